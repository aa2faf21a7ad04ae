"""Every registered query against its DuckDB oracle SQL on the smallest scale factor."""

import pytest

from tests.conftest import SF_SMALL


def _names():
    import __spark_entry__ as E
    return sorted(E.queries())


@pytest.fixture(scope="module")
def duck():
    from tools.oracle_check import duck as mk
    return mk(SF_SMALL)


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, duck, name):
    import __spark_entry__ as E
    from tools.oracle_check import digest
    got = E.queries()[name](spark, SF_SMALL).toPandas()
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert len(got.columns) > 0
        return
    want = duck.execute(sql).df()
    a, b = digest(got), digest(want)
    assert a[0] == b[0], (a[0], b[0])
    assert a[1] == b[1]
    assert a[2] == b[2], (sorted(set(a[3]) - set(b[3]))[:3], sorted(set(b[3]) - set(a[3]))[:3])


def test_entry(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["web_resource_id", "title", "top_image", "scraped_publish_date", "language", "publish_date"]
    assert df.count() > 0
