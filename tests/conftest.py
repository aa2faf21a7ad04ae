import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from newsflow.session import get_spark
    s = get_spark("local[4]", 8, app_name="newsflow-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def profiles(spark):
    from newsflow.operators.lang import fit_language_profiles
    p = spark.read.parquet(f"{SF_MID}/documents.parquet")
    return fit_language_profiles(p, "text", "lang").cache()
