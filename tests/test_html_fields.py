"""Character references and attribute order of landed pages; literal rule patterns."""

from pyspark.sql import functions as F


def test_references(spark):
    from newsflow.functions.text import unescape_html
    cases = [("a &lt;b&gt; &quot;c&quot;", 'a <b> "c"'), ("caf&eacute; &#8217;s &#x1F600;", "caf\u00e9 \u2019s \U0001F600"),
             ("&amp;lt; &#38;lt; &amp;#8217;", "&lt; &lt; &#8217;"), ("&nosuch; & &; &#; 5 &frac12;", "&nosuch; & &; &#; 5 \u00bd"),
             ("&#xD800; &#0; &#9999999;", "\ufffd \ufffd \ufffd"), ("it&apos;s &nbsp;x", "it's \u00a0x"), ("plain", "plain"), ("", ""), (None, None)]
    df = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(cases)], "i int, x string")
    got = {r.i: r.y for r in df.select("i", unescape_html("x").alias("y")).collect()}
    assert got == {i: y for i, (_, y) in enumerate(cases)}


def test_meta_in_either_order(spark):
    from newsflow.functions.text import html_fields
    pages = ['<title>T &ndash; x</title><meta property="og:image" content="https://i/1.png">',
             "<meta content='https://i/2.png?a=1&amp;b=2' property='og:image'/>"
             '<meta content="2024-01-02T03:04:05Z" property="article:published_time">', "<p>none</p>"]
    rows = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "i int, html string") \
        .select("i", html_fields("html").alias("f")).orderBy("i").collect()
    assert [r.f.top_image for r in rows] == ["https://i/1.png", "https://i/2.png?a=1&b=2", None]
    assert rows[0].f.title == "T \u2013 x" and str(rows[1].f.publish_date) == "2024-01-02 03:04:05" and rows[2].f.title == ""


def test_patterns_are_literals_of_the_plan(spark):
    from newsflow.operators.models import _matches
    rules = spark.createDataFrame([("",), ("^a.$",), ("b+",), (None,)], "pattern string")
    texts = spark.createDataFrame([("ab",), ("bb",), ("",), (None,)], "x string").crossJoin(rules)
    few = texts.select("x", "pattern", F.coalesce(_matches(F.col("x"), F.col("pattern"), rules), F.lit(False)).alias("m"))
    many = texts.select("x", "pattern", F.coalesce(_matches(F.col("x"), F.col("pattern"), rules, 1), F.lit(False)).alias("m"))
    as_set = lambda df: {tuple(r) for r in df.where("x IS NOT NULL").collect()}
    assert as_set(few) == as_set(many)
