from pyspark.sql import functions as F

from corridor.llm.storage import fresh, small_side


def hinted(df):
    return "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()


def test_a_side_is_broadcast_by_rows_and_bytes(spark):
    ids = spark.range(1000)
    assert hinted(small_side(ids, 1000)) and not hinted(small_side(ids, 1000, limit=999))
    text = ids.select(F.expr("repeat('x', 100)").alias("t"))
    assert hinted(small_side(text, 1000)) and not hinted(small_side(text, 1000, max_bytes=50_000))
    nested = ids.select(F.struct("id", F.lit("abc")).alias("s"))
    assert hinted(small_side(nested, 1000)) and not hinted(small_side(nested, 1000, max_bytes=1000))
    assert hinted(small_side(text.limit(0), 0))


def test_names_that_no_column_has(spark):
    df = spark.sql("SELECT 1 AS a, 2 AS _A, 3 AS b")
    assert fresh(df, "a", "b", "c", "c") == ["__a", "_b", "c", "_c"]
