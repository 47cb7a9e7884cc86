from pyspark.sql import functions as F

from dimsmith.functions.hashing import diff_hash, hash_hex, null_hash


def _h(spark, rows, schema):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(hash_hex(diff_hash(df.columns))).collect()]


def test_case_and_outer_blanks_are_no_change(spark):
    a, b = _h(spark, [("Ann ",), ("ANN",)], "v string")
    assert a == b


def test_null_equals_placeholder(spark):
    a, b = _h(spark, [(None,), ("^^",)], "v string")
    assert a == b


def test_delimiter_is_not_escaped(spark):
    a, b = _h(spark, [("a|b", "c"), ("a", "b|c")], "x string, y string")
    assert a == b


def test_real_change_differs(spark):
    a, b = _h(spark, [("a", "c"), ("a", "d")], "x string, y string")
    assert a != b


def test_null_hash_is_sha1_of_marker(spark):
    got = spark.range(1).select(hash_hex(null_hash())).first()[0]
    import hashlib
    assert got == hashlib.sha1(b"*null*").hexdigest()


def test_decimal_text_keeps_scale(spark):
    df = spark.createDataFrame([(73.0,)], "v double").select(F.col("v").cast("decimal(12,2)").alias("v"))
    import hashlib
    assert df.select(hash_hex(diff_hash(["v"]))).first()[0] == hashlib.sha1(b"73.00").hexdigest()


def test_sample_order_never_overflows(spark):
    from dimsmith.sources.feeds import SAMPLE_MOD, sample_key
    df = spark.createDataFrame([(9_000_000_000_000_000_000,), (15_000_000_000,), (0,)], "k long")
    got = [r[0] for r in df.select(sample_key(F.col("k"), 7)).collect()]
    assert all(0 <= v < SAMPLE_MOD for v in got)
