from conftest import rows
from pyspark.sql import functions as F

from cadenza.operators.joins import hot_keys, lookup_join, null_safe_join, plan_bytes


def test_salted_join_equals_broadcast_join_with_a_hot_key(spark):
    facts = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("k"), F.col("id").alias("u")
    )
    dim = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    for how in ("inner", "left"):
        near = lookup_join(facts, dim, "k", ["u"], how)
        far = lookup_join(facts, dim, "k", ["u"], how, limit=0, salts=8)
        assert "_salt" in far._jdf.queryExecution().optimizedPlan().toString()
        assert sorted(near.columns) == sorted(far.columns)
        key = lambda r: (r["u"], r["k"])
        assert sorted(near.collect(), key=key) == sorted(far.select(near.columns).collect(), key=key)


def test_plan_bytes_grows_with_the_table(spark):
    assert plan_bytes(spark.range(10)) < plan_bytes(spark.range(100000))


def test_null_safe_join(spark):
    left = spark.createDataFrame([("a", 1), (None, 2)], "k string, x int")
    right = spark.createDataFrame([("a", 10), (None, 20)], "k string, y int")
    joined = null_safe_join(left, right, ["k"])
    assert rows(joined, "x", "y") == [(1, 10), (2, 20)]
    assert null_safe_join(left, right.where("k is null"), ["k"], "left_semi").count() == 1


def test_facts_of_one_row_per_key_are_not_copied(spark):
    facts = spark.range(30).select(F.col("id").alias("k"), F.col("id").alias("u"))
    dim = spark.range(20).select(F.col("id").alias("k"), F.col("id").alias("v"))
    plain = lookup_join(facts, dim, "k", ["k"], limit=0)
    assert "_salt" not in plain._jdf.queryExecution().optimizedPlan().toString()
    assert plain.count() == 20


def test_dimensions_are_copied_for_hot_keys_only(spark):
    even = spark.range(4000).select((F.col("id") % 400).alias("k"), F.col("id").alias("u"))
    dim = spark.range(500).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    plain = lookup_join(even, dim, "k", ["u"], limit=0)
    text = plain._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" not in text and "Generate" not in text and plain.count() == 4000
    skewed = even.withColumn("k", F.when(F.col("u") % 3 == 0, 17).otherwise(F.col("k")))
    assert hot_keys(skewed, "k") == ([17], False) and hot_keys(even, "k") == ([], False)
    joined = lookup_join(skewed, dim, "k", ["u"], limit=0, salts=8)
    assert "_salt" in joined._jdf.queryExecution().optimizedPlan().toString()
    assert joined.count() == 4000
    sizes = joined.where("k = 17").groupBy(F.pmod(F.xxhash64("u"), F.lit(8))).count().collect()
    assert len(sizes) == 8 and max(r["count"] for r in sizes) < 2 * 1334 / 8


def test_rows_without_a_key_are_spread(spark):
    facts = spark.range(900).select(F.when(F.col("id") % 3 > 0, F.col("id") % 100).alias("k"), F.col("id").alias("u"))
    dim = spark.range(90).select(F.col("id").alias("k"), F.col("id").cast("string").alias("v"))
    assert hot_keys(facts, "k")[1] and hot_keys(facts.where("k is null"), "k") == ([], True)
    near, far = lookup_join(facts, dim, "k", ["u"], "left"), lookup_join(facts, dim, "k", ["u"], "left", limit=0)
    assert "_salt" in far._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(repr, near.collect())) == sorted(map(repr, far.select(near.columns).collect()))
    assert lookup_join(facts.limit(0), dim, "k", ["u"], limit=0).count() == 0
