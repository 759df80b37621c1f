import pytest
from pyspark.sql import functions as F
from stationkit.plans import keyed, ordered
from stationkit.plans.stored import shared_folder, store


def skewed(spark):
    """A third of the rows share one key; some rows have none; many are copies."""
    return spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 101 == 0, None)
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string")))
        .alias("key"),
        (F.col("id") % 7).alias("x"),
    )


def same(a, b):
    assert a.exceptAll(b).count() == 0
    assert b.exceptAll(a).count() == 0


@pytest.mark.parametrize("how", ["left", "inner", "left_semi"])
@pytest.mark.parametrize("weighted", [True, False])
def test_sliced_join_equals_plain_join(spark, how, weighted):
    rows = skewed(spark)
    counts = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    table = counts.where(F.col("key").isNotNull() & (F.col("key") != "k7"))
    plain = rows.join(table, "key", how)
    sliced = keyed.attach(
        rows, table, ["key"], how, weight="n" if weighted else None, broadcast_bytes=0
    )
    same(plain, sliced)
    same(plain, keyed.attach(rows, table, ["key"], how))


def test_heavy_key_missing_from_the_table_is_spread(spark):
    rows = skewed(spark)
    table = spark.createDataFrame([("k1", 1)], "key string, n int")
    heavy = keyed._heavy_keys(rows, table, ["key"], None)
    assert "hot" in [r.key for r in heavy.collect()]
    same(rows.join(table, "key", "left"), keyed.attach(rows, table, ["key"], broadcast_bytes=0))


def test_many_rows_per_key_in_the_table(spark):
    rows = skewed(spark)
    table = spark.createDataFrame([("hot", i) for i in range(3)] + [("k1", 9)], "key string, n int")
    same(
        rows.join(table, "key"),
        keyed.attach(rows, table, ["key"], "inner", broadcast_bytes=0),
    )


def test_slices_are_balanced(spark):
    rows = skewed(spark).where("key = 'hot'")
    sizes = rows.groupBy(F.pmod(keyed.row_hash(rows), F.lit(16))).count()
    # Only seven different rows exist; copies are spread by partition.
    assert sizes.count() > 7


def test_broadcast_only_below_the_limit(spark):
    rows, table = skewed(spark), skewed(spark).groupBy("key").count()
    small = keyed.attach(rows, table, ["key"])._jdf.queryExecution().toString()
    large = keyed.attach(rows, table, ["key"], weight="count", broadcast_bytes=0)
    assert "ResolvedHint (strategy=broadcast)" in small
    plan = large._jdf.queryExecution().toString().split("== Optimized")[0]
    # The list of heavy keys is broadcast to both sides, the table itself is not.
    assert plan.count("ResolvedHint (strategy=broadcast)") % 2 == 0


def test_stored_table_knows_its_size(spark):
    stored = store(spark.range(10).withColumn("t", F.lit("abc")), "t", top=F.max("id"))
    assert stored.rows == 10
    assert stored.bytes == 10 * (16 + 16 + 8 + 3)
    assert stored.seen["top"] == 9
    assert shared_folder(spark)


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_dense_ids_follow_the_order(spark, parts):
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    df = spark.range(500).select((F.col("id") * 37 % 500).alias("v"))
    ids = ordered.dense_ids(df, ["v"], "n")
    assert ids.where("v <> n").count() == 0
    assert ids.count() == 500


def test_running_total_over_blocks(spark):
    df = spark.range(100).withColumn("b", F.floor(F.col("id") / 9))
    total = ordered.running_total(df, ["id"], F.col("id"), "s", "b")
    assert total.where("s <> id * (id + 1) / 2").count() == 0


def test_package_is_packed_whole(tmp_path):
    import subprocess
    import sys

    from stationkit.plans import shipping

    path = shipping.packed(str(tmp_path))
    code = f"import sys; sys.path = [{path!r}, *sys.path[1:]]; import stationkit.operators.alike as a; print(a.__file__)"
    said = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=tmp_path)
    assert path in said.stdout


def test_workers_find_the_package(spark):
    from stationkit.plans import shipping

    shipping.ship(spark)
    shipping.ship(spark)
    assert spark.sparkContext.environment["PYTHONPATH"].endswith(str(shipping._ROOT))
