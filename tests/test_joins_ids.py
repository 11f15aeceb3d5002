import bisect
import random
import re
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entiledger.operators import ids
from entiledger.operators.ids import dense_ids, first_free, next_id
from entiledger.operators.joins import (
    fits_broadcast,
    hot_keys,
    hot_values,
    id_join,
    lookup_join,
)

from .conftest import rows


def big(spark, n=20_000):
    """A third of the rows has key 7, another part has no key."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 1, None)
    return spark.range(0, n, 1, 16).select(
        key.otherwise(F.col("id") % 1500).alias("k"), F.col("id").alias("v")
    )


def lookup(spark):
    return spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("spread", [None, ["v"]])
def test_salted_join_equals_plain_join(broadcast_up_to, spark, how, spread):
    left, right = big(spark), lookup(spark)
    want = rows(left.join(right, "k", how))
    assert rows(lookup_join(left, right, "k", how, spread=spread)) == want
    broadcast_up_to("-1")
    got = lookup_join(left, right, "k", how, spread=spread)
    assert got.columns == ["k", "v", "w"]
    assert rows(got) == want


def test_salted_join_on_two_keys(broadcast_up_to, spark):
    broadcast_up_to("-1")
    left = big(spark).withColumn("t", F.when(F.col("v") % 2 == 0, "a").otherwise("b"))
    right = lookup(spark).withColumn("t", F.lit("a"))
    got = lookup_join(left, right, ["t", "k"], "left", profile=left.select("t", "k"))
    assert rows(got, "t", "k", "v", "w") == rows(
        left.join(right, ["t", "k"], "left"), "t", "k", "v", "w"
    )


@pytest.fixture
def many_partitions(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "32",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield 32
    for name, value in before.items():
        spark.conf.set(name, value)


def largest_task(joined):
    sizes = joined.groupBy(F.spark_partition_id()).count().agg(F.max("count"))
    return sizes.first()[0]


def test_hot_key_is_spread(spark, many_partitions):
    """Neither the hot key nor the missing keys end up in one task."""
    joined = lookup_join(big(spark), lookup(spark), "k", "left")
    assert largest_task(joined) < 20_000 / 6


def test_many_equally_hot_keys_are_spread(spark, many_partitions):
    """However many keys share the rows, no task gets far more than its part."""
    for keys in (300, 40):
        left = spark.range(0, 60_000, 1, 16).select(
            (F.col("id") % keys * 2**20).alias("k"), F.col("id").alias("v")
        )
        right = spark.range(keys).select((F.col("id") * 2**20).alias("k"))
        joined = lookup_join(left, right, "k", "inner", ["v"])
        assert joined.count() == 60_000
        assert largest_task(joined) < 3 * 60_000 / many_partitions


def test_no_rows_meet_in_a_single_partition(spark, many_partitions):
    joined = lookup_join(big(spark), lookup(spark), "k", "left")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    for part in plan.split("Exchange SinglePartition")[1:]:
        assert "partial_" in part.split("\n")[1]


def test_hot_keys_are_relative(spark, many_partitions):
    even = spark.range(10_000).select(F.col("id").alias("k"))
    assert hot_keys(even, ["k"]).count() == 0
    got = {r.k: r._salts for r in hot_keys(big(spark), ["k"]).collect()}
    assert set(got) == {7}
    n = big(spark).where("k = 7").count() / big(spark).where("k IS NOT NULL").count()
    assert got[7] == -(-n * 256 // 1)
    both = hot_values(big(spark), ["k", "v"])
    assert rows(both["k"]) == sorted(got.items())
    assert both["v"].count() == 0


def test_size_decides_about_a_broadcast(broadcast_up_to, spark):
    broadcast_up_to("1000b")
    assert fits_broadcast(spark.range(10))
    assert not fits_broadcast(spark.range(1000))


@pytest.mark.parametrize("how", ["inner", "left_semi", "left_anti"])
def test_ids_are_never_broadcast(broadcast_up_to, spark, how):
    """However small their files are: the driver would hold all of them."""
    broadcast_up_to("10m")
    left = big(spark, 200).where("v < 120 OR k IS NULL")
    want = left.join(lookup(spark).where("k < 50"), "k", how)
    got = id_join(left, lookup(spark).where("k < 50"), "k", how)
    assert rows(got, *want.columns) == rows(want)
    assert "Broadcast" in want._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()


def test_rejects_other_join_types(spark):
    with pytest.raises(ValueError):
        lookup_join(big(spark), lookup(spark), "k", "right")


def numbered(spark, keys, start=0):
    df = spark.createDataFrame([(k,) for k in keys], "k long").repartition(7)
    return {r.k: r.n for r in dense_ids(df, "k", "n", start).collect()}


def test_dense_ids_follow_key_order(spark):
    rng = random.Random(5)
    keys = {rng.randrange(-(2**63), 2**63) for _ in range(300)}
    keys |= {rng.randrange(-(2**44), 2**44) for _ in range(300)}
    keys |= set(range(2**20 - 150, 2**20 + 150)) | {0, -1, 2**63 - 1, -(2**63)}
    want = {key: 1000 + place for place, key in enumerate(sorted(keys))}
    assert numbered(spark, keys, 1000) == want


def test_dense_ids_of_nothing_and_of_a_missing_key(spark):
    assert numbered(spark, []) == {}
    assert numbered(spark, [5, None, -3]) == {None: 0, -3: 1, 5: 2}


def test_dense_ids_with_major(spark):
    df = spark.createDataFrame(
        [(2, 5), (1, 2**50), (1, 3), (2, -4), (3, 0)], "m int, k long"
    )
    got = rows(dense_ids(df, "k", "n", 10, "m"))
    assert got == [(1, 3, 10), (1, 2**50, 11), (2, -4, 12), (2, 5, 13), (3, 0, 14)]


def test_dense_ids_keep_other_columns(spark):
    df = spark.createDataFrame([(1, "b"), (0, "a")], "k int, t string")
    assert rows(dense_ids(df, "k", "n")) == [(0, "a", 0), (1, "b", 1)]


def test_sparse_keys_make_few_even_buckets(spark, many_partitions):
    """Hash-like and clustered keys alike: counts as many as buckets, none of them large."""
    rng = random.Random(7)
    sparse = [rng.randrange(-(2**63), 2**63) for _ in range(6000)]
    keys = spark.createDataFrame([(k,) for k in {*sparse, *range(6000)}], "k long")
    borders = ids.key_borders(keys, "k", 64)
    assert borders == sorted(set(borders)) and 50 < len(borders) <= 64
    assert borders == ids.key_borders(keys.repartition(5), "k", 64)
    bucket = ids._range_of(F.col("k"), borders).alias("b")
    sizes = [r["count"] for r in keys.groupBy(bucket).count().collect()]
    assert len(sizes) <= 65 and max(sizes) < 12_000 / 64 * 8
    for k, b in keys.select("k", bucket).limit(500).collect():
        assert b == bisect.bisect_right(borders, k)


def test_row_ids_need_no_key(spark):
    data = [(1, None)] * 5 + [(1, "a"), (None, None)] + [(2, "b")] * 70_000
    df = spark.createDataFrame(data, "k int, t string").repartition(7)
    done = ids.row_ids(ids.counted_rows(df), "n", 10)
    again = ids.row_ids(ids.counted_rows(df.repartition(3)), "n", 10)
    assert done.columns == ["k", "t", "n"]
    got = rows(done)
    assert sorted(r[2] for r in got) == list(range(10, 10 + len(data)))
    assert rows(done, "k", "t") == rows(df)
    assert rows(again) == got
    assert rows(ids.row_ids(ids.counted_rows(df.limit(0)), "n")) == []


def test_lacking_rows_counts_copies(spark):
    want = spark.createDataFrame([(1, "a")] * 3 + [(1, None)] * 2 + [(2, "b")], "k int, t string")
    stored = spark.createDataFrame([("a", 1), (None, 1), (None, 1), ("c", 9)], "t string, k int")
    assert rows(ids.lacking_rows(want, stored)) == [(1, "a", 2), (2, "b", 1)]
    assert rows(ids.lacking_rows(want, want)) == []
    assert rows(ids.lacking_rows(want, want.limit(0)), "_copies") == [(1,), (2,), (3,)]


def _shuffles(df):
    """Exchanges by key in a plan."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning")


def test_lacking_rows_shuffle_each_side_once(spark, tmp_path):
    spark.range(100).selectExpr("id AS k", "'a' AS t").write.parquet(f"{tmp_path}/t")
    want, stored = (spark.read.parquet(f"{tmp_path}/t") for _ in range(2))
    assert _shuffles(ids.lacking_rows(want, stored)) == 1
    none = stored.where("k < 0")
    assert _shuffles(ids.rows_to_add(want, none)) == 0
    assert rows(ids.rows_to_add(want, none), "k", "_copies") == [(k, 1) for k in range(100)]
    assert rows(ids.rows_to_add(want, stored.where("k > 1")), "k") == [(0,), (1,)]


def test_lacking_rows_are_not_counted_before_their_shuffle(spark, tmp_path):
    twice = spark.range(100).selectExpr("id % 50 AS k", "nullif('a', 'a') AS t")
    twice.write.parquet(f"{tmp_path}/t")
    want = spark.read.parquet(f"{tmp_path}/t")
    lacking = ids.lacking_rows(want, want.where("k < 25").distinct())
    plan = lacking._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("Exchange hashpartitioning", 1)
    assert above.count("HashAggregate") == 2
    assert "partial_sum" in above and "partial_sum" not in below
    assert rows(lacking) == [(k, None, 1 if k < 25 else 2) for k in range(50)]
    constant = want.select("t").na.fill("x")
    assert rows(ids.lacking_rows(constant, constant.limit(1), {"t": "x"})) == [("x", 99)]


def test_columns_of_one_value_are_not_shuffled(spark):
    want = spark.createDataFrame([(1, "x", 0.5)] * 2 + [(None, "x", 0.5)], "k int, t string, f float")
    told = [(1, "x", 0.5), (1, "y", 0.5), (1, None, 0.5), (None, "x", 0.25), (None, "x", None)]
    stored = spark.createDataFrame(told, "k int, t string, f float")
    lacking = ids.lacking_rows(want, stored, {"t": "x", "f": 0.5})
    assert lacking.schema.names == ["k", "t", "f", "_copies"]
    assert rows(lacking) == rows(ids.lacking_rows(want, stored)) == [(1, "x", 0.5, 1), (None, "x", 0.5, 1)]
    plan = lacking._jdf.queryExecution().executedPlan().toString()
    assert re.findall(r"hashpartitioning\((.*?), \d+\)", plan)[0].startswith("k#")
    assert "t#" not in re.findall(r"hashpartitioning\((.*?), \d+\)", plan)[0]


def test_runs_tell_whether_rows_are_numbered_once(spark, monkeypatch):
    def once(*parts):
        listed = [spark.createDataFrame([(k,) for k in p], "k long").coalesce(1) for p in parts]
        return ids.numbered_once(reduce(DataFrame.union, listed), "k")

    assert once([5, 6, 7], [1, 2, 4])
    assert once([3, 1, 2]) and once([])
    assert not once([5, 6, 7], [7, 8])
    assert not once([1, 1])
    assert not once([1, 2, None])
    # Ranges that overlap are not told; the rows are counted then.
    assert not once([1, 9, 3], [2])
    monkeypatch.setattr(ids, "MOST_BUCKETS", 2)
    assert once([1, 2, 4]) and not once([1, 3, 5])


def test_row_ids_by_place_in_stored_files(spark, tmp_path):
    data = [(None, None)] * 3 + [(1, "a")] * 70_000 + [(k, "b") for k in range(40)]
    df = spark.createDataFrame(data, "k int, t string").repartition(5)

    def store(copies):
        copies.withColumn("n", F.lit(None).cast("long")).write.parquet(f"{tmp_path}/t")
        return spark.read.parquet(f"{tmp_path}/t")

    done = ids.row_ids(ids.counted_rows(df), "n", 10, store)
    assert done.columns == ["k", "t", "n"]
    # The files alone are grouped.
    assert _shuffles(done) == 1
    got = rows(done)
    assert sorted(r[2] for r in got) == list(range(10, 10 + len(data)))
    assert rows(done, "k", "t") == rows(df)
    assert rows(done) == got
    split = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(split)
    spark.conf.set(split, "2k")
    assert rows(done.select("*")) == got
    spark.conf.set(split, before)


def test_hot_keys_of_crowded_classes_only(spark, many_partitions):
    few = spark.range(60_000).select((F.col("id") % 9).alias("k"))
    assert rows(hot_keys(few, ["k"]), "k") == [(k,) for k in range(9)]
    mixed = few.where("k = 3").union(spark.range(100, 60_000).toDF("k"))
    assert rows(hot_keys(mixed, ["k"]), "k") == [(3,)]
    plan = hot_keys(mixed, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert "_class" in plan and "LeftSemi" in plan


def test_next_id(spark):
    table = spark.createDataFrame([(4,), (9,)], "n long")
    one = spark.range(1)
    assert one.select(next_id(table, "n", 1)).first()[0] == 10
    assert one.select(next_id(table.where("n > 20"), "n", 1000)).first()[0] == 1000


def test_first_free(spark):
    table = spark.createDataFrame([(4,), (9,)], "n long")
    none = table.where("n > 20")
    assert first_free(1000, table, none) == 10
    assert first_free(1000, none, none) == 1000
    assert first_free(1, table, table.selectExpr("n + 5")) == 15
