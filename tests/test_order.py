import hashlib
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from linkmill.operators import order as O
from linkmill.plans import batch_store as B
from linkmill.plans import lineage


@pytest.mark.parametrize("parts", [1, 4, 9])
def test_row_index_is_complete_even_with_one_heavy_key(spark, parts):
    rows = spark.range(1000).select(
        F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id") % 7).alias("k"), "id"
    ).repartition(parts)
    got = O.with_row_index(rows, "k").orderBy("row_index").collect()
    assert [r["row_index"] for r in got] == list(range(1000))
    keys = [r["k"] for r in got]
    assert keys == sorted(keys)
    assert {r["id"] for r in got} == set(range(1000))


def test_heavy_key_is_sorted_by_several_tasks(spark):
    rows = spark.range(4000, numPartitions=8).select(F.lit(1).alias("k"), "id")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = O.stable_order(rows, "k").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) > 3 and max(r["count"] for r in sizes) < 1500


def test_sort_behind_a_shuffle_writes_nothing_extra(spark):
    moved = spark.range(60).selectExpr("id % 3 AS k", "id % 7 AS v").repartition(5)
    plan = O.stable_order(moved, "k")._jdf.queryExecution().executedPlan().toString()
    assert "parquet" not in plan.lower() and "WriteFiles" not in plan
    assert not hasattr(lineage, "repeatable")


def test_order_of_ties_does_not_hang_on_the_layout(spark):
    rows = spark.range(300).selectExpr("id % 3 AS k", "id % 11 AS v", "map('a', id % 2) AS m", "array(id % 5) AS a")
    first = O.stable_order(rows, "k").collect()
    for layout in (rows.coalesce(1), rows.repartition(7), rows.orderBy(F.desc("v"))):
        assert O.stable_order(layout, "k").collect() == first


def test_row_index_of_nothing(spark):
    assert O.with_row_index(spark.range(0), "id").count() == 0


def paths(spark, n):
    return spark.range(n).select(F.concat(F.lit("/d/"), F.col("id"), F.lit(".jpg")).alias("path"))


def expected_order(n, seed=0):
    return sorted(
        (f"/d/{i}.jpg" for i in range(n)),
        key=lambda p: (hashlib.md5(f"{seed}{p}".encode()).hexdigest(), p),
    )


@pytest.mark.parametrize("n,want,seed", [(100, 35, 0), (100, 35, 9), (20, 20, 0), (20, 50, 0), (20, 0, 0)])
def test_seeded_split_is_exact(spark, n, want, seed):
    got = O.seeded_split(paths(spark, n), "path", want, seed).collect()
    first = set(expected_order(n, seed)[:want])
    assert {r["path"] for r in got if r["split"] == "validation"} == first
    assert len(got) == n


@pytest.mark.parametrize("digits", [0, 1, 2])
def test_split_with_many_rows_per_prefix(spark, monkeypatch, digits):
    monkeypatch.setattr(O, "_PREFIX_DIGITS", digits)
    got = O.seeded_split(paths(spark, 200), "path", 77).where("split = 'validation'").collect()
    assert {r["path"] for r in got} == set(expected_order(200)[:77])


def test_split_key_must_be_unique(spark):
    twice = paths(spark, 3).unionAll(paths(spark, 3))
    with pytest.raises(ValueError, match="not unique"):
        O.seeded_split(twice, "path", 3)


@pytest.mark.parametrize("n,n_val,shards", [(43, 10, 5), (12, 2, 5), (7, 3, 2), (6, 1, 1)])
def test_shards_are_contiguous_and_may_end_empty(spark, n, n_val, shards):
    split = O.seeded_split(paths(spark, n), "path", n_val)
    got = {r["path"]: (r["split"], r["shard"]) for r in O.assign_shards(split, "path", shards).collect()}
    order = expected_order(n)
    want = {}
    for name, part in (("validation", order[:n_val]), ("train", order[n_val:])):
        size = -(-len(part) // shards)
        want |= {p: (name, i // size) for i, p in enumerate(part)}
    assert got == want


@pytest.mark.parametrize("size", [4, 5, 10, 23])
def test_stream_of_batches_holds_every_row(spark, size):
    rows = spark.range(10).withColumnRenamed("id", "row_index")
    stream = [i % 10 for i in range(size * 7)]
    for step in range(7):
        found = {r["row_index"]: sorted(r["at"]) for r in rows.withColumn("at", O.stream_places(size, 10, step)).collect()}
        want = stream[step * size : (step + 1) * size]
        assert found == {i: [at for at, row in enumerate(want) if row == i] for i in range(10)}


def test_batches_and_replicas(spark):
    rows = spark.range(23).withColumnRenamed("id", "v")
    full = O.take_batches(rows, 5, "v").collect()
    assert sorted((r["v"], r["batch_id"]) for r in full) == [(i, i // 5) for i in range(23)]
    assert O.take_batches(rows, 5, "v", drop_short=True).count() == 20
    with pytest.raises(ValueError, match="equal parts"):
        O.assign_replicas(rows, 4, "v")
    parts = O.assign_replicas(rows.where("v < 20"), 4, "v").collect()
    assert sorted((r["v"], r["replica_id"]) for r in parts) == [(i, i // 5) for i in range(20)]


def test_epochs(spark):
    assert O.epochs_needed(10, 4, 6) == 3
    got = O.repeat_epochs(spark.range(3), 4).collect()
    assert sorted((r["id"], r["epoch"]) for r in got) == [(i, e) for i in range(3) for e in range(4)]
    assert O.repeat_epochs(spark.range(3), 0).count() == 0


@pytest.mark.parametrize("batch,max_ranges", [(4, 4096), (7, 3), (10, 4096), (23, 2), (60, 4096)])
def test_a_step_reads_only_the_files_of_its_batch(spark, batch, max_ranges):
    rows = spark.range(50).selectExpr("49 - id AS v", "id AS w").repartition(6)
    store = B.store_batches(rows, batch, "v", max_ranges=max_ranges)
    assert store.total == 50 and len(store.rows.select(B.RANGE).distinct().collect()) <= max_ranges
    folder_of = {f: int(f.split(f"{B.RANGE}=")[1].split("/")[0]) for f in store.rows.inputFiles()}
    for step in range(9):
        want = [(step * batch + k) % 50 for k in range(batch)]
        needed = {i // store.width for i in want}
        others = {urlparse(f).path: None for f, folder in folder_of.items() if folder not in needed}
        for path in others:  # whatever else the step opened would now fail
            with open(path, "rb") as file:
                others[path] = file.read()
            with open(path, "wb") as file:
                file.write(b"no parquet here")
        fed = store.batch(batch, step)
        assert [r["v"] for r in sorted(fed.collect(), key=lambda r: r["_place"])] == want
        for path, content in others.items():
            with open(path, "wb") as file:
                file.write(content)
        plan = fed._jdf.queryExecution().executedPlan().toString()
        assert B.RANGE in plan.split("PartitionFilters: ")[1].split("]")[0]


def test_store_of_nothing(spark):
    store = B.store_batches(spark.range(0).withColumnRenamed("id", "v"), 5, "v")
    assert store.total == 0 and store.batch(5, 3).collect() == []
