"""Sharded image datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkmill.fixed_values import NUM_SHARDS, SPLIT_SEED
from linkmill.functions.text import shard_file
from linkmill.operators.order import shuffle_key

SHARD_FILE = "shard_file"


def write_shards(
    records: DataFrame, out: str, key: str, shards: int = NUM_SHARDS, seed: int = SPLIT_SEED
) -> None:
    """One folder per shard, named after split and shard number.

    Shards are stretches of the hash order, and hashes are evenly spread: the
    leading digits alone place a row in one of equally large tasks, without
    sampling the encoded bytes first.  A task writes a stretch of one or two
    shards, and a shard of any size is spread over many tasks.
    """
    partitions = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    digits = F.conv(F.substring("_hash", 1, 8), 16, 10).cast("double")
    task = F.floor(digits / F.lit(float(1 << 32)) * F.lit(partitions)).cast("int")
    named = records.withColumns(
        {SHARD_FILE: shard_file(F.col("split"), F.col("shard"), shards), "_hash": shuffle_key(key, seed)}
    )
    placed = named.repartitionById(partitions, task).sortWithinPartitions(SHARD_FILE, "_hash", key)
    placed.drop("_hash", "split", "shard").write.mode("errorifexists").partitionBy(SHARD_FILE).parquet(out)
