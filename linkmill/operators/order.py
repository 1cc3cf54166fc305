"""Positions, exact splits, shards and batches over distributed rows.

Nothing here ranks rows in one task: positions come from a range-partitioned
sort plus one offset per sort task, cut points from counting hash prefixes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from linkmill.fixed_values import NUM_SHARDS, NUM_VALIDATION, SPLIT_SEED
from linkmill.plans.lineage import materialize

_TASK_BITS = 33  # monotonically_increasing_id keeps the task number above this bit
_PREFIX_DIGITS = 4
#: splits that a table may have
MAX_GROUPS = 16


def content_hash(df: DataFrame) -> Column:
    """A hash of all columns of a row; maps count by their JSON form."""
    cells = [F.to_json(f"`{f.name}`") if isinstance(f.dataType, MapType) else F.col(f"`{f.name}`") for f in df.schema]
    return F.xxhash64(*cells) if cells else F.lit(0).cast("long")


def stable_order(df: DataFrame, *order: str | Column) -> DataFrame:
    """Global sort in which equal keys may be spread over several tasks.

    Ties are broken by a hash of the whole row, so the order is the same for any
    layout of the input.  Rows that are equal throughout are told apart by their
    place in their task once it is sorted by that hash, so a range can also end within one value that
    holds a large part of the rows; a task run again, with its rows in another order, numbers
    them alike.  Nothing is written.
    """
    hashed = df.withColumn("_content", content_hash(df)).sortWithinPartitions("_content")
    numbered = hashed.withColumn("_tie", F.monotonically_increasing_id())
    return numbered.orderBy(*order, "_content", "_tie").drop("_content", "_tie")


def with_row_index(df: DataFrame, *order: str | Column, name: str = "row_index") -> DataFrame:
    """Add the 0-based position of each row in the given order."""
    placed = stable_order(df, *order).withColumn("_place", F.monotonically_increasing_id())
    stored = materialize(placed, "ordered")
    task = F.shiftright("_place", _TASK_BITS)
    # one row per sort task, so the running sum below stays small
    sizes = stored.groupBy(task.alias("_task")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = F.col("_place").bitwiseAND(F.lit((1 << _TASK_BITS) - 1))
    return (
        stored.withColumn("_task", task)
        .join(F.broadcast(starts), "_task")
        .select(*df.columns, (F.col("_start") + within).alias(name))
    )


def first_rows(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """The first ``n`` rows in the given order; each task keeps at most ``n``."""
    return df.orderBy(*order).limit(n)


def shuffle_key(key: str, seed: int = SPLIT_SEED) -> Column:
    """A seeded, repeatable stand-in for a random position of ``key``."""
    return F.md5(F.concat(F.lit(str(seed)), F.col(key).cast("string")))


def _hashed(df: DataFrame, key: str, seed: int, group: Column) -> DataFrame:
    text = F.col(key).cast("string")
    return df.select(group.alias("_group"), shuffle_key(key, seed).alias("_hash"), text.alias("_key"))


def _keys_at(keys: DataFrame, wanted) -> dict[str, list[tuple[str, str]]]:
    """Per group, the ``(_hash, _key)`` at the positions ``wanted(rows)`` (from 1).

    One pass counts rows per group and hash prefix (at most 65,536 prefixes),
    a second ranks only the rows of the prefixes that hold a wanted position.
    """
    spark = keys.sparkSession
    marked = keys.withColumn("_prefix", F.substring("_hash", 1, _PREFIX_DIGITS))
    most = MAX_GROUPS << 4 * _PREFIX_DIGITS
    counts = marked.groupBy("_group", "_prefix").agg(F.count(F.lit(1)).alias("n")).limit(most + 1).toPandas()
    if len(counts) > most:
        raise ValueError(f"more than {MAX_GROUPS} splits")
    places = []
    for group, part in counts.sort_values("_prefix").groupby("_group"):
        upto = part["n"].cumsum().to_numpy()
        for position in wanted(int(upto[-1])):
            if position > upto[-1]:
                continue
            bucket = int(upto.searchsorted(position))
            inside = int(position - (upto[bucket] - part["n"].iloc[bucket]))
            places.append((group, part["_prefix"].iloc[bucket], inside, int(position)))
    if not places:
        return {}
    picks = F.broadcast(  # one row per wanted position
        spark.createDataFrame(places, "_group string, _prefix string, _rank int, _position long")
    )
    buckets = picks.select("_group", "_prefix").distinct()
    ranked = marked.join(F.broadcast(buckets), ["_group", "_prefix"]).withColumn(
        "_rank", F.row_number().over(Window.partitionBy("_group", "_prefix").orderBy("_hash", "_key"))
    )
    found: dict[str, list[tuple[str, str]]] = {}
    rows = ranked.join(picks, ["_group", "_prefix", "_rank"]).collect()
    for row in sorted(rows, key=lambda r: r["_position"]):
        found.setdefault(row["_group"], []).append((row["_hash"], row["_key"]))
    return found


def seeded_split(
    df: DataFrame,
    key: str,
    n_validation: int = NUM_VALIDATION,
    seed: int = SPLIT_SEED,
    name: str = "split",
    listed: DataFrame | None = None,
) -> DataFrame:
    """Mark exactly ``n_validation`` rows 'validation', all others 'train'.

    ``key`` must be unique.  The split is a condition on each row, so the rows
    themselves are neither sorted nor joined.  ``listed`` may give the same keys at less
    cost than ``df``; the cut is then found there.
    """
    train, validation = F.lit("train"), F.lit("validation")
    if n_validation <= 0:
        return df.withColumn(name, train)
    keys = _hashed(df if listed is None else listed, key, seed, F.lit("all"))
    around = _keys_at(keys, lambda rows: (n_validation, n_validation + 1)).get("all", [])
    if len(around) < 2:  # no row beyond the validation part
        return df.withColumn(name, validation)
    if around[0] == around[1]:
        raise ValueError(f"the split key is not unique: {around[0][1]!r}")
    place = F.struct(shuffle_key(key, seed), F.col(key).cast("string"))
    last = F.struct(*[F.lit(v) for v in around[0]])
    return df.withColumn(name, F.when(place <= last, validation).otherwise(train))


def assign_shards(
    df: DataFrame,
    key: str,
    n: int = NUM_SHARDS,
    split: str = "split",
    seed: int = SPLIT_SEED,
    name: str = "shard",
    listed: DataFrame | None = None,
) -> DataFrame:
    """Contiguous shards of ``ceil(rows / n)`` rows per split, in shuffled order.

    Nothing is sorted: a row gets its shard by comparing its key with the first
    keys of the shards of its split.  ``listed`` may give the same keys and splits.
    """

    def firsts(rows: int) -> list[int]:
        size = -(-rows // n)
        return [i * size + 1 for i in range(1, n) if i * size < rows]

    cuts = _keys_at(_hashed(df if listed is None else listed, key, seed, F.col(split)), firsts)
    place = F.struct(shuffle_key(key, seed), F.col(key).cast("string"))
    shard = F.lit(0)
    for value, keys in cuts.items():
        points = F.array(*[F.struct(F.lit(h), F.lit(k)) for h, k in keys])
        passed = F.size(F.filter(points, lambda point: point <= place))
        shard = F.when(F.col(split) == F.lit(value), passed).otherwise(shard)
    return df.withColumn(name, shard.cast("int"))


def take_batches(
    df: DataFrame, batch_size: int, *order: str | Column, drop_short: bool = False
) -> DataFrame:
    """Consecutive batches: adds ``row_index`` and ``batch_id``.

    A short last batch is kept; ``drop_short`` leaves it out.
    """
    indexed = with_row_index(df, *order)
    batched = indexed.withColumn("batch_id", F.floor(F.col("row_index") / F.lit(batch_size)))
    if not drop_short:
        return batched
    rows = indexed.count()
    return batched.where(F.col("row_index") < rows - rows % batch_size)


def assign_replicas(df: DataFrame, replicas: int, *order: str | Column, equal: bool = True) -> DataFrame:
    """Equal consecutive parts: adds ``row_index`` and ``replica_id``.

    Rows that have no equal parts are an error, unless parts need not be ``equal``: their sizes
    then differ by one row at most.
    """
    indexed = with_row_index(df, *order)
    rows = indexed.count()
    if equal and rows % replicas:
        raise ValueError(f"{rows} rows cannot be split into {replicas} equal parts")
    # whole numbers: a quotient of doubles may lie on the wrong side of a part's first row
    part = F.expr(f"row_index * {replicas}L div {max(rows, 1)}L")
    return indexed.withColumn("replica_id", part.cast("int"))


def repeat_epochs(df: DataFrame, epochs: int) -> DataFrame:
    """Every row once per epoch, numbered in ``epoch``."""
    if epochs < 1:
        return df.withColumn("epoch", F.lit(0)).where(F.lit(False))
    return df.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))


def stream_places(batch_size: int, rows: int, step: int, index: str = "row_index") -> Column:
    """Places (from 0) of a row in batch ``step`` of the stream of rows, repeated without end.

    Batches run on over the end of an epoch, so no row is left out; a batch
    larger than the table holds rows several times.
    """
    first = F.pmod(F.col(index) - F.lit(step * batch_size % rows), F.lit(rows)).cast("long")
    places = F.sequence(first, F.greatest(first, F.lit(batch_size - 1).cast("long")), F.lit(rows).cast("long"))
    return F.filter(places, lambda place: place < batch_size)


def epochs_needed(rows: int, batch_size: int, batch_num: int) -> int:
    """How often ``rows`` rows must be repeated to fill all batches."""
    return -(-batch_num * batch_size // rows)
