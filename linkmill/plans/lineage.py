"""Cutting lineage into storage that outlives executors.

The shared folder is the one the cluster names in ``spark.checkpoint.dir``, else
a folder below the session's warehouse, which is shared storage as well.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the session, set on the context if needed."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if named or current:
        if current is None:
            context.setCheckpointDir(named)
        return named or current
    own = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/linkmill-checkpoints"
    context.setCheckpointDir(own)
    return own


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing uses yet."""
    return f"{shared_folder(spark).rstrip('/')}/linkmill/{name}-{uuid.uuid4().hex}"


_scratch: ContextVar[tuple[list[str], ...]] = ContextVar("scratch", default=())


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables written meanwhile by :func:`materialize` are deleted at the end, but for lasting ones.

    Lasting tables belong to the scratch around this one, if there is any.
    """
    own: list[str] = []
    token = _scratch.set((*_scratch.get(), own))
    try:
        yield
    finally:
        _scratch.reset(token)
        for path in own:
            delete_path(spark, path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a table or folder that this job wrote."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def materialize(df: DataFrame, name: str, lasting: bool = False, compression: str | None = None) -> DataFrame:
    """Write ``df`` once as parquet and go on from the written table.

    Columns stay prunable and filters push down; values that are not
    repeatable (row positions, task numbers) are frozen by the write.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    owners = _scratch.get()[:-1] if lasting else _scratch.get()
    if owners:
        owners[-1].append(path)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def planned_session(spark: SparkSession, partitions: int, **settings: str) -> SparkSession:
    """A session beside ``spark`` with the same SQL settings, planned for that many shuffle partitions.

    Work that needs its own number leaves the caller's session, and whatever else is
    planned in it meanwhile, as they are.  Tables move between sessions by being written.
    """
    own = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if own.conf.isModifiable(name):
            own.conf.set(name, value)
    for name, value in {"spark.sql.shuffle.partitions": str(partitions), **settings}.items():
        own.conf.set(name, value)
    return own


def moved_to(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written once and read by another session."""
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored(df: DataFrame, name: str, lasting: bool = False) -> DataFrame:
    """:func:`materialize` in fewer files: one for two tasks that run at a time, or for eight shuffle partitions.

    For intermediate rows that are small beside the input: many shuffle partitions of few
    rows would leave as many files.
    """
    spark = df.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return materialize(df.coalesce(max(2 * spark.sparkContext.defaultParallelism, partitions // 8)), name, lasting)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 2_000) -> Iterator[None]:
    """Send rows of long texts to Python in smaller Arrow batches meanwhile.

    Both sides hold a batch whole, beside the copy that Arrow grows it in.  No result and no
    plan hangs on the setting, so a query that another thread runs meanwhile is none the worse.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    usual = spark.conf.get(name)
    if 0 < int(usual) <= rows:
        yield
        return
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, usual)


@contextmanager
def swept(spark: SparkSession) -> Iterator[None]:
    """Jobs that write meanwhile delete what they shuffled as they end, not when the driver collects its garbage.

    Whoever needs such rows again makes them again, so no result hangs on it.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    usual = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, usual)


def checkpoint(df: DataFrame) -> DataFrame:
    """Eager reliable checkpoint, for intermediate rows read exactly once."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
