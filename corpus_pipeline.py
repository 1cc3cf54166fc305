"""The training-data pipeline: a list of stages from documents to the final mix.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows it is given.
All but the last return the columns of documents; the last returns what the mix
takes of each document left.  Rows are judged one by one: a null doc_id is no
reason to go, a repeated one no reason to stay.

A stage works out which rows go and returns ``docs`` without them: texts are scanned
where they lie and neither copied nor shuffled for that.  Its intermediate tables are
deleted at its end; what stays is the list of rows that go.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkmill.llm import decontam, exact_dedup, fair_mix, lang_id, part_enum
from linkmill.plans.lineage import materialize, scratch, small_batches, stored
from linkmill.plans.sizes import small_side

#: words of a document inside benchmark windows from which on it goes
HIT_WORDS = 1
#: bits for the place of a row in its file
_ROW_BITS = 40


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a whole number of its own for every row, and that column's name.

    A row of a file is named by the file and its place there, so nothing is written
    and a task run again finds the same numbers.  A table that is no scan of such files is written first.
    """
    taken = {c.lower() for c in docs.columns}
    names = []
    for name in ("row_key", "row_file", "row_place"):
        while name in taken:
            name += "_"
        names.append(name)
    key, file, place = names
    try:
        located = docs.select("*", F.col("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(place))
    except AnalysisException:
        return _keyed(materialize(docs, "rows", lasting=True))
    # as many as the scan has files, which the driver lists anyway
    files = sorted(row[0] for row in located.select(file).distinct().collect())
    numbers = docs.sparkSession.createDataFrame(list(enumerate(files)), f"{key} long, {file} string")
    numbered = located.join(small_side(numbers), file)
    number = F.shiftleft(F.col(key), _ROW_BITS).bitwiseOR(F.col(place)).alias(key)
    return numbered.select(*(F.col(f"`{c}`") for c in docs.columns), number), key


def _without(docs: DataFrame, rows: DataFrame, key: str, gone: DataFrame) -> DataFrame:
    """The columns of ``docs`` for the numbered ``rows`` whose number is not in ``gone``."""
    gone = stored(gone.select(key), "gone", lasting=True)
    return rows.join(small_side(gone), key, "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; without text or a letter they go.

    If no row teaches a language (none is labelled, or all that are have a null
    id or are held out), only rows without text or a letter go.
    """
    model = lang_id.train(docs)
    letters = F.coalesce(F.col("text"), F.lit("")).rlike(r"\p{L}")
    if not model.languages:
        return docs.where(letters)
    with scratch(spark), small_batches(spark):
        rows, key = _keyed(docs)
        found = lang_id.identify(rows.select(key, "text"), model, keep=[key])
        return _without(docs, rows, key, found.where(F.col("lang_pred") == lang_id.UNKNOWN))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts: the longest, then the smallest id.

    A null id loses to any other; of rows that repeat an id one stays.
    """
    with scratch(spark):
        rows, key = _keyed(docs)
        one = F.struct(F.isnull("doc_id").alias("none"), F.col("doc_id"), F.col(key).alias("row"))
        groups = exact_dedup.exact_groups(rows.select("text", one.alias("one")), doc_id="one")
        return _without(docs, rows, key, groups.where("not kept").select(F.col("doc_id.row").alias(key)))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of similar texts: the smallest id.

    A null id loses to any other; of rows that repeat an id and are similar one
    stays.  A text without words is like no other and stays.
    """
    with scratch(spark):
        rows, key = _keyed(docs)
        groups = part_enum.similar_groups(rows, doc_id=key).select(F.col("doc_id").alias(key), "component_id")
        several = groups.groupBy("component_id").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
        several = stored(several.select("component_id"), "several")
        members = stored(groups.join(small_side(several), "component_id"), "members")
        one = F.struct(F.isnull("doc_id").alias("none"), F.col("doc_id"), F.col(key).alias("row"))
        ranked = stored(rows.select("doc_id", key).join(small_side(members), key), "ranked")
        best = stored(ranked.groupBy("component_id").agg(F.min(one).alias("one")), "best")
        gone = ranked.join(small_side(best.select(F.col("one.row").alias(key))), key, "left_anti")
        return _without(docs, rows, key, gone)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without words inside benchmark windows; every row is judged by its own text."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    with scratch(spark):
        rows, key = _keyed(docs)
        found = decontam.contamination(rows, items, doc_id=key).where(F.col("n_hit") >= HIT_WORDS)
        return _without(docs, rows, key, found.select(F.col("doc_id").alias(key)))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document."""
    return fair_mix.mix_by_weight(docs).select("doc_id", "source", "size", "source_size", "target", "taken")


STAGES = [
    ("language", language),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("benchmark_leaks", benchmark_leaks),
    ("mix", mix),
]

#: stages on kernels, signatures and set similarity have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
