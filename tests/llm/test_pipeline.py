"""The stages of the pipeline over null ids, repeated rows and tables without labels."""

import os
import sys
from urllib.parse import urlparse

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402

from linkmill.plans import lineage  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string"
LEAK = " ".join(f"leak{i}" for i in range(20))
ONE = " ".join(f"one{i}" for i in range(60))
TWO = " ".join(f"two{i}" for i in range(60))
ROWS = [
    (None, ONE, "null id, no copy"),
    (5, TWO, "first"),
    (5, TWO, "first"),
    (None, TWO, "copy without an id"),
    (6, TWO.replace("two9 ", "other "), "near copy"),
    (7, "its own text of some words", "repeated id"),
    (7, "and quite another text here", "repeated id too"),
    (None, LEAK, "leak without an id"),
    (8, "12 345", "no letter"),
    (9, None, "no text"),
]
LEFT = ["first", "null id, no copy", "repeated id", "repeated id too"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    rows = [(d, t, None, kind) for d, t, kind in ROWS]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, LEAK)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_run_without_labels(spark, folder):
    """No label at all; every row that is no copy, no leak and has a letter reaches the mix once."""
    rows = corpus_pipeline.run(spark, folder).collect()
    assert sorted(r.source for r in rows) == LEFT
    assert sum(r.taken for r in rows) == sum(r["size"] for r in rows) == 131


def test_row_numbers(spark, tmp_path):
    """From files and places; a table that is no scan is written first; names that clash."""
    frame = spark.range(1000).repartition(7).withColumnRenamed("id", "row_key")
    frame.write.parquet(str(tmp_path / "rows"))
    for rows in (spark.read.parquet(str(tmp_path / "rows")), frame):
        numbered, key = corpus_pipeline._keyed(rows)
        assert key == "row_key_" and numbered.columns == ["row_key", "row_key_"]
        first, again = ({r.row_key: r[key] for r in numbered.collect()} for _ in range(2))
        assert first == again and len(set(first.values())) == 1000 and set(first) == set(range(1000))
    assert corpus_pipeline._keyed(frame.limit(0))[0].count() == 0


def test_stages_scan_texts_where_they_lie(spark, folder):
    """No stage shuffles the texts it keeps, and extra columns come through as they are."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    path = f"{folder}/with_more.parquet"
    docs.selectExpr("*", "'mine' AS lang_pred", "7 AS score", "1 AS _text").write.parquet(path)
    docs = spark.read.parquet(path)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, folder)
        assert kept.columns == docs.columns
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "Exchange hash" not in plan
        assert all((r.lang_pred, r.score, r._text) == ("mine", 7, 1) for r in kept.collect())


def test_scratch_tables_go(spark, tmp_path):
    before = lineage.shared_folder(spark)
    rows = spark.range(5)
    with lineage.scratch(spark):
        with lineage.scratch(spark):
            inner, kept = lineage.materialize(rows, "inner"), lineage.materialize(rows, "kept", lasting=True)
            inner_files, kept_files = inner.inputFiles(), kept.inputFiles()
        exists = [os.path.exists(urlparse(f[0]).path) for f in (inner_files, kept_files)]
        assert exists == [False, True]
    assert not os.path.exists(urlparse(kept_files[0]).path) and lineage.shared_folder(spark) == before
    assert os.path.exists(urlparse(lineage.materialize(rows, "outside").inputFiles()[0]).path)
