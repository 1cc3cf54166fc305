import pytest
from pyspark.sql import functions as F

from linkmill.operators import edges as E
from linkmill.sources import text as text_source
from linkmill.sources.text import first_lines, read_edges, read_lines


def pairs(df):
    return sorted((r["src"], r["dst"]) for r in df.collect())


def test_split_keeps_trailing_fields_and_extra_fields_are_ignored(lines_of):
    rows = E.split_fields(lines_of(["a\tb\tc", "a\t"])).collect()
    assert [r["fields"] for r in rows] == [["a", "b", "c"], ["a", ""]]
    assert pairs(E.parse_edges(lines_of(["a\tb\tc", "x\t"]))) == [("a", "b"), ("x", "")]


def test_other_separators_are_literal(lines_of):
    assert pairs(E.parse_edges(lines_of(["a|b.c"]), sep="|")) == [("a", "b.c")]


def test_short_line_fails_or_is_left_out(lines_of):
    lines = lines_of(["a\tb", "alone"])
    with pytest.raises(Exception, match="without a target"):
        E.parse_edges(lines).collect()
    assert pairs(E.parse_edges(lines, mode="permissive")) == [("a", "b")]
    with pytest.raises(ValueError):
        E.parse_edges(lines, mode="other")


def test_short_line_fails_without_ansi(spark, lines_of):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="without a target"):
            E.parse_edges(lines_of(["alone"])).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_comments_and_blank_lines(lines_of):
    lines = lines_of(["# head", "", "a\tb", "#x\ty"])
    assert pairs(E.parse_edges(lines, comment_prefix="#")) == [("a", "b")]


def test_namespace_filter_is_on_the_target_before_lowering(lines_of):
    lines = lines_of(
        ["A\tB", "A\tCategory:X", "A\tcategory:X", "A\tFile:X", "File:S\tB", "A\tXCategory:Y"]
    )
    assert pairs(E.content_edges(lines)) == [("a", "b"), ("a", "category:x"), ("file:s", "b")]


def test_lowering_makes_duplicates_that_count(lines_of):
    edges = E.content_edges(lines_of(["A\tB", "a\tb", "a\tB"]))
    assert pairs(edges) == [("a", "b")] * 3
    assert E.out_degree(edges).first()["n_links"] == 3
    assert E.count_sources(edges) == 1


@pytest.mark.parametrize("limit", [1000, 10, 1])
def test_adjacency_keeps_the_bag_and_bounds_the_lists(edges_of, limit):
    pairs_in = [("hub", f"n{i % 40}") for i in range(120)] + [("b", "x")] * 70 + [("c", "y")]
    rows = E.adjacency(edges_of(pairs_in), max_list=limit).collect()
    out = sorted((r["src"], d) for r in rows for d in r["dests"])
    assert out == sorted(pairs_in)
    assert max(len(r["dests"]) for r in rows) <= limit
    assert len({(r["src"], r["slice"]) for r in rows}) == len(rows)
    if limit == 10:
        assert len([r for r in rows if r["src"] == "b"]) > 2
    if limit == 1000:
        assert len(rows) == 3


def test_text_sources(spark, tmp_path):
    for name, body in {"b.txt": "3\tx\n4\tx\n", "a.txt": "1\tx\n2\tx\n", "c.txt": "5\tx\n"}.items():
        (tmp_path / name).write_text(body)
    path = f"{tmp_path}/*.txt"
    assert read_lines(spark, path).count() == 5
    assert pairs(read_edges(spark, path)) == [(str(i), "x") for i in range(1, 6)]
    for n in (0, 1, 3, 4, 9):
        got = [r["value"][0] for r in first_lines(spark, path, n).collect()]
        assert sorted(got) == [str(i) for i in range(1, min(n, 5) + 1)]


def test_filter_reaches_the_scan_without_python(lines_of):
    plan = E.content_edges(lines_of(["a\tb"]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
    assert F is not None


@pytest.mark.parametrize("limit", [7, 64, 1000])
def test_adjacency_over_many_tasks(spark, edges_of, limit, monkeypatch):
    """A hub that lies in several tasks, a link of many copies, batches cut anywhere."""
    monkeypatch.setattr(E, "_EXPANDED", 16)
    pairs_in = [("hub", f"n{i}") for i in range(300)] + [("b", "x")] * 90 + [(f"s{i % 40}", f"t{i % 3}") for i in range(200)]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = E.adjacency(edges_of(pairs_in), max_list=limit).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sorted((r["src"], d) for r in rows for d in r["dests"]) == sorted(pairs_in)
    assert len({(r["src"], r["slice"]) for r in rows}) == len(rows)
    assert max(len(r["dests"]) for r in rows) <= limit
    assert len([r for r in rows if r["src"] == "hub"]) > 1


def test_adjacency_of_nothing(edges_of):
    assert E.adjacency(edges_of([])).collect() == []


def test_first_lines_read_heads_only(spark, tmp_path, monkeypatch):
    """Small files together; of a large one as many splits as needed, and no later file."""
    monkeypatch.setattr(text_source, "HEAD_BYTES", 40)
    (tmp_path / "a.txt").write_text("a1\na2\n")
    (tmp_path / "b.txt").write_text("")
    (tmp_path / "c.txt").write_text("c1\n")
    (tmp_path / "d.txt").write_text("".join(f"d{i:07d}\n" for i in range(100_000)))
    (tmp_path / "e.txt.gz").write_bytes(b"no gzip here")
    path, context = str(tmp_path), spark.sparkContext
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        want = ["a1", "a2", "c1"] + [f"d{i:07d}" for i in range(100_000)]
        for n in (0, 2, 3, 40, 12_000):
            context.setJobGroup(f"head{n}", "first lines")
            assert [r["value"] for r in first_lines(spark, path, n).collect()] == want[:n]
            stages = [s for j in context.statusTracker().getJobIdsForGroup(f"head{n}") for s in context.statusTracker().getJobInfo(j).stageIds]
            tasks = sum(info.numTasks for s in stages if (info := context.statusTracker().getStageInfo(s)))
            assert tasks < 30  # the large file has 14 splits
        with pytest.raises(Exception, match="gzip"):
            first_lines(spark, path, 100_004)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        context.setLocalProperty("spark.jobGroup.id", None)
