import os
import random
import time
from collections import Counter, defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from linkmill.operators import rank as R
from linkmill.operators import rank_blocks as B
from linkmill.plans import pagerank as P
from linkmill.plans.lineage import shared_folder

CHAIN = [("a", "b"), ("b", "c"), ("c", "d"), ("d", "d2"), ("x", "y"), ("y", "x")]


def brute(pairs, rounds=10, keep=False, base=0.15, factor=0.85, r0=1.0, normalise=False):
    links = defaultdict(list)
    for src, dst in pairs:
        links[src].append(dst)
    if normalise:
        base, factor = 0.15 / len(links), 0.85
    ranks = dict.fromkeys(links, r0)
    for _ in range(rounds):
        sums = Counter()
        for src, dests in links.items():
            if src in ranks:
                for dst in dests:
                    sums[dst] += ranks[src] / len(dests)
                if keep:
                    sums[src] += 0.0
        ranks = {n: base + factor * v for n, v in sums.items()}
    return ranks


def ranks_of(df):
    return {r["node"]: r["rank"] for r in df.collect()}


def close(got, want):
    assert got.keys() == want.keys()
    for node in want:
        assert got[node] == pytest.approx(want[node], rel=1e-12, abs=1e-14)


@pytest.mark.parametrize("rounds", [0, 1, 2, 5, 6])
def test_sources_drop_out_along_a_chain(edges_of, rounds):
    close(ranks_of(P.pagerank(edges_of(CHAIN), rounds)), brute(CHAIN, rounds))


def test_drop_out_node_sets(edges_of):
    assert set(ranks_of(P.pagerank(edges_of(CHAIN), 1))) == {"b", "c", "d", "d2", "x", "y"}
    assert set(ranks_of(P.pagerank(edges_of(CHAIN), 5))) == {"x", "y"}


def test_keep_holds_the_node_set(edges_of):
    for rounds in (1, 4):
        got = ranks_of(P.pagerank(edges_of(CHAIN), rounds, sources="keep"))
        close(got, brute(CHAIN, rounds, keep=True))
        assert set(got) == {"a", "b", "c", "d", "d2", "x", "y"}
        assert min(got.values()) >= 0.15


def test_repeated_links_and_self_links(edges_of):
    pairs = [("a", "b"), ("a", "b"), ("a", "a"), ("b", "a"), ("b", "b")]
    for keep in (False, True):
        got = ranks_of(P.pagerank(edges_of(pairs), 3, sources="keep" if keep else "drop"))
        close(got, brute(pairs, 3, keep))


def random_graph(seed, hub=False):
    rnd = random.Random(seed)
    pairs = [(f"n{rnd.randrange(40)}", f"n{rnd.randrange(60)}") for _ in range(300)]
    if hub:
        pairs += [("hub", f"n{i}") for i in range(60)] * 2 + [("n1", "hub")] * 200
    return pairs


@pytest.mark.parametrize(
    "options",
    [
        {},
        {"sources": "keep"},
        {"normalise": True},
        {"cache_links": False},
        {"num_partitions": 11},
        {"checkpoint_every": 2},
        {"base": 0.2, "factor": 0.5, "r0": 2.0},
        {"min_slice_rows": 3},
        {"min_slice_rows": 3, "sources": "keep", "num_partitions": 5},
        {"min_slice_rows": 3, "cache_links": False},
    ],
)
def test_options_against_brute_force(edges_of, options):
    pairs = random_graph(7, hub=True)
    want = brute(
        pairs,
        6,
        options.get("sources") == "keep",
        options.get("base", 0.15),
        options.get("factor", 0.85),
        options.get("r0", 1.0),
        options.get("normalise", False),
    )
    close(ranks_of(P.pagerank(edges_of(pairs), 6, **options)), want)


def test_heavy_sources_are_really_sliced(edges_of):
    links = R.link_table(edges_of(random_graph(7, hub=True)), min_slice_rows=3, num_partitions=4)
    assert links.heavy is not None and links.keys == ["src", "slice"]
    slices = {r["slice"] for r in links.rows.where("src = 'hub'").collect()}
    assert len(slices) > 1
    links.release()


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.tuples(st.sampled_from("abcdef"), st.sampled_from("abcdefgh")), min_size=1, max_size=25),
    st.booleans(),
)
def test_any_small_graph(edges_of, pairs, keep):
    got = ranks_of(P.pagerank(edges_of(pairs), 3, sources="keep" if keep else "drop"))
    close(got, brute(pairs, 3, keep))


def test_one_shuffle_per_round(spark, edges_of):
    links = R.link_table(edges_of(random_graph(1)))
    ranks = R.damp(R.sum_contributions(R.contributions(R.join_ranks(links, R.init_ranks(links.rows)))))
    again = R.damp(R.sum_contributions(R.contributions(R.join_ranks(links, ranks))))
    plan = again._jdf.queryExecution().executedPlan().toString()
    top = plan.split("InMemoryRelation")[0]
    # above the cached links: no exchange on the link side, none on the ranks but their own aggregate
    assert top.count("Exchange hashpartitioning") == 1
    assert "BatchEvalPython" not in plan and "MapInArrow" not in plan
    links.release()


@pytest.mark.parametrize("own,session", [(4, 8), (8, 3), (12, 8)])
def test_links_stay_where_they_are_placed(spark, edges_of, own, session):
    spark.conf.set("spark.sql.shuffle.partitions", session)
    try:
        links = R.link_table(edges_of(random_graph(2)), num_partitions=own)
        joined = R.join_ranks(links, R.init_ranks(links.rows))
        plan = joined._jdf.queryExecution().executedPlan().toString()
        link_side = plan.split("SortMergeJoin")[1].split("InMemoryRelation")[0]
        assert "Exchange" not in link_side
        links.release()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)


def test_unknown_mode(edges_of):
    with pytest.raises(ValueError):
        P.pagerank(edges_of(CHAIN), sources="other")


def test_wiki_and_sample(spark, tmp_path, lines_of):
    lines = ["A\tB", "b\tA", "B\tFile:x", "a\tCategory:C"] * 3
    pairs = [("a", "b"), ("b", "a"), ("a", "category:c")] * 3
    close(ranks_of(P.wiki_pagerank(lines_of(lines), iterations=4)), brute(pairs, 4))
    (tmp_path / "in.txt").write_text("\n".join(lines) + "\nq\tz\n")
    got = ranks_of(P.sample_pagerank(spark, str(tmp_path), 12, iterations=4))
    close(got, brute(pairs, 4, normalise=True))


def test_raw_skips_comments_and_folds_nothing(lines_of):
    got = ranks_of(P.raw_pagerank(lines_of(["# x", "A\tFile:b", "File:b\tA", "a\tA"]), iterations=2))
    close(got, brute([("A", "File:b"), ("File:b", "A"), ("a", "A")], 2))


def test_partition_report(edges_of):
    edges = edges_of(random_graph(3))
    links = R.link_table(edges, num_partitions=500)
    rows = P.partition_report(edges.repartition(3), 3, links).collect()
    assert [(r["stage"], r["n_rows"]) for r in rows] == [("before", 300), ("after", edges.distinct().count())]
    assert [r["partitions"] for r in rows] == [3, 500] and 1 < rows[1]["used"] < 500
    links.release()


@pytest.mark.parametrize("own", [12, 5])
def test_one_exchange_a_round_for_any_partitions(spark, edges_of, own):
    links = R.link_table(edges_of(random_graph(2)), num_partitions=own)
    ranks = P.checkpoint(R.init_ranks(links.rows))
    once = R.damp(R.sum_contributions(R.contributions(R.join_ranks(links, ranks))))
    twice = R.damp(R.sum_contributions(R.contributions(R.join_ranks(links, once))))
    plans = [d._jdf.queryExecution().executedPlan().toString() for d in (once, twice, links.rows)]
    first, second, cached = (plan.count("Exchange hashpartitioning") for plan in plans)
    assert second - first - cached == 1  # each round also prints the plan behind the cached links
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
    assert links.rows.sparkSession.conf.get("spark.sql.shuffle.partitions") == str(own)
    links.release()


@pytest.mark.parametrize("sliced", [{}, {"min_slice_rows": 3}])
def test_stored_links_are_scanned_as_they_lie(spark, edges_of, sliced):
    """Without a cache: no exchange and no sort on the link side of a round."""
    links = R.link_table(edges_of(random_graph(7, hub=True)), cache_links=False, **sliced)
    ranks = P.checkpoint(R.init_ranks(links.rows))
    joined = R.join_ranks(links, ranks)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    link_side = plan.split("SortMergeJoin")[1].split("Bucketed: true")[0]
    assert "Bucketed: true" in plan and "Exchange" not in link_side and "Sort [" not in link_side
    assert "InMemoryTableScan" not in plan
    name = links.stored
    assert spark.catalog.tableExists(name)
    links.release()
    assert not spark.catalog.tableExists(name)


def test_declared_partitions_are_folded(edges_of):
    assert [R.folded(n, 8) for n in (4, 8, 16, 120, 121, 113, 1000)] == [4, 8, 16, 8, 121, 113, 8]
    edges = edges_of(random_graph(3))
    links = R.link_table(edges, num_partitions=96)
    assert links.partitions < 96 == links.declared and links.rows.rdd.getNumPartitions() == links.partitions
    tasks = links.rows.selectExpr("spark_partition_id() AS task", "pmod(hash(src), 96) AS c").distinct().collect()
    assert all(r["task"] == r["c"] % links.partitions for r in tasks)
    links.release()


def test_links_move_once(spark, edges_of):
    """Counting, degrees and weights all happen where the links are placed, also with a self link per source."""
    for sources in ("drop", "keep"):
        links = R.link_table(edges_of(random_graph(2)), sources)
        plan = links.rows._jdf.queryExecution().executedPlan().toString()
        behind = plan.split("InMemoryRelation")[1].split("Initial Plan")[0]
        assert behind.count("Exchange hashpartitioning") == 1
        links.release()


def test_rounds_send_one_number_a_class_and_target(spark, edges_of):
    pairs = random_graph(5) + [(f"unfed{i}", f"n{i}") for i in range(30)]
    links = R.link_table(edges_of(pairs))
    first = R.damp(R.sum_contributions(R.contributions(links.rows.withColumn("rank", F.lit(1.0)))))
    first = first.withColumn("fed", F.lit(True))
    built = P.checkpoint(B.build_blocks(B.cut_blocks(links.rows, first, links.partitions, 0.15, False), 0.15, 0.85, False))
    sums = B.block_step(B.of_kind(built, "block"), B.of_kind(built, "ranks"), "sums", 0.15, 0.85, False)
    sent = sums.agg(F.sum(F.octet_length("data"))).first()[0]
    home = F.pmod(F.hash("src"), F.lit(links.partitions))
    fed = edges_of(pairs).where("src NOT LIKE 'unfed%'").join(edges_of(pairs).selectExpr("dst AS src").distinct(), "src")
    assert sent == 8 * fed.select(home, "dst").distinct().count()
    links.release()


@pytest.mark.parametrize("options", [{}, {"sources": "keep"}, {"cache_links": False, "checkpoint_every": 3}])
def test_nulls_repeats_and_sources_without_links_to_them(edges_of, options):
    pairs = random_graph(9) + [("n1", None)] * 3 + [(f"unfed{i}", f"n{i % 7}") for i in range(20)] + [("unfed1", "sink")]
    got = ranks_of(P.pagerank(edges_of(pairs + [(None, "n2")]), 5, **options))
    close(got, brute(pairs, 5, options.get("sources") == "keep"))


def test_a_repeated_heavy_link_is_counted_before_it_moves(edges_of):
    pairs = random_graph(7, hub=True) + [("loud", "n3")] * 500
    links = R.link_table(edges_of(pairs), min_slice_rows=100)
    assert links.heavy is None and links.rows.where("src = 'loud'").collect()[0]["weight"] == 1.0
    links.release()
    close(ranks_of(P.pagerank(edges_of(pairs), 4, min_slice_rows=100)), brute(pairs, 4))


def test_placed_links_are_sorted_once_and_counted_without_a_hash_table(edges_of):
    """A class then needs little memory, so classes can be large and rounds send less."""
    for own in ({}, {"sources": "keep", "self_links": False}):
        links = R.link_table(edges_of(random_graph(2)), **own)
        behind = links.rows._jdf.queryExecution().executedPlan().toString().split("InMemoryRelation")[1]
        behind = behind.split("Initial Plan")[0]
        assert behind.count("Sort [") == 1 and "Aggregate" not in behind
        assert links.rows.where("weight = 0").isEmpty()
        links.release()


@pytest.mark.parametrize("links,partitions", [(7_300_000, 12), (73_200_000, 19), (440_000_000, 110)])
def test_classes_hold_millions_of_links(spark, monkeypatch, links, partitions):
    monkeypatch.setattr(type(spark.sparkContext), "defaultParallelism", 12)
    assert R._fitting_partitions(spark, links) == partitions


def test_names_are_numbered_in_stretches(spark, monkeypatch, edges_of):
    import pyarrow as pa

    monkeypatch.setattr(B, "_GATHERED", 2)
    names = [("a", "b"), ("b", None), ("c", "a"), ("a", "c"), ("é", None)]
    kinds = pa.schema([("src", pa.string()), ("dst", pa.string())])
    rows = [pa.RecordBatch.from_pylist([{"src": s, "dst": d}], kinds) for s, d in names]
    whole = B._thin(iter(rows))
    (src, source), (dst, target) = (B._names_and_numbers(whole.column(c)) for c in ("src", "dst"))
    assert [(src[s].as_py(), dst[t].as_py()) for s, t in zip(source.tolist(), target.tolist(), strict=True)] == names
    assert len(src) == 4 and len(dst) == 4
    assert B._thin(iter([])) is None


@pytest.mark.parametrize("scattered", [False, True])
def test_the_first_round_goes_with_the_names(spark, edges_of, scattered):
    """No aggregate of names before it: the links are placed, then names and first sums move in one exchange."""
    pairs = random_graph(4)
    links = R.link_table(edges_of(pairs))
    built = B.build_blocks(B.cut_blocks(links.rows, None, links.partitions, 1.0, scattered), 0.15, 0.85, False)
    plan = built._jdf.queryExecution().executedPlan().toString()
    assert plan.split("InMemoryRelation")[0].count("Exchange") == 1 + scattered and "Aggregate" not in plan
    built = P.checkpoint(built)
    close(ranks_of(B.named_ranks(B.of_kind(built, "names"), B.of_kind(built, "ranks"))), brute(pairs, 1))
    links.release()


@pytest.mark.parametrize("options", [{"sources": "keep"}, {"cache_links": False}, {"normalise": True}])
def test_a_ranking_leaves_neither_its_links_nor_what_rounds_sent(spark, edges_of, options):
    def shuffled():
        places = list(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())
        names = [f for place in places for _, _, files in os.walk(place) for f in files if f.startswith("shuffle_")]
        return {n.split("_")[1] for n in names}

    def links_kept():
        folder = shared_folder(spark).removeprefix("file:")
        return {d for d in os.listdir(f"{folder}/linkmill") if d.startswith(("links-", "counted-"))}

    P.pagerank(edges_of(CHAIN), 3)  # makes the folder
    before, kept = shuffled(), links_kept()
    P.pagerank(edges_of(random_graph(3)), 8, **options)
    until = time.time() + 20
    while len(shuffled() - before) > 3 and time.time() < until:  # they are deleted beside the job
        time.sleep(0.5)
    # what is left was sent to see whether sources are heavy, and to place the links and blocks that executors hold
    assert len(shuffled() - before) <= 3 and links_kept() <= kept


def test_names_and_numbers_are_read_as_they_were_written():
    import numpy as np
    import pyarrow as pa

    long = [f"part_{n}" for n in range(1000)]
    for names in ([], [""], [None], ["", None], ["a", "é" * 300, "z"], ["", "b", "b\0"], [*long, None]):
        cut = pa.concat_arrays([pa.array(["before"]), pa.array(names, pa.string())])[1:]
        assert B._read(*B._spelt(cut)).to_pylist() == names
    assert len(B._packed(B._spelt(pa.array(sorted(long))))) < len(B._packed(pa.array(sorted(long)))) / 2
    for values in (np.zeros(0), np.array([0.5, np.nan, -0.0]), np.arange(300) % 7 / 3, np.arange(9, dtype=np.int32)):
        assert B._untabled(*B._tabled(values)).tolist() == pytest.approx(values.tolist(), nan_ok=True)
        assert B._flat(*B._planes(values)).tobytes() == values.tobytes()
    source, entry, weight = np.array([2, 0, 2]), np.array([5, 3, 1]), np.array([0.5, 1.0, 0.5])
    links = sorted(zip(*(part.tolist() for part in B._decoded(*B._coded(source, entry, weight))), strict=True))
    assert links == [(0, 3, 1.0), (2, 1, 0.5), (2, 5, 0.5)]
