"""Vector operators against plain Python: odd rows, ties, repeated ids, other lengths, empty tables."""

import brute
import numpy as np
import pytest
from linkmill.llm import dual_tree, lookup_centroids, vector_blocks

SCHEMA = "vec_id long, embedding array<double>, label int, cells string, code string, cluster string"


def table(spark, rows, parts=3):
    full = [(i, v, label, "cells", "code", "cluster") for i, v, label in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(parts)


def drawn(n, width=64, seed=1, step=1 / 512):
    """Vectors around a few centres, on a coarse grid so that distances tie."""
    draw = np.random.default_rng(seed)
    centres = draw.normal(0, 0.3, (6, width))
    points = centres[draw.integers(0, 6, n)] + draw.normal(0, 0.05, (n, width))
    return (np.round(points / step) * step).tolist()


def odd_rows(n=400):
    rows = [(i, v, [None, 1, 2][i % 3]) for i, v in enumerate(drawn(n))]
    nan, inf = float("nan"), float("inf")
    rows += [(1000, None, 1), (1001, [nan] + [0.0] * 63, 1), (1002, [0.5] * 63 + [-inf], 2), (1003, [None] * 64, 2)]
    rows += [(1004, [], 1), (1005, [0.25] * 32, 1), (1006, [0.25] * 65, None), (1007, [0.0] * 64, None)]
    rows += [(3, [0.125] * 64, 1), (3, [0.125] * 64, 1), (None, [0.25] * 64, None), (-5, [-0.001] * 64, 2)]
    rows += [(2000 + i, rows[7][1], 5) for i in range(40)]
    return rows


def told(df, columns):
    return sorted(map(repr, (tuple(r[c] for c in columns) for r in df.collect())))


CODES = ("vec_id", "code", "error", "label", "label_error", "codebooks_sha256")
CLUSTERS = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


@pytest.mark.parametrize("rows", [odd_rows(), odd_rows(30)[:25], odd_rows(0)], ids=["many", "few", "copies"])
def test_codes(spark, rows):
    got = told(dual_tree.compress(table(spark, rows)), CODES)
    assert got == sorted(map(repr, brute.codes(rows))) and got


@pytest.mark.parametrize("rows", [odd_rows(), odd_rows(30)[:5], odd_rows(0)], ids=["many", "few", "copies"])
def test_clusters(spark, rows):
    got = told(lookup_centroids.cluster(table(spark, rows)), CLUSTERS)
    assert got == sorted(map(repr, brute.clusters([r[:2] for r in rows]))) and got


def test_nothing_kept(spark):
    for rows in ([], [(1, None, 1), (2, [float("nan")] * 64, 1), (3, [1.0] * 3, 2)]):
        empty = table(spark, rows)
        assert dual_tree.compress(empty).collect() == []
        assert lookup_centroids.cluster(empty).collect() == []
    assert dual_tree.compress(table(spark, [])).columns == list(CODES[:2]) + ["error", "label", "label_error", "codebooks_sha256"]


def test_another_length(spark):
    """Parts of three components; the first vector's length is the table's."""
    rows = [(i, v, 1) for i, v in enumerate(drawn(90, 48))] + [(90 + i, v, 1) for i, v in enumerate(drawn(80))]
    assert told(dual_tree.compress(table(spark, rows)), CODES) == sorted(map(repr, brute.codes(rows)))
    rows = [(100 - i if i < 90 else 200 + i, v, label) for i, v, label in rows[::-1]]
    assert told(dual_tree.compress(table(spark, rows)), CODES) == sorted(map(repr, brute.codes(rows)))


def test_huge_components_count_as_the_largest(spark):
    rows = [(i, [(-1.0) ** i * 1e300] * 64, 1) for i in range(70)]
    limit = vector_blocks.LARGEST / 256
    want = brute.codes([(i, [(-1.0) ** i * limit] * 64, 1) for i in range(70)])
    assert told(dual_tree.compress(table(spark, rows)), CODES) == sorted(map(repr, want))


@pytest.mark.parametrize("n,spread", [(1, 5), (31, 3), (5000, 400), (5000, 12), (2500, 0)])
def test_trees_assign_like_all_pairs(n, spread):
    draw = np.random.default_rng(n + spread)
    points = draw.integers(-spread, spread + 1, (3, n, 4))
    books = draw.integers(-spread, spread + 1, (3, 64, 4))
    books[:, 40:] = books[:, :24]
    tree = dual_tree.tree_of(*dual_tree.arranged(points, dual_tree.LEAF))
    total, chosen = dual_tree.assign(tree, books, True)
    for p in range(3):
        far = ((points[p][:, None] - books[p][None]) ** 2).sum(axis=2)
        best = far.argmin(axis=1)
        true = tree.order[p] >= 0
        assert sorted(tree.order[p][true]) == list(range(n))
        assert (chosen[p][true] == best[tree.order[p][true]]).all()
        for e in range(64):
            row = total[p * 64 + e]
            assert row[0] == (best == e).sum() and (row[1:] == points[p][best == e].sum(axis=0)).all()


def test_whole_nodes_are_assigned(monkeypatch):
    """Groups far apart need no distance to a single part."""
    draw = np.random.default_rng(3)
    books = np.arange(64)[None, :, None] * np.full((1, 1, 4), 1000)
    points = books[:, np.repeat(np.arange(64), 64)] + draw.integers(0, 9, (1, 4096, 4))
    tree = dual_tree.tree_of(*dual_tree.arranged(points, dual_tree.LEAF))
    monkeypatch.setattr(dual_tree, "_chunks", lambda *_: pytest.fail("a leaf was measured"))
    total, _ = dual_tree.assign(tree, books, False)
    assert (total[:, 0] == 64).all()


def test_blocks_hold_every_row(spark):
    rows = table(spark, [(i, [float(i)] * 64, i) for i in range(100)], 2).select("vec_id", "label", vector_blocks.whole_numbers("embedding", 2).alias("v"))
    blocks = vector_blocks.pack(rows, 64, lambda v: {"sum": v[:, :1].sum(axis=0).tobytes()}, ["sum"], block=30).collect()
    assert sorted(i for b in blocks for i in b.vec_id) == list(range(100))
    assert max(len(b.vec_id) for b in blocks) == 30 and all(b.vec_id == b.label for b in blocks)
    assert all(np.frombuffer(b["sum"], np.int64)[0] == 2 * sum(b.vec_id) for b in blocks)
