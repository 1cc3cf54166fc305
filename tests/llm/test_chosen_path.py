"""The chosen-path join against counting all pairs: odd rows, thresholds, families, blocks, empty tables."""

import brute
import numpy as np
import pytest
from linkmill.llm import chosen_path, set_links


def groups(frame):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in chosen_path.similar_groups(frame).collect()}


def test_odd_texts(docs, texts):
    rows = chosen_path.similar_groups(docs).collect()
    want = brute.similar_groups(texts, 85)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_rows_without_an_id_and_rows_that_repeat_one(spark, texts, none):
    """Every row by its own text: id 7 stands for two texts, a null id has none."""
    text = dict(texts)
    rows = [(7, text[7]), (7, text[7]), (7, "quite another text of some more words"), (None, text[7]), (9, text[7] + " z"), (None, "alone here")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0, r.kept) for r in chosen_path.similar_groups(frame).collect())
    assert got == [(0, 1, 0, True), (0, 56, 7, False), (7, 3, 7, True), (7, 56, 7, True), (7, 56, 7, True), (9, 57, 7, False)]
    assert chosen_path.similar_groups(none).collect() == []
    assert chosen_path.similar_groups(none).columns == ["doc_id", "n_shingles", "component_id", "kept"]


def edited(base, times, seed):
    """``times`` copies of ``base`` with ever more words replaced."""
    draw = np.random.default_rng(seed)
    out = []
    for k in range(times):
        words = list(base)
        for at in draw.choice(len(words), min(1 + k % 6, len(words)), replace=False):
            words[at] = f"e{seed}x{k}x{at}"
        out.append(" ".join(words))
    return out


def corpus():
    """Texts around the threshold, chains, families of edited copies, and many texts around one passage."""
    rows = []
    for size in (6, 10, 12, 20, 40, 90, 150):
        words = [f"s{size}x{i}" for i in range(size)]
        for cut in range(0, size // 4 + 2):
            rows.append(" ".join(words[: size - cut] + [f"e{len(rows)}y{i}" for i in range(cut)]))
            rows.append(" ".join(words[: size - cut]))
    for family in range(4):
        rows += edited([f"f{family}w{i}" for i in range(120)], 45, family)
    passage = " ".join(f"p{i}" for i in range(40))
    rows += [f"{passage} " + " ".join(f"u{k}v{i}" for i in range(5 + k % 30)) for k in range(90)]
    return list(enumerate(rows))


def test_families_and_thresholds(spark):
    rows = corpus()
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert groups(frame) == brute.similar_groups(rows, 85)


@pytest.mark.parametrize("dense", [0.0, 2.0])
def test_every_way_of_comparing(spark, monkeypatch, dense):
    """With the smallest nodes and blocks: all nodes in blocks, all branch to the last level."""
    monkeypatch.setattr(chosen_path, "DENSE", dense)
    seen = []
    blocks = set_links.links_in_blocks
    monkeypatch.setattr(chosen_path, "links_in_blocks", lambda *x: seen.append(1) or blocks(*x))
    monkeypatch.setattr(chosen_path, "SMALL", 2)
    monkeypatch.setattr(set_links, "BLOCK", 8)
    rows = corpus()
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert groups(frame) == brute.similar_groups(rows, 85)
    assert seen


def test_ids_above_2_to_53(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(2**53 + 1 + k, f"{passage} u{k}") for k in range(30)] + [(2**62 + 2 * k + 1, f"o{k} " * 3) for k in range(5)]
    assert groups(spark.createDataFrame(rows, "doc_id long, text string")) == brute.similar_groups(rows, 85)


def test_enough_trees():
    count = chosen_path.trees()
    assert chosen_path.missed(count) <= chosen_path.MISSED < chosen_path.missed(count - 1)
    assert chosen_path.survival(1.0, 1) == pytest.approx(1 - np.exp(-1))


def test_pairs_at_the_threshold_meet_as_often_as_promised():
    """2,000 pairs with J = 0.85: the share of trees in which they still meet at level START."""
    draw = np.random.default_rng(4)
    tokens = draw.integers(0, 2**32, (2000, chosen_path.TOKENS), dtype=np.uint32)
    other = np.where(draw.random(tokens.shape) < 0.85, tokens, draw.integers(0, 2**32, tokens.shape, dtype=np.uint32))
    met = 0
    for tree in range(5):
        sides = []
        for side in (tokens, other):
            row, node = np.arange(len(side)), np.full(len(side), chosen_path.mix(np.array([tree + 100], np.uint64))[0])
            for _ in range(chosen_path.START):
                at, node = chosen_path.children(node, side[row])
                row = row[at]
            sides.append({(r, n) for r, n in zip(row.tolist(), node.tolist(), strict=True)})
        met += len({r for r, _ in sides[0] & sides[1]})
    assert met / 10_000 > chosen_path.survival(chosen_path.BOOST, chosen_path.START) - 0.1


def test_minwise_agreement_estimates_similarity():
    draw = np.random.default_rng(8)
    pool = draw.integers(0, 2**63, 2000, dtype=np.uint64)
    a, b = np.sort(pool[:1500]), np.sort(pool[300:1800])
    both = chosen_path.minwise(np.concatenate([a, b]), np.array([1500, 1500]))
    assert abs((both[0] == both[1]).mean() - 1200 / 1800) < 0.2
    assert chosen_path.minwise(a[:0], np.zeros(0, np.int64)).shape == (0, chosen_path.TOKENS)


def test_forest_joins_what_links_join():
    draw = np.random.default_rng(2)
    a, b = np.arange(0, 80, 2), np.arange(1, 81, 2)
    linked = draw.random((40, 40)) < 0.03
    x, y = set_links.forest(linked, a, b)

    def roots(pairs):
        label = {i: i for i in range(81)}
        for _ in range(81):
            for p, q in pairs:
                label[p] = label[q] = min(label[p], label[q])
        return label

    pairs = [(int(a[i]), int(b[j])) for i, j in zip(*np.nonzero(linked), strict=True)]
    assert roots(list(zip(x.tolist(), y.tolist(), strict=True))) == roots(pairs)
    assert len(x) <= 79


def test_a_text_is_named_by_both_its_hashes(spark):
    frame = spark.createDataFrame([("one",), ("two",), (None,)], "text string")
    assert len({(r.t1, r.t2) for r in frame.select(*set_links.text_key()).collect()}) == 3
