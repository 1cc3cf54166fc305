"""Document operators against plain Python, over odd rows, repeated rows and empty tables."""

import hashlib

import brute
import numpy as np
import pytest
from linkmill.llm import decontam, exact_dedup, fair_mix, lang_id, part_enum, pii, set_links
from pyspark.sql import functions as F

ITEMS = [
    (1, " ".join(f"near{i}" for i in range(5, 25))),
    (2, "one TWO three"),
    (3, None),
    (4, "..."),
    (5, "é"),
    (6, " ".join(f"near{i}" for i in range(10))),
    (None, "odd space and more of it all here and on it goes"),
    (12, "word1 w1 word2 w2 word3 w3 word4 w4 word5 w5 x"),
]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


def with_repeats(docs):
    """The rows, some once more, and one row without an id."""
    again = docs.where("doc_id in (4, 7, 12)")
    nobody = docs.where("doc_id = 7").withColumn("doc_id", F.lit(None).cast("long"))
    return docs.union(again).union(nobody)


def test_exact_groups(docs, texts):
    want = brute.exact_groups(texts)
    rows = exact_dedup.exact_groups(docs).collect()
    assert {r.doc_id: (r.keep_id, r.group_size, r.text_sha256) for r in rows} == want
    assert all(r.kept == (r.keep_id == r.doc_id) for r in rows)


def test_exact_groups_repeats(docs, none):
    rows = exact_dedup.exact_groups(with_repeats(docs)).collect()
    assert len(rows) == 23
    assert {(r.keep_id, r.group_size, r.kept) for r in rows if r.doc_id is None} == {(11, 4, False)}
    assert {r.group_size for r in rows if r.doc_id == 12} == {2}
    assert exact_dedup.exact_groups(none).count() == 0


def test_exact_groups_keep_one_row(spark):
    """Rows with one id are rows of their own: the longest stays, of equal ones one."""
    rows = [(5, "a b"), (5, "a  b"), (6, "ab"), (7, "c"), (7, "c"), (None, "c"), (None, "d"), (None, "d")]
    got = exact_dedup.exact_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted((r.keep_id or 0, r.group_size, r.kept) for r in got) == sorted(
        [(5, 3, True), (5, 3, False), (5, 3, False), (7, 3, True), (7, 3, False), (7, 3, False), (0, 2, True), (0, 2, False)]
    )


def test_rounds_of_runs():
    assert [exact_dedup.first_runs(n) for n in (1, 16, 17, 256, 257)] == [16, 16, 256, 256, 4096]


def test_similar_groups(docs, texts):
    rows = part_enum.similar_groups(docs).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute.similar_groups(texts)


def test_similar_groups_repeats(docs, texts, none):
    rows = part_enum.similar_groups(with_repeats(docs)).collect()
    assert len(rows) == 23
    want = brute.similar_groups(texts)
    assert all((r.n_shingles, r.component_id) == want[r.doc_id] for r in rows if r.doc_id)
    assert [(r.n_shingles, r.component_id) for r in rows if r.doc_id is None] == [(56, 7)]
    assert part_enum.similar_groups(none).count() == 0


def test_similar_groups_of_rows_that_repeat_an_id(spark):
    """Each by its own text: id 7 stands for three, one of them like 9's; null ids link as well."""
    one, two = (" ".join(f"{name}{i}" for i in range(40)) for name in ("one", "two"))
    rows = [(7, one), (7, two), (7, "third text of its own here"), (9, two + " x"), (None, one + " y"), (None, "nobody's own text")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    want = [(0, 1, 0), (0, 37, 7), (7, 2, 7), (7, 36, 7), (7, 36, 7), (9, 37, 7)]
    for layout in (frame.coalesce(1), frame.repartition(6)):
        got = part_enum.similar_groups(layout).collect()
        assert sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in got) == want


@pytest.mark.parametrize("many", [1, 10_000])
def test_both_ways_of_comparing_wide_signatures(spark, monkeypatch, many):
    """In blocks and pair by pair: the same links."""
    monkeypatch.setattr(part_enum, "MANY", many)
    monkeypatch.setattr(set_links, "BLOCK", 7)
    passage = [f"p{i}" for i in range(60)]
    rows = [" ".join(passage[: 60 - k % 25] + [f"u{k}v{i}" for i in range(k % 25)]) for k in range(70)]
    rows = list(enumerate(rows))
    got = part_enum.similar_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.similar_groups(rows)


def test_similar_groups_at_the_threshold(spark):
    """Sets with similarities around 3/4, chains, and many texts around one passage."""
    rows = []
    for size in (6, 10, 20, 40, 90, 150):
        words = [f"s{size}x{i}" for i in range(size)]
        for cut in range(0, size // 3 + 2):
            rows.append((len(rows), " ".join(words[: size - cut] + [f"e{len(rows)}y{i}" for i in range(cut)])))
    passage = " ".join(f"p{i}" for i in range(25))
    rows += [(1000 + k, f"{passage} " + " ".join(f"u{k}v{i}" for i in range(k % 9))) for k in range(80)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in part_enum.similar_groups(frame).collect()}
    assert got == brute.similar_groups(rows)


def test_similar_groups_of_ids_above_2_to_53(spark):
    """Neighbouring 64-bit ids, a signature of more than COMMON texts of a task, and a null id."""
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(2**53 + 1 + k, f"{passage} u{k}") for k in range(part_enum.COMMON + 24)]
    rows += [(2**62 + 2 * k + 1, " ".join(f"o{k}x{i}" for i in range(20))) for k in range(20)]
    frame = spark.createDataFrame(rows + [(None, passage)], "doc_id long, text string").coalesce(1)
    got = part_enum.similar_groups(frame).collect()
    assert len(got) == len(rows) + 1
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id} == brute.similar_groups(rows)
    assert [(r.n_shingles, r.component_id) for r in got if r.doc_id is None] == [(36, 2**53 + 1)]


def test_contamination(docs, texts, items):
    want = brute.contamination(texts, [("" if i is None else i, t) for i, t in ITEMS])
    rows = decontam.contamination(docs, items).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256) for r in rows} == want
    assert all(r.contaminated == (r.n_hit > 0) for r in rows)
    assert sum(r.contaminated for r in rows) >= 8


def test_contamination_repeats(docs, items, none):
    rows = decontam.contamination(with_repeats(docs), items).collect()
    assert len(rows) == 23
    seven = {(r.n_words, r.n_hit, r.items) for r in rows if r.doc_id == 7}
    assert len(seven) == 1 and {(r.n_words, r.n_hit, r.items) for r in rows if r.doc_id is None} == seven
    assert decontam.contamination(none, items).count() == 0
    clean = decontam.contamination(docs, items.limit(0)).collect()
    assert {(r.n_hit, r.items_sha256) for r in clean} == {(0, hashlib.sha256(b"").hexdigest())}


def test_contamination_of_rows_that_repeat_an_id(spark, items):
    """Each of them is judged by its own text, in any order."""
    texts = [f"clean {k} words" for k in range(6)] + [ITEMS[0][1], ITEMS[0][1] + " tail", "see one two three"]
    want = sorted(brute.contamination(list(enumerate(texts)), [("" if i is None else i, t) for i, t in ITEMS]).values())
    docs = spark.createDataFrame([(7, t) for t in texts], "doc_id long, text string")
    for frame in (docs, docs.repartition(5, "text")):
        rows = decontam.contamination(frame, items).collect()
        assert sorted((r.n_words, r.n_hit, r.n_items, r.items_sha256) for r in rows) == want


def test_every_shift_of_a_passage_is_found(spark):
    item = " ".join(f"i{k}" for k in range(14))
    rows = [
        (shift * 10 + first, " ".join([f"f{k}" for k in range(shift)] + item.split()[first : first + 10] + ["end"]))
        for shift in range(7)
        for first in range(5)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert {r.n_hit for r in decontam.contamination(docs, items).collect()} == {10}


def test_base_spans(docs, texts):
    rows = {r.doc_id: r for r in pii.told_spans(pii.find_personal_data(docs)).collect()}
    for doc, text in texts:
        want = brute.base_spans(text)
        assert rows[doc].base_sha256 == hashlib.sha256(brute.told(want).encode()).hexdigest(), text
        counts = tuple(sum(k == kind for k, _, _ in want) for kind in pii.KINDS)
        assert (rows[doc].n_email, rows[doc].n_ip, rows[doc].n_card, rows[doc].n_phone) == counts


def test_many_spans_in_one_text(spark):
    """20,000 addresses in a text, in seconds."""
    text = " ".join(f"é{i} u{i}@host{i % 7}.org 10.0.{i % 256}.{i % 200}" for i in range(10_000))
    frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = pii.told_spans(pii.find_personal_data(frame)).first()
    assert (row.n_email, row.n_ip) == (10_000, 10_000)
    assert row.base_sha256 == hashlib.sha256(brute.told(brute.base_spans(text)).encode()).hexdigest()


def test_weak_labels_add_spans(spark, none):
    told = [(k, f"please call (555) 2{k}-456{k % 10} or write to jo{k} at mail dot org") for k in range(10, 30)]
    plain = [(k, f"order 20240101{k} of 1999 0101 12{k}") for k in range(30, 50)]
    frame = spark.createDataFrame(told + plain, "doc_id long, text string")
    rows = pii.told_spans(pii.find_personal_data(frame)).collect()
    assert all(("phone:12:26" in r.spans and "email" in r.spans) == (r.doc_id < 30) for r in rows)
    assert all(r.spans == "" for r in rows if r.doc_id >= 30)
    assert pii.find_personal_data(none).count() == 0


def test_em_on_few_patterns():
    assert pii.learn([]).prior == 0.5
    none = (0,) * len(pii.FEATURES)
    model = pii.learn([((1, 1, 1, 1), none, 50), ((-1, -1, -1, -1), none, 50)])
    assert model.posterior((1, 1, 1, 1)) > 0.9 > 0.1 > model.posterior((-1, -1, -1, -1))


def test_classifier_overrules_the_majority_of_votes():
    """Features that hardly ever stand for a true span outweigh two labelers, and speak where all are silent."""
    yes, no = (2, 1, 0, 3), (4, 0, 2, 8)
    counts = [((1, 1, 1, 1), yes, 900), ((1, 1, 0, 1), yes, 300), ((-1, -1, -1, -1), no, 900), ((-1, -1, 0, -1), no, 300)]
    counts += [((1, 1, -1, 0), no, 4), ((0, 0, 0, 0), yes, 5), ((0, 0, 0, 0), no, 5)]
    model = pii.learn(counts)
    assert model.score((1, 1, 1, 1), yes) > 0 > model.score((-1, -1, -1, -1), no)
    assert model.score((1, 1, -1, 0), no) < 0 < model.score((1, 1, -1, 0), yes)
    assert model.score((0, 0, 0, 0), yes) > 0 > model.score((0, 0, 0, 0), no)


def test_votes_and_features_agree_with_the_model(spark):
    """The column expression and the plain one give the same verdicts."""
    draw = np.random.default_rng(3)
    sizes = list(pii.FEATURES.values())
    rows = [([int(v) for v in draw.integers(-1, 2, 4)], [int(draw.integers(0, k)) for k in sizes]) for _ in range(200)]
    model = pii.learn([(tuple(v), tuple(f), 1 + i % 5) for i, (v, f) in enumerate(rows)])
    frame = spark.createDataFrame(rows, "votes array<int>, features array<int>")
    got = [r.ok for r in frame.select(pii.accepts(model, F.col("votes"), F.col("features")).alias("ok")).collect()]
    assert got == [model.score(v, f) > 0 for v, f in rows]


def test_language(spark, docs, none):
    english = "the cat sat on the mat and the dog was there with them"
    german = "der hund und die katze sind nicht hier aber das ist gut"
    rows = [(i, f"{[english, german][i % 2]} {i}", ["en", "de"][i % 2]) for i in range(60)]
    model = lang_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == ("de", "en")
    found = {r.doc_id: r for r in lang_id.identify(docs, model, keep=["doc_id"]).collect()}
    assert {d for d, r in found.items() if r.lang_pred == "und"} == {1, 2, 3, 14}
    assert all(0 <= r.score <= 1 for r in found.values())
    same = lang_id.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string"), model)
    assert all(r.lang_pred == r.lang for r in same.collect())
    odd = spark.createDataFrame([("a", "b", 1, True, english)], "lang_pred string, score string, _text int, _letters boolean, text string")
    told = lang_id.identify(odd, model, names=("found", "share")).first()
    assert (told.lang_pred, told.score, told._text, told._letters, told.found) == ("a", "b", 1, True, "en")
    assert lang_id.identify(odd, model).columns == ["_text", "_letters", "text", "lang_pred", "score"]
    assert lang_id.train(none).languages == ()
    assert {r.lang_pred for r in lang_id.identify(docs, lang_id.train(none)).collect()} == {"und"}


def test_kernel_against_the_exact_one():
    """Nystroem features of all texts give the scores of ridge regression on the exact kernel."""
    draw = np.random.default_rng(5)
    words = {"x": ["ab", "abc", "bca"], "y": ["de", "edf", "fee"], "z": ["gh", "hig", "igh"]}
    sample = [(" ".join(draw.choice(words[lang], 6)) + f" {i}", lang) for i in range(17) for lang in "xyz"]
    model = lang_id.fit(sample)
    grams = [{(n, t[i : i + n]) for n in range(1, lang_id.GRAMS + 1) for i in range(len(t) - n + 1)} for t in
             ("".join(c.lower() if c.isalpha() else " " for c in text) for text, _ in sample)]
    size = len(sample)
    kernel = np.array([[len(a & b) / np.sqrt(len(a) * len(b)) for b in grams] for a in grams])
    centre = np.eye(size) - 1 / size
    inner = centre @ kernel @ centre
    goal = np.array([[float(lang == name) for name in "xyz"] for _, lang in sample])
    exact = goal.mean(axis=0) + inner @ np.linalg.solve(inner + lang_id.RIDGE * size * np.eye(size), goal - goal.mean(axis=0))
    assert np.abs(model.scores([text.encode() for text, _ in sample]) - exact).max() < 0.05


def test_tasks_need_no_package_on_their_path(spark, docs):
    """What the model broadcasts is plain: it can be unpickled without this package."""
    import pickle
    import pickletools

    model = lang_id.fit([("the cat", "en"), ("der hund", "de")])
    seen = []
    real = type(spark.sparkContext).broadcast
    try:
        type(spark.sparkContext).broadcast = lambda self, value: seen.append(value) or real(self, value)
        lang_id.identify(docs, model)
    finally:
        type(spark.sparkContext).broadcast = real
    names = {arg for _, arg, _ in pickletools.genops(pickle.dumps(seen[0])) if isinstance(arg, str)}
    assert not any("linkmill" in name for name in names)


def test_mix(spark, docs, texts, none):
    rows = fair_mix.mix_by_weight(with_repeats(docs)).collect()
    assert len(rows) == 23
    assert sum(r.taken for r in rows) == sum(r["size"] for r in rows)
    assert all(0 <= r.taken <= 3 * r["size"] for r in rows)
    assert fair_mix.mix_by_weight(none).count() == 0


def test_mix_meets_targets(spark):
    rows = [(i, "w " * (1 + i % 7), ["a", "b", "c", None][i % 4 if i % 3 else 0]) for i in range(4000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    first = fair_mix.mix_by_weight(frame).collect()
    by = {}
    for r in first:
        target, taken = by.get(r.source, (r.target, 0))
        by[r.source] = (target, taken + r.taken)
    assert abs(sum(t for t, _ in by.values()) - sum(r["size"] for r in first)) < 1e-6
    assert all(abs(taken - target) <= 16 for target, taken in by.values())
    again = fair_mix.mix_by_weight(frame.repartition(5)).collect()
    assert {(r.doc_id, r.taken) for r in again} == {(r.doc_id, r.taken) for r in first}


def test_running_sums_over_many_tasks(spark):
    """One source with a third of the rows, and rows that are equal in all but their number."""
    rows = spark.range(3000).selectExpr("id AS row", "if(id % 3 = 0, 'hot', concat('s', id % 50)) AS source", "1 + id % 5 AS size")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = fair_mix.running(rows.repartition(5), ["source", "row"], "size", "upto").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    total = 0
    for r in sorted(got, key=lambda r: (r.source, r.row)):
        total += r["size"]
        assert r.upto == total


def test_mix_of_rows_without_ids(spark):
    """Null ids are as many documents, ordered by their texts."""
    rows = [(None, f"w{i} " * (1 + i % 4), "a" if i % 2 else "b") for i in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    first, again = (sorted((r["size"], r.taken) for r in fair_mix.mix_by_weight(f).collect()) for f in (frame, frame.repartition(6)))
    assert first == again and sum(t for _, t in first) == sum(s for s, _ in first)
