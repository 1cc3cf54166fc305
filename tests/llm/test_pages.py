"""Page operators: extraction, URL rules and cascades, archives; token counts and the pipeline."""

import random
import zlib

import corpus_pipeline
import pytest
import regex
from linkmill.llm import html_blocks, token_counts, url_cascade, warc
from linkmill.llm.labelled_pages import LABELLED
from linkmill.llm.queries import PRE_TOKENS, VOCABULARY
from pyspark.sql import functions as F

SCHEMA = "page_id long, url string, html string, host string, path string, digest string, payload string"


@pytest.fixture(scope="module")
def pages(spark):
    big = "<p>" + "x" * 2000
    rows = [
        (1, "https://A.Example.ORG/es/1?q", big),
        (2, "https://example.org/en/12#t", big),
        (3, "http://sub.example.org/en/2", None),
        (4, "http://shop.com/fr/", ""),
        (5, "http://shop.com/de/x", "short"),
        (6, "http://com?x://y", "short"),
        (7, None, big),
        (8, "no scheme", "<b>é</b>"),
        (9, "http://www.spam-farm.net/en/", "z" * 300_000),
        (10, "http://good.net/a:80", "<article><p>Fine.</p></article>"),
        (None, "http://org", big),
        (2, "https://example.org/en/12#t", big),
    ]
    return spark.createDataFrame([(*r, "h", "p", "d", "l") for r in rows], SCHEMA)


def test_labelled_pages_are_learned():
    tree = html_blocks.train()
    for html, main in LABELLED:
        assert html_blocks.main_text(html, tree) == "\n\n".join(main)


def test_neighbours_decide():
    """The tree asks for words and link density of neighbours, and unseen pages are told by them."""
    tree = html_blocks.train()
    asked = tree.columns()
    assert asked & {"words_before", "words_after"} and asked & {"links_before", "links_after"}
    a, b, c = (" ".join(f"{name}{i}" for i in range(25)) for name in "abc")
    text = lambda html: html_blocks.main_text(html, tree)
    # the same short line: between long blocks, in a list of short ones, between long links
    assert text(f"<p>{a}</p><p>Just this.</p><p>{b}</p>") == f"{a}\n\nJust this.\n\n{b}"
    menu = "<p>Start page</p><p>Just this.</p><p>Your place</p>"
    assert text(f"<div>{menu}</div><div><p>{a}</p><p>{b}</p></div>").replace(f"{a}\n\n{b}", "") in ("", "Your place\n\n")
    links = f"<p><a href=1>{a}</a></p><p>Just this.</p><p><a href=2>{b}</a></p>"
    assert text(f"<div><p>{c}</p><p>{c}</p></div><div>{links}</div>") == f"{c}\n\n{c}"


@pytest.mark.parametrize(
    "wrapper", ["layout has-sidebar", "no-sidebar", "search-results main", "sidebar-left", "page with-banner", "social share"]
)
def test_an_article_is_read_whatever_its_wrapper_is_called(wrapper):
    page = f"<div class='{wrapper}'><nav><a href=/>Home</a></nav><article><div class='page-header'><h1>Title of it</h1></div><p>Text.</p></article></div>"
    assert html_blocks.main_text(page, html_blocks.train()) == "Title of it\n\nText."


@pytest.mark.parametrize("frame", ["class='cookie-notice'", "class='related-links'", "id=newsletter", "class='ad ad-top'", "role=navigation", "class='comment-list'"])
def test_named_frames_go(frame):
    line = " ".join(f"w{i}" for i in range(20))
    page = f"<article><p>{line} a</p><div {frame}><p>{line} b</p></div><p>{line} c</p></article>"
    assert html_blocks.main_text(page, html_blocks.train()) == f"{line} a\n\n{line} c"


@pytest.mark.parametrize(
    "html, text",
    [
        (None, ""),
        ("", ""),
        ("<p>", ""),
        ("plain &amp; simple", "plain & simple"),
        ("<article><p>a&nbsp;b\n c<br>d<p>e</article>", "a b c d\n\ne"),
        ("<article><p>x<script>var t='</p>';</script>y</p></article>", "xy"),
        ("<article><p title=\"a>b\">q</p><!-- <p>no</p> --></article>", "q"),
        ("<article><p>cut off <b", "cut off"),
        ("<nav><a href=x>menu</a></nav><article>t</article>", "t"),
    ],
)
def test_small_pages(html, text):
    assert html_blocks.main_text(html, html_blocks.train()) == text


def test_extract_rows(spark, pages):
    rows = html_blocks.extract(pages).collect()
    assert len(rows) == 12
    assert {(r.page_id, r.text, r.n_chars) for r in rows if r.page_id in (3, 4, 10)} == {(3, "", 0), (4, "", 0), (10, "Fine.", 5)}
    assert html_blocks.extract(pages.limit(0)).count() == 0


def test_urls(pages):
    judged = url_cascade.judge_urls(pages, url_cascade.labelled_hosts(pages))
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judged.collect()}
    assert got == {
        1: ("a.example.org", "/es/1", "example.org/es/", "block"),
        2: ("example.org", "/en/12", "example.org/en/1", "block"),
        3: ("sub.example.org", "/en/2", "org/", "allow"),
        4: ("shop.com", "/fr/", "com/fr/", "allow"),
        5: ("shop.com", "/de/x", "com/de/", "block"),
        6: ("com", "", None, "allow"),
        7: ("", "", None, "allow"),
        8: ("", "", None, "allow"),
        9: ("www.spam-farm.net", "/en/", None, "block"),
        10: ("good.net", "/a:80", None, "allow"),
        None: ("org", "", None, "allow"),
    }


def test_urls_of_no_pages(pages):
    none = pages.limit(0)
    assert url_cascade.judge_urls(none, url_cascade.labelled_hosts(pages)).collect() == []
    assert url_cascade.judge_urls(none, url_cascade.labelled_hosts(none)).collect() == []


@pytest.mark.parametrize("most", [1 << 21, 7])
def test_cascade_is_exact(spark, monkeypatch, most):
    """In one array a level and in many: no other way is taken for a longer list."""
    monkeypatch.setattr(url_cascade, "SHARD_WORDS", most)
    keys = spark.range(20_000).select(F.concat(F.lit("key"), "id").alias("key"), F.col("id") % 37 == 0)
    keys = keys.toDF("key", "truth")
    cascade = url_cascade.Cascade.build(keys, keys.where("truth"))
    assert (cascade.levels[0][0].shards > 5) == (most == 7)
    plan = cascade.listed(keys)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan.split("scalar-subquery")[0]
    assert cascade.listed(keys).where("listed != truth").count() == 0
    nothing = url_cascade.Cascade.build(keys, keys.limit(0))
    assert nothing.listed(keys).where("listed").count() == 0


def test_archives(spark, pages):
    rows = warc.round_trip(pages, payloads=True).collect()
    assert len(rows) == 12
    by = {r.page_id: r for r in rows}
    assert {(r.record_type, r.refers_to) for r in rows if r.page_id in (1, 2, None)} == {("revisit", 7)}
    assert (by[7].record_type, by[5].record_type, by[6].record_type) == ("response",) * 3
    assert by[9].payload == b"z" * 300_000 and by[8].payload_bytes == 9
    assert by[3].payload == b"" and by[1].payload_bytes == by[7].payload_bytes == 2003
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_payloads_are_not_shuffled_and_archives_read_in_parallel(spark, pages):
    rows = warc.archive_rows(pages.repartition(4))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert {len(r.payload) for r in rows.where("refers_to IS NOT NULL").collect()} == {0}
    index = spark.range(6).selectExpr("concat('p', id) AS path", "0 AS offset", "1 AS length", "0 AS page_id")
    plan = warc.read_records(index)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(path" in plan and ", 6), REPARTITION_BY_NUM" in plan


def test_normaliser_reads_any_members(spark, tmp_path):
    first = warc.record(1, "http://a", b"one\r\n\r\nWARC/1.1\r\n", "d1", 17, None)
    other = warc.record(2, None, b"", "d2", 0, None)
    source = tmp_path / "mono.warc.gz"
    gz = lambda x: (z := zlib.compressobj(wbits=31)).compress(x) + z.flush()
    source.write_bytes(gz(first + other[:40]) + gz(other[40:]))
    archives = spark.createDataFrame([(str(source),)], "path string")
    index = warc.normalise(archives, str(tmp_path / "out")).orderBy("offset").collect()
    data = open(index[0].path, "rb").read()
    parts = [zlib.decompress(data[r.offset : r.offset + r.length], 31) for r in index]
    assert parts == [first, other]
    assert len(open(index[0].path + ".idx").read().splitlines()) == 2


def test_edited_counts():
    split = regex.compile(PRE_TOKENS)
    counter = token_counts.load(open(VOCABULARY, "rb").read(), PRE_TOKENS)
    draw = random.Random(4)
    letters = "ab  \n\n\t'st're12.é!  "
    for _ in range(300):
        text = "".join(draw.choices(letters, k=draw.choice([0, 1, 5, 50, 900])))
        tree = token_counts.TokenTree(text, split, counter)
        for _ in range(4):
            begin = draw.randint(0, len(text))
            end = min(len(text), begin + draw.choice([0, 0, 1, 3, 20, 300]))
            new = "".join(draw.choices(letters, k=draw.choice([0, 1, 3, 10])))
            tree.edit(begin, end, new)
            text = text[:begin] + new + text[end:]
            assert tree.text == text
            assert tree.tokens == len(counter.encode(text))


def test_kept_trees_encode_only_what_edits_touch():
    """Set up again from lengths and counts, a tree encodes a few pre-tokens around each edit, and none before."""
    split = regex.compile(PRE_TOKENS)
    plain = token_counts.load(open(VOCABULARY, "rb").read(), PRE_TOKENS)
    text = " ".join(f"word{i}" for i in range(5000))
    kept = token_counts.TokenTree(text, split, plain).kept()
    seen = []
    watched = token_counts.Counter(lambda piece: seen.append(piece) or plain.encode(piece))
    for round_ in range(3):
        tree = token_counts.TokenTree(text, split, watched, kept)
        assert not seen and tree.text == text and tree.tokens == len(plain.encode(text))
        for at in (0, 7000 + round_, len(text) - 3):
            tree.edit(at, at + 4, f" new{round_}x{at} it's")
        assert 0 < len(seen) <= tree.recounted < 40
        text, kept = tree.text, tree.kept()
        assert tree.tokens == len(plain.encode(text)) and sum(kept[0]) == len(text)
        seen.clear()
        watched.clear()


def test_tables_of_trees(spark, docs, none, tmp_path):
    """Two batches of edits, each from the written table of the one before: as if counted anew."""
    edits = token_counts.edits_for(F.col("doc_id"), F.col("text"))
    path = str(tmp_path / "trees")
    token_counts.token_trees(docs, VOCABULARY, PRE_TOKENS).write.parquet(f"{path}0")
    for n in range(2):
        edited = token_counts.edit_trees(spark.read.parquet(f"{path}{n}"), edits, VOCABULARY, PRE_TOKENS)
        edited.write.parquet(f"{path}{n + 1}")
    counter = token_counts.load(open(VOCABULARY, "rb").read(), PRE_TOKENS)
    rows = spark.read.parquet(f"{path}2").collect()
    assert len(rows) == 19
    for r in rows:
        assert r.n_tokens_after == len(counter.encode(r.text)) == sum(r.counts) and sum(r.lengths) == len(r.text)
    long = next(r for r in rows if r.doc_id == 12)
    assert len(long.lengths) > 100_000 and long.n_recounted < 200
    for nothing in (token_counts.token_trees(none, VOCABULARY, PRE_TOKENS), token_counts.count_edited(none, edits, VOCABULARY, PRE_TOKENS)):
        assert nothing.collect() == []


def test_edits_touch_little(docs, none):
    edits = token_counts.edits_for(F.col("doc_id"), F.col("text"))
    rows = token_counts.count_edited(docs, edits, VOCABULARY, PRE_TOKENS).collect()
    long = next(r for r in rows if r.doc_id == 12)
    assert long.n_pretokens > 100_000 and long.n_recounted < 200
    assert next(r for r in rows if r.doc_id == 1).n_tokens == 0
    assert token_counts.count_edited(none, edits, VOCABULARY, PRE_TOKENS).count() == 0


def test_pipeline_stages(spark, docs, tmp_path):
    items = spark.createDataFrame([(1, "one two three four")], "item_id long, text string")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    left = docs
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, left, str(tmp_path))
        assert left.columns == docs.columns, name
        kept.append({r.doc_id for r in left.select("doc_id").collect()})
    language, exact, near, clean = kept
    assert language == set(range(4, 20)) - {14}
    assert exact == language - {7}
    assert near == exact - {5, 9, 10, 11, 13}
    assert clean == near - {6}
    mixed = corpus_pipeline.mix(spark, left, str(tmp_path)).collect()
    assert {r.doc_id for r in mixed} == clean
