"""Benchmark decontamination by winnowed k-grams, with DataFrame functions only.

The documents' k-grams are taken at every STRIDE-th word and the smallest hash
of each two neighbours is kept; the items' k-grams are taken at every word and
winnowed once for each phase of the stride.  WINDOW consecutive words hold two
neighbouring k-grams of the documents' stride wherever they start, and the same
two are neighbours in one of the item's phases, so the same minimum is kept on
both sides: every shared span of WINDOW words shares a fingerprint.  Hits are
extended to all windows around them, and those are compared as words.

Items of fewer words are one window.  For each such length that occurs the
documents' spans of that length are fingerprints, too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkmill.llm.set_links import text_key
from linkmill.llm.text import BETWEEN_WORDS, ascii_lower, filled, pieces
from linkmill.plans.lineage import materialize, stored
from linkmill.plans.sizes import small_side

WINDOW, GRAM, STRIDE = 10, 5, 3


def exact_words(text: Column) -> Column:
    return pieces(ascii_lower(filled(text)), BETWEEN_WORDS)


def loose_words(text: Column) -> Column:
    """Words in lower case in every script: equal wherever the exact words are equal.

    The one letter whose lower case depends on its neighbours is mapped first.
    """
    for letter in "Σς":
        text = F.replace(text, F.lit(letter), F.lit("σ"))
    return pieces(F.lower(text), BETWEEN_WORDS)


def _grams(words: str, first: int, step: int, length: int) -> Column:
    """Hashes of the ``length`` words from word ``first`` (from 1), then every ``step`` words."""
    last = F.size(words) - length + 1
    at = F.sequence(F.lit(first), F.greatest(last, F.lit(first)), F.lit(step))
    grams = F.transform(at, lambda i: F.xxhash64(F.slice(words, i, length), F.lit(length)))
    return F.when(last >= first, grams).otherwise(F.array().cast("array<bigint>"))


def _winnowed(grams: str) -> Column:
    """The smaller hash of each two neighbours, once."""
    n = F.greatest(F.size(grams) - 1, F.lit(0))
    pairs = F.zip_with(F.slice(grams, F.lit(1), n), F.slice(grams, F.lit(2), n), lambda a, b: F.least(a, b))
    return F.array_distinct(pairs)


def _prints(rows: DataFrame, firsts: list[int], lengths: list[int]) -> DataFrame:
    """``rows`` with ``prints``: winnowed k-grams from each of ``firsts``, and spans of ``lengths``."""
    for first in firsts:
        rows = rows.withColumn(f"grams{first}", _grams("words", first, STRIDE, GRAM))
    found = [_winnowed(f"grams{first}") for first in firsts]
    found += [F.array_distinct(_grams("words", 1, 1, n)) for n in lengths]
    return rows.withColumn("prints", F.concat(*found)).drop(*(f"grams{f}" for f in firsts))


def _spans(words: str, starts: Column, length: int | Column) -> Column:
    return F.transform(
        starts,
        lambda i: F.struct(
            i.alias("at"), F.array_join(F.slice(words, i, length), " ").alias("span")
        ),
    )


def _all_starts(words: str, length: int | Column) -> Column:
    last = F.greatest(F.size(words) - length + 1, F.lit(0))
    return F.when(last > 0, F.sequence(F.lit(1), F.greatest(last, F.lit(1)))).otherwise(
        F.array().cast("array<int>")
    )


def contamination(
    docs: DataFrame, items: DataFrame, text: str = "text", doc_id: str = "doc_id", item_id: str = "item_id"
) -> DataFrame:
    """Words of documents inside benchmark windows.

    Returns every row of ``docs``: ``doc_id, n_words, n_hit, n_items, items
    (sorted ids, comma-joined), items_sha256, contaminated``.  Words are runs of
    characters other than ASCII ones that are no letters or digits, A-Z
    lower-cased; null has none.  A null item id counts as an item named "".
    Every row is compared by its own text, whether its id is null or repeated;
    equal texts are compared once.
    """
    items = materialize(
        items.select(
            F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"),
            exact_words(F.col(text)).alias("exact"),
            loose_words(F.col(text)).alias("words"),
        ).where("size(exact) > 0"),
        "items",
    )
    short = [
        r[0] for r in items.where(F.size("exact") < WINDOW).select(F.size("exact")).distinct().collect()
    ]
    long = _prints(items.where(F.size("exact") >= WINDOW), [1, 2, 3][:STRIDE], [])
    prints = long.select(F.explode("prints").alias("print"))
    for n in short:
        brief = items.where(F.size("exact") == n)
        prints = prints.union(brief.select(F.explode(_grams("words", 1, 1, n)).alias("print")))
    prints = materialize(prints.distinct(), "prints")
    length = F.least(F.size("exact"), F.lit(WINDOW))
    windows = items.withColumn("length", length).select(
        "item",
        "length",
        F.explode(_spans("exact", _all_starts("exact", F.col("length")), F.col("length"))).alias("w"),
    )
    # one row per span, with all items that hold it
    windows = windows.groupBy("length", F.col("w.span").alias("span")).agg(F.collect_set("item").alias("items"))
    windows = small_side(materialize(windows, "windows"))
    prints = small_side(prints)

    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), *text_key())
    found = docs.select("doc_id", "t1", "t2", loose_words(F.col("text")).alias("words"))
    found = _prints(found, [1], short).select("doc_id", "t1", "t2", F.size("words").cast("long").alias("n_words"), "prints")
    found = materialize(found, "fingerprints")
    hits = found.select("t1", "t2", F.explode("prints").alias("print")).join(prints, "print")
    hits = stored(hits.select("t1", "t2").distinct(), "hits")
    one = docs.join(small_side(hits), ["t1", "t2"]).groupBy("t1", "t2").agg(F.min("text").alias("text"))
    touched = one.select("t1", "t2", loose_words(F.col("text")).alias("words"), exact_words(F.col("text")).alias("exact"))
    touched = materialize(touched, "touched")

    # a fingerprint at word i lies in the windows that start at the words from i - reach to i
    reach = WINDOW - GRAM

    def around(step: int, size: int, length: int, back: int) -> DataFrame:
        """Spans of ``length`` words around the ``size``-word fingerprints, taken every ``step`` words."""
        spots = touched.select("t1", "t2", F.posexplode(_grams("words", 1, step, size)).alias("at", "print"))
        spots = spots.join(prints, "print").groupBy("t1", "t2").agg(F.collect_set(F.col("at") * step + 1).alias("at"))
        starts = F.transform("at", lambda i: F.sequence(F.greatest(i - back, F.lit(1)), i))
        starts = F.filter(F.array_distinct(F.flatten(starts)), lambda i: i + length - 1 <= F.size("exact"))
        spans = touched.join(spots, ["t1", "t2"])
        return spans.select("t1", "t2", F.lit(length).alias("length"), F.explode(_spans("exact", starts, length)).alias("w"))

    spans = around(STRIDE, GRAM, WINDOW, reach)
    for n in short:
        spans = spans.union(around(1, n, n, 0))
    words = F.transform("at", lambda x: F.sequence(x["at"], x["at"] + x["length"] - 1))
    matched = (
        spans.select("t1", "t2", "length", "w.at", "w.span")
        .join(windows, ["length", "span"])
        .groupBy("t1", "t2")
        .agg(F.collect_set(F.struct("at", "length")).alias("at"), F.collect_set("items").alias("items"))
        .select(
            "t1",
            "t2",
            F.size(F.array_distinct(F.flatten(words))).cast("long").alias("n_hit"),
            F.sort_array(F.array_distinct(F.flatten("items"))).alias("names"),
        )
        .select("t1", "t2", "n_hit", F.size("names").cast("long").alias("n_items"), F.array_join("names", ",").alias("items"))
    )
    matched = small_side(stored(matched, "matched"))
    return found.select("doc_id", "t1", "t2", "n_words").join(matched, ["t1", "t2"], "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", F.lit("")).alias("items"),
        F.sha2(F.coalesce("items", F.lit("")), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )
