"""Language identification with a string kernel.

A text is the set of its byte n-grams for n = 1 to GRAMS, hashed to a fixed
number of features (blended spectrum, presence only; A-Z lower-cased, every
other ASCII character that is no letter as a space).  The kernel of two texts is the
size of the intersection over the root of the product of the sizes.  LANDMARKS
training texts span the Nystroem features; one ridge regression per language
(one against the rest) is solved on a bounded sample that gives every language
an equal share.  Texts are scored in batches by matrix products.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkmill.llm.text import filled

GRAMS, FEATURES = 4, 1 << 13
#: documents of the training sample, and those of them that are landmarks
SAMPLE, LANDMARKS = 2_000, 128
RIDGE = 1e-3
#: bytes of text and rows that are scored at once
BATCH_BYTES, BATCH_ROWS = 1 << 20, 256
UNKNOWN = "und"

_MULTIPLIERS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F)
_CODE = np.arange(256, dtype=np.uint32)
_CODE[65:91] += 32
_CODE[[*range(65), *range(91, 97), *range(123, 128)]] = 32


def _row_features(raw: np.ndarray) -> Iterator[np.ndarray]:
    """Feature numbers of all n-grams, one array per n."""
    code = _CODE[raw]
    for n in range(1, GRAMS + 1):
        if len(code) < n:
            return
        total = np.zeros(len(code) - n + 1, np.uint32)
        for k in range(n):
            total *= np.uint32(_MULTIPLIERS[0])
            total += code[k : k + len(total)] + np.uint32(1)
        total ^= total >> np.uint32(15)
        total *= np.uint32(_MULTIPLIERS[n - 1])
        yield total >> np.uint32(32 - FEATURES.bit_length() + 1)


def presence(texts: list[bytes]) -> np.ndarray:
    """One row of 0 and 1 per text; long texts are read piece by piece."""
    out = np.zeros((len(texts), FEATURES), np.float32)
    for i, text in enumerate(texts):
        for at in range(0, len(text), BATCH_BYTES):
            raw = np.frombuffer(text, np.uint8)[at : at + BATCH_BYTES + GRAMS - 1]
            for found in _row_features(raw):
                out[i, found] = 1
    return out


def _scaled(rows: np.ndarray) -> np.ndarray:
    """Rows divided by the root of their number of features, so products are kernels."""
    return rows / np.sqrt(np.maximum(rows.sum(axis=1, keepdims=True), 1))


@dataclass(frozen=True)
class Model:
    """``scores = (scaled presence) @ weights + bias``: one column per language.

    Landmark matrix, Nystroem map and regressions are one linear map once
    multiplied out.
    """

    languages: tuple[str, ...]
    weights: np.ndarray
    bias: np.ndarray

    def scores(self, texts: list[bytes]) -> np.ndarray:
        return linear_scores(texts, self.weights, self.bias)


def linear_scores(texts: list[bytes], weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    return _scaled(presence(texts)) @ weights + bias


def fit(sample: list[tuple[str, str]]) -> Model:
    """Kernel ridge regressions from ``(text, language)`` rows in a fixed order."""
    languages = tuple(sorted({lang for _, lang in sample}))
    if not sample:
        return Model((), np.zeros((FEATURES, 0), np.float32), np.zeros(0, np.float32))
    rows = _scaled(presence([text.encode() for text, _ in sample]))
    # landmarks: the first texts of each language in turn
    seen: dict[str, int] = {}
    rank = []
    for i, (_, lang) in enumerate(sample):
        seen[lang] = seen.get(lang, 0) + 1
        rank.append((seen[lang], i))
    marks = rows[[i for _, i in sorted(rank)[:LANDMARKS]]]
    value, vector = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    keep = value > 1e-6 * value[-1]
    root = vector[:, keep] / np.sqrt(value[keep])
    project = (marks.T @ root).astype(np.float32)
    features = (rows @ project).astype(np.float64)
    goal = np.array([[1.0 if lang == name else 0.0 for name in languages] for _, lang in sample])
    share = goal.mean(axis=0)
    middle = features.mean(axis=0)
    centred = features - middle
    square = centred.T @ centred + RIDGE * len(sample) * np.eye(centred.shape[1])
    beta = np.linalg.solve(square, centred.T @ (goal - share))
    return Model(
        languages,
        (project @ beta).astype(np.float32),
        (share - middle @ beta).astype(np.float32),
    )


def held_out(doc_id: Column) -> Column:
    """Whether a document is never learned from: a fifth of all; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def training_sample(
    docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", rows: int = SAMPLE
) -> list[tuple[str, str]]:
    """At most ``rows`` labelled rows outside the held-out fifth, languages in equal shares."""
    usable = docs.select(
        F.col(text).alias("text"), F.col(lang).alias("lang"), F.col(doc_id).alias("doc_id")
    ).where(F.col("text").rlike(r"\p{L}") & F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    counts = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}
    if not counts:
        return []
    weight = F.lit(0.0)
    for name, count in counts.items():
        weight = F.when(F.col("lang") == name, F.lit(float(count))).otherwise(weight)
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) * weight
    chosen = usable.select("doc_id", "lang", draw.alias("draw")).orderBy("draw", "doc_id").limit(rows)
    top, last = chosen.agg(F.max(F.struct("draw", "doc_id"))).first()[0]
    table = (
        usable.where((draw < top) | ((draw == top) & (F.col("doc_id") <= last)))
        .select("text", "lang", draw.alias("draw"), "doc_id")
        .collect()
    )
    return [(r["text"], r["lang"]) for r in sorted(table, key=lambda r: (r["draw"], r["doc_id"]))]


def train(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> Model:
    """A model from the labelled rows of ``docs`` outside the held-out fifth."""
    return fit(training_sample(docs, text, lang, doc_id))


def identify(
    docs: DataFrame,
    model: Model,
    text: str = "text",
    keep: list[str] | None = None,
    names: tuple[str, str] = ("lang_pred", "score"),
) -> DataFrame:
    """``docs`` (or its columns ``keep``) with two columns ``names``: the language and a score.

    The score is the share of the largest in a softmax, 0 to 1.  Null texts, texts
    without a letter and texts under a model that learned no language are ``und``
    with score 0; the first language wins ties.  Columns that already have these ``names``
    are replaced; any other column name may occur.
    """
    # plain arrays: what tasks unpickle must not hang on this package being on their path
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.weights, model.bias))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, weights, bias = shared.value
        for batch in batches:
            # the text and whether it has a letter are the last two columns
            column = batch.column(batch.num_columns - 2).cast(pa.large_binary())
            letters = batch.column(batch.num_columns - 1).to_pylist()
            languages: list[str] = []
            scores: list[float] = []
            for at in range(0, batch.num_rows, BATCH_ROWS):
                texts = [t or b"" for t in column.slice(at, BATCH_ROWS).to_pylist()]
                rows = linear_scores(texts, weights, bias)
                if rows.shape[1]:
                    odds = np.exp(8 * (rows - rows.max(axis=1, keepdims=True)))
                    scores += (1 / odds.sum(axis=1)).tolist()
                    languages += [known[i] for i in rows.argmax(axis=1).tolist()]
                else:
                    scores += [0.0] * len(rows)
                    languages += [UNKNOWN] * len(rows)
            yield pa.RecordBatch.from_arrays(
                batch.columns[:-2]
                + [
                    pa.array([x if ok else UNKNOWN for x, ok in zip(languages, letters, strict=True)], pa.string()),
                    pa.array([x if ok else 0.0 for x, ok in zip(scores, letters, strict=True)], pa.float64()),
                ],
                names=kept + list(names),
            )

    kept = [c for c in (docs.columns if keep is None else keep) if c not in names]
    rows = docs.select(*(F.col(f"`{c}`") for c in kept), F.col(text), filled(F.col(text)).rlike(r"\p{L}"))
    told = [T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())]
    return rows.mapInArrow(score, T.StructType([*rows.schema.fields[:-2], *told]))
