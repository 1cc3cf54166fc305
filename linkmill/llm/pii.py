"""Personal data by weak supervision, with DataFrame functions only.

Base spans come from fixed patterns and checks.  Beside them, wider patterns
propose candidates (spelled-out mail addresses, digit groups); four labelers -
shape, gazetteer, context and layout - vote yes, no or not at all on each.
Candidates are counted per pattern of votes and span features over the whole corpus;
from that table expectation-maximisation estimates how reliable each labeler is, and
the resulting soft labels train a logistic span classifier over the votes and the
features: size, grouping, first character and the word before.  So it can speak where the
labelers are silent, and overrule them.  Candidates it accepts are added where they
touch no base span.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkmill.llm.text import filled
from linkmill.plans.lineage import materialize

KINDS = ("email", "ip", "card", "phone")
#: where a match may start is stated so that long runs are not tried from each of their characters
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: cheap tests that every text with a match of the kind passes
_HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){15}", "phone": r"\+[0-9]"}
_OCTETS = r"^(?:0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\.|$)){4}"

_NAME, _LABEL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}", r"[A-Za-z0-9-]{1,63}"
WIDE = {
    "email": _NAME
    + rf"(?:\x20?[\[({{]at[\])}}]\x20?{_LABEL}(?:\x20?(?:\.|[\[({{]dot[\])}}])\x20?{_LABEL})+|\x20at\x20{_LABEL}(?:\x20dot\x20{_LABEL})+)",
    "number": r"(?<![0-9A-Za-z.+-])\(?[0-9](?:[\x20().-]{0,2}[0-9]){6,18}(?![0-9A-Za-z])",
}
_WIDE_HINTS = {"email": rf"[\[({{]at[\])}}]|\x20at\x20{_LABEL}\x20dot\x20", "number": r"[0-9](?:[\x20().-]{0,2}[0-9]){6}"}
#: fixed lists of the gazetteer and context labelers
DOMAINS = ("com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "uk", "eu")
NEAR_YES = r"(?i)(?:phone|telephone|tel|call|mobile|cell|fax|contact|mail|e-mail|email|card|visa|mastercard|write to|reach)[^A-Za-z]{0,12}$"
NEAR_NO = r"(?i)(?:token|key|password|secret|order|invoice|isbn|issn|id|no|nr|total|version|page|year|[=#$€£%])[^A-Za-z0-9]{0,4}$"
CONTEXT = 40
LABELERS = ("shape", "gazetteer", "context", "layout")
ROUNDS, STEPS = 30, 300
#: ridges of the classifier: votes already made the soft labels, so features explain what they can
RIDGE_VOTES, RIDGE_FEATURES = 0.1, 0.001
#: span features and their numbers of values; with the votes, 52,488 patterns at most
FEATURES = {"size": 6, "grouping": 3, "first": 4, "word": 9}


def _with(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _total(lengths: Column) -> Column:
    return F.aggregate(lengths, F.lit(0), lambda total, n: total + n)


def spans_of(text: Column, pattern: str) -> Column:
    """``begin, end, match`` of the pattern's successive matches, in code points.

    A match begins after all gaps and matches before it.  Their lengths are added up in
    blocks of about the root of their number first, so n matches cost n times that root.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)

    def placed(parts: Column) -> Column:
        matches = parts["found"]
        steps = F.zip_with(F.slice(parts["gaps"], F.lit(1), F.size(matches)), matches, lambda g, m: F.length(g) + F.length(m))
        return _with(F.struct(matches.alias("found"), parts["gaps"].alias("gaps"), steps.alias("steps")), in_blocks)

    def in_blocks(parts: Column) -> Column:
        size = F.greatest(F.ceil(F.sqrt(F.size(parts["steps"]))).cast("int"), F.lit(1))
        blocks = F.sequence(F.lit(0), F.floor((F.size(parts["steps"]) - 1) / size).cast("int"))
        sums = F.transform(blocks, lambda b: _total(F.slice(parts["steps"], b * size + 1, size)))
        return _with(F.struct(parts.alias("parts"), size.alias("size"), sums.alias("sums")), spans)

    def spans(known: Column) -> Column:
        parts, size = known["parts"], known["size"]

        def span(match: Column, i: Column) -> Column:
            block = F.floor(i / size).cast("int")
            before = _total(F.slice(known["sums"], F.lit(1), block))
            inside = _total(F.slice(parts["steps"], block * size + 1, i - block * size))
            begin = before + inside + F.length(F.get(parts["gaps"], i))
            return F.struct(begin.alias("begin"), (begin + F.length(match)).alias("end"), match.alias("match"))

        return F.transform(parts["found"], span)

    none = F.array().cast("array<struct<begin:int,end:int,match:string>>")
    both = F.struct(found.alias("found"), gaps.alias("gaps"))
    return _with(both, lambda parts: F.when(F.size(parts["found"]) > 0, placed(parts)).otherwise(none))


def digits_of(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the digits pass the check sum that doubles every second one from the right."""
    figures = F.filter(F.split(F.reverse(digits), ""), lambda d: d != "")

    def add(total: Column, figure: Column) -> Column:
        value = figure.cast("int") * F.when(total["odd"], 2).otherwise(1)
        value = F.when(value > 9, value - 9).otherwise(value)
        return F.struct((total["sum"] + value).alias("sum"), (~total["odd"]).alias("odd"))

    start = F.struct(F.lit(0).alias("sum"), F.lit(False).alias("odd"))
    return F.aggregate(figures, start, add, lambda total: total["sum"] % 10 == 0)


def _valid(kind: str, match: Column) -> Column:
    count = F.length(digits_of(match))
    if kind == "ip":
        return match.rlike(_OCTETS)
    if kind == "card":
        return F.when(count.between(16, 19), luhn(digits_of(match))).otherwise(False)
    if kind == "phone":
        return count.between(8, 15)
    return F.lit(True)


def _none(kind: str) -> Column:
    return F.array().cast(kind)


def _checker(kind: str):
    return lambda s: _valid(kind, s["match"])


def _namer(kind: str):
    return lambda s: F.struct(F.lit(kind).alias("kind"), s["begin"].alias("begin"), s["end"].alias("end"))


_SPANS = "array<struct<kind:string,begin:int,end:int>>"


def base_spans(text: Column) -> Column:
    """All base spans by kind as listed, then by start."""
    parts = []
    for kind in KINDS:
        hint = F.contains(text, F.lit("@")) if kind == "email" else text.rlike(_HINTS[kind])
        good = F.filter(spans_of(text, PATTERNS[kind]), _checker(kind))
        named = F.transform(good, _namer(kind))
        parts.append(F.when(hint, named.cast(_SPANS)).otherwise(_none(_SPANS)))
    return F.concat(*parts)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def _votes(kind: str, match: Column, before: Column) -> list[Column]:
    digits = digits_of(match)
    context = _vote(before.rlike(NEAR_YES), before.rlike(NEAR_NO))
    if kind == "email":
        ending = F.lower(F.regexp_extract(match, "([A-Za-z0-9-]+)$", 1))
        return [
            _vote(ending.rlike("^[a-z]{2,}$"), ~ending.rlike("^[a-z]{2,}$")),
            _vote(ending.isin(*DOMAINS), F.lit(False)),
            context,
            _vote(match.rlike(r"[\[({]"), F.lit(False)),
        ]
    card = F.length(digits) >= 13
    grouped = match.rlike(r"^\(?[0-9]{3}\)?[\x20.-]{1,2}[0-9]{3}[\x20.-][0-9]{4}$")
    return [
        F.when(card, F.when(luhn(digits), 1).otherwise(-1)).otherwise(_vote(grouped, ~grouped)),
        F.when(card, _vote(digits.rlike("^(?:4|5[1-5]|3[47]|35|6)"), F.lit(True))).otherwise(
            _vote(digits.rlike("^0?[2-9][0-9]{2}"), digits.rlike("^(?:19|20)[0-9]{2}"))
        ),
        context,
        _vote(match.rlike(r"[0-9][\x20().-]{1,2}[0-9]"), ~match.rlike(r"[\x20().-]")),
    ]


def _features(kind: str, match: Column, before: Column) -> list[Column]:
    """A value of each of FEATURES: whole numbers from 0."""
    digits = F.length(digits_of(match))
    size = F.lit(0)
    if kind != "email":
        size = F.when(digits <= 8, 1).when(digits <= 10, 2).when(digits <= 12, 3).when(digits <= 15, 4).otherwise(5)
    between = F.array_distinct(F.regexp_extract_all(match, F.lit(r"[\x20().\[\]{}-]"), F.lit(0)))
    grouping = F.least(F.size(between), F.lit(2))
    first = F.when(match.rlike(r"^\("), 0).when(match.rlike("^0"), 1).when(match.rlike("^1"), 2).otherwise(3)
    word = F.lower(F.regexp_extract(before, "([A-Za-z]+)[^A-Za-z]*$", 1))
    spread = F.pmod(F.xxhash64(word), F.lit(FEATURES["word"] - 1))
    return [size, grouping, first, F.when(word == "", FEATURES["word"] - 1).otherwise(spread)]


_CANDIDATES = "array<struct<kind:string,begin:int,end:int,votes:array<int>,features:array<int>>>"


def _judge(text: Column, kind: str):
    def judged(s: Column) -> Column:
        since = F.greatest(s["begin"] - CONTEXT, F.lit(0))
        before = F.substring(text, since + 1, s["begin"] - since)
        votes = F.array(*[v.cast("int") for v in _votes(kind, s["match"], before)])
        features = F.array(*[v.cast("int") for v in _features(kind, s["match"], before)])
        card = F.length(digits_of(s["match"])) >= 13
        name = F.lit("email") if kind == "email" else F.when(card, "card").otherwise("phone")
        return F.struct(
            name.alias("kind"), s["begin"].alias("begin"), s["end"].alias("end"), votes.alias("votes"), features.alias("features")
        )

    return judged


def candidates(text: Column) -> Column:
    """Wider matches with their labelers' votes (1 yes, -1 no, 0 none) and their features."""
    parts = []
    for kind, pattern in WIDE.items():
        found = F.transform(spans_of(text, pattern), _judge(text, kind)).cast(_CANDIDATES)
        parts.append(F.when(text.rlike(_WIDE_HINTS[kind]), found).otherwise(_none(_CANDIDATES)))
    return F.concat(*parts)


@dataclass(frozen=True)
class Labelling:
    """What was learned: share of true spans, each labeler's rates, and the classifier."""

    prior: float
    yes_if_true: tuple[float, ...]
    yes_if_false: tuple[float, ...]
    weights: tuple[float, ...]
    shifts: tuple[tuple[float, ...], ...]
    bias: float

    def score(self, votes, features) -> float:
        """The classifier's; above zero it accepts."""
        of_votes = sum(w * v for w, v in zip(self.weights, votes, strict=True))
        return self.bias + of_votes + sum(shift[f] for shift, f in zip(self.shifts, features, strict=True))

    def posterior(self, votes) -> float:
        """Probability of a true span given the votes, labelers independent given the truth."""
        odds = math.log(self.prior / (1 - self.prior))
        for vote, true, false in zip(votes, self.yes_if_true, self.yes_if_false, strict=True):
            if vote:
                odds += math.log(true / false) if vote > 0 else math.log((1 - true) / (1 - false))
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, odds))))


def learn(counts: list[tuple[tuple[int, ...], tuple[int, ...], int]]) -> Labelling:
    """EM and classifier from the number of candidates per pattern of votes and features.

    Rates start from the majority of votes and are smoothed, so no candidates or
    one lone pattern are fine.  Rounds, steps and order are fixed: reruns agree.
    """
    n = len(LABELERS)
    counts = sorted(counts)
    votes = np.array([v for v, _, _ in counts], float).reshape(-1, n)
    times = np.array([c for _, _, c in counts], float)
    soft = np.select([votes.sum(axis=1) > 1, votes.sum(axis=1) < 0], [0.9, 0.1], 0.4)
    blank = Labelling(0.5, (0.7,) * n, (0.3,) * n, (0.0,) * n, tuple((0.0,) * k for k in FEATURES.values()), 0.0)
    model = blank
    for _ in range(ROUNDS):
        prior = (float(soft @ times) + 1) / (times.sum() + 2)
        rates = []
        for share, more in ((soft * times, 7), (times - soft * times, 3)):
            yes, voted = share @ (votes > 0), share @ (votes != 0)
            rates.append(tuple(((yes + more) / (voted + 10)).tolist()))
        model = replace(blank, prior=prior, yes_if_true=rates[0], yes_if_false=rates[1])
        soft = np.array([model.posterior(v) for v, _, _ in counts])
    starts = np.cumsum([0, *FEATURES.values()])
    rows = np.concatenate([votes, np.zeros((len(counts), starts[-1]))], axis=1)
    for i, (_, features, _) in enumerate(counts):
        rows[i, n + starts[:-1] + np.array(features)] = 1
    ridge = np.repeat([RIDGE_VOTES, RIDGE_FEATURES], [n, starts[-1]])
    weights, bias = np.zeros(rows.shape[1]), 0.0
    share = times / max(times.sum(), 1)
    for _ in range(STEPS):
        odds = np.clip(rows @ weights + bias, -50, 50)
        gap = (1 / (1 + np.exp(-odds)) - soft) * share
        weights = weights - 2 * (rows.T @ gap + ridge * weights)
        bias -= 2 * float(gap.sum())
    shifts = [tuple(weights[n + a : n + b].tolist()) for a, b in zip(starts[:-1], starts[1:], strict=True)]
    return replace(model, weights=tuple(weights[:n].tolist()), shifts=tuple(shifts), bias=bias)


def accepts(model: Labelling, votes: Column, features: Column) -> Column:
    """The classifier's verdict: a weighted sum of votes and features above zero."""
    score = F.lit(model.bias)
    for j, weight in enumerate(model.weights):
        score = score + F.lit(weight) * F.get(votes, F.lit(j))
    for j, shift in enumerate(model.shifts):
        score = score + F.get(F.array(*map(F.lit, shift)), F.get(features, F.lit(j)))
    return score > 0


def _is(kind: str):
    return lambda s: s["kind"] == kind


def _told(spans: Column) -> Column:
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", s["kind"], s["begin"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def find_personal_data(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Every row's spans: ``doc_id, n_<kind>`` (base spans), ``base, spans`` (all; arrays).

    Null text is empty; offsets are code points, ends exclusive.  Rows that
    repeat an id stay rows of their own.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), filled(F.col(text)).alias("text"))
    found = rows.select("doc_id", base_spans(F.col("text")).alias("base"), candidates(F.col("text")).alias("wide"))
    apart = F.filter(
        "wide", lambda c: ~F.exists("base", lambda b: (b["begin"] < c["end"]) & (c["begin"] < b["end"]))
    )
    found = materialize(found.withColumn("wide", apart), "spans")
    patterns = found.select(F.explode("wide").alias("c")).groupBy("c.votes", "c.features").count()
    model = learn([(tuple(r["votes"]), tuple(r["features"]), r["count"]) for r in patterns.collect()])
    added = F.transform(
        F.filter("wide", lambda c: accepts(model, c["votes"], c["features"])),
        lambda c: F.struct(c["kind"].alias("kind"), c["begin"].alias("begin"), c["end"].alias("end")),
    ).cast(_SPANS)
    rank = lambda s: F.array_position(F.array(*map(F.lit, KINDS)), s["kind"])
    ordered = F.transform(
        F.array_sort(
            F.transform(
                F.concat("base", added),
                lambda s: F.struct(rank(s).alias("rank"), s["begin"].alias("begin"), s["end"].alias("end"), s["kind"].alias("kind")),
            )
        ),
        lambda s: F.struct(s["kind"].alias("kind"), s["begin"].alias("begin"), s["end"].alias("end")),
    )
    counts = [
        F.size(F.filter("base", _is(kind))).cast("long").alias(f"n_{kind}") for kind in KINDS
    ]
    return found.select("doc_id", *counts, "base", ordered.alias("spans"))


def told_spans(found: DataFrame) -> DataFrame:
    """``find_personal_data`` rows with ``base_sha256`` and ``spans`` as text."""
    return found.select(
        "doc_id",
        *[f"n_{kind}" for kind in KINDS],
        F.sha2(_told(F.col("base")), 256).alias("base_sha256"),
        _told(F.col("spans")).alias("spans"),
    )
