"""Edit-aware token counts.

A document keeps its pre-tokens in the leaves of a segment tree whose nodes sum
code points and tokens.  An edit re-splits from one pre-token before it until
the new pre-tokens meet an old boundary behind it, encodes only those, and
updates the sums on the way up; all other leaves keep their counts.

Trees are kept: :func:`token_trees` gives every document's leaves as a table (lengths
and counts of its pre-tokens beside the text), :func:`edit_trees` applies a batch of edits to
such a table and returns the next one.  A kept tree is set up again without
splitting or encoding anything.

Byte-level BPE never merges across pre-tokens, so a document's count is the sum
over its pre-tokens.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from itertools import accumulate

import pyarrow as pa
import regex
import tiktoken
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkmill.llm.text import filled

#: pre-tokens in a leaf when a document is first read
LEAF = 64
#: pre-tokens whose counts a task remembers
REMEMBERED = 200_000


class Counter(dict):
    """Tokens of a pre-token, remembered up to a bound."""

    def __init__(self, encode: Callable[[str], list[int]]) -> None:
        super().__init__()
        self.encode, self.encoded = encode, 0

    def __missing__(self, piece: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self.encoded += 1
        count = self[piece] = len(self.encode(piece))
        return count


def load(vocabulary: bytes, pattern: str) -> Counter:
    """Counter of a vocabulary in lines of ``base64 rank``."""
    lines = (line.split() for line in vocabulary.splitlines() if line)
    ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
    encoding = tiktoken.Encoding("given", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return Counter(encoding.encode_ordinary)


class TokenTree:
    """Pre-tokens of one text in a segment tree; ``tokens`` is the count of the whole text.

    ``kept`` are lengths and counts of the text's pre-tokens, if they are known.
    """

    def __init__(self, text: str, split: regex.Pattern, counter: Counter, kept: tuple[list[int], list[int]] | None = None) -> None:
        self.split, self.counter = split, counter
        if kept is None:
            pieces = split.findall(text)
            counts = list(map(counter.__getitem__, pieces))
        else:
            lengths, counts = kept
            ends = list(accumulate(lengths))
            pieces = [text[end - n : end] for n, end in zip(lengths, ends, strict=True)]
        starts = range(0, len(pieces), LEAF)
        self.leaves = [pieces[i : i + LEAF] for i in starts] or [[]]
        self.counts = [counts[i : i + LEAF] for i in starts] or [[]]
        self.width = 1 << (len(self.leaves) - 1).bit_length()
        self.chars, self.sums = [0] * (2 * self.width), [0] * (2 * self.width)
        self.recounted = 0
        for i, leaf in enumerate(self.leaves):
            self.chars[self.width + i] = sum(map(len, leaf))
            self.sums[self.width + i] = sum(self.counts[i])
        for node in range(self.width - 1, 0, -1):
            self._add_up(node)

    def kept(self) -> tuple[list[int], list[int]]:
        """Lengths and counts of all pre-tokens."""
        return [len(piece) for leaf in self.leaves for piece in leaf], [n for leaf in self.counts for n in leaf]

    @property
    def tokens(self) -> int:
        return self.sums[1]

    @property
    def length(self) -> int:
        return self.chars[1]

    @property
    def text(self) -> str:
        return "".join(piece for leaf in self.leaves for piece in leaf)

    def _add_up(self, node: int) -> None:
        self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
        self.sums[node] = self.sums[2 * node] + self.sums[2 * node + 1]

    def _set(self, leaf: int, pieces: list[str], counts: list[int]) -> None:
        self.leaves[leaf], self.counts[leaf] = pieces, counts
        node = self.width + leaf
        self.chars[node], self.sums[node] = sum(map(len, pieces)), sum(counts)
        while node > 1:
            node //= 2
            self._add_up(node)

    def _find(self, place: int) -> tuple[int, int]:
        """Leaf that holds code point ``place`` (the last one for the end), and where it starts."""
        node, start = 1, 0
        while node < self.width:
            node *= 2
            if place >= start + self.chars[node] and start + self.chars[node] < self.length:
                start += self.chars[node]
                node += 1
        return min(node - self.width, len(self.leaves) - 1), start

    def edit(self, begin: int, end: int, new: str) -> None:
        """Replace the code points from ``begin`` up to ``end`` by ``new``; the range is clipped."""
        begin = min(max(begin, 0), self.length)
        end = min(max(end, begin), self.length)
        # one pre-token of context before the edit: the end of the one before may move
        first, start = self._find(max(begin - 1, 0))
        before: list[str] = []
        at = start
        for piece in self.leaves[first]:
            if at + len(piece) >= begin:
                break
            before.append(piece)
            at += len(piece)
        if before:
            at -= len(before.pop())
        elif first:
            # the piece before lies in an earlier leaf that is not empty
            while first and not before:
                first -= 1
                before = list(self.leaves[first])
            if before:
                at -= len(before.pop())
        last, last_start = self._find(end)
        known = self.counts[first][: len(before)]
        old = [piece for leaf in range(first, last + 1) for piece in self.leaves[leaf]][len(before) :]
        while True:
            # old pre-tokens from ``at``; new text of the same stretch
            text = "".join(old)
            changed = text[: begin - at] + new + text[end - at :]
            shift = len(new) - (end - begin)
            tail = at + len(text)
            # ends of old pre-tokens behind the edit, in new positions from ``at``
            ends, place = {}, 0
            for i, piece in enumerate(old):
                place += len(piece)
                if at + place >= end:
                    ends[place + shift] = i + 1
            pieces, place, met = [], 0, None
            follows = tail < self.length
            for match in self.split.finditer(changed):
                piece = match[0]
                if follows and match.end() >= len(changed) - 1 and len(changed) > 0:
                    break  # what comes next may change this one
                pieces.append(piece)
                place = match.end()
                if place >= begin - at + len(new) and place in ends and not self._open(changed, place):
                    met = ends[place]
                    break
            if met is not None or not follows:
                break
            last += 1
            while last < len(self.leaves) - 1 and not self.leaves[last]:
                last += 1
            old += self.leaves[last]
        self.recounted += len(pieces)
        known += map(self.counter.__getitem__, pieces)
        if met is not None:
            pieces += old[met:]
            known += [n for leaf in range(first, last + 1) for n in self.counts[leaf]][len(before) + met :]
        for leaf in range(first + 1, last + 1):
            self._set(leaf, [], [])
        self._set(first, before + pieces, known)

    @staticmethod
    def _open(text: str, place: int) -> bool:
        """Whether a boundary lies beside white space, where splits depend on what surrounds it."""
        around = text[max(place - 1, 0) : place + 1]
        return text[place - 1 : place].isspace() or (len(around) > 1 and around[1].isspace() and text[place + 1 : place + 2].isspace())


def edits_for(doc_id: Column, text: Column) -> Column:
    """Three edits that every text gets here: a deletion, a replacement and an insertion.

    Places follow from the id and the length, so they spread over whole texts.
    """
    length = F.length(filled(text))
    place = lambda k: F.pmod(F.xxhash64(doc_id, F.lit(k)), length + 1).cast("int")
    edit = lambda at, n, new: F.struct(
        at.alias("begin"), (at + n).alias("end"), F.lit(new).alias("new")
    )
    return F.array(edit(place(1), 12, ""), edit(place(2), 5, " changed, 2x"), edit(place(3), 0, "It's new\n"))


def _counter(name: str, pattern: str) -> Counter:
    with open(SparkFiles.get(name), "rb") as file:
        return load(file.read(), pattern)


def _sent(docs: DataFrame, vocabulary: str) -> str:
    """Name of the vocabulary among the files that Spark sends to the executors."""
    docs.sparkSession.sparkContext.addFile(vocabulary)
    return vocabulary.rsplit("/", 1)[-1]


_COUNTS = ("n_tokens", "n_tokens_after", "n_pretokens", "n_recounted")


def _edited(tree: TokenTree, changes) -> tuple[int, int, int, int]:
    """Applies the changes; the numbers of _COUNTS."""
    before, pieces = tree.tokens, sum(map(len, tree.leaves))
    for change in changes or ():
        tree.edit(change["begin"], change["end"], change["new"] or "")
    return before, tree.tokens, pieces, tree.recounted


def count_edited(docs: DataFrame, edits: Column, vocabulary: str, pattern: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Token counts before and after ``edits`` (array of begin, end, new; applied in order).

    Returns ``doc_id, n_tokens, n_tokens_after, n_pretokens, n_recounted``
    for every row; null text is empty, null edits are none.
    ``vocabulary`` is a file on the driver that Spark sends to the executors.
    """
    name = _sent(docs, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, split = _counter(name, pattern), regex.compile(pattern)
        for batch in batches:
            told = [
                _edited(TokenTree(body, split, counter), changes)
                for body, changes in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)
            ]
            numbers = [pa.array(column, pa.int64()) for column in zip(*told, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(numbers or [pa.array([], pa.int64())] * 4)], ["doc_id", *_COUNTS])

    rows = docs.select(F.col(doc_id).alias("doc_id"), filled(F.col(text)).alias("text"), edits.alias("edits"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{name} long" for name in _COUNTS))


_TREE = "text string, lengths array<int>, counts array<int>"


def _trees(ids: pa.Array, texts: list[str], kept: list[tuple]) -> list[pa.Array]:
    lists = [pa.array(column, pa.list_(pa.int32())) for column in zip(*kept, strict=True)] or [pa.array([], pa.list_(pa.int32()))] * 2
    return [ids, pa.array(texts, pa.string()), *lists]


def token_trees(docs: DataFrame, vocabulary: str, pattern: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Every row's leaves: ``doc_id, text, lengths, counts``, for the caller to write; null text is empty."""
    name = _sent(docs, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, split = _counter(name, pattern), regex.compile(pattern)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            kept = [TokenTree(body, split, counter).kept() for body in texts]
            yield pa.RecordBatch.from_arrays(_trees(batch.column(0), texts, kept), ["doc_id", "text", "lengths", "counts"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), filled(F.col(text)).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, {_TREE}")


def edit_trees(trees: DataFrame, edits: Column, vocabulary: str, pattern: str) -> DataFrame:
    """The trees after ``edits``, as ``token_trees`` gives them, and what :func:`count_edited` tells of each.

    Only pre-tokens that an edit touches, and the context at its ends, are split and encoded.
    """
    name = _sent(trees, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, split = _counter(name, pattern), regex.compile(pattern)
        for batch in batches:
            texts, kept, told = [], [], []
            for body, lengths, counts, changes in zip(*(batch.column(i).to_pylist() for i in range(1, 5)), strict=True):
                tree = TokenTree(body, split, counter, (lengths, counts))
                told.append(_edited(tree, changes))
                texts.append(tree.text)
                kept.append(tree.kept())
            numbers = [pa.array(column, pa.int64()) for column in zip(*told, strict=True)] or [pa.array([], pa.int64())] * 4
            columns = _trees(batch.column(0), texts, kept) + numbers
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text", "lengths", "counts", *_COUNTS])

    rows = trees.select("doc_id", "text", "lengths", "counts", edits.alias("edits"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, {_TREE}, " + ", ".join(f"{name} long" for name in _COUNTS))
