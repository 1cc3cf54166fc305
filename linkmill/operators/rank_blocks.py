"""Ranking rounds over blocks of links, in which only numbers move.

Nodes lie in hash classes.  A class keeps its links as arrays, and the order in which it sends one
sum per target to each other class is settled once, when names are exchanged; the sums of the first round go
with the names.  From then on a round is one shuffle of plain arrays: eight bytes a target and class, no
names.  A sum that no ranked source gives to is NaN, so a node drops out as it does in a join.

Links of sources that no link leads to are left out of the rounds: after the first one such
a source has no rank ("drop"), or the base for ever, so that its gifts are added once ("keep").  A class
learns which sources these are with the names, and tells the others which targets it leaves out.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkmill.fixed_values import RANK_START

_ROWS = "to int, origin int, kind int, data binary"
#: kinds of rows that go to a class: its own links, names and first sums, sums of a round, its ranks, what rounds leave out
_OWN, _NAMES, _SUMS, _STATE, _LEFT_OUT = range(5)


def _packed(value) -> bytes:
    return zlib.compress(pickle.dumps(value, protocol=5), 1)


def _unpacked(data: bytes):
    return pickle.loads(zlib.decompress(data))


def _emit(rows: list[tuple]) -> pa.RecordBatch:
    to, origin, kind, data = zip(*rows, strict=True) if rows else ((), (), (), ())
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary())
    arrays = [pa.array(c, t) for c, t in zip((to, origin, kind, data), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=["to", "origin", "kind", "data"])


def _told(rows: pa.Table) -> Iterator[tuple]:
    """``(origin, kind, data)``; a side of a group without rows has no columns either."""
    if rows.num_rows:
        yield from zip(*(rows.column(c).to_pylist() for c in ("origin", "kind", "data")), strict=True)


def _sums(at: np.ndarray, gifts: np.ndarray, size: int) -> np.ndarray:
    """Gifts added by place; NaN where nothing but NaN arrives."""
    given = ~np.isnan(gifts)
    if not given.all():
        at, gifts = at[given], gifts[given]
    out = np.bincount(at, gifts, size).astype(float)  # of nothing, it counts in whole numbers
    out[np.bincount(at, minlength=size) == 0] = np.nan
    return out


def _planes(values: np.ndarray) -> tuple[str, bytes]:
    """Numbers as their first bytes, then their second ones, and so on: those that hardly differ compress well."""
    bytes_of = values.view(np.uint8).reshape(len(values), values.itemsize)
    return values.dtype.str, bytes_of.T.tobytes()


def _flat(kind: str, planes: bytes) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(size, -1).T).view(kind).ravel()


def _tabled(values: np.ndarray) -> tuple:
    """Numbers that repeat as places in a table; others as they are."""
    table, which = np.unique(values, return_inverse=True)
    if 2 * len(table) > len(values):
        return _planes(values), None
    return _planes(table), _planes(which.astype(np.min_scalar_type(len(table))))


def _untabled(table: tuple, which: tuple | None) -> np.ndarray:
    return _flat(*table) if which is None else _flat(*table)[_flat(*which)]


def _spelt(names: pa.Array) -> tuple:
    """Names, of which a null is the last: their lengths and their letters, all first ones first unless that takes much more."""
    body = names.cast(pa.string()).drop_null()
    lengths, letters = np.zeros(0, np.int32), np.zeros(0, np.uint8)
    if len(body):
        ends = np.frombuffer(body.buffers()[1], np.int32)[body.offset : body.offset + len(body) + 1]
        lengths, letters = np.diff(ends), np.frombuffer(body.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    longest = int(lengths.max(initial=0))
    by_place = longest * len(lengths) <= 2 * len(letters)
    if by_place:
        table = np.zeros((len(lengths), longest), np.uint8)
        table[np.arange(longest) < lengths[:, None]] = letters
        letters = table.T
    return _planes(lengths), letters.tobytes(), by_place, names.null_count


def _read(lengths: tuple, letters: bytes, by_place: bool, nulls: int) -> pa.Array:
    lengths, letters = _flat(*lengths), np.frombuffer(letters, np.uint8)
    if by_place:
        longest = int(lengths.max(initial=0))
        letters = letters.reshape(longest, len(lengths)).T[np.arange(longest) < lengths[:, None]]
    ends = np.cumsum(np.append(0, lengths)).astype(np.int32)
    body = pa.StringArray.from_buffers(len(lengths), pa.py_buffer(ends), pa.py_buffer(letters.tobytes()))
    return pa.concat_arrays([body, pa.nulls(nulls, pa.string())]) if nulls else body


def _cut(r0: float):
    """Task function: placed links to what their class keeps and what others must know."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = _thin(batches)
        if whole is None:
            return
        home = whole.column("home").to_numpy()
        classes = np.unique(home)
        for c in classes:
            yield _emit(_block(whole.filter(pa.array(home == c)) if len(classes) > 1 else whole, int(c), r0))

    return run


def _cut_class(r0: float):
    """Group function: the same for the links of one class."""
    return lambda key, links: pa.Table.from_batches([_emit(_block(_thin(links.to_batches()), key[0].as_py(), r0))])


#: links whose names are gathered before they are replaced by numbers
_GATHERED = 500_000


def _thin(batches: Iterable[pa.RecordBatch]) -> pa.Table | None:
    """All links of a task, each name held once."""
    done, held, n = [], [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            n += batch.num_rows
        if n >= _GATHERED:
            done.append(_numbered(held))
            held, n = [], 0
    if held:
        done.append(_numbered(held))
    return pa.concat_tables(done).unify_dictionaries() if done else None


def _numbered(batches: list[pa.RecordBatch]) -> pa.Table:
    rows = pa.Table.from_batches(batches)
    for c in ("src", "dst"):
        rows = rows.set_column(rows.schema.get_field_index(c), c, rows.column(c).combine_chunks().dictionary_encode())
    return rows


def _names_and_numbers(column: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """The names of a numbered column, null last if it occurs, and a number per row."""
    names = column.chunk(0).dictionary
    numbers = pa.concat_arrays([chunk.indices for chunk in column.chunks])
    if numbers.null_count:
        numbers = numbers.fill_null(len(names))
        names = pa.concat_arrays([names, pa.nulls(1, names.type)])
    return names, numbers.to_numpy()


def _block(links: pa.Table, home: int, r0: float) -> list[tuple]:
    (sources, source), (targets, target) = (_names_and_numbers(links.column(c)) for c in ("src", "dst"))
    away, weight = links.column("away").to_numpy(), links.column("weight").to_numpy()
    rank = links.column("rank").to_numpy() if "rank" in links.column_names else r0
    # targets by class, within it by name
    klass = np.zeros(len(targets), np.int32)
    klass[target] = away
    alphabet = np.empty(len(targets), np.int32)
    alphabet[pc.array_sort_indices(targets).to_numpy()] = np.arange(len(targets))
    order = np.lexsort((alphabet, klass))
    place = np.empty(len(order), np.int32)
    place[order] = np.arange(len(order))
    entry = place[target]
    first = _sums(entry, weight * rank, len(order))
    names, klass, rows, sizes = targets.take(pa.array(order)), klass[order], [], {}
    for t, begin in zip(*np.unique(klass, return_index=True), strict=True):
        end = int(np.searchsorted(klass, t, "right"))
        told = (_spelt(names[begin:end]), _tabled(first[begin:end]))
        rows.append((int(t), home, _NAMES, _packed(told)))
        sizes[int(t)] = end - int(begin)
    rows.append((home, home, _OWN, _packed((_spelt(sources), _coded(source, entry, weight), sizes))))
    return rows


def _coded(source: np.ndarray, entry: np.ndarray, weight: np.ndarray) -> tuple:
    """Links by source, in numbers that compress well: steps between sources, then between targets, a table of weights."""
    order = np.lexsort((entry, source))
    steps = (np.diff(of[order], prepend=0).astype(np.int32) for of in (source, entry))
    return *(_planes(s) for s in steps), _tabled(weight[order])


def _decoded(source: tuple, entry: tuple, weight: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.cumsum(_flat(*source), dtype=np.int32), np.cumsum(_flat(*entry), dtype=np.int32), _untabled(*weight)


def _gifts(static: dict, ranks: np.ndarray, home: int) -> list[tuple]:
    """What a class sends when its nodes have these ranks."""
    if not static["cores"]:
        return []
    source, entry, weight = _decoded(*static["links"])
    sums = _sums(entry, weight * ranks[static["own"]][source], sum(static["cores"].values()))
    rows, at = [], 0
    for t, n in static["cores"].items():
        if n:
            rows.append((t, home, _SUMS, _planes(sums[at : at + n])[1]))
        at += n
    return rows


def _ranked(
    size: int, received: list[tuple], fixed: np.ndarray | None, base: float, factor: float, keep: bool
) -> np.ndarray:
    """Ranks of a class from ``(origin, nodes, sums)`` that reach it; sums are added in the order of their classes."""
    received = sorted(received, key=lambda r: r[0])
    if received:
        total = _sums(np.concatenate([r[1] for r in received]), np.concatenate([r[2] for r in received]), size)
    else:
        total = np.full(size, np.nan)
    if keep:
        total = np.nan_to_num(total, nan=0.0)
        total = total if fixed is None else total + fixed
    return base + factor * total


def _build(base: float, factor: float, keep: bool):
    """Group function: a class learns its nodes, ranks them by the first sums and settles what its rounds send."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        home = key[0].as_py()
        own, told, seen = None, [], set()
        for origin, kind, data in _told(rows):
            if (origin, kind) in seen:
                raise RuntimeError(f"the links of class {origin} were cut in two")
            seen.add((origin, kind))
            if kind == _OWN:
                own = _unpacked(data)
            else:
                told.append((origin, *_unpacked(data)))
        told.sort(key=lambda r: r[0])
        lists = [_read(*r[1]) for r in told] + ([_read(*own[0])] if own else [])
        coded = pa.concat_arrays(lists).dictionary_encode("encode")
        # numbered by name, so that the places of a list of names are small steps
        by_name = pc.array_sort_indices(coded.dictionary).to_numpy()
        size = len(by_name)
        number = np.empty(size, np.int32)
        number[by_name] = np.arange(size, dtype=np.int32)
        node = number[coded.indices.to_numpy()]
        places, received, fed, at = {}, [], np.zeros(size, bool), 0
        for (origin, _, first), names in zip(told, lists, strict=False):
            nodes = node[at : at + len(names)]
            at += len(names)
            fed[nodes] = True
            places[origin] = _planes(np.diff(nodes, prepend=np.int32(0)))
            received.append((origin, nodes, _untabled(*first)))
        ranks = _ranked(size, received, None, base, factor, keep)
        static = {"size": size, "places": places, "own": node[at:], "links": None, "cores": {}}
        out = []
        if own:
            static["links"], static["cores"], out = _settled(own[1], own[2], fed[node[at:]], home, base, keep)
        out.append((home, home, _OWN, _packed(static)))
        out.append((home, home, _NAMES, _packed(_spelt(coded.dictionary.take(pa.array(by_name))))))
        out.append((home, home, _STATE, ranks.tobytes()))
        return pa.Table.from_batches([_emit(out)])

    return run


def _settled(links: tuple, sizes: dict, fed: np.ndarray, home: int, base: float, keep: bool) -> tuple:
    """The links of fed sources, how many sums they send to each class, and what classes are told of the others."""
    source, entry, weight = _decoded(*links)
    gives = fed[source]
    core = np.zeros(sum(sizes.values()), bool)
    core[entry[gives]] = True
    fixed = np.bincount(entry[~gives], weight[~gives] * base, len(core)).astype(float)
    cores, rows, at = {}, [], 0
    for t, n in sizes.items():
        part = slice(at, at + n)
        at += n
        cores[t] = int(core[part].sum())
        always = _tabled(fixed[part]) if keep and fixed[part].any() else None
        rows.append((t, home, _LEFT_OUT, _packed((np.packbits(core[part]), always))))
    # a round's sums, one class after another, without the targets that only unfed sources name
    number = np.cumsum(core) - 1
    return _coded(source[gives], number[entry[gives]], weight[gives]), cores, rows


def _arrived(static: dict, left_out: dict, received: dict) -> tuple[list[tuple], np.ndarray]:
    """``(origin, nodes, sums)`` of a round, and what unfed sources give each node."""
    placed, fixed = [], np.zeros(static["size"])
    for origin, (core, always) in left_out.items():
        nodes = np.cumsum(_flat(*static["places"][origin]))
        if always is not None:
            fixed[nodes] += _untabled(*always)  # a list names a node once
        if origin in received:
            placed.append((origin, nodes[np.unpackbits(core, count=len(nodes)).astype(bool)], received[origin]))
    return placed, fixed


def _step(out: int, base: float, factor: float, keep: bool):
    """Group function: sums or ranks that reach a class, to its next sums or ranks."""

    def run(key: tuple, kept: pa.Table, arrived: pa.Table) -> pa.Table:
        home = key[0].as_py()
        static, left_out, received, ranks = None, {}, {}, None
        for origin, kind, data in _told(kept):
            if kind == _OWN:
                static = _unpacked(data)
            else:
                left_out[origin] = data
        if static is None:
            return pa.Table.from_batches([_emit([])])
        for origin, kind, data in _told(arrived):
            if kind == _STATE:
                ranks = np.frombuffer(data)
            else:
                received[origin] = _flat("<f8", data)
        if ranks is None:
            left_out = {origin: _unpacked(left_out[origin]) for origin in sorted(left_out)}
            ranks = _ranked(static["size"], *_arrived(static, left_out, received), base, factor, keep)
        rows = _gifts(static, ranks, home) if out == _SUMS else [(home, home, _STATE, ranks.tobytes())]
        return pa.Table.from_batches([_emit(rows)])

    return run


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Names and ranks of a class as rows."""
    for batch in batches:
        for names, ranks in zip(batch.column("names").to_pylist(), batch.column("ranks").to_pylist(), strict=True):
            values = np.frombuffer(ranks)
            held = ~np.isnan(values)
            nodes = _read(*_unpacked(names)).filter(pa.array(held))
            yield pa.RecordBatch.from_arrays([nodes, pa.array(values[held])], names=["node", "rank"])


def cut_blocks(
    rows: DataFrame, ranks: DataFrame | None, partitions: int, r0: float = RANK_START, scattered: bool = False
) -> DataFrame:
    """What classes keep and tell each other, from links placed by ``src``.

    All sources start with ``r0``, else with their ``ranks (node, rank)``, which then lie where their links do, so
    nothing moves.  Links that are ``scattered`` may not lie in their classes and are gathered first.
    """
    rows, also = rows.where("weight > 0"), []
    if ranks is not None:
        rows, also = rows.join(ranks.select(F.col("node").alias("src"), "rank").hint("merge"), "src"), ["rank"]
    place = lambda c: F.pmod(F.hash(c), F.lit(partitions)).alias
    links = rows.select("src", "dst", "weight", *also, place("src")("home"), place("dst")("away"))
    if scattered:
        return links.groupBy("home").applyInArrow(_cut_class(r0), _ROWS)
    return links.mapInArrow(_cut(r0), _ROWS)


def build_blocks(cut: DataFrame, base: float, factor: float, keep: bool) -> DataFrame:
    """Per class its block, the names of its nodes and their ranks after one round."""
    return cut.groupBy("to").applyInArrow(_build(base, factor, keep), _ROWS)


def of_kind(built: DataFrame, kind: str) -> DataFrame:
    """The rows of :func:`build_blocks` that make a ``block``, or are its ``names`` or ``ranks``."""
    rows = built.where(F.col("kind").isin({"block": [_OWN, _LEFT_OUT], "names": [_NAMES], "ranks": [_STATE]}[kind]))
    return rows.select(*[F.col(c).alias(c) for c in rows.columns])  # a cogroup needs columns of each side's own


def block_step(blocks: DataFrame, arrived: DataFrame, to: str, base: float, factor: float, keep: bool) -> DataFrame:
    """Sums or ranks of the classes to the ``sums`` they send next, or to their ``ranks``."""
    step = _step(_SUMS if to == "sums" else _STATE, base, factor, keep)
    return blocks.groupBy("to").cogroup(arrived.groupBy("to")).applyInArrow(step, _ROWS)


def named_ranks(names: DataFrame, state: DataFrame) -> DataFrame:
    """``(node, rank)`` of the nodes that have a rank."""
    both = names.select("to", F.col("data").alias("names")).join(
        state.select("to", F.col("data").alias("ranks")).hint("merge"), "to"
    )
    return both.select("names", "ranks").mapInArrow(_named, "node string, rank double")
