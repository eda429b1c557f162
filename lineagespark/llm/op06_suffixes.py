"""Suffix-array dedup by distributed prefix doubling.

Bytes covered by a string of ``LENGTH`` bytes that also starts elsewhere are removed. Sorting
every position would move many times the input, so the suffix array is sparse: positions whose
next ``GRAM`` bytes hash below a bound, one in ``SPACING``, are anchors. Equal strings have the same
anchors, and a window belongs to its first one.

1. Rank anchors by the bytes up to the next anchor; Spark sorts (rank, position) by ranges that
   may split a rank, and only positions whose rank occurs again survive. Then double: pair the
   rank of an anchor with that of the anchor 1, 2, 4 further on, sort and rank again. A string that
   is unique at some depth stays unique, so windows that need that depth are settled.
2. For surviving anchors, compare the whole stretch that all their windows cover. Where it occurs
   again, all these windows repeat. Otherwise single windows are compared, one representative per
   kind of stretch, within anchors that continue alike.

Names of ranks are 64-bit hashes: a clash only lets a position survive; what is removed rests on
128-bit hashes of whole strings. The first and last row of a sorted range survive too, because
their neighbours lie in another task. Windows with no anchor near their start are positions of
their own.

Equal texts are handled once: with a copy, a text of ``LENGTH`` bytes or more goes whole. Nulls are
empty texts; shorter texts lose nothing. Rows without an id and repeated rows are documents like
any other (a repeated row is a copy). An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineagespark.llm.common import forget, written

LENGTH = 400
GRAM, SPACING, REACH, DOUBLINGS = 16, 40, 240, 3
#: Places from here on are windows that stand for themselves.
ALONE = 1 << 30

_U = np.uint64
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTES = tuple(_mix((np.arange(256, dtype=np.uint64) + _U(1)) * _U(b)) for b in _BASES)


@lru_cache(maxsize=8)
def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse modulo 2 ** 64."""
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        p = np.ones(size, np.uint64)
        p[1:] = _U(b)
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


class Text:
    """Bytes with prefix sums, so any substring's hash is one subtraction and one product."""

    def __init__(self, data: bytes, hashes: int = 2):
        self.size = len(data)
        room = 1 << max(12, (self.size + 1).bit_length())
        raw = np.frombuffer(data, np.uint8)
        self.prefix, self.inverse = [], []
        for base, values in list(zip(_BASES, _BYTES, strict=True))[:hashes]:
            power, inverse = _powers(base, room)
            sums = np.zeros(self.size + 1, np.uint64)
            np.cumsum(values[raw] * power[: self.size], out=sums[1:])
            self.prefix.append(sums)
            self.inverse.append(inverse)

    def hash(self, start: np.ndarray, end: np.ndarray, which: int = 0) -> np.ndarray:
        return _mix((self.prefix[which][end] - self.prefix[which][start]) * self.inverse[which][start])

    def anchors(self) -> np.ndarray:
        if self.size < GRAM:
            return np.zeros(0, np.int64)
        grams = (self.prefix[0][GRAM:] - self.prefix[0][:-GRAM]) * self.inverse[0][: self.size - GRAM + 1]
        return np.flatnonzero(grams * _U(_BASES[1]) < _U((1 << 64) // SPACING))


def own_range(anchors: np.ndarray, size: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last start of the windows that belong to each anchor; empty where last < first.

    A window belongs to its first anchor, if that is within reach and another one follows inside.
    """
    if not len(anchors):
        return anchors, anchors
    before = np.concatenate([[-1], anchors[:-1]])
    after = np.concatenate([anchors[1:], [2 * size + length]])
    return np.maximum(np.maximum(before + 1, anchors - REACH), after + GRAM - length), np.minimum(anchors, size - length)


def needed(anchors: np.ndarray, starts: np.ndarray, owner: np.ndarray, length: int) -> np.ndarray:
    """The depth at which the anchors inside a window must repeat if the window does."""
    inside = np.searchsorted(anchors, starts + length - GRAM, side="right") - 1 - owner
    return np.minimum(np.floor(np.log2(np.maximum(inside, 1))), DOUBLINGS).astype(np.int64)


def alone(anchors: np.ndarray, size: int, length: int) -> np.ndarray:
    """Starts of windows that belong to no anchor."""
    first, last = own_range(anchors, size, length)
    edge = np.zeros(size - length + 2, np.int64)
    some = last >= first
    np.add.at(edge, first[some], 1)
    np.add.at(edge, last[some] + 1, -1)
    return np.flatnonzero(np.cumsum(edge[:-1]) == 0)


def _raw(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _places(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """``(rank, doc, place, need)`` of every anchor with a next one, and of every window alone.

    A place is the text's check sum and a number; ``need`` is the least depth that any of the
    anchor's windows asks for, 9 if it has none.
    """
    for batch in batches:
        ranks, docs, places, needs = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            raw = _raw(text)
            if len(raw) < length:
                continue
            t = Text(raw, 1)
            at, own = t.anchors(), (zlib.crc32(raw) & 0x7FFFFFFF) << 32
            lone = alone(at, t.size, length)
            ranks += [t.hash(at[:-1], at[1:] + GRAM), t.hash(lone, lone + length)]
            index = np.arange(max(len(at) - 1, 0))
            first, last = (x[:-1] for x in own_range(at, t.size, length))
            needs += [np.where(last >= first, needed(at, first, index, length), 9), np.zeros(len(lone), np.int64)]
            number = np.concatenate([index, ALONE + lone])
            places.append(own + number)
            docs.append(np.full(len(number), doc, np.int64))
        yield pa.RecordBatch.from_arrays([*(pa.array(np.concatenate(c).view(np.int64)) for c in (ranks, docs, places)), pa.array(np.concatenate(needs).astype(np.int8))], names=["rank", "doc", "place", "need"])


def _again(keys: int, schema: pa.Schema):
    """Of rows sorted by their first ``keys`` columns and then by position, those whose keys another position has too.

    Adds ``repeated`` and ``edge``: the first and last row of the range come out in any case,
    since their neighbours may lie in another task. Equal rows count as one position.
    """
    out = schema.append(pa.field("repeated", pa.bool_())).append(pa.field("edge", pa.bool_()))

    def rows(columns, keep, repeated, edge):
        return pa.RecordBatch.from_arrays([*(pa.array(c[keep], f.type) for c, f in zip(columns, schema, strict=True)), pa.array(repeated[keep]), pa.array(edge[keep])], schema=out)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row seen, whether it equals the one before, whether it is the first
        for batch in batches:
            columns, repeated_before, first = [c.to_numpy() for c in batch.columns], False, held is None
            if held is not None:
                columns = [np.concatenate([h, c]) for h, c in zip(held[0], columns, strict=True)]
                repeated_before, first = held[1:]
            if not len(columns[0]):
                continue
            differs = [c[1:] != c[:-1] for c in columns]
            new = np.concatenate([[True], np.logical_or.reduce(differs)])
            columns = [c[new] for c in columns]
            equal = np.logical_and.reduce([c[1:] == c[:-1] for c in columns[:keys]])
            repeated = np.concatenate([[repeated_before], equal]) | np.concatenate([equal, [False]])
            edge = np.zeros(len(repeated), bool)
            edge[0] = first
            held = [c[-1:] for c in columns], bool(repeated[-1]), bool(edge[-1])
            yield rows(columns, np.flatnonzero((repeated | edge)[:-1]), repeated, edge)
        if held is not None:
            yield rows(held[0], np.zeros(1, np.int64), np.array([held[1]]), np.array([True]))

    return task


_RANKED = pa.schema([("rank", pa.int64()), ("doc", pa.int64()), ("place", pa.int64()), ("need", pa.int8())])
_WINDOWS = pa.schema([("w1", pa.int64()), ("w2", pa.int64()), ("doc", pa.int64()), ("sum", pa.int64()), ("start", pa.int64())])


def _sorted_again(rows: DataFrame, keys: int, schema: pa.Schema) -> DataFrame:
    """``_again`` over ranges of the sorted rows; a range may begin or end inside a key, so no key is too large for a task."""
    order = schema.names
    kinds = {pa.int64(): "long", pa.int8(): "byte"}
    return rows.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_again(keys, schema), ", ".join(f"{f.name} {kinds[f.type]}" for f in schema) + ", repeated boolean, edge boolean")


def _ranked(rows: DataFrame) -> DataFrame:
    return _sorted_again(rows, 1, _RANKED).select(*_RANKED.names)


def prefix_doubling(docs: DataFrame, length: int = LENGTH) -> tuple[DataFrame, list[DataFrame]]:
    """``(doc, place, depth)``: the greatest depth (0 to DOUBLINGS) at which a position is not unique, where its windows need no more.

    Also returns the tables it reads from, to be deleted when it has been used.
    """
    now = written(_ranked(docs.select("doc", "text").mapInArrow(lambda it: _places(it, length), "rank long, doc long, place long, need byte")), "depth")
    depths = [now]
    for d in range(DOUBLINGS):
        here = now.filter(F.col("place").bitwiseAND(ALONE) == 0)
        there = here.select(F.col("rank").alias("_next"), "doc", (F.col("place") - (1 << d)).alias("place"))
        now = written(_ranked(here.join(there, ["doc", "place"]).select(F.xxhash64("rank", "_next").alias("rank"), "doc", "place", "need")), "depth")
        depths.append(now)
    parts = [df.select("doc", "place", F.lit(d).alias("depth"), "need") for d, df in enumerate(depths)]
    every = parts[0]
    for more in parts[1:]:
        every = every.unionByName(more)
    return every.groupBy("doc", "place").agg(F.max("depth").alias("depth"), F.max("need").alias("need")).filter("depth >= need").select("doc", "place", "depth"), depths


# -- stretches and windows -----------------------------------------------------------------------


class Candidates:
    """What a text's surviving places leave to compare."""

    def __init__(self, raw: bytes, number: np.ndarray, depth: np.ndarray, length: int):
        self.text, self.length = Text(raw), length
        at = self.at = self.text.anchors()
        self.lone = np.unique(number[number >= ALONE]) - ALONE
        known = np.full(len(at) + 1, -1)
        chained = number < ALONE
        np.maximum.at(known, number[chained], depth[chained])
        self.first, self.last = own_range(at, self.text.size, length)
        count = np.maximum(self.last - self.first + 1, 0)
        #: Windows by anchor: the anchor's number and the window's start.
        self.owner = np.repeat(np.arange(len(at)), count)
        self.start = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(self.first, count)
        self.open = known[self.owner] >= needed(at, self.start, self.owner, length)

    def stretches(self) -> tuple[np.ndarray, ...]:
        """(anchor, two hashes of the stretch its windows cover, hash of what follows the anchor)."""
        i = np.unique(self.owner[self.open])
        first, last, at = self.first[i], self.last[i], self.at[i]
        shape = _mix((at - first).astype(np.uint64) * _U(_BASES[0]) + (last - first).astype(np.uint64))
        one, two = (self.text.hash(first, last + self.length, w) ^ shape for w in (0, 1))
        return i, one, two, self.text.hash(at, at + self.length - REACH)

    def windows(self, anchors: np.ndarray) -> np.ndarray:
        """Starts of the open windows of some anchors and of the windows alone."""
        return np.concatenate([self.start[self.open & np.isin(self.owner, anchors)], self.lone])


def _longs(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _candidates(row: dict, length: int) -> Candidates:
    found = np.array(row["found"], np.int64)
    return Candidates(_raw(row["text"]), found >> 2, found & 3, length)


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for start in range(0, batch.num_rows, 64):
            yield from batch.slice(start, 64).to_pylist()


def _gathered(parts: list[tuple[np.ndarray, ...]], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([_longs(np.concatenate(c)) for c in zip(*parts, strict=True)], names=names)


def _in_lots(rows: Iterator[tuple[np.ndarray, ...]], names: list[str], most: int = 200_000) -> Iterator[pa.RecordBatch]:
    lot, size = [], 0
    for row in rows:
        lot.append(row)
        size += len(row[0])
        if size >= most:
            yield _gathered(lot, names)
            lot, size = [], 0
    if lot:
        yield _gathered(lot, names)


def _constant(value: int, n: int) -> np.ndarray:
    return np.full(n, value, np.int64)


def _stretch_task(length: int):
    def rows(batches):
        for row in _each(batches):
            i, one, two, follows = _candidates(row, length).stretches()
            yield _constant(row["doc"], len(i)), _constant(row["sum"], len(i)), i.astype(np.int64), one, two, follows

    return lambda batches: _in_lots(rows(batches), ["doc", "sum", "anchor", "s1", "s2", "follows"])


def _window_task(length: int):
    def rows(batches):
        for row in _each(batches):
            c = _candidates(row, length)
            start = c.windows(np.array(row["asked"] or [], np.int64))
            yield _constant(row["doc"], len(start)), _constant(row["sum"], len(start)), start.astype(np.int64), c.text.hash(start, start + length, 0), c.text.hash(start, start + length, 1)

    return lambda batches: _in_lots(rows(batches), ["doc", "sum", "start", "w1", "w2"])


def removed_bytes(raw: bytes, anchors: list[int] | None, starts: list[int] | None, length: int) -> np.ndarray:
    """Mask of the bytes that the windows of some anchors and some single windows cover."""
    edge = np.zeros(len(raw) + 1, np.int64)
    if anchors:
        at = Text(raw, 1).anchors()
        first, last = (x[np.array(anchors)] for x in own_range(at, len(raw), length))
        np.add.at(edge, first, 1)
        np.add.at(edge, last + length, -1)
    if starts:
        np.add.at(edge, np.array(starts), 1)
        np.add.at(edge, np.array(starts) + length, -1)
    return np.cumsum(edge[:-1]) > 0


def _removal_task(length: int):
    def task(batches):
        for batch in batches:
            rows = []
            for row in _each([batch]):
                raw = _raw(row["text"])
                gone = removed_bytes(raw, row["sure"], row["single"], length)
                spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(gone) else 0
                rows.append((row["doc"], row["sum"], int(gone.sum()), spans, np.frombuffer(raw, np.uint8)[~gone].tobytes()))
            n, m, k, s, t = zip(*rows, strict=True) if rows else ([],) * 5
            yield pa.RecordBatch.from_arrays([pa.array(n, pa.int64()), pa.array(m, pa.int64()), pa.array(k, pa.int64()), pa.array(s, pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in t], pa.string())], names=["doc", "sum", "n_removed", "n_spans", "kept_sha256"])

    return task


def repeats(docs: DataFrame, firsts: DataFrame, length: int = LENGTH) -> DataFrame:
    """``(doc, sum, n_removed, n_spans, kept_sha256)`` of the texts without an equal one that lose bytes.

    ``docs(doc, sum, text)``; ``firsts(doc, sum)`` name the texts that stand for their equals.
    """
    depths, used = prefix_doubling(docs, length)
    lists = depths.groupBy("doc", F.shiftright("place", 32).alias("sum")).agg(F.collect_list(F.col("place").bitwiseAND(0xFFFFFFFF) * 4 + F.col("depth")).alias("found"))
    lists = lists.join(firsts, ["doc", "sum"])
    texts = written(docs.select("doc", "sum", "text").join(lists, ["doc", "sum"]).dropDuplicates(["doc", "sum"]), "texts")  # only texts with a repeated piece
    forget(*used)

    stretches = written(texts.mapInArrow(_stretch_task(length), "doc long, sum long, anchor long, s1 long, s2 long, follows long"), "stretches")
    here = F.struct("doc", "sum", "anchor")
    kinds = written(stretches.groupBy("s1", "s2", "follows").agg(F.count(F.lit(1)).alias("n"), F.min(here).alias("one")), "kinds")
    sure = stretches.join(kinds.filter("n > 1").select("s1", "s2", "follows"), ["s1", "s2", "follows"]).groupBy("doc", "sum").agg(F.collect_list("anchor").alias("sure"))
    unsure = kinds.groupBy("follows").agg(F.min("n").alias("least"), F.count(F.lit(1)).alias("kinds")).filter("least = 1 AND kinds > 1").select("follows")
    asked = kinds.join(unsure, "follows").select("one.*").groupBy("doc", "sum").agg(F.collect_list("anchor").alias("asked"))
    ask = texts.join(asked, ["doc", "sum"], "left").filter(F.col("asked").isNotNull() | F.exists("found", lambda x: x >= 4 * ALONE))
    windows = ask.mapInArrow(_window_task(length), "doc long, sum long, start long, w1 long, w2 long")
    # Sorted like the ranks; a row at the edge of a range is settled by the other edges, two rows a range.
    windows = written(_sorted_again(windows, 2, _WINDOWS), "windows")
    met = windows.filter("edge").groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("w1", "w2")
    twins = windows.filter("repeated").select("doc", "sum", "start").unionByName(windows.filter("edge AND NOT repeated").join(met, ["w1", "w2"]).select("doc", "sum", "start"))
    single = twins.groupBy("doc", "sum").agg(F.collect_list("start").alias("single"))
    found = texts.select("doc", "sum", "text").join(sure, ["doc", "sum"], "left").join(single, ["doc", "sum"], "left").filter("sure IS NOT NULL OR single IS NOT NULL")
    result = written(found.mapInArrow(_removal_task(length), "doc long, sum long, n_removed long, n_spans long, kept_sha256 string"), "removed")
    forget(texts, stretches, kinds, windows)
    return result


def repeat_report(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)``, one row per document."""
    text = F.coalesce("text", F.lit(""))
    check = F.crc32(text.cast("binary")).bitwiseAND(0x7FFFFFFF)
    # Rows may lack an id or repeat one, so a text is known by 64 bits of both and 31 of a check sum.
    doc = F.xxhash64("doc_id", text).alias("doc")
    base = docs.select("doc_id", doc, check.alias("sum"), F.octet_length(text).cast("long").alias("n_bytes"), F.md5(text.cast("binary")).alias("digest"), F.sha2(text, 256).alias("own_sha"))
    base = written(base, "base")
    equals = written(base.groupBy("digest").agg(F.count(F.lit(1)).alias("n_equal"), F.min(F.struct("doc", "sum")).alias("one")), "equals")
    firsts = equals.select("one.doc", "one.sum").distinct()
    texts = docs.select(doc, check.alias("sum"), F.col("text"))
    lost = repeats(texts, firsts, length)
    out = base.join(equals.select("digest", "n_equal"), "digest").join(lost, ["doc", "sum"], "left")
    whole = (F.col("n_equal") > 1) & (F.col("n_bytes") >= length)
    nothing = hashlib.sha256(b"").hexdigest()
    return out.select(
        "doc_id", "n_bytes", F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, nothing).otherwise(F.coalesce("kept_sha256", "own_sha")).alias("kept_sha256"),
    )
