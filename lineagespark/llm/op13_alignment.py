"""Alignment of two tokenizers' tokens by white-space anchors.

Every text is tokenized whole by a byte-level BPE (A, space before the text) and by a sentencepiece
model (B, which adds the space). An anchor is a byte offset where tokens of both end, as their summed
lengths verify, and where both next tokens are marked by a space; anchors cut a document into windows
of token ids. Equal windows align alike, so a task aligns a window once and keeps the alignment under
the two tuples of ids; documents are put together from windows.

The corpus-wide count of a pair of ids is the number of its links. Documents keep their distinct pairs
with multiplicities in a written table; pair counts are partial sums. The most frequent pairs, at
most ``HEAD``, go to all tasks as two sorted arrays and settle nearly all links; the links of all other
pairs are joined on Spark, pair by pair. So both ways together cover every link, and what is sent
out does not grow with the data.

Null and empty texts, and texts whose tokens do not spell the text, have zeros and the digest ``''``.
Rows are judged alone: a repeated row counts as often as it occurs. Texts are worked on in blocks
of ``BLOCK`` bytes or one text, if that is longer. An empty table gives no rows; extra columns are not looked
at.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineagespark.llm.common import written

TOKENIZERS = "/opt/tokenizers"
BYTE_BPE, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Bytes of text that a task works on at a time, and windows whose alignment it keeps.
BLOCK, MEMO = 1 << 21, 400_000
#: Pairs that are sent to all tasks, and bins per doubling of the histogram that chooses them.
HEAD, BINS = 1 << 20, 8

# Fixed value: how this byte-level BPE cuts a text before merging.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SPACE_MARK = "▁"
ALIGNED = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>"

_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)


def byte_level() -> dict[str, int]:
    """The characters that stand for bytes: printable ones for themselves, the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(moved)}


class Tokens:
    """The bytes of every id of a vocabulary, with their lengths and whether a space comes first."""

    def __init__(self, spelled: list[bytes]):
        self.spelled = spelled
        self.sizes = [len(s) for s in spelled]
        self.length = np.array(self.sizes, np.int64)
        self.spaced = np.array([s[:1] == b" " for s in spelled], bool)


class Tokenizers:
    """Both tokenizers of a folder and the bytes of their tokens."""

    def __init__(self, folder: str):
        import sentencepiece
        import tiktoken

        with open(f"{folder}/{BYTE_BPE}", encoding="utf-8") as f:
            saved = json.load(f)
        special = {t["content"] for t in saved["added_tokens"]}
        code = byte_level()
        ranks = {bytes(code[c] for c in token): i for token, i in saved["model"]["vocab"].items() if token not in special}
        # Ids follow the order of merges, so they serve as ranks; the special strings are plain text.
        self.bpe = tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        spelled = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            spelled[i] = token
        self.a = Tokens(spelled)
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=f"{folder}/{PIECES}")
        size = self.pieces.get_piece_size()
        piece = lambda i: bytes([int(self.pieces.id_to_piece(i)[1:-1], 16)]) if self.pieces.is_byte(i) else self.pieces.id_to_piece(i).replace(SPACE_MARK, " ").encode()
        self.b = Tokens([piece(i) for i in range(size)])
        # Ids as text, alone and behind the bar of a group.
        self.names = [str(i) for i in range(max(len(spelled), size))]
        self.behind = ["|" + n for n in self.names]
        #: A pair of ids is one number: a * 2**bits + b.
        self.bits = max(1, (size - 1).bit_length())

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        return self.bpe.encode_ordinary_batch([" " + t for t in texts], num_threads=1), self.pieces.encode(texts, num_threads=1)


@lru_cache(maxsize=1)
def tokenizers(folder: str) -> Tokenizers:
    return Tokenizers(folder)


# -- windows ------------------------------------------------------------------------------------


def align(a: list[int], b: list[int], known: Tokenizers) -> tuple[str, int, bytes]:
    """``(groups, number of groups, linked pairs)`` of one window; the pairs as the bytes of 64-bit numbers."""
    if len(a) == 1 or len(b) == 1:
        # One token against all: the window ends where both do, and inside one side has no end.
        return ",".join(map(str, a)) + "|" + ",".join(map(str, b)), 1, array("q", [x << known.bits | y for x in a for y in b]).tobytes()
    size_a, size_b, names, behind = known.a.sizes, known.b.sizes, known.names, known.behind
    pairs, groups, i, j, left, right = [], [], 0, 0, 0, 0
    end_a, end_b = size_a[a[0]], size_b[b[0]]
    while True:
        pairs.append(a[i] << known.bits | b[j])
        if end_a < end_b:
            i += 1
            end_a += size_a[a[i]]
        elif end_b < end_a:
            j += 1
            end_b += size_b[b[j]]
        else:
            i, j = i + 1, j + 1
            if i - left == j - right == 1:
                groups.append(names[a[left]] + behind[b[right]])
            else:
                groups.append(",".join([names[x] for x in a[left:i]]) + "|" + ",".join([names[x] for x in b[right:j]]))
            if i == len(a):
                return ";".join(groups), len(groups), array("q", pairs).tobytes()
            left, right = i, j
            end_a += size_a[a[i]]
            end_b += size_b[b[j]]


def _window_hash(ids: np.ndarray, start: np.ndarray) -> np.ndarray:
    place = np.arange(len(ids)) - np.repeat(start, np.diff(np.append(start, len(ids))))
    x = (ids.astype(np.uint64) + _U(1)) * _STEP + (place.astype(np.uint64) + _U(1)) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return np.add.reduceat(x ^ (x >> _U(31)), start)


def _agrees(ids: np.ndarray, start: np.ndarray, model: np.ndarray) -> bool:
    """Whether every window has the ids of its model window."""
    size = np.diff(np.append(start, len(ids)))
    if not np.array_equal(size, size[model]):
        return False
    place = np.arange(len(ids)) - np.repeat(start, size)
    return np.array_equal(ids, ids[np.repeat(start[model], size) + place])


class Aligner:
    """Aligns blocks of texts and keeps the alignments of windows."""

    def __init__(self, known: Tokenizers, memo: int = MEMO):
        self.known, self.limit = known, memo
        self.memo: dict[tuple, tuple[str, int, bytes]] = {}

    def _window(self, a: list[int], b: list[int]) -> tuple[str, int, bytes]:
        key = (*a, -1, *b)
        found = self.memo.get(key)
        if found is None:
            if len(self.memo) >= self.limit:
                self.memo.clear()
            found = self.memo[key] = align(a, b, self.known)
        return found

    def block(self, texts: list[str]) -> list[tuple]:
        """``(n_a, n_b, n_groups, n_links, digest, pairs, times)`` of every text."""
        none = (0, 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int32))
        out, known = [none] * len(texts), self.known
        rows, first, second, size = [], [], [], []
        for row, (text, x, y) in enumerate(zip(texts, *known.encode(texts), strict=True)):
            whole = b" " + text.encode("utf-8", "surrogatepass")
            if text and b"".join(map(known.a.spelled.__getitem__, x)) == whole and b"".join(map(known.b.spelled.__getitem__, y)) == whole:
                rows.append(row)
                size.append(len(whole))
                first.append(np.array(x, np.int64))
                second.append(np.array(y, np.int64))
        if not rows:
            return out
        a, b = np.concatenate(first), np.concatenate(second)
        ends_a, ends_b = np.cumsum(known.a.length[a]), np.cumsum(known.b.length[b])
        at = np.searchsorted(ends_b, ends_a)
        shared = np.flatnonzero(ends_b[np.minimum(at, len(b) - 1)] == ends_a)
        stop_a, stop_b = shared + 1, at[shared] + 1
        opens = known.a.spaced[np.append(a, 0)[stop_a]] & known.b.spaced[np.append(b, 0)[stop_b]]
        last = np.isin(ends_a[shared], np.cumsum(size), assume_unique=True)
        cut = opens | last
        start_a, start_b = np.append(0, stop_a[cut][:-1]), np.append(0, stop_b[cut][:-1])
        doc = np.append(0, np.cumsum(last[cut])[:-1])
        value = _window_hash(a, start_a) * _STEP ^ _window_hash(b, start_b)
        _, model, kind = np.unique(value, return_index=True, return_inverse=True)
        if not (_agrees(a, start_a, model[kind]) and _agrees(b, start_b, model[kind])):
            model = kind = np.arange(len(start_a))  # two windows with one hash: take each by itself
        list_a, list_b, stop_a, stop_b = a.tolist(), b.tolist(), np.append(start_a[1:], len(a)), np.append(start_b[1:], len(b))
        found = [self._window(list_a[i:j], list_b[k:m]) for i, j, k, m in zip(*(x[model].tolist() for x in (start_a, stop_a, start_b, stop_b)), strict=True)]
        texts_of, links = [f[0] for f in found], np.array([len(f[2]) for f in found], np.int64) // 8
        flat, offset = np.frombuffer(b"".join([f[2] for f in found]), np.int64), np.append(0, np.cumsum(links))[:-1]
        # All links of the block: which document, which pair.
        many = links[kind]
        place = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        pair = flat[np.repeat(offset[kind], many) + place]
        in_doc, n_links = np.repeat(doc, many), np.bincount(doc, many, len(rows)).astype(np.int64)
        n_groups = np.bincount(doc, np.array([f[1] for f in found])[kind], len(rows)).astype(np.int64)
        order = np.argsort(in_doc << 40 | pair) if int(pair.max()) < 1 << 40 and len(rows) < 1 << 22 else np.lexsort((pair, in_doc))
        pair, in_doc = pair[order], in_doc[order]
        fresh = np.flatnonzero(np.concatenate([[True], (pair[1:] != pair[:-1]) | (in_doc[1:] != in_doc[:-1])]))
        times = np.diff(np.append(fresh, len(pair))).astype(np.int32)
        bounds = np.searchsorted(in_doc[fresh], np.arange(len(rows) + 1))
        windows = np.searchsorted(doc, np.arange(len(rows) + 1))
        for i, row in enumerate(rows):
            text = ";".join([texts_of[k] for k in kind[windows[i] : windows[i + 1]].tolist()])
            mine = slice(bounds[i], bounds[i + 1])
            out[row] = (len(first[i]), len(second[i]), int(n_groups[i]), int(n_links[i]), hashlib.sha256(text.encode()).hexdigest(), pair[fresh[mine]], times[mine])
        return out


def _lists(values: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    offsets = np.append(0, np.cumsum([len(v) for v in values]))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate([*values, np.zeros(0, np.int64)]), kind))


def aligned_rows(docs: DataFrame, folder: str = TOKENIZERS, block: int = BLOCK, memo: int = MEMO) -> DataFrame:
    """The columns of ``ALIGNED``, a row a document; ``row`` tells rows apart. To be written before use."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, number = Aligner(tokenizers(folder), memo), TaskContext.get().partitionId() << 40
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            start = 0
            while start < len(ids):
                stop = max(start + 1, int(np.searchsorted(sizes, (sizes[start - 1] if start else 0) + block, "right")))
                found = aligner.block([t or "" for t in texts[start:stop].to_pylist()])
                column = lambda i: pa.array([f[i] for f in found], pa.int64())  # noqa: E731, B023
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(number, number + len(found)), pa.int64()), ids[start:stop], *map(column, range(4)), pa.array([f[4] for f in found], pa.string()),
                     _lists([f[5] for f in found], pa.int64()), _lists([f[6] for f in found], pa.int32())],
                    names=[c.split()[0] for c in ALIGNED.split(", ")],
                )
                number, start = number + len(found), stop

    return docs.select("doc_id", "text").mapInArrow(task, ALIGNED)


# -- corpus counts ----------------------------------------------------------------------------------


def pair_counts(aligned: DataFrame, folder: str = TOKENIZERS) -> DataFrame:
    """``(pair, n, best)``: the links of every pair of ids, and whether no other pair of its B id has more."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pair, kind = np.unique(batch.column(0).flatten().to_numpy(zero_copy_only=False), return_inverse=True)
            n = np.bincount(kind, batch.column(1).flatten().to_numpy(zero_copy_only=False), len(pair)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pair, pa.int64()), pa.array(n)], names=["pair", "n"])

    counts = aligned.select("pairs", "times").mapInArrow(add, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = written(counts.withColumn("b", F.col("pair").bitwiseAND(F.lit((1 << tokenizers(folder).bits) - 1))), "pairs")
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    return counts.join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _head(counts: DataFrame, head: int) -> tuple[float, bool]:
    """The least count of the pairs that go to all tasks, at most ``head`` of them, and whether these are all."""
    size = F.floor(F.log2("n") * BINS)
    bins = sorted(((r["bin"], r["low"], r["pairs"]) for r in counts.groupBy(size.alias("bin")).agg(F.min("n").alias("low"), F.count(F.lit(1)).alias("pairs")).collect()), reverse=True)
    total, least = 0, float("inf")
    for _, low, pairs in bins:
        if total + pairs > head:
            return least, False
        total, least = total + pairs, low
    return least, True


def cross_alignment(docs: DataFrame, folder: str = TOKENIZERS, head: int = HEAD) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)``, one row per document."""
    spark = docs.sparkSession
    aligned = written(aligned_rows(docs, folder), "aligned")
    counts = written(pair_counts(aligned, folder), "counts")
    least, every = _head(counts, head)
    frequent = counts.filter(F.col("n") >= least).orderBy("pair").toPandas() if least < float("inf") else counts.limit(0).toPandas()
    shared = spark.sparkContext.broadcast((frequent["pair"].to_numpy(np.int64), frequent["n"].to_numpy(np.int64), frequent["best"].to_numpy(bool)))

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n, best = shared.value
        for batch in batches:
            pairs, times = batch.column("pairs"), batch.column("times")
            pair, many = pairs.flatten().to_numpy(zero_copy_only=False), times.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            owner = np.repeat(np.arange(batch.num_rows), pairs.value_lengths().to_numpy(zero_copy_only=False))
            at = np.minimum(np.searchsorted(known, pair), max(len(known) - 1, 0))
            hit = known[at] == pair if len(known) else np.zeros(len(pair), bool)
            # Whole numbers, so sums stay exact whatever their size.
            n_best, count_sum = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            np.add.at(n_best, owner[hit], many[hit] * best[at[hit]])
            np.add.at(count_sum, owner[hit], many[hit] * n[at[hit]])
            offsets = np.append(0, np.cumsum(np.bincount(owner[~hit], minlength=batch.num_rows)))
            left = [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(v)) for v in (pair[~hit], many[~hit])]
            plain = [batch.column(c) for c in ("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")]
            yield pa.RecordBatch.from_arrays([*plain, pa.array(n_best), pa.array(count_sum), *left], names=["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum", "pairs", "times"])

    fields = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long, pairs array<long>, times array<long>"
    settled = aligned.mapInArrow(settle, fields)
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    if every:
        return settled.select(*columns)
    settled = written(settled, "settled")
    rest = settled.filter(F.size("pairs") > 0).select("row", F.inline(F.arrays_zip("pairs", "times"))).withColumnsRenamed({"pairs": "pair", "times": "many"})
    rest = rest.join(counts.filter(F.col("n") < least), "pair").groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("many")).otherwise(0)).alias("more_best"), F.sum(F.col("many") * F.col("n")).alias("more_sum"))
    added = settled.join(rest, "row", "left").na.fill(0, ["more_best", "more_sum"])
    return added.withColumn("n_best", F.col("n_best") + F.col("more_best")).withColumn("count_sum", F.col("count_sum") + F.col("more_sum")).select(*columns)
