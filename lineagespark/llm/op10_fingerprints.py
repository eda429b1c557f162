"""Document fingerprints by order MinHash.

The items of a text are its k-mers of code points, each numbered by how often it has occurred
before. For every hash function the ``PICKED`` items with the smallest values are chosen, put
back into text order and hashed together, so both what a text says and the order it says it in
count, as in an edit distance. The likeness of two texts is the share of functions that agree.

A fingerprint needs one text. Likeness to the next document (descending id, text breaking ties,
rows without an id last, the first after the last) needs neighbours: rows go to ranges of ids,
the first row of each range is also sent to the range before, and a sorted range is streamed
holding two texts at a time. Texts are shuffled once.

Null texts count as empty; texts shorter than k are one item, empty ones none. Equal texts have
equal fingerprints. A single row is its own neighbour; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K, FUNCTIONS, PICKED = 8, 32, 2
#: Numbers worked on at a time: bounds the memory that a very long text takes.
CELLS = 2_000_000
LEAST_ID = -9223372036854775808
SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_SEEDS = _mix(np.arange(1, 4097, dtype=np.uint64) * _STEP)


def items(text: str, k: int = K) -> np.ndarray:
    """A hash per k-mer and occurrence, in text order."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    if not len(points):
        return points
    k = min(k, len(points))
    n = len(points) - k + 1
    value = np.zeros(n, np.uint64)
    for i in range(k):
        value = value * _STEP + points[i : i + n] + _U(1)
    value = _mix(value)
    low = max(1, int(n).bit_length())
    mask = _U((1 << low) - 1)
    # Sorting by value, then place: equal values stand together in text order.
    order = np.sort((value & ~mask) | np.arange(n, dtype=np.uint64))
    same = np.concatenate([[False], (order[1:] & ~mask) == (order[:-1] & ~mask)])
    if same.any():
        index = np.arange(n)
        start = np.maximum.accumulate(np.where(same, 0, index))
        turn = np.zeros(n, np.uint64)
        turn[(order & mask).astype(np.int64)] = (index - start).astype(np.uint64)
        value = _mix(value + turn * _STEP)
    return value


def fingerprint(text: str, k: int = K, functions: int = FUNCTIONS, picked: int = PICKED) -> np.ndarray:
    """One 32-bit number per hash function; zeros for an empty text."""
    value = items(text, k)
    n = len(value)
    out = np.zeros(functions, np.uint64)
    if not n:
        return out.astype(np.uint32)
    take, at_once = min(picked, n), max(1, CELLS // n)
    for start in range(0, functions, at_once):
        seeds = _SEEDS[start : min(functions, start + at_once), None]
        ranks = (value[None, :] ^ seeds) * (seeds | _U(1))
        rows = np.arange(len(seeds))
        chosen = np.empty((len(seeds), take), np.int64)
        for j in range(take):
            chosen[:, j] = ranks.argmin(axis=1)
            ranks[rows, chosen[:, j]] = _U(0xFFFFFFFFFFFFFFFF)
        chosen.sort(axis=1)
        tied = np.zeros(len(seeds), np.uint64)
        for j in range(take):
            tied = _mix(tied * _STEP + value[chosen[:, j]] + _U(j + 1))
        out[start : start + len(seeds)] = tied
    return (out >> _U(32)).astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as many first characters of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _hex(numbers: np.ndarray) -> str:
    return numbers.astype(">u4").tobytes().hex()


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (part, lent, ...): own rows of a part, then what the next part lends it."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
    held = None  # (part, doc_id, text, fingerprint) still without a neighbour
    for batch in batches:
        rows = []
        for part, lent, doc_id, text in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if held is None and lent:
                continue  # further rows lent to this part
            text = text or ""
            own = fingerprint(text)
            if held is not None:
                was = edited(held[2], text)
                other = fingerprint(was)
                rows.append((held[1], len(held[2]), hashlib.sha256(was.encode("utf-8", "surrogatepass")).hexdigest(), _hex(held[3]), _hex(other), likeness(held[3], other), likeness(held[3], own)))
            held = None if lent else (part, doc_id, text, own)
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)
    if held is not None:
        raise ValueError("a range of documents came without its neighbour")


def fingerprints(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """The columns of ``SCHEMA``, one row per document."""
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select("doc_id", "text", F.coalesce("doc_id", F.lit(LEAST_ID)).alias("_key"))
    quantiles = [i / parts for i in range(1, parts)]
    found = rows.agg(F.percentile_approx("_key", quantiles, F.lit(10_000)).alias("b")).first()["b"] if quantiles else []
    bounds = F.array(*[F.lit(b).cast("long") for b in sorted(set(found or []))]).cast("array<bigint>")
    rows = rows.withColumn("_part", F.size(F.filter(bounds, lambda b: b > F.col("_key"))))
    # One row per range, at most ``parts`` of them: which id opens it, and which range borrows that row.
    opens = {r["_part"]: r["k"] for r in rows.groupBy("_part").agg(F.max("_key").alias("k")).collect()}
    order = sorted(opens)
    borrowed = {opens[p]: order[i - 1] for i, p in enumerate(order)}
    lends = F.create_map(*[F.lit(x) for pair in borrowed.items() for x in pair]).cast("map<bigint,int>")
    to = F.try_element_at(lends, F.col("_key"))
    places = F.array(F.struct(F.col("_part").alias("part"), F.lit(0).alias("lent")), F.when(to.isNotNull(), F.struct(to.alias("part"), F.lit(1).alias("lent"))))
    sent = rows.select("doc_id", "_key", "text", F.explode(places).alias("_to")).filter("_to IS NOT NULL")
    sent = sent.select(F.col("_to.part").alias("_part"), F.col("_to.lent").alias("_lent"), "doc_id", "text", "_key")
    ranged = sent.repartitionByRange(parts, "_part").sortWithinPartitions("_part", "_lent", F.desc("_key"), F.asc("text"))
    return ranged.select("_part", "_lent", "doc_id", "text").mapInArrow(_stream, SCHEMA)
