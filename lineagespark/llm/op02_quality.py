"""Quality rules: characters inside repeated n-grams and lines.

Each text is one row and one unit of work; nothing is shuffled. Words become 64-bit numbers,
an n-gram is a window of a rolling polynomial hash over them, and a mask over words marks what
repeated windows cover, so overlapping repeats count once. The base counts use exact word
numbers instead of hashes.

Nulls, empty texts and texts of white space have no words: they fail the base rule. Repeated
rows and rows without an id are judged alone. Extra columns of the table stay as they are.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StringType, StructField, StructType

#: Bounds as (for long texts, most for any text); see ``bound``.
#: Most characters (share of word characters) that the commonest n-gram may take.
TOP_SHARE = {2: (0.20, 0.30), 3: (0.18, 0.28), 4: (0.16, 0.26)}
#: Most characters inside n-grams that occur more than once.
REPEATED_SHARE = {5: (0.15, 0.40), 6: (0.14, 0.39), 7: (0.13, 0.38), 8: (0.12, 0.37), 9: (0.11, 0.36), 10: (0.10, 0.35)}
#: Most lines, and most characters in lines, that repeat an earlier line.
LINE_SHARE, LINE_CHAR_SHARE = (0.30, 0.50), (0.20, 0.30)
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

SCHEMA = StructType([
    *[StructField(c, LongType()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")], StructField("base_failed", BooleanType()),
    *[StructField(c, DoubleType()) for c in ("top_share", "repeated_share", "dup_line_share", "dup_line_char_share")], StructField("kept", BooleanType()), StructField("reason", StringType()),
])
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SYMBOLS = re.compile(r"[#*$%&|<>]")


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit number per word number, with all bits mixed."""
    x = (x.astype(np.uint64) + np.uint64(1)) * _BASE
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def rolling(values: np.ndarray, n: int, prefix: np.ndarray, powers: np.ndarray) -> np.ndarray:
    """Hash of every window of ``n`` values, from prefix sums of value * base ** (last - i)."""
    size = len(values)
    if size < n:
        return np.zeros(0, np.uint64)
    return (prefix[n:] - prefix[:-n]) * powers[: size - n + 1]


def prefix_sums(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    size = len(values)
    powers = np.ones(size + 1, np.uint64)
    powers[1:] = _BASE
    powers = np.multiply.accumulate(powers)
    prefix = np.zeros(size + 1, np.uint64)
    np.cumsum(values * powers[:size][::-1], out=prefix[1:])
    return prefix, powers


def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, times it occurs) of every key."""
    _, number, times = np.unique(keys, return_inverse=True, return_counts=True)
    return number, times


def _covered(starts: np.ndarray, n: int, size: int) -> np.ndarray:
    """Mask of the words inside the windows of ``n`` words at ``starts``."""
    edge = np.zeros(size + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + n, -1)
    return np.cumsum(edge[:-1]) > 0


def _top_share(number: np.ndarray, times: np.ndarray, n: int, ends: np.ndarray, total: int) -> float:
    """Largest share of characters that the occurrences of one repeated n-gram cover."""
    worth = np.zeros(len(times), np.int64)
    np.add.at(worth, number, ends[n:] - ends[: len(ends) - n])
    worth[times < 2] = 0
    return min(1.0, float(worth.max(initial=0)) / total)


#: Words of a line of boilerplate and its first repeat, together, which every text may hold besides its share.
LINE_TWICE = 28


def bound(shares: tuple[float, float], size: int) -> float:
    """The bound of a text of ``size`` words: the share of long texts and ``LINE_TWICE`` words more, up to the most for any text.

    One line said twice is much of a short text and little of a long one.
    """
    long, most = shares
    return min(most, long + LINE_TWICE / max(size, 1))


def measure(text: str | None) -> tuple:
    """All counts and shares of one text, in the order of ``SCHEMA``."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    size = len(words)
    symbols = len(_SYMBOLS.findall(text))
    seen: set[bytes] = set()
    lines = line_chars = dup_lines = dup_line_chars = 0
    for line in raw.split(b"\n"):
        if line.strip():
            lines += 1
            line_chars += len(line)
            if line in seen:
                dup_lines += 1
                dup_line_chars += len(line)
            seen.add(line)
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, size)
    lengths = np.fromiter((len(w.decode("utf-8", "surrogatepass")) for w in numbers), np.int64, len(numbers))
    chars = lengths[ids] if size else np.zeros(0, np.int64)
    total = int(chars.sum())
    repeat = 0
    if size >= 3:
        pair, _ = _groups(ids[:-1] * len(numbers) + ids[1:])
        number, times = _groups(pair[:-1] * len(numbers) + ids[2:])
        repeat = int(_covered(np.flatnonzero(times[number] > 1), 3, size).sum())
    failed = size < MIN_WORDS or 100 * repeat > MAX_REPEAT_PERCENT * size
    top = repeated = 0.0
    reasons = ["base"] if failed else []
    if total:
        values = _mixed(ids)
        ends = np.concatenate([[0], np.cumsum(chars)])
        prefix, powers = prefix_sums(values)
        for n, most in TOP_SHARE.items():
            keys = rolling(values, n, prefix, powers)
            share = _top_share(*_groups(keys), n, ends, total) if len(keys) else 0.0
            top = max(top, share)
            if share > bound(most, size):
                reasons.append(f"top_{n}")
        for n, most in REPEATED_SHARE.items():
            keys = rolling(values, n, prefix, powers)
            if not len(keys):
                continue
            order = np.sort(keys)
            if not (order[1:] == order[:-1]).any():
                break  # a longer repeat would hold a repeat of this length
            number, times = _groups(keys)
            share = int(chars[_covered(np.flatnonzero(times[number] > 1), n, size)].sum()) / total
            repeated = max(repeated, share)
            if share > bound(most, size):
                reasons.append(f"repeated_{n}")
    by_line, by_char = (dup_lines / lines, dup_line_chars / line_chars) if lines else (0.0, 0.0)
    if by_line > bound(LINE_SHARE, size):
        reasons.append("lines")
    if by_char > bound(LINE_CHAR_SHARE, size):
        reasons.append("line_chars")
    return size, total, symbols, dup_lines, repeat, failed, top, repeated, by_line, by_char, not reasons, reasons[0] if reasons else None


@F.pandas_udf(SCHEMA)
def _measured(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([measure(t) for t in texts], columns=SCHEMA.names)


def quality(text: Column) -> Column:
    """A struct of the counts, shares and the verdict of a text column."""
    return _measured(text)


def quality_report(docs: DataFrame) -> DataFrame:
    """``doc_id`` and every count, share and verdict, one row per document."""
    return docs.select("doc_id", quality(F.col("text")).alias("_q")).select("doc_id", "_q.*")


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that no rule rejects, with all their columns."""
    return docs.filter(quality(docs["text"])["kept"])
