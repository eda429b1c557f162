"""Phrase collocations by stripes.

A stripe belongs to a prefix of words and counts, per next word, how often that word follows it in
a piece of text; next words that cannot make a frequent phrase are left out. Tasks build stripes of their texts in numpy, Spark adds
them up element by element: cells are combined before the shuffle and keyed by prefix and next word,
so a stripe of a very common prefix is never in one place. The merged stripes give

* extensions: the frequencies of phrases one word longer,
* prefix totals: the frequency of a prefix is the counter of its last word in the stripe of the words before,
* subsumption maxima: the most frequent extension of a phrase, to the right by its own stripe and to
  the left by the cells that end with it.

A phrase is frequent only if all its parts are, so three passes over the texts do. The first counts words,
as the stripe of the empty prefix. The second deals the pairs and triples of frequent words to ``BUCKETS``
hash buckets each and counts these; a pair or triple in a bucket of fewer than ``least`` cannot be frequent. The
third builds the stripes of all longer phrases whose words, pairs and triples may be frequent. Filters are
bitmaps of fixed size whatever the corpus; their false hits cost work and change no result, since counts are
complete for every frequent phrase. Phrases are strings all the way: no hash stands for one in a result.

A frequency never grows with length, so a phrase lies inside an equally frequent longer one exactly
if one word more, left or right, already gives such a phrase.

Null texts count as empty, a null lang as ``und``; repeated rows count as often as they occur. Rows
without an id count as well. Very long texts are worked on in blocks cut between pieces. Ties in the
order of phrases cannot happen, since phrases are distinct. An empty table gives no rows; extra
columns are not looked at.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lineagespark.llm.common import forget, parts, written

LEAST, LONGEST, TOP = 100, 5, 2000
#: Bytes of text that a task cuts into words at a time, words whose stripes it builds together, words of a vocabulary.
BLOCK, TOGETHER, VOCABULARY = 1 << 22, 1 << 22, 500_000
#: Bits of the filter of words; hash buckets for pairs and for triples, and how many of them are merged together.
FILTER_BITS, BUCKETS, CHUNK = 1 << 27, 1 << 27, 1 << 14
#: Bits per frequent word while the filter is smaller; bucket numbers that a task gathers before it counts them.
BITS_PER_WORD, GATHERED = 32, 1 << 23

#: A-Z become lower case, all piece separators a full stop.
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz.........")
_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _hash(word: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")


def _phrase_hash(lang: str, words: list[np.ndarray]) -> np.ndarray:
    """A hash per phrase; ``words`` holds the word hashes of all first words, all second words and so on."""
    value = np.full(len(words[0]), _hash(lang.encode("utf-8", "surrogatepass")), np.uint64)
    for w in words:
        value = _mix(value * _STEP + w)
    return value


# -- filters ------------------------------------------------------------------------------------


class Sieve:
    """Which phrases may be frequent: bits set at one or several places a phrase."""

    def __init__(self, words: np.ndarray, places):
        self.words, self.places = words, places

    def passes(self, value: np.ndarray) -> np.ndarray:
        found = np.ones(len(value), bool)
        for place in self.places(value):
            found &= (self.words[(place >> _U(3)).astype(np.int64)] >> (place & _U(7)).astype(np.uint8)) & 1 == 1
        return found


class TwoPlaces:
    """A Bloom filter's two places of a hash among ``bits``."""

    def __init__(self, bits: int):
        self.mask = _U(bits - 1)

    def __call__(self, value: np.ndarray) -> list[np.ndarray]:
        return [value & self.mask, (value >> _U(32)) * _U(0x9E3779B1) & self.mask]


def bucket_of(value: np.ndarray) -> list[np.ndarray]:
    """The one hash bucket of a phrase."""
    return [value & _U(BUCKETS - 1)]


def word_sieve(words: DataFrame) -> Sieve:
    """The filter of the frequent words ``(lang, phrase)``; at most FILTER_BITS / 32 numbers come to the driver."""
    bits = 1 << 12
    while bits < FILTER_BITS and bits < BITS_PER_WORD * words.count():
        bits *= 2
    places_of = TwoPlaces(bits)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True)
            value = [_phrase_hash(lang, [np.array([_hash(w)], np.uint64)]) for lang, w in rows]
            places = np.concatenate([*places_of(np.concatenate(value)), np.zeros(0, np.uint64)]) if value else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array((places >> _U(5)).astype(np.int32)), pa.array((_U(1) << (places & _U(31))).astype(np.int64))], names=["word", "bits"])

    rows = words.select("lang", "phrase").mapInArrow(mark, "word int, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toPandas()
    found = np.zeros(bits // 32, np.uint32)
    found[rows["word"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64).astype(np.uint32)
    return Sieve(found.view(np.uint8), places_of)


def _packed(places: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted places and their counts, small: steps in bytes, 255 for a step that goes on."""
    steps = np.diff(places, prepend=0)
    size = steps // 255 + 1
    out = np.full(int(size.sum()), 255, np.uint8)
    out[np.cumsum(size) - 1] = steps % 255
    return len(out).to_bytes(4, "little") + zlib.compress(out.tobytes() + np.minimum(counts, 65535).astype(np.uint16).tobytes(), 1)


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    size, whole = int.from_bytes(data[:4], "little"), zlib.decompress(data[4:])
    steps = np.frombuffer(whole, np.uint8, size)
    return np.cumsum(steps, dtype=np.int64)[steps < 255], np.frombuffer(whole, np.uint16, offset=size).astype(np.int64)


def _bucket_rows(shared):
    """Counts of the buckets of pairs and triples, chunk by chunk: ``(size, chunk, counts)``."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sieve, gathered = shared.value, {2: [], 3: []}

        def count() -> Iterator[pa.RecordBatch]:
            for size, parts in gathered.items():
                bucket, n = np.unique(np.concatenate([*parts, np.zeros(0, np.uint32)]), return_counts=True)
                parts.clear()
                if not len(bucket):
                    continue
                chunk, place = bucket // CHUNK, (bucket % CHUNK).astype(np.int64)
                start = np.flatnonzero(np.concatenate([[True], chunk[1:] != chunk[:-1]]))
                cells = [_packed(place[i:j], n[i:j]) for i, j in zip(start, np.append(start[1:], len(chunk)), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array([size] * len(start), pa.int32()), pa.array(chunk[start].astype(np.int32)), pa.array(cells, pa.binary())], names=["size", "chunk", "counts"])

        for lang, number, vocabulary in _numbered(batches):
            hashes = vocabulary.hashed()
            good = np.zeros(len(hashes), bool)
            good[1:] = sieve.passes(_phrase_hash(lang, [hashes[1:]]))
            inside = np.append(good[number], [False, False, False])
            hashes = np.append(hashes[number], np.zeros(3, np.uint64))
            for size, parts in gathered.items():
                end = len(inside) - 3
                at = np.flatnonzero(np.logical_and.reduce([inside[i : end + i] for i in range(size)]))
                parts.append(bucket_of(_phrase_hash(lang, [hashes[at + i] for i in range(size)]))[0].astype(np.uint32))
            if sum(map(len, gathered[2])) >= GATHERED:
                yield from count()
        yield from count()

    return task


def _bitmaps(least: int):
    """Rows sorted by (size, chunk) to the bitmap of each chunk."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, total = None, np.zeros(CHUNK, np.int64)

        def bitmap():
            bits = np.packbits(total >= min(least, 65535), bitorder="little").tobytes()
            return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()), pa.array([bits], pa.binary())], names=["size", "chunk", "bits"])

        for batch in batches:
            for size, chunk, counts in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if key != (size, chunk):
                    if key is not None:
                        yield bitmap()
                    key, total = (size, chunk), np.zeros(CHUNK, np.int64)
                place, n = _unpacked(counts)
                total[place] += n
        if key is not None:
            yield bitmap()

    return task


def phrase_sieves(texts: DataFrame, words: Sieve, least: int) -> dict[int, Sieve]:
    """The filters of words, pairs and triples; the bitmaps, BUCKETS / 8 bytes each at most, come to the driver."""
    spark = texts.sparkSession
    rows = texts.mapInArrow(_bucket_rows(spark.sparkContext.broadcast(words)), "size int, chunk int, counts binary")
    dealt = rows.repartition(parts(spark), "size", "chunk").sortWithinPartitions("size", "chunk")
    found = {size: np.zeros(BUCKETS // 8, np.uint8) for size in (2, 3)}
    for row in dealt.mapInArrow(_bitmaps(least), "size int, chunk int, bits binary").toLocalIterator(prefetchPartitions=True):
        found[row["size"]][row["chunk"] * (CHUNK // 8) :][: CHUNK // 8] = np.frombuffer(row["bits"], np.uint8)
    return {1: words} | {size: Sieve(bits, bucket_of) for size, bits in found.items()}


# -- stripes of a task ----------------------------------------------------------------------------


class Vocabulary(dict):
    """Numbers for words as they come; 0 is the end of a piece."""

    def __init__(self):
        super().__init__({b".": 0})
        self.words, self.hashes = [b"."], np.zeros(0, np.uint64)

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.words)
        self.words.append(word)
        return number

    def hashed(self) -> np.ndarray:
        new = [_hash(w) for w in self.words[len(self.hashes) :]]
        self.hashes = np.concatenate([self.hashes, np.array(new, np.uint64)])
        return self.hashes


def stripes_of(number: np.ndarray, vocabulary: Vocabulary, at: np.ndarray, short: int, follows: np.ndarray):
    """``(prefixes, offsets, nexts, counts)``: the stripes of the prefixes of ``short`` words at places ``at`` with the next words ``follows``."""
    # Prefixes are numbered by what they are: word by word, pairs of numbers get a number.
    code = number[at] if short else np.zeros(len(at), np.int64)
    for i in range(1, short):
        code = np.unique(code << 32 | number[at + i], return_inverse=True)[1]
    cell, first, counts = np.unique(code << 32 | follows, return_index=True, return_counts=True)
    start = np.flatnonzero(np.concatenate([[True], (cell[1:] >> 32) != (cell[:-1] >> 32)])) if len(cell) else np.zeros(0, np.int64)
    words = vocabulary.words
    prefixes = [b" ".join([words[w] for w in number[p : p + short].tolist()]) for p in at[first[start]].tolist()]
    nexts = [words[w] for w in (cell & 0xFFFFFFFF).tolist()]
    return prefixes, np.append(start, len(cell)), nexts, counts


def stripes_by_length(number: np.ndarray, vocabulary: Vocabulary, lang: str, longest: int, sieves: dict[int, Sieve] | None):
    """The stripes of a sequence of words: of the empty prefix without ``sieves``, else of prefixes of one word to ``longest - 1``."""
    number = np.append(number, np.zeros(longest, np.int64))
    end = len(number) - longest
    if sieves is None:
        at = np.flatnonzero(number > 0)
        yield 1, stripes_of(number, vocabulary, at, 0, number[at])
        return
    hashes = vocabulary.hashed()
    known = np.zeros(len(hashes), bool)
    known[1:] = sieves[1].passes(_phrase_hash(lang, [hashes[1:]]))
    hashes = hashes[number]
    # good[i]: the phrase of so many words that starts at i may be frequent.
    good = known[number]
    for length in range(2, longest + 1):
        longer = good & np.append(good[1:], False)
        if length in sieves:
            asked = np.flatnonzero(longer[:end])
            longer = np.zeros(len(good), bool)
            longer[asked[sieves[length].passes(_phrase_hash(lang, [hashes[asked + i] for i in range(length)]))]] = True
        at = np.flatnonzero(longer[:end])
        yield length, stripes_of(number, vocabulary, at, length - 1, number[at + length - 1])
        good = longer


def _blocks(text: bytes) -> Iterator[bytes]:
    """A folded text in blocks that end between pieces."""
    start = 0
    while len(text) - start > BLOCK:
        cut = text.find(b".", start + BLOCK)
        if cut < 0:
            break
        yield text[start:cut]
        start = cut
    yield text[start:] if start else text


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, np.ndarray, Vocabulary]]:
    """Texts ``(lang, text)`` as sequences of numbered words of one lang, with the vocabulary that the numbers refer to."""
    vocabulary, waiting, held, numbers, words = Vocabulary(), {}, 0, {}, 0

    def number() -> int:
        many = 0
        for lang, parts in waiting.items():
            found = b" . ".join([*parts, b""]).replace(b".", b" . ").split()
            numbers.setdefault(lang, []).append(np.fromiter(map(vocabulary.__getitem__, found), np.int32, len(found)))
            many += len(found)
        waiting.clear()
        return many

    def ready() -> Iterator[tuple[str, np.ndarray, Vocabulary]]:
        for lang in list(numbers):
            yield lang, np.concatenate(numbers.pop(lang)).astype(np.int64), vocabulary

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
            for part in _blocks((text.as_py() or b"").translate(_FOLD)):
                waiting.setdefault(lang, []).append(part)
                held += len(part)
                if held >= BLOCK:
                    words, held = words + number(), 0
                    if words >= TOGETHER or len(vocabulary) > VOCABULARY:
                        yield from ready()
                        words = 0
                        if len(vocabulary) > VOCABULARY:
                            vocabulary = Vocabulary()
    number()
    yield from ready()


def _stripe_rows(longest: int, shared):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text = lambda values: pa.array(values, pa.binary()).cast(pa.string())
        for lang, number, vocabulary in _numbered(batches):
            for length, (prefixes, offsets, nexts, counts) in stripes_by_length(number, vocabulary, lang, longest, shared.value if shared is not None else None):
                cells = pa.MapArray.from_arrays(pa.array(offsets, pa.int32()), text(nexts), pa.array(counts, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(prefixes), pa.string()), pa.array([length] * len(prefixes), pa.int32()), text(prefixes), cells], names=["lang", "size", "prefix", "stripe"]
                )

    return task


# -- corpus ----------------------------------------------------------------------------------------


def merged_stripes(texts: DataFrame, longest: int, sieves: dict[int, Sieve] | None) -> DataFrame:
    """``(lang, size, prefix, next, n)``: the stripes of all texts ``(lang, text)``, a row a cell, as a written table.

    ``size`` is the length of prefix and next word together."""
    shared = texts.sparkSession.sparkContext.broadcast(sieves) if sieves is not None else None
    rows = texts.mapInArrow(_stripe_rows(longest, shared), "lang string, size int, prefix string, stripe map<string,bigint>")
    cells = rows.select("lang", "size", "prefix", F.explode("stripe").alias("next", "n"))
    return written(cells.groupBy("lang", "size", "prefix", "next").agg(F.sum("n").alias("n")), "stripes")


def count_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """``words(lang, n)`` and ``phrases(lang, phrase, size, first, rest, n)``: all frequent ones from one word on, ``first`` and
    ``rest`` without the last and the first word."""
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").filter("text IS NOT NULL")
    single = merged_stripes(texts, 1, None)
    words = written(single.groupBy("lang").agg(F.sum("n").alias("n")), "words")
    single = single.filter(F.col("n") >= least)
    sieve = word_sieve(single.select("lang", F.col("next").alias("phrase")))
    cells = merged_stripes(texts, longest, phrase_sieves(texts, sieve, least))
    longer = cells.filter(F.col("n") >= least).select("lang", F.concat_ws(" ", "prefix", "next").alias("phrase"), "size", F.col("prefix").alias("first"), "n")
    longer = longer.select("lang", "phrase", "size", "first", F.expr("substring(phrase, instr(phrase, ' ') + 1)").alias("rest"), "n")
    none = F.lit(None).cast("string")
    phrases = written(longer.unionByName(single.select("lang", F.col("next").alias("phrase"), F.lit(1).alias("size"), none.alias("first"), none.alias("rest"), "n")), "phrases")
    forget(single, cells)
    return words, phrases


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the best ``top`` phrases of each lang."""
    words, every = count_phrases(docs, least, longest)
    phrases = every.filter("size > 1")
    # Left and right extensions that are as frequent make a phrase part of a longer one.
    left = phrases.filter("size > 2").groupBy("lang", F.col("rest").alias("phrase")).agg(F.max("n").alias("left"))
    right = phrases.filter("size > 2").groupBy("lang", F.col("first").alias("phrase")).agg(F.max("n").alias("right"))
    whole = phrases.select("lang", "phrase", "size", F.col("n").alias("a")).join(left, ["lang", "phrase"], "left").join(right, ["lang", "phrase"], "left")
    kept = whole.filter(F.coalesce(F.greatest("left", "right"), F.lit(0)) < F.col("a")).select("lang", "phrase", "size", "a")
    # Every cut of a phrase into two parts; parts are frequent phrases themselves.
    split = F.split("phrase", " ")
    cut = kept.select("lang", "phrase", "a", "size", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    joined = lambda a, b: F.array_join(F.slice(split, a, b), " ")
    cut = cut.select("lang", "phrase", "a", "k", joined(F.lit(1), F.col("k")).alias("p"), joined(F.col("k") + 1, F.col("size") - F.col("k")).alias("q"))
    of = lambda part, name: every.select("lang", F.col("phrase").alias(part), F.col("n").alias(name))
    cut = cut.join(of("p", "l"), ["lang", "p"]).join(of("q", "r"), ["lang", "q"]).join(words, "lang")
    big = lambda c: f"cast({c} AS decimal(19,0))"
    score = F.expr(f"(cast(1000 AS decimal(4,0)) * {big('a')} * {big('n')}) div ({big('l')} * {big('r')})")
    best = cut.withColumn("score", score).groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("c"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    found = best.select("lang", "phrase", "a", F.col("c.l").alias("l"), F.col("c.r").alias("r"), "n", F.col("c.score").alias("score"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
