"""Language identification by prediction by partial matching.

Every language has a tree of byte contexts of up to ``ORDER`` bytes with the counts of the byte
that follows. A byte costs -log2 of its share in the longest known context; a context that has
not seen it costs an escape (method C) and the next shorter one is asked. The text belongs to
the language whose frozen statistics give the shortest code.

Words are coded one by one from the space before to the space after them, so a word costs the
same wherever it stands and its code length is worked out once per task. Spark counts the
contexts over the whole texts of a sample of labelled rows (``docs_per_language``), added up
on Spark, so the model that is sent out is bounded too; every text is scored whole.

Null texts and texts without a letter are ``und`` with score 0, and so is everything when there
is nothing to learn from. Ties go to the smallest name. Rows without an id are never learned
from and not held out; repeated rows are judged alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ORDER, DOCS_PER_LANGUAGE = 4, 300
#: Words whose code lengths a task keeps before it starts afresh.
CACHE_WORDS = 300_000
OUT = "lang_pred string, score double"


def coded(text: str) -> list[bytes]:
    """The words of a text as they are coded."""
    return text.lower().encode("utf-8", "surrogatepass").split()


@dataclass
class Model:
    """Frozen statistics, by order: contexts with their escape costs, and context + byte with costs."""

    langs: list[str]
    contexts: list[np.ndarray] = field(default_factory=list)
    escapes: list[np.ndarray] = field(default_factory=list)
    keys: list[np.ndarray] = field(default_factory=list)
    costs: list[np.ndarray] = field(default_factory=list)


def build_model(counts: pd.DataFrame, order: int = ORDER) -> Model:
    """A model from ``counts(lang, size, key, n)``: ``key`` holds ``size`` context bytes and the next byte."""
    langs = sorted(counts["lang"].unique())
    model = Model(langs)
    for o in range(order + 1):
        part = counts[counts["size"] == o]
        key = part["key"].to_numpy(np.uint64)
        keys, row = np.unique(key, return_inverse=True)
        contexts, owner = np.unique(keys >> np.uint64(8), return_inverse=True)
        n = np.zeros((len(keys), len(langs)))
        np.add.at(n, (row, np.searchsorted(langs, part["lang"].to_numpy())), part["n"].to_numpy(float))
        total, kinds = np.zeros((len(contexts), len(langs))), np.zeros((len(contexts), len(langs)))
        np.add.at(total, owner, n)
        np.add.at(kinds, owner, n > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            escape = np.where(kinds > 0, -np.log2(kinds / (total + kinds)), 0.0)
            own = -np.log2(n / (total + kinds)[owner])
        shorter = model.costs[o - 1][np.searchsorted(model.keys[o - 1], keys & np.uint64((1 << 8 * o) - 1))] if o else 8.0
        model.contexts.append(contexts)
        model.escapes.append(escape)
        model.keys.append(keys)
        model.costs.append(np.where(n > 0, own, escape[owner] + shorter))
    return model


def _find(table: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(table, wanted), max(len(table) - 1, 0))
    return at, (table[at] == wanted if len(table) else np.zeros(len(wanted), bool))


def _laid_out(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All words with a space on either side: the bytes, each one's place in its word, where words start, how long they are."""
    data = np.frombuffer(b"".join(b" " + w + b" " for w in words), np.uint8).astype(np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
    return data, np.arange(len(data)) - np.repeat(starts, lengths), starts, lengths


def _keys(data: np.ndarray, at: np.ndarray, order: int) -> np.ndarray:
    """The ``order`` bytes before each place and the byte there, as one number."""
    key = np.zeros(len(at), np.uint64)
    for back in range(order, -1, -1):
        key = (key << np.uint64(8)) | data[at - back]
    return key


def code_lengths(model: Model, words: list[bytes]) -> np.ndarray:
    """Bits of every word under every language."""
    data, place, starts, _ = _laid_out(words)
    left = np.flatnonzero(place > 0)  # place 0 is the space before the word
    bits = np.zeros((len(data), len(model.langs)))
    for o in range(len(model.keys) - 1, -1, -1):
        deep = place[left] >= o
        at = left[deep]
        key = _keys(data, at, o)
        row, hit = _find(model.keys[o], key)
        bits[at[hit]] += model.costs[o][row[hit]]
        missed = at[~hit]
        row, hit_context = _find(model.contexts[o], key[~hit] >> np.uint64(8))
        bits[missed[hit_context]] += model.escapes[o][row[hit_context]]
        left = np.concatenate([left[~deep], missed])
    bits[left] += 8.0
    return np.add.reduceat(bits, starts) if len(words) else bits


class Scorer:
    """Scores texts, keeping the code lengths of words it has met."""

    def __init__(self, model: Model, cache_words: int = CACHE_WORDS):
        self.model, self.cache_words = model, cache_words
        self.rows: dict[bytes, int] = {}
        self.bits = np.zeros((0, len(model.langs)))

    def totals(self, texts: list[list[bytes]]) -> list[np.ndarray]:
        new = list({w for words in texts for w in words if w not in self.rows})
        if len(self.rows) + len(new) > self.cache_words:
            self.rows, self.bits = {}, np.zeros((0, len(self.model.langs)))
            new = list({w for words in texts for w in words})
        if new:
            self.bits = np.concatenate([self.bits, code_lengths(self.model, new)])
            self.rows.update(zip(new, range(len(self.rows), len(self.rows) + len(new)), strict=True))
        rows = self.rows
        return [self.bits[[rows[w] for w in words]].sum(axis=0) for words in texts]

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        fit = [bool(t) and bool(self.model.langs) and any(map(str.isalpha, t)) for t in texts]
        totals = iter(self.totals([coded(t) for t, ok in zip(texts, fit, strict=True) if ok]))
        names, scores = [], []
        for ok in fit:
            if not ok:
                names.append("und")
                scores.append(0.0)
                continue
            bits = next(totals)
            best = int(bits.argmin())
            names.append(self.model.langs[best])
            scores.append(float(1 / np.exp2(np.maximum(bits[best] - bits, -1000.0)).sum()))
        return names, scores


def _context_counts(order: int):
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, pdf in batch.groupby("lang"):
                data, place, _, lengths = _laid_out([w.encode("utf-8", "surrogatepass") for w in pdf["word"]])
                times = np.repeat(pdf["n"].to_numpy(), lengths)
                for o in range(order + 1):
                    at = np.flatnonzero((place > 0) & (place >= o))
                    key, row = np.unique(_keys(data, at, o), return_inverse=True)
                    n = np.zeros(len(key), np.int64)
                    np.add.at(n, row, times[at])
                    yield pd.DataFrame({"lang": lang, "size": np.int32(o), "key": key.astype(np.int64), "n": n})

    return count


def train(labelled: DataFrame, order: int = ORDER, docs_per_language: int = DOCS_PER_LANGUAGE) -> Model:
    """A model from ``labelled(doc_id, text, lang)``: per language, the documents with the smallest hashed ids."""
    by_hash = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    usable = labelled.filter("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL")
    # At most docs_per_language rows a language: small enough to send to every task.
    picked = usable.select("lang", "doc_id").withColumn("_turn", F.row_number().over(by_hash)).filter(F.col("_turn") <= docs_per_language).select("lang", "doc_id").distinct()
    sample = usable.select("lang", "doc_id", "text").join(F.broadcast(picked), ["lang", "doc_id"])
    words = sample.select("lang", F.explode(F.split(F.lower("text"), r"[\x20\x09-\x0D]+")).alias("word")).filter("word <> ''").groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))
    counts = words.mapInPandas(_context_counts(order), "lang string, size int, key long, n long").groupBy("lang", "size", "key").agg(F.sum("n").alias("n"))
    return build_model(counts.toPandas(), order)


def predict(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs`` with ``lang_pred`` and ``score``; only the text is looked at."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = docs.select(*keep, "text").schema

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                names, scores = scorer.predict(part.column(len(keep)).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=[*keep, "lang_pred", "score"])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields[: len(keep)])
    return docs.select(*keep, "text").mapInArrow(score, f"{kept}, {OUT}")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify_languages(docs: DataFrame, **bounds) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)``: learned from the rows that are not held out."""
    split = docs.select("doc_id", "text", "lang", held_out(F.col("doc_id")).alias("held_out"))
    model = train(split.filter("NOT held_out"), **bounds)
    return predict(split.select("doc_id", "held_out", "text"), model, ["doc_id", "held_out"])
