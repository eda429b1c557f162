"""Line dedup: repeated windows of three consecutive lines.

Windows overlap: every three consecutive lines with a word are hashed (128 bits). A window that
occurs more than once in the corpus stays where it comes first, by doc_id and then place; the
lines of its later occurrences go, and overlapping occurrences are merged by their lines.

Window totals are partial aggregates and the join back carries one small row per occurrence;
texts are shuffled once. Lines without a word are in no window and stay. Texts of fewer than
three such lines, and null texts, stay as they are. Rows without an id come last in the order;
rows equal in id and text are one document and get the same lines removed. A text that loses all
its lines becomes empty. An empty table gives no rows; extra columns stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineagespark.llm.common import NO_ID

WINDOW = 3


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("_id", F.coalesce(F.col("doc_id"), F.lit(NO_ID))).withColumn("_hash", F.xxhash64("text"))


def line_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(_id, _hash, at, w1, w2)``: every window of lines; ``at`` counts lines with a word."""
    lines = F.filter(F.split("text", "\n"), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))
    hashed = lambda seed: F.xxhash64(F.lit(seed), *[F.get(F.col("_lines"), F.col("at") + k) for k in range(window)])
    rows = _keyed(docs.select("doc_id", "text")).select("_id", "_hash", F.transform(lines, lambda x: F.struct(F.xxhash64(F.lit(1), x).alias("a"), F.xxhash64(F.lit(2), x).alias("b"))).alias("_lines"))
    rows = rows.filter(F.size("_lines") >= window)
    starts = rows.select("_id", "_hash", "_lines", F.explode(F.sequence(F.lit(0), F.size("_lines") - window)).alias("at"))
    return starts.select("_id", "_hash", "at", hashed(3).alias("w1"), hashed(4).alias("w2"))


def repeated_lines(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(_id, _hash, _gone)``: per document, the lines with a word that later occurrences cover."""
    seen = line_windows(docs, window)
    where = F.struct("_id", "_hash", "at")
    first = seen.groupBy("w1", "w2").agg(F.min(where).alias("_first"), F.max(where).alias("_last")).filter("_first <> _last").drop("_last")
    later = seen.join(first, ["w1", "w2"]).filter(where > F.col("_first"))
    gone = later.groupBy("_id", "_hash").agg(F.collect_set("at").alias("_at"))
    return gone.select("_id", "_hash", F.array_distinct(F.flatten(F.transform("_at", lambda a: F.sequence(a, a + window - 1)))).alias("_gone"))


def dedup_lines(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` with repeated lines out of ``text``, and ``n_lines_removed``."""
    columns = [c for c in docs.columns if c != "n_lines_removed"]
    found = _keyed(docs).join(repeated_lines(docs, window), ["_id", "_hash"], "left")
    # Lines are numbered among those with a word; the rest carry no number and stay.
    lines = F.split("text", "\n")
    worded = F.filter(F.sequence(F.lit(0), F.size("_all") - 1), lambda i: F.rlike(F.get(F.col("_all"), i), F.lit(r"[^\x20\x09-\x0D]")))
    found = found.withColumn("_all", lines).withColumn("_worded", worded)
    places = F.transform("_gone", lambda g: F.get(F.col("_worded"), g))
    kept = F.array_except(F.sequence(F.lit(0), F.size("_all") - 1), places)
    text = F.when(F.col("_gone").isNull(), F.col("text")).otherwise(F.array_join(F.transform(kept, lambda i: F.get(F.col("_all"), i)), "\n"))
    return found.withColumn("_new", text).select(*[F.col("_new").alias("text") if c == "text" else F.col(c) for c in columns], F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_lines_removed"))
