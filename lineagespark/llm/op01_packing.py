"""Packing: optimal length buckets and token-budget batches.

One aggregate gives the global histogram of lengths. Dynamic programming chooses at most
``buckets`` upper bounds so that padding every document to the bound of its bucket wastes the
fewest tokens. Inside a bucket, documents in hash order fill batches of
``budget // bound`` rows (one at least), so a padded batch stays within the token budget.

The histogram has one row per length below 4,096 and 4,096 rows per doubling above, so what the
driver sees is bounded for any corpus; a row keeps its count, sum and longest length, and costs
are exact for the bounds it offers. Places in a bucket come from parts of the hash order, so a
bucket that holds most rows is never sorted in one task.

Documents without tokens (null, empty, white space) need no place: bucket, batch and slot are
null. Repeated rows and rows without an id get places of their own; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineagespark.llm.common import running, word_count, written

BUCKETS, TOKEN_BUDGET = 16, 65_536
EXACT = 4096


def length_bin(n: Column) -> Column:
    """The row of the histogram that a length belongs to."""
    step = F.greatest(F.floor(F.log2(n.cast("double"))) - 11, F.lit(0))
    return F.when(n < EXACT, n).otherwise(step * EXACT + F.floor(n / F.pow(F.lit(2.0), step))).cast("long")


def optimal_bounds(histogram: list[tuple[int, int, int]], buckets: int) -> list[int]:
    """Upper bounds with the least padding, from rows (longest, count, sum of lengths) in order.

    ``best[j]`` is the least padding of the first j rows in k buckets. A bucket over rows i..j-1
    costs longest[j-1] * (count of them) - (sum of them), so over j the choices of i are straight
    lines in the bound; a lower hull that the growing bound walks along finds the best i.
    """
    count, total = [0], [0]
    for _, n, s in histogram:
        count.append(count[-1] + n)
        total.append(total[-1] + s)
    rows = len(histogram)
    best: list[int | None] = [0] + [None] * rows
    cuts: list[list[int]] = []
    for _ in range(min(buckets, rows)):
        hull: list[tuple[int, int, int]] = []  # (count before, best + total before, i)
        following: list[int | None] = [None] * (rows + 1)
        cut, at = [0] * (rows + 1), 0
        for j in range(1, rows + 1):
            i = j - 1
            if best[i] is not None:
                line = (count[i], best[i] + total[i], i)
                while len(hull) - at >= 2 and (line[1] - hull[-2][1]) * (hull[-1][0] - hull[-2][0]) <= (hull[-1][1] - hull[-2][1]) * (line[0] - hull[-2][0]):
                    hull.pop()
                hull.append(line)
            if not hull:
                continue
            bound = histogram[j - 1][0]
            while at + 1 < len(hull) and hull[at + 1][1] - bound * hull[at + 1][0] < hull[at][1] - bound * hull[at][0]:
                at += 1
            following[j] = bound * count[j] - total[j] + hull[at][1] - bound * hull[at][0]
            cut[j] = hull[at][2]
        best = following
        cuts.append(cut)
    bounds, j = [], rows
    for cut in reversed(cuts):
        bounds.append(histogram[j - 1][0])
        j = cut[j]
    return bounds[::-1]


def choose_bounds(lengths: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """Bounds for ``lengths(n_tokens)`` above 0."""
    rows = lengths.filter("n_tokens > 0").groupBy(length_bin(F.col("n_tokens")).alias("_bin")).agg(F.max("n_tokens").alias("longest"), F.count(F.lit(1)).alias("n"), F.sum("n_tokens").alias("s"))
    return optimal_bounds(sorted((r["longest"], r["n"], r["s"]) for r in rows.collect()), buckets)


def pack(docs: DataFrame, buckets: int = BUCKETS, budget: int = TOKEN_BUDGET, seed: str = "pack") -> DataFrame:
    """``(doc_id, n_tokens, bucket, bucket_len, batch, slot, padding)``, one row per document."""
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    rows = written(docs.select("doc_id", word_count(F.col("text")).alias("n_tokens"), order.alias("_order")), "lengths")
    bounds = choose_bounds(rows, buckets)
    bucket = bucket_len = F.lit(None)
    for k in range(len(bounds) - 1, -1, -1):
        fits = (F.col("n_tokens") > 0) & (F.col("n_tokens") <= bounds[k])
        bucket, bucket_len = F.when(fits, k).otherwise(bucket), F.when(fits, bounds[k]).otherwise(bucket_len)
    rows = rows.withColumn("bucket", bucket.cast("int")).withColumn("bucket_len", bucket_len.cast("long"))
    places = running(rows.filter("bucket IS NOT NULL").withColumn("_part", F.substring("_order", 1, 3)), ["bucket"], "_part", [F.col("_order"), F.col("n_tokens")], F.lit(1), "_place")
    room = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.col("bucket_len"))).cast("long")
    placed = places.withColumn("batch", F.floor((F.col("_place") - 1) / room)).withColumn("slot", ((F.col("_place") - 1) % room).cast("int"))
    columns = ["doc_id", "n_tokens", "bucket", "bucket_len", F.col("batch").cast("long").alias("batch"), "slot", (F.col("bucket_len") - F.col("n_tokens")).alias("padding")]
    empty = rows.filter("bucket IS NULL").withColumn("batch", F.lit(None).cast("long")).withColumn("slot", F.lit(None).cast("int"))
    return placed.select(*columns).unionByName(empty.select(*columns[:-1], F.lit(0).cast("long").alias("padding")))
