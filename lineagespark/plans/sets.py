"""Queries for set operations, orders and limits."""

from __future__ import annotations

from pyspark.sql import functions as F

from lineagespark.operators import selection, sets
from lineagespark.plans.distances import vector_cells
from lineagespark.plans.registry import query


@query("U1", """
WITH p AS (SELECT sample_id, 'input' AS pool FROM samples WHERE role = 'input' UNION ALL SELECT sample_id, 'context' FROM samples WHERE role = 'context' OR k % 100 = 0 UNION ALL SELECT sample_id, 'context' FROM samples WHERE k % 75 = 1)
SELECT sample_id, count(*) AS rows, CASE WHEN min(pool) <> max(pool) THEN 'input_and_context' ELSE 'repeated_id' END AS problem FROM p GROUP BY 1 HAVING count(*) > 1""", "samples")
def pool(t):
    s = t.samples.select("sample_id", "role", "k", "country")
    context = s.filter("role = 'context' OR k % 100 = 0").union(s.filter("k % 75 = 1"))
    return sets.combine_pool(s.filter("role = 'input'").drop("country"), context)[1]


@query("U2", """
SELECT sample_id, 'missing' AS status FROM samples WHERE k % 7 = 0 AND k % 3 <> 0 UNION ALL SELECT sample_id, 'extra' FROM samples WHERE k % 3 = 0 AND k % 7 <> 0""", "samples")
def differences(t):
    return sets.compare_sets(t.samples.filter("k % 7 = 0").select("sample_id"), t.samples.filter("k % 3 = 0").select("sample_id"), "sample_id")


@query("U3", """
SELECT locus, count(*) AS mapped FROM calls WHERE (CAST(substring(locus, 2) AS INTEGER) % 2 = 0 OR allele IS NOT NULL) GROUP BY 1 HAVING count(*) = (SELECT count(*) FROM profiles)""", "calls profiles")
def panel(t):
    mapped = t.calls.filter("CAST(substring(locus, 2, 2) AS INT) % 2 = 0 OR allele IS NOT NULL").select("sample_id", "locus")
    return sets.shared_panel(mapped)


_SEL = """m AS (SELECT 'run' || (k % 5) AS selection_id, sample_id FROM samples UNION SELECT 'run' || (k % 4), sample_id FROM samples UNION SELECT 'run9', sample_id FROM samples WHERE k % 5 = 0 OR k % 4 = 0)"""


@query("U4", f"""
WITH {_SEL}, n AS (SELECT selection_id, count(*) AS n FROM m GROUP BY 1), p AS (SELECT a.selection_id AS l, b.selection_id AS r, count(*) AS i FROM m a JOIN m b ON a.sample_id = b.sample_id AND a.selection_id < b.selection_id GROUP BY ALL)
SELECT x.selection_id AS "left", y.selection_id AS "right", coalesce(i, 0) AS intersection, x.n + y.n - coalesce(i, 0) AS "union", round(coalesce(i, 0) / (x.n + y.n - coalesce(i, 0)), 6) AS jaccard, coalesce(i, 0) = x.n + y.n - coalesce(i, 0) AS duplicate
FROM n x JOIN n y ON x.selection_id < y.selection_id LEFT JOIN p ON l = x.selection_id AND r = y.selection_id""", "samples")
def jaccard(t):
    s = t.samples
    members = s.selectExpr("concat('run', k % 5) AS selection_id", "sample_id").union(s.selectExpr("concat('run', k % 4)", "sample_id")).union(
        s.filter("k % 5 = 0 OR k % 4 = 0").selectExpr("'run9'", "sample_id")
    )
    return selection.overlaps(members).withColumn("jaccard", F.round("jaccard", 6))


@query("U5", "SELECT sha256(text) AS content_id, min(doc_id) AS first, count(*) AS copies FROM documents GROUP BY 1")
def duplicates(t):
    return sets.content_duplicates(t.table("documents"), "text", "doc_id")[0]


@query("U6", """
SELECT sample_id, country, row_number() OVER (PARTITION BY country ORDER BY first_day, n50 DESC, sample_id) AS position FROM samples""", "samples")
def total_order(t):
    """Position inside each country under a total order, as the ordered output would list it."""
    from pyspark.sql import Window

    order = Window.partitionBy("country").orderBy(F.asc_nulls_last("first_day"), F.desc_nulls_last("n50"), "sample_id")
    return sets.ordered(t.samples.select("sample_id", "country", F.row_number().over(order).alias("position")), ["country", "position"], "sample_id")


@query("U7", "SELECT node, s AS start, e AS \"end\" FROM intervals ORDER BY e - s DESC, s, node LIMIT 10", "intervals")
def first_ten(t):
    rows = t.intervals.withColumn("_l", F.col("end") - F.col("start"))
    return sets.head(rows, [F.desc("_l"), "start"], "node", 10).drop("_l")
