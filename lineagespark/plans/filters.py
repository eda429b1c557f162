"""Queries for filters and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from lineagespark.functions import dates, lineage, scopes
from lineagespark.operators import filters
from lineagespark.plans.inputs import AS_OF
from lineagespark.plans.registry import query


@query("F1", """
SELECT sample_id FROM samples WHERE (lower(country) LIKE 'nation_1%' OR lower(country) LIKE 'nation_2%')
  AND TRY_CAST(substring(collection_date, 1, 4) AS INTEGER) BETWEEN 1995 AND 1997 AND lower(host) LIKE '%us%'""", "samples")
def candidates(t):
    return filters.filter_candidates(t.samples, ["NATION_1", "nation_2"], 1995, 1997, host="US").select("sample_id")


@query("F2", "SELECT sample_id FROM samples WHERE qc_pass", "samples")
def qc(t):
    df = t.samples
    return df.filter(filters.qc_eligible(df)).select("sample_id")


@query("F3", """
WITH d AS (SELECT lineage, country, collection_date, i.s <= DATE '2026-01-01' AS ok FROM samples LEFT JOIN interval_of i USING (sample_id))
SELECT lineage, country, count(*) AS members, count(*) FILTER (WHERE ok) AS dated, count(DISTINCT CASE WHEN ok THEN collection_date END) AS distinct_dates,
  count(*) FILTER (WHERE ok) >= 3 AND count(DISTINCT CASE WHEN ok THEN collection_date END) >= 3 AS sufficient
FROM d GROUP BY ALL""", "samples interval_of")
def dated(t):
    return filters.dated_cohorts(t.samples, ["lineage", "country"], AS_OF)


@query("F4", "SELECT sample_id, collection_date, 'future_collection_date' AS reason FROM samples WHERE collection_date = '2999-05-01'", "samples")
def future(t):
    return filters.future_dates(t.samples, AS_OF)


@query("F5", """
SELECT scope_id, sample_id, count(allele) AS called, 64 AS loci, CASE WHEN count(allele) = 0 THEN 'profile_unavailable'
  WHEN count(allele) / 64 < 0.96 THEN 'insufficient_called_overlap' END AS reason FROM calls GROUP BY ALL""", "calls")
def own_overlap(t):
    return filters.self_eligible(t.calls, t.calls.select("scope_id", "locus").distinct(), 0.96)


@query("F6", """
WITH s AS (SELECT p.*, c.n, vec_id % 3 <> 0 AS lin FROM profiles p LEFT JOIN (SELECT sample_id, count(allele) AS n FROM calls GROUP BY 1) c USING (sample_id))
SELECT sample_id, CASE WHEN vec_id % 25 = 0 THEN 'input' ELSE 'context' END AS role, n > 0 AND vec_id % 11 <> 0 AS profile_ready, lin AS lineage_ready,
  CAST(vec_id % 11 = 0 AS INTEGER) + CAST(scope_id = 's2' AND vec_id % 11 <> 0 AS INTEGER) + CAST(NOT lin AS INTEGER) AS reasons,
  CASE WHEN host = '' AND collection_date = '' THEN 'host,collection_date' WHEN host = '' THEN 'host' WHEN collection_date = '' THEN 'collection_date' ELSE '' END AS missing_metadata,
  CASE WHEN vec_id % 11 <> 0 AND lin AND scope_id <> 's2' THEN 'ready' ELSE 'incomplete' END AS readiness
FROM s""", "profiles calls")
def ready(t):
    d = dates.normalised_text_dates("collection_date")
    samples = t.profiles.selectExpr("sample_id", "CASE WHEN vec_id % 25 = 0 THEN 'input' ELSE 'context' END AS role", "country", "host", "collection_date")
    samples = samples.withColumn("date_precision", d["precision"])
    counts = t.calls.filter("CAST(substring(sample_id, 2) AS BIGINT) % 11 <> 0").groupBy("sample_id", "scope_id").agg(F.count("allele").alias("called_loci"))
    counts = counts.selectExpr("sample_id", "called_loci", "scope_id <> 's2' AS catalogue_complete")
    scope = scopes.typing_scope(F.lit("scgMLST629_S"), F.lit("v1"), F.lit(""))
    lin = t.profiles.select(
        "sample_id",
        filters.lineage_is_ready(F.expr("CASE WHEN vec_id % 3 = 0 THEN 'missing' ELSE 'resolved' END"), F.lit("false"), scope, F.lit("1_2")).alias("lineage_ready"),
    )
    out = filters.readiness(samples, counts, lin, ["country", "host"])
    return out.withColumn("reasons", F.size("reasons")).withColumn("missing_metadata", F.array_join("missing_metadata", ","))


@query("F7", """
SELECT doc_id, depth, group_key FROM keyed WHERE group_key <> '' AND NOT prov""", "keyed")
def usable_lineage(t):
    status = F.expr("CASE WHEN provisional = 'true' OR contains(cglin_raw, '*') THEN 'conflict' ELSE 'resolved' END")
    scope = scopes.typing_scope("cglin_scheme", "cglin_scheme_version", "database_sha256")
    levels = F.array(*[F.struct(F.lit(d).alias("depth"), lineage.usable_lineage(scope, status, F.col("cglin_raw"), d).alias("u")) for d in (4, 5, 6, 7)])
    rows = t.assignments.select("doc_id", F.explode(levels).alias("l")).filter("l.u IS NOT NULL")
    key = lineage.group_key(F.col("l.u.scheme"), F.col("l.u.version"), F.col("l.u.prefix"), F.size("l.u.prefix"))
    return rows.select("doc_id", "l.depth", key.alias("group_key"))


@query("F8", """
SELECT event_id, round(CASE WHEN event_id % 5 IN (1, 2, 3) THEN NULL ELSE value END, 6) AS number FROM events""")
def numbers(t):
    raw = F.expr("CASE event_id % 5 WHEN 1 THEN 'n/a' WHEN 2 THEN 'NaN' WHEN 3 THEN '-1' ELSE CAST(value AS STRING) END")
    return t.table("events").select("event_id", F.round(filters.evidence_number(raw), 6).alias("number"))
