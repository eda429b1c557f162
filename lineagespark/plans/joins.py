"""Queries for joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from lineagespark.functions import accessions, geo, lineage, sequences
from lineagespark.operators import distances, joins, ranking
from lineagespark.plans.inputs import AS_OF
from lineagespark.plans.registry import query


def alias_table(t):
    """(source_genome_id, role, alias): version-free identity aliases of every genome."""
    named = F.array("biosample", "run_accession", "assembly_accession")
    rows = t.genomes.select("source_genome_id", "role", F.explode(named).alias("a")).filter("a <> ''")
    return rows.select("source_genome_id", "role", accessions.identity_alias("a").alias("alias")).distinct()


def unit_ids(t):
    """Units of documents with equal text, keyed by their sample accession."""
    return t.genomes.select(F.col("biosample").alias("unit"), "source_genome_id")


@query("J1", """
SELECT r.run_accession AS accession, count(DISTINCT g.source_genome_id) AS matches, CASE WHEN count(DISTINCT g.source_genome_id) = 1 THEN min(g.source_genome_id) END AS source_genome_id,
  CASE WHEN count(DISTINCT g.source_genome_id) = 1 THEN 'matched' ELSE 'ambiguous' END AS status
FROM (SELECT DISTINCT run_accession FROM genomes) r JOIN genomes g ON g.run_accession = r.run_accession GROUP BY 1
UNION ALL SELECT DISTINCT study_accession, 0, NULL, 'missing' FROM genomes""", "genomes")
def accession_join(t):
    g = t.genomes
    requests = g.select(F.col("run_accession").alias("accession")).union(g.select("study_accession")).distinct()
    aliases = alias_table(t).select("source_genome_id", F.col("alias").alias("value"))
    return joins.join_accessions(requests, aliases)


_OVERRIDE_SQL = """o AS (SELECT sample_id, CASE WHEN k % 3 = 0 THEN '' WHEN k % 3 = 1 THEN country ELSE 'NATION_X' END AS country, CASE WHEN k % 5 = 0 THEN '2001-05' ELSE '' END AS collection_date FROM samples WHERE k % 2 = 0)"""


@query("J2", f"""
WITH {_OVERRIDE_SQL}
SELECT s.sample_id, coalesce(nullif(o.country, ''), s.country) AS country, coalesce(nullif(o.collection_date, ''), s.collection_date) AS collection_date,
  o.sample_id IS NOT NULL AS overridden, CAST(coalesce(o.country NOT IN ('', s.country), false) AS INTEGER)
   + CAST(coalesce(o.collection_date NOT IN ('', s.collection_date) AND s.collection_date <> '', false) AS INTEGER) AS conflicts
FROM samples s LEFT JOIN o USING (sample_id)""", "samples")
def overrides(t):
    rows = t.samples.select("sample_id", "country", "collection_date", "k")
    new = rows.filter("k % 2 = 0").selectExpr(
        "sample_id", "CASE k % 3 WHEN 0 THEN '' WHEN 1 THEN country ELSE 'NATION_X' END AS country",
        "CASE WHEN k % 5 = 0 THEN '2001-05' ELSE '' END AS collection_date",
    )
    out, audit = joins.apply_overrides(rows, new, ["country", "collection_date"])
    counts = audit.groupBy("sample_id").agg(F.count(F.lit(1)).alias("conflicts"))
    return out.join(counts, "sample_id", "left").select(
        "sample_id", "country", "collection_date", F.col("manual_metadata_override").alias("overridden"), F.coalesce("conflicts", F.lit(0)).alias("conflicts")
    )


_LINEAGE_SQL = """
WITH sig AS (
  SELECT source_genome_id, cglin_raw, doc_id, prov, code_status, array_to_string(prefix, '_') || '|' || code_status || '|' || prov || '|' || cglin_scheme || '|' || cglin_scheme_version AS s,
    max(group_key) FILTER (WHERE depth = 5) AS key5 FROM keyed GROUP BY ALL),
 other AS (SELECT source_genome_id, CASE WHEN cglin_scheme = 'scgMLST629_S' THEN '1_1_1_1_1_1_1_1_1_1|complete|' ELSE '|unsupported|' END || (provisional = 'true') || '|' || cglin_scheme || '|' || cglin_scheme_version AS s FROM assignments WHERE doc_id % 11 = 0),
 rows AS (SELECT source_genome_id, s FROM sig UNION ALL SELECT source_genome_id, s FROM sig WHERE doc_id % 6 = 0 UNION ALL SELECT source_genome_id, s FROM other),
 u AS (SELECT g.biosample AS unit, count(*) AS export_records, min(r.s) AS lo, max(r.s) AS hi, min(g.source_genome_id) AS any_id FROM genomes g JOIN rows r USING (source_genome_id) GROUP BY 1)
SELECT unit, export_records, CASE WHEN lo <> hi THEN 'conflict' WHEN prov AND code_status IN ('complete', 'partial') THEN 'provisional' ELSE code_status END AS status,
  CASE WHEN lo <> hi THEN '' ELSE key5 END AS group_5{extra}
FROM u LEFT JOIN sig ON sig.source_genome_id = any_id"""


@query("J3", _LINEAGE_SQL.replace("{extra}", ""), "genomes keyed assignments")
def lineage_annotation(t):
    units = unit_ids(t).select("unit").distinct()
    export = t.exported.select("source_genome_id", "cglin_raw", "provisional", "cglin_scheme", "cglin_scheme_version")
    out = joins.annotate_lineage(units, unit_ids(t), export)
    return out.select("unit", "export_records", F.col("cglin_status").alias("status"), F.col("cglin_group_5").alias("group_5"))


def typing_rows(t):
    """Typing of two kinds per genome; one in thirteen is already flagged as a conflict."""
    g = t.genomes.selectExpr("source_genome_id", "doc_id", "n_chars")
    cluster = g.selectExpr("source_genome_id", "'hiercc' AS kind", "concat('HC5=', n_chars % 50) AS value", "CASE WHEN doc_id % 13 = 0 THEN 'conflict' ELSE 'resolved' END AS status")
    profile = g.filter("doc_id % 2 = 0").selectExpr("source_genome_id", "'cgmlst' AS kind", "concat('p', n_chars % 40) AS value", "'resolved' AS status")
    return cluster.unionByName(profile).withColumn("signature", F.concat_ws("|", "value", F.col("status") == "conflict"))


_TYPING_SQL = """typing AS (
  SELECT source_genome_id, 'hiercc' AS kind, 'HC5=' || (n_chars % 50) AS value, CASE WHEN doc_id % 13 = 0 THEN 'conflict' ELSE 'resolved' END AS status FROM genomes
  UNION ALL SELECT source_genome_id, 'cgmlst', 'p' || (n_chars % 40), 'resolved' FROM genomes WHERE doc_id % 2 = 0)"""


@query("J4", f"""
WITH {_TYPING_SQL},
 own AS (SELECT biosample AS unit, 'hiercc' AS kind, 'HC5=' || max(n_chars % 50 + CASE WHEN doc_id % 17 = 0 THEN 1 ELSE 0 END) AS value FROM genomes GROUP BY 1),
 a AS (SELECT g.biosample AS unit, kind, value, status, 1 AS imported FROM genomes g JOIN typing USING (source_genome_id) UNION ALL SELECT unit, kind, value, 'resolved', 0 FROM own)
SELECT unit, kind, CAST(sum(imported) AS BIGINT) AS records, CASE WHEN min(value) <> max(value) OR count(*) FILTER (WHERE status = 'conflict') > 0 THEN 'conflict' ELSE 'resolved' END AS status,
  CASE WHEN min(value) = max(value) AND count(*) FILTER (WHERE status = 'conflict') = 0 THEN min(value) END AS value
FROM a GROUP BY unit, kind HAVING sum(imported) > 0""", "genomes")
def typing_annotation(t):
    own = t.genomes.groupBy(F.col("biosample").alias("unit")).agg(
        F.concat(F.lit("HC5="), F.max(F.expr("n_chars % 50 + CASE WHEN doc_id % 17 = 0 THEN 1 ELSE 0 END"))).alias("value")
    ).select("unit", F.lit("hiercc").alias("kind"), F.concat("value", F.lit("|false")).alias("signature"), "value", F.lit("resolved").alias("status"))
    return joins.annotate_typing(unit_ids(t).select("unit").distinct(), unit_ids(t), typing_rows(t), own)


def focal_inputs(t):
    g = t.genomes
    focal = g.filter("role = 'input'")
    catalogue = g.filter("role = 'context'").join(t.assignments.select("source_genome_id", "cglin_raw", "cglin_scheme", "cglin_scheme_version"), "source_genome_id").select(
        "source_genome_id", "cglin_raw", "cglin_scheme", "cglin_scheme_version"
    )
    mine = focal.join(t.assignments.select("source_genome_id", "cglin_raw", "cglin_scheme", "cglin_scheme_version"), "source_genome_id").selectExpr(
        "concat('F', doc_id) AS sample_id", "CASE WHEN doc_id % 3 = 0 THEN concat('D', doc_id + 1) WHEN doc_id % 7 = 0 THEN 'D_gone' ELSE '' END AS direct_id",
        "CASE WHEN doc_id % 4 = 0 THEN cglin_raw ELSE '' END AS own_raw", "cglin_scheme AS own_scheme", "cglin_scheme_version AS own_version", "doc_id % 8 = 0 AS own_has_provenance",
    )
    fa = focal.select(F.concat(F.lit("F"), "doc_id").alias("sample_id"), F.explode(F.array("biosample", "run_accession")).alias("accession")).distinct()
    ca = g.filter("role = 'context'").select("source_genome_id", F.explode(F.array("biosample", "run_accession")).alias("accession")).distinct()
    links = focal.filter("doc_id % 9 = 0").selectExpr("concat('F', doc_id) AS sample_id", "concat('D', doc_id + 1) AS source_genome_id")
    return mine, fa, catalogue, ca, links


_FOCAL_SQL = """f AS (SELECT g.doc_id, 'F' || g.doc_id AS sample_id, biosample, run_accession, CASE WHEN g.doc_id % 3 = 0 THEN 'D' || (g.doc_id + 1) WHEN g.doc_id % 7 = 0 THEN 'D_gone' ELSE '' END AS direct_id,
    CASE WHEN g.doc_id % 4 = 0 THEN ok0 AND cglin_raw <> '' AND g.doc_id % 8 = 0 AND cglin_scheme = 'scgMLST629_S' ELSE false END AS own_valid, prefix, cglin_scheme, cglin_scheme_version
  FROM genomes g JOIN parsed USING (source_genome_id) WHERE g.role = 'input'),
 cat AS (SELECT g.*, cglin_scheme, cglin_scheme_version, CASE WHEN ok0 AND cglin_raw <> '' THEN list_transform(toks[1:n], lambda x: CAST(x AS BIGINT)) ELSE CAST([] AS BIGINT[]) END AS prefix FROM genomes g JOIN parsed USING (source_genome_id) WHERE g.role = 'context'),
 cand AS (SELECT sample_id, 'D' || (doc_id + 1) AS id, 'e' AS kind FROM f WHERE doc_id % 9 = 0
   UNION SELECT f.sample_id, cat.source_genome_id, 'a' FROM f JOIN cat ON f.biosample = cat.biosample OR f.run_accession = cat.run_accession
   UNION SELECT sample_id, direct_id, 'd' FROM f WHERE direct_id <> ''),
 sets AS (SELECT sample_id, coalesce(list_sort(list(id) FILTER (WHERE kind = 'e')), []) AS e, coalesce(list_sort(list(id) FILTER (WHERE kind = 'a')), []) AS a, coalesce(list(id) FILTER (WHERE kind = 'd'), []) AS d FROM cand GROUP BY 1),
 m AS (SELECT f.*, coalesce(e, []) AS e, coalesce(a, []) AS a, coalesce(d, []) AS d, list_distinct(list_concat(CASE WHEN len(coalesce(e, [])) > 0 THEN e ELSE coalesce(a, []) END, coalesce(d, []))) AS hits FROM f LEFT JOIN sets USING (sample_id)),
 st AS (SELECT *, CASE WHEN (len(e) > 0 AND len(a) > 0 AND e <> a) OR (len(a) > 0 AND len(d) > 0 AND NOT list_contains(a, d[1])) THEN 'conflict' WHEN len(hits) = 0 THEN 'missing' WHEN len(hits) > 1 THEN 'ambiguous'
   WHEN hits[1] NOT IN (SELECT source_genome_id FROM cat) THEN 'unavailable' ELSE 'matched' END AS s0 FROM m),
 resolved AS (SELECT st.sample_id, st.hits, st.own_valid, CASE WHEN s0 = 'matched' AND own_valid AND (st.cglin_scheme <> cat.cglin_scheme OR st.cglin_scheme_version <> cat.cglin_scheme_version
    OR st.prefix[1:least(len(st.prefix), len(cat.prefix))] <> cat.prefix[1:least(len(st.prefix), len(cat.prefix))]) THEN 'conflict' ELSE s0 END AS status FROM st LEFT JOIN cat ON s0 = 'matched' AND cat.source_genome_id = hits[1])"""


@query("J5", f"""
WITH {_FOCAL_SQL}
SELECT sample_id, status, len(hits) AS candidates, CASE WHEN status = 'matched' THEN hits[1] ELSE '' END AS matched_source_genome_id, own_valid AS retained_focal_assignment FROM resolved""", "genomes parsed")
def focal_resolution(t):
    return joins.resolve_focal(*focal_inputs(t))


@query("J6", f"""
WITH {_FOCAL_SQL}, {_TYPING_SQL}
SELECT sample_id, kind, 1 AS records, typing.status, CASE WHEN typing.status <> 'conflict' THEN value END AS value
FROM resolved JOIN typing ON resolved.status = 'matched' AND typing.source_genome_id = hits[1]""", "genomes parsed")
def focal_typing(t):
    resolved = joins.resolve_focal(*focal_inputs(t))
    own = typing_rows(t).withColumnRenamed("source_genome_id", "sample_id").filter("false")
    return joins.copy_matched_typing(resolved, typing_rows(t), own)


@query("J7", _LINEAGE_SQL.replace("{extra}", ", 'user_frozen_export' AS scope_source, CASE WHEN sig.source_genome_id IS NULL THEN 'unavailable' ELSE 'user_declared' END AS version_status"), "genomes keyed assignments")
def frozen_lineage(t):
    units = unit_ids(t).select("unit").distinct().withColumn("cglin_raw", F.lit("9_9_9_9_9_9_9")).withColumn("cgst", F.lit("7"))
    export = t.exported.select("source_genome_id", "cglin_raw", "provisional", "cglin_scheme", "cglin_scheme_version")
    out = joins.replace_lineage(units, unit_ids(t), export)
    return out.select(
        "unit", "export_records", F.col("cglin_status").alias("status"), F.col("cglin_group_5").alias("group_5"),
        F.col("cglin_scope_source").alias("scope_source"), F.col("cglin_database_version_status").alias("version_status"),
    )


@query("J8", """
SELECT DISTINCT c.source_genome_id, CASE WHEN i.alias IS NULL THEN 'kept' ELSE 'already_present_exact_identity' END AS reason FROM (
  SELECT source_genome_id, max(i.alias) AS alias FROM genome_aliases c LEFT JOIN (SELECT DISTINCT alias FROM genome_aliases WHERE role = 'input') i USING (alias) WHERE c.role = 'context' GROUP BY 1) x
JOIN genomes c USING (source_genome_id) LEFT JOIN (SELECT 1 AS one, 'x' AS alias) i ON x.alias IS NOT NULL""", "genomes genome_aliases")
def exclusion(t):
    aliases = alias_table(t)
    context = t.genomes.filter("role = 'context'").select("source_genome_id")
    kept, out = joins.exclude_known(context, aliases.filter("role = 'context'"), aliases.filter("role = 'input'"), "source_genome_id")
    return kept.withColumn("reason", F.lit("kept")).unionByName(out)


def lineage_keys(t, depths=(5, 6, 7)):
    """(source_genome_id, role, depth, group_key, fingerprint) of non-provisional codes."""
    a = t.assignments.select("*", lineage.parse_code("cglin_raw").alias("c"))
    usable = a.filter("cglin_scheme = 'scgMLST629_S' AND provisional = '' AND NOT contains(cglin_raw, '*')")
    rows = usable.withColumn("depth", F.explode(F.array(*[F.lit(d) for d in depths])))
    key = lineage.group_key("cglin_scheme", "cglin_scheme_version", "c.prefix", F.col("depth"))
    return rows.select("source_genome_id", "doc_id", "role", "depth", key.alias("group_key"), "database_sha256")


@query("J9", """
SELECT DISTINCT c.source_genome_id FROM keyed c JOIN keyed q ON q.role = 'input' AND c.role = 'context' AND q.depth = 5 AND c.depth = 5 AND q.group_key = c.group_key
  AND (q.database_sha256 = '' OR c.database_sha256 = '' OR q.database_sha256 = c.database_sha256)
WHERE c.group_key <> '' AND NOT c.prov AND NOT q.prov""", "keyed")
def lineage_match(t):
    keys = lineage_keys(t, (5,))
    return joins.match_lineage_groups(keys.filter("role = 'input'"), keys.filter("role = 'context'")).select("source_genome_id")


@query("J10", """
SELECT c.depth, count(*) AS matched FROM keyed c WHERE c.role = 'context' AND NOT c.prov AND c.group_key <> '' AND c.depth > 4
  AND (c.depth, c.group_key) IN (SELECT depth, group_key FROM keyed WHERE role = 'input' AND NOT prov) GROUP BY 1""", "keyed")
def level_counts(t):
    keys = lineage_keys(t)
    return joins.level_match_counts(keys.filter("role = 'input'"), keys.filter("role = 'context'"))


@query("J11", """
SELECT a_id AS sample_a, b_id AS sample_b, diffs AS allele_differences, shared AS shared_called_loci FROM good_pairs""", "good_pairs")
def scope_pairs(t):
    """Every comparable unordered in-scope pair, from the tiled kernel."""
    out = distances.pair_distances(t.calls, min_overlap=0.92)
    return out.select("sample_a", "sample_b", "allele_differences", "shared_called_loci")


@query("J12", "SELECT query_id, context_id, diffs AS allele_differences, shared AS shared_called_loci FROM near", "near")
def query_context(t):
    out = ranking.role_distances(t.calls, t.profiles, min_overlap=0.92)
    return out.select("query_id", "context_id", "allele_differences", "shared_called_loci")


@query("J13", """
SELECT i.node, i.s AS start, i.e AS "end", i.e - i.s + 1 AS length, coalesce(n, 0) AS segments, coalesce(n, 0) > 1 AS crosses_boundary
FROM intervals i LEFT JOIN (SELECT x.s, x.e, count(*) AS n FROM (SELECT DISTINCT s, e FROM intervals) x JOIN records r ON x.s <= r.e AND x.e >= r.s GROUP BY ALL) USING (s, e)""", "intervals records")
def interval_records(t):
    return joins.annotate_intervals(t.intervals, t.records)


@query("J14", """
WITH l AS (SELECT max(e) AS len FROM intervals), b AS (SELECT i AS bin, i * len // 97 AS lo, (i + 1) * len // 97 AS hi FROM range(97) r(i), l)
SELECT bin + 1 AS bin, count(DISTINCT node) AS branches FROM b JOIN intervals ON s - 1 < hi AND e - 1 >= lo GROUP BY 1""", "intervals")
def interval_bins(t):
    length = t.intervals.agg(F.max("end")).first()[0]
    return joins.branches_per_bin(t.intervals, length, 97)


_LINKED_SQL = """
 own AS (SELECT source_genome_id AS sample_id, CASE WHEN doc_id % 2 = 0 THEN '' WHEN doc_id % 5 = 0 THEN 'Unknown' ELSE country END AS country, CASE WHEN doc_id % 3 = 0 THEN '' ELSE host END AS host, run_accession FROM genomes),
 v AS (SELECT DISTINCT o.sample_id, 'country' AS field, g.country AS value FROM own o JOIN genomes g USING (run_accession) UNION SELECT DISTINCT o.sample_id, 'host', g.host FROM own o JOIN genomes g USING (run_accession)),
 m AS (SELECT sample_id, field, count(*) AS vals, min(value) AS value FROM v GROUP BY ALL)"""


@query("J15", f"""
WITH {_LINKED_SQL.strip()}
SELECT m.sample_id, field, vals AS "values", value, CASE WHEN vals > 1 THEN 'conflict' WHEN x IN ('', 'Unknown') THEN 'filled' WHEN x <> value THEN 'conflict' ELSE 'kept' END AS action,
  CASE WHEN x IN ('', 'Unknown') AND vals = 1 THEN value ELSE x END AS final
FROM (SELECT m.*, CASE field WHEN 'country' THEN own.country ELSE own.host END AS x FROM m JOIN own USING (sample_id)) m""", "genomes")
def linked_metadata(t):
    samples = t.genomes.selectExpr(
        "source_genome_id AS sample_id", "CASE WHEN doc_id % 2 = 0 THEN '' WHEN doc_id % 5 = 0 THEN 'Unknown' ELSE country END AS country",
        "CASE WHEN doc_id % 3 = 0 THEN '' ELSE host END AS host",
    )
    links = t.genomes.select(F.col("source_genome_id").alias("sample_id"), F.col("run_accession").alias("accession"))
    linked = t.genomes.select(F.col("run_accession").alias("accession"), "country", "host").distinct()
    filled, audit = joins.fill_from_linked(samples, links, linked, ["country", "host"])
    final = filled.unpivot("sample_id", ["country", "host"], "field", "final")
    return audit.join(final, ["sample_id", "field"])


@query("J16", """
WITH m AS (SELECT sample_id, locus, CAST(substring(sample_id, 2) AS BIGINT) AS k, allele FROM calls),
 map AS (SELECT CASE WHEN k % 97 = 0 THEN 'nobody' ELSE sample_id END AS sample_id, CASE WHEN k % 89 = 0 AND locus = 'L00' THEN 'LXX' ELSE locus END AS locus,
   CASE WHEN k % 83 = 0 AND locus = 'L01' THEN 'gone' ELSE locus || '_' || coalesce(allele, '0') || CASE WHEN k % 79 = 0 AND locus = 'L02' THEN 'b' ELSE '' END END AS record_id FROM m),
 maps AS (SELECT * FROM map UNION ALL SELECT * FROM map WHERE locus = 'L03' AND sample_id = 'V7'),
 c AS (SELECT x.*, m.allele FROM maps x JOIN m USING (sample_id, locus))
SELECT sample_id, locus, 'unknown_sample' AS reason, record_id AS detail FROM maps WHERE sample_id = 'nobody'
UNION ALL SELECT sample_id, locus, 'unknown_locus', record_id FROM maps WHERE locus = 'LXX'
UNION ALL SELECT sample_id, locus, 'unknown_record', record_id FROM maps WHERE record_id = 'gone'
UNION ALL SELECT sample_id, locus, 'duplicate_cell', CAST(count(*) AS VARCHAR) FROM maps GROUP BY ALL HAVING count(*) > 1
UNION ALL SELECT sample_id, locus, 'uncalled_cell', record_id FROM c WHERE allele IS NULL
UNION ALL SELECT '', locus, 'inconsistent_protein', allele FROM c WHERE allele IS NOT NULL AND record_id <> 'gone' GROUP BY locus, allele HAVING count(DISTINCT record_id) > 1""", "calls")
def mapping_integrity(t):
    k = F.col("sample_id").substr(2, 20).cast("bigint")
    m = t.calls.select("sample_id", "locus", "allele").withColumn("k", k)
    mapping = m.selectExpr(
        "CASE WHEN k % 97 = 0 THEN 'nobody' ELSE sample_id END AS sample_id", "CASE WHEN k % 89 = 0 AND locus = 'L00' THEN 'LXX' ELSE locus END AS locus",
        "CASE WHEN k % 83 = 0 AND locus = 'L01' THEN 'gone' ELSE concat(locus, '_', coalesce(allele, '0'), CASE WHEN k % 79 = 0 AND locus = 'L02' THEN 'b' ELSE '' END) END AS record_id",
    )
    mapping = mapping.union(mapping.filter("locus = 'L03' AND sample_id = 'V7'"))
    records = mapping.filter("record_id <> 'gone'").select("record_id", F.col("record_id").alias("protein_id")).distinct()
    return joins.mapping_problems(mapping, m.select("sample_id", "locus", "allele"), records, m.select("locus").distinct())


def allele_catalogue(t):
    """DNA per (locus, allele); the third allele of each locus is absent, some are broken."""
    a = t.calls.filter("allele IS NOT NULL AND allele <> '3'").select("locus", "allele").distinct()
    dna = F.expr("""concat('ATG', translate(substring(md5(concat(locus, allele)), 1, 30), '0123456789abcdef', 'ACGACGACGACGACGA'),
                    CASE WHEN locus IN ('L05', 'L06') AND allele = '1' THEN 'A' ELSE '' END, CASE WHEN locus = 'L07' AND allele = '1' THEN 'TAAGCC' ELSE '' END)""")
    return a.withColumn("dna", dna)


_CATALOGUE_SQL = """cat AS (SELECT DISTINCT locus, allele, 'ATG' || translate(substring(md5(locus || allele), 1, 30), '0123456789abcdef', 'ACGACGACGACGACGA')
   || CASE WHEN locus IN ('L05', 'L06') AND allele = '1' THEN 'A' ELSE '' END || CASE WHEN locus = 'L07' AND allele = '1' THEN 'TAAGCC' ELSE '' END AS dna FROM calls WHERE allele IS NOT NULL AND allele <> '3'),
 codons AS (SELECT map(list(cod ORDER BY i), list(aa ORDER BY i)) AS tab FROM (SELECT i, 'TCAG'[i // 16 + 1] || 'TCAG'[i // 4 % 4 + 1] || 'TCAG'[i % 4 + 1] AS cod,
   'FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG'[i + 1] AS aa FROM range(64) r(i))),
 prot AS (SELECT locus, allele, CASE WHEN length(dna) % 3 <> 0 THEN 'out_of_frame' WHEN contains(dna, 'TAAGCC') THEN 'internal_stop' END AS reason,
   'M' || array_to_string(list_transform(regexp_extract_all(dna, '...')[2:], lambda x: tab[x]), '') AS protein FROM cat, codons)"""


@query("J17", f"""
WITH {_CATALOGUE_SQL}
SELECT sample_id, c.locus, c.allele, CASE WHEN c.allele IS NULL THEN 'missing_call' WHEN p.locus IS NULL THEN 'missing_sequence' WHEN reason IS NOT NULL THEN 'invalid_cds' ELSE 'mapped' END AS status,
  CASE WHEN c.allele IS NULL THEN 'no_allele_call' WHEN p.locus IS NULL THEN 'allele_not_in_frozen_catalogue' ELSE reason END AS reason, CASE WHEN p.locus IS NOT NULL AND reason IS NULL THEN sha256(protein) END AS protein_id
FROM calls c LEFT JOIN prot p ON c.locus = p.locus AND c.allele = p.allele""", "calls")
def allele_mapping(t):
    return joins.map_alleles(t.calls.select("sample_id", "locus", "allele"), allele_catalogue(t), sequences.translate)


@query("J18", """
WITH d AS (SELECT 'sel' || (doc_id % 4) AS selection_id, CASE WHEN doc_id % 50 = 3 THEN 'X' || doc_id ELSE source_genome_id END AS sample_id, row_number() OVER (PARTITION BY doc_id % 4 ORDER BY doc_id) + CASE WHEN doc_id % 4 = 2 THEN 1 ELSE 0 END AS ord,
   CASE WHEN doc_id % 60 = 7 THEN '' ELSE 'r' END AS reason, doc_id % 40 = 5 AS mandatory FROM genomes WHERE role = 'context' OR doc_id % 100 = 0)
SELECT selection_id, sample_id, 'outside_pool' AS problem FROM d WHERE sample_id NOT IN (SELECT source_genome_id FROM genomes WHERE role = 'context')
UNION ALL SELECT selection_id, sample_id, 'input_listed_as_context' FROM d WHERE sample_id IN (SELECT source_genome_id FROM genomes WHERE role = 'input')
UNION ALL SELECT selection_id, sample_id, 'no_reason' FROM d WHERE reason = ''
UNION ALL SELECT 'sel2', '', 'broken_order'
UNION ALL SELECT '', sample_id, 'mandatory_not_in_every_selection' FROM d WHERE mandatory GROUP BY sample_id""", "genomes")
def selection_check(t):
    from pyspark.sql import Window

    g = t.genomes.filter("role = 'context' OR doc_id % 100 = 0").withColumn("grp", F.col("doc_id") % 4)
    ordered = g.withColumn("ord", F.row_number().over(Window.partitionBy("grp").orderBy("doc_id")) + F.expr("CASE WHEN grp = 2 THEN 1 ELSE 0 END"))
    decisions = ordered.selectExpr(
        "concat('sel', grp) AS selection_id", "CASE WHEN doc_id % 50 = 3 THEN concat('X', doc_id) ELSE source_genome_id END AS sample_id", "ord",
        "CASE WHEN doc_id % 60 = 7 THEN '' ELSE 'r' END AS reason", "doc_id % 40 = 5 AS mandatory",
    )
    ids = t.genomes.select(F.col("source_genome_id").alias("sample_id"), "role")
    return joins.selection_problems(decisions, ids.filter("role = 'context'").select("sample_id"), ids.filter("role = 'input'").select("sample_id"))


@query("J19", """
SELECT coalesce(t.sample_id, m.sample_id) AS sample_id, CASE WHEN t.sample_id IS NULL THEN 'Absent from reconstruction tree' WHEN m.sample_id IS NULL THEN 'No exact metadata match'
  WHEN m.observed = '' THEN 'Missing observed location' WHEN state <> observed THEN 'disagrees' ELSE 'matched' END AS status
FROM (SELECT sample_id, lineage AS state FROM samples WHERE k % 13 <> 0) t FULL OUTER JOIN
  (SELECT sample_id, CASE WHEN k % 17 = 0 THEN '' WHEN k % 19 = 0 THEN 'other' ELSE lineage END AS observed FROM samples WHERE k % 11 <> 0) m USING (sample_id)""", "samples")
def tip_status(t):
    tips = t.samples.filter("k % 13 <> 0").select("sample_id", F.col("lineage").alias("state"))
    meta = t.samples.filter("k % 11 <> 0").selectExpr("sample_id", "CASE WHEN k % 17 = 0 THEN ' ' WHEN k % 19 = 0 THEN 'other' ELSE lineage END AS observed")
    return joins.match_tips(tips, meta)


@query("J20", """
WITH n AS (SELECT *, min(diffs) OVER (PARTITION BY query_id) AS best FROM near)
SELECT q.country AS source, n.country AS target, count(DISTINCT query_id) AS query_count, count(DISTINCT context_id) AS context_count, count(*) AS comparison_count,
  min(diffs) AS min_differences, max(diffs) AS max_differences, min(shared) AS min_shared, max(shared) AS max_shared
FROM n JOIN profiles q ON q.sample_id = n.query_id WHERE diffs = best GROUP BY ALL""", "near profiles")
def place_connections(t):
    near = ranking.nearest_context(t.calls, t.profiles, 0.92, AS_OF).filter("status = 'matched'")
    places = t.profiles.select("sample_id", geo.known_location("country").alias("place"))
    return joins.nearest_place_connections(near, places)


@query("J21", """
WITH c AS (SELECT row_number() OVER (ORDER BY cglin_scheme, cglin_scheme_version, database_sha256) AS catalogue_id, * FROM (SELECT DISTINCT cglin_scheme, cglin_scheme_version, database_sha256 FROM assignments WHERE database_sha256 <> repeat('b', 64)))
SELECT a.source_genome_id AS sample_id, CAST(c.catalogue_id IS NOT NULL AS INTEGER) AS catalogues, CASE WHEN c.catalogue_id IS NOT NULL THEN a.cglin_scheme || '/' || a.cglin_scheme_version || '/' || substring(a.database_sha256, 1, 1) END AS catalogue_id,
  CASE WHEN c.catalogue_id IS NOT NULL THEN 'matched' WHEN doc_id % 5 = 0 THEN 'no_profile' ELSE 'no_compatible_catalogue' END AS status
FROM assignments a LEFT JOIN c USING (cglin_scheme, cglin_scheme_version, database_sha256)""", "assignments")
def catalogue_match(t):
    a = t.assignments.selectExpr(
        "source_genome_id AS sample_id", "cglin_scheme AS scheme", "cglin_scheme_version AS version", "CAST(NULL AS STRING) AS database_version", "upper(database_sha256) AS database_sha256", "doc_id % 5 <> 0 AS has_profile"
    )
    catalogues = a.filter("database_sha256 <> repeat('B', 64)").select("scheme", "version", "database_version", F.lower("database_sha256").alias("database_sha256")).distinct()
    catalogues = catalogues.withColumn("catalogue_id", F.concat_ws("/", "scheme", "version", F.substring("database_sha256", 1, 1)))
    return joins.match_catalogues(a, catalogues)


@query("J22", """
SELECT doc_id % 5 AS batch, source_genome_id, CASE WHEN doc_id % 8 = 0 THEN 0 WHEN doc_id % 9 = 0 THEN 2 ELSE 1 END AS copies,
  CASE WHEN doc_id % 10 = 7 AND doc_id % 8 = 0 THEN NULL WHEN doc_id % 10 = 7 THEN 'unrequested' WHEN doc_id % 8 = 0 THEN 'missing' WHEN doc_id % 9 = 0 THEN 'duplicate' ELSE 'returned' END AS status
FROM assignments WHERE NOT (doc_id % 10 = 7 AND doc_id % 8 = 0)""", "assignments")
def batches(t):
    a = t.assignments.select((F.col("doc_id") % 5).alias("batch"), "source_genome_id", "doc_id")
    returned = a.filter("doc_id % 8 <> 0").union(a.filter("doc_id % 8 <> 0 AND doc_id % 9 = 0"))
    return joins.reconcile_batches(a.filter("doc_id % 10 <> 7"), returned)


@query("J23", """
SELECT sample_id, CASE WHEN k % 7 = 0 AND k % 50 = 0 THEN 'fail' ELSE 'pass' END AS species_check, CASE WHEN k % 5 = 0 THEN 'review' ELSE 'pass' END AS strain_name_check,
  CASE WHEN year(first_day) = CAST(substring(coalesce(CAST(first_day AS VARCHAR), ''), 1, 4) AS INTEGER) AND k % 6 <> 0 THEN 'pass' ELSE 'review' END AS year_check, CASE WHEN k % 8 = 0 THEN 'review' ELSE 'pass' END AS country_check FROM samples""", "samples")
def verification(t):
    claimed = t.samples.selectExpr("sample_id", "concat('Strain ', k) AS strain", "CASE WHEN k % 6 = 0 THEN '1800' ELSE date_format(first_day, 'yyyy') END AS year", "country")
    recorded = t.samples.selectExpr(
        "sample_id", "CASE WHEN k % 350 = 0 THEN 'Other' ELSE species END AS organism", "CASE WHEN k % 5 = 0 THEN 'else' ELSE concat('strain-', k) END AS strain",
        "date_format(first_day, 'dd/MM/yyyy') AS collection_date", "CASE WHEN k % 8 = 0 THEN 'Elsewhere' ELSE concat(lower(country), ': town') END AS country",
    )
    return joins.verify_records(claimed, recorded, "sample_id", "Klebsiella")
