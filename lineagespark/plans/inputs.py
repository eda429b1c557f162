"""Operator inputs derived from the driver tables, once for Spark and once as SQL views.

Every view covers its whole base table. The two forms of a view must give equal rows.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2026-01-01"


class Inputs:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def samples(self) -> DataFrame:
        """One sample per customer, dated by the customer's first order."""
        first = self.table("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
            F.min(F.to_date("o_orderdate")).alias("d")
        )
        places = self.table("nation").join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")
        ).select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country"), F.col("r_name").alias("region"))
        df = self.table("customer").join(places, "c_nationkey").join(first, "c_custkey", "left")
        return df.selectExpr(
            "c_custkey AS k",
            "concat('C', c_custkey) AS sample_id",
            "CASE WHEN c_custkey % 20 = 0 THEN 'local' ELSE 'context' END AS origin",
            "CASE WHEN c_custkey % 20 = 0 THEN 'input' ELSE 'context' END AS role",
            "CASE WHEN c_custkey % 7 = 0 THEN 'Klebsiella_Variicola' ELSE 'Klebsiella pneumoniae' END AS species",
            "c_mktsegment AS lineage",
            "CASE c_custkey % 4 WHEN 0 THEN 'ST11' WHEN 1 THEN '15' WHEN 2 THEN '' ELSE 'x' END AS mlst_st",
            "country",
            "region",
            "CASE WHEN c_custkey % 3 = 0 THEN concat('N', c_custkey % 10) ELSE '' END AS nuts2",
            "CASE c_custkey % 5 WHEN 0 THEN 'Homo sapiens' WHEN 1 THEN 'Bos taurus' WHEN 2 THEN '' ELSE 'Gallus gallus' END AS host",
            "CASE WHEN c_custkey % 6 = 0 THEN '' ELSE concat('P', c_custkey DIV 4) END AS patient_id",
            "CASE c_custkey % 10 WHEN 0 THEN NULL WHEN 1 THEN false ELSE true END AS qc_pass",
            "CAST(round(c_acctbal * 100) AS BIGINT) AS n50",
            "d AS first_day",
            """CASE c_custkey % 8
                 WHEN 0 THEN date_format(d, 'yyyy')
                 WHEN 1 THEN date_format(d, 'yyyy-MM')
                 WHEN 3 THEN ''
                 WHEN 4 THEN concat(CAST(d AS STRING), '/', CAST(date_add(d, 40) AS STRING))
                 WHEN 7 THEN CASE c_custkey % 3 WHEN 0 THEN 'unknown' WHEN 1 THEN 'not a date' ELSE '2999-05-01' END
                 ELSE CAST(d AS STRING) END AS collection_date""",
        )

    @cached_property
    def dated(self) -> DataFrame:
        """Samples with declared bounds of several kinds, right and wrong."""
        return self.samples.selectExpr(
            "sample_id",
            "collection_date",
            """CAST(CASE k % 6 WHEN 0 THEN first_day WHEN 1 THEN trunc(first_day, 'MM') WHEN 2 THEN first_day
                    WHEN 3 THEN first_day END AS STRING) AS date_start""",
            """CAST(CASE k % 6 WHEN 0 THEN first_day WHEN 1 THEN last_day(first_day) WHEN 2 THEN date_add(first_day, 3)
                    WHEN 3 THEN date_add(first_day, CAST(k % 2 AS INT)) END AS STRING) AS date_end""",
            "CASE k % 6 WHEN 0 THEN 'day' WHEN 1 THEN 'month' WHEN 2 THEN 'month' WHEN 5 THEN 'missing' END AS date_precision",
        )

    @cached_property
    def countries(self) -> DataFrame:
        """A country table with two-letter codes made from the nation key."""
        return self.table("nation").selectExpr(
            "concat(chr(65 + n_nationkey % 26), chr(65 + (n_nationkey + 7) % 26)) AS code", "n_name AS name"
        )

    @cached_property
    def assignments(self) -> DataFrame:
        """Lineage code rows per document; every eleventh id has a second, different row."""
        d = self.table("documents").join(self.table("labels"), "doc_id", "left")
        base = """concat_ws('_', doc_id % 2, doc_id % 3, 1, doc_id % 2, doc_id % 5, n_chars % 2, n_chars % 3,
                            n_chars % 7, doc_id % 4, doc_id % 13)"""
        short = "concat_ws('_', doc_id % 2, doc_id % 3, 1, doc_id % 2, doc_id % 5, n_chars % 2, '*', '*', '*', '*')"
        code = f"""CASE doc_id % 9 WHEN 1 THEN {short} WHEN 2 THEN '1_2_*_4' WHEN 3 THEN ''
                   WHEN 4 THEN substring_index({base}, '_', 7) WHEN 5 THEN 'x_1' ELSE {base} END"""
        first = d.selectExpr(
            "doc_id",
            "concat('D', doc_id) AS source_genome_id",
            f"{code} AS cglin_raw",
            "CASE WHEN quality = 1 THEN 'true' ELSE '' END AS provisional",
            "CASE WHEN doc_id % 19 = 0 THEN 'other' ELSE 'scgMLST629_S' END AS cglin_scheme",
            "CASE WHEN doc_id % 4 = 0 THEN 'v2' ELSE 'v1' END AS cglin_scheme_version",
            "CASE doc_id % 6 WHEN 0 THEN '' WHEN 1 THEN '' WHEN 2 THEN repeat('b', 64) ELSE repeat('a', 64) END AS database_sha256",
            "CASE WHEN doc_id % 27 = 0 THEN 'input' ELSE 'context' END AS role",
            "CASE WHEN doc_id % 2 = 0 THEN '11' ELSE '15' END AS mlst_st",
            "'Klebsiella pneumoniae' AS species",
        )
        return first

    @cached_property
    def exported(self) -> DataFrame:
        """The assignment rows as several exports: repeats that agree and repeats that do not."""
        a = self.assignments
        again = a.filter("doc_id % 6 = 0")
        other = a.filter("doc_id % 11 = 0").withColumn("cglin_raw", F.lit("1_1_1_1_1_1_1_1_1_1"))
        return a.unionByName(again).unionByName(other)

    @cached_property
    def genomes(self) -> DataFrame:
        """Public records: documents with exact copies sharing an accession, and page links."""
        letters = "regexp_replace(text, '[^A-Za-z]', '')"
        accession = lambda prefix, value: (
            f"concat('{prefix}', CAST(conv(substring(md5({value}), 1, 7), 16, 10) AS BIGINT))"
        )
        return self.table("documents").selectExpr(
            "doc_id",
            "concat('D', doc_id) AS source_genome_id",
            f"{accession('SAMN', 'text')} AS biosample",
            f"{accession('SRR', letters)} AS run_accession",
            f"CASE WHEN doc_id % 3 = 0 THEN concat({accession('GCA_', 'text')}, '.', 1 + doc_id % 2) ELSE '' END AS assembly_accession",
            "concat('PRJNA', doc_id % 7) AS study_accession",
            "source AS country",
            "lang AS host",
            "CASE doc_id % 10 WHEN 0 THEN NULL WHEN 1 THEN false ELSE true END AS qc_pass",
            "n_chars",
            "CASE WHEN doc_id % 20 = 0 THEN 'input' ELSE 'context' END AS role",
        )

    @cached_property
    def calls(self) -> DataFrame:
        """Long allele calls: 64 loci per vector, alleles from value bands, some missing."""
        e = self.table("embeddings").selectExpr("vec_id", "label", "posexplode(embedding) AS (dim, v)")
        return e.selectExpr(
            "concat('s', label % 3) AS scope_id",
            "concat('V', vec_id) AS sample_id",
            "concat('L', lpad(CAST(dim AS STRING), 2, '0')) AS locus",
            """CASE WHEN (vec_id * 31 + dim * 17) % 23 = 0 THEN NULL
                    ELSE CAST(1 + CAST(CAST(v AS DOUBLE) > 0.0D AS INT) + CAST(CAST(v AS DOUBLE) > 0.1D AS INT) AS STRING) END AS allele""",
        )

    @cached_property
    def profiles(self) -> DataFrame:
        """Sample rows of the profile cohort."""
        return self.table("embeddings").selectExpr(
            "vec_id",
            "concat('V', vec_id) AS sample_id",
            "concat('s', label % 3) AS scope_id",
            "CASE WHEN vec_id % 25 = 0 THEN 'local' ELSE 'context' END AS origin",
            "concat('NATION_', label) AS country",
            "CASE WHEN vec_id % 4 = 0 THEN '' ELSE concat('H', vec_id % 3) END AS host",
            "CASE WHEN vec_id % 7 = 0 THEN '' ELSE CAST(2000 + vec_id % 9 AS STRING) END AS collection_date",
        )

    @cached_property
    def vectors(self) -> DataFrame:
        """Protein vectors: eight loci of eight dimensions; equal (locus, band) share a protein."""
        e = self.table("embeddings").selectExpr("vec_id", "label", "embedding", "explode(sequence(0, 7)) AS l")
        return e.selectExpr(
            "concat('p', vec_id, '_', l) AS protein_id",
            "concat('V', vec_id) AS sample_id",
            "concat('L', l) AS locus",
            "transform(slice(embedding, l * 8 + 1, 8), x -> CAST(x AS DOUBLE)) AS embedding",
        )

    @cached_property
    def tree(self) -> DataFrame:
        """root > region > nation > customer as an edge table with branch lengths."""
        root = self.table("region").selectExpr(
            "'t' AS tree_id", "'root' AS node", "CAST(NULL AS STRING) AS parent", "0.0D AS branch_length", "false AS is_tip"
        ).limit(1)
        region = self.table("region").selectExpr(
            "'t' AS tree_id", "concat('r', r_regionkey) AS node", "'root' AS parent",
            "0.1D * (r_regionkey % 7 + 1) AS branch_length", "false AS is_tip",
        )
        nation = self.table("nation").selectExpr(
            "'t' AS tree_id", "concat('n', n_nationkey) AS node", "concat('r', n_regionkey) AS parent",
            "0.1D * (n_nationkey % 7 + 1) AS branch_length", "false AS is_tip",
        )
        tips = self.table("customer").selectExpr(
            "'t' AS tree_id", "concat('C', c_custkey) AS node", "concat('n', c_nationkey) AS parent",
            "0.1D * (c_custkey % 7 + 1) AS branch_length", "true AS is_tip",
        )
        return root.unionByName(region).unionByName(nation).unionByName(tips)

    @cached_property
    def alignment(self) -> DataFrame:
        """256 sites per supplier from eight digests of its name; two hex digits are not bases."""
        s = self.table("supplier").selectExpr("s_suppkey", "s_name", "s_nationkey", "explode(sequence(0, 7)) AS block")
        return s.selectExpr(
            "concat('S', s_suppkey) AS sample_id",
            "s_suppkey AS ord",
            "CAST(block AS INT) AS block",
            "translate(md5(concat(CASE WHEN s_suppkey % 3 = 0 THEN 'x' ELSE s_name END, block)), '0123456789abcdef', 'AAAACCCCGGGGTTN-') AS bases",
        )

    @cached_property
    def isolates(self) -> DataFrame:
        """Sample rows of the alignment."""
        return self.table("supplier").selectExpr(
            "concat('S', s_suppkey) AS sample_id",
            "s_suppkey AS ord",
            "CASE WHEN s_suppkey % 5 = 0 THEN 'context' ELSE 'local' END AS origin",
            "CASE WHEN s_suppkey % 4 = 0 THEN '' ELSE concat('P', s_suppkey DIV 6) END AS patient_id",
            """CASE s_suppkey % 5 WHEN 0 THEN '' WHEN 1 THEN '2019' WHEN 2 THEN concat('2019-0', 1 + s_suppkey % 3)
               ELSE concat('2020-0', 1 + s_suppkey % 4, '-11') END AS collection_date""",
            "concat('n', s_nationkey) AS location",
        )

    @cached_property
    def intervals(self) -> DataFrame:
        return self.table("lineitem").selectExpr(
            "concat('b', l_suppkey) AS node",
            "l_partkey * 3 + 1 AS start",
            "l_partkey * 3 + CAST(l_quantity AS BIGINT) AS end",
        )

    @cached_property
    def records(self) -> DataFrame:
        """Reference records of 500 bases, one per fifteenth of the part range."""
        return self.table("part").selectExpr("p_partkey * 3 DIV 500 AS r").groupBy("r").count().selectExpr(
            "concat('rec', r) AS name", "r * 500 + 1 AS start", "r * 500 + 500 AS end"
        )

    @cached_property
    def points(self) -> DataFrame:
        """Distance against date midpoint, per lineage cohort."""
        return self.samples.selectExpr("sample_id", "lineage AS cohort", "role", "country", "k", "collection_date").join(
            self.table("customer").selectExpr("concat('C', c_custkey) AS sample_id", "c_acctbal / 1000.0D AS distance"),
            "sample_id",
        )

    @cached_property
    def runs(self) -> DataFrame:
        """Permutation metrics: one observed row and many null rows per method and analysis."""
        return self.table("events").selectExpr(
            "event_type AS method",
            "concat('a', user_id % 2) AS analysis",
            "CASE WHEN event_id < 10 THEN NULL ELSE event_id END AS permutation",
            "event_id",
            "value AS rate",
            "value * 0.9D AS rate_lower",
            "value * 1.1D AS rate_upper",
            "value / 1000.0D AS r_squared",
        )


_FIRST_CODE = """concat_ws('_', doc_id % 2, doc_id % 3, 1, doc_id % 2, doc_id % 5, n_chars % 2, n_chars % 3,
    n_chars % 7, doc_id % 4, doc_id % 13)"""

VIEWS: dict[str, tuple[list[str], str]] = {
    "samples": ([], """
      SELECT c_custkey AS k, 'C' || c_custkey AS sample_id,
        CASE WHEN c_custkey % 20 = 0 THEN 'local' ELSE 'context' END AS origin,
        CASE WHEN c_custkey % 20 = 0 THEN 'input' ELSE 'context' END AS role,
        CASE WHEN c_custkey % 7 = 0 THEN 'Klebsiella_Variicola' ELSE 'Klebsiella pneumoniae' END AS species,
        c_mktsegment AS lineage,
        CASE c_custkey % 4 WHEN 0 THEN 'ST11' WHEN 1 THEN '15' WHEN 2 THEN '' ELSE 'x' END AS mlst_st,
        n_name AS country, r_name AS region,
        CASE WHEN c_custkey % 3 = 0 THEN 'N' || (c_custkey % 10) ELSE '' END AS nuts2,
        CASE c_custkey % 5 WHEN 0 THEN 'Homo sapiens' WHEN 1 THEN 'Bos taurus' WHEN 2 THEN '' ELSE 'Gallus gallus' END AS host,
        CASE WHEN c_custkey % 6 = 0 THEN '' ELSE 'P' || (c_custkey // 4) END AS patient_id,
        CASE c_custkey % 10 WHEN 0 THEN NULL WHEN 1 THEN false ELSE true END AS qc_pass,
        CAST(round(c_acctbal * 100) AS BIGINT) AS n50,
        d AS first_day,
        CASE c_custkey % 8
          WHEN 0 THEN strftime(d, '%Y') WHEN 1 THEN strftime(d, '%Y-%m') WHEN 3 THEN ''
          WHEN 4 THEN CAST(d AS VARCHAR) || '/' || CAST(d + 40 AS VARCHAR)
          WHEN 7 THEN CASE c_custkey % 3 WHEN 0 THEN 'unknown' WHEN 1 THEN 'not a date' ELSE '2999-05-01' END
          ELSE CAST(d AS VARCHAR) END AS collection_date
      FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
      LEFT JOIN (SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS d FROM orders GROUP BY 1) ON o_custkey = c_custkey"""),
    "dated": (["samples"], """
      SELECT sample_id, collection_date,
        CAST(CASE k % 6 WHEN 0 THEN first_day WHEN 1 THEN CAST(date_trunc('month', first_day) AS DATE)
             WHEN 2 THEN first_day WHEN 3 THEN first_day END AS VARCHAR) AS date_start,
        CAST(CASE k % 6 WHEN 0 THEN first_day WHEN 1 THEN last_day(first_day) WHEN 2 THEN first_day + 3
             WHEN 3 THEN first_day + CAST(k % 2 AS INTEGER) END AS VARCHAR) AS date_end,
        CASE k % 6 WHEN 0 THEN 'day' WHEN 1 THEN 'month' WHEN 2 THEN 'month' WHEN 5 THEN 'missing' END AS date_precision
      FROM samples"""),
    "interval_of": (["samples"], """
      SELECT sample_id, s, e, p, year(s) + (dayofyear(s) - 1) / dayofyear(make_date(year(s), 12, 31)) AS year_min,
        year(e) + (dayofyear(e) - 1) / dayofyear(make_date(year(e), 12, 31)) AS year_max, year(s) AS y
      FROM (SELECT sample_id,
          CASE length(collection_date) WHEN 4 THEN 'year' WHEN 7 THEN 'month' ELSE 'day' END AS p,
          TRY_CAST(CASE length(collection_date) WHEN 4 THEN collection_date || '-01-01' WHEN 7 THEN CASE WHEN regexp_matches(collection_date, '^[0-9]{4}-') THEN collection_date || '-01' END
               WHEN 10 THEN collection_date END AS DATE) AS s,
          CASE length(collection_date) WHEN 4 THEN TRY_CAST(collection_date || '-12-31' AS DATE)
               WHEN 7 THEN last_day(TRY_CAST(CASE WHEN regexp_matches(collection_date, '^[0-9]{4}-') THEN collection_date || '-01' END AS DATE))
               ELSE TRY_CAST(collection_date AS DATE) END AS e
        FROM samples WHERE length(collection_date) IN (4, 7, 10)) WHERE s IS NOT NULL"""),
    "countries": ([], """
      SELECT chr(CAST(65 + n_nationkey % 26 AS INTEGER)) || chr(CAST(65 + (n_nationkey + 7) % 26 AS INTEGER)) AS code, n_name AS name FROM nation"""),
    "assignments": ([], f"""
      SELECT doc_id, 'D' || doc_id AS source_genome_id,
        CASE doc_id % 9 WHEN 1 THEN concat_ws('_', doc_id % 2, doc_id % 3, 1, doc_id % 2, doc_id % 5, n_chars % 2, '*', '*', '*', '*')
          WHEN 2 THEN '1_2_*_4' WHEN 3 THEN ''
          WHEN 4 THEN concat_ws('_', doc_id % 2, doc_id % 3, 1, doc_id % 2, doc_id % 5, n_chars % 2, n_chars % 3)
          WHEN 5 THEN 'x_1' ELSE {_FIRST_CODE} END AS cglin_raw,
        CASE WHEN quality = 1 THEN 'true' ELSE '' END AS provisional,
        CASE WHEN doc_id % 19 = 0 THEN 'other' ELSE 'scgMLST629_S' END AS cglin_scheme,
        CASE WHEN doc_id % 4 = 0 THEN 'v2' ELSE 'v1' END AS cglin_scheme_version,
        CASE doc_id % 6 WHEN 0 THEN '' WHEN 1 THEN '' WHEN 2 THEN repeat('b', 64) ELSE repeat('a', 64) END AS database_sha256,
        CASE WHEN doc_id % 27 = 0 THEN 'input' ELSE 'context' END AS role,
        CASE WHEN doc_id % 2 = 0 THEN '11' ELSE '15' END AS mlst_st,
        'Klebsiella pneumoniae' AS species
      FROM documents LEFT JOIN labels USING (doc_id)"""),
    "exported": (["assignments"], """
      SELECT * FROM assignments UNION ALL SELECT * FROM assignments WHERE doc_id % 6 = 0
      UNION ALL SELECT * REPLACE ('1_1_1_1_1_1_1_1_1_1' AS cglin_raw) FROM assignments WHERE doc_id % 11 = 0"""),
    "parsed": (["assignments"], """
      SELECT *, CASE WHEN ok THEN list_transform(toks[1:n], lambda x: CAST(x AS BIGINT)) ELSE CAST([] AS BIGINT[]) END AS prefix,
        CASE WHEN cglin_scheme <> 'scgMLST629_S' THEN 'unsupported' WHEN cglin_raw = '' THEN 'missing'
             WHEN NOT ok0 THEN 'malformed' WHEN n = 10 THEN 'complete' ELSE 'partial' END AS code_status
      FROM (SELECT *, ok0 AND cglin_raw <> '' AND cglin_scheme = 'scgMLST629_S' AS ok
        FROM (SELECT *, len(toks) <= 10 AND len(list_filter(toks[n + 1:], lambda x: x NOT IN ('', '-', '?', '*'))) = 0 AS ok0
          FROM (SELECT *, coalesce(list_position(list_transform(toks, lambda x: regexp_full_match(x, '[0-9]+')), false), len(toks) + 1) - 1 AS n
            FROM (SELECT *, string_split(cglin_raw, '_') AS toks FROM assignments))))"""),
    "keyed": (["parsed"], """
      SELECT doc_id, source_genome_id, cglin_raw, provisional, cglin_scheme, cglin_scheme_version, database_sha256, role, mlst_st, species,
        prefix, code_status, (provisional = 'true' OR contains(cglin_raw, '*')) AS prov, d AS depth,
        CASE WHEN len(prefix) >= d THEN '["' || cglin_scheme || '","' || cglin_scheme_version || '",[' || array_to_string(prefix[1:d], ',') || ']]' ELSE '' END AS group_key
      FROM parsed, (VALUES (4), (5), (6), (7)) v(d)"""),
    "genomes": ([], """
      SELECT doc_id, 'D' || doc_id AS source_genome_id,
        'SAMN' || CAST(('0x' || substring(md5(text), 1, 7)) AS BIGINT) AS biosample,
        'SRR' || CAST(('0x' || substring(md5(regexp_replace(text, '[^A-Za-z]', '', 'g')), 1, 7)) AS BIGINT) AS run_accession,
        CASE WHEN doc_id % 3 = 0 THEN 'GCA_' || CAST(('0x' || substring(md5(text), 1, 7)) AS BIGINT) || '.' || (1 + doc_id % 2) ELSE '' END AS assembly_accession,
        'PRJNA' || (doc_id % 7) AS study_accession, source AS country, lang AS host,
        CASE doc_id % 10 WHEN 0 THEN NULL WHEN 1 THEN false ELSE true END AS qc_pass, n_chars,
        CASE WHEN doc_id % 20 = 0 THEN 'input' ELSE 'context' END AS role
      FROM documents"""),
    "genome_aliases": (["genomes"], """
      SELECT DISTINCT source_genome_id, doc_id, role, alias FROM (
        SELECT source_genome_id, doc_id, role, biosample AS alias FROM genomes
        UNION ALL SELECT source_genome_id, doc_id, role, run_accession FROM genomes
        UNION ALL SELECT source_genome_id, doc_id, role, regexp_replace(assembly_accession, '\\.[0-9]+$', '') FROM genomes WHERE assembly_accession <> '')"""),
    "calls": ([], """
      SELECT 's' || (label % 3) AS scope_id, 'V' || vec_id AS sample_id, 'L' || lpad(CAST(dim AS VARCHAR), 2, '0') AS locus,
        CASE WHEN (vec_id * 31 + dim * 17) % 23 = 0 THEN NULL
             ELSE CAST(1 + CAST(CAST(embedding[dim + 1] AS DOUBLE) > CAST(0.0 AS DOUBLE) AS INTEGER) + CAST(CAST(embedding[dim + 1] AS DOUBLE) > CAST(0.1 AS DOUBLE) AS INTEGER) AS VARCHAR) END AS allele
      FROM embeddings, range(64) t(dim)"""),
    "profiles": ([], """
      SELECT vec_id, 'V' || vec_id AS sample_id, 's' || (label % 3) AS scope_id,
        CASE WHEN vec_id % 25 = 0 THEN 'local' ELSE 'context' END AS origin, 'NATION_' || label AS country,
        CASE WHEN vec_id % 4 = 0 THEN '' ELSE 'H' || (vec_id % 3) END AS host,
        CASE WHEN vec_id % 7 = 0 THEN '' ELSE CAST(2000 + vec_id % 9 AS VARCHAR) END AS collection_date
      FROM embeddings"""),
    "pairs": (["calls"], """
      SELECT a.scope_id, a.sample_id AS a_id, b.sample_id AS b_id, count(*) AS shared,
        count(*) FILTER (WHERE a.allele <> b.allele) AS diffs, 64 AS loci,
        count(*) / 64 AS overlap, count(*) FILTER (WHERE a.allele <> b.allele) / count(*) AS distance
      FROM calls a JOIN calls b ON a.scope_id = b.scope_id AND a.locus = b.locus AND a.sample_id < b.sample_id
      WHERE a.allele IS NOT NULL AND b.allele IS NOT NULL GROUP BY ALL"""),
    "good_pairs": (["pairs"], "SELECT * FROM pairs WHERE overlap >= 0.92"),
    "near": (["pairs", "profiles"], """
      SELECT q.sample_id AS query_id, c.sample_id AS context_id, c.country, c.collection_date, diffs, shared, distance
      FROM (SELECT a_id, b_id, diffs, shared, distance FROM pairs WHERE overlap >= 0.92
            UNION ALL SELECT b_id, a_id, diffs, shared, distance FROM pairs WHERE overlap >= 0.92) p
      JOIN profiles q ON q.sample_id = p.a_id AND q.origin = 'local'
      JOIN profiles c ON c.sample_id = p.b_id AND c.origin = 'context'"""),
    "vectors": ([], """
      SELECT 'p' || vec_id || '_' || l AS protein_id, 'V' || vec_id AS sample_id, 'L' || l AS locus,
        list_transform(embedding[l * 8 + 1:l * 8 + 8], lambda x: CAST(x AS DOUBLE)) AS embedding
      FROM embeddings, range(8) t(l)"""),
    "tree": ([], """
      SELECT 't' AS tree_id, 'root' AS node, CAST(NULL AS VARCHAR) AS parent, CAST(0 AS DOUBLE) AS branch_length, false AS is_tip
      UNION ALL SELECT 't', 'r' || r_regionkey, 'root', CAST(0.1 AS DOUBLE) * (r_regionkey % 7 + 1), false FROM region
      UNION ALL SELECT 't', 'n' || n_nationkey, 'r' || n_regionkey, CAST(0.1 AS DOUBLE) * (n_nationkey % 7 + 1), false FROM nation
      UNION ALL SELECT 't', 'C' || c_custkey, 'n' || c_nationkey, CAST(0.1 AS DOUBLE) * (c_custkey % 7 + 1), true FROM customer"""),
    "closure": (["tree"], """
      SELECT node, node AS anc, CAST(0 AS DOUBLE) AS dist, 0 AS steps FROM tree
      UNION ALL SELECT c.node, t.parent, c.dist + t.branch_length, c.steps + 1
      FROM closure c JOIN tree t ON c.anc = t.node WHERE t.parent IS NOT NULL"""),
    "alignment": ([], """
      SELECT 'S' || s_suppkey AS sample_id, s_suppkey AS ord, block,
        translate(md5(CASE WHEN s_suppkey % 3 = 0 THEN 'x' ELSE s_name END || block), '0123456789abcdef', 'AAAACCCCGGGGTTN-') AS bases
      FROM supplier, range(8) t(block)"""),
    "isolates": ([], """
      SELECT 'S' || s_suppkey AS sample_id, s_suppkey AS ord,
        CASE WHEN s_suppkey % 5 = 0 THEN 'context' ELSE 'local' END AS origin,
        CASE WHEN s_suppkey % 4 = 0 THEN '' ELSE 'P' || (s_suppkey // 6) END AS patient_id,
        CASE s_suppkey % 5 WHEN 0 THEN '' WHEN 1 THEN '2019' WHEN 2 THEN '2019-0' || (1 + s_suppkey % 3)
             ELSE '2020-0' || (1 + s_suppkey % 4) || '-11' END AS collection_date,
        'n' || s_nationkey AS location FROM supplier"""),
    "sites": (["alignment"], """
      SELECT sample_id, ord, block * 32 + i AS pos, bases[i] AS base FROM alignment, range(1, 33) t(i)"""),
    "snps": (["sites", "isolates"], """
      SELECT s1.sample_id AS a_id, s2.sample_id AS b_id, s1.origin AS origin_1, s2.origin AS origin_2,
        s1.collection_date AS date_1, s2.collection_date AS date_2, s1.patient_id AS patient_1, s2.patient_id AS patient_2,
        s1.location AS location_1, s2.location AS location_2, snps, callable_sites,
        CASE WHEN s1.origin = 'context' AND s2.origin = 'context' THEN 'context_context'
             WHEN s1.origin = 'context' OR s2.origin = 'context' THEN 'focal_context' ELSE 'focal_focal' END AS comparison,
        CASE WHEN length(s1.collection_date) >= 7 AND substring(s1.collection_date, 1, 7) = substring(s2.collection_date, 1, 7) THEN 'same_month'
             WHEN s1.collection_date <> '' AND substring(s1.collection_date, 1, 4) = substring(s2.collection_date, 1, 4) THEN 'same_year'
             WHEN s1.collection_date <> '' AND s2.collection_date <> '' THEN 'between_years' ELSE 'date_unavailable' END AS period_class,
        CASE WHEN s1.patient_id = '' OR s2.patient_id = '' THEN 'patient_unavailable' WHEN s1.patient_id = s2.patient_id THEN 'same_patient'
             ELSE 'different_patients' END AS patient_class
      FROM (SELECT a.sample_id AS a_id, b.sample_id AS b_id,
              count(*) FILTER (WHERE a.base IN ('A','C','G','T') AND b.base IN ('A','C','G','T')) AS callable_sites,
              count(*) FILTER (WHERE a.base IN ('A','C','G','T') AND b.base IN ('A','C','G','T') AND a.base <> b.base) AS snps
            FROM sites a JOIN sites b ON a.pos = b.pos AND a.sample_id < b.sample_id GROUP BY ALL) p
      JOIN isolates s1 ON s1.sample_id = p.a_id JOIN isolates s2 ON s2.sample_id = p.b_id"""),
    "intervals": ([], """
      SELECT 'b' || l_suppkey AS node, l_partkey * 3 + 1 AS s, l_partkey * 3 + CAST(l_quantity AS BIGINT) AS e FROM lineitem"""),
    "records": ([], """
      SELECT DISTINCT 'rec' || (p_partkey * 3 // 500) AS name, p_partkey * 3 // 500 * 500 + 1 AS s, p_partkey * 3 // 500 * 500 + 500 AS e FROM part"""),
    "points": (["samples", "interval_of"], """
      SELECT sample_id, s.lineage AS cohort, s.role, s.country, s.k, c_acctbal / CAST(1000 AS DOUBLE) AS distance,
        CASE WHEN i.s <= DATE '2026-01-01' THEN (i.year_min + i.year_max) / 2 END AS x
      FROM samples s JOIN customer ON 'C' || c_custkey = sample_id LEFT JOIN interval_of i USING (sample_id)"""),
    "runs": ([], """
      SELECT event_type AS method, 'a' || (user_id % 2) AS analysis, CASE WHEN event_id < 10 THEN NULL ELSE event_id END AS permutation,
        event_id, value AS rate, value * CAST(0.9 AS DOUBLE) AS rate_lower, value * CAST(1.1 AS DOUBLE) AS rate_upper, value / CAST(1000 AS DOUBLE) AS r_squared
      FROM events"""),
}


def with_views(sql: str, uses: list[str]) -> str:
    """Prefix ``sql`` with the views it names, in dependency order."""
    ordered: list[str] = []

    def visit(name):
        for dep in VIEWS[name][0]:
            visit(dep)
        if name not in ordered:
            ordered.append(name)

    for name in uses:
        visit(name)
    sql = sql.strip()
    if not ordered:
        return "WITH RECURSIVE " + sql[5:] if sql.upper().startswith("WITH ") else sql
    head = ",\n".join(f"{n} AS ({VIEWS[n][1].strip()})" for n in ordered)
    if sql.upper().startswith("WITH "):
        return f"WITH RECURSIVE {head},\n{sql[5:]}"
    return f"WITH RECURSIVE {head}\n{sql}"
