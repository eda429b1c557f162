"""Queries for graphs, clusters and trees."""

from __future__ import annotations

from pyspark.sql import functions as F

from lineagespark.operators import clusters, distances, joins, network, ranking, tours, trees
from lineagespark.plans.distances import OVERLAP, selection_profiles
from lineagespark.plans.inputs import AS_OF
from lineagespark.plans.joins import alias_table
from lineagespark.plans.ranking import wide_keys
from lineagespark.plans.registry import query
from lineagespark.session import durable


@query("G1", """
WITH a AS (SELECT source_genome_id AS id, alias FROM genome_aliases), e AS (SELECT DISTINCT x.id AS u, y.id AS v FROM a x JOIN a y USING (alias)),
 reach AS (SELECT source_genome_id AS root, source_genome_id AS id FROM genomes UNION SELECT reach.root, e.v FROM reach JOIN e ON e.u = reach.id),
 comp AS (SELECT id, min(root) AS component FROM reach GROUP BY 1),
 u AS (SELECT component, count(*) AS raw_genome_count, arg_min(source_genome_id, (CASE WHEN qc_pass THEN '0' ELSE '1' END) || source_genome_id) AS representative, min(country) <> max(country) AS country_conflict FROM comp JOIN genomes ON id = source_genome_id GROUP BY 1),
 n AS (SELECT component, min(a.alias) AS first_alias, min(a.alias) FILTER (WHERE a.alias LIKE 'SAM%') AS first_sample, count(DISTINCT a.alias) FILTER (WHERE a.alias LIKE 'SAM%') AS samples, count(f.alias) AS hits
   FROM comp JOIN a USING (id) LEFT JOIN (SELECT DISTINCT alias FROM genome_aliases WHERE role = 'input') f ON f.alias = a.alias GROUP BY 1)
SELECT component, CASE WHEN samples = 1 THEN first_sample ELSE first_alias END AS sample_unit_id, representative, raw_genome_count, country_conflict, samples > 1 AS identity_conflict, samples <= 1 AS identity_resolved,
  CASE WHEN hits > 0 THEN 'focal_overlap' WHEN samples > 1 THEN 'conflicting_biosamples' WHEN raw_genome_count > 1 THEN 'duplicate' ELSE 'retained' END AS reason FROM u JOIN n USING (component)""", "genomes genome_aliases")
def entities(t):
    """Records joined through any shared accession, without a limit on the chain."""
    a = alias_table(t)
    return clusters.resolve_entities(t.genomes.select("source_genome_id", "qc_pass", "country"), a.select("source_genome_id", "alias"), a.filter("role = 'input'").select("alias"))


@query("G2", """
WITH e AS (SELECT a_id AS u, b_id AS v FROM good_pairs WHERE distance <= 0.45 UNION SELECT b_id, a_id FROM good_pairs WHERE distance <= 0.45),
 reach AS (SELECT sample_id AS root, sample_id AS id FROM profiles UNION SELECT reach.root, e.v FROM reach JOIN e ON e.u = reach.id)
SELECT id AS sample_id, min(root) AS component FROM reach GROUP BY 1""", "good_pairs profiles")
def threshold_groups(t):
    return clusters.threshold_groups(distances.encode_profiles(t.calls), 0.45, OVERLAP)


@query("G3")
def linkage(t):
    """Complete-linkage groups; every within-group pair meets the cutoff."""
    return clusters.profile_groups(selection_profiles(t), 0.48, OVERLAP)


@query("G4")
def cohorts(t):
    """First-fit cohorts of mutually comparable profiles."""
    return clusters.comparable_cohorts(distances.encode_profiles(t.calls), 0.90625 + 1 / 64)


@query("G5")
def bootstrap(t):
    """Weakest pair support of each group over locus resamples."""
    return clusters.bootstrap_support(selection_profiles(t), 0.48, 0.5, replicates=30, seed=7)


@query("G6", """
WITH g AS (SELECT sample_id, lineage || country AS group_id, k FROM samples), l AS (SELECT sample_id, group_id, CASE WHEN k % 400 = 9 THEN NULL ELSE 'x' || (k // 1000) END AS label FROM g)
SELECT group_id, 'cglin' AS kind, count(*) AS members, CASE WHEN count(label) = count(*) AND min(label) = max(label) THEN min(label) END AS anchor FROM l GROUP BY 1""", "samples")
def anchors(t):
    groups = t.samples.select("sample_id", F.concat("lineage", "country").alias("group_id"))
    labels = t.samples.selectExpr("sample_id", "'cglin' AS kind", "CASE WHEN k % 400 = 9 THEN NULL ELSE concat('x', k DIV 1000) END AS label")
    return clusters.group_anchors(groups, labels)


def tip_samples(t):
    """Tree tips as samples: most nations of one region are focal only."""
    return t.samples.withColumn("location", F.col("country")).withColumn("origin", F.expr("CASE WHEN region = 'ASIA' OR country LIKE '%7' THEN 'local' ELSE 'context' END")).withColumn(
        "collection_date", F.coalesce(F.date_format("first_day", "yyyy"), F.lit(""))
    )


_TIPS = """tips AS (SELECT sample_id, CASE WHEN region = 'ASIA' OR country LIKE '%7' THEN 'local' ELSE 'context' END AS origin, coalesce(strftime(first_day, '%Y'), '') AS collection_date, patient_id, country, lineage, k FROM samples)"""


@query("G7", f"""
WITH {_TIPS}, n AS (SELECT anc, count(*) AS n, count(*) FILTER (WHERE origin = 'local') AS f FROM closure JOIN tips ON sample_id = node GROUP BY 1), pure AS (SELECT anc FROM n WHERE n = f),
 tops AS (SELECT anc FROM pure JOIN tree ON tree.node = anc WHERE parent IS NULL OR parent NOT IN (SELECT anc FROM pure))
SELECT 't' AS tree_id, anc AS clade, min(sample_id) AS first_sample, count(*) AS sample_count, count(DISTINCT nullif(patient_id, '')) AS patient_count, count(DISTINCT country) AS locations,
  min(collection_date) AS first_date, max(collection_date) AS last_date, count(DISTINCT collection_date) AS distinct_dates, count(DISTINCT collection_date) >= 2 AS spans_periods
FROM tops JOIN closure USING (anc) JOIN tips ON sample_id = node GROUP BY anc""", "closure samples")
def focal_clades(t):
    return trees.focal_clades(tours.tree_order(t.tree), tip_samples(t))


def cluster_dates(t):
    """One date per region, except that one nation in six has several."""
    return t.samples.filter("k % 11 <> 0").selectExpr("sample_id", "concat(region, CASE WHEN country LIKE '%3' THEN k % 3 ELSE 0 END) AS date")


_DATES = """dd AS (SELECT sample_id, region || CASE WHEN country LIKE '%3' THEN k % 3 ELSE 0 END AS date FROM samples WHERE k % 11 <> 0),
 dn AS (SELECT anc FROM closure JOIN dd ON sample_id = node GROUP BY 1 HAVING min(date) = max(date)),
 dt AS (SELECT anc FROM dn JOIN tree ON tree.node = anc WHERE parent IS NULL OR parent NOT IN (SELECT anc FROM dn)),
 dc AS (SELECT anc AS cluster, sample_id, date FROM dt JOIN closure USING (anc) JOIN dd ON sample_id = node)"""


@query("G8", f"WITH {_DATES} SELECT 't' AS tree_id, cluster, sample_id, date FROM dc", "closure samples")
def date_clusters(t):
    return trees.date_clusters(tours.tree_order(t.tree), cluster_dates(t))


def observed_states(t):
    return t.samples.selectExpr("sample_id AS node", "CASE WHEN k % 17 = 0 THEN NULL WHEN country LIKE '%1' THEN 'MACHINERY' ELSE lineage END AS state")


_STATES = """obs AS (SELECT sample_id AS node, CASE WHEN k % 17 = 0 THEN NULL WHEN country LIKE '%1' THEN 'MACHINERY' ELSE lineage END AS state FROM samples),
 sts AS (SELECT DISTINCT state FROM obs WHERE state IS NOT NULL),
 c0 AS (SELECT tree.node, parent, sts.state, CASE WHEN obs.state IS NULL OR obs.state = sts.state THEN 0 ELSE 1000000 END AS cost FROM tree JOIN obs USING (node), sts),
 c1 AS (SELECT parent AS node, state, CAST(sum(least(cost, lo + 1)) AS BIGINT) AS cost FROM (SELECT *, min(cost) OVER (PARTITION BY node) AS lo FROM c0) GROUP BY ALL),
 c2 AS (SELECT tree.parent AS node, state, CAST(sum(least(cost, lo + 1)) AS BIGINT) AS cost FROM (SELECT *, min(cost) OVER (PARTITION BY node) AS lo FROM c1) JOIN tree USING (node) GROUP BY ALL),
 c3 AS (SELECT tree.parent AS node, state, CAST(sum(least(cost, lo + 1)) AS BIGINT) AS cost FROM (SELECT *, min(cost) OVER (PARTITION BY node) AS lo FROM c2) JOIN tree USING (node) GROUP BY ALL),
 opt AS (SELECT min(cost) AS changes FROM c3), a3 AS (SELECT node, state FROM c3, opt WHERE cost = changes),
 m2 AS (SELECT c.node, a.state AS source, c.state AS target FROM c2 c JOIN tree USING (node) JOIN a3 a ON a.node = tree.parent JOIN (SELECT node, min(cost) AS lo FROM c2 GROUP BY 1) l ON l.node = c.node JOIN c2 s ON s.node = c.node AND s.state = a.state
   WHERE c.cost + CAST(c.state <> a.state AS INTEGER) = least(s.cost, lo + 1)), a2 AS (SELECT DISTINCT node, target AS state FROM m2),
 m1 AS (SELECT c.node, a.state AS source, c.state AS target FROM c1 c JOIN tree USING (node) JOIN a2 a ON a.node = tree.parent JOIN (SELECT node, min(cost) AS lo FROM c1 GROUP BY 1) l ON l.node = c.node JOIN c1 s ON s.node = c.node AND s.state = a.state
   WHERE c.cost + CAST(c.state <> a.state AS INTEGER) = least(s.cost, lo + 1)), a1 AS (SELECT DISTINCT node, target AS state FROM m1)"""


@query("G9", f"""
WITH {_STATES}
SELECT node, string_agg(state, ',' ORDER BY state) AS allowed, (SELECT changes FROM opt) AS optimum_changes FROM (SELECT * FROM a3 UNION ALL SELECT * FROM a2 UNION ALL SELECT * FROM a1) GROUP BY 1""", "tree samples")
def parsimony(t):
    """Optimal states of every inner node and the smallest number of changes."""
    result = network.parsimony(t.tree, tours.tree_depths(t.tree), observed_states(t))
    inner = t.tree.filter("NOT is_tip").select("tree_id", "node")
    return result["states"].join(inner, ["tree_id", "node"]).join(result["optimum"], "tree_id").select("node", F.array_join("allowed", ",").alias("allowed"), F.col("changes").alias("optimum_changes"))


def rerooted_trees(t, limit=5):
    closure = durable(trees.ancestors(t.tree))
    samples = observed_states(t).join(t.samples.select(F.col("sample_id").alias("node"), (F.col("role") == "input").alias("is_input")), "node")
    roots = network.choose_roots(t.tree, closure, samples, limit).select(F.col("tip").alias("new_id"), "tip")
    return durable(trees.reroot(t.tree, tours.tree_order(t.tree), roots)), samples


@query("G10")
def roots(t):
    """Possible changes under several roots."""
    rerooted, samples = rerooted_trees(t)
    return network.root_sensitivity(rerooted, tours.tree_depths(rerooted), samples.select("node", "state"))


@query("G11")
def location_network(t):
    """Directed changes with ranges, counts of inputs and context at both ends."""
    result = network.parsimony(t.tree, tours.tree_depths(t.tree), observed_states(t))
    samples = observed_states(t).join(t.samples.select(F.col("sample_id").alias("node"), (F.col("role") == "input").alias("is_input")), "node")
    nodes = network.state_nodes(samples)
    end = lambda c: nodes.select(F.col("state").alias(c), F.col("input_count").alias(f"{c}_inputs"), F.col("context_count").alias(f"{c}_context"))
    return network.directed_edges(result).join(end("source"), "source").join(end("target"), "target")


def country_edges(t):
    """Directed graph of customer nation to supplier nation: links clearly above the mean weight."""
    c = t.table("customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("x"))
    o = t.table("orders").join(c, "o_custkey").select(F.col("o_orderkey").alias("l_orderkey"), "x")
    s = t.table("supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("y"))
    pairs = t.table("lineitem").join(o, "l_orderkey").join(s, "l_suppkey").filter("x <> y")
    name = lambda k: F.concat(F.lit("n"), k)
    return pairs.groupBy(name("x").alias("source"), name("y").alias("target")).agg(F.count(F.lit(1)).alias("weight"))


_EDGES = """ce AS (SELECT 'n' || c_nationkey AS source, 'n' || s_nationkey AS target, count(*) AS weight FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
   WHERE c_nationkey <> s_nationkey GROUP BY ALL)"""


@query("G12", f"""
WITH {_EDGES}, vx AS (SELECT 'n' || n_nationkey AS v FROM nation), und AS (SELECT source AS u, target AS v FROM ce UNION SELECT target, source FROM ce),
 walk AS (SELECT v AS s, v, 0 AS d, ',' || v || ',' AS seen FROM vx UNION SELECT s, und.v, d + 1, NULL FROM walk JOIN und ON und.u = walk.v WHERE d < 8),
 far AS (SELECT s, sum(d) AS far FROM (SELECT s, v, min(d) AS d FROM walk GROUP BY ALL) GROUP BY 1),
 dw AS (SELECT v AS s, v, 0 AS d FROM vx UNION SELECT s, target, d + 1 FROM dw JOIN ce ON source = v WHERE d < 12),
 dist AS (SELECT s, v, min(d) AS d FROM dw GROUP BY ALL),
 np AS (SELECT s, v, d, CAST(1 AS DOUBLE) AS paths FROM dist WHERE d = 0 UNION SELECT x.s, x.target, x.d + 1, sum(x.paths) OVER (PARTITION BY x.s, x.target) FROM (SELECT np.s, np.d, np.paths, ce.target FROM np JOIN ce ON ce.source = np.v) x JOIN dist y ON y.s = x.s AND y.v = x.target AND y.d = x.d + 1),
 paths AS (SELECT DISTINCT s, v, d, paths FROM np),
 bt AS (SELECT m.v, sum(a.paths * b.paths / e.paths) AS betweenness FROM paths e JOIN paths a ON a.s = e.s JOIN paths b ON b.s = a.v AND b.v = e.v JOIN vx m ON m.v = a.v WHERE a.d + b.d = e.d AND a.v <> e.s AND a.v <> e.v GROUP BY 1),
 o AS (SELECT source AS v, count(*) AS od, sum(weight) AS ow FROM ce GROUP BY 1), i AS (SELECT target AS v, count(*) AS id, sum(weight) AS iw FROM ce GROUP BY 1)
SELECT vx.v AS vertex, coalesce(id, 0) AS in_degree, coalesce(od, 0) AS out_degree, coalesce(id, 0) + coalesce(od, 0) AS degree, round(coalesce(betweenness, 0), 6) AS betweenness, CASE WHEN far > 0 THEN round(1 / far, 6) END AS closeness,
  CAST(coalesce(iw, 0) AS BIGINT) AS in_changes, CAST(coalesce(ow, 0) AS BIGINT) AS out_changes, CASE WHEN coalesce(id, 0) + coalesce(od, 0) > 0 THEN round(coalesce(od, 0) / (coalesce(id, 0) + coalesce(od, 0)), 6) END AS source_hub_ratio
FROM vx LEFT JOIN o USING (v) LEFT JOIN i USING (v) LEFT JOIN bt USING (v) LEFT JOIN far ON far.s = vx.v""")
def metrics(t):
    vertices = t.table("nation").select(F.concat(F.lit("n"), "n_nationkey").alias("vertex"))
    out = network.network_metrics(vertices, country_edges(t))
    for c in ("betweenness", "closeness", "source_hub_ratio"):
        out = out.withColumn(c, F.round(c, 6))
    return out


def node_probabilities(t):
    """Three states per tree node with probabilities that sum to one."""
    n = F.pmod(F.crc32("node"), F.lit(10))
    p = lambda i: F.when(F.pmod(n, F.lit(5)) == i, 0.8).when(F.pmod(n, F.lit(5)) < 3, 0.1).otherwise(F.when(F.lit(i) == 2, 0.2).otherwise(0.4))
    rows = t.tree.select("node", F.explode(F.array(*[F.struct(F.lit(s).alias("state"), p(i).alias("probability")) for i, s in enumerate(("X", "Y", "Unknown"))])).alias("r"))
    return rows.select("node", "r.state", "r.probability")


@query("G13")
def marginal(t):
    """Country changes between nodes of a marginal reconstruction."""
    excluded = t.samples.filter("k % 17 = 0").select(F.col("sample_id").alias("node"), F.lit("Missing observed location").alias("reason"))
    return network.marginal_network(t.tree, network.marginal_states(node_probabilities(t)), excluded, 0.7)[1]


@query("G14", """
WITH a AS (SELECT 'set' || (k % 40) || CASE WHEN k % 3 = 0 THEN country ELSE region END AS set_id, sample_id AS node FROM samples),
 n AS (SELECT set_id, count(*) AS n FROM a GROUP BY 1), c AS (SELECT set_id, anc, count(*) AS have FROM a JOIN closure USING (node) GROUP BY ALL), d AS (SELECT node, max(steps) AS depth FROM closure GROUP BY 1)
SELECT set_id, 't' AS tree_id, arg_max(anc, depth) AS mrca FROM c JOIN n USING (set_id) JOIN d ON d.node = anc WHERE have = n GROUP BY 1""", "closure samples")
def mrca(t):
    sets = t.samples.selectExpr("concat('set', k % 40, CASE WHEN k % 3 = 0 THEN country ELSE region END) AS set_id", "sample_id AS node")
    return trees.common_ancestor(tours.tree_order(t.tree), sets)


def block_records(t):
    return t.assignments.join(wide_keys(t).select(F.col("id").alias("source_genome_id"), "key_5"), "source_genome_id", "left").selectExpr(
        "source_genome_id AS sample_id", "role", "species", "mlst_st", "CASE WHEN doc_id % 5 = 0 THEN '' WHEN doc_id % 2 = 1 AND doc_id % 7 = 0 THEN 'alt' ELSE 'mlst' END AS mlst_scheme", "'cglin' AS kind",
        "cglin_scheme AS scheme", "cglin_scheme_version AS version", "CAST(NULL AS STRING) AS database_version", "database_sha256", "coalesce(key_5, '') AS prefix",
    )


@query("G15", """
WITH r AS (SELECT source_genome_id AS sample_id, role, mlst_st, cglin_scheme_version AS v, database_sha256 AS h, CASE WHEN cglin_scheme = 'scgMLST629_S' THEN group_key ELSE '' END AS prefix,
   CASE WHEN doc_id % 5 = 0 THEN CASE WHEN mlst_st = '11' THEN 'mlst' END WHEN doc_id % 2 = 1 AND doc_id % 7 = 0 THEN 'alt' ELSE 'mlst' END AS sch FROM keyed WHERE depth = 5),
 b AS (SELECT DISTINCT mlst_st, v, h, prefix, sch FROM r WHERE role = 'input' AND prefix <> '' AND sch IS NOT NULL)
SELECT sample_id, role, CASE WHEN b.prefix IS NOT NULL THEN 'in_block' WHEN role = 'input' THEN 'missing_or_unresolved_partition_typing' WHEN r.sch IS NULL THEN 'ambiguous_mlst_namespace' ELSE 'unmatched_context' END AS outcome
FROM r LEFT JOIN b ON b.mlst_st = r.mlst_st AND b.v = r.v AND b.h = r.h AND b.prefix = r.prefix AND b.sch = r.sch""", "keyed")
def blocks(t):
    members, left = clusters.lineage_blocks(block_records(t))
    return members.select("sample_id", "role", F.lit("in_block").alias("outcome")).unionByName(left.withColumnRenamed("reason", "outcome"))


@query("G16", """
WITH keep AS (SELECT 'v' || (k % 60) AS view, sample_id AS node FROM samples), live AS (SELECT DISTINCT view, anc AS node FROM keep JOIN closure USING (node)),
 kids AS (SELECT view, parent AS node, count(*) AS kids FROM live JOIN tree USING (node) WHERE parent IS NOT NULL GROUP BY ALL),
 kept AS (SELECT view, node, is_tip FROM live JOIN tree USING (node) LEFT JOIN kids USING (view, node) WHERE is_tip OR kids >= 2),
 up AS (SELECT k.view, k.node, arg_min(c.anc, c.steps) AS parent, arg_min(c.dist, c.steps) AS len FROM kept k JOIN closure c ON c.node = k.node AND c.steps > 0 JOIN kept p ON p.view = k.view AND p.node = c.anc GROUP BY ALL)
SELECT k.view AS tree_id, k.node, parent, round(coalesce(len, 0), 6) AS branch_length, is_tip FROM kept k LEFT JOIN up USING (view, node)""", "closure samples")
def restricted(t):
    keep = t.samples.select(F.concat(F.lit("v"), F.col("k") % 60).alias("view"), F.col("sample_id").alias("node"))
    out = trees.restrict_tree(tours.tree_order(t.tree), keep)
    return out.withColumn("branch_length", F.round("branch_length", 6))


@query("G17", """
WITH rt AS (SELECT 'C' || c_custkey AS tip, 'n' || c_nationkey AS n, 'r' || n_regionkey AS r, 0.1 * (c_custkey % 7 + 1) AS lt, 0.1 * (c_nationkey % 7 + 1) AS ln, 0.1 * (n_regionkey % 7 + 1) AS lr FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey = 7)
SELECT tip AS tree_id, 'root@' || tip AS node, NULL AS parent, 0.0 AS branch_length, false AS is_tip FROM rt UNION ALL SELECT tip, tip, 'root@' || tip, 0.0, true FROM rt
UNION ALL SELECT tip, n, 'root@' || tip, round(lt, 6), false FROM rt UNION ALL SELECT tip, r, n, round(ln, 6), false FROM rt UNION ALL SELECT tip, 'root', r, round(lr, 6), false FROM rt
UNION ALL SELECT tip, node, parent, round(branch_length, 6), is_tip FROM tree, rt WHERE node NOT IN (tip, n, r, 'root')""", "tree")
def rerooted(t):
    tips = t.samples.filter("k = 7").select(F.col("sample_id").alias("new_id"), F.col("sample_id").alias("tip"))
    out = trees.reroot(t.tree, tours.tree_order(t.tree), tips)
    return out.withColumn("branch_length", F.round("branch_length", 6))


@query("G18", """
SELECT sample_id AS id, CASE WHEN k % 3 = 0 THEN NULL ELSE 'ST' || (k % 3) || '_CG' || (k % 5) END AS lineage_or_null, CASE WHEN k % 3 = 0 THEN lineage ELSE 'ST' || (k % 3) || '_CG' || (k % 5) END AS lineage, CASE WHEN k % 3 <> 0 THEN lineage END AS input_lineage FROM samples""", "samples")
def routed(t):
    labels = t.samples.selectExpr("sample_id AS id", "CASE WHEN k % 3 = 0 THEN NULL ELSE concat('ST', k % 3, '_CG', k % 5) END AS dataset")
    out = clusters.route(t.samples.select(F.col("sample_id").alias("id"), "lineage"), labels)
    return out.select("id", F.when(F.col("input_lineage").isNotNull(), F.col("lineage")).alias("lineage_or_null"), "lineage", "input_lineage")


@query("G19", """
SELECT 't' AS tree_id, node, 'negative_length' AS problem FROM tree WHERE is_tip AND CAST(substring(node, 2) AS BIGINT) % 50 = 3
UNION ALL SELECT 't', node, 'missing_length' FROM tree WHERE is_tip AND CAST(substring(node, 2) AS BIGINT) % 70 = 4 UNION ALL SELECT 't', node, 'duplicate_node' FROM tree WHERE is_tip AND CAST(substring(node, 2) AS BIGINT) % 90 = 5
UNION ALL SELECT 't', node, 'extra_tip' FROM tree WHERE is_tip AND CAST(substring(node, 2) AS BIGINT) % 100 = 6 UNION ALL SELECT '', 'N' || n_nationkey, 'missing_tip' FROM nation""", "tree")
def sanity(t):
    k = F.when(F.col("is_tip"), F.col("node").substr(2, 20).try_cast("bigint"))
    length = F.when(k % 50 == 3, -1.0).when(k % 70 == 4, None).otherwise(F.col("branch_length"))
    broken = t.tree.withColumn("branch_length", length)
    broken = broken.unionByName(broken.filter(k % 90 == 5))
    expected = t.tree.filter("is_tip").filter(k % 100 != 6).select("node").union(t.table("nation").select(F.concat(F.lit("N"), "n_nationkey")))
    out = trees.tree_problems(broken, expected)
    return out.distinct()
