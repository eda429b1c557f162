"""Location-change networks on rooted trees.

Parsimony tables are long rows ``(tree_id, node, state, cost)``, summed per parent as partial
aggregates, so a node with very many children does not gather them. Rounds follow tree levels;
many trees (views, tested roots) run in the same rounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lineagespark.operators.trees import root_paths
from lineagespark.session import durable

INFINITE = 1_000_000_000


def parsimony(tree: DataFrame, depths: DataFrame, observed: DataFrame, seed: int = 1729, ranges: bool = True):
    """Smallest number of state changes, with every optimal state and change count range.

    ``depths(tree_id, node, level)`` is :func:`tours.tree_depths`. ``observed(node, state)`` gives tip states; tips without one are free. Returns a dict of
    tables: ``optimum(tree_id, changes)``, ``states(tree_id, node, allowed, state)`` where
    ``state`` is one reproducible optimal history, ``branches(tree_id, parent, child, source,
    target)`` of that history, ``moves(tree_id, parent, child, source, target)`` holding every
    optimal transition, and ``ranges(tree_id, source, target, min_changes, max_changes)``.
    """
    states = durable(observed.select("state").filter("state IS NOT NULL").distinct(), "states")
    nodes = durable(tree.select("tree_id", "node", "parent", "is_tip").join(depths.select("tree_id", "node", F.col("level").cast("int").alias("level")), ["tree_id", "node"]), "nodes")
    depth = nodes.agg(F.max("level")).first()[0] or 0
    seen = observed.filter("state IS NOT NULL").select("node", F.col("state").alias("_seen"))
    tips = nodes.filter("is_tip").join(seen, "node", "left").crossJoin(states)
    tip_cost = F.when(F.col("_seen").isNull() | (F.col("_seen") == F.col("state")), 0).otherwise(INFINITE)
    tip_costs = durable(tips.select("tree_id", "node", "parent", "level", "state", tip_cost.cast("bigint").alias("cost")), "tip_costs")
    key = ["tree_id", "node"]
    costs, moves, spans = tip_costs, None, None
    below = None
    for level in range(depth, 0, -1):
        here = tip_costs.filter(F.col("level") == level)
        if below is not None:
            here = here.unionByName(below)
        low = here.groupBy(*key).agg(F.min("cost").alias("low"))
        marked = here.join(low, key).withColumn("best", F.least("cost", F.col("low") + 1))
        marked = durable(marked, "marked")
        # Every optimal (source, target): stay when that is best, or move to a cheapest state.
        stay = marked.filter("cost = best").select("tree_id", "parent", "node", F.col("state").alias("source"), F.col("state").alias("target"))
        cheapest = marked.filter("cost = low").select(*key, F.col("state").alias("target"))
        change = marked.filter("best = low + 1").select("tree_id", "parent", "node", F.col("state").alias("source")).join(cheapest, key).filter("source <> target")
        step = durable(stay.unionByName(change.select(stay.columns)), "step")
        moves = step if moves is None else moves.unionByName(step)
        summed = marked.groupBy("tree_id", "parent", "state").agg(F.sum("best").alias("cost"))
        up = nodes.select("tree_id", F.col("node").alias("_n"), F.col("parent").alias("_p"), "level")
        below = durable(
            summed.join(up, (summed["tree_id"] == up["tree_id"]) & (summed["parent"] == up["_n"]))
            .select(summed["tree_id"], F.col("_n").alias("node"), F.col("_p").alias("parent"), "level", "state", F.least("cost", F.lit(INFINITE)).alias("cost")), "below",
        )
        costs = costs.unionByName(below)
        if ranges:
            spans = durable(_pair_ranges(step, spans), "spans")
    root = costs.filter("parent IS NULL")
    optimum = root.groupBy("tree_id").agg(F.min("cost").alias("changes"))
    root_states = durable(root.join(optimum, "tree_id").filter("cost = changes").select("tree_id", "node", "state"), "root_states")
    if moves is None:
        raise ValueError("a tree needs at least one branch")
    states_out, branches, reachable = _histories(nodes, durable(moves, "moves"), root_states, depth, seed)
    result = {"optimum": optimum, "states": states_out, "branches": branches, "moves": reachable}
    if ranges:
        n = root_states.groupBy("tree_id").agg(F.count(F.lit(1)).alias("n"))
        at_root = spans.join(root_states.select("tree_id", "node", "state"), ["tree_id", "node", "state"])
        per = at_root.groupBy("tree_id", "source", "target").agg(F.min("low").alias("lo"), F.max("high").alias("hi"), F.count(F.lit(1)).alias("have")).join(n, "tree_id")
        result["ranges"] = per.filter("hi > 0").select("tree_id", "source", "target", F.when(F.col("have") == F.col("n"), F.col("lo")).otherwise(0).alias("min_changes"), F.col("hi").alias("max_changes"))
    return result


def _pair_ranges(step: DataFrame, below: DataFrame | None) -> DataFrame:
    """Fewest and most changes of each ordered pair below a node, per state of the node.

    Rows that would be (0, 0) are absent; a missing row therefore counts as zero.
    """
    own = step.filter("source <> target").select(
        "tree_id", "parent", "node", F.col("source").alias("state"), F.col("target").alias("t"), "source", "target", F.lit(1).alias("low"), F.lit(1).alias("high")
    )
    rows = own
    if below is not None:
        deeper = step.select("tree_id", "parent", "node", F.col("source").alias("from"), F.col("target").alias("t")).join(
            below.withColumnRenamed("state", "t"), ["tree_id", "node", "t"]
        )
        rows = own.unionByName(deeper.select("tree_id", "parent", "node", F.col("from").alias("state"), "t", "source", "target", "low", "high"))
    per = rows.groupBy("tree_id", "parent", "node", "state", "t", "source", "target").agg(F.sum("low").alias("low"), F.sum("high").alias("high"))
    options = step.groupBy("tree_id", "node", F.col("source").alias("state")).agg(F.count(F.lit(1)).alias("n"))
    child = per.groupBy("tree_id", "parent", "node", "state", "source", "target").agg(
        F.min("low").alias("lo"), F.max("high").alias("high"), F.count(F.lit(1)).alias("have")
    ).join(options, ["tree_id", "node", "state"])
    low = F.when(F.col("have") == F.col("n"), F.col("lo")).otherwise(0)
    return child.groupBy("tree_id", F.col("parent").alias("node"), "state", "source", "target").agg(F.sum(low).alias("low"), F.sum("high").alias("high"))


def _histories(nodes: DataFrame, moves: DataFrame, root_states: DataFrame, depth: int, seed: int):
    """Top-down: every state an optimal history allows, and one reproducible history."""
    draw = lambda: F.min(F.struct(F.sha2(F.concat_ws(":", F.lit(str(seed)), "node", "state"), 256).alias("h"), "state"))
    allowed = root_states
    chosen = durable(root_states.groupBy("tree_id", "node").agg(draw().alias("b")).select("tree_id", "node", F.col("b.state").alias("state")), "chosen")
    all_allowed, all_chosen, reachable = allowed, chosen, None
    for _ in range(depth):
        from_allowed = allowed.select("tree_id", F.col("node").alias("parent"), F.col("state").alias("source"))
        step = durable(moves.join(from_allowed, ["tree_id", "parent", "source"]), "reach")
        reachable = step if reachable is None else reachable.unionByName(step)
        allowed = durable(step.select("tree_id", "node", F.col("target").alias("state")).distinct(), "allowed")
        from_chosen = chosen.select("tree_id", F.col("node").alias("parent"), F.col("state").alias("source"))
        options = moves.join(from_chosen, ["tree_id", "parent", "source"]).withColumnRenamed("target", "state")
        chosen = durable(options.groupBy("tree_id", "node").agg(draw().alias("b")).select("tree_id", "node", F.col("b.state").alias("state")), "chosen")
        all_allowed, all_chosen = all_allowed.unionByName(allowed), all_chosen.unionByName(chosen)
    sets = all_allowed.groupBy("tree_id", "node").agg(F.array_sort(F.collect_set("state")).alias("allowed"))
    states = sets.join(all_chosen, ["tree_id", "node"])
    parent = nodes.select("tree_id", "node", "parent")
    up = all_chosen.select("tree_id", F.col("node").alias("parent"), F.col("state").alias("source"))
    branches = all_chosen.withColumnRenamed("state", "target").join(parent, ["tree_id", "node"]).join(up, ["tree_id", "parent"]).select("tree_id", "parent", F.col("node").alias("child"), "source", "target")
    return states, branches, reachable.select("tree_id", "parent", F.col("node").alias("child"), "source", "target")


def directed_edges(result: dict) -> DataFrame:
    """Ordered state pairs with the count of one history and the range over all of them."""
    counts = result["branches"].filter("source <> target").groupBy("tree_id", "source", "target").agg(F.count(F.lit(1)).alias("representative_count"))
    return result["ranges"].join(counts, ["tree_id", "source", "target"], "left").select(
        "tree_id", "source", "target", F.coalesce("representative_count", F.lit(0)).alias("representative_count"), "min_changes", "max_changes",
        (F.col("min_changes") != F.col("max_changes")).alias("count_ambiguous"),
    )


def undirected_pairs(df: DataFrame) -> DataFrame:
    return df.withColumn("a", F.least("source", "target")).withColumn("b", F.greatest("source", "target"))


def root_sensitivity(rerooted: DataFrame, depths: DataFrame, observed: DataFrame, seed: int = 1729) -> DataFrame:
    """Unordered pairs that can change under each tested root, all roots in the same rounds.

    ``rerooted`` carries one tree id per tested root.
    """
    result = parsimony(rerooted, depths, observed, seed, ranges=False)
    options = result["moves"].groupBy("tree_id", "child").agg(F.count(F.lit(1)).alias("options"))
    moves = undirected_pairs(result["moves"].filter("source <> target").join(options, ["tree_id", "child"]))
    per = moves.groupBy("tree_id", "a", "b").agg((F.max("options") > 1).alias("ambiguous"))
    roots = rerooted.select("tree_id").distinct().agg(F.count(F.lit(1)).alias("roots_tested"))
    return per.groupBy("a", "b").agg(F.count(F.lit(1)).alias("roots_with_possible_change"), F.count_if("ambiguous").alias("roots_with_ambiguous_change")).crossJoin(
        roots
    ).withColumn("root_fraction", F.col("roots_with_possible_change") / F.col("roots_tested"))


def choose_roots(tree: DataFrame, closure: DataFrame, samples: DataFrame, limit: int = 5) -> DataFrame:
    """Tips to test as roots: an input first, then new states, then the farthest tip.

    ``samples(node, state, is_input)``. One job per root; the number of roots is a parameter.
    """
    paths = durable(root_paths(tree, closure).join(samples.withColumnRenamed("node", "sample_id"), "sample_id"), "paths")
    first = paths.groupBy().agg(F.min(F.struct((~F.col("is_input")).alias("rank"), "sample_id")).alias("b")).select(F.col("b.sample_id").alias("tip")).first()
    if first is None or first[0] is None:
        return tree.sparkSession.createDataFrame([], "tip string, ord int")
    chosen = [first[0]]
    state = paths.withColumn("nearest", F.lit(float("inf")))
    total = paths.count()
    while len(chosen) < min(limit, total):
        last = paths.filter(F.col("sample_id") == chosen[-1]).select(F.col("path").alias("_p"), F.col("depths").alias("_d"), "tree_id")
        # One row: the last chosen tip.
        joined = state.join(F.broadcast(last), "tree_id")
        same = F.zip_with("path", "_p", lambda a, b: a.eqNullSafe(b))
        split = F.array_position(same, False)
        shared = F.when(split == 0, F.size(same)).otherwise(split.cast("int") - 1)
        gap = F.element_at("depths", -1) + F.element_at("_d", -1) - 2 * F.element_at("_d", shared)
        state = durable(joined.withColumn("nearest", F.least("nearest", gap)).drop("_p", "_d"), "state")
        seen = paths.filter(F.col("sample_id").isin(chosen)).select(F.col("state").alias("_s")).filter("_s IS NOT NULL").distinct()
        free = state.filter(~F.col("sample_id").isin(chosen)).join(F.broadcast(seen), F.col("state") == F.col("_s"), "left")
        novel = F.col("state").isNotNull() & F.col("_s").isNull()
        best = free.groupBy(novel.alias("novel")).agg(F.min(F.struct((-F.round("nearest", 12)).alias("n"), "sample_id")).alias("b"))
        chosen.append(best.orderBy(F.desc("novel")).select("b.sample_id").first()[0])
    return tree.sparkSession.createDataFrame([(c, i) for i, c in enumerate(chosen, 1)], "tip string, ord int")


def state_nodes(samples: DataFrame) -> DataFrame:
    """Samples, inputs and context per state from ``(node, state, is_input)``."""
    return samples.filter("state IS NOT NULL").groupBy("state").agg(
        F.count(F.lit(1)).alias("count"), F.count_if("is_input").alias("input_count"), F.count_if(~F.col("is_input")).alias("context_count")
    )


def network_metrics(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Degrees, directed betweenness, undirected closeness and source-hub ratio per vertex.

    ``vertices(vertex)``, ``edges(source, target, weight)`` with positive weights. Shortest
    paths are unweighted. All sources advance one step per round as rows (source, vertex,
    distance, paths); dependencies then flow back level by level.
    """
    e = durable(edges.filter("weight > 0").select("source", "target", "weight"), "edges")
    links = durable(e.select(F.col("source").alias("u"), F.col("target").alias("v")).distinct(), "links")
    found, levels = _breadth_first(vertices, links)
    # Brandes: dependency of a vertex is summed over its successors one level deeper.
    dep = found.filter(F.col("d") == levels).select("s", "v", "d", "paths", F.lit(0.0).alias("dep"))
    total = dep
    for level in range(levels - 1, 0, -1):
        here = found.filter(F.col("d") == level).select("s", "v", "d", "paths")
        onward = links.select(F.col("u").alias("v"), F.col("v").alias("w"))
        deeper = dep.select("s", F.col("v").alias("w"), F.col("paths").alias("_pw"), F.col("dep").alias("_dw"))
        gain = here.join(onward, "v").join(deeper, ["s", "w"]).groupBy("s", "v").agg(F.sum(F.col("paths") / F.col("_pw") * (1 + F.col("_dw"))).alias("dep"))
        dep = durable(here.join(gain, ["s", "v"], "left").withColumn("dep", F.coalesce("dep", F.lit(0.0))), "dependency")
        total = total.unionByName(dep)
    between = total.filter("s <> v").groupBy(F.col("v").alias("vertex")).agg(F.sum("dep").alias("betweenness"))
    around, _ = _breadth_first(vertices, links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    reach = around.groupBy(F.col("s").alias("vertex")).agg(F.sum("d").alias("far"))
    out = e.groupBy(F.col("source").alias("vertex")).agg(F.count(F.lit(1)).alias("out_degree"), F.sum("weight").alias("out_changes"))
    into = e.groupBy(F.col("target").alias("vertex")).agg(F.count(F.lit(1)).alias("in_degree"), F.sum("weight").alias("in_changes"))
    df = vertices.join(out, "vertex", "left").join(into, "vertex", "left").join(between, "vertex", "left").join(reach, "vertex", "left")
    zero = lambda c: F.coalesce(c, F.lit(0))
    degree = zero("in_degree") + zero("out_degree")
    return df.select(
        "vertex", zero("in_degree").alias("in_degree"), zero("out_degree").alias("out_degree"), degree.alias("degree"),
        F.coalesce("betweenness", F.lit(0.0)).alias("betweenness"), F.when(F.col("far") > 0, 1 / F.col("far")).alias("closeness"),
        zero("in_changes").alias("in_changes"), zero("out_changes").alias("out_changes"), F.when(degree > 0, zero("out_degree") / degree).alias("source_hub_ratio"),
    )


def _breadth_first(vertices: DataFrame, links: DataFrame) -> tuple[DataFrame, int]:
    """All-sources breadth-first levels ``(s, v, d, paths)`` and the deepest level."""
    start = vertices.select(F.col("vertex").alias("s"), F.col("vertex").alias("v"), F.lit(0).alias("d"), F.lit(1.0).alias("paths"))
    found, frontier, level = durable(start, "found"), start, 0
    while True:
        ahead = frontier.withColumnRenamed("v", "u").join(links, "u").groupBy("s", "v").agg(F.sum("paths").alias("paths"))
        frontier = durable(ahead.join(found.select("s", "v"), ["s", "v"], "left_anti").select("s", "v", F.lit(level + 1).alias("d"), "paths"), "frontier")
        if frontier.isEmpty():
            return found, level
        level += 1
        found = found.unionByName(frontier)


def marginal_states(probabilities: DataFrame, annotated: DataFrame | None = None, tolerance: float = 1e-10) -> DataFrame:
    """Best state of every node of a marginal reconstruction, with ties.

    ``probabilities(node, state, probability)``; an annotated state is the representative when
    given, else the first candidate.
    """
    top = probabilities.groupBy("node").agg(F.max("probability").alias("top"))
    best = probabilities.join(top, "node").filter(F.col("probability") >= F.col("top") - tolerance)
    # Candidates of a node are at most the states, a small set.
    sets = best.groupBy("node").agg(F.array_sort(F.collect_set("state")).alias("candidates"), F.max("top").alias("confidence"))
    out = sets.withColumn("tied", F.size("candidates") > 1)
    if annotated is None:
        return out.withColumn("state", F.element_at("candidates", 1))
    return out.join(annotated.select("node", F.col("state").alias("_a")), "node", "left").withColumn("state", F.coalesce("_a", F.element_at("candidates", 1))).drop("_a")


def marginal_network(tree: DataFrame, states: DataFrame, excluded_tips: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Branches and country changes of a marginal reconstruction.

    ``states`` as in :func:`marginal_states`, ``excluded_tips(node, reason)``. A branch to an
    excluded tip or with an unknown endpoint stays listed but out of the network.
    """
    from lineagespark.functions.geo import known_state

    side = lambda s, n: states.select(F.col("node").alias(n), F.col("state").alias(f"{s}_state"), F.col("confidence").alias(f"{s}_conf"), F.col("tied").alias(f"{s}_tied"))
    edges = tree.filter("parent IS NOT NULL").select("parent", F.col("node").alias("child"))
    df = edges.join(side("parent", "parent"), "parent").join(side("child", "child"), "child").join(excluded_tips.withColumnRenamed("node", "child"), "child", "left")
    reason = F.coalesce("reason", F.when(~known_state("parent_state") | ~known_state("child_state"), "Unknown endpoint country"), F.lit(""))
    sure = ~F.col("parent_tied") & ~F.col("child_tied") & (F.col("parent_conf") >= threshold) & (F.col("child_conf") >= threshold)
    branches = df.select(
        "parent", "child", "parent_state", "child_state", (F.col("parent_state") != F.col("child_state")).alias("changes"), F.coalesce(sure, F.lit(False)).alias("high"),
        (reason == "").alias("included"), reason.alias("reason"),
    )
    network = branches.filter("changes AND included").groupBy(F.col("parent_state").alias("source"), F.col("child_state").alias("target")).agg(
        F.count(F.lit(1)).alias("branches"), F.count_if("high").alias("high_endpoint_branches"), F.count_if(~F.col("high")).alias("uncertain_branches")
    )
    return branches, network
