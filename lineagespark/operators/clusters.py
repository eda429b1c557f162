"""Groups: components, complete linkage, comparable cohorts, entity resolution.

Loops stop on a convergence test over the whole table; every round is written to the shared
folder, so a lost executor costs one round.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lineagespark.functions.text import clean
from lineagespark.operators.distances import (
    BLOCK, TILE, _comparable, _payload, _upper, copies_of, sample_pair_totals, spread, tile_cross, tile_pairs, unavailable_counts,
)
from lineagespark.operators.near_profiles import near_pairs
from lineagespark.session import durable, forget

MAX_ROUNDS = 200
#: Samples that one task links: 134 MB of distances.
LINKED = 4096
#: Listed pairs that one task links, pairs of groups listed at a time for each group, and levels of distance.
LISTED, WINDOW, LEVELS = 1_000_000, 16, 1024


def _is_forest_of_stars(edges: DataFrame) -> bool:
    """Whether every vertex points at one root and no root points on: the fixed point."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
        edges.select(F.col("v").alias("id"), F.lit(0).alias("out"), F.lit(1).alias("into"))
    )
    per = ends.groupBy("id").agg(F.sum("out").alias("out"), F.sum("into").alias("into"))
    return not per.filter("out > 1 OR (out > 0 AND into > 0)").limit(1).count()


def connected_components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """``(id, component)`` of every vertex of an edge list; the component is its smallest id.

    Alternating large-star and small-star steps: neighbours are linked to the smallest vertex
    of a star, so the number of edges never grows and few rounds are needed. Star minima are
    partial aggregates, and the join back carries one small row per vertex.
    """
    e = durable(edges.filter(F.col(left) != F.col(right)).select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v")).distinct(), "edges")
    for _ in range(MAX_ROUNDS):
        if _is_forest_of_stars(e):
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = durable(both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct(), "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        linked = large.join(least, "u")
        e = durable(
            linked.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
            .unionByName(least.select("u", F.col("m").alias("v"))).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
            "small",
        )
    else:
        raise RuntimeError("connected components did not settle")
    roots = e.select(F.col("v").alias("id")).distinct().withColumn("component", F.col("id"))
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)


def components_with_singletons(vertices: DataFrame, edges: DataFrame, ident: str) -> DataFrame:
    found = connected_components(edges).withColumnRenamed("id", ident)
    return vertices.select(ident).distinct().join(found, ident, "left").select(ident, F.coalesce("component", ident).alias("component"))


# -- entity resolution ------------------------------------------------------------------------


def star_edges(aliases: DataFrame, ident: str, alias: str = "alias") -> DataFrame:
    """Edges from every record to the smallest record sharing an alias: linear, not all pairs."""
    low = aliases.groupBy(alias).agg(F.min(ident).alias("b"))
    return aliases.join(low, alias).select(F.col(ident).alias("a"), "b").filter("a <> b").distinct()


def resolve_entities(records: DataFrame, aliases: DataFrame, focal_aliases: DataFrame) -> DataFrame:
    """Sample units of a catalogue: connected records, their unit id, representative and fate.

    ``records(source_genome_id, qc_pass, country)``, ``aliases(source_genome_id, alias)`` with
    version-free upper-case accessions, ``focal_aliases(alias)``. A unit with one sample
    accession is named by it; several are a conflict. Units that touch a focal alias are
    excluded with that reason.
    """
    members = durable(components_with_singletons(records, star_edges(aliases, "source_genome_id"), "source_genome_id"), "members")
    worse = F.when(F.coalesce("qc_pass", F.lit(False)), 0).otherwise(1)
    units = records.join(members, "source_genome_id").groupBy("component").agg(
        F.count(F.lit(1)).alias("raw_genome_count"), F.min(F.struct(worse.alias("w"), "source_genome_id")).alias("r"),
        (F.min("country") != F.max("country")).alias("country_conflict"),
    )
    owned = aliases.join(members, "source_genome_id").select("component", "alias").distinct()
    focal = focal_aliases.select("alias").distinct().withColumn("_f", F.lit(1))
    named = owned.join(focal, "alias", "left").groupBy("component").agg(
        F.min("alias").alias("first_alias"), F.min(F.when(F.col("alias").startswith("SAM"), F.col("alias"))).alias("first_sample"),
        F.count_if(F.col("alias").startswith("SAM")).alias("samples"), F.count("_f").alias("focal_matches"),
    )
    touched = members.withColumn("alias", F.upper("source_genome_id")).join(focal, "alias", "left_semi").select("component").distinct().withColumn("_id_match", F.lit(1))
    df = units.join(named, "component", "left").join(touched, "component", "left")
    conflict = F.coalesce(F.col("samples") > 1, F.lit(False))
    unit = F.when(F.col("samples") == 1, F.col("first_sample")).otherwise(F.coalesce("first_alias", F.concat(F.lit("source:"), "component")))
    hit = (F.coalesce("focal_matches", F.lit(0)) > 0) | F.col("_id_match").isNotNull()
    return df.select(
        "component", unit.alias("sample_unit_id"), F.col("r.source_genome_id").alias("representative"), "raw_genome_count", "country_conflict",
        conflict.alias("identity_conflict"), (F.col("first_alias").isNotNull() & ~conflict).alias("identity_resolved"),
        F.when(hit, "focal_overlap").when(conflict, "conflicting_biosamples").when(F.col("raw_genome_count") > 1, "duplicate").otherwise("retained").alias("reason"),
    )


# -- distance groups ----------------------------------------------------------------------------


def threshold_groups(profiles: DataFrame, threshold: float, min_overlap: float, tile: int = TILE) -> DataFrame:
    """Single-linkage groups: components of the pairs within a distance. ``(sample_id, component)``."""
    distinct, members = copies_of(profiles)
    pairs = near_pairs(distinct.drop("copies"), min_overlap, threshold + 1e-12, tile)
    groups = components_with_singletons(distinct, pairs.select(F.col("sample_a").alias("a"), F.col("sample_b").alias("b")), "sample_id")
    return members.join(groups.withColumnRenamed("sample_id", "representative"), "representative").select("sample_id", "component")


def same_group(pairs: DataFrame, membership: DataFrame) -> DataFrame:
    """Whether each requested pair shares a group; null when the pair is not callable.

    ``pairs(sample_a, sample_b, callable)``.
    """
    side = lambda s: membership.select(F.col("sample_id").alias(f"sample_{s}"), F.col("component").alias(f"g_{s}"))
    df = pairs.join(side("a"), "sample_a").join(side("b"), "sample_b")
    return df.select("sample_a", "sample_b", F.when(F.col("callable"), F.col("g_a") == F.col("g_b")).alias("together"))


def link_greedily(matrix: np.ndarray, threshold: float) -> np.ndarray:
    """Complete linkage of one distance matrix (inf where unavailable); label per row.

    Merges the smallest (distance, i, j) first, where a cluster sits at its smallest row.
    """
    n = len(matrix)
    d = matrix.copy()
    np.fill_diagonal(d, np.inf)
    label = np.arange(n)
    best = d.argmin(axis=1)
    low = d[np.arange(n), best]
    while n > 1:
        i = int(low.argmin())
        if not low[i] <= threshold:
            break
        j = int(best[i])
        label[label == j] = i
        row = np.maximum(d[i], d[j])
        d[i], d[:, i] = row, row
        d[j], d[:, j] = np.inf, np.inf
        d[i, i] = np.inf
        stale = np.flatnonzero((best == i) | (best == j))
        for k in {i, j, *stale.tolist()}:
            best[k] = d[k].argmin()
            low[k] = d[k, best[k]]
    return label


def link_listed(n: int, i: np.ndarray, j: np.ndarray, distance: np.ndarray) -> np.ndarray:
    """What ``link_greedily`` gives for a list of pairs (``i < j``); pairs that are not listed are unavailable."""
    queue = list(zip(distance.tolist(), i.tolist(), j.tolist()))
    near = [{} for _ in range(n)]
    for d, a, b in queue:
        near[a][b] = near[b][a] = d
    heapq.heapify(queue)
    label = np.arange(n)
    while queue:
        d, a, b = heapq.heappop(queue)
        if near[a].get(b) != d:
            continue
        label[b] = a
        of_a, of_b, near[a], near[b] = near[a], near[b], {}, {}
        del of_a[b], of_b[a]
        for k in of_b:
            del near[k][b]
        for k, old in of_a.items():
            del near[k][a]
            if k in of_b:
                new = max(old, of_b[k])
                near[a][k] = near[k][a] = new
                if new != old:
                    heapq.heappush(queue, (new, min(a, k), max(a, k)))
    # A row's label is smaller than the row, so labels are final in row order.
    for k in range(n):
        label[k] = label[label[k]]
    return label


def complete_linkage(ids: DataFrame, pairs: DataFrame, threshold: float, task_members: int = LINKED, task_pairs: int = LISTED) -> DataFrame:
    """Complete-linkage groups ``(scope_id, sample_id, group_id)``, the group named by its smallest id.

    ``ids(scope_id, sample_id)``, ``pairs(scope_id, sample_a, sample_b, distance)`` holding every
    available pair within ``threshold``. Groups never cross a component of those pairs.
    Components of bounded size or with a bounded number of pairs are linked in one task each; larger ones by distributed rounds
    that merge all mutual nearest clusters, which under the total order (distance, i, j) gives
    the same groups.
    """
    near = durable(pairs.filter(F.col("distance") <= threshold).select("scope_id", "sample_a", "sample_b", "distance"), "near")
    key = lambda c: F.concat_ws("\x01", "scope_id", c)
    if near.count() <= task_pairs:
        # Few pairs in all: a task links a scope.
        small, big = near.withColumn("component", F.col("scope_id")), None
    else:
        comp = durable(connected_components(near.select(key("sample_a").alias("a"), key("sample_b").alias("b"))).withColumnRenamed("id", "_k"), "components")
        tagged = durable(near.withColumn("_k", key("sample_a")).join(comp, "_k").drop("_k"), "tagged")
        sizes = comp.groupBy("component").agg(F.count(F.lit(1)).alias("n")).join(tagged.groupBy("component").agg(F.count(F.lit(1)).alias("pairs")), "component")
        fits = (F.col("n") <= task_members) | (F.col("pairs") <= task_pairs)
        sized = tagged.join(sizes, "component")
        small, big = sized.filter(fits), sized.filter(~fits)

    def link(pdf: pd.DataFrame) -> pd.DataFrame:
        names = np.unique(np.concatenate([pdf["sample_a"].to_numpy(str), pdf["sample_b"].to_numpy(str)]))
        i, j = np.searchsorted(names, pdf["sample_a"].to_numpy(str)), np.searchsorted(names, pdf["sample_b"].to_numpy(str))
        if len(pdf) <= task_pairs:
            label = link_listed(len(names), np.minimum(i, j), np.maximum(i, j), pdf["distance"].to_numpy())
        else:
            matrix = np.full((len(names), len(names)), np.inf)
            matrix[i, j] = matrix[j, i] = pdf["distance"].to_numpy()
            label = link_greedily(matrix, threshold)
        return pd.DataFrame({"scope_id": pdf["scope_id"].iloc[0], "sample_id": names.astype(object), "group_id": names[label].astype(object)})

    schema = "scope_id string, sample_id string, group_id string"
    linked = small.groupBy("component").applyInPandas(link, schema)
    if big is not None and not big.isEmpty():
        linked = linked.unionByName(_linkage_rounds(big.select("scope_id", "sample_a", "sample_b", "distance")))
    return ids.join(linked, ["scope_id", "sample_id"], "left").select("scope_id", "sample_id", F.coalesce("group_id", "sample_id").alias("group_id"))


def _linkage_rounds(pairs: DataFrame) -> DataFrame:
    """Mutual-nearest merging over edge tables; ends when no cluster pair is complete."""
    e = durable(pairs.select("scope_id", F.col("sample_a").alias("x"), F.col("sample_b").alias("y"), "distance"), "links")
    ends = e.select("scope_id", F.col("x").alias("sample_id")).unionByName(e.select("scope_id", F.col("y").alias("sample_id"))).distinct()
    member = durable(ends.withColumn("group_id", F.col("sample_id")), "member")
    while not e.isEmpty():
        both = e.unionByName(e.select("scope_id", F.col("y").alias("x"), F.col("x").alias("y"), "distance"))
        order = F.struct("distance", F.least("x", "y").alias("lo"), F.greatest("x", "y").alias("hi"))
        best = both.groupBy("scope_id", "x").agg(F.min(order).alias("b")).select("scope_id", "x", "b.lo", "b.hi")
        merges = durable(best.groupBy("scope_id", "lo", "hi").count().filter("count = 2").select("scope_id", "lo", "hi"), "merges")
        move = merges.select("scope_id", F.col("hi").alias("old"), F.col("lo").alias("new"))
        parts = merges.select("scope_id", F.col("lo").alias("c"), F.lit(2).alias("parts"))
        member = durable(
            member.join(move, (member["scope_id"] == move["scope_id"]) & (member["group_id"] == move["old"]), "left")
            .select(member["scope_id"], "sample_id", F.coalesce("new", "group_id").alias("group_id")), "member",
        )
        rename = lambda df, c: df.join(move.select("scope_id", F.col("old").alias(c), F.col("new").alias(f"_{c}")), ["scope_id", c], "left").withColumn(c, F.coalesce(f"_{c}", c)).drop(f"_{c}")
        moved = rename(rename(e, "x"), "y").filter("x <> y")
        merged = moved.groupBy("scope_id", F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).agg(F.max("distance").alias("distance"), F.count(F.lit(1)).alias("n"))
        px = parts.select("scope_id", F.col("c").alias("x"), F.col("parts").alias("_px"))
        py = parts.select("scope_id", F.col("c").alias("y"), F.col("parts").alias("_py"))
        whole = merged.join(px, ["scope_id", "x"], "left").join(py, ["scope_id", "y"], "left")
        want = F.coalesce("_px", F.lit(1)) * F.coalesce("_py", F.lit(1))
        e = durable(whole.filter(F.col("n") == want).select("scope_id", "x", "y", "distance"), "links")
    return member


def _by_size(profiles: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """The profiles of scopes of at most ``limit`` samples, and the others."""
    sizes = durable(profiles.groupBy("scope_id").agg(F.count(F.lit(1)).alias("_size")), "sizes")
    sized = profiles.join(sizes, "scope_id")
    return sized.filter(F.col("_size") <= limit).drop("_size"), sized.filter(F.col("_size") > limit).drop("_size")


def _link_scopes(profiles: DataFrame, cuts: list[float], min_overlap: float) -> DataFrame:
    """Complete-linkage groups at each cut, ``(scope_id, threshold, sample_id, group_id)``; a task compares and links a scope, no pair leaves it."""

    def link(table: pa.Table) -> pa.Table:
        table = table.sort_by("sample_id").combine_chunks()
        names = table["sample_id"].combine_chunks()
        differences, shared, good, _ = _comparable(table, table, min_overlap)
        distance = np.where(good, differences / np.maximum(shared, 1), np.inf)
        del differences, shared, good
        out = []
        for cut in cuts:
            label = link_greedily(np.where(distance <= cut, distance, np.inf), cut)
            out.append(pa.table([table["scope_id"], pa.array(np.full(len(names), cut)), names, names.take(pa.array(label))], names=["scope_id", "threshold", "sample_id", "group_id"]))
        return pa.concat_tables(out)

    rows = spread(profiles.select("scope_id", "sample_id", *_payload(profiles)), "scope_id")
    return rows.groupBy("scope_id").applyInArrow(link, "scope_id string, threshold double, sample_id string, group_id string")


def _group_tiles(left: pa.Table, right: pa.Table, same: bool, min_overlap: float, tile: int = TILE):
    """Names and complete-linkage distances (inf where a pair is unavailable) of the groups of two blocks, tile by tile; a group is in one tile."""

    def cut(table):
        table = table.sort_by("group_id").combine_chunks()
        names = table["group_id"].to_numpy(zero_copy_only=False).astype(object)
        starts = np.flatnonzero(np.append(True, names[1:] != names[:-1]))
        parts = np.flatnonzero(np.append(True, starts[1:] // tile != starts[:-1] // tile)) if len(starts) else []
        for lo, hi in zip(parts, [*parts[1:], len(starts)]):
            end = starts[hi] if hi < len(starts) else len(names)
            yield table.slice(starts[lo], end - starts[lo]).combine_chunks(), names[starts[lo:hi]], starts[lo:hi] - starts[lo]

    rights = list(cut(right))
    for at, (a, x, i) in enumerate(rights if same else cut(left)):
        for b, y, j in rights[at if same else 0 :]:
            differences, shared, good, _ = _comparable(a, b, min_overlap)
            distance = np.where(good, differences / np.maximum(shared, 1), np.inf)
            distance = np.maximum.reduceat(np.maximum.reduceat(distance, i, axis=0), j, axis=1)
            if a is b:
                distance[np.tril_indices(len(x))] = np.inf
            yield x, y, distance


def _sweep(profiles: DataFrame, cuts: list[float], min_overlap: float, task_members: int = LINKED, tile: int = TILE, window: int = WINDOW) -> DataFrame:
    """Complete-linkage groups at each cut, ``(scope_id, threshold, sample_id, group_id)``, of scopes of any size.

    Distances of groups never fall as groups merge, so linkage goes on in windows of rising distance: tiles count the pairs
    of groups by level, the pairs of a window (about ``window`` a group) are listed and linked, and the groups that
    come of it enter the next window. Tiles keep a group together and leave one distance for each pair of groups, so no list holds the
    pairs of samples.
    """
    payload = _payload(profiles)
    state = durable(profiles.select("scope_id", F.col("sample_id").alias("group_id"), "sample_id", *payload), "state")
    tiles = lambda kernel, schema: tile_pairs(state, "group_id", payload, kernel, schema, block, block)
    block, low, out = max(tile, BLOCK), -1.0, []
    for cut in sorted(cuts):

        def levels(left, right, same):
            counts = np.zeros(LEVELS + 1, np.int64)
            for _, _, distance in _group_tiles(left, right, same, min_overlap, tile):
                near = distance[(distance > low) & (distance <= cut)]
                counts += np.bincount(np.ceil(near * LEVELS).astype(np.int64), minlength=LEVELS + 1)
            found = np.flatnonzero(counts)
            return {"level": pa.array(found, pa.int32()), "n": pa.array(counts[found], pa.int64())}

        while low < cut:
            # One row a level, at most LEVELS + 1.
            counts = tiles(levels, "level int, n bigint").groupBy("level").agg(F.sum("n").alias("n")).orderBy("level").collect()
            wanted = min(window * state.select("scope_id", "group_id").distinct().count(), LISTED)
            total, top = 0, None
            for row in counts:
                total += row["n"]
                if top is not None and total > wanted:
                    break
                top = row["level"]
            if top is None or row["level"] == top and total <= wanted:
                bound = cut
            else:
                bound = min(cut, top / LEVELS)
            if top is not None:

                def listed(left, right, same):
                    a, b, d = [], [], []
                    for x, y, distance in _group_tiles(left, right, same, min_overlap, tile):
                        i, j = np.nonzero(distance <= bound)
                        a.append(x[i])
                        b.append(y[j])
                        d.append(distance[i, j])
                    a, b = (np.concatenate(v) if v else np.array([], object) for v in (a, b))
                    swap = a > b
                    return {
                        "sample_a": pa.array(np.where(swap, b, a), pa.string()), "sample_b": pa.array(np.where(swap, a, b), pa.string()),
                        "distance": pa.array(np.concatenate(d) if d else [], pa.float64()),
                    }

                ids = state.select("scope_id", F.col("group_id").alias("sample_id")).distinct()
                pairs = durable(tiles(listed, "sample_a string, sample_b string, distance double"), "window")
                linked = complete_linkage(ids, pairs, bound, task_members).select("scope_id", F.col("sample_id").alias("group_id"), F.col("group_id").alias("_group"))
                before, state = state, durable(state.join(linked, ["scope_id", "group_id"]).select("scope_id", F.col("_group").alias("group_id"), "sample_id", *payload), "state")
                forget(before, pairs)
            low = bound
        out.append(durable(state.select("scope_id", F.lit(cut).alias("threshold"), "sample_id", "group_id"), "cut"))
    result = out[0]
    for df in out[1:]:
        result = result.unionByName(df)
    return result


def _linked_at(profiles: DataFrame, cuts: list[float], min_overlap: float, task_members: int, tile: int = TILE) -> DataFrame:
    """Complete-linkage groups at each cut: scopes of at most ``task_members`` profiles in one task, larger ones by windows."""
    small, large = _by_size(profiles, task_members)
    groups = _link_scopes(small, cuts, min_overlap)
    return groups if large.isEmpty() else groups.unionByName(_sweep(large, cuts, min_overlap, task_members, tile))


def profile_groups(profiles: DataFrame, threshold: float, min_overlap: float, tile: int = TILE, task_members: int = LINKED) -> DataFrame:
    """Complete-linkage groups of encoded profiles; copies of a profile always stay together."""
    distinct, members = copies_of(profiles)
    groups = _linked_at(distinct.drop("copies"), [threshold], min_overlap, task_members, tile).drop("threshold")
    return members.join(groups.withColumnRenamed("sample_id", "representative"), ["scope_id", "representative"]).select("scope_id", "sample_id", "group_id")


def threshold_sensitivity(profiles: DataFrame, threshold: float, min_overlap: float, task_members: int = LINKED) -> DataFrame:
    """Group counts and sizes at half, one and two times the threshold; one linkage serves all three."""
    distinct, _ = copies_of(profiles)
    cuts = sorted({threshold / 2, threshold, min(1.0, threshold * 2)})
    groups = _linked_at(distinct.drop("copies"), cuts, min_overlap, task_members)
    sizes = groups.join(distinct.select("scope_id", "sample_id", "copies"), ["scope_id", "sample_id"]).groupBy("scope_id", "threshold", "group_id").agg(F.sum("copies").alias("size"))
    return sizes.groupBy("scope_id", "threshold").agg(
        F.count(F.lit(1)).alias("group_count"), F.count_if(F.col("size") == 1).alias("singletons"), F.max("size").alias("largest_group")
    ).select("scope_id", "group_count", "singletons", "largest_group", "threshold", (F.col("threshold") == threshold).alias("selected"))


def incomparable_scopes(profiles: DataFrame, min_overlap: float, tile: int = TILE) -> DataFrame:
    """Scopes with a pair that may not be compared; a tile leaves one row at most.

    Two profiles share at least the loci that neither misses, so a scope in which that is enough even for its two
    poorest ones has no such pair and needs no tile. Fingerprints of schemes are compared by tiles only.
    """
    if "fingerprint" not in profiles.columns:
        loci, missing = F.size("codes"), F.size(F.filter("codes", lambda c: c == 0))
        least = F.col("loci") - 2 * F.col("missing")
        sizes = profiles.groupBy("scope_id").agg(F.min(loci).alias("loci"), F.max(missing).alias("missing"))
        # One row a scope, written, so that the join knows its size.
        doubtful = durable(sizes.filter(~((least > 0) & (least / F.col("loci") >= min_overlap))).select("scope_id"), "doubtful")
        profiles = profiles.join(doubtful, "scope_id", "left_semi")

    def kernel(left, right, same):
        _, _, good, _ = _comparable(left, right, min_overlap)
        return {"bad": pa.array([1] if _upper(~good, left, right, same).any() else [], pa.int32())}

    return tile_pairs(profiles, "sample_id", _payload(profiles), kernel, "bad int", tile).select("scope_id").distinct()


def comparable_cohorts(profiles: DataFrame, min_overlap: float, step: int = 2048) -> DataFrame:
    """First-fit cohorts in which every pair is comparable: ``(scope_id, sample_id, cohort_id)``.

    First fit in id order gives each sample the lowest number unused by its smaller incomparable
    neighbours. Samples are settled ``step`` at a time in every scope: tiles against the settled ones leave
    the numbers that are taken, not the pairs, and one task per scope numbers the step in id order.
    Rounds grow with the largest scope over ``step``. Cohorts are numbered by their first member.
    """
    called = F.size(F.filter("codes", lambda c: c > 0))
    payload = _payload(profiles)
    own = profiles.filter((called > 0) & (called / F.size("codes") >= min_overlap)).select("scope_id", "sample_id", *payload)
    eligible = in_steps(own, step)
    steps = eligible.agg(F.max("step")).first()[0]
    if steps is None:
        return eligible.select("scope_id", "sample_id", F.lit(None).cast("string").alias("cohort_id"))

    def taken(left, right, same):
        _, _, good, _ = _comparable(left, right, min_overlap)
        number = right["number"].to_numpy()
        known = np.unique(number)
        used = np.stack([~good[:, number == k].all(axis=1) for k in known], axis=1)
        rows = [known[u].tolist() for u in used]
        return {"sample_id": left["sample_id"], "used": pa.array(rows, pa.list_(pa.int32()))}

    def number(table: pa.Table) -> pa.Table:
        table = table.sort_by("sample_id")
        _, _, good, _ = _comparable(table, table, min_overlap)
        used, given = table["used"].to_pylist(), np.zeros(len(table), np.int32)
        for i in range(len(table)):
            taken = set(used[i] or ()) | set(given[:i][~good[i, :i]].tolist())
            given[i] = next(k for k in range(len(taken) + 1) if k not in taken)
        return table.select(["scope_id", "sample_id"]).append_column("number", pa.array(given))

    settled = None
    for at in range(steps + 1):
        now = eligible.filter(F.col("step") == at).drop("step")
        if settled is None:
            ready = now.withColumn("used", F.lit(None).cast("array<int>"))
        else:
            before = eligible.filter(F.col("step") < at).drop("step").join(settled, ["scope_id", "sample_id"])
            tiles = tile_cross(now.withColumn("number", F.lit(0)), before, "sample_id", [*payload, "number"], taken, "sample_id string, used array<int>")
            used = tiles.groupBy("scope_id", "sample_id").agg(F.array_distinct(F.flatten(F.collect_list("used"))).alias("used"))
            ready = now.join(used, ["scope_id", "sample_id"], "left")
        new = ready.groupBy("scope_id").applyInArrow(number, "scope_id string, sample_id string, number int")
        settled = durable(new if settled is None else settled.unionByName(new), "settled")
    firsts = settled.groupBy("scope_id", "number").agg(F.min("sample_id").alias("first"))
    # Cohorts are few; one sort numbers them.
    numbered = firsts.withColumn("cohort_id", F.concat(F.lit("cohort_"), F.row_number().over(Window.orderBy("first"))))
    return settled.join(numbered, ["scope_id", "number"]).select("scope_id", "sample_id", "cohort_id")


def in_steps(rows: DataFrame, step: int) -> DataFrame:
    """Add ``step``, written once: about ``step`` rows of a scope in id order, by ranges and not by a sort of a scope."""
    ranges = max(1, -(-rows.count() // step))
    ranged = durable(rows.repartitionByRange(ranges, "scope_id", "sample_id").withColumn("range", F.spark_partition_id()), "ranges")
    # One row per range and scope.
    steps = ranged.select("scope_id", "range").distinct().withColumn("step", F.row_number().over(Window.partitionBy("scope_id").orderBy("range")) - 1)
    return durable(ranged.join(steps, ["scope_id", "range"]).drop("range"), "steps")


def bootstrap_support(profiles: DataFrame, threshold: float, min_overlap: float, replicates: int, seed: int) -> DataFrame:
    """Locus bootstrap of complete-linkage groups: valid replicates and weakest pair support.

    A replicate redraws loci by hash, so it is an array gather of the codes; all replicates go
    through the same pair and linkage steps, with (scope, replicate) as the scope. A replicate
    with any incomparable pair is invalid. Each sample's labels over the valid replicates
    then form a short profile, and the weakest support in a group is one minus the largest
    mismatch fraction, found by the tile kernel without listing pairs.
    """
    groups = durable(profile_groups(profiles, threshold, min_overlap), "groups")
    draws = F.transform(F.sequence(F.lit(0), F.size("codes") - 1), lambda d: F.pmod(F.xxhash64(F.lit(seed), F.col("r"), d), F.size("codes")).cast("int"))
    copies = profiles.withColumn("r", F.explode(F.sequence(F.lit(1), F.lit(replicates)))).withColumn("draws", draws)
    drawn = copies.select(F.concat_ws("#", "scope_id", F.lpad(F.col("r").cast("string"), 5, "0")).alias("scope_id"), "sample_id", F.transform("draws", lambda i: F.get("codes", i)).alias("codes"))
    drawn = durable(drawn, "drawn")
    broken = incomparable_scopes(drawn, min_overlap)
    valid = drawn.join(durable(broken, "broken"), "scope_id", "left_anti")
    labels = profile_groups(valid, threshold, min_overlap)
    coded = labels.select(F.substring_index("scope_id", "#", 1).alias("scope_id"), F.substring_index("scope_id", "#", -1).alias("r"), "sample_id", F.hash("group_id").alias("label"), "group_id")
    # Labels become per-replicate numbers, so equal numbers mean equal groups exactly.
    numbers = coded.select("scope_id", "r", "group_id").distinct().withColumn("n", F.dense_rank().over(Window.partitionBy("scope_id", "r").orderBy("group_id")))
    vectors = coded.join(numbers, ["scope_id", "r", "group_id"]).groupBy("scope_id", "sample_id").agg(F.array_sort(F.collect_list(F.struct("r", "n"))).alias("c"))
    inside = vectors.join(groups, ["scope_id", "sample_id"]).select("group_id", "sample_id", F.col("c.n").alias("codes"), F.col("scope_id").alias("home"))
    per = sample_pair_totals(inside.withColumnRenamed("group_id", "scope_id").drop("home"), 0.0)
    support = per.groupBy(F.col("scope_id").alias("group_id")).agg((1 - F.max("max_distance")).alias("minimum_pair_support"))
    reps = valid.select(F.substring_index("scope_id", "#", 1).alias("scope_id"), "scope_id").toDF("home", "scope_id").distinct().groupBy("home").agg(F.count(F.lit(1)).alias("valid_replicates"))
    sizes = groups.groupBy("scope_id", "group_id").agg(F.count(F.lit(1)).alias("members"))
    return sizes.join(support, "group_id", "left").join(reps.withColumnRenamed("home", "scope_id"), "scope_id", "left").select(
        "scope_id", "group_id", "members", F.coalesce("valid_replicates", F.lit(0)).alias("valid_replicates"), "minimum_pair_support"
    )


def group_anchors(groups: DataFrame, labels: DataFrame) -> DataFrame:
    """The one label all members of a group share, if none lacks it.

    ``groups(sample_id, group_id)``, ``labels(sample_id, kind, label)``.
    """
    kinds = labels.select("kind").distinct()
    sizes = groups.groupBy("group_id").agg(F.count(F.lit(1)).alias("members"))
    found = groups.join(labels, "sample_id").groupBy("group_id", "kind").agg(F.count("label").alias("n"), F.min("label").alias("lo"), F.max("label").alias("hi"))
    return sizes.crossJoin(F.broadcast(kinds)).join(found, ["group_id", "kind"], "left").select(
        "group_id", "kind", "members", F.when((F.col("n") == F.col("members")) & (F.col("lo") == F.col("hi")), F.col("lo")).alias("anchor")
    )


# -- lineage blocks --------------------------------------------------------------------------------


def lineage_blocks(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Disjoint blocks of inputs and the context that shares their scoped prefix.

    ``records(sample_id, role, species, mlst_st, mlst_scheme, kind, scheme, version,
    database_version, database_sha256, prefix)`` with an empty prefix when unresolved. A
    missing MLST scheme adopts the only declared one of its species and type; with several it
    is ambiguous. Returns block members and the samples left out with a reason.
    """
    space = ["species", "mlst_st"]
    declared = records.filter(clean("mlst_scheme") != "").groupBy(*space).agg(F.min("mlst_scheme").alias("_lo"), F.max("mlst_scheme").alias("_hi"))
    df = records.join(declared, space, "left")
    lacking = clean("mlst_scheme") == ""
    ambiguous = lacking & F.coalesce(F.col("_lo") != F.col("_hi"), F.lit(False))
    df = df.withColumn("_scheme", F.when(~lacking, F.col("mlst_scheme")).when(~ambiguous, F.col("_lo"))).withColumn("_ambiguous", ambiguous)
    usable = ~F.col("_ambiguous") & (clean("prefix") != "") & (clean("mlst_st") != "") & (clean("species") != "")
    parts = ["species", "mlst_st", "kind", "scheme", "version", "database_version", "database_sha256", "_scheme", "prefix"]
    key = F.to_json(F.struct(*parts), {"ignoreNullFields": "false"})
    df = df.withColumn("_key", F.when(usable, key))
    keys = df.filter("role = 'input' AND _key IS NOT NULL").select("_key").distinct()
    block = F.concat(F.col("kind"), F.lit("_"), F.substring(F.sha2("_key", 256), 1, 12))
    members = df.join(keys, "_key", "left_semi").select("sample_id", "role", block.alias("block_id"))
    left = df.join(members.select("sample_id"), "sample_id", "left_anti").select(
        "sample_id", "role", F.when(F.col("role") == "input", "missing_or_unresolved_partition_typing").when(F.col("_ambiguous"), "ambiguous_mlst_namespace").otherwise("unmatched_context").alias("reason")
    )
    return members, left


def route(records: DataFrame, labels: DataFrame) -> DataFrame:
    """Records under their analysis dataset, with the original lineage kept beside it.

    ``labels(id, dataset)``; records without a dataset keep their lineage.
    """
    df = records.join(labels, "id", "left")
    return df.withColumn("input_lineage", F.when(F.col("dataset").isNotNull(), F.col("lineage"))).withColumn("lineage", F.coalesce("dataset", "lineage")).drop("dataset")
