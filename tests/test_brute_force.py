"""Iterative operators against small brute-force versions."""

import inspect
import itertools
import random
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from lineagespark.operators import clusters, distances, joins, network, ordination, selection, statistics, tours, trees
from lineagespark.plans import graphs
from lineagespark.plans import ranking as plans


def profiles(spark, n=60, loci=12, alleles=3, seed=1, missing=0.05, copies=True):
    rng = random.Random(seed)
    rows = [[0 if rng.random() < missing else rng.randint(1, alleles) for _ in range(loci)] for _ in range(n)]
    if copies:
        for i in range(0, n, 7):
            rows[i] = list(rows[0])
    ids = [f"p{i:03d}" for i in range(n)]
    df = spark.createDataFrame([("s", i, r) for i, r in zip(ids, rows)], "scope_id string, sample_id string, codes array<int>")
    return df, ids, np.array(rows)


def evidence(a, b):
    both = (a > 0) & (b > 0)
    return int((both & (a != b)).sum()), int(both.sum())


def test_tiled_pairs_match_pair_loop(spark):
    df, ids, codes = profiles(spark)
    got = {(r.sample_a, r.sample_b): (r.allele_differences, r.shared_called_loci) for r in distances.close_pairs(df, 0.7, 0.6, tile=9).collect()}
    want = {}
    for i, j in itertools.combinations(range(len(ids)), 2):
        d, s = evidence(codes[i], codes[j])
        if s and s / 12 >= 0.7 and d / s <= 0.6:
            want[ids[i], ids[j]] = (d, s)
    assert got == want


def greedy_linkage(ids, matrix, t):
    groups = {i: [i] for i in range(len(ids))}
    link = lambda a, b: max(matrix[x][y] for x in groups[a] for y in groups[b])
    while len(groups) > 1:
        best = min((link(a, b), a, b) for a, b in itertools.combinations(sorted(groups), 2))
        if best[0] > t:
            break
        groups[best[1]] += groups.pop(best[2])
    return {ids[m]: ids[min(g)] for g in groups.values() for m in g}


@pytest.mark.parametrize("task_members", [1000, 2])
def test_complete_linkage_in_task_and_in_rounds(spark, task_members):
    df, ids, codes = profiles(spark, n=36, missing=0.03, seed=3)
    matrix = np.full((36, 36), np.inf)
    for i, j in itertools.combinations(range(36), 2):
        d, s = evidence(codes[i], codes[j])
        if s / 12 >= 0.7:
            matrix[i, j] = matrix[j, i] = d / s
    ok = [i for i in range(36) if (codes[i] > 0).mean() >= 0.7]
    sub = [ids[i] for i in ok]
    want = greedy_linkage(sub, matrix[np.ix_(ok, ok)], 0.5)
    out = clusters.profile_groups(df.filter(F.col("sample_id").isin(sub)), 0.5, 0.7, tile=8, task_members=task_members)
    assert {r.sample_id: r.group_id for r in out.collect()} == want


def test_bootstrap_support_with_copies(spark):
    """A resample gives some profiles copies; each sample has one label a replicate all the same."""
    df, ids, codes = profiles(spark, n=30, missing=0.02, seed=9)
    loci, reps, seed = codes.shape[1], 6, 3
    draw = F.pmod(F.xxhash64(F.lit(seed), F.col("r"), F.col("d").cast("int")), F.lit(loci)).cast("int")
    rows = spark.range(1, reps + 1).select(F.col("id").cast("int").alias("r")).crossJoin(spark.range(loci).toDF("d")).select("r", "d", draw.alias("i")).collect()
    at = {(r.r, r.d): r.i for r in rows}

    def linked(c):
        matrix, broken = np.full((30, 30), np.inf), False
        for i, j in itertools.combinations(range(30), 2):
            d, s = evidence(c[i], c[j])
            if s / loci >= 0.5:
                matrix[i, j] = matrix[j, i] = d / s
            else:
                broken = True
        return None if broken else greedy_linkage(ids, matrix, 0.5)

    base = linked(codes)
    valid = [g for g in (linked(codes[:, [at[r, d] for d in range(loci)]]) for r in range(1, reps + 1)) if g]
    want = {}
    for group in set(base.values()):
        inside = [s for s in ids if base[s] == group]
        support = [np.mean([g[a] == g[b] for g in valid]) for a, b in itertools.combinations(inside, 2)]
        want[group] = (len(inside), len(valid), round(float(min(support)), 9) if support else None)
    out = clusters.bootstrap_support(df, 0.5, 0.5, reps, seed).collect()
    assert len(valid) > 1 and any(v[2] not in (None, 0.0, 1.0) for v in want.values())
    assert {r.group_id: (r.members, r.valid_replicates, None if r.minimum_pair_support is None else round(r.minimum_pair_support, 9)) for r in out} == want


@pytest.mark.parametrize("task_pairs", [1_000_000, 1])
def test_first_fit_cohorts(spark, task_pairs):
    df, ids, codes = profiles(spark, n=30, missing=0.2, seed=5, copies=False)
    good = [i for i in range(30) if (codes[i] > 0).mean() >= 0.7]
    cohorts = []
    for i in good:
        for c in cohorts:
            if all(evidence(codes[i], codes[j])[1] / 12 >= 0.7 for j in c):
                c.append(i)
                break
        else:
            cohorts.append([i])
    want = {ids[i]: f"cohort_{n}" for n, c in enumerate(cohorts, 1) for i in c}
    out = clusters.comparable_cohorts(df, 0.7, task_pairs)
    assert {r.sample_id: r.cohort_id for r in out.collect()} == want


def test_components_of_a_long_chain(spark):
    n = 300
    order = list(range(n))
    random.Random(2).shuffle(order)
    edges = spark.createDataFrame([(f"v{order[i]:03d}", f"v{order[i + 1]:03d}") for i in range(n - 1)] + [("w1", "w2")], "a string, b string")
    got = {r.id: r.component for r in clusters.connected_components(edges).collect()}
    assert len(got) == n + 2 and {v for k, v in got.items() if k[0] == "v"} == {"v000"} and got["w2"] == "w1"


def test_priority_turns(spark):
    rng = random.Random(4)
    cand = [f"c{i:02d}" for i in range(14)]
    rank = {q: rng.sample(cand, 9) for q in ("q1", "q2", "q3", "q4")}
    rank["q3"] = list(rank["q1"])
    rows = [(q, c, 0, float(i), i, 0) for q, cs in rank.items() for i, c in enumerate(cs)]
    ranked = spark.createDataFrame(rows, "query_id string, sample_id string, tier int, distance double, allele_differences int, neg_shared int")
    pool = spark.createDataFrame([(c, "x") for c in cand], "sample_id string, country string")
    out = selection.priority_pool(ranked, pool, ["country"], limit=12, seed=1).collect()
    taken, want = set(), {}
    while len(want) < 9:
        for q in sorted(rank):
            free = [c for c in rank[q] if c not in taken]
            if free and len(want) < 9:
                taken.add(free[0])
                want[free[0]] = q
    got = {r.sample_id: r.selection_reason.split(":")[1] for r in out if ":" in r.selection_reason}
    assert got == want and len(out) == 12


def test_priority_evidence_is_tier_first(spark):
    """Thirteen closer strangers do not hide a candidate of the query's own lineage; tiles do not matter."""
    rng = random.Random(9)
    ids = ["Q6", "Q12", "Q1"] + [f"C{i}" for i in range(1, 80)]
    calls = {s: [None if rng.random() < 0.03 else str(rng.randint(1, 2)) for _ in range(40)] for s in ids}
    for s in ids[:2]:
        calls[s] = ["1"] * 40
    for i in range(1, 80):
        if i % 6 and i < 40:
            calls[f"C{i}"] = ["1"] * 40
    rows = [("s", s, f"L{k:02d}", a) for s, cs in calls.items() for k, a in enumerate(cs)]
    samples = spark.createDataFrame([(s, "local" if s[0] == "Q" else "context") for s in ids], "sample_id string, origin string")
    inputs = SimpleNamespace(calls=spark.createDataFrame(rows, "scope_id string, sample_id string, locus string, allele string"), profiles=samples)

    def best(q, first):
        found = []
        for c in ids[3:]:
            both = [(a, b) for a, b in zip(calls[q], calls[c]) if a and b]
            d = sum(a != b for a, b in both)
            if len(both) / 40 >= plans.OVERLAP:
                found.append((int(int(q[1:]) % 6 != int(c[1:]) % 6), d / len(both), d, -len(both), c))
        return sorted(found)[:first]

    got = {}
    for r in plans.ranked_evidence(inputs).collect():
        got.setdefault(r.query_id, []).append((r.tier, r.distance, r.allele_differences, r.neg_shared, r.sample_id))
    assert {q: sorted(v) for q, v in got.items()} == {q: best(q, 40) for q in ids[:3]}
    assert got["Q6"] and min(got["Q6"])[0] == 0
    encoded = distances.encode_profiles(inputs.calls).withColumn("lineage", F.expr("string(substr(sample_id, 2) % 6)"))
    query = F.col("sample_id").startswith("Q")
    for tile in (7, 1024):
        out = distances.tiered_query_distances(encoded.filter(query), encoded.filter(~query), plans.OVERLAP, 5, tile)
        assert sorted((r.query_id, r.context_id) for r in out.collect()) == sorted((q, b[-1]) for q in ids[:3] for b in best(q, 5))


TREE = [("root", None, 0.0), ("a", "root", 0.1), ("b", "root", 0.2), ("t1", "a", 0.1), ("t2", "a", 0.1), ("c", "b", 0.1), ("t3", "c", 0.1), ("t4", "c", 0.1), ("t5", "b", 0.3)]


def tree_table(spark):
    rows = [("t", n, p, l, n.startswith("t")) for n, p, l in TREE]
    return spark.createDataFrame(rows, "tree_id string, node string, parent string, branch_length double, is_tip boolean")


def test_parsimony_against_every_history(spark):
    tree = tree_table(spark)
    tips = {"t1": "X", "t2": "Y", "t3": "Y", "t4": None, "t5": "Z"}
    observed = spark.createDataFrame(list(tips.items()), "node string, state string")
    parents = {n: p for n, p, _ in TREE if p}
    free = [n for n, _, _ in TREE if tips.get(n) is None]
    best, histories = None, []
    for states in itertools.product("XYZ", repeat=len(free)):
        full = {**{k: v for k, v in tips.items() if v}, **dict(zip(free, states))}
        cost = sum(full[c] != full[p] for c, p in parents.items())
        if best is None or cost < best:
            best, histories = cost, []
        if cost == best:
            histories.append(full)
    result = network.parsimony(tree, tours.tree_depths(tree), observed)
    assert result["optimum"].first().changes == best
    allowed = {r.node: set(r.allowed) for r in result["states"].collect()}
    assert allowed == {n: {h[n] for h in histories} for n, _, _ in TREE}
    counts = [{(a, b): sum(h[p] == a and h[c] == b for c, p in parents.items()) for a in "XYZ" for b in "XYZ" if a != b} for h in histories]
    want = {k: (min(c[k] for c in counts), max(c[k] for c in counts)) for k in counts[0] if max(c[k] for c in counts)}
    assert {(r.source, r.target): (r.min_changes, r.max_changes) for r in result["ranges"].collect()} == want
    moves = result["branches"].filter("source <> target").count()
    assert moves == best


def test_rerooting_keeps_distances(spark):
    tree = tree_table(spark)
    roots = spark.createDataFrame([("new", "t3")], "new_id string, tip string")
    out = trees.reroot(tree, tours.tree_order(tree), roots)
    tips = [n for n, _, _ in TREE if n[0] == "t"]
    pairs = spark.createDataFrame(list(itertools.combinations(tips, 2)), "sample_a string, sample_b string")
    read = lambda t: {(r.sample_a, r.sample_b): round(r.distance, 9) for r in trees.patristic(pairs, tours.tree_order(t)).collect()}
    assert read(tree) == read(out)
    assert trees.tree_problems(out).count() == 0


@pytest.mark.parametrize("tile", [1024, 16])
def test_ordination_matches_dense(spark, tile):
    """Whole scopes and block Lanczos against dense eigenvectors, with missing calls and negative eigenvalues."""
    df, ids, codes = profiles(spark, n=70, missing=0.05, seed=8, copies=False)
    # Three clusters, so that the two leading eigenvalues stand apart.
    codes[:25, :7], codes[25:45, :7] = np.where(codes[:25, :7] > 0, 1, 0), np.where(codes[25:45, :7] > 0, 2, 0)
    rows = [(s, i, r.tolist()) for s in ("s", "t") for i, r in zip(ids[: 70 if s == "s" else 41], codes)]
    df = spark.createDataFrame([*rows, ("one", "p", [1, 2]), ("two", "p", [1, 2]), ("two", "q", [1, 1])], df.schema)
    coords, report = ordination.leading_axes(df, 0.3, tile=tile)
    got = {(r.scope_id, r.sample_id): (r.axis_1, r.axis_2) for r in coords.collect()}
    table = report.collect()
    assert len(got) == 114 and got["one", "p"] == (0.0, 0.0)
    assert abs(got["two", "p"][0] - 0.25) < 1e-9 and abs(got["two", "q"][0] + 0.25) < 1e-9 and abs(got["two", "p"][1]) < 1e-6
    for scope, n in (("s", 70), ("t", 41)):
        d2 = np.array([[(lambda e: e[0] / e[1])(evidence(a, b)) for b in codes[:n]] for a in codes[:n]]) ** 2
        j = np.eye(n) - 1 / n
        values, vectors = np.linalg.eigh(-0.5 * j @ d2 @ j)
        assert values[0] < -0.05
        for axis in (1, 2):
            found = next(r for r in table if (r.scope_id, r.axis) == (scope, axis))
            assert abs(found.eigenvalue - values[-axis]) < 1e-6 and found.residual <= 1e-7 * values[-1]
            want = vectors[:, -axis] * values[-axis] ** 0.5
            want = want * np.sign(want[np.argmax(np.abs(want).round(9))])
            assert np.abs(np.array([got[scope, i][axis - 1] for i in ids[:n]]) - want).max() < 1e-6
        assert (next(r for r in table if r.scope_id == scope).rounds > 0) == (tile < n)


def test_ordination_of_bounded_scopes_takes_no_rounds(spark):
    """M4: several tiles of a scope that one task can hold are solved at once, with the same axes."""
    df, _, _ = profiles(spark, n=40, missing=0.0, seed=2, copies=False)
    coords, report = ordination.leading_axes(df, 0.3, tile=16, whole=40)
    rounds, _ = ordination.leading_axes(df, 0.3, tile=16)
    assert {r.rounds for r in report.collect()} == {0}
    want = {r.sample_id: r for r in rounds.collect()}
    assert all(abs(abs(r[f"axis_{k}"]) - abs(want[r.sample_id][f"axis_{k}"])) < 1e-6 for r in coords.collect() for k in (1, 2))


def test_ordination_refuses_missing_pairs_and_too_few_rounds(spark):
    df, _, codes = profiles(spark, n=40, missing=0.0, seed=2, copies=False)
    with pytest.raises(RuntimeError, match="no convergence"):
        ordination.leading_axes(df, 0.3, tile=16, rounds=1, block=2)
    broken = df.unionByName(spark.createDataFrame([("s", "x", [1] * 6 + [0] * 6), ("s", "y", [0] * 6 + [1] * 6)], df.schema))
    for tile in (1024, 16):
        with pytest.raises(ValueError, match="cannot be compared"):
            ordination.leading_axes(broken, 0.3, tile=tile)
    assert ordination.leading_axes(df.limit(0), 0.3)[0].count() == 0


def test_global_rank_is_a_permutation(spark):
    df = spark.range(1000).select(F.lit(1).alias("k"), F.col("id").cast("string").alias("i"))
    out = statistics.global_rank(df, ["k"], F.sha2("i", 256), "i", per_bucket=64)
    assert sorted(r["rank"] for r in out.collect()) == list(range(1, 1001))


def test_record_bounds(spark):
    rows = [(i, f"r{i}", 10 + i) for i in range(7)]
    out = joins.record_bounds(spark.createDataFrame(rows, "ord long, name string, length long"), width_of_chunk=3)
    got = {r.name: (r.start, r.end) for r in out.collect()}
    start = 1
    for _, name, length in rows:
        assert got[name] == (start, start + length - 1)
        start += length


def test_pins_keep_the_users_order(spark):
    from lineagespark.operators import selection

    nearest = spark.createDataFrame([("q", "a", 0.1), ("q", "p", 0.2), ("q", "b", 0.2), ("q", "c", 0.9)], "query_id string, sample_id string, value double")
    pinned = spark.createDataFrame([("z", 1), ("p", 2), ("z", 5), ("d", 3)], "sample_id string, ord int")
    rows = selection.mandatory_members(nearest, pinned, 2).orderBy("ord").collect()
    assert [r["sample_id"] for r in rows] == ["z", "p", "d", "a", "b"]
    assert rows[1]["reasons"][0] == "user_requested" and len(rows[1]["reasons"]) == 2
    assert [r["sample_id"] for r in selection.mandatory_members(nearest, pinned.select("sample_id"), 2).orderBy("ord").collect()] == ["d", "p", "z", "a", "b"]


def test_patients_without_a_code_are_uncoded(spark):
    from lineagespark.operators import statistics

    samples = spark.createDataFrame(
        [("x", "1", "local", "2020", None), ("y", "2", "local", "2020", "P1"), ("y", "3", "context", "2021", None), ("w", "4", "local", "2020", " ")],
        "lineage string, sample_id string, origin string, collection_date string, patient_id string",
    )
    groups = spark.createDataFrame([("x", "c", 1, False)], "lineage string, clade string, sample_count int, spans_periods boolean")
    signal = spark.createDataFrame([("x", True)], "lineage string, supported boolean")
    got = {r["lineage"]: r["patient_sensitivity"] for r in statistics.scenario(samples, groups, signal, ["lineage"]).collect()}
    assert got == {"x": "unavailable", "y": "supported", "w": "unavailable"}


def test_plans_use_all_replicates_and_roots(monkeypatch):
    """G5 resamples 30 times, and G10 tests the five roots of its operator."""
    asked = []
    monkeypatch.setattr(graphs, "selection_profiles", lambda t: t)
    monkeypatch.setattr(graphs.clusters, "bootstrap_support", lambda *args, replicates, seed: asked.append(replicates))
    graphs.bootstrap(None)
    assert asked == [30]
    default = lambda f: inspect.signature(f).parameters["limit"].default
    assert default(graphs.rerooted_trees) == default(network.choose_roots) == 5
