"""Complete linkage by windows and from lists of pairs, against the dense linkage of one scope."""

import numpy as np
import pytest

from lineagespark.operators import clusters

SCHEMA = "scope_id string, sample_id string, codes array<int>"


def profiles(spark, n=70, loci=12):
    rng = np.random.default_rng(3)
    bases = rng.integers(1, 4, (6, loci))
    rows = []
    for i in range(n):
        codes = np.where(rng.random(loci) < 0.35, rng.integers(0, 4, loci), bases[i % 6])
        rows.append(("st"[i % 2], f"p{i:03d}", [int(c) for c in codes]))
    return spark.createDataFrame(rows, SCHEMA)


def test_listed_pairs_link_as_the_matrix_does():
    rng = np.random.default_rng(1)
    for _ in range(20):
        n = 40
        m = rng.integers(1, 8, (n, n)) / 8.0
        m = np.where(rng.random((n, n)) < 0.5, m, np.inf)
        m = np.triu(m, 1)
        m = np.where(np.triu(np.ones((n, n), bool), 1), m, np.inf)
        m = np.minimum(m, m.T)
        i, j = np.nonzero(np.isfinite(np.triu(m, 1)) & np.triu(np.ones((n, n), bool), 1) & (m <= 0.75))
        assert (clusters.link_listed(n, i, j, m[i, j]) == clusters.link_greedily(np.where(m <= 0.75, m, np.inf), 0.75)).all()


@pytest.mark.parametrize("window", [2])
def test_windows_give_the_groups_of_one_task_at_every_cut(spark, window):
    """No list of all close pairs: scopes above the bound of a task are linked window by window."""
    rows, cuts = profiles(spark, 50), [0.4, 0.8]
    whole = {tuple(r) for r in clusters._link_scopes(rows, cuts, 0.6).collect()}
    assert {tuple(r) for r in clusters._sweep(rows, cuts, 0.6, tile=8, window=window).collect()} == whole


def test_a_window_lists_few_pairs(spark, monkeypatch):
    listed, link = [], clusters.complete_linkage
    monkeypatch.setattr(clusters, "complete_linkage", lambda ids, pairs, *rest: listed.append((ids.count(), pairs.count())) or link(ids, pairs, *rest))
    clusters.threshold_sensitivity(profiles(spark), 0.5, 0.6, task_members=10)
    close = clusters.near_pairs(profiles(spark), 0.6, 1.0).count()
    assert len(listed) > 1 and max(pairs for _, pairs in listed) < close / 2


def test_distributed_rounds_link_what_no_task_may(spark):
    rows = profiles(spark, 30)
    pairs = clusters.near_pairs(rows, 0.6, 0.5)
    one = {tuple(r) for r in clusters.complete_linkage(rows, pairs, 0.5).collect()}
    assert {tuple(r) for r in clusters.complete_linkage(rows, pairs, 0.5, task_members=2, task_pairs=0).collect()} == one


def test_scopes_whose_poorest_profiles_must_overlap_need_no_tile(spark, monkeypatch):
    from lineagespark.operators import clusters

    rows = [("full", f"a{i}", [1, 2, 3, i + 1]) for i in range(9)]
    rows += [("sure", f"b{i}", [0 if k == i % 4 else 1 for k in range(4)]) for i in range(9)]
    rows += [("doubt", f"c{i}", [0, 0, 1, 1]) for i in range(9)]
    rows += [("bad", "d0", [0, 0, 1, 1]), ("bad", "d1", [1, 1, 0, 0]), ("bad", "d2", [1, 1, 1, 1])]
    profiles = spark.createDataFrame(rows, "scope_id string, sample_id string, codes array<int>")
    seen = []
    keep = clusters.tile_pairs
    monkeypatch.setattr(clusters, "tile_pairs", lambda df, *a, **k: seen.extend(r[0] for r in df.select("scope_id").distinct().collect()) or keep(df, *a, **k))
    assert {r.scope_id for r in clusters.incomparable_scopes(profiles, 0.5).collect()} == {"bad"}
    assert set(seen) == {"doubt", "bad"}
