"""The segment index against the comparison of all tiles."""

import random

import pytest
from pyspark.sql import functions as F

from lineagespark.operators import distances, near_profiles


def clustered(spark, seed=6, clusters=9, members=14, loci=60):
    """Clusters of near profiles with missing calls; some profiles miss very many; two scopes of different width."""
    rng = random.Random(seed)
    rows = []
    for scope, width in (("s", loci), ("t", loci - 17)):
        for c in range(clusters):
            centre = [rng.randint(1, 40) for _ in range(width)]
            for m in range(members):
                codes = [rng.randint(1, 40) if rng.random() < 0.03 else x for x in centre]
                codes = [0 if rng.random() < (0.4 if m == 0 and c % 3 == 0 else 0.01) else x for x in codes]
                rows.append((scope, f"{scope}{c:02d}_{m:02d}", codes))
        rows.append((scope, f"{scope}none", [0] * width))
    return spark.createDataFrame(rows, "scope_id string, sample_id string, codes array<int>").repartition(3)


@pytest.mark.parametrize("threshold,overlap,tile", [(0.05, 0.5, 1024), (0.1, 0.5, 8), (0.0, 0.0, 8)])
def test_index_finds_what_all_tiles_find(spark, monkeypatch, threshold, overlap, tile):
    profiles = clustered(spark)
    want = {tuple(r) for r in distances.close_pairs(profiles, overlap, threshold).select("scope_id", "sample_a", "sample_b", "allele_differences", "shared_called_loci", "scheme_loci").collect()}
    monkeypatch.setattr(near_profiles, "close_pairs", None)  # the index must do
    got = near_profiles.near_pairs(profiles, overlap, threshold, tile, share=100.0).select("scope_id", "sample_a", "sample_b", "allele_differences", "shared_called_loci", "scheme_loci").collect()
    assert len(got) == len(set(got)) and {tuple(r) for r in got} == want and (len(want) > 50 or threshold == 0.0)


def test_few_pairs_are_compared_on_clustered_profiles(spark):
    profiles = clustered(spark, clusters=30)
    keyed = near_profiles.segment_keys(profiles, near_profiles.segment_plan(profiles, 0.05)).filter("indexed")
    keys = keyed.select("scope_id", F.posexplode("keys").alias("segment", "key")).filter("key IS NOT NULL")
    pairs = keys.groupBy("scope_id", "segment", "key").count().agg(F.sum(F.expr("count * (count - 1) / 2"))).first()[0]
    n = profiles.count() / 2
    assert pairs < 0.5 * 2 * n * (n - 1) / 2


def test_a_wide_distance_goes_through_all_tiles(spark):
    profiles = clustered(spark, clusters=3)
    columns = ["scope_id", "sample_a", "sample_b", "allele_differences"]
    assert set(near_profiles.near_pairs(profiles, 0.5, 0.9).select(*columns).collect()) == set(distances.close_pairs(profiles, 0.5, 0.9).select(*columns).collect())
    assert near_profiles.near_pairs(profiles.limit(0), 0.5, 0.1).count() == 0
