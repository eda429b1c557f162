"""Pairs of samples listed by tiles, copies included."""

import itertools

from lineagespark.operators import distances, ranking


def long_calls(spark, n=40, loci=6):
    rows = []
    for i in range(n):
        # Every fifth sample is a copy of the first.
        seed = 0 if i % 5 == 0 else i
        rows += [("s", f"p{i:02d}", f"L{k}", None if (seed * 7 + k) % 11 == 3 else str((seed * (k + 2)) % 3)) for k in range(loci)]
    return spark.createDataFrame(rows, "scope_id string, sample_id string, locus string, allele string"), rows


def test_pairs_with_copies_match_pair_loop(spark):
    calls, rows = long_calls(spark)
    alleles = {}
    for _, sample, locus, allele in rows:
        alleles.setdefault(sample, {})[locus] = allele
    want = set()
    for a, b in itertools.combinations(sorted(alleles), 2):
        both = [k for k in alleles[a] if alleles[a][k] is not None and alleles[b][k] is not None]
        if both and len(both) / 6 >= 0.8:
            want.add((a, b, sum(alleles[a][k] != alleles[b][k] for k in both), len(both)))
    out = distances.pair_distances(calls, 0.8, tile=7)
    assert {tuple(r) for r in out.select("sample_a", "sample_b", "allele_differences", "shared_called_loci").collect()} == want


def test_no_list_of_pairs_is_joined_at_a_guessed_size(spark):
    # The planner takes a tile's pairs for as large as its profiles, so a join would send them all through the driver.
    calls, _ = long_calls(spark)
    plan = distances.pair_distances(calls, 0.8)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroupsInArrow" in plan and "Join" not in plan.split("FlatMapGroupsInArrow")[0]


def test_nearest_reads_its_pairs_once(spark):
    pairs = spark.createDataFrame([("a", "b", 1.0), ("a", "c", 2.0), ("b", "c", 2.0)], "sample_a string, sample_b string, d double")
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    out = ranking.nearest_within_tolerance(pairs.mapInArrow(count, pairs.schema), "d", 1).select("sample_id", "other")
    assert {tuple(r) for r in out.collect()} == {("a", "b"), ("b", "a"), ("c", "a"), ("c", "b")} and seen.value == 3


def test_a_row_is_sent_once_per_block_not_once_per_tile(spark, monkeypatch):
    calls, _ = long_calls(spark)
    profiles = distances.encode_profiles(calls)
    sent = []
    spread = distances._spread_tiles
    monkeypatch.setattr(distances, "_spread_tiles", lambda df: sent.append(df.count()) or spread(df))
    cut = {tuple(r) for r in distances.close_pairs(profiles, 0.8, 1.0, tile=3).collect()}
    monkeypatch.setattr(distances, "BLOCK", 7)
    assert {tuple(r) for r in distances.close_pairs(profiles, 0.8, 1.0, tile=3).collect()} == cut and cut
    assert {tuple(r) for r in distances.close_pairs(profiles, 0.8, 1.0).collect()} == cut
    assert sent[0] == profiles.count() < sent[1]


def test_audit_and_maps_of_tiles_agree_with_those_of_listed_pairs(spark):
    import numpy as np
    from pyspark.sql import functions as F

    calls, _ = long_calls(spark)
    profiles = distances.encode_profiles(calls).localCheckpoint()
    pairs = distances.close_pairs(profiles, 0.8, 1.0).localCheckpoint()
    number = lambda ids: np.array([int(x[1:]) for x in ids.to_pylist()], dtype=int)
    k = F.col("sample_a").substr(2, 9).cast("int")

    def change(e):
        i = number(e["sample_a"])
        return e | {"distance": np.where(i % 4 == 0, e["distance"] + 2, e["distance"]), "allele_differences": np.where(i % 4 == 1, e["shared_called_loci"] + 1, e["allele_differences"])}

    listed = pairs.withColumn("distance", F.col("distance") + F.when(k % 4 == 0, 2).otherwise(0)).withColumn("allele_differences", F.when(k % 4 == 1, F.col("shared_called_loci") + 1).otherwise(F.col("allele_differences")))
    cohort = profiles.select("sample_id", F.col("scope_id").alias("cohort_id"))
    want = {tuple(r) for r in distances.audit_evidence(listed, cohort, 0.8).collect()}
    assert len({r[2] for r in want}) == 3
    assert {tuple(r) for r in distances.audit_tiles(profiles, cohort, 0.8, change, tile=7).collect()} == want

    side = lambda a, b, more: pairs.select(F.col(a).alias("sample_id_1"), F.col(b).alias("sample_id_2"), (F.col("distance") + more).alias("distance"), F.when(k % 3 > 0, F.col("allele_differences")).alias("allele_differences"))
    good, bad = distances.distance_maps(side("sample_a", "sample_b", 0).unionByName(side("sample_b", "sample_a", F.when(k % 5 == 0, 1).otherwise(0))))

    def directions(e):
        i = number(e["sample_a"])
        raw = np.where(i % 3 > 0, e["allele_differences"], np.nan)
        return (e["distance"], raw), (np.where(i % 5 == 0, e["distance"] + 1, e["distance"]), raw)

    out = distances.distance_maps_of_tiles(profiles, 0.8, directions, tile=7)
    assert {tuple(r) for r in out.filter("reason IS NULL").select(*good.columns).collect()} == {tuple(r) for r in good.collect()}
    assert {tuple(r) for r in out.filter("reason IS NOT NULL").select(*bad.columns).collect()} == {tuple(r) for r in bad.collect()} != set()


def test_audits_and_maps_write_no_list_of_pairs(spark, monkeypatch):
    from lineagespark.plans import distances as plans, registry

    written = []
    keep = plans.durable
    monkeypatch.setattr(plans, "durable", lambda df, name="step": written.append(keep(df, name)) or written[-1])
    for key in ("D12", "D15"):
        out = registry.QUERIES[key](spark, "/root/testdata/sf0.001")
        assert "Exchange hashpartitioning(sample_a" not in out._jdf.queryExecution().toString()
    assert written and all("sample_a" not in df.columns for df in written)


def test_asymmetric_pairs_are_found_by_hash_and_told_by_name(spark):
    rows = [("a", "b", 1, 4), ("b", "a", 1, 4), ("a", "c", 1, 4), ("c", "a", 2, 4), ("b", "c", 1, 4), ("c", "b", 1, 5)]
    pairs = spark.createDataFrame([(a, b, d, s, 8, s / 8, d / s) for a, b, d, s in rows], "sample_a string, sample_b string, allele_differences int, shared_called_loci int, scheme_loci int, call_overlap double, distance double")
    out = distances.audit_evidence(pairs, spark.createDataFrame([], "sample_id string, cohort_id string"), 0.1)
    assert {tuple(r) for r in out.collect()} == {("a", "c", "asymmetric"), ("b", "c", "asymmetric")}


def test_fingerprint_of_pairs_tells_nulls_changes_and_repeats_but_not_order(spark):
    from lineagespark.sources import sinks

    of = lambda *rows: tuple(sinks.pairs_fingerprint(spark.createDataFrame(rows, "a string, b string, n int, m int")).first())
    one, two = ("x", "y", 1, None), ("x", "z", 2, 3)
    assert of(one, two) == of(two, one)
    assert len({of(one, two), of(("x", "y", None, 1), two), of(("x", "y", 2, None), two), of(one, one, two), of(one, two, two), of(one)}) == 6


def test_stored_pairs_are_not_spelt_as_json(spark, tmp_path):
    from lineagespark.sources import sinks

    calls, _ = long_calls(spark)
    sinks.write_distances(distances.pair_distances(calls, 0.8), str(tmp_path / "p"), calls.select("sample_id").distinct(), "cgmlst", "d")
    pairs, problems = sinks.load_distances(spark, str(tmp_path / "p"), 0.8)
    assert "to_json" not in problems._jdf.queryExecution().toString() and problems.isEmpty() and not pairs.isEmpty()
