"""First-fit cohorts where nearly every pair is incomparable."""

import itertools

from lineagespark.operators import clusters


def test_rounds_grow_with_samples_not_with_chains(spark, monkeypatch):
    # Any two of these lack four loci of twelve together, so each needs the number of none before it.
    gaps = list(itertools.combinations(range(12), 3))[:60]
    rows = [("s", f"p{i:02d}", [0 if k in gap else 1 for k in range(12)]) for i, gap in enumerate(gaps)]
    rows += [("s", f"q{i:02d}", list(codes)) for i, (_, _, codes) in enumerate(rows[:10])]
    df = spark.createDataFrame(rows, "scope_id string, sample_id string, codes array<int>")
    written, durable = [], clusters.durable
    monkeypatch.setattr(clusters, "durable", lambda frame, *name: written.append(1) or durable(frame, *name))
    got = {r.sample_id: r.cohort_id for r in clusters.comparable_cohorts(df, 0.7, 30).collect()}
    assert got == {f"p{i:02d}": f"cohort_{i + 1}" for i in range(60)} | {f"q{i:02d}": f"cohort_{i + 1}" for i in range(10)}
    assert len(written) < 12
