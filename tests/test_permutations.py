"""Permuted dates against two sorted lists."""

import hashlib

from lineagespark.operators import statistics


def test_permuted_dates_meet_without_a_broadcast_of_copies(spark):
    rows = [(f"p{i:02d}", 2000.0 + i % 7, float(i)) for i in range(30)]
    points = spark.createDataFrame(rows, "sample_id string, date double, distance double")
    out = statistics.permute_dates(points, 4, 7)
    place = lambda side, r, ident: hashlib.sha256(f"7{side}:{r}:{ident}".encode()).hexdigest()
    want = set()
    for r in range(1, 5):
        left = sorted(rows, key=lambda x: place("a", r, x[0]))
        right = sorted(rows, key=lambda x: place("b", r, x[0]))
        want |= {(r, x[0], x[2], y[1]) for x, y in zip(left, right)}
    assert {(r.replicate, r.sample_id, r.distance, r.date) for r in out.collect()} == want
    plan = out._jdf.queryExecution().executedPlan().toString()
    # Sizes and offsets of the ranks are joined below the union; the copies themselves are not.
    assert "Join" not in plan.split("== Initial Plan ==")[-1].split("Union")[0]
