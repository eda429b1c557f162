"""The range join on nested bins against all pairs of a small set of very unequal lengths."""

import random

from lineagespark.operators import joins


def test_segments_of_unequal_intervals(spark):
    rng = random.Random(4)
    def some(n, name):
        out = []
        for i in range(n):
            start, length = rng.randrange(1, 5000), rng.choice([1, 2, 3, 40, 64, 65, 1000, 4096, 1 << 33])
            out.append((f"{name}{i}", start, start + length - 1))
        return out
    intervals = some(60, "i") + [("i0", 7, 7), ("again", 7, 7), ("empty", 9, 8)]
    records = some(40, "r") + [("none", 20, 10)]
    frame = lambda rows, key: spark.createDataFrame(rows, f"{key} string, start bigint, end bigint")
    out = joins.interval_segments(frame(intervals, "node"), frame(records, "name")).collect()
    spans = {(s, e) for _, s, e in intervals if s <= e}
    want = sorted((s, e, r, max(s, a) - a + 1, min(e, b) - a + 1) for s, e in spans for r, a, b in records if a <= b and s <= b and e >= a)
    assert sorted((r.start, r.end, r.name, r.local_start, r.local_end) for r in out) == want
    assert {r.copies for r in out if (r.start, r.end) == (7, 7)} <= {2}
