"""Close pairs of profiles through an index on locus segments.

A pair within distance t of L loci has at most k = floor(t * L) differences. Cut the loci into
S = k + 1 + 2 * w segments: at most k of them hold a difference, and of two profiles with at most w
incomplete segments each at most 2 * w hold a missing call, so one segment at least is complete and
equal in both. Such profiles meet in the group of that segment; groups are compared by the tile
kernel, which splits large ones. Profiles with more missing calls are the wildcards: they are compared
with all others, tile by tile. So no close pair is lost, and each is reported by the first segment that
both share.

``w`` per scope is what ``COMPLETE`` of the profiles keep to. Where segments would tell too little apart (a wide
distance, few loci) the number of pairs in the groups, known before any is compared, reaches that of all
pairs; then all tiles are compared. Both ways give the same rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineagespark.operators.distances import TILE, _comparable, _ordered_ids, _payload, _upper, close_pairs, matrix_of, tile_cross, tile_pairs, with_fractions
from lineagespark.session import durable, forget

COMPLETE = 0.95
_ROWS = "sample_a string, sample_b string, allele_differences int, shared_called_loci int, scheme_loci int"


def segment_plan(profiles: DataFrame, max_distance: float) -> DataFrame:
    """``(scope_id, loci, segments, missing)``: the segments of every scope, and how many of a profile's may be incomplete."""
    rows = profiles.select("scope_id", F.size("codes").alias("loci"), F.size(F.filter("codes", lambda c: c <= 0)).alias("gaps"))
    plan = rows.groupBy("scope_id").agg(F.max("loci").alias("loci"), F.percentile_approx("gaps", COMPLETE).alias("missing"))
    k = F.floor(F.lit(max_distance) * F.col("loci") + 1e-9)
    return plan.withColumn("segments", (k + 1 + 2 * F.col("missing")).cast("int"))


def segment_keys(profiles: DataFrame, plan: DataFrame) -> DataFrame:
    """The profiles with ``segments``, ``keys`` (a hash per segment, null where a call is missing) and whether they are ``indexed``."""
    joined = profiles.join(plan, "scope_id")
    low = lambda s: F.floor(s * F.col("loci") / F.col("segments")).cast("int")
    piece = lambda s: F.slice("codes", low(s) + 1, low(s + 1) - low(s))
    key = lambda s: F.when(F.forall(piece(s), lambda c: c > 0), F.xxhash64(piece(s)))
    keyed = joined.withColumn("keys", F.transform(F.sequence(F.lit(0), F.col("segments") - 1), key))
    fits = F.size(F.filter("keys", lambda k: k.isNull())) <= F.col("missing")
    return keyed.withColumn("indexed", fits & (F.col("segments") <= F.col("loci"))).drop("loci", "missing")


def _rows(left, right, near, differences, shared):
    i, j = np.nonzero(near)
    a, b = _ordered_ids(left, right, i, j)
    return {
        "sample_a": a, "sample_b": b, "allele_differences": pa.array(differences[i, j], pa.int32()),
        "shared_called_loci": pa.array(shared[i, j], pa.int32()), "scheme_loci": pa.array(np.full(len(i), matrix_of(left, "codes").shape[1], np.int32)),
    }


def _near(left, right, min_overlap: float, max_distance: float):
    differences, shared, good, _ = _comparable(left, right, min_overlap)
    return good & (differences / np.maximum(shared, 1) <= max_distance), differences, shared


def near_pairs(profiles: DataFrame, min_overlap: float, max_distance: float, tile: int = TILE, share: float = 0.5) -> DataFrame:
    """What ``close_pairs`` gives; by the index where that compares at most ``share`` of all pairs."""
    keyed = durable(segment_keys(profiles, segment_plan(profiles, max_distance)), "keyed")
    found = keyed.filter("indexed").select("scope_id", "sample_id", F.posexplode("keys").alias("segment", "key")).filter("key IS NOT NULL")
    groups = durable(found.groupBy("scope_id", "segment", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "groups")
    pairs = lambda n: F.coalesce(F.sum(n * (n - 1) / 2), F.lit(0.0))
    inside = groups.agg(pairs(F.col("n")).alias("p")).first()["p"]
    sizes = keyed.groupBy("scope_id").agg(F.count(F.lit(1)).cast("double").alias("n"), F.count_if(~F.col("indexed")).cast("double").alias("w"))
    every = sizes.agg(pairs(F.col("n")).alias("p"), F.coalesce(F.sum(F.col("w") * F.col("n")), F.lit(0.0)).alias("w")).first()
    if inside + every["w"] > share * every["p"]:
        forget(keyed, groups)
        return close_pairs(profiles, min_overlap, max_distance, tile)
    payload = _payload(profiles)
    plain = ["scope_id", "sample_id", *payload]

    def segment_kernel(left, right, same):
        near, differences, shared = _near(left, right, min_overlap, max_distance)
        near = _upper(near, left, right, same)
        i, j = np.nonzero(near)
        if len(i):
            a, b = matrix_of(left, "codes")[i], matrix_of(right, "codes")[j]
            segments, own = left["segments"][0].as_py(), left["segment"][0].as_py()
            start = np.arange(segments) * a.shape[1] // segments
            agree = np.add.reduceat(((a != b) | (a <= 0) | (b <= 0)).astype(np.int32), start, axis=1) == 0
            first = np.argmax(agree, axis=1) == own
            near = np.zeros_like(near)
            near[i[first], j[first]] = True
        return _rows(left, right, near, differences, shared)

    def wild_kernel(left, right, same):
        near, differences, shared = _near(left, right, min_overlap, max_distance)
        return _rows(left, right, _upper(near, left, right, same), differences, shared)

    # Each group is a scope of its own to the tile kernel; the true scope is what follows the second mark.
    shared_keys = found.join(groups.drop("n"), ["scope_id", "segment", "key"])
    members = shared_keys.join(keyed.select(*plain, "segments"), ["scope_id", "sample_id"])
    as_scope = F.concat_ws("#", F.col("segment").cast("string"), F.col("key").cast("string"), "scope_id")
    by_segment = tile_pairs(members.withColumn("scope_id", as_scope), "sample_id", [*payload, "segment", "segments"], segment_kernel, _ROWS, tile)
    by_segment = by_segment.withColumn("scope_id", F.expr("substring(scope_id, length(substring_index(scope_id, '#', 2)) + 2)"))
    out = by_segment
    if every["w"]:
        wild, tame = keyed.filter("NOT indexed").select(*plain), keyed.filter("indexed").select(*plain)
        out = out.unionByName(tile_pairs(wild, "sample_id", payload, wild_kernel, _ROWS, tile)).unionByName(tile_cross(wild, tame, "sample_id", payload, wild_kernel, _ROWS, tile))
    return with_fractions(out)
