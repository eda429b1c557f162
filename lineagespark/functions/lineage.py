"""Hierarchical lineage codes: prefixes, scoped keys and cluster maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineagespark import constants as C
from lineagespark.functions.scopes import typing_scope
from lineagespark.functions.text import _col, clean, first_filled, is_one_of, tolerant_field


def parse_code(raw) -> Column:
    """Struct(prefix array<bigint>, status) of a code such as ``1_2_3_*``.

    Unknown components may only follow the resolved prefix.
    """
    text = F.regexp_replace(clean(raw), r"\s*[_,]\s*", "_")
    known = F.regexp_extract(text, r"^([0-9]+(?:_[0-9]+)*)(?:_|$)", 1)
    unknown = r"(?:-|\?|\*[A-Za-z0-9]*)?"
    form = rf"^(?:[0-9]+(?:_[0-9]+)*(?:_{unknown})*|{unknown}(?:_{unknown})*)$"
    separators = F.length(text) - F.length(F.replace(text, F.lit("_"), F.lit("")))
    missing = F.lower(text).isin(C.MISSING_LIN_CODE)
    good = ~missing & text.rlike(form) & (separators < C.LIN_COMPONENTS)
    prefix = F.when(good & (known != ""), F.split(known, "_").try_cast("array<bigint>"))
    whole = text.rlike(rf"^[0-9]+(?:_[0-9]+){{{C.LIN_COMPONENTS - 1}}}$")
    return F.struct(
        F.coalesce(prefix, F.array().cast("array<bigint>")).alias("prefix"),
        F.when(missing, "missing").when(~good, "malformed").when(whole, "complete").otherwise("partial").alias("status"),
    )


def group_key(scheme, version, prefix, depth) -> Column:
    """Scoped full-prefix key at ``depth``; empty when the prefix is shorter."""
    prefix, depth = _col(prefix), depth if isinstance(depth, Column) else F.lit(depth)
    head = F.to_json(F.array(_col(scheme), _col(version)))
    codes = F.concat_ws(",", F.slice(prefix, 1, depth).cast("array<string>"))
    key = F.concat(F.substring_index(head, "]", 1), F.lit(",["), codes, F.lit("]]"))
    return F.when(F.size(prefix) >= depth, key).otherwise("")


def normalise_assignment(
    df: DataFrame, scheme: str = C.LIN_SCHEME, version: str = "unknown", depths=C.LIN_DEPTHS
) -> DataFrame:
    """Add the normalised lineage columns to rows with tolerant field names."""
    raw = tolerant_field(df, "cglin_raw", "LIN code", "LINcode", "cgLIN", "code")
    cgst = tolerant_field(df, "cgst", "cgST", "scgST")
    flag = tolerant_field(df, "cglin_provisional", "provisional")
    own_scheme = first_filled(tolerant_field(df, "cglin_scheme", "scheme"), F.lit(scheme))
    own_version = first_filled(
        tolerant_field(df, "cglin_scheme_version", "scheme_version", "version"), F.lit(version)
    )
    out = df.select(
        "*",
        tolerant_field(df, "source_genome_id", "genome_id", "genome id", "id").alias("_id"),
        raw.alias("_raw"),
        cgst.alias("_cgst"),
        (
            is_one_of(flag, ["true", "1", "yes"]) | cgst.startswith("*") | cgst.rlike(C.SHA1) | raw.contains("*")
        ).alias("_provisional"),
        own_scheme.alias("_scheme"),
        own_version.alias("_version"),
        parse_code(raw).alias("_parsed"),
    )
    supported = F.col("_scheme") == scheme
    nothing = F.array().cast("array<bigint>")
    out = out.withColumn("_prefix", F.when(supported, F.col("_parsed.prefix")).otherwise(nothing)).withColumn(
        "_status", F.when(supported, F.col("_parsed.status")).otherwise("unsupported")
    )
    state = F.when(F.col("_provisional") & F.col("_status").isin("complete", "partial"), "provisional").otherwise(
        F.col("_status")
    )
    columns = [c for c in df.columns if c not in _ASSIGNMENT_COLUMNS]
    keyed = out.select(
        *columns,
        F.col("_id").alias("source_genome_id"),
        F.col("_raw").alias("cglin_raw"),
        F.col("_cgst").alias("cgst"),
        state.alias("cglin_status"),
        F.col("_status").alias("cglin_code_status"),
        F.size("_prefix").alias("cglin_resolved_depth"),
        F.col("_provisional").alias("cglin_provisional"),
        F.col("_scheme").alias("cglin_scheme"),
        F.col("_version").alias("cglin_scheme_version"),
        F.col("_prefix").alias("cglin_prefix"),
        *[group_key("_scheme", "_version", "_prefix", d).alias(f"cglin_group_{d}") for d in depths],
    )
    for d in depths:
        resolved = F.when(F.col("cglin_provisional"), "provisional").otherwise("resolved")
        keyed = keyed.withColumn(
            f"cglin_status_{d}",
            F.when(F.col(f"cglin_group_{d}") != "", resolved).otherwise(F.col("cglin_code_status")),
        )
    return keyed


_ASSIGNMENT_COLUMNS = {
    "source_genome_id", "cglin_raw", "cgst", "cglin_status", "cglin_code_status", "cglin_resolved_depth",
    "cglin_provisional", "cglin_scheme", "cglin_scheme_version", "cglin_prefix",
}


def usable_lineage(scope: Column, status, raw, level: int, scheme: str = C.LIN_SCHEME) -> Column:
    """Struct(scheme, version, prefix) when the code is resolved to ``level``, else null."""
    parsed = parse_code(raw)
    usable = (
        scope.isNotNull()
        & ~is_one_of(status, C.UNUSABLE_TYPING_STATUS)
        & (scope["scheme"] == scheme)
        & parsed["status"].isin("complete", "partial")
        & (F.size(parsed["prefix"]) >= level)
    )
    return F.when(
        usable,
        F.struct(
            scope["scheme"].alias("scheme"),
            scope["version"].alias("version"),
            F.slice(parsed["prefix"], 1, level).alias("prefix"),
        ),
    )


def usable_cluster(scope: Column, status, codes, level: str) -> Column:
    """Scoped cluster label of one level of a level-to-cluster map, else null."""
    code = clean(F.try_element_at(_col(codes), F.lit(level)))
    usable = scope.isNotNull() & ~is_one_of(status, C.UNUSABLE_TYPING_STATUS) & code.rlike("^[0-9]+$")
    return F.when(usable, F.struct(scope["scheme"].alias("scheme"), scope["version"].alias("version"), code.alias("code")))


def normalise_clusters(codes) -> Column:
    """Struct(codes map, reason): levels ``HCn``/``dn`` become ``HCn``, clusters plain integers.

    A level or cluster of another form, or two levels that become one, give a reason.
    """
    entries = F.map_entries(_col(codes))
    level = lambda e: F.regexp_extract(e["key"], r"^(?:HC|d)([0-9]+)$", 1)
    bare = lambda text: F.regexp_replace(text, r"^0+(?=[0-9])", "")
    bad_form = F.exists(entries, lambda e: (level(e) == "") | ~F.trim(e["value"]).rlike("^[0-9]+$"))
    names = F.transform(entries, lambda e: F.concat(F.lit("HC"), bare(level(e))))
    repeated = F.size(F.array_distinct(names)) != F.size(names)
    reason = F.when(bad_form, "invalid_level_or_cluster").when(repeated, "duplicate_level")
    values = F.transform(entries, lambda e: bare(F.trim(e["value"])))
    good = F.map_from_arrays(
        F.when(reason.isNull(), names).otherwise(F.array().cast("array<string>")),
        F.when(reason.isNull(), values).otherwise(F.array().cast("array<string>")),
    )
    return F.struct(good.alias("codes"), reason.alias("reason"))


def common_prefix(df: DataFrame, keys: list[str], prefix: str, ordinal: str = None) -> DataFrame:
    """Longest prefix shared by every code of a group, as ``common_prefix``.

    One aggregation of (min, max) per position, so a hot group combines map-side.
    """
    positions = df.select(*keys, F.posexplode_outer(prefix).alias("pos", "part"), F.size(prefix).alias("_n"))
    per = positions.groupBy(*keys, "pos").agg(
        F.min("part").alias("lo"), F.max("part").alias("hi"), F.count("part").alias("n"), F.min("_n").alias("_n")
    )
    total = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("codes"))
    joined = per.join(total, keys)
    agreed = (F.col("lo") == F.col("hi")) & (F.col("n") == F.col("codes"))
    first_bad = F.min(F.when(~F.coalesce(agreed, F.lit(False)), F.coalesce(F.col("pos"), F.lit(0))))
    parts = F.array_sort(F.collect_list(F.when(F.col("pos").isNotNull(), F.struct("pos", "lo"))))
    grouped = joined.groupBy(*keys).agg(first_bad.alias("_bad"), parts.alias("_parts"), F.max("codes").alias("codes"))
    kept = F.filter("_parts", lambda p: F.col("_bad").isNull() | (p["pos"] < F.col("_bad")))
    return grouped.select(*keys, "codes", F.transform(kept, lambda p: p["lo"]).alias("common_prefix"))
