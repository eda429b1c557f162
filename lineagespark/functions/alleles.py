"""Categorical allele calls. Alleles are labels; a missing call is never a match."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lineagespark import constants as C
from lineagespark.functions.text import _col, clean


def comparable_allele(column) -> Column:
    """Positive integer without leading zeros, or a lower-case SHA-1; anything else is null."""
    text = clean(column)
    digits = F.regexp_replace(text, "^0+", "")
    return F.when(text.rlike(C.SHA1), F.lower(text)).when(text.rlike("^[0-9]+$") & (digits != ""), digits)


def stored_allele(column) -> Column:
    """Exact allele text with only the missing markers turned to null."""
    text = _col(column).cast("string")
    return F.when(F.lower(text).isin(C.MISSING_STORED_ALLELE), None).otherwise(text)


def stored_allele_is_valid(column) -> Column:
    text = _col(column).cast("string")
    return stored_allele(column).isNull() | ((text == F.trim(text)) & (text != ""))


def export_allele(column) -> Column:
    """Struct(allele, valid) of one cell of a long allele export."""
    text = clean(column)
    missing = text.isin(C.MISSING_EXPORT_ALLELE)
    value = comparable_allele(text)
    return F.struct(F.when(~missing, value).alias("allele"), (missing | value.isNotNull()).alias("valid"))


def combined_profile(known, novel, status) -> Column:
    """Known and novel calls as one map, null when the status or an overlap forbids it."""
    known = F.coalesce(_col(known), F.create_map().cast("map<string,string>"))
    novel = F.coalesce(_col(novel), F.create_map().cast("map<string,string>"))
    usable = (
        ~F.coalesce(_col(status).isin(C.UNUSABLE_PROFILE_STATUS), F.lit(False))
        & ~F.arrays_overlap(F.map_keys(known), F.map_keys(novel))
        & (F.size(known) + F.size(novel) > 0)
    )
    # Overlapping keys would make map_concat raise, so they are dropped before the guard applies.
    disjoint = F.map_filter(novel, lambda k, v: ~F.map_contains_key(known, k))
    return F.when(usable, F.map_concat(known, disjoint))


def declared_loci(declared, profile) -> Column:
    """Sorted locus set: the declared one when unique and covering, else null."""
    declared, profile = _col(declared), _col(profile)
    keys = F.map_keys(profile)
    good = (
        (F.size(declared) > 0)
        & (F.size(F.array_distinct(declared)) == F.size(declared))
        & (F.size(F.array_except(keys, declared)) == 0)
    )
    return F.when(declared.isNull(), F.array_sort(keys)).when(good, F.array_sort(declared))


def split_packed_code(code, loci, multi_hit_loci) -> Column:
    """Cells (locus, kind, allele) of a packed ``1_2__…`` code against its ordered loci.

    ``kind`` is known, novel, missing, ambiguous or invalid; null when the lengths differ.
    """
    tokens, loci = F.split(_col(code), "_", -1), _col(loci)
    cell = lambda locus, token: F.struct(
        locus.alias("locus"),
        F.when(F.array_contains(multi_hit_loci, locus), "ambiguous")
        .when(token == "", "missing")
        .when(token.rlike("^[0-9]+$") & ~token.rlike("^0+$"), "known")
        .when(token.rlike(C.SHA1), "novel")
        .otherwise("invalid")
        .alias("kind"),
        comparable_allele(token).alias("allele"),
    )
    return F.when(F.size(tokens) == F.size(loci), F.zip_with(loci, tokens, cell))
