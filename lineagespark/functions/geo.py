"""Country names and known-place tests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineagespark import constants as C
from lineagespark.functions.text import _col, clean, is_one_of


def _alias_map() -> Column:
    pairs = [F.lit(x) for item in C.COUNTRY_ALIASES.items() for x in item]
    return F.create_map(*pairs)


def normalise_country(df: DataFrame, column: str, codes: DataFrame, out: str = "country") -> DataFrame:
    """Add ``out``: canonical country name of free text.

    ``codes(code, name)`` is the caller's country table. It is joined twice, as an equi-join on
    the upper-case code and on the lower-case name, so Spark broadcasts it only when small.
    """
    place = F.trim(F.substring_index(clean(column), ":", 1))
    decorated = F.regexp_extract(place, r"^([A-Z]{2})\s+-\s+", 1)
    keyed = df.withColumn("_place", place).withColumn("_decorated", decorated)
    keyed = keyed.withColumn("_upper", F.upper("_place")).withColumn("_lower", F.lower("_place"))
    codes = codes.select("code", "name")
    by_code = codes.select(F.col("code").alias("_upper"), F.col("name").alias("_code_name"))
    by_mark = codes.select(F.col("code").alias("_decorated"), F.col("name").alias("_mark_name"))
    by_name = codes.groupBy(F.lower("name").alias("_lower")).agg(F.max("name").alias("_canonical"))
    joined = (
        keyed.join(by_code, "_upper", "left").join(by_mark, "_decorated", "left").join(by_name, "_lower", "left")
    )
    alias = F.try_element_at(_alias_map(), F.col("_lower"))
    name = (
        F.when(is_one_of(column, C.MISSING_METADATA), F.lit("Unknown"))
        .otherwise(F.coalesce("_mark_name", "_code_name", alias, "_canonical", "_place"))
    )
    return joined.withColumn(out, name).drop(
        "_place", "_decorated", "_upper", "_lower", "_code_name", "_mark_name", "_canonical"
    )


def known_location(column) -> Column:
    """Trimmed place, or null when the text means unknown."""
    return F.when(~is_one_of(column, C.MISSING_LOCATION), clean(column))


def known_state(column) -> Column:
    return ~is_one_of(column, C.MISSING_STATE)


def is_input(role, origin) -> Column:
    """Prepared roles win over source origins."""
    role, origin = clean(role), clean(origin)
    return F.when(role != "", role).otherwise(origin).isin(C.INPUT_ROLES)


def place_of(nuts2, region, country) -> Column:
    from lineagespark.functions.text import blank_to_null

    return F.coalesce(blank_to_null(nuts2), blank_to_null(region), blank_to_null(country))


def first_known(candidates: list[tuple[str, Column]]) -> Column:
    """Struct(field, value) of the first candidate place that is known."""
    tests = [F.when(~is_one_of(v, C.MISSING_METADATA), F.struct(F.lit(n).alias("field"), _col(v).alias("value"))) for n, v in candidates]
    return F.coalesce(*tests)
