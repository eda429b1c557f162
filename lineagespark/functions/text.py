"""Text helpers, identifiers, labels and fingerprints."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineagespark import constants as C


def clean(column) -> Column:
    """Trimmed text, with null as the empty string."""
    return F.trim(F.coalesce(_col(column).cast("string"), F.lit("")))


def _col(column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def blank_to_null(column) -> Column:
    text = clean(column)
    return F.when(text != "", text)


def first_filled(*columns) -> Column:
    """The first non-empty value, or the empty string."""
    return F.coalesce(*[blank_to_null(c) for c in columns], F.lit(""))


def is_one_of(column, words) -> Column:
    return F.lower(clean(column)).isin(list(words))


def safe_identifier(column) -> Column:
    return clean(column).rlike(C.SAFE_IDENTIFIER)


def parse_boolean(column) -> Column:
    """True, false, or null where the word is neither."""
    return F.when(is_one_of(column, C.TRUE_WORDS), True).when(is_one_of(column, C.FALSE_WORDS), False)


def tolerant_field(df: DataFrame, *names: str) -> Column:
    """First filled column whose name matches once case and punctuation are ignored."""
    plain = lambda name: re.sub(r"[^a-z0-9]", "", name.lower())
    by_name = {plain(c): c for c in df.columns}
    present = [F.col(f"`{by_name[plain(n)]}`") for n in names if plain(n) in by_name]
    return first_filled(*present) if present else F.lit("")


def species_name(column) -> Column:
    """Lower-case species with underscores and runs of blanks made single blanks."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(clean(column)), "_", " "), r"\s+", " "))


def display_species(column) -> Column:
    name = species_name(column)
    return F.concat(F.upper(F.substring(name, 1, 1)), F.substring(name, 2, 1 << 20))


def sequence_type(mlst_st, lineage) -> Column:
    """Digits of the sequence type, from its own field or else from an ``ST…`` lineage."""
    from_lineage = F.regexp_extract(clean(lineage), r"^(?i:ST)([0-9]+)$", 1)
    value = F.regexp_replace(first_filled(mlst_st, from_lineage), r"^(?i:ST)", "")
    return F.when(value.rlike(r"^[0-9]+$"), value).otherwise("")


def lineage_slug(species, lineage) -> Column:
    joined = F.concat_ws("__", clean(species), clean(lineage))
    return F.regexp_replace(F.regexp_replace(joined, r"[^A-Za-z0-9_.-]+", "_"), r"^_+|_+$", "")


def collection_identifier(column) -> Column:
    """Short collection id from bare text or the path of an HTTPS collection URL; else null."""
    text = clean(column)
    is_url = text.contains("://")
    path_id = F.regexp_extract(F.try_parse_url(text, F.lit("PATH")), r"^/collections/([^/]+)/?$", 1)
    allowed = ~is_url | (F.try_parse_url(text, F.lit("PROTOCOL")) == "https")
    ident = F.split(F.when(is_url, path_id).otherwise(text), "-")[0]
    return F.when(allowed & ident.rlike(C.SHORT_UUID), ident)


def row_fingerprint(df: DataFrame, ignore=("retrieved_at", "elapsed_seconds", "seconds", "requests", "attempts")) -> Column:
    """SHA-256 over the row as JSON, columns in name order, volatile columns left out."""
    kept = sorted(c for c in df.columns if c not in ignore and not c.endswith("_retrieved_at"))
    return F.sha2(F.to_json(F.struct(*kept), {"ignoreNullFields": "false"}), 256)


def table_fingerprint(df: DataFrame) -> DataFrame:
    """Order-independent (rows, fingerprint) of a whole table in one partial aggregate."""
    hashed = df.select(F.xxhash64(row_fingerprint(df)).alias("h"))
    return hashed.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(F.col("h").cast("decimal(38,0)")), F.lit(0)).cast("string").alias("fingerprint"),
    )


# Field names that would carry credentials.
SECRET_FIELDS = ["api_key", "apikey", "token", "access_token", "password", "authorization", "credentials", "secret", "client_secret"]


def secret_columns(df: DataFrame) -> list[str]:
    """Names of fields, at any depth, that look like credentials."""
    found: list[str] = []

    def walk(schema, prefix):
        for field in getattr(schema, "fields", []):
            name = f"{prefix}{field.name}"
            if field.name.lower().replace("-", "_") in SECRET_FIELDS:
                found.append(name)
            inner = field.dataType
            while hasattr(inner, "elementType"):
                inner = inner.elementType
            walk(inner, name + ".")

    walk(df.schema, "")
    return found


def not_finite(column) -> Column:
    value = _col(column)
    return F.isnan(value) | (F.abs(value) == float("inf"))
