"""Long evidence tables and canonical records from wide rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineagespark import constants as C
from lineagespark.functions.accessions import accession_kind, find_accessions
from lineagespark.functions.dates import normalised_text_dates
from lineagespark.functions.geo import normalise_country
from lineagespark.functions.scopes import typing_scope
from lineagespark.functions.text import clean, first_filled


def provenance_rows(df: DataFrame, id_column: str, fields: list[str], source: str = "frozen_record") -> DataFrame:
    """One row per sample and filled field."""
    texts = df.select(id_column, *[F.col(f).cast("string").alias(f) for f in fields])
    return (
        texts.unpivot(id_column, fields, "field", "value")
        .filter(clean("value") != "")
        .select(id_column, "field", F.lit(source).alias("source"), "value")
    )


def lineage_rows(df: DataFrame, id_column: str, kind: str, assignment: str) -> DataFrame:
    """Lineage evidence of one kind, with its scope and status."""
    scope = typing_scope(f"{kind}_scheme", f"{kind}_scheme_version", f"{kind}_database_sha256")
    return df.select(
        id_column,
        F.lit(kind).alias("kind"),
        F.when(clean(f"{kind}_scheme") != "", clean(f"{kind}_scheme")).alias("scheme_id"),
        F.coalesce(scope["version"], F.col(f"{kind}_scheme_version")).alias("scheme_version"),
        F.when(clean(assignment) != "", F.col(assignment)).alias("assignment"),
        first_filled(f"{kind}_status", F.lit("unverified")).alias("resolution_status"),
    )


def crosswalk_rows(df: DataFrame, id_column: str, accession_columns: list[str], conflict=None, resolved=None) -> DataFrame:
    """One row per sample and accession with the identity status of the sample."""
    status = (
        F.when(F.coalesce(conflict if conflict is not None else F.lit(False), F.lit(False)), "ambiguous")
        .when(F.coalesce(resolved if resolved is not None else F.lit(False), F.lit(False)), "resolved")
        .otherwise("unresolved")
    )
    found = df.select(id_column, status.alias("resolution_status"), F.explode(find_accessions(*accession_columns)).alias("value"))
    return found.withColumn("kind", accession_kind("value"))


def retrieval_rows(df: DataFrame, id_column: str, source: str, status: str) -> DataFrame:
    return df.select(
        id_column,
        F.lit("frozen_profile").alias("operation"),
        first_filled(source, F.lit("frozen_record")).alias("source"),
        first_filled(status, F.lit("unavailable")).alias("status"),
    )


def adapt_samples(df: DataFrame) -> DataFrame:
    """Prepared sample rows: role from role or origin, dates with their precision."""
    origin = clean("origin")
    role = first_filled("role", F.when(origin.isin(C.INPUT_ROLES), "input").otherwise(origin))
    dates = normalised_text_dates("collection_date")
    return df.withColumn("role", role).withColumn("_d", dates).select(
        "*", F.col("_d.start").alias("date_start"), F.col("_d.end").alias("date_end"), F.col("_d.precision").alias("date_precision")
    ).drop("_d")


def canonical_records(df: DataFrame, countries: DataFrame, origin: str, species: str = "") -> DataFrame:
    """Flatten source rows whose free fields sit in ``metadata MAP<STRING,STRING>``.

    Own columns win over metadata of the same meaning; metadata keys match without case and
    may carry a ``metadata/`` path.
    """
    names = {c.lower() for c in df.columns}
    own = lambda *cs: [F.col(c) for c in cs if c in names]
    flat = F.map_from_entries(
        F.array_distinct(
            F.transform(
                F.map_entries("metadata"),
                lambda e: F.struct(F.lower(F.element_at(F.split(e["key"], "/"), -1)).alias("key"), e["value"].alias("value")),
            )
        )
    )
    meta = lambda *keys: [F.try_element_at(F.col("_flat"), F.lit(k)) for k in keys]
    ident = first_filled(
        *own("sample_id"), F.when(clean("source_genome_id") != "", F.concat(F.lit("PW_"), clean("source_genome_id")))
    )
    st = first_filled(*own("mlst_st", "mlst"))
    base = df.withColumn("_flat", flat).select(
        "*",
        ident.alias("_sample"),
        st.alias("_st"),
        first_filled(*own("country"), *meta("country"), *own("location"), *meta("location")).alias("country_raw"),
        first_filled(*own("region"), *meta("city/region", "region")).alias("_region"),
        first_filled(*own("collection_date"), *meta("collection date", "collection_date", "date", "year")).alias("_date"),
        first_filled(*own("species"), F.lit(species)).alias("_species"),
    )
    text = [c for c in df.columns if c != "metadata"]
    accessions = find_accessions(*text, F.array_join(F.map_values("metadata"), " "))
    base = base.withColumn("_acc", accessions).withColumn("_d", normalised_text_dates("_date"))
    named = normalise_country(base, "country_raw", countries, "_country")
    lineage = first_filled(
        *own("lineage"), F.when((F.col("_st") != "") & (F.col("_st") != "-"), F.concat(F.lit("ST"), F.col("_st"))), F.lit("Unassigned")
    )
    return named.select(
        F.col("_sample").alias("sample_id"),
        F.lit(origin).alias("origin"),
        F.col("_species").alias("species"),
        lineage.alias("lineage"),
        F.col("_st").alias("mlst_st"),
        clean("source_genome_id").alias("source_genome_id"),
        F.col("_country").alias("country"),
        "country_raw",
        F.col("_region").alias("region"),
        F.col("_d.collection_date").alias("collection_date"),
        F.col("_d.start").alias("date_start"),
        F.col("_d.end").alias("date_end"),
        F.col("_d.precision").alias("date_precision"),
        F.filter("_acc", lambda a: accession_kind(a) != "study").alias("aliases"),
        clean("_sample").rlike(C.SAFE_IDENTIFIER).alias("id_is_safe"),
    )
