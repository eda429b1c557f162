"""Accessions found in text and record fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineagespark import constants as C
from lineagespark.functions.text import _col, clean


def find_accessions(*columns) -> Column:
    """Sorted distinct accessions anywhere in the text columns."""
    text = F.upper(F.concat_ws(" ", *[_col(c) for c in columns]))
    return F.array_sort(F.array_distinct(F.regexp_extract_all(text, F.lit(C.ACCESSION), 1)))


def accession_kind(accession) -> Column:
    a = _col(accession)
    return (
        F.when(a.startswith("SAM"), "biosample")
        .when(a.rlike("^[SED]RR"), "run")
        .when(a.startswith("GCA_") | a.startswith("GCF_"), "assembly")
        .when(a.rlike("^(PRJ|[SED]RP)"), "study")
        .otherwise("other")
    )


def alias_rows(df: DataFrame, id_column: str, columns: list[str]) -> DataFrame:
    """``(id, kind, value)`` rows of every accession of a record; studies never identify one."""
    found = df.select(F.col(id_column), F.explode(find_accessions(*columns)).alias("value"))
    return found.withColumn("kind", accession_kind("value"))


def strong_accessions(*columns) -> Column:
    """Sample, run and assembly accessions that are whole tokens of the fields."""
    tokens = F.split(F.upper(F.concat_ws(" ", *[_col(c) for c in columns])), r"[;,\s]+")
    return F.array_sort(F.array_distinct(F.filter(tokens, lambda t: t.rlike(C.STRONG_ACCESSION))))


def identity_alias(column) -> Column:
    """Upper-case accession with its version suffix removed."""
    return F.regexp_replace(F.upper(clean(column)), r"\.[0-9]+$", "")


def sample_label(sample_id, source_id, origin, values) -> Column:
    """Run, then sample, then assembly accession of a public record; inputs keep their id."""
    ident = F.coalesce(F.when(clean(sample_id) != "", clean(sample_id)), clean(source_id))
    pick = lambda pattern: F.array_min(F.filter(_col(values), lambda v: v.rlike(pattern)))
    best = F.coalesce(pick(C.RUN_ACCESSION), pick(C.SAMPLE_ACCESSION), pick(C.ASSEMBLY_ACCESSION), ident)
    own = _col(origin).isin(C.FOCAL_ORIGINS) & ~ident.startswith("PW_")
    return F.when(own, ident).otherwise(best)


def unique_labels(df: DataFrame, id_column: str, label: str) -> DataFrame:
    """Labels that more than one record carries get the record id in brackets."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    shown = F.when(F.col("_n") > 1, F.format_string("%s (%s)", F.col(label), F.col(id_column))).otherwise(F.col(label))
    return df.join(counts, label).withColumn(label, shown).drop("_n")
