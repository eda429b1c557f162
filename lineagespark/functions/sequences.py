"""Nucleotide and protein text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lineagespark import constants as C
from lineagespark.functions.text import _col


def codon_table() -> Column:
    """Codon to amino acid map, in TCAG order."""
    codons = [a + b + c for a in C.CODON_BASES for b in C.CODON_BASES for c in C.CODON_BASES]
    return F.create_map(*[F.lit(x) for pair in zip(codons, C.CODON_AMINO_ACIDS) for x in pair])


def translate(dna, terminal_stop: str = "optional", max_length: int = 1022) -> Column:
    """Struct(protein, reason, stop_removed) of a coding sequence under table 11.

    Start codons become methionine; ``terminal_stop='require'`` demands a final stop.
    """
    dna = F.upper(_col(dna))
    size = F.length(dna)
    codons = F.when(size >= 3, F.regexp_extract_all(dna, F.lit("(...)"), 1)).otherwise(F.array().cast("array<string>"))
    stops = ["TAA", "TAG", "TGA"]
    has_stop = F.substring(dna, -3, 3).isin(stops)
    coding = F.when(has_stop, F.slice(codons, 1, F.greatest(F.size(codons) - 1, F.lit(0)))).otherwise(codons)
    rest = F.when(F.size(coding) > 1, F.slice(coding, 2, F.size(coding))).otherwise(F.array().cast("array<string>"))
    table = codon_table()
    protein = F.concat(F.lit("M"), F.array_join(F.transform(rest, lambda c: F.try_element_at(table, c)), ""))
    reason = (
        F.when(~dna.rlike("^[ACGT]*$"), "ambiguous_or_unsupported_dna")
        .when(size % 3 != 0, "out_of_frame")
        .when(~F.substring(dna, 1, 3).isin(C.START_CODONS), "invalid_start_codon")
    )
    if terminal_stop == "require":
        reason = reason.when(~has_stop, "missing_terminal_stop")
    reason = reason.when(F.exists(coding, lambda c: c.isin(stops)), "internal_stop").when(
        F.length(protein) > max_length, "protein_exceeds_max_length"
    )
    return F.struct(F.when(reason.isNull(), protein).alias("protein"), reason.alias("reason"), has_stop.alias("stop_removed"))


def protein_reason(sequence, max_length: int = 1022) -> Column:
    """Why a protein record is left out, or null."""
    text = F.upper(_col(sequence))
    odd = F.array_sort(F.array_distinct(F.regexp_extract_all(text, F.lit("([^ACDEFGHIKLMNPQRSTVWYXBZUO])"), 1)))
    return (
        F.when(F.length(text) == 0, "empty sequence")
        .when(~text.rlike(C.PROTEIN_RESIDUES), F.concat(F.lit("unsupported residues: "), F.array_join(odd, "")))
        .when(F.length(text) > max_length, F.format_string(f"length %d exceeds max_length {max_length}", F.length(text)))
    )


def protein_id(sequence) -> Column:
    return F.sha2(F.upper(_col(sequence)), 256)
