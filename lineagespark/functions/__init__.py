"""Column expressions: dates, places, lineage codes, alleles, accessions, sequences."""
