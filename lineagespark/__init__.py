"""DataFrame operators for genomic surveillance tables, written for Spark."""
