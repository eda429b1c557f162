"""File readers. Bad rows are returned with a reason, never dropped silently."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lineagespark import constants as C
from lineagespark.functions.alleles import export_allele, stored_allele, stored_allele_is_valid
from lineagespark.functions.dates import date_is_accepted
from lineagespark.functions.text import clean, parse_boolean, row_fingerprint, safe_identifier


def read_table(spark: SparkSession, path: str, delimiter: str = ",", comment: str | None = None) -> DataFrame:
    """Untyped header-bearing text; every column is a string."""
    reader = spark.read.option("header", True).option("sep", delimiter).option("inferSchema", False).option("nullValue", "\x00")
    if comment:
        reader = reader.option("comment", comment)
    return reader.csv(path)


def require(df: DataFrame, columns) -> DataFrame:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def split_rules(df: DataFrame, rules: list[tuple[str, Column]]) -> tuple[DataFrame, DataFrame]:
    """Rows that pass every rule, and the rest with the first rule they break."""
    reason = None
    for name, broken in rules:
        broken = F.coalesce(broken, F.lit(True))
        reason = F.when(broken, name) if reason is None else reason.when(broken, name)
    judged = df.withColumn("reason", reason)
    return judged.filter("reason IS NULL").drop("reason"), judged.filter("reason IS NOT NULL")


def _repeats(df: DataFrame, keys: list[str]) -> DataFrame:
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies"))
    return df.join(counts, keys)


METADATA_COLUMNS = ["sample_id", "assembly", "collection_date", "location", "species", "lineage", "origin"]


def read_metadata(spark: SparkSession, path: str, undated: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Sample sheet: required columns, trimmed, unique safe ids, filled fields, known dates.

    ``undated`` is the sheet's own word for a sample that has no date to judge; an empty date is still rejected.
    """
    raw = require(read_table(spark, path), METADATA_COLUMNS)
    trimmed = raw.select(*[clean(c).alias(c) for c in raw.columns])
    for optional in ("is_reference", "patient_id"):
        if optional not in trimmed.columns:
            trimmed = trimmed.withColumn(optional, F.lit(""))
    counted = _repeats(trimmed, ["sample_id"])
    flag = parse_boolean("is_reference")
    rules = [
        ("unsafe_sample_id", ~safe_identifier("sample_id")),
        ("duplicate_sample_id", F.col("_copies") > 1),
        ("no_assembly", F.col("assembly") == ""),
        ("unsupported_collection_date", ~date_is_accepted("collection_date") & (F.lit(True) if undated is None else F.col("collection_date") != undated)),
        *[(f"empty_{c}", F.col(c) == "") for c in ("location", "species", "lineage", "origin")],
        ("invalid_is_reference", flag.isNull()),
    ]
    valid, rejects = split_rules(counted.withColumn("_flag", flag), rules)
    return valid.withColumn("is_reference", F.col("_flag")).drop("_flag", "_copies"), rejects.drop("_flag", "_copies")


def read_allele_export(spark: SparkSession, path: str, requested: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Long allele export ``Genome ID, Gene, Allele ID``.

    Returns calls ``(sample_id, locus, allele, status)``, where a cell with two different
    values is ambiguous and has no allele, and the rejected rows.
    """
    raw = require(read_table(spark, path), ["Genome ID", "Gene", "Allele ID"]).select(
        F.col("Genome ID").alias("sample_id"), F.col("Gene").alias("locus"), export_allele("Allele ID").alias("a")
    )
    known = requested.select("sample_id", F.lit(True).alias("_known")).distinct()
    judged = raw.join(known, "sample_id", "left")
    rules = [("unrequested_genome", F.col("_known").isNull()), ("empty_locus", clean("locus") == ""), ("unsupported_allele", ~F.col("a.valid"))]
    valid, rejects = split_rules(judged, rules)
    text = F.coalesce("a.allele", F.lit(""))
    cells = valid.groupBy("sample_id", "locus").agg(F.min(text).alias("lo"), F.max(text).alias("hi"))
    status = F.when(F.col("lo") != F.col("hi"), "ambiguous").when(F.col("hi") == "", "missing").otherwise("called")
    calls = cells.select("sample_id", "locus", F.when(status == "called", F.col("hi")).alias("allele"), status.alias("status"))
    return calls, rejects.select("sample_id", "locus", "reason")


def unpivot_profiles(wide: DataFrame, ident: list[str], loci: list[str]) -> tuple[DataFrame, DataFrame]:
    """Wide allele matrix to long calls, exact text kept; the second table is invalid cells."""
    long = wide.select(*ident, *[F.col(l).cast("string").alias(l) for l in loci]).unpivot(ident, loci, "locus", "allele")
    good = stored_allele_is_valid("allele")
    return long.filter(good).withColumn("allele", stored_allele("allele")), long.filter(~good)


def pivot_profiles(calls: DataFrame, ident: list[str], loci: list[str]) -> DataFrame:
    """Long calls to one column per locus of a given catalogue; one shuffle on the sample."""
    return calls.groupBy(*ident).pivot("locus", loci).agg(F.first("allele", ignorenulls=True))


def read_typing_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Typing assignments from JSON: a list of records, or ``{"assignments": [...]}``.

    ``schema`` is the DDL of one record. Each row carries the SHA-256 of its file.
    """
    envelope = spark.read.option("multiLine", True).schema(f"assignments array<struct<{schema}>>, {schema}").json(path).withColumn("_file", F.input_file_name())
    fields = [f.name for f in spark.createDataFrame([], schema).schema.fields]
    nested = envelope.filter("assignments IS NOT NULL").select("_file", F.explode("assignments").alias("a")).select("_file", *[F.col(f"a.{f}").alias(f) for f in fields])
    listed = envelope.filter("assignments IS NULL").select("_file", *fields)
    rows = nested.unionByName(listed)
    return rows.join(file_hashes(spark, path), "_file", "left").drop("_file")


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    """``(_file, export_sha256)`` of the exact bytes of every file."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.regexp_replace("path", "^file:/+", "file:///").alias("_file"), F.sha2("content", 256).alias("export_sha256"))


def read_lineage_table(spark: SparkSession, path: str) -> DataFrame:
    """Lineage code table, comma or tab separated by its header; needs an id and a code column."""
    import re

    first = spark.read.text(path).limit(1).first()
    if first is None:
        raise ValueError("the lineage export is empty")
    df = read_table(spark, path, "\t" if "\t" in first[0] else ",")
    plain = {re.sub("[^a-z0-9]", "", c.lower()) for c in df.columns}
    if not plain & {"sourcegenomeid", "genomeid", "id"} or not plain & {"cglinraw", "lincode", "cglin", "code"}:
        raise ValueError("a lineage table needs a genome id and a code column")
    return df


def reconcile_catalogue(rows: DataFrame, details: DataFrame, expected: DataFrame, key: str) -> DataFrame:
    """Problems of a frozen catalogue: counts, ids on one side only, and row fingerprints.

    ``expected(row_count, fingerprint)`` is what its manifest says.
    """
    from lineagespark.functions.text import table_fingerprint

    found = table_fingerprint(rows)
    joined = found.crossJoin(F.broadcast(expected))
    counts = joined.filter(F.col("rows") != F.col("row_count")).select(F.lit("row_count_differs").alias("problem"), F.col("rows").cast("string").alias("detail"))
    prints = joined.filter(found["fingerprint"] != expected["fingerprint"]).select(F.lit("fingerprint_differs").alias("problem"), found["fingerprint"].alias("detail"))
    only = lambda a, b, name: a.select(key).join(b.select(key), key, "left_anti").select(F.lit(name).alias("problem"), F.col(key).cast("string").alias("detail"))
    repeated = rows.groupBy(key).count().filter("count > 1").select(F.lit("repeated_id").alias("problem"), F.col(key).cast("string").alias("detail"))
    return counts.unionByName(prints).unionByName(only(rows, details, "row_without_detail")).unionByName(only(details, rows, "detail_without_row")).unionByName(repeated)


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: ``(name, header, sequence, length)``; files are split at ``>``."""
    raw = spark.read.option("lineSep", ">").text(path).filter(F.trim("value") != "")
    header = F.trim(F.substring_index("value", "\n", 1))
    body = F.upper(F.regexp_replace(F.regexp_replace("value", r"^[^\n]*\n?", ""), r"\s", ""))
    return raw.select(F.element_at(F.split(header, r"\s+"), 1).alias("name"), header.alias("header"), body.alias("sequence")).withColumn("length", F.length("sequence"))


def alignment_problems(records: DataFrame) -> DataFrame:
    """Unequal lengths, repeated names and empty names of an alignment."""
    sizes = records.agg(F.min("length").alias("lo"), F.max("length").alias("hi"))
    unequal = sizes.filter("lo <> hi").select(F.lit("unequal_lengths").alias("problem"), F.concat_ws("-", "lo", "hi").alias("detail"))
    repeated = records.groupBy("name").count().filter("count > 1").select(F.lit("repeated_name").alias("problem"), F.col("name").alias("detail"))
    empty = records.filter(clean("name") == "").select(F.lit("empty_name").alias("problem"), F.col("header").alias("detail"))
    return unequal.unionByName(repeated).unionByName(empty)


def block_alignment(records: DataFrame, width: int = 65_536) -> DataFrame:
    """Alignment rows cut into fixed blocks: ``(sample_id, block, bases)``."""
    block = F.explode(F.sequence(F.lit(0), F.floor((F.length("sequence") - 1) / width).cast("int"))).alias("block")
    cut = records.filter("length > 0").select(F.col("name").alias("sample_id"), "sequence", block)
    return cut.select("sample_id", "block", F.substring(F.col("sequence"), F.col("block") * width + 1, F.lit(width)).alias("bases"))


def read_intervals(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Import intervals ``Node, Beg, End``: 1-based, closed, positive and in order."""
    raw = read_table(spark, path, "\t")
    if raw.columns != ["Node", "Beg", "End"]:
        raise ValueError("expected the columns Node, Beg, End")
    typed = raw.select(clean("Node").alias("node"), F.col("Beg").try_cast("bigint").alias("start"), F.col("End").try_cast("bigint").alias("end"))
    return split_rules(typed, [("no_node", F.col("node") == ""), ("not_a_number", F.col("start").isNull() | F.col("end").isNull()), ("bad_coordinates", (F.col("start") < 1) | (F.col("end") < F.col("start")))])


def read_screening(spark: SparkSession, path: str) -> DataFrame:
    """Screening distances in both directions: ``(first, second, distance, mismatch)``."""
    raw = require(read_table(spark, path, "\t"), ["Sample1", "Sample2", "Distance", "Mismatches (proportion)"])
    one = raw.select(F.col("Sample1").alias("first"), F.col("Sample2").alias("second"), F.col("Distance").cast("double").alias("distance"), F.col("Mismatches (proportion)").cast("double").alias("mismatch"))
    return one.unionByName(one.select(F.col("second").alias("first"), F.col("first").alias("second"), "distance", "mismatch"))


def read_state_probabilities(spark: SparkSession, path: str, mapping: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Wide node-by-character probabilities to ``(node, state, probability)`` and faulty nodes.

    The header is ``#name`` then characters; ``mapping(code, state)`` names them.
    """
    raw = spark.read.option("header", True).option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True).csv(path)
    if raw.columns[0] != "#name" or len(raw.columns) < 2:
        raise ValueError("malformed header of a probability table")
    codes = raw.columns[1:]
    long = raw.withColumnRenamed("#name", "node").unpivot("node", codes, "code", "text").join(mapping, "code", "left")
    typed = long.select("node", "code", "state", F.col("text").try_cast("double").alias("probability"))
    bad_value = F.col("probability").isNull() | F.isnan("probability") | (F.col("probability") < 0) | (F.col("probability") > 1)
    per = typed.groupBy("node").agg(F.count_if(bad_value).alias("bad"), F.sum("probability").alias("total"), F.count(F.lit(1)).alias("n"), F.count("state").alias("named"))
    fault = (
        F.when(F.col("n") != len(codes), "repeated_node").when(F.col("bad") > 0, "invalid_probability").when(F.col("named") < F.col("n"), "unmapped_character")
        .when(F.abs(F.col("total") - 1) > 1e-6, "does_not_sum_to_one")
    )
    faults = per.select("node", fault.alias("problem")).filter("problem IS NOT NULL")
    return typed.join(faults, "node", "left_anti").select("node", "state", "probability"), faults


def read_identifiers(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Accessions from a plain list (``#`` comments) or a CSV with an accession or source id."""
    first = spark.read.text(path).limit(1).first()
    if first is None:
        raise ValueError("the identifier list is empty")
    head = first[0].lstrip("﻿").strip()
    if "," in head or head in ("accession", "source_genome_id"):
        df = read_table(spark, path)
        columns = [clean(c) for c in ("accession", "source_genome_id") if c in df.columns]
        if not columns:
            raise ValueError("an identifier table needs accession or source_genome_id")
        ids = df.select(F.coalesce(*[F.when(c != "", c) for c in columns], F.lit("")).alias("identifier"))
    else:
        lines = spark.read.text(path).select(F.trim("value").alias("identifier"))
        ids = lines.filter((F.col("identifier") != "") & ~F.col("identifier").startswith("#"))
    counted = _repeats(ids, ["identifier"])
    valid, rejects = split_rules(counted, [("empty_identifier", F.col("identifier") == ""), ("repeated_identifier", F.col("_copies") > 1)])
    return valid.drop("_copies"), rejects.drop("_copies").distinct()


def check_vectors(vectors: DataFrame, records: DataFrame) -> DataFrame:
    """Problems of embedding vectors and their record mapping.

    ``vectors(protein_id, embedding)``, ``records(record_id, protein_id)``: ids unique, values
    finite, norms positive, one dimension, every record known.
    """
    row = lambda df, ident, problem: df.select(F.col(ident).alias("id"), F.lit(problem).alias("problem"))
    finite = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    norm = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x)
    size = vectors.groupBy(F.size("embedding").alias("size")).agg(F.count(F.lit(1)).alias("n")).agg(F.max(F.struct("n", "size")).alias("m")).select(F.col("m.size").alias("_size"))
    # One row: the common dimension.
    sized = vectors.crossJoin(F.broadcast(size))
    out = row(vectors.groupBy("protein_id").count().filter("count > 1"), "protein_id", "repeated_protein")
    for df, ident, problem in (
        (vectors.filter(~finite), "protein_id", "not_finite"), (vectors.filter(finite & (norm == 0)), "protein_id", "zero_norm"),
        (sized.filter(F.size("embedding") != F.col("_size")), "protein_id", "other_dimension"),
        (records.groupBy("record_id").count().filter("count > 1"), "record_id", "repeated_record"),
        (records.join(vectors.select("protein_id"), "protein_id", "left_anti"), "record_id", "record_without_vector"),
    ):
        out = out.unionByName(row(df, ident, problem))
    return out


def read_allele_sequences(spark: SparkSession, path: str, scope: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Allele to DNA catalogue of one scope: exact columns, one sequence per (locus, allele)."""
    wanted = ["scheme_id", "scheme_version", "locus", "allele", "dna"]
    raw = require(read_table(spark, path), wanted).select(*wanted)
    counted = _repeats(raw, ["locus", "allele"])
    rules = [
        ("other_scope", (clean("scheme_id") != scope["scheme_id"]) | (clean("scheme_version") != scope["scheme_version"])),
        ("malformed_identifier", (clean("locus") == "") | (clean("allele") == "") | (F.col("locus") != F.trim("locus")) | (F.col("allele") != F.trim("allele"))),
        ("empty_sequence", clean("dna") == ""),
        ("repeated_allele", F.col("_copies") > 1),
    ]
    valid, rejects = split_rules(counted, rules)
    return valid.select("locus", "allele", F.upper("dna").alias("dna")), rejects.select("locus", "allele", "reason")


def read_clock_metrics(spark: SparkSession, path: str, separator: str | None = None) -> DataFrame:
    """Rate, its error and R² from clock reports, one row per report, with a 95% rate interval.

    A file is one report, or with a ``separator`` holds many that end with it. ``report`` is the first line.
    A report that lacks the rate or R² keeps a row that says so.
    """
    reader = spark.read if separator is None else spark.read.option("lineSep", separator)
    text = reader.text(path, wholetext=separator is None).withColumn("file", F.input_file_name())
    number = r"\s*([+-]?[0-9.]+(?:[eE][+-]?\d+)?)"
    pick = lambda pattern: F.regexp_extract("value", pattern, 1).try_cast("double")
    df = text.select(
        "file", F.substring_index("value", "\n", 1).alias("report"), pick(r"(?i)--rate:" + number).alias("rate"),
        pick(r"(?i)--rate:" + number.replace("(", "(?:", 1) + r"\s*\+/-" + number).alias("rate_std"), pick(r"(?i)--r\^2:" + number).alias("r_squared"),
    )
    half = 1.96 * F.col("rate_std")
    return df.withColumn("rate_lower_95", F.col("rate") - half).withColumn("rate_upper_95", F.col("rate") + half).withColumn(
        "status", F.when(F.col("rate").isNull() | F.col("r_squared").isNull(), "unreadable").otherwise("read")
    )


def read_node_dates(spark: SparkSession, path: str) -> DataFrame:
    """Node dates with bounds from a commented TSV; rows that are not numbers are left out."""
    schema = "node string, date string, numeric_date string, lower_bound string, upper_bound string"
    raw = spark.read.option("sep", "\t").option("comment", "#").schema(schema).csv(path)
    numbers = [F.col(c).try_cast("double").alias(c) for c in ("numeric_date", "lower_bound", "upper_bound")]
    return raw.select("node", "date", *numbers).dropna(subset=["numeric_date", "lower_bound", "upper_bound"])
