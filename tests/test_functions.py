"""Hand cases of the column functions."""

import pytest
from pyspark.sql import functions as F

from lineagespark.functions import accessions, alleles, dates, lineage, scopes, sequences


def values(spark, rows, expr):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, v string")
    return [r[0] for r in df.select("i", expr(F.col("v")).alias("o")).orderBy("i").select("o").collect()]


def test_dates(spark):
    rows = ["2020", "2020-02", "2020-02-30", "2020-02-29", "2020-2", "x", "", "2999", "0000"]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, v string")
    out = dates.add_date_interval(df, "d", "v", "2026-01-01").orderBy("i").collect()
    got = [(str(r.d.start), str(r.d.end), r.d.precision) if r.d else None for r in out]
    assert got[0] == ("2020-01-01", "2020-12-31", "year")
    assert got[1] == got[4] == ("2020-02-01", "2020-02-29", "month")
    assert got[3] == ("2020-02-29", "2020-02-29", "day")
    assert got[2] is got[5] is got[6] is got[7] is got[8] is None
    assert abs(out[0].d.year_max - (2020 + 365 / 366)) < 1e-12


def test_interval_bounds_must_fit_precision(spark):
    rows = [
        ("2020", "2020-02-01", "2020-02-29", "month", "valid"), ("2020", "2020-02-01", "2020-02-28", "month", "invalid"),
        ("2020", None, None, "missing", "missing"), ("2019/2018", None, None, None, "invalid"), ("2018/2019-03", None, None, None, "valid"),
        ("2020-05-01", "2020-05-01", None, None, "invalid"), ("2030", None, None, None, "future"), ("unknown", None, None, None, "missing"),
    ]
    df = spark.createDataFrame(rows, "v string, s string, e string, p string, want string")
    out = dates.add_sample_interval(df, "i", "v", "s", "e", "p", "2026-01-01").collect()
    assert [r.i.status for r in out] == [r.want for r in out]


def test_service_bounds_recover_precision(spark):
    rows = [("", "2020-01-01", "2020-12-31"), ("", "2020-03-01", "2020-03-31"), ("", "2020-03-02", "2020-03-05"), ("", "", ""), ("2021", "2020-01-01", "")]
    df = spark.createDataFrame(rows, "r string, s string, e string")
    out = [(r.d.precision, r.d.collection_date) for r in dates.add_normalised_dates(df, "d", "r", "s", "e").collect()]
    assert out == [("year", "2020"), ("month", "2020-03"), ("interval", "2020-03-02/2020-03-05"), ("missing", ""), ("year", "2021")]


def test_lineage_codes(spark):
    rows = ["1_2_3_4_5_6_7_8_9_10", "1_2_*_*", "1_*_3", "1,2,?", "", "NA", "x_1", "1_2_3_4_5_6_7_8_9_10_11", "*_*", "1_*abc", "7"]
    got = values(spark, rows, lineage.parse_code)
    assert [(list(r.prefix), r.status) for r in got] == [
        (list(range(1, 11)), "complete"), ([1, 2], "partial"), ([], "malformed"), ([1, 2], "partial"), ([], "missing"), ([], "missing"), ([], "malformed"),
        ([], "malformed"), ([], "partial"), ([1], "partial"), ([7], "partial"),
    ]
    key = values(spark, ["1_2_3"], lambda c: lineage.group_key(F.lit("s"), F.lit("v"), lineage.parse_code(c)["prefix"], 2))
    assert key == ['["s","v",[1,2]]']


def test_alleles(spark):
    assert values(spark, ["001", "0", "A" * 40, "new", "?"], alleles.comparable_allele) == ["1", None, "a" * 40, None, None]
    assert values(spark, ["001", "0", "None", "x"], alleles.stored_allele) == ["001", None, None, "x"]


def test_scope_fallback(spark):
    digest = "a" * 64
    scope = lambda c: scopes.typing_scope(F.lit("s"), c, F.lit(digest))["version"]
    assert values(spark, ["v1", "unknown", ""], scope) == ["v1", "sha256:" + digest, "sha256:" + digest]
    none = lambda c: scopes.typing_scope(F.lit("s"), c, F.lit(""), [F.lit(digest)])["version"]
    assert values(spark, ["-"], none) == ["exportsha256:" + digest]


def test_translation(spark):
    rows = ["ATGGCCTAA", "GTGGCC", "ATGTAAGCC", "ATGG", "CCCATG", "ATGNNN"]
    got = [(r.protein, r.reason) for r in values(spark, rows, sequences.translate)]
    assert got == [("MA", None), ("MA", None), (None, "internal_stop"), (None, "out_of_frame"), (None, "invalid_start_codon"), (None, "ambiguous_or_unsupported_dna")]


def test_accessions(spark):
    assert values(spark, ["see samn12, ERR9 and GCA_1.2; PRJNA5"], lambda c: accessions.find_accessions(c)) == [["ERR9", "GCA_1.2", "PRJNA5", "SAMN12"]]


def test_shared_folder_without_a_setting_is_kept_per_application():
    from types import SimpleNamespace

    from lineagespark.session import shared_folder

    bare = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default), sparkContext=SimpleNamespace(master="local[2]", applicationId="app-1"))
    assert shared_folder(bare) == shared_folder(bare)
    cluster = SimpleNamespace(conf=bare.conf, sparkContext=SimpleNamespace(master="spark://host:7077", applicationId="app-2"))
    with pytest.raises(ValueError):
        shared_folder(cluster)
