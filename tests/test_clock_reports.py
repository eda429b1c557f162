"""Clock reports, one or many to a file."""

from lineagespark.plans import registry
from lineagespark.sources import readers

REPORTS = ["key 1\n --rate:\t0.5 +/- 0.1\n --r^2:  0.9\n", "key 2\n --rate:\t-1e-3 +/- 0.001\n", "key 3\n"]


def test_many_reports_in_a_file_read_as_one_file_each(spark, tmp_path):
    (tmp_path / "many").mkdir()
    (tmp_path / "one").mkdir()
    (tmp_path / "many" / "part.txt").write_text("".join(r + "\f" for r in REPORTS))
    for i, r in enumerate(REPORTS):
        (tmp_path / "one" / f"{i}.txt").write_text(r)
    rows = lambda df: sorted(tuple(r) for r in df.drop("file").collect())
    many = rows(readers.read_clock_metrics(spark, str(tmp_path / "many"), "\f"))
    assert many == rows(readers.read_clock_metrics(spark, str(tmp_path / "one"))) and [r[0] for r in many] == ["key 1", "key 2", "key 3"]


def test_clock_query_leaves_no_file_per_report(spark):
    registry.load_all()
    out = registry.QUERIES["S13"](spark, "/root/testdata/sf0.001")
    assert len([f for f in out.inputFiles() if "clock-" in f]) < 10 <= out.filter("source = 'clock'").count()
