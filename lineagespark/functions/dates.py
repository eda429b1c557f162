"""Partial dates as closed intervals, without inventing precision."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineagespark import constants as C
from lineagespark.functions.text import _col, clean, first_filled, is_one_of

DAY = "yyyy-MM-dd"


def _parse(text: Column) -> Column:
    return F.try_to_date(text, DAY)


def decimal_year(day) -> Column:
    """Year plus the elapsed fraction at the start of the day; leap years have 366 days."""
    day = _col(day)
    length = F.dayofyear(F.make_date(F.year(day), F.lit(12), F.lit(31)))
    return F.year(day) + (F.dayofyear(day) - 1) / length


_PARTIAL = r"^(?!0000)\d{4}(-\d{2}(-\d{2})?)?$"


def _start(text: Column) -> Column:
    """First day of a partial date: the missing tail is the tail of ``-01-01``."""
    tail = F.substring(F.lit("0000-01-01"), F.length(text) + 1, F.lit(10))
    return F.when(text.rlike(_PARTIAL), _parse(F.concat(text, tail)))


def _end(text: Column) -> Column:
    """Last day of a partial date."""
    months = F.when(F.length(text) == 4, 12).when(F.length(text) == 7, 1).otherwise(0)
    return F.date_sub(F.add_months(_start(text), months), F.signum(months).cast("int"))


def _precision(text: Column) -> Column:
    return F.when(F.length(text) == 4, "year").when(F.length(text) == 7, "month").otherwise("day")


def bounds(text) -> Column:
    """Struct(start, end, precision) of ``YYYY``, ``YYYY-MM`` or ``YYYY-MM-DD``; null dates if not one."""
    text = clean(text)
    return F.struct(_start(text).alias("start"), _end(text).alias("end"), _precision(text).alias("precision"))


def _date_part(text: Column) -> Column:
    """Only the date of longer text, such as a timestamp."""
    return F.substring(text, 1, 10)


def add_date_interval(df: DataFrame, out: str, collection_date, as_of: str | None, collection_year=None) -> DataFrame:
    """Add the interval struct of a simple partial date: null when unusable or after ``as_of``.

    Year and month need not be zero padded here; a full day must be ISO. ``as_of=None`` keeps
    future dates. Steps are staged as columns so the planner evaluates each once.
    """
    text = first_filled(collection_date, collection_year) if collection_year is not None else clean(collection_date)
    df = df.withColumn("_t", F.regexp_replace(text, r"^(\d{1,4})-(\d)$", "$1-0$2"))
    short = F.col("_t").rlike(r"^\d{1,3}(-\d\d)?$")
    width = F.when(F.col("_t").contains("-"), 7).otherwise(4)
    df = df.withColumn("_t", F.when(short, F.lpad("_t", width, F.lit("0"))).otherwise(F.col("_t")))
    df = df.withColumns({"_s": _start(F.col("_t")), "_e": _end(F.col("_t"))})
    value = F.struct(
        F.col("_s").alias("start"),
        F.col("_e").alias("end"),
        _precision(F.col("_t")).alias("precision"),
        decimal_year("_s").alias("year_min"),
        decimal_year("_e").alias("year_max"),
        F.year("_s").alias("year"),
    )
    usable = F.col("_s").isNotNull() if as_of is None else F.col("_s") <= F.lit(as_of).cast("date")
    return df.withColumn(out, F.when(usable, value)).drop("_t", "_s", "_e")


def add_normalised_dates(df: DataFrame, out: str, raw, service_start=None, service_end=None) -> DataFrame:
    """Source precedence for dates: the sample's own text, else the service's bounds.

    Text may be ``a/b``. Service bounds that cover exactly one year or month recover that
    precision. Adds Struct(collection_date, start, end, precision, dated). The two ends are staged as
    columns so the planner evaluates each once.
    """
    first = clean(service_start) if service_start is not None else F.lit("")
    last = first_filled(service_end, first) if service_end is not None else first
    df = df.withColumns({"_raw": clean(raw), "_first": first, "_last": last})
    raw, first, last = F.col("_raw"), F.col("_first"), F.col("_last")
    has_raw, is_pair = raw != "", raw.contains("/")
    low = _date_part(F.when(is_pair, F.trim(F.substring_index(raw, "/", 1))).when(has_raw, raw).otherwise(first))
    high = _date_part(F.when(is_pair, F.trim(F.regexp_replace(raw, "^[^/]*/", ""))).when(has_raw, raw).otherwise(last))
    staged = df.withColumns({"_low": low, "_high": high})
    staged = staged.withColumns({"_start": _start(F.col("_low")), "_end": _end(F.col("_high"))})
    low, start, end = F.col("_low"), F.col("_start"), F.col("_end")
    covers_year = (F.dayofyear(start) == 1) & (end == F.date_sub(F.add_months(start, 12), 1))
    covers_month = (F.dayofmonth(start) == 1) & (end == F.last_day(start))
    both = start.isNotNull() & end.isNotNull()
    precision = (
        F.when(is_pair, F.when(both & (start <= end), "interval").otherwise("invalid"))
        .when(has_raw & is_one_of(raw, C.MISSING_METADATA), "missing")
        .when(has_raw, F.when(both, _precision(low)).otherwise("invalid"))
        .when(start.isNull() & end.isNull(), "missing")
        .when(~both, "invalid")
        .when(covers_year, "year")
        .when(covers_month, "month")
        .when(start == end, "day")
        .otherwise("interval")
    )
    iso = lambda d, f=DAY: F.date_format(d, f)
    service_text = (
        F.when(~both, "")
        .when(covers_year, iso(start, "yyyy"))
        .when(covers_month, iso(start, "yyyy-MM"))
        .when(start == end, iso(start))
        .otherwise(F.concat_ws("/", iso(start), iso(end)))
    )
    value = F.struct(
        F.when(has_raw, raw).otherwise(service_text).alias("collection_date"),
        F.when(precision != "invalid", start).alias("start"),
        F.when(precision != "invalid", end).alias("end"),
        precision.alias("precision"),
        (~precision.isin("missing", "invalid")).alias("dated"),
    )
    return staged.withColumn(out, value).drop("_raw", "_first", "_last", "_low", "_high", "_start", "_end")


def normalised_text_dates(raw) -> Column:
    """The struct of :func:`add_normalised_dates` for the sample's own text alone."""
    raw = clean(raw)
    is_pair = raw.contains("/")
    low = _date_part(F.trim(F.substring_index(raw, "/", 1)))
    high = _date_part(F.trim(F.regexp_replace(raw, "^[^/]*/", "")))
    start, end = _start(low), _end(high)
    precision = (
        F.when(is_one_of(raw, C.MISSING_METADATA), "missing")
        .when(~F.coalesce(start <= end, F.lit(False)), "invalid")
        .when(is_pair, "interval")
        .otherwise(_precision(low))
    )
    known = F.coalesce(start <= end, F.lit(False))
    return F.struct(
        raw.alias("collection_date"), F.when(known, start).alias("start"), F.when(known, end).alias("end"),
        precision.alias("precision"), known.alias("dated"),
    )


def add_sample_interval(df: DataFrame, out: str, collection_date, start, end, precision, as_of: str) -> DataFrame:
    """Validated interval: declared bounds first, and they must fit the declared precision.

    Adds Struct(status, reason, start, end, precision, year_min, year_max, midpoint_year, year).
    """
    df = df.withColumns({"_raw": clean(collection_date), "_from": clean(start), "_to": clean(end), "_said": _col(precision)})
    raw, precision, start_text, end_text = F.col("_raw"), F.col("_said"), F.col("_from"), F.col("_to")
    declared = (start_text != "") | (end_text != "")
    whole_day = lambda text: F.when(F.length(text) == 10, text)
    low = F.when(declared, whole_day(start_text)).otherwise(F.trim(F.substring_index(raw, "/", 1)))
    high = F.when(declared, whole_day(end_text)).otherwise(F.trim(F.regexp_replace(raw, "^[^/]*/", "")))
    staged = df.withColumns({"_low": low, "_high": high, "_declared": declared})
    staged = staged.withColumns({"_lo": _start(F.col("_low")), "_hi": _end(F.col("_high")), "_kind": _precision(F.col("_low"))})
    lo, hi, declared = F.col("_lo"), F.col("_hi"), F.col("_declared")
    found = (
        F.when(declared, F.coalesce(precision, F.when(lo == hi, "day").otherwise("interval")))
        .when(raw.contains("/"), "interval")
        .otherwise(F.col("_kind"))
    )
    fits = (
        F.when(found == "day", lo == hi)
        .when(found == "month", (F.dayofmonth(lo) == 1) & (F.last_day(lo) == hi))
        .when(found == "year", (F.dayofyear(lo) == 1) & (hi == F.date_sub(F.add_months(lo, 12), 1)))
        .otherwise(found == "interval")
    )
    ok = F.coalesce((lo <= hi) & (~declared | fits), F.lit(False))
    status = (
        F.when(precision.isin("missing", "invalid"), precision)
        .when(~declared & is_one_of(raw, C.MISSING_METADATA), "missing")
        .when(~ok, "invalid")
        .when(lo > F.lit(as_of).cast("date"), "future")
        .otherwise("valid")
    )
    staged = staged.withColumns({"_status": status, "_found": found, "_lower": decimal_year(lo), "_upper": decimal_year(hi)})
    status, found, lower, upper = F.col("_status"), F.col("_found"), F.col("_lower"), F.col("_upper")
    has_bounds = status.isin("valid", "future")
    value = F.struct(
        status.alias("status"),
        F.when(status != "valid", F.concat(status, F.lit("_collection_date"))).alias("reason"),
        F.when(has_bounds, lo).alias("start"),
        F.when(has_bounds, hi).alias("end"),
        F.when(has_bounds, found).otherwise(status).alias("precision"),
        F.when(has_bounds, lower).alias("year_min"),
        F.when(has_bounds, upper).alias("year_max"),
        F.when(has_bounds, (lower + upper) / 2).alias("midpoint_year"),
        F.when(has_bounds, F.year(lo)).alias("year"),
    )
    return staged.withColumn(out, value).drop(
        "_raw", "_from", "_to", "_said", "_low", "_high", "_lo", "_hi", "_kind", "_declared", "_status", "_found", "_lower", "_upper"
    )


def date_is_accepted(column) -> Column:
    """Whether the text is one of the accepted sample-sheet date forms."""
    text = clean(column)
    month = F.try_element_at(F.split(text, "-"), F.lit(2)).try_cast("int")
    year = F.substring(text, 1, 4).try_cast("int")
    return (
        text.rlike(C.NUMERIC_DATE)
        | text.rlike(C.RANGE_DATE)
        | (text.rlike(r"^\d{4}-\d{2}$") & F.coalesce(month.between(1, 12) & year.between(1800, 2200), F.lit(False)))
        | (text.rlike(r"^\d{4}-\d{2}-\d{2}$"))
        & (_parse(text).isNotNull())
        | text.rlike(C.AMBIGUOUS_DATE)
    )


def cohort_date(collection_date, start, end, precision, dated) -> Column:
    """Date text for dated cohorts: intervals as ``[low:high]`` decimal years, else as given."""
    interval = F.format_string("[%.8f:%.8f]", decimal_year(start), decimal_year(end))
    text = F.when(_col(precision) == "interval", interval).otherwise(clean(collection_date))
    return F.when(_col(dated), text).otherwise("")


def year_text(column) -> Column:
    return F.when(_col(column).rlike(r"^\d{4}"), F.substring(_col(column), 1, 4)).otherwise("")


def month_text(column) -> Column:
    c = _col(column)
    return F.when(c.rlike(r"^\d{4}-(0[1-9]|1[0-2])"), F.substring(c, 1, 7)).otherwise("")


def period_class(first, second) -> Column:
    m1, m2, y1, y2 = month_text(first), month_text(second), year_text(first), year_text(second)
    return (
        F.when((m1 != "") & (m1 == m2), "same_month")
        .when((y1 != "") & (y1 == y2), "same_year")
        .when((y1 != "") & (y2 != ""), "between_years")
        .otherwise("date_unavailable")
    )


def patient_class(first, second) -> Column:
    a, b = F.coalesce(_col(first), F.lit("")), F.coalesce(_col(second), F.lit(""))
    return F.when((a == "") | (b == ""), "patient_unavailable").when(a == b, "same_patient").otherwise("different_patients")
