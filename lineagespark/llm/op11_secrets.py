"""Secret scan: fixed patterns, and character Markov models of random strings and identifiers.

Three fixed kinds (assignments, access ids, hex runs) are found by pattern. They also label the
training samples: their values are random strings, all other runs of ``SAMPLE`` characters or more
are ordinary identifiers. Two first-order Markov chains over ``ALPHABET`` are counted from these
samples over all documents; a run of ``CANDIDATE`` characters or more whose log-likelihood ratio
reaches ``MIN_ODDS`` is a span of kind ``markov``, unless a fixed span covers it. Ratios are whole
micro-nats, so sums do not depend on their order.

Everything is DataFrame expressions within a row, without a shuffle of texts; the only exchange adds
up the counts of 68 * 67 transitions, and as many whole numbers come to the driver and go back as a
constant. Positions come from running sums in blocks, so a very long text with very many spans takes
time in proportion to its length, up to the number of blocks.

Null texts count as empty and have no spans; repeated rows are judged alone; without samples of
one class its chain is uniform, without any nothing is added. An empty table gives no rows. Extra
columns are not looked at and not returned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The three patterns and the least lengths of their matches.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24
# The same matches where the rest of a run cannot hold one: a run is as long as it gets.
LONG_ACCESS = r"AKIA[A-Z0-9]{16,}"
LONG_HEX = r"[0-9a-f]{24,}"

KINDS = ["assign", "access", "hex", "markov"]
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
SYMBOLS = len(ALPHABET)
RUN = r"[A-Za-z0-9+/_=-]"
#: Least lengths of a training sample and of a run that is judged.
SAMPLE, CANDIDATE = 8, 16
#: Count that every transition starts with: transitions from a character that neither class has seen weigh nothing.
PRIOR = 1.0
#: Least log-likelihood ratio of an added span, in micro-nats.
MIN_ODDS = 10_000_000
#: Length of the blocks of a running sum.
BLOCK = 256


def running(values: Column, zero: Column, merge, kind: str = "int") -> Column:
    """Running totals of an array by ``merge``; full blocks are set aside, so a long array is not copied for each element."""

    def step(done, x):
        total, full = merge(done["last"], x), F.size(done["open"]) >= BLOCK
        return F.struct(
            F.when(full, F.concat(done["blocks"], F.array(done["open"]))).otherwise(done["blocks"]).alias("blocks"),
            F.when(full, F.array(total)).otherwise(F.concat(done["open"], F.array(total))).alias("open"), total.alias("last"),
        )

    start = F.struct(F.array().cast(f"array<array<{kind}>>").alias("blocks"), F.array().cast(f"array<{kind}>").alias("open"), zero.alias("last"))
    return F.aggregate(values, start, step, lambda done: F.flatten(F.concat(done["blocks"], F.array(done["open"]))))


def _spans(text: Column, found: Column, pattern: str, rank: int) -> Column:
    """Spans of the matches ``found`` of ``pattern``: the texts between matches say where these start.

    Arrays are zipped, not looked up from inside a lambda, which would work them out for each element.
    """
    lengths = lambda parts: F.transform(parts, lambda p: F.length(p))
    step = F.zip_with(lengths(F.split(text, pattern, -1)), F.concat(F.array(F.lit(0)), lengths(found)), lambda a, b: a + b)
    starts = F.slice(running(step, F.lit(0), lambda a, b: a + b), F.lit(1), F.size(found))
    span = lambda at, m: F.struct(at.alias("start"), F.lit(rank).alias("rank"), (at + F.length(m)).alias("end"), m.alias("value"))
    none = F.array().cast("array<struct<start:int,rank:int,end:int,value:string>>")
    return F.when(F.size(found) > 0, F.zip_with(starts, found, span)).otherwise(none)


def base_spans(docs: DataFrame) -> DataFrame:
    """``(doc_id, text, base)``: the sorted spans ``(start, rank, end, value)`` of the three fixed kinds; null texts are empty."""
    df = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    patterns = [(ASSIGN, "assign"), (LONG_ACCESS, "access"), (LONG_HEX, "hex")]
    df = df.select("doc_id", "text", *[F.regexp_extract_all("text", F.lit(p), 0).alias(name) for p, name in patterns])
    df = df.select("doc_id", "text", *[_spans(F.col("text"), F.col(name), p, rank).alias(name) for rank, (p, name) in enumerate(patterns)])
    good = F.filter("assign", lambda s: F.length(F.regexp_extract(s["value"], ASSIGN, 2)) >= MIN_ASSIGN)
    return df.select("doc_id", "text", F.array_sort(F.concat(good, "access", "hex")).alias("base"))


def labelled_samples(docs: DataFrame) -> DataFrame:
    """``(secret, token)``: values of the fixed kinds, and all other runs of ``SAMPLE`` characters or more."""
    values = ASSIGN.replace("=-]+", f"=-]{{{MIN_ASSIGN},}}")
    random = F.concat(F.regexp_extract_all("text", F.lit(values), 2), F.regexp_extract_all("text", F.lit(LONG_ACCESS), 0), F.regexp_extract_all("text", F.lit(LONG_HEX), 0))
    rest = F.regexp_replace("text", f"{values}|{LONG_ACCESS}|{LONG_HEX}", " ")
    ordinary = F.regexp_extract_all(rest, F.lit(f"{RUN}{{{SAMPLE},}}"), 0)
    named = lambda tokens, secret: F.transform(tokens, lambda t: F.struct(F.lit(secret).alias("secret"), t.alias("token")))
    return docs.filter("text IS NOT NULL").select(F.inline(F.concat(named(random, True), named(ordinary, False))))


def _symbols(token: Column) -> Column:
    """The numbers of a token's characters in ``ALPHABET``, from 1; others fall away."""
    return F.filter(F.transform(F.split(token, ""), lambda c: F.when(c == "", 0).otherwise(F.instr(F.lit(ALPHABET), c))), lambda s: s > 0)


def train(samples: DataFrame) -> DataFrame:
    """``(cell, odds)`` from ``samples(secret, token)``, for every transition: ``cell`` is SYMBOLS * before + after - 1,
    where before is 0 at the start of a token; ``odds`` are micro-nats for a random string."""
    shifted = F.concat(F.array(F.lit(0)), F.slice("s", F.lit(1), F.size("s") - 1))
    cells = F.zip_with("s", shifted, lambda after, before: before * SYMBOLS + after - 1)
    seen = samples.select("secret", _symbols(F.col("token")).alias("s")).filter(F.size("s") > 0).select("secret", F.explode(cells).alias("cell"))
    seen = seen.groupBy("cell").agg(F.count_if("secret").alias("r"), F.count_if(~F.col("secret")).alias("o"))
    every = samples.sparkSession.range((SYMBOLS + 1) * SYMBOLS).select(F.col("id").cast("int").alias("cell"))
    filled = every.join(seen, "cell", "left").na.fill(0).withColumn("before", F.floor(F.col("cell") / SYMBOLS))
    totals = filled.groupBy("before").agg(F.sum("r").alias("all_r"), F.sum("o").alias("all_o"))
    share = lambda n, whole: (F.col(n) + PRIOR) / (F.col(whole) + PRIOR * SYMBOLS)
    odds = F.floor(F.log(share("r", "all_r") / share("o", "all_o")) * 1000000 + 0.5)
    return filled.join(totals, "before").select("cell", odds.cast("long").alias("odds"))


def _constant(model: DataFrame) -> Column:
    """The odds by cell as one constant; ``model`` has a fixed number of rows."""
    odds = [r["odds"] for r in model.orderBy("cell").collect()]
    return F.split(F.lit(",".join(map(str, odds))), ",").cast("array<bigint>")


def log_odds(token: Column, model: DataFrame) -> Column:
    """How much likelier a token is as a random string, in micro-nats."""
    table = _constant(model)
    step = lambda a, s: F.struct(s.cast("int").alias("before"), (a["sum"] + F.get(table, a["before"] * SYMBOLS + s - 1)).alias("sum"))
    return F.aggregate(_symbols(token), F.struct(F.lit(0).alias("before"), F.lit(0).cast("long").alias("sum")), step, lambda a: a["sum"])


def secret_spans(docs: DataFrame, model: DataFrame | None = None, min_odds: int = MIN_ODDS) -> DataFrame:
    """``(doc_id, spans)``: sorted ``(start, kind, end, value)`` in code points, end exclusive; ``model`` as ``train`` gives it,
    by default from the documents' own labels."""
    model = train(labelled_samples(docs)) if model is None else model
    pattern = f"{RUN}{{{CANDIDATE},}}"
    df = base_spans(docs)
    df = df.select("doc_id", "text", "base", F.regexp_extract_all("text", F.lit(pattern), 0).alias("run"))
    df = df.select("doc_id", "base", _spans(F.col("text"), F.col("run"), pattern, 3).alias("run"))
    likely = F.filter("run", lambda s: log_odds(s["value"], model) >= min_odds)
    # A run goes when a fixed span that starts before it or with it reaches its end.
    df = df.select("doc_id", F.array_sort(F.concat("base", likely)).alias("every"))
    reach = running(F.transform("every", lambda s: F.when(s["rank"] < 3, s["end"]).otherwise(0)), F.lit(0), lambda a, b: F.greatest(a, b))
    marked = F.zip_with("every", reach, lambda s, r: F.struct(s.alias("s"), ((s["rank"] < 3) | (s["end"] > r)).alias("stays")))
    kept = F.transform(F.filter(marked, lambda x: x["stays"]), lambda x: x["s"])
    kinds = F.array(*[F.lit(k) for k in KINDS])
    named = F.transform(kept, lambda s: F.struct(s["start"].alias("start"), F.get(kinds, s["rank"]).alias("kind"), s["end"].alias("end"), s["value"].alias("value")))
    return df.select("doc_id", named.alias("spans"))


def secret_report(docs: DataFrame, min_odds: int = MIN_ODDS) -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, n_markov, base_sha256, spans)``, one row per document; a span is ``kind:start:end``."""
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"] != "markov")
    return secret_spans(docs, min_odds=min_odds).select("doc_id", *[count(k) for k in KINDS], F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))
