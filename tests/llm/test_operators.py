"""Numbered operators against brute force and on awkward tables."""

from __future__ import annotations

import hashlib
import os
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from compare import check, connect
from lineagespark.llm import (
    op01_packing, op02_quality, op03_chat, op04_jaccard, op05_language, op06_suffixes, op07_mixing, op08_urls, op09_lines, op10_fingerprints,
)
from lineagespark.llm import queries as llm

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n, words="one two three four five six seven eight nine ten red blue green old new".split()):
    return " ".join(rng.choice(words) + rng.choice("abcdefgh") for _ in range(n))


def awkward(spark, extra=True):
    """Nulls in any column, empty and long texts, repeated rows, ties, and columns whose names the operators use."""
    rng = random.Random(5)
    base = prose(rng, 120)
    long = "\n".join(prose(rng, 12) for _ in range(3000))
    texts = [None, "", "   \n\t ", base, base, base.replace("one", "uno"), long, long + " end", "a", "é" * 700, "=" * 900, "x y\nx y\nx y\nx y"]
    rows = [(i, t, [None, "en", "fr"][i % 3], [None, "s1", "s2"][i % 3], None) for i, t in enumerate(texts)]
    rows += [(None, base, "en", None, 5), (None, None, None, None, None), rows[3], rows[3], (7, "other text " * 60, "en", "s1", 1)]
    df = spark.createDataFrame(rows, DOCS)
    return df.select("*", *[F.lit("x").alias(c) for c in ("size", "bucket", "kept", "digest", "sum", "first", "n", "id")]) if extra else df


def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.mark.parametrize("key", sorted(llm.ORACLES))
def test_sql(spark, key):
    _, _, problem = check(spark, connect(SF), key, entry.queries()[key], llm.ORACLES[key], SF)
    assert problem is None, problem


def documents(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


OPERATORS = {
    "pack": op01_packing.pack, "quality": op02_quality.quality_report, "jaccard": op04_jaccard.jaccard_components, "language": op05_language.identify_languages,
    "repeats": op06_suffixes.repeat_report, "mix": op07_mixing.mix, "lines": op09_lines.dedup_lines, "fingerprints": op10_fingerprints.fingerprints,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_awkward_and_empty_tables(spark, name):
    docs = awkward(spark)
    rows = OPERATORS[name](docs).collect()
    assert len(rows) == docs.count()
    assert OPERATORS[name](empty(spark)).count() == 0


# -- 1 --------------------------------------------------------------------------------------------


def test_bounds_are_optimal():
    from itertools import combinations

    rng = random.Random(1)
    for _ in range(60):
        lengths = sorted(rng.randint(1, 25) for _ in range(rng.randint(1, 30)))
        kinds = sorted(set(lengths))
        rows = [(k, lengths.count(k), k * lengths.count(k)) for k in kinds]
        for buckets in (1, 2, 3, 4):
            cost = lambda bounds: sum(min(b for b in bounds if b >= x) - x for x in lengths)  # noqa: B023, E731
            best = min(cost(c) for n in range(1, buckets + 1) for c in combinations(kinds, n) if c[-1] == kinds[-1])
            got = op01_packing.optimal_bounds(rows, buckets)
            assert len(got) <= buckets and cost(got) == best


def test_batches_keep_the_budget(spark):
    rows = llm.QUERIES["op1_packing"](spark, SF).filter("bucket IS NOT NULL")
    per = rows.groupBy("bucket", "bucket_len", "batch").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("slot").alias("slots"), F.max("slot").alias("top")).collect()
    for r in per:
        assert r["n"] == r["slots"] == r["top"] + 1 and (r["n"] == 1 or r["n"] * r["bucket_len"] <= op01_packing.TOKEN_BUDGET)


# -- 2 --------------------------------------------------------------------------------------------


def test_quality_counts(spark):
    got = {r["doc_id"]: r for r in llm.QUERIES["op2_quality"](spark, SF).collect()}
    for doc_id, text in documents(spark):
        text = text or ""
        words, seen, dup = WORD.findall(text), set(), 0
        for line in text.split("\n"):
            if WORD.search(line):
                dup += line in seen
                seen.add(line)
        grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        again = {i + j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(3)} if len(grams) < 700 else None
        r = got[doc_id]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"]) == (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup)
        if again is not None:
            assert r["n_repeat_words"] == len(again)
            assert r["base_failed"] == (len(words) < 50 or 100 * len(again) > 50 * len(words))
        assert not (r["base_failed"] and r["kept"])


def test_repetition_is_rejected_and_prose_kept():
    rng = random.Random(3)
    text = prose(rng, 200)
    assert op02_quality.measure(text)[10]
    assert not op02_quality.measure(" ".join([text[:300]] * 6))[10]
    for n in (2, 5, 9):
        values = np.array([rng.randint(0, 3) for _ in range(60)], np.uint64)
        hashes = op02_quality.rolling(values + np.uint64(7), n, *op02_quality.prefix_sums(values + np.uint64(7)))
        windows = [tuple(values[i : i + n]) for i in range(61 - n)]
        assert all((hashes[i] == hashes[j]) == (windows[i] == windows[j]) for i in range(len(windows)) for j in range(i))


def test_quality_bounds_follow_the_length():
    """A third of a long text in passages of its own is too much; a short text may say one line twice."""
    rng = random.Random(8)
    fresh = lambda n: " ".join(f"{rng.random():.6f}" for _ in range(n))
    passages = [fresh(40) for _ in range(4)]
    long = " ".join([fresh(320), *passages, fresh(320), *passages])
    assert len(long.split()) == 960 and op02_quality.measure(long)[10:] == (False, "repeated_5")
    line = fresh(9)
    assert op02_quality.measure(f"{line}\n{fresh(40)}\n{line}")[10] and op02_quality.measure(fresh(960))[10]
    line = fresh(14)
    assert op02_quality.measure(f"{line}\n{fresh(72)}\n{line}")[10]
    shares = [op02_quality.bound(op02_quality.REPEATED_SHARE[10], n) for n in range(50, 5000)]
    assert shares[0] == 0.35 and 0.10 < shares[-1] < 0.11 and all(0 <= a - b < 0.01 for a, b in zip(shares, shares[1:]))


# -- 3, 8 -----------------------------------------------------------------------------------------


def test_snapshots_collapse(spark):
    say = lambda c, *texts: [(c, i, "user", t) for i, t in enumerate(texts)]
    rows = say(1, "a") + say(2, "a", "b") + say(3, "a", "b", None) + say(4, "a", "c") + say(5, "a", "c") + say(6, "b") + [(None, 0, "user", "a"), (6, 0, "user", "b"), (7, None, None, None)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("place", F.lit(1)).withColumn("n_turns", F.lit("x"))
    got = {r["conv_id"]: (r["n_turns"], r["n_equal"], r["text"]) for r in op03_chat.chat_documents(turns).collect()}
    assert set(got) == {3, 4, 6, 7} and got[4][:2] == (2, 2) and got[6][0] == 1
    assert got[3][2] == "<|user|>\na\n<|end|>\n<|user|>\nb\n<|end|>\n<|user|>\n\n<|end|>\n" and got[7][2].startswith("<|unknown|>")
    assert op03_chat.chat_documents(turns.limit(0)).count() == 0


def test_urls(spark):
    urls = [None, "no scheme", "http://", "http://A.Example.NET/en/x?q#f", "https://b.net", "https://b.net/", "http://x.example.com/de/1", "http://x.org/fr/", "http://bad.co.uk/p?u=http://net/", "http://bad.co.uk/q", "http://good.com#a/b"]
    pages = spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)] + [(100 + i, f"http://bad.co.uk/{i}", "") for i in range(60)] + [(200 + i, f"http://good.com/{i}", "") for i in range(60)], "page_id long, url string, host string")
    labels = spark.createDataFrame([(100 + i, 0, 0) for i in range(60)] + [(200 + i, 1, 0) for i in range(60)] + [(None, 0, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    got = {r["page_id"]: tuple(r)[1:5] for r in op08_urls.judge_urls(pages, labels).collect()}
    assert got[0] == got[1] == got[2] == ("", "", None, "allow")
    assert got[3] == ("a.example.net", "/en/x", "example.net/en/", "allow") and got[4] == ("b.net", "", None, "allow") and got[5] == ("b.net", "/", "net/", "block")
    assert got[6][2:] == ("example.com/de/", "block") and got[7][2:] == ("org/fr/", "allow")
    assert got[8] == ("bad.co.uk", "/p", None, "block") and got[9][3] == "block" and got[10] == ("good.com", "", None, "allow")
    assert op08_urls.judge_urls(pages.limit(0), labels.limit(0)).count() == 0


# -- 4 --------------------------------------------------------------------------------------------


def shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 4]) for i in range(max(len(words) - 3, 1))} if words else set()


def components(sets):
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("few", [op04_jaccard.FEW_PAIRS, 20])
def test_jaccard_components(spark, few, monkeypatch):
    monkeypatch.setattr(op04_jaccard, "FEW_PAIRS", few)
    rng, texts = random.Random(11), []
    for n in (3, 9, 60, 200):
        words = prose(rng, n).split()
        for edits in (0, 0, 1, 1, 2, 3, 4, 6, 8):
            copy = list(words)
            for _ in range(edits):
                copy[rng.randrange(n)] = f"w{rng.random()}"
            texts.append(" ".join(copy) if edits != 1 else " ".join(copy).upper())
    texts += [None, "", "solo", "SOLO"]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in op04_jaccard.jaccard_components(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    sets = {i: shingles(t) for i, t in enumerate(texts)}
    named = components(sets)
    assert got == {i: (len(s), named[i]) for i, s in sets.items()}


def test_similar_sets_share_a_signature():
    rng = np.random.default_rng(2)
    for size in (3, 7, 12, 33, 100, 260):
        for _ in range(20):
            a = rng.integers(0, 2**63, size, dtype=np.uint64)
            d = int(size * 0.15)
            for lost in range(d + 1):
                b = np.unique(np.concatenate([a[lost:], rng.integers(0, 2**63, d - lost, dtype=np.uint64)]))
                both = len(np.intersect1d(a, b))
                if 100 * both >= 85 * (len(a) + len(b) - both) and len(a) + len(b) > 2 * both:
                    assert np.intersect1d(op04_jaccard.signatures(np.sort(a)), op04_jaccard.signatures(b)).size


# -- 5 --------------------------------------------------------------------------------------------


def test_code_lengths_are_those_of_the_context_trees():
    import pandas as pd

    rng, order, trees, rows = random.Random(4), 2, {}, []
    for lang, letters in (("x", "aab"), ("y", "abbc")):
        for _ in range(40):
            data = b" " + "".join(rng.choice(letters) for _ in range(rng.randint(1, 6))).encode() + b" "
            for i in range(1, len(data)):
                for o in range(min(order, i) + 1):
                    trees.setdefault((lang, data[i - o : i]), {}).setdefault(data[i], 0)
                    trees[lang, data[i - o : i]][data[i]] += 1
    for (lang, context), seen in trees.items():
        rows += [(lang, len(context), int.from_bytes(context + bytes([s]), "big"), n) for s, n in seen.items()]
    model = op05_language.build_model(pd.DataFrame(rows, columns=["lang", "size", "key", "n"]), order)

    def bits(lang, word):
        data, total = b" " + word + b" ", 0.0
        for i in range(1, len(data)):
            for o in range(min(order, i), -1, -1):
                seen = trees.get((lang, data[i - o : i]))
                if seen is None:
                    continue
                n, kinds = sum(seen.values()), len(seen)
                if data[i] in seen:
                    total -= np.log2(seen[data[i]] / (n + kinds))
                    break
                total -= np.log2(kinds / (n + kinds))
            else:
                total += 8.0
        return total

    words = [b"ab", b"cab", b"zz", b"a", b"bcbcb"]
    assert np.allclose(op05_language.code_lengths(model, words), [[bits(lang, w) for lang in model.langs] for w in words])


def test_held_out_languages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = llm.QUERIES["op5_language"](spark, SF).join(docs, "doc_id").collect()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1
    held = [r for r in rows if r["held_out"] and r["lang_pred"] != "und"]
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.95 * len(held)


# -- 6 --------------------------------------------------------------------------------------------


def test_repeated_strings(spark):
    rng = random.Random(8)
    base = prose(rng, 500)
    docs = documents(spark)[:60] + [(1000, base), (1001, base), (1002, "z" + base[:900] + "q" + base[1400:]), (1003, base[700:1099]), (1004, base[700:1100]), (1005, "ab" * 450), (1006, "=" * 1000 + prose(rng, 80)), (1007, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: tuple(r)[1:] for r in op06_suffixes.repeat_report(df).collect()}
    seen = {}
    for _, text in docs:
        raw = (text or "").encode()
        for i in range(len(raw) - 399):
            seen[raw[i : i + 400]] = seen.get(raw[i : i + 400], 0) + 1
    for doc_id, text in docs:
        raw = (text or "").encode()
        gone = np.zeros(len(raw) + 1, bool)
        for i in range(len(raw) - 399):
            if seen[raw[i : i + 400]] > 1:
                gone[i : i + 400] = True
        gone = gone[: len(raw)]
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(raw) else 0
        assert got[doc_id] == (len(raw), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(raw, np.uint8)[~gone].tobytes()).hexdigest()), doc_id


def test_training_reads_past_a_long_beginning(spark):
    """A word that only stands after 20,000 characters counts for its language."""
    rows = [(1, "aa " * 8000 + "zzz " * 50, "x"), (2, "bb " * 100, "y")]
    model = op05_language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    names, _ = op05_language.Scorer(model).predict(["zzz zzz zzz"])
    assert list(names) == ["x"]


# -- 9, 10 ----------------------------------------------------------------------------------------


def test_line_windows_merge(spark):
    rows = [(2, "a\nb\nc\nd\nz"), (1, "x\na\nb\n\nc\nd"), (3, "a\nb"), (4, "r\nr\nr\nr\nr"), (5, "k\nl\nm"), (5, "k\nl\nm")]
    got = sorted((r["doc_id"], r["text"], r["n_lines_removed"]) for r in op09_lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(1, "x\na\nb\n\nc\nd", 0), (2, "z", 4), (3, "a\nb", 0), (4, "r", 4), (5, "k\nl\nm", 0), (5, "k\nl\nm", 0)]


def test_fingerprints(spark):
    docs = sorted(documents(spark), key=lambda r: -r[0])
    got = {r["doc_id"]: r for r in llm.QUERIES["op10_fingerprints"](spark, SF).collect()}
    for i, (doc_id, text) in enumerate(docs):
        following, text = docs[(i + 1) % len(docs)][1] or "", text or ""
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        r = got[doc_id]
        own, other = op10_fingerprints.fingerprint(text), op10_fingerprints.fingerprint(changed)
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert r["fingerprint"] == own.astype(">u4").tobytes().hex() and r["near_edited"] == (own == other).mean()
        assert r["near_next"] == (own == op10_fingerprints.fingerprint(following)).mean()


def test_fingerprints_see_order():
    rng = random.Random(6)
    text = prose(rng, 300)
    words = text.split()
    small, shuffled = " ".join([*words[:150], "new", *words[150:]]), " ".join(words[150:] + words[:150])
    near = lambda other: op10_fingerprints.likeness(op10_fingerprints.fingerprint(text), op10_fingerprints.fingerprint(other))
    assert near(text) == 1 and near(small) > 0.8 and near(shuffled) < near(small)
    numbered = op10_fingerprints.items("abababab", 2)
    assert len(set(numbered.tolist())) == 7


# -- pipeline -------------------------------------------------------------------------------------


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, rows = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SF)
        docs = docs.cache()
        rows[name] = docs.count()
        if name == "jaccard_join":
            named = components({r["doc_id"]: shingles(r["text"]) for r in before.collect()})
            assert {r["doc_id"] for r in docs.collect()} == {i for i, c in named.items() if i == c}
        if name != "packing":
            assert docs.columns == columns
    assert rows["quality_rules"] < 200 and rows["packing"] == rows["mixing"] > 0
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, awkward(spark), SF).count() > 0, name


def test_pipeline_joins_five_word_shingles_at_80_percent(spark):
    """Against brute force of its own; a text with a fifth more words goes, one with a third more stays."""
    rng, texts = random.Random(21), []
    for n in (60, 120, 200):
        base = [f"w{rng.random()}" for _ in range(n)]
        texts += [" ".join(base + [f"x{rng.random()}" for _ in range(n // k)]) for k in (n + 1, 5, 3)]
        for edits in (1, 2, 3, 5, 8):
            copy = list(base)
            for _ in range(edits):
                copy[rng.randrange(n)] = f"y{rng.random()}"
            texts.append(" ".join(copy))
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in map(str.split, texts)]
    root = list(range(len(sets)))
    for b in range(len(sets)):
        for a in range(b):
            both = len(sets[a] & sets[b])
            if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((root[a], root[b]))
                root = [low if r == high else r for r in root]
    docs = spark.createDataFrame([(i, t, "en", "s1", len(t)) for i, t in enumerate(texts)], DOCS)
    got = {r["doc_id"] for r in corpus_pipeline.jaccard_join(spark, docs, SF).collect()}
    assert got == {i for i, r in enumerate(root) if i == r}
    assert not got & {1, 9, 17} and got >= {2, 10, 18}


def test_suffixes_tell_texts_of_equal_check_sum_apart(spark):
    import random
    import zlib

    draw = random.Random(5)
    line = lambda n: "".join(draw.choice("abcdefghij klmnop") for _ in range(n))
    shared, other, seen, pair = line(450), line(480), {}, None
    for i in range(400_000):
        mine = (shared if i % 2 else other) + line(12)
        key = zlib.crc32(mine.encode()) & 0x7FFFFFFF
        before = seen.setdefault(key, mine)
        if before[:450] != mine[:450]:
            pair = before, mine
            break
    assert pair
    docs = spark.createDataFrame([(None, pair[0]), (None, pair[1]), (5, "<" + shared + ">")], "doc_id long, text string")
    assert sorted(r["n_removed"] for r in op06_suffixes.repeat_report(docs).collect()) == [0, 450, 450]


def test_signatures_come_in_lots_that_share_no_key_and_miss_none(spark):
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 2**63, 40).astype(np.uint64)) for _ in range(12)]
    df = spark.createDataFrame([(i, bytearray(x.tobytes())) for i, x in enumerate([*sets, *sets[:3]])], "id long, elements binary")
    lots = [{tuple(r) for r in op04_jaccard.signature_rows(df, 80, lot).collect()} for lot in range(op04_jaccard.LOTS)]
    want = {(int(k), i) for i, x in enumerate([*sets, *sets[:3]]) for k in op04_jaccard.signatures(x, 0, 80) >> np.uint64(8)}
    assert set().union(*lots) == want and len(lots) > 1 and all(lots)
    keys = [{k for k, _ in lot} for lot in lots]
    assert not keys[0] & keys[1]
    members = op04_jaccard.shared_signatures(*[op04_jaccard.signature_rows(df, 80, lot) for lot in range(op04_jaccard.LOTS)]).collect()
    assert {(r.id, r.weight) for r in members} == {(i, len(set(op04_jaccard.signatures(sets[i % 12], 0, 80) >> np.uint64(8)))) for i in (0, 1, 2, 12, 13, 14)}
