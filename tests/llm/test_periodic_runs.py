"""Periodic runs against a loop over all periods, the query against the contract word by word, and odd texts."""

import hashlib
import random
import re
import zlib

import pyarrow as pa
from pyspark.sql import functions as F

from tickforge.llm import common, periodic_runs, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(w):
    """Every maximal stretch of each period; a stretch counts if no smaller period fits it."""
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(6, 4 * q) and not any(all(w[k] == w[k + r] for k in range(i, i + length - r)) for r in range(1, q)):
                out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda x: (x[0], x[2]))


def collapse(w, runs):
    gone = {k for s, n, p in runs for k in range(s + p, s + n)}
    return " ".join(x for k, x in enumerate(w) if k not in gone)


def test_against_brute_force():
    rnd, texts = random.Random(5), []
    for _ in range(1500):
        k = rnd.choice([1, 2, 3, 5])
        w = [rnd.choice("abcdefg"[:k]) for _ in range(rnd.randint(0, 50))]
        if rnd.random() < 0.6:
            u = [rnd.choice("abcdefg"[: k + 1]) for _ in range(rnd.randint(1, 9))]
            w += u * rnd.randint(1, 8) + u[: rnd.randint(0, len(u))] + [rnd.choice("ab") for _ in range(rnd.randint(0, 6))]
        texts.append(" ".join(w))
    got = periodic_runs.find_runs(*periodic_runs.word_codes(pa.array(texts)))
    want = [brute(t.split()) for t in texts]
    assert got == want and sum(map(len, want)) > 500


def test_every_exponent_and_long_periods():
    for n, p in ((4000, 1), (4000, 999), (4001, 1000), (3999, 1000), (5000, 1250), (12_000, 7)):
        texts = pa.array([" ".join(["x", *(f"w{i % p}" for i in range(n)), "y"])])
        got = periodic_runs.find_runs(*periodic_runs.word_codes(texts))[0]
        assert got == ([(1, n, p)] if n >= max(6, 4 * p) else [])


def test_odd_rows(spark):
    rep = "a b " * 5
    rows = [(1, None, "x"), (2, "", "x"), (3, " \n\t", None), (4, rep, "x"), (4, rep, "x"), (None, rep, None), (5, "q" * 200_000 + " z" * 9, "x"), (6, "a\x1fb\x85c " * 6, "x"), (7, "so it goes", "x"), (8, ("v w x\n" * 30_000), "x")]
    d = spark.createDataFrame(rows, "doc_id long, text string, runs string").withColumn("collapsed", F.lit(1))
    got = periodic_runs.collapse_runs(d).collect()
    assert len(got) == len(rows) and set(got[0].asDict()) == {"doc_id", "n_words", "runs", "collapsed"}
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append((r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]))
    assert by[1] == by[2] == by[3] == [(0, [], "")]
    assert by[4] == [(10, [(0, 10, 2)], "a b")] * 2 and by[None] == by[4][:1]
    assert by[5] == [(10, [(1, 9, 1)], "q" * 200_000 + " z")]
    assert by[6] == [(6, [(0, 6, 1)], "a\x1fb\x85c")] and by[7] == [(3, [], "so it goes")]
    assert by[8] == [(90_000, [(0, 90_000, 3)], "v w x")]
    assert periodic_runs.collapse_runs(d.limit(0)).collect() == []


def test_longest_run_is_exact_and_breaks_ties(spark):
    rows = [([(5, 12, 3), (1, 8, 2), (0, 40, 10)],), ([(9, 7, 1), (2, 30, 7)],), ([],), ([(3, 8, 2), (3, 4 * 10**8 + 1, 10**8)],)]
    d = spark.createDataFrame(rows, "runs array<struct<start:long,length:long,period:long>>")
    got = [r["b"] and tuple(r["b"]) for r in d.select(periodic_runs.longest_run(F.col("runs")).alias("b")).collect()]
    assert got == [(0, 40, 10), (9, 7, 1), None, (3, 4 * 10**8 + 1, 10**8)]


def test_query_against_its_contract(spark, sf_dir):
    got = {r["doc_id"]: r for r in queries.op13_periodic_runs(spark, sf_dir).collect()}
    planted = 0
    for r in common.table(spark, sf_dir, "documents").collect():
        w = WORD.findall(r["text"] or "")
        h, n = zlib.crc32(str(r["doc_id"]).encode()), len(w)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[a + (i - a) % p] if i >= a else w[i] for i in range(n)]
            planted += 1
        runs = brute(w) if n <= 1500 else periodic_runs.find_runs(*periodic_runs.word_codes(pa.array([" ".join(w)])))[0]
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        best = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2])) if runs else (None,) * 3
        row = got[r["doc_id"]]
        assert (row["n_runs"], row["start"], row["length"], row["period"]) == (len(runs), *best)
        assert row["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        assert row["runs_sha256"] == sha("".join(f"{s},{m},{p}\n" for s, m, p in runs)) and row["collapsed_sha256"] == sha(collapse(w, runs))
    assert planted > 5
