"""Text operators against brute force, exact round trips and held-out accuracy; nulls, empty and odd input."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickforge.llm import attention_lm, common, decontaminate, language_id, line_crf, line_dedup, mixing, near_dedup, quality_rules, queries, tokens, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [None, "", " ", "\n\n", "x", "a b c a b c a b c", "The same line of a text.\nThe same line of a text.\n", "£ ü 漢字 漢字 漢字 漢字", "w " * 3000, "no-space" * 500, "a\x1fb\x85c  d\t\te", "<|endoftext|> mid <|endoftext|>"]


def docs_of(spark, texts, **more):
    return spark.createDataFrame([(i, t, more.get("lang"), more.get("source", "s"), len(t or "")) for i, t in enumerate(texts)], DOCS)


def sample(spark, sf_dir, n=200):
    return [(r["doc_id"], r["text"]) for r in common.table(spark, sf_dir, "documents").select("doc_id", "text").collect()][:n]


def test_rule_counts(spark, sf_dir):
    texts = ODD + [t for _, t in sample(spark, sf_dir)]
    got = quality_rules.judge(docs_of(spark, texts)).orderBy("doc_id").collect()
    for t, r in zip(texts, got):
        w = WORD.findall(t or "")
        wins = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        c = Counter(wins)
        again = {j for i, x in enumerate(wins) if c[x] > 1 for j in range(i, i + 3)}
        lines = [x for x in (t or "").split("\n") if WORD.search(x)]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in t or ""), len(lines) - len(set(lines)), len(again))
        assert r["base_failed"] == (len(w) < 50 or 100 * len(again) > 50 * len(w)) and not (r["base_failed"] and r["kept"])


def test_host_verdicts_shrink(spark):
    rows = [("bad", True)] * 40 + [("one", True)] + [("good", False)] * 60 + [("good", True)] + [(None, False)] * 9
    c = spark.createDataFrame(rows, "source string, failed boolean")
    v = {r["source"]: r for r in quality_rules.host_verdicts(c, "source").collect()}
    assert v["bad"]["host_rejected"] and not v["good"]["host_rejected"] and not v[None]["host_rejected"]
    assert v["one"]["shrunk_rate"] < 1.0


def test_keep_good_agrees_with_judge(spark, sf_dir):
    d = common.table(spark, sf_dir, "documents").withColumn("kept", F.lit("clash")).withColumn("_row", F.lit(1)).drop("_row")
    kept = {r["doc_id"] for r in quality_rules.keep_good(d).collect()}
    assert kept == {r["doc_id"] for r in quality_rules.judge(d).where("kept").collect()}


def brute_lines(texts):
    occ = {}
    for i, t in enumerate(texts):
        for p, x in enumerate((t or "").split("\n") if t is not None else []):
            x = x.strip(" ").lower()
            if len(x) >= line_dedup.MIN_CHARS:
                occ.setdefault(x, []).append((i, p))
    keys = list(occ)
    sets = [{x[i : i + 5] for i in range(len(x) - 4)} for x in keys]
    root = list(range(len(keys)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(keys)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both >= 0.8 * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    groups = {}
    for a, k in enumerate(keys):
        groups.setdefault(find(a), []).extend(occ[k])
    gone = {o for g in groups.values() for o in g if o != min(g)}
    return ["\n".join(x for p, x in enumerate(t.split("\n")) if (i, p) not in gone) if t is not None else None for i, t in enumerate(texts)]


@pytest.mark.parametrize("set_bytes", [64 << 20, 0])
def test_line_dedup(spark, sf_dir, monkeypatch, set_bytes):
    monkeypatch.setattr(line_dedup, "MAX_SET_BYTES", set_bytes)
    rnd = random.Random(5)
    base = [t for _, t in sample(spark, sf_dir, 40)]
    near = []
    for t in base[:15]:
        w = t.split(" ")
        w[rnd.randrange(len(w))] = "zzz"
        near.append(" ".join(w))
    texts = [x for x in ODD if x is None or len(x) < 4000] + base + near + base[:3]
    got = [r["text"] for r in line_dedup.drop_repeated_lines(docs_of(spark, texts)).orderBy("doc_id").collect()]
    assert got == brute_lines(texts)


@pytest.mark.parametrize("n", [2, 5])
def test_near_duplicates(spark, sf_dir, n):
    rnd = random.Random(6)
    base = [t for _, t in sample(spark, sf_dir, 60)]
    texts = list(ODD)
    for t in base:
        texts.append(t)
        for share in (0.01, 0.03):
            texts.append(" ".join("q" if rnd.random() < share else w for w in t.split(" ")))
    texts += base[:5] * 3
    got = near_dedup.near_duplicates(docs_of(spark, texts), n=n).orderBy("doc_id").collect()
    sets = [near_dedup.shingle_set(t, n) for t in texts]
    comp = list(range(len(texts)))

    def find(a):
        while comp[a] != a:
            a = comp[a]
        return a

    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                comp[max(x, y)] = min(x, y)
    assert [(r["n_shingles"], r["component_id"], r["kept"]) for r in got] == [(len(s), find(i), find(i) == i) for i, s in enumerate(sets)]


def test_signatures_of_repetitive_lines(spark):
    # Few distinct shingles, many repeats: the signature has all that a whole pass finds, whatever the number of repeats.
    lines = [f"{k}abc de{k} fghij kl{k}mn opq rstuvw " * n for k in range(40) for n in (30, 200)]
    texts = [lines[2 * k + e].strip() for k in range(20) for e in (0, 1)] + ["=" * 40, "=" * 400, "ab" * 90, "ab" * 700]
    d = docs_of(spark, texts)
    f = {r["id"]: sorted(r["f"]) for r in line_dedup.signatures(d, "text", "doc_id").where("w = 24").collect()}
    h = {r["doc"]: r["h1"] for r in line_dedup.lines_of(d, "text", "doc_id").collect()}
    whole = {r["id"]: sorted(r["f"]) for r in line_dedup._minima(line_dedup.lines_of(d, "text", "doc_id"), None, line_dedup.SLOTS).where("w = 24").collect()}
    assert sum(len(set(f[h[i]]) ^ set(whole[h[i]])) for i in range(len(texts)) if h[i] in f) <= 2
    got = [r["text"] for r in line_dedup.drop_repeated_lines(d).orderBy("doc_id").collect()]
    assert got == brute_lines(texts)


def alike_pairs(kind, n, rnd):
    """n pairs of lines of a kind with a similarity of 0.80 to 0.85, made by single changed characters."""
    grams = lambda x: {x[i : i + 5] for i in range(len(x) - 4)}
    word = lambda a, z: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randint(a, z)))
    out = []
    while len(out) < n:
        x = {
            "token of 60": lambda: word(60, 60), "token of 300": lambda: word(300, 300), "3 to 5 long words": lambda: " ".join(word(12, 18) for _ in range(rnd.randint(3, 5))),
            "12 to 25 words": lambda: " ".join(word(2, 9) for _ in range(rnd.randint(12, 25))), "40 to 150 words": lambda: " ".join(word(2, 9) for _ in range(rnd.randint(40, 150))),
        }[kind]()
        y, s = x, 1.0
        while s > 0.85:
            i = rnd.randrange(len(y))
            y = y[:i] + rnd.choice("0123456789") + y[i + 1 :]
            a, b = grams(x), grams(y)
            s = len(a & b) / len(a | b)
        if s >= 0.8:
            out.append((x, y))
    return out


def missed(spark, pairs):
    """Share of pairs without a common band, or dropped by the screen."""
    d = docs_of(spark, [t for p in pairs for t in p])
    lines = line_dedup.lines_of(d, "text", "doc_id")
    keys = line_dedup.signatures(d, "text", "doc_id").groupBy("id").agg(F.flatten(F.collect_list("f")).alias("keys"))
    n = F.octet_length("norm")
    cand = lines.select("doc", F.col("h1").alias("id"), "norm", F.col("norm").cast("binary").alias("bin"), line_dedup._varied(n).alias("varied"))
    full = common.cut(cand.select("doc", "id").join(keys, "id").join(line_dedup._features(cand), "id"), "sketches")
    x, y = (full.where(F.col("doc") % 2 == e).select(F.floor(F.col("doc") / 2).alias("k"), F.col("keys").alias(f"k{e}"), F.col("f").alias(f"f{e}")) for e in (0, 1))
    return 1 - x.join(y, "k").where(F.arrays_overlap("k0", "k1") & line_dedup._may(F.col("f0"), F.col("f1"))).count() / len(pairs)


@pytest.mark.parametrize("kind", ["token of 60", "token of 300", "3 to 5 long words", "12 to 25 words", "40 to 150 words"])
def test_line_candidates_are_found(spark, kind):
    assert missed(spark, alike_pairs(kind, 500, random.Random(3))) <= 0.005


@pytest.mark.parametrize("block", [1024, 32])
def test_crowded_bucket_of_many_groups(spark, monkeypatch, block):
    # Two crowded buckets that overlap: one of 150 alike pairs, the other with 60 more; nothing else links them.
    monkeypatch.setattr(common, "BLOCK", block)
    monkeypatch.setattr(common, "CHUNK", 20_000)
    rows = [(1, i) for i in range(300)] + [(2, i) for i in range(200, 420)]
    buckets = spark.createDataFrame(rows, "key long, id long")
    features = buckets.select("id", F.col("id").alias("f")).distinct()
    confirm = lambda p: common.cut(p.where("a % 2 = 0 and b = a + 1"), "links")
    links, comps = common.bucket_links(buckets, features, lambda x, y: F.abs(x - y) < 400, confirm)
    assert sorted((r["a"], r["b"]) for r in links.collect()) == [(i, i + 1) for i in range(0, 420, 2)]
    assert sorted((r["id"], r["component"]) for r in comps.collect()) == [(i, i - i % 2) for i in range(420)]


def test_near_duplicates_of_one_template(spark):
    # 80 pages of one template with a similarity of about 0.7 to each other, and one copy of each that is just alike.
    rnd = random.Random(8)
    head = [f"t{i}" for i in range(170)]
    texts = []
    for k in range(80):
        own = [f"p{k}_{i}" for i in range(35)]
        twin = list(own)
        twin[rnd.randrange(35)] = "other"
        texts += [" ".join(head + own), " ".join(head + twin)]
    got = near_dedup.near_duplicates(docs_of(spark, texts), n=2).orderBy("doc_id").collect()
    assert [r["component_id"] for r in got] == [i - i % 2 for i in range(160)]


def edited_copies(rnd, n, most):
    """Sets of about 100 hashes, each with up to ``most`` of a base's replaced, from a small stock; every tenth is the twin of the one before."""
    out = []
    for k in range(n):
        s = set(range(100))
        for x in rnd.sample(range(100), rnd.randrange(1, most)):
            s.discard(x)
            s.add(rnd.randrange(100, 4000))
        out.append(set(out[-1]) ^ {5000 + k} if k % 10 == 9 else s)
    return out


@pytest.mark.parametrize("apart", [False, True])
def test_overlap_pairs_lose_no_alike_pair(spark, apart):
    # Copies of one base; or sets that differ from the weightiest one by more than they hold.
    rnd = random.Random(5)
    sets = edited_copies(rnd, 200, 30)
    if apart:
        sets = [{1, 2, 3}] + [set(rnd.sample(range(60), 20)) if k % 4 else set(sets[-k]) | {9000} for k in range(1, 150)] + sets[:50]
    of = {i: s for i, s in enumerate(sets)}
    comp = {i: 0 if i % 3 else i for i in of}
    rows = [(key, i, 1000 - i, comp[i]) for i in of for key in ((1, 2) if i % 2 else (1,))]
    open_ = spark.createDataFrame(rows, "key long, id long, w long, comp long")
    table = spark.createDataFrame([(i, sorted(s)) for i, s in of.items()], "id long, v array<long>")
    got = {(r["a"], r["b"]) for r in common._overlap_pairs(open_, lambda ids: table.join(ids, "id"), 80).collect()}
    alike = {(i, j) for i in of for j in of if i < j and comp[i] != comp[j] and 100 * len(of[i] & of[j]) >= 80 * len(of[i] | of[j])}
    low = {(r["a"], r["b"]) for r in common.connected_components(spark.createDataFrame(sorted(got & alike), "a long, b long"), "a", "b").selectExpr("id a", "component b").collect()}
    want = {(r["a"], r["b"]) for r in common.connected_components(spark.createDataFrame(sorted(alike), "a long, b long"), "a", "b").selectExpr("id a", "component b").collect()}
    assert low == want and len(alike) > 20
    assert all(comp[i] != comp[j] for i, j in got)


def test_unlike_crowds_meet_by_size_without_an_index(spark, monkeypatch):
    # A crowd that shares one hash besides copies of a base: only the base's copies are indexed, unless many are of one size.
    rnd, sets = random.Random(6), []
    for k in range(150):
        n = rnd.randrange(20, 200)
        sets.append({1} | set(rnd.sample(range(2, 4000), n)) if k % 3 or not k else set(rnd.sample(sorted(sets[-1]), len(sets[-1]) * rnd.choice((79, 80, 81, 95)) // 100)))
    base = len(sets)
    sets += [{x + 10_000 for x in s} for s in edited_copies(rnd, 60, 30)]
    of = dict(enumerate(sets))
    open_ = spark.createDataFrame([(i // base, i, 1000 - i, i) for i in of], "key long, id long, w long, comp long")
    table = spark.createDataFrame([(i, sorted(s)) for i, s in of.items()], "id long, v array<long>")
    features = table.select("id", F.struct(F.lit(0).alias("n"), F.col("v").alias("s")).alias("f"))
    alike = {(i, j) for i in of for j in of if i < j and i // base == j // base and 100 * len(of[i] & of[j]) >= 80 * len(of[i] | of[j])}
    indexed, index = [], common._index_pairs

    def counted(group, v, percent):
        indexed.append(group.count())
        return index(group, v, percent)

    monkeypatch.setattr(common, "_index_pairs", counted)
    for few, rows in ((1000, 60), (2, len(of))):
        monkeypatch.setattr(common, "FEW", few)
        indexed.clear()
        got = {tuple(r) for r in common._overlap_pairs(open_, lambda ids: table.join(ids, "id"), 80, features, line_dedup._may, line_dedup._shared).collect()}
        assert sum(indexed) == rows
        assert alike <= got and len(alike) > 30 and {p for p in alike if p[0] < base} and (few == 2 or all(p[1] >= base or 100 * len(of[p[0]] & of[p[1]]) >= 60 * len(of[p[0]] | of[p[1]]) for p in got))


def test_screens_move_features_of_the_pairs_only(spark, monkeypatch):
    # Two of a hundred buckets are crowded: later screens read the features of their open members, not of all.
    buckets = spark.createDataFrame([(i // 4 if i < 400 else 100 + i % 2, i) for i in range(600)], "key long, id long")
    features = buckets.select("id", F.col("id").alias("f"))
    ends, cut = [], common.cut

    def counted(df, label="cut"):
        out = cut(df, label)
        if label == "ids":
            ends.append(out.count())
        return out

    monkeypatch.setattr(common, "cut", counted)
    links, _ = common.bucket_links(buckets, features, lambda x, y: F.abs(x - y) <= 2, lambda p: cut(p, "links"))
    assert len(ends) > 1 and ends[0] == 600 and max(ends[1:]) <= 200
    assert {tuple(r) for r in links.collect()} >= {(i, i + 1) for i in range(400) if i % 4 < 3}


def test_crowds_are_indexed_and_screened_in_parts(spark, monkeypatch):
    # Five crowds: pairs are those of one pass, and no written part holds more than some of the crowds or pairs.
    rnd, sets = random.Random(9), []
    for k in range(5):
        sets += [{x + 10_000 * k for x in s} for s in edited_copies(rnd, 60, 30)]
    open_ = spark.createDataFrame([(i // 60, i, 1000 - i, i) for i in range(len(sets))], "key long, id long, w long, comp long")
    table = spark.createDataFrame([(i, sorted(s)) for i, s in enumerate(sets)], "id long, v array<long>")
    pairs = lambda: {tuple(r) for r in common._overlap_pairs(open_, lambda ids: table.join(ids, "id"), 80).collect()}
    whole, held, cut = pairs(), {}, common.cut

    def counted(df, label="cut"):
        out = cut(df, label)
        held.setdefault(label, []).append(out.count())
        return out

    monkeypatch.setattr(common, "cut", counted)
    monkeypatch.setattr(common, "INDEX", 8_000)
    assert pairs() == whole and len(whole) > 20
    assert len(held["pairs"]) > 2 and max(held["differences"]) < len(sets)
    held.clear()
    monkeypatch.setattr(common, "SCREENED", 100)
    buckets = spark.createDataFrame([(i // 6, i) for i in range(240)], "key long, id long")
    features = buckets.select("id", F.col("id").alias("f"))
    links, _ = common.bucket_links(buckets, features, lambda x, y: F.abs(x - y) == 1, lambda p: cut(p, "links"))
    assert sorted(map(tuple, links.collect())) == [(i, i + 1) for i in range(240) if i % 6 < 5]
    assert held["unscreened"] == [600] and len(held["pairs"]) == 7 and max(held["pairs"][:6]) < 100


def test_members_unlike_all_of_a_crowd_meet_few(spark, monkeypatch):
    # Near copies of one text of which a tenth is changed too much to be alike any: those must not meet every copy.
    rnd = random.Random(11)
    base = [f"b{i}" for i in range(150)]
    texts = [" ".join(base)]
    for k in range(400):
        w = list(base)
        for x in rnd.sample(range(150), 9 if k % 10 == 0 else rnd.randrange(1, 4)):
            w[x] = f"o{rnd.randrange(3000)}"
        texts.append(" ".join(w))
    met = []
    confirm = near_dedup._confirm
    monkeypatch.setattr(near_dedup, "_confirm", lambda p, *a: (met.append(p.count()), confirm(p, *a))[1])
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(docs_of(spark, texts), n=2).collect()}
    sets = [near_dedup.shingle_set(t, 2) for t in texts]
    alike = [(i, j) for i in range(401) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    low = list(range(401))
    for _ in range(5):
        for i, j in sorted(alike):
            low[i] = low[j] = min(low[i], low[j])
    assert list(got.values()) == [low[i] for i in got]
    assert sum(met[2:]) < 500


def test_odd_sketch_estimates():
    rnd = np.random.RandomState(3)
    for j in (0.8, 0.9, 0.97):
        u = rnd.randint(0, 1 << 62, 2000).astype(np.uint64)
        k = int(2000 * (1 - j) / (1 + j))
        v = u.copy()
        v[:k] = rnd.randint(0, 1 << 62, k)
        a, b = near_dedup.signature(np.unique(u))[1], near_dedup.signature(np.unique(v))[1]
        x = sum(bin((int(p) ^ int(q)) & (2**64 - 1)).count("1") for p, q in zip(a, b))
        assert abs(1 + 256 / 520 * math.log(1 - 2 * x / 256) - j) < 0.12


def test_whole_set_sketches_lose_no_alike_pair(spark):
    rnd = np.random.RandomState(4)
    rows = []
    for size in (20, 150, 600, 5000):
        for j in (0.8, 0.6):
            for _ in range(100):
                k = int(size * (1 - j) / (1 + j))
                u = rnd.randint(0, 1 << 62, size).astype(np.uint64)
                v = u.copy()
                v[:k] = rnd.randint(0, 1 << 62, k)
                rows.append((size, j, near_dedup.signature(u)[2].tolist(), near_dedup.signature(v)[2].tolist()))
    d = spark.createDataFrame(rows, "n long, j double, x array<long>, y array<long>")
    got = {(r["n"], r["j"]): r["ok"] for r in d.groupBy("n", "j").agg(F.count_if(near_dedup.may_differ_by(F.col("n") * (2 / 9), "x", "y")).alias("ok")).collect()}
    assert all(got[n, 0.8] == 100 for n in (20, 150, 600, 5000)) and got[150, 0.6] == 0 and got[600, 0.6] < 20


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 101), (101, 102), (100, 102), (7, 7), (200, 150)]
    got = {r["id"]: r["component"] for r in common.connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {**{i: 0 for i in range(31)}, 100: 100, 101: 100, 102: 100, 150: 150, 200: 150}
    assert common.connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_warc_round_trip(spark, tmp_path):
    big = "WARC/1.0\r\nWARC-Type: response\r\n\r\n" + "ü" * 1000
    rows = [(1, "http://a.example/x", big), (2, None, big), (3, "http://b.example", "small"), (4, "http://b.example", "small"), (5, "u", None), (6, "bad\r\nurl", ""), (7, "z", big), (8, "http://c.example/é?q=1", "\r\n\r\n" * 600)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash"))
    path = f"file://{tmp_path}/warc"
    warc.write_archives(pages, path)
    records = warc.read_records(spark, path)
    assert records.count() == 3 * len(rows)
    stored = {r["page_id"]: bytes(r["p"]) for r in warc.assemble(records).select(F.regexp_extract("metadata.fields", r"page-id: (\d+)", 1).cast("long").alias("page_id"), F.col("main.payload").alias("p")).where("p is not null").collect()}
    got = {r["page_id"]: r for r in warc.capture_digests(warc.assemble(records)).collect()}
    for i, _, h in rows:
        raw = (h or "").encode()
        assert (got[i]["payload_bytes"], got[i]["payload_digest"]) == (len(raw), hashlib.sha1(raw).hexdigest())
        assert (got[i]["record_type"], got[i]["refers_to"]) == (("revisit", 7) if i in (1, 2) else ("response", None))
        assert i in (1, 2) or stored[i] == raw
    c = warc.assemble(records).collect()
    assert len(c) == len(rows) and all(r["n_records"] == 3 and r["request"] and r["metadata"] for r in c)


def test_mix_limits_and_edges(spark):
    rnd = random.Random(8)
    rows = [(i, " ".join("w" * rnd.randrange(0, 60)) or None, None, rnd.choice(["a", "b", "c", None]) if i % 3 else "a", 0) for i in range(400)]
    d = spark.createDataFrame(rows, DOCS).withColumn("target", F.lit("clash"))
    out = mixing.mix(d).collect()
    assert len(out) == 400 and all(0 <= r["copies"] <= 2 for r in out)
    by = {}
    for r in out:
        x = by.setdefault(r["source"], [0, r["target"], 0, r["source_size"]])
        x[0] += r["mix_size"] * r["copies"]
        x[2] += r["mix_size"]
    assert all(abs(t - g) <= 60 and s == z and t <= 2 * s + 1e-9 for g, t, s, z in by.values())
    assert abs(sum(t for _, t, _, _ in by.values()) - 1.5 * sum(s for _, _, s, _ in by.values())) < 1e-6
    assert sorted((r["doc_id"], r["copies"]) for r in out) == sorted((r["doc_id"], r["copies"]) for r in mixing.mix(d).collect())
    assert mixing.mix(d.where("false")).count() == 0


def test_token_counts(spark, sf_dir):
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    texts = ODD + ["a  b \n c d e​f", " lead", "trail ", "it's 12 3,4 don't!!  ", "\U0001f600 x"] + [t for _, t in sample(spark, sf_dir, 60)]
    d = docs_of(spark, texts).withColumn("n_tokens", F.lit("clash"))
    got = tokens.token_counts(d, P.path("byte_bpe_50k.json")).orderBy("doc_id").collect()
    for t, r in zip(texts, got):
        n = len(tok.encode(t or "", add_special_tokens=False))
        assert (r["n_tokens"], r["n_bytes"], r["over_limit"]) == (n, len((t or "").encode()), n > 512)


def test_decontamination_both_ways(spark, sf_dir):
    bench = [(1, "One two three four five six seven eight nine ten eleven twelve thirteen fourteen"), (2, "short item here"), (3, None), (4, "..."), (5, "One two three four five six seven eight nine ten eleven twelve thirteen")]
    b = spark.createDataFrame(bench, "item_id long, text string")
    texts = [*ODD, "pre ONE two-three four five six seven eight nine ten eleven twelve thirteen post", "x " * 400 + "short, ITEM here", "short item", "tail short item here", *[t for _, t in sample(spark, sf_dir, 20)]]
    d = docs_of(spark, texts).withColumn("n_hit", F.lit("clash"))
    norm = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    cols = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    by_set = sorted(map(tuple, decontaminate.scan_documents(d, b).select(cols).collect()))
    by_join = sorted(map(tuple, decontaminate.scan_documents(d, b, max_items_bytes=1).select(cols).collect()))
    want = []
    for i, t in enumerate(texts):
        w, hit, items = norm(t), set(), set()
        for item, x in bench:
            v = norm(x)
            k = min(13, len(v))
            for s in range(len(v) - k + 1 if v else 0):
                for p in range(len(w) - k + 1):
                    if w[p : p + k] == v[s : s + k]:
                        hit.update(range(p, p + k))
                        items.add(item)
        want.append((i, len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    assert by_set == want and by_join == want
    clean = {r["doc_id"]: r["clean_text"] for r in decontaminate.scan_documents(d, b, clean_spans=True).collect()}
    assert clean[len(ODD) + 3] == "tail " and clean[len(ODD) + 2] == "short item" and clean[0] is None
    assert decontaminate.scan_documents(d, b.where("false")).where("n_hit > 0").count() == 0


def test_line_crf_forward_backward():
    rnd = np.random.RandomState(0)
    u, t = rnd.randn(1, 4, 2), rnd.randn(2, 2)
    p, pairs, z = line_crf.forward_backward(u, t, np.array([4]))
    total, marg = 0.0, np.zeros((4, 2))
    for code in range(16):
        y = [(code >> i) & 1 for i in range(4)]
        s = math.exp(sum(u[0, i, y[i]] for i in range(4)) + sum(t[y[i], y[i + 1]] for i in range(3)))
        total += s
        for i in range(4):
            marg[i, y[i]] += s
    assert np.allclose(p[0], marg / total) and np.isclose(z[0], math.log(total)) and np.isclose(pairs.sum(), 3)


def test_quality_classifier_held_out(spark, sf_dir):
    sf = sf_dir.replace("sf0.001", "sf0.01")
    o = queries.op6_quality_classifier(spark, sf).join(common.table(spark, sf, "labels"), "doc_id").where("held_out").toPandas()
    assert (o["predicted"] == o["quality"]).mean() > 0.95
    m = line_crf.LineCRF()
    s = line_crf.score(docs_of(spark, ODD), m).collect()
    assert all(0 <= r["score"] <= 1 for r in s)


def test_language_id_held_out(spark, sf_dir):
    sf = sf_dir.replace("sf0.001", "sf0.01")
    o = queries.op8_language_id(spark, sf).join(common.table(spark, sf, "documents").select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (o["lang_pred"] == o["lang"]).mean() > 0.97
    d = docs_of(spark, [*ODD, "123 456", "..."], lang="en")
    model = language_id.train(d.withColumn("score", F.lit("clash")))
    got = language_id.predict(d, model).orderBy("doc_id").collect()
    assert [r["lang_pred"] for r in got if r["text"] is None or not any(map(str.isalpha, r["text"]))] == ["und"] * 6
    assert language_id.predict(d, language_id.train(d.where("false"))).where("lang_pred <> 'und'").count() == 0


def plain_model(p, ids):
    """Log probabilities of one document's ids and of word starts, place by place, from full softmaxes."""
    A = attention_lm
    logs, begin = [], []
    for t, y in enumerate(ids):
        first = max(0, t // A.STRIDE * A.STRIDE - (A.WINDOW - A.STRIDE))
        inp = [A.BOS if j == 0 else ids[j - 1] for j in range(first, t + 1)]
        x = p["E"][inp]
        soft = lambda z: np.exp(z) / np.exp(z).sum()
        heads = []
        for g in range(A.HEADS):
            key, value = slice(g * A.KEY, (g + 1) * A.KEY), slice(g * A.VALUE, (g + 1) * A.VALUE)
            q = x[-1] @ p["q"][:, key]
            a = soft(np.array([q @ (v @ p["k"][:, key]) / A.KEY**0.5 + p["r"][g, len(inp) - 1 - j] for j, v in enumerate(x)]))
            heads.append(a @ (x @ p["v"][:, value]))
        u = x[-1] + np.concatenate(heads) @ p["o"]
        h = u + np.maximum(u @ p["w1"] + p["b1"], 0) @ p["w2"]
        c = soft(h @ p["c"] + p["cb"])
        member = [soft(h @ p["m"][k] + p["mb"][k]) if k not in A.RARE_CLASSES else np.eye(A.MEMBERS)[0] for k in range(A.CLASSES)]
        full = np.concatenate([c[k] * member[k] for k in range(A.CLASSES)])
        assert abs(full.sum() - 1) < 1e-9
        logs.append(np.log(full[y]))
        begin.append(np.log(full[: A.HALF * A.MEMBERS].sum()))
    return np.array(logs), np.array(begin)


def some_table():
    r = np.random.RandomState(0)
    return attention_lm.SubwordTable(r.randint(0, 1000, 3000), 50, r.rand(3000) < 0.5)


def test_scores_agree_with_a_plain_forward_pass():
    t = some_table()
    r = np.random.RandomState(5)
    p = {k: (v + r.randn(*v.shape) * 0.2).astype(float) for k, v in attention_lm.initial(t).items()}
    docs = [np.append(t.compact[r.randint(0, 3000, n)], t.end) for n in (0, 1, 15, 16, 17, 90)]
    logs, begin = attention_lm.token_scores(p, docs)
    want = [plain_model(p, d.tolist()) for d in docs]
    assert np.allclose(logs, np.concatenate([w[0] for w in want]), atol=1e-4) and np.allclose(begin, np.concatenate([w[1] for w in want]), atol=1e-4)


def test_attention_gradients_and_windows():
    t = some_table()
    p = {k: v.astype(float) for k, v in attention_lm.initial(t).items()}
    r = np.random.RandomState(1)
    rows = t.compact[r.randint(0, 3000, (4, 33))]
    rows[0, 20:], rows[1, 0] = attention_lm.PAD, attention_lm.BOS
    g, _ = attention_lm.gradients(p, rows[:, :-1], rows[:, 1:])
    for k in p:
        i = np.unravel_index(np.argmax(np.abs(g[k])), g[k].shape)
        q = {n: v.copy() for n, v in p.items()}
        q[k][i] += 1e-5
        up = attention_lm.gradients(q, rows[:, :-1], rows[:, 1:])[1]
        q[k][i] -= 2e-5
        assert abs((up - attention_lm.gradients(q, rows[:, :-1], rows[:, 1:])[1]) / 2e-5 - g[k][i]) < 1e-5
    docs = [np.arange(n, dtype=np.int32) % 400 for n in (1, 24, 25, 100)]
    windows = attention_lm.Windows(docs)
    target = windows[:][1]
    for i, d in enumerate(docs):
        seen = target[windows.doc == i]
        assert seen[seen != attention_lm.PAD].tolist() == d.tolist()
    # Later tokens never change the score of earlier ones.
    a = attention_lm.token_scores(attention_lm.initial(t), [docs[3]])[0]
    b = attention_lm.token_scores(attention_lm.initial(t), [np.concatenate([docs[3][:60], docs[3][:40][::-1]])])[0]
    assert np.allclose(a[:60], b[:60], atol=1e-4)


def test_training_takes_every_subword_once(monkeypatch):
    P = pytest.importorskip("public_tokenizers")
    pd = pytest.importorskip("pandas")
    monkeypatch.setattr(attention_lm, "SHUFFLE", 16)
    source = attention_lm.encoder((P.path("byte_bpe_50k.tiktoken"), P.PATTERN))
    table = attention_lm.SubwordTable(np.arange(source.size)[::-1], 50, source.starts)
    enc = attention_lm.CompactEncoder(source, table)
    # Short documents, long words of many subwords, and none at all.
    texts = ["one two three " * k for k in range(1, 30)] + ["Donaudampfschifffahrtsgesellschaft " * 40, "x" * 900, "", None]
    want = Counter(i for t in texts for i in [x for w in (t or "").lower().encode().split() for x in enc[w][0]] + [table.end])
    chunks = list(attention_lm._chunks(iter([pd.DataFrame({"_text": texts})]), enc))
    seen = Counter(np.concatenate(chunks)[:, 1:].ravel().tolist())
    del seen[attention_lm.PAD]
    assert seen == want and max(map(len, chunks)) == 16
    p = attention_lm.initial(table)
    assert attention_lm.train_task(p, iter(chunks), 0)[1] == sum(map(len, chunks))
    assert attention_lm.train_task(p, iter([]), 5)[1] == 0


def test_lm_base_score(spark, sf_dir):
    P = pytest.importorskip("public_tokenizers")
    texts = ODD + [t for _, t in sample(spark, sf_dir, 80)]
    train = lambda c: F.crc32(c.cast("string").cast("binary")) % 5 != 1
    d = docs_of(spark, texts).withColumn("score", F.lit("clash"))
    out = attention_lm.score(d, train(F.col("_id")), (P.path("byte_bpe_50k.tiktoken"), P.PATTERN), rates=(0.01,), least_steps=5, head_words=50).orderBy("doc_id").collect()
    words = [WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for t in texts]
    c, ends = Counter(), 0
    for i, w in enumerate(words):
        if zlib.crc32(str(i).encode()) % 5 != 1:
            c.update(w)
            ends += 1
    n, v = sum(c.values()) + ends, len(c) + 1
    for w, r in zip(words, out):
        want = sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w) + math.log10((ends + 0.5) / (n + 0.5 * (v + 1)))
        assert abs(want - r["base_score"]) < 1e-6 and (r["n_tokens"], r["train_tokens"]) == (len(w) + 1, n)
        assert r["n_known"] == sum(c[x] > 0 for x in w) + 1 and -1e9 < r["score"] < 0
    assert attention_lm.score(d.where("false"), train(F.col("_id")), (P.path("byte_bpe_50k.tiktoken"), P.PATTERN), rates=(0.01,)).count() == 0


def test_lm_beats_word_counts_on_held_out_texts(spark):
    """On whole texts that the model never saw."""
    pytest.importorskip("public_tokenizers")
    out = queries.op9_lm_scoring(spark, "/root/testdata/sf0.01").where("held_out")
    r = out.selectExpr("sum(base_score) / sum(n_tokens) AS base", "sum(score) / sum(n_tokens) AS score").first()
    assert r["score"] > r["base"] + 0.05


def test_lm_scores_of_null_ids(spark):
    P = pytest.importorskip("public_tokenizers")
    texts = ["the cat sat on the mat", "rare words here", "other unusual sentence entirely"]
    d = spark.createDataFrame([(i if k else None, t) for k in (0, 1) for i, t in enumerate(texts)], "doc_id long, text string")
    out = attention_lm.score(d, F.col("_id").isNotNull(), (P.path("byte_bpe_50k.tiktoken"), P.PATTERN), rates=(0.01,), least_steps=2, head_words=2).collect()
    part = lambda null: sorted((r["n_tokens"], r["n_known"], round(r["base_score"], 6), round(r["score"], 4)) for r in out if (r["doc_id"] is None) == null)
    assert len(out) == 6 and part(True) == part(False)


def test_pipeline_stages(spark, sf_dir):
    import corpus_pipeline

    docs = common.table(spark, sf_dir, "documents")
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        after = common.cut(stage(spark, before, sf_dir), name)
        assert set(docs.columns) <= set(after.columns)
        x, y = ({r["doc_id"]: r["text"] for r in d.collect()} for d in (before, after))
        assert set(y) <= set(x)
        if name == "line_dedup":
            ids = sorted(x)
            want = dict(zip(ids, brute_lines([x[i] for i in ids])))
            assert all(want[i] == t for i, t in y.items()) and all(not WORD.search(want[i]) for i in set(x) - set(y))
        elif name != "mixing":
            assert all(x[i] == t for i, t in y.items())
        before = after


CLASHES = ["doc", "pos", "removed", "passes", "below", "room", "host_rejected", "failed", "id", "key", "h1", "norm", "rep", "f", "w", "n_lines", "n_removed", "size"]


def test_clashing_columns_and_empty_tables(spark, sf_dir):
    d = common.table(spark, sf_dir, "documents").limit(120)
    more = d.withColumns({c: F.lit("clash") for c in CLASHES})
    bench = common.table(spark, sf_dir, "benchmark")
    for op in (
        quality_rules.judge, quality_rules.keep_good, line_dedup.drop_repeated_lines, near_dedup.near_duplicates, mixing.mix, lambda x: decontaminate.scan_documents(x, bench),
        lambda x: decontaminate.scan_documents(x, bench, max_items_bytes=1),
    ):
        plain, odd = op(d), op(more)
        cols = [c for c in plain.columns if c not in CLASHES or c in ("n_lines", "n_removed", "failed", "host_rejected")]
        rows = lambda x: sorted(map(repr, x.select(cols).collect()))
        assert rows(plain) == rows(odd)
        assert op(more.where("false")).count() == 0


def test_warc_repeated_rows_and_null_ids(spark, tmp_path):
    big = "x" * 2000
    rows = [(1, "u", big), (1, "u", big), (2, "u", big), (2, "u", big), (None, "u", big), (None, "u", big), (None, "u", "s"), (None, "u", "s"), (3, "u", None), (3, "u", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("_k", F.lit("clash"))
    path = f"file://{tmp_path}/warc"
    warc.write_archives(pages, path)
    got = warc.capture_digests(warc.assemble(warc.read_records(spark, path))).collect()
    kinds = Counter((r["page_id"], r["record_type"], r["payload_bytes"], r["refers_to"]) for r in got)
    assert kinds == {(1, "revisit", 2000, 2): 2, (2, "response", 2000, None): 2, (None, "response", 2000, None): 2, (None, "response", 1, None): 2, (3, "response", 0, None): 2}
    empty = f"file://{tmp_path}/empty"
    warc.write_archives(pages.where("false"), empty)
    assert warc.assemble(warc.read_records(spark, empty)).count() == 0
