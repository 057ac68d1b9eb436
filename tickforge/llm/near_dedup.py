"""MinHash near-duplicates with odd sketches: banded candidates, parity-bitmap screening, exact confirmation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bucket_links, cut, drop_cut, scratch, small_or_plain, spread

#: MinHash samples: BANDS x ROWS. At a similarity of 0.8 a pair shares no band with a probability of 3e-5.
BANDS, ROWS = 26, 5
#: Longs of a parity bitmap of the samples, and of one of the whole set; 64 bits each.
ODD_LONGS, WHOLE_LONGS = 4, 8
#: Pairs whose estimated similarity lies this far below the threshold are not confirmed: over five standard deviations.
MARGIN = 0.25
#: Ids of candidates that are broadcast to look up their texts, at most; more of them are joined by a shuffle.
MAX_BROADCAST = 300_000
#: Pairs that a task confirms, where their texts are broadcast, and the tasks that one text's pairs are spread over.
PAIRS, SALTS = 5_000, 8
_BLANKS = bytes(0x20 if b in (0x20, 9, 10, 11, 12, 13) else b for b in bytes(range(256)).lower())
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_rng = np.random.RandomState(20240101)
_A = (_rng.randint(0, 1 << 62, BANDS * ROWS).astype(np.uint64) << np.uint64(1)) | np.uint64(1)
_B = _rng.randint(0, 1 << 62, BANDS * ROWS).astype(np.uint64)


def words(text: str | None) -> list[bytes]:
    """A-Z lower-cased, cut at the six ASCII blanks only."""
    return [w for w in text.encode("utf-8", "surrogatepass").translate(_BLANKS).split(b" ") if w] if text else []


def shingle_set(text: str | None, n: int) -> set:
    """Distinct n-word shingles; with fewer words the whole sequence is one; without words none."""
    w = words(text)
    if len(w) < n:
        return {tuple(w)} if w else set()
    return set(zip(*[w[i:] for i in range(n)]))


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


class _WordHashes(dict):
    def __missing__(self, w: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        h = self[w] = xxhash.xxh64_intdigest(w)
        return h


_hashes = _WordHashes()


def shingle_hashes(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles."""
    w = words(text)
    if not w:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_hashes.__getitem__, w), np.uint64, len(w))
    m = max(1, len(w) - n + 1)
    acc = np.full(m, min(n, len(w)), np.uint64)
    for j in range(min(n, len(w))):
        acc = _mix(acc * np.uint64(3) + h[j : j + m])
    return np.unique(acc)


def _parities(h: np.ndarray, longs: int) -> np.ndarray:
    """Every hash flips one of the 64 * longs bits."""
    bits = np.bincount((h % np.uint64(64 * longs)).astype(np.int64), minlength=64 * longs) & 1
    return np.packbits(bits.astype(np.uint8)).view(">u8").astype(np.uint64).view(np.int64)


def signature(u: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(band keys, odd sketch of the samples, odd sketch of the whole set) of a set of hashes."""
    low = np.full(len(_A), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(u), 4096):
        low = np.minimum(low, (u[i : i + 4096, None] * _A + _B).min(axis=0))
    low = _mix(low)
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)
    grid = low.reshape(BANDS, ROWS)
    for r in range(ROWS):
        keys = _mix(keys * np.uint64(5) + grid[:, r])
    # Samples are tagged with their numbers; equal samples of two sets cancel in the XOR.
    return keys.view(np.int64), _parities(_mix(low + np.arange(len(low), dtype=np.uint64) * _M1), ODD_LONGS), _parities(_mix(u), WHOLE_LONGS)


def _apart(a: str | Column, b: str | Column, longs: int) -> Column:
    """Population count of the XOR of two bitmaps."""
    return sum((F.bit_count(F.get(a, i).bitwiseXOR(F.get(b, i))) for i in range(1, longs)), F.bit_count(F.get(a, 0).bitwiseXOR(F.get(b, 0))))


def similarity_estimate(a: str, b: str) -> Column:
    """Similarity by the population count of the XOR of two odd sketches."""
    n, k = 64 * ODD_LONGS, BANDS * ROWS
    return F.lit(1.0) + F.lit(n / (4.0 * k)) * F.log(F.greatest(F.lit(1.0) - F.lit(2.0 / n) * _apart(a, b, ODD_LONGS), F.lit(1e-9)))


def may_differ_by(m: Column, a: str | Column, b: str | Column) -> Column:
    """Whether the odd sketches of two whole sets allow that at most m hashes are in one of them only.

    m balls in n bins leave n / 2 * (1 - exp(-2m / n)) odd ones on average; five standard deviations above are allowed.
    Large differences fill the bitmap, and then nothing is ruled out.
    """
    n = 64.0 * WHOLE_LONGS
    e = F.exp(m * F.lit(-4.0 / n))
    spread = F.sqrt(F.greatest(F.lit(n / 4) * (1 - (1 + m * F.lit(4.0 / n)) * e), F.lit(0.0)))
    return _apart(a, b, WHOLE_LONGS) <= F.lit(n / 2) * (1 - F.sqrt(e)) + 5 * spread + 1


def sketches(docs: DataFrame, n: int, text: str, doc_id: str) -> DataFrame:
    """(doc_id, n_shingles, class_key, bands, odd, whole); null keys and sketches for documents without words."""

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            rows = []
            for i, t in zip(pdf["doc_id"], pdf["text"]):
                u = shingle_hashes(t if isinstance(t, str) else None, n)
                if len(u):
                    rows.append((i, len(u), xxhash.xxh128_digest(u.tobytes()), *signature(u)))
                else:
                    rows.append((i, 0, None, None, None, None))
            yield pd.DataFrame(rows, columns=["doc_id", "n_shingles", "class_key", "bands", "odd", "whole"])

    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).where("doc_id is not null")
    return d.mapInPandas(run, "doc_id long, n_shingles long, class_key binary, bands array<long>, odd array<long>, whole array<long>")


def _sets(ids: DataFrame, docs: DataFrame, n: int, text: str, doc_id: str) -> DataFrame:
    """(id, v): the shingle hashes of the documents with these ids."""

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            yield pd.DataFrame({"id": pdf["id"], "v": [shingle_hashes(t, n).view(np.int64) for t in pdf["text"]]})

    d = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    return d.join(small_or_plain(cut(ids, "ends"), MAX_BROADCAST), "id", "left_semi").dropDuplicates(["id"]).mapInPandas(run, "id long, v array<long>")


def _confirm(pairs: DataFrame, docs: DataFrame, n: int, percent: int, text: str, doc_id: str) -> DataFrame:
    """Those of the pairs (a, b) whose full shingle sets reach the similarity; only texts of candidates are moved."""
    @F.pandas_udf("boolean")
    def alike(x: pd.Series, y: pd.Series) -> pd.Series:
        # Pairs with a text in common mostly follow each other, so each side's last set is kept.
        out, s, t = [], None, None
        left, right = set(), set()
        for s1, t1 in zip(x, y):
            if s1 != s:
                s, left = s1, shingle_set(s1, n)
            if t1 != t:
                t, right = t1, shingle_set(t1, n)
            both = len(left & right)
            out.append(100 * both >= percent * (len(left) + len(right) - both))
        return pd.Series(out, dtype=bool)

    with scratch() as stay:
        ends = pairs.select(F.col("a").alias("_id")).unionByName(pairs.select(F.col("b").alias("_id"))).distinct()
        ends = small_or_plain(cut(ends, "ends"), MAX_BROADCAST)
        texts = docs.select(F.col(doc_id).cast("long").alias("_doc"), F.col(text).alias("_text")).join(ends, F.col("_doc") == F.col("_id"), "left_semi").dropDuplicates(["_doc"])
        texts = cut(texts, "texts")
        left = texts.select(F.col("_doc").alias("a"), F.col("_text").alias("ta"))
        right = texts.select(F.col("_doc").alias("b"), F.col("_text").alias("tb"))
        pairs = spread(pairs, PAIRS, "a", F.pmod(F.xxhash64("b"), F.lit(SALTS))).sortWithinPartitions("a", "b")
        links = cut(pairs.join(left, "a").join(right, "b").where(alike("ta", "tb")).select("a", "b"), "links")
        stay.append(links)
    return links


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept (doc_id = component_id).

    Documents are linked if their sets of n-word shingles share at least percent % of their union; component_id is
    the smallest id reachable. Documents with equal sets form one class and are compared once. Classes that share a
    band bucket are compared by bucket_links: a large group of near copies costs a few comparisons per member, and no
    pair that shares a bucket stays open. Pairs are screened by their odd sketches, those of the samples and those of
    the whole sets, and confirmed on their full sets. Null, empty and blank texts are linked with nothing and kept;
    null ids are left out; rows that repeat an id must repeat its text. Very long texts are taken whole, equal
    similarities decide nothing, an empty table gives an empty result, and other columns are not read.
    """
    with scratch() as stay:
        feats = cut(sketches(docs, n, text, doc_id), "sketches")
        first = [F.first(c).alias(c) for c in ("n_shingles", "bands", "odd", "whole")]
        classes = cut(feats.where("class_key is not null").groupBy("class_key").agg(F.min("doc_id").alias("rep"), *first), "classes")
        slim = cut(feats.select("doc_id", "n_shingles", "class_key"), "classes")
        drop_cut(feats)
        # A set of fewer than 100 * (1 - s) / s shingles, rounded up, has no similar set but itself.
        least = -(-percent // (100 - percent)) if percent < 100 else 1 << 60
        live = classes.where(F.col("n_shingles") >= least)
        buckets = live.select(F.explode("bands").alias("key"), F.col("rep").alias("id"))
        features = live.select(F.col("rep").alias("id"), F.struct("n_shingles", "odd", "whole").alias("f"))
        _, comps = bucket_links(buckets, features, lambda x, y: _may(x, y, percent), lambda p: _confirm(p, docs, n, percent, text, doc_id), lambda ids: _sets(ids, docs, n, text, doc_id), percent)
        home = classes.select(F.col("class_key").alias("_k"), "rep").join(comps, F.col("rep") == F.col("id"), "left").select("_k", F.coalesce("component", "rep").alias("component_id"))
        out = slim.join(home, F.col("class_key") == F.col("_k"), "left")
        out = cut(out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")), "near")
        stay.append(out)
    return out.withColumn("kept", F.col("doc_id") == F.col("component_id"))


def _may(x: Column, y: Column, percent: int) -> Column:
    """Whether sizes allow the similarity and odd sketches don't rule it out; x, y: structs (n_shingles, odd, whole)."""
    fits = 100 * F.least(x["n_shingles"], y["n_shingles"]) >= percent * F.greatest(x["n_shingles"], y["n_shingles"])
    differ = F.lit((100 - percent) / (100 + percent)) * (x["n_shingles"] + y["n_shingles"])
    return fits & (similarity_estimate(x["odd"], y["odd"]) >= percent / 100 - MARGIN) & may_differ_by(differ, x["whole"], y["whole"])
