"""Benchmark decontamination by a broadcast set of normalised test n-grams."""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut

#: Everything but ASCII digits, ASCII letters and the bytes of other characters separates words.
_WORD = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in bytes(range(256)).lower())
_MULT = np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z only) words as UTF-8; null has none."""
    return text.encode("utf-8", "surrogatepass").translate(_WORD).split() if text else []


class WindowIndex:
    """Windows of the test items: word ids, 64-bit window hashes by length, and the exact windows behind each hash."""

    def __init__(self, items, n: int):
        self.n, self.ids, self.windows = n, {}, defaultdict(lambda: defaultdict(set))
        for item_id, text in items:
            w = words(text)
            if not w:
                continue
            k = min(n, len(w))
            for x in w:
                self.ids.setdefault(x, len(self.ids) + 1)
            for i in range(len(w) - k + 1):
                self.windows[k][tuple(w[i : i + k])].add(item_id)
        self.windows = {k: {x: tuple(v) for x, v in d.items()} for k, d in self.windows.items()}
        self.hashes = {}
        for k, d in self.windows.items():
            m = np.array([[self.ids[x] for x in window] for window in d], dtype=np.uint64).reshape(-1, k)
            h = np.zeros(len(m), np.uint64)
            for j in range(k):
                h = h * _MULT + m[:, j]
            self.hashes[k] = self._mask(h)

    @staticmethod
    def _mask(h: np.ndarray) -> np.ndarray:
        bits = max(16, int(np.ceil(np.log2(max(1, len(h))))) + 6)
        mask = np.zeros(1 << bits, bool)
        mask[h * _MULT >> np.uint64(64 - bits)] = True
        return mask

    def scan(self, w: list[bytes]) -> tuple[np.ndarray, set]:
        """Which words lie in an occurring window, and the items whose windows occur."""
        hit, items = np.zeros(len(w), bool), set()
        if not w:
            return hit, items
        get = self.ids.get
        ids = np.fromiter([get(x, 0) for x in w], np.uint64, len(w))
        zeros = np.concatenate(([0], np.cumsum(ids == 0)))
        for k, mask in self.hashes.items():
            m = len(w) - k + 1
            if m <= 0:
                continue
            at = np.flatnonzero(zeros[k:] == zeros[:m])
            if not len(at):
                continue
            h = np.zeros(len(at), np.uint64)
            for j in range(k):
                h = h * _MULT + ids[at + j]
            at = at[mask[h * _MULT >> np.uint64(65 - len(mask).bit_length())]]
            found = self.windows[k]
            for i in at.tolist():
                got = found.get(tuple(w[i : i + k]))
                if got:
                    hit[i : i + k] = True
                    items.update(got)
        return hit, items


def scan_documents(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", n: int = 13, percent: int = 5, max_items_bytes: int = 4 << 20, clean_spans: bool = False) -> DataFrame:
    """Adds n_words, n_hit, n_items, items_sha256, contaminated (and clean_text with clean_spans) to docs.

    A window is n consecutive words of an item (all of them in a shorter item); a document word inside any
    occurrence of a window is hit; contaminated means n_hit > 0 and n_hit >= percent of the words. The window set is
    broadcast: the benchmark's text is measured first, and beyond max_items_bytes (the index takes about 56 times as
    much memory, in each Python worker) the windows are joined by shuffles instead (scan_by_join, same result). Null and empty texts have no words and no hits; null items are
    skipped; an empty benchmark contaminates nothing. clean_text is the text without the hit words' spans.
    """
    spark = docs.sparkSession
    docs = docs.drop("n_words", "n_hit", "n_items", "items_sha256", "clean_text", "contaminated")
    items = benchmark.select(F.col(item_id).alias("i"), F.col(item_text).alias("t")).where("t is not null and i is not null")
    total = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    if total > max_items_bytes:
        return _verdict(scan_by_join(docs, items, text, n, clean_spans), percent)
    held = spark.sparkContext.broadcast(WindowIndex([tuple(r) for r in items.collect()], n))
    extra = [T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("n_items", T.LongType()), T.StructField("items_sha256", T.StringType())]
    if clean_spans:
        extra.append(T.StructField("clean_text", T.StringType()))
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = held.value
        for batch in batches:
            cols: list[list] = [[] for _ in extra]
            for v in batch.column(at):
                t = v.as_py()
                w = words(t)
                hit, found = index.scan(w)
                row = [len(w), int(hit.sum()), len(found), hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()]
                if clean_spans:
                    row.append(without_spans(t, hit))
                for c, x in zip(cols, row):
                    c.append(x)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(c, k) for c, k in zip(cols, kinds)]], [*batch.schema.names, *[f.name for f in extra]])

    out = docs.mapInArrow(run, T.StructType([*docs.schema.fields, *extra]))
    return _verdict(out, percent)


def _verdict(df: DataFrame, percent: int) -> DataFrame:
    return df.withColumn("contaminated", (F.col("n_hit") > 0) & (100 * F.col("n_hit") >= percent * F.col("n_words")))


def _arrow_words(texts: pd.Series) -> pd.Series:
    return pd.Series([[x.decode("utf-8", "surrogatepass") for x in words(t)] for t in texts])


def scan_by_join(docs: DataFrame, items: DataFrame, text: str, n: int, clean_spans: bool = False) -> DataFrame:
    """scan_documents for a benchmark of any size: windows meet in a shuffled join on their words, keyed by row."""
    spread = F.pandas_udf(_arrow_words, "array<string>")
    docs = cut(docs.withColumn("_row", F.expr("uuid()")), "decon")
    win = lambda w, k: F.transform(F.sequence(F.lit(1), F.size(w) - k + 1), lambda i: F.array_join(F.slice(w, i, k), " "))
    it = items.withColumn("w", spread("t")).where(F.size("w") > 0).withColumn("k", F.least(F.size("w"), F.lit(n)))
    it = it.select("i", "k", F.explode(win(F.col("w"), F.col("k"))).alias("win")).distinct()
    lengths = [r["k"] for r in it.select("k").distinct().collect()]  # n values at most
    d = docs.select("_row", spread(text).alias("w"))
    parts = [d.where(F.size("w") >= k).select("_row", F.lit(k).alias("k"), F.posexplode(win(F.col("w"), F.lit(k))).alias("pos", "win")) for k in lengths]
    if not parts:
        parts = [d.where("false").select("_row", F.lit(0).alias("k"), F.lit(0).alias("pos"), F.lit("").alias("win"))]
    hits = cut(reduce(DataFrame.unionByName, parts).join(it, ["k", "win"]).select("_row", "k", "pos", "i"), "decon")
    by_item = hits.select("_row", "i").distinct().groupBy("_row").agg(F.count("*").alias("n_items"), F.array_join(F.sort_array(F.collect_list(F.col("i").cast("string"))), ",").alias("_ids"))
    by_word = hits.select("_row", F.explode(F.sequence("pos", F.col("pos") + F.col("k") - 1)).alias("p")).distinct().groupBy("_row").agg(F.count("*").alias("n_hit"), F.sort_array(F.collect_list("p")).alias("_hits"))
    out = docs.join(by_word, "_row", "left").join(by_item, "_row", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    cols = [F.size(spread(text)).cast("long").alias("n_words"), zero("n_hit"), zero("n_items"), F.sha2(F.coalesce("_ids", F.lit("")), 256).alias("items_sha256")]
    if clean_spans:
        strip = F.pandas_udf(lambda t, h: pd.Series([without_spans(x, _flags(x, y)) for x, y in zip(t, h)]), "string")
        cols.append(strip(text, "_hits").alias("clean_text"))
    return out.select(*[c for c in docs.columns if c != "_row"], *cols)


def _flags(text: str | None, at) -> np.ndarray:
    hit = np.zeros(len(words(text)), bool)
    if at is not None:
        hit[np.asarray(at, int)] = True
    return hit


def without_spans(text: str | None, hit: np.ndarray) -> str | None:
    """The text without its hit words; what stands between two of them goes too."""
    if text is None or not hit.any():
        return text
    raw = text.encode("utf-8", "surrogatepass")
    flat = np.frombuffer(raw.translate(_WORD), np.uint8) != 0x20
    starts = np.flatnonzero(flat & ~np.concatenate(([False], flat[:-1])))
    ends = np.flatnonzero(flat & ~np.concatenate((flat[1:], [False]))) + 1
    keep, last = [], 0
    i = 0
    while i < len(hit):
        if hit[i]:
            j = i
            while j + 1 < len(hit) and hit[j + 1]:
                j += 1
            keep.append(raw[last : starts[i]])
            last = int(ends[j])
            i = j
        i += 1
    keep.append(raw[last:])
    return b"".join(keep).decode("utf-8", "surrogatepass")
