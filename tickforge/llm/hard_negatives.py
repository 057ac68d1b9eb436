"""Hard negatives by exact integer scores, looked up in tables of anchors' subset sums (the Four-Russians method).

Components become integers, and a vector becomes bit planes in two's complement: a byte for each plane and each group of
eight dimensions. Of an anchor, the sums of all 256 subsets of each such group stand in a table; a candidate's byte picks
its subset, so a plane's share of the inner product is one lookup a group, and planes are shifted and added. Nothing is
rounded: the score is the inner product of the integers.

Anchors meet all candidates, in blocks: both sides are dealt to blocks by a hash of their id, and each pair of blocks is
one group of a cogrouped function that emits the best few rows of an anchor. A hot label is spread over all blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut

#: Rows of a block of anchors and of a block of candidates, on average.
ANCHORS, CANDIDATES = 1024, 4096

PAIR = "anchor_id long, other_id long, score long, positive_id long, positive_score long"


def pack(ints: np.ndarray, planes: int) -> np.ndarray:
    """Bit planes of rows of integers, the lowest first: bytes of shape (rows, planes, groups of eight dimensions)."""
    bits = (ints[:, None, :] >> np.arange(planes)[None, :, None]) & 1
    return np.packbits(bits.astype(np.uint8), axis=2, bitorder="little")


def unpack(planes: np.ndarray, dims: int) -> np.ndarray:
    """The integers of bit planes; the last plane is the sign."""
    bits = np.unpackbits(planes, axis=2, count=dims, bitorder="little").astype(np.int64)
    weights = np.int64(1) << np.arange(planes.shape[1], dtype=np.int64)
    weights[-1] = -weights[-1]
    return np.einsum("npd,p->nd", bits, weights)


def subset_sums(anchors: np.ndarray, dtype) -> np.ndarray:
    """Tables of shape (groups, 256, anchors): the sum of each subset of each eight dimensions of every anchor."""
    n, dims = anchors.shape
    groups = -(-dims // 8)
    wide = np.zeros((n, groups * 8), dtype)
    wide[:, :dims] = anchors
    wide = wide.reshape(n, groups, 8).transpose(1, 2, 0)
    out = np.zeros((groups, 256, n), dtype)
    for bit in range(8):
        out[:, 1 << bit : 2 << bit] = out[:, : 1 << bit] + wide[:, None, bit]
    return out


def scores(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Inner products (candidates, anchors): a lookup for each byte, from the sign's plane down, doubled from plane to plane."""
    n, n_planes, groups = planes.shape
    total = np.zeros((n, tables.shape[2]), tables.dtype)
    part = np.empty_like(total)
    for plane in range(n_planes - 1, -1, -1):
        np.left_shift(total, 1, out=total)
        for g in range(groups):
            np.take(tables[g], planes[:, plane, g], axis=0, out=part, mode="clip")
            if plane == n_planes - 1:
                total -= part
            else:
                total += part
    return total


class _Side:
    """Rows of a block, sorted by label and id."""

    def __init__(self, t: pa.Table, prefix: str, n_planes: int, groups: int):
        ids, labels = (t.column(prefix + c).to_numpy() for c in ("id", "label"))
        raw = t.column(prefix + "planes").combine_chunks()
        flat = np.frombuffer(b"".join(raw.to_pylist()), np.uint8).reshape(len(ids), n_planes, groups)
        self.order = np.lexsort((ids, labels))
        self.ids, self.labels, self.planes = ids[self.order], labels[self.order], flat[self.order]

    def span(self, label: int) -> tuple[int, int]:
        return tuple(np.searchsorted(self.labels, [label, label + 1]))


def _meet(left: pa.Table, right: pa.Table, n_planes: int, dims: int, best: int, rank) -> pa.Table:
    """All anchors of left with the candidates of right: rank(anchor row, ids, scores) gives what is kept of each."""
    out: list[tuple] = []
    if left.num_rows and right.num_rows:
        groups = -(-dims // 8)
        a, c = _Side(left, "a_", n_planes, groups), _Side(right, "", n_planes, groups)
        top = 1 << (n_planes - 1)
        dtype = np.int32 if dims * top * top < 1 << 31 else np.int64
        for label in np.unique(a.labels).tolist():
            i, j = a.span(label)
            tables = subset_sums(unpack(a.planes[i:j], dims), dtype)
            x, y = c.span(label)
            pick = np.arange(x, y) if best else np.concatenate([np.arange(x), np.arange(y, len(c.ids))])
            if not len(pick):
                continue
            pick = pick[np.argsort(c.ids[pick], kind="stable")]
            ids, found = c.ids[pick], scores(tables, c.planes[pick])
            for k in range(i, j):
                out.extend(rank(int(a.ids[k]), int(a.order[k]), ids, found[:, k - i]))
    cols = list(zip(*out)) if out else [[]] * 5
    return pa.table({n: pa.array(v, pa.int64()) for n, v in zip(("anchor_id", "other_id", "score", "positive_id", "positive_score"), cols)})


def _first(score: np.ndarray, n: int) -> np.ndarray:
    """Rows of the n highest scores, ties by their order."""
    if len(score) > 4 * n:
        least = np.partition(score, len(score) - n)[len(score) - n]
        rows = np.flatnonzero(score >= least)
        return rows[np.argsort(-score[rows], kind="stable")[:n]]
    return np.argsort(-score, kind="stable")[:n]


def _blocks(rows: DataFrame, mine: str, n_mine: int, other: str, n_other: int) -> DataFrame:
    """Each row in its block, once for each block of the other side."""
    d = rows.withColumn(mine, F.pmod(F.xxhash64("id", F.lit(mine)), F.lit(n_mine)))
    return d.withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_other - 1).cast("long"))))


def _best(pairs: DataFrame, keys: list[str], n: int) -> DataFrame:
    w = W.partitionBy(*keys).orderBy(F.desc("score"), "other_id")
    return pairs.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def integers(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """(id, label, ints) of (id, label, vector): floor(scale * x) of every component, of the rows that take part."""
    x = F.transform("vector", lambda v: F.floor(F.lit(float(scale)) * v.cast("double")))
    fine = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))))
    d = vectors.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & fine)
    return d.select(F.col("id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), x.alias("ints"))


def mine(vectors: DataFrame, is_anchor: Column, low: int = 30, high: int = 90, positives: int = 5, negatives: int = 10, scale: int = 256) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for vectors (id, label, vector).

    Anchors are the rows for which is_anchor, a condition on id and label, holds. An anchor's positives are the
    ``positives`` rows of its label with the highest scores; for each of them come the ``negatives`` highest rows of
    other labels with low * positive_score <= 100 * score <= high * positive_score, ranked from 1. Equal scores are
    ordered by id. Every anchor is scored with every row.

    Rows without an id, label or vector, or with a null or non-finite component, take no part. An id names one vector:
    of rows that repeat it, the least by (label, integers) counts. Missing components of shorter vectors count 0; empty
    vectors score 0. Other columns are not read; an empty table, one without anchors, and anchors without positives or
    negatives give no rows. Components so large that a score might not fit 64 bits are an error.
    """
    ints = integers(vectors, scale)
    size = ints.agg(F.max(F.size("ints")), F.max(F.greatest(F.coalesce(F.array_max("ints"), F.lit(0)), -1 - F.coalesce(F.array_min("ints"), F.lit(0)))), F.count("*")).first()
    dims, most = max(1, size[0] or 1), size[1] or 0
    n_planes = int(most).bit_length() + 1
    if dims << 2 * n_planes >= 1 << 63:
        raise ValueError(f"scores of {dims} components of up to {most} may not fit 64 bits")
    groups = -(-dims // 8)

    def to_planes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ints")
            counts, flat = np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy(zero_copy_only=False)
            wide = np.zeros((len(counts), dims), np.int64)
            wide[np.arange(dims) < counts[:, None]] = flat
            raw = pack(wide, n_planes).tobytes()
            step = n_planes * groups
            planes = pa.array([raw[k : k + step] for k in range(0, len(raw), step)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), planes], ["id", "label", "planes"])

    packed = ints.mapInArrow(to_planes, "id long, label long, planes binary")
    least = F.min(F.struct("label", "planes"))
    packed = cut(packed.groupBy("id").agg(least.alias("v")).select("id", "v.label", "v.planes"), "planes")
    anchors = packed.where(is_anchor)
    n_anchors, n_rows = anchors.count(), packed.count()
    n_a, n_c = -(-n_anchors // ANCHORS) or 1, -(-n_rows // CANDIDATES) or 1
    keys, cands = ["ab", "cb"], _blocks(packed, "cb", n_c, "ab", n_a).groupBy("ab", "cb")
    # Both sides come from one table, so the anchors' columns get names of their own.
    dealt = lambda d: _blocks(d, "ab", n_a, "cb", n_c).select(*[F.col(c).alias("a_" + c) for c in d.columns], *[F.col(c).alias(c) for c in keys]).groupBy(*keys)

    def near(key, left: pa.Table, right: pa.Table) -> pa.Table:
        def rank(anchor, row, ids, score):
            return [(anchor, int(ids[r]), int(score[r]), None, None) for r in _first(score, positives + 1) if ids[r] != anchor][:positives]

        return _meet(left, right, n_planes, dims, positives, rank)

    def hard(key, left: pa.Table, right: pa.Table) -> pa.Table:
        held = left.column("a_positives").to_pylist()

        def rank(anchor, row, ids, score):
            # In descending order, each positive's negatives start at the first score that isn't too high.
            by = np.argsort(-score, kind="stable")
            falling = -score[by].astype(np.int64)
            found = []
            for p in held[row]:
                s = p["score"]
                begin = int(np.searchsorted(falling, -(high * s // 100), "left"))
                for r in by[begin : begin + negatives].tolist():
                    if 100 * int(score[r]) < low * s:
                        break
                    found.append((anchor, int(ids[r]), int(score[r]), p["other_id"], s))
            return found

        return _meet(left, right, n_planes, dims, 0, rank)

    pairs = dealt(anchors).cogroup(cands).applyInArrow(near, PAIR)
    chosen = _best(pairs, ["anchor_id"], positives)
    chosen = chosen.groupBy("anchor_id").agg(F.collect_list(F.struct("other_id", "score")).alias("positives"))
    asked = cut(anchors.join(chosen, F.col("id") == F.col("anchor_id")).select("id", "label", "planes", "positives"), "anchors")
    pairs = dealt(asked).cogroup(cands).applyInArrow(hard, PAIR)
    out = _best(pairs, ["anchor_id", "positive_id"], negatives)
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int"), F.col("other_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
