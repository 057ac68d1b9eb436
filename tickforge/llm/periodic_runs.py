"""Periodic runs of words: maximal stretches that repeat with their smallest period, found by descending common prefixes.

The suffixes of a text are sorted by prefix doubling, neighbours in that order are joined by decreasing length of their
common prefix (Kruskal's order), and each class keeps its positions sorted. Two positions that become neighbours inside
a class while their distance is at most that length seed a run: its start, its period (the distance) and its length (the
common prefix and the distance). A start from which the run can be extended to the left belongs to another seed.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A run has at least this many words, and this many periods.
MIN_LENGTH, MIN_PERIODS = 6, 4
#: Words of a run's first period and of the one after it begin alike for so many words at least: a run of period 1 has
#: MIN_LENGTH - 1, one of a longer period three times its period.
SHARED = 5
#: Bytes of text that are searched at a time; a longer text is searched alone.
SLICE_BYTES = 4 << 20

RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])


def word_codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(codes, bounds): a number for each word of the texts, equal for equal words, and where each text begins and ends."""
    lists = pc.ascii_split_whitespace(texts.fill_null(""))
    flat = lists.flatten()
    codes = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    full = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0
    counts = np.diff(lists.offsets.to_numpy())
    bounds = np.concatenate([[0], np.cumsum(counts)])
    kept = np.concatenate([[0], np.cumsum(full)])
    return codes[full], kept[bounds]


def _may_have_runs(codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Whether a text has SHARED words in a row three times, or twice at a distance of 2 at most, as any run has.

    Compared by 64-bit hashes: chance can add a text, not lose one.
    """
    n = len(codes) - SHARED + 1
    out = np.zeros(len(bounds) - 1, bool)
    if n <= 0:
        return out
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    whole = np.flatnonzero(doc[:n] == doc[SHARED - 1 :])
    mixed = np.random.RandomState(1).randint(0, 1 << 63, SHARED + 1, dtype=np.uint64) * 2 + 1
    x = codes.astype(np.uint64)
    h = doc.astype(np.uint64)[whole] * mixed[SHARED]
    for k in range(SHARED):
        y = (x[whole + k] + np.uint64(k + 1)) * mixed[k]
        h = (h ^ (y >> np.uint64(29))) * mixed[SHARED] + y
    for d in (1, 2):
        near = (h[d:] == h[:-d]) & (whole[d:] == whole[:-d] + d)
        out[doc[whole[d:][near]]] = True
    order = np.argsort(h)
    s = h[order]
    out[doc[whole[order[2:][s[2:] == s[:-2]]]]] = True
    return out


def _suffixes(codes: np.ndarray, doc: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """(order, levels): suffixes sorted within their text, and for each k the rank of every position's first 2**k words.

    Only positions whose first words occur again are sorted in the rounds that follow.
    """
    n = len(codes)
    order = np.lexsort((codes, doc))
    first = np.ones(n, bool)
    first[1:] = (codes[order[1:]] != codes[order[:-1]]) | (doc[order[1:]] != doc[order[:-1]])
    at = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = at
    shared = ~first
    shared[:-1] |= ~first[1:]
    slots, levels, span = np.flatnonzero(shared), [rank.astype(np.int32)], 1
    while len(slots):
        pos = order[slots]
        later = pos + span
        inside = later < end[pos]
        second = np.where(inside, rank[np.where(inside, later, 0)], -1)
        key = rank[pos] * (n + 1) + second + 1
        by = np.argsort(key, kind="stable")
        key, pos = key[by], pos[by]
        order[slots] = pos
        first = np.ones(len(slots), bool)
        first[1:] = key[1:] != key[:-1]
        rank[pos] = np.maximum.accumulate(np.where(first, slots, 0))
        shared = ~first
        shared[:-1] |= ~first[1:]
        slots, span = slots[shared], span * 2
        levels.append(rank.astype(np.int32))
    return order, levels


def _common(i: np.ndarray, j: np.ndarray, end: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Length of the common prefix of the suffixes at i and j of one text."""
    got = np.zeros(len(i), np.int64)
    last = np.minimum(end[i] - i, end[j] - j)
    for k in range(len(levels) - 1, -1, -1):
        fits = np.flatnonzero(got + (1 << k) <= last)
        a, b = i[fits] + got[fits], j[fits] + got[fits]
        got[fits[levels[k][a] == levels[k][b]]] += 1 << k
    return got


def _seeds(low: list[int], high: list[int], shared: list[int]) -> list[tuple[int, int, int]]:
    """(position, distance, common prefix) of positions that become neighbours in a class while the prefix spans three
    distances at least. Pairs come by decreasing prefix; the smaller class moves into the larger one."""
    owner: dict[int, list[int]] = {}
    found = []
    for i, j, n in zip(low, high, shared):
        a, b = owner.get(i) or [i], owner.get(j) or [j]
        if len(a) < len(b):
            a, b = b, a
        if len(a) == 1:
            owner[a[0]] = a
        before, left = -1, len(b)
        for x in b:
            left -= 1
            after = b[-left] if left else None
            k = bisect_left(a, x)
            # Neighbours that come from the same class were neighbours before.
            if k and a[k - 1] != before and 3 * (x - a[k - 1]) <= n:
                found.append((a[k - 1], x - a[k - 1], n))
            if k < len(a) and (after is None or a[k] < after) and 3 * (a[k] - x) <= n:
                found.append((x, a[k] - x, n))
            a.insert(k, x)
            owner[x] = a
            before = x
    return found


def find_runs(codes: np.ndarray, bounds: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """For each text its runs (start, length, period), by start and period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(len(bounds) - 1)]
    may = np.flatnonzero(_may_have_runs(codes, bounds))
    if not len(may):
        return out
    sizes = np.diff(bounds)[may]
    begin = np.concatenate([[0], np.cumsum(sizes)])
    doc = np.repeat(np.arange(len(may)), sizes)
    codes = codes[np.arange(begin[-1]) + (bounds[may] - begin[:-1])[doc]]
    end = begin[1:][doc]
    order, levels = _suffixes(codes, doc, end)
    # Neighbours with SHARED words in common have four.
    near = levels[min(2, len(levels) - 1)]
    pairs = np.flatnonzero(near[order[1:]] == near[order[:-1]])
    i, j = order[pairs], order[pairs + 1]
    same = doc[i] == doc[j]
    i, j = i[same], j[same]
    shared = _common(i, j, end, levels)
    keep = np.flatnonzero(shared >= SHARED)
    keep = keep[np.argsort(-shared[keep], kind="stable")]
    found = _seeds(i[keep].tolist(), j[keep].tolist(), shared[keep].tolist())
    if not found:
        return out
    s, p, n = np.array(found, np.int64).T
    n = n + p
    left = s > begin[:-1][doc[s]]
    more = left & (codes[np.where(left, s - 1, 0)] == codes[np.where(left, s - 1 + p, 0)])
    good = ~more & (n >= np.maximum(MIN_LENGTH, MIN_PERIODS * p))
    s, p, n = s[good], p[good], n[good]
    for k in np.lexsort((p, s)):
        d = doc[s[k]]
        out[may[d]].append((int(s[k] - begin[d]), int(n[k]), int(p[k])))
    return out


def _kept(runs: list[tuple[int, int, int]], n: int) -> np.ndarray:
    """Which of n words stay: those that no run holds after its first period."""
    change = np.zeros(n + 1, np.int64)
    for s, length, p in runs:
        change[s + p] += 1
        change[s + length] -= 1
    return np.cumsum(change[:-1]) == 0


def _slices(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about SLICE_BYTES."""
    begin, held = 0, 0
    for k, size in enumerate(sizes.tolist()):
        if held and held + size > SLICE_BYTES:
            yield begin, k
            begin, held = k, 0
        held += size
    if begin < len(sizes):
        yield begin, len(sizes)


def collapse_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds n_words, runs (start, length and period of every run, by start and period) and collapsed to each row; the
    text does not come back.

    Words are what the six ASCII white-space characters part, numbered from 0. A run is a stretch with smallest period
    p and max(6, 4 * p) words or more that no neighbouring word extends; runs may overlap. collapsed holds the words,
    joined by one space, but for those that a run holds after its first period. Null, empty and blank texts have no
    words, no runs and an empty collapsed text. Rows that repeat are treated each; rows keep their order and other
    columns, of which those named n_words, runs and collapsed are replaced. An empty table gives an empty one. A text is
    searched whole, in memory of about 200 bytes for each of its words.
    """
    docs = docs.drop("n_words", "runs", "collapsed")
    at = docs.columns.index(text)
    runs_type = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
            for a, b in _slices(sizes):
                part = batch.slice(a, b - a)
                texts = part.column(at).fill_null("")
                codes, bounds = word_codes(texts)
                found = find_runs(codes, bounds)
                collapsed = []
                for k, t in enumerate(texts.cast(pa.binary()).to_pylist()):
                    words = t.split()
                    if found[k]:
                        words = [words[x] for x in np.flatnonzero(_kept(found[k], len(words))).tolist()]
                    collapsed.append(b" ".join(words))
                rows = [[{"start": s, "length": n, "period": p} for s, n, p in r] for r in found]
                cols = [c for k, c in enumerate(part.columns) if k != at]
                names = [n for k, n in enumerate(part.schema.names) if k != at]
                more = [pa.array(np.diff(bounds), pa.int64()), pa.array(rows, runs_type), pa.array(collapsed, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays([*cols, *more], [*names, "n_words", "runs", "collapsed"])

    fields = [f for f in docs.schema if f.name != text]
    schema = T.StructType([*fields, T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())])
    return docs.mapInArrow(run, schema)


def longest_run(runs) -> F.Column:
    """The run of the greatest exact length / period; among equals the one of the smallest start, then period; null for none."""
    def order(x, y):
        a, b = x["length"] * y["period"], y["length"] * x["period"]
        return F.when(a > b, -1).when(a < b, 1).when(x["start"] < y["start"], -1).when(x["start"] > y["start"], 1).when(x["period"] < y["period"], -1).when(x["period"] > y["period"], 1).otherwise(0)

    return F.get(F.array_sort(runs, order), 0)
