"""Quality classifier: a linear-chain conditional random field over the lines of a document."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Labelled documents that the model is fitted on, at most; taken in the order of the MD5 of their ids.
MAX_TRAINING_DOCS = 4000
#: Lines of all of them, at most.
MAX_TRAINING_LINES = 400_000
#: Symbols that count as markup or noise.
SYMBOLS = frozenset("#*$%&|<>@^~=+_{}[]\\/")
N_OWN = 12


def line_features(line: str, seen: bool) -> tuple:
    """Shape of one line: no words, ids or languages, only shares and lengths."""
    n = len(line)
    if not n:
        return (0.0,) * N_OWN
    w = line.split()
    m = len(w) or 1
    letters = sum(map(str.isalpha, line))
    spaces = line.count(" ")
    upper = sum(map(str.isupper, line))
    symbols = sum(line.count(c) for c in SYMBOLS)
    marks = line.count("!") + line.count("?")
    digits = sum(line.count(c) for c in "0123456789")
    return (
        np.log1p(n) / 5, np.log1p(len(w)) / 4, min(1.0, 4 * symbols / n), min(1.0, 4 * digits / n), min(1.0, 4 * marks / n), upper / n, letters / n, min(2.0, sum(map(len, w)) / m / 8),
        len(set(w)) / m, sum(a == b for a, b in zip(w, w[1:])) / m, float(seen), spaces / n,
    )


def document_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(lines x features, line lengths): each line's own features, those of both neighbours, edges and a constant.

    A null or empty text is one empty line.
    """
    lines = (text or "").split("\n")
    seen: set[str] = set()
    own = np.empty((len(lines), N_OWN))
    for i, x in enumerate(lines):
        own[i] = line_features(x, bool(x) and x in seen)
        seen.add(x)
    zero = np.zeros((1, N_OWN))
    left, right = np.concatenate([zero, own[:-1]]), np.concatenate([own[1:], zero])
    ends = np.zeros((len(lines), 3))
    ends[0, 0] = ends[-1, 1] = 1
    ends[:, 2] = 1
    return np.concatenate([own, left, right, ends], axis=1), np.array([max(1, len(x)) for x in lines], float)


def _logsumexp(a: np.ndarray, axis: int) -> np.ndarray:
    m = a.max(axis=axis, keepdims=True)
    return (m + np.log(np.exp(a - m).sum(axis=axis, keepdims=True))).squeeze(axis)


def forward_backward(unary: np.ndarray, trans: np.ndarray, lengths: np.ndarray):
    """Marginals (docs, lines, 2), pair marginals summed over places (2, 2) and log partitions of padded sequences."""
    d, n, _ = unary.shape
    alpha, beta = np.zeros_like(unary), np.zeros_like(unary)
    alpha[:, 0] = unary[:, 0]
    for t in range(1, n):
        alpha[:, t] = unary[:, t] + _logsumexp(alpha[:, t - 1, :, None] + trans, 1)
    pairs = np.zeros((2, 2))
    z = _logsumexp(alpha[np.arange(d), lengths - 1], 1)
    for t in range(n - 2, -1, -1):
        inside = (t + 1 < lengths)[:, None]
        nxt = (unary[:, t + 1] + beta[:, t + 1])[:, None, :] + trans
        beta[:, t] = np.where(inside, _logsumexp(nxt, 2), 0)
        pair = alpha[:, t, :, None] + nxt - z[:, None, None]
        pairs += np.where(inside[:, :, None], np.exp(np.minimum(pair, 0)), 0).sum(0)
    return np.exp(np.minimum(alpha + beta - z[:, None, None], 0)), pairs, z


def _batches(order: list[int], lens: list[int], rows: int = 256, cells: int = 1 << 16) -> list[list[int]]:
    """Runs of documents in order of length: at most ``rows`` of them and ``cells`` lines when padded, or one document."""
    out: list[list[int]] = []
    for i in order:
        if not out or len(out[-1]) == rows or (len(out[-1]) + 1) * lens[i] > cells:
            out.append([])
        out[-1].append(i)
    return out


class LineCRF:
    """Two states (bad 0, good 1), linear unary scores and a transition matrix, fitted by Adam on the likelihood."""

    def __init__(self):
        k = 3 * N_OWN + 3
        self.w, self.trans, self.mean, self.scale, self.platt = np.zeros((k, 2)), np.zeros((2, 2)), np.zeros(k), np.ones(k), (1.0, 0.0)

    def _unary(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.w

    def fit(self, docs: list[np.ndarray], spans: list[np.ndarray], labels: np.ndarray, steps: int = 150, rate: float = 0.1, l2: float = 1e-3) -> LineCRF:
        """Every line of a labelled document carries the document's label. One class alone gives a constant model."""
        if not len(docs):
            return self
        flat = np.concatenate(docs)
        self.mean, self.scale = flat.mean(0), flat.std(0) + 1e-6
        self.mean[-1], self.scale[-1] = 0, 1
        order = sorted(range(len(docs)), key=lambda i: len(docs[i]))
        groups = []
        for ids in _batches(order, [len(x) for x in docs]):
            lens = np.array([len(docs[i]) for i in ids])
            x = np.zeros((len(ids), lens.max(), flat.shape[1]))
            for r, i in enumerate(ids):
                x[r, : lens[r]] = (docs[i] - self.mean) / self.scale
            mask = np.arange(lens.max()) < lens[:, None]
            y = np.eye(2)[labels[ids]][:, None, :] * mask[:, :, None]
            gold = np.zeros((2, 2))
            for r, i in enumerate(ids):
                gold[labels[i], labels[i]] += lens[r] - 1
            groups.append((x, lens, mask, y, gold))
        total = len(flat)
        state = [np.zeros_like(self.w), np.zeros_like(self.w), np.zeros_like(self.trans), np.zeros_like(self.trans)]
        for step in range(1, steps + 1):
            gw, gt = l2 * self.w, l2 * self.trans
            for x, lens, mask, y, gold in groups:
                p, pairs, _ = forward_backward(x @ self.w, self.trans, lens)
                diff = (p * mask[:, :, None] - y) / total
                gw = gw + np.tensordot(x, diff, ([0, 1], [0, 1]))
                gt = gt + (pairs - gold) / total
            for p, g, a, b in ((self.w, gw, state[0], state[1]), (self.trans, gt, state[2], state[3])):
                a *= 0.9
                a += 0.1 * g
                b *= 0.99
                b += 0.01 * g * g
                p -= rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)
        raw = np.array([self.raw(x, s) for x, s in zip(docs, spans)])
        self.platt = _platt(raw, labels)
        return self

    def raw(self, x: np.ndarray, spans: np.ndarray) -> float:
        """Log odds of the length-weighted share of good lines."""
        p, _, _ = forward_backward(self._unary(x)[None], self.trans, np.array([len(x)]))
        good = float((p[0, :, 1] * spans).sum() / spans.sum())
        return float(np.log((good + 1e-6) / (1 - good + 1e-6)))

    def score(self, text: str | None) -> float:
        a, b = self.platt
        return float(1 / (1 + np.exp(-np.clip(a * self.raw(*document_features(text)) + b, -500, 500))))


def _platt(raw: np.ndarray, y: np.ndarray, l2: float = 1e-2) -> tuple[float, float]:
    """Slope and offset of a logistic fit with Platt's softened targets, by Newton steps that are halved until they help."""
    pos, neg = y.sum(), len(y) - y.sum()
    t = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x = np.stack([raw, np.ones(len(raw))], 1)
    v = np.array([1.0, 0.0])

    def loss(v: np.ndarray) -> float:
        z = x @ v
        return float((np.logaddexp(0, z) - t * z).sum() + l2 / 2 * ((v - [1, 0]) ** 2).sum())

    now = loss(v)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ v, -30, 30)))
        g = x.T @ (p - t) + l2 * (v - [1, 0])
        h = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + l2 * np.eye(2)
        step = np.linalg.solve(h, g)
        while loss(v - step) > now and np.abs(step).max() > 1e-9:
            step = step / 2
        if np.abs(step).max() <= 1e-9:
            break
        v, now = v - step, loss(v - step)
    return float(v[0]), float(v[1])


def train(docs: DataFrame, labels: DataFrame, usable, text: str = "text", doc_id: str = "doc_id", label: str = "quality", max_docs: int = MAX_TRAINING_DOCS, max_lines: int = MAX_TRAINING_LINES) -> LineCRF:
    """Fit on at most max_docs labelled documents for which ``usable(id column)`` holds; features are computed in the tasks.

    The sample is bounded by max_docs documents and by max_lines lines of all of them, and ordered by the MD5 of the id,
    so reruns agree. All lines of a document carry its label, as no others are known: the transitions that are learned
    are those of staying. Null labels don't count, nor do documents of both labels; null ids are left out; of rows that
    repeat an id the least text is fitted; an empty table, or one without usable labels, gives a model that scores every
    text 0.5.
    """
    known = labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("_y")).where("_y in (0, 1) and _id is not null")
    one = known.where(usable(F.col("_id"))).groupBy("_id").agg(F.min("_y").alias("_y"), F.max("_y").alias("_z")).where("_y = _z").drop("_z")
    picked = one.orderBy(F.md5(F.col("_id").cast("string")), "_id").limit(max_docs)
    rows = docs.select(F.col(doc_id).alias("_doc"), F.col(text).alias("_text")).join(F.broadcast(picked), F.col("_doc") == F.col("_id"))
    rows = rows.groupBy("_doc", "_y").agg(F.min("_text").alias("_text"))
    # One task sums up the numbers of lines of max_docs documents at most, without their texts.
    sizes = rows.select(F.col("_doc").alias("_d"), F.size(F.split(F.coalesce("_text", F.lit("")), "\n")).alias("_n"))
    within = sizes.withColumn("_upto", F.sum("_n").over(W.orderBy(F.md5(F.col("_d").cast("string")), "_d"))).where(F.col("_upto") <= max_lines)
    rows = rows.join(F.broadcast(within.select("_d")), F.col("_doc") == F.col("_d")).drop("_d")

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            got = [document_features(t if isinstance(t, str) else None) for t in pdf["_text"]]
            yield pd.DataFrame({"id": pdf["_doc"], "y": pdf["_y"], "x": [x.astype(np.float32).tobytes() for x, _ in got], "s": [s.astype(np.float32).tobytes() for _, s in got]})

    got = sorted(rows.mapInPandas(run, "id long, y int, x binary, s binary").collect(), key=lambda r: r["id"])
    k = 3 * N_OWN + 3
    return LineCRF().fit([np.frombuffer(r["x"], np.float32).reshape(-1, k).astype(float) for r in got], [np.frombuffer(r["s"], np.float32).astype(float) for r in got], np.array([r["y"] for r in got], int))


def score(docs: DataFrame, model: LineCRF, text: str = "text", threshold: float = 0.7) -> DataFrame:
    """Adds score (0 to 1) and predicted (score >= threshold) to every row; whole texts, one document at a time.

    Null and empty texts are one empty line and have a score too; repeated rows score alike; other columns pass
    through, but for score and predicted, which are replaced; an empty table gives an empty result.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def quality(texts: pd.Series) -> pd.Series:
        m = held.value
        return pd.Series([m.score(t if isinstance(t, str) else None) for t in texts], dtype=float)

    return docs.withColumn("score", quality(F.col(text))).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
