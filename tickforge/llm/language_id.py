"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams, fitted by FTRL."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Buckets that character n-grams are hashed into, and the n-gram lengths.
BITS, ORDERS = 16, (1, 2, 3)
DIM = 1 << BITS
#: Labelled documents that the classifier is fitted on, at most; document frequencies cover all of them.
MAX_TRAINING_DOCS = 4000
_MULT = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35))


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, counts) of the lower-cased text's n-grams; runs of ASCII non-letters count as one space."""
    raw = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    blank = (raw < 128) & ~((raw >= 97) & (raw <= 122))
    c = np.where(blank, np.uint32(32), raw)
    c = c[~(blank & np.concatenate(([False], blank[:-1])))]
    counts = np.zeros(DIM, np.int64)
    for n in ORDERS:
        if len(c) < n:
            break
        h = np.full(len(c) - n + 1, n, np.uint32)
        for j in range(n):
            h = (h ^ c[j : len(c) - n + 1 + j]) * _MULT[j % 3]
            h ^= h >> np.uint32(15)
        counts += np.bincount(h >> np.uint32(32 - BITS), minlength=DIM)
    at = np.flatnonzero(counts)
    return at, counts[at]


def has_letter(text) -> bool:
    return isinstance(text, str) and any(map(str.isalpha, text))


class FTRL:
    """Follow-the-regularised-leader (proximal) with elastic-net penalties, one weight column per class."""

    def __init__(self, classes: list[str], idf: np.ndarray, alpha: float = 0.5, beta: float = 1.0, l1: float = 1e-3, l2: float = 1e-3):
        self.classes, self.idf = classes, idf
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros((DIM, len(classes))), np.zeros((DIM, len(classes)))
        self.weights, self.temperature = None, 1.0

    def _w(self, z: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Weights in closed form: exactly 0 where the penalty wins."""
        return np.where(np.abs(z) <= self.l1, 0.0, -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def vector(self, at: np.ndarray, counts: np.ndarray) -> np.ndarray:
        x = np.log1p(counts) * self.idf[at]
        return x / (np.sqrt(x @ x) or 1.0)

    def update(self, at: np.ndarray, x: np.ndarray, y: int) -> None:
        z, n = self.z[at], self.n[at]
        w = self._w(z, n)
        p = _softmax(x @ w)
        p[y] -= 1
        g = x[:, None] * p
        step = (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha
        self.z[at] = z + g - step * w
        self.n[at] = n + g * g

    def freeze(self) -> None:
        self.weights = self._w(self.z, self.n)
        self.z = self.n = None

    def logits(self, at: np.ndarray, x: np.ndarray) -> np.ndarray:
        return x @ self.weights[at]

    def calibrate(self, logits: np.ndarray, y: np.ndarray) -> None:
        """The temperature with the least log loss, labels smoothed by 0.001, on documents that were not learned from."""
        if not len(y):
            return
        grid = np.exp(np.linspace(np.log(0.02), np.log(20), 200))
        target = np.full(logits.shape, 0.001 / logits.shape[1])
        target[np.arange(len(y)), y] += 0.999
        loss = [-np.mean((target * np.log(_softmax(logits / t) + 1e-12)).sum(1)) for t in grid]
        self.temperature = float(grid[int(np.argmin(loss))])

    def predict(self, text) -> tuple[str, float]:
        """('und', 0.0) for a null text, one without a letter, or a model that has learned no language."""
        if not self.classes or not has_letter(text):
            return "und", 0.0
        at, counts = gram_counts(text)
        p = _softmax(self.logits(at, self.vector(at, counts)) / self.temperature)
        k = int(np.argmax(p))
        return self.classes[k], float(p[k])


def _softmax(a: np.ndarray) -> np.ndarray:
    e = np.exp(a - a.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def document_frequencies(docs: DataFrame, text: str) -> tuple[np.ndarray, int]:
    """How many of all docs have each bucket, and how many docs there are. Each task sends at most DIM sums."""

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df, n = np.zeros(DIM, np.int64), 0
        for pdf in it:
            for t in pdf[text]:
                if isinstance(t, str):
                    df[gram_counts(t)[0]] += 1
                    n += 1
        at = np.flatnonzero(df)
        yield pd.DataFrame({"bucket": np.append(at, -1), "n": np.append(df[at], n)})

    out, n = np.zeros(DIM), 0
    for r in docs.select(text).mapInPandas(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        if r["bucket"] < 0:
            n = r["n"]
        else:
            out[r["bucket"]] = r["n"]
    return out, n


def train(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", max_docs: int = MAX_TRAINING_DOCS, passes: int = 2) -> FTRL:
    """Fit on docs, all of which may be learned from. Rows with a null text or language are left out.

    Document frequencies are summed over all rows in Spark. The weights are fitted on at most max_docs whole
    documents, in the order of the MD5 of their ids, so reruns agree; every fifth of them only sets the temperature.
    Rows with a null id count in the frequencies only; of rows that repeat an id the least by (language, text) is fitted.
    Texts of any length are counted whole, as at most DIM numbers each. Without rows to fit the model has no language.
    """
    known = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"), F.col(lang).alias("_lang"))
    df, n = document_frequencies(known, "_text")
    ids = known.where("_id is not null").select("_id").distinct().orderBy(F.md5(F.col("_id").cast("string")), "_id").limit(max_docs)
    picked = F.broadcast(ids.select(F.col("_id").alias("_pick")))

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            got = [gram_counts(t) for t in pdf["_text"]]
            yield pd.DataFrame({"id": pdf["_id"], "lang": pdf["_lang"], "at": [a.astype(np.int32).tobytes() for a, _ in got], "n": [c.astype(np.int32).tobytes() for _, c in got]})

    rows = known.join(picked, F.col("_id") == F.col("_pick")).groupBy("_id").agg(F.min(F.struct("_lang", "_text")).alias("_r")).select("_id", "_r._text", "_r._lang")
    rows = rows.mapInPandas(run, "id long, lang string, at binary, n binary").collect()
    rows.sort(key=lambda r: ((r["id"] * 2654435761) & 0xFFFFFFFF, r["id"]))
    classes = sorted({r["lang"] for r in rows})
    model = FTRL(classes, np.log((1.0 + n) / (1.0 + df)) + 1.0)
    data = []
    for r in rows:
        at = np.frombuffer(r["at"], np.int32).astype(np.int64)
        data.append((at, model.vector(at, np.frombuffer(r["n"], np.int32)), classes.index(r["lang"])))
    learn = [d for i, d in enumerate(data) if i % 5] or data
    for _ in range(passes):
        for at, x, y in learn:
            model.update(at, x, y)
    model.freeze()
    rest = [d for i, d in enumerate(data) if not i % 5]
    if rest:
        model.calibrate(np.array([model.logits(at, x) for at, x, _ in rest]), np.array([y for *_, y in rest]))
    return model


def predict(docs: DataFrame, model: FTRL, text: str = "text") -> DataFrame:
    """Adds lang_pred and score (its calibrated probability) to every row.

    Null texts, and texts without a letter, are und; so is every text if the model has learned no language. Texts are
    read whole; repeated rows are predicted alike; columns named lang_pred and score are replaced, all others stay; an
    empty table gives an empty one.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def guess(texts: pd.Series) -> pd.DataFrame:
        m = held.value
        return pd.DataFrame([m.predict(t) for t in texts], columns=["lang_pred", "score"])

    docs = docs.drop("lang_pred", "score")
    name = "_guess" + "_" * max([0, *map(len, docs.columns)])
    return docs.withColumn(name, guess(F.col(text))).select(*docs.columns, f"{name}.lang_pred", f"{name}.score")
