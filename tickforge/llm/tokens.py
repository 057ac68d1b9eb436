"""Token counts: batched encoding in Arrow functions that return lengths only."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A space with something else on both sides ends one pre-token and starts the next, whatever stands around it.
SAFE = re.compile("(?<=[^\\s\u180e\u200b\ufeff]) (?=[^\\s\u180e\u200b\ufeff])")
#: A space that touches other white space; texts without any can be cut at every space.
UNSAFE = re.compile("^ | [\\s\u180e\u200b\ufeff]|[\\s\u180e\u200b\ufeff] | $")
#: Pieces longer than this are encoded but not remembered; the memory is emptied beyond MEMORY pieces.
LONG, MEMORY = 64, 400_000
#: Bytes of text that are encoded at a time.
BATCH_BYTES = 4 << 20

_encoders: dict = {}


class PieceCounter:
    """Counts tokens piece by piece with the tokenizer's own library and remembers short pieces.

    Cutting at SAFE places changes no token: the byte-level pre-tokenizer always starts a new pre-token at a single
    space between two non-blank characters. A text of any length is therefore encoded in small parts.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.inner: dict[str, int] = {}

    def _encode(self, pieces: list[str]) -> list[int]:
        return [len(x) for x in self.tokenizer.encode_batch(pieces, add_special_tokens=False)]

    def counts(self, texts: list[str]) -> list[int]:
        split = [(SAFE.split(t) if UNSAFE.search(t) else t.split(" ")) if t else [] for t in texts]
        heads = self._encode([p[0] if p else "" for p in split])
        inner = self.inner
        if len(inner) > MEMORY:
            inner.clear()
        fresh = set()
        for p in split:
            fresh.update(p[1:])
        new = [x for x in fresh if x not in inner]
        inner.update(zip(new, self._encode([" " + x for x in new])))
        out = [n + sum(map(inner.__getitem__, p[1:])) for n, p in zip(heads, split)]
        for x in new:
            if len(x) > LONG:
                del inner[x]
        return out


def _batches(texts: pa.Array) -> Iterator[list[str]]:
    """Slices of about BATCH_BYTES of text."""
    size, part = 0, []
    for v in texts:
        t = v.as_py() or ""
        part.append(t)
        size += len(t)
        if size >= BATCH_BYTES:
            yield part
            size, part = 0, []
    if part:
        yield part


def token_counts(docs: DataFrame, path: str, text: str = "text", limit: int = 512) -> DataFrame:
    """Adds n_bytes, n_tokens and over_limit (n_tokens > limit) to every row of docs.

    path: a tokenizers .json file with a byte-level pre-tokenizer, present on every worker. Tokens are those of the
    library without added special tokens; special strings inside a text are handled as by its default. Null and
    empty texts count 0. Nothing is truncated; columns of these names in docs are replaced.
    """
    docs = docs.drop("n_bytes", "n_tokens", "over_limit")
    i = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _encoders.get(path) or _encoders.setdefault(path, PieceCounter(path))
        for batch in batches:
            names = batch.schema.names
            counts: list[int] = []
            for part in _batches(batch.column(i)):
                counts += counter.counts(part)
            keep = [batch.column(k) for k in range(len(names)) if k != i]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(counts, pa.int64())], [*[n for n in names if n != text], "n_tokens"]
            )

    sized = docs.withColumn("n_bytes", F.coalesce(F.octet_length(text), F.lit(0)).cast("long"))
    # The text does not come back from the function, only its length does.
    schema = T.StructType([*[f for f in sized.schema if f.name != text], T.StructField("n_tokens", T.LongType())])
    return sized.mapInArrow(run, schema).withColumn("over_limit", F.col("n_tokens") > limit)
