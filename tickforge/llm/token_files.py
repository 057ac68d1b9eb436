"""Token ids in binary files: documents in the order of their ids, coded by range_coder in checksummed blocks.

A file is a sequence of segments, each followed by a line feed (the files are written by the text sink, which takes bytes
as they are). A segment holds whole documents, about SEGMENT ids of them (``segment``). All numbers are little-endian:

    magic "TFT1" | range, number: u32 | documents, blocks: u32 | ids: u64 | bytes of codes: u64 | crc32 of what came so far: u32
    id: i64 a document | whether its id is null: u8 a document | ids: u64 a document
    ids: u32 a block | bytes of its code: u32 | crc32 of its ids as u32: u32 | crc32 of these tables: u32
    codes of the blocks

Range and number give the order of segments whatever their files are called. Blocks start anew each, so a broken one
doesn't harm the others; reading compares all checksums.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import range_coder
from .common import small_or_plain

MAGIC = b"TFT1"
HEAD = struct.Struct("<4sIIIIQQI")
#: Ids of a segment: it ends with the document that reaches them. Segments of a file, at most.
SEGMENT, PER_FILE = 1024 * range_coder.BLOCK, 4
#: Words that are remembered with their ids, and the longest that are.
MEMORY, LONG = 200_000, 40
#: Bytes of text that are split at a time.
SLICE_BYTES = 2 << 20
#: Ids that are given back at a time, about: batches of whole documents.
BATCH = 1 << 19
#: Rows of the segments' offsets that are broadcast, at most.
MAX_SEGMENTS = 500_000

_words: dict = {}


class WordEncoder:
    """Ids of whole texts from the ids of their words, which are encoded once each by the tokenizer's library.

    Right for tokenizers that treat white space as an end of words, mark it by </w> and drop it: a word's ids don't
    depend on its neighbours. Special strings hold no white space, so they are found inside words as in whole texts.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        #: Whether an id ends a word; words of ASCII letters have one such id each, their last.
        self.ends = np.zeros(self.vocabulary, bool)
        self.ends[[i for t, i in self.tokenizer.get_vocab(with_added_tokens=False).items() if t.endswith("</w>")]] = True
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.bounds = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def _learn(self, new: list[str]) -> None:
        """Encode words that aren't known: those of letters many at a time, the others each by itself."""
        plain = [w for w in new if w.isascii() and w.isalpha()]
        other = [w for w in new if not (w.isascii() and w.isalpha())]
        lines = [" ".join(plain[k : k + 256]) for k in range(0, len(plain), 256)]
        got = [np.array(e.ids, np.int32) for e in self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)]
        flat = np.concatenate([np.zeros(0, np.int32), *got])
        last = np.flatnonzero(self.ends[flat]) + 1
        if len(last) != len(plain):
            raise ValueError("the tokenizer doesn't end every word by an id of its own")
        more = [e.ids for e in self.tokenizer.encode_batch_fast(other, add_special_tokens=False)]
        sizes = np.cumsum([len(x) for x in more], dtype=np.int64) + len(flat)
        self.known.update(zip([*plain, *other], range(len(self.bounds) - 1, len(self.bounds) - 1 + len(new))))
        self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.concatenate([last, sizes]).astype(np.int64)])
        self.ids = np.concatenate([self.ids, flat, np.array([i for x in more for i in x], np.int32)])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, counts): the ids of all texts in a row, and how many of them are each text's."""
        lists = pc.ascii_split_whitespace(texts)
        words = lists.flatten().dictionary_encode()
        names, index = words.dictionary.to_pylist(), words.indices.to_numpy(zero_copy_only=False)
        if len(self.known) > MEMORY:
            self._clear()
        known = self.known
        new = [w for w in names if w not in known]
        self._learn(new)
        at = np.fromiter(map(known.__getitem__, names), np.int64, len(names))
        for w in new:
            if len(w) > LONG:
                del known[w]
        begin, size = self.bounds[at][index], (self.bounds[at + 1] - self.bounds[at])[index]
        ends = np.cumsum(size)
        out = self.ids[np.repeat(begin - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]
        ends = np.concatenate([[0], ends])[lists.offsets.to_numpy()]
        return out, np.diff(ends)


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def make_segment(part: int, number: int, doc_ids: list, counts: np.ndarray, ids: np.ndarray, vocabulary: int) -> bytes:
    blocks = list(range_coder.to_blocks(ids, vocabulary))
    codes = b"".join(c for _, c in blocks)
    head = HEAD.pack(MAGIC, part, number, len(doc_ids), len(blocks), len(ids), len(codes), 0)[:-4]
    names, nulls = (np.array([0 if i is None else i for i in doc_ids], "<i8"), np.array([i is None for i in doc_ids], np.uint8))
    sizes = np.array([n for n, _ in blocks], "<u4")
    begin = np.cumsum(sizes, dtype=np.int64) - sizes
    sums = np.array([_crc(ids[a : a + n]) for a, n in zip(begin.tolist(), sizes.tolist())], "<u4")
    tables = b"".join([names.tobytes(), nulls.tobytes(), counts.astype("<u8").tobytes(), sizes.tobytes(), np.array([len(c) for _, c in blocks], "<u4").tobytes(), sums.tobytes()])
    return b"".join([head, struct.pack("<I", zlib.crc32(head)), tables, struct.pack("<I", zlib.crc32(tables)), codes])


class Segment:
    """What a segment says of itself; ids() decodes it."""

    def __init__(self, raw: memoryview):
        if len(raw) < HEAD.size or raw[:4] != MAGIC:
            raise ValueError("not a segment of token ids")
        _, self.part, self.number, self.n_docs, self.n_blocks, self.n_ids, self.n_bytes, crc = HEAD.unpack(raw[: HEAD.size])
        if zlib.crc32(raw[: HEAD.size - 4]) != crc:
            raise ValueError("a segment's header is broken")
        tables = self.n_docs * 17 + self.n_blocks * 12
        self.length = HEAD.size + tables + 4 + self.n_bytes
        self.raw, self.tables = raw, raw[HEAD.size : HEAD.size + tables]

    def read(self) -> tuple[list, np.ndarray, np.ndarray]:
        """(document ids, their numbers of ids, all ids)."""
        at = HEAD.size + len(self.tables)
        if len(self.raw) < self.length or zlib.crc32(self.tables) != struct.unpack("<I", self.raw[at : at + 4])[0]:
            raise ValueError(f"the tables of segment {self.part}.{self.number} are broken")
        d, b = self.n_docs, self.n_blocks
        names = np.frombuffer(self.tables[: 8 * d], "<i8").tolist()
        nulls = np.frombuffer(self.tables[8 * d : 9 * d], np.uint8)
        for k in np.flatnonzero(nulls).tolist():
            names[k] = None
        counts = np.frombuffer(self.tables[9 * d : 17 * d], "<u8").astype(np.int64)
        sizes, lengths, sums = np.frombuffer(self.tables[17 * d :], "<u4").reshape(3, b).astype(np.int64)
        ends = np.cumsum(lengths) + at + 4
        codes = [bytes(self.raw[e - n : e]) for e, n in zip(ends.tolist(), lengths.tolist())]
        rows = range_coder.decode_blocks(codes, sizes, self.vocabulary)
        for k in range(b):
            if _crc(rows[k, : sizes[k]]) != sums[k]:
                raise ValueError(f"block {k} of segment {self.part}.{self.number} is broken")
        return names, counts, rows.ravel()[: self.n_ids]

    vocabulary = 0


def _segments(content: memoryview) -> Iterator[Segment]:
    at = 0
    while at < len(content):
        s = Segment(content[at:])
        yield s
        at += s.length + 1


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int, doc_id: str = "doc_id", text: str = "text", segment: int = SEGMENT) -> None:
    """Write the ids of every text, each followed by end_id, to files under path, by ascending doc_id.

    tokenizer: a .json file of a tokenizer that drops white space, present on every worker. Rows are dealt to ranges of
    (doc_id, hash of the text), so a doc_id or null that repeats without end is spread too; null ids come first, rows
    that repeat an id are written each, by the hash of their texts. Null and empty texts are the end id alone. Texts are
    never cut short; one text of any length lies in one segment. Other columns are not read. An empty table writes files
    without segments.
    """
    d = docs.select(F.col(doc_id).cast("long").alias("_id"), F.coalesce(text, F.lit("")).alias("_text"))
    d = d.withColumn("_h", F.xxhash64("_text"))
    d = d.repartitionByRange("_id", "_h").sortWithinPartitions("_id", "_h").select("_id", "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _words.get(tokenizer) or _words.setdefault(tokenizer, WordEncoder(tokenizer))
        part, number = TaskContext.get().partitionId(), 0
        names: list = []
        counts: list[np.ndarray] = []
        parts: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal number, held
            ids = np.concatenate(parts)
            parts.clear()
            s = make_segment(part, number, names, np.concatenate(counts), ids, max(encoder.vocabulary, end_id + 1))
            number, held = number + 1, 0
            names.clear(), counts.clear()
            pa.default_memory_pool().release_unused()
            return pa.RecordBatch.from_arrays([pa.array([s], pa.binary())], ["segment"])

        for batch in batches:
            sizes = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False))
            a = 0
            while a < batch.num_rows:
                b = max(a + 1, int(np.searchsorted(sizes, (sizes[a - 1] if a else 0) + SLICE_BYTES, "right")))
                ids, n = encoder.encode(batch.column(1).slice(a, b - a))
                ids, n = np.insert(ids, np.cumsum(n), end_id), n + 1
                doc_ids, ends, done = batch.column(0).slice(a, b - a).to_pylist(), np.cumsum(n), 0
                while done < len(n):
                    before = int(ends[done - 1]) if done else 0
                    # Up to the document that fills the segment.
                    upto = min(len(n), int(np.searchsorted(ends, before + segment - held, "left")) + 1)
                    names += doc_ids[done:upto]
                    counts.append(n[done:upto])
                    parts.append(ids[before : ends[upto - 1]])
                    held += int(ends[upto - 1]) - before
                    done = upto
                    if held >= segment:
                        yield flush()
                a = b
        if names:
            yield flush()

    out = d.mapInArrow(run, "segment binary").select(F.col("segment").cast("string").alias("value"))
    out.write.option("maxRecordsPerFile", PER_FILE).text(path)


def read_token_files(spark: SparkSession, path: str, vocabulary: int) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document in the files under path: ids as little-endian u32, with the end
    id, and start, the number of ids of all documents before it. Broken headers, tables and blocks are errors."""
    files = spark.read.format("binaryFile").load(path).select("content")

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for v in batch.column(0):
                rows = [(s.part, s.number, s.n_ids) for s in _segments(memoryview(v.as_buffer()))]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["part", "number", "n_ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for v in batch.column(0):
                for s in _segments(memoryview(v.as_buffer())):
                    s.vocabulary = vocabulary
                    names, counts, ids = s.read()
                    ids, ends, a = ids.astype("<u4", copy=False), np.cumsum(counts), 0
                    while a < len(names):
                        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + BATCH, "right")))
                        pieces = [ids[e - n : e].tobytes() for e, n in zip(ends[a:b].tolist(), counts[a:b].tolist())]
                        cols = [pa.array([s.part] * (b - a), pa.int64()), pa.array([s.number] * (b - a), pa.int64()), pa.array(names[a:b], pa.int64()), pa.array((ends - counts)[a:b], pa.int64()), pa.array(counts[a:b], pa.int64()), pa.array(pieces, pa.binary())]
                        yield pa.RecordBatch.from_arrays(cols, ["part", "number", "doc_id", "inside", "n_tokens", "ids"])
                        a = b

    # Ids before a segment: those of the ranges before its own, and those before it in its range.
    index = files.mapInArrow(heads, "part long, number long, n_ids long")
    parts = index.groupBy("part").agg(F.sum("n_ids").alias("n"))
    parts = parts.withColumn("before", F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("n")).drop("n")
    inner = W.partitionBy("part").orderBy("number").rowsBetween(W.unboundedPreceding, W.currentRow)
    offsets = index.withColumn("within", F.sum("n_ids").over(inner) - F.col("n_ids")).join(parts, "part").select("part", "number", (F.col("before") + F.col("within")).alias("offset"))
    out = files.mapInArrow(run, "part long, number long, doc_id long, inside long, n_tokens long, ids binary")
    return out.join(small_or_plain(offsets, MAX_SEGMENTS), ["part", "number"]).select("doc_id", (F.col("offset") + F.col("inside")).alias("start"), "n_tokens", "ids")
