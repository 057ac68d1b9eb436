"""Range coder round trips, files against the tokenizer's library, broken files, odd texts."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tickforge.llm import common, queries, range_coder, token_files

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [None, "", " ", "\n\n", "x", "It 's  the\tend\x0b\x0cof    it", "ΣΑΣ Ὀδυσσεύς é e ́", "a<|endoftext|>b <|startoftext|>", "£ü漢字 " * 9, "n" * 5000, "word " * 30_000, "\x00  x", "don't WON'T we'll 1234"]


@pytest.mark.parametrize("vocabulary", [3, 49408, 1 << 24])
@pytest.mark.parametrize("n", [0, 1, 17, 4097])
def test_round_trip(n, vocabulary):
    r = np.random.RandomState(n)
    for ids in (np.minimum((r.pareto(0.7, n) * 3).astype(np.int64), vocabulary - 1), r.randint(0, vocabulary, n), np.resize(r.randint(0, vocabulary, 37), n), np.full(n, vocabulary - 1)):
        blocks = list(range_coder.to_blocks(ids, vocabulary))
        lengths = np.array([k for k, _ in blocks], np.int64)
        got = range_coder.decode_blocks([c for _, c in blocks], lengths, vocabulary)
        assert (got.ravel()[:n] == ids).all() and lengths.sum() == n


def test_blocks_are_independent_and_adapt():
    r = np.random.RandomState(1)
    words = [r.randint(0, 49408, 6) for _ in range(300)]
    ids = np.concatenate([words[k] for k in np.minimum(r.pareto(1.0, 9000).astype(int), 299)])
    blocks = list(range_coder.to_blocks(ids, 49408))
    assert sum(len(c) for _, c in blocks) * 8 < 6 * len(ids)
    one = range_coder.decode_blocks([blocks[3][1]], np.array([blocks[3][0]]), 49408)
    assert (one[0] == ids[3 * range_coder.BLOCK : 4 * range_coder.BLOCK]).all()
    # Each order pays: repeated phrases cost far less than their ids' entropy, even odds cost hardly more than theirs.
    loop = list(range_coder.to_blocks(np.resize(words[0], 4096), 49408))
    assert len(loop[0][1]) * 8 < 0.2 * 4096
    assert len(next(range_coder.to_blocks(r.randint(0, 49408, 4096), 49408))[1]) * 8 < 16.8 * 4096


def test_codes_do_not_depend_on_how_far_intervals_are_looked_up(monkeypatch):
    ids = np.minimum(np.random.RandomState(2).pareto(0.5, 9000) * 30, 48999).astype(np.int32)
    whole = list(range_coder.to_blocks(ids, 49408))
    monkeypatch.setattr(range_coder, "AHEAD", 300)
    assert list(range_coder.to_blocks(ids, 49408)) == whole


def test_word_encoder_is_the_library():
    rnd, t = random.Random(4), Tokenizer.from_file(PATH)
    chars = list("abcXYZ 's\n\t'1_<|>") + ["é", "é", "Σ", "漢", " ", "​", "😀", "ﬁ", "<|endoftext|>", "ß", "İ"]
    texts = [x or "" for x in ODD] + ["".join(rnd.choice(chars) for _ in range(rnd.randint(0, 60))) for _ in range(2000)]
    ids, counts = token_files.WordEncoder(PATH).encode(pa.array(texts))
    ends = np.cumsum(counts)
    for text, e, n in zip(texts, ends, counts):
        assert ids[e - n : e].tolist() == t.encode(text, add_special_tokens=False).ids, text


def want_rows(rows):
    t, at, out = Tokenizer.from_file(PATH), 0, []
    for i, text in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


@pytest.mark.parametrize("segment", [token_files.SEGMENT, 5000])
def test_files_hold_all_ids(spark, sf_dir, tmp_path, segment):
    rows = [(r["doc_id"], r["text"]) for r in common.table(spark, sf_dir, "documents").collect()]
    rows += [(10_000 - 7 * k, x) for k, x in enumerate(ODD)]
    random.Random(1).shuffle(rows)
    d = spark.createDataFrame(rows, "doc_id long, text string").withColumn("segment", F.lit("clash")).withColumn("value", F.lit(1))
    path = f"file://{tmp_path}/out"
    token_files.write_token_files(d, path, PATH, 2, segment=segment)
    got = token_files.read_token_files(spark, path, 49408).select("doc_id", "start", "n_tokens", F.crc32("ids")).collect()
    assert sorted(map(tuple, got)) == want_rows(sorted(rows))


def test_nulls_and_repeats(spark, tmp_path):
    rows = [(None, "a b"), (None, "c"), (5, "same text"), (5, "same text"), (5, None), (-3, "first of all")]
    path = f"file://{tmp_path}/out"
    token_files.write_token_files(spark.createDataFrame(rows, "doc_id long, text string"), path, PATH, 2)
    got = token_files.read_token_files(spark, path, 49408).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == [None, None, -3, 5, 5, 5]
    assert sorted((r["doc_id"] or 0, r["n_tokens"]) for r in got) == sorted((i or 0, n) for i, _, n, _ in want_rows(rows))
    ends = np.cumsum([r["n_tokens"] for r in got])
    assert [r["start"] for r in got] == [0, *ends[:-1]]
    empty = f"file://{tmp_path}/empty"
    token_files.write_token_files(spark.createDataFrame([], "doc_id long, text string"), empty, PATH, 2)
    assert token_files.read_token_files(spark, empty, 49408).count() == 0


def test_broken_bytes_are_noticed():
    ids = np.random.RandomState(3).randint(0, 49408, 9000)
    raw = token_files.make_segment(0, 0, [1, None], np.array([4000, 5000]), ids, 49408)
    whole = token_files.Segment(memoryview(raw))
    whole.vocabulary = 49408
    names, counts, got = whole.read()
    assert names == [1, None] and counts.tolist() == [4000, 5000] and (got == ids).all()
    for at in (1, 9, token_files.HEAD.size + 3, len(raw) - 6000, len(raw) - 40):
        bad = bytearray(raw)
        bad[at] ^= 5
        with pytest.raises(ValueError):
            s = token_files.Segment(memoryview(bytes(bad)))
            s.vocabulary = 49408
            s.read()
    with pytest.raises(ValueError):
        s = token_files.Segment(memoryview(raw[:-100]))
        s.vocabulary = 49408
        s.read()


def test_query_against_the_library(spark, sf_dir):
    got = sorted(map(tuple, queries.op12_token_files(spark, sf_dir).collect()))
    assert got == want_rows(sorted((r["doc_id"], r["text"]) for r in common.table(spark, sf_dir, "documents").collect()))
