import hashlib
import pathlib
import random
import time

import numpy as np
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

import public_tokenizers
from neudrift.llm import byte_bpe
from neudrift.llm.byte_bpe import (
    character_classes, decode, encode, frequent, merged, merged_with_heap, piece_starts, rank_of, read_ranks,
)
from neudrift.llm.common import settle_last
from neudrift.llm.queries import op12_byte_bpe
from neudrift.llm.words import text_bytes
from neudrift.session import workspace

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
MARKS = "aAzst re ve ll m d'' \t\n\r\x0b\x1c\x85  　 09½²٣.,!<|>-_ñÑß日本éİ\U0001f600\U00020000͸ʰ"


@pytest.fixture(scope="module")
def ranks():
    return read_ranks(PATH)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts(n=4000):
    rng = random.Random(3)
    fixed = ["", " ", "  ", "'", "''s", "'s", " 's", "  's", "\n's", "a's't", "don't we'll I'm they've 'RE 're",
             "x\n\ny", "x \n y", "end  ", "'ll", "'l l", "'r", "a b", "a   b", "1'2", "<|endoftext|>", "'", "s"]
    return fixed + ["".join(rng.choice(MARKS) for _ in range(rng.randint(0, 30))) for _ in range(n)]


def test_pieces_are_the_librarys(library):
    """Read off the library itself: with ranks of bytes alone a piece cannot be seen, so pieces are compared
    through the ids of a vocabulary in which they differ."""
    texts = odd_texts()
    data, offsets = text_bytes(pa.array(texts))
    starts = piece_starts(data, offsets, character_classes())
    ends = np.append(starts[1:], len(data))
    bounds = np.searchsorted(starts, offsets)
    raw = data.tobytes()
    for text, a, b in zip(texts, bounds, bounds[1:]):
        pieces = [raw[s:e] for s, e in zip(starts[a:b].tolist(), ends[a:b].tolist())]
        assert b"".join(pieces).decode() == text
        single = [library.encode_single_token(p) if p in library._mergeable_ranks else None for p in pieces]
        ids = [i for p, one in zip(pieces, single)
               for i in ([one] if one is not None else library._core_bpe.encode_single_piece(p))]
        assert ids == library.encode_ordinary(text), repr(text)


def test_merges_are_the_librarys(spark, ranks, library):
    rng = random.Random(8)
    alphabet = ["a", "b", "e", "in", "ing", "the", "er", "-", "=", " ", "é", "日", "z", "q", "x", "0"]
    pieces = {"".join(rng.choice(alphabet) for _ in range(rng.randint(2, 40))).encode() for _ in range(1500)}
    pieces |= {b"aa", b"a" * 256, b" " * 200, b"-" * 77, b"ab" * 100, bytes(range(128, 256)), b"\xff\xfe"}
    pieces = sorted(p for p in pieces if 2 <= len(p) <= byte_bpe.FOLDED)
    want = [library._core_bpe.encode_single_piece(p) for p in pieces]
    assert [merged_with_heap(p, ranks) for p in pieces] == want
    frame = spark.createDataFrame([(k, p.decode("latin-1")) for k, p in enumerate(pieces)], "k int, p string")
    found = frame.select("k", merged(F.col("p"), rank_of(ranks)).alias("ids")).collect()
    assert [r.ids for r in sorted(found)] == want


def test_every_token_is_merged_to_itself(ranks):
    assert all(merged_with_heap(token, ranks) == [rank] for token, rank in ranks.items())


def test_long_pieces(ranks, library):
    rng = random.Random(4)
    for piece in (b"a" * 200_000, bytes(rng.choice(b"abcdefgh=-") for _ in range(100_000)), b"ab" * 50_000):
        assert merged_with_heap(piece, ranks) == library._core_bpe.encode_single_piece(piece)


@pytest.mark.parametrize("known", [0, 40, 1_500_000])
def test_texts(spark, library, odd_docs, odd_rows, known):
    """Nulls, empty, very long and repeated texts, rows without an id, columns with clashing names."""
    texts = odd_texts(300) + ["x" * 70_000, "word " * 40_000, "=" * 3_000 + " end"]
    docs = odd_docs.select("doc_id", "text", "row", "id", "key", "at").unionByName(spark.createDataFrame(
        [(1000 + k, t, "r", k, "k", "a") for k, t in enumerate(texts)],
        odd_docs.select("doc_id", "text", "row", "id", "key", "at").schema).repartition(3))
    found = encode(docs, PATH, known=known, decoded=True).collect()
    apart = decode(encode(docs, PATH, known=known), PATH).collect() if known == 40 else found
    assert sorted(apart, key=str) == sorted(found, key=str)
    want = sorted(((i, library.encode_ordinary(t or "")) for i, t in
                   odd_rows + [(1000 + k, t) for k, t in enumerate(texts)]), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    got = sorted(((r.id, np.frombuffer(r.ids, "<u4").tolist()) for r in found), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    assert got == want
    assert all(r.n_tokens == len(r.ids) // 4 for r in found)
    assert all(bytes(r.decoded) == library.decode_bytes(np.frombuffer(r.ids, "<u4").tolist()) for r in found)


def test_ids_of_any_type(spark, no_docs):
    docs = spark.createDataFrame([("a-1", "some text"), ("b", None)], "doc_id string, text string")
    assert sorted((r.id, r.n_tokens) for r in encode(docs, PATH).collect()) == [("a-1", 2), ("b", 0)]
    assert decode(encode(no_docs, PATH), PATH).collect() == []


def test_frequent(spark):
    counts = spark.createDataFrame([(f"p{k}", k) for k in range(1, 3001)], "piece string, n long")
    for most in (0, 1, 10, 1500, 2990, 3000, 9999):
        kept = {int(r.piece[1:]) for r in frequent(counts, most).collect()}
        assert len(kept) <= most and kept == set(range(3001 - len(kept), 3001))
        assert most < 3000 or len(kept) == 3000
        assert len(kept) >= min(most, 3000) * 0.9 - 200


def test_table_between_is_small(spark):
    """Words that occur once: neither their counts nor a list of ids for each are kept."""
    rng = random.Random(6)
    words = list({"".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(40_000)})
    texts = [" ".join(words[k:k + 500]) for k in range(0, len(words), 500)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(2)
    workspace(spark)

    def stored():
        folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")
        return {file: file.stat().st_size for file in pathlib.Path(folder).rglob("part-*")}

    before = stored()
    found = encode(docs, PATH)
    added = sum(size for file, size in stored().items() if file not in before)
    assert found.agg(F.sum("n_tokens")).first()[0] > len(words)
    assert added < 2 * sum(map(len, texts))


def test_shuffle_files_go(spark):
    def shuffles():
        blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
        return {name for name in (str(blocks.apply(k)) for k in range(blocks.size())) if name.startswith("shuffle")}

    before = shuffles()
    counted = settle_last(lambda: spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    for _ in range(50):  # Spark deletes in the background
        if not shuffles() - before:
            break
        time.sleep(0.2)
    assert not shuffles() - before
    assert sorted(r["count"] for r in counted.collect()) == [142] + [143] * 6


def test_query(spark, library):
    sf_dir = "/root/testdata/sf0.001"
    found = {r.doc_id: r for r in op12_byte_bpe(spark, sf_dir).collect()}
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert len(found) == len(rows)
    for row in rows:
        ids = library.encode_ordinary(row.text or "")
        got = found[row.doc_id]
        assert (got.n_tokens, got.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert got.decoded_sha256 == hashlib.sha256((row.text or "").encode()).hexdigest()
