"""One text of some megabytes, and one word of a megabyte, through every operator."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from neudrift.llm.decontaminate import find_matches, hit_words
from neudrift.llm.exact_dedup import exact_duplicates
from neudrift.llm.line_dedup import dedup_lines
from neudrift.llm.packing import pack_documents
from neudrift.llm.quality import rated
from neudrift.llm.queries import PIECES, WORD_TOKENIZER, tokenizer_file
from neudrift.llm.sharding import shard_documents
from neudrift.llm.simhash import near_duplicates
from neudrift.llm.substring_dedup import dedup_passages
from neudrift.llm.token_counts import token_counts
from neudrift.llm.toxicity import FactorizationMachine, Model, score
from tests.llm.conftest import text_of
from tests.llm.test_near import fingerprint
from tests.llm.test_passages import passages_by_hand

import numpy as np


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(12)
    long = text_of(rng, 300_000)
    return {1: long, 2: "x" * 1_000_000, 3: long[1_000_000:1_000_700], 4: "é" * 400_000 + " y", 5: "\n" * 100_000}


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame([(i, t, "en") for i, t in texts.items()], "doc_id long, text string, lang string")


def test_native(docs, texts):
    got = {r.doc_id: r for r in dedup_lines(docs).select("row.doc_id", "n_lines", "kept").collect()}
    assert all(got[i].n_lines == t.count("\n") + 1 for i, t in texts.items()) and got[1].kept == texts[1]
    assert {r.keep_id for r in exact_duplicates(docs).collect()} == set(texts)
    assert {r.doc_id: r["size"] for r in shard_documents(docs, 3, 64).collect()} == {
        i: len(t.encode()) + 8 for i, t in texts.items()}


def test_near(docs, texts):
    assert {r.id: r.fp & (2**64 - 1) for r in near_duplicates(docs).collect()} == {i: fingerprint(t, 4) for i, t in texts.items()}


def test_passages(spark, docs, texts):
    got = {r.doc: (r.n_words, r.n_removed, hashlib.sha256(r.text.encode()).hexdigest()) for r in dedup_passages(docs).collect()}
    want = passages_by_hand(list(texts.items()), 20)
    assert got == {i: (n, gone, hashlib.sha256(kept.encode()).hexdigest()) for i, n, gone, kept in want}
    item = " ".join(texts[1].split()[200_000:200_030])
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    hits = {r[0]: r[1] for r in find_matches(docs, bench).select("row.doc_id", hit_words(F.col("matches"))).collect()}
    assert hits[1] >= 30 and hits[2] == hits[4] == hits[5] == 0


def test_tokens(docs, texts):
    pieces = pack_documents(docs, tokenizer_file(WORD_TOKENIZER)).collect()
    assert {r.id for r in pieces} == set(texts) and max(r.length for r in pieces) == 4096
    counts = {r.id: r.n_tokens for r in token_counts(docs, tokenizer_file(PIECES)).collect()}
    assert set(counts) == set(texts) and counts[1] > 300_000 and counts[5] == 100_001


def test_models(spark, docs, texts):
    labels = spark.createDataFrame([(i, 1, 0) for i in texts], "doc_id long, quality int, toxic int")
    got = {r.id: r.log_ppl for r in rated(docs, labels).collect()}
    assert got[5] is None and all(got[i] > 0 for i in (1, 2, 3, 4))
    model = Model(np.arange(100), FactorizationMachine(100, 2))
    assert {r.id for r in score(docs, model).collect()} == set(texts)
