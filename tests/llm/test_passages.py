import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from neudrift.llm.decontaminate import decontaminate, find_matches, hit_words
from neudrift.llm.substring_dedup import dedup_passages
from tests.llm.conftest import WORDS, text_of, white_split

LAST = 2**63 - 1


def item_words(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def hits_by_hand(rows, items, least):
    out = []
    for i, t in rows:
        words, hit, found = item_words(t), set(), set()
        for item, own in items:
            own = item_words(own)
            k = min(least, len(own))
            grams = {tuple(own[p:p + k]) for p in range(len(own) - k + 1)} if own and item is not None else set()
            for p in range(len(words) - k + 1):
                if k and tuple(words[p:p + k]) in grams:
                    hit.update(range(p, p + k))
                    found.add(item)
        out.append((i, len(words), len(hit), tuple(sorted(found))))
    return out


@pytest.fixture(scope="module")
def items(odd_rows):
    texts = dict(odd_rows)
    own = texts[3].split()
    return [(1, " ".join(own[10:40])), (2, " ".join(own[12:22]).upper()), (2, " ".join(own[12:22])), (3, "one"),
            (4, None), (5, ""), (6, "... --"), (None, " ".join(own)), (7, texts[90][1000:1600]),
            (8, "word " * 12), (9, "nothing like it anywhere at all in these few texts here"), (10, "teak oak")]


@pytest.mark.parametrize("block_bytes", [1 << 20, 200])
def test_matches(odd_docs, odd_rows, no_docs, spark, items, block_bytes):
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = find_matches(odd_docs, bench, block_bytes=block_bytes)
    got = found.select("row.doc_id", "n_words", hit_words(F.col("matches")),
                       F.array_sort(F.array_distinct("matches.item"))).collect()
    assert Counter((a, b, c, tuple(d)) for a, b, c, d in got) == Counter(hits_by_hand(odd_rows, items, 10))
    clean = decontaminate(odd_docs, bench, block_bytes=block_bytes)
    assert clean.columns == odd_docs.columns and clean.count() == sum(1 for r in hits_by_hand(odd_rows, items, 10) if not r[3])
    assert find_matches(no_docs, bench).count() == 0
    nothing = find_matches(odd_docs, bench.limit(0))
    assert nothing.where(F.size("matches") > 0).count() == 0 and nothing.count() == len(odd_rows)


def test_one_word_over_and_over(spark):
    """A long text and a long item that repeat a word: work grows with their lengths, not with the product."""
    import time

    docs = spark.createDataFrame([(1, "word " * 200_000 + "end of it"), (2, "other words here")], "doc_id long, text string")
    bench = spark.createDataFrame([(k, "word " * (10_000 + k)) for k in range(3)] + [(9, "end of it")], "item_id long, text string")
    start = time.time()
    found = {r.doc_id: (r.hit, sorted(set(r.items))) for r in find_matches(docs, bench).select(
        "row.doc_id", hit_words(F.col("matches")).alias("hit"), F.col("matches.item").alias("items")).collect()}
    assert time.time() - start < 60
    assert found == {1: (200_003, [0, 1, 2, 9]), 2: (0, [])}


@pytest.mark.parametrize("repeats, together", [(16, 2_000_000), (0, 1), (3, 7)])
def test_hits_do_not_depend_on_repeats(spark, monkeypatch, repeats, together):
    """Words hit and items against a plain search, with passages that repeat inside items and texts."""
    from neudrift.llm import decontaminate as module

    monkeypatch.setattr(module, "REPEATS", repeats)
    monkeypatch.setattr(module, "TOGETHER", together)
    rng = random.Random(repeats)
    texts = [[rng.choice("ab" if k % 2 else "abcd") for _ in range(rng.randint(0, 80))] for k in range(30)]
    items = [[rng.choice("ab") for _ in range(rng.randint(1, 60))] for _ in range(12)] + [["a"] * 50, ["b"] * 3]
    want = {}
    for k, words in enumerate(texts):
        hit, names = set(), set()
        for j, item in enumerate(items):
            n = min(10, len(item))
            wanted = {tuple(item[i:i + n]) for i in range(len(item) - n + 1)}
            for i in range(len(words) - n + 1):
                if tuple(words[i:i + n]) in wanted:
                    hit |= set(range(i, i + n))
                    names.add(j)
        want[k] = (len(hit), sorted(names))
    shared = module.Suffixes(np.arange(len(items)), pa.array([" ".join(i) for i in items]), 10)
    counts, (text, item, start, _, length) = module.matches_in(pa.array([" ".join(t) for t in texts]), shared, 10)
    got = {k: (len({w for t, s, n in zip(text, start, length) if t == k for w in range(s, s + n)}),
               sorted({int(i) for t, i in zip(text, item) if t == k})) for k in range(len(texts))}
    assert got == want and counts.tolist() == [len(t) for t in texts]


def test_longest_matches(spark):
    rng = random.Random(2)
    words = [f"w{rng.randint(0, 10**6)}" for _ in range(100)]
    docs = spark.createDataFrame([(1, " ".join(["x"] * 5 + words[20:60] + ["y"] + words[55:70]))], "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    (row,) = find_matches(docs, bench).collect()
    assert sorted(map(tuple, row.matches)) == [(1, 5, 20, 40), (1, 46, 55, 15)]


def passages_by_hand(rows, size):
    order = lambda r: LAST if r is None else r
    seen, out = {}, []
    for n, (i, t) in enumerate(rows):
        words = white_split(t)
        for p in range(len(words) - size + 1):
            seen.setdefault(tuple(words[p:p + size]), []).append((order(i), t, p))
    for i, t in rows:
        words = white_split(t)
        gone = [False] * len(words)
        for p in range(len(words) - size + 1):
            places = seen[tuple(words[p:p + size])]
            if any(a < order(i) or (a == order(i) and b == t and q < p) for a, b, q in places):
                gone[p:p + size] = [True] * size
        out.append((i, len(words), sum(gone), b" ".join(w for w, g in zip(words, gone) if not g).decode()))
    return out


@pytest.mark.parametrize("size, block", [(20, 10), (7, 4), (20, 6)])
def test_passages(odd_docs, odd_rows, no_docs, spark, size, block):
    # Texts that share an id are ordered by a hash of them, so here each id has one text.
    once = [(i, t) for k, (i, t) in enumerate(odd_rows) if i is not None and (i != 96 or odd_rows[k - 1][0] != 96)]
    once += [(None, odd_rows[-3][1])]
    docs = spark.createDataFrame(once, "doc_id long, text string").repartition(3)
    got = dedup_passages(docs, size, block).select("doc", "n_words", "n_removed", "text").collect()
    assert Counter(map(tuple, got)) == Counter(passages_by_hand(once, size))
    if size == 20 and block == 10:
        assert dedup_passages(odd_docs).count() == len(odd_rows)
        assert dedup_passages(no_docs).count() == 0


def test_rows_that_share_an_id(spark):
    """One of two texts under one id keeps the passage, and repeated rows keep the same."""
    rng = random.Random(9)
    passage = text_of(rng, 40)
    rows = [(1, "a b c " + passage), (1, passage + " d e f"), (1, passage + " d e f")]
    got = dedup_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    removed = sorted(r.n_removed for r in got)
    assert removed in ([0, 0, 40], [0, 40, 40]) and len({(r.text, r.n_removed) for r in got}) == 2


def test_many_copies_of_a_passage(spark):
    rng = random.Random(4)
    passage = " ".join(rng.choice(WORDS) for _ in range(60))
    rows = [(k, " ".join(rng.choice(WORDS) + str(rng.random()) for _ in range(rng.randint(0, 30))) + " " + passage) for k in range(400)]
    got = {r.doc: r.n_removed for r in dedup_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect()}
    assert got == {k: 60 if k else 0 for k in range(400)}


def test_block_too_long(odd_docs):
    with pytest.raises(ValueError):
        dedup_passages(odd_docs, size=20, block=11)
