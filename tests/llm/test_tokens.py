import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer, models, normalizers

from neudrift.llm.packing import LengthSums, pack_documents, plan
from neudrift.llm.queries import PIECES, WORD_TOKENIZER, tokenizer_file
from neudrift.llm.token_counts import UnigramCounter, token_counts, vocabulary
from neudrift.llm.tokens import Remembered, WordEncoder

ALPHABET = "aAbBzZ09 \t\n.,!'|<>-_ñÑßÀ÷×…“é́日Σς½²\x1c\x85 İ'"


def odd_texts(n=3000):
    rng = random.Random(1)
    fixed = ["Hello, WORLD!! it's don't I'LL", "<|endoftext|> <|startoftext|>x", "", "   ", "a--b 's 't 're's",
             "İstanbul ΟΔΟΣ", "日本語 テスト", "a\x85b c", "123 4x5 x67", "word " * 500, "x" * 300,
             "<|ENDOFTEXT|> <|endoftext|> <|EndOfText|>", "H\u0331a h\u0331a J\u030cA j\u030ca J\u030ca H\u0331A"]
    return fixed + ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_ids_are_the_tokenizers(monkeypatch):
    path = tokenizer_file(WORD_TOKENIZER)
    texts = odd_texts()
    want = [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    for remembered in (800_000, 50):  # with 50, tables begin anew again and again
        monkeypatch.setattr("neudrift.llm.tokens.REMEMBERED", remembered)
        encoder = WordEncoder(path)
        for at in range(0, len(texts), 700):
            part = texts[at:at + 700]
            ids, bounds = encoder.encode(pa.array(part))
            assert [ids[s:e].tolist() for s, e in zip(bounds, bounds[1:])] == want[at:at + 700]
    ids, bounds = encoder.encode(pa.array([None, "", None], pa.string()))
    assert len(ids) == 0 and bounds.tolist() == [0, 0, 0, 0]


def test_remembered(monkeypatch):
    """Strings are found by hash and bytes; one that shares a hash with another is not taken for it."""
    monkeypatch.setattr("neudrift.llm.tokens.REMEMBERED", 4)
    table = Remembered()

    def find(*pairs):
        names = np.frombuffer(b"".join(n for _, n in pairs), np.uint8)
        sizes = np.array([len(n) for _, n in pairs], np.int64)
        at = table.find(np.array([h for h, _ in pairs], np.uint64), names, np.cumsum(sizes) - sizes, sizes)
        return [None if k < 0 else table.ids[table.places[2][k]:table.places[2][k] + table.places[3][k]].tolist() for k in at]

    def ids(*numbers):
        return np.array(numbers, "<u4").tobytes()

    assert find((1, b"a")) == [None]
    table.add(np.array([5, 9], np.uint64), [b"five", b"nine"], [ids(1, 2), ids()])
    table.add(np.array([3, 5], np.uint64), [b"three", b"other"], [ids(7), ids(8)])
    assert find((3, b"three"), (4, b"four"), (5, b"fivx"), (9, b"nine")) == [[7], None, None, []]
    assert find((5, b"five"), (9, b"nin")) == [[1, 2], None]
    table.add(np.array([1, 2], np.uint64), [b"one", b"two"], [ids(4), ids(5, 6)])
    assert find((1, b"one"), (2, b"two"), (5, b"five")) == [[4], [5, 6], None]


def packed_well(runs, counts):
    """Every piece has one place, no sequence is overfull, and places have no gaps."""
    most = len(counts) - 1
    fill, seen = {}, Counter()
    for length, first, last, sequence, offset in runs:
        for k in range(last - first + 1):
            fill.setdefault(sequence + k, []).append((offset, length))
            seen[length, first + k] += 1
    assert set(seen.values()) <= {1} and Counter(n for n, _ in seen) == Counter({n: c for n, c in enumerate(counts) if c})
    for places in fill.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= most
    return len(fill)


@pytest.mark.parametrize("seed", range(12))
def test_plan(seed):
    rng = np.random.default_rng(seed)
    most = int(rng.integers(5, 60))
    counts = np.zeros(most + 1, np.int64)
    for n in rng.integers(1, most + 1, int(rng.integers(0, 30))):
        counts[n] += int(rng.integers(1, 40))
    used = packed_well(plan(counts), counts)
    total = int((counts * np.arange(most + 1)).sum())
    # No worse than best fit decreasing promises.
    assert -(-total // most) <= used <= 11 / 9 * best_possible(counts) + 1


def best_possible(counts):
    most = len(counts) - 1
    total = int((counts * np.arange(most + 1)).sum())
    return max(-(-total // most), int(counts[most // 2 + 1:].sum())) * 1.15 + 1


def test_exact_fillings():
    counts = np.zeros(101, np.int64)
    counts[[60, 40, 25, 15]] = [1000, 400, 600, 600]
    assert packed_well(plan(counts), counts) == 1000
    counts = np.zeros(11, np.int64)
    counts[[7, 1]] = [50, 150]  # three times the same length
    assert packed_well(plan(counts), counts) == 50


def test_sums_as_lengths_run_out():
    rng = random.Random(3)
    counts = np.array([0] + [rng.randint(0, 1) for _ in range(40)])
    sums = LengthSums(counts)
    for length in [n for n in range(1, 41) if counts[n]][:15]:
        counts[length] = 0
        sums.run_out(length)
        fresh = LengthSums(counts)
        assert (sums.single == fresh.single).all() and (sums.pair == fresh.pair).all() and (sums.triple == fresh.triple).all()


def test_packing(odd_docs, odd_rows, no_docs):
    path = tokenizer_file(WORD_TOKENIZER)
    encode = Tokenizer.from_file(path)
    for most in (64, 4096):
        want = Counter()
        for i, t in odd_rows:
            ids = np.array(encode.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
            for k in range(0, len(ids), most):
                want[(i, k // most, k, len(ids[k:k + most]), zlib.crc32(ids[k:k + most].tobytes()))] += 1
        got = pack_documents(odd_docs, path, most).collect()
        assert Counter((r.id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
        sequences = {}
        for r in got:
            sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        for places in sequences.values():
            at = 0
            for offset, length in sorted(places):
                assert offset == at
                at += length
            assert at <= most
        assert len(sequences) <= 1.01 * sum(r.length for r in got) / most + 1
    assert pack_documents(no_docs, path).count() == 0


def unigram(scores):
    lowest = min(scores.values())
    pieces = [("<unk>", 0.0), *scores.items(), *((f"<0x{b:02X}>", lowest) for b in range(256))]
    tokenizer = Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=True))
    tokenizer.normalizer = normalizers.Sequence([normalizers.Prepend("▁"), normalizers.Replace(" ", "▁")])
    return tokenizer


def test_counts_are_the_tokenizers():
    path = tokenizer_file(PIECES)
    scores, _ = vocabulary(path)
    counter, reference = UnigramCounter.of(path), unigram(scores)
    for text in odd_texts(2000) + ["thestion thereash  the   end", "▁already marked ▁▁"]:
        assert counter.count(text)[0] == len(reference.encode(text).ids), text


@pytest.mark.parametrize("seed", range(5))
def test_counts_with_ties(seed):
    """Small vocabularies with few different scores: the piece that starts first wins a tie."""
    rng = random.Random(seed)
    scores = {c: -float(rng.randint(2, 4)) for c in "▁abc"}
    for _ in range(25):
        scores[rng.choice(["", "▁"]) + "".join(rng.choice("abc") for _ in range(rng.randint(1, 5)))] = -float(rng.randint(1, 8))
    counter, reference = UnigramCounter(scores), unigram(scores)
    for _ in range(400):
        text = "".join(rng.choice("abc  d") for _ in range(rng.randint(1, 30)))
        assert counter.count(text)[0] == len(reference.encode(text).ids), text


def test_pieces_across_spaces():
    """A vocabulary whose pieces cross spaces is not taken apart there."""
    scores = {c: -3.0 for c in "▁ab"} | {"a▁b": -1.0, "▁a": -2.0}
    assert UnigramCounter(scores).count("a b")[0] == len(unigram(scores).encode("a b").ids) == 2


def test_token_counts(odd_docs, odd_rows, no_docs):
    path = tokenizer_file(PIECES)
    reference = unigram(vocabulary(path)[0])
    want = Counter((i, len(reference.encode(t).ids) if t else 0) for i, t in odd_rows)
    assert Counter((r.id, r.n_tokens) for r in token_counts(odd_docs, path).collect()) == want
    assert token_counts(no_docs, path).count() == 0
