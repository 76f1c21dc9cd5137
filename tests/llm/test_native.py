import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest

from neudrift.llm import sharding
from neudrift.llm.exact_dedup import exact_duplicates
from neudrift.llm.line_dedup import dedup_lines, with_kept_lines
from neudrift.llm.sharding import grown, load_map, rebalanced, shard_documents

LAST = 2**63 - 1
UP = {c: c + 32 for c in range(65, 91)}


def lines_by_hand(rows, least=10, min_docs=2):
    holders = defaultdict(set)
    key = lambda line: line.strip("\t\n\x0b\x0c\r ").translate(UP)
    ident = lambda i: LAST if i is None else i
    for i, t in rows:
        for line in (t or "").split("\n"):
            holders[key(line)].add(ident(i))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        gone = [len(key(x)) >= least and len(holders[key(x)]) >= min_docs and min(holders[key(x)]) != ident(i) for x in lines]
        out.append((i, len(lines), sum(gone), "\n".join(x for x, g in zip(lines, gone) if not g)))
    return out


def test_lines(odd_docs, odd_rows):
    for n in (2, 3):
        got = dedup_lines(odd_docs, min_docs=n).select("row.doc_id", "n_lines", "n_dropped", "kept").collect()
        assert Counter(map(tuple, got)) == Counter(lines_by_hand(odd_rows, min_docs=n))


def test_lines_keep_columns(odd_docs, no_docs, odd_rows):
    kept = with_kept_lines(odd_docs)
    assert kept.schema.simpleString() == odd_docs.schema.simpleString()
    assert all(r.n_chars == len(r.text) and (r.key, r.at) == ("k", "a") for r in kept.collect())
    assert with_kept_lines(no_docs).count() == 0


def test_exact(odd_docs, odd_rows, no_docs):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = defaultdict(list)
    for i, t in odd_rows:
        groups[norm(t)].append(i)
    for support in (0.0005, 0.02, 0.3):
        got = exact_duplicates(odd_docs, support=support).collect()
        want = Counter()
        for text, ids in groups.items():
            first = min((i for i in ids if i is not None), default=None)
            for i in ids:
                want[(i, first, len(ids), hashlib.sha256(text.encode()).hexdigest())] += 1
        assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
        kept = Counter(r.text_sha256 for r in got if r.kept)
        assert set(kept.values()) == {1} and len(kept) == len(groups)
        assert all(r.doc_id == r.keep_id for r in got if r.kept)
    assert exact_duplicates(no_docs).count() == 0


def test_hot_group_is_broadcast(spark):
    docs = spark.createDataFrame([(k, "copy" if k % 3 else f"text {k}") for k in range(300)], "doc_id long, text string")
    got = exact_duplicates(docs, support=0.1).collect()
    assert {r.hot for r in got if r.text_sha256 == hashlib.sha256(b"copy").hexdigest()} == {True}
    assert sum(r.hot for r in got) == 200 and all(r.group_size == 200 for r in got if r.hot)


def test_shards(odd_docs, odd_rows, no_docs, spark, tmp_path):
    got = shard_documents(odd_docs, shards=3, slots=64, map_path=str(tmp_path / "map")).collect()
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in odd_rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    for shard in range(3):
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(sum(r.shard == shard for r in got)))
    versions = [{r.virtual_slot: r.shard for r in load_map(spark, str(tmp_path / "map"), v).collect()} for v in (1, 2)]
    assert versions[0] == {s: s % 3 for s in range(64)} and all(versions[1][r.virtual_slot] == r.shard for r in got)
    load = Counter()
    for r in got:
        load[r.shard] += r.size
    of_slot = Counter()
    for r in got:
        of_slot[r.virtual_slot] += r.size
    largest_slot = max(of_slot.values())
    assert max(load.values()) - min(load.values()) <= largest_slot
    assert shard_documents(no_docs, shards=3, slots=64).count() == 0


def test_map_edits():
    weights = [(s * 7919) % 1000 + 1 for s in range(512)]
    first = sharding.even_map(512, 24)
    second = rebalanced(first, weights, 24)
    load = lambda m, n: [sum(w for w, s in zip(weights, m) if s == k) for k in range(n)]
    assert max(load(second, 24)) - min(load(second, 24)) <= 0.01 * sum(weights) / 24
    third = grown(second, weights, 24)
    assert all(a == b or b == 24 for a, b in zip(second, third))
    assert 0.8 * sum(weights) / 25 <= load(third, 25)[24] <= sum(weights) / 25
    assert rebalanced([0, 0], [0, 0], 2) == [0, 0]


def test_a_document_of_many_lines(spark):
    """Lines are put together in time that grows with their number."""
    import time

    lines = [f"line number {k} of a very long document" for k in range(200_000)]
    rows = [(1, "\n".join(lines[k] for k in range(0, 200_000, 50))), (2, "\n".join(lines))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    start = time.time()
    found = {r.row.doc_id: r for r in dedup_lines(docs).collect()}
    assert time.time() - start < 60
    assert (found[1].n_dropped, found[2].n_dropped) == (0, 4_000)
    assert found[2].kept == "\n".join(line for k, line in enumerate(lines) if k % 50)


def test_a_map_lives_on(spark, odd_docs, tmp_path):
    """Every call edits the newest version, and only if slots have to move; earlier versions stay."""
    path = str(tmp_path / "map")

    def run(docs, shards):
        rows = shard_documents(docs, shards=shards, slots=64, map_path=path).collect()
        return rows, {r.map_version for r in rows}.pop()

    def version(v):
        return {r.virtual_slot: r.shard for r in load_map(spark, path, v).collect()}

    rows, at = run(odd_docs, 3)
    assert at == 2
    kept = {v: version(v) for v in (1, 2)}
    again, at = run(odd_docs, 3)
    assert at == 2 and sorted(again, key=str) == sorted(rows, key=str)
    more, at = run(odd_docs, 4)
    assert at == 3 and {r.shard for r in more} == {0, 1, 2, 3}
    _, at = run(odd_docs.where("doc_id < 40"), 4)
    assert at == 4
    assert {v: version(v) for v in (1, 2)} == kept
    # Grown first: the new shard takes slots, and only what levels the bytes moves besides.
    sizes = {}
    for r in more:
        sizes[r.virtual_slot] = sizes.get(r.virtual_slot, 0) + r.size
    weights = [sizes.get(s, 0) for s in range(64)]
    assert version(3) == dict(enumerate(sharding.edited([kept[2][s] for s in range(64)], weights, 4)))
    with pytest.raises(ValueError):
        run(odd_docs, 2)
