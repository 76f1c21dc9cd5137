import hashlib
import zlib
from collections import defaultdict

import pytest

from neudrift.llm.merkle import hexed, manifest, numbered, proof_hash
from neudrift.llm.queries import op13_merkle
from pyspark.sql import functions as F


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(leaves, arity=16):
    """Root, and for every leaf its siblings before and after, level by level."""
    paths, places, level = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(level) > 1:
        for path, at in zip(paths, places):
            run = at // arity * arity
            path.append((level[run:at], level[at + 1:run + arity]))
        places = [at // arity for at in places]
        level = [h("".join(level[k:k + arity])) for k in range(0, len(level), arity)]
    return level[0], paths


def brute(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    groups = defaultdict(list)
    for row in rows:
        groups[row[1]].append(row)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[name] = tree([leaf_of(r) for r in groups[name]])
    root, tops = tree([trees[name][0] for name in names])
    out = []
    for name, top in zip(names, tops):
        for row, path in zip(groups[name], trees[name][1]):
            path = path + top
            i, text = row[0], row[4]
            if i is not None and zlib.crc32(str(i).encode()) % 5 == 0 and text is not None:
                text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
            node = leaf_of((*row[:4], text))
            for before, after in path:
                node = h("".join(before) + node + "".join(after))
            proof = h("".join("".join(b) + "".join(a) for b, a in path))
            out.append((i, leaf_of(row), trees[name][0], root, proof, node, node == root))
    return out


def found(docs):
    rows = manifest(docs).select("id", hexed("leaf"), hexed("subroot"), hexed("root"), proof_hash(),
                                 hexed("folded_root"), F.expr("folded_root = root")).collect()
    return [tuple(r) for r in rows]


def key(row):
    return tuple((v is not None, v) if v is not None else (False, 0) for v in row)


COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def test_odd_documents(spark, odd_docs):
    """Nulls, empty, long and repeated rows, ids of several rows, columns with clashing names."""
    rows = [tuple(r) for r in odd_docs.select(*COLUMNS).collect()]
    assert sorted(found(odd_docs), key=key) == sorted(brute(rows), key=key)


@pytest.mark.parametrize("sizes", [
    {"a": 1}, {None: 1, "": 1, "a": 17}, {"a": 16, "b": 256, "é": 257, None: 300, "Z": 4097, "z": 70_000},
    {f"s{k}": 1 + k % 3 for k in range(600)}])
def test_sizes(spark, sizes):
    """Trees that end at every height, one hot source, and a top tree of several heights."""
    rows = [(k * 3 + len(str(s)), s, None, k, f"Text {k}") for s, n in sizes.items() for k in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    assert sorted(found(docs)) == sorted(brute(rows))


def test_tampering_is_seen(spark):
    rows = [(k, "a", "en", 1, text) for k, text in enumerate(["lower", "UPPER", None, "", "Ünder", "ÀÉ"] * 40)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    got = {r[0]: r[-1] for r in found(docs)}
    for i, _, _, _, text in rows:
        assert got[i] == (not (zlib.crc32(str(i).encode()) % 5 == 0 and text == "UPPER"))
    assert not all(got.values())


def test_empty(no_docs):
    assert manifest(no_docs).collect() == [] and "folded_root" in manifest(no_docs).columns


def test_numbered(spark):
    rows = [("hot", k) for k in range(5000)] + [(f"g{k}", j) for k in range(200) for j in range(k % 7)]
    frame = spark.createDataFrame(rows, "g string, v int").repartition(7)
    for r in numbered(frame, "g", ["v"]).collect():
        assert r.pos == r.v and r.n == (5000 if r.g == "hot" else int(r.g[1:]) % 7)


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS).collect()]
    assert sorted(tuple(r) for r in op13_merkle(spark, sf_dir).collect()) == sorted(brute(rows))

