import random
from collections import Counter

import pytest
import xxhash

from neudrift.llm.components import components
from neudrift.llm.simhash import keep_firsts, links, near_duplicates
from tests.llm.conftest import white_split

UP = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text, size):
    words = [w.translate(UP) for w in white_split(text)]
    shingles = [b" ".join(words[k:k + size]) for k in range(max(1, len(words) - size + 1))] if words else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(values, bits):
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    values = list(root)
    for a in range(len(values)):
        for b in range(a):
            if (values[a] ^ values[b]).bit_count() <= bits:
                x, y = find(values[a]), find(values[b])
                root[max(x, y)] = min(x, y)
    return {v: find(v) for v in values}


def test_near_duplicates(odd_docs, odd_rows, no_docs):
    prints = [(i, fingerprint(t, 4)) for i, t in odd_rows]
    found = groups({p for _, p in prints}, 4)
    first = {}
    for i, p in prints:
        if i is not None:
            first[found[p]] = min(i, first.get(found[p], i))
    want = Counter((i, p, first.get(found[p])) for i, p in prints)
    got = near_duplicates(odd_docs).collect()
    assert Counter((r.id, r.fp & (2**64 - 1), r.component_id) for r in got) == want
    assert near_duplicates(no_docs).count() == 0 and keep_firsts(no_docs).count() == 0
    kept = keep_firsts(odd_docs)
    assert kept.columns == odd_docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(i for i, _, c in want.elements() if i == c)


def test_one_row_of_each_group_stays(spark):
    """Copies without an id, repeated rows and ids of several texts."""
    base, other = "some words that make a text of their own " * 5, "quite another text with its own words here " * 5
    rows = [(None, base)] * 5 + [(7, other)] * 3 + [(7, other + "end"), (None, other), (8, None), (None, ""), (9, " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = sorted(((r.doc_id, r.text) for r in keep_firsts(docs).collect()), key=str)
    groups = {r.root for r in near_duplicates(docs).collect()}
    assert len(kept) == len(groups) and (None, base) in kept and (8, None) in kept
    assert sum(i == 7 for i, _ in kept) == len(kept) - 2


@pytest.mark.parametrize("largest", [20_000, 40])
def test_links_of_clusters(spark, largest):
    """Clusters, a chain, and an entry that is solved by explosion when `largest` is small."""
    rng = random.Random(3)
    values = {rng.getrandbits(64) for _ in range(200)}
    for _ in range(5):
        centre = rng.getrandbits(64)
        values |= {centre ^ sum(1 << b for b in rng.sample(range(24), rng.randint(0, 5))) for _ in range(80)}
    step = rng.getrandbits(64)
    for k in range(0, 40, 4):
        values.add(step := step ^ 0xF << k)
    signed = [(v - 2**64 if v >= 2**63 else v,) for v in values]
    edges = links(spark.createDataFrame(signed, "fp long").repartition(3), 4, largest)
    pairs = [(r.u & (2**64 - 1), r.v & (2**64 - 1)) for r in edges.collect()]
    want = groups(values, 4)
    assert all((a ^ b).bit_count() <= 4 or want[a] == want[b] for a, b in pairs)
    assert len(pairs) <= 70 * len(values) * (1 if largest > 40 else 12)
    got = {r.node: r.root for r in components(edges).collect()}
    of = lambda v: got.get(v - 2**64 if v >= 2**63 else v, v - 2**64 if v >= 2**63 else v)
    by_root, by_want = {}, {}
    for v in values:
        by_root.setdefault(of(v), set()).add(v)
        by_want.setdefault(want[v], set()).add(v)
    assert sorted(map(sorted, by_root.values())) == sorted(map(sorted, by_want.values()))


def test_components(spark):
    rng = random.Random(1)
    edges = [(k, k + 1) for k in range(100, 180)] + [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(35)]
    edges += [(7, 7), (None, 3), (500, 400), (500, 400), (400, 500)] + [(900, k) for k in range(901, 950)]
    root = {}

    def find(v):
        while root.setdefault(v, v) != v:
            v = root[v]
        return v

    for a, b in edges:
        if a is not None:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {v: find(v) for v in list(root) if find(v) != v}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
