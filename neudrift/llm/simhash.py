"""Near duplicates by SimHash fingerprints, found through an inverted index on byte positions.

Two 64-bit fingerprints that differ in at most 4 bits differ in at most 4 of their 8 bytes, so they
share at least 4 positional bytes. The index therefore has an entry for every choice of 4 byte positions
and the values there: two fingerprints meet in an entry exactly if their tally of shared positional bytes
reaches that minimum, and pairs below it are never formed. In general, for at most d bits, entries are
over 8 - d positions. Pairs that meet are tallied and verified bit by bit.

Only distinct fingerprints are indexed, so copies cost nothing. Within an entry links are followed
breadth-first, and each fingerprint is reported once with the root of its group: never all pairs.
An entry of more than `largest` fingerprints is solved another way, still exactly: two fingerprints
differ in at most 4 bits just if some third value is within 2 bits of both, so each is exploded
into those values and the values link them.
"""

from itertools import combinations
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from neudrift.llm.common import keyed, map_arrow, matching, settle
from neudrift.llm.components import components

SEED = 42
_TO_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def shingle_hashes(text: bytes, shingle: int) -> np.ndarray:
    """XXH64 of every run of `shingle` words, or of the whole sequence if it is shorter."""
    words = text.translate(_TO_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    pairs = zip(starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist())
    return np.fromiter((digest(joined[s:e], SEED) for s, e in pairs), np.uint64, len(words) - k + 1)


def fingerprint(parts) -> int:
    """Bit by bit the majority of all hashes; zero without any. Takes the hashes in parts."""
    ones, n = np.zeros(64, np.int64), 0
    for part in parts:
        planes = part.astype("<u8").view(np.uint8).reshape(-1, 8)
        for k in range(8):
            ones[8 * k:8 * k + 8] += np.bincount(planes[:, k], minlength=256) @ _BITS
        n += len(part)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0]) if n else 0


def fingerprints(docs: DataFrame, shingle: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`id`, `fp`, the fingerprint as a signed long, and `key`, a hash of id and text, of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            found = [fingerprint([shingle_hashes(t.as_buffer().to_pybytes(), shingle)]) if t.is_valid else 0
                     for t in texts]
            yield pa.record_batch([batch.column("id"), pa.array(np.array(found, np.uint64).view(np.int64)),
                                   batch.column("key")], names=["id", "fp", "key"])

    rows = keyed(docs, id_col, text_col).select("id", F.col("text").cast("binary").alias("text"), "key")
    return map_arrow(rows, run, "id long, fp long, key long")


def _near(values: np.ndarray, one: np.uint64, bits: int) -> np.ndarray:
    """Which values reach the tally of shared positional bytes and then pass the bit check."""
    differ = values ^ one
    shared = (differ.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
    return (shared >= 8 - bits) & (np.bitwise_count(differ) <= bits)


def _groups(values: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Each value that has a link, with the first value of its group."""
    members, roots = [], []
    left = values
    while len(left) > 1:
        root, left, group, todo = left[0], left[1:], [], [left[0]]
        while todo and len(left):
            near = _near(left, todo.pop(), bits)
            if near.any():
                found = left[near]
                group.append(found)
                todo.extend(found)
                left = left[~near]
        if group:
            members.append(np.concatenate(group))
            roots.append(np.full(len(members[-1]), root))
    if not members:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return np.concatenate(members), np.concatenate(roots)


def _link_entries(bits: int, largest: int):
    """Sorted index rows (entry, part, fp) to links (u, v), or (u, null, entry, part) of entries too large."""
    out = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("entry", pa.int32()), ("part", pa.int64())])

    def made(u, v=None, entry=None, part=None):
        n = len(u)
        return pa.record_batch([
            pa.array(u.view(np.int64)), pa.array(v.view(np.int64)) if v is not None else pa.nulls(n, pa.int64()),
            pa.array(np.full(n, entry, np.int32)) if entry is not None else pa.nulls(n, pa.int32()),
            pa.array(np.full(n, part, np.int64)) if part is not None else pa.nulls(n, pa.int64()),
        ], schema=out)

    def solve(entry, part, fp):
        edge = np.flatnonzero((np.diff(entry) != 0) | (np.diff(part) != 0)) + 1
        starts = np.concatenate(([0], edge))
        sizes = np.diff(np.concatenate((starts, [len(fp)])))
        pairs = starts[sizes == 2]
        if len(pairs):
            a, b = fp[pairs], fp[pairs + 1]
            differ = a ^ b
            shared = (differ.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
            near = (shared >= 8 - bits) & (np.bitwise_count(differ) <= bits)
            if near.any():
                yield made(b[near], a[near])
        us, vs = [], []
        for s, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
            if n > largest:
                yield made(fp[s:s + n], entry=entry[s], part=part[s])
                continue
            u, v = _groups(fp[s:s + n], bits)
            us.append(u)
            vs.append(v)
        if us and sum(map(len, us)):
            yield made(np.concatenate(us), np.concatenate(vs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, large = None, None
        for batch in batches:
            new = [batch.column("entry").to_numpy(zero_copy_only=False),
                   batch.column("part").to_numpy(zero_copy_only=False),
                   batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)]
            if large is not None:  # the rest of an entry that was given up as too large
                more = (new[0] == large[0]) & (new[1] == large[1])
                if more.any():
                    yield made(new[2][more], entry=large[0], part=large[1])
                    new = [x[~more] for x in new]
            if not len(new[0]):
                continue
            rows = new if held is None else [np.concatenate(x) for x in zip(held, new)]
            open_ = (rows[0] == rows[0][-1]) & (rows[1] == rows[1][-1])
            cut = len(open_) - int(open_.sum())
            held, large = [x[cut:] for x in rows], None
            if cut:
                yield from solve(*[x[:cut] for x in rows])
            if len(held[0]) > largest:
                large = (held[0][0], held[1][0])
                yield made(held[2], entry=large[0], part=large[1])
                held = None
        if held is not None and len(held[0]):
            yield from solve(*held)

    return run


def _too_large(rows: DataFrame, masks: list[int], bits: int) -> DataFrame:
    """Links inside large entries: values within half the distance of two fingerprints connect them."""
    free = [[b for b in range(64) if not mask >> b & 1] for mask in masks]
    near = F.array(*[F.array(*[F.lit(_signed(sum(1 << b for b in flips)))
                               for k in range(bits // 2 + 1) for flips in combinations(bits_of, k)])
                     for bits_of in free])
    steps = rows.select("u", "entry", "part", F.explode(F.get(near, F.col("entry"))).alias("flip"))
    value = F.col("u").bitwiseXOR(F.col("flip"))
    least = steps.select("u", "entry", value.alias("value")).groupBy("entry", "value").agg(
        F.min("u").alias("v"), F.max("u").alias("last")).where("v < last")
    return steps.select("u", "entry", value.alias("value")).join(least, ["entry", "value"]).select("u", "v").where("u != v")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def links(distinct: DataFrame, bits: int = 4, largest: int = 20_000) -> DataFrame:
    """From distinct fingerprints `fp` to links `u`, `v` that have the same components as all pairs
    of at most `bits` differing bits."""
    masks = [sum(0xFF << 8 * k for k in chosen) for chosen in combinations(range(8), 8 - bits)]
    index = distinct.select(
        "fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in masks])).alias("entry", "part")
    )
    partitions = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = index.repartition(partitions, "entry", "part").sortWithinPartitions("entry", "part", "fp")
    found = settle(map_arrow(dealt, _link_entries(bits, largest), "u long, v long, entry int, part long"))
    direct = found.where("v IS NOT NULL").select("u", "v")
    hot = found.where("v IS NULL")
    if hot.isEmpty():
        return direct
    if bits % 2:
        raise ValueError("entries above `largest` need an even number of bits; raise `largest`")
    return direct.union(_too_large(hot, masks, bits).distinct())


def near_duplicates(docs: DataFrame, shingle: int = 4, bits: int = 4, largest: int = 20_000,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`id`, `key` (a hash of id and text), `fp`, `component_id` and `root`, a fingerprint that names the component,
    of every row.

    A document's component is the smallest id that can be reached over links of at most `bits` differing
    bits, its own included. A null, empty or blank text has the fingerprint zero, which links like any
    other. Texts shorter than a shingle are one shingle. Rows without an id take part and get the smallest
    id of their component, null if there is none; repeated rows are answered each. Other columns are not
    looked at. An empty table gives an empty table.
    """
    rows = settle(fingerprints(docs, shingle, id_col, text_col))
    distinct = settle(rows.groupBy("fp").agg(F.min("id").alias("first_id")))
    roots = components(links(distinct.select("fp"), bits, largest))
    rooted = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    answers = rooted.join(smallest, "root").select("fp", "component_id", "root")
    return rows.join(answers, "fp").select("id", "key", "fp", "component_id", "root")


def keep_firsts(docs: DataFrame, shingle: int = 4, bits: int = 4, **options) -> DataFrame:
    """One row of `docs` for each component, columns unchanged: that with the smallest id, then with the smallest
    hash of id and text; rows without an id come last. Of rows that repeat both one stays.
    """
    found = settle(near_duplicates(docs, shingle, bits, **options).select("id", "key", "root"))
    chosen = found.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("late"), "id", "key")).alias("first"))
    firsts = chosen.select("first.key")
    per_key = settle(found.groupBy("key").count().join(firsts.withColumn("stays", F.lit(True)), "key", "left"))
    kept = matching(keyed(docs), per_key.where("stays IS NULL").select("key"), "left_anti")
    repeated = per_key.where("stays AND count > 1").select("key")
    if repeated.isEmpty():
        return kept.select("row.*")
    again = matching(kept, repeated, "left_semi").groupBy("key").agg(F.any_value("row").alias("row"))
    return matching(kept, repeated, "left_anti").select("row.*").unionByName(again.select("row.*"))
