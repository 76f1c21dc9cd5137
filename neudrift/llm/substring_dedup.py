"""Removal of passages that occur earlier, found through anchors on fixed blocks.

A window of 20 words that occurs twice holds, in its earlier place, a whole block of the grid of
10 words that every document is cut into. So:

1. Blocks are indexed and every rolling window of 10 words of every document is a probe. Index entries and
   probes meet by hash; a hash with a block and at least two places is an anchor, and all its places are hits.
2. Hits are extended: every window of 20 words that holds a hit is looked up by a 72-bit hash among the
   other such windows. Neighbouring windows that repeat together make up the maximal exact repeats; no
   pairs of places are formed. The earliest place of each window stays.
3. Words under the other places are removed.

Positions travel in packed arrays, one per chunk of text and shard of the hash space: some 5 bytes
for a probe, whose place is its number among the chunk's words. A place that its own chunk can settle is not
sent, so what a third of all documents share costs one entry per chunk. Answers go back to the chunk's list
of documents. Only documents with hits are read again: they are written as a table bucketed by their key,
which the last join reads without a shuffle. The text of the others is never shuffled while the keys
of those with hits can be broadcast.
"""

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from neudrift.llm.common import WHITE, map_arrow, matching, rank_id, settle
from neudrift.llm.exact_dedup import RUNS
from neudrift.llm.words import NOT_WHITE, blocks, hashes, inside, pack, spans, text_bytes, unpack, windows
from neudrift.session import workspace

CHUNK_BYTES = 8 << 20
# Words of the corpus for each shard of the hash space, as a power of two.
SHARD_WORDS_LOG2 = 21
# Bits of a probe's hash beyond those that name its shard; chance hits only cost work.
PROBE_BITS = 28

# What a chunk sends to a shard: places `at` with the rest of their hashes and flags; where the order of
# documents matters also how many places each has, its id and its key. To a negative shard: its list of
# documents, with their numbers of words and the places that it has settled itself.
_PART = "shard int, chunk long, at binary, rest binary, more binary, sizes binary, ids binary, keys binary"
_FIELDS = pa.schema([("shard", pa.int32()), ("chunk", pa.int64())]
                    + [(n, pa.binary()) for n in ("at", "rest", "more", "sizes", "ids", "keys")])
_PLACES = pa.schema([("key", pa.int64()), ("at", pa.binary())])


def _rising(values: np.ndarray) -> bytes:
    return pack(np.diff(values, prepend=0).astype(np.uint32))


def _risen(packed: bytes) -> np.ndarray:
    return np.cumsum(unpack(packed, np.uint32).astype(np.int64))


def _rows(rows) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), _FIELDS.types)], schema=_FIELDS)


class Chunk:
    """The words of a batch of documents."""

    def __init__(self, batch: pa.RecordBatch):
        data, offsets = text_bytes(batch.column("text"))
        starts, ends, self.bounds = spans(data, offsets, NOT_WHITE)
        self.hash = hashes(data, starts, ends)
        self.keys = batch.column("key").to_numpy(zero_copy_only=False)
        self.ids = batch.column("id").to_numpy(zero_copy_only=False)
        self.counts = np.diff(self.bounds)
        self.doc = np.repeat(np.arange(len(self.keys)), self.counts)

    def starts_of(self, size: int) -> np.ndarray:
        """Words at which a window of `size` words within one document starts."""
        return np.flatnonzero(inside(self.bounds, len(self.hash), size))

    def head(self, chunk: int, shards_log2: int, settled: np.ndarray) -> tuple:
        """The row with the list of documents."""
        return (-1 - chunk % (1 << shards_log2), chunk, _rising(settled), None, None,
                pack(self.counts.astype(np.uint32)), None, pack(self.keys))


def _cut(top: np.ndarray, shards_log2: int):
    """The order that puts places together by shard, which the first bits of `top` name, and each shard's range."""
    shard = (top >> np.uint64(64 - shards_log2)).astype(np.uint32) if shards_log2 else np.zeros(len(top), np.uint32)
    order = np.argsort(shard, kind="stable")
    shard = shard[order]
    edges = np.concatenate(([0], np.flatnonzero(np.diff(shard)) + 1, [len(shard)]))
    return order, [(int(shard[s]), s, e) for s, e in zip(edges[:-1].tolist(), edges[1:].tolist()) if e > s]


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Parts of a task's batches with a number that no other task gives."""
    task = TaskContext.get().partitionId()
    parts = (part for batch in batches for part in blocks(batch, "text", CHUNK_BYTES))
    for nth, part in enumerate(parts):
        yield (task << 32) + nth, part


def _probes(size: int, shards_log2: int):
    """Every rolling window of `size` words, flagged if it is a block of its document's grid."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, part in _chunks(batches):
            chunk = Chunk(part)
            at = chunk.starts_of(size)
            if not len(at):
                continue
            h = windows(chunk.hash, size)[at]
            block = (at - chunk.bounds[chunk.doc[at]]) % size == 0
            settled, sent = _settled_here(h, block)
            rows = [chunk.head(number, shards_log2, at[settled])]
            at, h, flags = at[sent], h[sent], np.stack((block[sent], settled[sent]), 1)
            order, shards = _cut(h, shards_log2)
            at, flags = at[order], flags[order]
            rest = ((h[order] << np.uint64(shards_log2)) >> np.uint64(64 - PROBE_BITS)).astype(np.uint32)
            rows += [(shard, number, _rising(at[s:e]), pack(rest[s:e]), pack(np.packbits(flags[s:e])), None, None, None)
                     for shard, s, e in shards]
            yield _rows(rows)

    return run


def _settled_here(h: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places that are hits by this chunk alone, and places to send: of those only one per hash."""
    order = np.argsort(h, kind="stable")
    sorted_ = h[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = sorted_[1:] != sorted_[:-1]
    first = np.flatnonzero(fresh)
    run = np.cumsum(fresh) - 1
    many = np.diff(np.concatenate((first, [len(h)]))) > 1
    anchored = np.logical_or.reduceat(block[order], first)
    known = (many & anchored)[run]
    settled, sent = np.zeros(len(h), bool), np.ones(len(h), bool)
    settled[order] = known
    sent[order] = ~known | fresh
    # The one that is sent stands for a block too.
    block[order[known]] = True
    return settled, sent


def _answers(heads: list[dict], rows: list[dict], gone: np.ndarray, at: list[np.ndarray]) -> pa.Table:
    """The rows of documents as they came, and for each chunk the places that are found."""
    out = [tuple(row[n] for n in _FIELDS.names) for row in heads]
    start = 0
    for row, own in zip(rows, at):
        found = own[gone[start:start + len(own)]]
        start += len(own)
        if len(found):
            out.append((row["shard"], row["chunk"], _rising(found), None, None, None, None, None))
    return pa.Table.from_batches([_rows(out)] if out else [], schema=_FIELDS)


def _anchors(table: pa.Table) -> pa.Table:
    """Places of the shard's anchors: hashes with a block and more than one place."""
    all_ = table.to_pylist()
    rows = [r for r in all_ if r["shard"] >= 0]
    at = [_risen(r["at"]) for r in rows]
    hit = np.zeros(0, bool)
    if rows:
        rest = np.concatenate([unpack(r["rest"], np.uint32) for r in rows])
        flags = np.concatenate([np.unpackbits(unpack(r["more"], np.uint8), count=2 * len(a)).reshape(-1, 2)
                                for r, a in zip(rows, at)]).astype(bool)
        order = np.argsort(rest)
        rest, flags = rest[order], flags[order]
        fresh = np.concatenate(([True], rest[1:] != rest[:-1]))
        first = np.flatnonzero(fresh)
        many = np.diff(np.concatenate((first, [len(rest)]))) > 1
        anchored = np.logical_or.reduceat(flags[:, 0], first)
        hit = np.zeros(len(rest), bool)
        hit[order] = (many & anchored)[np.cumsum(fresh) - 1] & ~flags[:, 1]
    return _answers([r for r in all_ if r["shard"] < 0], rows, hit, at)


def _by_document(table: pa.Table) -> pa.Table:
    """All places that were found in a chunk, by document."""
    rows = table.to_pylist()
    head = next(r for r in rows if r["shard"] < 0)
    at = np.sort(np.concatenate([_risen(r["at"]) for r in rows]))
    keys = unpack(head["keys"], np.int64)
    bounds = np.concatenate(([0], np.cumsum(unpack(head["sizes"], np.uint32).astype(np.int64))))
    cuts = np.searchsorted(at, bounds)
    docs = np.flatnonzero(np.diff(cuts))
    own = [_rising(at[cuts[d]:cuts[d + 1]] - bounds[d]) for d in docs.tolist()]
    return pa.Table.from_arrays([pa.array(keys[docs]), pa.array(own, pa.binary())], schema=_PLACES)


def _extensions(size: int, block: int, shards_log2: int):
    """Every window of `size` words that holds a hit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, part in _chunks(batches):
            chunk = Chunk(part)
            hits = [_risen(x) for x in part.column("at").to_pylist()]
            sizes = [len(x) for x in hits]
            first = np.repeat(chunk.bounds[:-1], sizes)
            hit = np.concatenate(hits) + first
            cover = np.zeros(len(chunk.hash) + 1, np.int32)
            np.add.at(cover, np.maximum(hit - (size - block), first), 1)
            np.add.at(cover, hit + 1, -1)
            at = chunk.starts_of(size)
            at = at[np.cumsum(cover)[at] > 0]
            if not len(at):
                continue
            h = windows(chunk.hash, size)[at]
            more = (windows(chunk.hash, size, base=1)[at] >> np.uint64(56)).astype(np.uint8)
            doc = chunk.doc[at]
            place = h, more, chunk.ids[doc], chunk.keys[doc], at - chunk.bounds[doc]
            # Only the earliest place of a window in this chunk has to be compared with others.
            order = np.lexsort(place[::-1])
            dropped = np.zeros(len(at), bool)
            dropped[order] = _later(*(x[order] for x in place))
            rows = [chunk.head(number, shards_log2, at[dropped])]
            at, h, more, doc = (x[~dropped] for x in (at, h, more, doc))
            order, shards = _cut(h, shards_log2)
            at, h, more, doc = (x[order] for x in (at, h << np.uint64(shards_log2), more, doc))
            for shard, s, e in shards:
                docs, n = np.unique(doc[s:e], return_counts=True)
                # Places in the documents follow from the chunk's; the shard needs them to tell which is earlier.
                rows.append((shard, number, _rising(at[s:e]), pack(h[s:e]), pack(more[s:e]), pack(np.stack(
                    (n, chunk.bounds[docs])).astype(np.uint32).reshape(-1)), pack(chunk.ids[docs]), pack(chunk.keys[docs])))
            yield _rows(rows)

    return run


def _later(h, more, ids, keys, at) -> np.ndarray:
    """Of places in order: which have an earlier place with the same hash."""
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (more[1:] != more[:-1])
    first = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
    return (ids != ids[first]) | (keys != keys[first]) | (at != at[first])


def _repeats(table: pa.Table) -> pa.Table:
    """Places of windows that start earlier somewhere else."""
    all_ = table.to_pylist()
    rows = [r for r in all_ if r["shard"] >= 0]
    at = [_risen(r["at"]) for r in rows]
    gone = np.zeros(0, bool)
    if rows:
        columns = []
        for r, own in zip(rows, at):
            n, first = unpack(r["sizes"], np.uint32).astype(np.int64).reshape(2, -1)
            columns.append((unpack(r["rest"], np.uint64), unpack(r["more"], np.uint8),
                            np.repeat(unpack(r["ids"], np.int64), n), np.repeat(unpack(r["keys"], np.int64), n),
                            own - np.repeat(first, n)))
        columns = [np.concatenate(c) for c in zip(*columns)]
        order = np.lexsort(columns[::-1])
        gone = np.zeros(len(order), bool)
        gone[order] = _later(*(c[order] for c in columns))
    return _answers([r for r in all_ if r["shard"] < 0], rows, gone, at)


def _remove(size: int):
    """Texts without the words under windows that start at `at`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, n_words, n_removed = [], [], []
            for text, at in zip(batch.column("text").to_pylist(), batch.column("at").to_pylist()):
                words = text.encode().split()
                cover = np.zeros(len(words) + 1, np.int32)
                starts = _risen(at)
                np.add.at(cover, starts, 1)
                np.add.at(cover, starts + size, -1)
                keep = np.cumsum(cover)[:-1] == 0
                texts.append(b" ".join([w for w, k in zip(words, keep.tolist()) if k]).decode())
                n_words.append(len(words))
                n_removed.append(len(words) - int(keep.sum()))
            yield pa.record_batch([batch.column("doc"), pa.array(texts, pa.string()),
                                   pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())],
                                  names=["doc", "text", "n_words", "n_removed"])

    return run


def _places(parts: DataFrame, reducer) -> DataFrame:
    """`key` and `at`, the places found in a document. Rows that share a key have the same places."""
    found = parts.groupBy("shard").applyInArrow(reducer, _PART)
    documents = found.groupBy("chunk").applyInArrow(_by_document, "key long, at binary")
    return settle(documents.groupBy("key").agg(F.max("at").alias("at")))


def _bucketed(df: DataFrame, name: str) -> DataFrame:
    """Compute once, into a table of the shared folder that joins on `key` read without a shuffle."""
    spark = df.sparkSession
    name = f"{name}_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (df.repartition(buckets, "key").write.option("compression", "zstd").option("path", f"{workspace(spark)}/{name}")
     .bucketBy(buckets, "key").sortBy("key").saveAsTable(name))
    return spark.table(name)


def dedup_passages(docs: DataFrame, size: int = 20, block: int = 10,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc` (the id), `text` (the words that stay, joined by one space), `n_words`, `n_removed` of every row.

    Every word is removed that a window of `size` words covers whose word sequence also starts earlier: in
    a document with a smaller id, or in the same one further left. All windows are judged on the input.
    `block` is at most (size + 1) / 2.

    Null, empty and blank texts have no words, and texts shorter than a window lose none. Rows without an
    id come after all others, ordered by their texts' hashes; so do rows that share an id. Rows that repeat
    both id and text are one document, and each shows its words. Other columns are not looked at. An empty
    table gives an empty table.
    """
    if 2 * block - 1 > size:
        raise ValueError("a window must hold a whole block wherever it starts")
    rows = docs.select(
        docs[f"`{id_col}`"].cast("long").alias("doc"), rank_id(docs[f"`{id_col}`"]).alias("id"),
        F.coalesce(docs[f"`{text_col}`"].cast("string"), F.lit("")).alias("text"),
    ).withColumn("key", F.xxhash64("id", "text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards_log2 = max(0, (total // 6).bit_length() - SHARD_WORDS_LOG2)

    probes = map_arrow(rows.select("key", "id", "text"), _probes(block, shards_log2), _PART)
    hits = _places(probes, _anchors)
    candidates = _bucketed(matching(rows, hits.select("key"), "left_semi").join(hits, "key"), "candidates")
    # A window sends more bytes than a probe, and has to name its document.
    extended = map_arrow(candidates.select("key", "id", "text", "at"),
                         _extensions(size, block, max(0, shards_log2 - 2)), _PART)
    repeats = _places(extended, _repeats)

    changed = map_arrow(candidates.drop("at").join(repeats, "key").select("doc", "text", "at"), _remove(size),
                        "doc long, text string, n_words long, n_removed long")
    text = F.btrim(F.regexp_replace("text", RUNS, " "), F.lit(WHITE))
    unchanged = matching(rows, repeats.select("key"), "left_anti").select("doc", text.alias("text")).select(
        "doc", "text",
        F.when(F.col("text") == "", 0).otherwise(
            F.length("text") - F.length(F.replace("text", F.lit(" "), F.lit(""))) + 1).cast("long").alias("n_words"),
        F.lit(0).cast("long").alias("n_removed"),
    )
    return changed.unionByName(unchanged)
