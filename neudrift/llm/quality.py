"""Document quality as perplexity under an n-gram model of trusted text.

The model is an interpolated modified Kneser-Ney model of order 2 over a hashed vocabulary: a word (a run
of non-white bytes, case kept) is one of `2**bits - 1` classes, and a boundary class stands before the
first and after the last word. There are more than 16 classes for each byte of text, so that hardly a word
shares one, up to the 2**31 that a pair's 64-bit key has room for. The probability of a pair is

    p(b | a) = max(c(a b) - D(c), 0) / c(a) + g(a) * p(b),

with discounts D from the numbers of pairs seen once to four times, g(a) the discounted share of a, and
p(b) the same construction one order lower, on the number of different words before b. So

    log p(text) = sum over pairs of [log g(a) + log p(b)]  +  sum over pairs seen in training of the rest,

where the first sum needs a table with a row per class seen in training, 16 bytes each, which is broadcast
(classes never seen share one row), and the second is a join
of two tables of counts on the pair, sharded by a hash of the pair: counts in trusted text, and counts in
each document. Both travel packed, one row per chunk of text and shard. The pairs that are most frequent
in training, a bounded number, are taken out of that join: they are broadcast and settled where the text is,
so that neither a very common word nor a very common pair piles up in a shard.

A text that the model was trained on looks better than it is. So every eighth trusted document, by a hash of
its id, is held out of the counts, and thresholds are quantiles of the perplexity of these, by language.
All others are counted; nothing is sampled.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from neudrift.llm.common import keyed, map_arrow, matching, settle
from neudrift.llm.words import NOT_WHITE, blocks, hashes, mixed, pack, spans, text_bytes, unpack

# The least vocabulary; the most is what two classes in one signed long allow.
WORD_BITS = 21
CLASSES = 1 << WORD_BITS
MOST_BITS = 31
CHUNK_BYTES = 4 << 20
# The most frequent pairs, which are broadcast.
FREQUENT = 1 << 16
# One in so many trusted documents is held out for the thresholds.
HELD_OUT = 8
# Width of the classes of log perplexity in which quantiles are counted.
QUANTILE_STEP = 1e-3

_PART = "shard int, chunk long, docs binary, sizes binary, found binary"
_PART_NAMES = ["shard", "chunk", "docs", "sizes", "found"]
_PART_TYPES = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
_COUNTS = "shard int, pairs binary, counts binary"
_STATS = "shard int, classes binary, numbers binary"


def word_bits(total: int) -> int:
    """Bits of a word's class for texts of `total` bytes: one more for each doubling."""
    return min(max(total.bit_length() + 4, WORD_BITS), MOST_BITS)


def _pairs(batch: pa.RecordBatch, bits: int):
    """Pairs of a batch as numbers a << bits | b, with their document, and the words per document."""
    data, offsets = text_bytes(batch.column("text"))
    starts, ends, bounds = spans(data, offsets, NOT_WHITE)
    words = (hashes(data, starts, ends) % np.uint64((1 << bits) - 1)).astype(np.int64) + 1
    counts = np.diff(bounds)
    # One boundary before each document's words and one after the last document.
    row = np.zeros(len(words) + len(counts) + 1, np.int64)
    row[np.arange(len(words)) + np.repeat(np.arange(1, len(counts) + 1), counts)] = words
    doc = np.repeat(np.arange(len(counts)), counts + 1)
    return row[:-1] << bits | row[1:], doc, counts


def _dealt(pairs: np.ndarray, shards_log2: int, key_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The shard of each pair and its key there, from the first bits of a one-to-one hash."""
    spread = mixed(pairs.astype(np.uint64))
    shard = spread >> np.uint64(64 - shards_log2) if shards_log2 else np.zeros_like(spread)
    key = (spread << np.uint64(shards_log2)) >> np.uint64(64 - key_bits)
    return shard.astype(np.int64), key.astype(np.uint32 if key_bits <= 32 else np.uint64)


def _cuts(shard: np.ndarray):
    """Sorted shards as (shard, start, end)."""
    edges = np.concatenate(([0], np.flatnonzero(np.diff(shard)) + 1, [len(shard)]))
    return [(int(shard[s]), s, e) for s, e in zip(edges[:-1].tolist(), edges[1:].tolist()) if e > s]


def _pack_rising(values: np.ndarray) -> bytes:
    return pack(np.diff(values, prepend=0))


def _unpack_rising(packed: bytes) -> np.ndarray:
    return np.cumsum(unpack(packed, np.int64))


def _training_counts(shards_log2: int, bits: int):
    """Counts of the pairs of each chunk, by shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "text", CHUNK_BYTES):
                pairs, doc, counts = _pairs(part, bits)
                pairs = pairs[(counts > 0)[doc]]
                if not len(pairs):
                    continue
                keys, n = np.unique(pairs, return_counts=True)
                shard, _ = _dealt(keys, shards_log2, 32)
                order = np.argsort(shard, kind="stable")
                keys, n = keys[order], n[order].astype(np.uint32)
                yield _count_rows([(k, _pack_rising(keys[s:e]), pack(n[s:e])) for k, s, e in _cuts(shard[order])])

    return run


def _count_rows(rows) -> pa.RecordBatch:
    shard, pairs, counts = zip(*rows)
    return pa.record_batch([pa.array(shard, pa.int32()), pa.array(pairs, pa.binary()), pa.array(counts, pa.binary())],
                           names=["shard", "pairs", "counts"])


def _summed(table: pa.Table) -> pa.Table:
    """The counts of all chunks of a shard, added."""
    pairs = np.concatenate([_unpack_rising(x) for x in table.column("pairs").to_pylist()])
    counts = np.concatenate([unpack(x, np.uint32) for x in table.column("counts").to_pylist()])
    keys, place = np.unique(pairs, return_inverse=True)
    counts = np.bincount(place, counts).astype(np.uint64)
    return pa.Table.from_batches([_count_rows([(table.column("shard")[0].as_py(), _pack_rising(keys), pack(counts))])])


def _tally(counts: np.ndarray) -> np.ndarray:
    """How many are 1, 2, 3, 4 and 3 or more, and their sum."""
    return np.array([*((counts == k).sum() for k in (1, 2, 3, 4)), (counts > 2).sum(), counts.sum()], np.int64)


def _tallies(column: str, numbers):
    """One tally over all rows of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for packed in batch.column(column).to_pylist():
                yield pa.record_batch([pa.array([n]) for n in _tally(numbers(packed))], names=list("abcdef"))

    return run


def _tallied(df: DataFrame, column: str, numbers) -> list[int]:
    found = map_arrow(df, _tallies(column, numbers), ", ".join(f"{c} long" for c in "abcdef"))
    return [n or 0 for n in found.agg(*[F.sum(c) for c in "abcdef"]).first()]


def _stats_row(shard: int, classes: np.ndarray, numbers: np.ndarray):
    return shard, _pack_rising(classes), pack(numbers.astype(np.uint64).reshape(-1))


def _stats_rows(rows) -> pa.RecordBatch:
    return pa.record_batch([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int32(), pa.binary(), pa.binary()))],
                           names=["shard", "classes", "numbers"])


def _numbers(packed: bytes) -> np.ndarray:
    """For each class: its total, its pairs seen once, twice and more often, and the classes before it."""
    return unpack(packed, np.uint64).astype(np.int64).reshape(5, -1)


def _class_counts(shards_log2: int, bits: int):
    """What the shards of pairs know about their classes, by shard of classes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pairs, counts in zip(batch.column("pairs").to_pylist(), batch.column("counts").to_pylist()):
                pairs, counts = _unpack_rising(pairs), unpack(counts, np.uint64).astype(np.int64)
                classes, place = np.unique(np.concatenate((pairs >> bits, pairs & (1 << bits) - 1)), return_inverse=True)
                a, b, m = place[:len(pairs)], place[len(pairs):], len(classes)
                numbers = np.stack([np.bincount(a, counts, m).astype(np.int64)] + [
                    np.bincount(a[which], minlength=m) for which in (counts == 1, counts == 2, counts > 2)] + [
                    np.bincount(b, minlength=m)])
                yield _stats_rows([_stats_row(k, classes[s:e], numbers[:, s:e])
                                   for k, s, e in _cuts(classes >> (bits - shards_log2))])

    return run


def _classes_summed(table: pa.Table) -> pa.Table:
    classes = np.concatenate([_unpack_rising(x) for x in table.column("classes").to_pylist()])
    numbers = np.concatenate([_numbers(x) for x in table.column("numbers").to_pylist()], axis=1)
    found, place = np.unique(classes, return_inverse=True)
    sums = np.stack([np.bincount(place, row, len(found)) for row in numbers])
    return pa.Table.from_batches([_stats_rows([_stats_row(table.column("shard")[0].as_py(), found, sums)])])


def _most_frequent(each: int):
    """The pairs with the highest counts of every shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pairs, counts in zip(batch.column("pairs").to_pylist(), batch.column("counts").to_pylist()):
                pairs, counts = _unpack_rising(pairs), unpack(counts, np.uint64).astype(np.int64)
                top = np.lexsort((pairs, -counts))[:each]
                yield pa.record_batch([pa.array(pairs[top]), pa.array(counts[top])], names=["pair", "n"])

    return run


def discounts(n1: int, n2: int, n3: int, n4: int) -> np.ndarray:
    """What is taken off counts of 0, 1, 2 and of 3 or more."""
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    steps = ((1, n1, n2), (2, n2, n3), (3, n3, n4))
    found = [min(max(k - (k + 1) * y * (b / a if a else 0.5), 0.1), k) for k, a, b in steps]
    return np.array([0.0, *found])


def _class_table(steps: np.ndarray, lower: np.ndarray, even: float, all_: float):
    """Rows of a class seen in training: its total, the log of its discounted share, and of its probability as a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for classes, packed in zip(batch.column("classes").to_pylist(), batch.column("numbers").to_pylist()):
                total, *kinds, before = _numbers(packed)
                left = sum(n * step for n, step in zip(kinds, steps[1:]))
                # A word that never was a context leaves everything to the lower order.
                share = np.log(np.divide(left, total, out=np.ones(len(total)), where=total > 0))
                word = np.log((before - lower[np.minimum(before, 3)] + even) / all_)
                yield pa.record_batch([pa.array(_unpack_rising(classes).astype(np.int32))] + [
                    pa.array(x.astype(np.float32)) for x in (total, share, word)], names=["class", "total", "share", "word"])

    return run


class Model:
    """The table with a row per class seen in training, and the most frequent pairs."""

    def __init__(self, counted: DataFrame, stats: DataFrame, top: DataFrame, bits: int):
        self.bits = bits
        self.discounts = discounts(*_tallied(counted, "counts", lambda x: unpack(x, np.uint64))[:4])
        n1, n2, n3, n4, more, all_ = _tallied(stats, "numbers", lambda x: _numbers(x)[4])
        lower = discounts(n1, n2, n3, n4)
        spare = n1 * lower[1] + n2 * lower[2] + more * lower[3] if all_ else 1.0
        even, all_ = spare / (1 << bits), max(all_, 1)
        table = map_arrow(stats, _class_table(self.discounts, lower, even, all_),
                          "class int, total float, share float, word float").toArrow()
        classes = table.column("class").to_numpy()
        order = np.argsort(classes)
        self.classes = classes[order]
        # The last row is that of all classes that were not seen.
        self.total, self.log_share, self.log_word = (
            np.append(table.column(name).to_numpy()[order], np.float32(other))
            for name, other in (("total", 1.0), ("share", 0.0), ("word", np.log(even / all_))))
        top = top.toArrow()  # FREQUENT rows
        pairs, counts = top.column("pair").to_numpy(), top.column("n").to_numpy()
        order = np.argsort(pairs)
        self.frequent, self.frequent_gain = pairs[order], self.gain(pairs[order], counts[order])

    def places(self, classes: np.ndarray) -> np.ndarray:
        """Rows of the table."""
        classes = classes.astype(np.int32)
        at = np.searchsorted(self.classes, classes)
        if len(self.classes):
            at[self.classes[np.minimum(at, len(self.classes) - 1)] != classes] = len(self.classes)
        return at

    def base(self, pairs: np.ndarray) -> np.ndarray:
        return self.base_and_known(pairs)[0]

    def base_and_known(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The base, and whether both classes were seen in training; no other pair can have been."""
        a, b = self.places(pairs >> self.bits), self.places(pairs & (1 << self.bits) - 1)
        last = len(self.classes)
        return self.log_share[a].astype(np.float64) + self.log_word[b], (a < last) & (b < last)

    def gain(self, pairs: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """What having been seen adds to the base."""
        base = self.base(pairs)
        counts = counts.astype(np.float64)
        own = (counts - self.discounts[np.minimum(counts, 3).astype(int)]) / self.total[self.places(pairs >> self.bits)]
        return np.log(own + np.exp(base)) - base


def _document_counts(shared, shards_log2: int, key_bits: int):
    """Per chunk the documents' bases with the frequent pairs (negative shard), and other pairs by shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, task, nth = shared.value, TaskContext.get().partitionId(), 0
        for batch in batches:
            for part in blocks(batch, "text", CHUNK_BYTES):
                pairs, doc, counts = _pairs(part, model.bits)
                base, known = model.base_and_known(pairs)
                score = np.bincount(doc, base, len(counts))
                pairs, doc = pairs[known], doc[known]
                if len(model.frequent):
                    place = np.minimum(np.searchsorted(model.frequent, pairs), len(model.frequent) - 1)
                    hit = model.frequent[place] == pairs
                    score += np.bincount(doc[hit], model.frequent_gain[place[hit]], len(counts))
                    pairs, doc = pairs[~hit], doc[~hit]
                chunk = (task << 32) + nth
                nth += 1
                keys = part.column("key").to_numpy(zero_copy_only=False)
                rows = [(-1 - chunk % (1 << shards_log2), pack(keys), pack(counts), pack(score))]
                shard, found = _dealt(pairs, shards_log2, key_bits)
                order = np.argsort(shard, kind="stable")
                doc, found = doc[order], found[order]
                for k, s, e in _cuts(shard[order]):
                    docs, n = np.unique(doc[s:e], return_counts=True)
                    docs = np.diff(docs, prepend=0).astype(np.uint32)
                    rows.append((k, pack(docs), pack(n.astype(np.uint32)), pack(found[s:e])))
                shard, *binary = zip(*rows)
                yield pa.record_batch(
                    [pa.array(shard, pa.int32()), pa.array(np.full(len(rows), chunk)),
                     *(pa.array(x, pa.binary()) for x in binary)], names=_PART_NAMES)

    return run


def _join_shards(shared, shards_log2: int, key_bits: int):
    """Over rows in the order of shards, the model's row of a shard first: gains of documents by chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, of, known, gain = shared.value, None, None, None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["shard"] < 0:
                    out.append((row["shard"], row["chunk"], row["docs"], row["sizes"], row["found"]))
                elif row["chunk"] < 0:
                    of, pairs = row["shard"], _unpack_rising(row["docs"])
                    gain = model.gain(pairs, unpack(row["sizes"], np.uint64))
                    known = _dealt(pairs, shards_log2, key_bits)[1]
                    order = np.argsort(known)
                    known, gain = known[order], gain[order]
                elif row["shard"] == of:
                    values, sizes = unpack(row["found"], known.dtype), unpack(row["sizes"], np.uint32)
                    place = np.minimum(np.searchsorted(known, values), len(known) - 1)
                    added = np.where(known[place] == values, gain[place], 0.0)
                    sums = np.bincount(np.repeat(np.arange(len(sizes)), sizes), added, len(sizes))
                    out.append((row["shard"], row["chunk"], row["docs"], None, pack(sums.astype(np.float32))))
            if out:
                yield pa.record_batch([pa.array(x, t) for x, t in zip(zip(*out), _PART_TYPES)], names=_PART_NAMES)

    return run


def _add_up(table: pa.Table) -> pa.Table:
    """A chunk's documents with the sums of what all shards found."""
    rows = table.to_pylist()
    head = next(row for row in rows if row["shard"] < 0)
    score = unpack(head["found"], np.float64).copy()
    for row in sorted((r for r in rows if r["shard"] >= 0), key=lambda r: r["shard"]):
        docs = np.cumsum(unpack(row["docs"], np.uint32))
        score[docs] += unpack(row["found"], np.float32)
    return pa.table({"key": unpack(head["docs"], np.int64), "n_words": unpack(head["sizes"], np.int64), "score": score})


def log_perplexity(rows: DataFrame, trusted: DataFrame) -> DataFrame:
    """`key` and `log_ppl` of every distinct key of `rows` (key, text), under a model of `trusted` (text).

    A text without words has no perplexity, null. Without trusted text all texts have that of evenly
    spread classes.
    """
    spark = rows.sparkSession
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards_log2 = max(0, (total // 6).bit_length() // 2 - 8)

    bits = word_bits(total)
    # Of a pair not seen in training, fewer than one in a thousand has the key of one that was.
    key_bits = max(32, (total // 6).bit_length() - shards_log2 + 10)

    parts = map_arrow(trusted.select("text"), _training_counts(shards_log2, bits), _COUNTS)
    counted = settle(parts.groupBy("shard").applyInArrow(_summed, _COUNTS))
    stats = settle(map_arrow(counted, _class_counts(shards_log2, bits), _STATS).groupBy("shard").applyInArrow(
        _classes_summed, _STATS))
    top = map_arrow(counted, _most_frequent(FREQUENT >> shards_log2), "pair long, n long")
    model = Model(counted, stats, top, bits)
    shared = spark.sparkContext.broadcast(model)

    documents = map_arrow(rows.select("key", "text"), _document_counts(shared, shards_log2, key_bits), _PART)
    counts = counted.select("shard", F.lit(-1).cast("long").alias("chunk"), F.col("pairs").alias("docs"),
                            F.col("counts").alias("sizes"), F.lit(None).cast("binary").alias("found"))
    dealt = documents.unionByName(counts).repartition("shard").sortWithinPartitions("shard", "chunk")
    sums = map_arrow(dealt, _join_shards(shared, shards_log2, key_bits), _PART).groupBy("chunk").applyInArrow(
        _add_up, "key long, n_words long, score double")
    return sums.groupBy("key").agg(F.max("n_words").alias("n_words"), F.max("score").alias("score")).select(
        "key", F.when(F.col("n_words") > 0, -F.col("score") / (F.col("n_words") + 1)).alias("log_ppl"))


def thresholds(trusted: DataFrame, quantile: float) -> DataFrame:
    """The quantile of `log_ppl` of each `lang`, and of all under a null `lang`; by counted classes."""
    step = F.floor(F.col("log_ppl") / QUANTILE_STEP).alias("step")
    counts = trusted.where("log_ppl IS NOT NULL").groupBy("lang", step).agg(F.count("*").alias("n"))
    every = counts.groupBy(F.lit(None).cast("string").alias("lang"), "step").agg(F.sum("n").alias("n"))
    both = counts.where("lang IS NOT NULL").unionByName(every)
    up_to = Window.partitionBy("lang").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    return (
        both.withColumn("up_to", F.sum("n").over(up_to)).withColumn("all", F.sum("n").over(Window.partitionBy("lang")))
        .where(F.col("up_to") >= F.col("all") * quantile)
        .groupBy("lang").agg(((F.min("step") + 1) * QUANTILE_STEP).alias("limit"))
    )


def rated(docs: DataFrame, labels: DataFrame, quantile: float = 0.99, margin: float = 0.0,
          id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """`key`, `id`, `lang`, `log_ppl`, `limit` and `kept` of every row of `docs`.

    Trusted are the rows whose id has a label with quality 1. A row is kept if its log perplexity is at most
    the limit of its language: the quantile among its held-out trusted rows plus `margin`. Languages
    without such rows, and rows without a language, take the limit over all held-out rows; if there are
    none at all, every row with words is kept. Null, empty and blank texts have no perplexity and are not
    kept. Rows without an id are never trusted; repeated rows are rated each. Other columns are not
    looked at. An empty table gives an empty table.
    """
    rows = keyed(docs, id_col, text_col).withColumn("lang", F.col(f"row.`{lang_col}`").cast("string"))
    ids = labels.where("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("id")).distinct()
    ids = settle(ids.withColumn("held_out", F.pmod(F.xxhash64("id"), F.lit(HELD_OUT)) == 0))
    scores = settle(log_perplexity(rows, matching(rows, ids.where("NOT held_out").select("id"), "left_semi")))
    found = rows.select("key", "id", "lang").join(scores, "key")
    limits = settle(thresholds(matching(found, ids.where("held_out").select("id"), "left_semi"), quantile))
    general = limits.where("lang IS NULL").first()
    limit = F.coalesce("limit", F.lit(general["limit"] if general else None).cast("double")) + margin
    return found.join(limits.where("lang IS NOT NULL"), "lang", "left").select(
        "key", "id", "lang", "log_ppl", limit.alias("limit"),
        (F.col("log_ppl").isNotNull() & F.coalesce(F.col("log_ppl") <= limit, F.lit(True))).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of `docs` that are kept, columns unchanged."""
    rejected = settle(rated(docs, labels, **options).where("NOT kept").select("key").distinct())
    return matching(keyed(docs), rejected, "left_anti").select("row.*")
