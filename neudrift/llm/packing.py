"""Packing of tokenized documents into sequences of a fixed length.

Lengths run from 1 to `most` only, so packing is decided on the number of pieces of each length, a table
of at most `most` rows whatever the corpus. Sums of one, two and three available lengths are indexed. A
sequence is opened with the longest length left; if one, two or three lengths fill its gap exactly they
are consumed, as many times as their counts allow, else the longest length that fits is added and
the gap is looked up again. Lengths that no exact filling takes go best-fit, longest first, into the
fullest open sequences that have room.

The decision is a list of runs: pieces of one length, counted from one rank to another, go to consecutive
sequences at one offset. Pieces get their rank within their length from counts per task, so a length
that a third of all pieces have is no group of one task, and find their run by a join on (length, block
of ranks).
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from neudrift.llm.common import map_arrow, settle
from neudrift.llm.tokens import WordEncoder
from neudrift.llm.words import blocks

# Ranks of one length that share a join key, and pieces of one length that are ranked together.
RANK_BLOCK = 4096
# Bytes of text whose distinct words are looked up together.
BLOCK_BYTES = 3 << 20
SHARE = 2_000


def pieces_of(docs: DataFrame, tokenizer: str, most: int = 4096, end_id: int = 1,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`id`, `piece`, `start`, `length`, `ids_crc32` of every piece of at most `most` ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = WordEncoder.of(tokenizer), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for part in blocks(batch, "text", BLOCK_BYTES):
                found, bounds = encoder.encode(part.column("text"))
                raw, bounds = found.tobytes(), (4 * bounds).tolist()
                ids = part.column("id")
                row, piece, length, crc = [], [], [], []
                for k in range(len(part)):
                    own = raw[bounds[k]:bounds[k + 1]] + end
                    for nth, at in enumerate(range(0, len(own), 4 * most)):
                        cut = own[at:at + 4 * most]
                        row.append(k)
                        piece.append(nth)
                        length.append(len(cut) // 4)
                        crc.append(zlib.crc32(cut))
                piece, length = np.array(piece, np.int32), np.array(length, np.int64)
                yield pa.record_batch(
                    [ids.take(pa.array(row, pa.int64())), pa.array(piece), pa.array(piece.astype(np.int64) * most),
                     pa.array(length), pa.array(crc, pa.int64())],
                    names=["id", "piece", "start", "length", "ids_crc32"])

    return map_arrow(
        docs.select(docs[f"`{id_col}`"].cast("long").alias("id"), docs[f"`{text_col}`"].cast("string").alias("text")),
        run, "id long, piece int, start long, length long, ids_crc32 long")


class LengthSums:
    """Which sums one, two and three available lengths make, as lengths run out."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts
        self.most = len(counts) - 1
        single = (counts > 0).astype(np.int64)
        single[0] = 0
        self.single = single
        self.pair = np.convolve(single, single)[:self.most + 1]
        self.triple = np.convolve(self.pair, single)[:self.most + 1]

    def _shifted(self, sums: np.ndarray, by: int) -> np.ndarray:
        out = np.zeros_like(sums)
        if by <= self.most:
            out[by:] = sums[:len(sums) - by]
        return out

    def run_out(self, length: int) -> None:
        """Take a length off the index: ordered choices with it in one, two or three places go."""
        one = np.zeros_like(self.single)
        one[0] = 1
        twice, thrice = self._shifted(one, 2 * length), self._shifted(one, 3 * length)
        self.triple -= 3 * self._shifted(self.pair, length) - 3 * self._shifted(self.single, 2 * length) + thrice
        self.pair -= 2 * self._shifted(self.single, length) - twice
        self.single[length] = 0

    def take(self, pattern: list[int], times: int) -> None:
        for length in pattern:
            self.counts[length] -= times
        for length in set(pattern):
            if self.counts[length] <= 0 and self.single[length]:
                self.run_out(length)

    def _allowed(self, used: list[int]) -> bool:
        return all(self.counts[length] >= used.count(length) for length in set(used))

    def filling(self, gap: int, used: list[int]) -> list[int] | None:
        """One, two or three available lengths that sum to the gap, longest first; `used` are taken."""
        if self.single[gap] and self._allowed([*used, gap]):
            return [gap]
        for chosen in self._pairs(gap, used, gap - 1):
            return chosen
        if self.triple[gap] > 0:
            for first in np.flatnonzero(self.single[:gap - 1] & (self.pair[gap:1:-1] > 0))[::-1].tolist():
                for chosen in self._pairs(gap - first, [*used, first], first):
                    return [first, *chosen]
        return None

    def _pairs(self, gap: int, used: list[int], longest: int) -> Iterator[list[int]]:
        if gap < 2 or self.pair[gap] <= 0:
            return
        low = -(-gap // 2)
        firsts = np.flatnonzero(self.single[low:gap] & self.single[gap - low:0:-1]) + low
        for first in firsts[firsts <= longest][::-1].tolist():
            if self._allowed([*used, first, gap - first]):
                yield [first, gap - first]


def plan(counts: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """From the number of pieces of each length, 0 to the capacity, to runs
    (length, first rank, last rank, sequence of the first, offset)."""
    counts = counts.astype(np.int64).copy()
    most = len(counts) - 1
    sums, ranks, runs, sequences = LengthSums(counts), np.zeros(most + 1, np.int64), [], 0

    def place(length: int, times: int, sequence: int, offset: int) -> None:
        runs.append((length, int(ranks[length]), int(ranks[length]) + times - 1, sequence, offset))
        ranks[length] += times

    def put(pattern: list[int], times: int) -> None:
        nonlocal sequences
        offset = 0
        for length in pattern:
            place(length, times, sequences, offset)
            offset += length
        sequences += times

    rest = np.zeros(most + 1, np.int64)
    while (left := np.flatnonzero(sums.single)).size:
        pattern, gap = [int(left[-1])], most - int(left[-1])
        exact = gap == 0
        while gap and not exact:
            if filling := sums.filling(gap, pattern):
                pattern, exact = pattern + filling, True
                break
            fitting = [n for n in left[left <= gap][::-1].tolist() if counts[n] > pattern.count(n)]
            if not fitting:
                break
            pattern.append(fitting[0])
            gap -= fitting[0]
        times = min(int(counts[n]) // pattern.count(n) for n in set(pattern))
        if exact:
            put(pattern, times)
            sums.take(pattern, times)
        else:  # nothing completes this length any more: it is left to best fit
            length = pattern[0]
            rest[length] += counts[length]
            sums.take([length], int(counts[length]))

    # Open sequences by gap: [gap] -> runs of (first sequence, how many).
    open_: dict[int, list[tuple[int, int]]] = {}
    for length in np.flatnonzero(rest)[::-1].tolist():
        todo = int(rest[length])
        while todo:
            gap = min((g for g in open_ if g >= length), default=None)
            if gap is None:
                room = most // length
                full, part = divmod(todo, room)
                for n, times in ((room, full), (part, 1)):
                    if n and times:
                        for k in range(n):
                            place(length, times, sequences, k * length)
                        open_.setdefault(most - n * length, []).append((sequences, times))
                        sequences += times
                break
            first, times = open_[gap].pop()
            if not open_[gap]:
                del open_[gap]
            used = min(times, todo)
            if used < times:
                open_.setdefault(gap, []).append((first + used, times - used))
            place(length, used, first, most - gap)
            open_.setdefault(gap - length, []).append((first, used))
            todo -= used
    return runs


def pack_documents(docs: DataFrame, tokenizer: str, most: int = 4096, end_id: int = 1,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: `id`, `piece`, `start`, `length`, `ids_crc32`, `sequence_id`, `offset`.

    A document is its ids and the end id; only a document of more than `most` ids is cut, into pieces of
    `most` ids and a last one. Null, empty and blank texts are the end id alone. Rows without an id and
    repeated rows are packed like any other. Other columns are not looked at. An empty table gives an empty
    table.
    """
    spark = docs.sparkSession
    pieces = settle(pieces_of(docs, tokenizer, most, end_id, id_col, text_col))
    counts = np.zeros(most + 1, np.int64)
    for row in pieces.groupBy("length").count().collect():  # at most `most` rows
        counts[row["length"]] = row["count"]

    runs = plan(counts)
    table = pa.table(dict(zip(("length", "first", "last", "sequence", "offset"),
                              (np.array(runs, np.int64).reshape(-1, 5)).T)))
    runs = spark.createDataFrame(table).select(
        "*", F.explode(F.sequence(F.floor(F.col("first") / RANK_BLOCK), F.floor(F.col("last") / RANK_BLOCK))).alias("block"))

    # Rank within a length: place within a share of the length's pieces, after all earlier shares.
    shares = spark.createDataFrame(pa.table({"length": np.arange(most + 1), "shares": -(-counts // SHARE)}))
    shared = pieces.join(F.broadcast(shares), "length").withColumn(  # most + 1 rows
        "share", F.pmod(F.xxhash64("id", "piece", "ids_crc32"), F.col("shares"))).drop("shares")
    sizes = shared.groupBy("length", "share").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("share")
    starts = sizes.select("length", "share", (F.sum("n").over(before) - F.col("n")).alias("before"))
    inside = Window.partitionBy("length", "share").orderBy("id", "piece", "ids_crc32")
    ranked = (
        shared.withColumn("nth", F.row_number().over(inside).cast("long") - 1)
        .join(starts, ["length", "share"])
        .withColumn("rank", F.col("before") + F.col("nth")).withColumn("block", F.floor(F.col("rank") / RANK_BLOCK))
    )
    return (
        ranked.join(runs, ["length", "block"]).where("rank BETWEEN first AND last")
        .select("id", "piece", "start", "length", "ids_crc32",
                (F.col("sequence") + F.col("rank") - F.col("first")).alias("sequence_id"), "offset")
    )
