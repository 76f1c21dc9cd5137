"""Byte-level BPE: texts to ids by ranked merges, and ids back to bytes.

Pieces of a text are found on arrays of character classes. Merges are done by Spark's higher-order functions, once
for a distinct piece: a fold over its adjacent pairs takes the pair of lowest rank, the leftmost of equals, joins
it and looks up its two new neighbours, until no pair has a rank. Ranks are a literal of the expression, a map per
checksum of the bytes, since a look-up in one map reads it from its beginning.

The pieces of all texts are counted, and those that occur most, KNOWN at most, are merged first and sent to every
task. The other pieces of a block of texts are merged beside it, in the same stage: texts are never shuffled.
A piece of more than FOLDED bytes, for which the fold's work would grow with the square of its length, is merged
with a heap in the task, to the same ids.
"""

import base64
import heapq
import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from neudrift.llm.common import map_arrow, settle, settle_last
from neudrift.llm.tokens import Remembered, ranges
from neudrift.llm.words import blocks, hashes, pack, text_bytes, unpack

# Distinct pieces that every task holds, of KNOWN_BYTES each at most; some 45 bytes of memory each.
KNOWN = 1 << 20
KNOWN_BYTES = 64
# Longest piece that the fold merges, in bytes; its pairs are coded with 10 bits for a place.
FOLDED = 256
_PLACE = 1 << 10
_NO_RANK = 1 << 20
_SLOTS = 1 << 15
# What is taken from an id for two signed bytes to hold it.
_HALF = 1 << 15

_LETTER, _NUMBER, _MARK, _SPACE = range(4)
# What may follow an apostrophe in a piece of its own.
_ONE, _TWO = "stmd", ("re", "ve", "ll")


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of byte strings, from lines of base64 text and a number."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    if max(ranks.values()) >= 1 << 16 or any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("a vocabulary of at most 65,536 ranks that has every single byte is needed")
    return ranks


def character_classes() -> np.ndarray:
    """Letter, number, white space or other mark for every code point, by the same tables as the tokenizer's
    library uses: an encoding that only matches one class keeps only its characters."""
    import tiktoken

    single = {bytes([b]): b for b in range(256)}
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    out = np.full(0x110000, _MARK, np.uint8)
    for kind, pattern in ((_LETTER, r"\p{L}"), (_NUMBER, r"\p{N}"), (_SPACE, r"\s")):
        only = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=single, special_tokens={})
        found = only.decode(only.encode_ordinary(every))
        out[np.frombuffer(found.encode("utf-32-le"), "<u4")] = kind
    return out


def piece_starts(data: np.ndarray, offsets: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """First bytes of all pieces of the texts that begin at `offsets`; together pieces cover every byte.

    Pieces are an apostrophe with s, t, re, ve, m, ll or d; runs of letters, of numbers or of other marks, each
    with a blank before it; and runs of white space, without the last one where text follows.
    """
    if not len(data):
        return np.zeros(0, np.int64)
    n = len(data)
    kind = classes[:256].take(data)
    # Every byte of a character has the character's class, so that places of bytes will do.
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        more = 1 + (data[lead] >= 0xE0) + (data[lead] >= 0xF0).astype(np.int64)
        point = data[lead].astype(np.int64) & (0x3F >> more)
        for k in (1, 2, 3):
            point = np.where(more >= k, point << 6 | data[np.minimum(lead + k, n - 1)] & 0x3F, point)
        found = classes[np.minimum(point, len(classes) - 1)]
        kind[lead] = found
        for k in (1, 2, 3):
            kind[lead[more >= k] + k] = found[more >= k]
    begins = offsets[:-1]
    begins = begins[begins < n]
    first = np.zeros(n + 4, bool)  # with room for what follows the last character
    first[begins] = True
    first[n:] = True
    starts = first.copy()
    starts[1:n] |= kind[1:] != kind[:-1]

    # White space before text of the same document: its last character stands alone or, a blank, joins the text.
    space = kind == _SPACE
    text = np.flatnonzero(space[:-1] & ~space[1:] & ~first[1:n]) + 1
    last = text - 1
    for _ in range(3):
        last = np.where(data[last] & 0xC0 == 0x80, last - 1, last)
    starts[last] = True
    starts[text] = data[text - 1] != 32

    quote = np.flatnonzero(data == 39)
    quote = quote[starts[quote]]
    after = np.zeros((2, len(quote)), np.uint8)  # the next two characters of the same document, else 0
    inside = np.ones(len(quote), bool)
    for k in (1, 2):
        inside &= ~first[quote + k]
        after[k - 1] = np.where(inside, data[np.minimum(quote + k, n - 1)], 0)
    one = np.isin(after[0], [ord(c) for c in _ONE])
    two = np.zeros(len(quote), bool)
    for x, y in _TWO:
        two |= (after[0] == ord(x)) & (after[1] == ord(y))
    starts[quote[one | two] + 1] = False
    starts[quote[one] + 2] = True
    starts[quote[two] + 3] = True
    return np.flatnonzero(starts[:n])


def _pieces(texts: pa.Array, classes: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """The number of each piece's distinct form, the distinct forms, and the n + 1 places where texts begin."""
    data, offsets = text_bytes(texts)
    starts = piece_starts(data, offsets, classes)
    cuts = np.append(starts, len(data)).astype(np.int64)
    every = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(cuts), pa.py_buffer(np.ascontiguousarray(data))])
    coded = every.dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary, np.searchsorted(starts, offsets)


def _raw(pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of binary values one after another, and the n + 1 places where they begin."""
    pieces = pieces.cast(pa.large_binary())
    _, offsets, data = pieces.buffers()
    offsets = np.frombuffer(offsets, np.int64)[pieces.offset:pieces.offset + len(pieces) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def _binary(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Binary values that lie one after another in `data`."""
    out = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(bounds) - 1,
        [None, pa.py_buffer(np.ascontiguousarray(bounds, np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
    return out.cast(pa.binary())


def _code(forms: int) -> np.dtype:
    """The type of a number of one of so many distinct forms."""
    return np.dtype("<u2" if forms <= 1 << 16 else "<i4")


def _one_list(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _latin(pieces: pa.Array) -> pa.Array:
    """Binary values as strings of one character per byte."""
    data, offsets = _raw(pieces)
    wide = np.concatenate(([0], np.cumsum(data >= 128)))[offsets]
    return pa.LargeStringArray.from_buffers(
        len(pieces), pa.py_buffer(offsets + wide), pa.py_buffer(data.tobytes().decode("latin-1").encode())).cast(pa.string())


# Merging by higher-order functions

def rank_of(ranks: dict[bytes, int]):
    """A look-up of byte strings, written with one character per byte, in a literal map of ranks."""
    slots = [{} for _ in range(_SLOTS)]
    for token, rank in ranks.items():
        name = token.decode("latin-1")
        slots[zlib.crc32(name.encode()) % _SLOTS][name] = rank
    literal = F.from_json(F.lit(json.dumps(slots, separators=(",", ":"))), "array<map<string,int>>")
    return lambda name: F.try_element_at(F.get(literal, F.crc32(name).bitwiseAND(_SLOTS - 1).cast("int")), name)


def _bound(value: Column, use) -> Column:
    """`use(value)` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def merged(piece: Column, look) -> Column:
    """Ids of a piece of 2 to FOLDED bytes, written with one character per byte.

    The state of the fold is a number per pair of neighbours, in order: rank, start, middle and end. A step looks
    up the ranks of new pairs, which begin with rank 0 and a mark, and joins the best pair. The look-up is written
    once for all steps and once for the ids, since each holds the whole literal.
    """
    size = F.length(piece)
    marked, none = F.lit(-1).cast("long"), _NO_RANK * _PLACE ** 3

    def part(start, end):
        return F.substring(piece, start.cast("int") + 1, (end - start).cast("int"))

    def field(pair, shift):
        return F.shiftright(pair, shift).bitwiseAND(_PLACE - 1)

    def start(pair):
        return field(pair, 20)

    def middle(pair):
        return field(pair, 10)

    def end(pair):
        return pair.bitwiseAND(_PLACE - 1)

    def new(a, b, c):
        return marked * _PLACE ** 3 + (a * _PLACE + b) * _PLACE + c

    def ranked(pair):
        rank = F.coalesce(look(part(start(pair), end(pair))), F.lit(_NO_RANK)).cast("long")
        return F.when(pair < 0, pair + (rank + 1) * _PLACE ** 3).otherwise(pair)

    def joined(pairs, best):
        left, right = start(best), end(best)
        return F.transform(
            F.filter(pairs, lambda p: p != best),
            lambda p: F.when(middle(p) == left, new(start(p), left, right))
            .when(middle(p) == right, new(left, right, end(p))).otherwise(p))

    def step(pairs, _):
        return _bound(F.transform(pairs, ranked), lambda now: _bound(
            F.array_min(now), lambda best: F.when(best < none, joined(now, best)).otherwise(now)))

    def ids(pairs):
        starts = F.concat(F.transform(pairs, start), F.array(F.when(
            F.size(pairs) == 0, F.lit(0).cast("long")).otherwise(middle(F.get(pairs, F.size(pairs) - 1)))))
        ends = F.concat(F.transform(pairs, middle), F.array(size.cast("long")))
        return F.zip_with(starts, ends, lambda a, b: look(part(a, b)))

    places = F.sequence(F.lit(1).cast("long"), size.cast("long") - 1)
    pairs = F.transform(places, lambda k: new(k - 1, k, k + 1))
    return _bound(F.aggregate(F.sequence(F.lit(2), size), pairs, step), ids)


def folded(pieces: Column, look) -> Column:
    """`sizes` and `ids`: the numbers of ids of an array of pieces, and the ids less _HALF one after another. An array
    for each piece would take some 40 bytes, these take some seven."""
    return _bound(F.transform(pieces, lambda p: merged(p, look)), lambda lists: F.struct(
        F.transform(lists, lambda ids: F.size(ids).cast("short")).alias("sizes"),
        F.transform(F.flatten(lists), lambda i: (i - _HALF).cast("short")).alias("ids")))


def merged_with_heap(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same ids for a piece of any length, in time that grows little faster than it."""
    n = len(piece)
    before = list(range(-1, n - 1))  # where the part before begins
    end = list(range(1, n + 1))  # where the part that begins here ends; 0 where none begins
    heap = [(ranks[piece[k:k + 2]], k, k + 2) for k in range(n - 1) if piece[k:k + 2] in ranks]
    heapq.heapify(heap)
    while heap:
        _, k, to = heapq.heappop(heap)
        middle = end[k]
        if not middle or middle >= n or end[middle] != to:
            continue  # one of the two has changed
        end[k], end[middle] = to, 0
        if to < n:
            before[to] = k
            rank = ranks.get(piece[k:end[to]])
            if rank is not None:
                heapq.heappush(heap, (rank, k, end[to]))
        if before[k] >= 0:
            rank = ranks.get(piece[before[k]:to])
            if rank is not None:
                heapq.heappush(heap, (rank, before[k], to))
    out, k = [], 0
    while k < n:
        out.append(ranks[piece[k:end[k]]])
        k = end[k]
    return out


# The pieces that every task knows

def _counts(texts: DataFrame, classes) -> DataFrame:
    """(piece, n) over all texts, the pieces written with one character per byte; single bytes and pieces of more
    than KNOWN_BYTES left out."""
    def run(batches):
        for batch in batches:
            for part in blocks(batch, "text"):
                which, forms, _ = _pieces(part.column("text"), classes.value)
                sizes = np.diff(_raw(forms)[1])
                keep = pa.array((sizes > 1) & (sizes <= KNOWN_BYTES))
                n = pa.array(np.bincount(which, minlength=len(forms)))
                yield pa.RecordBatch.from_arrays([_latin(forms.filter(keep)), n.filter(keep)], ["piece", "n"])

    return map_arrow(texts, run, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))


def frequent(counts: DataFrame, most: int) -> DataFrame:
    """The pieces above the lowest count that leaves `most` of them at most.

    Counts are told apart up to 1,024 and in steps of a twenty-fourth above, so the driver reads some 1,500 rows.
    """
    level = F.when(F.col("n") < 1024, F.col("n")).otherwise(1024 + F.floor(F.log2(F.col("n") / 1024) * 16)).cast("int")
    taken, lowest = 0, None
    for at, n in sorted(counts.groupBy(level.alias("level")).count().collect(), reverse=True):
        taken += n
        if taken > most:
            break
        lowest = at
    return counts.where(F.lit(False) if lowest is None else level >= lowest).select("piece")


def known_table(names: pa.Array, ids: pa.Array) -> dict:
    """Binary names and their lists of ids as plain arrays, in order of the names' hashes."""
    found = _hashed(names)
    order = pa.array(np.argsort(found, kind="stable"))
    names, ids = names.take(order), ids.take(order)
    data, offsets = _raw(names)
    return {"hashes": found[order.to_numpy()], "bytes": data, "sizes": np.diff(offsets).astype(np.uint8),
            "counts": np.diff(ids.offsets.to_numpy()).astype(np.uint8), "ids": ids.flatten().to_numpy().astype(np.uint16)}


def _hashed(names: pa.Array) -> np.ndarray:
    data, offsets = _raw(names)
    return hashes(data, offsets[:-1], offsets[1:])


class Known:
    """Pieces with their ids, found by hash and compared by bytes."""

    def __init__(self, table: dict):
        self.table = Remembered()
        self.table.hashes, self.table.bytes, self.table.ids = table["hashes"], table["bytes"], table["ids"]
        places = np.empty((4, len(table["hashes"])), np.int32)
        for at, lengths in ((0, table["sizes"]), (2, table["counts"])):
            np.cumsum(lengths, out=places[at], dtype=np.int32)
            places[at] -= lengths
            places[at + 1] = lengths
        self.table.places = places

    def find(self, forms: pa.Array) -> np.ndarray:
        """The place of each form, or -1."""
        data, offsets = _raw(forms)
        found = _hashed(forms)
        order = np.argsort(found, kind="stable")
        out = np.empty(len(found), np.int64)
        out[order] = self.table.find(found[order], data, offsets[:-1][order], np.diff(offsets)[order])
        return out


_PROCESS: dict = {}


def _known(shared) -> Known:
    """The process's table of pieces, made from what was sent."""
    if _PROCESS.get("id") != shared.value["id"]:
        _PROCESS.clear()
        _PROCESS.update(id=shared.value["id"], known=Known(shared.value))
    return _PROCESS["known"]


def _prepare(texts: DataFrame, ranks: dict[bytes, int], look, classes, known: int):
    """The most frequent pieces with their ids, as a broadcast variable. One that occurs once is merged once anyhow,
    with the others of its block."""
    chosen = frequent(settle_last(lambda: _counts(texts, classes).where("n > 1")), known)
    found = chosen.select(F.encode("piece", "ISO-8859-1").alias("bytes"), merged(F.col("piece"), look).alias("ids"))
    single = pa.table({"bytes": [bytes([b]) for b in range(256)], "ids": [[ranks[bytes([b])]] for b in range(256)]},
                      schema=pa.schema({"bytes": pa.binary(), "ids": pa.list_(pa.int32())}))
    sent = pa.concat_tables([found.toArrow().cast(single.schema), single]).combine_chunks()
    table = known_table(sent["bytes"].chunk(0), sent["ids"].chunk(0))
    return texts.sparkSession.sparkContext.broadcast(table | {"id": uuid.uuid4().hex})


# Encoding and decoding

def _by_id(ranks: dict[bytes, int]) -> list[bytes]:
    pieces = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        pieces[rank] = token
    return pieces


def _decoded(by_id: pa.Array, ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The binary pieces of each run of ids, one after another; `bounds` are the n + 1 places of the runs."""
    data, offsets = _raw(by_id.take(pa.array(ids)))
    return _binary(data, offsets[bounds])


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", known: int = KNOWN,
           decoded: bool = False) -> DataFrame:
    """`id`, `n_tokens` and `ids` (binary: little-endian unsigned 32-bit numbers) of every text, and with `decoded`
    what `decode` makes of the ids, in the same task.

    A null or empty text has no ids. Rows are taken one by one, so repeated rows, equal ids and rows without
    an id stay as they are; other columns are not read. An empty table gives an empty table. Texts are taken as
    valid UTF-8, and a text of any length is one unit of work, some 20 bytes of memory for a byte of it.
    """
    spark, ranks = docs.sparkSession, read_ranks(path)
    look = rank_of(ranks)
    classes = spark.sparkContext.broadcast(character_classes())
    texts = docs.select(docs[f"`{id_col}`"].alias("id"), F.coalesce(docs[f"`{text_col}`"].cast("string"), F.lit("")).alias("text"))
    id_type = texts.schema["id"].dataType.simpleString()
    shared = _prepare(texts.select("text"), ranks, look, classes, known)
    all_ranks = spark.sparkContext.broadcast((ranks, _by_id(ranks)))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, ranks = _known(shared), all_ranks.value[0]
        for batch in batches:
            for part in blocks(batch, "text"):
                which, forms, bounds = _pieces(part.column("text"), classes.value)
                place = table.find(forms)
                new, old = np.flatnonzero(place < 0), place[place >= 0]
                sizes = np.diff(_raw(forms)[1])[new]
                # Those for the fold, and those that are too long for it.
                short, long = new[sizes <= FOLDED], new[sizes > FOLDED]
                heaped = [np.array(merged_with_heap(p, ranks), "<u2") for p in forms.take(pa.array(long)).to_pylist()]
                # Numbers of ids of known forms, less than 0 for long ones, and 0 for those that the fold merges.
                counts = np.zeros(len(place), "<i4")
                counts[place >= 0] = table.table.places[3][old]
                counts[long] = [-len(ids) for ids in heaped]
                ids = table.table.ids[ranges(table.table.places[2][old].astype(np.int64), table.table.places[3][old].astype(np.int64))]
                packed = [counts, np.concatenate((ids.astype("<u2"), *heaped)), bounds.astype("<i8"), which.astype(_code(len(forms)))]
                yield pa.RecordBatch.from_arrays(
                    [_one_list(_latin(forms.take(pa.array(short)))), _one_list(part.column("id")),
                     *[pa.array([pack(values)], pa.binary()) for values in packed]],
                    ["others", "docs", "counts", "ids", "bounds", "pieces"])

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_id = pa.array(all_ranks.value[1], pa.large_binary())
        for batch in batches:
            for k in range(len(batch)):
                def packed(name, dtype):
                    return unpack(batch.column(name)[k].as_py(), dtype)

                given = packed("counts", "<i4")
                counts = np.abs(given).astype(np.int64)
                counts[given == 0] = batch.column("new_sizes")[k].values.to_numpy()
                new_ids = batch.column("new_ids")[k].values.to_numpy().astype("<i4") + _HALF
                pool = np.concatenate((packed("ids", "<u2"), new_ids)).astype("<u4")
                # The pool has the ids of known forms, of long ones, and of those from the fold.
                order = np.concatenate([np.flatnonzero(some) for some in (given > 0, given < 0, given == 0)])
                firsts = np.empty_like(counts)
                firsts[order] = np.cumsum(counts[order]) - counts[order]

                codes, cuts = packed("pieces", _code(len(given))), packed("bounds", "<i8")
                sizes = counts[codes]
                bounds = np.concatenate(([0], np.cumsum(sizes)))[cuts]
                ids = pool[ranges(firsts[codes], sizes)]
                out = [batch.column("docs")[k].values, pa.array(np.diff(bounds), pa.int64()), _binary(ids, 4 * bounds)]
                if decoded:
                    out.append(_decoded(by_id, ids, bounds))
                yield pa.RecordBatch.from_arrays(out, ["id", "n_tokens", "ids", "decoded"][:len(out)])

    # A row is a block of texts: its pieces that are not known, and its texts as packed numbers of distinct
    # pieces. As a table between the two it costs nearly the Parquet input, and a task has one Python process, not two.
    rows = map_arrow(texts, split, f"others array<string>, docs array<{id_type}>, counts binary, ids binary, "
                                   "bounds binary, pieces binary")
    blocked = settle(rows.withColumn("others", folded(F.col("others"), look)))
    blocked = blocked.select(F.col("others.sizes").alias("new_sizes"), F.col("others.ids").alias("new_ids"), *rows.columns[1:])
    schema = f"id {id_type}, n_tokens long, ids binary"
    return map_arrow(blocked, assemble, f"{schema}, decoded binary" if decoded else schema)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """`encoded` as `encode` returns it, with `decoded`: the binary pieces of its ids, one after another.

    A null is taken as no ids.
    """
    shared = encoded.sparkSession.sparkContext.broadcast(_by_id(read_ranks(path)))

    def run(batches):
        by_id = pa.array(shared.value, pa.large_binary())
        for batch in batches:
            packed, cuts = _raw(batch.column("ids").fill_null(b""))
            out = _decoded(by_id, packed.view("<u4"), cuts // 4)
            yield pa.RecordBatch.from_arrays([*batch.columns, out], [*batch.schema.names, "decoded"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return map_arrow(encoded, run, f"{schema}, decoded binary")
