"""Benchmark passages in training text, found through suffix arrays of the training text.

Every block of training text gets, in its task, an array of its suffixes (by words, in lexicographic
order of word hashes, to the depth a match needs). Every suffix of every test item is looked up in
every such array by binary search, one word deeper at a time, which gives the range of places where its
first words occur. Ranges that survive to the minimum length are occurrences, and occurrences that
follow each other on one diagonal are joined to the longest verbatim matches with their places.

Only suffixes that start like some test suffix (first two words) are put into the arrays; the others
cannot be in any range. Training text is read once and never shuffled. Test items are the stated query set:
they go to the tasks in blocks of at most `block_bytes`, one pass over the arrays for each.

A passage that an item repeats more than REPEATS times, such as one word over and over, would meet every place of
a text that repeats it once for each of its own places. Of such equal suffixes of an item the first is
looked up, and its places are joined along the text alone: the words hit and the items are the same, a match then
says where in the item its first words occur.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from neudrift.llm.common import map_arrow
from neudrift.llm.words import ALPHANUMERIC, blocks, hashes, mixed, spans, text_bytes

MATCH = "struct<item:long, doc_start:long, item_start:long, length:long>"
_MATCH = pa.struct([(n, pa.int64()) for n in ("item", "doc_start", "item_start", "length")])
_FILTER_BITS = 22
# Equal suffixes of an item that are looked up one by one, and places that are joined at a time, if no item has more.
REPEATS, TOGETHER = 16, 2_000_000


class Suffixes:
    """The suffixes of test items that are long enough to matter."""

    def __init__(self, ids: np.ndarray, texts: pa.Array, min_words: int):
        data, offsets = text_bytes(texts)
        starts, ends, bounds = spans(data, offsets, ALPHANUMERIC)
        sizes = np.diff(bounds)
        item = np.repeat(np.arange(len(ids)), sizes)
        place = np.arange(len(starts)) - bounds[:-1][item]
        need = np.minimum(min_words, sizes)[item]
        keep = sizes[item] - place >= need
        words = hashes(data, starts, ends, lower=True)
        self.words = np.concatenate((words, np.zeros(min_words, np.uint64)))
        self.at = np.flatnonzero(keep)
        self.item, self.place, self.need = ids[item[keep]], place[keep], need[keep]
        self._repeats(item[keep])
        self.prefix = 1 if len(self.need) and self.need.min() == 1 else 2
        self.starts_like = np.zeros(1 << _FILTER_BITS, bool)
        if len(self.at):
            self.starts_like[_prefix_keys(self.words, self.prefix)[self.at]] = True


    def _repeats(self, row: np.ndarray) -> None:
        """Leave the first of equal suffixes of an item if there are more than REPEATS, marked as `crowded`."""
        self.crowded = np.zeros(len(self.at), bool)
        if not len(self.at):
            return
        key = mixed(row.astype(np.uint64) * np.uint64(64) + self.need.astype(np.uint64))
        for d in range(int(self.need.max())):
            key = np.where(self.need > d, mixed(key ^ self.words[self.at + d]) + np.uint64(d), key)
        _, first, which, times = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
        self.crowded = times[which] > REPEATS
        kept = ~self.crowded
        kept[first] = True
        order = np.flatnonzero(kept)
        order = order[np.argsort(self.item[order], kind="stable")]
        for name in ("at", "item", "place", "need", "crowded"):
            setattr(self, name, getattr(self, name)[order])


def _prefix_keys(words: np.ndarray, prefix: int) -> np.ndarray:
    keys = words >> np.uint64(64 - _FILTER_BITS)
    if prefix == 2:
        pair = words[:-1] * np.uint64(3) + words[1:]
        keys[:-1] = mixed(pair) >> np.uint64(64 - _FILTER_BITS)
    return keys


def _bisect(column, low: np.ndarray, high: np.ndarray, wanted: np.ndarray, right: bool) -> np.ndarray:
    """Binary search of each wanted value in its own range of a column that is sorted within it."""
    low, high = low.copy(), high.copy()
    while (open_ := low < high).any():
        middle = (low + high) >> 1
        value = column(np.where(open_, middle, 0))
        go = open_ & ((value <= wanted) if right else (value < wanted))
        low = np.where(go, middle + 1, low)
        high = np.where(open_ & ~go, middle, high)
    return low


def matches_in(texts: pa.Array, tests: Suffixes, min_words: int):
    """Words per text, and (text, item, doc_start, item_start, length) of every longest match."""
    data, offsets = text_bytes(texts)
    starts, ends, bounds = spans(data, offsets, ALPHANUMERIC)
    counts = np.diff(bounds)
    none = np.zeros((5, 0), np.int64)
    if not len(starts) or not len(tests.at):
        return counts, none
    words = np.concatenate((hashes(data, starts, ends, lower=True), np.zeros(min_words, np.uint64)))
    suffixes = np.flatnonzero(tests.starts_like[_prefix_keys(words, tests.prefix)[:len(starts)]])
    if not len(suffixes):
        return counts, none
    text_of = np.repeat(np.arange(len(counts)), counts)
    end = bounds[1:][text_of[suffixes]]

    depth = int(tests.need.max())
    columns = [np.where(suffixes + d < end, words[suffixes + d], np.uint64(0)) for d in range(depth)]
    order = np.lexsort(columns[::-1])
    suffixes, columns = suffixes[order], [c[order] for c in columns]

    alive = np.arange(len(tests.at))
    low, high = np.zeros(len(alive), np.int64), np.full(len(alive), len(suffixes), np.int64)
    for d in range(depth):
        deeper = np.flatnonzero(tests.need[alive] > d)
        wanted = tests.words[tests.at[alive[deeper]] + d]
        column = columns[d].__getitem__
        l, h = low[deeper], high[deeper]
        low[deeper], high[deeper] = _bisect(column, l, h, wanted, False), _bisect(column, l, h, wanted, True)
        found = low < high
        alive, low, high = alive[found], low[found], high[found]
    if not len(alive):
        return counts, none

    # Tests are in order of item; what is joined at a time are the places of whole items.
    ends = np.flatnonzero(np.append(np.diff(tests.item[alive]) != 0, True)) + 1
    total = np.concatenate(([0], np.cumsum(high - low)))
    found, at = [], 0
    while at < len(alive):
        to = ends[max(int(np.searchsorted(total[ends], total[at] + TOGETHER, "right")) - 1, np.searchsorted(ends, at, "right"))]
        found.append(_joined(tests, alive[at:to], low[at:to], high[at:to], suffixes, text_of, bounds))
        at = to
    found = np.concatenate(found, axis=1)
    return counts, found[:, np.argsort(found[0], kind="stable")]


def _joined(tests: Suffixes, alive, low, high, suffixes, text_of, bounds) -> np.ndarray:
    """The places of some tests joined along their diagonals, those of crowded tests along the text."""
    sizes = high - low
    test = np.repeat(alive, sizes)
    nth = np.arange(len(test)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    place = suffixes[np.repeat(low, sizes) + nth]
    text = text_of[place]
    doc_start = place - bounds[:-1][text]
    item, item_start, need, crowded = tests.item[test], tests.place[test], tests.need[test], tests.crowded[test]
    diagonal = np.where(crowded, 0, doc_start - item_start)

    order = np.lexsort((doc_start, diagonal, crowded, item, text))
    text, item, doc_start, item_start, need, crowded, diagonal = (
        x[order] for x in (text, item, doc_start, item_start, need, crowded, diagonal))
    fresh = np.ones(len(text), bool)
    fresh[1:] = ((np.diff(text) != 0) | (np.diff(item) != 0) | (np.diff(doc_start) != 1)
                 | (np.diff(diagonal) != 0) | (crowded[1:] != crowded[:-1]))
    first = np.flatnonzero(fresh)
    last = np.concatenate((first[1:], [len(text)])) - 1
    length = doc_start[last] + need[last] - doc_start[first]
    return np.stack((text[first], item[first], doc_start[first], item_start[first], length))


def _pass(shared, min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests = shared.value
        for batch in batches:
            for part in blocks(batch, "text"):
                counts, (text, *found) = matches_in(part.column("text"), tests, min_words)
                bounds = np.searchsorted(text, np.arange(len(part) + 1)).astype(np.int32)
                rows = pa.StructArray.from_arrays([pa.array(x) for x in found], fields=list(_MATCH))
                new = pa.ListArray.from_arrays(pa.array(bounds), rows)
                columns = dict(zip(part.schema.names, part.columns))
                columns |= {"n_words": pa.array(counts.astype(np.int64)), "found": new}
                yield pa.record_batch(list(columns.values()), names=list(columns))

    return run


def _test_blocks(items: DataFrame, id_col: str, text_col: str, min_words: int, block_bytes: int):
    """Item numbers and texts, a bounded block at a time."""
    items = items.select(items[f"`{id_col}`"].cast("long").alias("id"), items[f"`{text_col}`"].alias("text"))
    items = items.where("id IS NOT NULL AND text IS NOT NULL")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = -(-total // block_bytes)
    for k in range(parts):
        mine = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(parts)) == k).toArrow()
        yield Suffixes(mine.column("id").to_numpy(), mine.column("text"), min_words)


def find_matches(docs: DataFrame, items: DataFrame, min_words: int = 10, block_bytes: int = 16 << 20,
                 id_col: str = "doc_id", text_col: str = "text",
                 item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of `docs` as a struct `row`, with `n_words` and `matches`, an array of (item, doc_start,
    item_start, length) in words: the longest verbatim matches of at least `min_words` words, or of the
    whole of an item that has fewer.

    Words are runs of ASCII letters and digits, A-Z lower-cased, and all other characters from U+0080.
    Null and empty texts have no words; items without words or without an id match nothing. Rows that
    repeat are answered each; items that repeat each have their matches. Other columns of `docs` are carried
    along. Empty tables give no rows, or rows without matches.
    """
    rows = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"),
        docs[f"`{text_col}`"].cast("string").alias("text"),
        F.lit(0).cast("long").alias("n_words"), F.array().cast(f"array<{MATCH}>").alias("matches"),
    )
    for tests in _test_blocks(items, item_id, item_text, min_words, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(tests)
        kind = rows.schema["row"].dataType.simpleString()
        rows = map_arrow(
            rows.select("row", "text", "matches"), _pass(shared, min_words),
            f"row {kind}, text string, matches array<{MATCH}>, n_words long, found array<{MATCH}>",
        ).select("row", "text", "n_words", F.concat("matches", "found").alias("matches"))
    return rows.select("row", "n_words", "matches")


def hit_words(matches: Column) -> Column:
    """Number of words inside any match: starts and lengths, merged from left to right."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to"))

    def add(state, match):
        end = match["doc_start"] + match["length"]
        new = F.greatest(end - F.greatest(match["doc_start"], state["to"]), F.lit(0))
        return F.struct((state["n"] + new).alias("n"), F.greatest(state["to"], end).alias("to"))

    by_start = F.array_sort(F.transform(
        matches, lambda m: F.struct(m["doc_start"].alias("doc_start"), m["length"].alias("length"))))
    return F.aggregate(by_start, start, add, lambda state: state["n"])


def decontaminate(docs: DataFrame, items: DataFrame, min_words: int = 10, **names) -> DataFrame:
    """The rows of `docs` that share no passage with the items, columns unchanged."""
    return find_matches(docs, items, min_words, **names).where(F.size("matches") == 0).select("row.*")
