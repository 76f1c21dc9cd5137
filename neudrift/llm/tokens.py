"""Ids of a public tokenizer, by distinct words.

The tokenizer file lower-cases, treats runs of white space as separators and then splits a text into runs of
letters, single digits and runs of other marks, before any merge. Where a piece between ASCII white space has
only ASCII and Latin-1 letters, digits and marks without apostrophe or <, these units can be told from its bytes;
any other piece is one unit, taken as it is written. A text's ids are those of its units, one after another. The units of a block of
texts are found on arrays, and only its distinct ones are looked up. Each worker process remembers the ids
of units that it has met, in a table of bounded size, and encodes new ones, many at once, since a
token that ends a word can be told from others. Units are found by a 64-bit hash and compared by their bytes.
"""

import numpy as np
import pyarrow as pa

from neudrift.llm.words import NOT_WHITE, hashes, mixed, text_bytes

# Units whose ids a worker process remembers, some 50 bytes each; a full table is begun anew.
REMEMBERED = 800_000
_LONGEST = 64

_WHITE_SPACE, _LETTER, _DIGIT, _MARK = range(4)
_CLASS = np.full(256, _MARK, np.uint8)
_CLASS[~NOT_WHITE] = _WHITE_SPACE
_CLASS[128:] = _LETTER
_CLASS[[b for b in range(128) if chr(b).isalpha()]] = _LETTER
_CLASS[48:58] = _DIGIT
# Sets the hashes of units that are not words apart from those of words.
_OTHER = np.uint64(0x5851F42D4C957F2D)
# Bytes that make the rule unsure: apostrophes, the < of special tokens, controls, and all of UTF-8 but the
# two of a Latin-1 letter.
_UNSURE = np.zeros(256, bool)
_UNSURE[[39, 60, *range(9), *range(14, 32), 127, *range(0x80, 256)]] = True
_LATIN_LEAD = 0xC3
_NO_LETTERS = (0x97, 0xB7)  # the second bytes of the multiplication and the division sign


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for every range, one after another."""
    after = np.cumsum(sizes)
    return np.arange(after[-1] if len(after) else 0) + np.repeat(starts - (after - sizes), sizes)


class Remembered:
    """Byte strings with their ids, on arrays sorted by the strings' hashes."""

    def __init__(self):
        self.hashes = np.zeros(0, np.uint64)
        # For each string: where its bytes and its ids begin, and how many there are.
        self.places = np.zeros((4, 0), np.int32)
        self.bytes, self.ids = np.zeros(0, np.uint8), np.zeros(0, np.uint16)

    def find(self, hashes: np.ndarray, names: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The place of each string, or -1; strings are given by their bytes in `names`, `hashes` rises."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        at[(self.hashes[at] != hashes) | (self.places[1][at] != sizes)] = -1
        here = np.flatnonzero(at >= 0)
        own = names[ranges(starts[here], sizes[here])] == self.bytes[ranges(self.places[0][at[here]], sizes[here])]
        firsts = np.cumsum(sizes[here]) - sizes[here]
        same = np.logical_and.reduceat(own, firsts) if len(here) else own
        at[here[~same]] = -1
        return at

    def add(self, hashes: np.ndarray, names: list[bytes], ids: list[bytes]) -> None:
        """Take in strings that are not in the table, by rising hash; of two with one hash the first stays."""
        if len(self.hashes) + len(names) > REMEMBERED:
            self.__init__()
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            new = np.flatnonzero(self.hashes[at] != hashes)
        else:
            new = np.arange(len(names))
        names, ids = [names[k] for k in new.tolist()], [ids[k] for k in new.tolist()]
        sizes = np.array([[len(n) for n in names], [len(i) // 4 for i in ids]], np.int32).reshape(2, -1)
        starts = np.cumsum(sizes, axis=1, dtype=np.int32) - sizes
        starts += np.array([[len(self.bytes)], [len(self.ids)]], np.int32)
        where = np.searchsorted(self.hashes, hashes[new])
        self.hashes = np.insert(self.hashes, where, hashes[new])
        self.places = np.insert(self.places, where, np.stack((starts[0], sizes[0], starts[1], sizes[1])), axis=1)
        self.bytes = np.concatenate((self.bytes, np.frombuffer(b"".join(names), np.uint8)))
        self.ids = np.concatenate((self.ids, np.frombuffer(b"".join(ids), "<u4").astype(np.uint16)))


def units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First and next-after-last byte of every unit, whether it is one word to the tokenizer, and the n + 1
    places in them where texts begin."""
    n = len(data)
    kind = _CLASS[data]
    unsure = _UNSURE[data]
    lead = np.flatnonzero(data[:-1] == _LATIN_LEAD)
    second = data[lead + 1]
    lead = lead[(second >= 0x80) & (second < 0xC0) & (second != _NO_LETTERS[0]) & (second != _NO_LETTERS[1])]
    unsure[lead] = False
    unsure[lead + 1] = False

    begins = np.zeros(n, bool)
    at = offsets[:-1]
    begins[at[at < n]] = True
    piece = kind != _WHITE_SPACE
    first = piece.copy()
    first[1:] &= ~piece[:-1] | begins[1:]
    last = piece.copy()
    last[:-1] &= ~piece[1:] | begins[1:]
    piece_starts, piece_ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    bad = np.zeros(len(piece_starts), bool)
    bad[np.searchsorted(piece_starts, np.flatnonzero(unsure & piece), "right") - 1] = True

    start = piece
    start[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT) | begins[1:]
    starts = np.flatnonzero(start)
    piece_of = np.cumsum(first[starts]) - 1
    outer = ~bad[piece_of] | first[starts]
    starts, piece_of = starts[outer], piece_of[outer]
    # A unit ends where the next begins, or at the white space or text end before that.
    ends = np.minimum(np.append(starts[1:], n), piece_ends[piece_of])
    return starts, ends, ~bad[piece_of], np.searchsorted(starts, offsets)


class WordEncoder:
    """Texts to their ids."""

    _by_path: dict[str, "WordEncoder"] = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        if max(vocabulary.values()) > np.iinfo(np.uint16).max:
            raise ValueError("a vocabulary of at most 65,536 ids is needed")
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.known = Remembered()

    @classmethod
    def of(cls, path: str) -> "WordEncoder":
        """The process's encoder of a file."""
        if path not in cls._by_path:
            cls._by_path[path] = cls(path)
        return cls._by_path[path]

    def _each(self, texts: list[bytes]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast([t.decode("utf-8", "replace") for t in texts], add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _words(self, words: list[bytes]) -> list[bytes]:
        """Ids of texts that are one word each."""
        out = []
        for at in range(0, len(words), 5_000):
            part = words[at:at + 5_000]
            ids = self.tokenizer.encode(b" ".join(part).decode(), add_special_tokens=False).ids
            ids = np.array(ids, "<u4")
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) != len(part) or ends[-1] != len(ids):
                out += self._each(part)
                continue
            raw, cuts = ids.tobytes(), (4 * ends).tolist()
            out += [raw[s:e] for s, e in zip([0, *cuts[:-1]], cuts)]
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids one after another, and the n + 1 places where texts begin."""
        data, offsets = text_bytes(texts)
        if not len(data):
            return np.zeros(0, "<u4"), np.zeros(len(offsets), np.int64)
        starts, ends, word, bounds = units(data, offsets)
        # Words that differ only in the case of ASCII letters have the same ids. Other units may not: special
        # tokens are found as they are written, and letters are composed before they are lower-cased.
        found = hashes(data, starts, ends, lower=True)
        found[~word] = mixed(hashes(data, starts[~word], ends[~word]) ^ _OTHER)
        distinct, where, which = np.unique(found, return_index=True, return_inverse=True)
        lower, upper = data.copy(), (data >= 65) & (data <= 90)
        kept = ranges(starts[~word], (ends - starts)[~word])
        upper[kept] = False
        lower[upper] += 32
        starts, sizes, word = starts[where], (ends - starts)[where], word[where]
        at = self.known.find(distinct, lower, starts, sizes)

        new = np.flatnonzero(at < 0)
        raw = lower.tobytes()
        names = [raw[s:s + n] for s, n in zip(starts[new].tolist(), sizes[new].tolist())]
        plain = word[new].tolist()
        words = iter(self._words([n for n, w in zip(names, plain) if w]))
        other = iter(self._each([n for n, w in zip(names, plain) if not w]))
        ids = [next(words) if w else next(other) for w in plain]

        found, known = np.flatnonzero(at >= 0), self.known
        counts, firsts = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        pool = known.ids[ranges(known.places[2][at[found]], known.places[3][at[found]].astype(np.int64))]
        counts[found] = known.places[3][at[found]]
        counts[new] = [len(i) // 4 for i in ids]
        firsts[found] = np.cumsum(counts[found]) - counts[found]
        firsts[new] = len(pool) + np.cumsum(counts[new]) - counts[new]
        pool = np.concatenate((pool.astype("<u4"), np.frombuffer(b"".join(ids), "<u4")))

        short = np.flatnonzero(sizes[new] <= _LONGEST).tolist()
        known.add(distinct[new[short]], [names[k] for k in short], [ids[k] for k in short])
        counts, firsts = counts[which], firsts[which]
        return pool[ranges(firsts, counts)], np.concatenate(([0], np.cumsum(counts)))[bounds]
