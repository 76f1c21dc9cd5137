"""Token counts of a unigram tokenizer, without making the tokens.

An Aho-Corasick automaton of the vocabulary enumerates, for every position, the pieces that end there.
Dynamic programming carries the best score up to each position and the number of pieces on that path,
nothing else. Ties follow the tokenizer: paths are extended from left to right and replaced only by a
better one, so of equal paths the one whose last piece starts first stays. A character that no piece of its
own covers may be taken alone at the lowest score of the vocabulary less 10, and counts as its UTF-8 bytes
where the vocabulary has byte pieces.

Where no piece of the vocabulary continues after a space mark that follows another character, which is
checked, texts fall apart at spaces, and a worker process remembers the counts of the parts it has met.
Scores are summed in double precision.

Counts are those of a unigram model over the pieces and scores of a file, whatever model the file is made for. Of a
BPE model, whose scores are ranks of merges, they are not the file's own counts.
"""

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from neudrift.llm.common import map_arrow
from neudrift.llm.words import blocks

# Fixed values of the tokenizer's format.
SPACE = "▁"
UNKNOWN_PENALTY = 10.0

# Parts whose counts a worker process remembers; a full table is started anew.
REMEMBERED = 400_000
_LONGEST = 64


def vocabulary(path: str) -> tuple[dict[str, float], bool]:
    """Pieces of a model file with their scores, and whether unknown characters become bytes."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.vocab_size())
    special = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i) for i in ids]
    scores = {model.id_to_piece(i): model.get_score(i) for i in ids if not special[i]}
    return scores, any(model.is_byte(i) for i in ids)


class UnigramCounter:
    """Counts of texts under one vocabulary."""

    _by_path: dict[str, "UnigramCounter"] = {}

    def __init__(self, scores: dict[str, float], bytes_for_unknown: bool = True):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in scores.items():
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(scores.values()) - UNKNOWN_PENALTY
        self.single = {piece for piece in scores if len(piece) == 1}
        self.bytes_for_unknown = bytes_for_unknown
        falls_apart = all(SPACE not in piece.lstrip(SPACE) for piece in scores)
        self.parts = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+" if falls_apart else r"(?s:.+)").findall
        self.known: dict[str, tuple[int, float]] = {}

    @classmethod
    def of(cls, path: str) -> "UnigramCounter":
        """The process's counter for a model file."""
        if path not in cls._by_path:
            cls._by_path[path] = cls(*vocabulary(path))
        return cls._by_path[path]

    def best_path(self, part: str) -> tuple[int, float]:
        """Number of pieces and score of the best segmentation."""
        n = len(part)
        score, pieces = [0.0] * (n + 1), [0] * (n + 1)
        matches = self.automaton.iter(part)
        ends, value = next(matches, (n, None))
        for end in range(1, n + 1):
            best = None
            while ends == end - 1:
                length, own = value
                # The automaton tells longer matches first, so an equal shorter one does not replace.
                if best is None or score[end - length] + own > best:
                    best, count = score[end - length] + own, pieces[end - length] + 1
                ends, value = next(matches, (n, None))
            char = part[end - 1]
            if char not in self.single and (best is None or score[end - 1] + self.unknown > best):
                best = score[end - 1] + self.unknown
                count = pieces[end - 1] + (len(char.encode()) if self.bytes_for_unknown else 1)
            score[end], pieces[end] = best, count
        return pieces[n], score[n]

    def count(self, text: str) -> tuple[int, float]:
        """Number of pieces and score of a text; spaces become marks, and one is put in front."""
        if not text:
            return 0, 0.0
        known, count, score = self.known, 0, 0.0
        for part in self.parts(SPACE + text.replace(" ", SPACE)):
            found = known.get(part)
            if found is None:
                found = self.best_path(part)
                if len(part) <= _LONGEST:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[part] = found
            count += found[0]
            score += found[1]
        return count, score


def token_counts(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`id`, `n_tokens` and `score`, the best path's, of every row. Nothing is shuffled.

    Null and empty texts have no tokens; blank ones have those of their spaces. Rows without an id and
    repeated rows are counted like any other. Other columns are not looked at. An empty table gives an empty
    table.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = UnigramCounter.of(model)
        for batch in batches:
            for part in blocks(batch, "text"):
                found = np.array([counter.count(t) if t else (0, 0.0) for t in part.column("text").to_pylist()],
                                 "f8").reshape(-1, 2)
                yield pa.record_batch([part.column("id"), pa.array(found[:, 0].astype(np.int64)), pa.array(found[:, 1])],
                                      names=["id", "n_tokens", "score"])

    return map_arrow(
        docs.select(docs[f"`{id_col}`"].cast("long").alias("id"), docs[f"`{text_col}`"].cast("string").alias("text")),
        run, "id long, n_tokens long, score double")
