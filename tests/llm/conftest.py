import random

import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "id long, key string, row string, line string, pos int, shard int, slot long, at string, fp long")
WORDS = ["alder", "Birch", "cedar,", "dogwood", "Élan", "fir.", "größe", "hazel", "iroko", "Juniper",
         "kapok", "larch", "maple", "ñandú", "oak", "pine", "quince", "rowan", "spruce", "teak"]


def text_of(rng, n, per_line=12):
    words = [rng.choice(WORDS) + rng.choice(["", "", "s", "ed", str(rng.randint(0, 99))]) for _ in range(n)]
    return "\n".join(" ".join(words[k:k + per_line]) for k in range(0, n, per_line))


@pytest.fixture(scope="session")
def odd_rows():
    """(doc_id, text) with nulls, empties, blanks, copies, near copies, shared passages and lines, a long text,
    repeated rows and rows without an id."""
    rng = random.Random(5)
    rows = [(k, text_of(rng, rng.randint(1, 120))) for k in range(10, 40)]
    passage = text_of(rng, 45, 1000)
    rows += [(k, f"{text_of(rng, 8)} {passage} {text_of(rng, 30)}") for k in (3, 50, 51)]
    line = "A shared   line, kept once"
    rows += [(k, f"{text_of(rng, 20)}\n  {line.upper()}\t\n{line}\nshort\n{text_of(rng, 5)}") for k in (60, 61, 2)]
    base = text_of(rng, 300)
    rows += [(70, base), (71, base.replace(" ", "  ", 40)), (72, base + " end"), (73, base.replace("\n", " \t\n"))]
    rows += [(80, None), (81, ""), (82, " \n\t "), (83, "\n\n"), (84, "one")]
    rows += [(90, text_of(rng, 6000)), (91, "word " * 700)]
    rows += [(95, base), (95, base), (96, passage), (96, text_of(rng, 25)), (None, passage), (None, base), (None, None)]
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    full = [(i, t, None if k % 5 == 0 else "en", f"s{k % 3}", len(t or ""), 7, "k", "r", "l", 1, 2, 3, "a", 4)
            for k, (i, t) in enumerate(odd_rows)]
    return spark.createDataFrame(full, SCHEMA).repartition(4)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def white_split(text):
    return (text or "").encode().split()
