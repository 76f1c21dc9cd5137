"""Removal of lines that occur in several documents.

Every line is exploded with its position and a 128-bit hash of its normalised form. Per hash the
documents are counted (pre-aggregated before the shuffle). The positions of lines to drop go back to
their document, and the remaining lines are put together by position. Texts are shuffled once, for
that last join; a hash that a third of all lines share is one row per task in the count, and a skewed
join key, which adaptive execution splits, in the look-up.
"""

from pyspark.sql import Column, DataFrame, functions as F

from neudrift.llm.common import WHITE, lower_ascii, rank_id, settle


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(WHITE)))


def dedup_lines(docs: DataFrame, min_chars: int = 10, min_docs: int = 2,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` as a struct `row`, with `n_lines`, `n_dropped` and the text that stays, `kept`.

    A line is dropped if its key has at least `min_chars` characters, at least `min_docs` documents
    hold it, and this is not the one with the smallest id.

    A null or empty text is one empty line. Rows with equal ids are one document, and so are all rows
    without an id, which comes last; each row keeps its own lines. Other columns, whatever their names,
    are carried along untouched. An empty table gives an empty table.
    """
    rows = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"),
        rank_id(docs[f"`{id_col}`"]).alias("id"),
        F.coalesce(docs[f"`{text_col}`"], F.lit("")).alias("text"),
    ).withColumn("text_hash", F.xxhash64("text"))

    # Rows of one id and one text fare alike, so (id, text_hash) can stand for the row.
    lines = (
        rows.select("id", "text_hash", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
        .select("id", "text_hash", "pos", line_key(F.col("line")).alias("key"))
        .where(F.length("key") >= min_chars)
        .select("id", "text_hash", "pos", F.xxhash64("key").alias("h1"),
                F.xxhash64(F.lit(1), "key").alias("h2"))
    )
    if min_docs == 2:
        repeated = lines.groupBy("h1", "h2").agg(F.min("id").alias("first"), F.max("id").alias("last"))
        repeated = repeated.where("first < last")
    else:
        repeated = (
            lines.select("h1", "h2", "id").distinct().groupBy("h1", "h2")
            .agg(F.min("id").alias("first"), F.count("*").alias("docs")).where(F.col("docs") >= min_docs)
        )
    # As a table of its own the look-up is a plain join of two shuffles, whose hot keys can be split.
    repeated = settle(repeated.select("h1", "h2", "first"))
    dropped = (
        lines.join(repeated, ["h1", "h2"]).where("id != first")
        .groupBy("id", "text_hash").agg(F.collect_set("pos").alias("drop"))
    )
    split = F.split("text", "\n", -1)
    kept_at = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), "drop")
    # As a lambda's argument the lines are split off once, not again for each of them.
    joined = F.get(F.transform(F.array(split), lambda lines: F.array_join(
        F.transform(kept_at, lambda i: F.get(lines, i)), "\n")), 0)
    return rows.join(dropped, ["id", "text_hash"], "left").select(
        "row",
        F.size(split).cast("long").alias("n_lines"),
        F.coalesce(F.size("drop"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("drop").isNull(), F.col("text")).otherwise(joined).alias("kept"),
    )


def with_kept_lines(docs: DataFrame, text_col: str = "text", chars_col: str = "n_chars", **options) -> DataFrame:
    """`docs` with the text that stays, and its number of characters where there is a column for it."""
    row = F.col("row").withField(f"`{text_col}`", F.col("kept"))
    if chars_col in docs.columns:
        row = row.withField(f"`{chars_col}`", F.length("kept").cast(docs.schema[chars_col].dataType))
    return dedup_lines(docs, text_col=text_col, **options).select(row.alias("row")).select("row.*")
