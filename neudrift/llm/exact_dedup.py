"""Exact duplicates: one row of each group of equal texts stays.

Rows are reduced to (id, digest) first. Frequent digests are found by a Misra-Gries summary (Spark's
`freqItems`, which merges the summaries of all partitions); the candidates are counted exactly, and
those that really hold more than `support` of all rows, at most 1/support of them, are broadcast, so
that the rows of hot groups get their answer where they are. All other digests are shuffled.
"""

from pyspark.sql import Column, DataFrame, functions as F

from neudrift.llm.common import settle

# Runs of white space that a single space has to replace; a lone space can stay as it is.
RUNS = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), RUNS, " ")


def exact_duplicates(docs: DataFrame, support: float = 0.001,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: id, `keep_id`, `group_size`, `kept`, `text_sha256`, `hot`.

    Texts are equal when they are identical after each run of white space became one space; null counts
    as empty. The smallest id of a group stays; rows without an id stay only if their whole group has
    none. Of rows that repeat both id and text one stays. Other columns are not looked at. An empty
    table gives an empty table.
    """
    digest = F.unhex(F.sha2(normalised(docs[f"`{text_col}`"]), 256))
    rows = settle(
        docs.select(docs[f"`{id_col}`"].alias("id"), digest.alias("digest"))
        .groupBy("id", "digest").agg(F.count("*").alias("copies"))
        .withColumn("key", F.xxhash64("digest"))
    )
    group = [F.min("id").alias("keep_id"), F.sum("copies").alias("group_size")]

    candidates = rows.freqItems(["key"], support).select(F.explode("key_freqItems").alias("key"))
    least = rows.count() * support
    winners = settle(
        rows.join(F.broadcast(candidates), "key").groupBy("digest").agg(*group, F.count("*").alias("rows"))
        .where(F.col("rows") > least).drop("rows")
    )
    marked = rows.join(F.broadcast(winners), "digest", "left")
    hot = marked.where("group_size IS NOT NULL").withColumn("hot", F.lit(True))
    rest = marked.where("group_size IS NULL").select("id", "digest", "copies")
    cold = rest.join(rest.groupBy("digest").agg(*group), "digest").withColumn("hot", F.lit(False))
    names = ["id", "keep_id", "group_size", "copies", "digest", "hot"]
    return (
        hot.select(*names).unionByName(cold.select(*names))
        .select("*", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("nth"))
        .select(
            F.col("id").alias(id_col), "keep_id", "group_size",
            (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"), "hot",
        )
    )
