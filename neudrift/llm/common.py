"""What several operators share: reading, settled intermediate tables, text rules."""

import pathlib
import tempfile
import zipfile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from neudrift.session import BROADCAST_ROWS, workspace

# The white space of all contracts, and the ASCII letters they lower-case.
WHITE = "\t\n\x0b\x0c\r "
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
WHITE_RUN = r"[\x20\x09-\x0D]"

LAST_ID = 2**63 - 1
# Whether the files of an action's shuffles go at its end.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settle(df: DataFrame) -> DataFrame:
    """Compute a narrow table once, into the folder of `spark.checkpoint.dir`.

    The plan behind it is cut, so a lost executor costs no more than reading it again. Spark deletes
    the files when the last frame that uses them is gone, given
    `spark.cleaner.referenceTracking.cleanCheckpoints`.
    """
    workspace(df.sparkSession)
    return df.checkpoint()


def settle_last(make) -> DataFrame:
    """`settle(make())` for a frame that is not computed again: Spark deletes its shuffle files when the table is
    written, and not whenever the driver next collects garbage."""
    conf = SparkSession.active().conf
    before = conf.get(SHUFFLE_CLEANUP)
    conf.set(SHUFFLE_CLEANUP, "true")
    try:
        return settle(make())
    finally:
        conf.set(SHUFFLE_CLEANUP, before)


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`row`, the row as a struct whatever its columns are called, `id`, `text` without nulls, and a `key` that
    rows share only if they are equal in both."""
    return docs.select(
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), docs[f"`{id_col}`"].cast("long").alias("id"),
        F.coalesce(docs[f"`{text_col}`"].cast("string"), F.lit("")).alias("text"),
    ).withColumn("key", F.xxhash64("id", "text"))


def matching(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """Rows with ("left_semi") or without ("left_anti") one of the values in the only column of `keys`.

    Keys are broadcast if there are at most BROADCAST_ROWS, counted; else the rows are shuffled.
    """
    few = keys.count() <= BROADCAST_ROWS
    return rows.join(F.broadcast(keys) if few else keys, keys.columns[0], how)


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else; the quick way where every character is ASCII."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )


def rank_id(doc_id: Column) -> Column:
    """Ids in order; rows without an id count as one document after all others."""
    return F.coalesce(doc_id.cast("long"), F.lit(LAST_ID))


def map_arrow(df: DataFrame, run, schema: str) -> DataFrame:
    """`df.mapInArrow(run, schema)`, with this package sent along to executors that lack it.

    A worker process gives unused memory back at the end of each task, since others follow in it.
    """
    context = df.sparkSession.sparkContext
    if not getattr(context, "_sent_neudrift", False):
        package = pathlib.Path(__file__).resolve().parent.parent
        archive = pathlib.Path(tempfile.mkdtemp(prefix="neudrift-code-")) / "neudrift.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted(package.rglob("*.py")):
                out.write(file, file.relative_to(package.parent))
        context.addPyFile(str(archive))
        context._sent_neudrift = True

    def tidy(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(tidy, schema)
