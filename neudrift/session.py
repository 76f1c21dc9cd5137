"""Where intermediate results are kept, and the session settings the jobs are tuned for."""

import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

# Largest row count that is broadcast; about 100 MB for the narrow key tables used here.
BROADCAST_ROWS = 1_000_000

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Checkpoint files go when the last frame that uses them is gone.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

_scopes = threading.local()


def workspace(spark: SparkSession) -> str:
    """Folder for intermediate tables: the cluster's checkpoint folder, shared by all executors.

    Only a local session, where driver and executors share one disk, may fall back to a
    temporary folder of its own.
    """
    context = spark.sparkContext
    if not context.getCheckpointDir():
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            root = tempfile.mkdtemp(prefix="neudrift-")
        context.setCheckpointDir(root)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the workspace."""
    return f"{workspace(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def settling(spark: SparkSession):
    """A job: the tables that `settle` writes in it are deleted at its end.

    What a job returns must not depend on them; see `kept`.
    """
    outer, _scopes.paths = getattr(_scopes, "paths", None), []
    try:
        yield
    finally:
        for path in _scopes.paths:
            delete(spark, path)
        _scopes.paths = outer


def settle(df: DataFrame) -> DataFrame:
    """Compute once, into a table of the workspace, and go on from there.

    A lost executor does not lose the table. Within a job it is a Parquet table that the job deletes;
    outside it is a checkpoint, which Spark deletes when nothing uses it any more.
    """
    paths = getattr(_scopes, "paths", None)
    if paths is None:
        return kept(df)
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "settled")
    paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def kept(df: DataFrame) -> DataFrame:
    """Compute once what a job returns."""
    workspace(df.sparkSession)
    return df.checkpoint()


def last_use(df: DataFrame, *paths: str) -> DataFrame:
    """Compute once, and delete the folders that the rows were read from."""
    result = kept(df)
    for path in paths:
        delete(df.sparkSession, path)
    return result


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def delete(spark: SparkSession, path: str) -> None:
    files, where = _file_system(spark, path)
    files.delete(where, True)


def pruned_by(table: DataFrame, keys: DataFrame, on: list[str] | str) -> DataFrame:
    """The rows of a partitioned table whose partition columns `on` occur in `keys`, which has few rows. Only
    their partitions are read: the values are known when the scan starts (dynamic partition pruning), however
    many there are.

    Spark prunes by a side of a join only if that side is filtered, hence the condition that every row meets.
    """
    on = [on] if isinstance(on, str) else on
    some = settle(keys.select(*on).distinct())
    few = some.count() <= BROADCAST_ROWS
    some = some.where(F.coalesce(F.hash(*on), F.lit(0)) >= -(1 << 31))
    return table.join(F.broadcast(some) if few else some, on, "left_semi")


def move(spark: SparkSession, path: str, target: str) -> None:
    """Give a file another name, in a folder that is made if there is none."""
    files, where = _file_system(spark, path)
    goal = spark._jvm.org.apache.hadoop.fs.Path(target)
    files.mkdirs(goal.getParent())
    if not files.rename(where, goal):
        raise OSError(f"{path} could not be moved to {target}")


def join_small(left: DataFrame, small: DataFrame, on, how="inner", at_most=None) -> DataFrame:
    """Join a side that is expected to be small.

    It is broadcast when its row count (`at_most` if the caller can prove one, else counted) is
    within BROADCAST_ROWS. A larger one is left to the planner: shuffled, with hot join keys split
    by adaptive execution.
    """
    if at_most is None:
        at_most = small.count()
    return left.join(F.broadcast(small) if at_most <= BROADCAST_ROWS else small, on, how)


def read_or_empty(spark: SparkSession, reader, path: str, schema) -> DataFrame:
    """`reader(path)`, or an empty frame of `schema` when nothing has been written there yet."""
    try:
        return reader(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
