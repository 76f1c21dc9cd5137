"""A manifest of a dataset as a hash tree, with proofs, and versions of it for changed rows.

A row is a leaf; leaves of one source, in order of id, are the leaves of that source's tree, and the roots of the
sources' trees, in order of source, are the leaves of the top tree. A node is the hash of up to ARITY consecutive
nodes below it.

Trees are kept in aligned blocks of BLOCK leaves, which are LEVELS levels high. A pass upwards hashes every block
of one height on its own and hands on its topmost nodes, which make up the next height's blocks; a block is one row. A
pass downwards gives every block its path, the siblings above it. Blocks and paths are the stored tree, and
never change. A changed leaf makes a version: its ancestors are copied within its block and then along the block's
path, and every other node is shared with the tree. As paths have come down to the lowest blocks, versions are
made there, all at once, however many share an upper block.

Leaves are numbered by sorted ranges: a leaf's number is its place in its range plus the leaves of its source in
the ranges before. So a source that holds most rows is dealt like any other.
"""

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from neudrift.llm.common import lower_ascii, map_arrow, settle
from neudrift.session import join_small

ARITY, LEVELS = 16, 2
BLOCK = ARITY ** LEVELS
DIGEST = 32
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
CHANGED_EVERY = 5


def leaf_hash(*values: Column) -> Column:
    """SHA-256, in lowercase hex, of every value with its length in bytes before it; `-` for null."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[
        F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def is_tampered(doc_id: Column) -> Column:
    """One in CHANGED_EVERY, by the checksum of the id; never a row without an id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % CHANGED_EVERY == 0, F.lit(False))


# Numbering

def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """`rows` with `pos`, from 0 in the order of `order` within `group`, and `n`, the rows of that group.

    Rows that are equal in all of `order` are numbered in any order.
    """
    marked = settle(rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
                    .withColumn("_at", F.monotonically_increasing_id()))
    # The upper 31 bits are the range, the lower 33 the place in it.
    marked = marked.withColumn("_range", F.shiftright("_at", 33))
    sizes = marked.groupBy(group, "_range").agg(F.min("_at").alias("_first"), F.count("*").alias("_size"))
    whole = Window.partitionBy(group)
    before = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = settle(sizes.select(
        group, "_range", (F.coalesce(F.sum("_size").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_size").over(whole).alias("n")))
    return join_small(marked, starts, [group, "_range"]).withColumn("pos", F.col("_at") + F.col("_shift")).drop(
        "_at", "_range", "_shift")


# Blocks

def _node(run: bytes) -> bytes:
    return hashlib.sha256(run.hex().encode()).digest()


def block_levels(leaves: bytes, n: int) -> list[bytes]:
    """The levels of a block from its leaves up, each as digests one after another; `n` is the number of nodes
    that the tree has at this height. A tree that ends inside the block has fewer levels."""
    out = [leaves]
    for _ in range(LEVELS):
        if n == 1:
            break
        below = out[-1]
        out.append(b"".join(_node(below[k:k + ARITY * DIGEST]) for k in range(0, len(below), ARITY * DIGEST)))
        n = -(-n // ARITY)
    return out


def siblings(levels: list[bytes], at: int) -> list[tuple[bytes, bytes]]:
    """For a leaf of a block, level by level, the siblings before and after its ancestor."""
    out = []
    for below in levels[:-1]:
        run = at // ARITY * ARITY * DIGEST
        here = at * DIGEST
        out.append((below[run:here], below[here + DIGEST:run + ARITY * DIGEST]))
        at //= ARITY
    return out


def folded(digest: bytes, path: list[tuple[bytes, bytes]]) -> bytes:
    """The topmost of the ancestors that a changed node copies along `path`."""
    for before, after in path:
        digest = _node(before + digest + after)
    return digest


def _grouped(nodes: DataFrame, *extra: str) -> DataFrame:
    """A row per block: its leaves in order."""
    leaf = F.struct("pos", "digest", *extra)
    return nodes.groupBy("tree", F.floor(F.col("pos") / BLOCK).alias("block"), "n").agg(
        F.sort_array(F.collect_list(leaf)).alias("leaves"))


def _tops(blocks: DataFrame) -> DataFrame:
    """The topmost node of every block, as a node of the next height."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tops = []
            for leaves, n in zip(batch.column("leaves"), batch.column("n").to_pylist()):
                digests = b"".join(leaves.values.field("digest").to_pylist())
                tops.append(block_levels(digests, n)[-1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("tree"), batch.column("block"), batch.column("n"), pa.array(tops, pa.binary())],
                ["tree", "pos", "n", "digest"])

    found = map_arrow(blocks.select("tree", "block", "n", "leaves"), run, "tree long, pos long, n long, digest binary")
    return found.withColumn("n", F.ceil(F.col("n") / BLOCK))


PATH = "array<struct<before:binary,after:binary>>"
_PATH_TYPE = pa.list_(pa.struct([("before", pa.binary()), ("after", pa.binary())]))


def _paths(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """The path of every leaf of every block, given the blocks' own paths: (tree, pos, path)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tree, block, n, leaves, path in zip(*[batch.column(k) for k in range(5)]):
                digests = b"".join(leaves.values.field("digest").to_pylist())
                levels, upper = block_levels(digests, n.as_py()), path.as_py()
                size = len(digests) // DIGEST
                paths = [[{"before": b, "after": a} for b, a in siblings(levels, k)] + upper for k in range(size)]
                yield pa.RecordBatch.from_arrays([
                    pa.array([tree.as_py()] * size, pa.int64()),
                    pa.array([block.as_py() * BLOCK + k for k in range(size)], pa.int64()),
                    pa.array(paths, _PATH_TYPE)], ["tree", "pos", "path"])

    joined = blocks.join(above, ["tree", "block"]).select("tree", "block", "n", "leaves", "path")
    return map_arrow(joined, run, f"tree long, pos long, path {PATH}")


class Forest:
    """The blocks of one or more trees, height by height, and the roots."""

    def __init__(self, lowest: DataFrame, most: int):
        """`lowest`: a row per lowest block (tree, block, n, leaves), `most`: the leaves of the largest tree."""
        self.heights, self.lowest = [], lowest
        tops, ended = _tops(lowest), []
        while most > BLOCK:
            tops = settle(tops)
            ended.append(tops.where("n = 1"))
            blocks = _grouped(tops.where("n > 1"))
            self.heights.append(blocks)
            tops = _tops(blocks)
            most = -(-most // BLOCK)
        # (tree, digest)
        self.roots = tops
        for done in ended:
            self.roots = self.roots.unionByName(done)
        self.roots = settle(self.roots.select("tree", "digest"))

    def paths(self, roots_paths: DataFrame) -> DataFrame:
        """The path of every lowest block, given those of the roots (tree, path): (tree, block, path)."""
        known = roots_paths.select("tree", F.lit(0).cast("long").alias("block"), "path")
        for blocks in reversed(self.heights):
            below = _paths(blocks, known).withColumnRenamed("pos", "block")
            # Trees that ended further down have not had their paths extended by these blocks.
            ended = known.join(blocks.select("tree").distinct(), "tree", "left_anti")
            known = settle(below.unionByName(ended))
        return known


def manifest(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source",
             fields: tuple[str, ...] = FIELDS, text_col: str = "text") -> DataFrame:
    """A row per row of `docs`: `id`, `tampered`, `leaf`, `changed` (the leaf of the tampered row, else null),
    `siblings` (level by level, before and after), `subroot`, `root` and `folded_root`, the root of the version
    that the changed leaf makes, else of the tree. Digests are 32 bytes, leaves lowercase hex.

    Rows without a source make one tree, the first. Within a source rows without an id come first, and rows with
    equal ids are in order of their leaves; repeated rows are leaves each. Null and empty texts differ.
    Other columns are not read. An empty table gives an empty table.
    """
    spark = docs.sparkSession
    column = {name: docs[f"`{name}`"] for name in (id_col, source_col, *fields)}
    tampered = is_tampered(column[id_col])
    plain = leaf_hash(*[column[f] for f in fields])
    other = leaf_hash(*[lower_ascii(column[f]) if f == text_col else column[f] for f in fields])
    rows = docs.select(
        # A name that sorts rows without a source first and tells them from an empty one.
        F.coalesce(F.concat(F.lit("="), column[source_col].cast("string")), F.lit("")).alias("source"),
        column[id_col].alias("id"), F.unhex(plain).alias("digest"), F.when(tampered, F.unhex(other)).alias("changed"))
    leaves = numbered(settle(rows), "source", ["id", "digest"])  # ranges are drawn by reading all rows once more
    sources = leaves.groupBy("source").agg(F.max("n").alias("n"))
    sources = settle(numbered(sources.withColumnRenamed("n", "rows").withColumn("all", F.lit(0)), "all", ["source"]))
    size = sources.agg(F.max("rows").alias("rows"), F.max("n").alias("n")).first()
    if size.rows is None:
        return spark.createDataFrame([], _schema(rows))

    leaves = join_small(leaves, sources.select("source", F.col("pos").alias("tree")), "source", at_most=size.n)
    lowest = settle(_grouped(leaves.select("tree", "pos", "n", "digest", "id", "changed"), "id", "changed"))
    trees = Forest(lowest, size.rows)
    top_leaves = sources.select(F.col("pos").alias("tree"), "pos", "n").join(trees.roots, "tree")
    top = Forest(settle(_grouped(top_leaves.select(F.lit(0).cast("long").alias("tree"), "pos", "n", "digest"))), size.n)
    root = top.roots.select("digest").first()[0]

    no_path = spark.range(1).select(F.col("id").alias("tree"), F.array().cast(PATH).alias("path"))
    source_paths = _paths(top.lowest, top.paths(no_path)).select(F.col("pos").alias("tree"), "path")
    subroots = trees.roots.withColumnRenamed("digest", "subroot")
    paths = trees.paths(source_paths).join(subroots, "tree")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, leaves, path, subroot in zip(*[batch.column(k) for k in range(4)]):
                nodes = leaves.values
                digests, changed = nodes.field("digest").to_pylist(), nodes.field("changed").to_pylist()
                levels = block_levels(b"".join(digests), n.as_py())
                upper = [(p["before"], p["after"]) for p in path.as_py()]
                full = [siblings(levels, k) + upper for k in range(len(digests))]
                roots = [folded(d if c is None else c, p) for d, c, p in zip(digests, changed, full)]
                yield pa.RecordBatch.from_arrays([
                    nodes.field("id"), pa.array([c is not None for c in changed]),
                    pa.array(digests, pa.binary()), nodes.field("changed"),
                    pa.array([[{"before": b, "after": a} for b, a in p] for p in full], _PATH_TYPE),
                    pa.array([subroot.as_py()] * len(digests), pa.binary()),
                    pa.array([root] * len(digests), pa.binary()), pa.array(roots, pa.binary()),
                ], names)

    schema = _schema(rows)
    names = [part.split(" ")[0] for part in schema.split(", ")]
    packed = trees.lowest.join(paths, ["tree", "block"]).select("n", "leaves", "path", "subroot")
    return map_arrow(packed, run, schema)


def _schema(rows: DataFrame) -> str:
    return (f"id {rows.schema['id'].dataType.simpleString()}, tampered boolean, leaf binary, changed binary, "
            f"siblings {PATH}, subroot binary, root binary, folded_root binary")


def hexed(digest: str | Column) -> Column:
    return F.lower(F.hex(digest))


def proof_hash(path: str = "siblings") -> Column:
    """The hash of all siblings of a leaf, in lowercase hex, from the leaf's level to the root's, left to right."""
    run = F.array_join(F.transform(path, lambda p: F.concat(hexed(p["before"]), hexed(p["after"]))), "")
    return F.sha2(run, 256)
