"""Sharding through fixed virtual slots.

A record's slot is a hash of its id and text, modulo a number of slots that never changes. Bytes are
summed per slot, and a map from slot to shard is stored as a table with a version for every edit. An
edit moves slots: from the fullest to the emptiest shard until their sizes are near equal, or to shards
that were added. Only the map, `slots` rows, ever reaches the driver.
"""

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from neudrift.llm.common import settle
from neudrift.session import read_or_empty, workspace

SLOTS = 4096
MAP_SCHEMA = "array<struct<virtual_slot:int, shard:int>>"
MAP_ROW = "virtual_slot int, shard int"


def even_map(slots: int, shards: int) -> list[int]:
    """The first version: shard by slot number."""
    return [slot % shards for slot in range(slots)]


def rebalanced(shard_of: list[int], weights: list[int], shards: int) -> list[int]:
    """Move or swap slots between the fullest and the emptiest shard while that brings them closer."""
    shard_of = list(shard_of)
    members = [[] for _ in range(shards)]
    for slot, shard in enumerate(shard_of):
        members[shard].append(slot)
    load = [sum(weights[s] for s in own) for own in members]
    while True:
        high, low = load.index(max(load)), load.index(min(load))
        gap = load[high] - load[low]
        # Giving away `moved` bytes leaves a difference of |gap - 2 * moved|.
        options = [(abs(gap - 2 * weights[a]), a, None) for a in members[high] if weights[a]]
        best = min(options, default=None)
        if best is None or best[0] > gap // 8:
            options += [
                (abs(gap - 2 * (weights[a] - weights[b])), a, b)
                for a in members[high] for b in members[low] if weights[a] > weights[b]
            ]
            best = min(options, key=lambda o: (o[0], o[1], -1 if o[2] is None else o[2]), default=None)
        if best is None or best[0] >= gap:
            return shard_of
        _, a, b = best
        moved = weights[a] - (weights[b] if b is not None else 0)
        for slot, source, target in ((a, high, low), (b, low, high)):
            if slot is not None:
                members[source].remove(slot)
                members[target].append(slot)
                shard_of[slot] = target
        load[high] -= moved
        load[low] += moved


def grown(shard_of: list[int], weights: list[int], shards: int) -> list[int]:
    """One more shard, number `shards`: it takes slots from the fullest shards that have any that fit, and no
    others move."""
    shard_of = list(shard_of)
    members = [[s for s, shard in enumerate(shard_of) if shard == own] for own in range(shards)]
    load = [sum(weights[s] for s in own) for own in members]
    taken, share, givers = 0, sum(load) / (shards + 1), set(range(shards))
    while givers:
        high = max(givers, key=lambda shard: (load[shard], -shard))
        fitting = [s for s in members[high] if 0 < weights[s] and taken + weights[s] <= share]
        if not fitting:
            givers.remove(high)  # what fits is less from here on, so it will never give again
            continue
        slot = max(fitting, key=lambda s: (weights[s], -s))
        members[high].remove(slot)
        shard_of[slot] = shards
        load[high] -= weights[slot]
        taken += weights[slot]
    return shard_of


def map_rows(spark: SparkSession, shard_of: list[int]) -> DataFrame:
    rows = json.dumps([{"virtual_slot": s, "shard": shard} for s, shard in enumerate(shard_of)])
    return spark.range(1).select(F.inline(F.from_json(F.lit(rows), MAP_SCHEMA)))


def save_map(spark: SparkSession, path: str, version: int, shard_of: list[int]) -> None:
    """Add a version; an earlier one is never changed."""
    map_rows(spark, shard_of).coalesce(1).write.mode("errorifexists").parquet(f"{path}/version={version}")


def load_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.parquet(f"{path}/version={version}")


def map_versions(spark: SparkSession, path: str) -> DataFrame:
    """All versions of a map: virtual_slot, shard, version; no rows before the first is saved."""
    schema = f"{MAP_ROW}, version int"
    return read_or_empty(spark, lambda p: spark.read.schema(schema).parquet(p), path, schema)


def latest_map(spark: SparkSession, path: str) -> tuple[int, list[int]]:
    """Number and shards of the newest version; 0 and nothing before the first is saved."""
    versions = map_versions(spark, path)
    newest = versions.agg(F.max("version")).first()[0]
    if newest is None:
        return 0, []
    rows = versions.where(F.col("version") == newest).collect()  # one row a slot
    return newest, [r.shard for r in sorted(rows, key=lambda r: r.virtual_slot)]


def edited(shard_of: list[int], weights: list[int], shards: int) -> list[int]:
    """The next version: shards that are missing are grown one by one, then slots are moved until bytes are near
    equal. A map with more shards than asked for is not cut down."""
    have = max(shard_of) + 1
    if have > shards:
        raise ValueError(f"the map has {have} shards")
    for more in range(have, shards):
        shard_of = grown(shard_of, weights, more)
    return rebalanced(shard_of, weights, shards)


def records(docs: DataFrame, slots: int = SLOTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, `size`, `text_crc32` and `virtual_slot` of every row."""
    text = F.coalesce(docs[f"`{text_col}`"], F.lit(""))
    return docs.select(
        docs[f"`{id_col}`"].alias(id_col),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.pmod(F.xxhash64(docs[f"`{id_col}`"], text), F.lit(slots)).cast("int").alias("virtual_slot"),
    )


def shard_documents(docs: DataFrame, shards: int = 24, slots: int = SLOTS, map_path: str | None = None,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, `size`, `text_crc32`, `virtual_slot`, `shard`, `slot` and `map_version` of every row.

    Version 1 of the map deals slots evenly. Every call edits the newest version at `map_path`: it grows shards
    that are missing and rebalances by the bytes of `docs`, and saves the next version if anything
    has moved. `slot` is the row's place in its shard, without gaps from 0: shards hold their virtual slots one
    after another, and a slot its rows by id.

    A null text has no bytes and counts 8. Rows without an id are hashed by their text. Rows that repeat
    id and text share a virtual slot and get places of their own. Other columns are not looked at. An
    empty table gives an empty table.
    """
    spark = docs.sparkSession
    map_path = map_path or f"{workspace(spark)}/slot-map-{uuid.uuid4().hex}"
    rows = settle(records(docs, slots, id_col, text_col))
    per_slot = rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    bytes_of, rows_of = [0] * slots, [0] * slots
    for one in per_slot.collect():  # at most `slots` rows
        bytes_of[one.virtual_slot], rows_of[one.virtual_slot] = one.bytes, one.rows

    version, shard_of = latest_map(spark, map_path)
    if not version:
        version, shard_of = 1, even_map(slots, shards)
        save_map(spark, map_path, 1, shard_of)
    if len(shard_of) != slots:
        raise ValueError(f"the map has {len(shard_of)} slots")
    now = edited(shard_of, bytes_of, shards)
    if now != shard_of:
        version += 1
        save_map(spark, map_path, version, now)

    current = load_map(spark, map_path, version)
    counts = map_rows(spark, rows_of).withColumnRenamed("shard", "rows")
    in_shard = Window.partitionBy("shard").orderBy("virtual_slot")
    places = current.join(counts, "virtual_slot").select(
        "virtual_slot", "shard", (F.sum("rows").over(in_shard) - F.col("rows")).alias("before")
    )
    in_slot = Window.partitionBy("virtual_slot").orderBy(id_col, "size", "text_crc32")
    return (
        rows.withColumn("nth", F.row_number().over(in_slot).cast("long") - 1)
        .join(F.broadcast(places), "virtual_slot")
        .select(id_col, "size", "text_crc32", "virtual_slot", "shard",
                (F.col("before") + F.col("nth")).alias("slot"), F.lit(version).alias("map_version"))
    )
