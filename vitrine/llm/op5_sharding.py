"""Sharding by fixed virtual slots and a versioned slot-to-shard map.

A record is hashed by its id into one of ``SLOTS`` virtual slots, for good.  Which
shard holds a slot stands in a map of ``SLOTS`` rows that is stored in versions;
records move only when the map is edited.  ``grow`` makes the next version for one
more shard by moving an even share of slots to it; ``rebalance`` makes one that
evens out the bytes that ``slot_sizes`` finds.  The query follows the law ``key``:
its shards come from the maps of growth alone, so id and shard count decide.  Beside
them it sums the bytes of every slot, stores the map edited by them as a version of its own, and
names the shard of that version as ``balanced_shard``.

Defined cases: a null id hashes like the text ``null``; a null text has no bytes (size 8);
equal ids share a shard; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitrine.llm.common import table
from vitrine.session import cut_lineage, scratch_path

SLOTS = 8192
#: Rows of one virtual slot are numbered in so many parts.
PARTS = 16


def slot_of(id_col: str, slots: int = SLOTS) -> Column:
    """Virtual slot of a record: a hash of its id as text, nothing else."""
    return F.pmod(F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit("null"))), F.lit(slots)).cast("int")


def grow(owners: list[int], shards: int) -> list[int]:
    """The map after one more shard: each old shard hands its last slots over, down to an even share."""
    held: dict[int, list[int]] = {s: [] for s in range(shards)}
    for slot, shard in enumerate(owners):
        held[shard].append(slot)
    share, extra = divmod(len(owners), shards + 1)
    out = list(owners)
    for rank, shard in enumerate(sorted(held, key=lambda s: (-len(held[s]), s))):
        for slot in held[shard][share + (rank < extra) :]:
            out[slot] = shards
    return out


def grown_map(shards: int, slots: int = SLOTS) -> list[int]:
    """The map for ``shards`` shards, grown from one; it depends on the two counts only."""
    owners = [0] * slots
    for n in range(1, shards):
        owners = grow(owners, n)
    return owners


def rebalance(owners: list[int], shards: int, size: dict[int, int], tolerance: float = 0.02) -> list[int]:
    """The map edited so that bytes are within ``tolerance`` of even, where slots allow it; few slots move."""
    out, load = list(owners), [0] * shards
    held: dict[int, list[tuple[int, int]]] = {s: [] for s in range(shards)}
    for slot, shard in enumerate(owners):
        load[shard] += size.get(slot, 0)
        held[shard].append((size.get(slot, 0), slot))
    most = sum(load) / shards * (1 + tolerance)
    light = [(v, s) for s, v in enumerate(load)]
    heapq.heapify(light)
    for shard in sorted(range(shards), key=lambda s: -load[s]):
        for weight, slot in sorted(held[shard], reverse=True):
            if load[shard] <= most:
                break
            while light[0][0] != load[light[0][1]]:
                heapq.heapreplace(light, (load[light[0][1]], light[0][1]))
            to = light[0][1]
            if weight and to != shard and load[to] + weight < load[shard]:
                out[slot] = to
                load[shard] -= weight
                load[to] += weight
                heapq.heapreplace(light, (load[to], to))
    return out


def slot_sizes(placed: DataFrame) -> DataFrame:
    """Rows and bytes of each virtual slot of ``placed`` (virtual_slot, size)."""
    return placed.groupBy("virtual_slot").agg(F.count("*").alias("rows"), F.sum("size").alias("bytes"))


def save_map(spark: SparkSession, path: str, version: str, owners: list[int]) -> None:
    """Store a version of the map; versions stand side by side and none is overwritten."""
    spark.createDataFrame(list(enumerate(owners)), "virtual_slot int, shard int").coalesce(1).write.parquet(f"{path}/version={version}")


def load_map(spark: SparkSession, path: str, version: str) -> DataFrame:
    return spark.read.schema("virtual_slot int, shard int").parquet(f"{path}/version={version}")


def place(df: DataFrame, slot_map: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows with id, size, text_crc32, virtual_slot and shard.  The map has ``SLOTS`` rows, so it is broadcast."""
    raw = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    thin = df.select(F.col(id_col), (F.octet_length(raw) + 8).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"), slot_of(id_col).alias("virtual_slot"))
    return thin.join(F.broadcast(slot_map), "virtual_slot")


def numbered(placed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``slot``: 0, 1, ... within each shard, in the order of virtual slot, part, id.

    Counts by (slot, part), at most SLOTS * PARTS rows, give each part its first
    number; only the rows of one part are sorted together.
    """
    parted = placed.withColumn("part", F.pmod(F.xxhash64(F.col(id_col), "text_crc32", F.lit(1)), F.lit(PARTS)).cast("int"))
    before = Window.partitionBy("shard").orderBy("virtual_slot", "part").rowsBetween(Window.unboundedPreceding, -1)
    first = parted.groupBy("shard", "virtual_slot", "part").count().select("virtual_slot", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("virtual_slot", "part").orderBy(id_col, "text_crc32", "size")
    ranked = parted.withColumn("nth", F.row_number().over(within) - 1)
    return ranked.join(first, ["virtual_slot", "part"]).withColumn("slot", (F.col("first") + F.col("nth")).cast("long")).drop("first", "nth", "part")


def op5_virtual_slots(spark, sf_dir: str, shards: int = 24) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    path = scratch_path(spark, "slot_map")
    owners = grown_map(shards)
    save_map(spark, path, f"{shards}", owners)
    save_map(spark, path, f"{shards + 1}", grow(owners, shards))
    placed = cut_lineage(place(documents, load_map(spark, path, f"{shards}")), "placed")
    # A row a slot reaches the driver, whatever the input.
    held = {r["virtual_slot"]: r["bytes"] for r in slot_sizes(placed).collect()}
    save_map(spark, path, f"{shards}-by-bytes", rebalance(owners, shards, held))
    later = load_map(spark, path, f"{shards + 1}").withColumnRenamed("shard", "grown_shard")
    even = load_map(spark, path, f"{shards}-by-bytes").withColumnRenamed("shard", "balanced_shard")
    out = numbered(placed).join(F.broadcast(later), "virtual_slot").join(F.broadcast(even), "virtual_slot")
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard", "virtual_slot", "balanced_shard")


QUERIES = {"op5_virtual_slots": op5_virtual_slots}
ORACLES: dict[str, str] = {}
