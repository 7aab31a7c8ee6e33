"""Sharding by fixed virtual slots and a versioned map from slots to shards.

A record's slot is a hash of its doc_id, one of ``SLOTS`` for ever. Only the map from slots to
shards changes: it is made from bytes per slot, and rebalancing edits as few of its rows as it
can and gives them a new version. A slot that holds far more than its part (one doc_id with very
many rows) is cut into ``LANES`` lanes, which the map places one by one; once cut, it stays cut. A
record's lane comes from its doc_id, its text and its number among its copies, so a rerun that
splits files in another way puts the same records into the same shards.

The map is a stored table (``MAP_SCHEMA``), one ``as_of`` per version; a row's ``version`` is the one
that placed it last. With the path of a map, ``shard`` reads its last version, edits it for the sizes
of today and appends a version if anything changed; without one, it stores a map of its own.

Law of the query: ``bytes``. Shards differ by about one small slot.

Defined cases: null text is empty (size 1, CRC of nothing); null doc_id is a key like any other;
repeated rows are records of their own; an empty table gives an empty result and an even map;
other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Collection, Mapping

from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gradeweave.sources.shared import shared_dir, stage

SLOTS, LANES = 4096, 64
#: A slot is cut into lanes if it holds more than this part of a shard's even share.
HOT_PART = 1 / 16
MAP_SCHEMA = "vslot int, lane int, shard int, version int"
Unit = tuple[int, int]  # slot and lane; lane -1: the whole slot


def _record() -> dict[str, Column]:
    text = F.coalesce(F.col("text"), F.lit(""))
    return {
        "size": (F.octet_length(text) + 1).cast("bigint"),
        "text_crc32": F.crc32(text),
        "vslot": F.pmod(F.xxhash64("doc_id"), F.lit(SLOTS)).cast("int"),
        "same": F.xxhash64("doc_id", text),
    }


def hot_slots(found: DataFrame, shards: int, cut: Collection[int] = ()) -> list[int]:
    """Slots to be cut into lanes: those above their part, and those that the map has cut before. The driver sees SLOTS sums."""
    sums = {r.vslot: r.bytes for r in found.groupBy("vslot").agg(F.sum("size").alias("bytes")).collect()}
    return sorted({v for v, b in sums.items() if b * shards > sum(sums.values()) * HOT_PART} | set(cut))


def in_lanes(found: DataFrame, hot: list[int]) -> DataFrame:
    """``found`` with ``lane``: -1, or in hot slots a hash of doc_id and text plus the number among equal records.

    Equal records are told apart by nothing but that number, so it may follow the stored order. It is
    counted in blocks of the stored records and over blocks: a record with very many copies is in no one task.
    """
    if not hot:
        return found.withColumn("lane", F.lit(-1))
    part = found.where(F.col("vslot").isin(hot)).withColumn("_block", F.shiftright("rid", 16))
    counts = part.groupBy("same", "_block").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("same").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("same", "_block", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("same", "_block").orderBy("rid")) - 1
    numbered = part.withColumn("_inside", inside).join(starts, ["same", "_block"])
    lane = F.pmod(F.pmod("same", F.lit(LANES)) + F.col("_start") + F.col("_inside"), F.lit(LANES)).cast("int")
    lanes = stage(numbered.withColumn("lane", lane).select(*found.columns, "lane"), "shard-lanes")
    return found.where(~F.col("vslot").isin(hot)).withColumn("lane", F.lit(-1)).unionByName(lanes)


def unit_bytes(units: DataFrame) -> dict[Unit, int]:
    """Bytes per slot, and per lane of the hot ones: at most SLOTS sums, and LANES for each hot slot."""
    return {(r.vslot, r.lane): r.bytes for r in units.groupBy("vslot", "lane").agg(F.sum("size").alias("bytes")).collect()}


def first_map(sizes: Mapping[Unit, int], shards: int) -> dict[Unit, int]:
    """Largest unit first, each to the shard with the fewest bytes; empty slots go round."""
    heap = [(0, s) for s in range(shards)]
    placed: dict[Unit, int] = {}
    for unit, size in sorted(sizes.items(), key=lambda x: (-x[1], x[0])):
        held, shard = heapq.heappop(heap)
        placed[unit] = shard
        heapq.heappush(heap, (held + size, shard))
    seen = {v for v, _ in placed}
    return placed | {(v, -1): v % shards for v in range(SLOTS) if v not in seen}


def rebalanced(placed: Mapping[Unit, int], sizes: Mapping[Unit, int], shards: int, slack: float = 0.01) -> dict[Unit, int]:
    """The map edited for new sizes or shards: units leave shards above the even share by more than ``slack``, others stay."""
    known = {u: s if s < shards else -1 for u, s in placed.items()}
    whole = {v: s for (v, lane), s in known.items() if lane == -1}
    now = {u: known.get(u, whole.get(u[0], -1)) for u in sizes}
    held = [0] * shards
    for u, s in now.items():
        if s >= 0:
            held[s] += sizes[u]
    fair = sum(sizes.values()) / shards
    moving = [u for u, s in now.items() if s < 0]
    over = {s for s in range(shards) if held[s] > fair * (1 + slack)}
    for u in sorted(now, key=lambda u: (-sizes[u], u)):
        s = now[u]
        if s in over and held[s] > fair and held[s] - sizes[u] >= fair * (1 - slack):
            held[s] -= sizes[u]
            moving.append(u)
    heap = [(b, s) for s, b in enumerate(held) if s not in over]
    heapq.heapify(heap)
    for u in sorted(moving, key=lambda u: (-sizes[u], u)):
        b, s = heapq.heappop(heap)
        now[u] = s
        heapq.heappush(heap, (b + sizes[u], s))
    seen = {v for v, _ in now}
    return now | {(v, -1): (s if s >= 0 else v % shards) for v, s in whole.items() if v not in seen}


def map_rows(placed: Mapping[Unit, int], version: int, previous: DataFrame | None = None, spark: SparkSession | None = None) -> DataFrame:
    """The map as a table (vslot, lane, shard, version); rows that did not change keep the version of ``previous``."""
    spark = spark or previous.sparkSession
    old = {(r.vslot, r.lane): (r.shard, r.version) for r in previous.collect()} if previous is not None else {}
    rows = [(v, lane, s, old[v, lane][1] if old.get((v, lane), (None,))[0] == s else version) for (v, lane), s in sorted(placed.items())]
    return spark.createDataFrame(rows, MAP_SCHEMA)


def records(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, vslot, same (a hash of doc_id and text), and rid: a number of the row that is stored with it."""
    numbered = docs.select("doc_id", "text").withColumns(_record()).drop("text").withColumn("rid", F.monotonically_increasing_id())
    return stage(numbered, "shard-records")


def placed_records(units: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Records with ``shard`` and ``slot``, their place in it, gapless from 0.

    Places are counted in two steps, in blocks of the stored records and over blocks, so no
    shard is numbered by one task. The map has SLOTS rows and LANES for each hot slot: broadcast.
    """
    sharded = units.join(F.broadcast(slot_map), ["vslot", "lane"]).withColumn("_block", F.shiftright("rid", 16))
    counts = sharded.groupBy("shard", "_block").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("shard").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "_block", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("shard", "_block").orderBy("rid")) - 1
    return (
        sharded.withColumn("_inside", inside).join(starts, ["shard", "_block"])
        .withColumn("slot", (F.col("_start") + F.col("_inside")).cast("bigint")).drop("_block", "_inside", "_start")
    )


def stored_map(spark: SparkSession, path: str) -> DataFrame | None:
    """The last version of the map at ``path``; None if there is none yet."""
    try:
        versions = spark.read.schema(f"{MAP_SCHEMA}, as_of int").parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    last = versions.agg(F.max("as_of")).first()[0]
    return None if last is None else versions.where(F.col("as_of") == last)


def edited_map(units: DataFrame, shards: int, path: str, known: DataFrame | None) -> DataFrame:
    """The map at ``path`` made or edited for ``units``; a version is appended only if a row changed."""
    sizes, spark = unit_bytes(units), units.sparkSession
    if known is None:
        rows = map_rows(first_map(sizes, shards), 1, spark=spark).withColumn("as_of", F.lit(1))
    else:
        old = {(r.vslot, r.lane): r.shard for r in known.collect()}
        # lanes without a record today keep their place, so they can be found again
        new = {u: s for u, s in old.items() if s < shards} | rebalanced(old, sizes, shards)
        if new == old:
            return known.drop("as_of")
        as_of = known.first().as_of + 1
        rows = map_rows(new, as_of, known).withColumn("as_of", F.lit(as_of))
    rows.coalesce(1).write.mode("append").partitionBy("as_of").parquet(path)
    return stored_map(spark, path).drop("as_of")


def shard(docs: DataFrame, shards: int = 8, map_path: str | None = None) -> DataFrame:
    """All documents in ``shards`` shards of near equal bytes, by the map at ``map_path``, which is made or edited."""
    spark = docs.sparkSession
    path = map_path or f"{shared_dir(spark).rstrip('/')}/gradeweave/slot-map-{uuid4().hex}"
    known, found = stored_map(spark, path) if map_path else None, records(docs)
    cut = [r.vslot for r in known.where("lane >= 0").select("vslot").distinct().collect()] if known is not None else []
    units = in_lanes(found, hot_slots(found, shards, cut))
    return placed_records(units, edited_map(units, shards, path, known)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "vslot", F.col("version").alias("map_version"))
