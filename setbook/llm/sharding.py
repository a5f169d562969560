"""Shards of near-equal bytes through fixed virtual slots.

1. A record belongs for ever to one of ``slots`` virtual slots: a hash of its
   id and its text.  One map-side-folded aggregate gives bytes and rows of
   every slot.
2. The *slot map* (slot -> shard) deals the slots to the shards, the largest
   first, each to the shard with the fewest bytes.  It has one row a slot, so
   its size is bounded by ``slots`` and not by the data.  Every version of
   the map is a table of its own; ``grow`` edits the newest one: it moves
   slots only as long as that evens the shards out, and rewrites only the
   shards that gain or lose a slot.  What stays is read from where it lies.
3. The records are written as Parquet files below ``data/v<version>``, one
   folder a shard.  A shard is written in blocks of at most ``block_bytes``
   (a large slot is cut by a second hash), each by one task, ordered by slot.
   A record's place in its shard is the block's base plus its number in the
   block, gapless from 0.

A slot far beyond its share that holds several rows is *spread*: its rows are
dealt over all slots by a second hash.  Where that leaves a slot as large,
its rows are copies (whole rows repeated, a third of the table in the
extreme): those are dealt by their number in the scan, so that they do not
end in one shard; which copy lies where then rests on the order of the
scan.  The map says which slots are spread.

Defined results: the size of a record is the UTF-8 bytes of its text
(none for a null text) plus ``overhead``; a null id or text hashes like any
other value; repeated rows are records of their own; an empty table gives
a map of empty slots and no rows; all columns of the table are kept, as fields of
one column ``record``, so their names cannot clash with the places.  A
record larger than a shard's share stands where the map puts it; the other
shards are evened out beside it.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, scratch_path

SLOTS = 8192
SHARDS = 40
OVERHEAD = 16
BLOCK_BYTES = 128 << 20
# beyond this share of a shard a slot is spread, if it has more than one row
HOT_SHARE = 0.125

MAP_SCHEMA = "slot int, bytes long, rows long, spread int, shard int, home int"


def record_size(text: str | Column = "text", overhead: int = OVERHEAD) -> Column:
    """UTF-8 bytes of the text (null: none) plus a fixed overhead."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(overhead)).cast("long")


def slot_of(identity: Column, slots: int) -> Column:
    return F.pmod(identity, F.lit(slots)).cast("int")


def dealt(sizes: dict[int, int], shards: int) -> dict[int, int]:
    """slot -> shard: slots by falling size, each to the shard with the fewest bytes (ties: the lowest number)."""
    load = [(0, s) for s in range(shards)]
    out = {}
    for slot in sorted(sizes, key=lambda s: (-sizes[s], s)):
        size, shard = load[0]
        out[slot] = shard
        heapq.heapreplace(load, (size + sizes[slot], shard))
    return out


def edited(sizes: dict[int, int], placed: dict[int, int], shards: int) -> dict[int, int]:
    """The map ``placed`` for ``shards`` shards, with few slots moved.

    Slots of shards that are given up move first.  Then the fullest shard
    hands the emptiest one the largest slot that leaves their gap smaller,
    as long as there is one that does so by a thousandth of the mean.
    """
    out = dict(placed)
    load = dict.fromkeys(range(shards), 0)
    own: dict[int, list[int]] = {s: [] for s in load}
    for slot in sorted(out, key=lambda s: (sizes[s], s)):
        if out[slot] in load:
            load[out[slot]] += sizes[slot]
            own[out[slot]].append(slot)
    homeless = [s for s in out if out[s] not in load]
    for slot in sorted(homeless, key=lambda s: (-sizes[s], s)):
        shard = min(load, key=lambda k: (load[k], k))
        out[slot] = shard
        load[shard] += sizes[slot]
        own[shard].append(slot)
        own[shard].sort(key=lambda s: (sizes[s], s))
    least = max(1, sum(sizes.values()) // max(shards, 1) // 1000)
    while True:
        full, empty = max(load, key=lambda k: (load[k], -k)), min(load, key=lambda k: (load[k], k))
        gap = load[full] - load[empty]
        fits = [s for s in own[full] if least <= sizes[s] <= gap - least]
        if not fits:
            return out
        slot = min(fits, key=lambda s: (abs(gap // 2 - sizes[s]), s))
        own[full].remove(slot)
        own[empty].append(slot)
        own[empty].sort(key=lambda s: (sizes[s], s))
        out[slot] = empty
        load[full] -= sizes[slot]
        load[empty] += sizes[slot]


def _numbered(docs: DataFrame, id_col: str, text_col: str, overhead: int) -> DataFrame:
    """(record, size, identity, number): number tells repeated rows apart and rests on the order of the scan."""
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("record"),
        record_size(F.col(text_col), overhead).alias("size"),
        F.xxhash64(F.col(id_col), F.col(text_col)).alias("identity"),
        F.monotonically_increasing_id().alias("number"))


def _slots(rows: DataFrame, slots: int, spread: list[set[int]]) -> DataFrame:
    """``rows`` with their slot; ``spread`` holds the slots whose rows are dealt anew, by identity and then by number."""
    at = [slot_of(F.xxhash64("identity", "number"), slots), slot_of(F.xxhash64("identity", F.lit(1)), slots),
          slot_of(F.col("identity"), slots)]
    slot, moves = at[0], F.lit(2)
    for hot, own, k in ((spread[1], at[1], 1), (spread[0], at[2], 0)):
        stays = ~own.isin(*sorted(hot)) if hot else F.lit(True)
        slot, moves = F.when(stays, own).otherwise(slot), F.when(stays, F.lit(k)).otherwise(moves)
    return rows.withColumn("slot", slot).withColumn("moves", moves)


def slot_map(rows: DataFrame, slots: int, shards: int) -> list[tuple]:
    """Rows of the first map, one for every slot: (slot, bytes, rows, spread, shard, home)."""
    spread: list[set[int]] = [set(), set()]

    def measured() -> dict[int, list]:
        """slot -> bytes and rows, and those of the rows that the next dealing would move."""
        found = _slots(rows, slots, spread).groupBy("slot", "moves").agg(
            F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")).collect()     # at most 3 rows a slot
        out = {s: [0, 0, 0, 0] for s in range(slots)}
        latest = sum(map(bool, spread))
        for r in found:
            own = out[r["slot"]]
            own[0] += r["bytes"]
            own[1] += r["rows"]
            if r["moves"] == latest:
                own[2] += r["bytes"]
                own[3] += r["rows"]
        return out

    found = measured()
    limit = HOT_SHARE * sum(v[0] for v in found.values()) / shards
    for k in (0, 1):
        spread[k] = {s for s, v in found.items() if v[2] > limit and v[3] > 1}
        if not spread[k]:
            break
        found = measured()
    shard = dealt({s: v[0] for s, v in found.items()}, shards)
    return [(s, found[s][0], found[s][1], (s in spread[0]) + 2 * (s in spread[1]), shard[s], 1) for s in range(slots)]


def _write(spark: SparkSession, rows: DataFrame, placed: list[tuple], folder: str, block_bytes: int) -> None:
    """Write ``rows`` (record, size, identity, number, slot) below ``folder``, one folder a shard.

    ``placed`` are the map's rows of the shards to write.
    """
    plan, blocks = [], 0
    room: dict[int, int] = {}
    for slot, size, _, _, shard, _ in sorted(placed, key=lambda r: (r[4], r[0])):
        parts = max(1, -(-size // block_bytes))
        if parts > 1 or shard not in room or room[shard] < size:
            first = blocks
            blocks += parts
            room[shard] = block_bytes - size if parts == 1 else 0
        else:
            first = blocks - 1
            room[shard] -= size
        plan.append((slot, shard, first, parts))
    if not plan:
        return
    own = spark.createDataFrame(plan, "slot int, shard int, first int, parts int")
    cut = F.pmod(F.xxhash64("number", "identity", F.lit(11)), F.col("parts"))
    blocked = rows.join(F.broadcast(own), "slot").withColumn("block", (F.col("first") + cut).cast("int"))
    order = Window.partitionBy("block").orderBy("slot", "identity", "number")
    at = blocked.repartition(blocks, "block").withColumn("place", F.row_number().over(order).cast("long") - 1)
    at.select("record", "slot", "block", "place", "shard").write.partitionBy("shard").parquet(folder)


def write_shards(docs: DataFrame, folder: str, shards: int = SHARDS, slots: int = SLOTS, id_col: str = "doc_id",
                 text_col: str = "text", overhead: int = OVERHEAD, block_bytes: int = BLOCK_BYTES) -> int:
    """Write ``docs`` as version 1 of a sharded table below ``folder``; returns the version."""
    spark = docs.sparkSession
    rows = _numbered(docs, id_col, text_col, overhead)
    placed = slot_map(rows, slots, shards)
    spread = [{r[0] for r in placed if r[3] & bit} for bit in (1, 2)]
    _write(spark, _slots(rows, slots, spread), placed, f"{folder}/data/v1", block_bytes)
    _publish(spark, placed, folder, 1)
    return 1


def _publish(spark: SparkSession, placed: list[tuple], folder: str, version: int) -> None:
    """The map of a version, written when the data it names are complete."""
    spark.createDataFrame(placed, MAP_SCHEMA).coalesce(1).write.parquet(f"{folder}/map/v{version}")


def read_map(spark: SparkSession, folder: str, version: int) -> DataFrame:
    return spark.read.schema(MAP_SCHEMA).parquet(f"{folder}/map/v{version}")


def grow(spark: SparkSession, folder: str, version: int, shards: int, block_bytes: int = BLOCK_BYTES) -> int:
    """The next version of a sharded table, for ``shards`` shards; only shards that change are written."""
    old = [tuple(r) for r in read_map(spark, folder, version).collect()]          # at most ``slots`` rows
    shard = edited({r[0]: r[1] for r in old}, {r[0]: r[4] for r in old}, shards)
    moved = {r[0] for r in old if shard[r[0]] != r[4]}
    changed = {r[4] for r in old if r[0] in moved} | {shard[s] for s in moved}
    new = [(s, b, n, spread, shard[s], version + 1 if shard[s] in changed else home)
           for s, b, n, spread, _, home in old]
    again = [r for r in new if r[4] in changed]
    stored = _placed_rows(spark, folder, old).select(
        "record", "slot", F.xxhash64("block", "place").alias("identity"),
        (F.col("block").cast("long") * F.lit(1 << 33) + F.col("place")).alias("number"))
    _write(spark, stored, again, f"{folder}/data/v{version + 1}", block_bytes)
    _publish(spark, new, folder, version + 1)
    return version + 1


def _placed_rows(spark: SparkSession, folder: str, placed: list[tuple]) -> DataFrame:
    """(record, slot, block, place, shard) of the shards where the map says they lie."""
    out = None
    for home in sorted({r[5] for r in placed}):
        there = sorted({r[4] for r in placed if r[5] == home and r[2]})
        if there:
            part = spark.read.parquet(f"{folder}/data/v{home}").where(F.col("shard").isin(*there))
            out = part if out is None else out.unionByName(part)
    return out


def read_shards(spark: SparkSession, folder: str, version: int, empty: DataFrame | None = None) -> DataFrame:
    """Rows of a version: record, shard, place (gapless from 0 in each shard), virtual_slot.

    ``empty`` gives the columns of the table where the version holds no row.
    """
    rows = _placed_rows(spark, folder, [tuple(r) for r in read_map(spark, folder, version).collect()])
    if rows is None:
        return empty.limit(0).select(F.struct(*empty.columns).alias("record"), F.lit(0).alias("shard"),
                                     F.lit(0).cast("long").alias("place"), F.lit(0).alias("virtual_slot"))
    blocks = rows.groupBy("shard", "block").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = blocks.select("shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return rows.join(base, ["shard", "block"]).select(
        "record", "shard", (F.col("base") + F.col("place")).alias("place"), F.col("slot").alias("virtual_slot"))


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: the shard and place of every document, read back from the shard files."""
    docs = documents(spark, sf_dir)
    folder = scratch_path(spark, "shards")
    version = write_shards(docs, folder)
    text = F.col("record.text")
    return read_shards(spark, folder, version, docs).select(
        F.col("record.doc_id").alias("doc_id"), record_size(text).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"), F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"), F.col("place").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", F.lit(version).alias("map_version"))
