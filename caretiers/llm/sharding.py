"""Sharding by fixed virtual slots: records keep their slot for ever, only the slots' shards change.

A record is hashed into one of some thousand slots. Bytes are summed per slot, and a map says which
shard each slot lies in. Maps are versions in a table of their own: rebalancing, a new shard or the loss
of one is an edit that moves few slots and is stored as the next version, so that readers of an older
version still find their records.

All work on records is done by DataFrame functions. The map has one row per slot, which bounds what is
broadcast and what the driver weighs when it edits a map.
"""

from __future__ import annotations

from bisect import bisect_left, insort

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize

SLOTS = 4096
#: What makes two rows the same record, besides the number of the copy.
RECORD = ["doc_id", "size", "text_crc32"]


def records(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(doc_id, size, text_crc32, copy, virtual_slot), a row for each row of docs.

    size is the UTF-8 length of the text plus one. Rows that are the same in id, size and CRC are
    numbered, and the number is hashed with them: a record that holds a third of all rows is dealt
    over all slots. It is counted per input partition before anything is shuffled, so no task gets
    more of its rows than one partition has.
    """
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.spark_partition_id().alias("part"),
    )
    counted = rows.groupBy(*RECORD, "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy(*RECORD).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counted = counted.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    copies = counted.select(*RECORD, F.explode(F.expr("sequence(before, before + n - 1)")).alias("copy"))
    return copies.withColumn("virtual_slot", F.pmod(F.xxhash64(*RECORD, "copy"), F.lit(slots)).cast("int"))


def slot_sizes(found: DataFrame) -> DataFrame:
    """(virtual_slot, bytes, n) of the slots that have records."""
    return found.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))


def even_map(slots: int, shards: int) -> list[int]:
    """The first map, before anything is weighed: slots dealt in turn."""
    return [slot % shards for slot in range(slots)]


def edited(shard_of: list[int], sizes: list[int], shards: int) -> list[int]:
    """A map for `shards` shards with near equal bytes that moves few slots.

    Slots of shards that are gone move to the lightest shard, the largest first. Then the slot that
    best evens out the heaviest and the lightest shard moves, until no move makes their gap smaller; a
    shard that cannot give is passed over for the next heaviest. At the end the lightest shard lacks
    no more than the smallest slot of any heavier one. New shards take slots only into themselves:
    where there are any, nothing moves among the others.
    """
    new = set(range(shards)) - set(shard_of)
    takers = sorted(new) or range(shards)
    shard_of, load = list(shard_of), [0] * shards
    held: list[list[tuple[int, int]]] = [[] for _ in range(shards)]

    def put(slot: int, shard: int) -> None:
        shard_of[slot] = shard
        load[shard] += sizes[slot]
        insort(held[shard], (sizes[slot], slot))

    homeless = []
    for slot, shard in enumerate(shard_of):
        if shard < shards:
            put(slot, shard)
        else:
            homeless.append(slot)
    for slot in sorted(homeless, key=lambda s: (-sizes[s], s)):
        put(slot, load.index(min(load)))

    def move() -> bool:
        light = min(takers, key=load.__getitem__)
        for heavy in sorted(range(shards), key=lambda s: -load[s]):
            gap = load[heavy] - load[light]
            near = bisect_left(held[heavy], (gap / 2, -1))
            fitting = [held[heavy][k] for k in (near - 1, near) if 0 <= k < len(held[heavy]) and 0 < held[heavy][k][0] < gap]
            if fitting:
                size, slot = min(fitting, key=lambda x: abs(gap - 2 * x[0]))
                held[heavy].remove((size, slot))
                load[heavy] -= size
                put(slot, light)
                return True
        return False

    while move():
        pass
    return shard_of


def save_map(spark: SparkSession, folder: str, version: int, shard_of: list[int]) -> None:
    """Stores a map as a version of its own: one small file."""
    listed = F.split(F.lit(",".join(map(str, shard_of))), ",")
    slot = F.col("id").cast("int")
    rows = spark.range(len(shard_of)).select(slot.alias("virtual_slot"), listed[slot].cast("int").alias("shard"))
    rows.coalesce(1).write.mode("overwrite").parquet(f"{folder}/version={version}")


def load_map(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """(virtual_slot, shard, version) of a stored map, the newest one unless told otherwise."""
    stored = spark.read.schema("virtual_slot int, shard int, version int").parquet(folder)
    if version is None:
        version = stored.agg(F.max("version")).first()[0]
    return stored.filter(F.col("version") == version)


def rebalance(spark: SparkSession, folder: str, found: DataFrame, shards: int) -> int:
    """Weighs the slots, edits the newest map for `shards` shards and stores the result as the next
    version, whose number is returned; a map that needs no edit stays the newest."""
    newest = load_map(spark, folder)
    weighed = newest.join(slot_sizes(found), "virtual_slot", "left").orderBy("virtual_slot").collect()
    before = [r["shard"] for r in weighed]
    after = edited(before, [r["bytes"] or 0 for r in weighed], shards)
    version = weighed[0]["version"]
    if after != before:
        version += 1
        save_map(spark, folder, version, after)
    return version


def placed(found: DataFrame, slot_map: DataFrame) -> DataFrame:
    """The records with their shard and their place there, counted from 0 without gaps.

    The places of a shard run through its virtual slots in order. Rows are numbered per virtual slot, so
    a task numbers one slot's share of all rows and no shard is in one task.
    """
    earlier = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    shards = slot_map.join(slot_sizes(found).select("virtual_slot", "n"), "virtual_slot").select(
        "virtual_slot", "shard", F.col("version").alias("map_version"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    own = F.row_number().over(Window.partitionBy("virtual_slot").orderBy(*RECORD, "copy"))
    return (
        found.withColumn("own", own)
        .join(F.broadcast(shards), "virtual_slot")
        .select(*RECORD, "copy", "virtual_slot", "map_version", "shard", (F.col("before") + F.col("own") - 1).alias("place"))
    )


def shard(docs: DataFrame, folder: str, shards: int = 8, slots: int = SLOTS) -> DataFrame:
    """A row for each row of docs: doc_id, size, text_crc32, copy, virtual_slot, map_version, shard, place.

    Shards 0 to `shards` - 1 hold near equal bytes. Maps are kept in `folder`: where it has none, the
    even one is the first; what is there is edited. The number of slots is fixed with the first map.
    Null and empty texts have size 1 and the CRC of nothing; null ids and repeated rows are
    records like any others; other columns are not read. An empty table has no rows and leaves the
    even map.
    """
    spark = docs.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        slots = load_map(spark, folder).count()
    else:
        save_map(spark, folder, 1, even_map(slots, shards))
    found = materialize(records(docs, slots), "records")
    version = rebalance(spark, folder, found, shards)
    return placed(found, load_map(spark, folder, version))
