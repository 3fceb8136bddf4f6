"""Sharding by fixed virtual slots, in DataFrame functions only.

Rows are hashed into thousands of slots by their text, so equal texts meet; bytes are added up per
slot; a small versioned table maps slots to shards, largest slot first to the emptiest shard.
Rebalancing edits that table: a new version moves some slots and leaves all other rows in place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def size_of(text: Column) -> Column:
    """UTF-8 bytes and one more; a null text has none."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def slotted(docs: DataFrame, slots: int = 4096, id_col: str = "doc_id", text_col: str = "text",
            hot_share: float = 1 / 64, copies: int = 64) -> DataFrame:
    """id, size, text_crc32 and the virtual slot of every row.

    Equal texts share a slot, unless together they are more than ``hot_share`` of all bytes: such a
    group could not be balanced, so its rows are spread by id.  At most 1 / hot_share groups can
    be that large; the table of them is broadcast.  ``copies`` first pre-aggregates a group in as
    many parts.
    """
    text = F.col(f"`{text_col}`")
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), size_of(text).alias("size"),
                       F.crc32(F.coalesce(text, F.lit("")).cast("binary")).cast("long").alias("text_crc32"),
                       F.xxhash64(F.coalesce(text, F.lit(""))).alias("group"))
    groups = (rows.groupBy("group").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
              .filter("n > 1"))
    total = rows.agg(F.sum("size").alias("total"))
    hot = (groups.join(F.broadcast(total), F.col("bytes") > F.col("total") * hot_share)
           .select(F.col("group").alias("hot")))
    spread = F.when(F.col("hot").isNull(), F.xxhash64("group")).otherwise(F.xxhash64("group", "id"))
    return (rows.join(F.broadcast(hot), F.col("group") == F.col("hot"), "left")
            .select("id", "size", "text_crc32", F.pmod(spread, F.lit(slots)).cast("int").alias("v")))


def slot_map(weights: DataFrame, shards: int, slots: int) -> DataFrame:
    """(version 1, v, shard) for slot weights (v, bytes): every slot, the largest first, goes to the
    shard that is emptiest so far, ties to the smaller number.  One row per slot, so the table is
    bounded by ``slots``; it is folded in one expression."""
    all_slots = F.sequence(F.lit(0), F.lit(slots - 1))
    filled = (weights.sparkSession.range(1).select(F.explode(all_slots).alias("v"))
              .join(F.broadcast(weights), "v", "left").select("v", F.coalesce("bytes", F.lit(0)).alias("bytes")))
    listed = filled.agg(F.sort_array(F.collect_list(F.struct((-F.col("bytes")).alias("less"), "v"))).alias("s"))
    start = F.struct(F.array_repeat(F.lit(0).cast("long"), shards).alias("load"),
                     F.array().cast("array<int>").alias("to"))

    def put(acc: Column, slot: Column) -> Column:
        least = (F.array_position(acc["load"], F.array_min(acc["load"])) - 1).cast("int")
        load = F.transform(acc["load"], lambda x, i: F.when(i == least, x - slot["less"]).otherwise(x))
        return F.struct(load.alias("load"), F.concat(acc["to"], F.array(least)).alias("to"))

    return (listed.select(F.arrays_zip(F.transform("s", lambda x: x["v"]).alias("v"),
                                       F.aggregate("s", start, put, lambda acc: acc["to"]).alias("shard")).alias("z"))
            .select(F.explode("z").alias("z")).select(F.lit(1).alias("version"), "z.v", "z.shard"))


def grow(mapping: DataFrame, weights: DataFrame) -> DataFrame:
    """The next version of a slot map with one more shard: from every old shard, slots in the order
    of their number move to the new one until its fair share is given; all others stay."""
    last = mapping.agg(F.max("version").alias("last"), (F.max("shard") + 1).alias("new"))
    now = (mapping.join(F.broadcast(last), F.col("version") == F.col("last"))
           .join(weights, "v", "left").withColumn("bytes", F.coalesce("bytes", F.lit(0))))
    own = Window.partitionBy("shard")
    before = F.sum("bytes").over(own.orderBy("v"))
    fair = F.sum("bytes").over(own) / (F.col("new") + 1)
    return now.select((F.col("version") + 1).alias("version"), "v",
                      F.when(before <= fair, F.col("new")).otherwise(F.col("shard")).cast("int").alias("shard"))


def shard(docs: DataFrame, shards: int = 8, slots: int = 4096, rows_per_part: int = 8192, most_parts: int = 64,
          id_col: str = "doc_id", text_col: str = "text", mapping: DataFrame | None = None) -> DataFrame:
    """Put every row into a shard of nearly equal bytes and number the rows of a shard.

    Returns id, size, text_crc32, law ('bytes'), shard, slot (the row's place in its shard,
    gapless from 0), grown_shard (null under this law), virtual_slot.  ``mapping`` takes a stored
    slot map (its newest version) in place of a new one.

    Places need no sort of a whole shard: rows are counted per (virtual slot, part), a small table
    of at most slots x ``most_parts`` rows gives each its first place, and rows are ordered by id
    inside it.  A slot of many rows, as that of a text that many rows have, has more parts.  Null texts have size 1, null ids come first, repeated rows are separate rows with
    separate places, an empty table gives an empty one, other columns are ignored.
    """
    rows = slotted(docs, slots, id_col, text_col)
    cuts = F.least(F.lit(most_parts), F.ceil(F.count(F.lit(1)) / rows_per_part)).cast("int")
    # One row a slot.
    rows = (rows.join(F.broadcast(rows.groupBy("v").agg(cuts.alias("cuts"))), "v")
            .withColumn("part", F.pmod(F.xxhash64("id", F.lit(7)), "cuts").cast("int")))
    counted = rows.groupBy("v", "part").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    if mapping is None:
        mapping = slot_map(counted.groupBy("v").agg(F.sum("bytes").alias("bytes")), shards, slots)
    newest = mapping.withColumn("r", F.row_number().over(Window.partitionBy("v").orderBy(F.desc("version"))))
    placed = counted.join(newest.filter("r = 1").select("v", "shard"), "v")
    first = F.coalesce(F.sum("n").over(Window.partitionBy("shard").orderBy("v", "part")
                                       .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    places = placed.select(F.col("v").alias("pv"), F.col("part").alias("pp"), "shard", first.alias("first"))
    inside = F.row_number().over(Window.partitionBy("v", "part").orderBy(F.asc_nulls_first("id"), "text_crc32", "size"))
    return (rows.withColumn("inside", inside)
            .join(F.broadcast(places), (F.col("v") == F.col("pv")) & (F.col("part") == F.col("pp")))
            .select(F.col("id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"),
                    F.col("shard").cast("int").alias("shard"),
                    (F.col("first") + F.col("inside") - 1).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard"), F.col("v").alias("virtual_slot")))


def save_map(mapping: DataFrame, path: str) -> None:
    """Append a version to the stored slot map; earlier versions stay readable."""
    mapping.coalesce(1).write.partitionBy("version").mode("append").parquet(path)
