"""Global shuffle of documents into shards: scatter into memory-sized buckets, then shuffle each bucket."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparecost.llm.common import Scratch


def shuffled(df: DataFrame, keys: list[str], size: Column, seed: int = 17, bucket_bytes: int = 16 << 20) -> DataFrame:
    """Add `bucket` and `place`: a seeded random order of all rows.

    Pass one scatters whole rows by a seeded hash of `keys` into as many buckets as bring the mean to `bucket_bytes`;
    Spark's shuffle files hold them. Pass two takes one bucket at a time, brings it into a fixed order and permutes it
    by Fisher-Yates (the shuffle() function). Every bucket is the partition of its number, so no two buckets share a task, and
    a task that is run again gives the same order.
    """
    total = df.agg(F.sum(size)).first()[0] or 0
    buckets = max(1, -(-int(total) // bucket_bytes))
    columns = df.columns
    scattered = df.select(
        F.pmod(F.xxhash64(F.lit(seed), *[F.col(k) for k in keys]), F.lit(buckets)).cast("int").alias("__bucket"),
        F.xxhash64(F.lit(seed + 1), *[F.col(k) for k in keys]).alias("__mix"), F.struct(*columns).alias("__row"),
    )
    held = (
        scattered.repartitionById(buckets, F.col("__bucket")).groupBy("__bucket")
        .agg(F.sort_array(F.collect_list(F.struct("__mix", "__row"))).alias("rows")).sortWithinPartitions("__bucket")
    )
    return held.select(
        "__bucket", F.posexplode(F.shuffle(F.col("rows"), seed)).alias("place", "item")
    ).select(F.col("__bucket").alias("bucket"), F.col("place").cast("long"), "item.__row.*")


_GROUP = 4096


def _before(order: DataFrame) -> DataFrame:
    """Rows before each bucket, and rows in all: bucket, before, total.

    Sums run within groups of 4096 buckets, in parallel, and then over the groups, of which there is one per 64 GB.
    """
    counts = order.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).withColumn("g", F.expr(f"bucket div {_GROUP}"))
    earlier = (Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("n").over(Window.partitionBy("g").orderBy("bucket").rowsBetween(*earlier)), F.lit(0))
    groups = counts.groupBy("g").agg(F.sum("n").alias("n"))
    groups = groups.select(
        "g", F.coalesce(F.sum("n").over(Window.orderBy("g").rowsBetween(*earlier)), F.lit(0)).alias("outside"),
        F.sum("n").over(Window.partitionBy()).alias("total"))
    return counts.select("g", "bucket", inside.alias("inside")).join(groups, "g").select(
        "bucket", (F.col("inside") + F.col("outside")).alias("before"), "total")


def shard_documents(
    docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text", seed: int = 17,
    bucket_bytes: int = 16 << 20,
) -> DataFrame:
    """All rows with whole texts in a seeded random order, dealt to shards 0 to shards-1 whose counts differ by one at most.

    Shard s takes the rows from s*n/shards to (s+1)*n/shards of the order. Returns id, text, size (UTF-8 bytes + 16, null
    text: 16), text_crc32 (null text: that of the empty text), shard, slot (from 0, gapless). Rows that are equal in all
    columns stay separate rows. A null id is hashed as any other value. Texts may be of any length, a bucket holding at least
    one row. Other columns are not read, so their names cannot clash. No rows give no rows. The order is stored, so what is
    read from it does not change if a task runs again.
    """
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    scratch = Scratch(docs.sparkSession, "shards")
    order = scratch.keep(shuffled(rows, ["doc_id", "text_crc32", "size"], F.col("size"), seed, bucket_bytes), "order")
    placed = order.join(_before(order), "bucket").withColumn("at", F.col("before") + F.col("place"))
    placed = placed.withColumn("shard", F.expr(f"cast(at * {shards} div total as int)"))
    first = F.expr(f"(shard * total + {shards - 1}) div {shards}")
    return placed.select(
        "doc_id", "text", "size", "text_crc32", "shard", (F.col("at") - first).alias("slot"),
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, rows in slot order within each file."""
    sharded.sortWithinPartitions("shard", "slot").write.partitionBy("shard").mode("overwrite").parquet(path)
