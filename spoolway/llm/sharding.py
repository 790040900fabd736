"""Shards of near equal size by longest-processing-time scheduling."""

import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spoolway.llm.common import numbered, stored

#: Groups with this part of a shard, or more, are scheduled one by one; there are at most
#: as many of them for each shard. Smaller ones are hashed into bundles first.
LARGE_PER_SHARD = 400
BUNDLES_PER_SHARD = 200


def schedule(sizes: dict, shards: int) -> dict:
    """Give every item, the largest first, to the shard with the least load; ties by number."""
    loads = [(0, s) for s in range(shards)]
    heapq.heapify(loads)
    out = {}
    for item in sorted(sizes, key=lambda x: (-sizes[x], x)):
        load, shard = heapq.heappop(loads)
        out[item] = shard
        heapq.heappush(loads, (load + sizes[item], shard))
    return out


def shard_documents(
    docs: DataFrame, shards: int, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Spread all rows over shards of near equal bytes; equal texts stay together.

    A group is the rows of one text (by its hash, so that two texts at worst share a
    group; null is a group of its own). Group sizes are added up in Spark. Groups of at
    least total / (shards * ``LARGE_PER_SHARD``) bytes are items of their own; all others
    fall by hash into ``BUNDLES_PER_SHARD`` bundles per shard, each of which then is an
    item. So at most 600 items per shard reach the driver's heap, however many rows
    there are, and a text larger than a shard is no harm but its own size.

    One row per row of ``docs``: the id, ``size`` (UTF-8 bytes and 8), ``text_crc32``,
    ``shard``, and ``slot``, gapless from 0 in each shard. Null and empty texts have
    size 8. Equal rows get slots of their own. No rows give none.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    sized = stored(
        docs.select(
            id_column,
            (F.octet_length(value) + 8).cast("long").alias("size"),
            F.crc32(value.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("_group"),
        ),
        "sizes",
    )
    groups = stored(sized.groupBy("_group").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")), "groups")
    total, rows = groups.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.coalesce(F.sum("rows"), F.lit(0))).first()
    large = F.col("bytes") * (shards * LARGE_PER_SHARD) >= F.lit(total)
    bundle = F.pmod(F.xxhash64("_group"), F.lit(shards * BUNDLES_PER_SHARD))
    bundles = groups.where(~large).groupBy(bundle.alias("b")).agg(F.sum("bytes").alias("bytes")).collect()
    sizes = {("group", r["_group"]): r["bytes"] for r in groups.where(large).collect()}
    sizes |= {("bundle", r["b"]): r["bytes"] for r in bundles}
    at = schedule(sizes, shards)
    spark = docs.sparkSession
    pairs = {k: [(key, s) for (kind, key), s in at.items() if kind == k] for k in ("group", "bundle")}
    by_group = spark.createDataFrame(pairs["group"], "_large long, _shard_a int")
    by_bundle = spark.createDataFrame(pairs["bundle"], "_bundle long, _shard_b int")
    placed = (
        sized.join(F.broadcast(by_group), F.col("_group") == F.col("_large"), "left")
        .join(F.broadcast(by_bundle), bundle == F.col("_bundle"), "left")
        .withColumn("shard", F.coalesce("_shard_a", "_shard_b"))
        .select(id_column, "size", "text_crc32", "shard")
    )
    return numbered(placed, "shard", [id_column, "text_crc32"], rows)
