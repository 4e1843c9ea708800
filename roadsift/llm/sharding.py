"""Operator 1: two-pass external shuffle into shards.

Pass one scatters records over memory-sized buckets by seeded hashes: the shard is the one
whose hash with the record's key is highest (so a further shard takes records only into itself)
and the bucket within the shard follows from a hash of the whole record. Pass two shuffles each
bucket by Fisher-Yates with a seed and writes it. Only built-in functions are used.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of records that one bucket is meant to hold.
BUCKET_BYTES = 16 << 20


def highest_shard(key: Column, n_shards: int, seed: int) -> Column:
    """The shard in 0..n-1 whose seeded hash with the key is highest. A null key counts as a key of its own."""
    best = F.array_max(F.transform(F.sequence(F.lit(0), F.lit(n_shards - 1)), lambda s: F.struct(F.xxhash64(F.lit(seed), key, s).alias("h"), s.alias("s"))))
    return best["s"].cast("int")


def record_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + F.lit(8)


def shuffle_into_shards(records: DataFrame, n_shards: int = 24, key: str = "doc_id", text: str = "text", bucket_bytes: int = BUCKET_BYTES, seed: int = 20240607) -> DataFrame:
    """(record struct, shard, grown_shard, bucket, slot): each record once, slots gapless from 0 in each shard.

    ``record`` holds all columns as they came, so that no name clashes. ``grown_shard`` is the
    shard with one shard more: it is either ``shard`` or ``n_shards``. The order within a bucket is
    a Fisher-Yates permutation of records sorted by hash, so a task that runs again gives the
    same order. Null keys share a shard, null text has size 8; repeated rows keep a slot each;
    many rows of one key or text spread over buckets as far as they differ, so that rows which are
    equal in every column share one bucket. A very long text is one record and stays whole. Columns
    may have any names. An empty table gives an empty result.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be positive")
    spark = records.sparkSession
    mix = F.xxhash64(F.lit(seed + 1), *[F.col(f"`{c}`") for c in records.columns if not isinstance(records.schema[c].dataType, (T.MapType, T.VariantType))])
    total = records.agg(F.sum(record_size(F.col(f"`{text}`")))).first()[0] or 0
    per_shard = max(1, math.ceil(total / n_shards / bucket_bytes))
    shard = highest_shard(F.col(f"`{key}`"), n_shards, seed)
    home = [shard.alias("shard"), F.pmod(mix, F.lit(per_shard)).cast("int").alias("bucket")]

    sizes = records.select(*home).groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ahead = sizes.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))

    scattered = records.select(*home, mix.alias("mix"), F.struct(*[F.col(f"`{c}`") for c in records.columns]).alias("record"))
    width = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(n_shards * per_shard, 100_000))
    buckets = (
        scattered.repartition(width, "shard", "bucket")
        .sortWithinPartitions("shard", "bucket", "mix", F.col("record")[key])
        .groupBy("shard", "bucket")
        .agg(F.collect_list("record").alias("records"))
        .select("shard", "bucket", F.shuffle("records", seed).alias("records"))
        .join(ahead, ["shard", "bucket"])
    )
    placed = buckets.select("shard", "bucket", "ahead", F.posexplode("records").alias("at", "record"))
    moves = F.xxhash64(F.lit(seed), F.col("record")[key], F.lit(n_shards))
    kept = F.xxhash64(F.lit(seed), F.col("record")[key], F.col("shard"))
    return placed.select(
        "record", "shard", F.when(moves > kept, F.lit(n_shards)).otherwise(F.col("shard")).cast("int").alias("grown_shard"),
        "bucket", (F.col("ahead") + F.col("at")).alias("slot"),
    )


def write_shards(shuffled: DataFrame, path: str) -> None:
    """Write the records by shard, in slot order within each bucket."""
    shuffled.select("record.*", F.col("shard").alias("_shard"), F.col("bucket").alias("_bucket"), F.col("slot").alias("_slot")).write.partitionBy("_shard").parquet(path)
