"""Event policies: compaction, episodes, cooldown and dominance, in that order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GROUP = ["scenario_id", "tag_name", "rule_id", "subject_type", "subject_id"]
FAMILY = ["scenario_id", "subject_type", "subject_id", "review_family"]


def merged(events: DataFrame, gap: int | Column) -> DataFrame:
    """One row for each run of frames with at most ``gap`` from one to the next: the first event, end_frame, event_count and raw_frames. A gap of -1 keeps every event apart."""
    order = Window.partitionBy(*GROUP).orderBy("frame_index")
    new = F.coalesce((F.col("frame_index") > F.lag("frame_index").over(order) + gap).cast("int"), F.lit(1))
    rows = events.withColumn("_new", new).withColumn("_run", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    rest = [c for c in events.columns if c not in GROUP]
    out = rows.groupBy(*GROUP, "_run").agg(F.min_by(F.struct(*rest), "frame_index").alias("_e"), F.max("frame_index").alias("end_frame"), F.count("*").alias("event_count"), F.array_sort(F.collect_list("frame_index")).alias("raw_frames"))
    return out.select(*GROUP, "_e.*", "end_frame", "event_count", "raw_frames")


def compact(events: DataFrame, by_rule: list[str] | None = None) -> DataFrame:
    """Consecutive frames of events outside review become intervals; the others are as they were."""
    apart = (F.col("intent") != "review") if by_rule is None else (F.col("intent") != "review") & F.col("rule_id").isin(*by_rule)
    alone = events.filter(~F.coalesce(apart, F.lit(False)))
    alone = alone.select(*GROUP, *[c for c in events.columns if c not in GROUP], F.col("frame_index").alias("end_frame"), F.lit(1).cast("long").alias("event_count"), F.array("frame_index").alias("raw_frames"))
    return merged(events.filter(apart), 1).unionByName(alone)


def episodes(events: DataFrame, cooldown: int = 0) -> DataFrame:
    """Review events whose frames lie within max(1, cooldown) of each other become episodes."""
    return merged(events, max(1, cooldown))


def cooldown(events: DataFrame, frames: int | Column, key: tuple[str, ...] = ("scenario_id", "tag_name", "subject_type", "subject_id")) -> DataFrame:
    """Events that come after an earlier kept one by more than ``frames``, with suppressed_until.

    Each kept event silences those after it, so this is a fold over a subject's events in order.
    ``frames`` may be a column that is the same for all events of a key; where it is 0 none is silenced.
    """
    if isinstance(frames, int):
        if frames <= 0:
            return events.withColumn("suppressed_until", F.lit(None).cast("int"))
        frames = F.lit(frames)
    rest = [c for c in events.columns if c not in key]
    free = events.filter(frames <= 0).withColumn("suppressed_until", F.lit(None).cast("int"))
    events = events.filter(frames > 0)
    lists = events.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct(F.col("frame_index").alias("_f"), F.struct(*rest).alias("e")))).alias("_all"))
    start = F.struct(F.lit(-1).alias("until"), F.slice("_all", 1, 0).alias("kept"))
    fold = F.aggregate("_all", start, lambda s, x: F.when(x["_f"] > s["until"], F.struct((x["_f"] + frames).alias("until"), F.concat(s["kept"], F.array(x)).alias("kept"))).otherwise(s))
    rows = lists.select(*key, F.explode(fold["kept"]).alias("k"))
    return rows.select(*key, "k.e.*", (F.col("k._f") + frames).alias("suppressed_until")).select(*events.columns, "suppressed_until").unionByName(free)


def dominance(events: DataFrame) -> DataFrame:
    """Review events of a family that overlap its best event go, the best one stays.

    The best has the highest priority, and of these the first frame, then the first tag.
    ``end_frame`` is the event's last frame.
    """
    family = F.col("review_family").isNotNull() & F.col("review_priority").isNotNull()
    rank = Window.partitionBy(*FAMILY).orderBy(F.desc("review_priority"), "frame_index", "tag_name", "rule_id")
    ranked = events.filter(family).withColumn("_n", F.row_number().over(rank))
    best = ranked.filter("_n = 1").select(*FAMILY, F.col("frame_index").alias("_a"), F.col("end_frame").alias("_b"))
    kept = ranked.join(best.hint("merge"), FAMILY).filter("_n = 1 OR NOT (frame_index <= _b AND end_frame >= _a)").select(*events.columns)
    return kept.unionByName(events.filter(~family))
