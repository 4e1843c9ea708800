"""Temporal rules over tag events: sustained tags, sequences, gating."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadsift.operators.subjects import once

SUBJECT = ["scenario_id", "subject_id"]


def timeline(events: DataFrame) -> DataFrame:
    """(scenario_id, tag_name, subject_id, frames): where each subject carries each tag."""
    return events.groupBy("scenario_id", "tag_name", "subject_id").agg(F.array_sort(F.collect_set("frame_index")).alias("frames"))


def _islands(events: DataFrame, tag: str) -> DataFrame:
    """The tag's frames, once each, with a number that is equal over consecutive frames."""
    held = events.filter(F.col("tag_name") == tag).groupBy(*SUBJECT, "frame_index").agg(F.min("ts").alias("ts"))
    order = Window.partitionBy(*SUBJECT).orderBy("frame_index")
    return held.withColumn("island", F.col("frame_index") - F.row_number().over(order))


def sustained_frames(events: DataFrame, tag: str, frames: int) -> DataFrame:
    """Frames that end a run of at least so many consecutive frames with the tag."""
    run = Window.partitionBy(*SUBJECT, "island").orderBy("frame_index")
    rows = _islands(events, tag).withColumn("n", F.row_number().over(run)).filter(F.col("n") >= frames)
    return rows.select(*SUBJECT, "frame_index", "ts", (F.col("frame_index") - (frames - 1)).alias("first_frame"), F.col("frame_index").alias("last_frame"))


def sustained_seconds(events: DataFrame, tag: str, seconds: float, mode: str = "exact") -> DataFrame:
    """Frames at which the tag has held for the time without a gap.

    "exact": a frame of the run lies exactly ``seconds`` before, in double arithmetic; "at_least":
    the run began that long before or earlier.
    """
    # a little more than the time, as the range's bound is rounded; what lies outside by exact differences doesn't count
    since = f"{float(seconds) + 1e-6!r}D PRECEDING" if mode == "exact" else "UNBOUNDED PRECEDING"
    over = f"OVER (PARTITION BY {', '.join(SUBJECT)}, island ORDER BY ts RANGE BETWEEN {since} AND CURRENT ROW)"
    rows = _islands(events, tag).withColumns({"_first": F.expr(f"min(struct(ts, frame_index)) {over}"), "_second": F.expr(f"nth_value(struct(ts, frame_index), 2) {over}")})
    if mode == "exact":
        rows = rows.withColumn("_first", F.when(F.col("ts") - F.col("_first.ts") <= float(seconds), F.col("_first")).otherwise(F.col("_second")))
    out = rows.filter(F.col("ts") - F.col("_first.ts") >= float(seconds))
    return out.select(*SUBJECT, "frame_index", "ts", F.col("_first.frame_index").alias("first_frame"), F.col("frame_index").alias("last_frame"))


def _fits(end: Column, last: Column, low: Column | None, seconds: float | None) -> Callable[[Column], Column]:
    """Whether a place lies in the window that closes at ``end`` and not before the step before it."""
    def test(p: Column) -> Column:
        inside = (p["frame_index"] >= low) if low is not None else (p["ts"] >= end["ts"] - float(seconds))
        return inside & (p["frame_index"] <= end["frame_index"]) & (last.isNull() | (p["frame_index"] >= last["frame_index"]))

    return test


def sequence(events: DataFrame, tags: list[str], frames: int | None = None, seconds: float | None = None, max_gap_frames: int | None = None) -> DataFrame:
    """For each frame with the last tag, the earliest chain of the tags within the window up to it.

    A step takes the earliest frame at or after the one before; there is no way back, so a gap
    that is too long ends the chain. Returns first_frame, last_frame and the chain's frames.
    """
    places = [F.array_sort(F.collect_set(F.when(F.col("tag_name") == t, F.struct("frame_index", "ts")))).alias(f"_p{k}") for k, t in enumerate(tags)]
    # subjects that lack a tag, most of them, go before lists are made
    whole = Window.partitionBy(*SUBJECT)
    rows = events.filter(F.col("tag_name").isin(*tags)).select(*SUBJECT, "tag_name", "frame_index", "ts")
    rows = rows.withColumns({f"_n{k}": F.max(F.col("tag_name") == t).over(whole) for k, t in enumerate(tags)}).filter(" AND ".join(f"_n{k}" for k in range(len(tags))))
    rows = rows.groupBy(*SUBJECT).agg(*places).withColumn("_end", F.explode(f"_p{len(tags) - 1}"))
    end, chain = F.col("_end"), F.array().cast("array<struct<frame_index:int,ts:double>>")
    low = end["frame_index"] - frames if frames is not None else None
    for k in range(len(tags)):
        last = F.try_element_at(chain, F.lit(-1))
        # each step is worked out once: as plain columns, every step would hold two copies and more of the one before
        rows = rows.withColumn(f"_f{k}", once(F.try_element_at(F.filter(f"_p{k}", _fits(end, last, low, seconds)), F.lit(1))))
        found = F.col(f"_f{k}")
        ok = found.isNotNull() & (F.size(chain) == k)
        if max_gap_frames is not None and k:
            ok = ok & (found["frame_index"] - last["frame_index"] - 1 <= max_gap_frames)
        rows = rows.withColumn(f"_c{k}", once(F.when(ok, F.concat(chain, F.array(found))).otherwise(chain)))
        chain = F.col(f"_c{k}")
    first, last = F.try_element_at(chain, F.lit(1)), F.try_element_at(chain, F.lit(-1))
    whole = F.size(chain) == len(tags)
    if seconds is not None:
        whole = whole & (end["ts"] - first["ts"] <= float(seconds))
    return rows.filter(whole).select(*SUBJECT, end["frame_index"].alias("frame_index"), end["ts"].alias("ts"), first["frame_index"].alias("first_frame"), last["frame_index"].alias("last_frame"), F.transform(chain, lambda p: p["frame_index"]).alias("chain"))


def gated(candidates: DataFrame, predecessors: DataFrame, tag: str) -> DataFrame:
    """Candidates of a later step whose subject carries the step before it in any frame."""
    return candidates.join(predecessors.filter(F.col("tag_name") == tag).select(*SUBJECT).distinct().hint("merge"), SUBJECT, "left_semi")


def supporting(detected: DataFrame, events: DataFrame, tag: str) -> DataFrame:
    """detected with the tag's frames and times from first_frame to last_frame."""
    at = events.filter(F.col("tag_name") == tag).groupBy(*SUBJECT).agg(F.array_sort(F.collect_set(F.struct("frame_index", "ts"))).alias("_all"))
    inside = F.filter("_all", lambda p: (p["frame_index"] >= F.col("first_frame")) & (p["frame_index"] <= F.col("last_frame")))
    rows = detected.join(at.hint("merge"), SUBJECT).withColumn("_in", inside)
    return rows.select(*detected.columns, F.transform("_in", lambda p: p["frame_index"]).alias("supporting_frames"), F.transform("_in", lambda p: p["ts"]).alias("supporting_ts"))
