"""Mergeable summaries of events: counts and distinct targets by shard, as rows that can be added up without the events.

A partial summary has a row for each (shard, scenario_id, side, kind, name): kind says what is
counted ("event", "tag", "risk", "subtype", "target"), side which events ("review": primary ones,
"candidate": all that a payload keeps). Summaries of disjoint shards are merged by union and sums;
distinct targets stay exact, as a target is a name of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadsift.operators import review

KINDS = ("event", "tag", "risk", "subtype", "target")
KEY = ["shard", "scenario_id", "side", "kind", "name"]


def keeps_payload(tag: Column, risk: Column, group: Column) -> Column:
    """Whether a payload keeps an event: primary ones, and close interactions of medium risk."""
    return (group == "primary") | ((tag == "vru_close_interaction") & (risk == "medium"))


def partial(events: DataFrame, shard: Column, source: Column | None = None) -> DataFrame:
    """Partial summary of events with tag_name, risk_level, review_group, subject_id and perhaps review_subtype; source names the file a shard comes from."""
    subtype = F.col("review_subtype") if "review_subtype" in events.columns else F.lit(None).cast("string")
    risk = review.risk_of(F.col("risk_level"), F.col("review_group"))
    sides = F.array_compact(F.array(F.when(F.col("review_group") == "primary", F.lit("review")), F.when(keeps_payload(F.col("tag_name"), F.col("risk_level"), F.col("review_group")), F.lit("candidate"))))
    target = F.when(F.col("subject_id").contains(":"), review.target_of(F.col("subject_id")))
    named = {"event": F.lit(""), "tag": F.col("tag_name"), "risk": risk, "subtype": subtype, "target": target}
    names = F.array(*[F.struct(F.lit(k).alias("kind"), v.alias("name")) for k, v in named.items()])
    rows = events.select(shard.alias("shard"), (shard if source is None else source).cast("string").alias("source"), "scenario_id", F.explode(sides).alias("side"), names.alias("names"))
    rows = rows.select("shard", "source", "scenario_id", "side", F.explode("names").alias("n")).select("shard", "source", "scenario_id", "side", "n.*").filter("name IS NOT NULL")
    return rows.groupBy("source", *KEY).agg(F.count("*").alias("events"))


def merge(*parts: DataFrame) -> DataFrame:
    """One partial summary of several."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("source", *KEY).agg(F.sum("events").alias("events"))


def _counts(side: str, kind: str) -> Column:
    """Map of counts by name; of few names, as tags, risks and subtypes are fixed words."""
    found = F.collect_list(F.when((F.col("side") == side) & (F.col("kind") == kind), F.struct("name", "events")))
    return F.map_from_entries(F.array_sort(found))


def shard_totals(parts: DataFrame) -> DataFrame:
    """Per shard: scenarios with events, scenarios with several review events, events of both sides, and their counts by tag, risk and subtype."""
    of = lambda side, kind: (F.col("side") == side) & (F.col("kind") == kind)
    per = parts.groupBy("shard", "scenario_id").agg(*[F.coalesce(F.sum(F.when(of(s, "event"), F.col("events"))), F.lit(0)).alias(s) for s in ("review", "candidate")])
    per = per.groupBy("shard").agg(F.count("*").alias("scenarios"), F.count_if(F.col("review") > 1).alias("multi_event_scenarios"), F.sum("review").alias("review_events"), F.sum("candidate").alias("candidate_events"))
    named = parts.filter(F.col("kind").isin("tag", "risk", "subtype")).groupBy("shard", "side", "kind", "name").agg(F.sum("events").alias("events"))
    counts = named.groupBy("shard").agg(*[_counts(s, k).alias(f"{s}_{k}s") for s in ("review", "candidate") for k in ("tag", "risk", "subtype")])
    targets = parts.filter(of("candidate", "target")).groupBy("shard", "scenario_id").agg(F.count_distinct("name").alias("n")).groupBy("shard").agg(F.sum("n").alias("targets"))
    return per.join(counts, "shard", "left").join(targets, "shard", "left").withColumn("targets", F.coalesce("targets", F.lit(0)))


def grand_totals(parts: DataFrame) -> DataFrame:
    """(side, kind, name, events) over all shards, targets left out."""
    return parts.filter("kind <> 'target'").groupBy("side", "kind", "name").agg(F.sum("events").alias("events"))


def references(parts: DataFrame) -> DataFrame:
    """Per scenario: its shard and source, review and candidate events, review tags, and the sorted distinct targets of its candidates."""
    of = lambda side, kind: (F.col("side") == side) & (F.col("kind") == kind)
    return parts.groupBy("shard", "source", "scenario_id").agg(
        F.coalesce(F.sum(F.when(of("review", "event"), F.col("events"))), F.lit(0)).alias("review_events"), F.coalesce(F.sum(F.when(of("candidate", "event"), F.col("events"))), F.lit(0)).alias("candidate_events"),
        F.array_sort(F.collect_set(F.when(of("review", "tag"), F.col("name")))).alias("review_tags"), F.array_sort(F.collect_set(F.when(of("candidate", "target"), F.col("name")))).alias("targets"),
    )


def busiest(parts: DataFrame, n: int = 10) -> DataFrame:
    """The n scenarios with most review events in all, and each source's own first n; ties by source and scenario."""
    told = references(parts).filter("review_events > 0")
    order = [F.desc("review_events"), "source", "scenario_id"]
    top = told.orderBy(*order).limit(n).select(F.lit("all").alias("of"), "source", "scenario_id", "review_events")
    rank = F.row_number().over(Window.partitionBy("source").orderBy(*order))
    own = told.withColumn("_n", rank).filter(F.col("_n") <= n).select(F.lit("source").alias("of"), "source", "scenario_id", "review_events")
    return top.unionByName(own)
