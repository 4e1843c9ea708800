"""Evaluation feedback: validation, classification and an idempotent store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadsift.scratch import cut, forget

# Fixed values of the result envelope.
CONSTANTS = {"protocol_version": "shared_exchange_protocol.v1", "schema_version": "evaluation_run_result.v1", "message_type": "evaluation.run.result"}
SCENE_ID, SAFE_ID = "^[0-9a-f]{32}$", "^[A-Za-z0-9][A-Za-z0-9._-]{0,127}$"
STATUSES = ("succeeded", "failed", "cancelled")
RAN = ("completed", "ego_closed_loop", "interactive_closed_loop")
RUNTIME_STATUSES = ("not_run", "planned", *RAN, "failed")
OUTCOMES = ("pass", "fail", "unknown")
PAYLOAD = ("run_id", "scene_id", "scene_version", "status", "runtime_status", "outcome", "algorithm", "odd", "started_at", "finished_at", "duration_sec", "summary", "artifacts")
SUMMARY = ("collision_count", "min_ttc", "route_progress", "hard_brake_count", "max_jerk", "control_timeout_count")
IDENTITIES = {"algorithm": ("algorithm_id", "algorithm_version"), "odd": ("odd_id",)}


def _has(field: str, names: tuple[str, ...]) -> Column:
    out = F.lit(True)
    for n in names:
        out = out & F.map_contains_key(F.col(f"payload.{field}"), n)
    return out


def errors() -> Column:
    """Names of what is missing or wrong in a result, in the order of the checks.

    A result has the envelope's columns and ``payload``, a struct of PAYLOAD whose algorithm, odd and
    summary are maps. A field that is null counts as missing.
    """
    checks = {n: F.col(n) == v for n, v in CONSTANTS.items()}
    checks |= {"message_id": F.col("message_id").rlike(SAFE_ID), "created_at": F.col("created_at").isNotNull(), "payload": F.col("payload").isNotNull()}
    checks |= {f"payload.{n}": F.col(f"payload.{n}").isNotNull() for n in PAYLOAD}
    checks |= {"run_id": F.col("payload.run_id").rlike(SAFE_ID), "scene_id": F.col("payload.scene_id").rlike(SCENE_ID), "status": F.col("payload.status").isin(*STATUSES)}
    checks |= {"runtime_status": F.col("payload.runtime_status").isin(*RUNTIME_STATUSES), "outcome": F.col("payload.outcome").isin(*OUTCOMES)}
    checks |= {n: _has(n, names) for n, names in {**IDENTITIES, "summary": SUMMARY}.items()}
    return F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(n)) for n, ok in checks.items()]))


def classification() -> dict[str, Column]:
    """State, priority and disposition of a valid result."""
    status, runtime, outcome = F.col("payload.status"), F.col("payload.runtime_status"), F.col("payload.outcome")
    done = (status == "succeeded") & runtime.isin(*RAN) & (outcome == "pass")
    failed = status.isin("failed", "cancelled") | (runtime == "failed") | (outcome == "fail")
    three = lambda a, b, c: F.when(done, a).when(failed, b).otherwise(c)
    return {"state": three("validated", "failed", "incomplete"), "priority": three("normal", "high", "normal"), "disposition": three("pass", "investigate", "unknown")}


def digest(*columns: str) -> Column:
    """SHA-256 of the columns as JSON with sorted names."""
    return F.sha2(F.to_json(F.struct(*sorted(columns))), 256)


def absorb(batch: DataFrame, store: DataFrame) -> DataFrame:
    """(run_id, digest, action) of a batch against a store of (run_id, digest).

    "new" for the first of a run, "duplicate" for the same content again, "conflict" for other
    content, whether the earlier one stands in the store or in the batch. ``seq`` orders the batch.
    """
    first = Window.partitionBy("run_id").orderBy("seq")
    rows = batch.join(store.select("run_id", F.col("digest").alias("_stored")), "run_id", "left")
    rows = rows.withColumns({"_first": F.first("digest").over(first), "_n": F.row_number().over(first)})
    base = F.coalesce("_stored", "_first")
    action = F.when(F.col("_stored").isNull() & (F.col("_n") == 1), "new").when(F.col("digest") == base, "duplicate").otherwise("conflict")
    return rows.select("run_id", "seq", "digest", action.alias("action"))


STORE = "run_id string, digest string, document string"


def documents(results: DataFrame) -> DataFrame:
    """(run_id, digest, document) and ``seq``, where there is one, of valid results.

    The document is the feedback as JSON, with sorted field names; it tells the source envelope with
    a digest of the whole result, the identity, the classification and the evaluation. ``digest`` is
    the document's own.
    """
    kinds = classification()
    whole = F.sha2(F.to_json(F.struct(*sorted((*CONSTANTS, "message_id", "created_at", "payload")))), 256)
    p = lambda n: F.col(f"payload.{n}").alias(n)
    parts = {
        "schema_version": F.lit("scenario_feedback.v1"), "feedback_id": F.concat(F.lit("feedback-"), "payload.run_id"),
        "source": F.struct(*[F.col(c).alias(c) for c in sorted((*CONSTANTS, "message_id", "created_at"))], whole.alias("content_sha256")),
        "identity": F.struct(p("algorithm"), p("odd"), p("run_id"), F.col("payload.scene_id").alias("scenario_id"), F.col("payload.scene_id").alias("scene_token"), p("scene_version")),
        "classification": F.struct(*[kinds[n].alias(n) for n in sorted(kinds)]),
        "evaluation": F.struct(*[p(n) for n in ("duration_sec", "finished_at", "outcome", "runtime_status", "started_at", "status", "summary")]),
    }
    text = F.to_json(F.struct(*[parts[n].alias(n) for n in sorted(parts)]))
    valid = results.filter(F.size(errors()) == 0)
    return valid.select(*[c for c in ("seq",) if c in results.columns], F.col("payload.run_id").alias("run_id"), text.alias("document")).withColumn("digest", F.sha2("document", 256))


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """What a store holds: (run_id, digest, document), one row a run; nothing where there is no store yet."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], STORE)
    return spark.read.schema(STORE).parquet(path)


def store(batch: DataFrame, path: str) -> DataFrame:
    """Append a batch of documents() with ``seq`` to the store at path; (run_id, seq, digest, action) of each.

    Only documents of new runs are written, in one commit of Spark's writer, so that a batch that
    breaks off leaves the store as it was and running it again is safe: what is there already is a
    "duplicate", or a "conflict" where it differs, and conflicts are never written. One writer at a
    time.
    """
    spark = batch.sparkSession
    told = cut(absorb(batch, read_store(spark, path)).join(batch.select("run_id", "seq", "document"), ["run_id", "seq"]))
    told.filter("action = 'new'").select("run_id", "digest", "document").write.mode("append").parquet(path)
    out = cut(told.drop("document"))
    forget(told)
    return out
