"""Run tracking, logs and reports over the event table, in batch and as a stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from tunewright.catalog import query
from tunewright.catalog.common import strip_sql, table
from tunewright.operators import report, track
from tunewright.session import scratch_path
from tunewright.sources import sinks, tables
from tunewright.specs import PromptSpec
from tunewright.streaming import ingest, state

KINDS = {
    "signup": "start",
    "click": "metric",
    "view": "param",
    "error": "artifact",
    "purchase": "end",
}


def tracking_events(spark, sf):
    """The event table in the shape of tracking events: users are runs."""
    e = table(spark, sf, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    kind = F.create_map(*[F.lit(x) for kv in KINDS.items() for x in kv])[F.col("event_type")]
    e = e.withColumn("kind", kind)
    step = F.col("k").cast("string")
    return e.select(
        F.concat(F.lit("run-0000"), F.col("user_id").cast("string")).alias("run_id"),
        "kind",
        F.when(F.col("kind") == "start", F.when(F.col("k") > 50, F.concat(F.lit("name"), step)))
        .when(F.col("kind") == "metric", F.when(F.col("k") > 50, "train_loss").otherwise("eval_loss"))
        .when(F.col("kind") == "param", F.concat(F.lit("p"), step)).alias("key"),
        F.when(F.col("kind").isin("start", "param"), F.col("props"))
        .when(F.col("kind") == "artifact", F.concat(F.lit("out/m"), step, F.lit("/")))
        .alias("value"),
        F.when(F.col("kind") == "metric", F.when(F.col("k") != 7, F.col("value"))).alias("num"),
        F.when(F.col("k") >= 10, F.col("k")).alias("step"),
        F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01', ts) / 1e6D").alias("ts"),
        F.col("event_id").alias("seq"),
    )


EVENTS_SQL = """e AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k,
    CASE event_type WHEN 'signup' THEN 'start' WHEN 'click' THEN 'metric' WHEN 'view' THEN 'param'
      WHEN 'error' THEN 'artifact' WHEN 'purchase' THEN 'end' END AS kind FROM events),
ev AS (
  SELECT 'run-0000' || user_id AS run_id, kind,
    CASE kind WHEN 'start' THEN CASE WHEN k > 50 THEN 'name' || k END
      WHEN 'metric' THEN CASE WHEN k > 50 THEN 'train_loss' ELSE 'eval_loss' END
      WHEN 'param' THEN 'p' || k END AS key,
    CASE WHEN kind IN ('start', 'param') THEN props
      WHEN kind = 'artifact' THEN 'out/m' || k || '/' END AS value,
    CASE WHEN kind = 'metric' AND k <> 7 THEN value END AS num,
    CASE WHEN k >= 10 THEN k END AS step,
    CAST(epoch_us(ts) AS DOUBLE) / 1e6 AS ts, event_id AS seq FROM e),
starts AS (SELECT * FROM ev WHERE kind = 'start'
  QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY ts DESC, seq DESC) = 1),
ends AS (SELECT * FROM ev WHERE kind = 'end'
  QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY ts DESC, seq DESC) = 1),
mh AS (SELECT run_id, key, num AS value, coalesce(step, -1) AS step, ts, seq FROM ev
       WHERE kind = 'metric' AND num IS NOT NULL),
mc AS (SELECT * FROM mh
  QUALIFY row_number() OVER (PARTITION BY run_id, key, step ORDER BY ts DESC, seq DESC) = 1),
ph AS (
  SELECT run_id, CASE kind WHEN 'param' THEN key ELSE 'artifact:' || split_part(value, '/', 2) END
    AS key, CASE kind WHEN 'param' THEN value ELSE '/srv/' || rtrim(value, '/') END AS value,
    ts, seq FROM ev WHERE kind IN ('param', 'artifact'))"""


@query(
    "runs",
    f"""WITH {EVENTS_SQL}
SELECT s.run_id, coalesce(s.key, substr(s.run_id, 1, 8)) AS run_name, s.value AS config_json,
  s.ts AS start_ts, n.ts AS end_ts,
  CASE WHEN n.run_id IS NULL THEN 'running' ELSE 'finished' END AS status
FROM starts s LEFT JOIN ends n ON n.run_id = s.run_id""",
)
def runs(spark, sf):
    return track.runs(tracking_events(spark, sf))


@query("param_history", f"WITH {EVENTS_SQL} SELECT run_id, key, value, ts, seq FROM ph")
def param_history(spark, sf):
    return track.param_history(tracking_events(spark, sf), "/srv")


@query(
    "params",
    f"""WITH {EVENTS_SQL} SELECT run_id, key, value FROM ph
QUALIFY row_number() OVER (PARTITION BY run_id, key ORDER BY ts DESC, seq DESC) = 1""",
)
def params(spark, sf):
    return track.params(tracking_events(spark, sf), "/srv")


@query(
    "artifacts",
    f"""WITH {EVENTS_SQL} SELECT run_id, key, count(*) AS n, max(value) AS value FROM ph
WHERE key LIKE 'artifact:%' GROUP BY 1, 2""",
)
def artifacts(spark, sf):
    rows = track.param_history(tracking_events(spark, sf), "/srv")
    rows = rows.filter(F.startswith("key", F.lit("artifact:")))
    return rows.groupBy("run_id", "key").agg(F.count("*").alias("n"), F.max("value").alias("value"))


@query("metric_history", f"WITH {EVENTS_SQL} SELECT run_id, key, step, value, ts, seq FROM mh")
def metric_history(spark, sf):
    return report.history(track.metric_history(tracking_events(spark, sf)))


@query("metrics_current", f"WITH {EVENTS_SQL} SELECT run_id, key, value, step, ts FROM mc")
def metrics_current(spark, sf):
    return track.metrics(tracking_events(spark, sf))


def _upserted(spark, sf, name):
    """Two overlapping batches, the later one first, and the first one once more under another id."""
    events = tracking_events(spark, sf)
    base = scratch_path(spark, "upsert")
    early, late = events.filter("pmod(seq, 10) < 6"), events.filter("pmod(seq, 10) > 3")
    for batch, n in ((late, "b2"), (early, "b1"), (early, "b1"), (early, "b1 again")):
        sinks.upsert_tracking(batch, base, n, "/srv", 8, [name])
    return tables.read_upserted(spark, base, name)


@query("upsert_metrics", f"WITH {EVENTS_SQL} SELECT run_id, key, value, step, ts FROM mc")
def upsert_metrics(spark, sf):
    return _upserted(spark, sf, "metrics").drop("seq")


@query(
    "upsert_params",
    f"""WITH {EVENTS_SQL} SELECT run_id, key, value FROM ph
QUALIFY row_number() OVER (PARTITION BY run_id, key ORDER BY ts DESC, seq DESC) = 1""",
)
def upsert_params(spark, sf):
    return _upserted(spark, sf, "params").drop("ts", "seq")


@query(
    "events_current",
    """SELECT * FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""",
)
def events_current(spark, sf):
    return track.current(table(spark, sf, "events"), ["user_id", "event_type"], ["ts", "event_id"])


@query(
    "tracking_tables",
    f"""WITH {EVENTS_SQL}
SELECT 'runs' AS name, s.run_id, coalesce(s.key, substr(s.run_id, 1, 8)) AS key, s.value AS text,
  s.ts AS num, NULL::BIGINT AS step FROM starts s
UNION ALL (SELECT 'params', run_id, key, value, NULL, NULL FROM ph
  QUALIFY row_number() OVER (PARTITION BY run_id, key ORDER BY ts DESC, seq DESC) = 1)
UNION ALL SELECT 'metrics', run_id, key, NULL, value, step FROM mc""",
)
def tracking_tables(spark, sf):
    """Write the run histories and read the current tables."""
    path = scratch_path(spark, "tracking")
    sinks.write_tracking(tracking_events(spark, sf), path, artifact_base="/srv")
    parts = []
    for name, key, text, num, step in (
        ("runs", "run_name", "config_json", "start_ts", None),
        ("params", "key", "value", None, None),
        ("metrics", "key", None, "value", "step"),
    ):
        cells = [(key, "key", "string"), (text, "text", "string"), (num, "num", "double")]
        columns = [
            (F.col(c) if c else F.lit(None)).cast(kind).alias(out)
            for c, out, kind in [*cells, (step, "step", "bigint")]
        ]
        current = tables.current_tracking(spark, path, name)
        parts.append(current.select(F.lit(name).alias("name"), "run_id", *columns))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "run_summary",
    f"""WITH {EVENTS_SQL}
SELECT run_id,
  coalesce(arg_max(value, (ts, seq)) FILTER (key = 'train_loss'), 0.0) AS train_loss,
  coalesce(arg_max(value, (ts, seq)) FILTER (key = 'eval_loss'), 0.0) AS eval_loss
FROM mh GROUP BY 1""",
)
def run_summary(spark, sf):
    return track.summary(tracking_events(spark, sf))


@query(
    "compare_runs",
    f"""WITH {EVENTS_SQL}
SELECT run_id, arg_max(value, step) FILTER (key = 'train_loss') AS train_loss,
       arg_max(value, step) FILTER (key = 'eval_loss') AS eval_loss FROM mc GROUP BY 1""",
)
def compare_runs(spark, sf):
    current = track.metrics(tracking_events(spark, sf))
    return report.compare(current, ["train_loss", "eval_loss"])


# Logs -------------------------------------------------------------------------------------------


def log_rows(spark, sf):
    """Events as wide log lines: the type says which field is filled."""
    e = table(spark, sf, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))

    def field(kind):
        return F.when(F.col("event_type") == kind, F.col("value") / 7)

    return e.select(
        F.col("user_id").cast("string").alias("run_id"),
        F.col("event_id").alias("step"),
        (F.col("k") / 3).alias("epoch"),
        field("click").alias("loss"),
        field("view").alias("learning_rate"),
        field("purchase").alias("train_loss"),
        field("error").alias("eval_loss"),
    )


LOG_SQL = """l AS (
  SELECT CAST(user_id AS VARCHAR) AS run_id, event_id AS step,
    CAST(json_extract_string(props, '$.k') AS INT) / 3 AS e,
    CASE WHEN event_type = 'click' THEN round(value / 7, 6) END AS loss,
    CASE WHEN event_type = 'view' THEN round(value / 7, 6) END AS learning_rate,
    CASE WHEN event_type = 'purchase' THEN round(value / 7, 6) END AS train_loss,
    CASE WHEN event_type = 'error' THEN round(value / 7, 6) END AS eval_loss
  FROM events WHERE event_type <> 'signup'),
log AS (SELECT * EXCLUDE (e), CASE WHEN e <> 0 THEN round(e, 4) END AS epoch FROM l)"""


@query("log_entries", f"WITH {LOG_SQL} SELECT * FROM log")
def log_entries(spark, sf):
    return track.log_entries(log_rows(spark, sf))


def _stored_log(spark, sf):
    path = scratch_path(spark, "log")
    sinks.append_log(log_rows(spark, sf), path)
    return path


@query(
    "training_log",
    f"WITH {LOG_SQL} SELECT run_id, step, epoch, loss, learning_rate, train_loss, eval_loss FROM log",
)
def training_log(spark, sf):
    """Write log lines as JSON and scan them with the log schema."""
    df = tables.read_training_log(spark, _stored_log(spark, sf), tables.RUN_LOG_SCHEMA)
    return df.select("run_id", "step", "epoch", "loss", "learning_rate", "train_loss", "eval_loss")


@query(
    "loss_curve",
    f"""WITH {LOG_SQL}
SELECT run_id, step, 'train' AS series, loss AS value FROM log WHERE loss IS NOT NULL
UNION ALL SELECT run_id, step, 'train', train_loss FROM log WHERE train_loss IS NOT NULL
UNION ALL SELECT run_id, step, 'eval', eval_loss FROM log WHERE eval_loss IS NOT NULL
UNION ALL SELECT run_id, step, 'learning_rate', learning_rate FROM log WHERE learning_rate IS NOT NULL""",
)
def loss_curve(spark, sf):
    return report.loss_curve(track.log_entries(log_rows(spark, sf)), "run_id")


LONG_SQL = f"""{LOG_SQL},
long AS (
  SELECT run_id, 'loss' AS key, loss AS value, step FROM log WHERE loss IS NOT NULL
  UNION ALL SELECT run_id, 'learning_rate', learning_rate, step FROM log
    WHERE learning_rate IS NOT NULL
  UNION ALL SELECT run_id, 'train_loss', train_loss, step FROM log WHERE train_loss IS NOT NULL
  UNION ALL SELECT run_id, 'eval_loss', eval_loss, step FROM log WHERE eval_loss IS NOT NULL
  UNION ALL SELECT run_id, 'epoch', epoch, step FROM log WHERE epoch IS NOT NULL)"""


@query("metric_events", f"WITH {LONG_SQL} SELECT run_id, key, value, step FROM long")
def metric_events(spark, sf):
    return track.metric_events(track.log_entries(log_rows(spark, sf)))


@query("stream_metrics", f"WITH {LONG_SQL} SELECT run_id, key, value, step FROM long")
def stream_metrics(spark, sf):
    """The same rows, read from the log folder as a stream."""
    stream = ingest.read_log_stream(spark, _stored_log(spark, sf))
    target, checkpoint = scratch_path(spark, "metrics"), scratch_path(spark, "offsets")
    ingest.ingest_metrics(stream, target, checkpoint).awaitTermination()
    return spark.read.parquet(target).select("run_id", "key", "value", "step")


@query("stream_current", f"WITH {LONG_SQL} SELECT run_id, key, value, step FROM long")
def stream_current(spark, sf):
    """Two log folders streamed into one target, and the last write of each metric there."""
    logs = track.log_entries(log_rows(spark, sf))
    target = scratch_path(spark, "tracking")
    for name, part in (("even", F.col("step") % 2 == 0), ("odd", F.col("step") % 2 != 0)):
        folder = scratch_path(spark, "log")
        sinks.append_log(logs.filter(part), folder)
        stream = ingest.read_log_stream(spark, folder)
        offsets = scratch_path(spark, "offsets")
        ingest.ingest_metrics(stream, f"{target}/metrics", offsets, source=name).awaitTermination()
    current = tables.current_tracking(spark, target, "metrics")
    return current.select("run_id", "key", "value", "step")


@query("stream_state", f"WITH {EVENTS_SQL} SELECT run_id, key, value, step, ts FROM mc")
def stream_state(spark, sf):
    """The current metrics kept by a stateful stream of files: two overlapping parts, the later one
    first."""
    history = track.metric_history(tracking_events(spark, sf))
    folder, target = scratch_path(spark, "history"), scratch_path(spark, "state")
    for part in ("pmod(seq, 10) > 3", "pmod(seq, 10) < 6"):
        history.filter(part).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(history.schema).option("maxFilesPerTrigger", 1000).parquet(folder)
    offsets = scratch_path(spark, "offsets")
    state.keep_current(state.metric_changes(stream), target, offsets).awaitTermination()
    return spark.read.parquet(f"{target}/rows").select("run_id", "key", "value", "step", "ts")


@query(
    "stream_prompts",
    f"""SELECT conv_id, turn, 'Role: ' || role || '\n' || lower({strip_sql("text")}) AS formatted_text
FROM conversations""",
)
def stream_prompts(spark, sf):
    """Prompts over the conversation table, read as a stream."""
    schema = table(spark, sf, "conversations").schema
    stream = spark.readStream.schema(schema).parquet(f"{sf}/conversations.parquet*")
    out = ingest.prompts(stream, PromptSpec("Role: {role}\n{text}"), ("text",), lower=True)
    target, checkpoint = scratch_path(spark, "prompts"), scratch_path(spark, "offsets")
    ingest.write_parquet(out, target, checkpoint).awaitTermination()
    return spark.read.parquet(target).select("conv_id", "turn", "formatted_text")


# Configs and models -----------------------------------------------------------------------------


@query(
    "flatten_config",
    """WITH c AS (
  SELECT event_id::VARCHAR AS run_id, event_type, value, CAST(json_extract_string(props, '$.k') AS INT) AS k
  FROM events)
SELECT run_id, 'model.name' AS key, '"' || event_type || '"' AS value FROM c
UNION ALL SELECT run_id, 'model.lora', '{"r": ' || k || '}' FROM c
UNION ALL SELECT run_id, 'seed', CAST(k AS VARCHAR) FROM c
UNION ALL SELECT run_id, 'data', '{"k": ' || k || '}' FROM c""",
)
def flatten_config(spark, sf):
    """Config objects built from every event: one nested object, one leaf object, one number."""
    e = table(spark, sf, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    config = F.struct(
        F.struct(
            F.col("event_type").alias("name"), F.struct(F.col("k").alias("r")).alias("lora")
        ).alias("model"),
        F.col("k").alias("seed"),
        F.struct("k").alias("data"),
    )
    configs = e.select(
        F.col("event_id").cast("string").alias("run_id"), F.to_json(config).alias("config_json")
    )
    return track.flatten_config(configs)


@query(
    "model_catalogue",
    """SELECT p_partkey,
  CASE WHEN p_size < 10 THEN 'unknown' ELSE p_name END AS name,
  CASE WHEN p_size > 40 THEN 'unknown' ELSE p_type END AS adaptation_method,
  CASE WHEN p_size < 25 THEN 1704067200 + p_partkey END AS trained FROM part""",
)
def model_catalogue(spark, sf):
    """Metadata files written from the part table, scanned as a catalogue."""
    size = F.col("p_size")
    path = scratch_path(spark, "models")
    table(spark, sf, "part").select(
        F.when(size <= 40, F.col("p_type")).alias("approach"),
        F.when(size >= 10, F.col("p_name")).otherwise("").alias("base_model"),
        F.when(
            size < 25,
            F.expr(
                "date_format(TIMESTAMP_NTZ'2024-01-01' + make_dt_interval(0, 0, 0, p_partkey),"
                " \"yyyy-MM-dd'T'HH:mm:ss'+00:00'\")"
            ),
        ).alias("training_date"),
        "p_partkey",
    ).write.json(path)
    schema = f"{tables.MODEL_SCHEMA}, p_partkey bigint"
    raw = tables.load(spark, path, "json", schema=schema)
    return tables.describe_models(raw).select(
        "p_partkey", "name", "adaptation_method", F.unix_timestamp("training_date").alias("trained")
    )
