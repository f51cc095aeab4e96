import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tunewright.operators import report, track
from tunewright.plans import data_prep, whole_run
from tunewright.sources import sinks, tables
from tunewright.specs import CleanSpec, DataSpec, EvalSpec, PromptSpec, SampleSpec
from tunewright.streaming import ingest

EVENTS = [
    ("abcdefgh-1", "start", None, '{"finetuning":{"model":{"name":"gpt2"}}}', None, None, 1.0, 1),
    ("abcdefgh-1", "metric", "loss", None, 1.5, 10, 2.0, 2),
    ("abcdefgh-1", "metric", "loss", None, 1.2, 20, 3.0, 3),
    ("abcdefgh-1", "metric", "loss", None, 1.1, 20, 3.0, 4),
    ("abcdefgh-1", "metric", "train_loss", None, 0.9, None, 4.0, 5),
    ("abcdefgh-1", "metric", "note", None, None, 1, 4.0, 6),
    ("abcdefgh-1", "param", "lr", "0.1", None, None, 2.0, 7),
    ("abcdefgh-1", "param", "lr", "0.2", None, None, 2.5, 8),
    ("abcdefgh-1", "artifact", None, "out/model/", None, None, 5.0, 9),
    ("abcdefgh-1", "end", None, None, None, None, 6.0, 10),
    ("run-2", "start", "named", None, None, None, 1.0, 11),
    ("ghost", "end", None, None, None, None, 1.0, 12),
]


@pytest.fixture()
def events(spark):
    return spark.createDataFrame(EVENTS, track.EVENT_SCHEMA).repartition(3)


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_runs(events):
    out = {r.run_id: r for r in track.runs(events).collect()}
    assert set(out) == {"abcdefgh-1", "run-2"}
    first = out["abcdefgh-1"]
    assert (first.run_name, first.status, first.end_ts) == ("abcdefgh", "finished", 6.0)
    assert json.loads(first.config_json)["finetuning"]["model"]["name"] == "gpt2"
    assert (out["run-2"].run_name, out["run-2"].status, out["run-2"].end_ts) == ("named", "running", None)


def test_metrics_and_params(events):
    assert rows(track.metrics(events), "key", "value", "step") == [
        ("loss", 1.1, 20), ("loss", 1.5, 10), ("train_loss", 0.9, -1),
    ]
    assert rows(track.params(events, "/srv"), "key", "value") == [
        ("artifact:model", "/srv/out/model"), ("lr", "0.2"),
    ]
    assert rows(track.summary(events), "train_loss", "eval_loss") == [(0.9, 0.0)]
    assert [r.step for r in report.history(track.metrics(events), "loss").collect()] == [10, 20]
    wide = report.compare(track.metrics(events), ["loss", "train_loss"]).first()
    assert (wide.loss, wide.train_loss) == (1.1, 0.9)


def test_tracking_sink(spark, events, tmp_path):
    sinks.write_tracking(events, str(tmp_path), "none")
    assert not (tmp_path / "runs").exists()
    with pytest.raises(ValueError, match="no tracking backend"):
        sinks.write_tracking(events, str(tmp_path), "mlflow")
    sinks.write_tracking(events, str(tmp_path))
    sinks.write_tracking(events, str(tmp_path))
    history = tables.read_tracking(spark, str(tmp_path), "metrics")
    assert history.count() == 8
    assert tables.current_tracking(spark, str(tmp_path), "metrics").count() == 3
    assert tables.current_tracking(spark, str(tmp_path), "params").count() == 2


def test_a_run_may_end_in_a_later_batch(spark, events, tmp_path):
    sinks.write_tracking(events.filter("kind <> 'end'"), str(tmp_path), "orc")
    assert {r.status for r in tables.current_tracking(spark, str(tmp_path), "runs", "orc").collect()} == {"running"}
    sinks.write_tracking(events.filter("kind = 'end'"), str(tmp_path), "orc")
    out = tables.current_tracking(spark, str(tmp_path), "runs", "orc")
    assert {r.run_id: r.status for r in out.collect()} == {"abcdefgh-1": "finished", "run-2": "running"}


def test_flatten_config(spark):
    configs = [
        ("a", {"model": {"name": "x", "lora": {"r": 8}}, "seed": 1, "leaf": {"p": [1, {"q": 2}]}, "empty": {}}),
        ("b", {"x": {"y": {"z": {"deep": True}}}, "s": None}),
        ("c", None),
    ]
    df = spark.createDataFrame([(i, json.dumps(c) if c else None) for i, c in configs], "run_id string, config_json string")
    got = {(r.run_id, r.key): json.loads(r.value) if r.value else None for r in track.flatten_config(df).collect()}
    assert got == {
        ("a", "model.name"): "x", ("a", "model.lora"): {"r": 8}, ("a", "seed"): 1,
        ("a", "leaf"): {"p": [1, {"q": 2}]}, ("a", "empty"): {},
        ("b", "x.y.z"): {"deep": True}, ("b", "s"): None,
    }


LOG = "run_id string, step bigint, epoch double, loss double, learning_rate double"


def test_log_sink_and_scan(spark, tmp_path):
    path = str(tmp_path / "deep" / "log")
    one = spark.createDataFrame([("r", 10, 0.5, 2.345678, 1e-4)], LOG)
    sinks.append_log(one, path)
    more = [("r", 0, 0.0, 0.0, None), ("r", 1, 0.12345, 1.23456789, None), ("r", 2, 0.2, None, None)]
    sinks.append_log(spark.createDataFrame(more, LOG), path)
    log = tables.read_training_log(spark, path, tables.RUN_LOG_SCHEMA)
    assert rows(log, "step", "epoch", "loss") == [
        (0, None, 0.0), (1, 0.1235, 1.234568), (10, 0.5, 2.345678),
    ]
    with pytest.raises(ValueError, match="run_id"):
        sinks.append_log(one.drop("run_id"), path)


def test_log_scan_unions_fields(spark, tmp_path):
    file = tmp_path / "log.jsonl"
    file.write_text('{"step": 1, "loss": 2.5}\n\n{"step": 2, "eval_loss": 1.5, "epoch": 1.0}\n')
    log = tables.read_training_log(spark, str(file))
    assert len(log.columns) == 14 and log.count() == 2
    assert rows(report.loss_curve(log), "step", "series", "value") == [(1, "train", 2.5), (2, "eval", 1.5)]


def test_results_scan(spark, tmp_path):
    (tmp_path / "a.json").write_text(
        json.dumps({"quantitative": {"m": {"v": 1.0}}, "qualitative": [{"input": "i", "output": "o"}]}, indent=2)
    )
    (tmp_path / "b.json").write_text("{}")
    out = tables.read_results(spark, str(tmp_path))
    assert rows(report.flatten(out), "metric", "sub_metric", "value") == [("m", "v", 1.0)]
    assert sorted(len(r.qualitative) for r in out.collect()) == [0, 1]
    assert report.pivot(report.flatten(out)).first().asDict() == {"metric": "m", "v": 1.0}


def test_model_catalogue(spark, tmp_path):
    for name, meta in {
        "a": {"approach": "lora", "base_model": "gpt2", "training_date": "2024-01-02T03:04:05.123456+00:00"},
        "b": {},
    }.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "metadata.json").write_text(json.dumps(meta))
    out = {r.name: r for r in tables.models(spark, f"{tmp_path}/*/metadata.json").collect()}
    assert out["gpt2"].adaptation_method == "lora" and out["gpt2"].training_date.year == 2024
    assert out["unknown"].adaptation_method == "unknown" and out["unknown"].training_date is None
    named = tables.models(spark, f"{tmp_path}/*/metadata.json", "mine").select("name").distinct()
    assert [r.name for r in named.collect()] == ["mine"]


def test_preview(spark):
    df = spark.createDataFrame([(i, "i" * 201, None) for i in range(7)], "id int, input string, output string")
    out = report.preview(df, ["id"]).collect()
    assert len(out) == 5 and out[0].input == "i" * 200 + "..." and out[0].output == ""


def test_stream_equals_batch_and_replays_leave_one_copy(spark, tmp_path):
    path, target = str(tmp_path / "log"), str(tmp_path / "metrics")
    logs = spark.createDataFrame([("r", i, 0.1, float(i), 0.5) for i in range(5)], LOG)
    sinks.append_log(logs, path)
    stream = ingest.read_log_stream(spark, path)
    ingest.ingest_metrics(stream, target, str(tmp_path / "o1")).awaitTermination()
    expected = rows(track.metric_events(track.log_entries(logs)), "run_id", "key", "value", "step")
    columns = ("run_id", "key", "value", "step")
    assert rows(spark.read.parquet(target), *columns) == expected
    # lost offsets: the same batch id is written again
    ingest.ingest_metrics(stream, target, str(tmp_path / "o2")).awaitTermination()
    assert rows(spark.read.parquet(target), *columns) == expected
    # a second stream has batch numbers of its own
    other = str(tmp_path / "other")
    sinks.append_log(spark.createDataFrame([("s", 3_000_000_000, 0.1, 2.0, 0.5)], LOG), other)
    stream = ingest.read_log_stream(spark, other)
    ingest.ingest_metrics(stream, target, str(tmp_path / "o3"), source="other").awaitTermination()
    both = spark.read.parquet(target)
    assert rows(both.filter("run_id = 'r'"), *columns) == expected
    assert {r.step for r in both.filter("run_id = 's'").collect()} == {3_000_000_000}
    current = track.current(both.drop("source", "batch_id"), ["run_id", "key", "step"])
    assert current.count() == both.count()


def test_runs_read_only_their_kinds(spark, tmp_path):
    spark.createDataFrame([], track.EVENT_SCHEMA).write.parquet(str(tmp_path / "e"))
    plan = track.runs(spark.read.parquet(str(tmp_path / "e")))._jdf.queryExecution().toString()
    assert "PushedFilters: [Or(EqualTo(kind,start),EqualTo(kind,end))]" in plan


def test_stream_prompts_equal_batch(spark, tmp_path):
    df = spark.createDataFrame([(1, " A b "), (2, "C")], "id int, text string")
    df.write.parquet(str(tmp_path / "in"))
    spec = PromptSpec("<{text}>")
    stream = ingest.prompts(
        spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), spec, ("text",)
    )
    ingest.write_parquet(stream, str(tmp_path / "out"), str(tmp_path / "o")).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert rows(out, "id", "formatted_text") == [(1, "<A b>"), (2, "<C>")]


def test_whole_run(spark, tmp_path):
    df = spark.range(60).select(
        "id", F.concat(F.lit("Explain item "), F.col("id").cast("string")).alias("instruction"),
        F.lit(" context ").alias("input"), F.concat(F.lit("answer "), F.col("id").cast("string")).alias("output"),
    )
    df.write.parquet(str(tmp_path / "data"))
    data = DataSpec(
        path=str(tmp_path / "data"), key=("id",), sample=SampleSpec(n=50), clean=CleanSpec(),
        model_name="gpt2",
    )
    prepared = data_prep.run(spark, data)
    assert {r["split"]: r["count"] for r in prepared.groupBy("split").count().collect()} == {
        "train": 40, "val": 5, "test": 5,
    }
    assert prepared.first().formatted_text.startswith("### Instruction:\nExplain item")
    stored = data_prep.run(spark, data, keep=False)
    assert rows(stored, "id", "split") == rows(prepared, "id", "split")
    after = data_prep.run(spark, replace(data, sample_after_clean=True))
    assert rows(after, "id", "split") == rows(prepared, "id", "split")
    prompts = spark.createDataFrame([("What is a bond?",)], "prompt string")
    out = whole_run.run(
        spark, data, EvalSpec(metrics=("rouge",)), lambda: (lambda ps, n: [p + "answer" for p in ps]),
        str(tmp_path / "out"), prompts,
    )
    got = {r.sub_metric: r.value for r in out.collect()}
    assert got["rouge1"] == pytest.approx(2 / 3, abs=1e-6)
    lines = spark.read.json(str(tmp_path / "out" / "results" / "qualitative")).collect()
    assert [r.output for r in lines] == ["answer"]


def files(path):
    return {str(f): f.stat().st_mtime_ns for f in path.rglob("*.parquet")}


def test_upsert_equals_the_whole_history(spark, events, tmp_path):
    """Batches that overlap, arrive late and are repeated."""
    base = str(tmp_path)
    late, early = events.filter("seq > 4"), events.filter("seq < 8")
    for batch, name in ((late, "b"), (early, "a"), (early, "c"), (events.limit(0), "empty")):
        sinks.upsert_tracking(batch, base, name, "/srv", parts=4)
    m = tables.read_upserted(spark, base, "metrics")
    assert rows(m, "run_id", "key", "value", "step") == rows(track.metrics(events), "run_id", "key", "value", "step")
    p = tables.read_upserted(spark, base, "params")
    assert rows(p, "run_id", "key", "value") == rows(track.params(events, "/srv"), "run_id", "key", "value")
    r = tables.read_upserted(spark, base, "runs")
    assert sorted(map(str, r.collect())) == sorted(map(str, track.runs(events).collect()))


def test_upsert_rewrites_only_what_a_batch_touches(spark, tmp_path):
    def batch(ids, value, ts):
        return spark.createDataFrame([(i, value, ts, 0) for i in ids], "k long, v string, ts double, seq long")

    path = str(tmp_path / "t")
    assert sinks.upsert(batch(range(200), "old", 1.0), path, ["k"], "1", parts=16)
    before = files(tmp_path)
    assert sinks.upsert(batch([5], "new", 2.0), path, ["k"], "2", parts=16)
    after = files(tmp_path)
    touched = {f for f in after if "/rows/" in f and f not in before}
    assert len({f.split("_part=")[1].split("/")[0] for f in touched}) == 1
    assert sum(f in before for f in after if "/rows/" in f) >= 10
    # the same batch id, a late row, and a row of a key that is not there yet
    assert not sinks.upsert(batch([5], "newest", 9.0), path, ["k"], "2", parts=16)
    assert sinks.upsert(batch([5, 999], "late", 0.5), path, ["k"], "3", parts=16)
    out = {r.k: r.v for r in spark.read.parquet(f"{path}/rows").collect()}
    assert out == {i: "old" for i in range(200)} | {5: "new", 999: "late"}
