"""Exports, their defaults and bad records, and the streaming form of the metrics."""

import json

import pytest

from deskmill.session import durable_cut, shared_dir
from deskmill.sources.exports import ENTITIES, entity_schema, read_export, write_export
from deskmill.sources.tables import TABLES, read_table
from deskmill.streaming import landing
from deskmill.streaming.metrics import late_rows, stream_execution_metrics, write_metrics

SMALL = "/root/testdata/sf0.001"


def test_declared_tables_match_the_files(spark):
    for name in TABLES:
        declared = read_table(spark, SMALL, name)
        assert declared.dtypes == spark.read.parquet(f"{SMALL}/{name}.parquet").dtypes


def test_all_entities_round_trip(spark, tmp_path):
    for entity in ENTITIES:
        for file_format in ("json", "parquet"):
            empty = spark.createDataFrame([], entity_schema(entity))
            where = write_export(empty, str(tmp_path / file_format), entity, file_format)
            back = read_export(spark, where, entity, file_format, keep_corrupt=False)
            assert back.count() == 0 and back.columns == entity_schema(entity).fieldNames()
    with pytest.raises(ValueError):
        read_export(spark, str(tmp_path), "nonsense")


def test_defaults_and_bad_records(spark, tmp_path):
    folder = tmp_path / "event"
    folder.mkdir()
    lines = [
        json.dumps({"event_id": "1", "start": {"date": "2024-01-01"}, "attendees": [{"email": "a@x"}], "surplus": 1}),
        json.dumps({"event_id": "2", "summary": "Lunch"}),
        "{not json",
    ]
    (folder / "part.json").write_text("\n".join(lines))
    assert read_export(spark, str(tmp_path), "event").count() == 3
    assert read_export(spark, str(tmp_path), "event", keep_corrupt=False).count() == 2
    events = {r.event_id: r for r in read_export(spark, str(tmp_path), "event", keep_corrupt=False).collect()}
    assert sorted(events) == ["1", "2"]
    assert events["1"].summary == "No Title" and events["2"].summary == "Lunch"
    assert events["1"].attendees[0].email == "a@x" and events["1"].location == "No Location"
    kept = read_export(spark, str(tmp_path), "event").collect()
    assert [r["_corrupt_record"] for r in kept if r["_corrupt_record"]] == ["{not json"]


def test_cut_starts_a_new_plan(spark):
    df = spark.range(10).selectExpr("id", "id % 3 AS k").groupBy("k").count()
    cut = durable_cut(df)
    assert sorted(map(tuple, cut.collect())) == sorted(map(tuple, df.collect()))
    assert "Aggregate" not in cut._jdf.queryExecution().executedPlan().toString()
    assert shared_dir(spark) in cut.inputFiles()[0]


def test_streaming_metrics(spark, tmp_path):
    landing = tmp_path / "runs"
    runs = read_table(spark, SMALL, "events").selectExpr("ts", "user_id", "event_type = 'error' AS failed")
    runs.repartition(3).write.parquet(str(landing))
    stream = spark.readStream.schema(runs.schema).parquet(str(landing))
    query = write_metrics(stream_execution_metrics(stream), str(tmp_path / "out"), str(tmp_path / "state"))
    query.awaitTermination()
    closed = {r.start_time: r for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    from deskmill.operators.aggregates import execution_metrics

    exact = {r.start_time: r for r in execution_metrics(runs).collect()}
    assert 0 < len(exact) - len(closed) <= 1
    for start, row in closed.items():
        assert row.total_executions == exact[start].total_executions
        assert row.failed_executions == exact[start].failed_executions
        assert abs(row.active_users - exact[start].active_users) <= 0.1 * exact[start].active_users + 1


def test_rows_behind_the_watermark_are_reported(spark, tmp_path):
    landing = tmp_path / "runs"

    def land(day):
        rows = spark.sql(f"SELECT TIMESTAMP_NTZ '2024-01-{day:02d} 10:00:00' AS ts, id AS user_id, false AS failed FROM range(5)")
        rows.write.mode("append").parquet(str(landing))
        stream = spark.readStream.schema(rows.schema).parquet(str(landing))
        query = write_metrics(stream_execution_metrics(stream), str(tmp_path / "out"), str(tmp_path / "state"))
        query.awaitTermination()
        return late_rows(query)

    assert land(5) == 0 and land(9) == 0
    assert land(2) > 0
    closed = [(r.start_time.day, r.total_executions) for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert closed == [(5, 5)]


def test_exports_land_once(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")

    def arrive(name, *lines):
        (tmp_path / "in" / "task").mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / "task" / name).write_text("\n".join(lines))

    def land():
        landing.land_export(spark, source, "task", target).awaitTermination()
        (row,) = landing.landing_counts(spark, target, ["task"]).collect()
        return tuple(row)

    arrive("a.json", '{"id": "1", "title": "one"}', '{"id": "2", "title": ', "no json", '{"other": 1}')
    assert land() == ("task", 4, 2, 2)
    assert land() == ("task", 4, 2, 2)
    arrive("b.json", '{"id": "3"}')
    arrive("c.json", "broken}")
    assert land() == ("task", 6, 3, 3)
    kept = landing.read_landed(spark, target, "task")
    assert sorted((r.id or "", r.title) for r in kept.collect()) == [("", None), ("1", "one"), ("3", None)]
    turned = landing.read_landed(spark, target, "task", landing.REJECTS).collect()
    assert sorted(r.record for r in turned) == ["broken}", "no json", '{"id": "2", "title": '] and all(r.file.endswith(".json") for r in turned)


def test_defaults_are_filled_in_on_landing(spark, tmp_path):
    (tmp_path / "in" / "comment").mkdir(parents=True)
    (tmp_path / "in" / "comment" / "x.json").write_text('{"comment_id": "c"}')
    landing.land_export(spark, str(tmp_path / "in"), "comment", str(tmp_path / "out")).awaitTermination()
    (row,) = landing.read_landed(spark, str(tmp_path / "out"), "comment").collect()
    assert (row.comment_id, row.author, row.resolved, row.batch) == ("c", "Unknown", False, 0)


def test_files_have_owners():
    assert "owners" in entity_schema("file").names
