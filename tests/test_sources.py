"""CSV files with different headers, and sinks that are run twice."""

import gzip

import pytest
from pyspark.sql import functions as F

from voltide.sources import files
from voltide.sources.by_name import csv_headers, read_csv_by_name

SCHEMA = "a int, b double, c string"


def put(folder, **texts):
    for name, text in texts.items():
        path = folder / f"{name}.csv"
        path.write_text(text)
    return str(folder)


def rows(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


def test_columns_are_found_by_name(spark, tmp_path):
    path = put(tmp_path, one="a,b,c\n1,1.5,x\n", two="c,a,b\ny,2,2.5\n", three="b,d,a\n3.5,z,3\n", empty="")
    df = read_csv_by_name(spark, path, SCHEMA, file_name="file")
    assert df.dtypes == [("a", "int"), ("b", "double"), ("c", "string"), ("d", "string"), ("file", "string")]
    assert rows(df, "a", "b", "c", "d", "file") == [
        (1, 1.5, "x", None, "one.csv"), (2, 2.5, "y", None, "two.csv"), (3, 3.5, None, "z", "three.csv")]
    assert read_csv_by_name(spark, path, SCHEMA, extra=False).columns == ["a", "b", "c"]
    with pytest.raises(ValueError, match="three.csv lacks c"):
        files.read_csv(spark, path, SCHEMA)
    assert rows(files.read_csv(spark, f"{path}/two.csv", SCHEMA), "a", "b", "c") == [(2, 2.5, "y")]


def test_types_are_inferred_for_all_files_together(spark, tmp_path):
    path = put(tmp_path, predictions_1="n,x,s\n1,1,5\n", predictions_2="s,x,n\nabc,2.5,3000000000\n")
    df = files.read_prediction_files(spark, f"{path}/predictions_*.csv")
    assert dict(df.dtypes) == {"n": "bigint", "x": "double", "s": "string", "file_name": "string"}
    assert rows(df, "n", "x", "s") == [(1, 1.0, "5"), (3000000000, 2.5, "abc")]


def test_odd_headers(spark, tmp_path):
    spaced, listed = tmp_path / "with space", tmp_path / "list [1]"
    spaced.mkdir()
    listed.mkdir()
    (spaced / "q.csv").write_text('"a ""x""","line\nbreak",\n1,2,3\n')
    with gzip.open(listed / "z.csv.gz", "wt") as f:
        f.write("\ufeffa,b\n7,8.5\n")
    pattern = str(listed).replace("[", "\\[").replace("]", "\\]")
    assert list(csv_headers(spark, [str(spaced), pattern]).values()) == [("a", "b"), ('a "x"', "line\nbreak", "_c2")]
    assert rows(read_csv_by_name(spark, pattern, "b double, a int"), "a", "b") == [(7, 8.5)]
    quoted = read_csv_by_name(spark, str(spaced))
    assert rows(quoted, 'a "x"', "line\nbreak", "_c2") == [(1, 2, 3)]


def test_quotes_come_back(spark, tmp_path):
    df = spark.createDataFrame([(1, 'say "x", twice'), (2, "back\\slash")], "a int, c string")
    files.write_csv(df, str(tmp_path / "q"))
    assert rows(files.read_csv(spark, str(tmp_path / "q"), "c string, a int"), "a", "c") == rows(df, "a", "c")


def test_what_cannot_be_read(spark, tmp_path):
    put(tmp_path, twice="a,a\n1,2\n")
    with pytest.raises(ValueError, match="column name twice"):
        read_csv_by_name(spark, str(tmp_path / "twice.csv"), SCHEMA)
    put(tmp_path, none="")
    with pytest.raises(FileNotFoundError):
        read_csv_by_name(spark, str(tmp_path / "none.csv"))
    put(tmp_path, bad="b,a\n1.5,x\n")
    with pytest.raises(Exception, match="(?i)malformed|parse|cast"):
        read_csv_by_name(spark, str(tmp_path / "bad.csv"), SCHEMA).collect()


def test_only_wanted_columns_are_read(spark, tmp_path):
    path = put(tmp_path, one="a,b,c\n1,1.5,x\n", two="c,a,b\ny,2,2.5\n")
    plan = read_csv_by_name(spark, path, SCHEMA).where(F.col("a") > 1).select("b")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "c:string" not in text and text.count("GreaterThan(a,1)") >= 2


PREDICTIONS = "op_id long, prediction_timestamp timestamp"


def predictions(spark, *pairs):
    import datetime as dt

    return spark.createDataFrame(
        [(i, d and dt.datetime.fromisoformat(d)) for i, d in pairs], PREDICTIONS)


def test_a_run_replaces_its_own_rows_only(spark, tmp_path):
    path = str(tmp_path / "p")
    first = predictions(spark, (1, "2024-01-01T10:00:00"), (2, "2024-01-02T10:00:00"), (3, None))
    other = predictions(spark, (9, "2024-01-01T11:00:00"))
    for df, run in ((first, "a"), (other, "b"), (first, "a")):
        files.append_predictions(df, path, run)
    stored = spark.read.parquet(path)
    assert rows(stored, "op_id", "run_id") == [(1, "a"), (2, "a"), (3, "a"), (9, "b")]
    # fewer days: what the run said before is gone, the other run stays
    files.append_predictions(predictions(spark, (2, "2024-01-02T10:00:00")), path, "a")
    assert rows(spark.read.parquet(path), "op_id") == [(2,), (9,)]
    files.append_predictions(predictions(spark), path, "a")
    assert rows(spark.read.parquet(path), "op_id") == [(9,)]
    with pytest.raises(ValueError, match="a run is named by"):
        files.append_predictions(other, path, "../b")


def test_records_and_events_of_a_repeated_run(spark, tmp_path):
    import datetime as dt

    record = files.metric_record(spark, dt.datetime(2024, 3, 1), {"rmse": 1.0}, {})
    later = files.metric_record(spark, dt.datetime(2024, 3, 1), {"rmse": 2.0}, {})
    for df, run in ((record, "a"), (record, "a"), (later, "b")):
        files.write_metric_records(df, str(tmp_path / "m"), run)
    back = files.read_metric_records(spark, str(tmp_path / "m"))
    assert back.columns == record.columns and sorted(r["metrics"]["rmse"] for r in back.collect()) == [1.0, 2.0]

    events = spark.createDataFrame(
        [(dt.datetime(2024, m, 1), "login", "ok", None) for m in (1, 2, 3)],
        "timestamp timestamp, event_type string, status string, details string")
    now = F.lit(dt.datetime(2024, 3, 10))
    for _ in range(2):
        files.append_audit_events(events, str(tmp_path / "e"), "a", now)
    import os

    assert [d for d in sorted(os.listdir(tmp_path / "e")) if d.startswith("day")] == ["day=2024-03-01"]
    assert files.read_audit_events(spark, str(tmp_path / "e"), now).count() == 1


def test_monitoring_run_twice(spark, tmp_path):
    import datetime as dt

    from voltide.operators import monitor

    path = str(tmp_path / "h")
    records = spark.createDataFrame(
        [(dt.datetime(2024, 1, d, 12), {"rmse": 200.0}, {}) for d in (1, 20, 31)], monitor.RECORD)
    monitor.append_history(records, path)
    for _ in range(2):
        alerts, recent = monitor.run_monitoring(records, path, F.lit(dt.datetime(2024, 1, 31, 13)), days=15)
        assert recent.count() == 2 and alerts.count() == 1
    assert spark.read.parquet(path).count() == 2
