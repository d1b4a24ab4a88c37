import pandas as pd
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from quillspark.operators import progress
from quillspark.sources import state, tables
from quillspark.sources import text as text_source
from quillspark.streaming import ingest
from quillspark.streaming.progress import _rises, start_progress
from quillspark.streaming.training import start_training
from quillspark.plans.training import pages_to_training


def test_progress_line(values):
    (got,) = values({"v": "100%|██████████| 5571/5571"}, progress.progress_of(F.col("v")))
    assert tuple(got) == (100, 5571, 5571, True)
    assert values({"v": "noise 5/6"}, progress.progress_of(F.col("v"))) == [None]


@pytest.mark.parametrize("split_bytes", ["128m", "50b"])
def test_log_file(spark, tmp_path, split_bytes):
    lines = [f"line {i}" if i % 4 else f"{min(i, 100)}%|##| {i}/120" for i in range(121)]
    (tmp_path / "log").write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    try:
        log = text_source.read_log_lines(spark, str(tmp_path / "log"))
        assert [r.value for r in log.orderBy("line_no").collect()] == lines
        assert [r.line_no for r in progress.tail_lines(log, 2).collect()] == [120, 119]
        latest = progress.latest_progress(progress.parse_progress(progress.tail_lines(log))).collect()[0]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert (latest.percent, latest.current_step, latest.completed) == (100, 120, True)


def test_rises(spark):
    data = [("j", i, p, p, 100, p >= 100) for i, p in enumerate([1, 1, 3, 2, 5, 100, 120])]
    df = spark.createDataFrame(
        data, "job string, line_no long, percent long, current_step long, total_steps long, completed boolean"
    )
    got = progress.progress_increases(df, ["job"]).orderBy("line_no").collect()
    assert [r.percent for r in got] == [1, 3, 5, 100] and [r.line_no for r in got] == [0, 2, 4, 5]


def land(spark, path, rows, schema="id string, pos int, bad boolean"):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(path)


def fail_bad(batch):
    return batch.withColumn("error", F.when(F.col("bad"), F.lit("bad page")))


def test_ingest_resumes_and_retries(spark, tmp_path):
    src, out, mark = (str(tmp_path / n) for n in ("src", "out", "mark"))
    schema = "id string, pos int, bad boolean"

    def run():
        stream = spark.readStream.schema(schema).json(src)
        ingest.start_ingest(stream, fail_bad, out, mark, order=["pos"]).awaitTermination()

    land(spark, src, [("a", 1, False), ("b", 2, True), ("a", 3, False)])
    run()
    run()  # nothing new: no row is added
    assert [(r.id, r.pos) for r in spark.read.parquet(f"{out}/records").collect()] == [("a", 1)]
    assert [r.id for r in ingest.pending_retries(spark, out).collect()] == ["b"]
    land(spark, src, [("a", 4, False), ("b", 5, False), ("c", 6, False)])
    run()
    assert sorted(r.id for r in spark.read.parquet(f"{out}/records").collect()) == ["a", "b", "c"]
    assert ingest.pending_retries(spark, out).count() == 0


def test_a_new_checkpoint_keeps_old_records_and_failed_rows_are_replayed(spark, tmp_path):
    out = str(tmp_path / "out")
    schema = "id string, pos int, bad boolean"
    for k, rows in enumerate([[("a", 1, False), ("b", 2, True)], [("c", 3, False), ("a", 4, False)]]):
        land(spark, str(tmp_path / f"src{k}"), rows)
        stream = spark.readStream.schema(schema).json(str(tmp_path / f"src{k}"))
        ingest.start_ingest(stream, fail_bad, out, str(tmp_path / f"mark{k}"), order=["pos"]).awaitTermination()
    assert sorted((r.id, r.pos) for r in spark.read.parquet(f"{out}/records").collect()) == [("a", 1), ("c", 3)]
    ingest.retry_failed(spark, lambda b: b.withColumn("error", F.lit(None).cast("string")), out, order=["pos"])
    assert sorted(r.id for r in spark.read.parquet(f"{out}/records").collect()) == ["a", "b", "c"]
    assert ingest.pending_retries(spark, out).count() == 0


def test_a_wrong_key_is_an_error(spark, tmp_path):
    state.save_seen(spark.createDataFrame([("a",)], "id string"), str(tmp_path / "seen"))
    with pytest.raises(AnalysisException):
        state.load_seen(spark, str(tmp_path / "seen"), "url")


def test_a_replayed_batch_overwrites_itself(spark, tmp_path):
    body = ingest.ingest_batch(fail_bad, str(tmp_path), order=["pos"])
    batch = spark.createDataFrame([("a", 1, False)], "id string, pos int, bad boolean")
    body(batch, 0)
    body(batch, 0)
    assert spark.read.parquet(f"{tmp_path}/records").count() == 1
    body(batch, 1)
    assert spark.read.parquet(f"{tmp_path}/records").count() == 1


def test_reset_forgets_records_errors_and_offsets(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    schema = "id string, pos int, bad boolean"
    land(spark, src, [("a", 1, False), ("b", 2, True)])

    def run():
        data, mark = ingest.generation_folders(spark, out)
        stream = spark.readStream.schema(schema).json(src)
        ingest.start_ingest(stream, fail_bad, data, mark, order=["pos"]).awaitTermination()
        return data

    first = run()
    assert run() == first and spark.read.parquet(f"{first}/records").count() == 1
    land(spark, src, [("a", 0, False)])
    second, _ = ingest.reset_ingest(spark, out)
    assert run() == second != first
    assert [(r.id, r.pos) for r in spark.read.parquet(f"{second}/records").collect()] == [("a", 0)]
    assert [r.id for r in ingest.pending_retries(spark, second).collect()] == ["b"]
    assert [(r.id, r.pos) for r in spark.read.parquet(f"{first}/records").collect()] == [("a", 1)]
    assert ingest.reset_ingest(spark, out)[0] not in (first, second)


def test_stream_unseen_equals_batch(spark, tmp_path):
    src, out, mark = (str(tmp_path / n) for n in ("src", "out", "mark"))
    for k in range(3):
        land(spark, src, [(str(i % 7), i, False) for i in range(k * 10, k * 10 + 10)])
    stream = spark.readStream.schema("id string, pos int, bad boolean").option("maxFilesPerTrigger", 1).json(src)
    for _ in range(2):
        ingest.stream_unseen(stream.select("id")).writeStream.format("parquet").option("path", out).option(
            "checkpointLocation", mark
        ).trigger(availableNow=True).start().awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [str(i) for i in range(7)]


def test_stream_progress_carries_the_maximum(spark, tmp_path):
    src, out, mark = (str(tmp_path / n) for n in ("src", "out", "mark"))
    schema = "job string, line_no long, value string"

    def run(pairs):
        land(spark, src, [("j", n, f"{p}%|#| {p}/100") for n, p in pairs], schema)
        start_progress(spark.readStream.schema(schema).json(src), out, mark).awaitTermination()

    run([(0, 5), (1, 5), (2, 9)])
    run([(3, 7), (4, 12), (5, 100)])
    run([(6, 120)])
    got = spark.read.parquet(out).orderBy("line_no").collect()
    assert [r.percent for r in got] == [5, 9, 12, 100]


def test_stream_training_equals_batch(spark, tmp_path):
    html = "<p>" + "</p><p>".join("some text of a page " * 9 for _ in range(20)) + "</p>"
    pages = spark.createDataFrame([(i, f"https://h/{i}", html) for i in range(4)], "page_id long, url string, html string")
    pages.repartition(3).write.parquet(str(tmp_path / "src"))
    stream = spark.readStream.schema(pages.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "src"))
    start_training(stream, str(tmp_path / "out"), str(tmp_path / "mark")).awaitTermination()
    got = sorted(r.text for r in spark.read.json(str(tmp_path / "out")).collect())
    assert got == sorted(r.text for r in pages_to_training(pages).collect()) and len(got) > 4


def test_seen_state(spark, tmp_path):
    path = str(tmp_path / "seen")
    assert state.load_seen(spark, path).count() == 0
    ids = spark.createDataFrame([("a",), ("b",)], "id string")
    state.save_seen(ids, path)
    state.save_seen(ids, path)
    assert sorted(r.id for r in state.load_seen(spark, path).collect()) == ["a", "b"]
    state.save_seen(ids.limit(0), path, reset=True)
    assert state.load_seen(spark, path).count() == 0
    done = spark.createDataFrame([(1,), (3,)], "page long")
    assert state.resume_page(done).collect()[0].page == 4
    assert state.resume_page(done.limit(0)).collect()[0].page == 1


def test_records_round_trip(spark, tmp_path):
    path = str(tmp_path / "r")
    df = spark.createDataFrame([("é", None, ["x"])], "title string, date string, tags array<string>")
    tables.write_records(df, path)
    tables.write_records(df, path)
    raw = "".join(p.read_text() for p in (tmp_path / "r").glob("part-*"))
    assert '"date":null' in raw and "é" in raw
    (tmp_path / "r" / "broken.json").write_text("{bad\n")
    back = tables.read_records(spark, path, df.schema)
    assert back.where("title = 'é'").count() == 2 and back.count() == 3
    assert tables.preview(df.select("title", "date")).collect()[0].line == "é (No date)"


def test_training_sink_appends(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("a", "x")], "text string, source string")
    tables.write_training(df, path)
    tables.write_training(df, path, "append")
    assert spark.read.json(path).columns == ["text"] and spark.read.json(path).count() == 2


def test_csv_scan(spark, tmp_path):
    from quillspark.sources.trees import read_csv

    (tmp_path / "x.csv").write_text('a,b\n1,"two\nlines"\n')
    assert read_csv(spark, str(tmp_path / "x.csv")).collect()[0].b == "two\nlines"


def test_progress_state_over_restarts_and_jobs(spark, tmp_path):
    src, out, mark = (str(tmp_path / n) for n in ("src", "out", "mark"))
    schema = "job string, line_no long, value string"
    parts = [
        [("a", 2, "7%|#| 7/100"), ("a", 1, "3%|#| 3/100"), ("b", 1, "noise"), (None, 5, "4%|#| 4/9"), ("a", 3, "7%|#| 8/100")],
        [("a", 4, "5%|#| 5/100"), ("b", 2, "1%|#| 1/100"), (None, 6, "4%|#| 5/9")],
        [("a", 5, "100%|#| 100/100"), ("a", 6, "120%|#| 1/1"), (None, 7, "9%|#| 9/9"), ("b", 3, "")],
        [("a", 7, "130%|#| 1/1"), ("b", 4, "2%|#| 2/100"), ("b", 4, "2%|#| 2/100")],
    ]
    for rows in parts:
        land(spark, src, rows, schema)
        start_progress(spark.readStream.schema(schema).json(src), out, mark).awaitTermination()
    got = spark.read.parquet(out)
    assert "event" not in got.columns
    assert sorted(((r.job, r.line_no, r.percent, r.current_step, r.total_steps, r.completed) for r in got.collect()), key=str) == sorted(
        [("a", 1, 3, 3, 100, False), ("a", 2, 7, 7, 100, False), ("a", 5, 100, 100, 100, True), ("b", 2, 1, 1, 100, False),
         ("b", 4, 2, 2, 100, False), (None, 5, 4, 4, 9, False), (None, 7, 9, 9, 9, False)], key=str)


def test_a_replayed_progress_batch_reads_no_earlier_output(spark, tmp_path):
    """The state alone carries the maximum: output that is gone does not bring rises back."""
    src, mark = str(tmp_path / "src"), str(tmp_path / "mark")
    schema = "job string, line_no long, value string"
    for k, want in ((0, [50]), (1, []), (2, [60])):
        land(spark, src, [("j", k, f"{(50, 40, 60)[k]}%|#| 1/2")], schema)
        out = str(tmp_path / f"out{k}")
        start_progress(spark.readStream.schema(schema).json(src), out, mark).awaitTermination()
        assert [r.percent for r in spark.read.schema("percent long").parquet(out).collect()] == want


def test_a_silent_job_is_reported_once(spark, tmp_path):
    import time

    src, out, mark = (str(tmp_path / n) for n in ("src", "out", "mark"))
    schema = "job string, line_no long, value string"
    land(spark, src, [("done", 1, "100%|#| 9/9"), ("stuck", 1, "20%|#| 2/9")], schema)
    query = start_progress(spark.readStream.schema(schema).json(src), out, mark, every="1 second", silence_ms=2000)
    try:
        events = set()
        for _ in range(60):
            time.sleep(1)
            if query.lastProgress and query.lastProgress["batchId"] > 0:
                events = {(r.job, r.event, r.percent) for r in spark.read.parquet(out).collect()}
                if len(events) == 3:
                    break
        assert query.exception() is None
        assert events == {("done", "completed", 100), ("stuck", "progress", 20), ("stuck", "silent", 20)}
    finally:
        query.stop()


def test_visits_expire(spark, tmp_path):
    src, out, mark = (str(tmp_path / n) for n in ("src", "out", "mark"))
    schema = "id string, ts timestamp, extra int, n int, last_at int"
    at = lambda h: f"2024-01-{1 + h // 24:02d} {h % 24:02d}:00:00"

    def run(rows):
        land(spark, src, [(i, at(h) if h is not None else None, x, 0, 0) for i, h, x in rows], "id string, ts string, extra int, n int, last_at int")
        query = ingest.first_of_visits(spark.readStream.schema(schema).json(src), "id", "ts", "2 hours", "3 hours", ["extra"]).writeStream.format(
            "parquet").option("path", out).option("checkpointLocation", mark).trigger(availableNow=True).start()
        query.awaitTermination()
        return sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])

    run([("a", 1, 2), ("a", 0, 1), ("a", 0, 0), (None, 0, 5), ("b", 0, 6), ("b", None, 7)])
    run([("a", 10, 3)])
    assert run([("b", 1, 9), ("a", 30, 4)]) >= 1  # b's row is too late
    got = sorted(((r.id, r.first_at.hour, r.last_at.hour, r.n, r.extra) for r in spark.read.parquet(out).collect()), key=str)
    assert got == sorted([("a", 0, 1, 3, 0), ("a", 10, 10, 1, 3), ("b", 0, 0, 1, 6), (None, 0, 0, 1, 5)], key=str)


class _State:
    hasTimedOut = False

    def __init__(self, value=None):
        self.get, self.exists = value, value is not None

    def update(self, value):
        self.get, self.exists = value, True


def test_rises_of_a_job_without_data_frames_for_nothing():
    fields = ["percent", "line_no", "current_step", "total_steps"]
    frames = [pd.DataFrame([(5, 9, 1, 2), (7, 3, 1, 2)], columns=fields), pd.DataFrame([(4, 1, 1, 2), (120, 8, 1, 2)], columns=fields)]
    state, run = _State(), _rises("job", None)
    (rows,) = run((3,), iter(frames), state)
    assert rows.columns.tolist() == ["job", *fields, "event", "completed"]
    assert rows[["job", "percent", "line_no", "event", "completed"]].values.tolist() == [
        [3, 4, 1, "progress", False], [3, 7, 3, "progress", False], [3, 120, 8, "completed", True]]
    assert state.get == (120, 8, 1, 2)
    assert list(run((3,), iter(frames), state)) == []
