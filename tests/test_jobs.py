"""The compositions, on small inputs in batch and as streams."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import LOGIN, LOGINS_1, LOGINS_2, ORDER, ORDERS, START
from millrace import jobs
from millrace.sinks import files
from millrace.sources.lines import stream_text_lines

CLICKS = [f"{u},{(u * 7) % 5},9,{'pv' if u % 4 else 'buy'},{1511658000 + 3 * u}" for u in range(60)]
VISITS = [f"2020-01-01 00:00:{s:02d}, m{s % 4},{s},http://x" for s in range(0, 50, 2)]


def stream_rows(spark, tmp_path, lines, last, start):
    """Runs ``start`` over two files of lines and a last line far ahead."""
    folder, out = tmp_path / "lines", str(tmp_path / "out")
    folder.mkdir()
    for i, part in enumerate((lines[::1][: len(lines) // 2], lines[len(lines) // 2:], [last])):
        (folder / f"{i}.txt").write_text("\n".join(part) + "\n")
        start(stream_text_lines(spark, str(folder)), files.parquet_batches(out), str(tmp_path / "state")).awaitTermination()
    return spark.read.option("recursiveFileLookup", "true").parquet(out)


def test_hot_items(spark, make, rows_of, tmp_path, capsys):
    batch = jobs.hot_items(make([(c,) for c in CLICKS], "value STRING").drop("seq"), size="60 seconds")
    got = stream_rows(
        spark, tmp_path, CLICKS, "1,1,1,buy,2511658000",
        lambda s, w, c: jobs.start_hot_items(s, w, c, size="60 seconds", available_now=True),
    )
    columns = ["window_end", "item_id", "cnt", "rank"]
    assert batch.count() > 0 and rows_of(got.select(*columns)) == rows_of(batch.select(*columns))
    jobs.print_rankings(batch.limit(3))
    assert "商品ID" in capsys.readouterr().out


def test_top_visitors(spark, make, rows_of, tmp_path):
    batch = jobs.top_visitors(make([(v,) for v in VISITS], "value STRING").drop("seq"), size="20 seconds")
    got = stream_rows(
        spark, tmp_path, VISITS, "2090-01-01 00:00:00,x,1,http://x",
        lambda s, w, c: jobs.start_top_visitors(s, w, c, size="20 seconds", available_now=True),
    )
    columns = ["window_end", "mid", "cnt", "rank"]
    assert {r.mid for r in batch.collect()} == {"m0", "m2"}
    assert rows_of(got.select(*columns)) == rows_of(batch.select(*columns))


def run_parts(spark, tmp_path, rows, schema, start):
    """Runs ``start(stream, writer of a name, checkpoint)`` over parts of rows; the tables by name."""
    folder = str(tmp_path / "rows")
    for part in rows:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(schema).parquet(folder)
        start(stream, lambda name: files.parquet_batches(str(tmp_path / name)), str(tmp_path / "state")).awaitTermination()
    return lambda name: spark.read.option("recursiveFileLookup", "true").parquet(str(tmp_path / name))


SENSOR_FEED = "value STRING, seq LONG"


def test_coldest_readings_as_a_stream(spark, make, rows_of, tmp_path):
    lines = [(f"p{i % 2}, {START + i}, {(i * 13) % 7}.5", i) for i in range(40)]
    batch = jobs.coldest_readings(spark.createDataFrame(lines, SENSOR_FEED))
    read = run_parts(
        spark, tmp_path, [lines[:20], lines[20:], [(f"z, {START + 9000}, 1.0", 99)]], SENSOR_FEED,
        lambda s, w, c: jobs.start_coldest_readings(s, w("out"), c, available_now=True))
    assert batch.count() > 0 and rows_of(read("out").select(*batch.columns)) == rows_of(batch)


def test_controlled_readings_as_a_stream(spark, tmp_path):
    lines = [(f"p, {START + i}, {20 - i}.5", i) for i in range(12)] + [(f"c, {START + 30}, 9.0", 12), (f"p, {START + 1}, 0.0", 13)]
    read = run_parts(
        spark, tmp_path, [lines[:6], lines[6:]], SENSOR_FEED,
        lambda s, w, c: jobs.start_controlled_readings(s, w("out"), c, "c", available_now=True))
    # Only the control sensor closes windows; the reading after it is late.
    assert read("out").filter("id = 'p'").agg(F.min("temperature")).first()[0] == 9.5


def test_alarms_as_a_stream(spark, rows_of, tmp_path):
    lines = [(f"p, {START + i}, {10 + i % 5}.0", i) for i in range(30)]
    batch = jobs.temperature_alarms(spark.createDataFrame(lines, SENSOR_FEED))
    read = run_parts(
        spark, tmp_path, [lines, [(f"z, {START + 9000}, -1.0", 99)]], SENSOR_FEED,
        lambda s, w, c: jobs.start_temperature_alarms(s, w("out"), c, available_now=True))
    assert batch.count() > 1 and rows_of(read("out")) == rows_of(batch)


def test_logins_and_orders_as_streams(spark, rows_of, tmp_path):
    def numbered(rows):
        return [(*row, i) for i, row in enumerate(rows)]

    (tmp_path / "a").mkdir(), (tmp_path / "b").mkdir()
    far = (None, None, None, START + 90_000, 99)
    read = run_parts(
        spark, tmp_path / "a", [numbered(LOGINS_2)[:4], numbered(LOGINS_2)[4:], [far]], LOGIN + ", seq LONG",
        lambda s, w, c: jobs.start_login_warnings(
            s, w("out"), c, available_now=True, keys=[], message=jobs.patterns.FAIL_PATTERN_MESSAGE))
    batch = jobs.login_pattern_warnings(spark.createDataFrame(numbered(LOGINS_2), LOGIN + ", seq LONG"))
    assert rows_of(read("out")) == rows_of(batch)
    read = run_parts(
        spark, tmp_path / "b", [numbered(ORDERS), [(None, None, START + 90_000, 99)]], ORDER + ", seq LONG",
        lambda s, w, c: jobs.start_order_outputs(s, w("paid"), w("late"), c, available_now=True))
    paid, late = jobs.order_outputs(spark.createDataFrame(numbered(ORDERS), ORDER + ", seq LONG"))
    assert rows_of(read("paid")) == rows_of(paid) and rows_of(read("late")) == rows_of(late)


def test_sensors(sensor_lines, make):
    assert jobs.coldest_readings(sensor_lines).count() == 11
    assert jobs.temperature_alarms(sensor_lines).count() == 3
    main, cold = jobs.freeze_warnings(sensor_lines)
    assert (main.count(), cold.count()) == (3, 2)
    assert jobs.sensor_strings(sensor_lines).first().value.startswith(f"Sensor(probe_a,{START + 12},35.5")
    assert jobs.sensor_documents(sensor_lines).filter(F.col("document").contains(f'"timeStamp":"{START + 26}"')).count() == 1
    assert jobs.coldest_readings(make([("",), ("a,1,2.0",)], "value STRING")).count() == 3


def test_logins_and_orders(make, rows_of):
    assert jobs.login_warnings(make(LOGINS_1, LOGIN)).count() == 3
    assert rows_of(jobs.login_pattern_warnings(make(LOGINS_2, LOGIN)).select("user_id")) == [(42,)]
    paid, late = jobs.order_outputs(make(ORDERS, ORDER))
    assert [r.order_id for r in paid.collect()] == [72] and sorted(r.order_id for r in late.collect()) == [71, 73]


def test_word_count_stream(spark, tmp_path):
    folder = tmp_path / "lines"
    folder.mkdir()
    (folder / "a.txt").write_text("rain wind\n" * 9)
    out = str(tmp_path / "out")
    jobs.start_word_count(
        stream_text_lines(spark, str(folder)), out, str(tmp_path / "state"), available_now=True).awaitTermination()
    lines = spark.read.option("recursiveFileLookup", "true").text(out)
    assert sorted(r.value for r in lines.collect()) == ["(rain,9)", "(wind,9)"]


@pytest.mark.parametrize("bad", ["1,2", "x,1,1,pv,1"])
def test_bad_lines_stop_the_job(make, bad):
    with pytest.raises(Exception, match="cannot parse line"):
        jobs.hot_items(make([(bad,)], "value STRING").drop("seq")).collect()
