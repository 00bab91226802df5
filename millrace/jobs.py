"""The usual questions end to end: from lines or rows to what gets printed or stored.

Each is a short composition of operators; sizes, limits and n are arguments.
Lines are ``value STRING``, in a batch or, for the ``start_`` forms, on a stream.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.text import java_trim
from millrace.functions import parsing, rendering
from millrace.functions.text import not_empty
from millrace.functions.times import event_time
from millrace.operators import alarms, patterns, ranking, routing, sliding, words
from millrace.sinks import documents, files
from millrace.streaming import machines
from millrace.streaming import patterns as stream_patterns
from millrace.streaming.windows import LeastRecord, Lateness, WindowStream, ranked, row_count

BatchWriter = Callable[[DataFrame, int], None]


def _tables(checkpoint: str) -> str:
    """Where a job keeps its own tables: beside the checkpoint, as both belong together."""
    return f"{checkpoint.rstrip('/')}-tables"


def _behavior(lines: DataFrame) -> DataFrame:
    return parsing.parse_behavior(lines).withColumn("ts", event_time("event_time"))


def hot_items(
    lines: DataFrame, n: int = 3, size: str = "60 minutes", slide: str = "5 seconds", behavior: str = "pv"
) -> DataFrame:
    """The ``n`` most viewed items of every window: ``window_end, item_id, cnt, rank``."""
    views = _behavior(lines).filter(F.col("behavior") == behavior)
    return ranking.top_n(sliding.sliding_count(views, ["item_id"], "ts", size, slide), n)


def start_hot_items(
    lines: DataFrame, write: BatchWriter, checkpoint: str, n: int = 3, size: str = "60 minutes",
    slide: str = "5 seconds", behavior: str = "pv", available_now: bool = False,
) -> StreamingQuery:
    """The same on a stream in order; every micro-batch's rankings go to ``write``."""
    views = WindowStream(
        row_count(), ["item_id"], "ts", size, slide, _tables(checkpoint), where=F.col("behavior") == behavior
    )
    return views.start(_behavior(lines), ranked(write, n), checkpoint, available_now)


def top_visitors(
    lines: DataFrame, n: int = 3, size: str = "60 minutes", slide: str = "5 seconds"
) -> DataFrame:
    """The ``n`` machines with most visits: ``window_end, mid, cnt, rank``.

    Names count apart if their blanks differ and are shown without blanks.
    """
    counts = sliding.sliding_count(parsing.parse_visit(lines), ["mid"], "ts", size, slide)
    return ranking.top_n(counts, n, tie=["mid"]).withColumn("mid", java_trim(F.col("mid")))


def start_top_visitors(
    lines: DataFrame, write: BatchWriter, checkpoint: str, n: int = 3, size: str = "60 minutes",
    slide: str = "5 seconds", lateness: str = "2 seconds", available_now: bool = False,
) -> StreamingQuery:
    """The same on a stream whose rows lag by up to ``lateness``."""
    visits = WindowStream(row_count(), ["mid"], "ts", size, slide, _tables(checkpoint), lateness=Lateness(lateness))

    def trimmed(rows: DataFrame, batch_id: int) -> None:
        write(rows.withColumn("mid", java_trim(F.col("mid"))), batch_id)

    return visits.start(parsing.parse_visit(lines), ranked(trimmed, n, tie=["mid"]), checkpoint, available_now)


def print_rankings(top: DataFrame) -> None:
    """Prints rankings of items as text blocks."""
    files.print_rows(rendering.item_report(top))


def _sensors(lines: DataFrame) -> DataFrame:
    return parsing.parse_sensor(lines.filter(not_empty(F.col("value"))))


def coldest_readings(
    lines: DataFrame, seq: str = "seq", size: str = "15 seconds", slide: str = "5 seconds"
) -> DataFrame:
    """The coldest reading of every sensor and window; ``seq`` is the arrival order."""
    return sliding.sliding_min_record(
        _sensors(lines), ["id"], "event_time", size, slide, "temperature", [seq], ["event_time"]
    )


def start_coldest_readings(
    lines: DataFrame, write: BatchWriter, checkpoint: str, seq: str = "seq", size: str = "15 seconds",
    slide: str = "5 seconds", lateness: str | float = "1 second", available_now: bool = False,
) -> StreamingQuery:
    """The same on a stream whose rows lag by up to ``lateness``."""
    return _coldest(seq, size, slide, checkpoint, Lateness(lateness)).start(_sensors(lines), write, checkpoint, available_now)


def start_controlled_readings(
    lines: DataFrame, write: BatchWriter, checkpoint: str, control: str, seq: str = "seq", size: str = "15 seconds",
    slide: str = "5 seconds", available_now: bool = False,
) -> StreamingQuery:
    """The same where only the readings of the sensor ``control`` move the watermark; ``seq`` is the arrival order."""
    lateness = Lateness(arrival=(seq,), control=F.col("id") == control)
    return _coldest(seq, size, slide, checkpoint, lateness).start(_sensors(lines), write, checkpoint, available_now)


def _coldest(seq: str, size: str, slide: str, checkpoint: str, lateness: Lateness) -> WindowStream:
    record = LeastRecord("temperature", [seq], ["event_time"])
    return WindowStream(record, ["id"], "event_time", size, slide, _tables(checkpoint), lateness=lateness)


def temperature_alarms(lines: DataFrame, seq: str = "seq", horizon: str = "2 seconds") -> DataFrame:
    """Sensors whose temperature did not fall back in time."""
    return alarms.rising_alarms(_sensors(lines), "id", "event_time", "temperature", [seq], horizon)


def start_temperature_alarms(
    lines: DataFrame, write: BatchWriter, checkpoint: str, seq: str = "seq", horizon: str = "2 seconds",
    lateness: str | float = 0, available_now: bool = False,
) -> StreamingQuery:
    """The same on a stream."""
    sensors = _sensors(lines)
    rising = machines.rising_alarms(_tables(checkpoint), "id", "event_time", "temperature", seq, horizon, Lateness(lateness))

    def alarm(rows: DataFrame, batch_id: int) -> None:
        write(machines.alarm_rows(rows, sensors, "id", "event_time"), batch_id)

    return rising.start(sensors, alarm, checkpoint, available_now)


def freeze_warnings(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Readings at or above the freezing limit, and those below it."""
    routed = routing.freeze_route(_sensors(lines))
    return routing.side_output(routed, routing.MAIN), routing.side_output(routed, routing.FREEZE_TAG)


def sensor_strings(lines: DataFrame) -> DataFrame:
    """Readings as ``value STRING`` records, the id as it came; for a text or Kafka sink."""
    sensors = parsing.parse_sensor(lines, trim_id=False)
    return sensors.select(rendering.sensor_text(F.col("id"), F.col("event_time"), F.col("temperature")).alias("value"))


def sensor_documents(lines: DataFrame) -> DataFrame:
    """Readings as ``document STRING``, JSON for the bulk sink."""
    fields = (F.col("id"), F.col("event_time"), F.col("temperature"))
    return parsing.parse_sensor(lines).select(rendering.sensor_document(*fields).alias("document"))


def start_sensor_documents(
    lines: DataFrame, send: documents.Sender, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """The same on a stream, sent in bulk requests, each document stored once."""
    batches = documents.once_batches(F.col("document"), send, _tables(checkpoint))
    return files.start_batches(sensor_documents(lines), batches, checkpoint, "append", available_now)


def login_warnings(logins: DataFrame, seq: str = "seq") -> DataFrame:
    """Two failed logins of a user within two seconds."""
    return patterns.fail_streaks(logins, seq=seq)


def login_pattern_warnings(logins: DataFrame, seq: str = "seq") -> DataFrame:
    """Two failed logins next to each other among all users' rows."""
    return patterns.fail_streaks(logins, seq=seq, keys=[], message=patterns.FAIL_PATTERN_MESSAGE)


def start_login_warnings(
    logins: DataFrame, write: BatchWriter, checkpoint: str, seq: str = "seq", available_now: bool = False,
    keys: list[str] | None = None, message: str = patterns.FAIL_STREAK_MESSAGE, lateness: str | float = 0,
) -> StreamingQuery:
    """The same on a stream; ``keys=[]`` and the other message give the warnings among all users' rows."""
    streaks = stream_patterns.fail_streaks(_tables(checkpoint), seq=seq, keys=keys, lateness=Lateness(lateness))

    def warn(rows: DataFrame, batch_id: int) -> None:
        write(patterns.fail_warnings(rows, "user_id", "event_time", message), batch_id)

    return streaks.start(logins, warn, checkpoint, available_now)


def order_outputs(orders: DataFrame, seq: str = "seq") -> tuple[DataFrame, DataFrame]:
    """Orders paid within 15 minutes, and those that ran out of time."""
    results = patterns.order_results(orders, seq=seq)
    return results.filter(F.col("status") == patterns.MATCHED), results.filter(F.col("status") == patterns.TIMEOUT)


def start_order_outputs(
    orders: DataFrame, paid: BatchWriter, late: BatchWriter, checkpoint: str, seq: str = "seq",
    lateness: str | float = 0, available_now: bool = False,
) -> StreamingQuery:
    """The same on a stream: paid orders to one writer, those out of time to the other."""
    results = stream_patterns.order_results(_tables(checkpoint), seq=seq, lateness=Lateness(lateness))

    def write(rows: DataFrame, batch_id: int) -> None:
        texts = patterns.order_texts(rows, "order_id", "event_time").persist()
        try:
            paid(texts.filter(F.col("status") == patterns.MATCHED), batch_id)
            late(texts.filter(F.col("status") == patterns.TIMEOUT), batch_id)
        finally:
            texts.unpersist()

    return results.start(orders, write, checkpoint, available_now)


def start_word_count(lines: DataFrame, path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Running word counts of a line stream, as text files of updates."""
    return files.start_batches(words.word_count(lines), files.pair_batches(path), checkpoint, "update", available_now)
