"""The operators over the given tables, each with its SQL twin.

``events`` stands in for clicks, logins, orders and sensor readings, with limits
widened to its density; ``documents`` and ``conversations`` are the text.
Times leave as whole numbers of seconds (``_s``) or microseconds (``_us``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import parsing, rendering
from millrace.functions.text import not_empty
from millrace.functions.times import SECOND_US, event_time, event_time_ms, from_us, to_us
from millrace.operators import alarms, lateness, patterns, ranking, routing, sliding, words
from millrace.session import scratch_path
from millrace.sinks import documents, files
from millrace.sinks.fanout import read_tag, tagged_batches
from millrace.sinks.files import parquet_batches, read_batches, start_batches
from millrace.sources import kafka
from millrace.sources.lines import collection, integers, stream_table, table, text_lines
from millrace.plans.aggregates import Accumulator, LeastRecord, Sums, WindowAggregate
from millrace.streaming import machines
from millrace.streaming import patterns as stream_patterns
from millrace.streaming.arrivals import Lateness, start_marked
from millrace.streaming.machines import MachineStream
from millrace.streaming.patterns import PatternStream
from millrace.streaming.windows import WindowStream, row_count
from millrace.streaming.words import RunningCount

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name, with its SQL twin if there is one."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def _seconds(df: DataFrame, *columns: str) -> DataFrame:
    for c in columns:
        df = df.withColumn(c, from_us(to_us(df, c, "us"), T.LongType(), "s")).withColumnRenamed(c, f"{c}_s")
    return df


def _micros(df: DataFrame, *columns: str) -> DataFrame:
    for c in columns:
        df = df.withColumn(c, to_us(df, c, "us")).withColumnRenamed(c, f"{c}_us")
    return df


def _timed(spark: SparkSession, sf: str) -> DataFrame:
    """Events with ``ts`` in microseconds: converted once per event, not once per window."""
    events = table(spark, sf, "events")
    return events.withColumn("ts", to_us(events, "ts"))


# --- words ---------------------------------------------------------------

_WS = r"[ \t\n\x0B\f\r]"


@query(rf"""
WITH lines AS (SELECT text, regexp_replace(text, '{_WS}+$', '') AS body FROM documents),
tokens AS (
  SELECT unnest(CASE WHEN text = '' THEN [''] WHEN body = '' THEN []
                     ELSE string_split_regex(body, '{_WS}') END) AS word
  FROM lines)
SELECT word, count(*) AS cnt FROM tokens GROUP BY word
""")
def word_count(spark: SparkSession, sf: str) -> DataFrame:
    return words.word_count(table(spark, sf, "documents"), "text")


@query("""
WITH tokens AS (
  SELECT conv_id, turn, list, unnest(range(len(list))) AS pos
  FROM (SELECT conv_id, turn, string_split(rtrim(text, ' '), ' ') AS list FROM conversations
        WHERE text = '' OR rtrim(text, ' ') <> ''))
SELECT conv_id, turn, pos, list[pos + 1] AS word,
       count(*) OVER (PARTITION BY list[pos + 1] ORDER BY conv_id, turn, pos
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cnt
FROM tokens
""")
def word_running_count(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "conversations")
    log = words.running_word_count(lines, ["conv_id", "turn"], "text", " ")
    return log.withColumn("pos", F.col("pos").cast("long"))


@query("""
SELECT doc_id, count(*) AS lines
FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
WHERE line <> '' GROUP BY doc_id
""")
def nonempty_lines(spark: SparkSession, sf: str) -> DataFrame:
    full = F.size(F.filter(F.split("text", "\n"), not_empty)).cast("long")
    return table(spark, sf, "documents").select("doc_id", full.alias("lines")).filter("lines > 0")


# --- sliding windows and rankings ----------------------------------------

def _window_rows(slide_s: int, size_s: int, where: str = "TRUE", columns: str = "") -> str:
    """SQL: one row per event and window, ``window_end_s`` in seconds."""
    pane = f"(epoch_us(ts) // {slide_s * SECOND_US}) * {slide_s}"
    ends = f"generate_series({pane} + {slide_s}, {pane} + {size_s}, {slide_s})"
    return f"SELECT user_id, unnest({ends}) AS window_end_s{columns} FROM events WHERE {where}"


def _top3(rows: str) -> str:
    return f"""
SELECT window_end_s, user_id AS item_id, cnt, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY window_end_s ORDER BY cnt DESC, user_id) AS rank
  FROM (SELECT user_id, window_end_s, count(*) AS cnt FROM ({rows}) GROUP BY ALL))
WHERE rank <= 3"""


def _views(spark: SparkSession, sf: str) -> DataFrame:
    return _timed(spark, sf).filter(F.col("event_type") == "view")


def _item_counts(df: DataFrame, best: tuple[int, list[str]] | None = None) -> DataFrame:
    clicks = df.withColumnRenamed("user_id", "item_id")
    return sliding.sliding_count(clicks, ["item_id"], "ts", "60 minutes", "5 minutes", unit="us", best=best)


def _ranking(top: DataFrame) -> DataFrame:
    return _seconds(top, "window_end").withColumn("rank", F.col("rank").cast("long"))


_VIEW_ROWS = _window_rows(300, 3600, "event_type = 'view'")
_VISIT_ROWS = _window_rows(300, 3600)


@query(f"""
SELECT user_id, window_end_s, count(*) AS cnt
FROM ({_window_rows(5, 3600, "event_type = 'view'")}) GROUP BY ALL
""")
def sliding_count_5s(spark: SparkSession, sf: str) -> DataFrame:
    counts = sliding.sliding_count(_views(spark, sf), ["user_id"], "ts", "60 minutes", "5 seconds", unit="us")
    return _seconds(counts, "window_end")


@query(_top3(_VIEW_ROWS))
def hot_items_topn(spark: SparkSession, sf: str) -> DataFrame:
    return _ranking(ranking.top_n(_item_counts(_views(spark, sf)), 3))


@query(_top3(_VISIT_ROWS).replace("item_id", "mid"))
def visit_topn(spark: SparkSession, sf: str) -> DataFrame:
    visits = _timed(spark, sf).withColumnRenamed("user_id", "mid")
    counts = sliding.sliding_count(visits, ["mid"], "ts", "60 minutes", "5 minutes", unit="us", best=(3, ["mid"]))
    return _ranking(ranking.top_n(counts, 3, tie=["mid"]))


_MIN_RECORD = """
SELECT user_id, window_end_s, value, event_id, ts_us FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, window_end_s ORDER BY value, event_id) AS place
  FROM ({rows}))
WHERE place = 1"""
_MIN_ROWS = _window_rows(3600, 21600, columns=", value, event_id, epoch_us(ts) AS ts_us")


@query(_MIN_RECORD.format(rows=_MIN_ROWS))
def sliding_min_record(spark: SparkSession, sf: str) -> DataFrame:
    least = sliding.sliding_min_record(
        _timed(spark, sf), ["user_id"], "ts", "6 hours", "1 hour", "value", ["event_id"], ["event_id", "ts"], unit="us"
    )
    return _micros(_seconds(least, "window_end"), "ts")


@query("""
SELECT user_id, start_s + 1500 AS window_end_s, count(*) AS cnt, CAST(sum(event_id) AS BIGINT) AS id_sum
FROM (SELECT user_id, event_id, epoch_us(ts) // 1000000 AS t,
             unnest(generate_series((epoch_us(ts) // 600000000) * 600 - 1200, (epoch_us(ts) // 600000000) * 600, 600))
               AS start_s
      FROM events)
WHERE t < start_s + 1500
GROUP BY ALL
""")
def sliding_sum_uneven(spark: SparkSession, sf: str) -> DataFrame:
    """A size that is no multiple of the slide: panes are their greatest common divisor."""
    sums = sliding.sliding_sum(
        _timed(spark, sf), ["user_id"], "ts", "25 minutes", "10 minutes", {"id_sum": "event_id"}, unit="us"
    )
    return _seconds(sums, "window_end")


def _mean_and_span() -> Accumulator:
    """A user's aggregate, declared once: the mean id, and a pairwise reduce of the greatest value and the last time."""
    start = F.struct(
        F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("total"), F.lit(None).cast("double").alias("top"),
        F.lit(None).cast("long").alias("last"),
    )

    def fields(n: Column, total: Column, top: Column, last: Column) -> Column:
        return F.struct(n.alias("n"), total.alias("total"), top.alias("top"), last.alias("last"))

    return Accumulator(
        create=start,
        add=lambda a, row: fields(a["n"] + 1, a["total"] + row["event_id"], F.greatest(a["top"], row["value"]), F.greatest(a["last"], row["event_id"])),
        merge=lambda a, b: fields(a["n"] + b["n"], a["total"] + b["total"], F.greatest(a["top"], b["top"]), F.greatest(a["last"], b["last"])),
        result=lambda a: F.struct((a["total"].cast("double") / a["n"]).alias("mean_id"), a["top"].alias("top_value"), a["last"].alias("last_id")),
        columns=["event_id", "value"],
    )


@query(f"""
SELECT user_id, window_end_s, CAST(sum(event_id) AS DOUBLE) / count(*) AS mean_id, max(value) AS top_value, max(event_id) AS last_id
FROM ({_window_rows(3600, 21600, columns=", value, event_id")}) GROUP BY user_id, window_end_s
""")
def sliding_mean_and_span(spark: SparkSession, sf: str) -> DataFrame:
    found = sliding.sliding_accumulated(_timed(spark, sf), _mean_and_span(), ["user_id"], "ts", "6 hours", "1 hour", unit="us")
    return _seconds(found, "window_end").select("user_id", "window_end_s", "result.*")


_REPORT_HEAD = rendering.RULE.strip()


@query(f"""
SELECT window_end_s,
  '{_REPORT_HEAD}' || chr(10) || '{rendering.TIME_LABEL}'
    || strftime(make_timestamp(window_end_s * 1000000), '%Y-%m-%d %H:%M:%S') || '.0' || chr(10)
    || string_agg('No.' || rank || ': {rendering.ITEM_LABEL}' || item_id || '{rendering.VIEWS_LABEL}' || cnt || chr(10),
                  '' ORDER BY rank)
    || '{_REPORT_HEAD}' || chr(10) AS report
FROM ({_top3(_VIEW_ROWS)}) GROUP BY window_end_s
""")
def topn_report(spark: SparkSession, sf: str) -> DataFrame:
    clicks = table(spark, sf, "events").filter(F.col("event_type") == "view").withColumnRenamed("user_id", "item_id")
    counts = sliding.sliding_count(clicks, ["item_id"], "ts", "60 minutes", "5 minutes", best=(3, ["item_id"]))
    return _seconds(rendering.item_report(ranking.top_n(counts, 3)), "window_end")


@query(f"""
SELECT window_end_s,
  '{_REPORT_HEAD}' || chr(10)
    || string_agg('No.' || rank || 'WindowKeyTime(' || window_end_s * 1000 || ',' || item_id || ',' || cnt || ')' || chr(10),
                  '' ORDER BY rank)
    || '{_REPORT_HEAD}' || chr(10) AS report
FROM ({_top3(_VISIT_ROWS)}) GROUP BY window_end_s
""")
def visit_report(spark: SparkSession, sf: str) -> DataFrame:
    top = ranking.top_n(_item_counts(_timed(spark, sf), (3, ["item_id"])), 3)
    return _seconds(rendering.visit_report(top, key="item_id", unit="us"), "window_end")


# --- patterns -------------------------------------------------------------

def _fail_sql(partition: str, hours: float, message: str) -> str:
    return f"""
SELECT user_id, first_time_us, last_fail_time_us, '{message}' AS warning_msg FROM (
  SELECT lag(user_id) OVER w AS user_id, lag(event_type) OVER w AS before, event_type,
         lag(epoch_us(ts)) OVER w AS first_time_us, epoch_us(ts) AS last_fail_time_us
  FROM events WINDOW w AS ({partition} ORDER BY ts, event_id))
WHERE before = 'error' AND event_type = 'error'
  AND last_fail_time_us - first_time_us < {int(hours * 3600 * SECOND_US)}"""


def _errors(spark: SparkSession, sf: str, within: str, keys: list[str], message: str) -> DataFrame:
    found = patterns.fail_streaks(
        table(spark, sf, "events"), "ts", "event_id", fail="error", within=within, keys=keys, message=message
    )
    return _micros(found, "first_time", "last_fail_time")


@query(_fail_sql("PARTITION BY user_id", 4, patterns.FAIL_STREAK_MESSAGE))
def fail_streak_keyed(spark: SparkSession, sf: str) -> DataFrame:
    return _errors(spark, sf, "4 hours", ["user_id"], patterns.FAIL_STREAK_MESSAGE)


@query(_fail_sql("PARTITION BY user_id", 24, patterns.FAIL_PATTERN_MESSAGE))
def fail_next_keyed(spark: SparkSession, sf: str) -> DataFrame:
    return _errors(spark, sf, "24 hours", ["user_id"], patterns.FAIL_PATTERN_MESSAGE)


@query(_fail_sql("", 1 / 60, patterns.FAIL_PATTERN_MESSAGE))
def fail_next_global(spark: SparkSession, sf: str) -> DataFrame:
    return _errors(spark, sf, "60 seconds", [], patterns.FAIL_PATTERN_MESSAGE)


_DAY_US = 86_400 * SECOND_US
_ORDER_SQL = f"""
SELECT user_id, begin_us, begin_id,
       CASE WHEN follow_us - begin_us < {_DAY_US} THEN follow_us END AS follow_us,
       CASE WHEN follow_us - begin_us < {_DAY_US} THEN 'matched' ELSE 'timeout' END AS status,
       begin_us + {_DAY_US} AS deadline_us
FROM (SELECT user_id, event_type, event_id AS begin_id, epoch_us(ts) AS begin_us,
             min(CASE WHEN event_type = 'purchase' THEN epoch_us(ts) END) OVER (
               PARTITION BY user_id ORDER BY ts, event_id
               ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS follow_us
      FROM events)
WHERE event_type = 'signup'"""


def _signups() -> patterns.Pattern:
    begin = patterns.Pattern.begin("begin", F.col("event_type") == "signup")
    return begin.followed_by("follow", F.col("event_type") == "purchase").within("24 hours")


@query(f"SELECT user_id, begin_id, begin_us, follow_us FROM ({_ORDER_SQL}) WHERE status = 'matched'")
def followed_by(spark: SparkSession, sf: str) -> DataFrame:
    found = patterns.match(
        table(spark, sf, "events"), _signups(), ["user_id"], "ts", "event_id", ["event_id", "ts"]
    )
    return _stages(found)


def _stages(found: DataFrame) -> DataFrame:
    stages = found.select(
        "user_id", F.col("begin.event_id").alias("begin_id"), F.col("begin.ts").alias("begin"),
        F.col("follow.ts").alias("follow"),
    )
    return _micros(stages, "begin", "follow")


@query(_ORDER_SQL)
def pattern_timeout(spark: SparkSession, sf: str) -> DataFrame:
    found = patterns.match_or_timeout(
        table(spark, sf, "events"), _signups(), ["user_id"], "ts", "event_id", ["event_id", "ts"]
    )
    stages = found.select(
        "user_id", F.col("begin.event_id").alias("begin_id"), F.col("begin.ts").alias("begin"),
        F.col("follow.ts").alias("follow"), "status", "deadline",
    )
    return _micros(stages, "begin", "follow", "deadline")


@query(f"""
SELECT user_id AS order_id, status,
       CASE WHEN status = 'matched' THEN '{patterns.PAID_MESSAGE}'
            ELSE '{patterns.TIMEOUT_PREFIX}' || CASE
              WHEN deadline_us % 1000000 = 0 THEN strftime(make_timestamp(deadline_us), '%Y-%m-%d %H:%M:%S')
              ELSE rtrim(strftime(make_timestamp(deadline_us), '%Y-%m-%d %H:%M:%S.%f'), '0') END END AS result_msg,
       begin_us AS create_ts_us, follow_us AS pay_ts_us, deadline_us
FROM ({_ORDER_SQL.replace("'signup'", "'click'").replace(str(_DAY_US), str(_DAY_US // 2))})
""")
def order_results(spark: SparkSession, sf: str) -> DataFrame:
    found = patterns.order_results(
        table(spark, sf, "events"), "ts", "event_id", "user_id", create="click", pay="purchase", within="12 hours"
    )
    return _order_rows(found)


def _order_rows(found: DataFrame) -> DataFrame:
    return _micros(found, "create_ts", "pay_ts", "deadline")


_HORIZON_US = 6 * 3600 * SECOND_US
_ALARM_SQL = f"""
WITH RECURSIVE readings AS (
  SELECT user_id, epoch_us(ts) AS us, value AS x,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n
  FROM events),
walk AS (
  SELECT DISTINCT user_id, CAST(0 AS BIGINT) AS n, CAST(0 AS DOUBLE) AS temp,
         CAST(NULL AS BIGINT) AS timer, CAST(NULL AS BIGINT) AS fired
  FROM readings
  UNION ALL
  SELECT user_id, n,
         CASE WHEN x <= temp OR (x > temp AND timer IS NULL) THEN x ELSE temp END,
         CASE WHEN x <= temp THEN NULL WHEN timer IS NULL THEN us + {_HORIZON_US} ELSE timer END,
         fired
  FROM (SELECT r.user_id, r.n, r.us, r.x,
               CASE WHEN w.timer < r.us THEN 0 ELSE w.temp END AS temp,
               CASE WHEN w.timer < r.us THEN NULL ELSE w.timer END AS timer,
               CASE WHEN w.timer < r.us THEN w.timer END AS fired
        FROM walk w JOIN readings r ON r.user_id = w.user_id AND r.n = w.n + 1))
SELECT user_id, fired AS alarm_ts_us, '{alarms.ALARM_PREFIX}' || user_id AS alarm_msg
FROM (SELECT user_id, fired FROM walk WHERE fired IS NOT NULL
      UNION ALL
      SELECT user_id, timer FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC) AS back FROM walk)
      WHERE back = 1 AND timer IS NOT NULL)"""


@query(_ALARM_SQL)
def rising_alarm(spark: SparkSession, sf: str) -> DataFrame:
    found = alarms.rising_alarms(
        table(spark, sf, "events"), "user_id", "ts", "value", ["event_id"], horizon="6 hours"
    )
    return _micros(found, "alarm_ts")


# --- splitting, routing, merging -------------------------------------------

def _tagged(spark: SparkSession, sf: str) -> DataFrame:
    numbers = table(spark, sf, "events").select("event_id", "user_id")
    return routing.split(numbers, routing.parity_tags(F.col("event_id")))


@query(f"""
SELECT event_id, user_id, CASE WHEN event_id % 2 = 0 THEN '{routing.EVEN}' ELSE '{routing.ODD}' END AS tag FROM events
""")
def split_tags(spark: SparkSession, sf: str) -> DataFrame:
    return _tagged(spark, sf).select("event_id", "user_id", F.array_join(routing.TAGS, ",").alias("tag"))


@query("SELECT event_id, user_id FROM events WHERE event_id % 2 <> 0")
def split_select(spark: SparkSession, sf: str) -> DataFrame:
    return routing.select(_tagged(spark, sf), routing.ODD)


@query("SELECT event_id, user_id FROM events")
def split_select_all(spark: SparkSession, sf: str) -> DataFrame:
    return routing.select(_tagged(spark, sf), routing.ODD, routing.EVEN)


@query(f"""
SELECT '{routing.ODD_TEXT}' || event_id AS text FROM events WHERE event_id % 2 <> 0
UNION ALL SELECT '{routing.EVEN_TEXT}' || event_id FROM events WHERE event_id % 2 = 0
""")
def connect_map(spark: SparkSession, sf: str) -> DataFrame:
    def labelled(text: str) -> Callable[[DataFrame], DataFrame]:
        return lambda df: df.select(F.concat(F.lit(text), F.col("event_id").cast("string")).alias("text"))

    tagged = _tagged(spark, sf)
    return routing.connect_map(
        routing.select(tagged, routing.ODD), routing.select(tagged, routing.EVEN),
        labelled(routing.ODD_TEXT), labelled(routing.EVEN_TEXT),
    )


@query("""
SELECT event_id, user_id FROM events WHERE event_id % 2 <> 0 UNION ALL SELECT event_id, user_id FROM events
""")
def union_all(spark: SparkSession, sf: str) -> DataFrame:
    tagged = _tagged(spark, sf)
    return routing.union(routing.select(tagged, routing.ODD), routing.select(tagged, routing.ODD, routing.EVEN))


@query(f"""
SELECT event_id, value, CASE WHEN value < 32.0 THEN '{routing.FREEZE_TAG}' ELSE 'main' END AS tag FROM events
""")
def freeze_route(spark: SparkSession, sf: str) -> DataFrame:
    return routing.freeze_route(table(spark, sf, "events").select("event_id", "value"), "value")


@query("SELECT event_id, value FROM events WHERE value < 32.0")
def freeze_side_output(spark: SparkSession, sf: str) -> DataFrame:
    return routing.side_output(freeze_route(spark, sf), routing.FREEZE_TAG)


# --- text in, text out ------------------------------------------------------

def _lines(spark: SparkSession, sf: str, *fields: Column) -> DataFrame:
    events = table(spark, sf, "events")
    return events.select("event_id", F.concat_ws(",", *[f.cast("string") for f in fields]).alias("value"))


def _event_seconds(spark: SparkSession, sf: str) -> Column:
    return (to_us(table(spark, sf, "events"), "ts") / F.lit(SECOND_US)).cast("long")


def _sensor_lines(spark: SparkSession, sf: str) -> DataFrame:
    padded_id = F.concat(F.lit(" "), F.col("user_id").cast("string"))
    return _lines(spark, sf, padded_id, F.concat(F.lit(" "), _event_seconds(spark, sf).cast("string")), F.col("value"))


@query("""
SELECT event_id, user_id, event_id AS item_id, CAST(user_id % 10 AS INTEGER) AS category_id,
       event_type AS behavior, epoch_us(ts) // 1000000 AS event_time
FROM events
""")
def parse_behavior(spark: SparkSession, sf: str) -> DataFrame:
    lines = _lines(
        spark, sf, F.col("user_id"), F.col("event_id"), F.col("user_id") % 10,
        F.concat(F.lit(" "), "event_type", F.lit(" ")), _event_seconds(spark, sf),
    )
    return parsing.parse_behavior(lines)


@query("""
SELECT event_id, CAST(user_id AS VARCHAR) AS id, epoch_us(ts) // 1000000 AS event_time, value AS temperature FROM events
""")
def parse_sensor(spark: SparkSession, sf: str) -> DataFrame:
    return parsing.parse_sensor(_sensor_lines(spark, sf))


@query("""
SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN CAST(user_id AS VARCHAR) END AS id,
       CASE WHEN event_id % 7 <> 0 THEN epoch_us(ts) // 1000000 END AS event_time,
       CASE WHEN event_id % 7 <> 0 THEN value END AS temperature,
       CASE WHEN event_id % 7 = 0 THEN user_id || ',' || event_type END AS _corrupt
FROM events
""")
def parse_permissive(spark: SparkSession, sf: str) -> DataFrame:
    """Every seventh line lacks a field and is kept as corrupt."""
    events = table(spark, sf, "events")
    line = F.when(F.col("event_id") % 7 == 0, F.concat_ws(",", F.col("user_id").cast("string"), "event_type"))
    good = F.concat_ws(",", F.col("user_id").cast("string"), _event_seconds(spark, sf).cast("string"), F.col("value").cast("string"))
    return parsing.parse_sensor(events.select("event_id", line.otherwise(good).alias("value")), mode="permissive")


@query("""
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS visit_time, ' m' || user_id AS mid,
       CAST(user_id AS VARCHAR) AS uid, ' http://' || event_type AS url
FROM events
""")
def parse_visit(spark: SparkSession, sf: str) -> DataFrame:
    shape = "yyyy-MM-dd HH:mm:ss"
    lines = _lines(
        spark, sf, F.concat(F.lit(" "), F.date_format("ts", shape)),
        F.concat(F.lit(" m"), F.col("user_id").cast("string")), F.col("user_id"),
        F.concat(F.lit(" http://"), "event_type"),
    )
    return parsing.parse_visit(lines).select(
        "event_id", F.date_format("ts", shape).alias("visit_time"), "mid", "uid", "url"
    )


@query(f"""
SELECT event_id, 'Sensor( ' || user_id || ',' || epoch_us(ts) // 1000000 || ',' || value || ')' AS raw_text,
       '{rendering.DESCRIBE_PREFIX}Sensor( ' || user_id || ',' || epoch_us(ts) // 1000000 || ',' || value || ')' AS described
FROM events
""")
def sensor_text(spark: SparkSession, sf: str) -> DataFrame:
    """Records as text, the id with its blank as it came."""
    sensors = parsing.parse_sensor(_sensor_lines(spark, sf), trim_id=False)
    fields = (F.col("id"), F.col("event_time"), F.col("temperature"))
    return sensors.select(
        "event_id", rendering.sensor_text(*fields).alias("raw_text"), rendering.describe_sensor(*fields).alias("described")
    )


@query("""
SELECT event_id, '{"id":"' || user_id || '","timeStamp":"' || epoch_us(ts) // 1000000
       || '","temprature":"' || value || '"}' AS document
FROM events
""")
def document_payload(spark: SparkSession, sf: str) -> DataFrame:
    sensors = parsing.parse_sensor(_sensor_lines(spark, sf))
    fields = (F.col("id"), F.col("event_time"), F.col("temperature"))
    return sensors.select("event_id", rendering.sensor_document(*fields).alias("document"))


@query("""
SELECT CAST(user_id AS VARCHAR) AS id, epoch_us(ts) // 1000000 AS event_time, value AS temperature FROM events
""")
def kafka_sensor_values(spark: SparkSession, sf: str) -> DataFrame:
    """Events wrapped as Kafka records, decoded to lines and parsed."""
    lines = _sensor_lines(spark, sf)
    records = lines.select(
        F.encode(F.col("event_id").cast("string"), "UTF-8").alias("key"),
        F.encode("value", "UTF-8").alias("value"),
        F.lit("sensors").alias("topic"), F.lit(0).alias("partition"), F.col("event_id").alias("offset"),
    )
    return parsing.parse_sensor(kafka.decode_values(records))


# --- out to files and back -----------------------------------------------------------

_LINE_TOKENS = rf"""
SELECT unnest(CASE WHEN line = '' THEN [''] WHEN body = '' THEN [] ELSE string_split_regex(body, '{_WS}') END) AS word
FROM (SELECT line, regexp_replace(line, '{_WS}+$', '') AS body
      FROM (SELECT unnest(string_split_regex(text, '\r\n|\n|\r')) AS line FROM conversations WHERE text <> ''))"""


@query(f"SELECT word, count(*) AS cnt FROM ({_LINE_TOKENS}) GROUP BY word")
def text_files_word_count(spark: SparkSession, sf: str) -> DataFrame:
    """Texts written as lines, counted from the files, written as ``(word,n)`` lines and read again."""
    folder = scratch_path(spark, "text")
    texts = table(spark, sf, "conversations").filter("text <> ''")
    lines = texts.select(F.explode(F.split("text", "\r\n|\n|\r")).alias("line"))
    files.write_text(lines, F.col("line"), f"{folder}/lines")
    files.write_pairs(words.word_count(text_lines(spark, f"{folder}/lines")), f"{folder}/counts")
    pair = r"(?s)^\((.*),(\d+)\)$"
    counts = text_lines(spark, f"{folder}/counts")
    return counts.select(F.regexp_extract("value", pair, 1).alias("word"), F.regexp_extract("value", pair, 2).cast("long").alias("cnt"))


@query("""
SELECT CAST(user_id AS VARCHAR) AS id, CAST(epoch_us(ts) // 1000000 AS VARCHAR) AS time_stamp, CAST(value AS VARCHAR) AS temprature
FROM events
""")
def bulk_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Readings as bulk requests, written, and their documents read back out of the bodies."""
    folder = scratch_path(spark, "bulk")
    sensors = parsing.parse_sensor(_sensor_lines(spark, sf))
    document = rendering.sensor_document(F.col("id"), F.col("event_time"), F.col("temperature"))
    documents.request_bodies(sensors, document, "sensors").write.parquet(folder)
    bodies = spark.read.parquet(folder)
    lines = bodies.select(F.posexplode(F.split(F.rtrim("body", F.lit("\n")), "\n")).alias("at", "line")).filter("at % 2 = 1")
    fields = {"id": "id", "time_stamp": "timeStamp", "temprature": "temprature"}
    return lines.select(*[F.get_json_object("line", f"$.{path}").alias(name) for name, path in fields.items()])


@query("""
SELECT event_id, (epoch_us(ts) // 1000000) * 1000000 AS from_seconds_us, (epoch_us(ts) // 1000) * 1000 AS from_millis_us FROM events
""")
def event_times(spark: SparkSession, sf: str) -> DataFrame:
    """Times sent as numbers of seconds and of milliseconds."""
    numbers = _timed(spark, sf).select(
        "event_id", F.call_function("div", "ts", F.lit(SECOND_US)).alias("s"), F.call_function("div", "ts", F.lit(1000)).alias("ms"))
    times = numbers.select("event_id", event_time("s").alias("from_seconds"), event_time_ms("ms").alias("from_millis"))
    return _micros(times, "from_seconds", "from_millis")


@query(f"""
SELECT window_end_s,
  '{_REPORT_HEAD}' || chr(10)
    || string_agg('No.' || rank || 'WindowKeyTime(' || window_end_s * 1000 || ',m ' || item_id || ',' || cnt || ')' || chr(10),
                  '' ORDER BY rank)
    || '{_REPORT_HEAD}' || chr(10) AS report
FROM ({_top3(_VISIT_ROWS)}) GROUP BY window_end_s
""")
def visit_report_trimmed(spark: SparkSession, sf: str) -> DataFrame:
    """Keys between blanks, tabs and control characters, which the report leaves away at both ends."""
    visits = _timed(spark, sf).withColumn("place", F.format_string("%020d", "user_id")).withColumn(
        "mid", F.concat(F.lit("\x01 \t"), F.lit("m "), F.col("user_id").cast("string"), F.lit(" \x1f\r")))
    counts = sliding.sliding_count(visits, ["mid", "place"], "ts", "60 minutes", "5 minutes", unit="us", best=(3, ["place"]))
    return _seconds(rendering.visit_report(ranking.top_n(counts, 3, tie=["place"]), unit="us"), "window_end")


@query("""
SELECT l.label, n.x AS bucket, count(e.event_id) AS cnt
FROM (VALUES ('view', 'seen'), ('click', 'clicked'), ('signup', 'new')) l(kind, label)
CROSS JOIN (SELECT unnest(range(10)) AS x) n
LEFT JOIN events e ON e.event_type = l.kind AND e.event_id % 10 = n.x
GROUP BY ALL
""")
def labelled_buckets(spark: SparkSession, sf: str) -> DataFrame:
    """Inline rows and numbers as side inputs of a table."""
    kinds = [("view", "seen"), ("click", "clicked"), ("signup", "new")]
    labels = collection(spark, kinds, "kind STRING, label STRING")
    buckets = integers(spark, 0, 9).withColumn("kind", F.explode(F.array(*[F.lit(k) for k, _ in kinds])))
    grid = buckets.join(labels, "kind").select("kind", "label", F.col("x").cast("long").alias("bucket"))
    events = table(spark, sf, "events").groupBy(F.col("event_type").alias("kind"), (F.col("event_id") % 10).alias("bucket"))
    found = grid.join(events.agg(F.count(F.lit(1)).alias("cnt")), ["kind", "bucket"], "left")
    return found.select("label", "bucket", F.coalesce("cnt", F.lit(0)).alias("cnt"))


# --- late data ----------------------------------------------------------------

# Arrival: event time plus up to two hours, so rows overtake each other.
_DELAY_S = 7_200
_ARRIVAL_SQL = f"epoch_us(ts) + ((event_id * 7919) % {_DELAY_S}) * {SECOND_US}"


def _arrivals(spark: SparkSession, sf: str) -> DataFrame:
    delay = (F.col("event_id") * 7919) % _DELAY_S
    return _timed(spark, sf).withColumn("arrival_us", F.col("ts") + delay * F.lit(SECOND_US))


def _marked_sql(seen: str) -> str:
    return f"""
SELECT user_id, event_id, value, epoch_us(ts) AS us, max({seen}) OVER (
         ORDER BY {_ARRIVAL_SQL}, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS watermark_us
FROM events"""


def _kept_sql(seen: str) -> str:
    """SQL: one row per event and window (2 hours by 30 minutes) that its watermark has not closed."""
    pane = "(us // 1800000000) * 1800"
    return f"""
SELECT * FROM (
  SELECT *, unnest(generate_series({pane} + 1800, {pane} + 7200, 1800)) AS window_end_s FROM ({_marked_sql(seen)}))
WHERE watermark_us IS NULL OR window_end_s * 1000000 - 1000 > watermark_us"""


_BOUNDED_SQL = f"epoch_us(ts) - {600 * SECOND_US}"
_CONTROL_SQL = "CASE WHEN event_type = 'signup' AND user_id % 15 = 0 THEN epoch_us(ts) END"


@query(f"""
SELECT user_id, window_end_s, count(*) AS cnt FROM ({_kept_sql(_BOUNDED_SQL)}) GROUP BY ALL
""")
def drop_late(spark: SparkSession, sf: str) -> DataFrame:
    marked = lateness.bounded_watermark(_arrivals(spark, sf), ["arrival_us", "event_id"], "ts", "10 minutes", "us")
    counts = sliding.sliding_count(marked, ["user_id"], "ts", "2 hours", "30 minutes", lateness.WATERMARK, "us")
    return _seconds(counts, "window_end")


@query(f"""
SELECT event_id, user_id, us AS ts_us, watermark_us FROM ({_marked_sql("epoch_us(ts) - 1000")})
WHERE (us // 1800000000) * 1800000000 + 1800000000 - 1000 <= watermark_us
""")
def late_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Rows too late for their only window of 30 minutes, if the source is taken to be in order."""
    marked = lateness.ascending_watermark(_arrivals(spark, sf), ["arrival_us", "event_id"], "ts", "us")
    late = lateness.late_rows(marked, "ts", "30 minutes", "30 minutes", "us")
    return _micros(late.select("event_id", "user_id", "ts", lateness.WATERMARK), "ts")


@query(f"""
SELECT user_id, window_end_s, value, event_id, ts_us FROM (
  SELECT *, us AS ts_us, row_number() OVER (PARTITION BY user_id, window_end_s ORDER BY value, event_id) AS place
  FROM ({_kept_sql(_CONTROL_SQL)}))
WHERE place = 1
""")
def punctuated_late(spark: SparkSession, sf: str) -> DataFrame:
    """Least records per window, with a watermark moved by some signups only."""
    control = (F.col("event_type") == "signup") & (F.col("user_id") % 15 == 0)
    marked = lateness.punctuated_watermark(_arrivals(spark, sf), ["arrival_us", "event_id"], "ts", control, "us")
    least = sliding.sliding_min_record(
        marked, ["user_id"], "ts", "2 hours", "30 minutes", "value", ["event_id"], ["event_id", "ts"],
        lateness.WATERMARK, "us",
    )
    return _micros(_seconds(least, "window_end"), "ts")


# --- the same on streams ---------------------------------------------------------
#
# The whole table is read as a finite file stream, some files per micro-batch. What the
# operators still hold at the end is settled by the end itself. Results go to the shared
# folder and are read back, so they meet the SQL twins of the batch forms.

_FILES_PER_BATCH = 16


def _stream(spark: SparkSession, sf: str, name: str = "events") -> DataFrame:
    return stream_table(spark, sf, name, _FILES_PER_BATCH)


def _finished(stream: DataFrame, label: str, mode: str = "append") -> DataFrame:
    """All rows a stream gives."""
    spark = stream.sparkSession
    out, state = scratch_path(spark, label), scratch_path(spark, f"{label}-state")
    start_batches(stream, parquet_batches(out), state, mode).awaitTermination()
    return read_batches(spark, out, stream.schema)


def _settled(
    stream: DataFrame, label: str, operator: Callable[[str], PatternStream | WindowStream | MachineStream],
    through: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> DataFrame:
    """The results of an operator over a finite stream, written ``through`` a last step per micro-batch."""
    spark = stream.sparkSession
    folder = scratch_path(spark, label)
    running = operator(f"{folder}/state")
    write = parquet_batches(f"{folder}/out")
    running.start(stream, lambda rows, batch: write(through(rows), batch), f"{folder}/checkpoint").awaitTermination()
    rest = through(running.rest(stream))
    return read_batches(spark, f"{folder}/out", rest.schema).unionByName(rest)


@query(ORACLES["word_count"])
def stream_word_count(spark: SparkSession, sf: str) -> DataFrame:
    """Updates of a running count; the last update of a word is the greatest."""
    counts = words.word_count(_stream(spark, sf, "documents"), "text")
    updates = _finished(counts, "word-count", "update")
    return updates.groupBy("word").agg(F.max("cnt").alias("cnt"))


@query(ORACLES["word_running_count"])
def stream_word_running_count(spark: SparkSession, sf: str) -> DataFrame:
    """The log of updates itself: counts go on from micro-batch to micro-batch."""
    lines = _stream(spark, sf, "conversations")
    folder = scratch_path(spark, "running-count")
    running = RunningCount(["conv_id", "turn"], "text", " ", f"{folder}/state")
    running.start(lines, parquet_batches(f"{folder}/out"), f"{folder}/checkpoint").awaitTermination()
    log = read_batches(spark, f"{folder}/out", running.schema(lines))
    return log.withColumn("pos", F.col("pos").cast("long"))


def _windows_of(aggregate: WindowAggregate, keys: list[str], size: str, slide: str, **options) -> Callable[[str], WindowStream]:
    return lambda path: WindowStream(aggregate, keys, "ts", size, slide, path, **options)


@query(ORACLES["sliding_count_5s"])
def stream_sliding_count_5s(spark: SparkSession, sf: str) -> DataFrame:
    """720 windows per row."""
    views = F.col("event_type") == "view"
    counts = _windows_of(row_count(), ["user_id"], "60 minutes", "5 seconds", where=views)
    return _seconds(_settled(_stream(spark, sf), "sliding-count", counts), "window_end")


@query(ORACLES["hot_items_topn"])
def stream_hot_items_topn(spark: SparkSession, sf: str) -> DataFrame:
    clicks = _stream(spark, sf).withColumnRenamed("user_id", "item_id")
    views = F.col("event_type") == "view"
    counts = _windows_of(row_count(), ["item_id"], "60 minutes", "5 minutes", where=views)
    return _ranking(_settled(clicks, "hot-items", counts, lambda rows: ranking.top_n(rows, 3)))


@query(ORACLES["sliding_min_record"])
def stream_sliding_min_record(spark: SparkSession, sf: str) -> DataFrame:
    record = LeastRecord("value", ["event_id"], ["event_id", "ts"])
    least = _settled(_stream(spark, sf), "min-record", _windows_of(record, ["user_id"], "6 hours", "1 hour"))
    return _micros(_seconds(least, "window_end"), "ts")


@query(ORACLES["sliding_sum_uneven"])
def stream_sliding_sum_uneven(spark: SparkSession, sf: str) -> DataFrame:
    sums = Sums({"cnt": F.count(F.lit(1)), "id_sum": F.coalesce(F.sum("event_id"), F.lit(0))})
    return _seconds(_settled(_stream(spark, sf), "sums", _windows_of(sums, ["user_id"], "25 minutes", "10 minutes")), "window_end")


@query(ORACLES["sliding_mean_and_span"])
def stream_sliding_mean_and_span(spark: SparkSession, sf: str) -> DataFrame:
    found = _settled(_stream(spark, sf), "mean", _windows_of(_mean_and_span(), ["user_id"], "6 hours", "1 hour"))
    return _seconds(found, "window_end").select("user_id", "window_end_s", "result.*")


@query(ORACLES["fail_streak_keyed"])
def stream_fail_streak(spark: SparkSession, sf: str) -> DataFrame:
    return _stream_errors(spark, sf, "4 hours", ["user_id"], patterns.FAIL_STREAK_MESSAGE)


@query(ORACLES["fail_next_global"])
def stream_fail_next_global(spark: SparkSession, sf: str) -> DataFrame:
    return _stream_errors(spark, sf, "60 seconds", [], patterns.FAIL_PATTERN_MESSAGE)


def _stream_errors(spark: SparkSession, sf: str, within: str, keys: list[str], message: str) -> DataFrame:
    def streaks(path: str) -> PatternStream:
        return stream_patterns.fail_streaks(path, "ts", "event_id", fail="error", within=within, keys=keys)

    found = _settled(_stream(spark, sf), "fail", streaks, lambda rows: patterns.fail_warnings(rows, "user_id", "ts", message))
    return _micros(found, "first_time", "last_fail_time")


@query(ORACLES["order_results"])
def stream_order_results(spark: SparkSession, sf: str) -> DataFrame:
    def orders(path: str) -> PatternStream:
        return stream_patterns.order_results(path, "ts", "event_id", "user_id", create="click", pay="purchase", within="12 hours")

    found = _settled(_stream(spark, sf), "orders", orders, lambda rows: patterns.order_texts(rows, "user_id", "ts"))
    return _order_rows(found)


@query(ORACLES["followed_by"])
def stream_followed_by(spark: SparkSession, sf: str) -> DataFrame:
    """Any pattern: stages come out as structs, as in a table."""
    def signups(path: str) -> PatternStream:
        return PatternStream(_signups(), ["user_id"], "ts", "event_id", ["event_id", "ts"], path)

    return _stages(_settled(_stream(spark, sf), "followed-by", signups))


@query(ORACLES["rising_alarm"])
def stream_rising_alarm(spark: SparkSession, sf: str) -> DataFrame:
    events = _stream(spark, sf)

    def rising(path: str) -> MachineStream:
        return machines.rising_alarms(path, "user_id", "ts", "value", "event_id", "6 hours")

    found = _settled(events, "alarms", rising, lambda rows: machines.alarm_rows(rows, events, "user_id", "ts"))
    return _micros(found, "alarm_ts")


def _stream_arrivals(spark: SparkSession, sf: str) -> DataFrame:
    """The arrival order is a column, so rows of a micro-batch are late as in the table."""
    events = _stream(spark, sf)
    delay = (F.col("event_id") * 7919) % _DELAY_S
    return events.withColumn("arrival_us", to_us(events, "ts") + delay * F.lit(SECOND_US))


_ARRIVAL = ("arrival_us", "event_id")


@query(ORACLES["punctuated_late"])
def stream_punctuated_late(spark: SparkSession, sf: str) -> DataFrame:
    control = (F.col("event_type") == "signup") & (F.col("user_id") % 15 == 0)
    record = LeastRecord("value", ["event_id"], ["event_id", "ts"])
    least = _settled(_stream_arrivals(spark, sf), "punctuated", _windows_of(
        record, ["user_id"], "2 hours", "30 minutes", lateness=Lateness(arrival=_ARRIVAL, control=control)))
    return _micros(_seconds(least, "window_end"), "ts")


@query(ORACLES["drop_late"])
def stream_drop_late(spark: SparkSession, sf: str) -> DataFrame:
    counts = _settled(_stream_arrivals(spark, sf), "drop-late", _windows_of(
        row_count(), ["user_id"], "2 hours", "30 minutes", lateness=Lateness("10 minutes", _ARRIVAL)))
    return _seconds(counts, "window_end")


@query(ORACLES["late_rows"])
def stream_late_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The late rows of a stream as an output of their own."""
    arrivals, folder = _stream_arrivals(spark, sf), scratch_path(spark, "late-rows")
    write = parquet_batches(f"{folder}/out")

    def late(rows: DataFrame) -> DataFrame:
        return lateness.late_rows(rows, "ts", "30 minutes", "30 minutes").select("event_id", "user_id", "ts", lateness.WATERMARK)

    start_marked(
        arrivals, lambda rows, batch: write(late(rows), batch), f"{folder}/state", f"{folder}/checkpoint", "ts",
        Lateness(arrival=_ARRIVAL),
    ).awaitTermination()
    schema = late(arrivals.withColumn(lateness.WATERMARK, F.lit(0).cast("long"))).schema
    return _micros(read_batches(spark, f"{folder}/out", schema), "ts")


@query(ORACLES["freeze_side_output"])
def stream_freeze_side_output(spark: SparkSession, sf: str) -> DataFrame:
    """A routed stream written once, by tag; the freeze tag's rows are returned."""
    readings = _stream(spark, sf).select("event_id", "value")
    folder = scratch_path(spark, "freeze")
    start_batches(
        routing.freeze_route(readings, "value"), tagged_batches(f"{folder}/out"), f"{folder}/checkpoint"
    ).awaitTermination()
    return read_tag(spark, f"{folder}/out", routing.FREEZE_TAG, readings.schema)
