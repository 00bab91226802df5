"""Any :class:`Pattern` on a stream, matched by the operators for tables.

Each micro-batch is put together with the rows held from before, matched natively, and only
what the watermark has settled comes out: a match when its second row is settled, a timeout
when the deadline is. Held is what can still matter: rows that are not settled, and behind
them first-stage rows still waiting (relaxed), or the last settled row of each key if it is a
first-stage row (strict). With a time limit these are no older than the watermark less the
limit, so the table does not grow with the stream. Frequent keys, and patterns without keys,
are cut by the ordered scans as in a table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators import patterns
from millrace.operators.lateness import WATERMARK
from millrace.operators.patterns import MATCHED, Pattern
from millrace.sinks.files import start_batches
from millrace.streaming.arrivals import US, Lateness
from millrace.streaming.store import BatchMark, BatchTable

FIRST, SECOND = "__first", "__second"

Writer = Callable[[DataFrame, int], None]


@dataclass(frozen=True)
class PatternStream:
    """A pattern over a stream; ``path`` is the folder of what it holds.

    Results are those of ``patterns.match`` or, with ``outcomes``, ``match_or_timeout``:
    keys and one struct of ``columns`` per stage. Rows that come later than ``lateness``
    allows are left out, as are rows without a time.
    """

    pattern: Pattern
    keys: Sequence[str]
    ts: str
    seq: str
    columns: Sequence[str]
    path: str
    outcomes: bool = False
    lateness: Lateness = field(default_factory=Lateness)
    unit: str = "s"
    rows_per_group: int | None = None

    def start(self, stream: DataFrame, write: Writer, checkpoint: str, available_now: bool = True) -> StreamingQuery:
        """Runs ``write(results, batch id)`` for every micro-batch."""
        if self.outcomes and (self.pattern.strict or self.pattern.limit is None):
            raise ValueError("timeouts need followed_by and within")
        held, mark = self._tables(stream)

        def step(rows: DataFrame, batch_id: int) -> None:
            spark = rows.sparkSession
            before = mark.before(spark, batch_id)
            marked = self.lateness.marked(rows, self.ts, before, self.unit).persist()
            reached = self.lateness.reached(marked, before)
            both = held.before(spark, batch_id).unionByName(self._fresh(marked)).persist()
            found = self._matched(both).persist()
            try:
                write(self._results(found, reached, before), batch_id)
                held.put(self._keep(both, found, reached), batch_id)
                mark.put(spark, reached, batch_id)
            finally:
                for frame in (found, both, marked):
                    frame.unpersist()

        return start_batches(stream, step, checkpoint, available_now=available_now)

    def rest(self, stream: DataFrame) -> DataFrame:
        """What the end of the stream settles: the results of the rows held after the last batch."""
        spark, (held, mark) = stream.sparkSession, self._tables(stream)
        last = held.last(spark)
        rows = held.before(spark, 0) if last is None else held.of(spark, last)
        return self._results(self._matched(rows), None, mark.last(spark), end=True)

    def _tables(self, stream: DataFrame) -> tuple[BatchTable, BatchMark]:
        # The schema of what is held follows from the stream's, without reading it.
        plain = stream.select(*self._needed(stream), F.lit(0).cast("long").alias(US))
        flagged = plain.withColumns({FIRST: F.lit(True), SECOND: F.lit(True)})
        return BatchTable(f"{self.path}/held", flagged.schema), BatchMark(f"{self.path}/reached")

    def _needed(self, df: DataFrame) -> list[str]:
        return list(dict.fromkeys([*self.keys, self.ts, self.seq, *self.columns]))

    def _fresh(self, marked: DataFrame) -> DataFrame:
        """The rows in time, with the stages they may be."""
        first, second = (F.coalesce(w, F.lit(False)) for w in (self.pattern.first_where, self.pattern.second_where))
        in_time = F.col(WATERMARK).isNull() | (F.col(US) > F.col(WATERMARK))
        rows = marked.filter(in_time).withColumns({FIRST: first, SECOND: second})
        # In a strict pattern any row comes between two others.
        rows = rows if self.pattern.strict else rows.filter(F.col(FIRST) | F.col(SECOND))
        return rows.select(*self._needed(marked), US, FIRST, SECOND)

    def _matched(self, rows: DataFrame) -> DataFrame:
        flagged = replace(self.pattern, first_where=F.col(FIRST), second_where=F.col(SECOND))
        whole = [c for c in rows.columns]
        if self.pattern.strict:
            return patterns.match(rows, flagged, self.keys, self.ts, self.seq, whole, self.unit, self.rows_per_group)
        limited = flagged if flagged.limit is not None else replace(flagged, limit=_FOREVER)
        return patterns.match_or_timeout(rows, limited, self.keys, self.ts, self.seq, whole, self.unit, self.rows_per_group)

    def _settled(self, reached: int | None) -> Column:
        """Of results: whether the watermark has settled them."""
        if reached is None:
            return F.lit(False)
        matched = F.col(f"{self.pattern.second}.{US}") <= F.lit(reached)
        if self.pattern.strict:
            return matched
        over = F.col(f"{self.pattern.first}.{US}") + F.lit(self.pattern.limit or _FOREVER) - 1 <= F.lit(reached)
        return F.when(F.col("status") == MATCHED, matched).otherwise(over)

    def _results(self, found: DataFrame, reached: int | None, before: int | None, end: bool = False) -> DataFrame:
        rows = found if end else found.filter(self._settled(reached))
        if self.pattern.strict and before is not None:
            rows = rows.filter(F.col(f"{self.pattern.second}.{US}") > F.lit(before))
        if not self.pattern.strict and not self.outcomes:
            rows = rows.filter(F.col("status") == MATCHED)
        stages = [
            F.when(F.col(name).isNotNull(), F.struct(*[F.col(f"{name}.{c}").alias(c) for c in self.columns])).alias(name)
            for name in (self.pattern.first, self.pattern.second)
        ]
        return rows.select(*self.keys, *stages, *(["status", "deadline"] if self.outcomes else []))

    def _keep(self, both: DataFrame, found: DataFrame, reached: int | None) -> DataFrame:
        if reached is None:
            return both
        unsettled = both.filter(F.col(US) > F.lit(reached))
        if self.pattern.strict:
            settled = both.filter(F.col(US) <= F.lit(reached))
            last = settled.groupBy(*self.keys).agg(
                F.max_by(F.struct(*both.columns), F.struct(US, self.seq)).alias("row")
            ).select("row.*").filter(FIRST)
            if self.pattern.limit is not None:
                last = last.filter(F.col(US) > F.lit(reached - self.pattern.limit))
            return unsettled.unionByName(last)
        first = self.pattern.first
        waiting = found.filter(~self._settled(reached)).select(f"{first}.*").filter(F.col(US) <= F.lit(reached))
        return unsettled.unionByName(waiting)


# Ten thousand years: a pattern without a limit.
_FOREVER = 10_000 * 366 * 86_400 * 1_000_000


def fail_streaks(
    path: str, ts: str = "event_time", seq: str = "seq", user: str = "user_id", event: str = "event_type",
    fail: str = "fail", within: str = "2 seconds", keys: Sequence[str] | None = None,
    lateness: Lateness = Lateness(), unit: str = "s",
) -> PatternStream:
    """Two failures in a row; write its results through :func:`patterns.fail_warnings`."""
    keys = [user] if keys is None else list(keys)
    pattern = patterns.fail_pattern(event, fail, within)
    return PatternStream(pattern, keys, ts, seq, [user, ts], path, lateness=lateness, unit=unit)


def order_results(
    path: str, ts: str = "event_time", seq: str = "seq", order_id: str = "order_id", event: str = "event_type",
    create: str = "create", pay: str = "pay", within: str = "15 minutes", lateness: Lateness = Lateness(), unit: str = "s",
) -> PatternStream:
    """Orders paid or out of time; write its results through :func:`patterns.order_texts`."""
    pattern = patterns.order_pattern(event, create, pay, within)
    return PatternStream(pattern, [order_id], ts, seq, [ts], path, outcomes=True, lateness=lateness, unit=unit)
