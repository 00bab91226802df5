"""Conversations as training windows of a token budget, native.

A turn is written ``<s>[INST]role[/INST]text</s>``. Control strings inside roles and texts
get a backslash after their first character, one more than they already have there, so
nothing but a mark looks like one and reading back takes one away again.

Windows come from prefix sums of turn tokens. Let C be the budget less the system turn and
the history, and w = C / 2. A turn lies in slot (start div w). A slot's window takes the
turns inside it and the one that reaches into it, if that has at most w tokens: together at
most C. A longer turn has a window to itself. So a turn's window follows from its own prefix
sum: no walk along the conversation, and one very long conversation is spread over all
tasks. Each window repeats the system turn and the last turns before it, as far as they
start at most ``history`` tokens before the window does; what is repeated bears no loss.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.plans.ordered import ordered_scan

BUDGET, HISTORY = 1024, 256
# A token is reckoned as four code points; every turn has four tokens of marks.
CODE_POINTS, MARKS = 4, 4
# History is not carried across blocks of so many slots, which keeps the look ahead parallel.
BLOCK_SLOTS = 4096

_HEAD, _SAYS, _END = "<s>[INST]", "[/INST]", "</s>"
_CONTROL = r"/?s>|/?INST\]"
_SYSTEM, _TARGET = "system", "assistant"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*)({_CONTROL})", r"$1$2\\$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*)\\({_CONTROL})", "$1$2$3")


def turn_tokens(text: Column) -> Column:
    """The tokens a turn is reckoned at."""
    return F.ceil(F.length(text) / CODE_POINTS).cast("long") + MARKS


def _sums(turns: DataFrame, rows_per_group: int | None) -> DataFrame:
    """Adds ``sums``: ``before`` (tokens of the turns before; NULL for the first) and ``lead`` (tokens of a leading system turn)."""
    leading = F.when(F.col("role") == _SYSTEM, F.col("tokens")).otherwise(F.lit(0))
    order = ["turn", "role", "text"]

    def both(before: Column, lead: Column) -> Column:
        return F.struct(before.alias("before"), lead.alias("lead"))

    def merge(here: Column, gone: Column) -> Column:
        begun = here["before"].isNotNull() | gone["before"].isNotNull()
        total = F.coalesce(here["before"], F.lit(0)) + F.coalesce(gone["before"], F.lit(0))
        return both(F.when(begun, total), F.coalesce(gone["lead"], here["lead"]))

    past = (Window.unboundedPreceding, -1)
    return ordered_scan(
        turns, ["conv_id"], order, "sums",
        local=lambda w: both(F.sum("tokens").over(w.rowsBetween(*past)), F.first(leading).over(w.rowsBetween(Window.unboundedPreceding, 0))),
        summary=both(F.sum("tokens"), F.min_by(leading, F.struct(*order))),
        carry=lambda s, w: F.when(F.row_number().over(w) > 1, both(F.sum(s["before"]).over(w.rowsBetween(*past)), F.first(s["lead"]).over(w.rowsBetween(*past)))),
        merge=merge,
        rows_per_group=rows_per_group,
    )


def _placed(turns: DataFrame, budget: int, history: int, rows_per_group: int | None) -> DataFrame:
    """Adds ``start`` (-1 for a leading system turn), ``window`` and ``block``."""
    summed = _sums(turns.withColumn("tokens", turn_tokens(F.col("text"))), rows_per_group)
    first, lead = F.col("sums.before").isNull(), F.col("sums.lead")
    system = first & (F.col("role") == _SYSTEM)
    start = F.when(system, F.lit(-1)).otherwise(F.coalesce("sums.before", F.lit(0)) - F.when(first, F.lit(0)).otherwise(lead))
    # A system turn that leaves less than a quarter of the budget leaves that quarter all the same.
    room = F.greatest(F.lit(budget - history) - lead, F.lit(budget // 4))
    with_start = summed.select("conv_id", "role", "text", "tokens", start.alias("start"), F.floor(room / 2).alias("wide"))
    slot = F.call_function("div", F.col("start"), F.col("wide"))
    last = F.call_function("div", F.col("start") + F.col("tokens") - 1, F.col("wide"))
    window = F.when(F.col("start") < 0, F.lit(1)).when(F.col("tokens") > F.col("wide"), 2 * slot + 2).otherwise(2 * last + 1)
    placed = with_start.withColumn("window", window.cast("long"))
    return placed.withColumn("block", F.call_function("div", F.col("window"), F.lit(2 * BLOCK_SLOTS)))


def windows(
    conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY, rows_per_group: int | None = None
) -> DataFrame:
    """(conv_id, window, text, n_turns, n_repeated, n_tokens, loss) of ``conversations`` (conv_id, turn, role, text).

    Turns are taken by (turn, role, text), NULL turns first; NULL roles and texts are empty,
    rows with a NULL ``conv_id`` form one conversation, repeated rows are turns of their own,
    other columns are not read, an empty table gives no windows. ``window`` grows along a
    conversation, with gaps. The first ``n_repeated`` turns of a window are repeated. ``loss``
    lists (start, end) in code points of ``text``, end exclusive: the assistant texts that
    stand here for the first time. A leading system turn opens window 1 and is repeated in
    all others; window 1 holds nothing else if the next turn needs a window to itself. No
    window is over ``budget`` tokens unless one turn of it alone is, or the system turn leaves
    less than a quarter of the budget.
    """
    if not 0 <= history <= budget // 2 or budget < 8 * MARKS:
        raise ValueError("history must not take more than half of the budget")
    blank = F.lit("")
    turns = conversations.select(
        "conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text")
    )
    placed = _placed(turns, budget, history, rows_per_group)
    along = Window.partitionBy("conv_id", "block").orderBy("start")
    before = F.lag("window").over(along)
    opening = F.when(before.isNull() | (before != F.col("window")), F.col("window"))
    marked = placed.withColumn("opening", F.when(F.col("start") >= 0, opening))
    ahead = marked.withColumn("ahead", F.collect_list("opening").over(along.rangeBetween(1, history)))
    later = F.filter("ahead", lambda w: (F.col("start") >= 0) & (w > F.col("window")))
    head = F.concat(F.lit(_HEAD), escaped(F.col("role")), F.lit(_SAYS))
    copies = ahead.select(
        "conv_id", "start", "tokens", head.alias("head"), escaped(F.col("text")).alias("body"),
        (F.col("role") == _TARGET).alias("target"), F.col("window").alias("own"),
        F.explode(F.concat(F.array("window"), later)).alias("window"),
    ).withColumn("repeated", F.col("window") != F.col("own"))
    members = copies.select(
        F.struct("conv_id").alias("key"), "window", "tokens",
        F.struct("start", "head", "body", "target", "repeated").alias("turn"),
    )
    grouped = members.groupBy("key", "window").agg(F.sort_array(F.collect_list("turn")).alias("turns"), F.sum("tokens").alias("tokens"))

    # The system turn, at most one row per conversation, goes to every window but its own.
    lead = F.struct("start", head.alias("head"), escaped(F.col("text")).alias("body"), F.lit(False).alias("target"), F.lit(True).alias("repeated"))
    systems = placed.filter("start < 0").select(
        F.struct("conv_id").alias("key"), F.col("tokens").alias("lead_tokens"), lead.alias("lead")
    )
    joined = grouped.join(systems, "key", "left")
    repeat = F.col("lead").isNotNull() & (F.col("window") > 1)
    turns_of = F.when(repeat, F.concat(F.array("lead"), "turns")).otherwise(F.col("turns"))
    tokens = F.col("tokens") + F.when(repeat, F.col("lead_tokens")).otherwise(F.lit(0))
    return _written(joined.select("key.conv_id", "window", turns_of.alias("turns"), tokens.alias("n_tokens")))


def _written(windows: DataFrame) -> DataFrame:
    """The text of each window and the spans of its loss."""
    text = F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(_END))), "")
    nothing = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start: int, end: int>>").alias("spans"))

    def step(done: Column, t: Column) -> Column:
        start = done["at"] + F.length(t["head"])
        end = start + F.length(t["body"])
        bears = t["target"] & ~t["repeated"]
        spans = F.when(bears, F.concat(done["spans"], F.array(F.struct(start.alias("start"), end.alias("end"))))).otherwise(done["spans"])
        return F.struct((end + len(_END)).alias("at"), spans.alias("spans"))

    return windows.select(
        "conv_id", "window", text.alias("text"), F.size("turns").cast("long").alias("n_turns"),
        F.size(F.filter("turns", lambda t: t["repeated"])).cast("long").alias("n_repeated"), "n_tokens",
        F.aggregate("turns", nothing, step)["spans"].alias("loss"),
    )


def read_turns() -> Column:
    """Of a window: the turns that stand there for the first time, as (role, text)."""
    first, count = F.col("n_repeated").cast("int") + 1, (F.col("n_turns") - F.col("n_repeated")).cast("int")
    pieces = F.slice(F.split("text", _END, -1), first, count)

    def read(piece: Column) -> Column:
        says = F.split(piece, r"\[/INST\]", 2)
        role = F.substring(says[0], F.lit(len(_HEAD) + 1), F.length(says[0]))
        return F.struct(unescaped(role).alias("role"), unescaped(says[1]).alias("text"))

    return F.transform(pieces, read)


def read_targets() -> Column:
    """Of a window: the texts under the loss mask, as they were before escaping."""
    return F.transform("loss", lambda s: unescaped(F.substring(F.col("text"), s["start"] + 1, s["end"] - s["start"])))


def digests(formatted: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), read back from windows.

    A digest is that of all texts of a conversation in one string; only for these the texts
    of a conversation are put together in one row.
    """
    turns = read_turns()
    lines = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    part = F.struct("window", lines.alias("lines"), F.array_join(read_targets(), "").alias("targets"))
    parts = formatted.select(
        F.struct("conv_id").alias("key"), part.alias("part"), F.size(turns).alias("turns"), F.length("text").alias("chars")
    )
    whole = parts.groupBy("key").agg(
        F.sort_array(F.collect_list("part")).alias("parts"), F.sum("turns").cast("long").alias("n_turns"),
        F.sum("chars").cast("long").alias("formatted_chars"),
    )
    said, targets = F.array_join("parts.lines", ""), F.array_join("parts.targets", "")
    return whole.select(
        "key.conv_id", "n_turns", F.sha2(said, 256).alias("turns_sha256"), F.length(targets).cast("long").alias("loss_chars"),
        F.sha2(targets, 256).alias("loss_sha256"), "formatted_chars",
    )


def with_control_texts(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """``conversations`` and conversation -1, both turns of which consist of control strings."""
    said = f"{_END}[INST] ok {_SAYS}"
    schema = "conv_id long, turn long, role string, text string"
    probe = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], schema)
    return conversations.select("conv_id", "turn", "role", "text").unionByName(probe)
