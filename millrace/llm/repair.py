"""Repair of the turn structure of conversations, with the cheapest edits and an audit of them.

A conversation is to be empty or an optional system turn and then user and assistant turns in
turn. Edits: Keep, Rerole to user or assistant, Delete, Insert an empty turn. The audit is the
string of their initials; of equally cheap audits the least one counts.

The search runs over four states (nothing yet, after system, user, assistant). What leads to
a state is a node of a persistent tree that shares its beginning with others: a node has a
parent, the rolling hash of its path and ancestors at distances 1, 2, 4, ... Two equally cheap
paths are compared by a search for their longest common prefix over these ancestors, and the
prefix found by hash is verified symbol by symbol, once for every pair of paths.

A conversation is cut into chunks of ``CHUNK`` rows. Every chunk is searched by itself from
each state it may be entered in; the chunks of a conversation are then put together by the
same search, with the audits of chunks as symbols. Least (cost, audit) pairs compose, as no
audit of the same rows and cost is the beginning of another: both have all the rows' initials,
and each further Insert costs. Tasks read sorted rows one after the other and hold one
chunk's edits, or one conversation's audits, never its texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import map_batches
from millrace.plans.ordered import row_numbers
from millrace.session import reliable_checkpoint

CHUNK = 20_000
# Costs of the edits; ``UNFINISHED`` is added for every truncated turn that stays.
REROLE, DELETE, INSERT, UNFINISHED = 1, 2, 5, 5
CLEAN, BLANK, DUPLICATE, TRUNCATED = range(4)
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
_NEXT_IS_USER = (NOTHING, SYSTEM, ASSISTANT)
_LEGAL = ("su", "ua", "au")
_SPACE = " \t\n\x0b\f\r"
_EMPTY = hashlib.sha256(b"").hexdigest()

Path = tuple[int, int]


class AuditTree:
    """Strings that share their beginnings; node 0 is the empty one."""

    def __init__(self, modulus: int = (1 << 61) - 1):
        self.modulus = modulus
        self.parent, self.symbol, self.depth, self.hash = [0], [""], [0], [0]
        self.ancestors: list[list[int]] = [[]]
        self.alike: dict[int, int] = {}

    def extend(self, node: int, symbol: str) -> int:
        above, jump, k = [node], node, 0
        while k < len(self.ancestors[jump]):
            jump = self.ancestors[jump][k]
            above.append(jump)
            k += 1
        self.parent.append(node)
        self.symbol.append(symbol)
        self.depth.append(self.depth[node] + 1)
        self.hash.append((self.hash[node] * 1_000_003 + hash(symbol) + 1) % self.modulus)
        self.ancestors.append(above)
        return len(self.parent) - 1

    def text(self, node: int, depth: int = 0) -> str:
        """The symbols of ``node`` behind the first ``depth``."""
        symbols = []
        while self.depth[node] > depth:
            symbols.append(self.symbol[node])
            node = self.parent[node]
        return "".join(reversed(symbols))

    def path(self, node: int) -> list[str]:
        symbols = []
        while node:
            symbols.append(self.symbol[node])
            node = self.parent[node]
        return symbols[::-1]

    def _up(self, node: int, depth: int) -> int:
        """The ancestor at ``depth``."""
        step, k = self.depth[node] - depth, 0
        while step:
            if step & 1:
                node = self.ancestors[node][k]
            step >>= 1
            k += 1
        return node

    def _same(self, a: int, b: int) -> bool:
        """Whether two nodes of one depth and hash have the same symbols; remembers that they do."""
        seen = []
        while (a := self._like(a)) != (b := self._like(b)):
            if self.symbol[a] != self.symbol[b]:
                return False
            seen.append((a, b))
            a, b = self.parent[a], self.parent[b]
        for one, other in seen:
            self.alike[max(one, other)] = min(one, other)
        return True

    def _like(self, node: int) -> int:
        while node in self.alike:
            node = self.alike[node]
        return node

    def _common(self, a: int, b: int) -> int | None:
        """The length of the longest common prefix, or None if hashes collide."""
        depth = min(self.depth[a], self.depth[b])
        a, b = self._up(a, depth), self._up(b, depth)
        if self.hash[a] != self.hash[b]:
            for k in range(len(self.ancestors[a]) - 1, -1, -1):
                if k < len(self.ancestors[a]):
                    u, v = self.ancestors[a][k], self.ancestors[b][k]
                    if self.hash[u] != self.hash[v]:
                        a, b = u, v
            a, b = self.parent[a], self.parent[b]
        return self.depth[a] if self._same(a, b) else None

    def less(self, a: int, x: str, b: int, y: str) -> bool:
        """Whether the text of ``a`` and then ``x`` comes before that of ``b`` and then ``y``."""
        if a == b:
            return x < y
        common = self._common(a, b) or 0
        one = self.symbol[self._up(a, common + 1)] if self.depth[a] > common else x
        other = self.symbol[self._up(b, common + 1)] if self.depth[b] > common else y
        # Symbols of which neither begins the other decide.
        if one and other and not one.startswith(other) and not other.startswith(one):
            return one < other
        return self.text(a, common) + x < self.text(b, common) + y


class Search:
    """The least (cost, audit) of every state, row by row."""

    def __init__(self, tree: AuditTree, start: int):
        self.tree = tree
        self.best: list[Path | None] = [None] * 4
        self.best[start] = (0, 0)

    def _least(self, found: Iterable[tuple[Path | None, int, str]]) -> Path | None:
        """The best of (path, cost of the next edit, its initial), as a path."""
        least = None
        for path, cost, initial in found:
            if path is None:
                continue
            this = (path[0] + cost, path[1], initial)
            if least is None or this[0] < least[0] or (
                this[0] == least[0] and self.tree.less(this[1], this[2], least[1], least[2])
            ):
                least = this
        if least is None:
            return None
        cost, node, initial = least
        return cost, self.tree.extend(node, initial) if initial else node

    def inserted(self) -> list[Path | None]:
        """The best after any inserts."""
        best = self.best
        user = self._least([(best[USER], 0, ""), *[(best[s], INSERT, "I") for s in _NEXT_IS_USER]])
        assistant = self._least([(best[ASSISTANT], 0, ""), (user, INSERT, "I")])
        return [best[NOTHING], best[SYSTEM], user, assistant]

    def row(self, initial: str, fault: int) -> None:
        before = self.inserted()
        into: list[list] = [[(path, DELETE, "D")] for path in before]
        if fault in (CLEAN, TRUNCATED):
            left = UNFINISHED if fault == TRUNCATED else 0
            if initial == "s":
                into[SYSTEM].append((before[NOTHING], left, "K"))
            user = (left, "K") if initial == "u" else (left + REROLE, "R")
            into[USER] += [(before[s], *user) for s in _NEXT_IS_USER]
            assistant = (left, "K") if initial == "a" else (left + REROLE, "R")
            into[ASSISTANT].append((before[USER], *assistant))
        self.best = [self._least(found) for found in into]

    def end(self) -> tuple[int, str]:
        """Cost and audit of the whole."""
        done = self.inserted()
        cost, node = self._least([(done[NOTHING], 0, ""), (done[ASSISTANT], 0, "")])
        return cost, self.tree.text(node)


class Compose:
    """The same over chunks, each given as {(state, next state): (cost, audit)}."""

    def __init__(self, tree: AuditTree):
        self.search = Search(tree, NOTHING)

    def chunk(self, edits: dict[tuple[int, int], tuple[int, str]]) -> None:
        best, states = self.search.best, range(4)
        # A state's number goes with the audit, as two states may share one.
        self.search.best = [
            self.search._least([(best[s], edits[s, t][0], edits[s, t][1]) for s in states if (s, t) in edits]) for t in states
        ]


# --- damage and faults: native -----------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): rows after damage; ``copies`` is 0 for dropped rows."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(key.cast("binary")) % 20
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    return conversations.select(
        "conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def _key() -> Column:
    """The conversation as a struct: unlike a bare id it is equal to itself where it is NULL."""
    return F.struct("conv_id").alias("key")


def faults(rows: DataFrame, rows_per_group: int | None = None) -> DataFrame:
    """(key, pos, role, text, fault): rows numbered within their conversation, each with its first fault.

    ``rows`` are taken by (turn, role, text), NULL turns first.
    """
    each = rows.filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("copies", "copy")
    same = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    numbered = reliable_checkpoint(
        row_numbers(each, ["conv_id"], ["turn", "role", "text"], "pos", rows_per_group).select(
            _key(), "pos", "role", "text", F.unhex(same).alias("same")
        )
    )
    repeated = numbered.groupBy("key", "same").agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n"))
    repeated = repeated.filter("n > 1").select("key", "same", "first")
    ended = F.rtrim(F.col("text"), F.lit(_SPACE))
    fault = (
        F.when(ended == "", BLANK).when(F.col("pos") > F.col("first"), DUPLICATE)
        .when(~F.right(ended, F.lit(1)).isin(".", "!", "?"), TRUNCATED).otherwise(CLEAN)
    )
    return numbered.join(repeated, ["key", "same"], "left").select("key", "pos", "role", "text", fault.alias("fault"))


# --- the search ------------------------------------------------------------------------


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns])


def _search_chunks(modulus: int):
    def finish(key, searches, ends, illegal) -> dict:
        tree = searches[0][1].tree
        edits = [
            {"s": start, "t": state, "cost": path[0], "audit": tree.text(path[1])}
            for start, search in searches for state, path in enumerate(search.best) if path is not None
        ]
        return {"key": [{"conv_id": key[0]}], "chunk": [key[1]], "edits": [edits], "first": [ends[0]], "last": [ends[1]], "illegal": [illegal]}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        key, searches, ends, illegal = None, [], ["", ""], 0
        for conv, chunk, initial, fault in _rows(batches):
            if key != (conv["conv_id"], chunk):
                if key:
                    yield finish(key, searches, ends, illegal)
                key, tree = (conv["conv_id"], chunk), AuditTree(modulus)
                searches = [(s, Search(tree, s)) for s in (range(4) if chunk else [NOTHING])]
                ends, illegal = [initial, initial], 0
            else:
                illegal += ends[1] + initial not in _LEGAL
                ends[1] = initial
            for _, search in searches:
                search.row(initial, fault)
        if key:
            yield finish(key, searches, ends, illegal)

    return run


_PLAN = "key struct<conv_id: {kind}>, chunk long, state int, audit string, cost long, illegal long"


def _compose(modulus: int):
    def finish(key, chunks) -> dict:
        tree = AuditTree(modulus)
        compose, illegal, last = Compose(tree), 0, None
        for _, edits, first, end, inside in chunks:
            compose.chunk({(e["s"], e["t"]): (e["cost"], e["audit"]) for e in edits})
            illegal += inside + (last is not None and last + first not in _LEGAL)
            last = end
        done = compose.search.inserted()
        cost, node = compose.search._least([(done[NOTHING], 0, ""), (done[ASSISTANT], 0, "")])
        symbols = tree.path(node)
        n = len(chunks)
        audits, states = symbols[:n], _states(chunks, symbols)
        audits[-1] += "".join(symbols[n:])
        return {
            "key": [key] * n, "chunk": [c[0] for c in chunks], "state": states, "audit": audits,
            "cost": [cost] * n, "illegal": [illegal] * n,
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        key, chunks = None, []
        for conv, chunk, edits, first, last, illegal in _rows(batches):
            if key is not None and key != conv:
                yield finish(key, chunks)
                chunks = []
            key = conv
            chunks.append((chunk, edits, first, last, illegal))
        if chunks:
            yield finish(key, chunks)

    return run


def _states(chunks, symbols) -> list[int]:
    """The state in which each chunk is entered; an audit read from a known state leads to one state only."""
    state, states = NOTHING, []
    for (_, edits, *_), symbol in zip(chunks, symbols):
        states.append(state)
        state = next(e["t"] for e in edits if e["s"] == state and e["audit"] == symbol)
    return states


def plans(flagged: DataFrame, chunk: int = CHUNK, modulus: int = (1 << 61) - 1) -> DataFrame:
    """(key, chunk, state, audit, cost, illegal): per chunk the edits and the state it is entered in; totals on every row."""
    kind = flagged.schema["key"].dataType["conv_id"].dataType.simpleString()
    numbered = flagged.select("key", F.floor((F.col("pos") - 1) / chunk).alias("chunk"), "pos", F.substring("role", 1, 1).alias("initial"), "fault")
    dealt = numbered.repartition("key", "chunk").sortWithinPartitions("key", "chunk", "pos").drop("pos")
    found = map_batches(
        dealt, _search_chunks(modulus),
        f"key struct<conv_id: {kind}>, chunk long, edits array<struct<s: int, t: int, cost: long, audit: string>>, "
        "first string, last string, illegal long",
    )
    return map_batches(found.repartition("key").sortWithinPartitions("key", "chunk"), _compose(modulus), _PLAN.format(kind=kind))


# --- the repaired rows ----------------------------------------------------------------


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Reads a chunk's plan (pos 0) and then its rows, and writes the turns that are left."""
    names = ("key", "chunk", "place", "edit", "role", "text")
    audit, at, state, place, conv = "", 0, NOTHING, 0, None

    def next_role() -> str:
        return "assistant" if state == USER else "user"

    def inserts(out: list) -> None:
        nonlocal at, state, place
        while at < len(audit) and audit[at] == "I":
            role = next_role()
            out.append((*conv, place, "I", role, ""))
            state, at, place = ASSISTANT if role == "assistant" else USER, at + 1, place + 1

    for batch in batches:
        out: list[tuple] = []
        for key, chunk, pos, role, text, entered, plan in zip(*[c.to_pylist() for c in batch.columns]):
            if pos == 0:
                audit, at, state, place, conv = plan, 0, entered, 0, (key, chunk)
                inserts(out)
                continue
            edit = audit[at]
            at += 1
            if edit != "D":
                role = role if edit == "K" else next_role()
                out.append((key, chunk, place, edit, role, text))
                state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[0]]
                place += 1
            inserts(out)
        if out:
            yield dict(zip(names, map(list, zip(*out))))


def repaired(flagged: DataFrame, planned: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(key, chunk, place, edit, role, text): the turns left, in order of (chunk, place)."""
    rows = flagged.select("key", F.floor((F.col("pos") - 1) / chunk).alias("chunk"), "pos", "role", "text")
    rows = rows.withColumns({"state": F.lit(None).cast("int"), "audit": F.lit(None).cast("string")})
    none = F.lit(None).cast("string")
    heads = planned.select("key", "chunk", F.lit(0).cast("long").alias("pos"), none.alias("role"), none.alias("text"), "state", "audit")
    dealt = rows.unionByName(heads).repartition("key", "chunk").sortWithinPartitions("key", "chunk", "pos")
    kind = flagged.schema["key"].dataType.simpleString()
    return map_batches(dealt, _apply, f"key {kind}, chunk long, place long, edit string, role string, text string")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    key = digest = None
    for conv, role, text in _rows(batches):
        if digest is not None and conv == key:
            digest.update(b"\n")
        else:
            if digest is not None:
                yield {"key": [key], "repaired_sha256": [digest.hexdigest()]}
            key, digest = conv, hashlib.sha256()
        digest.update(f"{role}:{text}".encode())
    if digest is not None:
        yield {"key": [key], "repaired_sha256": [digest.hexdigest()]}


def report(conversations: DataFrame, chunk: int = CHUNK, rows_per_group: int | None = None, modulus: int = (1 << 61) - 1) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every ``conv_id``.

    NULL roles and texts are one space, as are NULL ids and turns in the choice of damage;
    rows with a NULL id form one conversation, rows with equal turns are taken by role and
    text, repeated rows are rows of their own. A conversation without rows after damage has
    zeros, an empty audit and the digest of an empty string. An empty table gives no rows.
    Other columns are not read. The audit and the digest are of a whole conversation: they
    are made in one task, which reads the conversation row by row.
    """
    rows = damaged(conversations)
    # A first pass by turn: partial aggregates, so a long conversation is no burden.
    turns = rows.groupBy(_key(), "turn").agg(F.sum("copies").alias("copies"))
    there = F.when(F.col("copies") > 0, F.col("turn"))
    spans = turns.groupBy("key").agg((F.max(there) - F.min(there) + 1 - F.count(there)).alias("gaps"))
    flagged = reliable_checkpoint(faults(rows, rows_per_group))
    counted = flagged.groupBy("key").agg(*[
        F.count_if(F.col("fault") == fault).alias(name)
        for fault, name in ((BLANK, "blank"), (DUPLICATE, "duplicate"), (TRUNCATED, "truncated"))
    ])
    planned = reliable_checkpoint(plans(flagged, chunk, modulus))
    whole = planned.groupBy("key").agg(
        F.max("illegal").alias("illegal"), F.max("cost").alias("cost"), F.sort_array(F.collect_list(F.struct("chunk", "audit"))).alias("audits"),
    ).select("key", "illegal", "cost", F.array_join("audits.audit", "").alias("audit"))
    left = repaired(flagged, planned, chunk).repartition("key").sortWithinPartitions("key", "chunk", "place")
    kind = flagged.schema["key"].dataType.simpleString()
    digests = map_batches(left.select("key", "role", "text"), _digest, f"key {kind}, repaired_sha256 string")
    joined = spans.join(counted, "key", "left").join(whole, "key", "left").join(digests, "key", "left")
    zero = F.lit(0).cast("long")
    return joined.select(
        "key.conv_id", *[F.coalesce(c, zero).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(_EMPTY)).alias("repaired_sha256"),
    )
