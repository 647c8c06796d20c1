"""Structure repair of conversations: the cheapest edits that make the roles ``(s?(ua)+)?``, by the auction algorithm for shortest paths.

A conversation is a lattice of nodes (rows passed, state); the state says what the last turn given out was. Keep, rerole, delete
and insert are arcs with whole-number costs, and the cheapest repair is a shortest path to an accepting end. The
auction keeps one path and a price per node, never above the cost of any arc plus the price at its end. The last node of the path
looks for its best arc: if its price is below that arc's worth, the price is raised to it and the path contracts by the node;
else the arc is tight and the path is extended by it. When the path reaches the end, prices along it are exact distances. Arcs
are looked at in the order of their initials, so the path follows the least tight arc of every node, and tracing the tight arcs
from the start gives the least audit string among the cheapest ones: a node's arcs have different initials, an arc dearer
than the best at the time of extension stays so, and no cheapest audit is the beginning of another.

At scale: rows are put in order over the whole table by ranges of (conversation, turn, role, hash of the text), so a
conversation of any length is dealt out over tasks, in segments of at most ``ROWS`` different rows. A conversation that is one
segment is solved there. Segments of longer ones give their cost from each state to each state; from the last segment
backwards these make the prices at every segment's end, with which each segment finds its least path from each of the four states.
Only then do texts move, once: a task goes through a conversation's segments and texts in order and feeds the hash of
the repaired conversation. That stream holds one batch of texts at a time; SHA-256 and the audit string of one conversation
cannot be made in parts elsewhere. Rows that agree in everything are one row with a count until then.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.common import stored, table

ROWS = 32
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
_NEVER = 1 << 60
_SPACE = " \t\n\x0b\f\r"

# States: nothing given out yet, after the system turn, after a user's, after an assistant's.
START, SYSTEM, USER, ASSISTANT = range(4)
#: What leaving in each state costs at the end of a conversation.
END = (0, _NEVER, _NEVER, 0)
ROLE = {SYSTEM: "system", USER: "user", ASSISTANT: "assistant"}


# -- the auction ----------------------------------------------------------------------------------------------


def _turn_after(state: int) -> int:
    return ASSISTANT if state == USER else USER


def _kept(initial: str, state: int) -> int | None:
    """The state after keeping a row, if that is legal."""
    if initial == "s":
        return SYSTEM if state == START else None
    if initial in "ua":
        return _turn_after(state) if initial == ("a" if state == USER else "u") else None
    return None


def _arcs(items: str, repeats: Sequence[int], i: int, state: int):
    """(initials, next node, cost) by initial. ``items``: the row's initial, a capital if it is truncated, ``d`` if it must go."""
    after = _turn_after(state)
    if i < len(items):
        item = items[i]
        if item == "d":
            yield "D", (i + 1, state), DELETE * repeats[i]
            yield "I", (i, after), INSERT
            return
        extra = TRUNCATED if item.isupper() else 0
        yield "D", (i + 1, state), DELETE
        yield "I", (i, after), INSERT
        kept = _kept(item.lower(), state)
        if kept is not None:
            yield "K", (i + 1, kept), extra
        yield "R", (i + 1, after), REROLE + extra
    else:
        yield "", None, 0
        yield "I", (i, after), INSERT


class Auction:
    """Prices of the nodes of one segment, towards leaving it at the cost ``exits[state]``.

    Starting prices are what no path can avoid: deletions that must be, a truncated row's charge, the cheapest exit.
    """

    def __init__(self, items: str, repeats: Sequence[int], exits: Sequence[int]):
        self.items, self.repeats, self.exits = items, repeats, exits
        least = min(exits)
        floor = [least]
        for item, n in zip(reversed(items), reversed(repeats), strict=True):
            floor.append(floor[-1] + (DELETE * n if item == "d" else TRUNCATED if item.isupper() else 0))
        floor.reverse()
        self.price = {(i, s): floor[i] for i in range(len(items) + 1) for s in range(4)}

    def _worth(self, node: tuple[int, int]):
        """The best arc of a node, the least initial among equals, and its worth."""
        best, choice = 2 * _NEVER, None
        for initial, to, cost in _arcs(self.items, self.repeats, *node):
            worth = cost + (self.exits[node[1]] if to is None else self.price[to])
            if worth < best:
                best, choice = worth, (initial, to, cost)
        return best, choice

    def distance(self, state: int) -> int:
        """The cost of the cheapest way from the segment's start in ``state`` to an exit; there must be one."""
        price, path = self.price, [(0, state)]
        while True:
            node = path[-1]
            worth, (_, to, _) = self._worth(node)
            if price[node] < worth:
                price[node] = worth
                if len(path) > 1:
                    path.pop()
            elif to is None:
                return price[path[0]]
            else:
                path.append(to)

    def trace(self, state: int) -> tuple[str, int, int]:
        """The least audit among the cheapest ways, its cost up to the exit, and the state there. Call ``distance`` first."""
        audit, spent, node = [], 0, (0, state)
        while True:
            worth, (initial, to, cost) = self._worth(node)
            if worth != self.price[node]:
                raise AssertionError("no tight arc; distance() wasn't called for this state")
            if to is None:
                return "".join(audit), spent, node[1]
            audit.append("D" * self.repeats[node[0]] if initial == "D" else initial)
            spent += cost
            node = to


def crossings(items: str, repeats: Sequence[int]) -> list[int]:
    """Cheapest cost from each state at a segment's start to each state at its end, row by row."""
    out = [_NEVER] * 16
    for to in range(4):
        auction = Auction(items, repeats, [0 if s == to else _NEVER for s in range(4)])
        for state in range(4):
            within = to >= USER or state == to or (state, to) == (START, SYSTEM) and ("s" in items or "S" in items)
            if within:
                out[4 * state + to] = auction.distance(state)
    return out


# -- segments -------------------------------------------------------------------------------------------------


def _spaces_off(text: str) -> Column:
    return F.rtrim(F.col(text), F.lit(_SPACE))


def _ordered(rows: DataFrame) -> DataFrame:
    """Different rows with their count and faults: one row per (conv, turn, role, hash)."""
    trimmed = _spaces_off("text")
    slim = rows.select(
        "conv",
        "turn",
        "role",
        "hash",
        (trimmed == "").alias("blank"),
        (~F.right(trimmed, F.lit(1)).isin(".", "!", "?")).alias("truncated"),
    )
    each = slim.groupBy("conv", "turn", "role", "hash").agg(
        F.count(F.lit(1)).alias("times"), F.first("blank").alias("blank"), F.first("truncated").alias("truncated")
    )
    each = stored(each)
    seen = F.struct(F.col("turn").isNotNull().alias("has"), "turn")
    first = each.groupBy(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("hash").alias("h")).agg(F.min(seen)["turn"].alias("first"))
    same = F.col("conv").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("hash") == F.col("h"))
    return each.join(first, same).select(
        "conv", "turn", "role", "hash", "times", "blank", "truncated", (~F.col("turn").eqNullSafe(F.col("first"))).alias("again")
    )


_STATS = ("blank", "duplicate", "truncated", "illegal", "turns")


class _Segment:
    """Rows of one conversation, in order."""

    def __init__(self, row: dict):
        self.key = {k: row[k] for k in ("conv", "turn", "role", "hash")}
        self.rows, self.items, self.repeats = 0, [], []
        self.stats = dict.fromkeys(_STATS, 0)
        self.first_turn = self.last_turn = self.least_turn = None
        self.first_initial = self.last_initial = None

    def add(self, row: dict) -> None:
        initial, times, turn = row["role"][:1], row["times"], row["turn"]
        stats = self.stats
        if not self.rows:
            self.first_turn, self.first_initial = turn, initial
        elif self.last_initial + initial not in ("su", "ua", "au"):
            stats["illegal"] += 1
        stats["illegal"] += times - 1
        if turn is not None:
            if self.least_turn is None:
                self.least_turn = turn
            stats["turns"] += not self.rows or turn != self.last_turn
        self.rows += 1
        self.last_turn, self.last_initial = turn, initial
        if row["blank"]:
            stats["blank"] += times
        elif row["again"]:
            stats["duplicate"] += times
        else:
            item = initial if initial in ("s", "u", "a") else "x"
            self.items.append(item.upper() if row["truncated"] else item)
            self.repeats.append(1)
            stats["truncated"] += row["truncated"]
            stats["duplicate"] += times - 1
            times -= 1
        if times:
            self.items.append("d")
            self.repeats.append(times)

    def out(self, whole: bool) -> dict:
        items = "".join(self.items)
        found = self.key | self.stats | {"items": items, "repeats": self.repeats, "whole": whole, "crossing": None}
        found |= {"first_turn": self.first_turn, "last_turn": self.last_turn, "least_turn": self.least_turn}
        found |= {"first_initial": self.first_initial, "last_initial": self.last_initial}
        found |= {"audits": None, "costs": None, "ends": None}
        if not whole:
            return found | {"crossing": crossings(items, self.repeats)}
        return found | _ways(items, self.repeats, END, (START,))


def _ways(items: str, repeats: Sequence[int], exits: Sequence[int], states: Sequence[int]) -> dict:
    auction, found = Auction(items, repeats, exits), []
    for state in states:
        auction.distance(state)
        found.append(auction.trace(state))
    return dict(zip(("audits", "costs", "ends"), (list(x) for x in zip(*found, strict=True)), strict=True))


def _fields(conv: str) -> str:
    return (
        f"conv {conv}, turn long, role string, hash string, items string, repeats array<long>, whole boolean, crossing array<long>, "
        + "first_turn long, last_turn long, least_turn long, first_initial string, last_initial string, "
        + "audits array<string>, costs array<long>, ends array<int>, "
        + ", ".join(f"{s} long" for s in _STATS)
    )


def _batched(rows: Iterator[dict], schema: pa.Schema, at_once: int = 1000) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == at_once:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _segmented(schema: pa.Schema, rows_each: int):
    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        now, inside = None, False  # inside: the conversation's first row is this task's, but not its first row at all
        for batch in batches:
            for row in batch.to_pylist():
                if now is not None and row["conv"] != now.key["conv"]:
                    yield now.out(whole=inside)
                    now, inside = None, True
                elif now is not None and now.rows >= rows_each:
                    yield now.out(whole=False)
                    now, inside = None, False
                if now is None:
                    now = _Segment(row)
                now.add(row)
        if now is not None:
            yield now.out(whole=False)

    return lambda batches: _batched(segments(batches), schema)


def _priced(schema: pa.Schema):
    """Segments of split conversations, last first, with the prices at their ends (in ``crossing``)."""

    def priced(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        conv, prices, begun = None, END, False
        for batch in batches:
            for row in batch.to_pylist():
                if not begun or row["conv"] != conv:
                    conv, prices, begun = row["conv"], END, True
                cost = row["crossing"]
                yield row | {"crossing": list(prices)}
                prices = tuple(min(cost[4 * s + t] + prices[t] for t in range(4)) for s in range(4))

    return lambda batches: _batched(priced(batches), schema)


def _solved(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r | _ways(r["items"], r["repeats"], r["crossing"], range(4)) for batch in batches for r in batch.to_pylist())
        return _batched(rows, schema)

    return run


def _arrow(df_schema) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(df_schema)


ORDER = ("conv", "turn", "role", "hash")


def segments(rows: DataFrame, rows_each: int | None = None) -> DataFrame:
    """One row per segment, with its least audits, their costs and end states by the state it is entered in (only START if it is whole)."""
    fields = _fields(rows.schema["conv"].dataType.simpleString())
    schema = _arrow(rows.sparkSession.createDataFrame([], fields).schema)
    up = [F.asc_nulls_first(c) for c in ORDER]
    down = [F.desc_nulls_last(c) for c in ORDER]
    ordered = stored(_ordered(rows)).repartitionByRange(*up).sortWithinPartitions(*up)
    made = stored(ordered.mapInArrow(_segmented(schema, rows_each or ROWS), fields))
    split = made.where("NOT whole").repartition("conv").sortWithinPartitions(*down).mapInArrow(_priced(schema), fields)
    return made.where("whole").unionByName(stored(split).repartition(*ORDER).mapInArrow(_solved(schema), fields))


# -- the repaired conversations -------------------------------------------------------------------------------

RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string, turns long"


class _Conversation:
    def __init__(self, conv):
        self.conv = conv
        self.found = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "cost", "turns"), 0)
        self.least = self.most = self.last_turn = self.last_initial = None
        self.state = self.entered = START
        self.audit: list[str] = []
        self.open, self.at = "", 0
        self.digest, self.given = hashlib.sha256(), 0

    def enter(self, s: dict) -> None:
        """A segment begins; its way follows from the state reached so far."""
        self._inserts()
        for k in _STATS:
            self.found[k] += s[k]
        if self.last_initial is not None and self.last_initial + s["first_initial"] not in ("su", "ua", "au"):
            self.found["illegal"] += 1
        if s["first_turn"] is not None and s["first_turn"] == self.last_turn:
            self.found["turns"] -= 1
        if s["least_turn"] is not None:
            self.least = s["least_turn"] if self.least is None else self.least
            self.most = s["last_turn"]
        self.last_turn, self.last_initial = s["last_turn"], s["last_initial"]
        way = self.entered
        self.open, self.at = s["audits"][way], 0
        self.audit.append(self.open)
        self.found["cost"] += s["costs"][way]
        self.entered = s["ends"][way]

    def _give(self, role: str, text: str) -> None:
        self.digest.update(f"{chr(10) if self.given else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
        self.given += 1

    def _inserts(self) -> None:
        while self.open[self.at : self.at + 1] == "I":
            self.state = _turn_after(self.state)
            self._give(ROLE[self.state], "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self._inserts()
        edit = self.open[self.at]
        self.at += 1
        if edit == "K":
            self.state = _kept(role[0], self.state)
            self._give(role, text)
        elif edit == "R":
            self.state = _turn_after(self.state)
            self._give(ROLE[self.state], text)

    def out(self) -> dict:
        self._inserts()
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.found["turns"]
        done = {"gaps": gaps, "audit": "".join(self.audit), "repaired_sha256": self.digest.hexdigest(), "turns": self.given}
        return {"conv": self.conv} | self.found | done


def _repaired(schema: pa.Schema):
    def conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        now = None
        for batch in batches:
            for row in batch.to_pylist():
                if row["kind"] == 0:
                    if now is not None:
                        yield now.out()
                    now = _Conversation(row["conv"])
                elif row["kind"] == 1:
                    now.enter(row["segment"])
                else:
                    now.row(row["role"], row["text"])
        if now is not None:
            yield now.out()

    return lambda batches: _batched(conversations(batches), schema)


_CARRIED = ("first_turn", "last_turn", "least_turn", "first_initial", "last_initial", "audits", "costs", "ends", *_STATS)


def repair(
    rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", rows_each: int | None = None,
    among: DataFrame | None = None,
) -> DataFrame:
    """One row per conversation: conv_id, faults found, cost and audit of the cheapest repair, hash and number of the repaired turns.

    Rows are taken by turn, missing turns first; rows of one turn by role, then by the hash of the text. A null role or text counts as one
    space, so a null text is blank; a null ``conv_id`` is a conversation of its own. A role that begins with none of s, u, a, or is
    empty, can't be kept as it is. Each row has one fault at most: blank, else duplicate (role and text seen earlier), else
    truncated. Blank and duplicate rows are deleted. ``among`` names conversations (a column ``conv_id``) that are to be
    listed even if ``rows`` has none of their rows. Other columns aren't looked at; an empty table gives no rows.
    """
    conv = F.col(conv_id).alias("conv")
    rows = rows.select(
        conv,
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"),
    ).withColumn("hash", F.sha2("text", 256))
    listed = rows.select("conv").distinct() if among is None else rows.select("conv").union(among.select(conv)).distinct()
    kind = rows.schema["conv"].dataType.simpleString()
    steps = segments(rows, rows_each).select(*ORDER, F.struct(*_CARRIED).alias("segment"))
    heads = listed.select("conv", F.lit(0).alias("kind"))
    stream = (
        heads.unionByName(steps.withColumn("kind", F.lit(1)), allowMissingColumns=True)
        .unionByName(rows.withColumn("kind", F.lit(2)), allowMissingColumns=True)
        .select("conv", "turn", "role", "hash", "kind", "text", "segment")
        .repartition("conv")
        .sortWithinPartitions(*[F.asc_nulls_first(c) for c in (*ORDER, "kind")])
    )
    fields = f"conv {kind}, {RESULT}"
    schema = _arrow(rows.sparkSession.createDataFrame([], fields).schema)
    return stream.mapInArrow(_repaired(schema), fields).withColumnRenamed("conv", conv_id)


def damaged(rows: DataFrame) -> DataFrame:
    """Test damage by the CRC-32 of ``conv_id:turn`` (nulls: one space) modulo 20: 0 drops the row, 1 empties its text, 2 takes out
    its full stops, exclamation and question marks, 3 repeats it, 4 sets the role user."""
    own = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    code = F.crc32(F.encode(F.concat(own("conv_id"), F.lit(":"), own("turn")), "UTF-8")) % 20
    text = F.when(code == 1, F.lit("")).when(code == 2, F.regexp_replace(own("text"), "[.!?]", "")).otherwise(own("text"))
    role = F.when(code == 4, F.lit("user")).otherwise(own("role"))
    return rows.where(code != 0).select(
        "conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(1), F.when(code == 3, 2).otherwise(1))).alias("_copy")
    ).drop("_copy")


def op12_auction_repair(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repair(damaged(rows), among=rows)
