"""Repair of conversations: the cheapest edits that make their turns alternate.

The rows of a conversation span an edit lattice: a node is the number of rows
consumed and the state of the pattern ``(s?(ua)+)?``; edges keep, re-role or
delete the next row, or insert a turn.  A bidirectional Dijkstra search finds
the cheapest way: heaps from the start and from the end meet, both go on until
no further crossing can be as cheap, and of all cheapest crossings the one with
the least audit is taken.

Rows are ordered once by a range partitioning, so that a conversation of any
length is spread over tasks.  It is searched in segments: a segment's search
gives the cheapest way between any two states, and a second search over the
segments, whose edges are those ways, chooses among them.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.frames import partitions, saved, small_batches, tidy, tidy_group

KEEP, REROLE, DELETE, INSERT = "KRDI"
# The prices of edits.
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 1, 2, 5, 5
# Rows of a conversation that are searched at once.
SEGMENT = 512
# States of the pattern: nothing yet, a system turn, a user turn, a whole exchange.
START, SYSTEM, USER, ASSISTANT = range(4)
# By state: the role initial that a re-roled or inserted turn has there, and the state after each initial.
NEEDED = {START: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
AFTER = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
ENDS = (START, ASSISTANT)
ROLES = {"s": "system", "u": "user", "a": "assistant"}
# A row's code is its role initial if it is s, u or a, else OTHER; upper case if it is truncated, GONE if it must go.
OTHER, GONE = "o", "-"

Node = tuple[int, int]  # rows consumed, state
Edge = tuple[Node, int, str]  # the node at the other side, cost, label


def row_edges(code: str, state: int) -> Iterator[tuple[int, int, str]]:
    """What may be done with a row in a state: (state after, cost, label)."""
    yield state, DELETE_COST, DELETE
    if code == GONE:
        return
    initial, extra = code.lower(), TRUNCATED_COST if code.isupper() else 0
    if initial in AFTER[state]:
        yield AFTER[state][initial], extra, KEEP
    yield AFTER[state][NEEDED[state]], REROLE_COST + extra, REROLE


def meet(
    start: Node, ends: Iterable[Node], onward: Callable[[Node], Iterable[Edge]], back: Callable[[Node], Iterable[Edge]]
) -> tuple[int, str] | None:
    """Cost and labels of the cheapest way from ``start`` to one of ``ends``; of equally cheap ones the least labels.

    ``onward`` and ``back`` give the edges out of and into a node.  Edges lead
    to a higher layer, or within a layer at a cost above 0, so nodes of one cost
    are settled layer by layer and their least labels are known by then.  No two
    equally cheap ways between the same nodes have labels of which one begins
    the other, so the least front and the least rest make the least whole.
    """
    found: tuple[dict[Node, tuple[int, str]], ...] = ({start: (0, "")}, {end: (0, "") for end in ends})
    settled: tuple[set[Node], set[Node]] = (set(), set())
    heaps = ([(0, start[0], start)], [(0, -end[0], end) for end in found[1]])
    heapq.heapify(heaps[1])
    best = None
    while heaps[0] or heaps[1]:
        if best is not None and sum(heap[0][0] for heap in heaps if heap) > best[0]:
            break
        side = int(not heaps[0] or bool(heaps[1]) and heaps[1][0][0] < heaps[0][0][0])
        cost, _, node = heapq.heappop(heaps[side])
        if node in settled[side]:
            continue
        settled[side].add(node)
        labels = found[side][node][1]
        if node in settled[1 - side]:
            other, rest = found[1 - side][node]
            whole = (cost + other, labels + rest if side == 0 else rest + labels)
            best = whole if best is None else min(best, whole)
        for there, price, label in (onward if side == 0 else back)(node):
            reached = (cost + price, labels + label if side == 0 else label + labels)
            if there in settled[1 - side]:
                other, rest = found[1 - side][there]
                whole = (reached[0] + other, reached[1] + rest if side == 0 else rest + reached[1])
                best = whole if best is None else min(best, whole)
            if there not in found[side] or reached < found[side][there]:
                if there not in found[side] or reached[0] < found[side][there][0]:
                    heapq.heappush(heaps[side], (reached[0], there[0] if side == 0 else -there[0], there))
                found[side][there] = reached
    return best


def _lattice(codes: str, last: bool) -> tuple[Callable[[Node], list[Edge]], Callable[[Node], list[Edge]]]:
    """Edges of the rows of a segment; a turn may be inserted before each row, and after all rows of the last segment."""
    rows = len(codes)

    def onward(node: Node) -> list[Edge]:
        row, state = node
        edges = [((row, AFTER[state][NEEDED[state]]), INSERT_COST, INSERT)] if row < rows or last else []
        if row < rows:
            edges += [((row + 1, to), cost, label) for to, cost, label in row_edges(codes[row], state)]
        return edges

    def back(node: Node) -> list[Edge]:
        row, state = node
        edges = []
        for before in AFTER:
            if (row < rows or last) and AFTER[before][NEEDED[before]] == state:
                edges.append(((row, before), INSERT_COST, INSERT))
            if row:
                edges += [
                    ((row - 1, before), cost, label)
                    for to, cost, label in row_edges(codes[row - 1], before) if to == state
                ]
        return edges

    return onward, back


@functools.lru_cache(maxsize=1 << 14)
def cheapest(codes: str) -> tuple[int, str]:
    """Cost and audit of the cheapest repair of a whole conversation."""
    return meet((0, START), [(len(codes), state) for state in ENDS], *_lattice(codes, True))


def ways(codes: str, last: bool) -> list[tuple[int, int, int, str]]:
    """(state before, state after, cost, audit) of the cheapest ways through a segment; after the last one all ends are one."""
    found = []
    for before in AFTER:
        for ends in [ENDS] if last else [(state,) for state in AFTER]:
            way = meet((0, before), [(len(codes), state) for state in ends], *_lattice(codes, last))
            if way:
                found.append((before, ends[0], *way))
    return found


def chosen_ways(segments: list[list[tuple[int, int, int, int]]]) -> list[tuple[int, int]]:
    """The states before and after each segment on the cheapest way through all.

    A segment's ways are (before, after, cost, rank); ranks order the audits of
    the ways that begin alike, which decides among equally cheap ones, as no two
    of them are equal or begin each other.
    """
    out: list[dict[int, list]] = []
    into: list[dict[int, list]] = []
    for found in segments:
        out.append({}), into.append({})
        for before, after, cost, rank in found:
            out[-1].setdefault(before, []).append((after, cost, chr(48 + rank)))
            into[-1].setdefault(after, []).append((before, cost, chr(48 + rank)))
    count = len(segments)

    def onward(node: Node) -> list[Edge]:
        at, state = node
        return [((at + 1, to), cost, label) for to, cost, label in out[at].get(state, ())] if at < count else []

    def back(node: Node) -> list[Edge]:
        at, state = node
        return [((at - 1, to), cost, label) for to, cost, label in into[at - 1].get(state, ())] if at else []

    _, ranks = meet((0, START), [(count, ENDS[0])], onward, back)
    states, path = START, []
    for at, rank in enumerate(ranks):
        after = next(to for to, _, label in out[at][states] if label == rank)
        path.append((states, after))
        states = after
    return path


# --- rows -----------------------------------------------------------------------


def _blank(text: Column) -> Column:
    return ~text.rlike(r"[^\x20\x09-\x0D]")


def _truncated(text: Column) -> Column:
    return ~F.rtrim(text, F.lit(" \t\n\x0b\x0c\r")).rlike(r"[.!?]\z")


def ordered_rows(messages: DataFrame) -> DataFrame:
    """The rows of all conversations in one order, cut into tasks wherever that falls.

    ``conv, conv_id, turn, role, text, place``: ``conv`` is the id as text, null
    as one space; ``place`` rises by conversation, then turn (null first), then
    role and text, of which the first 64 characters decide and then a digest.
    Equal rows follow each other and may go to different tasks.
    """
    rows = saved(messages.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"), F.monotonically_increasing_id().alias("row"),
    ))
    rows = rows.withColumns({
        "conv": F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")),
        "said": F.sha2(F.encode(F.concat("role", F.lit("\0"), "text"), "UTF-8"), 256),
        "role_head": F.left("role", F.lit(64)), "text_head": F.left("text", F.lit(64)),
    })
    order = ["conv", "turn", "role_head", "text_head", "said", "row"]
    placed = rows.repartitionByRange(partitions(rows.sparkSession), *order).sortWithinPartitions(*order)
    return saved(placed.select(
        "conv", "conv_id", "turn", "role", "text", "said", F.monotonically_increasing_id().alias("place"),
        _blank(F.col("text")).alias("blank"), _truncated(F.col("text")).alias("cut"),
    ))


def _segments(rows: DataFrame) -> DataFrame:
    """``conv, conv_id, segment, rows``: what the search needs of at most ``SEGMENT`` rows that follow each other."""
    # Of rows that say the same the first is no duplicate; it is known by its place, so no key is hot in the join.
    firsts = saved(rows.filter("NOT blank").groupBy("conv", "said").agg(F.min("place").alias("place")).select(
        "place", F.lit(True).alias("first")
    ))
    slim = rows.select("conv", "conv_id", "turn", "place", "blank", "cut", F.substring("role", 1, 1).alias("initial"))
    coded = slim.join(firsts, "place", "left").withColumn("fault", (
        F.when(F.col("blank"), "blank").when(F.col("first").isNull(), "duplicate").when(F.col("cut"), "truncated").otherwise("")
    ))
    one = F.struct("place", "turn", "initial", "fault")
    return saved(coded.groupBy("conv", F.floor(F.col("place") / SEGMENT).alias("segment")).agg(
        F.first("conv_id").alias("conv_id"), F.sort_array(F.collect_list(one)).alias("rows")
    ))


def _code(initial: str, fault: str) -> str:
    if fault in ("blank", "duplicate"):
        return GONE
    code = initial if initial in ROLES else OTHER
    return code.upper() if fault == "truncated" else code


_COUNTS = ("blank", "duplicate", "truncated")


def _summary(rows: list[dict]) -> dict:
    """Faults, illegal neighbours and turns inside a segment, and what its neighbours need to know."""
    turns = [row["turn"] for row in rows if row["turn"] is not None]
    initials = [row["initial"] for row in rows]
    return {
        **{fault: sum(row["fault"] == fault for row in rows) for fault in _COUNTS},
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        "first_initial": initials[0], "last_initial": initials[-1],
        "low": min(turns, default=None), "high": max(turns, default=None), "turns": len(set(turns)),
    }


_SUMMARY = (
    "blank long, duplicate long, truncated long, illegal long, first_initial string, last_initial string, low long, "
    "high long, turns long"
)
_KINDS = {
    "long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64()),
    "array<string>": pa.list_(pa.string()),
}


def _batch(rows: list[dict], schema: str) -> pa.RecordBatch:
    columns = dict(column.rsplit(" ", 1) for column in schema.split(", "))
    return pa.record_batch({name: pa.array([row[name] for row in rows], _KINDS[kind]) for name, kind in columns.items()})


_SEARCHED = (
    f"conv string, conv_id long, segment long, split boolean, {_SUMMARY}, codes string, "
    "before array<long>, after array<long>, costs array<long>, audits array<string>"
)


def _searched(segments: DataFrame) -> DataFrame:
    """The segments' summaries and the ways through them; the only way of a conversation in one segment."""
    among = segments.groupBy("conv").agg(F.count("segment").alias("many"), F.max("segment").alias("last"))
    split = saved(among.filter("many > 1").select("conv", "last"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                codes = "".join(_code(one["initial"], one["fault"]) for one in row["rows"])
                if row["last"] is None:
                    through = [(START, ENDS[0], *cheapest(codes))]
                else:
                    through = ways(codes, row["last"] == row["segment"])
                found.append({
                    "conv": row["conv"], "conv_id": row["conv_id"], "segment": row["segment"],
                    "split": row["last"] is not None, **_summary(row["rows"]),
                    "codes": codes, **dict(zip(("before", "after", "costs", "audits"), map(list, zip(*through)))),
                })
            if found:
                yield _batch(found, _SEARCHED)

    return saved(segments.join(split, "conv", "left").select(
        "conv", "conv_id", "segment", "rows", "last"
    ).mapInArrow(tidy(search), _SEARCHED))


def _decided(searched: DataFrame) -> DataFrame:
    """``conv, segment, codes, state, cost, audit`` of each segment: the way taken through it and its state before."""
    ordered = F.transform("audits", lambda audit, i: F.struct(F.get("before", i).alias("before"), audit.alias("audit")))
    # The rank of a way's audit among the ways that begin in the same state; the audits themselves stay behind.
    ranks = F.transform(ordered, lambda own: F.size(F.filter(
        ordered, lambda other: (other.before == own.before) & (other.audit < own.audit)
    )).cast("long"))

    def choose(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda row: row["segment"])
        path = chosen_ways([list(zip(row["before"], row["after"], row["costs"], row["ranks"])) for row in rows])
        return pa.table({
            "conv": table.column("conv"), "segment": pa.array([row["segment"] for row in rows], pa.int64()),
            "state": pa.array([before for before, _ in path], pa.int64()),
            "to": pa.array([after for _, after in path], pa.int64()),
        })

    split = searched.filter("split")
    slim = split.select("conv", "segment", "before", "after", "costs", ranks.alias("ranks"))
    path = saved(slim.groupBy("conv").applyInArrow(tidy_group(choose), "conv string, segment long, state long, to long"))
    taken = split.join(path, ["conv", "segment"]).withColumn("way", F.expr(
        "filter(sequence(0, size(before) - 1), i -> before[i] = state AND after[i] = to)[0]"
    ))
    whole = searched.filter("NOT split").withColumns({"state": F.lit(START).cast("long"), "way": F.lit(0)})
    return saved(whole.unionByName(taken.drop("to")).select(
        "conv", "segment", "codes", "state", F.get("costs", F.col("way")).alias("cost"),
        F.get("audits", F.col("way")).alias("audit"),
    ))


def _findings(searched: DataFrame, decided: DataFrame) -> DataFrame:
    """One row for each conversation; neighbouring segments tell what lies across their border."""
    before = Window.partitionBy("conv").orderBy("segment")
    across = F.concat(F.lag("last_initial").over(before), F.col("first_initial"))
    joined = searched.join(decided.select("conv", "segment", "cost", "audit"), ["conv", "segment"]).withColumns({
        "apart": (across.isNotNull() & ~across.isin("su", "ua", "au")).cast("long"),
        "shared": F.coalesce((F.lag("high").over(before) == F.col("low")).cast("long"), F.lit(0)),
    })
    pieces = F.sort_array(F.collect_list(F.struct("segment", "audit")))
    return joined.groupBy("conv").agg(
        F.first("conv_id").alias("conv_id"),
        F.coalesce(F.max("high") - F.min("low") + 1 - F.sum("turns") + F.sum("shared"), F.lit(0)).alias("gaps"),
        *(F.sum(fault).alias(fault) for fault in _COUNTS), F.sum(F.col("illegal") + F.col("apart")).alias("illegal"),
        F.sum("cost").alias("cost"), F.array_join(F.transform(pieces, lambda piece: piece.audit), "").alias("audit"),
    )


def _turns(codes: str, state: int, audit: str) -> list[tuple[int, str | None]]:
    """(row, role) of the turns left by an audit: rows from 0, -1 for an inserted turn; no role where a row keeps its own."""
    turns, row = [], 0
    for edit in audit:
        if edit == DELETE:
            row += 1
            continue
        initial = codes[row].lower() if edit == KEEP else NEEDED[state]
        state = AFTER[state][initial]
        turns.append((-1 if edit == INSERT else row, None if edit == KEEP else ROLES[initial]))
        row += edit != INSERT
    return turns


_TURN = "conv string, conv_id long, position long, role string, text string"


def _repaired(rows: DataFrame, decided: DataFrame) -> DataFrame:
    """The turns left, those of a conversation in order in one task; a task holds one batch of rows at a time."""
    marks = decided.select(
        "conv", "segment", F.lit(None).cast("long").alias("place"), F.lit(None).cast("long").alias("conv_id"),
        F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), "codes", "state", "audit",
    )
    lines = rows.select(
        "conv", F.floor(F.col("place") / SEGMENT).alias("segment"), "place", "conv_id", "role", "text",
        F.lit(None).cast("string").alias("codes"), F.lit(None).cast("long").alias("state"),
        F.lit(None).cast("string").alias("audit"),
    )
    both = small_batches(marks.unionByName(lines)).repartition(partitions(rows.sparkSession), "conv")
    both = both.sortWithinPartitions("conv", "segment", F.col("place").asc_nulls_first())

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: list[tuple[int, str | None]] = []
        conv, row_number, row_count, position = None, 0, 0, 0
        for batch in batches:
            out: list[dict] = []

            def left(line: dict, role: str, text: str) -> None:
                nonlocal position
                out.append({"conv": conv, "conv_id": line["conv_id"], "position": position, "role": role, "text": text})
                position += 1

            def inserted(line: dict) -> None:
                while turns and turns[0][0] == -1:
                    left(line, turns.pop(0)[1], "")

            for line in batch.to_pylist():
                if line["conv"] != conv:
                    conv, position = line["conv"], 0
                if line["place"] is None:
                    turns = _turns(line["codes"], line["state"], line["audit"])
                    row_number, row_count = 0, len(line["codes"])
                    continue
                inserted(line)
                if turns and turns[0][0] == row_number:
                    role = turns.pop(0)[1]
                    left(line, line["role"] if role is None else role, line["text"])
                row_number += 1
                if row_number == row_count:
                    inserted(line)
            if out:
                yield _batch(out, _TURN)

    return both.mapInArrow(tidy(apply), _TURN)


def repair(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What is wrong with each conversation and its cheapest repair, and the repaired turns.

    ``messages`` has ``conv_id, turn, role, text``; a null role or text counts
    as one space, further columns are not read.  The first table has ``conv,
    conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit`` for each
    conversation with rows, those without an id together; ``conv`` is the id as
    text, one space for null.  The second has ``conv, conv_id, position, role,
    text``: the turns left, from position 0, each conversation's in order in one
    partition.  Rows follow by turn, null first, then by role and text.

    A row is blank if it has no character but ASCII white space, else a
    duplicate if an earlier row says the same in the same role, else truncated
    if it does not end in ``.``, ``!`` or ``?``.  Blank rows and duplicates are
    deleted; a role whose first letter is not s, u or a cannot stay.  Of equally
    cheap repairs the one with the least audit is taken.  An empty table gives
    no rows.

    The turns of one conversation are written by one task, batch by batch; all
    else about a long one is spread over segments of ``SEGMENT`` rows.
    """
    rows = ordered_rows(messages)
    searched = _searched(_segments(rows))
    decided = _decided(searched)
    return saved(_findings(searched, decided)), _repaired(rows, decided)


def digests(turns: DataFrame) -> DataFrame:
    """``conv, repaired_sha256`` of the turns of :func:`repair`: the hash of ``role:text`` lines, newline between them."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, held = None, hashlib.sha256()
        for batch in batches:
            done: list[dict] = []
            for name, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv", "role", "text"))):
                if name != conv:
                    if conv is not None:
                        done.append({"conv": conv, "repaired_sha256": held.hexdigest()})
                    conv, held = name, hashlib.sha256(f"{role}:{text}".encode())
                else:
                    held.update(f"\n{role}:{text}".encode())
            if done:
                yield _batch(done, "conv string, repaired_sha256 string")
        if conv is not None:
            yield _batch([{"conv": conv, "repaired_sha256": held.hexdigest()}], "conv string, repaired_sha256 string")

    return turns.mapInArrow(tidy(digest), "conv string, repaired_sha256 string")
