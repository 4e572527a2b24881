"""Repair of conversation structure: the cheapest edits that make roles read ``(s?(ua)+)?``, proved by branch-and-bound.

The search goes depth first over prefixes of edits with a stack of its own. A prefix is a node (rows consumed, state of the
pattern) with its cost and audit. What is still to come costs at least as much as on a simpler machine (``bounds``); a
prefix whose cost and that bound exceed the incumbent's (cost, audit) is dropped, and so is one that reaches a node no
better than the node's dominance table has it. When the stack is empty the
incumbent is optimal.

Rows are put in order over range partitions and searched in segments of at most ``segment`` rows, so a conversation of any
length is spread over tasks: a segment inside a longer conversation is solved from every state to every state, and the tables
are joined along the conversation. At equal cost no audit of a node is the beginning of another (it would hold fewer
inserts and cost less), so the least audit of each node is all that must be kept, between segments too.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged

BLANKS = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, CUT_SHORT = 0, 2, 3, 2, 1
#: States: nothing yet, after system, after user, after assistant. Where each role's turn leads.
USER, ASSISTANT, SYSTEM = {0: 2, 1: 2, 3: 2}, {2: 3}, {0: 1}
MOVES = [SYSTEM, USER, ASSISTANT, {}]
DONE = (0, 3)
ROLES = "sua"
LEGAL = {(0, 1), (1, 2), (2, 1)}
TRUNCATED, BLANK, DUPLICATE = 1, 2, 3
FAR = 1 << 60


# ---- search ----------------------------------------------------------------------------------------------------


def after(state: int) -> int:
    """The state after the one turn that a rerole or an insert can give in ``state``."""
    return USER.get(state) or ASSISTANT[state]


def options(code: int, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of the edits that consume a row; ``code`` is role + 4 * fault."""
    role, fault = code & 3, code >> 2
    found = [("D", DELETE, state)]
    if fault < BLANK:
        short = CUT_SHORT * (fault == TRUNCATED)
        if state in MOVES[role]:
            found.append(("K", KEEP + short, MOVES[role][state]))
        if MOVES[role].get(state) != after(state):  # else keeping does the same for less
            found.append(("R", REROLE + short, after(state)))
    return found


def bounds(codes: list[int], target: int | None) -> list[dict[int, int]]:
    """For each place and state, the least cost of the rest.

    Up to the end of the conversation state 1 counts as 3, as if a system turn could stand alone; with a ``target`` the
    states stay apart, since on such a machine a segment would seem to end after a system turn for next to nothing.
    """
    if target is None:
        apart, level = (0, 2, 3), {0: 0, 1: 0, 2: INSERT, 3: 0}
    else:
        apart, level = (0, 1, 2, 3), {q: 0 if q == target else FAR for q in range(4)}
    levels = [level]
    for code in reversed(codes):
        direct = {q: min(cost + level[p] for _, cost, p in options(code, q)) for q in apart}
        level = {q: min(direct[q], INSERT + direct[after(q)], 2 * INSERT + direct[after(after(q))]) for q in apart}
        level.setdefault(1, level[3])
        levels.append(level)
    return levels[::-1]


def search(codes: list[int], entry: int = 0, target: int | None = None) -> tuple[int, str] | None:
    """(cost, audit) of the cheapest edits from state ``entry``, of equal ones the ASCII-least; None where there are none.

    Without a ``target`` the conversation ends here, in a finished state, and turns may be inserted after the last row; with one the
    segment must end in that state.
    """
    n, least = len(codes), bounds(codes, target)
    best: tuple[int, str] | None = None
    table: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, entry, 0, "")]
    while stack:
        i, state, cost, audit = stack.pop()
        bound = cost + least[i][state]
        if bound >= FAR or best and (bound > best[0] or bound == best[0] and audit > best[1][: len(audit)]):
            continue
        seen = table.get((i, state))
        if seen and seen <= (cost, audit):
            continue
        table[i, state] = cost, audit
        if i == n and (state in DONE if target is None else state == target) and (best is None or (cost, audit) < best):
            best = cost, audit
        following = [(letter, c, i + 1, q) for letter, c, q in options(codes[i], state)] if i < n else []
        if i < n or target is None:
            following.append(("I", INSERT, i, after(state)))
        ranked = sorted((cost + c + least[j][q], letter, j, q, cost + c) for letter, c, j, q in following)
        stack += [(j, q, spent, audit + letter) for _, letter, j, q, spent in reversed(ranked)]
    return best


def segment_table(codes: list[int], last: bool) -> list[tuple[int, int, int, str]]:
    """(from, to, cost, audit) for every state a segment can be entered in; the last of a conversation ends it."""
    found = []
    for entry in range(4):
        for target in [None] if last else range(4):
            solved = search(codes, entry, target)
            if solved:
                found.append((entry, -1 if target is None else target, *solved))
    return found


def along(tables: list[list[tuple[int, int, int, str]]]) -> list[tuple[int, int, str]]:
    """(state at its start, cost, audit) of each segment, in order, on the cheapest way through all of them."""
    reached, steps = {0: (0, "")}, []
    for table in tables:
        now, came = {}, {}
        for entry, target, cost, audit in table:
            if entry in reached:
                whole = reached[entry][0] + cost, reached[entry][1] + audit
                if target not in now or whole < now[target]:
                    now[target], came[target] = whole, (entry, cost, audit)
        reached = now
        steps.append(came)
    state, out = -1, []
    for came in reversed(steps):
        out.append(came[state])
        state = came[state][0]
    return out[::-1]


def written(codes: list[int], entry: int, audit: str) -> list[tuple[str, str, str, str]]:
    """(letter, inserted before, role given, inserted after) for each row of a segment; roles as initials."""
    out, state, before = [], entry, ""
    for letter in audit:
        if letter == "D":
            out.append(("D", before, "", ""))
            before = ""
            continue
        role = codes[len(out)] & 3 if letter == "K" else 1 if state in USER else 2
        state = MOVES[role][state]
        if letter == "I":
            before += ROLES[role]
        else:
            out.append((letter, before, ROLES[role], ""))
            before = ""
    if before:
        out[-1] = (*out[-1][:3], before)
    return out


def illegal(roles: list[int]) -> int:
    return sum(pair not in LEGAL for pair in zip(roles, roles[1:]))


# ---- on Spark --------------------------------------------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` after damage that the row's id and turn decide; null roles, texts and keys read as one space."""

    def spaced(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), spaced("role").alias("role"), spaced("text").alias("text"))
    kind = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn"))) % 20
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    hit = rows.where(kind != 0).select("conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"), copies.alias("copy"))
    return hit.drop("copy")


def in_order(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with ``seq``, rising along each conversation, and the marks of each row.

    By turn, nulls first; rows of one turn by role, the first 64 characters, and a digest of the text. Rows are ranged, so a
    conversation may go on in another task; rows alike in all of that are dealt out by number.
    """
    stripped = F.rtrim("text", F.lit(BLANKS))
    role = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for p in (("s", 0), ("u", 1), ("a", 2)) for x in p]), F.left("role", F.lit(1))), F.lit(3))
    marked = rows.withColumns(
        {
            "head": F.left("text", F.lit(64)), "digest": F.unhex(F.sha2("text", 256)), "initial": role, "blank": stripped == "",
            "ended": F.right(stripped, F.lit(1)).isin(".", "!", "?"), "number": F.monotonically_increasing_id(),
        }
    )
    keys = ["conv_id", "turn", "role", "head", "digest"]
    ranged = marked.repartitionByRange(*keys, "number").sortWithinPartitions(*keys)
    return staged(ranged.select("conv_id", "turn", "role", "text", "digest", "initial", "blank", "ended", F.monotonically_increasing_id().alias("seq")), "repair-rows")


def coded(rows: DataFrame) -> DataFrame:
    """``conv_id, seq, code``: role + 4 * first fault. A row repeats when an earlier one has its role and text."""
    first = rows.groupBy("conv_id", "role", "digest").agg(F.min("seq").alias("first")).select("first")
    known = rows.select("conv_id", "seq", "initial", "blank", "ended").join(first, F.col("seq") == F.col("first"), "left")
    fault = F.when(F.col("blank"), BLANK).when(F.col("first").isNull(), DUPLICATE).when(~F.col("ended"), TRUNCATED).otherwise(0)
    return known.select("conv_id", "seq", (F.col("initial") + 4 * fault).alias("code"))


SOLVED = (
    "conv_id long, block long, blocks long, seqs array<long>, codes array<int>, table array<struct<entry:int,target:int,cost:long,audit:string>>, "
    "entry int, cost long, audit string, illegal long"
)


def _solve(batches):
    for batch in batches:
        rows = []
        for conv, block, blocks, last, pairs in zip(*[c.to_pylist() for c in batch.columns]):
            codes = [p["code"] for p in pairs]
            row = {"conv_id": conv, "block": block, "blocks": blocks, "seqs": [p["seq"] for p in pairs], "codes": codes}
            row |= {"illegal": illegal([c & 3 for c in codes]), "table": [], "entry": 0, "cost": None, "audit": None}
            if blocks == 1:
                row["cost"], row["audit"] = search(codes)
            else:
                names = ("entry", "target", "cost", "audit")
                row["table"] = [dict(zip(names, t)) for t in segment_table(codes, block == last)]
            rows.append(row)
        yield pa.RecordBatch.from_pylist(rows, SCHEMA)


SCHEMA = pa.schema(
    [
        ("conv_id", pa.int64()), ("block", pa.int64()), ("blocks", pa.int64()), ("seqs", pa.list_(pa.int64())), ("codes", pa.list_(pa.int32())),
        ("table", pa.list_(pa.struct([("entry", pa.int32()), ("target", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))),
        ("entry", pa.int32()), ("cost", pa.int64()), ("audit", pa.string()), ("illegal", pa.int64()),
    ]
)


def _join_segments(group: pa.Table) -> pa.Table:
    rows = sorted(group.to_pylist(), key=lambda r: r["block"])
    ways = along([[(t["entry"], t["target"], t["cost"], t["audit"]) for t in r["table"]] for r in rows])
    for i, (row, (entry, cost, audit)) in enumerate(zip(rows, ways)):
        row |= {"entry": entry, "cost": cost, "audit": audit, "table": []}
        if i:
            row["illegal"] += illegal([rows[i - 1]["codes"][-1] & 3, row["codes"][0] & 3])
    return pa.Table.from_pylist(rows, SCHEMA)


def solved_segments(codes: DataFrame, segment: int) -> DataFrame:
    """One row a segment: its rows, the state it is entered in, its part of the cheapest edits and their cost.

    Only the tables of conversations with several segments meet by conversation: a few bytes a row, as their audit does.
    """
    cut = codes.withColumn("block", F.expr(f"seq div {segment}"))
    parts = cut.groupBy("conv_id", "block").agg(F.sort_array(F.collect_list(F.struct("seq", "code"))).alias("pairs"))  # ``segment`` rows at most
    blocks = cut.groupBy(F.col("conv_id").alias("own"), F.col("block").alias("own_block")).agg(F.lit(1)).groupBy("own").agg(F.count("*").alias("blocks"), F.max("own_block").alias("last"))
    each = parts.join(blocks, F.col("conv_id").eqNullSafe(F.col("own"))).select("conv_id", "block", "blocks", "last", "pairs")
    solved = staged(each.mapInArrow(_solve, SOLVED), "repair-segments")
    several = solved.where("blocks > 1").groupBy("conv_id").applyInArrow(_join_segments, SOLVED)
    return staged(solved.where("blocks = 1").unionByName(several), "repair-solved")


def edits(solved: DataFrame) -> DataFrame:
    """``seq, edit, before, given, after`` of every row: its letter, the lines inserted around it, and its role's initial."""
    names = {"u": "user:", "a": "assistant:"}

    def run(batches):
        for batch in batches:
            rows = []
            for seqs, codes, entry, audit in zip(*[c.to_pylist() for c in batch.columns]):
                rows += [(s, *w) for s, w in zip(seqs, written(codes, entry, audit))]
            seq, edit, before, given, after = list(zip(*rows)) or [[]] * 5
            lines = [pa.array([[names[c] for c in turns] for turns in column], pa.list_(pa.string())) for column in (before, after)]
            yield pa.RecordBatch.from_arrays([pa.array(seq, pa.int64()), pa.array(edit, pa.string()), lines[0], pa.array(given, pa.string()), lines[1]], ["seq", "edit", "before", "given", "after"])

    return solved.select("seqs", "codes", "entry", "audit").mapInArrow(run, "seq long, edit string, before array<string>, given string, after array<string>")


def repaired_rows(rows: DataFrame, solved: DataFrame) -> DataFrame:
    """``conv_id, seq, turn, edit, lines``: the lines ``role:text`` that stand in a row's place, inserted turns with it."""
    role = F.when(F.col("edit") == "K", F.col("role")).when(F.col("given") == "u", F.lit("user")).otherwise(F.lit("assistant"))
    own = F.when(F.col("edit") != "D", F.array(F.concat(role, F.lit(":"), F.col("text")))).otherwise(F.array().cast("array<string>"))
    both = rows.select("conv_id", "seq", "turn", "role", "text").join(edits(solved), "seq")
    return both.select("conv_id", "seq", "turn", "edit", F.concat("before", own, "after").alias("lines"))


def digests(repaired: DataFrame) -> DataFrame:
    """``conv_id, sha``: SHA-256 of a conversation's lines, newline-joined. A digest is taken in order, so a conversation's
    lines pass through one task, but as a stream sorted on disk: no conversation is held in memory."""

    def run(batches):
        none = object()
        conv, state, some = none, None, False
        for batch in batches:
            done = []
            for own, line in zip(batch.column("conv_id").to_pylist(), batch.column("line").to_pylist()):
                if own != conv or conv is none:
                    if conv is not none:
                        done.append((conv, state.hexdigest()))
                    conv, state, some = own, hashlib.sha256(), False
                state.update((b"\n" if some else b"") + line.encode())
                some = True
            yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in done], pa.int64()), pa.array([s for _, s in done], pa.string())], ["conv_id", "sha"])
        if conv is not none:
            yield pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array([state.hexdigest()], pa.string())], ["conv_id", "sha"])

    lines = repaired.select("conv_id", "seq", F.posexplode("lines").alias("nth", "line"))
    return lines.repartition("conv_id").sortWithinPartitions("conv_id", "seq", "nth").select("conv_id", "line").mapInArrow(run, "conv_id long, sha string")


def repair(rows: DataFrame, segment: int = 1024) -> tuple[DataFrame, DataFrame]:
    """(repaired rows, one summary row a conversation) of ``conv_id, turn, role, text``.

    A role counts by its first letter; one that is not s, u or a, or is empty, fits nowhere and must be changed or deleted.
    A row's first fault counts: blank, repeat of an earlier row's role and text, last character not one of ``.!?``. Rows without
    a conversation are one conversation. Rows of one turn stand by role, then text. An empty table gives empty results.
    """
    placed = in_order(rows)
    solved = solved_segments(coded(placed), segment)
    repaired = repaired_rows(placed, solved)

    def count(fault: int) -> Column:
        return F.size(F.filter("codes", lambda c: F.shiftright(c, 2) == fault)).cast("long")

    faults = {"blank": count(BLANK), "duplicate": count(DUPLICATE), "truncated": count(TRUNCATED)}
    in_turn = F.sort_array(F.collect_list(F.struct("block", "audit")))
    summary = solved.withColumns(faults).groupBy("conv_id").agg(
        *[F.sum(c).alias(c) for c in (*faults, "illegal", "cost")], F.array_join(F.transform(in_turn, lambda p: p["audit"]), "").alias("audit")
    )
    turns = placed.where("turn is not null").groupBy("conv_id", "turn").agg(F.lit(1)).groupBy("conv_id").agg(F.max("turn").alias("most"), F.min("turn").alias("least"), F.count("*").alias("turns"))
    gaps = turns.select("conv_id", (F.col("most") - F.col("least") + 1 - F.col("turns")).alias("gaps"))
    return repaired, _merged([summary, gaps, digests(repaired)])


def _merged(parts: list[DataFrame]) -> DataFrame:
    """One row a conversation from tables with one row a conversation each, in one shuffle."""
    both = parts[0]
    for part in parts[1:]:
        both = both.unionByName(part, allowMissingColumns=True)
    return both.groupBy("conv_id").agg(*[F.max(c).alias(c) for c in both.columns if c != "conv_id"])


def repaired_conversations(conversations: DataFrame, segment: int = 1024) -> DataFrame:
    """Every ``conv_id`` of the table with what ``repair`` finds after ``damaged``; zeros where no row or known turn is left."""
    _, summary = repair(damaged(conversations), segment)
    everyone = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    found = _merged([summary, everyone])
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    nothing = hashlib.sha256().hexdigest()
    return found.select(
        "conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in numbers], F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha", F.lit(nothing)).alias("repaired_sha256")
    )
