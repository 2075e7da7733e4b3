"""Repair of conversation structure by depth-first branch and bound.

A repaired conversation is empty, or an optional system turn followed by pairs of user and assistant. Each row may be
kept (K, costs 0), given the other role (R, 1) or deleted (D, 2); an empty turn may be inserted anywhere (I, 5). Blank
rows and rows seen earlier must go, truncated rows that stay cost 5 more. Of the cheapest edits those whose letters come
first in ASCII are taken; they settle the result, because the grammar leaves each place one role to be given.

The search has an explicit stack. A node is a row and a state of the grammar; from every node the cost of the cheapest
way to the end, whatever its letters, is the lower bound of the rest. Children are tried in the order of their letters,
so complete edits are met in ASCII order, and of two prefixes of equal cost the one met first is the smaller: a prefix
is cut where its bound exceeds the cost of the best known edits (at first, those of a dive along the bounds), where an
incumbent of that cost was met before, or where its node was reached before at no higher cost (the dominance table).
An empty stack proves the incumbent.

Rows are range-partitioned and sorted by conversation and turn, so that a conversation of any size is spread. One that
lies whole inside a partition and within ``ROWS`` and ``BYTES`` is solved as it streams by. Others are cut into pieces
within these bounds; for every piece the search runs from each state to each state, and the results are chained per
conversation, which is the same least (cost, letters), since the letters of equal cost for the same rows are never a
prefix of one another. First occurrences of a role and text are found for them by an aggregation.

Defined results: null roles and texts are one space; rows with a null turn come first; rows of one turn are ordered by
role, the text's first 200 characters and its hash; a role whose first character is not s, u or a, or that is empty,
cannot be kept; null conv_ids are one conversation; repeated rows are duplicates; a conversation whose rows are all
``gone`` has zeros and no letters; empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from uptake.llm.common import shuffle_parts
from uptake.session import materialize

ROWS, BYTES = 2000, 8_000_000  #: most rows, and bytes of text, of a piece
SPACE = " \t\n\v\f\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5

#: states of the grammar: nothing yet, after the system turn, after a user's, after an assistant's turn
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
STEP = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
GIVEN = (USER, USER, ASSISTANT, USER)  #: state after the turn that an insertion or a new role gives
ROLE = {USER: "user", ASSISTANT: "assistant"}
ENDS = (START, ASSISTANT)
NEVER = 1 << 60

#: Arrow types of the columns that Python steps return
ARROW = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(),
         "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}


def arrow_schema(ddl: str) -> pa.Schema:
    """Arrow schema of a DDL string, also on executors."""
    return pa.schema([(name, ARROW[kind]) for name, kind in (c.split() for c in ddl.split(","))])


Move = tuple[str, bool, int]  #: a row to the search: initial of its role, whether it must go, cost if it stays


def _bounds(rows: list[Move], ends) -> list[list[int]]:
    """Cost of the cheapest way from each row and state to the end."""
    out = [[]] * (len(rows) + 1)
    for at in range(len(rows), -1, -1):
        if at == len(rows):
            here = [0 if s in ends else NEVER for s in STATES]
        else:
            initial, must_go, extra = rows[at]
            rest = out[at + 1]
            here = [DELETE + c for c in rest]
            if not must_go:
                for s in STATES:
                    here[s] = min(here[s], REROLE + extra + rest[GIVEN[s]])
                    if initial in STEP[s]:
                        here[s] = min(here[s], KEEP + extra + rest[STEP[s][initial]])
        for _ in range(3):  # as many insertions as lead from any state to any other that they can reach
            for s in STATES:
                here[s] = min(here[s], INSERT + here[GIVEN[s]])
        out[at] = here
    return out


def _children(rows: list[Move], at: int, state: int) -> list[tuple[str, int, int, int]]:
    """Edits at a node in the order of their letters: (letter, cost, row, state)."""
    out = []
    if at < len(rows):
        initial, must_go, extra = rows[at]
        out.append(("D", DELETE, at + 1, state))
        out.append(("I", INSERT, at, GIVEN[state]))
        if not must_go:
            if initial in STEP[state]:
                out.append(("K", KEEP + extra, at + 1, STEP[state][initial]))
            out.append(("R", REROLE + extra, at + 1, GIVEN[state]))
    else:
        out.append(("I", INSERT, at, GIVEN[state]))
    return out


def search(rows: list[Move], start: int = START, ends=ENDS) -> tuple[int, str] | None:
    """The least ``(cost, letters)`` that lead from a state to one of ``ends``, or None if none do."""
    bound = _bounds(rows, ends)
    if bound[0][start] >= NEVER:
        return None
    # the dive: from each node the child with the least bound; its cost is known before its letters are
    limit, at, state = 0, 0, start
    while at < len(rows) or state not in ends:
        letter, cost, at_next, state_next = min(
            _children(rows, at, state), key=lambda c: c[1] + bound[c[2]][c[3]])
        limit, at, state = limit + cost, at_next, state_next
    incumbent = None
    reached: dict[tuple[int, int], int] = {}
    stack = [(0, start, 0, None)]
    while stack:
        at, state, cost, path = stack.pop()
        low = cost + bound[at][state]
        if low > limit or (incumbent is not None and low >= limit) or reached.get((at, state), NEVER) <= cost:
            continue
        reached[at, state] = cost
        if at == len(rows) and state in ends:
            limit, incumbent = cost, path
            continue
        for letter, more, at_next, state_next in reversed(_children(rows, at, state)):
            stack.append((at_next, state_next, cost + more, (letter, path)))
    letters = []
    while incumbent is not None:
        letter, incumbent = incumbent
        letters.append(letter)
    return limit, "".join(reversed(letters))


def replay(rows: list[tuple[str, str]], letters: str, start: int = START) -> list[tuple[str, str]]:
    """The rows ``(role, text)`` after edits."""
    out, at, state = [], 0, start
    for letter in letters:
        if letter == "I":
            state = GIVEN[state]
            out.append((ROLE[state], ""))
            continue
        role, text = rows[at]
        at += 1
        if letter == "K":
            state = STEP[state][role[:1]]
            out.append((role, text))
        elif letter == "R":
            state = GIVEN[state]
            out.append((ROLE[state], text))
    return out


def _illegal(initials: list[str]) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


def _whole(rows: list[tuple]) -> tuple:
    """Report and repaired rows of one conversation, from all its rows ``(turn, role, text, gone)`` in order."""
    rows = [r for r in rows if not r[3]]
    turns = {r[0] for r in rows if r[0] is not None}
    seen, moves, counts = set(), [], [0, 0, 0]
    for _, role, text, _ in rows:
        body = text.strip(SPACE)
        fault = 0 if not body else 1 if (role, text) in seen else 2 if body[-1] not in ".!?" else None
        seen.add((role, text))
        if fault is not None:
            counts[fault] += 1
        moves.append((role[:1], fault in (0, 1), TRUNCATED if fault == 2 else 0))
    cost, letters = search(moves)
    fixed = replay([r[1:3] for r in rows], letters)
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return (gaps, *counts, _illegal([m[0] for m in moves]), cost, letters, [r for r, _ in fixed], [t for _, t in fixed])


REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
SOLVED = f"conv_id long, {REPORT}, roles array<string>, texts array<string>"
PIECE_ROW = "turn long, role string, text string, gone boolean, pos long, piece long"


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Solves the conversations that lie whole in a sorted partition; rows of others are handed on in pieces."""
    schema = arrow_schema(f"{SOLVED}, {PIECE_ROW}")
    none = object()
    conv, held, size, edge, at, out, out_size = none, [], 0, True, 0, [], 0

    def solved():
        return (conv, *_whole(held), *[None] * 6)

    def pieces():
        place = part << 40
        first = place + at - len(held)
        return [(conv, *[None] * 9, *r, first + i, first) for i, r in enumerate(held)]

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    for batch in batches:
        for lo in range(0, batch.num_rows, 500):
            for c, turn, role, text, gone, part in zip(*(col.to_pylist() for col in batch.slice(lo, 500).columns)):
                if conv is not none and c != conv:
                    out += pieces() if edge else [solved()]
                    # a conversation begins inside the partition, all of it can lie here
                    held, size, edge = [], 0, False
                elif len(held) >= ROWS or size >= BYTES:
                    out += pieces()
                    held, size, edge = [], 0, True
                conv = c
                held.append((turn, role, text, gone))
                size += len(text)
                out_size += len(text)
                at += 1
                if out_size >= BYTES and out:
                    yield batch_of(out)
                    out, out_size = [], size
    if conv is not none:
        out += pieces()  # the last one may go on in the next partition
    if out:
        yield batch_of(out)


def _piece_table(table: pa.Table) -> pa.Table:
    """Counts of one piece, and for every pair of states the least cost and letters that lead from one to the other."""
    table = table.sort_by("pos")
    rows = table.to_pylist()
    moves = [(r["initial"], r["blank"] or r["seen"], 0 if r["blank"] or r["seen"] or not r["open"] else TRUNCATED) for r in rows]
    ways = [search(moves, s, (e,)) for s in STATES for e in STATES]
    initials = [m[0] for m in moves]
    got = {
        "conv_id": [rows[0]["conv_id"]], "piece": [rows[0]["piece"]],
        "blank": [sum(r["blank"] for r in rows)], "duplicate": [sum(r["seen"] and not r["blank"] for r in rows)],
        "truncated": [sum(m[2] > 0 for m in moves)], "illegal": [_illegal(initials)], "first": [initials[0]], "last": [initials[-1]],
        "costs": [[NEVER if w is None else w[0] for w in ways]], "letters": [["" if w is None else w[1] for w in ways]]}
    return pa.Table.from_pydict(got, schema=arrow_schema(WAYS))


WAYS = ("conv_id long, piece long, blank long, duplicate long, truncated long, illegal long, first string, last string, "
        "costs array<long>, letters array<string>")
CHAIN = f"conv_id long, piece long, state int, letters string, leads boolean, {REPORT.replace('gaps long, ', '')}"


def _letters(path) -> str:
    out = []
    while path is not None:
        out.append(path[2])
        path = path[0]
    return "".join(reversed(out))


def _chain(table: pa.Table) -> pa.Table:
    """Chains the pieces of one conversation: the letters of each piece and the state it starts from."""
    pieces = table.sort_by("piece").to_pylist()
    best = {START: (0, None)}  # state -> (cost, path of (path before, state before, letters))
    for p in pieces:
        after: dict[int, tuple] = {}
        for s, (cost, path) in best.items():
            for e in STATES:
                c = cost + p["costs"][4 * s + e]
                if c >= NEVER:
                    continue
                way = (c, (path, s, p["letters"][4 * s + e]))
                if e not in after or c < after[e][0] or (c == after[e][0] and _letters(way[1]) < _letters(after[e][1])):
                    after[e] = way
        best = after
    cost, path = min(((c, p) for s, (c, p) in best.items() if s in ENDS), key=lambda w: (w[0], _letters(w[1])))
    steps = []
    while path is not None:
        path, state, letters = path
        steps.append((state, letters))
    steps.reverse()
    joints = sum(a["last"] + b["first"] not in ("su", "ua", "au") for a, b in zip(pieces, pieces[1:]))
    sums = [sum(p[c] for p in pieces) for c in ("blank", "duplicate", "truncated", "illegal")]
    audit = "".join(w for _, w in steps)
    rows = [(p["conv_id"], p["piece"], s, w, i == 0, *(sums[:3] if i == 0 else [0] * 3), sums[3] + joints if i == 0 else 0,
             cost if i == 0 else 0, audit if i == 0 else "") for i, (p, (s, w)) in enumerate(zip(pieces, steps))]
    schema = arrow_schema(CHAIN)
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


FIXED = "conv_id long, piece long, roles array<string>, texts array<string>"


def _apply(rows: pa.Table, step: pa.Table) -> pa.Table:
    """The repaired rows of one piece."""
    r, s = rows.sort_by("pos").to_pylist(), step.to_pylist()[0]
    fixed = replay([(x["role"], x["text"]) for x in r], s["letters"], s["state"])
    return pa.Table.from_pydict({"conv_id": [s["conv_id"]], "piece": [s["piece"]], "roles": [[a for a, _ in fixed]],
                                 "texts": [[b for _, b in fixed]]}, schema=arrow_schema(FIXED))


def repair(rows: DataFrame, gone: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Repairs conversations (``conv_id``, ``turn``, ``role``, ``text``).

    Rows for which ``gone`` holds only make their conversation known. Returns the report, one row per conversation:
    ``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit)``; and the repaired rows in pieces,
    ``(conv_id, piece, pieces, roles, texts)``: the roles and texts of a conversation in the order of ``piece``, most
    often in one.
    """
    spark = rows.sparkSession
    gone = F.coalesce(gone, F.lit(False)) if gone is not None else F.lit(False)
    text_or = lambda c: F.when(gone, F.lit("")).otherwise(F.coalesce(F.col(c).cast("string"), F.lit(" "))).alias(c)
    rows = rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), text_or("role"), text_or("text"), gone.alias("gone"))
    keys = ["conv_id", "turn", "role", F.left("text", F.lit(200)), F.xxhash64("text")]
    laid = (rows.repartitionByRange(shuffle_parts(spark), *keys, F.monotonically_increasing_id())
            .sortWithinPartitions(*keys, "text").withColumn("part", F.spark_partition_id().cast("long")))
    done = materialize(laid.mapInArrow(_stream, f"{SOLVED}, {PIECE_ROW}"), "conversations")

    rest = done.where("piece is not null").select("conv_id", "turn", "role", "text", "gone", "pos", "piece")
    left = rest.where("not gone")
    # the first row of each role and text of a conversation, by its place, which no other row has
    firsts = left.groupBy("conv_id", "role", F.sha2("text", 256)).agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("opens"))
    body = F.regexp_replace("text", r"[\x20\x09-\x0D]+$", "")
    marks = left.select("conv_id", "piece", "pos", F.left("role", F.lit(1)).alias("initial"), (body == "").alias("blank"),
                        (~F.right(body, F.lit(1)).isin(".", "!", "?")).alias("open"))
    marks = marks.join(firsts, "pos", "left").withColumn("seen", F.col("opens").isNull()).drop("opens")
    chain = materialize(marks.groupBy("piece").applyInArrow(_piece_table, WAYS).groupBy("conv_id").applyInArrow(_chain, CHAIN), "conversation-pieces")
    spans = rest.groupBy("conv_id").agg(
        *[f(F.when(~F.col("gone"), F.col("turn"))).alias(n) for f, n in ((F.min, "lo"), (F.max, "hi"), (F.count_distinct, "n"))])
    lead = chain.where("leads").withColumnRenamed("conv_id", "c")
    zero = F.lit(0).cast("long")
    long_report = spans.join(lead, spans["conv_id"].eqNullSafe(lead["c"]), "left").select(
        "conv_id", F.coalesce(F.col("hi") - F.col("lo") + 1 - F.col("n"), zero).alias("gaps"),
        *[F.coalesce(c, zero).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"))
    report = done.where("piece is null").select(long_report.columns).union(long_report)
    fixed = left.select("piece", "pos", "role", "text").groupBy("piece").cogroup(chain.groupBy("piece")).applyInArrow(_apply, FIXED)
    many = F.lit(2).alias("pieces")  # pieces of a cut conversation are brought together by those who need them so
    pieces = done.where("piece is null").select("conv_id", zero.alias("piece"), F.lit(1).alias("pieces"), "roles", "texts").union(
        fixed.select("conv_id", "piece", many, "roles", "texts"))
    return report, pieces


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the lines of each conversation, from its pieces in order."""
    schema = arrow_schema("conv_id long, sha string")
    none = object()
    conv, sha, empty, out = none, None, True, []
    for batch in batches:
        for at in range(batch.num_rows):
            c, lines = batch.column(0)[at].as_py(), batch.column(1)[at].as_py()
            if conv is none or c != conv:
                if conv is not none:
                    out.append((conv, sha.hexdigest()))
                conv, sha, empty = c, hashlib.sha256(), True
            for line in lines:
                sha.update(line.encode() if empty else b"\n" + line.encode())
                empty = False
    if conv is not none:
        out.append((conv, sha.hexdigest()))
    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [[], []], schema)], schema=schema)


def digests(pieces: DataFrame) -> DataFrame:
    """Per conversation the SHA-256 of its repaired ``role:text`` lines: ``(conv_id, sha)``.

    A conversation of several pieces is streamed through one task in their order (the digest of a text has no other
    way), which holds one piece of it at a time.
    """
    lines = F.zip_with("roles", "texts", lambda r, t: F.concat(r, F.lit(":"), t))
    one = pieces.where("pieces = 1").select("conv_id", F.sha2(F.array_join(lines, "\n").cast("binary"), 256).alias("sha"))
    cut = (pieces.where("pieces > 1").select("conv_id", "piece", lines.alias("lines")).repartition("conv_id")
           .sortWithinPartitions("conv_id", "piece").select("conv_id", "lines").mapInArrow(_digest, "conv_id long, sha string"))
    return one.union(cut)


def damage(rows: DataFrame) -> DataFrame:
    """Rows of conversations, damaged by the CRC-32 of ``conv_id:turn`` modulo 20, with the column ``gone``.

    0 drops the row (it stays as ``gone``), 1 empties its text, 2 removes its full stops, exclamation and question marks,
    3 repeats it, 4 makes the user its role; nulls are one space.
    """
    word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(word("conv_id"), F.lit(":"), word("turn")).cast("binary")) % 20
    rows = rows.select("conv_id", "turn", word("role").alias("role"), word("text").alias("text"), kind.alias("kind"))
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"),
        (F.col("kind") == 0).alias("gone"), F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == 3, F.lit(2)).otherwise(F.lit(1)))).alias("copy")
    ).drop("copy")
