"""Conversation structure repair: the cheapest edits that make turns alternate, by branch-and-bound.

A well-formed conversation is empty, or an optional system row followed by pairs of user and
assistant. Rows are kept (0), given another role (3), deleted (4; required for blank rows and for
copies of an earlier row), or rows without text are inserted (3); a truncated row that is not
deleted adds 3. Of the cheapest edits, those whose initials (D, I, K, R) are least in ASCII win.

The search goes depth first over an explicit stack of prefixes. A suffix bound (the least cost of
the rows that are left, from the role that has to follow) cuts prefixes that cannot reach the
incumbent, and a table per node (row, role that has to follow) drops every prefix that is no better
than one that came there before. What is popped comes in ASCII order, so of two prefixes of equal
cost the later is the greater; when the stack is empty the incumbent is proved to be the optimum.

Two passes, each with one shuffle by conversation. The first moves a few bytes a row (no texts) and
returns one plan a conversation. The second sends each plan ahead of its texts and streams both, so
a task holds a character and a checksum a row of one conversation, never its texts. Order inside a conversation
is the work itself, so a conversation is not split; sorting spills.

Defined results: null ids form one conversation; null roles and texts read as one space; rows go by
turn (nulls first), then by a checksum of role and text; roles count by their first letter, others
than s, u and a fit nowhere; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidegrid.llm.storage import small_batches, staged

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
BLANKS = r"\x20\x09-\x0D"

#: What may follow: nothing so far, after a system row, after a user row, after an assistant row.
START, SYSTEM, USER, PAIR = range(4)
#: The role that an inserted row or a changed one takes, and where it leads.
WANTED = ("u", "u", "a", "u")
AFTER = {"s": SYSTEM, "u": USER, "a": PAIR}
ROLES = {"u": "user", "a": "assistant"}

#: Rows of a conversation in one character each: role (s, u, a or -), in upper case if truncated; x has to go.
Codes = Sequence[str]


def fits(state: int, role: str) -> bool:
    return role == WANTED[state] or (role == "s" and state == START)


def edits(state: int, code: str) -> list[tuple[str, int, int]]:
    """Letter, cost and next state of every edit of a row."""
    if code == "x":
        return [("D", DELETE, state)]
    role, more = code.lower(), TRUNCATED if code != code.lower() or code == "+" else 0
    out = [("D", DELETE, state)]
    if fits(state, role):
        out.append(("K", KEEP + more, AFTER[role]))
    if role != WANTED[state]:
        out.append(("R", REROLE + more, AFTER[WANTED[state]]))
    return out


TABLE = {(state, code): edits(state, code) for state in range(4) for code in "suaSUA-+x"}


def suffix_bounds(codes: Codes) -> list[tuple[int, int, int, int]]:
    """For every row and state the least cost of all that follows, letters left out of it."""

    def with_inserts(begin: int, system: int, user: int, pair: int) -> tuple[int, int, int, int]:
        user, pair = min(user, pair + INSERT), min(pair, user + INSERT)
        return min(begin, user + INSERT), min(system, user + INSERT), user, pair

    far = 1 << 60
    bounds = [with_inserts(0, far, far, 0)]
    for code in reversed(codes):
        after = bounds[-1]
        bounds.append(with_inserts(*[min(cost + after[to] for _, cost, to in TABLE[state, code]) for state in range(4)]))
    bounds.reverse()
    return bounds


def cheapest(codes: Codes) -> tuple[int, str]:
    """Cost and initials of the cheapest edits; of equal ones the least initials."""
    n, bounds = len(codes), suffix_bounds(codes)
    best, audit = 1 << 62, ""
    reached: list[list[int | None]] = [[None] * 4 for _ in range(n + 1)]
    path: list[str] = []
    stack = [(0, START, 0, 0, "")]
    while stack:
        row, state, cost, depth, letter = stack.pop()
        if cost + bounds[row][state] >= best:
            continue  # no better than the incumbent, and later in the order of letters
        before = reached[row][state]
        if before is not None and before <= cost:
            continue  # a prefix that came here before costs no more, and its letters are less
        reached[row][state] = cost
        del path[max(depth - 1, 0) :]
        if letter:
            path.append(letter)
        if row == n and state in (START, PAIR):
            best, audit = cost, "".join(path)
            continue
        nexts = [("I", INSERT, AFTER[WANTED[state]], row)]
        if row < n:
            nexts += [(name, more, to, row + 1) for name, more, to in TABLE[state, codes[row]]]
        for name, more, to, at in sorted(nexts, reverse=True):
            if cost + more + bounds[at][to] < best:
                stack.append((at, to, cost + more, depth + 1, name))
    return best, audit


def with_order(rows: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """``_conv, _turn, _role, _text, _sum``: nulls read, with a checksum of role and text."""
    read = rows.select(
        F.col(conv_id).alias("_conv"),
        F.col(turn).cast("long").alias("_turn"),
        F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("_role"),
        F.coalesce(F.col(text).cast("string"), F.lit(" ")).alias("_text"),
    )
    return read.withColumn("_sum", F.unhex(F.md5(F.concat_ws("\x00", "_role", "_text"))))


SUMMARY = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def repair_plans(
    rows: DataFrame, everyone: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row for each conversation of ``everyone``: gaps, faults, illegal neighbours, cost and audit.

    ``everyone`` holds the ids to report, with repeats; one without rows has zeros and an empty audit.
    """
    read = with_order(rows, conv_id, turn, role, text)
    blank = ~F.col("_text").rlike(f"[^{BLANKS}]")
    cut = ~F.col("_text").rlike(rf"[.!?][{BLANKS}]*\z")
    initial = F.substring("_role", 1, 1)
    facts = read.select(
        "_conv",
        F.lit(1).alias("_kind"),
        "_turn",
        "_sum",
        F.when(initial.isin("s", "u", "a"), initial).otherwise("-").alias("_initial"),
        F.when(blank, "b").when(cut, "t").otherwise("").alias("_fault"),
    )
    ids = everyone.select(F.col(conv_id).alias("_conv")).distinct()
    nothing = [F.lit(None).cast(facts.schema[c].dataType).alias(c) for c in facts.columns[2:]]
    both = facts.unionByName(ids.select("_conv", F.lit(0).alias("_kind"), *nothing))
    schema = T.StructType([rows.select(conv_id).schema[0]])
    for name in SUMMARY:
        schema = schema.add(name, "long")
    schema = schema.add("audit", "string")
    names = schema.names

    def planned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[list] = [[] for _ in names]
        now = Facts()

        def close() -> None:
            for column, value in zip(found, now.result(), strict=True):
                column.append(value)

        for batch in batches:
            for conv, kind, at, checksum, first, fault in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if kind == 0:  # comes first in every conversation
                    if now.begun:
                        close()
                    now = Facts(conv, True)
                else:
                    now.add(at, checksum, first, fault)
            if len(found[0]) > 1000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(found, kinds, strict=True)], names)
                for column in found:
                    column.clear()
        if now.begun:
            close()
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(found, kinds, strict=True)], names)

    kinds = arrow_types(schema)
    dealt = both.repartition("_conv").sortWithinPartitions("_conv", "_kind", "_turn", "_sum")
    return dealt.mapInArrow(planned, schema)


def arrow_types(schema: T.StructType) -> list[pa.DataType]:
    return to_arrow_schema(schema).types


class Facts:
    """What is known of the conversation so far: a character and a checksum a row, never a text."""

    def __init__(self, conv: object = None, begun: bool = False) -> None:
        self.conv, self.begun = conv, begun
        self.codes: list[str] = []
        self.seen: set[bytes] = set()
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first_turn: int | None = None
        self.last_turn: int | None = None
        self.last = ""

    def add(self, turn: int | None, checksum: bytes, initial: str, fault: str) -> None:
        if self.last and self.last + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.last = initial
        if turn is not None and turn != self.last_turn:
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
            self.turns += 1
        if fault == "b":
            self.blank += 1
            code = "x"
        elif checksum in self.seen:
            self.duplicate += 1
            code = "x"
        elif fault == "t":
            self.truncated += 1
            code = "+" if initial == "-" else initial.upper()
        else:
            code = initial
        self.seen.add(checksum)
        self.codes.append(code)

    def result(self) -> list:
        gaps = 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.turns
        cost, audit = cheapest(self.codes)
        return [self.conv, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit]


def repaired_rows(
    rows: DataFrame, plans: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """The repaired conversations: id, place (from 0), edit (K, R or I), role and text.

    Rows of a conversation come in order and in one partition. Plans travel ahead of their rows.
    """
    read = with_order(rows, conv_id, turn, role, text).select(
        "_conv", F.lit(1).alias("_kind"), "_turn", "_sum", F.lit(None).cast("string").alias("_audit"), "_role", "_text"
    )
    ahead = plans.select(
        F.col(conv_id).alias("_conv"),
        F.lit(0).alias("_kind"),
        F.lit(None).cast("long").alias("_turn"),
        F.lit(None).cast("binary").alias("_sum"),
        F.col("audit").alias("_audit"),
        F.lit(None).cast("string").alias("_role"),
        F.lit(None).cast("string").alias("_text"),
    )
    schema = T.StructType([rows.select(conv_id).schema[0]]).add("place", "long").add("edit", "string").add("role", "string").add("text", "string")
    kinds, names = arrow_types(schema), schema.names
    small_batches(rows.sparkSession)

    def repaired(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, audit, at, place, state = None, "", 0, 0, START
        out: list[tuple] = []

        def inserts() -> None:
            nonlocal at, place, state
            while at < len(audit) and audit[at] == "I":
                wanted = WANTED[state]
                out.append((conv, place, "I", ROLES[wanted], ""))
                at, place, state = at + 1, place + 1, AFTER[wanted]

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in (0, 1, 4, 5, 6)]
            for now, kind, plan, said_by, said in zip(*columns, strict=True):
                if kind == 0:
                    inserts()  # at the end of the conversation before
                    conv, audit, at, place, state = now, plan, 0, 0, START
                    continue
                inserts()
                edit, at = audit[at], at + 1
                if edit == "D":
                    continue
                initial = said_by[:1] if edit == "K" else WANTED[state]
                out.append((conv, place, edit, said_by if edit == "K" else ROLES[initial], said))
                place, state = place + 1, AFTER[initial]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names)
                out.clear()
        inserts()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names)

    dealt = read.unionByName(ahead).repartition("_conv").sortWithinPartitions("_conv", "_kind", "_turn", "_sum")
    return dealt.mapInArrow(repaired, schema)


def checksums(repaired: DataFrame, conv_id: str = "conv_id") -> DataFrame:
    """``repaired_sha256`` of ``role:text`` lines of every conversation that has a repaired row.

    Reads the rows as ``repaired_rows`` returns them, partition by partition and in order.
    """
    schema = T.StructType([repaired.select(conv_id).schema[0]]).add("repaired_sha256", "string")
    kinds, names = arrow_types(schema), schema.names

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, running, done = None, None, []
        for batch in batches:
            for now, place, role, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if place == 0:
                    if running is not None:
                        done.append((conv, running.hexdigest()))
                    conv, running = now, hashlib.sha256()
                else:
                    running.update(b"\n")
                running.update(f"{role}:{text}".encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), kinds, strict=True)], names)
                done.clear()
        if running is not None:
            done.append((conv, running.hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), kinds, strict=True)], names)

    return repaired.select(conv_id, "place", "role", "text").mapInArrow(hashed, schema)


def repair(
    rows: DataFrame, everyone: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """Plans (staged) and the repaired rows."""
    plans = staged(repair_plans(rows, everyone, conv_id, turn, role, text))
    return plans, repaired_rows(rows, plans, conv_id, turn, role, text)


def damaged(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Conversations with planted faults, told by a checksum of id and turn: see the query.

    Of 20 remainders, 0 drops the row, 1 empties its text, 2 takes its sentence ends, 3 repeats it
    and 4 makes it the user's; nulls read as one space.
    """
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col(conv_id).cast("string"), blank), F.lit(":"), F.coalesce(F.col(turn).cast("string"), blank))
    part = F.crc32(key.cast("binary")) % 20
    read = rows.select(
        conv_id,
        turn,
        F.coalesce(F.col(role), blank).alias(role),
        F.coalesce(F.col(text), blank).alias(text),
        part.alias("_part"),
    ).where("_part <> 0")
    words = F.when(F.col("_part") == 1, "").when(F.col("_part") == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(F.col(text))
    copies = F.when(F.col("_part") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return read.select(
        conv_id,
        turn,
        F.when(F.col("_part") == 4, "user").otherwise(F.col(role)).alias(role),
        words.alias(text),
        F.explode(copies).alias("_copy"),
    ).drop("_copy")
