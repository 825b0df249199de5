"""Cheapest repair of conversations whose turns are broken."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from os.path import commonprefix

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from labelflow.llm.common import text_batches
from labelflow.storage import materialise

#: Rows, and characters, of a block: a stretch of one conversation that is solved at once.
BLOCK_ROWS, BLOCK_CHARS = 4096, 1 << 20
#: White space, and the marks that end a complete text.
SPACE, COMPLETE = " \t\n\x0b\x0c\r", ".!?"
#: What a kept row may begin with in each state, and the state it leads to. States:
#: nothing yet, after a system row, after a user row, after an assistant row.
KEPT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
#: The state behind a rewritten or inserted row, and the role of such a row.
NEXT, ROLE = (2, 2, 3, 2), ("user", "user", "assistant", "user")
ENDS = (0, 3)
STATES = range(4)
LEGAL = {"su", "ua", "au"}
_BASE, _PRIME = 1_000_003, (1 << 61) - 1


class Edits:
    """Sequences of edits that share their beginnings.

    A node is a sequence: the one of its parent and one edit. It knows its
    length, a rolling hash and its ancestors 1, 2, 4, 8, ... edits back, so two
    sequences are compared by a search for their longest common beginning.
    """

    def __init__(self):
        self.edit, self.length, self.hash = [""], [0], [0]
        self.up: list[list[int]] = [[]]

    def child(self, node: int, edit: str) -> int:
        up, at, k = [node], node, 0
        while len(self.up[at]) > k:
            at = self.up[at][k]
            up.append(at)
            k += 1
        self.up.append(up)
        self.edit.append(edit)
        self.length.append(self.length[node] + 1)
        self.hash.append((self.hash[node] * _BASE + ord(edit)) % _PRIME)
        return len(self.edit) - 1

    def ancestor(self, node: int, length: int) -> int:
        back = self.length[node] - length
        while back:
            k = back.bit_length() - 1
            node = self.up[node][k]
            back -= 1 << k
        return node

    def same(self, a: int, b: int) -> bool:
        """True if two nodes of equal length are equal sequences. Equal hashes of
        different nodes are not trusted: the edits are compared one by one."""
        if a == b:
            return True
        if self.hash[a] != self.hash[b]:
            return False
        while a != b:
            if self.edit[a] != self.edit[b]:
                return False
            a, b = self.up[a][0], self.up[b][0]
        return True

    def less(self, x: int, last_x: str, y: int, last_y: str) -> bool:
        """True if sequence x and an edit come before y and an edit. The edits may
        be empty."""
        if x == y:
            return last_x < last_y
        short = min(self.length[x], self.length[y])
        a, b = self.ancestor(x, short), self.ancestor(y, short)
        if self.same(a, b):
            return self._rest(x, short) + last_x < self._rest(y, short) + last_y
        for k in range(len(self.up[a]) - 1, -1, -1):
            if k < len(self.up[a]) and not self.same(self.up[a][k], self.up[b][k]):
                a, b = self.up[a][k], self.up[b][k]
        return self.edit[a] < self.edit[b]

    def _rest(self, node: int, length: int) -> str:
        out = []
        while self.length[node] > length:
            out.append(self.edit[node])
            node = self.up[node][0]
        return "".join(reversed(out))

    def text(self, node: int) -> str:
        return self._rest(node, 0)


def solve(rows: list[tuple[str, bool, bool]], start: int) -> list[tuple[int, str] | None]:
    """The cheapest edits, ties to the least, from state ``start`` over ``rows``
    (initial of the role, whether the row must go, whether it is truncated) to
    each state."""
    edits = Edits()
    cells: list[tuple[int, int] | None] = [None] * 4
    cells[start] = (0, 0)

    def with_inserts(cells):
        changed = True
        while changed:
            changed = False
            for state in STATES:
                if cells[state] is None:
                    continue
                cost, node = cells[state]
                to = cells[NEXT[state]]
                if (
                    to is None
                    or cost + 2 < to[0]
                    or (cost + 2 == to[0] and edits.less(node, "I", to[1], ""))
                ):
                    cells[NEXT[state]] = (cost + 2, edits.child(node, "I"))
                    changed = True
        return cells

    with_inserts(cells)
    for initial, must_go, truncated in rows:
        best: list[tuple[int, int, str] | None] = [None] * 4
        for state in STATES:
            if cells[state] is None:
                continue
            cost, node = cells[state]
            offers = [(state, cost + 3, "D")]
            if not must_go:
                offers.append((NEXT[state], cost + 2 + truncated, "R"))
                if initial in KEPT[state]:
                    offers.append((KEPT[state][initial], cost + truncated, "K"))
            for to, total, edit in offers:
                held = best[to]
                if (
                    held is None
                    or total < held[0]
                    or (total == held[0] and edits.less(node, edit, held[1], held[2]))
                ):
                    best[to] = (total, node, edit)
        cells = with_inserts([b and (b[0], edits.child(b[1], b[2])) for b in best])
    return [c and (c[0], edits.text(c[1])) for c in cells]


def apply_edits(
    audit: str, start: int, roles: list[str], texts: list[str]
) -> tuple[list[str], list[str]]:
    """Roles and texts of the rows after the edits."""
    state, at, out_roles, out_texts = start, 0, [], []
    for edit in audit:
        if edit == "K":
            out_roles.append(roles[at])
            out_texts.append(texts[at])
            state = KEPT[state][roles[at][:1]]
        elif edit in "RI":
            out_roles.append(ROLE[state])
            out_texts.append(texts[at] if edit == "R" else "")
            state = NEXT[state]
        at += edit != "I"
    return out_roles, out_texts


def best_end(found: list[tuple[int, str] | None]) -> tuple[int, tuple[int, str]]:
    return min(((s, found[s]) for s in ENDS if found[s] is not None), key=lambda x: x[1])


_COUNTS = ["blank", "duplicate", "truncated", "illegal"]
_BLOCK = (
    "part long, block long, alone boolean, blank long, duplicate long, truncated long, "
    "illegal long, turns long, first_turn long, last_turn long, first_initial string, "
    "last_initial string, start int, cost long, audit string, roles array<string>, "
    "texts array<string>, costs array<long>, audits array<string>"
)


class _Block:
    """Rows of a conversation one after the other, with what is counted in them."""

    def __init__(self, before: "_Block | None"):
        self.roles: list[str] = []
        self.texts: list[str] = []
        self.rows: list[tuple[str, bool, bool]] = []
        self.chars = 0
        self.counts = dict.fromkeys(_COUNTS, 0)
        self.first_initial = None
        self.last_initial = before.last_initial if before else None
        self.seen_turn = before.seen_turn if before else None
        self.turns, self.first_turn, self.last_turn = 0, None, None

    def add(self, turn: int | None, role: str, text: str, first: bool) -> None:
        stripped = text.rstrip(SPACE)
        fault = (
            "blank" if not stripped else "duplicate" if not first
            else "truncated" if stripped[-1] not in COMPLETE else None
        )
        if fault:
            self.counts[fault] += 1
        initial = role[:1]
        if self.last_initial is not None:
            self.counts["illegal"] += self.last_initial + initial not in LEGAL
        if self.first_initial is None:
            self.first_initial = initial
        self.last_initial = initial
        if turn is not None:
            if turn != self.seen_turn:
                self.turns += 1
                self.seen_turn = turn
            if self.first_turn is None:
                self.first_turn = turn
            self.last_turn = turn
        self.roles.append(role)
        self.texts.append(text)
        self.rows.append((initial, fault in ("blank", "duplicate"), fault == "truncated"))
        self.chars += len(text)

    def row(self, begins: bool, ends: bool) -> dict:
        """The block as a row; ``begins`` and ``ends`` tell if it surely is the
        first and the last of its conversation."""
        out = self.counts | {
            "alone": begins and ends, "turns": self.turns, "first_turn": self.first_turn,
            "last_turn": self.last_turn, "first_initial": self.first_initial,
            "last_initial": self.last_initial, "start": None, "cost": None, "audit": None,
            "costs": None, "audits": None,
        }
        if begins and ends:
            _, (cost, audit) = best_end(solve(self.rows, 0))
            roles, texts = apply_edits(audit, 0, self.roles, self.texts)
            return out | {"start": 0, "cost": cost, "audit": audit, "roles": roles, "texts": texts}
        found = [
            solve(self.rows, s) if s == 0 or not begins else [None] * 4 for s in STATES
        ]
        return out | {
            "roles": self.roles, "texts": self.texts,
            "costs": [x and x[0] for f in found for x in f],
            "audits": [x and x[1] for f in found for x in f],
        }


def _walk(schema: pa.Schema):
    """A function for mapInArrow over rows sorted by conversation and order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        out: list[dict] = []
        held, number, chars = None, 0, 0

        def batch() -> pa.RecordBatch:
            nonlocal chars
            made = pa.RecordBatch.from_pylist(out, schema=schema)
            out.clear()
            chars = 0
            return made

        def close(block: _Block, key, begins: bool, ends: bool) -> None:
            nonlocal number, chars
            out.append(block.row(begins, ends) | {"key": key, "part": part, "block": number})
            number += 1
            chars += block.chars + 100 * len(block.rows)

        # The first conversation may have begun, the last may go on, in another task.
        key, first_key, begins, marked = None, True, False, None
        for rows in batches:
            columns = [rows.column(n).to_pylist() for n in ("key", "turn", "role", "text", "row", "kind")]
            for k, turn, role, text, row, kind in zip(*columns):
                if held is None:
                    key, held = k, _Block(None)
                elif k != key:
                    close(held, key, begins, True)
                    key, held, begins = k, _Block(None), True
                if kind == 0:  # the next row is the first with its role and text
                    marked = row
                elif kind == 1:
                    if len(held.rows) >= BLOCK_ROWS or held.chars >= BLOCK_CHARS:
                        close(held, key, begins, False)
                        held, begins = _Block(held), False
                    held.add(turn, role, text, marked == row)
                if chars >= BLOCK_CHARS:
                    yield batch()
        if held is not None:
            close(held, key, begins, False)
        if out:
            yield batch()

    return run


def _choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each block of a conversation, sorted: the states at its two ends on the
    cheapest way through all, ties to the least.

    Of the ways to each state only their ends, from where they differ, are kept.
    """
    schema = pa.schema(
        [("part", pa.int64()), ("block", pa.int64()), ("start", pa.int32()), ("end", pa.int32())]
    )

    def chosen(path, cells) -> pa.RecordBatch:
        state = best_end(cells)[0]
        out = []
        for part, block, back in reversed(path):
            out.append((part, block, back[state], state))
            state = back[state]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema
        )

    key, cells, path = None, None, []
    for batch in batches:
        for row in batch.to_pylist():
            if cells is None or row["key"] != key:
                if cells is not None:
                    yield chosen(path, cells)
                key, cells, path = row["key"], [(0, ""), None, None, None], []
            new: list = [None] * 4
            back = [0] * 4
            for start in STATES:
                for end in STATES:
                    cost = row["costs"][4 * start + end]
                    if cells[start] is None or cost is None:
                        continue
                    way = (cells[start][0] + cost, cells[start][1] + row["audits"][4 * start + end])
                    if new[end] is None or way < new[end]:
                        new[end], back[end] = way, start
            same = len(commonprefix([c[1] for c in new if c]))
            cells = [c and (c[0], c[1][same:]) for c in new]
            path.append((row["part"], row["block"], back))
    if cells is not None:
        yield chosen(path, cells)


def _edited(schema: pa.Schema):
    """A function for mapInArrow: blocks with their chosen states become repaired."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                (row,) = batch.slice(i, 1).to_pylist()
                at = 4 * row["start"] + row.pop("end")
                row["cost"], row["audit"] = row["costs"][at], row["audits"][at]
                row["roles"], row["texts"] = apply_edits(
                    row["audit"], row["start"], row["roles"], row["texts"]
                )
                row["costs"] = row["audits"] = None
                yield pa.RecordBatch.from_pylist([row], schema=schema)

    return run


def repair(
    df: DataFrame, key: str, turn: str, role: str, text: str, gone: Column | None = None
) -> DataFrame:
    """The cheapest repair of each conversation, in blocks.

    A conversation is the rows of a key, by turn (nulls first), then role and
    SHA-256 of the text, so that equal rows stand side by side; rows of which
    ``gone`` is true only make their key known. A row is blank (only white
    space), a duplicate (role and text stood earlier) or truncated (the last
    character but white space is not one of ``.!?``), whichever is first. Keeping
    a row is free, another role (user or assistant) costs 2, deleting 3, an
    empty row put in 2; blank and duplicate rows must go, truncated ones that
    stay cost 1. The roles' initials of the result are nothing, or ``ua`` once or
    more with or without ``s`` in front. Of the cheapest edits those with the
    least initials (D, I, K, R) are taken.

    Returns the blocks of a conversation in the order of (part, block): key, the
    counts of faults and of illegal neighbours, turns (different ones that are
    not null), first_turn, last_turn, cost, audit (initials of the edits) and the
    repaired rows as roles and texts. ``alone``: the block is a whole conversation.

    Rows are sorted in range partitions, which may part a long conversation
    anywhere, and solved block by block. A block that is not a whole
    conversation is solved from every state to every state; the blocks' costs
    and edits are put together afterwards, block by block, so no task holds a
    conversation's rows. First occurrences are found by an aggregate with a
    partial step and sorted in as marks in front of their rows.

    A null role or text is one space; an empty role cannot be kept; null keys are
    one conversation. An empty table gives an empty table. Only the named
    columns are read, whatever others are called.
    """
    rows = df.select(
        F.col(key).alias("key"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit(" ")).alias("text"),
        (F.lit(False) if gone is None else F.coalesce(gone, F.lit(False))).alias("gone"),
    )
    stored = materialise(
        rows.select(
            "key", "turn", "role", "text", F.sha2("text", 256).alias("digest"),
            F.monotonically_increasing_id().alias("row"),
            F.when(F.col("gone"), 2).otherwise(1).alias("kind"),
        )
    )
    firsts = materialise(
        stored.where("kind = 1")
        .groupBy("key", "role", "digest")
        .agg(F.min(F.struct(F.col("turn").isNotNull().alias("some"), "turn", "row")).alias("x"))
        .select("key", "x.turn", "role", "digest", "x.row")
    )
    marks = firsts.select(
        "key", "turn", "role", F.lit("").alias("text"), "digest", "row", F.lit(0).alias("kind")
    )
    order = [F.col(c).asc_nulls_first() for c in ("key", "turn", "role", "digest", "row")]
    together = stored.unionByName(marks).repartitionByRange(*order).sortWithinPartitions(
        *order, "kind"
    )
    schema = T.StructType(
        [T.StructField("key", df.schema[key].dataType), *T.StructType.fromDDL(_BLOCK).fields]
    )
    arrow = to_arrow_schema(schema)
    found = materialise(
        text_batches(together)
        .select("key", "turn", "role", "text", "row", "kind")
        .mapInArrow(_walk(arrow), schema)
    )
    parted = found.where(~F.col("alone"))
    ways = materialise(
        parted.select("key", "part", "block", "costs", "audits")
        .repartition("key")
        .sortWithinPartitions("key", "part", "block")
        .mapInArrow(_choose, "part long, block long, start int, end int")
    )
    edited = parted.drop("start").join(ways, ["part", "block"]).mapInArrow(_edited(arrow), schema)
    return found.where("alone").unionByName(edited).drop("costs", "audits", "start")


def repaired_turns(blocks: DataFrame) -> DataFrame:
    """One row per repaired turn: key, part, block, place (in the block), role, text."""
    return blocks.select(
        "key", "part", "block", F.posexplode(F.arrays_zip("roles", "texts")).alias("place", "x")
    ).select("key", "part", "block", "place", "x.roles", "x.texts").toDF(
        "key", "part", "block", "place", "role", "text"
    )


def _report_parted(key_type: T.DataType):
    schema = to_arrow_schema(_report_schema(key_type))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Reports of conversations in several blocks, which come one after the
        other; the hash runs on from block to block."""
        held, hasher, first = None, None, None

        def done() -> pa.RecordBatch:
            row = dict(held)
            row["gaps"] = 0 if first is None else row["last_turn"] - first + 1 - row["turns"]
            row["audit"] = "".join(row["audit"])
            row["repaired_sha256"] = hasher.hexdigest()
            return pa.RecordBatch.from_pylist([{n: row[n] for n in schema.names}], schema=schema)

        for batch in batches:
            for i in range(batch.num_rows):
                (row,) = batch.slice(i, 1).to_pylist()
                if held is not None and held["key"] == row["key"]:
                    for name in [*_COUNTS, "cost", "turns"]:
                        held[name] += row[name]
                    if row["part"] != held["part"] and row["first_initial"] is not None:
                        # What a task could not see: the row before its first.
                        if held["last_initial"] is not None:
                            pair = held["last_initial"] + row["first_initial"]
                            held["illegal"] += pair not in LEGAL
                        if row["first_turn"] is not None and row["first_turn"] == held["last_turn"]:
                            held["turns"] -= 1
                    held["audit"].append(row["audit"])
                    for name in ("last_turn", "last_initial"):
                        held[name] = held[name] if row[name] is None else row[name]
                    held["part"] = row["part"]
                else:
                    if held is not None:
                        yield done()
                    held, hasher, first = row | {"audit": [row["audit"]]}, hashlib.sha256(), None
                    written = False
                first = row["first_turn"] if first is None else first
                for role, text in zip(row["roles"], row["texts"]):
                    hasher.update(f"{chr(10) if written else ''}{role}:{text}".encode())
                    written = True
        if held is not None:
            yield done()

    return run


def _report_schema(key_type: T.DataType) -> T.StructType:
    longs = ["gaps", *_COUNTS, "cost"]
    return T.StructType(
        [
            T.StructField("key", key_type),
            *[T.StructField(n, T.LongType()) for n in longs],
            T.StructField("audit", T.StringType()),
            T.StructField("repaired_sha256", T.StringType()),
        ]
    )


def reports(blocks: DataFrame) -> DataFrame:
    """One row per key of ``repair``: key, gaps (turns missing between the first
    and the last), the counts, cost, audit, and the SHA-256 of the repaired
    ``role:text`` lines.

    A hash over a conversation is one stream by its nature: the blocks of one
    that is in several pass through one task, one after the other.
    """
    lines = F.transform(
        F.arrays_zip("roles", "texts"), lambda x: F.concat(x["roles"], F.lit(":"), x["texts"])
    )
    whole = blocks.where("alone").select(
        "key",
        F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns"), F.lit(0)).alias("gaps"),
        *_COUNTS, "cost", "audit",
        F.sha2(F.array_join(lines, "\n"), 256).alias("repaired_sha256"),
    )
    key_type = blocks.schema["key"].dataType
    parted = (
        blocks.where(~F.col("alone"))
        .repartition("key")
        .sortWithinPartitions("key", "part", "block")
        .mapInArrow(_report_parted(key_type), _report_schema(key_type))
    )
    return whole.unionByName(parted)
