"""Repair of the structure of conversations by survivor-coalescence Viterbi.

A repaired conversation is empty, or an optional system turn followed by pairs of a user and an assistant turn: the first letters of
its roles match ``(s?(ua)+)?``. Each row is kept (cost 0), given the role user or assistant (3) or deleted (4; the only choice for
blank and repeated rows); an empty turn of user or assistant can be inserted anywhere (3); a truncated row that stays costs 3 more.
The cheapest list of edits wins, among equal ones the one that is least as a string of the letters D, I, K, R.

Between two rows a conversation is in one of four states (nothing yet, after the system turn, after a user, after an assistant), and
each state has one survivor, the best edits that lead there. Survivors are leaves of a tree of back pointers. A node counts the
nodes that hang on it: one that nothing hangs on any more goes, with its row, and when the root has a single child left, all survivors
share it, so its edits are final and go out. What a task holds is thus the rows since the survivors' last common ancestor: a few in a conversation
with some order, all of them where it stays open to the end who speaks first (a thousand user turns). A survivor goes early when another one, at the
price of the edits that make up for the difference of states, is cheaper still.

Ties are decided on the complete unresolved edits of both survivors. Their order never has to be read from the tree: survivors end with the
letter of the same row, so none is the beginning of another, and whatever is appended, two survivors stay in the order they are in.
Each carries its place in that order, so a row costs the same however long the unresolved part is.

Rows are taken by turn (nulls first), rows of equal turn by role and text. A null role or text counts as one space. A row is *blank* if its text
has nothing but space and 0x09 to 0x0D, else a *duplicate* if the conversation had its role and text before, else *truncated* if
its last other character is none of ``.!?``. An empty role has no first letter and cannot be kept. A null conv_id is a conversation
of its own. Columns other than conv_id, turn, role and text are not read. No rows give no edits.

A conversation goes through one task in order, as its digest must; nothing of it but the unresolved rows and the letters of its edits is held.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: What the edits cost, and the characters that end a turn.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
BLANKS = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
FINAL = {NOTHING: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}  # turns to insert at the end
KEEPS = {(NOTHING, "s"): SYSTEM, (NOTHING, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: The state after the next user or assistant turn, and that turn's role.
ONWARD = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: At most this much more is paid from the first state than from the second for the same rows to come: by inserting the turns between the
#: states, or by deleting the one system turn that the second could have kept.
MAKES_UP = {
    (ASSISTANT, NOTHING): DELETE, (SYSTEM, NOTHING): 2 * INSERT, (USER, NOTHING): INSERT + DELETE,
    (NOTHING, SYSTEM): 0, (ASSISTANT, SYSTEM): 0, (USER, SYSTEM): INSERT,
    (NOTHING, USER): INSERT, (SYSTEM, USER): INSERT, (ASSISTANT, USER): INSERT,
    (NOTHING, ASSISTANT): 0, (SYSTEM, ASSISTANT): 2 * INSERT, (USER, ASSISTANT): INSERT,
}

FAULTS = ("", "blank", "duplicate", "truncated")


def _moves(letter: str, fault: str) -> list[list[tuple[int, int, str]]]:
    """From each state: the state after a row, what it costs, and the letters, inserted turns first."""
    out = []
    for state in range(4):
        mine, here = [], state
        for inserted in range(3):
            paid, letters = inserted * INSERT, "I" * inserted
            mine.append((here, paid + DELETE, letters + "D"))
            if fault not in ("blank", "duplicate"):
                stays = paid + (TRUNCATED if fault == "truncated" else 0)
                mine.append((ONWARD[here], stays + REROLE, letters + "R"))
                if (here, letter) in KEEPS:
                    mine.append((KEEPS[here, letter], stays, letters + "K"))
            here = ONWARD[here]
        out.append(mine)
    return out


MOVES = {(letter, fault): _moves(letter, fault) for letter in ("s", "u", "a", "") for fault in FAULTS}


class Node:
    """A row's edits on a survivor's way."""

    __slots__ = ("cost", "kids", "letters", "parent", "row", "state")

    def __init__(self, parent: Node | None, state: int, cost: int, letters: str, row: tuple | None) -> None:
        self.parent, self.state, self.cost, self.letters, self.row = parent, state, cost, letters, row
        self.kids: list[Node] = []  # their number is the reference count; survivors hang on nothing but their parent


class Repair:
    """One conversation, row by row. ``add`` and ``finish`` yield what is decided: (edit, role, row), a row being what was added."""

    def __init__(self) -> None:
        self.root = Node(None, NOTHING, 0, "", None)
        self.survivors = [self.root]  # in the order of their edits

    def add(self, row: tuple, letter: str, fault: str) -> Iterator[tuple[str, str | None, tuple | None]]:
        moves = MOVES[letter if letter in ("s", "u", "a") else "", fault]
        best: dict[int, tuple[int, int, str]] = {}
        for place, node in enumerate(self.survivors):
            for state, paid, letters in moves[node.state]:
                found = (node.cost + paid, place, letters)
                if state not in best or found < best[state]:
                    best[state] = found
        chosen = [
            (place, letters, state, cost)
            for state, (cost, place, letters) in best.items()
            if not any(other != state and best[other][0] + MAKES_UP[other, state] < cost for other in best)
        ]
        before, self.survivors = self.survivors, []
        for place, letters, state, cost in sorted(chosen):
            node = Node(before[place], state, cost, letters, row)
            before[place].kids.append(node)
            self.survivors.append(node)
        for node in before:
            self._release(node)
        yield from self._settled()

    def _release(self, node: Node) -> None:
        while not node.kids and node is not self.root:
            node.parent.kids.remove(node)
            node = node.parent

    def _settled(self) -> Iterator[tuple[str, str | None, tuple | None]]:
        while len(self.root.kids) == 1:
            child = self.root.kids[0]
            yield from _edits(self.root.state, child)
            child.parent = None
            self.root = child

    def finish(self) -> tuple[int, list[tuple[str, str | None, tuple | None]]]:
        """The cost of all edits, and those not yielded so far."""
        ends = [(n.cost + FINAL[n.state] * INSERT, place, n) for place, n in enumerate(self.survivors)]
        cost, _, last = min(ends, key=lambda e: e[:2])
        path, node = [], last
        while node is not self.root:
            path.append(node)
            node = node.parent
        out, state = [], self.root.state
        for node in reversed(path):
            out += _edits(state, node)
            state = node.state
        for _ in range(FINAL[state]):
            state = ONWARD[state]
            out.append(("I", ROLE[state], None))
        return cost, out

    def held(self) -> int:
        """Nodes in the tree beside its root."""
        count, open_nodes = 0, [self.root]
        while open_nodes:
            kids = open_nodes.pop().kids
            count += len(kids)
            open_nodes += kids
        return count


def _edits(state: int, node: Node) -> Iterator[tuple[str, str | None, tuple | None]]:
    for letter in node.letters:
        if letter in "IR":
            state = ONWARD[state]
        yield letter, (ROLE[state] if letter in "IR" else None), (None if letter == "I" else node.row)


def _prepared(conversations: DataFrame) -> DataFrame:
    """Rows of a conversation together and in order, with the first fault of each."""
    rows = conversations.select(
        "conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text")
    )
    same = W.partitionBy("conv_id", "role", "_digest").orderBy("turn")
    rows = rows.withColumn("_digest", F.sha2("text", 256)).repartition("conv_id")
    rows = rows.withColumn("_again", F.row_number().over(same) > 1)
    core = F.rtrim(F.col("text"), F.lit(BLANKS))
    fault = (
        F.when(F.length(core) == 0, "blank").when(F.col("_again"), "duplicate").when(~F.right(core, F.lit(1)).isin(*ENDS), "truncated").otherwise("")
    )
    # equal rows of equal turn: the one that is no duplicate first
    rows = rows.sortWithinPartitions("conv_id", "turn", "role", "text", "_again")
    return rows.select("conv_id", "turn", "role", "text", fault.alias("fault"))


def repair(conversations: DataFrame) -> DataFrame:
    """One row per edit, in order within each conversation: conv_id, seq, edit (K, R, D or I), role and text after it (null for D), and
    turn, was (the role before), fault of the row it applies to (null for I). The row after a conversation's last edit has a null edit and
    the ``cost``. Conversations lie whole in a partition, sorted."""
    rows = _prepared(conversations)
    kind = dict(rows.dtypes)
    schema = f"conv_id {kind['conv_id']}, seq bigint, edit string, role string, text string, turn {kind['turn']}, was string, fault string, cost bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "seq", "edit", "role", "text", "turn", "was", "fault", "cost"]
        types: list[pa.DataType] = []
        made: list[tuple] = []
        size = 0
        now: Repair | None = None
        conv, seq = None, 0

        def flush() -> pa.RecordBatch:
            nonlocal size
            columns = list(zip(*made, strict=True))
            made.clear()
            size = 0
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        def put(edits) -> None:
            nonlocal seq, size
            for edit, role, row in edits:
                turn, was, text, fault = row or (None, None, "", None)
                made.append((conv, seq, edit, (was if edit == "K" else role), (None if edit == "D" else text), turn, was, fault, None))
                seq, size = seq + 1, size + len(text) + 64

        def end() -> None:
            cost, edits = now.finish()
            put(edits)
            made.append((conv, seq, None, None, None, None, None, None, cost))

        for batch in batches:
            types = [batch.schema.field("conv_id").type, pa.int64(), *[pa.string()] * 3, batch.schema.field("turn").type, *[pa.string()] * 2, pa.int64()]
            for key, turn, role, text, fault in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "fault")), strict=True):
                if now is None or key != conv:
                    if now is not None:
                        end()
                    now, conv, seq = Repair(), key, 0
                put(now.add((turn, role, text, fault), role[:1], fault))
                if size > 4 << 20:
                    yield flush()
        if now is not None:
            end()
        if made:
            yield flush()

    return rows.mapInArrow(run, schema)


def repair_digest(edits: DataFrame) -> DataFrame:
    """One row per conversation of ``repair``'s result, read in its order: conv_id, gaps in the turn numbers, rows by fault, illegal neighbours, cost,
    ``audit`` (the edits' letters) and ``repaired_sha256`` over ``role:text`` of the turns that are left, joined by line breaks."""
    kind = dict(edits.dtypes)["conv_id"]
    schema = (
        f"conv_id {kind}, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def fresh() -> dict:
            return {"low": None, "high": None, "turns": 0, "last": None, "illegal": 0, "letters": [], "hash": hashlib.sha256(), "any": False} | dict.fromkeys(FAULTS, 0)

        c = fresh()
        for batch in batches:
            out = []
            for conv, edit, role, text, turn, was, fault, cost in zip(
                *(batch.column(x).to_pylist() for x in ("conv_id", "edit", "role", "text", "turn", "was", "fault", "cost")), strict=True
            ):
                if edit is None:
                    gaps = c["high"] - c["low"] + 1 - c["turns"] if c["turns"] else 0
                    out.append((conv, gaps, c["blank"], c["duplicate"], c["truncated"], c["illegal"], cost, "".join(c["letters"]), c["hash"].hexdigest()))
                    c = fresh()
                    continue
                c["letters"].append(edit)
                if edit != "I":
                    c[fault] += 1
                    if turn is not None and turn != c["high"]:  # in order, so a new one
                        c["low"], c["high"], c["turns"] = (turn if c["low"] is None else c["low"]), turn, c["turns"] + 1
                    if c["last"] is not None and c["last"] + was[:1] not in ("su", "ua", "au"):
                        c["illegal"] += 1
                    c["last"] = was[:1]
                if edit != "D":
                    c["hash"].update((("\n" if c["any"] else "") + f"{role}:{text}").encode())
                    c["any"] = True
            columns = list(zip(*out, strict=True)) or [()] * 9
            types = [batch.schema.field("conv_id").type, *[pa.int64()] * 6, pa.string(), pa.string()]
            names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, types, strict=True)], names)

    return edits.mapInArrow(run, schema)
