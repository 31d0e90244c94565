"""Chat formatting with minimum-cost role repair.

The legal turns are an automaton: an optional system turn, then user and assistant in turn, the assistant last. Each
turn of a conversation is placed under its own role, placed under another one (relabelled), or merged into the turn
before it; empty turns may be inserted before it and at the end. Dynamic programming finds repairs of least total cost.

One step of the automaton is a 4 by 4 matrix of costs, and a run of turns is the (min, +) product of its steps. So a
conversation may span any number of partitions: turns are put in order by a range exchange, one pass reduces the first
and last run of each partition to its matrix, the driver joins these (two rows of some 300 bytes a partition, never the
turns), and a second pass repairs and renders each run between its known entry and exit states, of which each partition
gets two bytes. A hot conversation is spread over partitions like any other rows.

Of repairs of equal cost one wins wherever the conversation is cut: that whose last state comes first in STATES, then
that whose last but one does, and so on. For that a matrix ranks, beside each cost, the states on the way: for a given
last state its four ways, one from each first state, in the order of their states read backwards. Two ways of a product
are compared by their rank in the right factor, then by the state between, then by their rank in the left one, so the
product is associative in costs and ranks alike.

The result is a row per turn whose `segment` is its part of the rendered conversation; segments in order of turn give
the whole, so no conversation has to fit into one row.

Nulls: a null text counts as empty, a null or unknown role must be relabelled, a null turn comes first; null conv_ids
form one conversation. Ties in (conv_id, turn) are put in order by role and a hash of the text; repeated rows stay
repeated turns, and are spread like any others. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiquarry.llm.common import shared_path

STATES = ("start", "system", "user", "assistant")
START, SYSTEM, USER, ASSISTANT = range(4)
FOLLOWS = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
#: Other names of roles.
ALIASES = {"system": SYSTEM, "user": USER, "human": USER, "assistant": ASSISTANT, "gpt": ASSISTANT, "bot": ASSISTANT, "model": ASSISTANT}
MERGE, RELABEL, NAME, INSERT = 1, 3, 2, 2  # NAME: a role that is null or unknown
FAR = 1 << 40

OPEN, CLOSE, BREAK = "<|im_start|>", "<|im_end|>\n", "\n\n"

Matrix = list[list[int]]
#: Least costs and ranks of a run, by the states before and after it.
Run = tuple[Matrix, Matrix]


def _ways() -> list[list[tuple[int, ...] | None]]:
    """The fewest turns to insert in a state before a turn of another state may follow."""
    out: list[list[tuple[int, ...] | None]] = []
    for s in range(4):
        best: dict[int, tuple[int, ...]] = {}
        paths = [((), s)]
        for _ in range(3):
            for path, at in paths:
                for t in FOLLOWS[at]:
                    best.setdefault(t, path)
            paths = [((*path, t), t) for path, at in paths for t in FOLLOWS[at]]
        out.append([best.get(t) for t in range(4)])
    return out


WAYS = _ways()


def role_of(role: str | None) -> int | None:
    return ALIASES.get((role or "").strip().lower())


def options(role: int | None) -> list[list[tuple[int, str, tuple[int, ...]] | None]]:
    """For each state before and after a turn: least cost, action, and the roles inserted before it."""
    table: list[list[tuple[int, str, tuple[int, ...]] | None]] = []
    for s in range(4):
        row: list[tuple[int, str, tuple[int, ...]] | None] = [None] * 4
        for t in (SYSTEM, USER, ASSISTANT):
            change = 0 if t == role else NAME if role is None else RELABEL
            found = []
            if WAYS[s][t] is not None:
                found.append((change + INSERT * len(WAYS[s][t]), "keep" if not change else "relabel", WAYS[s][t]))
            if s == t:
                found.append((change + MERGE, "merge" if not change else "relabel+merge", ()))
            row[t] = min(found, key=lambda x: x[0], default=None)
        table.append(row)
    return table


OPTIONS = {role: options(role) for role in (None, SYSTEM, USER, ASSISTANT)}
STEP: dict[int | None, Matrix] = {role: [[x[0] if x else FAR for x in row] for row in table] for role, table in OPTIONS.items()}
#: What is inserted when a conversation ends in a state.
TAIL: dict[int, tuple[int, ...]] = {SYSTEM: (USER, ASSISTANT), USER: (ASSISTANT,), ASSISTANT: ()}
#: The run of a single turn: there are no states on the way.
SINGLE: dict[int | None, Run] = {role: (cost, [[0] * 4 for _ in range(4)]) for role, cost in STEP.items()}


def joined(a: Run, b: Run) -> Run:
    """The run a and then b."""
    (cost_a, rank_a), (cost_b, rank_b) = a, b
    costs, ranks = [[FAR] * 4 for _ in range(4)], [[0] * 4 for _ in range(4)]
    for t in range(4):
        ways = []
        for s in range(4):
            cost, rank, k = min((cost_a[s][k] + cost_b[k][t], rank_b[k][t], k) for k in range(4))
            costs[s][t] = min(FAR, cost)
            ways.append((rank, k, rank_a[s][k]))
        order = sorted(set(ways))
        for s in range(4):
            ranks[s][t] = order.index(ways[s])
    return costs, ranks


def ending(t: int) -> int:
    return INSERT * len(TAIL[t]) if t != START else FAR


@dataclass
class Border:
    """States before and after a run of turns, and whether its conversation begins and ends with it."""

    entry: int
    leave: int
    first: bool
    last: bool

    def packed(self) -> int:
        return 1 + (self.entry | self.leave << 2 | self.first << 4 | self.last << 5)

    @classmethod
    def of(cls, packed: int) -> Border:
        x = packed - 1
        return cls(x & 3, x >> 2 & 3, bool(x & 16), bool(x & 32))


def borders(runs: list[Run]) -> list[Border]:
    """Of a conversation's runs, in order."""
    ahead = [[0 if s == START else FAR for s in range(4)]]
    for cost, _ in runs:
        ahead.append([min(FAR, *(ahead[-1][s] + cost[s][t] for s in range(4))) for t in range(4)])
    state = min(range(1, 4), key=lambda t: (ahead[-1][t] + ending(t), t))
    out = []
    for k in range(len(runs) - 1, -1, -1):
        cost, rank = runs[k]
        before = min(range(4), key=lambda s, k=k, t=state: (ahead[k][s] + cost[s][t], rank[s][t], s))
        out.append(Border(before, state, k == 0, k == len(runs) - 1))
        state = before
    return out[::-1]


def whole(roles: list[int | None]) -> Border:
    """Of a run that is all of its conversation."""
    ahead = [0 if s == START else FAR for s in range(4)]
    for r in roles:
        ahead = [min(FAR, *(ahead[s] + STEP[r][s][t] for s in range(4))) for t in range(4)]
    return Border(START, min(range(1, 4), key=lambda t: (ahead[t] + ending(t), t)), True, True)


def repair(roles: list[int | None], border: Border) -> list[int]:
    """The states after each turn of a run, of least cost between the border's states."""
    ahead = [[0 if s == border.entry else FAR for s in range(4)]]
    for r in roles:
        step = STEP[r]
        ahead.append([min(FAR, *(ahead[-1][s] + step[s][t] for s in range(4))) for t in range(4)])
    out, t = [], border.leave
    for k in range(len(roles) - 1, -1, -1):
        out.append(t)
        t = min(range(4), key=lambda s, k=k, t=t: (ahead[k][s] + STEP[roles[k]][s][t], s))
    return out[::-1]


def _empty(roles: tuple[int, ...]) -> str:
    return "".join(f"{OPEN}{STATES[r]}\n{CLOSE}" for r in roles)


def render(roles: list[int | None], texts: list[str | None], border: Border) -> Iterator[tuple[str, str, int, int, str]]:
    """(role, action, inserted, cost, segment) of each turn of a run."""
    states, s = repair(roles, border), border.entry
    for k, (role, text, t) in enumerate(zip(roles, texts, states, strict=True)):
        cost, action, inserted = OPTIONS[role][s][t]
        body = (text or "").replace("<|im_", "< |im_")  # the text cannot open or close turns
        if action.endswith("merge"):
            segment = BREAK + body
        else:
            segment = ("" if border.first and k == 0 else CLOSE) + _empty(inserted) + f"{OPEN}{STATES[t]}\n{body}"
        n = len(inserted)
        if border.last and k == len(roles) - 1:
            segment += CLOSE + _empty(TAIL[t])
            n, cost = n + len(TAIL[t]), cost + ending(t)
        yield STATES[t], action, n, cost, segment
        s = t


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """A partition's rows by conversation."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and held[-1][0] != row[0]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _placed(runs: Iterator[list[tuple]]) -> Iterator[tuple[list[tuple], int | None]]:
    """A partition's runs with 0 for the first, 1 for the last of several, and None for those between."""
    held = None
    place: int | None = 0
    for run in runs:
        if held is not None:
            yield held, place
            place = None
        held = run
    if held is not None:
        yield held, 0 if place == 0 else 1


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per turn: conv_id, turn, role, action, inserted (empty turns put before it, or at the end), cost, segment."""
    conv, turn = (turns.schema[c].dataType.simpleString() for c in (conv_col, turn_col))
    rows = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    keys = [F.col("conv_id"), F.col("turn"), F.col("role"), F.xxhash64("text"), F.col("at")]
    shared_path(turns.sparkSession, "checkpoint")  # sets a folder for checkpoints where there is none
    rows = rows.withColumn("at", F.monotonically_increasing_id())
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("at").checkpoint()

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held: list[tuple[object, list[int | None]]] = []  # roles of the first and of the last run
        for batch in batches:
            for key, role in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if held and key == held[-1][0]:
                    held[-1][1].append(role_of(role))
                else:
                    held = [*held[:1], (key, [role_of(role)])]
        found = [(repr(key), reduce(joined, (SINGLE[r] for r in roles))) for key, roles in held]
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([part] * len(found), pa.int64()),
                pa.array([hashlib.sha256(k.encode()).digest() for k, _ in found], pa.binary()),
                *(pa.array([sum(x[k], []) for _, x in found], pa.list_(pa.int64())) for k in (0, 1)),
            ],
            ["part", "key", "costs", "ranks"],
        )

    ends = ordered.select("conv_id", "role").mapInArrow(edges, "part long, key binary, costs array<long>, ranks array<long>").collect()
    #: For each partition the packed borders of its first and of its last run; 0: none, or the same run.
    known = bytearray(2 * max([0, *(r["part"] + 1 for r in ends)]))
    open_: list[tuple[int, bytes, Run]] = []

    def close() -> None:
        for (at, _, _), border in zip(open_, borders([m for *_, m in open_]), strict=True):
            known[at] = border.packed()

    square = lambda x: [x[4 * s : 4 * s + 4] for s in range(4)]
    before = None
    for r in sorted(ends, key=lambda r: r["part"]):  # stable: the first run of a partition stays before the last
        at = 2 * r["part"] + (r["part"] == before)
        before = r["part"]
        if open_ and open_[-1][1] != r["key"]:
            close()
            open_ = []
        open_.append((at, r["key"], (square(r["costs"]), square(r["ranks"]))))
    if open_:
        close()
    sent = turns.sparkSession.sparkContext.broadcast(bytes(known))  # two bytes a partition

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        types = [*kinds, pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        out: list[tuple] = []
        size = 0
        for run, place in _placed(_runs(batches)):
            roles, texts = [role_of(r[2]) for r in run], [r[3] for r in run]
            if place is None:
                border = whole(roles)
            else:
                border = Border.of(sent.value[2 * part + place])
            for row, done in zip(run, render(roles, texts, border), strict=True):
                out.append((row[0], row[1], *done))
                size += len(done[4])
                if size > 4_000_000:
                    yield _batch(out, types)
                    out, size = [], 0
        yield _batch(out, types)

    from pyspark.sql.pandas.types import to_arrow_type

    kinds = [to_arrow_type(ordered.schema[c].dataType) for c in ("conv_id", "turn")]
    return ordered.mapInArrow(write, f"conv_id {conv}, turn {turn}, role string, action string, inserted long, cost long, segment string")


def _batch(rows: list[tuple], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(types)
    names = ["conv_id", "turn", "role", "action", "inserted", "cost", "segment"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)
