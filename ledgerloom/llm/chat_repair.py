"""Chat formatting with minimum-cost role repair.

A legal conversation is an optional system turn, then user and assistant turns in strict
alternation from a user turn, ending with an assistant turn.  A turn may be kept, given
another role, or merged into the turn before it (of the same role after repair); an empty
turn may be put in before it or at the end.  Of all repairs the cheapest is taken, by
dynamic programming over the automaton of legal turns; ties go to the first choice in the
order in which choices are listed.

The automaton has four states, so a run of turns is a 4 x 4 matrix of least costs, and
matrices of neighbouring runs combine by (min, +) products.  Rows are range-sorted by
conversation and turn; each task sums up the runs it holds, the few runs of a conversation
that lie in several tasks are combined, and each task then traces its own runs between the
states so found.  So a conversation may hold any share of all rows.

The result has one row for each turn: its place, what is done with it, its role, and the
rendered text that it adds; those texts in order are the rendered conversation.  Null or
unknown roles must be given another; null and empty texts render as empty ones, very long
ones whole; turns with equal numbers are ordered by role and text, so that repeated rows are
turns of their own, next to each other, and are merged; turns without a number come first;
turns without a conversation id are one conversation; empty tables give no rows; columns
other than those named are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .durable import cut, tidy

# States: nothing yet, after a system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {"system": SYSTEM, "user": USER, "assistant": ASSISTANT}
NAMES = {v: k for k, v in ROLES.items()}
#: Costs of the repairs.
MERGE, RELABEL, RELABEL_UNKNOWN, INSERT = 1.0, 3.0, 2.0, 2.5
_FAR = np.inf
_FOLLOWS = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}


def _choices() -> dict[tuple[int, int], list[tuple[float, str, tuple[int, ...]]]]:
    """By (state, role of the turn; 0: unknown): (cost, action, roles inserted before, role taken) of each choice."""
    found: dict = {}
    for state in range(4):
        for role in range(4):
            out = []
            for taken in (SYSTEM, USER, ASSISTANT):
                relabel = 0.0 if taken == role else RELABEL if role else RELABEL_UNKNOWN
                name = "keep" if taken == role else "relabel"
                if taken in _FOLLOWS[state]:
                    out.append((relabel, name, (), taken))
                if state == taken:
                    out.append((relabel + MERGE, "merge" if taken == role else "relabel and merge", (), taken))
                for between in _FOLLOWS[state]:
                    if taken in _FOLLOWS[between] and between != SYSTEM:
                        out.append((relabel + INSERT, f"insert and {name}", (between,), taken))
            found[state, role] = sorted(out, key=lambda c: c[0])
    return found


CHOICES = _choices()


def _step(role: int) -> np.ndarray:
    """Least cost from each state to each state over one turn."""
    m = np.full((4, 4), _FAR)
    for state in range(4):
        for cost, _, _, taken in CHOICES[state, role]:
            m[state, taken] = min(m[state, taken], cost)
    return m


STEPS = [_step(role) for role in range(4)]
#: Cost of ending in each state: an empty assistant turn after a user turn, both after a system turn; nothing is legal as it is.
ENDING = np.array([0.0, 2 * INSERT, INSERT, 0.0])
ENDING_ROLES: list[tuple[int, ...]] = [(), (USER, ASSISTANT), (ASSISTANT,), ()]


def best_path(roles: list[int], start: int, end: int) -> list[tuple[float, str, tuple[int, ...], int]]:
    """The cheapest choices for turns of these roles that lead from one state to another."""
    cost = np.full(4, _FAR)
    cost[start] = 0
    came: list[list] = []
    for role in roles:
        nxt, via = np.full(4, _FAR), [None] * 4
        for state in range(4):
            if cost[state] < _FAR:
                for choice in CHOICES[state, role]:
                    if cost[state] + choice[0] < nxt[choice[3]]:
                        nxt[choice[3]], via[choice[3]] = cost[state] + choice[0], (state, choice)
        cost = nxt
        came.append(via)
    path, state = [], end
    for via in reversed(came):
        state, choice = via[state]
        path.append(choice)
    return path[::-1]


def render(role: int, text: str) -> str:
    return f"<|{NAMES[role]}|>\n{text}"


CLOSE = "<|end|>\n"


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, pa.RecordBatch, int, int]]:
    """Stretches of one conversation within each batch: (conversation, batch, from, to)."""
    for batch in batches:
        convs = batch.column(0).to_pylist()
        at = 0
        for i in range(1, len(convs) + 1):
            if i == len(convs) or convs[i] != convs[at]:
                yield convs[at], batch, at, i
                at = i


def repair(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", run_rows: int = 4096) -> DataFrame:
    """conv, turn, place (0, 1, ...), role_in, role, action, cost and rendered of every turn."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), F.col(role_col).cast("string").alias("role_in"), text.alias("text")).withColumn("tie", F.xxhash64("role_in", "text"))
    # Kept, so that both passes find the rows in the same tasks.
    order = ["conv", "turn", "role_in", "tie", "text"]
    placed = cut(rows.repartitionByRange("conv", "turn", "role_in", "tie").sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()).drop("tie"))

    conv_type = placed.schema["conv"].dataType
    known = F.coalesce(F.element_at(F.create_map(*(x for k, v in ROLES.items() for x in (F.lit(k), F.lit(v)))), F.lower(F.trim("role_in"))), F.lit(0))
    fields = [T.StructField("conv", conv_type), T.StructField("part", T.IntegerType()), T.StructField("run", T.IntegerType()), T.StructField("rows", T.LongType()), T.StructField("costs", T.ArrayType(T.DoubleType()))]

    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, int, list[tuple[pa.RecordBatch, int, int]]]]:
        """Runs of at most run_rows turns of one conversation in this task, numbered."""
        conv, run, held, size, started = None, -1, [], 0, False
        for c, batch, a, b in _runs(batches):
            if started and c != conv and held:
                yield conv, run, held
                held, size = [], 0
            if not started or c != conv:
                conv, started, run = c, True, run + 1
            while a < b:
                take = min(b - a, run_rows - size)
                held.append((batch, a, a + take))
                size, a = size + take, a + take
                if size == run_rows:
                    yield conv, run, held
                    held, size, run = [], 0, run + 1
        if held:
            yield conv, run, held

    @tidy
    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[list] = [[] for _ in fields]
        names = [f.name for f in fields]
        kinds = [None, pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.float64())]
        conv_kind = None
        for conv, run, held in stretches(batches):
            conv_kind = held[0][0].column(0).type
            total = None
            for batch, a, b in held:
                for role in batch.column(1).slice(a, b - a).to_pylist():
                    total = STEPS[role] if total is None else (total[:, :, None] + STEPS[role][None, :, :]).min(1)
            for column, value in zip(out, (conv, held[0][0].column(2)[held[0][1]].as_py(), run, sum(b - a for _, a, b in held), total.ravel().tolist()), strict=True):
                column.append(value)
            if len(out[0]) >= 5000:
                yield pa.RecordBatch.from_arrays([pa.array(c, k or conv_kind) for c, k in zip(out, kinds, strict=True)], names=names)
                out = [[] for _ in fields]
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(c, k or conv_kind) for c, k in zip(out, kinds, strict=True)], names=names)

    runs = placed.select("conv", known.alias("role"), "part").mapInArrow(summed, T.StructType(fields))

    # A conversation's runs, one for each few thousand of its turns, are chained: states before and after each.
    chained_fields = [T.StructField("part", T.IntegerType()), T.StructField("run", T.IntegerType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("before", T.LongType()), T.StructField("last", T.BooleanType())]

    @tidy
    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solve(group: list[tuple[int, int, int, np.ndarray]]) -> list[tuple]:
            reach = [np.array([0.0, _FAR, _FAR, _FAR])]
            for *_, m in group:
                reach.append((reach[-1][:, None] + m).min(0))
            state = int(np.argmin(reach[-1] + ENDING))
            made = []
            for i in range(len(group) - 1, -1, -1):
                part, run, n, m = group[i]
                start = int(np.argmin(reach[i] + m[:, state]))
                made.append([part, run, start, state, n, i == len(group) - 1])
                state = start
            before = 0
            for row in reversed(made):
                row[4], before = before, before + row[4]
            return made

        conv, group, out, started = None, [], [], False
        for batch in batches:
            for c, part, run, n, costs in zip(*(col.to_pylist() for col in batch.columns), strict=True):
                if started and c != conv:
                    out += solve(group)
                    group = []
                conv, started = c, True
                group.append((part, run, n, np.array(costs, float).reshape(4, 4)))
            if out:
                yield pa.RecordBatch.from_pylist([dict(zip((f.name for f in chained_fields), r, strict=True)) for r in out], schema=arrow_chained)
                out = []
        if group:
            yield pa.RecordBatch.from_pylist([dict(zip((f.name for f in chained_fields), r, strict=True)) for r in solve(group)], schema=arrow_chained)

    arrow_chained = pa.schema([("part", pa.int32()), ("run", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("before", pa.int64()), ("last", pa.bool_())])
    chained = runs.repartition("conv").sortWithinPartitions("conv", "part", "run").mapInArrow(chain, T.StructType(chained_fields))

    # Number the runs of the kept rows in the same way, then trace each between its states.
    numbered_schema = T.StructType([*placed.schema.fields, T.StructField("run", T.IntegerType()), T.StructField("nth", T.IntegerType())])

    @tidy
    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, run, held in stretches(batches):
            nth = 0
            for batch, a, b in held:
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(np.full(b - a, run, np.int32)), pa.array(np.arange(nth, nth + b - a, dtype=np.int32))], names=numbered_schema.names)
                nth += b - a

    numbered = placed.mapInArrow(number, numbered_schema)
    joined = numbered.join(chained, ["part", "run"]).select("part", "run", "nth", "start", "end", "before", "last", "conv", "turn", "role_in", known.alias("known"), "text")
    result = T.StructType(
        [T.StructField(conv_col, conv_type), T.StructField(turn_col, T.LongType()), T.StructField("place", T.LongType()), T.StructField("role_in", T.StringType())]
        + [T.StructField(n, T.StringType()) for n in ("role", "action")]
        + [T.StructField("cost", T.DoubleType()), T.StructField("rendered", T.StringType())]
    )

    @tidy
    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def traced() -> pa.RecordBatch:
            """A turn is closed by the next one that isn't merged into it, or by the end."""
            _, _, _, start, end, before, last = held[0][:7]
            path = best_path([h[10] for h in held], start, end)
            out = []
            for h, (cost, action, inserted, taken) in zip(held, path, strict=True):
                opened = h[2] + before > 0
                body = "\n" + h[11] if "merge" in action else (CLOSE if opened else "") + "".join(render(r, "") + CLOSE for r in inserted) + render(taken, h[11])
                out.append([h[7], h[8], h[2] + before, h[9], NAMES[taken], action, cost, body])
            if last:
                out[-1][7] += CLOSE + "".join(render(r, "") + CLOSE for r in ENDING_ROLES[end])
                out[-1][6] += float(ENDING[end])
                if ENDING_ROLES[end]:
                    out[-1][5] += " and insert after"
            kinds = [conv_kind, pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=result.names)

        conv_kind = None
        for batch in batches:
            conv_kind = batch.column(7).type
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:2] != key and held:
                    yield traced()
                    held = []
                key = row[:2]
                held.append(row)
        if held:
            yield traced()

    return joined.repartition("part", "run").sortWithinPartitions("part", "run", "nth").mapInArrow(trace, result)
