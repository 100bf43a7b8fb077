"""Chat formatting with minimum-cost role repair.

Legal conversations are the words of a small automaton: an optional system turn, then user and assistant in turn,
ending with the assistant. Each given turn is emitted under some role, or merged into the turn before it; an empty turn
may be inserted before it. Dynamic programming over the automaton's states finds the repair of least total cost
(``COSTS``); the repaired sequence is then rendered.

A conversation may be of any length: its turns are range-partitioned by (conv_id, turn, role, text), so one that holds
a third of all rows spreads over many tasks. A run of turns acts on the states as a 4 x 4 matrix under (min, +). Only
the first and last run of each partition can belong to a conversation that spans partitions; their matrices (two a
partition) go to the driver, which chains them and hands each such run the states it starts and ends in.

The result has a row for each given turn; its ``rendered`` strings, joined in the order of ``seq``, are the whole
conversation. Inserted and closing pieces belong to the turn that they come with.

Defined cases: a null text is empty; a null or unknown role can take any role at the cost of a relabel; turns with the
same number are ordered by role, then text; rows that repeat are turns of their own; a null conv_id is a conversation
like any other; an empty table gives an empty result; columns of other names are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillsift.scratch import shared_dir

START, SYSTEM, USER, ASSISTANT = range(4)
NAMES = ("", "system", "user", "assistant")
LEGAL = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
COSTS = {"merge": 1, "insert": 2, "relabel": 3}
BIG = 1 << 60
#: Turns that end a conversation legally from each state.
ENDING = {START: (USER, ASSISTANT), SYSTEM: (USER, ASSISTANT), USER: (ASSISTANT,), ASSISTANT: ()}
SCHEMA = "conv_id bigint, seq bigint, turn bigint, role string, out_role string, action string, inserted string, cost bigint, rendered string"


def options(costs: dict[str, int] = COSTS) -> dict[int, list[tuple[int, int, int, str, int | None]]]:
    """Of each observed role (0: unknown): (from state, to state, cost, action, inserted role), the first of equals wins."""
    out: dict[int, list] = {}
    for seen in range(4):
        steps = []
        for s in range(4):
            if s != START:
                steps.append((s, s, costs["merge"] + (0 if seen == s else costs["relabel"]), "merge", None))
            for r in LEGAL[s]:
                steps.append((s, r, 0 if seen == r else costs["relabel"], "keep" if seen == r else "relabel", None))
            for x in LEGAL[s]:
                for r in LEGAL[x]:
                    steps.append((s, r, costs["insert"] + (0 if seen == r else costs["relabel"]), "keep" if seen == r else "relabel", x))
        out[seen] = steps
    return out


OPTIONS = options()
#: For each observed role, the cheapest option from state to state.
BEST = {seen: {(s, t): min((o for o in steps if o[:2] == (s, t)), key=lambda o: o[2]) for s, t in {o[:2] for o in steps}} for seen, steps in OPTIONS.items()}
MOVES = {seen: [(s, t, o[2]) for (s, t), o in sorted(best.items())] for seen, best in BEST.items()}


def code(role: str | None) -> int:
    """The state that a role's name asks for; 0 if it is none of the three."""
    name = (role or "").strip().lower()
    return NAMES.index(name) if name in NAMES[1:] else 0


def advance(cost: list[int], seen: int) -> tuple[list[int], list[int]]:
    """Costs of the states after one more turn, and the state before each."""
    new, back = [BIG] * 4, [0] * 4
    for s, t, c in MOVES[seen]:
        if cost[s] + c < new[t]:
            new[t], back[t] = cost[s] + c, s
    return new, back


def repair(codes: list[int], enter: int = START, leave: int | None = None) -> list[tuple[int, tuple]]:
    """(state before, option) of each turn on the cheapest way; ``leave``: the state to end in, else any with its ending."""
    cost, backs = [BIG] * 4, []
    cost[enter] = 0
    for seen in codes:
        cost, back = advance(cost, seen)
        backs.append(back)
    at = leave if leave is not None else min(range(4), key=lambda s: cost[s] + len(ENDING[s]) * COSTS["insert"])
    out = []
    for seen, back in zip(reversed(codes), reversed(backs), strict=True):
        out.append((back[at], BEST[seen][back[at], at]))
        at = back[at]
    return out[::-1]


def matrix(rows: list[list[int]], seen: int) -> list[list[int]]:
    return [advance(r, seen)[0] for r in rows]


def unit() -> list[list[int]]:
    return [[0 if s == t else BIG for t in range(4)] for s in range(4)]


def chain(matrices: list[list[list[int]]]) -> list[tuple[int, int]]:
    """State before and after each run of one conversation, on the cheapest way through all of them."""
    cost, backs = [0 if s == START else BIG for s in range(4)], []
    for m in matrices:
        new, back = [BIG] * 4, [0] * 4
        for s in range(4):
            for t in range(4):
                if cost[s] + m[s][t] < new[t]:
                    new[t], back[t] = cost[s] + m[s][t], s
        cost = new
        backs.append(back)
    at = min(range(4), key=lambda s: cost[s] + len(ENDING[s]) * COSTS["insert"])
    out = []
    for back in reversed(backs):
        out.append((back[at], at))
        at = back[at]
    return out[::-1]


def turn(role: int, text: str) -> str:
    return f"<|{NAMES[role]}|>\n{text}<|end|>\n"


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for the partition: its first and last run as (conv_id, turns, matrix)."""
    first, conv, n, rows, runs = None, None, 0, unit(), 0
    for batch in batches:
        for c, role in zip(batch["conv_id"].to_pylist(), batch["role"].to_pylist(), strict=True):
            if n and c != conv:
                first = first or (conv, n, rows)
                n, rows, runs = 0, unit(), runs + 1
            conv, n, rows = c, n + 1, matrix(rows, code(role))
    if n:
        pid, runs = TaskContext.get().partitionId(), runs + 1
        found = [(pid, 0, *first), (pid, 1, conv, n, rows)] if first else [(pid, 2, conv, n, rows)]
        cols = list(zip(*found, strict=True))
        yield pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64()), pa.array([[x for r in m for x in r] for m in cols[4]], pa.list_(pa.int64()))],
            names=["pid", "place", "conv_id", "n", "m"],
        )


def _spans(rows: list) -> dict[int, dict[int, tuple]]:
    """partition -> place -> (enter, leave or None, turns before, first of its conversation, last of it)."""
    out: dict[int, dict[int, tuple]] = {}
    rows = sorted(rows, key=lambda r: (r["pid"], r["place"]))
    i = 0
    while i < len(rows):
        j = i + 1
        while j < len(rows) and rows[j]["conv_id"] == rows[i]["conv_id"] and rows[j]["pid"] > rows[j - 1]["pid"]:
            j += 1
        if j - i > 1:
            states, before = chain([[r["m"][k : k + 4] for k in range(0, 16, 4)] for r in rows[i:j]]), 0
            for r, (enter, leave) in zip(rows[i:j], states, strict=True):
                out.setdefault(r["pid"], {})[r["place"]] = (enter, leave, before, r is rows[i], r is rows[j - 1])
                before += r["n"]
        i = j
    return out


def _render(run: list[tuple], span: tuple | None) -> list[tuple]:
    enter, leave, before, head, tail = span or (START, None, 0, True, True)
    ways, out, last = repair([code(r[2]) for r in run], enter, leave), [], len(run) - 1
    for i, ((conv, number, role, text), (_, (s, t, cost, action, inserted))) in enumerate(zip(run, ways, strict=True)):
        begun = not (head and i == 0)
        if action == "merge":
            piece = "\n" + (text or "")
        else:
            piece = ("<|end|>\n" if begun else "") + (turn(inserted, "") if inserted else "") + f"<|{NAMES[t]}|>\n" + (text or "")
        if tail and i == last:
            piece += "<|end|>\n" + "".join(turn(x, "") for x in ENDING[t])
            cost += len(ENDING[t]) * COSTS["insert"]
        out.append((conv, before + i, number, role, NAMES[t], action, NAMES[inserted] if inserted else None, cost, piece))
    return out


def _repaired(spans: dict[int, dict[int, tuple]]):
    def run_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = spans.get(TaskContext.get().partitionId(), {})
        run: list[tuple] = []
        state = {"runs": 0}

        def flush(last: bool) -> pa.RecordBatch:
            place = (2 if last else 0) if not state["runs"] else (1 if last else None)
            state["runs"] += 1
            cols = list(zip(*_render(run, own.get(place)), strict=True))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=[f.split()[0] for f in SCHEMA.split(", ")])

        for batch in batches:
            for row in zip(*(batch[c].to_pylist() for c in ("conv_id", "turn", "role", "text")), strict=True):
                if run and row[0] != run[0][0]:
                    yield flush(False)
                    run = []
                run.append(row)
        if run:
            yield flush(True)

    return run_all


def chat_format(turns: DataFrame) -> DataFrame:
    """``SCHEMA`` from rows of conv_id, turn, role, text."""
    spark = turns.sparkSession
    keys = ["conv_id", "turn", "role", "text"]
    slim = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    ordered = slim.repartitionByRange(n, *keys).sortWithinPartitions(*keys).checkpoint()
    found = ordered.mapInArrow(_summaries, "pid bigint, place bigint, conv_id bigint, n bigint, m array<bigint>").collect()
    return ordered.mapInArrow(_repaired(_spans(found)), SCHEMA)


def op6_chat_format(spark, sf_dir: str) -> DataFrame:
    """Every turn of ``conversations``, repaired and rendered."""
    return chat_format(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
