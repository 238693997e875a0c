"""Chat formatting with minimum-cost role repair.

A legal conversation is ``[system] (user assistant)+``. Turns that are not so are repaired at
the least total cost: a turn may be merged into the one before it (same role), relabelled, or
an empty turn may be inserted. Dynamic programming over the automaton of legal turns, with
the states start, system, user and assistant, finds the cheapest repair; of equal ones it
takes the smaller state.

Turns are sorted by conversation and turn and cut into blocks of ``BLOCK`` turns, however
long a conversation is. What a block does to a conversation is a matrix: the least cost from
each state before it to each state after it. For the conversations at the edges of blocks
these are multiplied (least sums) in the order of the blocks, which tells the states between
blocks. Then every block repairs its own turns. So a conversation with a third of all turns is
no task's burden; the table of matrices has two rows per block. Blocks hold roles only; texts are
joined to the decisions by the place of the turn and rendered turn by turn, so that long texts
never gather.

The result has one row per fragment: a turn, an inserted turn or the end. Fragments in the
order of ``place, part`` give the rendered conversation; merged turns stay fragments, so that
no text grows with a conversation. Roles are read without regard to case and by their usual
other names; any other role, null too, fits every state at the cost ``UNKNOWN``. Null texts
are empty. Turns without a number come first; turns with equal numbers are taken in the
order of a hash of role and text; repeated rows are turns of their own. Rows without a
conversation id are one conversation. An empty table gives no rows.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm import common
from kindred.llm.packing import number_sorted
from kindred.session import stage

BLOCK = 16384

# Roles by their names, and the costs of a repair.
STATES = ["start", "system", "user", "assistant"]
NAMES = {
    "system": 1, "developer": 1,
    "user": 2, "human": 2, "prompter": 2, "customer": 2,
    "assistant": 3, "gpt": 3, "bot": 3, "model": 3, "ai": 3, "chatbot": 3,
}
MERGE, RELABEL, UNKNOWN, INSERT = 1, 2, 1, 3
INF = 1 << 40

# From a state to a turn's state: the turns inserted between; None where there is no way.
BETWEEN = {
    (0, 1): [], (0, 2): [], (0, 3): [2],
    (1, 1): [], (1, 2): [], (1, 3): [2],
    (2, 1): None, (2, 2): [], (2, 3): [],
    (3, 1): None, (3, 2): [], (3, 3): [],
}
CLOSING = {0: None, 1: [2, 3], 2: [3], 3: []}  # inserted after the last turn


def role_of(role: str | None) -> int:
    return NAMES.get((role or "").strip().lower(), 0)


def step_cost(before: int, state: int, role: int) -> int:
    between = BETWEEN[before, state]
    if between is None:
        return INF
    label = 0 if role == state else RELABEL if role else UNKNOWN
    return label + INSERT * len(between) + MERGE * (before == state)


def end_cost(state: int) -> int:
    return INF if CLOSING[state] is None else INSERT * len(CLOSING[state])


_COSTS = {(b, s, r): step_cost(b, s, r) for b in range(4) for s in range(1, 4) for r in range(4)}


def forward(costs: list[int], roles: list[int]) -> list[list[int]]:
    """The least cost of every state before the first and after each of ``roles``."""
    out = [costs]
    for role in roles:
        last = out[-1]
        out.append([INF] + [min(last[b] + _COSTS[b, s, role] for b in range(4)) for s in (1, 2, 3)])
    return out


def _from(state: int) -> list[int]:
    return [0 if s == state else INF for s in range(4)]


def matrix(roles: list[int]) -> list[int]:
    """Least cost from each state to each state, row by row."""
    return [min(c, INF) for state in range(4) for c in forward(_from(state), roles)[-1]]


def best_end(costs: list[int]) -> int:
    return min(range(4), key=lambda s: (costs[s] + end_cost(s), s))


def path(entry: int, roles: list[int], exit_state: int | None) -> list[int]:
    """The states of ``roles`` on the cheapest way from ``entry`` to ``exit_state``, or to
    the best end where that is None."""
    costs = forward(_from(entry), roles)
    state = best_end(costs[-1]) if exit_state is None else exit_state
    states = []
    for k in range(len(roles), 0, -1):
        states.append(state)
        state = min(range(4), key=lambda b: (costs[k - 1][b] + _COSTS[b, state, roles[k - 1]], b))
    return states[::-1]


def chain(matrices: list[list[int]]) -> list[tuple[int, int | None]]:
    """For each block of a conversation the state it is entered in and left in (None: the
    conversation ends there)."""
    costs = [_from(0)]
    for m in matrices:
        costs.append([min(min(costs[-1][p] + m[4 * p + s] for p in range(4)), INF) for s in range(4)])
    state = best_end(costs[-1])
    out = []
    for k in range(len(matrices) - 1, -1, -1):
        left = state
        state = min(range(4), key=lambda p: (costs[k][p] + matrices[k][4 * p + left], p))
        out.append((state, left if k < len(matrices) - 1 else None))
    return out[::-1]


def _opened(state: int) -> str:
    return f"<|im_start|>{STATES[state]}\n"


_CLOSED = "<|im_end|>\n"


def fragments(entry: int, roles: list[int], states: list[int], texts: list[str], ends: bool):
    """``(turn in the block, part, role, action, rendered)`` of every fragment."""
    before = entry
    for k, (role, state, text) in enumerate(zip(roles, states, texts)):
        part = 0
        for inserted in BETWEEN[before, state]:
            yield k, part, STATES[inserted], "insert", (_CLOSED if before else "") + _opened(inserted)
            before, part = inserted, part + 1
        action = "keep" if role == state else "relabel"
        text = text.replace("<|im_", "<| im_")  # marks in a text are no marks
        if before == state:
            yield k, part, STATES[state], "merge" if role == state else "relabel and merge", "\n\n" + text
        else:
            yield k, part, STATES[state], action, (_CLOSED if before else "") + _opened(state) + text
        before = state
    if ends:
        part = 1000
        for inserted in CLOSING[before]:
            yield len(roles) - 1, part, STATES[inserted], "insert", _CLOSED + _opened(inserted)
            before, part = inserted, part + 1
        yield len(roles) - 1, part, STATES[before], "end", _CLOSED


def _runs(table: pa.Table):
    """``(conversation id, first row, end row)`` of a sorted block."""
    ids = table.column("conv_id").to_pylist()
    first = 0
    for k in range(1, len(ids) + 1):
        if k == len(ids) or ids[k] != ids[first]:
            yield ids[first], first, k
            first = k


EDGES = "conv_id long, block long, entry int, leave int"
RESULT = "conv_id long, turn long, place long, part int, role string, action string, rendered string"


def formatted(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """Every fragment of the repaired and rendered conversations."""
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).withColumn("_tie", F.xxhash64("role", "text"))
    placed = number_sorted(turns, "conv_id", "turn", "_tie").drop("_tie")
    placed = stage(placed.withColumn("block", F.floor(F.col("_place") / block).cast("long")), "turns")

    def edge_matrices(table: pa.Table) -> pa.Table:
        table = table.sort_by("_place")
        roles = [role_of(r) for r in table.column("role").to_pylist()]
        runs = list(_runs(table))
        rows = [
            {"conv_id": conv, "block": table.column("block")[0].as_py(), "matrix": matrix(roles[first:end])}
            for conv, first, end in runs if first == 0 or end == len(roles)
        ]
        return pa.Table.from_pylist(
            rows, pa.schema([("conv_id", pa.int64()), ("block", pa.int64()), ("matrix", pa.list_(pa.int64()))])
        )

    matrices = stage(
        placed.select("conv_id", "role", "_place", "block").groupBy("block")
        .applyInArrow(edge_matrices, "conv_id long, block long, matrix array<long>"),
        "matrices",
    )
    edge_schema = pa.schema([("conv_id", pa.int64()), ("block", pa.int64()), ("entry", pa.int32()), ("leave", pa.int32())])

    def states_between(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        found = chain(table.column("matrix").to_pylist())
        return pa.Table.from_arrays(
            [table.column("conv_id"), table.column("block"), pa.array([e for e, _ in found], pa.int32()),
             pa.array([x for _, x in found], pa.int32())], schema=edge_schema,
        )

    edges = stage(matrices.groupBy("conv_id").applyInArrow(states_between, EDGES), "edges")
    decided = pa.schema(
        [("_place", pa.int64()), ("before", pa.int32()), ("state", pa.int32()), ("ends", pa.bool_())]
    )

    def repair(table: pa.Table, known: pa.Table) -> pa.Table:
        table = table.sort_by("_place")
        between = {r["conv_id"]: (r["entry"], r["leave"]) for r in known.to_pylist()}
        raw, before, after, ends = table.column("role").to_pylist(), [], [], []
        for conv, first, end in _runs(table):
            entry, leave = between.get(conv, (0, None))
            states = path(entry, [role_of(r) for r in raw[first:end]], leave)
            before += [entry, *states[:-1]]
            after += states
            ends += [False] * (len(states) - 1) + [leave is None]
        columns = [table.column("_place"), *(pa.array(c, f.type) for c, f in zip((before, after, ends), list(decided)[1:]))]
        return pa.Table.from_arrays(columns, schema=decided)

    # Texts take no part in the decisions: blocks are of numbers and roles, and a turn meets its
    # text and its two states again by its place, of which there is one.
    states = (
        placed.select("conv_id", "role", "_place", "block").groupBy("block").cogroup(edges.groupBy("block"))
        .applyInArrow(repair, "_place long, before int, state int, ends boolean")
    )
    texts = placed.select("conv_id", "turn", "role", "text", "_place")
    return texts.join(states, "_place").mapInArrow(_rendered, RESULT)


def _rendered(batches):
    """The fragments of every turn."""
    names = [f.split()[0] for f in RESULT.split(", ")]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string()]
    schema = pa.schema(list(zip(names, types)))
    for batch in common.slices(batches):
        rows = [
            (r["conv_id"], r["turn"], r["_place"], part, role, action, text)
            for r in batch.to_pylist()
            for _, part, role, action, text in fragments(
                r["before"], [role_of(r["role"])], [r["state"]], [r["text"]], r["ends"]
            )
        ]
        yield common.batch_of(schema, dict(zip(names, map(list, zip(*rows)))))


def op9_chat_formatting(spark, sf_dir: str) -> DataFrame:
    return formatted(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
