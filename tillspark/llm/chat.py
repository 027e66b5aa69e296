"""Chat formatting with the cheapest repair of turn order.

Method. A legal conversation is an optional system turn and then user and assistant in turn,
the assistant last. Each turn may keep its role, get another one, be merged into the turn
before it, or be preceded by empty turns; each has a cost (``COSTS``). A dynamic program over
the automaton's states picks the cheapest repair of the whole conversation; among equal ones
the first state in the order system, user, assistant wins, from the end backwards. The
repaired sequence is rendered with turn markers, one fragment per input turn: the fragments of
a conversation, in order of turn, concatenated, are its rendering.

Scale. Turns are range-partitioned by conversation and turn and written once, so that a
conversation with a third of all turns is spread over many partitions. The program runs in
each partition; of a conversation that crosses partitions only its cost matrix between the
automaton's states (4 x 4 numbers per partition) is combined, at most two per partition.

Defined cases. A turn without conv_id is a conversation by itself; turns without number come
first; equal numbers are ordered by role and text, repeated rows side by side. A null or
unknown role may become any role at a lower cost; white space and case of roles, and common
other names, do not matter. A null text is an empty turn. Markers inside texts are broken up.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillspark.session import staged

ROLES = ("system", "user", "assistant")
OTHER_NAMES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "ai": "assistant"}
COSTS = {"merge": 1, "relabel": 2, "name": 1, "insert": 3}
# states: 0 nothing yet, 1 system, 2 user, 3 assistant; turns inserted to get from one to another
START, SYSTEM, USER, ASSISTANT = range(4)
INSERTED = {
    (START, SYSTEM): (), (START, USER): (), (START, ASSISTANT): ("user",),
    (SYSTEM, USER): (), (SYSTEM, ASSISTANT): ("user",),
    (USER, ASSISTANT): (), (ASSISTANT, USER): (),
}
AT_END = {SYSTEM: ("user", "assistant"), USER: ("assistant",), ASSISTANT: ()}


def _turn_costs() -> np.ndarray:
    """costs[role, state, next]: of a turn whose role is 0-2, or 3 where it is unknown."""
    costs = np.full((4, 4, 4), math.inf)
    for role in range(4):
        for (state, following), inserted in INSERTED.items():
            named = 0 if role == following - 1 else COSTS["name"] if role == 3 else COSTS["relabel"]
            costs[role, state, following] = named + COSTS["insert"] * len(inserted)
        for state in (SYSTEM, USER, ASSISTANT):
            named = 0 if role == state - 1 else COSTS["name"] if role == 3 else COSTS["relabel"]
            costs[role, state, state] = named + COSTS["merge"]
    return costs


TURN_COSTS = _turn_costs()
END_COSTS = np.array([0.0, *(COSTS["insert"] * len(AT_END[s]) for s in (SYSTEM, USER, ASSISTANT))])


def segment_costs(roles: np.ndarray) -> np.ndarray:
    """Least cost between every two states over a run of turns."""
    total = np.where(np.eye(4, dtype=bool), 0.0, math.inf)
    for role in roles:
        total = (total[:, :, None] + TURN_COSTS[role][None]).min(axis=1)
    return total


def repair(roles: np.ndarray, entry: int = START, leave: int | None = None) -> list[int]:
    """States after each turn of the cheapest repair from ``entry``.

    Without ``leave`` the conversation ends here and the end counts; otherwise it is in that
    state after the last turn.
    """
    cost = np.full(4, math.inf)
    cost[entry] = 0
    back = []
    for role in roles:
        options = cost[:, None] + TURN_COSTS[role]
        back.append(options.argmin(axis=0))
        cost = options.min(axis=0)
    state = int((cost + END_COSTS).argmin()) if leave is None else leave
    states = []
    for choice in reversed(back):
        states.append(state)
        state = int(choice[state])
    return states[::-1]


def crossing(segments: list[dict]) -> dict[tuple[int, str], tuple[int, int | None]]:
    """(entry, leave) states of the segments of conversations that cross partitions.

    ``segments`` are the first and last conversation of each partition, in order, with their
    cost matrices; keys are (part, place).
    """
    out: dict[tuple[int, str], tuple[int, int | None]] = {}
    at = 0
    while at < len(segments):
        to = at + 1
        # the next partition's first conversation is the same one
        while (
            to < len(segments)
            and segments[to]["conv_id"] == segments[at]["conv_id"]
            and segments[to - 1]["place"] in ("last", "only")
            and segments[to]["place"] in ("first", "only")
        ):
            to += 1
        run = segments[at:to]
        if len(run) > 1:
            cost, back = np.array([0.0, math.inf, math.inf, math.inf]), []
            for segment in run:
                options = cost[:, None] + np.array(segment["costs"]).reshape(4, 4)
                back.append(options.argmin(axis=0))
                cost = options.min(axis=0)
            state, last = int((cost + END_COSTS).argmin()), True
            for segment, choice in zip(reversed(run), reversed(back)):
                before = int(choice[state])
                out[segment["part"], segment["place"]] = (before, None if last else state)
                state, last = before, False
        at = to
    return out


def _role_number(role: Column) -> Column:
    name = F.lower(F.trim(F.coalesce(role.cast("string"), F.lit(""))))
    number = F.lit(3)
    for other, meant in OTHER_NAMES.items():
        number = F.when(name == other, ROLES.index(meant)).otherwise(number)
    for i, known in enumerate(ROLES):
        number = F.when(name == known, i).otherwise(number)
    return number.cast("int")


def _segments(table: pa.Table):
    """(conv_id, low, high) of each conversation's rows in a table ordered by place."""
    ids = table.column("conv_id").to_numpy()
    cuts = np.flatnonzero(ids[1:] != ids[:-1]) + 1
    edges = [0, *cuts.tolist(), len(ids)]
    return [(int(ids[low]), low, high) for low, high in zip(edges[:-1], edges[1:])]


def _outer_segments(table: pa.Table) -> pa.Table:
    table = table.sort_by("at")
    roles = table.column("role_number").to_numpy()
    part = table.column("part")[0].as_py()
    runs = _segments(table)
    outer = [("only", runs[0])] if len(runs) == 1 else [("first", runs[0]), ("last", runs[-1])]
    return pa.table(
        {
            "part": [part] * len(outer),
            "place": [place for place, _ in outer],
            "conv_id": [run[0] for _, run in outer],
            "costs": [segment_costs(roles[low:high]).ravel().tolist() for _, (_, low, high) in outer],
        }
    )


def _decisions(roles: np.ndarray, entry: int, leave: int | None) -> list[tuple]:
    """(new_role, action, inserted, opens, ends, cost) of every turn of a segment."""
    out = []
    state = entry
    states = repair(roles, entry, leave)
    for i, (role, after) in enumerate(zip(roles.tolist(), states)):
        merged = state == after
        actions = [] if role == after - 1 else ["relabel"]
        if merged:
            actions.append("merge")
        inserted = () if merged else INSERTED[state, after]
        cost = TURN_COSTS[role, state, after]
        last = leave is None and i == len(states) - 1
        end = AT_END[after] if last else ()
        out.append(
            (
                ROLES[after - 1], "+".join(actions) or "keep", ",".join(inserted), ",".join(end),
                state == START, last, int(cost + COSTS["insert"] * len(end)),
            )
        )
        state = after
    return out


_DECISION = "new_role string, action string, inserted string, appended string, opens boolean, closes boolean, cost bigint"
_DECISION_NAMES = ["new_role", "action", "inserted", "appended", "opens", "closes", "cost"]


def _rendered(text: Column) -> Column:
    """Markers of a turn around its text; what precedes it closes the turn before."""

    def empty(names: Column) -> Column:
        turns = F.transform(F.filter(F.split(names, ","), lambda n: n != ""), lambda n: F.concat(F.lit("<|im_start|>"), n, F.lit("\n<|im_end|>\n")))
        return F.array_join(turns, "")

    safe = F.regexp_replace(F.coalesce(text, F.lit("")), r"<\|(im_start|im_end)\|>", "<| $1 |>")
    begin = F.concat(
        F.when(F.col("opens"), F.lit("")).otherwise(F.lit("<|im_end|>\n")), empty(F.col("inserted")),
        F.lit("<|im_start|>"), F.col("new_role"), F.lit("\n"),
    )
    end = F.when(F.col("closes"), F.concat(F.lit("<|im_end|>\n"), empty(F.col("appended")))).otherwise(F.lit(""))
    return F.concat(F.when(F.col("action").contains("merge"), F.lit("\n")).otherwise(begin), safe, end)


def repaired(turns: DataFrame) -> DataFrame:
    """Per input turn: conv_id, turn, role, new_role, action, inserted, appended, cost, rendered.

    ``inserted`` and ``appended`` name the empty turns before it and, at the end of the
    conversation, after it. Costs add up to the cost of the conversation's repair.
    """
    rows = turns.select(
        F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), F.col("role").cast("string").alias("role"),
        F.col("text").cast("string").alias("text"), _role_number(F.col("role")).alias("role_number"),
    )
    order = [F.col("conv_id"), F.col("turn"), F.col("role_number"), F.xxhash64("text"), F.col("role"), F.rand(7)]
    keyed = rows.where("conv_id is not null").select("*", *[c.alias(f"_{i}") for i, c in enumerate(order)])
    keys = [f"_{i}" for i in range(len(order))]
    ordered = keyed.repartitionByRange(*keys).sortWithinPartitions(*keys).drop(*keys)
    # the number of a row holds its partition above bit 33 and its place in it below
    ordered = staged(ordered.withColumn("at", F.monotonically_increasing_id()), "chat-turns")
    narrow = ordered.select(F.shiftright("at", 33).alias("part"), "at", "conv_id", "role_number")
    outer = narrow.groupBy("part").applyInArrow(
        _outer_segments, "part bigint, place string, conv_id bigint, costs array<double>"
    )
    found = [row.asDict() for row in outer.orderBy("part", "place").collect()]  # two per partition at most
    sent = turns.sparkSession.sparkContext.broadcast(crossing(found))

    def decide(table: pa.Table) -> pa.Table:
        table = table.sort_by("at")
        roles = table.column("role_number").to_numpy()
        part = table.column("part")[0].as_py()
        runs = _segments(table)
        out = []
        for number, (_, low, high) in enumerate(runs):
            place = "only" if len(runs) == 1 else {0: "first", len(runs) - 1: "last"}.get(number, "")
            out += _decisions(roles[low:high], *sent.value.get((part, place), (START, None)))
        columns = [pa.array(c) for c in zip(*out)]
        return pa.table([table.column("at").combine_chunks(), *columns], names=["at", *_DECISION_NAMES])

    decided = narrow.groupBy("part").applyInArrow(decide, f"at bigint, {_DECISION}")

    # a turn without conv_id is a conversation by itself: four cases, known beforehand
    alone_cases = [(role, *_decisions(np.array([role]), START, None)[0]) for role in range(4)]
    cases = turns.sparkSession.createDataFrame(alone_cases, f"role_number int, {_DECISION}")
    alone = rows.where("conv_id is null").join(F.broadcast(cases), "role_number")
    every = ordered.join(decided, "at").drop("at").unionByName(alone)
    return every.select(
        "conv_id", "turn", "role", "new_role", "action", "inserted", "appended", "cost",
        _rendered(F.col("text")).alias("rendered"),
    )
