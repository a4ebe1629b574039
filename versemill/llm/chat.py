"""Role repair of conversations at least cost, and their rendering.

The legal orders of roles form a small automaton. Each turn may keep its role, be relabelled, or
be merged into the turn before it, and empty turns may be put in front of it; the cheapest way
through the automaton is found by dynamic programming.

A step of the programme is a small (min, +) matrix, and matrices of consecutive turns multiply
in any grouping. So conversations are cut into segments, every segment gives one matrix, and the
state at each segment's start follows from a tree of products; a conversation of any length is
spread over many tasks.

Defined cases: turns are ordered by turn, then role, then text (absent first); equal rows stay in
any order, for they render alike; an absent or unknown role is cheap to relabel; an absent text is
empty; an absent conversation id is one conversation; roles are read without regard to case and
outer blanks; other columns are not read; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from versemill.session import cut_lineage

ROLES = ("system", "user", "assistant", "tool")
ALIASES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "function": "tool"}
START, SYSTEM, USER, ASSISTANT, TOOL = range(5)
#: state → states a new turn may lead to. A state is the role of the turn before.
LEGAL = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER, TOOL), TOOL: (ASSISTANT,)}
FINAL = (ASSISTANT,)
UNKNOWN = 0  # the input role of a turn that names none of ROLES
MERGE, RELABEL, RELABEL_UNKNOWN, INSERT = 1, 4, 2, 6
BIG = 10**12
#: Turns a segment, and segments (or groups of them) a node of the tree of products.
SEGMENT = 256
FAN_BITS = 8


def _insertions() -> list[list[tuple[int, ...] | None]]:
    """[from][to]: the shortest run of inserted turns after which the state is `to` (itself: none)."""
    out = []
    for start in range(5):
        best: list[tuple[int, ...] | None] = [None] * 5
        best[start] = ()
        todo = [start]
        for state in todo:
            for nxt in LEGAL[state]:
                if best[nxt] is None:
                    best[nxt] = (*best[state], nxt)
                    todo.append(nxt)
        out.append(best)
    return out


INSERTIONS = _insertions()


def _choices() -> list[list[list[tuple[int, str, int, tuple[int, ...]]]]]:
    """[input role][state before]: (cost, action, state after, inserted), the best for each state after."""
    out = []
    for role in range(5):
        by_state = []
        for state in range(5):
            options = []
            if state != START:
                change = 0 if role == state else RELABEL_UNKNOWN if role == UNKNOWN else RELABEL
                options.append((MERGE + change, "merge", state, ()))
            for between in range(5):
                inserted = INSERTIONS[state][between]
                if inserted is None:
                    continue
                for after in LEGAL[between]:
                    change = 0 if role == after else RELABEL_UNKNOWN if role == UNKNOWN else RELABEL
                    options.append((INSERT * len(inserted) + change, "relabel" if change else "keep", after, inserted))
            best = {}
            for option in sorted(options, key=lambda o: (o[0], o[2], o[1], o[3])):
                best.setdefault(option[2], option)
            by_state.append(list(best.values()))
        out.append(by_state)
    return out


CHOICES = _choices()
STEP = np.full((5, 5, 5), BIG, np.int64)
for _role in range(5):
    for _state in range(5):
        for _cost, _, _after, _ in CHOICES[_role][_state]:
            STEP[_role, _state, _after] = _cost
#: Cost of ending in a state, with the turns that are put behind.
ENDINGS = [min((INSERTIONS[s][f] for f in FINAL if INSERTIONS[s][f] is not None), key=len) for s in range(5)]
END_COST = np.array([INSERT * len(e) for e in ENDINGS], np.int64)


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The (min, +) product."""
    return np.minimum((a[:, :, None] + b[None, :, :]).min(1), BIG)


def product(matrices: list[np.ndarray]) -> np.ndarray:
    out = matrices[0]
    for m in matrices[1:]:
        out = times(out, m)
    return out


def best_states(matrices: list[np.ndarray], entry: int, leave: int) -> list[int]:
    """States before the first matrix, between them, and after the last (`leave`) at least cost."""
    costs = [np.where(np.arange(5) == entry, 0, BIG)]
    for m in matrices:
        costs.append(np.minimum((costs[-1][:, None] + m).min(0), BIG))
    states = [leave]
    for m, before in zip(matrices[::-1], costs[-2::-1]):
        states.append(int(np.argmin(before + m[:, states[-1]])))
    return states[::-1]


def best_end(matrix: np.ndarray) -> int:
    return int(np.argmin(matrix[START] + END_COST))


def role_code(role: str | None) -> int:
    name = (role or "").strip().lower()
    name = ALIASES.get(name, name)
    return ROLES.index(name) + 1 if name in ROLES else UNKNOWN


def opened(state: int) -> str:
    return f"<|{ROLES[state - 1]}|>\n"


CLOSED = "\n<|end|>\n"


def empty_turns(states: tuple[int, ...]) -> str:
    return "".join(opened(s) + CLOSED for s in states)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds `seg`, `pos` and, at the last turn of each segment, its matrix. Rows come in order.

    One row is held back, to see whether the segment ends with it.
    """
    part = TaskContext.get().partitionId()
    number, length, key = -1, 0, None
    matrix: np.ndarray | None = None
    held: pa.RecordBatch | None = None

    def with_matrices(batch, segs, poss, mats):
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(segs, pa.int64()), pa.array(poss, pa.int32()), pa.array(mats, pa.list_(pa.int64()))],
            names=[*batch.schema.names, "seg", "pos", "matrix"],
        )

    last_seg = last_pos = None
    for batch in batches:
        if not batch.num_rows:
            continue
        segs, poss, mats = [], [], []
        for conv, role in zip(batch.column("conv_id").to_pylist(), batch.column("role").to_pylist()):
            new = number < 0 or conv != key or length >= SEGMENT
            done = matrix.ravel().tolist() if new and matrix is not None else None
            if segs:
                mats.append(done)
            elif held is not None:
                yield with_matrices(held, [last_seg], [last_pos], [done])
            if new:
                number, length, key, matrix = number + 1, 0, conv, None
            step = STEP[role_code(role)]
            matrix = step if matrix is None else times(matrix, step)
            segs.append((part << 33) + number)
            poss.append(length)
            length += 1
        if batch.num_rows > 1:
            yield with_matrices(batch.slice(0, batch.num_rows - 1), segs[:-1], poss[:-1], mats)
        held, last_seg, last_pos = batch.slice(batch.num_rows - 1, 1), segs[-1], poss[-1]
    if held is not None:
        yield with_matrices(held, [last_seg], [last_pos], [matrix.ravel().tolist()])


def _multiply(key, pdf):
    """Matrices of one node in order → the node's matrix."""
    import pandas as pd

    pdf = pdf.sort_values("node")
    whole = product([np.array(m, np.int64).reshape(5, 5) for m in pdf["matrix"]])
    return pd.DataFrame({"conv_id": [pdf["conv_id"].iloc[0]], "node": [int(pdf["parent"].iloc[0])], "matrix": [whole.ravel().tolist()]})


def _descend(key, pdf):
    """A node's entry and exit → those of its children."""
    import pandas as pd

    pdf = pdf.sort_values("node")
    matrices = [np.array(m, np.int64).reshape(5, 5) for m in pdf["matrix"]]
    states = best_states(matrices, int(pdf["entry"].iloc[0]), int(pdf["leave"].iloc[0]))
    return pd.DataFrame(
        {
            "conv_id": pdf["conv_id"],
            "node": pdf["node"],
            "entry": pd.array(states[:-1], "Int32"),
            "leave": pd.array(states[1:], "Int32"),
            "last": [bool(pdf["last"].iloc[0]) and i == len(pdf) - 1 for i in range(len(pdf))],
        }
    )


def segment_states(segments: DataFrame) -> DataFrame:
    """(conv_id, seg, matrix) of conversations with several segments → entry, leave, last of each.

    A node of the tree holds the segments whose number is equal without its last FAN_BITS bits:
    256 at most, however long the conversation is.
    """
    id_type = dict(segments.dtypes)["conv_id"]
    level = cut_lineage(segments.select("conv_id", F.col("seg").alias("node"), "matrix"))
    levels = []
    while True:
        levels.append(level)
        if level.groupBy("conv_id").count().filter("count > 1").isEmpty():
            break
        parent = level.withColumn("parent", F.shiftright("node", FAN_BITS))
        grouped = parent.groupBy("conv_id", "parent").applyInPandas(
            _multiply, f"conv_id {id_type}, node long, matrix array<long>"
        )
        level = cut_lineage(grouped)
    costs = [F.col("matrix")[START * 5 + s] + F.lit(int(END_COST[s])) for s in range(5)]
    best = F.array_position(F.array(*costs), F.array_min(F.array(*costs))) - 1
    states = levels[-1].select("conv_id", "node", F.lit(START).alias("entry"), best.cast("int").alias("leave"), F.lit(True).alias("last"))
    for level in levels[-2::-1]:
        above = states.withColumnsRenamed({"conv_id": "_c", "node": "_n"})
        parent = level.withColumn("parent", F.shiftright("node", FAN_BITS))
        joined = parent.join(above, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("parent") == F.col("_n")))
        states = joined.drop("_c", "_n").groupBy("conv_id", "parent").applyInPandas(
            _descend, f"conv_id {id_type}, node long, entry int, leave int, last boolean"
        )
        states = cut_lineage(states)
    return states.withColumnRenamed("node", "seg")


def _render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turns of whole segments in order → their repair and their piece of the rendered text."""

    def segment(rows: list[dict]) -> list[dict]:
        codes = [role_code(r["role"]) for r in rows]
        steps = [STEP[c] for c in codes]
        first = rows[0]
        if first["entry"] is None:  # the conversation is this one segment
            entry, last = START, True
            leave = best_end(product(steps))
        else:
            entry, leave, last = first["entry"], first["leave"], first["last"]
        states = best_states(steps, entry, leave)
        out = []
        for row, code, before, after in zip(rows, codes, states, states[1:]):
            cost, action, _, inserted = next(c for c in CHOICES[code][before] if c[2] == after)
            text = row["text"] or ""
            if action == "merge":
                piece = "\n" + text
            else:
                piece = (CLOSED if before != START else "") + empty_turns(inserted) + opened(after) + text
            out.append(
                {
                    "conv_id": row["conv_id"], "seg": row["seg"], "pos": row["pos"], "turn": row["turn"],
                    "role": row["role"], "new_role": ROLES[after - 1], "action": action,
                    "inserted": [ROLES[s - 1] for s in inserted], "cost": cost, "rendered": piece,
                }
            )
        if last:
            ending = ENDINGS[leave]
            out[-1]["rendered"] += CLOSED + empty_turns(ending)
            out[-1]["appended"] = [ROLES[s - 1] for s in ending]
            out[-1]["cost"] += INSERT * len(ending)
        return out

    schema = None
    held: list[dict] = []
    for batch in batches:
        if schema is None:
            names = pa.list_(pa.string())
            schema = pa.schema(
                [batch.schema.field("conv_id"), ("seg", pa.int64()), ("pos", pa.int32()), batch.schema.field("turn"),
                 ("role", pa.string()), ("new_role", pa.string()), ("action", pa.string()), ("inserted", names),
                 ("appended", names), ("cost", pa.int64()), ("rendered", pa.string())]
            )
        done: list[dict] = []
        for row in batch.to_pylist():
            if held and row["seg"] != held[0]["seg"]:
                done += segment(held)
                held = []
            held.append(row)
        if done:
            yield pa.RecordBatch.from_pylist(done, schema)
    if held:
        yield pa.RecordBatch.from_pylist(segment(held), schema)


def repair(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) → one row a turn with its repair and its piece of the rendering.

    The pieces of a conversation, joined by `seg` and `pos`, are its rendered text. Every turn's
    row has the action (keep, relabel, merge), the new role, the empty turns put before it
    (`inserted`) or behind the conversation (`appended`), and the cost.
    """
    turns = conversations.select("conv_id", "turn", F.col("role").cast("string"), F.col("text").cast("string"))
    order = ["conv_id", "turn", "role", "_text"]
    keyed = turns.withColumn("_text", F.xxhash64("text"))
    sorted_turns = keyed.repartitionByRange(*order).sortWithinPartitions(*order).drop("_text")
    kinds = dict(turns.dtypes)
    fields = f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, role string, text string"
    cut = cut_lineage(sorted_turns.mapInArrow(_cut, f"{fields}, seg long, pos int, matrix array<long>"))
    segments = cut.filter("matrix IS NOT NULL").select("conv_id", "seg", "matrix")
    # Conversations of one segment are solved where they are rendered.
    longer = segments.groupBy(F.col("conv_id").alias("_c")).agg(F.count("*").alias("_n")).filter("_n > 1")
    several = segments.join(longer, F.col("conv_id").eqNullSafe(F.col("_c")), "left_semi")
    states = segment_states(several).select(F.col("seg").alias("_seg"), "entry", "leave", "last")
    joined = cut.drop("matrix").join(states, F.col("seg") == F.col("_seg"), "left").drop("_seg")
    grouped = joined.repartition("seg").sortWithinPartitions("seg", "pos")
    return grouped.mapInArrow(
        _render,
        f"conv_id {kinds['conv_id']}, seg long, pos int, turn {kinds['turn']}, role string, new_role string, action string,"
        " inserted array<string>, appended array<string>, cost long, rendered string",
    )
