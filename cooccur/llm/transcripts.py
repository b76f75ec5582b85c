"""Roles of transcripts by a hidden Markov model over lines, and canonical turns.

The states of a line are its role and whether a turn begins with it. A line shows a speaker's
marker ("User:", "### Assistant", "Q:", ...), whether it follows a break, its length, and signs
such as a question mark or a list item. Transition and emission probabilities are counted from
labelled conversations; Viterbi's path then gives every line a state.

A conversation may be of any length. A message is a matrix of the best log probabilities from
the state before it to its last state; the matrices of up to ``SPAN`` neighbours are multiplied
(maximum of sums) to one, in as many levels as the longest conversation needs. Neighbours are told
by their number in the conversation, not by their turn, which any number of them may share. From the top
down, each level then fixes the states at the borders of the level below. So the path is exact,
and a task holds at most ``SPAN`` matrices or one message, never a conversation.

A null or empty text is one empty line. Null turns come first. Rows that agree in conversation,
turn and text are one message; equal turns are in the order of their texts' digests. A null conversation
is one of its own. Roles that are not in ``ROLES`` are not learned from.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cooccur.llm.frames import arrow_rows, freeze, learnable

ROLES = ("system", "user", "assistant")
STATES = len(ROLES) * 2  # role * 2, plus 1 for a line that continues a turn
SPAN = 256
FOLDS = 5
SMOOTHING = 0.5

#: Fixed speaker markers by role.
MARKERS = {
    "system": "system|instructions?|context|sys",
    "user": "user|human|customer|question|q|prompt|me|you",
    "assistant": "assistant|ai|bot|model|agent|answer|a|response|gpt",
}
_MARKER = re.compile(
    r"^\s*(?:[#>*<|\[]+\s*)?(?:(?P<system>" + MARKERS["system"] + r")|(?P<user>" + MARKERS["user"] + r")|(?P<assistant>"
    + MARKERS["assistant"] + r"))\s*(?:[|>\]*]+\s*:?|:)\s*", re.IGNORECASE)
_OTHER = re.compile(r"^\s*[A-Z][\w.' -]{0,30}:\s")
_LIST = re.compile(r"^\s*(?:[-*+]|\d+[.)])\s")
_QUESTION = re.compile(r"[?？¿]")

#: Values of each feature of a line.
FEATURES = (5, 3, 8, 2, 3)


def marker_of(line: str) -> tuple[int, int]:
    """(0 none, 1-3 a role, 4 another speaker; where the text after a role's marker starts)"""
    found = _MARKER.match(line)
    if found:
        return 1 + next(i for i, role in enumerate(ROLES) if found[role]), found.end()
    return (4, 0) if _OTHER.match(line) else (0, 0)


def line_features(lines: list[str], first_message: bool) -> np.ndarray:
    """A row of feature values for each line of a message."""
    rows = np.zeros((len(lines), len(FEATURES)), np.int64)
    after_break = 2 if first_message else 1
    for i, line in enumerate(lines):
        shape = 1 if _LIST.match(line) else 2 if line.startswith(("    ", "\t", "```", "|")) else 0
        rows[i] = (marker_of(line)[0], after_break, min(7, len(line).bit_length() // 2 if len(line) < 4096 else 7), bool(_QUESTION.search(line)), shape)
        after_break = 0 if line.strip() else 1
    return rows


_OFFSETS = np.concatenate([[0], np.cumsum(FEATURES)])


class Hmm:
    """Log probabilities of a start, of steps between states, and of the values of each feature."""

    def __init__(self, start: np.ndarray, step: np.ndarray, shows: np.ndarray) -> None:
        def logs(counts: np.ndarray, axis: int = -1) -> np.ndarray:
            counts = counts + SMOOTHING
            return np.log(counts / counts.sum(axis, keepdims=True))

        self.start = logs(start)
        self.step = logs(step)
        self.shows = np.concatenate([logs(shows[:, a:b]) for a, b in zip(_OFFSETS[:-1], _OFFSETS[1:], strict=True)], axis=1)

    def lines(self, features: np.ndarray, first: bool) -> np.ndarray:
        """For each line, a matrix: from the state before to its own state. The first line of all has none before."""
        seen = self.shows[:, features + _OFFSETS[:-1]].sum(2).T
        matrices = self.step[None] + seen[:, None, :]
        if first:
            matrices[0] = self.start + seen[0]
        return matrices


def product(matrices: np.ndarray) -> np.ndarray:
    """Best sums over paths through all matrices, by the states at both ends."""
    total = matrices[0]
    for matrix in matrices[1:]:
        total = (total[:, :, None] + matrix[None]).max(1)
    return total


def best_path(matrices: np.ndarray, entry: np.ndarray, last: int) -> np.ndarray:
    """The states after each matrix on the best path; ``last`` is the final one, or -1 if it is free."""
    score, back = entry, []
    for matrix in matrices:
        steps = score[:, None] + matrix
        back.append(steps.argmax(0))
        score = steps.max(0)
    state = int(score.argmax()) if last < 0 else last
    path = np.zeros(len(matrices), np.int64)
    for i in range(len(matrices) - 1, -1, -1):
        path[i] = state
        state = int(back[i][state])
    return path


def _lines(text: str | None) -> list[str]:
    return (text or "").split("\n")


def _key(conv_id: str) -> Column:
    return F.coalesce(F.concat(F.lit("id "), F.col(f"`{conv_id}`").cast("string")), F.lit("none"))


def _messages(talks: DataFrame, conv_id: str, turn: str, text: str) -> DataFrame:
    """(conv, conv_id, turn, text, tie, place, first): distinct messages.

    Places number a conversation's messages from 0 in the order of (turn, tie), without gaps;
    ``first`` marks its first message. The rows are sorted by ranges; a task numbers the messages of
    each conversation it meets, and a conversation that began in earlier tasks goes on from there.
    """
    rows = talks.select(
        _key(conv_id).alias("conv"), F.col(f"`{conv_id}`").alias("conv_id"), F.coalesce(F.col(f"`{turn}`").cast("long"), F.lit(-1)).alias("turn"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text")).distinct().withColumn("tie", F.md5(F.col("text").cast("binary")))

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, conv, n = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if batch.num_rows:
                keys = batch.column(0).to_numpy(zero_copy_only=False)
                starts = np.flatnonzero(np.concatenate([[keys[0] != conv], keys[1:] != keys[:-1]]))
                at = np.arange(len(keys))
                began = np.full(len(keys), -n)  # where the conversation of the last batch began
                if len(starts):
                    group = np.searchsorted(starts, at, "right") - 1
                    began = np.where(group >= 0, starts[np.maximum(group, 0)], -n)
                nth = at - began
                conv, n = keys[-1], int(nth[-1]) + 1
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(np.full(len(keys), part, np.int32)), pa.array(nth.astype(np.int64))], [*batch.schema.names, "_part", "_nth"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    held = freeze(rows.orderBy("conv", "turn", "tie").mapInArrow(numbered, f"{fields}, _part int, _nth long"))
    # A row per sort partition and conversation at its edge: only these can go on in another partition.
    edges = held.groupBy("_part").agg(F.min("conv").alias("low"), F.max("conv").alias("high"))
    edges = edges.select("_part", F.explode(F.array_distinct(F.array("low", "high"))).alias("conv"))
    sizes = held.join(F.broadcast(edges), ["_part", "conv"], "left_semi").groupBy("conv", "_part").agg(F.count("*").alias("_size"))
    earlier = W.partitionBy("conv").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("conv", "_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset")).where("_offset > 0")
    place = F.col("_nth") + F.coalesce("_offset", F.lit(0))
    return held.join(F.broadcast(offsets), ["conv", "_part"], "left").withColumn("place", place).withColumn(
        "first", F.col("place") == 0).drop("_part", "_nth", "_offset")


def fit(talks: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> Hmm:
    """Count starts, steps and line features over all labelled messages: tables of a fixed size.

    The step into a message comes from the role of a message one turn before it; messages after a
    gap in the turns say nothing about steps.
    """
    rows = talks.where(F.col(role).isin(*ROLES)).select(
        _key(conv_id).alias("conv"), F.coalesce(F.col(f"`{turn}`").cast("long"), F.lit(-1)).alias("turn"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
        F.array_position(F.array(*[F.lit(r) for r in ROLES]), F.col(role)).cast("int").alias("role")).distinct()
    before = rows.groupBy("conv", (F.col("turn") + 1).alias("turn")).agg(F.max(F.struct("text", "role"))["role"].alias("before"))
    least = rows.groupBy("conv").agg(F.min("turn").alias("_least"))
    known = rows.join(before, ["conv", "turn"], "left").join(least, "conv").select(
        "text", "role", F.coalesce("before", F.lit(0)).alias("before"), (F.col("turn") == F.col("_least")).alias("first"))

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        start, step, shows = np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros((STATES, _OFFSETS[-1]))
        for text, role, before, first in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            lines = _lines(text)
            begin = (role - 1) * 2
            if first:
                start[begin] += 1
            elif before:
                step[(before - 1) * 2 + 1, begin] += 1
                step[(before - 1) * 2, begin] += 1
            if len(lines) > 1:
                step[begin, begin + 1] += 1
                step[begin + 1, begin + 1] += len(lines) - 2
            features = line_features(lines, first) + _OFFSETS[:-1]
            for state, part in ((begin, features[:1]), (begin + 1, features[1:])):
                np.add.at(shows[state], part.ravel(), 1)
        flat = np.concatenate([start, step.ravel(), shows.ravel()])
        at = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(flat[at])], ["cell", "n"])

    total = np.zeros(STATES + STATES * STATES + STATES * _OFFSETS[-1])
    for row in arrow_rows(known, work, "cell int, n double").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        total[row["cell"]] = row["n"]
    a, b = STATES, STATES + STATES * STATES
    return Hmm(total[:a], total[a:b].reshape(STATES, STATES), total[b:].reshape(STATES, -1))


NODE = "conv string, place long, matrix array<double>"


def _in_groups(rows: DataFrame, columns: list[str], work: Callable[[dict, int, int], Iterator[tuple]], schema: str) -> DataFrame:
    """``work`` on each (conv, parent): the rows lie together and in order, so a task walks through them.

    ``work`` gets a batch's columns as lists (the matrices as one array) and where the group
    starts and ends. A group that a batch cuts is kept for the next one, at most ``SPAN`` rows.
    """
    names = [part.split()[0] for part in schema.split(", ")]
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "array<double>": pa.list_(pa.float64())}
    types = [kinds[part.split()[1]] for part in schema.split(", ")]
    ordered = rows.select("conv", "parent", *columns).repartition("conv", "parent").sortWithinPartitions("conv", "parent", "place")

    def done(table: pa.Table, last: bool) -> tuple[pa.RecordBatch, int]:
        held = {c: table[c].to_pylist() for c in table.column_names if c != "matrix"}
        held["matrix"] = np.array(table["matrix"].combine_chunks().flatten()).reshape(-1, STATES, STATES)
        keys = list(zip(held["conv"], held["parent"], strict=True))
        starts = [i for i in range(len(keys)) if i == 0 or keys[i] != keys[i - 1]]
        ends = [*starts[1:], len(keys)] if last else starts[1:]
        found = [row for low, high in zip(starts, ends, strict=False) for row in work(held, low, high)]
        cells = list(zip(*found, strict=True)) or [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cells, types, strict=True)], names), starts[-1]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            if batch.num_rows:
                own = pa.Table.from_batches([batch])
                table = own if rest is None else pa.concat_tables([rest, own])
                found, start = done(table, last=False)
                rest = table.slice(start)
                yield found
        if rest is not None:
            yield done(rest, last=True)[0]

    return ordered.mapInArrow(task, schema)


def _joined(held: dict, low: int, high: int) -> Iterator[tuple]:
    yield held["conv"][low], held["parent"][low], product(held["matrix"][low:high]).ravel().tolist()


def _up(nodes: DataFrame) -> DataFrame:
    """One level up: a node for each ``SPAN`` places of a conversation."""
    return _in_groups(nodes.withColumn("parent", F.floor(F.col("place") / SPAN)), ["place", "matrix"], _joined, NODE)


def _fixed(held: dict, low: int, high: int) -> Iterator[tuple]:
    before = held["p_before"][low]
    for i, state in enumerate(best_path(held["matrix"][low:high], _entry(before), held["p_last"][low]).tolist(), low):
        yield held["conv"][i], held["place"][i], before, state
        before = state


def _down(nodes: DataFrame, parents: DataFrame) -> DataFrame:
    """The states at both ends of each node, from those of its parent: (conv, place, before, last)."""
    above = parents.select("conv", F.col("place").alias("parent"), F.col("before").alias("p_before"), F.col("last").alias("p_last"))
    keyed = nodes.withColumn("parent", F.floor(F.col("place") / SPAN)).join(above, ["conv", "parent"])
    return _in_groups(
        keyed, ["place", "matrix", "p_before", "p_last"], _fixed, "conv string, place long, before int, last int")


def _entry(state: int) -> np.ndarray:
    entry = np.full(STATES, -1e300)
    entry[state] = 0.0
    return entry


def rendered(role: str, text: str) -> str:
    """A turn in canonical form."""
    return f"<|{role}|>\n{text}\n<|end|>\n"


def parse_transcripts(talks: DataFrame, model: Hmm, *, conv_id: str = "conv_id", turn: str = "turn", text: str = "text") -> DataFrame:
    """(conv_id, turn, part, role, text, rendered): the turns that Viterbi's path begins, in order.

    ``talks`` has the messages or pieces of transcripts in the order of ``turn``; a whole transcript
    may be a single row. Markers of roles at the beginning of a turn are left out of its text.
    """
    messages = _messages(talks, conv_id, turn, text)

    def matrices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts, firsts = batch.column(2).to_pylist(), batch.column(3).to_pylist()
        found = [product(model.lines(line_features(_lines(t), f), f)).ravel().tolist() for t, f in zip(texts, firsts, strict=True)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(found, pa.list_(pa.float64()))], ["conv", "place", "matrix"])

    levels = [freeze(arrow_rows(messages.select("conv", "place", "text", "first"), matrices, NODE))]
    levels.append(freeze(_up(levels[0])))
    while levels[-1].where("place > 0").head(1):
        levels.append(freeze(_up(levels[-1])))
    # At the top is one node per conversation; its first line does not depend on the state before.
    last = F.array_position("matrix", F.array_max(F.slice("matrix", 1, STATES))) - 1
    ends = levels[-1].select("conv", "place", F.lit(0).alias("before"), last.cast("int").alias("last"))
    for nodes in reversed(levels[:-1]):
        ends = freeze(_down(nodes, ends))
    decoded = messages.join(ends, ["conv", "place"]).select("conv_id", "turn", "text", "first", "before", "last")
    id_kind = decoded.schema["conv_id"].dataType.simpleString()

    def render(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        place, out = [], []
        for i, (text, first, before, last) in enumerate(zip(*[batch.column(c).to_pylist() for c in range(2, 6)], strict=True)):
            lines = _lines(text)
            path = best_path(model.lines(line_features(lines, first), first), _entry(before), last)
            starts = [0, *[j for j in range(1, len(lines)) if path[j] % 2 == 0 or path[j] // 2 != path[j - 1] // 2]]
            for part, (low, high) in enumerate(zip(starts, [*starts[1:], len(lines)], strict=True)):
                role, own = ROLES[path[low] // 2], lines[low:high]
                own[0] = own[0][marker_of(own[0])[1]:]
                body = "\n".join(own)
                place.append(i)
                out.append((part, role, body, rendered(role, body.strip())))
        columns = list(zip(*out, strict=True)) or [()] * 4
        taken = pa.array(place, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(taken), batch.column(1).take(taken),
             *[pa.array(list(c), k) for c, k in zip(columns, (pa.int32(), pa.string(), pa.string(), pa.string()), strict=True)]],
            ["conv_id", "turn", "part", "role", "text", "rendered"])

    return arrow_rows(decoded, render, f"conv_id {id_kind}, turn long, part int, role string, text string, rendered string").withColumn(
        "turn", F.when(F.col("turn") >= 0, F.col("turn")))


def recovered(talks: DataFrame, *, folds: int = FOLDS) -> DataFrame:
    """Learn from the conversations whose id's remainder is not 0, parse all."""
    return parse_transcripts(talks, fit(talks.where(learnable("conv_id", folds))))
