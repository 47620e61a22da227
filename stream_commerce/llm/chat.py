"""Roles of transcript lines by a hidden Markov model, and canonical turns.

States are (role, first line of a turn) and (role, later line). A line shows a speaker marker
("User:", "### Assistant", "[system]", ...) or none, its length class and whether it ends as a
question. `train` counts starts, role changes, turn lengths and line features over all labelled turns
(plain grouping and one equi-join on the next turn, no sampling); how far markers are to be trusted is
a parameter, as labelled turns have none. `recover` finds the most probable states by Viterbi.

Long transcripts are cut into blocks of `BLOCK_LINES` lines, so no task holds a whole transcript of
unbounded length. Their lines are numbered by a range sort over all that orders them, which splits a
conversation. A block's best scores from each state before it to each state at its end are a matrix;
products of the matrices, `FAN` at a time, give each block the scores before it and after it, with which
it finds its part of the whole transcript's most probable states. A turn that goes on over a cut has a
part in either block's row.

A speaker marker is taken off only where it opens a turn of its own role; a heading that holds nothing else
goes as a line. All other lines stay as they are, so without the marks the rendering has every character of
the transcript. A line that looks like a mark of the rendering itself gets a backslash before it, which
`parsed` takes off again.

Defined cases: null text is one empty line; rows of one conversation with equal turn numbers follow
each other by role and text, equal rows one after the other, and in training each counts as followed by
every row of the next number; null conv_id is a conversation of its own, null turn comes first; a role
other than the known ones (or null) is not counted in training; an empty table trains a uniform model
and gives no rows; other columns are not read.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stream_commerce.llm.shared import saved

ROLES = ("system", "user", "assistant")
TRUST = 0.97
BLOCK_LINES = 64
FAN = 256
# Speaker names found before a colon or in a heading or brackets.
NAMES = {
    "system": "system", "sys": "system", "instruction": "system", "instructions": "system",
    "user": "user", "human": "user", "customer": "user", "q": "user", "question": "user", "prompter": "user",
    "assistant": "assistant", "ai": "assistant", "bot": "assistant", "gpt": "assistant", "model": "assistant",
    "a": "assistant", "answer": "assistant", "response": "assistant",
}
_MARKER = re.compile(
    r"^\s*(?:#{1,6}\s*|\*\*|<\|(?:im_start\|>)?|\[|\()?\s*([A-Za-z]{1,14})\s*(?:\*\*\s*:|:\s*\*\*|\|>|\]\s*:?|\)\s*:?|:|>)[ \t]?|"
    r"^\s*#{1,6}\s*([A-Za-z]{1,14})\s*$")
_MARK = re.compile(r"\\*<\|(?:system|user|assistant|end)\|>$")
LENGTHS = (1, 40, 120, 400)
FEATURES = 2 * (len(LENGTHS) + 1)


def marker(line: str) -> tuple[int, str]:
    """(0 none, or 1 + place in ROLES, 4 for any other speaker; the line without a known marker)."""
    hit = _MARKER.match(line)
    if not hit:
        return 0, line
    role = NAMES.get((hit[1] or hit[2]).lower())
    return (1 + ROLES.index(role), line[hit.end():]) if role else (4, line)


def heading(line: str) -> bool:
    """Whether the line is a marker in a heading and nothing else."""
    hit = _MARKER.match(line)
    return hit is not None and hit[2] is not None


def feature(line: Column) -> Column:
    """Length class and question mark as one number below FEATURES."""
    size = sum((F.char_length(line) >= n).cast("int") for n in LENGTHS)
    return 2 * size + F.rtrim(line).endswith("?").cast("int")


def turn_lines(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, digest, row, n, line): the lines of each turn, n from 0; digest of the text, row is unique."""
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("digest", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    return rows.select("conv_id", "turn", "role", "digest", "row", F.posexplode(F.split("text", "\n")).alias("n", "line"))


class Model:
    """Log probabilities of start, change and emission; states 2 * role + (1 for later lines)."""

    def __init__(self, start, change, more, seen, trust: float = TRUST):
        k = len(ROLES)
        start, change, more, seen = (np.asarray(x, float) for x in (start, change, more, seen))
        self.start = np.full(2 * k, 1e-9)
        self.start[::2] = start
        self.step = np.full((2 * k, 2 * k), 1e-9)
        for r in range(k):
            for s in (2 * r, 2 * r + 1):
                self.step[s, 2 * r + 1] = more[r]
                self.step[s, ::2] = (1 - more[r]) * change[r]
        self.seen = seen
        marks = np.full((2 * k, 5), (1 - trust) / 4)
        for r in range(k):
            # A turn may begin with its own marker or with none; a later line hardly has one.
            marks[2 * r, 1 + r] = trust * 0.8
            marks[2 * r, 0] = trust * 0.2
            marks[2 * r + 1, 0] = trust
        self.marks = marks
        self.log = [np.log(x) for x in (self.start, self.step, self.seen, self.marks)]

    def decode(self, marks: np.ndarray, features: np.ndarray, begins: bool = True,
               before: np.ndarray | None = None, after: np.ndarray | float = 0.0) -> np.ndarray:
        """States of the lines; `begins` if the first line opens the transcript. `before` has the best scores
        of the states of the line before, `after` those of all lines behind for the states of the last."""
        start, step, seen, mark = self.log
        emit = seen[:, features] + mark[:, marks]
        score = ((start if begins else 0) if before is None else (before[:, None] + step).max(0)) + emit[:, 0]
        back = np.zeros((len(marks), len(score)), np.int8)
        for i in range(1, len(marks)):
            ways = score[:, None] + step
            back[i] = ways.argmax(0)
            score = ways.max(0) + emit[:, i]
        states = np.empty(len(marks), np.int64)
        states[-1] = (score + after).argmax()
        for i in range(len(marks) - 1, 0, -1):
            states[i - 1] = back[i, states[i]]
        return states

    def matrix(self, marks: np.ndarray, features: np.ndarray, first: bool, begins: bool) -> np.ndarray:
        """Best score from each state before the lines to each state of the last; all rows alike for the
        `first` lines of a transcript."""
        start, step, seen, mark = self.log
        emit = seen[:, features] + mark[:, marks]
        ways = np.tile(start if begins else np.zeros(len(start)), (len(start), 1)) if first else step
        ways = ways + emit[:, 0]
        for i in range(1, len(marks)):
            ways = _product(ways, step) + emit[:, i]
        return ways


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a[:, :, None] + b).max(1)


def train(turns: DataFrame, trust: float = TRUST) -> Model:
    """Count a model over labelled turns (conv_id, turn, role, text)."""
    k = len(ROLES)
    place = F.array_position(F.lit(list(ROLES)), F.col("role")) - 1
    rows = turn_lines(turns).withColumn("r", place).filter("r >= 0")
    seen = np.ones((2 * k, FEATURES))
    lines = np.ones((k, 2))
    for x in rows.groupBy("r", (F.col("n") > 0).cast("int").alias("later"), feature(F.col("line")).alias("f")).count().collect():
        seen[2 * x["r"] + x["later"], x["f"]] += x["count"]
        lines[x["r"], x["later"]] += x["count"]
    # Rows that repeat a turn are counted before they meet the next turn's, so copies are not paired.
    whole = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), place.alias("r")).filter("r >= 0")
    counted = whole.groupBy("conv_id", "turn", "r").agg(F.count("*").alias("n"))
    after = counted.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("r").alias("next"), F.col("n").alias("m"))
    change = np.ones((k, k))
    pairs = F.sum(F.col("n").cast("double") * F.col("m"))
    for x in counted.join(after, ["conv_id", "turn"]).groupBy("r", "next").agg(pairs.alias("count")).collect():
        change[x["r"], x["next"]] += x["count"]
    start = np.ones(k)
    for x in whole.filter("turn = 0").groupBy("r").count().collect():
        start[x["r"]] += x["count"]
    return Model(start / start.sum(), change / change.sum(1, keepdims=True), lines[:, 1] / lines.sum(1),
                 seen / seen.sum(1, keepdims=True), trust)


def rendered(roles: list[str], turns: list[list[str]]) -> str:
    """Canonical turns: <|role|>, the lines, <|end|>, each on lines of its own."""
    rows = []
    for role, lines in zip(roles, turns, strict=True):
        rows += [f"<|{role}|>", *["\\" + x if _MARK.match(x) else x for x in lines], "<|end|>"]
    return "\n".join(rows)


def parsed(text: str) -> list[tuple[str, list[str]]]:
    """(role, lines) of each turn of a rendering."""
    turns = []
    for line in text.split("\n"):
        hit = _MARK.match(line)
        if hit and line[0] == "<":
            if line != "<|end|>":
                turns.append((line[2:-2], []))
        elif turns:
            turns[-1][1].append(line[1:] if hit else line)
    return turns


ORDER = ["turn", "role", "digest", "row", "n"]


def _conv(frame: pd.DataFrame):
    conv = frame["conv_id"].iloc[0]
    return None if pd.isna(conv) else int(conv)


def _opens(frame: pd.DataFrame) -> bool:
    turn = frame["turn"].iloc[0]
    return int(frame["block"].iloc[0]) == 0 and bool(pd.isna(turn) or turn == 0)


def _decode(model: Model):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(ORDER, na_position="first", kind="stable")
        marked = [marker(x) for x in frame["line"]]
        block, before, after = int(frame["block"].iloc[0]), frame["before"].iloc[0], frame["after"].iloc[0]
        states = model.decode(
            np.array([m for m, _ in marked]), frame["f"].to_numpy(np.int64), _opens(frame),
            None if before is None or block == 0 else np.array(before), 0.0 if after is None else np.array(after))
        roles, turns, matched = [], [], 0
        for state, (mark, rest), line, true in zip(states, marked, frame["line"], frame["role"], strict=True):
            role = ROLES[state // 2]
            matched += role == true
            if state % 2 == 0 or not roles or roles[-1] != role:
                roles.append(role)
                turns.append([])
            if state % 2 or mark != 1 + state // 2:
                turns[-1].append(line)
            elif not heading(line):
                turns[-1].append(rest)
        return pd.DataFrame([{
            "conv_id": _conv(frame), "block": block, "n_lines": len(frame), "n_turns": len(roles), "matched": matched,
            "roles": ",".join(roles), "rendered": rendered(roles, turns)}]).astype({"conv_id": "Int64"})

    return run


def _matrix(model: Model):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(ORDER, na_position="first", kind="stable")
        marks = np.array([marker(x)[0] for x in frame["line"]])
        block = int(frame["block"].iloc[0])
        ways = model.matrix(marks, frame["f"].to_numpy(np.int64), block == 0, _opens(frame))
        return pd.DataFrame([{"conv_id": _conv(frame), "block": block, "ways": ways.ravel()}]).astype({"conv_id": "Int64"})

    return run


def _square(flat) -> np.ndarray:
    return np.array(flat, float).reshape(2 * len(ROLES), -1)


def _joined(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.sort_values("block")
    ways = _square(frame["ways"].iloc[0])
    for x in frame["ways"].iloc[1:]:
        ways = _product(ways, _square(x))
    return pd.DataFrame([{
        "conv_id": _conv(frame), "block": int(frame["up"].iloc[0]), "ways": ways.ravel()}]).astype({"conv_id": "Int64"})


def _handed_down(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.sort_values("block")
    ways = [_square(x) for x in frame["ways"]]
    before, after = [np.array(frame["before"].iloc[0])], [np.array(frame["after"].iloc[0])]
    for x in ways[:-1]:
        before.append((before[-1][:, None] + x).max(0))
    for x in ways[:0:-1]:
        after.append((x + after[-1]).max(1))
    return pd.DataFrame({"conv_id": frame["conv_id"].astype("Int64"), "block": frame["block"], "before": before, "after": after[::-1]})


def _around(matrices: DataFrame, fan: int) -> DataFrame:
    """(conv_id, block, before, after) of blocks (conv_id, block, ways), `block` counting from 0."""
    none = F.array_repeat(F.lit(0.0), 2 * len(ROLES))
    if matrices.filter("block > 0").isEmpty():
        return matrices.select("conv_id", "block", none.alias("before"), none.alias("after"))
    rows = matrices.withColumn("up", F.floor(F.col("block") / fan).cast("int"))
    above = saved(rows.groupBy("conv_id", "up").applyInPandas(_joined, "conv_id long, block int, ways array<double>"), "matrices")
    outer = _around(above, fan).select(F.col("conv_id").alias("c"), F.col("block").alias("b"), "before", "after")
    held = rows.join(outer, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("up") == F.col("b"))).drop("c", "b")
    return saved(held.groupBy("conv_id", "up").applyInPandas(
        _handed_down, "conv_id long, block int, before array<double>, after array<double>"), "around")


def _cut(lines: DataFrame, block_lines: int) -> DataFrame:
    """The lines with their block: each conversation's lines numbered in order, whatever it holds."""
    placed = saved(lines.repartitionByRange("conv_id", *ORDER).sortWithinPartitions("conv_id", *ORDER).select(
        "*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), "chat-lines")
    one = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = placed.groupBy("conv_id", "part").agg(F.min("at").alias("low"), F.count("*").alias("held"))
    firsts = firsts.select(F.col("conv_id").alias("c"), F.col("part").alias("p"),
                           (F.col("low") - F.coalesce(F.sum("held").over(one), F.lit(0))).alias("low"))
    numbered = placed.join(firsts, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")))
    return numbered.withColumn("block", F.floor((F.col("at") - F.col("low")) / block_lines).cast("int")).drop("c", "p", "part", "at", "low")


def recover(lines: DataFrame, model: Model, block_lines: int = BLOCK_LINES, fan: int = FAN) -> DataFrame:
    """(conv_id, block, n_lines, n_turns, matched, roles, rendered) from lines as `turn_lines` gives them.

    `turn` only orders the lines; the roles come from the model. `matched` counts the lines whose role
    column agrees (0 where roles are unknown).
    """
    none = F.lit(None).cast("array<double>")
    held = lines.select("conv_id", *ORDER, "line", feature(F.col("line")).alias("f"))
    long = saved(lines.groupBy("conv_id").count().filter(F.col("count") > block_lines).select(F.col("conv_id").alias("x")), "long-chats")
    rows = held.join(long, F.col("conv_id").eqNullSafe(F.col("x")), "left_anti").select(
        "*", F.lit(0).alias("block"), none.alias("before"), none.alias("after"))
    if not long.isEmpty():
        cut = saved(_cut(held.join(long, F.col("conv_id").eqNullSafe(F.col("x")), "left_semi"), block_lines), "chat-blocks")
        matrices = saved(cut.groupBy("conv_id", "block").applyInPandas(
            _matrix(model), "conv_id long, block int, ways array<double>"), "matrices")
        around = _around(matrices, fan).withColumnRenamed("conv_id", "c").withColumnRenamed("block", "b")
        rows = rows.unionByName(cut.join(around, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b"))).drop("c", "b"))
    return rows.groupBy("conv_id", "block").applyInPandas(
        _decode(model), "conv_id long, block int, n_lines int, n_turns int, matched int, roles string, rendered string")


def marked(turns: DataFrame) -> DataFrame:
    """Turns as a transcript writes them: one marker style per conversation, every third turn bare."""
    style = F.pmod(F.xxhash64("conv_id"), F.lit(4))
    name = F.initcap(F.col("role"))
    short = F.when(F.col("role") == "user", "Human").when(F.col("role") == "assistant", "AI").otherwise(name)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    mark = (F.when(style == 0, F.concat(name, F.lit(": "))).when(style == 1, F.concat(F.lit("### "), name, F.lit("\n")))
            .when(style == 2, F.concat(F.lit("["), F.lower(name), F.lit("] "))).otherwise(F.concat(short, F.lit(": "))))
    bare = (F.pmod(F.xxhash64("conv_id", "turn"), F.lit(3)) == 0) | F.col("role").isNull()
    return turns.select("conv_id", "turn", "role", F.when(bare, text).otherwise(F.concat(mark, text)).alias("text"))
