"""Chat formatting: roles of transcript lines by a hidden Markov model.

A transcript is an ordered run of lines. Hidden states are (role, first
line of a turn) and (role, later line) for each of ``ROLES``. A line is
seen through its speaker marker (``User:``, ``### Assistant``, ``[system]``,
``<|tool|>``, ``**Human**:`` and the like, see ``ALIASES``), whether it is
blank, whether a blank line comes before it, its length class and a final
question mark. Transitions and emissions are counted with add-one
smoothing on a bounded sample of labelled conversations (``SAMPLE_TURNS``
rows, those with the smallest hash of their conversation); Viterbi finds
the best states of every line, and consecutive lines of a turn are
rendered as ``<|role|>``, text, ``<|end|>``.

Transcripts may be of any length: they are cut into blocks of ``BLOCK``
positions. Viterbi is a product of matrices in the (max, +) algebra, so a
transcript of several blocks first gets one matrix per block, then the
states at the block borders from those, and then each block is decoded
between its borders, all of them in parallel.

Cases: a null line counts as empty; lines come in the order of their
position, then line number, then text, so repeated rows interleave; a null
position comes first and a null key is a transcript of its own; roles that
are not known are ``other``; a transcript without any marker gets the most
likely roles by its lines alone; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.sorted_groups import group_bounds, key_rows, whole_groups
from tillroll.session import materialize

ROLES = ("system", "user", "assistant", "tool", "other")
ALIASES = {
    "system": ("system", "instruction", "instructions", "context"),
    "user": ("user", "human", "customer", "question", "q"),
    "assistant": ("assistant", "ai", "bot", "model", "answer", "a"),
    "tool": ("tool", "function", "observation"),
}
_ROLE_OF = {name: role for role, names in ALIASES.items() for name in names}
MARKER = re.compile(
    r"\s*(?:<\|(\w{1,20})\|>|\[(\w{1,20})\]|#{1,4}[ ]*(\w{1,20})[ ]*:?(?=\s|$)|\*\*(\w{1,20})\*\*[ ]*:|(\w{1,20})[ ]*:(?=\s|$))\s?")
NO_MARKER = len(ROLES)  # marker classes: one per role, then none
STATES = 2 * len(ROLES)  # 2r: first line of role r, 2r + 1: a later line
LENGTHS = 12
SAMPLE_TURNS = 20_000
BLOCK = 4096
SEED = 5

# how the transcripts of the conversations table write their markers
STYLES = ("{Name}: ", "**{Name}**: ", "### {Name}\n", "[{name}] ", "<|{name}|>\n")
HUMAN_NAMES = {"user": ("user", "human"), "assistant": ("assistant", "ai")}
UNMARKED_EVERY = 10  # one turn in so many has no marker, only a blank line before it


def marker(line: str) -> tuple[int, int]:
    """Marker class of a line and the length of the marker."""
    m = MARKER.match(line)
    if not m:
        return NO_MARKER, 0
    role = _ROLE_OF.get(m[m.lastindex].lower())
    if role is None:
        # a bare word with a colon may be anything: only known names count
        return (ROLES.index("other"), m.end()) if m.lastindex != 5 else (NO_MARKER, 0)
    return ROLES.index(role), m.end()


def observed(lines: list[str]) -> np.ndarray:
    """Marker, blank, after blank, length class and question of each line."""
    out = np.zeros((len(lines), 5), np.int64)
    blank = False
    for k, line in enumerate(lines):
        empty = not line.strip()
        out[k] = (marker(line)[0], empty, blank, min(len(line).bit_length(), LENGTHS - 1), line.rstrip().endswith("?"))
        blank = empty
    return out


FEATURE_SIZES = (len(ROLES) + 1, 2, 2, LENGTHS, 2)


class MarkovModel:
    """log tables: ``initial`` (S), ``step`` (S, S), ``emit`` per feature."""

    def __init__(self, transcripts: list[tuple[list[str], list[int]]]):
        initial = np.ones(STATES)
        initial[1::2] = 1e-3  # a transcript begins with a first line
        step = np.full((STATES, STATES), 0.2)
        for r in range(len(ROLES)):  # a later line follows its own role
            step[:, 2 * r + 1] = 1e-6
            step[2 * r : 2 * r + 2, 2 * r + 1] = 1.0
        emit = [np.full((STATES, size), 0.5) for size in FEATURE_SIZES]
        for r in range(len(ROLES)):  # a marker names its own role
            emit[0][2 * r, r] = 5.0
            emit[0][2 * r + 1, : len(ROLES)] = 0.01
        for lines, states in transcripts:
            if not states:
                continue
            initial[states[0]] += 1
            np.add.at(step, (states[:-1], states[1:]), 1)
            seen = observed(lines)
            for k, table in enumerate(emit):
                np.add.at(table, (states, seen[:, k]), 1)
        self.initial = np.log(initial / initial.sum())
        self.step = np.log(step / step.sum(1, keepdims=True))
        self.emit = [np.log(t / t.sum(1, keepdims=True)) for t in emit]

    def emissions(self, seen: np.ndarray) -> np.ndarray:
        return sum(table[:, seen[:, k]].T for k, table in enumerate(self.emit))

    def matrix(self, emissions: np.ndarray, first: bool) -> np.ndarray:
        """Best log probability from each state before a block to each state
        at its end (a block that comes first begins anew: equal rows)."""
        now = np.broadcast_to(self.initial + emissions[0], (STATES, STATES)) if first else self.step + emissions[0]
        for e in emissions[1:]:
            now = (now[:, :, None] + self.step[None]).max(1) + e
        return now

    def decode(self, emissions: np.ndarray, entry: int | None, exit_: int | None) -> np.ndarray:
        """Viterbi path; ``entry``: the state before the first line (None: a
        transcript begins), ``exit_``: the state of the last (None: any)."""
        n = len(emissions)
        back = np.zeros((n, STATES), np.int64)
        now = (self.initial if entry is None else self.step[entry]) + emissions[0]
        for k in range(1, n):
            ways = now[:, None] + self.step
            back[k] = ways.argmax(0)
            now = ways.max(0) + emissions[k]
        path = np.empty(n, np.int64)
        path[-1] = int(now.argmax()) if exit_ is None else exit_
        for k in range(n - 1, 0, -1):
            path[k - 1] = back[k, path[k]]
        return path


# --- transcripts of the conversations table ------------------------------------------


def turn_lines(conv_id: int | None, turn: int | None, role: str | None, text: str | None) -> list[str]:
    """A turn as transcript lines: a marker in the style of its conversation
    or, now and then, only a blank line before it."""
    seed = zlib.crc32(str(conv_id).encode())
    if zlib.crc32(f"{conv_id}:{turn}".encode()) % UNMARKED_EVERY == 0 and turn:
        return ["", *(text or "").split("\n")]
    names = HUMAN_NAMES.get(role or "other", (role or "other",))
    name = names[seed // 7 % len(names)]
    return (STYLES[seed % len(STYLES)].format(name=name, Name=name.capitalize()) + (text or "")).split("\n")


def transcript_lines(conversations: DataFrame) -> DataFrame:
    """(key, position, line_no, line) of the conversations' transcripts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: tuple[list, list, list, list] = ([], [], [], [])
            for conv, turn, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text")), strict=True):
                for k, line in enumerate(turn_lines(conv, turn, role, text)):
                    for column, value in zip(rows, (conv, turn, k, line), strict=True):
                        column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, kinds, strict=True)], ["key", "position", "line_no", "line"])

    source = conversations.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), F.col("role").cast("string"), "text")
    return source.mapInArrow(run, "key bigint, position bigint, line_no bigint, line string")


def train_model(conversations: DataFrame) -> MarkovModel:
    """Count on a bounded sample of labelled turns."""
    rows = (
        conversations.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), F.col("role").cast("string").alias("role"), "text")
        .orderBy(F.xxhash64(F.lit(SEED), "conv_id"), "conv_id", "turn", "role", "text").limit(SAMPLE_TURNS).collect()
    )
    transcripts: list[tuple[list[str], list[int]]] = []
    previous: object = object()
    for r in rows:
        if r["conv_id"] != previous:
            transcripts.append(([], []))
            previous = r["conv_id"]
        lines, states = transcripts[-1]
        own = ROLES.index(r["role"]) if r["role"] in ROLES else ROLES.index("other")
        new = turn_lines(*r)
        if new[0] == "" and len(new) > 1 and states:  # the blank line still belongs to the turn before
            states.append(states[-1] | 1)
            lines.append("")
            new = new[1:]
        states += [2 * own] + [2 * own + 1] * (len(new) - 1)
        lines += new
    return MarkovModel(transcripts)


# --- parsing ------------------------------------------------------------------------

GROUP = ["key_", "block"]


def parse_lines(lines: DataFrame, model: MarkovModel) -> DataFrame:
    """Roles of lines (key, position, line_no, line): adds role, turn (from
    0 in its transcript) and the line without its marker."""
    tables = vars(model)
    keyed = materialize(lines.select(
        "key", F.coalesce("position", F.lit(-1)).alias("position"), "line_no", F.coalesce("line", F.lit("")).alias("line"),
        F.coalesce(F.xxhash64("key"), F.lit(0)).alias("key_"), F.floor(F.coalesce("position", F.lit(-1)) / BLOCK).alias("block")), "chat-lines")
    blocks = keyed.groupBy("key", *GROUP).agg(F.count(F.lit(1)).alias("lines"))
    several = blocks.groupBy("key").agg(F.count(F.lit(1)).alias("blocks"), F.min("block").alias("first")).filter("blocks > 1")
    several = materialize(several, "chat-long")

    def same_key(a: str, b: str):
        return F.col(f"{a}.key").eqNullSafe(F.col(f"{b}.key"))

    def own_model() -> MarkovModel:
        out = object.__new__(MarkovModel)
        vars(out).update(tables)
        return out

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, int, int, list[str]]]:
        for table in whole_groups(batches, GROUP):
            bounds = group_bounds(key_rows(table, GROUP))
            texts = table.column("line").to_pylist()
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                yield table, a, b, texts[a:b]

    def block_matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hmm = own_model()
        for table, a, _, texts in pieces(batches):
            m = hmm.matrix(hmm.emissions(observed(texts)), table.column("block")[a].as_py() == table.column("first")[a].as_py())
            yield pa.RecordBatch.from_pydict({"key": pa.array([table.column("key")[a].as_py()], pa.int64()), "block": pa.array([table.column("block")[a].as_py()], pa.int64()),
                                              "matrix": pa.array([m.ravel().tolist()], pa.list_(pa.float64()))})

    def borders(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("block")
        matrices = [np.array(m).reshape(STATES, STATES) for m in rows["matrix"]]
        now, back = matrices[0][0], []
        for m in matrices[1:]:
            ways = now[:, None] + m
            back.append(ways.argmax(0))
            now = ways.max(0)
        states = [int(now.argmax())]
        for b in reversed(back):
            states.append(int(b[states[-1]]))
        states.reverse()  # the state at the end of each block
        return pd.DataFrame({"key": rows["key"].to_numpy(), "block": rows["block"].to_numpy(), "entry": [-1, *states[:-1]], "exit": states})

    partitions = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def by_block(rows: DataFrame) -> DataFrame:
        return rows.repartition(partitions, *GROUP).sortWithinPartitions(*GROUP, "position", "line_no", "line")

    long_lines = keyed.alias("l").join(several.alias("s"), same_key("l", "s")).select("l.*", "first")
    edges = by_block(long_lines).mapInArrow(block_matrices, "key bigint, block bigint, matrix array<double>").groupBy("key").applyInPandas(
        borders, "key bigint, block bigint, entry int, exit int")
    edges = materialize(edges, "chat-borders")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hmm = own_model()
        for table, a, b, texts in pieces(batches):
            entry, exit_ = table.column("entry")[a].as_py(), table.column("exit")[a].as_py()
            path = hmm.decode(hmm.emissions(observed(texts)), None if entry is None or entry < 0 else entry, exit_)
            first = path % 2 == 0
            if entry is None or entry < 0:
                first[0] = True
            shown = []
            for text, state in zip(texts, path.tolist(), strict=True):
                kind, length = marker(text)
                shown.append(text[length:] if state % 2 == 0 and kind == state // 2 else text)
            part = table.slice(a, b - a)
            yield pa.RecordBatch.from_arrays(
                [part.column(c).combine_chunks() for c in ("key", "key_", "block", "position", "line_no")]
                + [pa.array(shown, pa.string()), pa.array([ROLES[s // 2] for s in path.tolist()]), pa.array(first), pa.array(np.cumsum(first))],
                ["key", "key_", "block", "position", "line_no", "line", "role", "first", "local"])

    placed = keyed.alias("l").join(edges.alias("e"), same_key("l", "e") & (F.col("l.block") == F.col("e.block")), "left").select("l.*", "entry", "exit")
    schema = "key bigint, key_ bigint, block bigint, position bigint, line_no bigint, line string, role string, first boolean, local bigint"
    decoded = materialize(by_block(placed).mapInArrow(decode, schema), "chat-roles")
    # turns before a block: a window over the blocks of a transcript (one row each)
    starts = decoded.groupBy("key_", "block").agg(F.count_if("first").alias("starts"))
    earlier = Window.partitionBy("key_").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = starts.select("key_", "block", F.coalesce(F.sum("starts").over(earlier), F.lit(0)).alias("before"))
    return decoded.join(offsets, ["key_", "block"]).select(
        "key", "key_", "position", "line_no", "line", "role", (F.col("before") + F.col("local") - 1).alias("turn"))


def render_turns(parsed: DataFrame) -> DataFrame:
    """One row per turn: key, turn, role, n_lines, text, rendered."""
    lines = F.sort_array(F.collect_list(F.struct("position", "line_no", "line")))
    turns = parsed.groupBy("key_", "turn").agg(
        F.min("key").alias("key"), F.min("role").alias("role"), F.count(F.lit(1)).alias("n_lines"),
        F.array_join(F.transform(lines, lambda s: s["line"]), "\n").alias("raw"))
    # line breaks that only surround a turn are layout
    text = F.regexp_replace("raw", r"^\n+|\n+$", "")
    return turns.select("key", "turn", "role", "n_lines", text.alias("text"),
                        F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n"), text, F.lit("\n<|end|>")).alias("rendered"))


def format_conversations(conversations: DataFrame) -> DataFrame:
    """The conversations as transcripts, parsed and rendered anew."""
    model = train_model(conversations)
    return render_turns(parse_lines(transcript_lines(conversations), model)).withColumnRenamed("key", "conv_id")
