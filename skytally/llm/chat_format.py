"""Conversations as training windows: marked turns, a token budget, and a loss mask.

A window is a run of whole turns. Prefix sums of the turns' token counts say how
far it reaches: as far as the budget allows after the system turn, which every
window repeats, and a limited history, the last turns before the window. The
loss mask covers the assistants' texts and nothing else, and none that is
repeated, so every one of them is learned once.

Turns are marked with control strings. Where a text holds one, a backslash is
put behind its first character, and backslashes are doubled; ``unescaped``
undoes both, so that what is read back is exactly what went in.

A conversation is formatted in blocks of ``BLOCK_TURNS`` turn numbers, each by
one task that streams it, so a conversation of any length needs no task of its
own. Blocks of one conversation share its system turn, and hand their last
``HISTORY_TURNS`` turn numbers on. Turn numbers count turns; if they leave large
gaps, nothing is lost but windows get shorter.

Defined cases: null texts and roles are empty; turns come by number, nulls
first, equal numbers by role and text; repeated rows are turns of their own; the
system turn is the first one of that role; a turn beyond the budget is a window
of its own; a null conv_id is one conversation; no rows give no windows. Only
the four columns named here are read.
"""

from __future__ import annotations

import hashlib
import itertools
import os
import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytally.llm.common import TASK_ROWS, arrow_map

#: Control strings of the template. None holds a backslash or starts inside another.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|role|>")

WINDOW_TOKENS = 1024
HISTORY_TOKENS = 192
HISTORY_TURNS = 4
BLOCK_TURNS = 256  # a power of two
#: Characters of windows that a task gathers before it hands them on.
BATCH_CHARS = 4_000_000

_ESCAPED = re.compile(r"\\|" + "|".join(map(re.escape, CONTROLS)))
_TURN = re.compile(
    r"<<SYS>>\n(?P<system>.*?)\n<</SYS>>\n\n"
    r"|\[INST\] (?P<user>.*?) \[/INST\]"
    r"|<\|role\|>(?P<role>.*?)<\|role\|> (?P<other>.*?) </s>"
    r"| (?P<assistant>.*?) </s>",
    re.DOTALL,
)


def escaped(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\\\\" if m[0] == "\\" else f"{m[0][0]}\\{m[0][1:]}", text)


def unescaped(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


def marked(role: str, text: str) -> tuple[str, int, int]:
    """A turn in the template, and where in it its text starts and ends."""
    before, after = {
        "system": ("<<SYS>>\n", "\n<</SYS>>\n\n"),
        "user": ("[INST] ", " [/INST]"),
        "assistant": (" ", " </s>"),
    }.get(role) or (f"<|role|>{escaped(role)}<|role|> ", " </s>")
    piece = before + escaped(text) + after
    return piece, len(before), len(piece) - len(after)


def read_back(formatted: str) -> list[tuple[str, str]]:
    """``(role, text)`` of every turn of a window."""
    turns, at = [], len("<s>")
    if not formatted.startswith("<s>"):
        raise ValueError("not a formatted window")
    while at < len(formatted):
        found = _TURN.match(formatted, at)
        if found is None:
            raise ValueError(f"not a formatted window at {at}")
        kind = found.lastgroup
        role = unescaped(found["role"]) if kind == "other" else kind
        turns.append((role, unescaped(found[kind])))
        at = found.end()
    return turns


class _Block:
    """Windows of the turns of one block, taken one by one."""

    def __init__(self, budget: int, history: int):
        self.budget, self.history_budget = budget, history
        self.split = False  # whether the conversation has other blocks
        self.system: tuple[str, int] | None = None
        self.past: deque = deque(maxlen=HISTORY_TURNS)  # turns before the window: (piece, tokens)
        self.turns: list = []  # of the window: (role, piece, tokens, start and end of its text)
        self.sums = [0]  # prefix sums of the window's tokens
        self.windows = 0

    def remember(self, piece: str, tokens: int) -> None:
        if self.system is None or piece != self.system[0]:  # that one is repeated anyway
            self.past.append((piece, tokens))

    def _repeated(self) -> list[tuple[str, int]]:
        """What the window starts with: the system turn, and as much history as its first turn leaves room for."""
        system = [] if self.system is None else [self.system]
        room = min(self.history_budget, self.budget - 1 - self.turns[0][2] - sum(n for _, n in system))
        history: list = []
        for piece, tokens in reversed(self.past):
            room -= tokens
            if room < 0:
                break
            history.append((piece, tokens))
        return system + history[::-1]

    def add(self, role: str, text: str, tokens: int) -> dict | None:
        """Take a turn; returns the window that had to be closed for it."""
        closed = None
        if self.turns:
            fixed = 1 + sum(n for _, n in self._repeated())
            if fixed + self.sums[-1] + tokens > self.budget:
                closed = self.close()
        piece, *span = marked(role, text)
        self.turns.append((role, piece, tokens, span))
        self.sums.append(self.sums[-1] + tokens)
        return closed

    def close(self) -> dict | None:
        if not self.turns:
            return None
        repeated = self._repeated()
        pieces = ["<s>", *(piece for piece, _ in repeated)]
        at = sum(map(len, pieces))
        starts, ends = [], []
        for role, piece, tokens, (start, end) in self.turns:
            if role == "assistant":
                starts.append(at + start)
                ends.append(at + end)
            pieces.append(piece)
            at += len(piece)
            if role == "system" and self.system is None:
                self.system = (piece, tokens)
            self.remember(piece, tokens)
        window = {
            "window": self.windows,
            "formatted": "".join(pieces),
            "repeated": len(repeated),
            "loss_starts": starts,
            "loss_ends": ends,
            "n_tokens": 1 + sum(n for _, n in repeated) + self.sums[-1],
            "split": self.split,
        }
        self.turns, self.sums = [], [0]
        self.windows += 1
        return window


WINDOWS = {
    "conv_id": pa.int64(),
    "block": pa.int64(),
    "window": pa.int32(),
    "formatted": pa.string(),
    "repeated": pa.int32(),
    "loss_starts": pa.list_(pa.int32()),
    "loss_ends": pa.list_(pa.int32()),
    "n_tokens": pa.int64(),
    "split": pa.bool_(),
}
_WINDOWS_DDL = (
    "conv_id long, block long, window int, formatted string, repeated int, "
    "loss_starts array<int>, loss_ends array<int>, n_tokens long, split boolean"
)
#: What a row is to its block: a note that the conversation has others, its system turn, history, a turn of its own.
NOTE, SYSTEM, HISTORY, OWN = range(4)


def _turns(conversations: DataFrame) -> DataFrame:
    turn = F.col("turn").cast("long")
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.coalesce(F.shiftright(turn, BLOCK_TURNS.bit_length() - 1), F.lit(-(1 << 56))).alias("block"),
        turn.alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def _shared(turns: DataFrame) -> DataFrame:
    """Notes and system turns for the blocks of conversations that have several.

    Only the numbers of the turns are shuffled, and the texts of system turns.
    """
    blocks = turns.select("conv_id", "block").distinct()
    several = blocks.groupBy("conv_id").agg(F.count("*").alias("n")).where("n > 1")
    systems = turns.where("role = 'system'").groupBy("conv_id").agg(F.min(F.struct("block", "turn", "text")).alias("first"))
    listed = several.alias("c").join(systems.alias("s"), F.expr("c.conv_id <=> s.conv_id"), "left").select("c.conv_id", "first")
    found = blocks.alias("b").join(listed.alias("l"), F.expr("b.conv_id <=> l.conv_id"))
    kinds = F.array(
        F.struct(F.lit(NOTE).alias("kind"), F.lit("").alias("text")),
        F.when(F.col("first.block") < F.col("b.block"), F.struct(F.lit(SYSTEM).alias("kind"), F.col("first.text").alias("text"))),
    )
    return found.select("b.conv_id", "b.block", F.explode(F.array_compact(kinds)).alias("_")).select(
        "conv_id", "block", F.lit(None).cast("long").alias("turn"), F.lit("system").alias("role"), "_.text", "_.kind"
    )


def formatted(
    conversations: DataFrame, tokenizer: str, budget: int = WINDOW_TOKENS, history: int = HISTORY_TOKENS
) -> DataFrame:
    """The windows of all conversations; ``tokenizer`` is the tokenizer's JSON.

    ``(conv_id, block, window, formatted, repeated, loss_starts, loss_ends, n_tokens, split)``: the first
    ``repeated`` turns of a window are there for context; the loss covers the code points from each start
    to its end; ``split`` says whether the conversation has several blocks. Rows of a block stay together,
    in order.
    """
    turns = _turns(conversations)
    late = F.pmod("turn", F.lit(BLOCK_TURNS)) >= BLOCK_TURNS - HISTORY_TURNS
    places = F.array(
        F.struct(F.col("block"), F.lit(OWN).alias("kind")),
        F.when(late, F.struct((F.col("block") + 1).alias("block"), F.lit(HISTORY).alias("kind"))),
    )
    own = turns.withColumn("_", F.explode(F.array_compact(places))).select(
        "conv_id", "_.block", "turn", "role", "text", "_.kind"
    )
    rows = own.unionByName(_shared(turns)).repartition("conv_id", "block")
    ordered = rows.sortWithinPartitions("conv_id", "block", "kind", "turn", "role", "text")

    def mapped(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core
        from tokenizers import Tokenizer

        encoder = Tokenizer.from_str(tokenizer)
        encoder.no_truncation()
        encoder.no_padding()
        encoder.encode_special_tokens = True  # their strings in a text are ordinary text
        key, block, made, chars = None, None, [], 0

        def note(window) -> int:
            if window is None:
                return 0
            made.append({"conv_id": key[0], "block": key[1], **window})
            return len(window["formatted"])

        for batch in batches:
            for start in range(0, batch.num_rows, TASK_ROWS):
                part = batch.slice(start, TASK_ROWS).to_pylist()
                sizes = encoder.encode_batch([marked(r["role"], r["text"])[0] for r in part], add_special_tokens=False)
                for row, size in zip(part, sizes):
                    if key != (row["conv_id"], row["block"]):
                        chars += note(block.close()) if block else 0
                        key, block = (row["conv_id"], row["block"]), _Block(budget, history)
                    tokens = len(size.ids)
                    if row["kind"] == NOTE:
                        block.split = True
                    elif row["kind"] == OWN:
                        chars += note(block.add(row["role"], row["text"], tokens))
                    elif row["kind"] == SYSTEM:
                        block.system = (marked(row["role"], row["text"])[0], tokens)
                    else:
                        block.remember(marked(row["role"], row["text"])[0], tokens)
                if chars >= BATCH_CHARS:
                    yield _batch(made)
                    made, chars = [], 0
        if block:
            note(block.close())
        yield _batch(made)

    return arrow_map(ordered, mapped, _WINDOWS_DDL)


def _batch(rows: list[dict]) -> pa.RecordBatch:
    arrays = [pa.array([row[name] for row in rows], kind) for name, kind in WINDOWS.items()]
    return pa.RecordBatch.from_arrays(arrays, names=list(WINDOWS))


_READ = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("block", pa.int64()),
        ("window", pa.int32()),
        ("split", pa.bool_()),
        ("n_turns", pa.int64()),
        ("turns", pa.string()),
        ("loss", pa.string()),
        ("formatted_chars", pa.int64()),
    ]
)
_READ_DDL = (
    "conv_id long, block long, window int, split boolean, n_turns long, turns string, loss string, formatted_chars long"
)


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def turns_read(windows: DataFrame) -> DataFrame:
    """What each window holds, read back from its formatted text: its own turns, and the text under its loss mask."""

    def mapped(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, TASK_ROWS):
                made = []
                for row in batch.slice(start, TASK_ROWS).to_pylist():
                    text = row["formatted"]
                    own = read_back(text)[row["repeated"] :]
                    spans = zip(row["loss_starts"], row["loss_ends"])
                    made.append(
                        {
                            **{name: row[name] for name in ("conv_id", "block", "window", "split")},
                            "n_turns": len(own),
                            "turns": "".join(f"{role}\n{said}\n" for role, said in own),
                            "loss": "".join(unescaped(text[a:b]) for a, b in spans),
                            "formatted_chars": len(text),
                        }
                    )
                yield pa.RecordBatch.from_pylist(made, schema=_READ)

    return arrow_map(windows, mapped, _READ_DDL)


_DIGESTS = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
        ("n_windows", pa.int64()),
    ]
)
_DIGESTS_DDL = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long, n_windows long"
)


class _Digest:
    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = self.windows = 0

    def add(self, row: dict) -> None:
        self.turns.update(row["turns"].encode("utf-8", "surrogatepass"))
        self.loss.update(row["loss"].encode("utf-8", "surrogatepass"))
        self.n_turns += row["n_turns"]
        self.loss_chars += len(row["loss"])
        self.chars += row["formatted_chars"]
        self.windows += 1

    def row(self, conv_id: int | None) -> dict:
        return {
            "conv_id": conv_id,
            "n_turns": self.n_turns,
            "turns_sha256": self.turns.hexdigest(),
            "loss_chars": self.loss_chars,
            "loss_sha256": self.loss.hexdigest(),
            "formatted_chars": self.chars,
            "n_windows": self.windows,
        }


def _runs(batches, key) -> Iterator[tuple]:
    """``(key, rows)`` of neighbours with equal keys, rows as they come."""
    rows = (
        row
        for batch in batches
        for start in range(0, batch.num_rows, TASK_ROWS)
        for row in batch.slice(start, TASK_ROWS).to_pylist()
    )
    return itertools.groupby(rows, key)


def _in_batches(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    made = []
    for row in rows:
        made.append(row)
        if len(made) == TASK_ROWS:
            yield pa.RecordBatch.from_pylist(made, schema=schema)
            made = []
    yield pa.RecordBatch.from_pylist(made, schema=schema)


def digests(windows: DataFrame) -> DataFrame:
    """One row per conversation, from the windows as :func:`formatted` gives them.

    A conversation of one block is folded by the task that read it. Of one with
    several, the blocks are brought together; the digest of a sequence has to see
    it in order, but holds no more of it than a window.
    """

    def whole(batches):
        def rows():
            for (conv_id, split), run in _runs(batches, lambda r: (r["conv_id"], r["split"])):
                if split:
                    yield from ({**row, "digest": None} for row in run)
                else:
                    digest = _Digest()
                    for row in run:
                        digest.add(row)
                    yield {"conv_id": conv_id, "digest": digest.row(conv_id)}

        return _in_batches(rows(), folded)

    def joined(batches):
        def rows():
            for conv_id, run in _runs(batches, lambda r: r["conv_id"]):
                digest = _Digest()
                for row in run:
                    if row["digest"] is not None:
                        yield row["digest"]
                    else:
                        digest.add(row)
                if digest.windows:
                    yield digest.row(conv_id)

        return _in_batches(rows(), _DIGESTS)

    folded = pa.schema([*_READ, ("digest", pa.struct(list(_DIGESTS)))])
    kind = _DIGESTS_DDL.replace(" long", ":bigint").replace(" string", ":string")
    parts = arrow_map(turns_read(windows), whole, f"{_READ_DDL}, digest struct<{kind}>")
    ordered = parts.repartition("conv_id").sortWithinPartitions("conv_id", "block", "window")
    return arrow_map(ordered, joined, _DIGESTS_DDL)
