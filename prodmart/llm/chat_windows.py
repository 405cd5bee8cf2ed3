"""Chat formatting in budgeted windows.

A turn is written `### role: text</turn>\\n`. Inside roles and texts every `\\`, `#`, `<` (and in roles `:`) gets a
backslash, so that control strings cannot appear there, and dropping the backslashes gives the text back.

Prefix sums of the turns' token counts cut a conversation into spans of whole turns: a span grows while the
system turn, the repeated history and the span stay within the budget. Each window repeats the system turn and
the last turns that fit into `history` tokens, then gives its own span. Only assistant texts of the span
are under the loss mask, so every one is a target once and repeated ones are masked.

Conversations stream through their task in turn order: one window is held at a time, whatever the length of the
conversation.

Defined results: a null text is empty and a null role is an empty role; turns sort by turn (null first), role and text,
so ties and repeated rows have one order; rows with a null conversation id are one conversation; a turn
over the budget is a window of its own, marked by its token count; an empty table gives no window.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .frames import map_batches
from .tokenizers import TOKENIZERS, byte_pair_counter, file_bytes

CONTROL = re.compile(r"([\\#<])")
ROLE_CONTROL = re.compile(r"([\\#<:\n])")
ESCAPED = re.compile(r"\\(.)", re.DOTALL)
# Possessive loops keep no state, so a turn of any length is matched in constant memory.
TURN = re.compile(r"### ((?:[^\\#<:\n]++|\\.)*+): ((?:[^\\#<]++|\\.)*+)</turn>\n", re.DOTALL)


def escape(text: str, control: re.Pattern = CONTROL) -> str:
    return control.sub(r"\\\1", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The turn as written, and where its text begins and ends in it."""
    head = f"### {escape(role, ROLE_CONTROL)}: "
    body = escape(text)
    return f"{head}{body}</turn>\n", len(head), len(head) + len(body)


def read_turns(window: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a formatted window; raises where the window is not in the template."""
    turns, at = [], 0
    while at < len(window):
        found = TURN.match(window, at)
        if not found:
            raise ValueError(f"no turn at {at}")
        turns.append((unescape(found[1]), unescape(found[2])))
        at = found.end()
    return turns


@dataclass(frozen=True)
class Budget:
    """Tokens of a window, and how many of them repeated history may take."""

    tokens: int = 1024
    history: int = 256
    target: str = "assistant"
    system: str = "system"


@dataclass
class Turn:
    role: str
    text: str
    begin: int
    end: int
    tokens: int


@dataclass
class Window:
    number: int
    text: str
    repeated: int
    turns: int
    tokens: int
    loss: list[tuple[int, int]]


def windows(turns: Iterator[tuple[str, str]], budget: Budget, count: Callable[[str], int]) -> Iterator[Window]:
    """The windows of one conversation, in order."""
    system: Turn | None = None
    past: deque[Turn] = deque()  # the last turns that fit into the history, without the system turn
    span: list[Turn] = []
    total = start = number = 0  # prefix sum of all turns, and its value where the span starts
    context: list[Turn] = []
    base = 0

    def window() -> Window:
        parts, loss, at = [], [], 0
        for i, t in enumerate([*context, *span]):
            if i >= len(context) and t.role == budget.target and t.end > t.begin:
                loss.append((at + t.begin, at + t.end))
            parts.append(t.text)
            at += len(t.text)
        return Window(number, "".join(parts), len(context), len(span), base + total - start, loss)

    for i, (role, text) in enumerate(turns):
        written, begin, end = format_turn(role, text)
        turn = Turn(role, written, begin, end, count(written))
        if span and base + total + turn.tokens - start > budget.tokens:
            yield window()
            number += 1
            for t in span:
                if t is not system:
                    past.append(t)
            held = sum(t.tokens for t in past)
            while past and held > budget.history:
                held -= past.popleft().tokens
            # history gives way when the next turn would not fit beside it
            room = budget.tokens - turn.tokens - (system.tokens if system else 0)
            again = list(past)
            while again and held > room:
                held -= again.pop(0).tokens
            context = ([system] if system else []) + again
            base, span, start = sum(t.tokens for t in context), [], total
        if i == 0 and role == budget.system:
            system = turn
        span.append(turn)
        total += turn.tokens
    if span:
        yield window()


WINDOW_FIELDS = [
    T.StructField("window", T.LongType()), T.StructField("text", T.StringType()), T.StructField("n_repeated", T.LongType()),
    T.StructField("n_turns", T.LongType()), T.StructField("n_tokens", T.LongType()),
    T.StructField("loss", T.ArrayType(T.StructType([T.StructField("begin", T.LongType()), T.StructField("end", T.LongType())]))),
]


def _by_id(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Scalar, Iterator[list]]]:
    """Rows grouped by the first column, which is sorted; each group has to be read before the next."""
    rows = (row for b in batches for row in zip(b.column(0), zip(*(c.to_pylist() for c in b.columns[1:]))))
    ahead = next(rows, None)

    def group(first: tuple) -> Iterator[tuple]:
        nonlocal ahead
        ahead = first
        while ahead is not None and ahead[0] == first[0]:
            yield ahead[1]
            ahead = next(rows, None)

    while ahead is not None:
        yield ahead[0], group(ahead)


def chat_windows(
    conversations: DataFrame, budget: Budget | None = None, tokenizers: str = TOKENIZERS, conv_id: str = "conv_id",
    turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """One row per window: the conversation id, `window`, `text`, `n_repeated` (leading turns that are context),
    `n_turns` (of its own), `n_tokens` and `loss` (code point spans of the targets)."""
    budget = budget or Budget()
    spark = conversations.sparkSession
    ranks = spark.sparkContext.broadcast(file_bytes(f"{tokenizers}/byte_bpe_50k.tiktoken"))
    kind = conversations.schema[conv_id].dataType
    rows = conversations.select(
        F.col(conv_id).alias("id"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    ).repartition("id").sortWithinPartitions("id", "turn", "role", "text").select("id", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = byte_pair_counter(ranks.value)
        loss_type = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
        for key, turns in _by_id(batches):
            for w in windows(turns, budget, count):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([key.as_py()], key.type), pa.array([w.number]), pa.array([w.text], pa.string()),
                        pa.array([w.repeated]), pa.array([w.turns]), pa.array([w.tokens]),
                        pa.array([[{"begin": b, "end": e} for b, e in w.loss]], loss_type),
                    ],
                    ["id", *(f.name for f in WINDOW_FIELDS)],
                )

    made = map_batches(rows, run, T.StructType([T.StructField("id", kind), *WINDOW_FIELDS]))
    return made.withColumnRenamed("id", conv_id)


def read_back(made: DataFrame, conv_id: str = "conv_id") -> DataFrame:
    """Per conversation, what its windows hold: turns, digest of roles and texts, and digest of the targets.

    Windows follow each other in their task, so no shuffle is needed; they are sorted again to be sure of it.
    """
    rows = made.select(conv_id, "window", "text", "n_repeated", "loss").sortWithinPartitions(conv_id, "window").drop("window")
    schema = T.StructType([
        made.schema[conv_id], T.StructField("n_turns", T.LongType()), T.StructField("turns_sha256", T.StringType()),
        T.StructField("loss_chars", T.LongType()), T.StructField("loss_sha256", T.StringType()),
        T.StructField("formatted_chars", T.LongType()), T.StructField("n_windows", T.LongType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, group in _by_id(batches):
            whole, targets = hashlib.sha256(), hashlib.sha256()
            n_turns = loss_chars = formatted = n = 0
            for text, repeated, loss in group:
                n += 1
                formatted += len(text)
                for role, said in read_turns(text)[repeated:]:
                    n_turns += 1
                    whole.update(f"{role}\n{said}\n".encode())
                for span in loss:
                    target = unescape(text[span["begin"] : span["end"]])
                    loss_chars += len(target)
                    targets.update(target.encode())
            values = [n_turns, whole.hexdigest(), loss_chars, targets.hexdigest(), formatted, n]
            yield pa.RecordBatch.from_arrays([pa.array([key.as_py()], key.type), *(pa.array([v]) for v in values)], schema.names)

    return map_batches(rows, run, schema)
