"""Conversations as training windows of a token budget.

Prefix sums of turn tokens cut a conversation into turn-aligned spans that fill the budget,
whatever its length. Every window repeats the leading system turn and limited history; the loss
mask covers assistant texts in the window that first shows them only.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scale import materialize, running
from .words import slices

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>\n"
# what opens a control string: of this template, or of other common ones
_CONTROL = r"(?=/?s>|/?INST\]|\|)"
_ESCAPE = rf"([<\[])(\\*){_CONTROL}"
_UNESCAPE = re.compile(rf"([<\[])\\(\\*){_CONTROL}")
_PARSE = re.compile(r"<\|turn\|>(.*?)<\|text\|>(.*?)<\|end\|>\n", re.S)
BUDGET = 2048
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pattern that splits text before the merges of the rank file.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def escape(text: Column) -> Column:
    """One backslash more behind < or [ wherever a control string could begin."""
    return F.regexp_replace(text, _ESCAPE, r"$1\\$2")


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2", text)


def token_counter(spark: SparkSession, ranks_path: str = RANKS):
    """A column function that counts byte-pair tokens; the driver reads the rank file.

    The vocabulary is a fixed file of about a megabyte and is broadcast.
    """
    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    shared = spark.sparkContext.broadcast(ranks)

    @F.pandas_udf("long")
    def count(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import tiktoken

        coder = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=shared.value, special_tokens={})
        for part in texts:
            yield part.map(lambda t: len(coder.encode_ordinary(t)))

    return count


_WINDOW = (
    "conv_id long, window long, text string, loss array<struct<start:long,end:long>>, n_repeated long, n_tokens long"
)
_LOSS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


SPAN = 8  # budgets in a stretch: what one task cuts into windows at a time


def choose_spans(tokens: list[int], first: int, system: int, held: bool, budget: int) -> list[tuple[int, int, int]]:
    """Windows of a stretch as (history start, start, end) in its turns, each as full as can be.

    The turns before `first` were shown before. `system` is the size of the leading system
    turn, 0 without one; `held` says that it is turn 0 here. A search in the prefix sums
    finds the oldest turn within the history's quarter of the budget, or the last turn where
    none is; the oldest go while the next turn would not fit. A second search finds the end.
    """
    sums = np.concatenate([[0], np.cumsum(tokens)])
    least, spans, start = int(held), [], first
    while start < len(tokens):
        room = budget - (0 if held and start == 0 else system)
        at = int(np.searchsorted(sums, sums[start] - budget // 4))
        at = min(max(min(at, start - 1), least), start)
        while at < start and sums[start + 1] - sums[at] > room:
            at += 1
        end = int(np.searchsorted(sums, sums[at] + room, "right")) - 1
        end = max(end, start + 1)
        spans.append((at, start, end))
        start = end
    return spans


def _assemble(batches, budget: int):
    kinds = [pa.int64(), pa.int64(), pa.string(), _LOSS, pa.int64(), pa.int64()]
    names = ["conv_id", "window", "text", "loss", "n_repeated", "n_tokens"]
    for batch in slices(batches):
        out = []
        for conv, stretch, turns, lead in zip(*(batch.column(i).to_pylist() for i in range(4))):
            sizes = [t["tokens"] for t in turns]
            held = lead is not None and turns[0]["pos"] == 0
            first = sum(not t["fresh"] for t in turns)
            spans = choose_spans(sizes, first, lead["tokens"] if lead else 0, held, budget)
            for k, (at, start, end) in enumerate(spans):
                parts, loss, size, n = [], [], 0, 0
                if lead is not None and not (held and start == 0):
                    parts, n = [f"{TURN}{lead['role']}{TEXT}{lead['body']}{END}"], lead["tokens"]
                repeated = len(parts) + start - at
                size = sum(map(len, parts))
                for i in range(at, end):
                    t = turns[i]
                    head = f"{TURN}{t['role']}{TEXT}"
                    if i >= start and t["answer"]:
                        loss.append({"start": size + len(head), "end": size + len(head) + len(t["body"])})
                    parts.append(f"{head}{t['body']}{END}")
                    size += len(parts[-1])
                out.append((conv, (stretch << 32) + k, "".join(parts), loss, repeated, n + sum(sizes[at:end])))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)


def chat_windows(turns: DataFrame, tokens, budget: int = BUDGET) -> DataFrame:
    """(conv_id, window, text, loss, n_repeated, n_tokens) from (conv_id, turn, role, text).

    A window takes fresh turns up to the budget, behind the system turn and its history: every
    trailing turn within a quarter of the budget, or the last turn alone if it is larger, as far
    as the first fresh turn still fits. So a conversation within the budget is one window, and a
    window exceeds it only if one turn with the system turn does: turns are never cut. A long
    conversation is cut at every SPAN budgets first, so that its stretches spread over tasks;
    the window at such a border may be shorter. `window` grows along the conversation, with
    gaps. `loss` holds code point ranges of `text`; `n_repeated`
    turns at the start (system, history) were shown before. Turns go by (turn, role, text),
    nulls first; null role and text are empty; rows that repeat are turns of their own; a null
    conv_id is a conversation; other columns are ignored; no rows give no windows.
    """
    step, history = SPAN * budget, budget // 4
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        escape(role).alias("role"), escape(text).alias("body"), (role == "assistant").alias("answer"),
        (role == "system").alias("system"),
    )
    shown = F.concat(F.lit(TURN), "role", F.lit(TEXT), "body", F.lit(END))
    rows = materialize(rows.withColumn("tokens", tokens(shown)), "turns")
    order = [F.col(c).asc_nulls_first() for c in ("turn", "role", "body")]
    one = F.lit(1).cast("long")
    placed = running(rows, ["conv_id"], order, {"pos": ("sum", one), "before": ("sum", F.col("tokens"))})
    placed = materialize(placed, "placed")
    no = F.lit(False)
    lead = placed.filter("pos = 0 and system").select(
        F.col("conv_id").alias("lead_conv"),
        F.struct("pos", no.alias("fresh"), "role", "body", "answer", "tokens").alias("lead"),
    )
    own = F.floor(F.col("before") / step)
    following = F.floor((F.col("before") + F.col("tokens")) / step)
    # the last turn before a stretch ends in it; the history before that ends in the stretch before
    later = F.when(following > own, following).when(F.col("before") >= (own + 1) * step - history, own + 1)
    again = later.isNotNull() & ~((F.col("pos") == 0) & F.col("system"))
    places = F.filter(
        F.array(
            F.struct(own.alias("stretch"), F.lit(True).alias("fresh")),
            F.when(again, F.struct(later.alias("stretch"), no.alias("fresh"))),
        ),
        lambda x: x.isNotNull(),
    )
    turn = F.struct("pos", "fresh", "role", "body", "answer", "tokens")
    stretches = (
        placed.select("*", F.inline(places))
        .groupBy("conv_id", "stretch")
        .agg(F.array_sort(F.collect_list(turn)).alias("turns"))  # SPAN budgets, the history and two turns at most
        .filter(F.exists("turns", lambda t: t["fresh"]))
    )
    joined = stretches.join(lead, F.col("conv_id").eqNullSafe(F.col("lead_conv")), "left")
    return joined.select("conv_id", "stretch", "turns", "lead").mapInArrow(lambda batches: _assemble(batches, budget), _WINDOW)


def read_turns(text: str) -> list[tuple[str, str]]:
    """(role, text) of the turns of a window, as they were before formatting."""
    return [(unescape(r), unescape(t)) for r, t in _PARSE.findall(text)]


_READ = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
    "n_windows long"
)


def _read_back(batches):
    """Windows arrive by conversation and window; digests grow along, so a long one needs no room."""
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_windows"]
    current, state, done = None, None, []

    def finish():
        n, turns, chars, loss, size, windows = state
        done.append((current, n, turns.hexdigest(), chars, loss.hexdigest(), size, windows))

    def flush():
        rows = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=names)
        done.clear()
        return rows

    for batch in slices(batches):
        for conv, _, text, loss, repeated, _ in zip(*(c.to_pylist() for c in batch.columns)):
            if state is None or conv != current:
                if state:
                    finish()
                current, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
            fresh = read_turns(text)[repeated:]
            state[0] += len(fresh)
            for role, body in fresh:
                state[1].update(f"{role}\n{body}\n".encode())
            for part in loss:
                body = unescape(text[part["start"] : part["end"]])
                state[2] += len(body)
                state[3].update(body.encode())
            state[4] += len(text)
            state[5] += 1
        if done:
            yield flush()
    if state:
        finish()
        yield flush()


def read_back(windows: DataFrame) -> DataFrame:
    """One row of digests per conversation, read from its windows alone.

    A digest is taken in order, so one task streams the windows of a conversation; it holds
    a batch of them at a time.
    """
    ordered = windows.repartition("conv_id").sortWithinPartitions("conv_id", "window")
    return ordered.mapInArrow(_read_back, _READ)
