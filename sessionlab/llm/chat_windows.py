"""Conversations as training windows of a bounded number of tokens.

A turn is written ``<s>[INST]role[/INST]text</s>``. Control strings inside a role or a text are
broken by a backslash behind their first character, and one more is added where backslashes stand
there already, so the way back is exact and text without control strings stays as it is.

The tokens of a turn are those of its text and of what stands before and behind it, each taken by
itself. Prefix sums of the tokens of a conversation's turns choose the windows. A window takes as many whole
turns as fit into ``budget`` tokens; the next one begins with the turn after. Every window begins
with the conversation's system turn, if its first turn is one of at most half the budget, and then
repeats the last turns before it as long as these have at most ``history`` tokens and the first new
turn still fits. The loss mask covers the texts of new assistant turns, so that each text is learnt
once however often it is repeated. A turn longer than the budget is never cut: it stands alone with
what is repeated, and its window is longer than the budget.

A conversation of more than ``CHUNK`` rows is numbered over range partitions and dealt out in chunks
of that many rows. A window ends where its chunk ends; the last ``HISTORY_TURNS`` turns of a chunk
travel to the next one, and the system turn to all, to be repeated there. All other conversations
move once. Tasks read sorted rows and hold the turns of one chunk at a time.

Rows are ordered by turn, then role and text; a missing turn comes first. A missing role or text is
empty, and rows without conv_id make up one conversation. Repeated rows are repeated turns.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlab.llm.bytes_bpe import codec, slices
from sessionlab.llm.common import stored
from sessionlab.operators.ranks import number_in_groups

BUDGET = 1024
HISTORY = 256
CHUNK = 4096
HISTORY_TURNS = 64
MANY_ROLES = 10_000
CUT_BY = 64  # characters of a text that range partitions are cut by
OPEN, ROLE, SAYS, CLOSE = "<s>", "[INST]", "[/INST]", "</s>"
SYSTEM, ASSISTANT = "system", "assistant"
# Between the first character of a control string, any backslashes, and the rest of the string.
ESCAPE = re.compile(r"(?<=<)\\*(?=/?s>)|(?<=\[)\\*(?=/?INST\])")
UNESCAPE = re.compile(r"(?<=<)\\+(?=/?s>)|(?<=\[)\\+(?=/?INST\])")
TURN = re.compile(r"<s>\[INST\](.*?)\[/INST\](.*?)</s>", re.DOTALL)

# Why a turn is in a chunk.
SYSTEM_TURN, LAST_TURN, OWN_TURN = 0, 1, 2

SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
WINDOW = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("chunk", pa.int64()),
        ("window", pa.int64()),
        ("text", pa.string()),
        ("tokens", pa.int64()),
        ("turns", pa.int64()),
        ("repeated", pa.int64()),
        ("loss", SPAN),
    ]
)
WINDOW_TYPE = (
    "conv_id long, chunk long, window long, text string, tokens long, turns long, repeated long, "
    "loss array<struct<start:bigint,end:bigint>>"
)
DIGEST = pa.schema(
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
DIGEST_TYPE = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long, n_windows long"
)


def escape(text: str) -> str:
    """No control string is left; see :func:`unescape`."""
    return ESCAPE.sub(lambda m: "\\" + m.group(), text)


def unescape(text: str) -> str:
    return UNESCAPE.sub(lambda m: m.group()[1:], text)


class Turn(NamedTuple):
    formatted: str
    start: int  # of the text in it
    end: int
    tokens: int
    learnt: bool


def write_turn(role: str, text: str) -> tuple[str, int, int]:
    """(the turn, start and end of the text in it)."""
    head = f"{OPEN}{ROLE}{escape(role)}{SAYS}"
    body = escape(text)
    return f"{head}{body}{CLOSE}", len(head), len(head) + len(body)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn."""
    return [(unescape(role), unescape(text)) for role, text in TURN.findall(formatted)]


def choose_spans(
    tokens: list[int], first: int, lead: int, fixed: int, budget: int, history: int
) -> list[tuple[int, int, int]]:
    """(first repeated turn, first new turn, end) of every window over turns of so many tokens. New
    turns begin at ``first``; ``lead`` tokens stand in front of every window whose first new turn is
    not before ``fixed``, and turns before ``fixed`` are not repeated."""
    ends = np.cumsum([0, *tokens])
    spans = []
    while first < len(tokens):
        room = budget - (lead if first >= fixed else 0)
        spare = max(min(history, room - tokens[first]), 0)
        back = int(np.searchsorted(ends, ends[first] - spare, side="left"))
        back = max(back, first - HISTORY_TURNS, min(fixed, first))
        reach = ends[back] + room
        last = max(int(np.searchsorted(ends, reach, side="right")) - 1, first + 1)
        spans.append((back, first, last))
        first = last
    return spans


def windows_of_chunk(
    system: Turn | None, earlier: list[Turn], new: list[Turn], leads: bool, budget: int, history: int
) -> Iterator[dict]:
    """Windows of the turns of a chunk. ``system`` comes from an earlier chunk; with ``leads`` the
    first new turn is the system turn."""
    turns = earlier + new
    lead = new[0] if leads else system
    if lead is not None and lead.tokens > budget // 2:
        lead = None
    fixed = 1 if leads and lead else 0
    spans = choose_spans(
        [t.tokens for t in turns], len(earlier), lead.tokens if lead else 0, fixed, budget, history
    )
    for number, (back, first, last) in enumerate(spans):
        chosen = turns[back:last]
        repeated = first - back
        if lead and first >= fixed:
            chosen, repeated = [lead, *chosen], repeated + 1
        at, loss = 0, []
        for place, turn in enumerate(chosen):
            if place >= repeated and turn.learnt:
                loss.append({"start": at + turn.start, "end": at + turn.end})
            at += len(turn.formatted)
        yield {
            "window": number,
            "text": "".join(t.formatted for t in chosen),
            "tokens": sum(t.tokens for t in chosen),
            "turns": len(chosen),
            "repeated": repeated,
            "loss": loss,
        }


def _format(rows: DataFrame, vocabulary: str, pattern: str, budget: int, history: int) -> DataFrame:
    """Windows of rows (conv_id, chunk, kind, turn, role, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(vocabulary, pattern)
        key, turns, out = None, {}, []
        frames: dict[str, int] = {}  # tokens around the text, by role

        def begin(new_key: tuple | None) -> None:
            nonlocal key, turns
            if key is not None:
                system = turns[SYSTEM_TURN][0] if turns[SYSTEM_TURN] else None
                made = windows_of_chunk(
                    system, turns[LAST_TURN], turns[OWN_TURN], turns["leads"], budget, history
                )
                out.extend({"conv_id": key[0], "chunk": key[1], **window} for window in made)
            key = new_key
            turns = {SYSTEM_TURN: [], LAST_TURN: [], OWN_TURN: [], "leads": False}

        for part in slices(batches, 500):
            columns = (part[n].to_pylist() for n in ("conv_id", "chunk", "kind", "role", "text"))
            for conv_id, chunk, kind, role, text in zip(*columns):
                if key != (conv_id, chunk):
                    begin((conv_id, chunk))
                    turns["leads"] = chunk == 0 and role == SYSTEM
                formatted, start, end = write_turn(role, text)
                head = formatted[:start]
                if head not in frames:
                    frames[head] = len(own.encode(head)) + len(own.encode(CLOSE))
                tokens = frames[head] + len(own.encode(formatted[start:end]))
                turns[kind].append(Turn(formatted, start, end, tokens, role == ASSISTANT))
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=WINDOW)
                out.clear()
            if len(frames) > MANY_ROLES:
                frames.clear()
        begin(None)
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=WINDOW)

    order = ["conv_id", "chunk", "kind", "turn", "role", "text"]
    return rows.repartition("conv_id", "chunk").sortWithinPartitions(*order).mapInArrow(run, WINDOW_TYPE)


def _turns(conversations: DataFrame) -> DataFrame:
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    return conversations.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), empty("role"), empty("text")
    )


def _in_chunks(rows: DataFrame, sizes: DataFrame, chunk_rows: int) -> DataFrame:
    """The rows of long conversations, dealt to their chunk and, where they are repeated, to the
    next ones. ``sizes`` has (id, size) of the conversations."""
    order = [F.col(c).asc_nulls_first() for c in ("turn", "role", "text")]
    cut = [*order[:2], F.substring("text", 1, CUT_BY)]
    numbered = number_in_groups(rows, ["conv_id"], order, "number", ranges_by=cut)
    sized = numbered.join(sizes, F.col("conv_id").eqNullSafe(F.col("id")))
    number = F.col("number") - 1
    chunk = F.floor(number / chunk_rows).cast("long")
    last_chunk = F.floor((F.col("size") - 1) / chunk_rows).cast("long")
    deal = lambda to, kind: F.struct(to.alias("chunk"), F.lit(kind).alias("kind"))
    none = F.array().cast("array<struct<chunk:bigint,kind:int>>")
    again = (number % chunk_rows >= chunk_rows - HISTORY_TURNS) & (chunk < last_chunk)
    leads = (number == 0) & (F.col("role") == SYSTEM) & (last_chunk > 0)
    later = F.sequence(F.lit(1).cast("long"), F.greatest(last_chunk, F.lit(1).cast("long")))
    dealt = F.concat(
        F.array(deal(chunk, OWN_TURN)),
        F.when(again, F.array(deal(chunk + 1, LAST_TURN))).otherwise(none),
        F.when(leads, F.transform(later, lambda c: deal(c, SYSTEM_TURN))).otherwise(none),
    )
    return sized.select("conv_id", "turn", "role", "text", F.inline(dealt))


def windows(
    conversations: DataFrame,
    vocabulary: str,
    pattern: str,
    budget: int = BUDGET,
    history: int = HISTORY,
    chunk_rows: int = CHUNK,
) -> tuple[DataFrame, DataFrame]:
    """Windows of the short and of the long conversations: conv_id, chunk, window, text, tokens,
    turns, repeated (how many of the turns, the first ones, are repeated) and loss (code points).
    Those of a short conversation stand one after the other in a partition."""
    rows = _turns(conversations)
    counts = rows.groupBy("conv_id").agg(F.count("*").alias("size")).filter(F.col("size") > chunk_rows)
    sizes = stored(counts.withColumnRenamed("conv_id", "id"), "long_conversations")
    is_long = F.col("conv_id").eqNullSafe(F.col("id"))
    short = rows.join(sizes, is_long, "left_anti").withColumns(
        {"chunk": F.lit(0).cast("long"), "kind": F.lit(OWN_TURN)}
    )
    settings = (vocabulary, pattern, budget, history)
    made = _format(short, *settings)
    if sizes.isEmpty():
        return made, made.limit(0)
    long_rows = rows.join(sizes, is_long, "left_semi")
    return made, _format(_in_chunks(long_rows, sizes, chunk_rows), *settings)


def _read_back(made: DataFrame) -> DataFrame:
    """One row per conversation from windows that stand in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict | None = None
        out: list[dict] = []

        def finish() -> None:
            if state is not None:
                digests = {k: state[k].hexdigest() for k in ("turns_sha256", "loss_sha256")}
                out.append(state | digests)

        for part in slices(batches, 500):
            names = ("conv_id", "text", "repeated", "loss")
            for conv_id, text, repeated, loss in zip(*(part[n].to_pylist() for n in names)):
                if state is None or state["conv_id"] != conv_id:
                    finish()
                    state = dict.fromkeys(DIGEST.names, 0) | {
                        "conv_id": conv_id,
                        "turns_sha256": hashlib.sha256(),
                        "loss_sha256": hashlib.sha256(),
                    }
                for role, said in read_turns(text)[repeated:]:
                    state["n_turns"] += 1
                    state["turns_sha256"].update(f"{role}\n{said}\n".encode())
                for span in loss:
                    said = unescape(text[span["start"] : span["end"]])
                    state["loss_chars"] += len(said)
                    state["loss_sha256"].update(said.encode())
                state["formatted_chars"] += len(text)
                state["n_windows"] += 1
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=DIGEST)
                out.clear()
        finish()
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=DIGEST)

    return made.mapInArrow(run, DIGEST_TYPE)


def digests(short: DataFrame, long: DataFrame) -> DataFrame:
    """What the windows say, per conversation: conv_id, n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars, n_windows. A digest follows its conversation from beginning to
    end, so the windows of a long one pass through one task, which holds one of them at a time."""
    order = ["conv_id", "chunk", "window"]
    return _read_back(short).unionByName(
        _read_back(long.repartition("conv_id").sortWithinPartitions(*order))
    )
