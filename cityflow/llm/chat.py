"""Chat formatting: conversations rendered through a compiled template, and read back from the output."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame

from cityflow.llm.common import bounded_batches, col, shuffle_partitions
from cityflow.llm.template import FILTERS, compiled, shown

#: Strings with a meaning in the output. None begins with the last character of another.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<ROLE>>", "<</ROLE>>")

TEMPLATE = (
    "{% for turn in turns %}<s>"
    "{% if turn.role == 'user' %}[INST] {{ turn.text | guard }} [/INST]"
    "{% elif turn.role == 'assistant' %}{% generation %}{{ turn.text | guard }}{% endgeneration %}</s>"
    "{% else %}<<ROLE>>{{ turn.role | guard }}<</ROLE>>{{ turn.text | guard }}</s>{% endif %}"
    "{% endfor %}"
)

_GUARDED = re.compile("|".join(re.escape(c[0]) + r"\\*" + re.escape(c[1:]) for c in CONTROLS))
_TURN = re.compile(
    r"<s>(?:\[INST\] (?P<user>.*?) \[/INST\]|<<ROLE>>(?P<role>.*?)<</ROLE>>(?P<other>.*?)</s>|(?P<assistant>.*?)</s>)", re.DOTALL
)


def guard(text: Any) -> str:
    """Control strings in a text with one more backslash behind their first character, so that none is left."""
    return _GUARDED.sub(lambda m: m[0][0] + "\\" + m[0][1:], shown(text))


def unguard(text: str) -> str:
    """The text that `guard` was given."""
    return _GUARDED.sub(lambda m: m[0][0] + m[0][1:].removeprefix("\\"), text)


@lru_cache(maxsize=8)
def formatter(template: str) -> Callable[[dict], tuple[str, list[tuple[int, int]]]]:
    """The compiled template, once for each worker."""
    return compiled(template, FILTERS | {"guard": guard})


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """Role and text of each turn of an output of `TEMPLATE`."""
    turns, done = [], 0
    for m in _TURN.finditer(formatted):
        if m.start() != done:
            break
        done = m.end()
        kind = m.lastgroup if m.lastgroup != "other" else None
        turns.append((kind, unguard(m[kind])) if kind else (unguard(m["role"]), unguard(m["other"])))
    if done != len(formatted):
        raise ValueError(f"not an output of the template at {done}")
    return turns


def _formatted(template: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Renders the conversations of a sorted partition one after the other."""
        render = formatter(template)
        names = ["conv_id", "formatted", "loss"]
        schema = pa.schema([("conv_id", pa.int64()), ("formatted", pa.string()), ("loss", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])
        open_id, turns, done, size = None, [], [], 0

        def close() -> None:
            text, spans = render({"turns": turns})
            done.append((open_id, text, [{"start": a, "end": b} for a, b in spans]))

        def batch() -> pa.RecordBatch:
            columns = zip(*done, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, schema.field(n).type) for c, n in zip(columns, names, strict=True)], schema=schema)

        for rows in batches:
            for conv, role, text in zip(*(rows.column(i).to_pylist() for i in (0, 1, 2)), strict=True):
                if turns and conv != open_id:
                    close()
                    turns = []
                    size += len(done[-1][1])
                    if size > 4_000_000:
                        yield batch()
                        done, size = [], 0
                open_id = conv
                turns.append({"role": role or "", "text": text or ""})
        if turns:
            close()
        if done:
            yield batch()

    return run


def format_chats(
    conversations: DataFrame,
    template: str = TEMPLATE,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """conv_id, formatted (the output) and loss (spans in code points under the loss mask) of each conversation.

    Rows go by turn, then role, then text; nulls come first, and a null role or text is empty. Rows that repeat
    a turn are turns of their own. Rows with a null conv_id are one conversation. Other columns are not
    read; an empty table gives no rows. Conversations are dealt out by id and streamed in order, so a task
    holds one conversation at a time.
    """
    bounded_batches(conversations.sparkSession)
    rows = conversations.select(
        col(id_col).cast("long").alias("conv_id"),
        col(role_col).cast("string").alias("role"),
        col(text_col).cast("string").alias("text"),
        col(turn_col).cast("long").alias("turn"),
    )
    dealt = rows.repartition(shuffle_partitions(conversations.sparkSession), "conv_id")
    ordered = dealt.sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInArrow(_formatted(template), "conv_id long, formatted string, loss array<struct<start long, end long>>")


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for conv, text, loss in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            turns = read_turns(text)
            whole = hashlib.sha256()
            for role, body in turns:
                whole.update(f"{role}\n{body}\n".encode())
            learned = "".join(unguard(text[s["start"] : s["end"]]) for s in loss)
            rows.append((conv, len(turns), whole.hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest(), len(text)))
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        columns = zip(*rows, strict=True) if rows else [[]] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def read_back(formatted: DataFrame) -> DataFrame:
    """What outputs of `TEMPLATE` hold: turns, digest of roles and texts, length and digest of the learned text."""
    return formatted.select("conv_id", "formatted", "loss").mapInArrow(
        _digested,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )


def with_example(conversations: DataFrame) -> DataFrame:
    """The conversations and one more, whose texts are made of control strings."""
    text = "</s>[INST] ok [/INST]"
    rows = [(-7, 0, "user", text), (-7, 1, "assistant", text)]
    example = conversations.sparkSession.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return conversations.select("conv_id", "turn", "role", "text").unionByName(example)


