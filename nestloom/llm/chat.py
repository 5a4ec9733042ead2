"""Chat formatting by prefix-target expansion (operator 5).

Every assistant turn becomes an example of its own: all turns before it as context, and only its reply
trainable. A turn is written as ``### role: text</turn>`` and a line feed. Inside roles and texts the escape
sign, ``#``, ``<`` and ``:`` (roles only) get a backslash in front, so no text can imitate the marks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

_TEXT_MARKS, _ROLE_MARKS = re.compile(r"([\\#<])"), re.compile(r"([\\#<:])")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"### ((?:[^\\:]|\\.)*): ((?:[^\\<]|\\.)*)</turn>\n", re.DOTALL)
_FLUSH = 4 << 20  # characters of examples in one output batch

EXAMPLES = "conv_id bigint, example int, text string, loss_start bigint, loss_end bigint, last boolean"


def format_turn(role: str, text: str) -> tuple[str, str]:
    """What precedes the text, and the escaped text with the closing mark."""
    return f"### {_ROLE_MARKS.sub(r'\\\1', role)}: ", _TEXT_MARKS.sub(r"\\\1", text) + "</turn>\n"


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def read_turns(text: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted text."""
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(text)]


def examples(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rows of ``EXAMPLES``, those of a conversation adjacent and in order within one partition.

    ``loss_start`` to ``loss_end`` are the code points of ``text`` to train on. ``last`` marks a
    conversation's last row, which holds all its turns: where turns follow the last reply, or there is no
    reply, that row has an empty loss. Partitions are sorted and streamed; a task holds one conversation's
    text and one output batch, so long conversations don't add up.

    Null text or role counts as empty; rows without conversation id form one conversation. Equal turn
    numbers are ordered by role and text, and repeated rows stay turns. An empty table gives no rows.
    """
    columns = [F.col(f"`{conv_col}`").cast("bigint").alias("c"), F.col(f"`{turn_col}`").alias("t")]
    texts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(a) for c, a in ((role_col, "r"), (text_col, "x"))]
    ordered = turns.select(*columns, *texts).repartition("c").sortWithinPartitions("c", "t", "r", "x")

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("conv_id", pa.int64()), ("example", pa.int32()), ("text", pa.string()), ("loss_start", pa.int64()), ("loss_end", pa.int64()), ("last", pa.bool_())]
        )
        out: list[list] = []
        state: dict = {}

        def emit(start: int, end: int, last: bool) -> None:
            text = "".join(state["parts"])
            state["parts"] = [text]
            out.append([state["conv"], state["count"], text, start, end, last])
            state["count"] += 1

        def close() -> None:
            if state["held"]:
                emit(*state["held"], True)
            else:
                emit(state["chars"], state["chars"], True)

        def ready(all_: bool) -> Iterator[pa.RecordBatch]:
            if out and (all_ or sum(len(r[2]) for r in out) > _FLUSH):
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in out], schema=schema)
                out.clear()

        for batch in batches:
            convs, roles, texts_ = batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()
            for conv, role, text in zip(convs, roles, texts_, strict=True):
                if not state or conv != state["conv"]:
                    if state:
                        close()
                    state = {"conv": conv, "count": 0, "parts": [], "chars": 0, "held": None}
                elif state["held"]:  # an earlier reply: its example ends before this turn
                    emit(*state["held"], False)
                head, body = format_turn(role, text)
                start = state["chars"] + len(head)
                state["parts"] += [head, body]
                state["chars"] = start + len(body)
                state["held"] = (start, state["chars"] - len("</turn>\n")) if role == "assistant" else None
                yield from ready(False)
        if state:
            close()
        yield from ready(True)

    return ordered.mapInArrow(expand, EXAMPLES)


DIGESTS = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, examples bigint"


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation, read back from its examples: turns, trainable text and formatted size.

    Takes the rows as ``examples`` leaves them (a conversation's rows adjacent and in order).
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        loss, loss_chars, chars, count = hashlib.sha256(), 0, 0, 0
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                trained = unescape(row["text"][row["loss_start"] : row["loss_end"]])
                loss.update(trained.encode())
                loss_chars, chars, count = loss_chars + len(trained), chars + len(row["text"]), count + 1
                if row["last"]:
                    turns = read_turns(row["text"])
                    whole = hashlib.sha256("".join(f"{role}\n{text}\n" for role, text in turns).encode()).hexdigest()
                    rows.append((row["conv_id"], len(turns), whole, loss_chars, loss.hexdigest(), chars, count))
                    loss, loss_chars, chars, count = hashlib.sha256(), 0, 0, 0
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
            columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [c.split()[0] for c in DIGESTS.split(", ")])

    return formatted.mapInArrow(read, DIGESTS)
