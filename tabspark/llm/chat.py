"""Chat formatting with a grammar round trip.

Grammar of a formatted conversation (a sequence of turns, nothing between them)::

    turn      := user | assistant | other
    user      := "[INST] " text " [/INST]"
    assistant := "<s>" text "</s>"
    other     := "[ROLE " role "] " text " [/ROLE]"

Control strings inside roles and texts are escaped by one more backslash after their first
character (``[\\INST]`` for ``[INST]``, ``[\\\\INST]`` for ``[\\INST]``), so unescaping removes
exactly what escaping added. Each rendered conversation is parsed again and compared with
its source; content is escaped only where that comparison fails: not at all at first, then
the turns that differ, then all of them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept

#: The control strings without their first character, which a backslash may follow.
CONTROL = re.compile(r"([\[<])(\\*)(/?INST\]|/?ROLE(?=[ \]])|/?s>|\](?=\s))")
ESCAPED = re.compile(r"([\[<])(\\+)(/?INST\]|/?ROLE(?=[ \]])|/?s>|\](?=\s))")
OPEN = re.compile(r"\[INST\] |<s>|\[ROLE ")
Turn = tuple[str, str]


def escape(text: str) -> str:
    return CONTROL.sub(lambda m: f"{m[1]}\\{m[2]}{m[3]}", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(lambda m: f"{m[1]}{m[2][1:]}{m[3]}", text)


def escape_role(role: str) -> str:
    """A role stands before "] ": its brackets and percent signs are written as %XX."""
    return re.sub(r"[%\[\]]", lambda m: f"%{ord(m[0]):02X}", role)


def unescape_role(role: str) -> str:
    return re.sub(r"%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), role)


def _turn(role: str, text: str) -> tuple[str, str, str]:
    if role == "user":
        return "[INST] ", text, " [/INST]"
    if role == "assistant":
        return "<s>", text, "</s>"
    return f"[ROLE {escape_role(role)}] ", text, " [/ROLE]"


def render(turns: list[Turn], escaped: list[bool]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text, and the spans of it under the loss mask (assistant texts)."""
    out, at, mask = [], 0, []
    for (role, text), guard in zip(turns, escaped, strict=True):
        head, body, tail = _turn(role, escape(text) if guard else text)
        if role == "assistant":
            mask.append((at + len(head), at + len(head) + len(body)))
        out += head, body, tail
        at += len(head) + len(body) + len(tail)
    return "".join(out), mask


def parse(formatted: str) -> list[tuple[str, str, int, int]] | None:
    """role, unescaped text, start and end of the text of every turn; None if it isn't in the grammar."""
    at, out = 0, []
    while at < len(formatted):
        m = OPEN.match(formatted, at)
        if not m:
            return None
        begin = m.end()
        if m[0] == "<s>":
            role, close = "assistant", "</s>"
        elif m[0] == "[INST] ":
            role, close = "user", " [/INST]"
        else:
            stop = formatted.find("] ", begin)
            if stop < 0:
                return None
            role, begin, close = unescape_role(formatted[begin:stop]), stop + 2, " [/ROLE]"
        end = formatted.find(close, begin)
        if end < 0:
            return None
        out.append((role, unescape(formatted[begin:end]), begin, end))
        at = end + len(close)
    return out


def format_turns(turns: list[Turn]) -> tuple[str, list[tuple[int, int]]]:
    """Render, reparse and compare, escaping what conflicts, until the turns come back identical."""
    guards = [False] * len(turns)
    while True:
        formatted, mask = render(turns, guards)
        back = parse(formatted)
        if back is not None and [(r, t) for r, t, _, _ in back] == turns and [(s, e) for r, _, s, e in back if r == "assistant"] == mask:
            return formatted, mask
        if all(guards):
            raise ValueError("a fully escaped conversation doesn't come back: the grammar is not reversible")
        # one turn at a time shows which contents conflict; if none does alone, all are escaped
        more = [g or (b := parse(render([t], [False])[0])) is None or [(r, x) for r, x, _, _ in b] != [t] for g, t in zip(guards, turns, strict=True)]
        guards = more if more != guards else [True] * len(turns)


def format_conversations(rows: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, formatted string, mask array<struct<start,stop>>``: one row for each conversation.

    Turns go by turn number (null first), ties by role, then text; repeated rows are repeated
    turns. A null text or role is empty; rows of a null conversation form one conversation.
    Other columns are ignored; an empty table gives an empty result.
    """
    part = F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    whole = rows.select(F.col(conv).alias("conv_id"), part.alias("part")).groupBy("conv_id").agg(F.sort_array(F.collect_list("part")).alias("turns"))
    whole = whole.select("conv_id", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept("chat")
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                piece = batch.slice(at, 500)
                done = [format_turns([(t["role"], t["text"]) for t in x]) for x in piece.column("turns").to_pylist()]
                spans = [[{"start": s, "stop": e} for s, e in mask] for _, mask in done]
                yield pa.RecordBatch.from_arrays([piece.column("conv_id"), pa.array([x for x, _ in done], pa.string()), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))], ["conv_id", "formatted", "mask"])

    kind = rows.schema[conv].dataType.simpleString()
    return whole.mapInArrow(run, f"conv_id {kind}, formatted string, mask array<struct<start:bigint,stop:bigint>>")


def read_back(formatted: DataFrame) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars`` from formatted text and mask alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept("chat")
        import hashlib

        digest = lambda x: hashlib.sha256(x.encode("utf-8", "surrogatepass")).hexdigest()
        for batch in batches:
            columns: list[list] = [[], [], [], [], []]
            for x, mask in zip(batch.column("formatted").to_pylist(), batch.column("mask").to_pylist(), strict=True):
                turns = parse(x)
                if turns is None:
                    raise ValueError("a formatted conversation is not in the grammar")
                loss = "".join(unescape(x[m["start"] : m["stop"]]) for m in mask)
                values = (len(turns), digest("".join(f"{r}\n{t}\n" for r, t, _, _ in turns)), len(loss), digest(loss), len(x))
                for c, v in zip(columns, values, strict=True):
                    c.append(v)
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]], ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    kind = formatted.schema["conv_id"].dataType.simpleString()
    return formatted.mapInArrow(run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
