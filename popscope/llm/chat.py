"""Chat formatting by incremental black-box rendering.

The template is only called, never looked into. Each prefix of a conversation is rendered;
what a turn adds to the output before it is the turn's span. The prompt for a reply, and
the same turn rendered with an empty text, tell the text within a reply's span from the marks
around it. A template whose output for more turns does not begin with its output for fewer
rewrites history: ``rewritten_at`` names the first such turn, and no span is given.

Turns are sorted by turn, role and text, nulls first; null roles and texts are empty;
repeated rows are turns of their own. A null conversation id is a conversation. An empty table
gives no rows. A conversation is the unit of rendering and is held by one task, as its output is
one string; rendering prefixes costs the square of its turns.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CONTROL = ("<|turn|>", "<|end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>")
_SPECIAL = re.compile(r"\\|" + "|".join(map(re.escape, CONTROL)))
_TURN = re.compile(r"<\|turn\|>((?:[^\\\n]|\\[\s\S])*)\n((?:[^\\<]|\\[\s\S]|<(?!\|end\|>))*)<\|end\|>\n")
Turn = tuple[str, str]
Render = Callable[[list[Turn], bool], str]


@lru_cache(maxsize=4096)
def escaped(text: str) -> str:
    """Without control strings: each gets a backslash inside, and backslashes are doubled."""
    return _SPECIAL.sub(lambda m: "\\\\" if m[0] == "\\" else f"{m[0][0]}\\{m[0][1:]}", text)


def unescaped(text: str) -> str:
    return re.sub(r"\\([\s\S])", r"\1", text)


def render_plain(turns: list[Turn], prompt: bool) -> str:
    """``<|turn|>role``, the escaped text and ``<|end|>`` per turn; ``prompt`` opens a reply."""
    out = [f"<|turn|>{_role(role)}\n{escaped(text)}<|end|>\n" for role, text in turns]
    return "".join(out) + ("<|turn|>assistant\n" if prompt else "")


def _role(role: str) -> str:
    return escaped(role).replace("\n", "\\\n")


def parse_plain(output: str) -> list[Turn]:
    """The turns of ``render_plain``'s output."""
    turns, at = [], 0
    while at < len(output):
        found = _TURN.match(output, at)
        if not found:
            raise ValueError(f"no turn at {at}")
        turns.append((unescaped(found[1]), unescaped(found[2])))
        at = found.end()
    return turns


@dataclass
class Rendered:
    text: str
    spans: list[tuple[str, int, int]]  # role, start, end of each turn
    loss: list[tuple[int, int]]  # texts of the replies
    rewritten_at: int | None


def render_spans(turns: list[Turn], render: Render = render_plain, reply: str = "assistant") -> Rendered:
    before, spans, loss = render([], False), [], []
    for k in range(len(turns)):
        role, text = turns[k]
        after = render(turns[: k + 1], False)
        if not after.startswith(before):
            return Rendered(render(turns, False), [], [], k)
        spans.append((role, len(before), len(after)))
        if role == reply:
            opened, empty = render(turns[:k], True), render([*turns[:k], (role, "")], False)
            tail = len(empty) - len(opened)
            if not (opened.startswith(before) and after.startswith(opened) and empty.startswith(opened)) or (
                tail and not after.endswith(empty[-tail:])
            ):
                return Rendered(render(turns, False), [], [], k)
            if text:
                loss.append((len(opened), len(after) - tail))
        before = after
    return Rendered(before, spans, loss, None)


FORMATTED = (
    "conv_id {id}, formatted string, spans array<struct<role:string,start:int,end:int>>, "
    "loss array<struct<start:int,end:int>>, rewritten_at int"
)


def format_conversations(
    rows: DataFrame, render: Render = render_plain, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per conversation: conv_id, formatted, spans, loss, rewritten_at (offsets in code points)."""
    schema = FORMATTED.format(id=rows.schema[id].dataType.simpleString())
    turns = rows.select(F.col(id).alias("conv_id"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    turns = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return turns.select("conv_id", "role", "text").mapInArrow(_formatter(render), schema)


def _formatter(render: Render):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns, current, open_ = [], None, False
        for batch in batches:
            kind, out = batch.schema.field("conv_id").type, []
            ids, roles, texts = (batch.column(i).to_pylist() for i in range(3))
            for conv, role, text in zip(ids, roles, texts):
                if open_ and conv != current:
                    out.append(_conversation(current, turns, render))
                    turns = []
                current, open_ = conv, True
                turns.append((role or "", text or ""))
            yield _batch(out, kind)
        if open_:
            yield _batch([_conversation(current, turns, render)], kind)

    return run


def _conversation(conv, turns, render):
    found = render_spans(turns, render)
    return {
        "conv_id": conv, "formatted": found.text, "rewritten_at": found.rewritten_at,
        "spans": [{"role": r, "start": a, "end": b} for r, a, b in found.spans],
        "loss": [{"start": a, "end": b} for a, b in found.loss],
    }


def _batch(rows, kind):
    span = [("start", pa.int32()), ("end", pa.int32())]
    schema = pa.schema([("conv_id", kind), ("formatted", pa.string()), ("spans", pa.list_(pa.struct([("role", pa.string()), *span]))),
                        ("loss", pa.list_(pa.struct(span))), ("rewritten_at", pa.int32())])
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def digests(formatted: DataFrame, parse=parse_plain) -> DataFrame:
    """What the formatted text and its loss mask hold, read back: one row per conversation."""
    schema = (
        f"conv_id {formatted.schema['conv_id'].dataType.simpleString()}, n_turns long, turns_sha256 string, "
        "loss_chars long, loss_sha256 string, formatted_chars long"
    )

    def run(batches):
        for batch in batches:
            out = {name: [] for name in ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")}
            for text, loss in zip(batch.column("formatted").to_pylist(), batch.column("loss").to_pylist()):
                turns = parse(text)
                masked = "".join(unescaped(text[span["start"] : span["end"]]) for span in loss)
                out["n_turns"].append(len(turns))
                out["turns_sha256"].append(_sha256("".join(f"{role}\n{said}\n" for role, said in turns)))
                out["loss_chars"].append(len(masked))
                out["loss_sha256"].append(_sha256(masked))
                out["formatted_chars"].append(len(text))
            columns = [pa.array(v, pa.string() if k.endswith("sha256") else pa.int64()) for k, v in out.items()]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), *columns], names=["conv_id", *out])

    return formatted.select("conv_id", "formatted", "loss").mapInArrow(run, schema)


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
