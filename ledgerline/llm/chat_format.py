"""Operator 8: chat formatting by incremental black-box rendering.

A template is any function from turns to text.  Successive turn prefixes are
rendered and consecutive outputs compared: what the new output adds is the span
of the new turn, and an output that does not start with the previous one
rewrites history, which is reported.  A rendering with a stand-in text locates
the turn's own text inside its span, so the loss mask needs no knowledge of the
template.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Template = Callable[[list[tuple[str, str]]], str]

START, END = "<|im_start|>", "<|im_end|>"
TURN_SCHEMA = ("conv_id long, seq long, kept_before long, piece string, content_start long, content_end long, "
               "loss boolean, rewrites boolean")


def escape(text: str) -> str:
    """Make control strings impossible: `\\` doubles, `<|` becomes `<\\|`."""
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def escape_role(role: str) -> str:
    """As `escape`; line breaks, which end a role, become `\\n`."""
    return escape(role).replace("\n", "\\n")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text, flags=re.S)


def chatml(turns: list[tuple[str, str]]) -> str:
    """The production template, over escaped roles and texts."""
    return "".join(f"{START}{role}\n{text}{END}\n" for role, text in turns)


def parse_chatml(text: str) -> list[tuple[str, str]]:
    """Turns of a rendered text, unescaped; raises ValueError on anything else."""
    out, at = [], 0
    while at < len(text):
        line, stop = text.find("\n", at), text.find(END + "\n", at)
        if not text.startswith(START, at) or line < 0 or stop < line:
            raise ValueError("not a rendered conversation")
        out.append((unescape(text[at + len(START) : line]), unescape(text[line + 1 : stop])))
        at = stop + len(END) + 1
    return out


class IncrementalRenderer:
    """Feeds a conversation to a template turn by turn.

    The template sees every turn so far: outputs cannot show that it ignores
    older ones.  Only where the caller declares it ``separable`` (each turn's
    rendering depends on that turn alone) is the history cut to its last turn
    every ``window`` turns.
    """

    def __init__(self, template: Template, window: int = 16, separable: bool = False):
        self.template, self.window, self.separable = template, window, separable
        self.turns: list[tuple[str, str]] = []
        self.output = ""

    def add(self, role: str, text: str) -> tuple[int, str, int | None, int | None, bool]:
        """(characters dropped from the end of the output so far, span, content start and end in it, rewrites)."""
        new = self.template([*self.turns, (role, text)])
        rewrites = not new.startswith(self.output)
        same = len(commonprefix([new, self.output])) if rewrites else len(self.output)
        mark = "\ue000\ue001"
        while mark in self.output or mark in role:
            mark += "\ue001"
        probe = self.template([*self.turns, (role, mark)])
        at = probe.rfind(mark)
        found = at >= same and probe[:at] == new[:at] and new.startswith(text, at) and probe[at + len(mark) :] == new[at + len(text) :]
        dropped, span = len(self.output) - same, new[same:]
        self.turns.append((role, text))
        self.output = new
        if self.separable and len(self.turns) >= self.window:
            self.turns = self.turns[-1:]
            self.output = self.template(self.turns)
        return dropped, span, at - same if found else None, at - same + len(text) if found else None, rewrites


def _format(template: Template, loss_roles: tuple[str, ...], window: int, separable: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "seq", "kept_before", "piece", "content_start", "content_end", "loss", "rewrites"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_()]
        conv, renderer, seq, length = object(), None, 0, 0
        for b in batches:
            rows = []
            for conv_id, role, text in zip(*(b.column(c).to_pylist() for c in range(3)), strict=True):
                if conv_id != conv or renderer is None:
                    conv, renderer, seq, length = conv_id, IncrementalRenderer(template, window, separable), 0, 0
                role, text = role or "", text or ""
                dropped, span, a, z, rewrites = renderer.add(escape_role(role), escape(text))
                length -= dropped
                rows.append((conv_id, seq, length, span, a, z, role in loss_roles, rewrites))
                length += len(span)
                seq += 1
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return run


def format_conversations(turns: DataFrame, template: Template = chatml, loss_roles: tuple[str, ...] = ("assistant",), window: int = 16,
                         conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                         separable: bool | None = None) -> DataFrame:
    """One row per turn, in order ``seq`` of its conversation.

    ``piece`` is the turn's span; the conversation's text is, turn by turn, the
    first ``kept_before`` characters so far followed by ``piece``
    (``kept_before`` falls short of the length so far only where ``rewrites``
    says that the template changed history).  content_start and content_end
    locate the escaped text inside the piece (null if the template alters
    it); ``loss`` says whether it counts for the loss.

    Turns are ordered by turn (nulls first), then role, then text.  Null roles
    and texts are empty; null conversation ids form one conversation; repeated
    rows are turns of their own; other columns are ignored; no rows, no rows.
    Turns stream through sorted partitions.  A ``separable`` template, as the
    production one is, sees the last turns only, so its conversations are never
    held whole; any other sees the whole conversation so far at each turn.
    """
    separable = template is chatml if separable is None else separable
    rows = turns.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("_turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "_turn", "role", "text").select("conv_id", "role", "text")
    return rows.mapInArrow(_format(template, loss_roles, window, separable), TURN_SCHEMA)


DIGEST_SCHEMA = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, rewrites boolean"


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in DIGEST_SCHEMA.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
    conv, state = object(), None

    def close() -> tuple:
        return conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4], state[5]

    for b in batches:
        rows = []
        for conv_id, kept, piece, a, z, loss, rewrites in zip(*(b.column(c).to_pylist() for c in range(7)), strict=True):
            if conv_id != conv or state is None:
                if state is not None:
                    rows.append(close())
                conv, state = conv_id, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, False]
            for role, text in parse_chatml(piece):
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            if loss and a is not None:
                text = unescape(piece[a:z])
                state[2] += len(text)
                state[3].update(text.encode("utf-8", "surrogatepass"))
            state[4] = kept + len(piece)
            state[5] |= rewrites
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(close(), kinds, strict=True)], names)


def read_back(formatted: DataFrame) -> DataFrame:
    """Parse rendered ChatML turns and digest each conversation, as a stream over its turns in order."""
    rows = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "seq")
    return rows.select("conv_id", "kept_before", "piece", "content_start", "content_end", "loss", "rewrites").mapInArrow(_digest, DIGEST_SCHEMA)
