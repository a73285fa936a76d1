"""Chat formatting by incremental black-box rendering.

A template is any object with ``render(turns) -> str``, ``escape`` and ``unescape``. To find each turn
in the output nothing is assumed of it: successive prefixes of the turns are rendered and consecutive
outputs compared. Where an output begins with the one before, the rest is the new turn's span; where it
doesn't, the template rewrites history, which is reported, and no spans or mask are given. The text
inside a turn's span is found by rendering the turn once more with a one-character probe as its text.

``TurnTemplate`` marks every turn and escapes its control strings inside texts and roles by a
backslash after the first character; longer runs of backslashes grow by one, so unescaping is exact.

Defined results: rows are ordered by turn, role, text (null first); a null role or text is empty; each
row with a null conv_id is a conversation of its own; repeated rows are repeated turns; a conversation without an
assistant turn has an empty mask; an empty table gives an empty result; other columns are ignored. A
conversation is rendered by one task, as its output is one string.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turn = tuple[str, str]
PROBE = "\ue000"
LOSS_ROLE = "assistant"
KEPT = 2 << 20


class TurnTemplate:
    """<s>[INST] user [/INST]</s>, <s>assistant</s> and <s>[ROLE]name[/ROLE]any other</s>."""

    _control = r"(/?(?:s>|INST\]|ROLE\]))"
    _plain = re.compile(r"([<\[])(\\*)" + _control)
    _escaped = re.compile(r"([<\[])\\(\\*)" + _control)
    _turn = re.compile(r"<s>(?:\[INST\] (.*?) \[/INST\]|\[ROLE\](.*?)\[/ROLE\](.*?)|(.*?))</s>", re.DOTALL)

    def __init__(self) -> None:
        self._known: dict[Turn, str] = {}
        self._held = 0

    def escape(self, text: str) -> str:
        return self._plain.sub(r"\1\\\2\3", text)

    def unescape(self, text: str) -> str:
        return self._escaped.sub(r"\1\2\3", text)

    def turn(self, role: str, text: str) -> str:
        """A turn as text; the last KEPT characters are kept, as rendering prefix after prefix asks for each turn again and again."""
        known = self._known.get((role, text))
        if known is None:
            known = self._turn_text(role, text)
            self._held += len(known)
            if self._held > KEPT:
                self._known.clear()
                self._held = len(known)
            self._known[role, text] = known
        return known

    def _turn_text(self, role: str, text: str) -> str:
        text = self.escape(text)
        if role == "user":
            return f"<s>[INST] {text} [/INST]</s>"
        return f"<s>{text}</s>" if role == LOSS_ROLE else f"<s>[ROLE]{self.escape(role)}[/ROLE]{text}</s>"

    def render(self, turns: list[Turn]) -> str:
        return "".join(self.turn(role, text) for role, text in turns)

    def parse(self, output: str) -> list[Turn]:
        """The turns, read back from an output."""
        turns, at = [], 0
        for m in self._turn.finditer(output):
            if m.start() != at:
                raise ValueError(f"text outside a turn at {at}")
            at = m.end()
            user, role, other, assistant = m.groups()
            turns.append(("user", user) if user is not None else (LOSS_ROLE, assistant) if assistant is not None else (self.unescape(role), other))
        if at != len(output):
            raise ValueError(f"text outside a turn at {at}")
        return [(role, self.unescape(text)) for role, text in turns]


@dataclass
class Formatted:
    """An output with the spans of its turns and of its assistant texts (the loss mask)."""

    text: str
    spans: list[tuple[int, int]]
    mask: list[tuple[int, int]]
    rewrites_history: bool


def format_chat(template, turns: list[Turn], loss_role: str = LOSS_ROLE) -> Formatted:
    """Renders turn after turn and locates them by comparing consecutive outputs."""
    spans, mask, before = [], [], template.render([])
    for k, (role, text) in enumerate(turns):
        output = template.render(turns[: k + 1])
        if not output.startswith(before):
            return Formatted(template.render(turns), [], [], True)
        spans.append((len(before), len(output)))
        if role == loss_role:
            probed = template.render([*turns[:k], (role, PROBE)])
            start = probed.find(PROBE, len(before))
            end = len(output) - (len(probed) - start - 1)
            if start < 0 or not probed.startswith(before) or template.unescape(output[start:end]) != text:
                return Formatted(template.render(turns), [], [], True)
            mask.append((start, end))
        before = output
    return Formatted(before, spans, mask, False)


def conversations(rows: DataFrame) -> DataFrame:
    """conv_id, turns array<struct<turn, role, text>> in order."""
    turn = F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    own = F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id()).alias("_own")
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), own, turn.alias("_turn"))
    return rows.groupBy("conv_id", "_own").agg(F.sort_array(F.collect_list("_turn")).alias("turns")).drop("_own")


def format_conversations(rows: DataFrame, template: TurnTemplate | None = None) -> DataFrame:
    """conv_id, formatted, spans, mask (arrays of start and end in code points), rewrites_history."""
    template = template or TurnTemplate()
    names = ["conv_id", "formatted", "spans", "mask", "rewrites_history"]
    pairs = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                turns = [(t["role"], t["text"]) for t in batch.column("turns")[k].as_py()]
                out = format_chat(template, turns)
                as_pairs = lambda x: pa.array([[{"start": a, "end": b} for a, b in x]], pairs)
                yield pa.RecordBatch.from_arrays([batch.column("conv_id").slice(k, 1), pa.array([out.text]), as_pairs(out.spans), as_pairs(out.mask), pa.array([out.rewrites_history])], names)

    return conversations(rows).mapInArrow(run, "conv_id long, formatted string, spans array<struct<start:int,end:int>>, mask array<struct<start:int,end:int>>, rewrites_history boolean")


def digests(formatted: DataFrame, template: TurnTemplate | None = None) -> DataFrame:
    """Reads formatted conversations back: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    template = template or TurnTemplate()
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for text, mask in zip(batch.column("formatted").to_pylist(), batch.column("mask").to_pylist(), strict=True):
                turns = template.parse(text)
                whole, loss, chars = hashlib.sha256(), hashlib.sha256(), 0
                for role, said in turns:
                    whole.update(f"{role}\n{said}\n".encode())
                for span in mask:
                    said = template.unescape(text[span["start"] : span["end"]])
                    loss.update(said.encode())
                    chars += len(said)
                out.append((len(turns), whole.hexdigest(), chars, loss.hexdigest(), len(text)))
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), *(pa.array([x[i] for x in out], t) for i, t in enumerate((pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())))], names)

    return formatted.select("conv_id", "formatted", "mask").mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
