"""Chat formatting: typed content parts, a marking template, a loss mask, and the way back.

A message's content is plain text or a JSON list of typed parts ({"type": "text" | "image" | "audio" | "document", ...}).
A visitor flattens the parts into text with ordered placeholders `<|kind:k|>`, records the attachment behind each
placeholder, and counts the tokens that the placeholder expands to. The template writes each turn as
`<|im_start|>role\\ntext<|im_end|>\\n`. Control strings inside roles and texts are escaped reversibly: `\\` becomes `\\\\`
and `<|` becomes `<\\|`, a line break in a role `\\n`, so a marker in the output is always a real one. The loss mask covers the assistant texts.

Malformed content is text, never an error: a list that is no list of typed parts, parts of an unknown type, JSON that is
nested too deep, sizes that are no numbers (which count as absent), and lone surrogates (which become U+FFFD).

A null role or text is empty, a null turn sorts first, and rows that share a turn are ordered by role and text, so repeated
rows are repeated turns. Very long texts count in full. A conversation without rows does not exist; an empty table gives an
empty result. Columns beside conv_id, turn, role and text are not looked at, whatever their names.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import sha, small_batches

START, END = "<|im_start|>", "<|im_end|>"
#: Sizes from here on are taken for errors.
MOST = 1e9
#: A line break inside a role.
LINE = "\\n"


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    out, at = [], 0
    while (k := text.find("\\", at)) >= 0:
        out += [text[at:k], "\n" if text[k + 1 : k + 2] == "n" else text[k + 1 : k + 2]]
        at = k + 2
    return "".join(out) + text[at:]


def whole(text: str) -> str:
    """text without lone surrogates, which no UTF-8 can hold."""
    return text.encode("utf-16-le", "surrogatepass").decode("utf-16-le", "replace")


def number(value: object, other: float) -> float:
    """value if it is a number of a size that can be counted, else other."""
    if isinstance(value, (int, float)) and not isinstance(value, bool) and abs(value) < MOST:
        return value
    return other


@dataclass
class Attachment:
    kind: str
    reference: str
    tokens: int
    placeholder: str


@dataclass
class PartVisitor:
    """Flattens typed parts in order; `visit_<type>` returns what stands in the text."""

    patch: int = 28  # pixels a side of the square that one image token covers
    audio_rate: float = 12.5  # audio tokens a second
    page_tokens: int = 256
    found: list[Attachment] = field(default_factory=list)

    def flatten(self, parts: list) -> str:
        return "".join(self.visit(p) for p in parts)

    def visit(self, part: object) -> str:
        if isinstance(part, str):
            return escape(part)
        if not isinstance(part, dict):
            return self.visit_unknown(part)
        known = {"text": self.visit_text, "image": self.visit_image, "audio": self.visit_audio, "document": self.visit_document}
        kind = part.get("type")
        return known.get(kind if isinstance(kind, str) else "", self.visit_unknown)(part)

    def visit_text(self, part: dict) -> str:
        text = part.get("text")
        return escape(whole(text)) if isinstance(text, str) else "" if text is None else self.visit_unknown(part)

    def visit_unknown(self, part: object) -> str:
        return escape(whole(json.dumps(part, ensure_ascii=False, sort_keys=True)))

    def visit_image(self, part: dict) -> str:
        wide, high = (max(1, math.ceil(number(part.get(k), self.patch) / self.patch)) for k in ("width", "height"))
        return self._attach("image", part, wide * high)

    def visit_audio(self, part: dict) -> str:
        return self._attach("audio", part, max(1, round(number(part.get("seconds"), 0) * self.audio_rate)))

    def visit_document(self, part: dict) -> str:
        return self._attach("document", part, self.page_tokens * max(1, math.ceil(number(part.get("pages"), 1))))

    def _attach(self, kind: str, part: dict, tokens: int) -> str:
        mark = f"<|{kind}:{len(self.found)}|>"
        self.found.append(Attachment(kind, whole(str(part.get("url") or part.get("ref") or "")), tokens, mark))
        return mark


def content(raw: str | None, typed: bool, visitor: PartVisitor) -> str:
    """Flattened, escaped content. Only with typed is a JSON list of parts taken apart; any other text is one part of text."""
    raw = raw or ""
    if typed and raw.startswith("["):
        try:
            parts = json.loads(raw)
        except (ValueError, RecursionError):
            parts = None
        if isinstance(parts, list) and parts and all(isinstance(p, dict) and "type" in p for p in parts):
            return visitor.flatten(parts)
    return visitor.flatten([{"type": "text", "text": raw}])


def render(turns: list[tuple[str, str]], typed: bool = False) -> tuple[str, list[tuple[int, int]], list[Attachment]]:
    """Formatted text, spans of it under the loss, attachments."""
    visitor, out, at, spans = PartVisitor(), [], 0, []
    for role, raw in turns:
        head, body = f"{START}{escape(role or '').replace(chr(10), LINE)}\n", content(raw, typed, visitor)
        begin = at + len(head)
        if role == "assistant":
            spans.append((begin, begin + len(body)))
        out += [head, body, END, "\n"]
        at = begin + len(body) + len(END) + 1
    return "".join(out), spans, visitor.found


def parse(formatted: str) -> list[tuple[str, str]]:
    """Role and text of every turn, read back from the formatted text."""
    turns = []
    for block in formatted.split(START)[1:]:
        role, _, body = block.partition("\n")
        turns.append((unescape(role), unescape(body[: body.rindex(END)])))
    return turns


def conversations(rows: DataFrame) -> DataFrame:
    """One row per conv_id with its turns in order."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))


def format_conversations(rows: DataFrame, typed: bool = True) -> DataFrame:
    """conv_id, formatted, loss_spans (start, end in code points), attachments, attachment_tokens, and what parsing the
    formatted text gives back: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    small_batches(rows.sparkSession)
    key = rows.schema["conv_id"].dataType.simpleString()
    span, attachment = pa.struct([("start", pa.int64()), ("end", pa.int64())]), pa.struct([("kind", pa.string()), ("reference", pa.string()), ("tokens", pa.int64()), ("placeholder", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: dict[str, list] = {k: [] for k in ("formatted", "spans", "attachments", "tokens", "n", "turns", "chars", "loss", "size")}
            for turns in b.column(1).to_pylist():
                text, spans, found = render([(t["role"], t["text"]) for t in turns], typed)
                back, loss = parse(text), "".join(unescape(text[i:j]) for i, j in spans)
                out["formatted"].append(text)
                out["spans"].append([{"start": i, "end": j} for i, j in spans])
                out["attachments"].append([vars(a) for a in found])
                out["tokens"].append(sum(a.tokens for a in found))
                out["n"].append(len(back))
                out["turns"].append(sha("".join(f"{r}\n{t}\n" for r, t in back)))
                out["chars"].append(len(loss))
                out["loss"].append(sha(loss))
                out["size"].append(len(text))
            kinds = [pa.string(), pa.list_(span), pa.list_(attachment), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(v, t) for v, t in zip(out.values(), kinds))], names=["conv_id", "formatted", "loss_spans", "attachments", "attachment_tokens", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    schema = (
        f"conv_id {key}, formatted string, loss_spans array<struct<start: long, end: long>>, attachments array<struct<kind: string, reference: string, tokens: long, placeholder: string>>, "
        "attachment_tokens long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
    return conversations(rows).mapInArrow(run, schema)
