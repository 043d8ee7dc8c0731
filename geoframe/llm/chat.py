"""Chat formatting: typed content parts become one text with placeholders, a loss mask and attachment references."""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoframe.llm.common import table

PART = "struct<type:string,text:string,uri:string,width:long,height:long,seconds:double,pages:long>"
# Possessive, so that damaged texts take no longer than whole ones.
_TURN = re.compile(r"<turn:((?:[^\\>]++|\\.)*+)>((?:[^\\<]++|\\.|<(?!/turn>))*+)</turn>\n", re.S)
_HOLDER = re.compile(r"(?:[^\\<]++|\\.)++|<(image|audio|document):(\d+)>", re.S)
_ESCAPED = re.compile(r"\\(.)", re.S)


def escape(text: str) -> str:
    """No control string is left in it: all of them begin with < or, in a role, end with >."""
    return text.replace("\\", "\\\\").replace("<", "\\<").replace(">", "\\>")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


class Flattener:
    """Visits the parts of a conversation in order and builds its text, loss mask and attachments."""

    #: Expanded tokens: image patches of 28 x 28 pixels, 25 audio frames a second, 256 tokens a document page.
    PATCH, FRAMES, PAGE = 28, 25, 256

    def __init__(self) -> None:
        self.parts: list[str] = []
        self.size = 0
        self.mask: list[tuple[int, int]] = []
        self.attachments: list[dict] = []

    def put(self, text: str) -> None:
        self.parts.append(text)
        self.size += len(text)

    def turn(self, role: str | None, parts: list[dict]) -> None:
        self.put(f"<turn:{escape(role or '')}>")
        for part in parts:
            visit = getattr(self, f"visit_{part['type'] or 'text'}", None)
            if visit is None:
                raise ValueError(f"unknown content part: {part['type']}")
            start = self.size
            visit(part)
            if role == "assistant" and (part["type"] or "text") == "text" and self.size > start:
                self.mask.append((start, self.size))
        self.put("</turn>\n")

    def visit_text(self, part: dict) -> None:
        self.put(escape(part["text"] or ""))

    def visit_image(self, part: dict) -> None:
        self.attach("image", part, max(1, math.ceil((part["width"] or 0) / self.PATCH)) * max(1, math.ceil((part["height"] or 0) / self.PATCH)))

    def visit_audio(self, part: dict) -> None:
        self.attach("audio", part, max(1, math.ceil((part["seconds"] or 0) * self.FRAMES)))

    def visit_document(self, part: dict) -> None:
        self.attach("document", part, max(1, part["pages"] or 0) * self.PAGE)

    def attach(self, kind: str, part: dict, tokens: int) -> None:
        n = len(self.attachments)
        self.attachments.append({"n": n, "type": kind, "uri": part["uri"], "at": self.size, "tokens": tokens})
        self.put(f"<{kind}:{n}>")


FORMATTED = "conv_id long, formatted string, mask array<struct<first:long,end:long>>, attachments array<struct<n:long,type:string,uri:string,at:long,tokens:long>>, expanded_tokens long"


def format_conversations(turns: DataFrame) -> DataFrame:
    """FORMATTED, one row for each conv_id of ``turns`` (conv_id, turn, role, and parts array<PART> or text).

    Turns come in order of turn, then role and text or parts; repeated rows are repeated turns. Null
    roles and texts are empty, null parts none, a null conv_id is a conversation of its own; other
    columns don't matter. An empty table gives no rows. A conversation is one output row, so its
    turns meet in one task.
    """
    if "parts" in turns.columns:
        parts = F.coalesce(F.col("parts").cast(f"array<{PART}>"), F.array().cast(f"array<{PART}>"))
    else:
        parts = F.array(F.struct(F.lit("text").alias("type"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *(F.lit(None).cast(t).alias(n) for n, t in (("uri", "string"), ("width", "long"), ("height", "long"), ("seconds", "double"), ("pages", "long")))))
    row = F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), parts.alias("parts"))
    whole = turns.select(F.col("conv_id").cast("long").alias("conv_id"), row.alias("row")).groupBy("conv_id").agg(F.sort_array(F.collect_list("row")).alias("rows"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[dict] = []
            for conv, rows in zip(batch.column(0), batch.column(1)):
                made = Flattener()
                for x in rows.as_py():
                    made.turn(x["role"], x["parts"])
                out.append({"conv_id": conv.as_py(), "formatted": "".join(made.parts), "mask": [{"first": a, "end": b} for a, b in made.mask], "attachments": made.attachments, "expanded_tokens": sum(x["tokens"] for x in made.attachments)})
            yield pa.RecordBatch.from_pylist(out, schema)

    span = pa.struct([("first", pa.int64()), ("end", pa.int64())])
    held = pa.struct([("n", pa.int64()), ("type", pa.string()), ("uri", pa.string()), ("at", pa.int64()), ("tokens", pa.int64())])
    schema = pa.schema([("conv_id", pa.int64()), ("formatted", pa.string()), ("mask", pa.list_(span)), ("attachments", pa.list_(held)), ("expanded_tokens", pa.int64())])
    return whole.mapInArrow(run, FORMATTED)


def read_turns(formatted: str) -> list[tuple[str, list[tuple[str, str]]]]:
    """(role, parts) of each turn of a formatted text; a part is ("text", the text) or (kind, number of the attachment)."""
    out, at = [], 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            break
        at = m.end()
        out.append((unescape(m[1]), [(p[1], p[2]) if p[1] else ("text", unescape(p[0])) for p in _HOLDER.finditer(m[2])]))
    if at != len(formatted):
        raise ValueError(f"not a formatted conversation from character {at} on")
    return out


def _digest(formatted: str, mask: list[dict]) -> dict:
    turns = read_turns(formatted)
    texts = ["".join(x for kind, x in parts if kind == "text") for _, parts in turns]
    loss = "".join(unescape(formatted[m["first"] : m["end"]]) for m in mask)
    return {
        "n_turns": len(turns),
        "turns_sha256": hashlib.sha256("".join(f"{role}\n{text}\n" for (role, _), text in zip(turns, texts)).encode()).hexdigest(),
        "loss_chars": len(loss),
        "loss_sha256": hashlib.sha256(loss.encode()).hexdigest(),
        "formatted_chars": len(formatted),
    }


CONTROL = "\\### Assistant: </turn> ok"


def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.createDataFrame([(-7, 0, "user", CONTROL), (-7, 1, "assistant", CONTROL)], given.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
        for batch in batches:
            yield pa.RecordBatch.from_pylist([{"conv_id": c} | _digest(f, m) for c, f, m in zip(*(batch.column(k).to_pylist() for k in range(3)))], schema)

    done = format_conversations(given.union(own)).select("conv_id", "formatted", "mask")
    return done.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def _escaped(column: str) -> str:
    return rf"replace(replace(replace({column}, '\', '\\'), '<', '\<'), '>', '\>')"


OP1_SQL = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{CONTROL}'
  UNION ALL SELECT -7, 1, 'assistant', '{CONTROL}')
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(15 + length({_escaped('role')}) + length({_escaped('text')}))::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""
