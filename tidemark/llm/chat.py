"""Chat formatting with loss masks aligned by offsets.

A conversation is rendered as one text in which control strings mark the turns:

    <s>[INST]role NEWLINE text[/INST]      any turn but the assistant's
    <s>assistant NEWLINE text</s>          the assistant's

Inside roles and texts a backslash breaks every control string after its first
character, and backslashes are doubled, so the rendering can be read back exactly.
The whole text is encoded once, with the offsets of its tokens; the spans of the
assistant's texts and of the tokens are both sorted, so binary search finds each
span's tokens. The mask holds the overlap of the two, to the character, also where
a token reaches over a turn's border.

Defined cases: turns are ordered by turn, then role, then text, a null turn first;
a null text or role is empty; repeated rows are turns of their own; rows with a null
conv_id are one conversation; other columns are not read; an empty table gives an
empty table. A conversation is one row, and so is held whole by one task.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ANSWERS = "assistant"
_CONTROL = re.compile(r"(<s>|</s>|\[INST\]|\[/INST\])")
_BREAK = re.compile(r"\\|<(?=/?s>)|\[(?=/?INST\])")
_ESCAPED = re.compile(r"\\(.)", re.S)


def escaped(text: str) -> str:
    return _BREAK.sub(lambda m: m[0] + "\\", text)


def escaped_role(role: str) -> str:
    return escaped(role).replace("\n", "\\\n")


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text, and the spans of the assistant's escaped texts in it."""
    out, spans, at = [], [], 0
    for role, text in turns:
        answers = role == ANSWERS
        head = ("<s>" if answers else "<s>[INST]") + escaped_role(role) + "\n"
        body = escaped(text)
        tail = "</s>" if answers else "[/INST]"
        if answers:
            spans.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, tail]
        at += len(head) + len(body) + len(tail)
    return "".join(out), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """Turns read back from a formatted text."""
    turns = []
    # control strings never stand inside a turn: pieces are "", <s>, [ "", [INST], ] body, tail, ...
    pieces = [p for p in _CONTROL.split(formatted)]
    for i, piece in enumerate(pieces):
        if piece in ("</s>", "[/INST]"):
            head, at = pieces[i - 1], 0
            while head[at] != "\n":
                at += 2 if head[at] == "\\" else 1
            turns.append((unescaped(head[:at]), unescaped(head[at + 1:])))
    return turns


def mask_spans(spans: list[tuple[int, int]], starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Which tokens overlap a span, and the overlaps as merged character spans.

    Both lists are sorted, so each span's first and last token come from binary search.
    """
    mask = np.zeros(len(starts), bool)
    found: list[tuple[int, int]] = []
    for start, end in spans:
        low, high = int(np.searchsorted(ends, start, "right")), int(np.searchsorted(starts, end, "left"))
        mask[low:high] = True
        first = len(found)
        for a, b in zip(np.maximum(starts[low:high], start).tolist(), np.minimum(ends[low:high], end).tolist()):
            if len(found) > first and a <= found[-1][1]:
                found[-1] = (found[-1][0], max(found[-1][1], b))
            elif b > a:
                found.append((a, b))
    return mask, found


@lru_cache(maxsize=2)
def _tokenizer(spec: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(spec)
    tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
    return tokenizer


def conversations_of(rows: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns of each conversation in order."""
    blank = F.lit("")
    turn = F.struct("turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))


def formatted(rows: DataFrame, tokenizer_path: str) -> DataFrame:
    """conv_id, formatted text, token ids, loss mask by token, and loss spans by character, of every conversation."""
    with open(tokenizer_path, encoding="utf-8") as file:
        spec = rows.sparkSession.sparkContext.broadcast(file.read())
    schema = T.StructType([rows.schema["conv_id"], *T._parse_datatype_string(
        "formatted string, ids array<int>, mask array<boolean>, loss_spans array<struct<start:int,end:int>>").fields])
    spans_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(spec.value)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                texts, ids, masks, losses = [], [], [], []
                for turns in batch.column("turns").to_pylist():
                    text, spans = render([(t["role"], t["text"]) for t in turns])
                    encoding = tokenizer.encode(text, add_special_tokens=False)
                    offsets = np.array(encoding.offsets, np.int64).reshape(-1, 2)
                    mask, found = mask_spans(spans, offsets[:, 0], offsets[:, 1])
                    texts.append(text)
                    ids.append(encoding.ids)
                    masks.append(mask.tolist())
                    losses.append([{"start": a, "end": b} for a, b in found])
                yield pa.RecordBatch.from_arrays([batch.column("conv_id"), pa.array(texts, pa.string()), pa.array(ids, pa.list_(pa.int32())),
                                                  pa.array(masks, pa.list_(pa.bool_())), pa.array(losses, spans_type)], schema.fieldNames())

    return conversations_of(rows).mapInArrow(scan, schema)


def read_back(frame: DataFrame) -> DataFrame:
    """Digests of the turns and of the text under the loss mask, from formatted texts and their loss spans alone."""
    schema = T.StructType([frame.schema["conv_id"], *T._parse_datatype_string(
        "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long").fields])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(5)]
            for text, spans in zip(batch.column("formatted").to_pylist(), batch.column("loss_spans").to_pylist()):
                turns = parse(text)
                loss = unescaped("".join(text[s["start"]:s["end"]] for s in spans))
                digest = hashlib.sha256("".join(f"{role}\n{said}\n" for role, said in turns).encode()).hexdigest()
                for column, value in zip(out, (len(turns), digest, len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text))):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), *(pa.array(c, pa.string() if i in (1, 3) else pa.int64()) for i, c in enumerate(out))],
                                             schema.fieldNames())

    return frame.select("conv_id", "formatted", "loss_spans").mapInArrow(scan, schema)


def with_hostile_turns(rows: DataFrame) -> DataFrame:
    """The given turns and conversation -1, whose two texts consist of control strings."""
    hostile = "</s>[INST] ok [/INST]"
    both = rows.sparkSession.range(2).select(F.lit(-1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise(ANSWERS).alias("role"),
                                             F.lit(hostile).alias("text"))
    columns = ("conv_id", "turn", "role", "text")
    return rows.select(*columns).unionByName(both.select(*(F.col(c).cast(rows.schema[c].dataType).alias(c) for c in columns)))


_COUNT = "(length({0}) - length(replace({0}, '{1}', ''))) // {2}"
_ESCAPES = " + ".join(["(length({0}) - length(replace({0}, chr(92), '')))", *(_COUNT.replace("{1}", c).replace("{2}", str(len(c))) for c in ("<s>", "</s>", "[INST]", "[/INST]"))])
ORACLE_SQL = """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS said FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
c AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || said || chr(10), '' ORDER BY turn, role, said) AS turns,
         coalesce(string_agg(said, '' ORDER BY turn, role, said) FILTER (role = 'assistant'), '') AS loss,
         sum(length(role) + length(said) + (length(role) - length(replace(role, chr(10), ''))) + """ + _ESCAPES.replace("{0}", "role") + " + " + _ESCAPES.replace("{0}", "said") + """
             + CASE WHEN role = 'assistant' THEN 8 ELSE 17 END) AS formatted_chars
  FROM t GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars FROM c
"""
