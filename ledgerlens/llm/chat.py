"""Chat formatting with offset-aligned loss masks.

A conversation is rendered as one text, each turn as ``[INST] role [/INST] text </s>`` without the
blanks; the text is encoded once, and every token's place in it is known from the tokens' lengths. The spans of
turns and of tokens are both sorted, so a turn's tokens are found by binary search; the mask of a token is set if it overlaps
an assistant's text, and where a token reaches over a span's edge the mask is cut to the span.

Control strings inside roles and texts are escaped reversibly: a backslash becomes two, and the opening ``[`` or ``<`` of
a control string gets a backslash behind it.

Defined cases: NULL role or text is empty; turns go by number (NULL first), then role, then text, so repeated rows and
ties have a fixed order; rows with NULL ``conv_id`` are one conversation; an empty table gives an empty result; other
columns are ignored. A conversation is one sequence and is rendered by one task.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe

#: Control strings of the template.
OPEN, CLOSE, END = "[INST]", "[/INST]", "</s>"
_CONTROL = re.compile(r"\\|(?<=\[)(?=/?INST\])|(?<=<)(?=/s>)")
_ESCAPED = re.compile(r"\\(\\?)")


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: "\\\\" if m.group() else "\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m.group(1), text)


def render(turns: list[tuple[str, str]], learn: str = "assistant") -> tuple[str, list[tuple[int, int]]]:
    """The formatted text and the byte spans of the texts to learn."""
    parts: list[str] = []
    spans: list[tuple[int, int]] = []
    at = 0
    for role, text in turns:
        head, body = f"{OPEN}{escape(role)}{CLOSE}", escape(text)
        a = at + len(head.encode())
        b = a + len(body.encode())
        if role == learn:
            spans.append((a, b))
        parts += [head, body, END]
        at = b + len(END)
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts read back."""
    turns = []
    at = 0
    while at < len(formatted):
        a = formatted.index(CLOSE, at)
        b = formatted.index(END, a)
        turns.append((unescape(formatted[at + len(OPEN) : a]), unescape(formatted[a + len(CLOSE) : b])))
        at = b + len(END)
    return turns


def masked(ends: np.ndarray, spans: list[tuple[int, int]]) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Token mask and the byte ranges under it. ``ends``: where each token ends."""
    mask = np.zeros(len(ends), bool)
    starts = np.append(0, ends[:-1]) if len(ends) else ends
    ranges: list[tuple[int, int]] = []
    if not spans:
        return mask, ranges
    a, b = (np.array([s[i] for s in spans], np.int64) for i in range(2))
    first = np.searchsorted(ends, a, "right")
    last = np.searchsorted(starts, b, "left")
    for x, y, i, j in zip(a.tolist(), b.tolist(), first.tolist(), last.tolist()):
        if x < y and i < j:
            mask[i:j] = True
            ranges.append((max(x, int(starts[i])), min(y, int(ends[j - 1]))))
    return mask, ranges


def format_one(turns: list[tuple[str, str]], coder: tuple, learn: str = "assistant") -> dict:
    prefixes, split = coder
    text, spans = render(turns, learn)
    ids = bpe.encode_text(text, prefixes, split)
    ends = np.cumsum([len(prefixes.bytes_of[i]) for i in ids.tolist()], dtype=np.int64)
    mask, ranges = masked(ends, spans)
    raw = text.encode()
    return {"formatted": text, "ids": ids, "mask": mask, "loss": "".join(unescape(raw[a:b].decode()) for a, b in ranges)}


OUT = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
        ("n_tokens", pa.int64()),
        ("n_loss_tokens", pa.int64()),
        ("formatted", pa.string()),
        ("ids", pa.binary()),
        ("mask", pa.binary()),
    ]
)
DDL = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_tokens long, n_loss_tokens long, formatted string, ids binary, mask binary"


def formatted(rows: DataFrame, path: str, pattern: str, learn: str = "assistant", texts: bool = True) -> DataFrame:
    """One row per conversation: digests read back from the output, and on request the text, ids and mask (one byte a token)."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    turn = F.struct(F.col("turn").cast("long").alias("turn"), text("role").alias("role"), text("text").alias("text"))
    convs = rows.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = bpe.coder(path, pattern)
        for batch in batches:
            out = []
            for conv, turns in zip(batch.column(0).to_pylist(), batch.column(1)):
                one = format_one([(t["role"], t["text"]) for t in turns.as_py()], coder, learn)
                back = parse(one["formatted"])
                told = "".join(f"{r}\n{t}\n" for r, t in back)
                out.append(
                    {
                        "conv_id": conv,
                        "n_turns": len(back),
                        "turns_sha256": hashlib.sha256(told.encode()).hexdigest(),
                        "loss_chars": len(one["loss"]),
                        "loss_sha256": hashlib.sha256(one["loss"].encode()).hexdigest(),
                        "formatted_chars": len(one["formatted"]),
                        "n_tokens": len(one["ids"]),
                        "n_loss_tokens": int(one["mask"].sum()),
                        "formatted": one["formatted"] if texts else None,
                        "ids": one["ids"].tobytes() if texts else None,
                        "mask": one["mask"].tobytes() if texts else None,
                    }
                )
            yield pa.RecordBatch.from_pylist(out, schema=OUT)

    done = convs.mapInArrow(run, DDL)
    return done if texts else done.drop("formatted", "ids", "mask")
