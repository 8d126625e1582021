"""Where a window of fixed length occurs again: routing of equal windows to one place.

A document is a run of units (words or bytes) and a window is ``length`` consecutive units. Of the k-grams inside a
window the one with the smallest hash (leftmost on ties) is the window's anchor; equal windows have equal anchors. Consecutive
windows that share an anchor travel as one stretch, so every unit travels about three times instead of ``length``
times. What travels first is only (anchor hash, hash of the stretch, document, start):

* a stretch that equals another one is a repeat throughout; in a task the copies are settled before the shuffle, so
  a passage that a third of all documents share reaches the shuffle once per task and chunk;
* a stretch whose anchor occurs nowhere else is unique throughout;
* only stretches with the same anchor and different surroundings are *open*: their text is fetched and an index of
  their group says which windows are repeated. Groups of very many open stretches are split by longer content, down to
  single windows.

Documents are identified by (doc, sub): ``sub`` is 0, or a hash of the text where a ``doc_id`` is repeated. Rows that
repeat both id and text are one document. NULL ids are an id of their own, smaller than all others.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import MIX, gram_hashes, mix64, stored, whole, window_argmin, word_hashes, words_of

NO_ID = -(1 << 63)
#: Units handled at once in a task.
CHUNK = {"byte": 1 << 21, "word": 1 << 18}
#: Open stretches of one anchor beyond which its group is split into single windows.
CROWD = 20_000
ROWS = 1 << 16

_BYTE = mix64((np.arange(256, dtype=np.uint64) + np.uint64(1)) * MIX)
_R = 0xD1342543DE82EF95
_INV = pow(_R, -1, 1 << 64)


@dataclass(frozen=True)
class Spec:
    """``first_stays``: only occurrences after the first are repeats; else all occurrences are."""

    unit: str
    length: int
    gram: int
    first_stays: bool


def numbered(docs: DataFrame) -> tuple[DataFrame, bool]:
    """``docs`` with ``_doc`` and ``_sub``, and whether some id is repeated."""
    base = docs.withColumn("_doc", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)))
    again = base.groupBy("_doc").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_doc")
    again = stored(again, "windows-again")
    if again.isEmpty():
        return base.withColumn("_sub", F.lit(0).cast("long")), False
    marked = base.join(again.withColumn("_many", F.lit(True)), "_doc", "left")
    return marked.withColumn("_sub", F.when(F.col("_many"), F.xxhash64(whole())).otherwise(F.lit(0)).cast("long")).drop("_many"), True


def named(docs: DataFrame) -> DataFrame:
    """(doc, sub, text) of every row."""
    return numbered(docs.select("doc_id", whole().alias("text")))[0].select(F.col("_doc").alias("doc"), F.col("_sub").alias("sub"), "text")


def powers(n: int, base: int) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    if n:
        p[0] = 1
    return np.multiply.accumulate(p)


def pieces(raw: bytes, spec: Spec) -> Iterator[tuple[int, np.ndarray]]:
    """(first unit, hashes of units) of a document; long documents come in pieces that overlap by a window less one unit."""
    size, over = CHUNK[spec.unit], spec.length - 1
    if spec.unit == "byte":
        b = np.frombuffer(raw, np.uint8)
        for o in range(0, max(0, len(b) - over), size):
            yield o, _BYTE[b[o : o + size + over]]
        return
    start, end = words_of(raw)
    for o in range(0, max(0, len(start) - over), size):
        s, e = start[o : o + size + over], end[o : o + size + over]
        yield o, word_hashes(raw[s[0] : e[-1]], s - s[0], e - s[0])


def stretches(values: np.ndarray, ends: np.ndarray, spec: Spec) -> tuple[np.ndarray, ...]:
    """Stretches of a chunk: (key, content hash, first unit, windows). ``ends``: where each piece ends."""
    n, length = len(values), spec.length
    grams = gram_hashes(values, spec.gram)
    at = window_argmin(grams, length - spec.gram + 1)
    valid = np.ones(len(at), bool)
    for e in ends[:-1]:
        valid[max(0, e - length + 1) : e] = False
    new = np.empty(len(at), bool)
    new[:1] = True
    new[1:] = at[1:] != at[:-1]
    new[1:] |= ~valid[:-1]
    first = np.flatnonzero(new & valid)
    # a stretch ends before the next new or invalid window
    stop = np.flatnonzero(np.append(new | ~valid, True))
    count = stop[np.searchsorted(stop, first, "right")] - first
    prefix = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values * powers(n, _R), dtype=np.uint64)))
    content = (prefix[first + count - 1 + length] - prefix[first]) * powers(n + 1, _INV)[first]
    return grams[at[first]], mix64(content + count.astype(np.uint64) * MIX), first, count


SCAN = pa.schema([("key", pa.int64()), ("ch", pa.int64()), ("doc", pa.int64()), ("sub", pa.int64()), ("start", pa.int64()), ("n", pa.int32()), ("kind", pa.int32())])
SCAN_DDL = "key long, ch long, doc long, sub long, start long, n int, kind int"
#: kinds of rows: to be compared (and the same, with a settled copy), a repeat throughout, open, open and a repeat throughout
ONCE, TWICE, FULL, OPEN, OPEN_FULL = 0, 1, 2, 3, 4


def _settle(key, ch, doc, sub, start, n):
    """Collapse equal stretches of a task: one stays to be compared, the others are repeats throughout."""
    order = np.lexsort((start, sub, doc, ch, key))
    key, ch, doc, sub, start, n = (x[order] for x in (key, ch, doc, sub, start, n))
    same = (key[1:] == key[:-1]) & (ch[1:] == ch[:-1])
    twin = same & (doc[1:] == doc[:-1]) & (sub[1:] == sub[:-1]) & (start[1:] == start[:-1])
    head = np.append(True, ~same)
    keep = np.append(True, ~twin)
    group = np.cumsum(head) - 1
    copies = np.bincount(group[keep], minlength=group[-1] + 1 if len(group) else 0)
    kind = np.where(head, np.where(copies[group] > 1, TWICE, ONCE), FULL)
    # settled rows need no company: they are dealt out by place
    key = np.where(head, key, mix64((start + doc).view(np.uint64)).view(np.int64))
    return tuple(x[keep] for x in (key, ch, doc, sub, start, n, kind.astype(np.int32)))


def emit(spec: Spec):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[int, int, int, np.ndarray]] = []
        total = 0

        def flush() -> Iterator[pa.RecordBatch]:
            lens = np.array([len(p[3]) for p in parts])
            ends = np.cumsum(lens)
            key, ch, first, n = stretches(np.concatenate([p[3] for p in parts]), ends, spec)
            owner = np.searchsorted(ends, first, "right")
            doc, sub, at = (np.array([p[i] for p in parts], np.int64) for i in range(3))
            rows = _settle(key.view(np.int64), ch.view(np.int64), doc[owner], sub[owner], first - (ends - lens)[owner] + at[owner], n)
            for i in range(0, len(rows[0]), ROWS):
                yield pa.RecordBatch.from_arrays([pa.array(c[i : i + ROWS], f.type) for c, f in zip(rows, SCAN)], schema=SCAN)

        for batch in batches:
            for doc, sub, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                for offset, values in pieces(text.as_py().encode(), spec):
                    parts.append((doc, sub, offset, values))
                    total += len(values)
                    if total >= CHUNK[spec.unit]:
                        yield from flush()
                        parts, total = [], 0
        if parts:
            yield from flush()

    return run


def scan(spec: Spec):
    """Over rows sorted by key, content, document and start: settle equal stretches, find open ones. Remembers one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None  # the last stretch of the batch before, not yet decided
        held_after = False  # another content of the same key came before it

        def decide(cols, head, after, opened):
            key, ch, doc, sub, start, n, kind = cols
            rep = head
            group = np.cumsum(head) - 1
            copies = np.bincount(group, minlength=int(group[-1]) + 1)
            many = (copies[group] > 1) | (np.bincount(group, kind == TWICE)[group] > 0)
            full = ~rep | ((not spec.first_stays) & many)
            is_open = rep & (after | opened)
            out = np.where(is_open, np.where(full, OPEN_FULL, OPEN), np.where(full, FULL, -1)).astype(np.int32)
            keep = out >= 0
            return pa.RecordBatch.from_arrays([pa.array(c[keep], f.type) for c, f in zip((key, ch, doc, sub, start, n, out), SCAN)], schema=SCAN)

        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(7)]
            settled = cols[6] == FULL
            if settled.any():
                yield pa.RecordBatch.from_arrays([pa.array(c[settled], f.type) for c, f in zip(cols, SCAN)], schema=SCAN)
                cols = [c[~settled] for c in cols]
                if not len(cols[0]):
                    continue
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols)]
            key, ch, doc, sub, start = cols[:5]
            twin = np.append(False, (key[1:] == key[:-1]) & (ch[1:] == ch[:-1]) & (doc[1:] == doc[:-1]) & (sub[1:] == sub[:-1]) & (start[1:] == start[:-1]))
            if twin.any():
                cols = [c[~twin] for c in cols]
            key, ch, kind = cols[0], cols[1], cols[6]
            new_key = np.append(True, key[1:] != key[:-1])
            head = new_key | np.append(True, ch[1:] != ch[:-1])
            after = ~new_key  # for heads: another content of the key stands before
            after[0] = held_after if held is not None else False
            reps = np.flatnonzero(head)
            opened = np.zeros(len(key), bool)
            opened[reps[:-1]] = key[reps[1:]] == key[reps[:-1]]
            last = reps[-1]
            # the last stretch waits for what follows; of its copies only the first is held, and that there were some
            done = [c[:last] for c in cols]
            if last:
                yield decide(done, head[:last], after[:last], opened[:last])
            rest = [c[last + 1 :] for c in cols]
            if len(rest[0]):
                flag = np.full(len(rest[0]), FULL, np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((*rest[:6], flag), SCAN)], schema=SCAN)
            held = [c[last : last + 1].copy() for c in cols]
            if len(rest[0]):
                held[6][:] = TWICE
            held_after = bool(after[last])
        if held is not None:
            yield decide(held, np.array([True]), np.array([held_after]), np.array([False]))

    return run


def found(docs: DataFrame, spec: Spec) -> DataFrame:
    """Settled and open stretches of (doc, sub, text) rows: the scan table, written."""
    rows = docs.mapInArrow(emit(spec), SCAN_DDL).repartition("key")
    order = [F.col("kind") == FULL, "key", "ch", "doc", "sub", "start"]
    return stored(rows.sortWithinPartitions(*order).mapInArrow(scan(spec), SCAN_DDL), "windows-scan")


CONTENT = pa.schema([("key", pa.int64()), ("doc", pa.int64()), ("sub", pa.int64()), ("start", pa.int64()), ("n", pa.int32()), ("body", pa.binary())])
CONTENT_DDL = "key long, doc long, sub long, start long, n int, body binary"


def cut_out(spec: Spec):
    """Text of the listed stretches; those of crowded groups as single windows, keyed by their whole content."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for doc, sub, text, parts in zip(*(batch.column(i) for i in range(4))):
                raw = text.as_py().encode()
                doc, sub = doc.as_py(), sub.as_py()
                begin, end = words_of(raw) if spec.unit == "word" else (None, None)
                for p in parts.as_py():
                    s, n = p["start"], p["n"]
                    ones = [(s + i, 1) for i in range(n)] if p["crowded"] else [(s, n)]
                    for a, m in ones:
                        b = a + m - 1 + spec.length
                        body = raw[begin[a] : end[b - 1]] if begin is not None else raw[a:b]
                        key = p["key"]
                        if p["crowded"]:
                            value = word_hashes(body, begin[a:b] - begin[a], end[a:b] - begin[a]) if begin is not None else _BYTE[np.frombuffer(body, np.uint8)]
                            key = int(mix64(np.atleast_1d(np.sum(value * powers(len(value), _R), dtype=np.uint64))).view(np.int64)[0])
                        rows.append((key, doc, sub, a, m, body))
                        size += len(body) + 60
                    if size >= 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), CONTENT)], schema=CONTENT)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), CONTENT)], schema=CONTENT)

    return run


SPAN = pa.schema([("doc", pa.int64()), ("sub", pa.int64()), ("s", pa.int64()), ("e", pa.int64())])
SPAN_DDL = "doc long, sub long, s long, e long"


def in_groups(decide: Callable[[list[tuple]], np.ndarray], spec: Spec, most: int):
    """Feed whole groups (keys) of at least ``most`` bytes together to ``decide``; it says for each row which windows are repeats.

    ``decide`` gets rows (key, doc, sub, start, n, body) and returns a flat mask over their windows. Groups of single
    windows are equal throughout, so all their rows but those needed to tell the first need not be kept together.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size, cut = 0, 0

        def flush(part: list[tuple]) -> pa.RecordBatch:
            mask = decide(part)
            n = np.array([r[4] for r in part])
            owner = np.repeat(np.arange(len(part)), n)
            at = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
            new = np.append(True, (owner[1:] != owner[:-1]) | ~mask[:-1]) & mask
            last = np.append((owner[1:] != owner[:-1]) | ~mask[1:], True) & mask
            a, b = np.flatnonzero(new), np.flatnonzero(last)
            doc, sub, start = (np.array([r[i] for r in part], np.int64) for i in (1, 2, 3))
            s, e = start[owner[a]] + at[a], start[owner[b]] + at[b] + spec.length
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (doc[owner[a]], sub[owner[a]], s, e)], schema=SPAN)

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if rows and row[0] != rows[-1][0]:
                    cut = len(rows)
                    if size >= most:
                        yield flush(rows)
                        rows, size, cut = [], 0, 0
                elif rows and row[4] == 1 and rows[-1][4] == 1 and len(rows) - cut > 2 and rows[-1][5] == row[5] == rows[-2][5]:
                    # a long group of one single window: all but its first rows are repeats, which two rows already show
                    yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (row[1], row[2], row[3], row[3] + spec.length)], schema=SPAN)
                    continue
                rows.append(row)
                size += len(row[5]) + 60
        if rows:
            yield flush(rows)

    return run


def spans(docs: DataFrame, spec: Spec, decide: Callable[[list[tuple]], np.ndarray], most: int = 1 << 20, crowd: int | None = None) -> DataFrame:
    """(doc, sub, marks): marked unit ranges [s, e) of each document that has any, as an unsorted array."""
    crowd = CROWD if crowd is None else crowd
    seen = found(docs, spec)
    opened = seen.where(F.col("kind").isin(OPEN, OPEN_FULL)).select("key", "doc", "sub", "start", "n")
    crowds = stored(opened.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > crowd).select("key"), "windows-crowds")
    if crowds.isEmpty():
        opened = opened.withColumn("crowded", F.lit(False))
    else:
        opened = opened.join(crowds.withColumn("many", F.lit(True)), "key", "left").withColumn("crowded", F.coalesce("many", F.lit(False))).drop("many")
    listed = opened.groupBy("doc", "sub").agg(F.collect_list(F.struct("start", "n", "key", "crowded")).alias("parts"))
    # identical rows are one document
    texts = docs.join(listed, ["doc", "sub"]).select("doc", "sub", "text", "parts")
    bodies = texts.mapInArrow(cut_out(spec), CONTENT_DDL).repartition("key").sortWithinPartitions("key", "body", "doc", "sub", "start")
    compared = bodies.mapInArrow(in_groups(decide, spec, most), SPAN_DDL)
    full = seen.where(F.col("kind").isin(FULL, OPEN_FULL)).select("doc", "sub", F.col("start").alias("s"), (F.col("start") + F.col("n") - 1 + spec.length).alias("e"))
    return full.unionByName(compared).groupBy("doc", "sub").agg(F.collect_list(F.struct("s", "e")).alias("marks"))


def covered(marks: list[dict] | None, n: int) -> np.ndarray:
    """Mask of the units that marked ranges cover."""
    if not marks or not n:
        return np.zeros(n, bool)
    s = np.fromiter((m["s"] for m in marks), np.int64, len(marks))
    e = np.fromiter((m["e"] for m in marks), np.int64, len(marks))
    step = np.bincount(s, minlength=n + 1) - np.bincount(e, minlength=n + 1)
    return np.cumsum(step[:n]) > 0
