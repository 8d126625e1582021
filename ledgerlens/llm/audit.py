"""Audit of five filters: what each order of them removes, and what that costs.

A byte transducer reads every text once. Its two tables map the class of a byte to the next state and a (state, class) pair
to what is counted there: a word's start, a code point, a capital, a symbol. The state after a byte depends on that byte's
class alone, so the tables are applied to whole arrays of bytes at once; texts of a batch follow each other and each starts
anew. The spans of the words go into a hash table with open addressing. A span meets the one that holds its place: other
document, hash, length or bytes send it to the next place, equal bytes make it a repeated word; no count rests on a hash.

Documents then shrink to the five verdicts. Equal texts are found by SHA-256, summed by digest before anything is compared, so that
no group of copies meets in one task. All orders are derived from the counts of the 32 verdict patterns per part.

Defined cases: a NULL text is empty; a text without words has 0 of 0 distinct words and passes B; an empty text passes C. A
document without doc_id is never a later copy, and rows repeated under one doc_id are not copies of a smaller one. NULL lang and ''
are one part. Several label rows of one document count as good or toxic if one of them says so. Other columns are not read. An empty table
gives no rows.
"""

from __future__ import annotations

import itertools
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import MIX, mix64, whole, word_hashes

#: Bytes the transducer reads at a time (a piece goes on to the end of its last word).
PIECE = 1 << 20

# classes of bytes
_BLANK, _PLAIN, _CAPITAL, _SYMBOL, _LEAD, _TAIL = range(6)
CLASS = np.full(256, _PLAIN, np.uint8)
CLASS[[32, 9, 10, 11, 12, 13]] = _BLANK
CLASS[ord("A") : ord("Z") + 1] = _CAPITAL
CLASS[[ord(c) for c in "#$%&*|"]] = _SYMBOL
CLASS[0x80:0xC0] = _TAIL
CLASS[0xC0:] = _LEAD

# states: between words, inside a word
_OUT, _IN = 0, 1
NEXT = np.array([_OUT, _IN, _IN, _IN, _IN, _IN], np.uint8)

# what a (state, class) pair emits, as bits; the last bit ends a word before this byte
_WORD, _POINT, _CAP, _SYM, _END = 1, 2, 4, 8, 16
EMIT = np.zeros((2, 8), np.uint8)
EMIT[:, [_BLANK, _PLAIN, _CAPITAL, _SYMBOL, _LEAD]] |= _POINT
EMIT[:, _CAPITAL] |= _CAP
EMIT[:, _SYMBOL] |= _SYM
EMIT[_OUT, [_PLAIN, _CAPITAL, _SYMBOL, _LEAD, _TAIL]] |= _WORD
EMIT[_IN, _BLANK] |= _END
EMIT = EMIT.ravel()

COUNTS = ["n_words", "n_distinct", "n_capitals", "n_points", "n_symbols"]

#: The filters by letter: a document fails where the condition holds. E is the copy of a smaller doc_id's text.
FILTERS = {
    "A": lambda: F.col("n_words") < 200,
    "B": lambda: 100 * F.col("n_distinct") < 50 * F.col("n_words"),
    "C": lambda: 100 * F.col("n_capitals") > 3 * F.col("n_points"),
    "D": lambda: F.col("n_symbols") > 0,
}
LETTERS = [*FILTERS, "E"]
_COPY = 1 << (len(LETTERS) - 1)


def _pieces(raw: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of about ``PIECE`` bytes that end where a document or a word ends."""
    at, total = int(first[0]), int(first[-1])
    while at < total:
        end = min(total, at + PIECE)
        limit = int(first[np.searchsorted(first, end)])
        while end < limit and CLASS[raw[end - 1]] != _BLANK:
            ahead = np.flatnonzero(CLASS[raw[end : min(limit, end + PIECE)]] == _BLANK)
            end = end + int(ahead[0]) + 1 if len(ahead) else min(limit, end + PIECE)
        yield at, end
        at = end


def transduce(raw: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Run the tables over texts that follow each other; ``first`` holds where each starts, and the end.

    Returns counts (texts x words, capitals, code points, symbols), then start, end and hash of every word.
    """
    n = len(first) - 1
    counts = np.zeros((n, 4), np.int64)
    starts, ends, hashes = [], [], []
    for lo, hi in _pieces(raw, first):
        part = raw[lo:hi]
        kind = CLASS[part]
        state = np.empty(len(kind), np.uint8)
        state[0] = _OUT
        state[1:] = NEXT[kind[:-1]]
        # texts that have bytes in this piece, each starting anew
        a = int(np.searchsorted(first, lo, side="right")) - 1
        b = int(np.searchsorted(first, hi, side="left"))
        begins = np.maximum(first[a:b], lo) - lo
        filled = np.flatnonzero(np.minimum(first[a + 1 : b + 1], hi) - lo > begins)
        begins = begins[filled]
        state[begins] = _OUT
        out = EMIT[(state << 3) | kind]
        for i, bit in enumerate((_WORD, _CAP, _POINT, _SYM)):
            counts[a + filled, i] += np.add.reduceat((out & bit != 0).astype(np.int32), begins)
        start = np.flatnonzero(out & _WORD)
        # a word ends at a blank, or where its text does
        bounds = np.append(begins[1:], len(part))
        last = bounds[CLASS[part[bounds - 1]] != _BLANK]
        end = np.sort(np.concatenate((np.flatnonzero(out & _END), last)))
        hashes.append(word_hashes(part, start, end))
        starts.append(start + lo)
        ends.append(end + lo)
    join = lambda parts, kind: np.concatenate(parts) if parts else np.empty(0, kind)
    return counts, join(starts, np.int64), join(ends, np.int64), join(hashes, np.uint64)


def _equal(raw: np.ndarray, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Whether the ``n`` bytes from ``a`` are those from ``b``, compared byte by byte in bounded blocks."""
    same = np.empty(len(a), bool)
    upto = np.cumsum(n)
    i = 0
    while i < len(a):
        done = upto[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(upto, done + PIECE, side="right")))
        if j == i + 1:
            same[i] = np.array_equal(raw[a[i] : a[i] + n[i]], raw[b[i] : b[i] + n[i]])
        else:
            size = n[i:j]
            begin = upto[i:j] - size - done
            at = np.arange(int(size.sum())) - np.repeat(begin, size)
            hit = raw[np.repeat(a[i:j], size) + at] == raw[np.repeat(b[i:j], size) + at]
            same[i:j] = np.logical_and.reduceat(hit, begin)
        i = j
    return same


def distinct_words(raw: np.ndarray, owner: np.ndarray, start: np.ndarray, end: np.ndarray, hashes: np.ndarray, texts: int) -> np.ndarray:
    """Number of different words of each text, by a hash table of spans whose hits are verified by their bytes."""
    size = end - start
    places = 1 << max(4, int(2 * max(1, len(start)) - 1).bit_length())
    mask = np.uint64(places - 1)
    slot = mix64(hashes ^ (owner.astype(np.uint64) * MIX)) & mask
    table = np.full(places, -1, np.int64)
    new = np.zeros(len(start), bool)
    open_ = np.arange(len(start))
    while len(open_):
        at = slot[open_]
        free = table[at] < 0
        # of several that want a free place, one gets it and the others meet it there
        table[at[free]] = open_[free]
        holder = table[at]
        mine = holder == open_
        new[open_[mine]] = True
        rest, holder = open_[~mine], holder[~mine]
        alike = (owner[rest] == owner[holder]) & (hashes[rest] == hashes[holder]) & (size[rest] == size[holder])
        pair = np.flatnonzero(alike)
        alike[pair] = _equal(raw, start[rest[pair]], start[holder[pair]], size[rest[pair]])
        open_ = rest[~alike]
        slot[open_] = (slot[open_] + np.uint64(1)) & mask
    return np.bincount(owner[new], minlength=texts)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text = batch.column(batch.schema.get_field_index("body")).cast(pa.binary())
        n = len(text)
        got = np.zeros((n, len(COUNTS)), np.int64)
        if n:
            _, places, data = text.buffers()
            first = np.frombuffer(places, np.int32)[text.offset : text.offset + n + 1].astype(np.int64)
            raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
            # groups of whole texts, so that one table holds the words of few texts
            i = 0
            while i < n:
                j = max(i + 1, int(np.searchsorted(first, first[i] + PIECE, side="right")) - 1)
                here = first[i : j + 1]
                counts, start, end, hashes = transduce(raw, here)
                owner = np.searchsorted(here, start, side="right") - 1
                got[i:j, [0, 2, 3, 4]] = counts
                got[i:j, 1] = distinct_words(raw, owner, start, end, hashes, j - i)
                i = j
        kept = [c for c in batch.schema.names if c != "body"]
        yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in kept), *(pa.array(got[:, k]) for k in range(len(COUNTS)))], [*kept, *COUNTS])


def facts(docs: DataFrame) -> DataFrame:
    """doc_id, part, digest of the text (SHA-256) and the counts of ``COUNTS``, one row per document."""
    rows = docs.select("doc_id", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), F.unhex(F.sha2(whole(), 256)).alias("digest"), whole().alias("body"))
    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(_measure, f"doc_id {kind}, part string, digest binary, " + ", ".join(f"{c} long" for c in COUNTS))


def patterns(measured: DataFrame, labels: DataFrame) -> DataFrame:
    """part, fails (one bit a filter, first filter lowest) and the documents, good and toxic ones among them, with that pattern."""
    bits = [F.when(F.coalesce(test(), F.lit(False)), F.lit(1 << i)).otherwise(F.lit(0)) for i, test in enumerate(FILTERS.values())]
    mask = bits[0]
    for b in bits[1:]:
        mask = mask + b
    # rows of one document and text are one row from here on
    once = measured.groupBy("doc_id", "part", "digest", mask.alias("fails")).agg(F.count(F.lit(1)).alias("n"))
    marks = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("bad"))
    marked = once.where(F.col("doc_id").isNotNull()).join(marks, "doc_id", "left").unionByName(once.where(F.col("doc_id").isNull()), allowMissingColumns=True)
    marked = marked.withColumns({"good": F.coalesce("good", F.lit(0)), "bad": F.coalesce("bad", F.lit(0))})
    # copies: one row per text, part and labels, with its smallest document and the rows that one has
    least = F.struct(F.col("doc_id"), F.col("n"))
    by_id = marked.groupBy("digest", "part", "fails", "good", "bad", "doc_id").agg(F.sum("n").alias("n"))
    # rows without an id sort behind all others here and are no copies of anything
    known = F.col("doc_id").isNotNull()
    groups = by_id.groupBy("digest", "part", "fails", "good", "bad").agg(
        F.sum("n").alias("n"), F.sum(F.when(known, F.col("n")).otherwise(0)).alias("known"), F.min(F.when(known, least)).alias("least")
    )
    first = F.min("least.doc_id").over(W.partitionBy("digest"))
    firsts = F.when(F.col("least.doc_id") == first, F.col("least.n")).otherwise(F.lit(0))
    split = groups.withColumn("copies", F.coalesce(F.col("known") - firsts, F.lit(0)))
    cells = F.array(F.struct(F.col("fails"), (F.col("n") - F.col("copies")).alias("n")), F.struct((F.col("fails") + _COPY).alias("fails"), F.col("copies").alias("n")))
    flat = split.select("part", "good", "bad", F.inline(cells))
    return flat.groupBy("part", "fails").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("bad")).alias("bad"))


def orders(counted: DataFrame) -> DataFrame:
    """What every step of every order of the filters keeps and removes in each part, from the counts of the patterns."""
    steps = []
    for order in itertools.permutations(range(len(LETTERS))):
        name, before = "".join(LETTERS[i] for i in order), 0
        for step, i in enumerate(order, 1):
            steps.append({"filter_order": name, "step": step, "before": before, "own": 1 << i})
            before |= 1 << i
    listed = F.from_json(F.lit(json.dumps(steps)), "array<struct<filter_order string, step int, before int, own int>>")
    c = counted.select("*", F.inline(listed))
    failed, gone = F.col("fails").bitwiseAND(F.col("own")) != 0, F.col("fails").bitwiseAND(F.col("before")) != 0
    total = lambda test, what="n": F.sum(F.when(test, F.col(what)).otherwise(F.lit(0))).cast("long")
    out = c.groupBy("part", "filter_order", "step", "own").agg(
        total(~failed & ~gone).alias("kept"),
        total(failed & ~gone).alias("removed"),
        total(failed & gone).alias("redundant"),
        total(F.col("fails") == F.col("own")).alias("unique_fails"),
        total(failed & ~gone, "good").alias("good_lost"),
        total(failed & ~gone, "bad").alias("toxic_lost"),
    )
    # 120 rows per part and filter
    return out.withColumn("shapley", F.sum("removed").over(W.partitionBy("part", "own"))).drop("own")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, with what the step keeps, removes and loses."""
    return orders(patterns(facts(docs), labels))


_MASK = " + ".join(f"CASE WHEN {c} THEN {1 << i} ELSE 0 END" for i, c in enumerate(["nw < 200", "100 * nd < 50 * nw", "100 * caps > 3 * length(t)", "regexp_matches(t, '[#$%&*|]')", "coalesce(doc_id > lo, false)"]))
_PICK = ", ".join(f"l{i}.f AS f{i}, l{i}.b AS b{i}" for i in range(1, 6))
_FROM = ", ".join(f"letters l{i}" for i in range(1, 6))
_STEPS = " UNION ALL ".join(
    f"SELECT f1 || f2 || f3 || f4 || f5 AS filter_order, {i} AS step, b{i} AS own, {' + '.join(['0', *(f'b{j}' for j in range(1, i))])} AS before FROM perms" for i in range(1, 6)
)
SQL = rf"""
    WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
    m AS (SELECT *, len(ws) AS nw, len(list_distinct(ws)) AS nd, length(regexp_replace(t, '[^A-Z]', '', 'g')) AS caps, min(doc_id) OVER (PARTITION BY t) AS lo FROM d),
    v AS (SELECT doc_id, part, {_MASK} AS fails FROM m),
    k AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels GROUP BY 1),
    c AS (SELECT part, fails, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(bad, 0)) AS bad FROM v LEFT JOIN k USING (doc_id) GROUP BY 1, 2),
    letters AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS x(f, b)),
    perms AS (SELECT {_PICK} FROM {_FROM} WHERE l1.b | l2.b | l3.b | l4.b | l5.b = 31),
    steps AS ({_STEPS}),
    r AS (SELECT part, filter_order, step, own, sum(CASE WHEN fails & own = 0 AND fails & before = 0 THEN n ELSE 0 END) AS kept,
        sum(CASE WHEN fails & own <> 0 AND fails & before = 0 THEN n ELSE 0 END) AS removed, sum(CASE WHEN fails & own <> 0 AND fails & before <> 0 THEN n ELSE 0 END) AS redundant,
        sum(CASE WHEN fails = own THEN n ELSE 0 END) AS unique_fails, sum(CASE WHEN fails & own <> 0 AND fails & before = 0 THEN good ELSE 0 END) AS good_lost,
        sum(CASE WHEN fails & own <> 0 AND fails & before = 0 THEN bad ELSE 0 END) AS toxic_lost FROM c, steps GROUP BY 1, 2, 3, 4)
    SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
        CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
        CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM r
"""
