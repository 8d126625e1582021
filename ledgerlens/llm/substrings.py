"""Substring deduplication by prefix-partitioned suffix trees.

Suffixes are split into memory-sized groups by variable-length prefixes: the prefix of a suffix reaches up to and
including the anchor of its first window (see ``windows``), and prefixes with the same anchor form one group; crowded
groups are split on, down to prefixes of a whole window. A group's suffix tree is grown from the top, a
range of words at a time: open suffixes read their next words, nodes split by them, and suffixes alone in their node are
leaves and drop out; the fewer are left, the longer the range. Nodes that reach a window's length are the deep internal
nodes, and their suffixes are the starts of repeats.

Removed is every word covered by a window whose word sequence starts anywhere else too. Defined cases: NULL, empty and
short texts keep all words; repeated rows see ``windows``; very long texts are handled in overlapping pieces; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import word_hashes, words_of
from .windows import NO_ID, Spec, covered, named, spans

SPEC = Spec("word", 35, 5, False)


def deep_nodes(ids: np.ndarray, starts: np.ndarray, node: np.ndarray, depth: int, reads: int = 1 << 20) -> np.ndarray:
    """Mask of the suffixes (by start) that share a node of at least ``depth`` words with another one."""
    alive = np.arange(len(starts))
    at = 0
    while at < depth and len(alive):
        # elastic range: few open suffixes read far ahead
        span = int(min(depth - at, max(1, reads // max(1, len(alive)))))
        columns = [ids[starts[alive] + at + i] for i in range(span)]
        order = np.lexsort((*columns[::-1], node))
        new = np.zeros(len(order), bool)
        new[:1] = True
        for c in (node, *columns):
            c = c[order]
            new[1:] |= c[1:] != c[:-1]
        label = np.cumsum(new) - 1
        inner = np.bincount(label)[label] > 1
        alive, node = alive[order][inner], label[inner]
        at += span
    out = np.zeros(len(starts), bool)
    out[alive] = True
    return out


def trees(spec: Spec):
    """Decide a batch of groups at once: the key is the root's child a suffix hangs under."""

    def decide(rows: list[tuple]) -> np.ndarray:
        values = []
        for r in rows:
            s, e = words_of(r[5])
            values.append(word_hashes(r[5], s, e))
        lens = np.array([len(v) for v in values])
        begin = np.cumsum(lens) - lens
        _, ids = np.unique(np.concatenate(values), return_inverse=True)
        n = np.array([r[4] for r in rows])
        owner = np.repeat(np.arange(len(rows)), n)
        at = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        _, node = np.unique(np.array([r[0] for r in rows]), return_inverse=True)
        return deep_nodes(ids, begin[owner] + at, node[owner], spec.length)

    return decide


def dedup(docs: DataFrame, length: int = SPEC.length, texts: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and, on request, the kept text, per row of ``docs``."""
    spec = Spec("word", length, min(SPEC.gram, length), False)
    base = named(docs)
    joined = base.join(spans(base, spec, trees(spec)), ["doc", "sub"], "left").select("doc", "text", "marks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, text, marks in zip(*(batch.column(i) for i in range(3))):
                raw = text.as_py().encode()
                begin, end = words_of(raw)
                gone = covered(marks.as_py(), len(begin))
                keep = np.flatnonzero(~gone)
                kept = b" ".join([raw[a:b] for a, b in zip(begin[keep].tolist(), end[keep].tolist())])
                doc = doc.as_py()
                out.append((None if doc == NO_ID else doc, len(begin), int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept.decode() if texts else None))
            yield pa.RecordBatch.from_pylist([dict(zip(("doc_id", "n_words", "n_removed", "kept_sha256", "kept"), o)) for o in out], schema=OUT)

    done = joined.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")
    return done if texts else done.drop("kept")


OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.string())])
