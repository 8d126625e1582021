"""The hash tree and its proofs against a plain rebuild."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    cell = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return h(*[cell(v) for v in (doc_id, source, lang, n_chars, text)])


def tree(leaves):
    """Top, and each leaf's siblings per level as (left, right)."""
    ways = [[] for _ in leaves]
    members = [[i] for i in range(len(leaves))]
    while len(leaves) > 1:
        up, held = [], []
        for a in range(0, len(leaves), 8):
            run = leaves[a : a + 8]
            for j in range(len(run)):
                for i in members[a + j]:
                    ways[i].append((run[:j], run[j + 1 :]))
            up.append(h(*run))
            held.append([i for m in members[a : a + 8] for i in m])
        leaves, members = up, held
    return leaves[0], ways


def expected(rows):
    langs = sorted({r[2] for r in rows}, key=lambda v: (v is not None, (v or "").encode()))
    subs, found = [], {}
    for lang in langs:
        mine = sorted(((r[0] is not None, r[0] or 0, leaf(*r)), r) for r in rows if r[2] == lang)
        top, ways = tree([k[2] for k, _ in mine])
        subs.append(top)
        found[lang] = [(r, k[2], w, top) for (k, r), w in zip(mine, ways)]
    root, sub_ways = tree(subs)
    out = []
    for lang, more in zip(langs, sub_ways):
        for r, digest, way, top in found[lang]:
            way = way + more
            seen = digest
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[1] is not None:
                low = "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1])
                seen = leaf(r[0], low, *r[2:])
            for left, right in way:
                seen = h(*left, seen, *right)
            proof = h(*[d for left, right in way for d in (*left, *right)])
            out.append((r[0], digest, top, root, proof, seen, seen == root))
    return out


def got(df):
    return [(r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in df.collect()]


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def made(n, langs, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = langs[min(len(langs) - 1, int(rng.random() ** 2 * len(langs)))]
        text = rng.choice([None, "", "Plain Text", "no capitals", "ÄÖ É only", f"Number {i}", "x" * 5000])
        rows.append((i * 3, text, lang, rng.choice([None, "s", "ü"]), rng.choice([None, 0, i])))
    return rows


@pytest.mark.parametrize("n, langs", [(1, ["en"]), (8, ["en"]), (9, ["en"]), (2, ["en", None]), (75, ["en", "de", None, ""]), (700, ["en", "zz", "é", "a"]), (60, [f"l{i}" for i in range(40)])])
def test_proofs_equal_a_plain_rebuild(spark, n, langs):
    rows = made(n, langs)
    assert order(got(merkle.tampered(spark.createDataFrame(rows, SCHEMA)))) == order(expected(rows))


def test_repeated_rows_null_ids_and_other_columns(spark):
    rows = made(20, ["en", None])
    rows += [rows[4]] * 30 + [(None, "Text", "en", "s", 1)] * 3 + [(None, None, None, None, None)] + [(6, "Other", "en", None, 2), (6, "Another", "en", None, 2)]
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("tree", "pos", "size", "digest", "payload", "spare", "way", "to", "sub", "leaf", "root"):
        df = df.withColumn(c, F.lit(7))
    assert order(got(merkle.tampered(df))) == order(expected(rows))


def test_empty_table(spark):
    assert merkle.tampered(spark.createDataFrame([], SCHEMA)).collect() == []


def test_far_ancestors_are_repeated(spark):
    """A tree of more than 2 * 4 levels jumps over 8 levels through salted copies of the ancestor."""
    rows = [(i, str(i), "en", None, 1) for i in range(700)]
    merkle_fan, merkle.FAN = merkle.FAN, 2
    try:
        found, root = merkle.proofs(merkle.leaves_of(spark.createDataFrame(rows, SCHEMA)))
        kept = found.select(merkle.hexed(F.col("digest")).alias("d"), merkle.fold(merkle.hexed(F.col("digest")), F.col("way")).alias("r"), F.size("way").alias("n")).collect()
    finally:
        merkle.FAN = merkle_fan
    level = [leaf(*r) for r in rows]
    assert sorted(k.d for k in kept) == sorted(level)
    while len(level) > 1:
        level = [h(*level[a : a + 2]) for a in range(0, len(level), 2)]
    assert root == level[0] and {k.r for k in kept} == {root} and {k.n for k in kept} == {10}
