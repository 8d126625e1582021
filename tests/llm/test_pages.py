"""HTML extraction against plain counts of repeated substrings."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from math import ceil

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import pages

SCHEMA = "page_id long, url string, html string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def expected(rows):
    """(page_id, text) by counting every substring of every distinct page."""
    read = [(i, pages.host(u), [(p, t) for p, t in pages.blocks(h or "") if p != "chrome"]) for i, u, h in rows]
    seen = defaultdict(lambda: defaultdict(set))
    distinct = defaultdict(set)

    def windows(text):
        w = WORD.findall(text)
        n = pages.LENGTH
        return [tuple(w[j : j + n]) for j in range(max(1, len(w) - n + 1))]

    for _, host, found in read:
        if host:
            page = tuple(found)
            distinct[host].add(page)
            for _, t in found:
                for w in windows(t):
                    seen[host][w].add(page)
    out = []
    for i, host, found in read:
        n = len(distinct[host])
        kept = []
        part = "main" if any(p == "main" for p, _ in found) else "open"
        own = [t for p, t in found if p == part]
        for t in own:
            least = max(pages.PAGES, ceil(n * pages.SHARE[part]))
            words, ws = WORD.findall(t), windows(t)
            cover = set()
            for j, w in enumerate(ws):
                if host and len(seen[host][w]) >= least:
                    cover.update(range(j, j + len(w)))
            if len(cover) < len(words):
                kept.append(t)
        out.append((i, "\n".join(kept or own)))
    return sorted(out, key=str)


def got(df):
    return sorted([(r.page_id, r.text) for r in df.collect()], key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    words = [f"w{i}é" if i % 7 == 0 else f"w{i}" for i in range(60)]
    make = lambda n: " ".join(rng.choice(words) for _ in range(n))
    lines = [make(n) for n in (2, 3, 9, 14, 30)]
    out, page = [], 0
    for host, count, urls in (("a.org", 24, "http://a.org/{}"), ("b.org", 4, "https://B.org:8080/{}"), ("c.org", 2, "http://c.org/{}"), (None, 5, None), ("", 4, "::odd {}")):
        article = make(40)
        for i in range(count):
            parts = [f"<p>{t}</p>" for t in lines if rng.random() < 0.7] + [f"<p>{make(rng.randint(1, 60))}</p>" for _ in range(rng.randint(0, 5))]
            if i % 6 == 0:
                parts.append(f"<p>{article}</p>")
            rng.shuffle(parts)
            body = "".join(parts)
            if i % 3 == 0:
                body = f"<nav>{lines[2]}</nav><article>{body}</article><p>{lines[3]} {make(3)}</p>"
            out.append((page, urls and urls.format(i), f"<html><body>{body}<footer>{make(5)}</footer></body>"))
            page += 1
    out += [out[1], out[1], (900, out[2][1], out[2][2]), (901, "http://a.org/x", None), (902, None, ""), (None, "http://b.org", "<p>x")]
    return out


@pytest.mark.parametrize("crowd, group", [(20_000, 1 << 20), (1, 1), (3, 1 << 20)])
def test_text_equals_plain_counts(spark, rows, crowd, group, monkeypatch):
    monkeypatch.setattr(pages, "CROWD", crowd)
    monkeypatch.setattr(pages, "GROUP", group)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for c in ("host", "row", "key", "n", "texts", "digest", "parts", "some"):
        df = df.withColumn(c, F.lit(1))
    want = expected(rows)
    assert got(pages.extract(df)) == want
    whole = {(i, "\n".join(t for p, t in pages.blocks(h or "") if p == ("main" if any(q == "main" for q, _ in pages.blocks(h or "")) else "open"))) for i, _, h in rows}
    assert sum(w not in whole for w in want) > 5


def test_what_is_no_boilerplate_stays(spark):
    phrase = "the council said on monday that the new bridge"
    rows = [(1, "http://n.org/1", f"<p>{phrase} opens</p><p>first</p>"), (2, "http://n.org/2", f"<p>{phrase} closes</p><p>second</p>")]
    # an article under several ids, with and without a main part
    story = "<p>" + " ".join(f"s{i}" for i in range(40)) + "</p>"
    rows += [(10 + i, f"http://copy.org/{i}", f"{story}<div>{'x' * i}</div>") for i in range(4)]
    rows += [(20 + i, f"http://main.org/{i}", f"<article>{story}</article>") for i in range(6)]
    rows += [(30 + i, None, f"<p>{phrase}</p><p>page {i}</p>") for i in range(5)]
    text = dict(got(pages.extract(spark.createDataFrame(rows, SCHEMA))))
    assert text[1] == f"{phrase} opens\nfirst" and text[2] == f"{phrase} closes\nsecond"
    body = story[3:-4]
    assert text[10] == body and all(text[20 + i] == body for i in range(6))
    assert all(text[30 + i] == f"{phrase}\npage {i}" for i in range(5))


def test_notices_go_from_main_parts_and_others(spark):
    notice = "all rights reserved by the publisher of this site since 1999"
    rows = [(i, f"http://site.org/{i}", f"<article><p>share this</p><p>story number {i}</p><p>{notice}</p></article>") for i in range(10)]
    rows += [(50 + i, f"http://plain.org/{i}", f"<div><p>{notice}</p><p>story number {i}</p></div>") for i in range(3)]
    text = dict(got(pages.extract(spark.createDataFrame(rows, SCHEMA))))
    assert all(text[i] == f"story number {i}" for i in range(10)) and all(text[50 + i] == f"story number {i}" for i in range(3))


def test_one_anchor_with_many_surroundings(spark, monkeypatch):
    """10,000 different stretches around one phrase of a host."""
    monkeypatch.setattr(pages, "CROWD", 500)
    rows = [(i, "http://big.org/", f"<p>generated in 0.{i} seconds by the machine of the house number {i % 7}</p><p>unique {i}</p><p>generated by the machine of the house and nothing else here</p>") for i in range(10_000)]
    out = pages.extract(spark.createDataFrame(rows, SCHEMA).repartition(8)).collect()
    assert len(out) == 10_000
    for r in out:
        assert r.text == f"generated in 0.{r.page_id} seconds by the machine of the house number {r.page_id % 7}\nunique {r.page_id}"


def test_empty_table_and_repeated_rows(spark):
    assert pages.extract(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(7, "http://h.org/", "<p>same</p>")] * 5 + [(7, "http://h.org/", "<p>other</p>"), (None, None, None)]
    assert got(pages.extract(spark.createDataFrame(rows, SCHEMA))) == sorted([(7, "same")] * 5 + [(7, "other"), (None, "")], key=str)


def test_copies_are_written_before_the_pages_move(spark, monkeypatch):
    """A short list of copies is known to be short, so that the texts are not dealt out for it."""
    names, write = [], pages.stored
    monkeypatch.setattr(pages, "stored", lambda df, name: names.append(name) or write(df, name))
    html = "<p>one two three four five six seven eight nine ten</p>"
    rows = [(i, "http://h.example/a", html + f"<p>{i % 4} own words</p>") for i in range(8)]
    got = pages.extract(spark.createDataFrame(rows, SCHEMA)).collect()
    assert "pages-copies" in names and len(got) == 8 and {r.text for r in got} == {f"{i} own words" for i in range(4)}


def test_anchors_travel_packed(spark):
    """About four bytes travel for an anchor, however the pages of hosts are mixed; counts are those of single pages."""
    rng = np.random.default_rng(3)
    many = [(f"h{i % 5}.example", [" ".join(f"w{w}" for w in rng.integers(0, 400, 60)) + " one two three four five six seven eight"], 1 + i % 5) for i in range(1500)]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*many)], names=["host", "texts", "cuts"])
    out = pa.Table.from_batches(pages._anchors(iter([batch])))
    want = Counter()
    for name, texts, cuts in many:
        values, ends = pages.streams(texts)
        part, upper = pages._placed(np.unique(pages.mix64(pages.stretches(values, ends, pages.SPEC)[0] ^ pages._salt(name))), cuts)
        want.update((name, p, u) for p, u in zip(part.tolist(), upper.tolist()))
    got = Counter()
    for row in out.to_pylist():
        got.update({(row["host"], row["part"], k): row["c"] for k in row["keys"]})
    assert got == want and out.nbytes < 5 * len(want)
