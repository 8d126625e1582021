"""Base finds and overlaps of personal data against plain expressions, with many finds in a text."""

from __future__ import annotations

import random
import re

import pytest

from ledgerlens.llm import pii

EXPRESSIONS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def plain(text):
    out = []
    for k, (kind, expression) in enumerate(EXPRESSIONS.items()):
        for m in re.finditer(expression, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False,
                "card": 12 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((m.start(), k, m.end(), kind))
    return sorted(out)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(12)
    pieces = ["word", "é中", "a@b.co", "x.y+z@c-d.e.org", "@", "1.2.3.4", "999.1.2.3", "1.2.3.4.5", "4242 4242 4242 4242", "4111-1111-1111-1111", "123456789012", "+1 (504) 555-2652", "+44.20.7946.0958", "+", "12", "id77123", "\n", "#55-66", "a@b", "..", "-"]
    out = ["".join(rng.choice(pieces) + rng.choice([" ", " ", "", ", "]) for _ in range(rng.randint(1, 60))) for _ in range(120)]
    out.append(" ".join(f"mail a{i}@b.co or id{i:05d} at 10.0.{i % 256}.{i % 256} and" for i in range(900)))
    return out


@pytest.mark.parametrize("chunk, place", [(256, 64), (3, 2)])
def test_base_finds_equal_plain_expressions(spark, texts, chunk, place, monkeypatch):
    monkeypatch.setattr(pii, "CHUNK", chunk)
    monkeypatch.setattr(pii, "PLACE", place)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.find(df).collect():
        want = plain(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(w[1] == k for w in want) for k in range(4)]
        spans = [s for s in r.spans.split(",") if s]
        base = [f"{kind}:{s}:{e}" for s, _, e, kind in want]
        assert [s for s in spans if s in set(base)] == base and len(spans) - len(base) == r.n_discovered
        # what was discovered overlaps no base find
        for s in set(spans) - set(base):
            _, a, b = s.split(":")
            assert not any(w[0] < int(b) and w[2] > int(a) for w in want)


@pytest.mark.parametrize("chunk", [256, 2])
def test_words_before_a_match_reach_over_chunks(spark, texts, chunk, monkeypatch):
    monkeypatch.setattr(pii, "CHUNK", chunk)
    words = re.compile(r"[^\x20\x09-\x0D]+")
    df = spark.createDataFrame([(0, texts[-1])], "doc_id long, text string")
    row = df.select(pii.base(df.text).alias("b"), pii.candidates(df.text).alias("c")).first()
    spans = [(m.start(), m[0]) for m in words.finditer(texts[-1])]
    assert len(row.b) == 1800
    for x in (*row.b[::7], *row.c[::7]):
        i = max(j for j, (s, _) in enumerate(spans) if s <= x.s)
        before = [w for _, w in spans[:i][-2:]]
        assert x.pattern == (re.sub("[0-9]+", "0", " ".join(before).lower()) if len(before) == 2 else "")
