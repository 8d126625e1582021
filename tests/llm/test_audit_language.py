"""Filter audit and language network against plain versions."""

from __future__ import annotations

import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import audit, language

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- audit ----------------------------------------------------------------------------------------


def verdicts(rows):
    least = {}
    for i, t, *_ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    out = []
    for i, t, *_ in rows:
        t = t or ""
        w = WORD.findall(t)
        caps = sum("A" <= c <= "Z" for c in t)
        out.append({
            "A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * caps > 3 * len(t), "D": any(c in "#$%&*|" for c in t), "E": i is not None and i > least[t],
        })
    return out


def plain_audit(rows, labels):
    good, bad = ({i for i, q, x in labels if i is not None and (q if k else x) == 1} for k in (1, 0))
    out, shap = {}, defaultdict(int)
    fails = verdicts(rows)
    for order in map("".join, itertools.permutations("ABCDE")):
        for step, f in enumerate(order, 1):
            for row, v in zip(rows, fails):
                c = out.setdefault((row[2] or "", order, step), Counter())
                earlier = any(v[g] for g in order[: step - 1])
                c["kept"] += not any(v[g] for g in order[:step])
                c["removed"] += v[f] and not earlier
                c["redundant"] += v[f] and earlier
                c["unique_fails"] += v[f] and sum(v.values()) == 1
                c["good_lost"] += v[f] and not earlier and row[0] in good
                c["toxic_lost"] += v[f] and not earlier and row[0] in bad
                shap[row[2] or "", f] += v[f] and not earlier
    return sorted((p, o, s, *(c[k] for k in COLUMNS), shap[p, o[s - 1]]) for (p, o, s), c in out.items())


COLUMNS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]


def got(df):
    return sorted((r.part, r.filter_order, r.step, *(r[c] for c in COLUMNS), r.shapley) for r in df.collect())


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    words = ["ab", "Ab", "é", "ÉÉ", "中文", "x#", "a|b", "Z", "long" * 30, "\x00", "ß", "\x85", "\xa0w"]
    make = lambda n: rng.choice([" ", "\n", "\t "]).join(rng.choice(words) + rng.choice(["", str(rng.randint(0, 400))]) for _ in range(n))
    texts = [None, "", " \n", "one", "A", "plain words only", "#" * 5, make(6000), "w " * 250]
    texts += [" ".join(f"word{j}" for j in range(i, i + 210)) for i in range(6)]
    texts += [make(rng.randint(1, 400)) for _ in range(40)]
    out = [(i, rng.choice(texts), rng.choice(["en", "de", None, ""]), "s", 1) for i in range(150)]
    return out + [out[5], out[5], (None, "one", "en", "s", 1), (None, "one", "en", "s", 1), (7, "one", "de", "s", 1)]


@pytest.fixture(scope="module")
def labels():
    rng = random.Random(2)
    out = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 170, 2)]
    return out + [(2, 1, 1), (None, 1, 1)]


@pytest.mark.parametrize("piece", [1 << 20, 64])
def test_audit_equals_a_plain_one(spark, rows, labels, piece, monkeypatch):
    monkeypatch.setattr(audit, "PIECE", piece)
    docs = spark.createDataFrame(rows, SCHEMA)
    for c in ("part", "digest", "body", "n", "good", "bad", "fails", "least"):
        docs = docs.withColumn(c, F.lit(3))
    marks = spark.createDataFrame(labels, LABELS).withColumn("good", F.lit(9))
    assert got(audit.audit(docs, marks)) == plain_audit(rows, labels)


def test_audit_counts(spark, rows):
    found = audit.facts(spark.createDataFrame(rows, SCHEMA)).collect()
    for r, (i, t, *_) in zip(found, rows):
        t = t or ""
        w = WORD.findall(t)
        assert (r.doc_id, r.n_words, r.n_distinct, r.n_points) == (i, len(w), len(set(w)), len(t))
        assert (r.n_capitals, r.n_symbols) == (sum("A" <= c <= "Z" for c in t), sum(c in "#$%&*|" for c in t))


@pytest.mark.parametrize("piece", [1 << 20, 7])
def test_words_of_one_hash_are_told_apart(piece, monkeypatch):
    """Every word hashes alike, so that only the bytes decide."""
    monkeypatch.setattr(audit, "PIECE", piece)
    texts = [b"a b a bb b", b"", b"a b", b"longer longer longes"]
    raw = np.frombuffer(b"".join(texts), np.uint8)
    first = np.cumsum([0, *map(len, texts)])
    counts, start, end, hashes = audit.transduce(raw, first)
    owner = np.searchsorted(first, start, side="right") - 1
    assert audit.distinct_words(raw, owner, start, end, np.zeros_like(hashes), len(texts)).tolist() == [3, 0, 2, 2]
    assert counts[:, 0].tolist() == [5, 0, 2, 3]


def test_audit_of_empty_tables(spark, rows):
    none = spark.createDataFrame([], LABELS)
    assert audit.audit(spark.createDataFrame([], SCHEMA), none).collect() == []
    assert got(audit.audit(spark.createDataFrame(rows[:20], SCHEMA), none)) == plain_audit(rows[:20], [])


# --- language -------------------------------------------------------------------------------------


def net_by_hand(net, x):
    """Probabilities of one window with plain loops."""
    e = [net.table[b].astype(float) for b in x]
    hidden, f = [], 0
    for w, n in language.FILTERS.items():
        for _ in range(n):
            best = max(sum(float(e[t + j] @ net.kernel[j * language.DIMS : (j + 1) * language.DIMS, f]) for j in range(w)) for t in range(language.LENGTH))
            hidden.append(max(0.0, best + float(net.bias[f])))
            f += 1
    z = np.array(hidden) @ net.out + net.base
    z = np.exp(z - z.max())
    return z / z.sum()


@pytest.fixture(scope="module")
def spoken():
    rng = random.Random(4)
    parts = {"en": ["the", "ing", "wh", "tion", "and"], "de": ["sch", "ich", "und", "ö", "ver"], "fr": ["eau", "que", "é", "les", "ai"], None: ["the", "sch"]}
    out = []
    for i in range(600):
        lang = rng.choice(["en", "en", "en", "de", "fr", None])
        text = " ".join("".join(rng.choice(parts[lang]) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(8, 200)))
        out.append((i, text, lang, "s", 1))
    return out + [(700, None, "en", "s", 1), (701, "", "de", "s", 1), (702, "12 34 !", "en", "s", 1), (703, "ich und sch " * 60_000, "de", "s", 1), (None, "the and", "en", "s", 1)] + [(705, "les eau que", "fr", "s", 1)] * 40


@pytest.fixture(scope="module")
def net(spark, spoken):
    return language.train(*language.sample(spark.createDataFrame(spoken, SCHEMA)))


def test_network_equals_loops_and_whole_texts_count(spark, spoken, net):
    rng = random.Random(1)
    assert net.languages == ["de", "en", "fr"]
    # training leaves a filter's places beyond its width at 0
    for w, at in zip(language.FILTERS, np.cumsum([0, *language.FILTERS.values()])):
        assert not net.kernel[w * language.DIMS :, at : at + language.FILTERS[w]].any()
    rows = {r.doc_id: r for r in language.predict(spark.createDataFrame(spoken, SCHEMA), net).collect()}
    for i, text, *_ in rng.sample(spoken[:600], 4):
        raw = text.encode()
        pieces = [raw[a : a + language.LENGTH] for a in range(0, len(raw), language.LENGTH)]
        mean = sum(net_by_hand(net, language.padded([p])[0]) * len(p) for p in pieces) / len(raw)
        assert rows[i].lang_pred == net.languages[int(mean.argmax())] and rows[i].score == pytest.approx(mean.max(), abs=1e-4)


def test_held_out_accuracy_and_defined_cases(spark, spoken):
    docs = spark.createDataFrame(spoken, SCHEMA)
    for c in ("share", "n", "i", "piece", "body", "held_out", "score"):
        docs = docs.withColumn(c, F.lit(1))
    rows = language.identify(docs).collect()
    assert len(rows) == len(spoken)
    right = []
    for r, (i, text, lang, *_) in zip(sorted(rows, key=lambda r: (r.doc_id is None, r.doc_id)), sorted(spoken, key=lambda r: (r[0] is None, r[0]))):
        assert r.doc_id == i and r.held_out == (i is not None and zlib.crc32(str(i).encode()) % 5 == 0)
        if not any(c.isalpha() for c in text or ""):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred in ("de", "en", "fr") and 0 < r.score <= 1
            if r.held_out and lang:
                right.append(r.lang_pred == lang)
    assert len(right) > 80 and np.mean(right) > 0.97


def test_held_out_rows_and_other_columns_do_not_matter(spark, spoken, net):
    changed = [(i, "xx" if i is not None and zlib.crc32(str(i).encode()) % 5 == 0 else t, lang, "other", 5) for i, t, lang, *_ in spoken]
    other = language.train(*language.sample(spark.createDataFrame(changed, SCHEMA)))
    assert all(np.allclose(a, b, atol=1e-5) for a, b in zip(net.parts(), other.parts()))


def test_nothing_or_one_language_to_learn(spark, spoken):
    none = spark.createDataFrame([(i, t, None, s, n) for i, t, _, s, n in spoken[:20]], SCHEMA)
    assert {r.lang_pred for r in language.identify(none).collect()} == {"und"}
    assert language.identify(spark.createDataFrame([], SCHEMA)).collect() == []
    one = spark.createDataFrame([(i, t, "en", s, n) for i, t, _, s, n in spoken[:20]], SCHEMA)
    assert {(r.lang_pred, r.score) for r in language.identify(one).collect()} == {("en", 1.0)}


def test_gradients_follow_differences():
    rng = np.random.default_rng(0)
    net = language.Network.fresh(["a", "b"], rng)
    x = language.padded([bytes(rng.integers(97, 123, 40).astype(np.uint8)) for _ in range(6)])
    y = np.array([0, 1, 0, 1, 1, 0])
    widths = np.ones_like(net.kernel)
    loss = lambda: -np.log(net.probabilities(x)[np.arange(6), y].astype(float)).mean()
    for p, g in zip(net.parts()[1:], net.gradients(x, y, widths)[1:]):
        for at in [tuple(rng.integers(0, s) for s in p.shape) for _ in range(4)]:
            old, step = p[at], 1e-2
            p[at] = old + step
            up = loss()
            p[at] = old - step
            down = loss()
            p[at] = old
            assert (up - down) / (2 * step) == pytest.approx(float(g[at]), abs=5e-3)
