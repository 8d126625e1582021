"""Brute-force checks of the corpus operators on small hard tables."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import public_tokenizers
import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerlens.llm import bpe, chat, exact, jaccard, mixing, pages, pii, quality, runs, substrings, windows
from ledgerlens.llm.q_ops import pattern, ranks_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, sub string, marks string, node string"


def sha(b):
    return hashlib.sha256(b if isinstance(b, bytes) else b.encode()).hexdigest()


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdeéß中") for _ in range(rng.randint(1, 7))) for _ in range(400)]
    make = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage, line = make(60), make(12)
    out = [None, "", " \t\n", "one", "Two words", "x" * 3000, "na " * 400, line, line, make(5000)]
    for i in range(40):
        body = make(rng.randint(20, 120))
        out.append(body)
        if i % 3 == 0:
            out += [body, body.replace(" ", "\n", 3), body.upper()]
        if i % 4 == 0:
            out.append(f"{make(9)} {passage} {make(7)}")
        if i % 5 == 0:
            near = body.split(" ")
            near[len(near) // 2] = "changed"
            out.append(" ".join(near))
        if i % 6 == 0:
            out.append(f"{line} {make(30)} {line}")
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, ["en", "de", None][i % 3], ["a", "b", None][i % 2 if i % 7 else 2], 1, "s", "m", "n") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def test_substring_dedup(docs, texts):
    ws = [WORD.findall(t or "") for t in texts]
    seen = Counter(tuple(w[j : j + 35]) for w in ws for j in range(len(w) - 34))
    got = by_id(substrings.dedup(docs))
    for i, w in enumerate(ws):
        gone = set()
        for j in range(len(w) - 34):
            if seen[tuple(w[j : j + 35])] > 1:
                gone.update(range(j, j + 35))
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        assert (got[i].n_words, got[i].n_removed, got[i].kept_sha256) == (len(w), len(gone), sha(kept))


@pytest.mark.parametrize("crowd", [20_000, 1])
def test_run_index(docs, texts, crowd, monkeypatch):
    monkeypatch.setattr(windows, "CROWD", crowd)
    got = by_id(runs.dedup(docs))
    seen = set()
    for i, t in enumerate(texts):
        b = (t or "").encode()
        gone = set()
        for j in range(len(b) - 99):
            if b[j : j + 100] in seen:
                gone.update(range(j, j + 100))
            seen.add(b[j : j + 100])
        spans = sum(1 for j in gone if j - 1 not in gone)
        rest = bytes(x for j, x in enumerate(b) if j not in gone)
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans, got[i].kept_sha256) == (len(b), len(gone), spans, sha(rest))


@pytest.mark.parametrize("pairs", [8, 2])
def test_jaccard(docs, texts, pairs, monkeypatch):
    monkeypatch.setattr(jaccard, "PAIRS", pairs)
    assert linked(docs) == shingle_components(texts)


@pytest.mark.parametrize("pairs", [2, 4])
def test_jaccard_in_large_families(spark, pairs, monkeypatch):
    """Near copies of which many are too far from the most linked text but similar to one another."""
    monkeypatch.setattr(jaccard, "PAIRS", pairs)
    rng = random.Random(11)
    make = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    base, passage = make(150), make(40)
    family = [list(base)]
    for i in range(160):
        copy = list(rng.choice(family) if i % 2 else base)
        for _ in range(rng.randint(1, 6)):
            at = rng.randrange(len(copy))
            copy[at : at + rng.randint(0, 1)] = make(rng.randint(0, 1)) or ["gone"]
        family.append(copy)
    family += [make(rng.randint(3, 15)) + passage + make(rng.randint(3, 15)) for _ in range(60)]
    rng.shuffle(family)
    texts = [" ".join(f) for f in family]
    got = linked(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    want = shingle_components(texts)
    assert got == want
    assert 1 < len({c for _, c in want.values()}) < len(texts)


@pytest.mark.parametrize("sets", [1024, 7])
def test_jaccard_counts_all_links(spark, sets, monkeypatch):
    """Families of more near copies than a meeting place gives pairs of, in one block and in several."""
    monkeypatch.setattr(jaccard, "BLOCK_SETS", sets)
    monkeypatch.setattr(jaccard, "LISTED", 50)
    rng = random.Random(3)
    texts = []
    for size, most in ((150, 3), (60, 12), (9, 1)):
        base = [f"w{rng.randrange(10**6)}" for _ in range(size)]
        for _ in range(60):
            copy = list(base) + [f"e{rng.randrange(10**6)}" for _ in range(rng.randint(0, most))]
            for _ in range(rng.randint(0, 2) if size > 9 else 0):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(10**6)}"
            texts.append(" ".join(copy))
    sets_of = [{tuple(w[j : j + 5]) for j in range(len(w) - 4)} for w in map(str.split, texts)]
    distinct = list({frozenset(s) for s in sets_of})
    alike = lambda a, b: 100 * len(a & b) >= 80 * len(a | b)
    want = [sum(alike(s, o) for o in distinct) - 1 for s in sets_of]
    got = by_id(jaccard.linked_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")))
    assert [got[i].links for i in range(len(texts))] == want
    assert max(want) > 3 * jaccard.PAIRS and {i: (r.n_shingles, r.component_id) for i, r in got.items()} == shingle_components(texts)


def test_jaccard_bounds_of_differences():
    """Similar sets share a difference from any hub that both look up, at places and with parities that allow a link."""
    rng = np.random.default_rng(5)
    seen = 0
    for _ in range(3000):
        hub = np.unique(rng.integers(0, 1 << 60, rng.integers(5, 120)).astype(np.uint64))
        edit = lambda s, most: np.unique(np.concatenate((rng.permutation(s)[rng.integers(0, most) :], rng.integers(0, 1 << 60, rng.integers(0, most)).astype(np.uint64))))
        x = edit(hub, max(2, len(hub) // 2))
        y = edit(x, max(2, len(x) // 7))
        if not len(x) or not len(y) or not jaccard.similar(x, y):
            continue
        d = [np.concatenate((np.setdiff1d(s, hub), np.setdiff1d(hub, s))) for s in (x, y)]
        if (len(d[0]), 0) < (len(d[1]), 1):
            x, y, d = y, x, d[::-1]
        # x is the farther one now; links to the hub need no second look
        if jaccard.similar(x, hub):
            continue
        seen += 1
        close = jaccard.similar(y, hub)
        lead = jaccard._front(len(d[1]), len(y), len(hub))
        lead = lead if close else min(lead, len(y) // 8 + 1)
        whole = d[0][: jaccard._front(len(d[0]), len(x), len(hub), whole=True)]
        apart = len(np.setxor1d(x, y))
        places = [(p, d[1][:lead].tolist().index(v)) for p, v in enumerate(whole.tolist()) if v in set(d[1][:lead].tolist())]
        assert places and min(p + q + abs((len(d[0]) - p) - (len(d[1]) - q)) for p, q in places) <= apart
        assert sum(int(v).bit_count() for v in (jaccard.parity(x) ^ jaccard.parity(y)).view(np.uint64)) <= apart
    assert seen > 100


def linked(docs):
    return {i: (r.n_shingles, r.component_id) for i, r in by_id(jaccard.linked_documents(docs)).items()}


def shingle_components(texts):
    """Per text its number of shingles and its component, from all pairs."""
    low = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    sets = []
    for t in texts:
        w = WORD.findall((t or "").translate(low))
        sets.append({tuple(w)} if 0 < len(w) < 5 else {tuple(w[j : j + 5]) for j in range(len(w) - 4)})
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 80 * (len(a) + len(sets[j]) - both):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in enumerate(sets)}


def test_exact(docs, texts):
    norm = [re.sub(r"[\x20\x09-\x0D]", "", t or "") for t in texts]
    groups = defaultdict(list)
    for i, n in enumerate(norm):
        groups[n].append(i)
    got = by_id(exact.dedup(docs, files_per_batch=1))
    for i, n in enumerate(norm):
        keep = min(groups[n], key=lambda j: (-len(texts[j] or ""), j))
        assert (got[i].keep_id, got[i].group_size, got[i].kept, got[i].text_sha256) == (keep, len(groups[n]), i == keep, sha(n))


def test_quality_counts(docs, texts):
    got = by_id(quality.judge(docs))
    for i, t in enumerate(texts):
        w = WORD.findall(t or "")
        c = Counter(tuple(w[j : j + 8]) for j in range(len(w) - 7))
        twice = {k for j in range(len(w) - 7) if c[tuple(w[j : j + 8])] > 1 for k in range(j, j + 8)}
        lines = [x for x in (t or "").split("\n") if WORD.search(x)]
        want = (len(w), sum(map(len, w)), sum((t or "").count(s) for s in "#*$%&|<>"), len(lines) - len(set(lines)), len(twice))
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (len(w) < 20 or 100 * len(twice) > 30 * len(w)) and not (r.base_failed and r.kept)


def test_covariances_are_inverted(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, quality.DIMS)) * [1, 0.2, 0.01, 0.3, 0.1]
    x[:, 4] += x[:, 0]
    rows = spark.createDataFrame([("g", *map(float, r)) for r in x], "grp string, " + ", ".join(f"{c} double" for c in quality.X))
    got = quality._solve(rows.groupBy("grp").agg(*quality._sums()), 1.2).first()
    cov = np.cov(x.T, bias=True) * 1.2
    np.fill_diagonal(cov, np.maximum(np.diag(cov), np.square(quality.FLOOR)))
    want = np.linalg.inv(cov)
    assert all(abs(got[f"w{i}{j}"] - want[i, j]) < 1e-3 * max(1, abs(want[i, j])) for i, j in quality.PAIRS)


def test_quality_rejects_outliers(spark):
    rng = random.Random(3)
    words = ["lorem", "ipsum", "dolor", "sit", "amet", "consec", "elit", "sed", "do", "eius"]
    good = [" ".join(rng.choice(words) for _ in range(rng.randint(60, 300))) for _ in range(150)]
    bad = [" ".join(rng.choice(words) + "###" for _ in range(100)) for _ in range(20)]
    df = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(good + bad)], "doc_id long, text string, lang string, source string")
    got = by_id(quality.judge(df))
    assert all(got[i].kept for i in range(150)) and not any(got[i].kept for i in range(150, 170))


def test_bpe(docs, texts):
    ranks = bpe.read_ranks(ranks_path())
    want = tiktoken.Encoding("t", pat_str=pattern(), mergeable_ranks=ranks, special_tokens={})
    got = by_id(bpe.encode(docs, ranks_path(), pattern(), with_ids=True))
    for i, t in enumerate(texts):
        ids = want.encode_ordinary(t or "")
        assert got[i].n_tokens == len(ids) and got[i].ids == b"".join(x.to_bytes(4, "little") for x in ids) and got[i].decoded_sha256 == sha(t or "")


def test_bpe_appends_and_edits():
    coder, split = bpe.coder(public_tokenizers.path("byte_bpe_50k.tiktoken"), pattern())
    rng = random.Random(2)
    for _ in range(100):
        text = "".join(rng.choice("abcde the ing'sé1") for _ in range(rng.randint(0, 50)))
        table = coder.lasts(text.encode())
        assert coder.extend(text.encode(), table, b"tion") == coder.lasts(text.encode() + b"tion")
        a = rng.randint(0, len(text.encode()))
        b = rng.randint(a, len(text.encode()))
        changed, edited = coder.edit(text.encode(), table, a, b, b"xy")
        assert edited == coder.lasts(changed)
        doc = bpe.Document(coder, split, text)
        doc.replace(len(text) // 2, len(text) // 2 + 1, " new ")
        assert doc.ids() == bpe.encode_text(doc.text, coder, split).tolist()


def test_mixing(spark):
    rng = random.Random(4)
    rows = [(i, "w " * rng.randint(0, 50), rng.choice(["a", "a", "a", "b", "c", None])) for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    one, two = by_id(mixing.mix(df)), by_id(mixing.mix(df))
    assert one == two and len(one) == 2000
    total = sum(r.size for r in one.values())
    size, target, taken = Counter(), {}, Counter()
    for r in one.values():
        size[r.source] += r.size
        target[r.source] = r.target
        taken[r.source] += r.taken
        assert r.taken <= 2 * r.size
    weight = dict(zip(["a", "b", "c", None], [3, 1, 2, 3]))
    want, open_ = {}, set(weight)
    while open_:
        level = (1.5 * total - sum(want.values())) / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 2 * size[s]}
        if not full:
            want |= {s: level * weight[s] for s in open_}
            break
        want |= {s: 2.0 * size[s] for s in full}
        open_ -= full
    for s in weight:
        assert target[s] == pytest.approx(want[s]) and taken[s] == pytest.approx(want[s], rel=0.05)


def test_chat(spark):
    hard = "</s>[INST] ok [/INST] \\ [\\INST]"
    rows = [(1, 0, "user", hard), (1, 1, "assistant", hard), (2, 0, None, None), (2, 0, "assistant", "é中😀"), (2, None, "system", ""), (None, 1, "assistant", "x"), (1, 1, "assistant", hard)]
    got = by_id(chat.formatted(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), ranks_path(), pattern()), "conv_id")
    assert got[1].loss_sha256 == sha(hard * 2) and got[1].n_turns == 3
    assert got[1].turns_sha256 == sha("".join(f"{r}\n{hard}\n" for r in ("user", "assistant", "assistant")))
    assert got[2].turns_sha256 == sha("system\n\n\n\nassistant\né中😀\n") and got[2].loss_chars == 3
    assert got[None].loss_chars == 1


def test_pages(spark):
    own = lambda i: " ".join(f"{w}{i}" for w in ("alpha", "beta", "gamma", "delta"))
    ads = "<div><p>buy now the very best things in town today</p></div>"
    rows = [(i, "http://h.org/x", f"<body>{ads}<div><p>{own(i)} &amp; more</p></div></body>") for i in range(3)]
    rows += [(9, "http://h.org/y", "<nav>a</nav><article><h1>T</h1><p>x <b>y<p>z</article><footer>f</footer>"), (10, None, None), (11, "::", ""), (9, "http://h.org/y", "<p>again")]
    out = [(r.page_id, r.text) for r in pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()]
    assert sorted(out, key=str) == sorted([*((i, f"{own(i)} & more") for i in range(3)), (9, "T\nx y\nz"), (10, ""), (11, ""), (9, "again")], key=str)


def test_personal_data(spark):
    rows = [(1, "mail a.b@c.org_d@e.com and +1 (504) 555-2652, 4242 4242 4242 4242; 1.2.3.4.5.6.7.8 999.1.1.1"), (2, None), (3, ""), (4, "9" * 5000 + " " + "a" * 20000)]
    rows += [(10 + i, f"some lead text then call me at +1 (504) 555-{2000 + i} now") for i in range(5)]
    rows += [(30, "other lead text then call me at 0044/777123456 now")]
    got = by_id(pii.find(spark.createDataFrame(rows, "doc_id long, text string")))
    assert (got[1].n_email, got[1].n_ip, got[1].n_card, got[1].n_phone) == (2, 2, 1, 1)
    assert got[1].spans.startswith("email:5:14,email:14:22,phone:27:44")
    assert got[2].spans == got[3].spans == "" and got[4].spans == ""
    assert got[30].n_phone == 0 and got[30].spans == "phone:32:46"


def test_personal_data_after_words_with_digits(spark):
    """Patterns hold the words of the text, also numbers, finds and long words, for seeds and for what they discover."""
    long = "w" * 300
    rows = [(i, f"order {i} call +1 (504) 555-{2000 + i} now") for i in range(5)]
    rows += [(10 + i, f"write first@x{i}.co or second@y{i}.co please") for i in range(5)]
    rows += [(20 + i, f"{long} dial +1 (504) 555-{3000 + i} now") for i in range(5)]
    rows += [(30, "order 77 call 0044/777123456 now"), (31, f"x {long} dial {'7' * 80}"), (32, "9 9 call 123456 8 call 234567")]
    got = by_id(pii.find(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got[30].spans == "phone:14:28"
    assert got[31].spans == "phone:308:388"
    assert got[32].spans == "phone:9:15,phone:23:29"
    words = re.compile(r"[^\x20\x09-\x0D]+")
    table = spark.createDataFrame(rows, "doc_id long, text string")
    found = table.select("text", pii.base(table.text).alias("b"), pii.candidates(table.text).alias("c")).collect()
    for r in found:
        for x in (*r.b, *r.c):
            i = max(j for j, w in enumerate(words.finditer(r.text)) if w.start() <= x.s)
            before = words.findall(r.text)[:i][-2:]
            assert x.pattern == (re.sub("[0-9]+", "0", " ".join(before).lower()) if len(before) == 2 else "")


OPERATORS = {
    "substrings": substrings.dedup,
    "runs": runs.dedup,
    "jaccard": jaccard.linked_documents,
    "exact": exact.dedup,
    "quality": quality.judge,
    "bpe": lambda d: bpe.encode(d, ranks_path(), pattern()),
    "mixing": mixing.mix,
    "pii": pii.find,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_and_repeated(name, docs, empty, spark):
    run = OPERATORS[name]
    assert run(empty).collect() == []
    rows = [(7, "same text " * 30, "en", "a", 1, "", "", ""), (7, "same text " * 30, "en", "a", 1, "", "", ""), (7, "other", None, None, 1, "", "", ""), (None, "no id", "en", "a", 1, "", "", "")]
    got = run(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 4 and sorted(str(r.doc_id) for r in got) == ["7", "7", "7", "None"]


def test_stages(spark, docs, empty):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, "").collect() == []
    kept = corpus_pipeline.exact_dedup(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({r.keep_id for r in exact.dedup(docs).collect()})
    near = corpus_pipeline.near_dedup(spark, docs, "").collect()
    assert sorted(r.doc_id for r in near) == sorted({r.component_id for r in jaccard.linked_documents(docs).collect()})
    mixed = Counter(r.doc_id for r in corpus_pipeline.mix_sources(spark, docs, "").collect())
    assert mixed == Counter({r.doc_id: r.copies for r in mixing.mix(docs).collect() if r.copies})
    good = {r.doc_id for r in corpus_pipeline.quality_rules(spark, docs, "").collect()}
    assert good == {r.doc_id for r in quality.judge(docs).collect() if r.kept}


CLASHES = ["_digest", "_length", "_key", "_doc", "_sub", "_unit", "_copies", "_copy", "_top", "_keep", "row", "unit", "copies", "digest", "length", "id", "key", "top", "copy"]


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES[:-1])
def test_stages_return_the_callers_columns(spark, docs, name, stage):
    """Extra columns keep name and value, whatever the stage calls its own."""
    wide = docs.drop("sub", "marks", "node")
    for i, c in enumerate(CLASHES):
        wide = wide.withColumn(c, F.concat(F.lit(f"{i}-"), F.col("doc_id").cast("string")))
    out = stage(spark, wide, "")
    assert out.columns == wide.columns
    rows = out.collect()
    assert rows and all(r[c] == f"{i}-{r.doc_id}" for r in rows for i, c in enumerate(CLASHES))
    plain = stage(spark, docs.drop("sub", "marks", "node"), "").collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in plain)


def test_long_texts_come_in_pieces(docs, texts, monkeypatch):
    """Windows, counts and shingles over the borders of pieces are those of whole texts."""
    monkeypatch.setattr(windows, "CHUNK", {"byte": 700, "word": 90})
    monkeypatch.setattr(quality, "PIECE", 40)
    test_substring_dedup(docs, texts)
    test_run_index(docs, texts, 20_000, monkeypatch)
    test_quality_counts(docs, texts)


def test_coder_memory_is_bounded():
    """Pieces a worker remembers, old ones included; all encode alike after they were forgotten."""
    from ledgerlens.llm import bpe

    coder = bpe.Prefixes({bytes([i]): i for i in range(256)} | {b"ab": 256, b"abc": 257})
    for i in range(300_000):
        coder.known[f"{i}"]
        coder.pairs.clear()
    assert len(coder.known) + len(coder.known.old) <= 150_000
    assert coder.known["1"] == (49,) and coder.known["abcab"] == (257, 256)


def test_coder_fills_tables_on_demand(monkeypatch):
    """Pieces that begin alike share what was found for the beginning; tokens on demand are those of the whole table, pairs those of plain merging."""
    monkeypatch.setattr(bpe, "BEGINNINGS", 500)
    coder = bpe.Prefixes(bpe.read_ranks(ranks_path()))
    first = b" erettingungkeitlich"
    coder.encode(first)
    n = len(coder.begun)
    assert 0 < n < len(first)
    coder.encode(first + b"zq")
    assert len(coder.begun) - n <= 3
    rng = random.Random(5)
    for _ in range(3000):
        piece = "".join(rng.choice("abcde the ing'sé1") for _ in range(rng.randint(1, 80))).encode()
        token = coder.ranks.get(piece)
        assert list(coder.encode(piece)) == ([token] if token is not None else coder.walk(coder.lasts(piece)))
        assert len(coder.begun) <= 500
    ids = list(coder.bytes_of)
    for _ in range(20_000):
        a, b = rng.choice(ids[: rng.choice((300, 5000, len(ids)))]), rng.choice(ids[: rng.choice((300, 5000, len(ids)))])
        assert coder.apart(a, b) == (coder.merged(coder.bytes_of[a] + coder.bytes_of[b]) == [a, b])
    # merging never gives abc here: its bytes hold no other token of two
    odd = bpe.Prefixes({bytes([i]): i for i in range(256)} | {b"abc": 256, b"xy": 257})
    assert odd.halves[256] is None and not odd.apart(256, 97) and odd.apart(257, 97)
