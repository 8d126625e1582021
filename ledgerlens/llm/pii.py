"""Personal data by bootstrapped contextual extraction (native).

Seeds are the base finds: addresses, numbers and telephone numbers that match fixed expressions and their checks. Words
that look like identifiers are *instances*, and the two words of the text before the word they begin in are their lexical *pattern*, whatever
those words are (earlier finds and numbers too). Spark scores the
graph of patterns and instances iteratively: a pattern is as sure of a kind as the instances it introduces are, on
average, and an instance that is no seed is as sure as its best pattern. Patterns that end up sure of one
kind, and have introduced enough different seeds of it, discover unseen identifiers: instances behind them that no
expression knows. Base finds always stay; discovered spans do not overlap them.

Positions are code points, taken from the lengths of matches and of the pieces between them. Expressions are written
so that a search never starts twice in one run of characters (possessive repeats, look-behind), so whole long texts
cost linear time.

Defined cases: NULL and empty texts have no finds; a pattern is empty at a text's start and then discovers nothing;
rows that repeat id and text get the same spans; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, whole

KINDS = ("email", "ip", "card", "phone")
#: A match may begin where the one before ended, or where its first run of characters begins.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])[0-9](?:[\x20-]?[0-9]){11,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
OCTET = r"0*(?:[0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])"
#: A word with a digit or an at sign; what looks like an identifier is decided on the word.
CANDIDATE = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D]*[0-9@][^\x20\x09-\x0D]*+"
#: The end of a text from the second last complete word on, with what stands behind it of the next word.
TAIL = r"(?<![^\x20\x09-\x0D])(?:[^\x20\x09-\x0D]++[\x20\x09-\x0D]++){0,2}[^\x20\x09-\x0D]*+\z"
#: Rounds of scoring, sureness of a pattern, and different seeds it must have introduced.
ROUNDS, SURE, SUPPORT = 3, 0.8, 3


#: Matches handled by one inner fold, and code points of a place by which spans are compared.
CHUNK, PLACE = 256, 64

_EMPTY = "cast(array() as array<struct<s:bigint,e:bigint,hit:string,before:string>>)"


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def places(text: Column, expression: str) -> Column:
    """Array of (s, e, hit, before) of the leftmost matches that do not overlap; before: the two words in front of the word a match begins in, and that word's beginning.

    Matches are folded in chunks and chunks are put together at the end: a fold copies the list it adds to, so one
    over all matches would take the square of their number.
    """
    gaps = F.split(text, expression, -1)
    hits = F.regexp_extract_all(text, F.lit(expression), F.lit(0))
    pairs = F.zip_with(gaps, hits, lambda g, h: F.struct(g.alias("g"), h.alias("h")))
    nothing = F.lit("")

    def step(acc: Column, x: Column) -> Column:
        s = acc["at"] + F.char_length(x["g"])
        e = s + F.char_length(x["h"])
        # words before the match may stand before earlier matches or be such
        before = F.regexp_extract(F.concat(acc["tail"], x["g"]), TAIL, 0)
        one = F.struct(s.alias("s"), e.alias("e"), x["h"].alias("hit"), before.alias("before"))
        return F.struct(
            F.coalesce(e, acc["at"]).alias("at"), F.concat(before, F.coalesce(x["h"], nothing)).alias("tail"), F.when(x["h"].isNull(), acc["out"]).otherwise(F.concat(acc["out"], F.array(one))).alias("out")
        )

    def chunk(acc: Column, part: Column) -> Column:
        start = F.struct(acc["at"].alias("at"), acc["tail"].alias("tail"), F.expr(_EMPTY).alias("out"))
        done = F.aggregate(part, start, step)
        return _bound(done, lambda d: F.struct(d["at"].alias("at"), d["tail"].alias("tail"), F.concat(acc["outs"], F.array(d["out"])).alias("outs")))

    def all_of(listed: Column) -> Column:
        parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(listed) - 1) / CHUNK).cast("int")), lambda i: F.slice(listed, i * CHUNK + 1, CHUNK))
        start = F.struct(F.lit(0).cast("long").alias("at"), nothing.alias("tail"), F.expr(f"cast(array() as array<{_EMPTY[16:-1]}>)").alias("outs"))
        return F.aggregate(parts, start, chunk, lambda a: F.flatten(a["outs"]))

    return _bound(pairs, all_of)


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits has a right check digit."""
    back = F.reverse(digits)
    worth = F.transform(F.sequence(F.lit(0), F.char_length(digits) - 1), lambda i: _worth(F.substring(back, i + 1, F.lit(1)).cast("int"), i))
    return F.aggregate(worth, F.lit(0), lambda a, x: a + x) % 10 == 0


def _worth(d: Column, i: Column) -> Column:
    twice = d * 2
    return F.when(i % 2 == 0, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))


def _checks() -> tuple[tuple[str, Callable[[Column], Column]], ...]:
    return (
        (EMAIL, lambda h: F.lit(True)),
        (IP, lambda h: h.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")),
        (CARD, lambda h: F.char_length(_digits(h)).between(12, 19) & luhn(_digits(h))),
        (PHONE, lambda h: F.char_length(_digits(h)).between(9, 15)),
    )


_NONE = "cast(array() as array<struct<s:bigint,k:int,e:bigint>>)"
_FOUND = "cast(array() as array<struct<s:bigint,k:int,e:bigint,value:string,pattern:string>>)"


def _pattern(before: Column) -> Column:
    """The two words before a place, lower case, numbers as 0."""
    words = F.lower(F.regexp_extract(before, r"^([^\x20\x09-\x0D]++[\x20\x09-\x0D]++[^\x20\x09-\x0D]++)[\x20\x09-\x0D]++[^\x20\x09-\x0D]*+\z", 1))
    return F.regexp_replace(F.regexp_replace(words, "[0-9]+", "0"), r"[\x20\x09-\x0D]+", " ")


def base(text: Column) -> Column:
    """Sorted array of (s, k, e, value, pattern) of all base finds."""
    found = []
    for k, (expression, check) in enumerate(_checks()):
        good = F.filter(places(text, expression), lambda x: check(x["hit"]))
        spans = F.transform(good, lambda x: F.struct(x["s"].alias("s"), F.lit(k).alias("k"), x["e"].alias("e"), F.lower(x["hit"]).alias("value"), _pattern(x["before"]).alias("pattern")))
        mark = ("@", ".", None, "+")[k]
        found.append(F.when(F.contains(text, F.lit(mark)), spans).otherwise(F.expr(_FOUND)) if mark else spans)
    return F.array_sort(F.concat(*found))


def candidates(text: Column) -> Column:
    """Array of (s, e, value, pattern) of the words that look like identifiers, without marks around them."""
    near = F.filter(
        places(text, CANDIDATE), lambda x: (F.char_length(_digits(x["hit"])) >= 5) | F.contains(x["hit"], F.lit("@"))
    )

    def one(x: Column) -> Column:
        lead = F.char_length(F.regexp_extract(x["hit"], r"^[^A-Za-z0-9+]*+", 0))
        tail = F.char_length(F.regexp_extract(x["hit"], r"(?<![^A-Za-z0-9])[^A-Za-z0-9]++$|(?<=[A-Za-z0-9])[^A-Za-z0-9]++$", 0))
        value = F.lower(F.substring(x["hit"], lead + 1, F.char_length(x["hit"]) - lead - tail))
        return F.struct((x["s"] + lead).alias("s"), (x["e"] - tail).alias("e"), value.alias("value"), _pattern(x["before"]).alias("pattern"))

    return F.filter(F.transform(near, one), lambda c: (c["value"] != "") & (c["pattern"] != ""))


def _score(k: int) -> str:
    return f"p{k}"


SCORES = [_score(k) for k in range(len(KINDS))]


def patterns(edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Patterns with their sureness of every kind, from edges (pattern, value, k); k is the seed's kind or NULL."""
    graph = stored(edges.groupBy("pattern", "value").agg(F.max("k").alias("k")), "pii-graph")
    seeds = stored(graph.groupBy("value").agg(F.max("k").alias("k")), "pii-values")
    instance = seeds.select("value", *(F.when(F.col("k") == i, 1.0).otherwise(0.0).alias(p) for i, p in enumerate(SCORES)))
    scored = None
    for step in range(rounds):
        # an instance of a kind adds its sureness, one more unknown instance is counted so that few finds prove little
        per = graph.join(instance, "value").groupBy("pattern").agg(
            *((F.sum(p) / (F.count(F.lit(1)) + 0.5)).alias(p) for p in SCORES),
            *(F.sum(F.when(F.col("k") == i, 1).otherwise(0)).alias(f"n{i}") for i in range(len(KINDS))),
        )
        scored = stored(per, f"pii-patterns-{step}")
        if step + 1 < rounds:
            best = graph.select("pattern", "value").join(scored.select("pattern", *SCORES), "pattern").groupBy("value").agg(*(F.max(p).alias(p) for p in SCORES))
            mixed = best.join(seeds, "value").select(
                "value", *(F.when(F.col("k") == i, 1.0).when(F.col("k").isNotNull(), 0.0).otherwise(F.col(p)).alias(p) for i, p in enumerate(SCORES))
            )
            instance = stored(mixed, f"pii-instances-{step}")
    return scored


def _unseen(rows: DataFrame) -> DataFrame:
    """(key, s, e, value, pattern) of the candidates that overlap no base find.

    Spans meet by the places of ``PLACE`` code points they stand in, so that a text's finds are not all compared with all its candidates.
    """
    at = lambda s, e: F.explode(F.sequence(F.floor(s / F.lit(PLACE)), F.floor((e - 1) / F.lit(PLACE)))).alias("place")
    listed = rows.select("key", F.explode("cands").alias("c")).select("key", "c.*").distinct()
    known = rows.select("key", F.explode("base").alias("b")).select("key", F.col("b.s").alias("bs"), F.col("b.e").alias("be")).distinct()
    met = listed.select("key", "s", "e", at(F.col("s"), F.col("e"))).join(known.select("key", "bs", "be", at(F.col("bs"), F.col("be"))), ["key", "place"])
    over = met.where((F.col("bs") < F.col("e")) & (F.col("be") > F.col("s"))).select("key", "s", "e").distinct()
    return listed.join(over, ["key", "s", "e"], "left_anti")


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["k"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")


def find(docs: DataFrame, rounds: int = ROUNDS, sure: float = SURE, support: int = SUPPORT) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_discovered: one row per row of ``docs``; counts are of base finds."""
    text = whole()
    rows = docs.select(F.xxhash64("doc_id", text).alias("key"), F.col("doc_id").cast("long").alias("doc_id"), base(text).alias("base"), candidates(text).alias("cands"))
    rows = stored(rows, "pii-rows")
    seeds = rows.select(F.explode("base").alias("b")).select("b.pattern", "b.value", "b.k").where("pattern <> ''")
    unseen = stored(_unseen(rows), "pii-unseen")
    scored = patterns(seeds.unionByName(unseen.select("pattern", "value", F.lit(None).cast("int").alias("k"))), rounds)
    kind = F.lit(None).cast("int")
    for i, p in enumerate(SCORES):
        kind = F.when((F.col(p) >= sure) & (F.col(f"n{i}") >= support), F.lit(i)).otherwise(kind)
    good = scored.select("pattern", kind.alias("found")).where("found IS NOT NULL")
    new = unseen.join(good, "pattern").select("key", F.col("s"), F.col("found").alias("k"), F.col("e")).distinct()
    added = new.groupBy("key").agg(F.collect_list(F.struct("s", "k", "e")).alias("added"))
    out = rows.select("key", "doc_id", "base").join(added, "key", "left")
    plain = F.transform("base", lambda b: F.struct(b["s"].alias("s"), b["k"].alias("k"), b["e"].alias("e")))
    every = F.array_sort(F.concat(plain, F.coalesce("added", F.expr(_NONE))))
    count = lambda i: F.size(F.filter("base", lambda b: b["k"] == i)).cast("long")
    return out.select(
        "doc_id",
        *(count(i).alias(f"n_{name}") for i, name in enumerate(KINDS)),
        F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _joined(every).alias("spans"),
        F.coalesce(F.size("added"), F.lit(0)).cast("long").alias("n_discovered"),
    )
