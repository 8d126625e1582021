"""HTML extraction with a host suffix array.

A page is read once into blocks of text in page order, each with the part of the page it stands in: *main* (inside
``article`` or ``main``), *chrome* (navigation, page header and footer, sidebars, notices, adverts, forms, comments, told by element, role or
class) or *open* (neither). Chrome goes. The main and open blocks of a host's distinct pages are its token streams; a substring is
``LENGTH`` tokens of a block, or a whole shorter block. A suffix array over streams that share an anchor counts on how many distinct
pages each substring stands. Substrings on at least ``PAGES`` of them and on a large share of the host's (``SHARE``) are boilerplate. A block that
they cover as a whole goes, all others stay as they are: ordinary phrases, passages that some pages share and copies of an article are no
boilerplate, and a page of which nothing would be left keeps everything.

The text of a page with a main part is what stays of that part, on other pages what stays of the open blocks.

What travels is kept small: first only half an anchor hash for every stretch of tokens, packed by host and part, counted per host; then the token hashes of stretches whose anchor
stands on enough pages, summed up where they are equal. Anchors with very many different stretches (``CROWD``) are counted
by single substrings instead. A host's list of substrings is bounded by the length of its pages: each counts on a share of all pages.

Character references are decoded, white space inside a block becomes one space, blocks are trimmed and joined in page
order by a line feed. Defined cases: NULL and empty pages, and pages without text, have empty text; pages with NULL or odd
addresses have no host and nothing of them is boilerplate by repeats; repeated rows, and pages of a host with the same blocks, are one
distinct page; broken and unclosed markup is read as far as it goes; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections.abc import Iterator
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import MIX, gram_hashes, mix64, stored, word_hashes, words_of
from .windows import Spec, stretches

#: Tokens of a repeated substring, and of its anchor.
LENGTH, GRAM = 8, 3
SPEC = Spec("word", LENGTH, GRAM, False)
#: Distinct pages of a host that boilerplate stands on at least, and the share of them by the part of the page.
PAGES, SHARE = 3, {"open": 0.5, "main": 0.8}
#: Different stretches of one anchor beyond which its substrings are counted one by one.
CROWD = 20_000
#: Bytes of stretches a suffix array is built over at once, as far as whole groups allow.
GROUP = 1 << 20

#: Element names of the markup language and words of class names that tell the part of a page.
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript", "template"}
GONE = RAW | {"head", "svg", "math", "object", "select", "button", "canvas", "audio", "video", "map", "datalist", "label", "input"}
CHROME = {"nav", "footer", "aside", "form", "menu", "dialog", "fieldset"}
MAIN = {"article", "main"}
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Elements that an opening tag of the same kind closes.
ALONE = {"p", "li", "dt", "dd", "tr", "td", "th", "option"}
HINTS = set(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer "
    "gdpr login masthead menu modal nav navbar navigation newsletter notice notices popup promo promoted promotion related reply replies respond "
    "share sharing sidebar signup social sponsor sponsored subscribe toolbar topbar widget".split()
)
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu", "menubar", "toolbar"}

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^\"'>]|\"[^\"]*\"|'[^']*')*+)>|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^<>]*>|<[a-zA-Z][^<>]*\Z", re.S)
_ATTR = re.compile(r"""(?<![\w-])(class|id|role|hidden|itemprop)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)
_PART = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[A-Z])")
_ROOM = re.compile(r"[\x20\x09-\x0D\xa0]+")


def _kind(tag: str, attrs: str, inside_main: bool) -> str | None:
    """What an element makes of its content: gone, chrome, main or nothing new."""
    if tag in GONE:
        return "gone"
    if tag in CHROME:
        return "chrome"
    if tag == "header":
        return None if inside_main else "chrome"
    found = {}
    if attrs and not attrs.isspace():
        found = {m[1].lower(): (m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(attrs)}
        if "hidden" in found and not re.search(r"hidden\s*=\s*[\"']?until", attrs, re.I):
            return "gone"
        role = found.get("role", "").strip().lower()
        if role in ROLES:
            return "chrome"
        if tag not in ("html", "body") and any(p.lower() in HINTS for n in ("class", "id") for p in _PART.split(found.get(n, ""))):
            return "chrome"
        if role in ("main", "article") or found.get("itemprop", "").lower() == "articlebody":
            return "main"
    return "main" if tag in MAIN else None


def blocks(page: str) -> list[tuple[str, str]]:
    """(part, text) of every block with text, in page order. One pass; the stack holds open elements only."""
    out: list[tuple[str, str]] = []
    text: list[str] = []
    stack: list[tuple[str, str]] = [("", "open")]

    def flush() -> None:
        if text:
            line = _ROOM.sub(" ", entities.unescape("".join(text))).strip(" ")
            text.clear()
            if line and stack[-1][1] != "gone":
                out.append((stack[-1][1], line))

    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        if m is None:
            text.append(page[at:])
            break
        if m.start() > at and stack[-1][1] != "gone":
            text.append(page[at : m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if tag == "br":
            text.append("\n")
            continue
        if m[1]:
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag), 0)
            if tag in BLOCK or (depth and stack[depth][1] != stack[depth - 1][1]):
                flush()
            if depth:
                # an unclosed inline element ends with the block around it; blocks are not closed by inline ends
                if tag in BLOCK or not any(t in BLOCK for t, _ in stack[depth + 1 :]):
                    del stack[depth:]
            continue
        inside = stack[-1][1]
        if tag in RAW and not m[3].endswith("/"):
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(page, at)
            at = close.end() if close else n
            continue
        if tag in BLOCK:
            flush()
            if tag in ALONE:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == tag:
                        del stack[i:]
                        break
                    if stack[i][0] in ("ul", "ol", "dl", "table", "div", "section", "article", "main", "body", "nav", "aside", "footer", "header", "form", "blockquote"):
                        break
        if tag in VOID or m[3].endswith("/"):
            continue
        kind = _kind(tag, m[3], any(k == "main" for _, k in stack))
        # a part inside a chrome or removed part stays what that is
        kind = inside if kind is None or inside in ("gone", "chrome") else kind
        if kind != inside:
            flush()
        stack.append((tag, kind))
    flush()
    return out


def host(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


#: Stands behind the tokens of a block shorter than a substring.
_END = np.uint64(0x2545F4914F6CDD1D)


def _salt(name: str) -> np.uint64:
    raw = name.encode()
    return word_hashes(raw, np.array([0]), np.array([len(raw)]))[0] * MIX


def streams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of blocks that follow each other, filled up to a substring's length, and where each block ends."""
    if not texts:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    raws = [t.encode() for t in texts]
    # all blocks at once: the line feed between them is no part of a word
    raw = b"\n".join(raws)
    start, end = words_of(raw)
    own = np.diff(np.searchsorted(start, np.cumsum([len(r) + 1 for r in raws])), prepend=0)
    n = np.maximum(own, LENGTH)
    ends = np.cumsum(n)
    values = np.full(ends[-1], _END)
    values[np.arange(len(start)) + np.repeat(ends - n - (np.cumsum(own) - own), own)] = word_hashes(raw, start, end)
    return values, ends


def _inner(n: int, ends: np.ndarray) -> np.ndarray:
    """Which of the substrings lie inside one block."""
    ok = np.ones(max(0, n - LENGTH + 1), bool)
    for e in ends[:-1]:
        ok[max(0, e - LENGTH + 1) : e] = False
    return ok


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Host, digest and blocks (parts as letters) of every page; chrome is left out."""
    for batch in batches:
        cols: list[list] = [[], [], [], []]
        for url, markup in zip(batch.column(1).to_pylist(), batch.column(2)):
            found = [(p, t) for p, t in blocks(markup.as_py()) if p != "chrome"]
            name, texts, parts = host(url), [t for _, t in found], "".join(p[0] for p, _ in found)
            digest = hashlib.blake2b("\n".join([parts, *texts]).encode(), digest_size=16).digest()
            for c, v in zip(cols, (name, digest, parts, texts)):
                c.append(v)
        made = [pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.binary(), pa.string(), pa.list_(pa.string())))]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *made], names=["page_id", "url", "host", "digest", "parts", "texts"])


#: Anchors of a host are dealt out by their hash to one part for so many pages, as far as the most parts allow.
PART_PAGES, MOST_PARTS = 64, 256
#: Anchors that are packed at once.
PACK = 1 << 19
KEYS = pa.schema([("host", pa.string()), ("part", pa.int32()), ("c", pa.int64()), ("keys", pa.list_(pa.int32()))])
KEYS_DDL = "host string, part int, c long, keys array<int>"


def _placed(key: np.ndarray, cuts: int) -> tuple[np.ndarray, np.ndarray]:
    """Part and upper half of the hashes of anchors, by which they are counted: two that share both are looked at if they stand on enough pages together."""
    key = key.view(np.uint64)
    return (key % np.uint64(cuts)).astype(np.int64), (key >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _packed(held: dict[str, tuple[int, list[np.ndarray]]]) -> pa.RecordBatch:
    """One row for the anchors of a host and part that stand on equally many of the pages."""
    columns: list[list[np.ndarray]] = [[], [], [], []]
    for i, (cuts, own) in enumerate(held.values()):
        keys, n = np.unique(np.concatenate(own), return_counts=True)
        for c, v in zip(columns, (np.full(len(keys), i), *_placed(keys, cuts), n)):
            c.append(v)
    name, part, upper, n = map(np.concatenate, columns)
    order = np.lexsort((n, part, name))
    name, part, upper, n = name[order], part[order], upper[order], n[order]
    head = np.ones(len(order), bool)
    head[1:] = (name[1:] != name[:-1]) | (part[1:] != part[:-1]) | (n[1:] != n[:-1])
    first = np.flatnonzero(head)
    keys = pa.ListArray.from_arrays(pa.array(np.append(first, len(order)), pa.int32()), pa.array(upper))
    hosts = pa.array(list(held), pa.string()).take(pa.array(name[first]))
    return pa.RecordBatch.from_arrays([hosts, pa.array(part[first], pa.int32()), pa.array(n[first], pa.int64()), keys], schema=KEYS)


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The different anchors of every page, packed by host and part."""
    held: dict[str, tuple[int, list[np.ndarray]]] = {}
    size = 0
    for batch in batches:
        for name, texts, cuts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            values, ends = streams(texts)
            if not len(values):
                continue
            own = np.unique(mix64(stretches(values, ends, SPEC)[0] ^ _salt(name)))
            if not len(own):
                continue
            held.setdefault(name, (cuts, []))[1].append(own)
            size += len(own)
            if size >= PACK:
                yield _packed(held)
                held, size = {}, 0
    if size:
        yield _packed(held)


STRETCH = pa.schema([("host", pa.string()), ("key", pa.int64()), ("body", pa.binary()), ("first", pa.binary())])
STRETCH_DDL = "host string, key long, body binary, first binary"


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Token hashes of the stretches whose anchor is in the host's list, with a mask of substrings that the page has not had before."""
    for batch in batches:
        rows: list[tuple] = []
        size = 0
        for name, texts, cuts, keys in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3)):
            values, ends = streams(texts)
            if not len(values):
                continue
            key, _, first, n = stretches(values, ends, SPEC)
            key = mix64(key ^ _salt(name)).view(np.int64)
            part, upper = _placed(key, cuts)
            wanted = np.sort(keys.values.to_numpy(zero_copy_only=False))
            grams = gram_hashes(values, LENGTH)
            new = np.zeros(len(grams), bool)
            inside = np.flatnonzero(_inner(len(values), ends))
            new[inside[np.unique(grams[inside], return_index=True)[1]]] = True
            for i in np.flatnonzero(np.isin(upper.astype(np.int64) * MOST_PARTS + part, wanted)).tolist():
                a, m = int(first[i]), int(n[i])
                rows.append((name, int(key[i]), values[a : a + m - 1 + LENGTH].tobytes(), np.packbits(new[a : a + m]).tobytes()))
                size += 8 * (m + LENGTH)
            if size >= 4 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), STRETCH)], schema=STRETCH)
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), STRETCH)], schema=STRETCH)


def _single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches of crowded anchors as single substrings, keyed by their whole content."""
    for batch in batches:
        rows: list[tuple] = []
        for name, body, first, pages in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            values = np.frombuffer(body, np.uint64)
            m = len(values) - LENGTH + 1
            key = mix64(gram_hashes(values, LENGTH) ^ _salt(name)).view(np.int64)
            for i in np.flatnonzero(np.unpackbits(np.frombuffer(first, np.uint8))[:m]).tolist():
                rows.append((name, int(key[i]), values[i : i + LENGTH].tobytes(), b"\x80", pages))
            if len(rows) > 1 << 16:
                yield _rows(rows)
                rows = []
        if rows:
            yield _rows(rows)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    schema = pa.schema([*STRETCH, ("pages", pa.int64())])
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def suffix_array(ids: np.ndarray, starts: np.ndarray, group: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes (by start) in the order of their group and first ``depth`` tokens, and whether each agrees with the one before over all of them."""
    columns = [ids[starts + i] for i in range(depth)]
    order = np.lexsort((*columns[::-1], group))
    agrees = np.ones(len(order), bool)
    agrees[:1] = False
    for c in (group, *columns):
        c = c[order]
        agrees[1:] &= c[1:] == c[:-1]
    return order, agrees


def _counted(rows: list[tuple]) -> pa.RecordBatch:
    """(host, substring, pages) of the substrings of whole groups that stand on enough pages."""
    values = [np.frombuffer(r[2], np.uint64) for r in rows]
    lens = np.array([len(v) for v in values])
    begin = np.cumsum(lens) - lens
    flat = np.concatenate(values)
    _, ids = np.unique(flat, return_inverse=True)
    n = lens - LENGTH + 1
    owner = np.repeat(np.arange(len(rows)), n)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    new = np.concatenate([np.unpackbits(np.frombuffer(r[3], np.uint8))[:m] for r, m in zip(rows, n)]).astype(np.int64)
    _, group = np.unique(np.array([r[1] for r in rows]), return_inverse=True)
    starts = begin[owner] + at
    order, agrees = suffix_array(ids, starts, group[owner], LENGTH)
    head = np.flatnonzero(~agrees)
    weight = (new * np.array([r[4] for r in rows])[owner])[order]
    pages = np.add.reduceat(weight, head)
    often = np.flatnonzero(pages >= PAGES)
    place = starts[order[head[often]]]
    content = gram_hashes(flat, LENGTH)[place].view(np.int64)
    hosts = [rows[i][0] for i in owner[order[head[often]]]]
    return pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(content), pa.array(pages[often], pa.int64())], names=["host", "content", "pages"])


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Suffix arrays over whole groups of stretches with one anchor, several small groups at once."""
    rows: list[tuple] = []
    size = 0
    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(5))):
            if rows and row[1] != rows[-1][1] and size >= GROUP:
                yield _counted(rows)
                rows, size = [], 0
            rows.append(row)
            size += len(row[2]) + 60
    if rows:
        yield _counted(rows)


OUT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64()), ("n_boilerplate_tokens", pa.int64())])


def covered_blocks(texts: list[str], parts: str, often: dict[str, np.ndarray]) -> np.ndarray:
    """Which blocks the host's frequent substrings (by part of the page) cover as a whole."""
    values, ends = streams(texts)
    out = np.zeros(len(texts), bool)
    if not len(values) or not any(len(v) for v in often.values()):
        return out
    grams = gram_hashes(values, LENGTH)
    n = np.diff(ends, prepend=0)
    block = np.repeat(np.arange(len(ends)), n)[: len(grams)]
    inside = np.arange(len(grams)) + LENGTH <= ends[block]
    letters = np.array(list(parts))[block]
    hit = np.zeros(len(grams), bool)
    for p, v in often.items():
        mine = np.flatnonzero(inside & (letters == p))
        hit[mine] = np.isin(grams[mine], v)
    at = np.flatnonzero(hit)
    step = np.zeros(len(values) + 1, np.int64)
    step[at] += 1
    step[at + LENGTH] -= 1
    return np.logical_and.reduceat(np.cumsum(step[:-1]) > 0, ends - n)


def main_text(texts: list[str], parts: str, often: dict[str, np.ndarray]) -> tuple[str, int]:
    """Main text of a page and how many tokens of it went as boilerplate."""
    part = "m" if "m" in parts else "o"
    gone = covered_blocks(texts, parts, often)
    own = [i for i, p in enumerate(parts) if p == part]
    if all(gone[i] for i in own):
        gone[:] = False
    lost = sum(len(words_of(texts[i].encode())[0]) for i in own if gone[i])
    return "\n".join(texts[i] for i in own if not gone[i]), lost


def _list(hashes: pa.ListScalar) -> np.ndarray:
    """Hashes of a list, none where there is no list."""
    return hashes.values.to_numpy(zero_copy_only=False).view(np.uint64) if hashes.is_valid else np.empty(0, np.uint64)


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        done: list[tuple[str, int]] = []
        for texts, parts, some, most in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4), batch.column(5)):
            done.append(main_text(texts, parts, {"o": _list(some), "m": _list(most)}))
        texts, lost = [t for t, _ in done], [n for _, n in done]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), pa.array(lost, pa.int64())], schema=OUT)


def boilerplate(read: DataFrame) -> DataFrame:
    """(host, some, most): the substrings of each host that stand on enough of its pages for an open and for a main block.

    ``read`` has host, digest and texts of its pages.
    """
    known = read.where("host <> ''")
    # one row of each distinct page; the others are listed, since they are few or cheap to leave out
    numbered = known.select("row", "host", "digest")
    firsts = numbered.groupBy("host", "digest").agg(F.min("row").alias("row"), F.count(F.lit(1)).alias("n"))
    copies = numbered.join(firsts.where("n > 1").select("host", "digest", F.col("row").alias("first")), ["host", "digest"]).where("row <> first").select("row")
    # written first: a short list is known to be short before the pages move, which then stay where they are
    copies = stored(copies, "pages-copies")
    pages = known.join(copies, "row", "left_anti").select("host", "texts")
    sizes = stored(firsts.groupBy("host").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= PAGES), "pages-hosts")
    enough = lambda part: F.greatest(F.lit(PAGES), F.ceil(F.col("n") * F.lit(SHARE[part])))
    least = F.least(*[enough(p) for p in SHARE])
    # hosts too small for any boilerplate need not be looked at
    cuts = F.least(F.lit(MOST_PARTS), F.ceil(F.col("n") / PART_PAGES).cast("int"))
    pages = pages.join(sizes.select("host", cuts.alias("cuts")), "host").select("host", "texts", "cuts")
    # packed rows travel; they are unpacked where they are counted
    packed = pages.mapInArrow(_anchors, KEYS_DDL).repartition("host", "part").select("host", "part", "c", F.explode("keys").alias("key"))
    anchors = packed.groupBy("host", "part", "key").agg(F.sum("c").alias("c"))
    often = anchors.join(sizes, "host").where(F.col("c") >= least)
    lists = stored(often.groupBy("host").agg(F.collect_list(F.col("key").cast("long") * MOST_PARTS + F.col("part")).alias("keys")), "pages-anchors")
    rows = pages.join(lists, "host").select("host", "texts", "cuts", "keys").mapInArrow(_stretches, STRETCH_DDL)
    rows = stored(rows.groupBy("host", "key", "body", "first").agg(F.count(F.lit(1)).alias("pages")), "pages-stretches")
    crowds = stored(rows.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > CROWD).select("key"), "pages-crowds")
    if not crowds.isEmpty():
        ones = rows.join(crowds, "key", "left_semi").select("host", "body", "first", "pages").mapInArrow(_single, STRETCH_DDL + ", pages long")
        ones = ones.groupBy("host", "key", "body", "first").agg(F.sum("pages").alias("pages"))
        rows = rows.join(crowds, "key", "left_anti").select(*ones.columns).unionByName(ones)
    grouped = rows.select("host", "key", "body", "first", "pages").repartition("key").sortWithinPartitions("key", "body", "first")
    # a substring is in one group only, as its anchor names the group
    counted = grouped.mapInArrow(_grouped, "host string, content long, pages long").join(sizes, "host")
    some = counted.where(F.col("pages") >= enough("open")).groupBy("host").agg(
        F.collect_list("content").alias("some"), F.collect_list(F.when(F.col("pages") >= enough("main"), F.col("content"))).alias("most")
    )
    return stored(some, "pages-often")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars, n_boilerplate_tokens: one row per row of ``pages``."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    read = rows.mapInArrow(_read, "page_id long, url string, host string, digest binary, parts string, texts array<string>")
    read = stored(read.withColumn("row", F.monotonically_increasing_id()), "pages-read")
    joined = read.join(boilerplate(read), "host", "left").select("page_id", "url", "texts", "parts", "some", "most")
    return joined.mapInArrow(_finish, "page_id long, url string, text string, n_chars long, n_boilerplate_tokens long")
