"""Byte-level BPE by prefix dynamic programming.

For every byte prefix of a piece there is exactly one last token with which a valid encoding of that prefix
ends: the token t, ending at the prefix's end, such that the last token u of the shorter prefix and t may stand
next to each other (encoding the bytes of u and t gives u, t again). The table of last tokens is the encoding
of all prefixes at once: appending bytes continues it without touching what is there, and after an edit only the
prefixes behind it are computed anew, until the table runs in step with the old one.

Texts are split by a pattern first; every match is a piece of its own. A piece that is itself a token is
that token. Defined cases: NULL and empty texts have no tokens; texts of any length are read whole, one piece at
a time; repeated rows are encoded alike; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import sys
import types
import unicodedata
from array import array
from bisect import bisect_right
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import whole

#: Pieces (twice as many with the old ones), pairs, and beginnings of pieces that a worker remembers.
REMEMBERED, PAIRS, BEGINNINGS = 75_000, 150_000, 600_000
#: Bytes of a piece beyond which its table is filled as a whole, and characters beyond which it is not remembered.
LONG = 64
#: Lengths of tokens that may end at a place whose last four bytes end no longer one.
SHORT = (3, 2, 1)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def splitter(pattern: str) -> tuple[regex.Pattern, regex.Pattern]:
    """The splitting pattern, as it is and with letters and digits as the tokenizer's library knows them.

    Libraries follow different versions of Unicode. Code points that Python does not know, or knows as unassigned,
    but the expression library takes for letters or digits, are asked of the tokenizer's library where it is installed.
    """
    try:
        import tiktoken
    except ImportError:
        return (regex.compile(pattern),) * 2
    plain = regex.compile(pattern)
    byte = {bytes([i]): i for i in range(256)}
    for name in ("L", "N"):
        ours = regex.compile(rf"\p{{{name}}}")
        theirs = tiktoken.Encoding(f"probe-{name}", pat_str=rf"\p{{{name}}}", mergeable_ranks=byte, special_tokens={})
        odd = [c for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c)) == "Cn" and ours.match(chr(c)) and not theirs.encode_ordinary(chr(c))]
        ranges: list[list[int]] = []
        for c in odd:
            if ranges and ranges[-1][1] == c - 1:
                ranges[-1][1] = c
            else:
                ranges.append([c, c])
        unknown = "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges)
        if unknown:
            # a nested set reads alike outside and inside another set
            pattern = pattern.replace(rf"\p{{{name}}}", rf"[\p{{{name}}}--[{unknown}]]")
    return plain, regex.compile(pattern, regex.V1)


class Prefixes:
    """Encoder of pieces; ``lasts`` gives the table of last tokens of a piece."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {i: t for t, i in ranks.items()}
        self.longest = max(map(len, ranks))
        # lengths of tokens by their last bytes (as many as four), longest first: only these can end at a place
        ends: dict[bytes, set[int]] = {}
        for t in ranks:
            ends.setdefault(t[-4:], set()).add(len(t))
        for k in [k for k in ends if len(k) == 4]:
            ends[k] |= {n for n in (1, 2, 3) if k[-n:] in ranks}
        self.lengths = {k: tuple(sorted(v, reverse=True)) for k, v in ends.items() if len(k) == 4}
        self.pairs: dict[int, bool] = {}
        self.halves = _Halves(self)
        # last tokens of beginnings met before: pieces that begin alike share them
        self.begun: dict[bytes, int] = {}
        self.known = _Known(self)
        self.sizes = array("H", (len(self.bytes_of.get(i, b"")) for i in range(max(self.bytes_of) + 1)))
        self.table = [self.bytes_of.get(i, b"") for i in range(max(self.bytes_of) + 1)]

    def merged(self, piece: bytes, least: int = 1) -> list[int]:
        """Plain merging, lowest rank first, down to ``least`` parts; used on one or two tokens' bytes only."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > least:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = self.ranks.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def fits(self, left: int, right: int) -> bool:
        """Whether two tokens may stand next to each other."""
        key = left << 32 | right
        got = self.pairs.get(key)
        if got is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            got = self.pairs[key] = self.apart(left, right)
        return got

    def apart(self, left: int, right: int) -> bool:
        """Whether merging the bytes of two tokens gives the two again: their merges are undone, the latest first, and none over the border may come before.

        Of merges of equal rank the leftmost comes first, so that one of the right token is undone first.
        """
        get, bytes_of, halves = self.ranks.get, self.bytes_of, self.halves
        if halves[left] is None or halves[right] is None:
            return self.merged(bytes_of[left] + bytes_of[right]) == [left, right]
        limit = len(self.table)
        while True:
            over = get(bytes_of[left] + bytes_of[right])
            if over is not None and over < limit:
                return False
            if left > right:
                limit, left = left, halves[left][1]
                if left == limit:
                    limit, right = right + 1, halves[right][0]
                    if right + 1 == limit:
                        return True
            else:
                limit, right = right + 1, halves[right][0]
                if right + 1 == limit:
                    limit, left = left, halves[left][1]
                    if left == limit:
                        return True

    def last(self, piece: bytes, end: int, lasts: list[int]) -> int:
        """Last token of the prefix that ends at ``end``, given those of all shorter prefixes."""
        get, known = self.ranks.get, self.pairs.get
        for n in self.lengths.get(piece[end - 4 : end], SHORT) if end > 3 else SHORT:
            if n < end:
                token = get(piece[end - n : end])
                if token is not None:
                    left = lasts[end - n - 1]
                    fits = known(left << 32 | token)
                    if fits or (fits is None and self.fits(left, token)):
                        return token
            elif n == end:
                token = get(piece[:end])
                if token is not None:
                    return token
        raise ValueError("no token ends here: the vocabulary lacks single bytes")

    def ending(self, piece: bytes, end: int) -> int:
        """The same, where the table is filled only as far as it is asked for; prefixes met in other pieces are remembered."""
        prefix = piece[:end]
        got = self.begun.get(prefix)
        if got is not None:
            return got
        got = self.ranks.get(prefix)
        if got is None:
            get, known = self.ranks.get, self.pairs.get
            for n in self.lengths.get(piece[end - 4 : end], SHORT) if end > 3 else SHORT:
                if n < end:
                    got = get(piece[end - n : end])
                    if got is not None:
                        left = self.ending(piece, end - n)
                        fits = known(left << 32 | got)
                        if fits or (fits is None and self.fits(left, got)):
                            break
            else:
                raise ValueError("no token ends here: the vocabulary lacks single bytes")
        if len(self.begun) >= BEGINNINGS:
            self.begun.clear()
        self.begun[prefix] = got
        return got

    def lasts(self, piece: bytes) -> list[int]:
        return self.extend(b"", [], piece)

    def extend(self, piece: bytes, lasts: list[int], more: bytes) -> list[int]:
        """Append bytes: the table grows, what was there stays."""
        text, out, last = piece + more, list(lasts), self.last
        for end in range(len(piece) + 1, len(text) + 1):
            out.append(last(text, end, out))
        return out

    def edit(self, piece: bytes, lasts: list[int], start: int, stop: int, new: bytes) -> tuple[bytes, list[int]]:
        """Replace bytes: prefixes before the edit stay, those behind follow until both tables agree over a whole token's reach."""
        text = piece[:start] + new + piece[stop:]
        out, shift, same = lasts[:start], len(new) - (stop - start), 0
        for end in range(start + 1, len(text) + 1):
            out.append(self.last(text, end, out))
            old = end - shift - 1
            # a last token depends on the bytes and last tokens within the longest token's reach only
            same = same + 1 if end > start + len(new) and old < len(lasts) and lasts[old] == out[-1] else 0
            if same > self.longest:
                out += lasts[old + 1 :]
                break
        return text, out

    def walk(self, lasts: list[int]) -> list[int]:
        """Token ids, read from the last prefix backwards."""
        out, end, sizes = [], len(lasts), self.sizes
        while end:
            token = lasts[end - 1]
            out.append(token)
            end -= sizes[token]
        out.reverse()
        return out

    def encode(self, piece: bytes) -> tuple[int, ...]:
        token = self.ranks.get(piece)
        if token is not None:
            return (token,)
        if len(piece) > LONG:
            return tuple(self.walk(self.lasts(piece)))
        out, end, sizes = [], len(piece), self.sizes
        while end:
            token = self.ending(piece, end)
            out.append(token)
            end -= sizes[token]
        out.reverse()
        return tuple(out)


class _Known(dict):
    """Ids of pieces met before. A full memory becomes the old one, from which pieces still met return; long ones are not remembered."""

    def __init__(self, coder: Prefixes):
        super().__init__()
        self.coder, self.old = coder, {}

    def __missing__(self, piece: str) -> tuple[int, ...]:
        got = self.old.get(piece) or self.coder.encode(piece.encode())
        if len(piece) <= LONG:
            if len(self) >= REMEMBERED:
                self.old = dict(self)
                self.clear()
            self[piece] = got
        return got


class _Halves(dict):
    """The two tokens a token is merged from, itself twice for a single byte, None where merging its bytes does not give it."""

    def __init__(self, coder: Prefixes):
        super().__init__()
        self.coder = coder

    def __missing__(self, token: int) -> tuple[int, int] | None:
        piece = self.coder.bytes_of[token]
        two = self.coder.merged(piece, 2)
        if len(piece) == 1:
            got = (token, token)
        else:
            got = tuple(two) if len(two) == 2 and self.coder.merged(piece) == [token] else None
        self[token] = got
        return got


class Document:
    """A text with its pieces, encoded; appends and edits re-encode only the pieces they reach."""

    def __init__(self, coder: Prefixes, split: tuple[regex.Pattern, regex.Pattern], text: str = ""):
        self.coder, self.split = coder, split[1]
        self.text, self.starts, self.tokens = "", [], []
        self.replace(0, 0, text)

    def replace(self, start: int, stop: int, new: str) -> None:
        # a piece depends on what follows it by the white space run it may give a character to: step back two pieces
        first = max(0, bisect_right(self.starts, start) - 3)
        begin = self.starts[first] if self.starts else 0
        old_starts, old_tokens, shift = self.starts, self.tokens, len(new) - (stop - start)
        self.text = self.text[:start] + new + self.text[stop:]
        old = {s + shift: i for i, s in enumerate(old_starts) if s > stop}
        self.starts, self.tokens = old_starts[:first], old_tokens[:first]
        for m in self.split.finditer(self.text, begin):
            i = old.get(m.start())
            if i is not None and m.start() > start + len(new) + 1:
                self.starts += [s + shift for s in old_starts[i:]]
                self.tokens += old_tokens[i:]
                return
            self.starts.append(m.start())
            self.tokens.append(self.coder.encode(m.group().encode()))

    def ids(self) -> list[int]:
        return [t for piece in self.tokens for t in piece]


def coder(path: str, pattern: str) -> tuple[Prefixes, tuple[regex.Pattern, regex.Pattern]]:
    """Encoder and splitter of this worker: kept where the worker's later tasks find them, as functions travel anew with every task."""
    held = sys.modules.setdefault("_prefix_coders", types.ModuleType("_prefix_coders")).__dict__
    if (path, pattern) not in held:
        held[path, pattern] = Prefixes(read_ranks(path)), splitter(pattern)
    return held[path, pattern]


#: Bytes from which a text may hold code points that libraries know differently (all of them lie above U+0540).
LATE = 0xD5


def encode_text(text: str, prefixes: Prefixes, split: tuple[regex.Pattern, regex.Pattern]) -> np.ndarray:
    """Ids of a whole text."""
    raw = np.frombuffer(text.encode(), np.uint8)
    pattern = split[1] if len(raw) and raw.max() >= LATE else split[0]
    return np.fromiter(chain.from_iterable(map(prefixes.known.__getitem__, pattern.findall(text))), "<u4")


SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()), ("ids", pa.binary())])
#: Bytes of an outgoing batch.
BATCH = 4 << 20


def encode(docs: DataFrame, path: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, digests of the ids (little-endian, 32 bits) and of the bytes decoded from them and, on request, the ids."""
    schema = SCHEMA if with_ids else pa.schema(list(SCHEMA)[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefixes, split = coder(path, pattern)
        rows, size = [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                ids = encode_text(text.as_py(), prefixes, split)
                raw, plain = ids.tobytes(), decode(ids, prefixes)
                row = (doc_id.as_py(), len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(plain).hexdigest(), raw)
                rows.append(row[: len(schema)])
                size += 160 + len(raw) * with_ids
                if size >= BATCH:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    ddl = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids binary" if with_ids else "")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole().alias("text")).mapInArrow(run, ddl)


def decode(ids: np.ndarray, prefixes: Prefixes) -> bytes:
    return b"".join(map(prefixes.table.__getitem__, ids.tolist()))
