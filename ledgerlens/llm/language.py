"""Language of a text by a convolutional network over its bytes.

Bytes are embedded, filters of several widths slide over a window of fixed length, each filter's largest response in the window passes
on, and a softmax over the languages ends it. The network is trained here in numpy (Adam, gradients through the places of the largest
responses) on windows of labelled documents: a sample bounded by ``DOCUMENTS`` per language and ``WINDOWS`` in all,
equal in size for every language however many documents it has. Prediction reads the whole text as windows that follow each other, many windows
to a matrix product, and averages the windows' probabilities by their bytes.

Only text and language of training documents are used; a prediction sees the text alone. Samples go by hashes of doc_id and all seeds are
fixed.

Defined cases: a text that is NULL or has no letter is ``und`` with score 0; so is every text if there is nothing to learn from. With one
language every other text is of that language. Labels that are NULL are not learned; texts without a letter neither. Rows repeated as a whole are
one row of the sample. Beyond ``LANGUAGES`` different labels only the most frequent are learned. Very long texts are
read in bounded blocks of windows. Other columns are not read. A row without doc_id is not held out and not learned from. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of a window.
LENGTH = 256
#: Numbers a byte is embedded in.
DIMS = 8
#: Filters by width in bytes.
FILTERS = {2: 12, 3: 16, 4: 20}
SPAN = max(FILTERS)

#: Bounds of the training sample: documents per language, windows per document, windows in all, languages.
DOCUMENTS = 800
PER_DOCUMENT = 2
WINDOWS = 40_000
LANGUAGES = 1000

#: Passes over the sample, windows per step, step size.
EPOCHS = 8
BATCH = 64
RATE = 3e-3

#: Windows that go through the filters at once.
BLOCK = 64

UNKNOWN = "und"


def _patches(x: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Embedded bytes around every place of zero-padded windows: windows x LENGTH x (SPAN * DIMS)."""
    e = table[x]
    step = e.strides[2]
    view = np.lib.stride_tricks.as_strided(e, (len(x), LENGTH, SPAN * DIMS), (e.strides[0], DIMS * step, step))
    return np.ascontiguousarray(view)


def padded(pieces: list[bytes]) -> np.ndarray:
    """Windows as rows of bytes, with zeros behind short ones and room for the widest filter."""
    out = np.zeros((len(pieces), LENGTH + SPAN - 1), np.uint8)
    for i, p in enumerate(pieces):
        out[i, : len(p)] = np.frombuffer(p, np.uint8)
    return out


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


@dataclass
class Network:
    """Parameters: embedding of the bytes, filters, their biases, weights and biases of the languages."""

    languages: list[str]
    table: np.ndarray
    kernel: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    base: np.ndarray

    @classmethod
    def fresh(cls, languages: list[str], rng: np.random.Generator) -> Network:
        n = sum(FILTERS.values())
        draw = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        return cls(languages, draw(256, DIMS, scale=0.5), draw(SPAN * DIMS, n, scale=0.25), np.zeros(n, np.float32), draw(n, len(languages), scale=0.1), np.zeros(len(languages), np.float32))

    def parts(self) -> list[np.ndarray]:
        return [self.table, self.kernel, self.bias, self.out, self.base]

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """Languages' probabilities of every window."""
        done = [np.empty((0, len(self.languages)), np.float32)]
        for i in range(0, len(x), BLOCK):
            patch = _patches(x[i : i + BLOCK], self.table)
            top = (patch.reshape(-1, SPAN * DIMS) @ self.kernel).reshape(len(patch), LENGTH, -1).max(axis=1)
            done.append(_softmax(np.maximum(top + self.bias, 0) @ self.out + self.base))
        return np.concatenate(done)

    def gradients(self, x: np.ndarray, y: np.ndarray, widths: np.ndarray) -> list[np.ndarray]:
        n = len(x)
        patch = _patches(x, self.table)
        response = (patch.reshape(-1, SPAN * DIMS) @ self.kernel).reshape(n, LENGTH, -1)
        place = response.argmax(axis=1)
        top = np.take_along_axis(response, place[:, None, :], axis=1)[:, 0]
        hidden = np.maximum(top + self.bias, 0)
        error = _softmax(hidden @ self.out + self.base)
        error[np.arange(n), y] -= 1
        error /= n
        back = (error @ self.out.T) * (hidden > 0)
        chosen = patch[np.arange(n)[:, None], place]
        kernel = np.einsum("bfk,bf->kf", chosen, back, optimize=True) * widths
        table = np.zeros_like(self.table)
        for j in range(SPAN):
            seen = x[np.arange(n)[:, None], place + j]
            np.add.at(table, seen, back[:, :, None] * self.kernel[j * DIMS : (j + 1) * DIMS].T[None])
        table[0] = 0
        return [table, kernel, back.sum(axis=0), hidden.T @ error, error.sum(axis=0)]


def train(windows: list[bytes], labels: list[str], seed: int = 7) -> Network | None:
    """A network for the languages among the labels; None without windows.

    A quarter of the windows is cut short in every pass, so that short texts are learned too.
    """
    languages = sorted(set(labels))
    if not languages:
        return None
    rng = np.random.default_rng(seed)
    net = Network.fresh(languages, rng)
    widths = np.concatenate([np.repeat((np.arange(SPAN * DIMS) < w * DIMS)[:, None], n, axis=1) for w, n in FILTERS.items()], axis=1).astype(np.float32)
    net.kernel *= widths
    net.table[0] = 0
    x, y = padded(windows), np.searchsorted(languages, labels)
    size = np.array([len(w) for w in windows])
    # languages with few windows are drawn more often
    by_language = [np.flatnonzero(y == i) for i in range(len(languages))]
    most = max(len(b) for b in by_language)
    first = [np.zeros_like(p) for p in net.parts()]
    second = [np.zeros_like(p) for p in net.parts()]
    steps = 0
    for epoch in range(EPOCHS):
        order = rng.permutation(np.concatenate([rng.permutation(np.resize(b, most)) for b in by_language]))
        rate = RATE * (1 - epoch / EPOCHS)
        for i in range(0, len(order), BATCH):
            rows = order[i : i + BATCH]
            part = x[rows].copy()
            short = np.where(rng.random(len(rows)) < 0.25, rng.integers(8, LENGTH, len(rows)), LENGTH)
            part[np.arange(part.shape[1])[None, :] >= np.minimum(short, size[rows])[:, None]] = 0
            steps += 1
            for p, g, m, v in zip(net.parts(), net.gradients(part, y[rows], widths), first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**steps)) / (np.sqrt(v / (1 - 0.999**steps)) + 1e-8)
    return net


def held_out(doc_id: Column) -> Column:
    """Documents kept from training."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _has_letter(text: Column) -> Column:
    return F.coalesce(text.cast("string").rlike(r"\p{L}"), F.lit(False))


def sample(docs: DataFrame) -> tuple[list[bytes], list[str]]:
    """Windows and labels to learn from: at most about ``DOCUMENTS`` documents of each language, ``WINDOWS`` windows in all."""
    known = F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))
    rows = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")).where(known)
    # at most LANGUAGES rows
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()
    if not counts:
        return [], []
    each = max(1, min(DOCUMENTS, WINDOWS // (PER_DOCUMENT * len(counts))))
    share = docs.sparkSession.createDataFrame([(r["lang"], each / r["n"]) for r in counts], "lang string, share double")
    unit = F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    drawn = rows.join(F.broadcast(share), "lang").where((unit < F.col("share")) & _has_letter(F.col("text")))
    starts = [F.pmod(F.xxhash64("doc_id", F.lit(i)), F.greatest(F.length("text") - LENGTH, F.lit(0)) + 1).cast("int") + 1 for i in range(PER_DOCUMENT)]
    cells = F.array(*[F.struct(F.lit(i).alias("i"), F.col("text").substr(s, F.lit(LENGTH)).alias("piece")) for i, s in enumerate(starts)])
    pieces = drawn.select("doc_id", "lang", F.inline(cells)).distinct()
    kept = pieces.orderBy(F.xxhash64("doc_id", "i"), "doc_id", "i", "lang", "piece").limit(WINDOWS).select("lang", "piece").collect()
    return [r["piece"].encode("utf-8", "replace")[:LENGTH] for r in kept], [r["lang"] for r in kept]


def _predictor(net: Network):
    def windows(raw: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Mean probabilities of texts that follow each other."""
        size = np.diff(first)
        number = -(-size // LENGTH)
        total = np.zeros((len(size), len(net.languages)))
        # blocks of windows, each a range of one text's bytes
        owner = np.repeat(np.arange(len(size)), number)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number)
        begin = first[:-1][owner] + nth * LENGTH
        length = np.minimum(LENGTH, first[1:][owner] - begin)
        for i in range(0, len(owner), BLOCK):
            b, n = begin[i : i + BLOCK], length[i : i + BLOCK]
            at = b[:, None] + np.arange(LENGTH)
            part = np.zeros((len(b), LENGTH + SPAN - 1), np.uint8)
            part[:, :LENGTH] = np.where(np.arange(LENGTH) < n[:, None], raw[np.minimum(at, len(raw) - 1)], 0)
            np.add.at(total, owner[i : i + BLOCK], net.probabilities(part) * n[:, None])
        return total / np.maximum(size, 1)[:, None]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = pa.array(net.languages)
        for batch in batches:
            text = batch.column(2).cast(pa.binary())
            n = len(text)
            best, score = np.zeros(n, np.int64), np.zeros(n)
            if n:
                _, places, data = text.buffers()
                first = np.frombuffer(places, np.int32)[text.offset : text.offset + n + 1].astype(np.int64)
                if first[-1] > first[0]:
                    mean = windows(np.frombuffer(data, np.uint8), first)
                    best, score = mean.argmax(axis=1), mean.max(axis=1)
            # texts without a letter came without bytes
            known = np.diff(first) > 0 if n else np.empty(0, bool)
            lang = pa.array(np.where(known, names.take(pa.array(best)).to_numpy(zero_copy_only=False), UNKNOWN).astype(object), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lang, pa.array(np.where(known, np.clip(np.round(score, 6), 0.0, 1.0), 0.0))], ["doc_id", "held_out", "lang_pred", "score"])

    return run


def predict(docs: DataFrame, net: Network | None) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""
    text = F.col("text").cast("string")
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.when(_has_letter(F.col("text")), text).otherwise(F.lit("")).alias("body"))
    if net is None:
        return rows.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    return rows.mapInArrow(_predictor(net), f"doc_id {dict(docs.dtypes)['doc_id']}, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    """Train on the documents not held out and predict the language of all."""
    return predict(docs, train(*sample(docs)))
