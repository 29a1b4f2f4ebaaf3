"""Quality score of texts by a generalised additive model with pairwise interactions.

Each text is described by a few dozen numbers (shares of byte classes, word and
line shapes, repetition). Boosting goes round the features in turn; every step
fits one shallow tree on one binned feature and adds it, shrunk, to that
feature's lookup table, so the model stays a sum of per-feature tables. Then the
pairs of features that best explain what is left get two-dimensional tables in
the same way. Scoring is binning and a sum of table entries for whole batches.

Labels are learned from at most ``sample_rows`` labelled rows (a hash sample);
scoring covers every row, without a shuffle.

Edge cases: null and empty texts have a defined description and score; without
usable labels every score is 0.5; labels that are null or not 0/1 are ignored;
rows with a null id are scored and not held out; repeated rows are all
returned; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batches, bound_batches

#: Byte classes of the description.
CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digit": b"0123456789",
    "blank": b" \t\r\x0b\x0c",
    "newline": b"\n",
    "stop": b".?",
    "comma": b",;:",
    "bang": b"!",
    "pipe": b"|",
    "bracket": b"()[]{}<>",
    "quote": b"\"'`",
    "dash": b"-_/\\",
    "sign": b"#$%&*+=@^~",
}
FEATURES = [*CLASSES, "wide", "bytes", "words", "word_bytes", "long_word", "short_words", "distinct", "top_word", "caps_words", "odd_ends", "lines", "line_bytes", "same_lines", "open_lines"]
_MASK = np.zeros((256, len(CLASSES)))
for _k, _bytes in enumerate(CLASSES.values()):
    _MASK[list(_bytes), _k] = 1


def describe(texts: list[bytes | None]) -> np.ndarray:
    """One row of FEATURES for each text."""
    out = np.zeros((len(texts), len(FEATURES)))
    k = len(CLASSES)
    for i, text in enumerate(texts):
        text = text or b""
        n = max(1, len(text))
        out[i, :k] = np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ _MASK / n
        out[i, k] = 1 - out[i, :k].sum() if text else 0
        words = text.split()
        m = max(1, len(words))
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        kinds: dict[bytes, int] = {}
        for w in words:
            kinds[w] = kinds.get(w, 0) + 1
        lines = text.split(b"\n")
        out[i, k + 1 :] = (
            np.log1p(len(text)),
            np.log1p(len(words)),
            sizes.mean() if len(words) else 0,
            sizes.max(initial=0),
            (sizes <= 3).sum() / m,
            len(kinds) / m,
            max(kinds.values(), default=0) / m,
            sum(map(bytes.isupper, words)) / m,
            sum(w[-1] in b"#$%&*!|~=+@^" for w in words) / m,
            np.log1p(len(lines)),
            len(text) / len(lines),
            1 - len(set(lines)) / len(lines),
            sum(not x.rstrip().endswith((b".", b"!", b"?", b":")) for x in lines) / len(lines),
        )
    return out


class AdditiveModel:
    """Lookup tables: intercept + sum of table[f][bin] + sum of table[f, g][bin, bin]."""

    def __init__(self, x: np.ndarray, y: np.ndarray, bins: int = 48, pair_bins: int = 12, rounds: int = 160, pair_rounds: int = 60, pairs: int = 10, rate: float = 0.1, leaf: int = 8):
        n, d = x.shape
        self.cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(d)]
        self.coarse = [np.unique(np.quantile(c, np.linspace(0, 1, pair_bins + 1)[1:-1])) if len(c) else c for c in self.cuts]
        p = (y.sum() + 1) / (n + 2)
        self.base = float(np.log(p / (1 - p)))
        self.tables = [np.zeros(len(c) + 1) for c in self.cuts]
        self.pairs: list[tuple[int, int]] = []
        self.pair_tables: list[np.ndarray] = []
        binned = [np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(self.cuts)]
        score = np.full(n, self.base)
        for _ in range(rounds):
            for j in range(d):
                if len(self.tables[j]) < 2:
                    continue
                step = rate * self._tree(*self._sums(score, y, binned[j], len(self.tables[j])), leaf)
                self.tables[j] += step
                score += step[binned[j]]
        wide = [np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(self.coarse)]
        gains = []
        for f, g in combinations(range(d), 2):
            a, b = len(self.coarse[f]) + 1, len(self.coarse[g]) + 1
            if a > 1 and b > 1:
                grad, hess, _ = self._sums(score, y, wide[f] * b + wide[g], a * b)
                gains.append((float((grad**2 / (hess + 5)).sum() / (a * b)), f, g))
        self.pairs = [(f, g) for _, f, g in sorted(gains, reverse=True)[:pairs]]
        shapes = [(len(self.coarse[f]) + 1, len(self.coarse[g]) + 1) for f, g in self.pairs]
        self.pair_tables = [np.zeros(s) for s in shapes]
        for _ in range(pair_rounds):
            for (f, g), shape, table in zip(self.pairs, shapes, self.pair_tables, strict=True):
                cell = wide[f] * shape[1] + wide[g]
                grad, hess, count = (s.reshape(shape) for s in self._sums(score, y, cell, shape[0] * shape[1]))
                step = rate * self._quadrants(grad, hess, count, leaf)
                table += step
                score += step.ravel()[cell]

    @staticmethod
    def _sums(score, y, cell, size):
        p = 1 / (1 + np.exp(-score))
        return np.bincount(cell, y - p, size), np.bincount(cell, p * (1 - p), size), np.bincount(cell, minlength=size)

    @staticmethod
    def _tree(grad, hess, count, leaf: int) -> np.ndarray:
        """Values of a tree of up to three leaves on one feature's bins: the best cut, then the best cut of either side."""
        out = np.zeros(len(grad))

        def cut(lo, hi):
            g, h, c = np.cumsum(grad[lo:hi]), np.cumsum(hess[lo:hi]), np.cumsum(count[lo:hi])
            if hi - lo < 2:
                return 0.0, None
            left = g[:-1] ** 2 / (h[:-1] + 1)
            right = (g[-1] - g[:-1]) ** 2 / (h[-1] - h[:-1] + 1)
            gain = np.where((c[:-1] >= leaf) & (c[-1] - c[:-1] >= leaf), left + right - g[-1] ** 2 / (h[-1] + 1), 0)
            k = int(gain.argmax())
            return float(gain[k]), lo + k + 1 if gain[k] > 0 else None

        edges = [0, len(grad)]
        for _ in range(2):
            best = max((cut(lo, hi) for lo, hi in zip(edges, edges[1:], strict=False)), key=lambda t: t[0])
            if best[1] is None:
                break
            edges = sorted({*edges, best[1]})
        for lo, hi in zip(edges, edges[1:], strict=False):
            out[lo:hi] = grad[lo:hi].sum() / (hess[lo:hi].sum() + 1)
        return out if len(edges) > 2 else np.zeros(len(grad))

    @staticmethod
    def _quadrants(grad, hess, count, leaf: int) -> np.ndarray:
        """Values of the tree with one cut on each of two features that explains most."""
        g, h, c = (s.cumsum(0).cumsum(1) for s in (grad, hess, count))

        def parts(s):
            top, side, all_ = s[:-1, -1:], s[-1:, :-1], s[-1, -1]
            a = s[:-1, :-1]
            return a, top - a, side - a, all_ - top - side + a

        if min(grad.shape) < 2:
            return np.zeros(grad.shape)
        gs, hs, cs = parts(g), parts(h), parts(c)
        gain = sum(x**2 / (y + 1) for x, y in zip(gs, hs, strict=True))
        gain = np.where(np.minimum.reduce(cs) >= leaf, gain, -1)
        i, j = np.unravel_index(int(gain.argmax()), gain.shape)
        out = np.zeros(grad.shape)
        if gain[i, j] <= 0:
            return out
        v = [float(x[i, j] / (y[i, j] + 1)) for x, y in zip(gs, hs, strict=True)]
        out[: i + 1, : j + 1], out[: i + 1, j + 1 :], out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = v
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row: bin, look up, add."""
        out = np.full(len(x), self.base)
        for j, (cuts, table) in enumerate(zip(self.cuts, self.tables, strict=True)):
            out += table[np.searchsorted(cuts, x[:, j], side="right")]
        for (f, g), table in zip(self.pairs, self.pair_tables, strict=True):
            out += table[np.searchsorted(self.coarse[f], x[:, f], side="right"), np.searchsorted(self.coarse[g], x[:, g], side="right")]
        return 1 / (1 + np.exp(-out))


def held_out(id_col: str) -> Column:
    """Rows kept for testing: crc32 of the id as text is divisible by 5."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, sample_rows: int, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, __text, y) of at most sample_rows labelled documents outside the held-out part, chosen by a hash of the id.

    The label sample is bounded by sample_rows, so it alone is broadcast and the documents are not shuffled.
    """
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col)).select(F.col(id_col).cast("long").alias("__id"), F.col(label_col).cast("double").alias("y"))
    some = known.groupBy("__id").agg(F.min("y").alias("y")).orderBy(F.xxhash64("__id"), "__id").limit(sample_rows)
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("__text"))
    return own.join(F.broadcast(some), own.doc_id == some["__id"]).select("doc_id", "__text", "y")


def _features(source):
    for cols in batches(source):
        x = describe(cols["__text"])
        yield pa.RecordBatch.from_arrays([pa.array(cols["doc_id"], pa.int64()), pa.array(cols["y"], pa.float64()), pa.array(list(x), pa.list_(pa.float64()))], names=["doc_id", "y", "x"])


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", sample_rows: int = 20_000, text_col: str = "text", id_col: str = "doc_id") -> AdditiveModel | None:
    """Model of P(label = 1), or None without rows of both labels."""
    bound_batches(docs.sparkSession)
    rows = labelled_sample(docs, labels, label_col, sample_rows, text_col, id_col).mapInArrow(_features, "doc_id long, y double, x array<double>").dropDuplicates(["doc_id"]).toArrow().sort_by("doc_id")
    y = rows["y"].to_numpy()
    if not len(y) or y.min() == y.max():
        return None
    return AdditiveModel(np.stack(rows["x"].to_numpy(zero_copy_only=False)), y)


def _score(model: AdditiveModel | None):
    def run(source):
        for cols in batches(source):
            s = model.score(describe(cols["__text"])) if model else np.full(len(cols["doc_id"]), 0.5)
            yield pa.RecordBatch.from_arrays([pa.array(cols["doc_id"], pa.int64()), pa.array(cols["held_out"], pa.bool_()), pa.array(s)], names=["doc_id", "held_out", "score"])

    return run


def score_quality(docs: DataFrame, labels: DataFrame, label_col: str = "quality", sample_rows: int = 20_000, threshold: float = 0.3, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    model = train(docs, labels, label_col, sample_rows, text_col, id_col)
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).cast("binary").alias("__text"))
    out = own.mapInArrow(_score(model), "doc_id long, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
