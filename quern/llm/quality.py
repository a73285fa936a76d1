"""Quality classifier: a generalised additive model with pairwise interactions.

Every feature of a text is cut into quantile bins. Cyclic boosting visits the features in turn and adds
a shallow tree over the feature's bins to its lookup table; afterwards the pairs of features that
explain most of what is left get tables over two coarser binnings in the same way. A score is the
logistic of the sum of table entries: vectorised look-ups and additions.

Features are computed from the text's bytes and word hashes only. Learning takes labelled rows bounded
by ``max_rows`` (chosen by a hash of the id); only their features come to the driver.

Defined results: a null or empty text has the features of an empty text and a score like any other;
labels that are null, not 0 or 1, or contradict each other for an id are not learned from; with one
class only, or none, all scores are the smoothed share of label 1 (0.5 without rows). Repeated rows and
null ids keep their rows; other columns are ignored by scoring and kept by the filter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm import _text

MAX_ROWS = 20_000
THRESHOLD = 0.7
BINS, PAIR_BINS = 48, 12
ROUNDS, PAIR_ROUNDS, PAIRS = 150, 60, 6
RATE = 0.15
LEAST = 10  # rows in a leaf

FEATURES = (
    "log_bytes", "log_words", "word_bytes", "upper_share", "digit_share", "mark_share", "symbol_share", "exclaim_share", "space_share", "high_share",
    "line_words", "distinct_words", "repeat_share", "top_word", "symbol_words", "upper_words", "lone_symbols", "longest_word", "stops_by_word", "distinct_pairs",
)


def _class(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_UPPER, _LOWER, _DIGIT = (_class(bytes(range(ord(a), ord(b) + 1))) for a, b in ("AZ", "az", "09"))
_MARK, _STOP = _class(b".,;:'\"()?-"), _class(b".!?")
_SYMBOL = _class(b"#$%&*|<>{}[]=_~^\\/@+`!")


def features(column: pa.Array) -> np.ndarray:
    """(texts, FEATURES) of an Arrow column."""
    data, offsets = _text.utf8(column)
    n = len(offsets) - 1
    starts, ends = _text.word_bounds(data, offsets)
    hashes = _text.hash_spans(data, starts, ends)
    bounds = np.searchsorted(starts, offsets)
    size, count = np.diff(offsets), np.diff(bounds)

    def by_bytes(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return total[offsets[1:]] - total[offsets[:-1]]

    def by_words(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return total[bounds[1:]] - total[bounds[:-1]]

    upper, lower, symbol = by_bytes(_UPPER[data]), by_bytes(_LOWER[data]), by_bytes(_SYMBOL[data])
    length = ends - starts
    first, last = data[starts] if len(starts) else data[:0], data[ends - 1] if len(ends) else data[:0]
    doc = np.repeat(np.arange(n), count)
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])
    pair = hashes.copy()
    pair[1:] = _text.mix(hashes[1:] ^ (hashes[:-1] << np.uint64(1)))
    distinct, top, pairs, longest = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n)
    for d in np.flatnonzero(count):
        a, b = bounds[d], bounds[d + 1]
        own = np.sort(hashes[a:b])
        _, k = _text.runs(own)
        distinct[d], top[d], longest[d] = len(k), k.max(), length[a:b].max()
        own = np.sort(pair[a + 1 : b])
        pairs[d] = 1 + np.count_nonzero(own[1:] != own[:-1]) if len(own) else 1
    bytes_, words = np.maximum(size, 1), np.maximum(count, 1)
    letters = np.maximum(upper + lower, 1)
    out = np.stack(
        [
            np.log1p(size), np.log1p(count), size / words, upper / letters, by_bytes(_DIGIT[data]) / bytes_, by_bytes(_MARK[data]) / bytes_, symbol / bytes_,
            by_bytes(data == 33) / bytes_, by_bytes(_text.IS_SEP[data]) / bytes_, by_bytes(data >= 128) / bytes_,
            count / (by_bytes(data == 10) + 1), distinct / words, by_words(same) / words, top / words, by_words(_SYMBOL[last]) / words,
            by_words(_UPPER[first] & (length > 1) & _UPPER[data[np.minimum(starts + 1, max(0, len(data) - 1))]] if len(starts) else np.zeros(0, bool)) / words,
            by_words((length == 1) & _SYMBOL[first]) / words, longest, by_bytes(_STOP[data]) / words, pairs / words,
        ],
        axis=1,
    )
    return out.astype(np.float64)


def _cuts(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1])) if len(x) else np.zeros(0)


def _gain(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[float, int]:
    """The best cut of histogram cells into a left and a right part: gain and size of the left."""
    G, H, N = np.cumsum(g), np.cumsum(h), np.cumsum(n)
    ok = (N[:-1] >= LEAST) & (N[-1] - N[:-1] >= LEAST)
    if not ok.any():
        return 0.0, 0
    gain = np.where(ok, G[:-1] ** 2 / (H[:-1] + 1) + (G[-1] - G[:-1]) ** 2 / (H[-1] - H[:-1] + 1) - G[-1] ** 2 / (H[-1] + 1), 0)
    k = int(gain.argmax())
    return float(gain[k]), k + 1


def shallow_tree(g: np.ndarray, h: np.ndarray, n: np.ndarray, leaves: int = 4) -> np.ndarray:
    """Newton steps of a tree with few leaves over ordered cells: the value of every cell."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        best = max((( *_gain(g[a:b], h[a:b], n[a:b]), a, b) for a, b in parts if b - a > 1), default=(0.0, 0, 0, 0))
        if best[0] <= 1e-9:
            break
        _, k, a, b = best
        parts.remove((a, b))
        parts += [(a, a + k), (a + k, b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + 1)
    return out


def shallow_tree_2d(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """A cut of one axis, then a cut of the other on either side; the better order of the two."""
    best, value = -1.0, np.zeros_like(g)
    for flip in (False, True):
        G, H, N = (x.T if flip else x for x in (g, h, n))
        total, k = _gain(G.sum(1), H.sum(1), N.sum(1))
        out, rows = np.zeros_like(G), ([slice(0, k), slice(k, None)] if k else [slice(None)])
        for r in rows:
            more, j = _gain(G[r].sum(0), H[r].sum(0), N[r].sum(0))
            total += more
            for c in [slice(0, j), slice(j, None)] if j else [slice(None)]:
                out[r, c] = G[r, c].sum() / (H[r, c].sum() + 1)
        if total > best:
            best, value = total, out.T if flip else out
    return value


@dataclass
class AdditiveModel:
    """bias + a table for each feature + a table for each chosen pair."""

    bias: float
    cuts: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pair_cuts: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray) -> AdditiveModel:
        share = (y.sum() + 0.5) / (len(y) + 1)
        model = cls(float(np.log(share / (1 - share))))
        if len(y) < 2 * LEAST or y.min() == y.max():
            return model
        model.cuts = [_cuts(c, BINS) for c in x.T]
        bins = [np.searchsorted(cut, c, "right") for cut, c in zip(model.cuts, x.T, strict=True)]
        size = [len(cut) + 1 for cut in model.cuts]
        model.tables = [np.zeros(s) for s in size]
        rows = [np.bincount(b, minlength=s) for b, s in zip(bins, size, strict=True)]
        f = np.full(len(y), model.bias)
        for _ in range(ROUNDS):
            for k, (b, s) in enumerate(zip(bins, size, strict=True)):
                p = 1 / (1 + np.exp(-f))
                step = RATE * shallow_tree(np.bincount(b, y - p, s), np.bincount(b, p * (1 - p), s), rows[k])
                model.tables[k] += step
                f += step[b]
        model.pair_cuts = [_cuts(c, PAIR_BINS) for c in x.T]
        bins = [np.searchsorted(cut, c, "right") for cut, c in zip(model.pair_cuts, x.T, strict=True)]
        wide = PAIR_BINS + 1
        hist = lambda i, j, w: np.bincount(bins[i] * wide + bins[j], w, wide * wide).reshape(wide, wide)
        p = 1 / (1 + np.exp(-f))
        strength = []
        for i in range(x.shape[1]):
            for j in range(i):
                g, h = hist(i, j, y - p), hist(i, j, p * (1 - p))
                strength.append((float((g**2 / (h + 1)).sum() - (g.sum(0) ** 2 / (h.sum(0) + 1)).sum() - (g.sum(1) ** 2 / (h.sum(1) + 1)).sum()), i, j))
        chosen = [(i, j, np.zeros((wide, wide)), hist(i, j, None)) for _, i, j in sorted(strength, reverse=True)[:PAIRS]]
        for _ in range(PAIR_ROUNDS):
            for i, j, t, n in chosen:
                p = 1 / (1 + np.exp(-f))
                step = RATE * shallow_tree_2d(hist(i, j, y - p), hist(i, j, p * (1 - p)), n)
                t += step
                f += step[bins[i], bins[j]]
        model.pairs = [(i, j, t) for i, j, t, _ in chosen]
        return model

    def score(self, x: np.ndarray) -> np.ndarray:
        f = np.full(len(x), self.bias)
        for k, (cut, t) in enumerate(zip(self.cuts, self.tables, strict=True)):
            f += t[np.searchsorted(cut, x[:, k], "right")]
        for i, j, t in self.pairs:
            f += t[np.searchsorted(self.pair_cuts[i], x[:, i], "right"), np.searchsorted(self.pair_cuts[j], x[:, j], "right")]
        return 1 / (1 + np.exp(-f))


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in _text.slices(batch):
            yield pa.RecordBatch.from_arrays([part.column("label"), pa.array(list(features(part.column("text"))), pa.list_(pa.float64()))], ["label", "x"])


def fit(docs: DataFrame, labels: DataFrame, *, max_rows: int = MAX_ROWS) -> AdditiveModel:
    """Learns quality from the texts of labelled ids; a broadcast of at most about max_rows ids.

    Where ids are repeated so often that these have over twice as many rows, a sample of about max_rows of them is taken.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("_id"), F.col("quality").cast("int").alias("label")).where("_id IS NOT NULL AND label IN (0, 1)")
    known = known.groupBy("_id").agg(F.min("label").alias("label"), F.max("label").alias("high")).where("label = high").drop("high")
    total = known.count()
    if total > max_rows:
        known = known.where(F.pmod(F.xxhash64("_id"), F.lit(1_000_000)) < int(1_000_000 * max_rows / total))
    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string").alias("text"), F.monotonically_increasing_id().alias("_at")).join(F.broadcast(known), "_id")
    total = docs.select(F.col("doc_id").cast("long").alias("_id")).join(F.broadcast(known), "_id").count()
    if total > 2 * max_rows:
        rows = rows.where(F.pmod(F.xxhash64("_at"), F.lit(1_000_000)) < max(1, int(1_000_000 * max_rows / total)))
    found = rows.select("label", "text").mapInArrow(_featurise, "label int, x array<double>").toArrow()
    if not found.num_rows:
        return AdditiveModel(0.0)
    x = np.array(found.column("x").combine_chunks().flatten()).reshape(found.num_rows, len(FEATURES))
    y = found.column("label").to_numpy().astype(float)
    order = np.lexsort((*x.T, y))  # the same rows in the same order, however they were dealt
    return AdditiveModel.fit(x[order], y[order])


def predict(docs: DataFrame, model: AdditiveModel, *, threshold: float = THRESHOLD, held_out: Column | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _text.slices(batch):
                score = model.score(features(part.column("text")))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(score), pa.array((score >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    held = F.lit(False) if held_out is None else F.coalesce(held_out, F.lit(False))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model: AdditiveModel, *, threshold: float = THRESHOLD) -> DataFrame:
    """The rows that are not rejected; columns stay as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _text.slices(batch):
                yield part.filter(pa.array(model.score(features(part.column("text"))) >= threshold))

    return docs.mapInArrow(run, docs.schema)
