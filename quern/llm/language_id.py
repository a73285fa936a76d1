"""Language identification with language-bitmask n-gram filters.

One bit-sliced Bloom filter serves all languages: every cell holds a mask with one bit for each
language, an n-gram sets its languages' bits in its cells, and the AND of the cells of a looked-up
n-gram is the set of all languages that contain it. A text's n-grams are looked up together; for each
language the hits are counted, corrected for the filter's false-positive rate, and the largest
corrected share decides. Reads text only when it predicts.

Training counts the n-grams of a sample of labelled rows, bounded by ``max_rows`` (chosen by a hash of
the row's text, so alike at every size); a language keeps an n-gram that is not rare in it and not
much rarer than in the language that has it most (borrowed passages don't count).

Defined results: a null text or one without a letter is ``und`` with score 0; a text with letters but
without a known n-gram takes the most frequent learned language with score 0; ties go to the more
frequent language; without any labelled row every prediction is ``und``. Repeated rows and null ids
keep their rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm import _text

GRAM = 4  # bytes
PROBES = 3
CELL_BITS = 20
MAX_ROWS = 20_000
LEAST_ROWS, _GRAINS = 50, 100_000_000  # rows of each language in a sample
RARE = 4e-6  # least share of a language's n-grams
BORROWED = 0.05  # least share of the share in the language that has it most

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOWER[[9, 10, 11, 12, 13]] = 32
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_SALTS = _text.seeded(23, 8)


def grams(data: np.ndarray, offsets: np.ndarray, n: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all n-grams of folded bytes that lie inside a document, and each document's bounds."""
    low = _LOWER[data]
    if len(data) > 1:  # capitals of Latin-1 as two UTF-8 bytes
        latin = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
        low[latin] += 32
    size = np.maximum(np.diff(offsets) - n + 1, 0)
    bounds = np.concatenate([[0], np.cumsum(size)])
    if not bounds[-1]:
        return np.zeros(0, np.uint64), bounds
    code = np.zeros(len(low) - n + 1, np.uint64)
    for i in range(n):
        code |= low[i : len(low) - n + 1 + i].astype(np.uint64) << np.uint64(8 * i)
    inside = np.ones(len(code), bool)
    for k in range(1, n):  # starts whose n-gram would cross a document's end
        at = offsets[1:-1] - k
        inside[at[(at >= 0) & (at < len(code))]] = False
    short = np.flatnonzero((np.diff(offsets) < n) & (np.diff(offsets) > 0))
    for d in short:
        inside[offsets[d] : offsets[d + 1]] = False
    return code[inside], bounds


def _cells(codes: np.ndarray, probe: int, bits: int = CELL_BITS) -> np.ndarray:
    return (((codes ^ _SALTS[probe]) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


@dataclass
class Filters:
    """Learned languages, the most frequent first, and their bit-sliced filter: words of 64 languages by cell."""

    languages: list[str]
    slices: np.ndarray  # (words, cells) uint64
    false_positive: np.ndarray

    @classmethod
    def build(cls, languages: list[str], members: list[np.ndarray]) -> Filters:
        slices = np.zeros((max(1, -(-len(languages) // 64)), 1 << CELL_BITS), np.uint64)
        rate = np.zeros(len(languages))
        for k, codes in enumerate(members):
            bit = np.uint64(1 << (k % 64))
            for p in range(PROBES):
                slices[k // 64, _cells(codes, p)] |= bit
            rate[k] = np.count_nonzero(slices[k // 64] & bit) / (1 << CELL_BITS)
        return cls(languages, slices, rate**PROBES)

    def counts(self, codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """(documents, languages): hits of every language, corrected for false positives."""
        n = np.diff(bounds)
        out = np.zeros((len(n), len(self.languages)))
        cells = [_cells(codes, p) for p in range(PROBES)]
        for word in range(len(self.slices)):
            mask = self.slices[word][cells[0]]
            for c in cells[1:]:
                mask &= self.slices[word][c]
            for k in range(64 * word, min(64 * word + 64, len(self.languages))):
                total = np.concatenate([[0], np.cumsum((mask >> np.uint64(k % 64)).astype(np.uint8) & np.uint8(1), dtype=np.int64)])
                hits = total[bounds[1:]] - total[bounds[:-1]]
                f = self.false_positive[k]
                out[:, k] = np.clip((hits - f * n) / max(1e-9, 1 - f), 0, None)
        return out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts by language and hashed n-gram, summed over the whole task before anything is sent."""
    codes: dict[str, dict] = {}
    for batch in batches:
        for part in _text.slices(batch):
            code, bounds = grams(*_text.utf8(part.column("text")))
            langs = np.array(part.column("lang").to_pylist(), object)
            size = np.diff(bounds)
            for lang in dict.fromkeys(langs.tolist()):
                own = code[np.repeat(langs == lang, size)]
                values, n = np.unique(own, return_counts=True)
                held = codes.setdefault(lang, {})
                if "v" in held:
                    values, inverse = np.unique(np.concatenate([held["v"], values]), return_inverse=True)
                    n = np.bincount(inverse, weights=np.concatenate([held["n"], n])).astype(np.int64)
                held["v"], held["n"] = values, n
    for lang, held in codes.items():
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(held["v"]), pa.string()), pa.array(held["v"].view(np.int64)), pa.array(held["n"])], ["lang", "gram", "n"])


def fit(docs: DataFrame, *, max_rows: int = MAX_ROWS) -> Filters:
    """Learns from the text and lang of the given rows; rows without either are left out.

    Beyond max_rows a sample of about as many is taken, by a hash of the row: an equal number of each
    language (all rows of one that has fewer, LEAST_ROWS at least), so that a rare language is learned at any size.
    """
    keys = [F.col("doc_id").cast("string")] if "doc_id" in docs.columns else []
    rows = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"), F.pmod(F.xxhash64("text", *keys), F.lit(_GRAINS)).alias("grain")).where("text IS NOT NULL AND lang IS NOT NULL")
    sizes = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).groupBy(F.col("lang").cast("string").alias("lang")).count().collect()
    if sum(r["count"] for r in sizes) > max_rows:
        left, quota = max_rows, 0.0
        for k, r in enumerate(sorted(sizes, key=lambda r: r["count"])):
            quota = left / (len(sizes) - k)
            if r["count"] > quota:
                break
            left -= r["count"]
        bounds = [(r["lang"], max(quota, LEAST_ROWS) / r["count"]) for r in sizes]
        bound = F.element_at(F.create_map(*(F.lit(x) for lang, share in bounds for x in (lang, int(_GRAINS * min(1.0, share)) + 1))), F.col("lang"))
        rows = rows.where(F.col("grain") < bound)
    rows = rows.drop("grain")
    # an n-gram below the rarity bound never counts, so what comes back is bounded by 1 / RARE for each language
    counted = rows.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    totals = counted.groupBy("lang").agg(F.sum("n").alias("total"))
    common = counted.join(F.broadcast(totals), "lang").where(F.col("n") >= RARE * F.col("total")).select("lang", "gram", (F.col("n") / F.col("total")).alias("share"))
    found = common.toArrow()
    order = {r["lang"]: r["count"] for r in sizes}
    languages = sorted({x for x in found.column("lang").to_pylist()}, key=lambda x: (-order.get(x, 0), x))
    if not languages:
        return Filters.build([], [])
    which = np.array([languages.index(x) for x in found.column("lang").to_pylist()])
    gram, share = found.column("gram").to_numpy().view(np.uint64), found.column("share").to_numpy()
    known, inverse = np.unique(gram, return_inverse=True)
    most = np.zeros(len(known))
    np.maximum.at(most, inverse, share)
    keep = share >= BORROWED * most[inverse]
    return Filters.build(languages, [gram[keep & (which == k)] for k in range(len(languages))])


def identify(texts: pa.Array, filters: Filters) -> tuple[list[str], np.ndarray]:
    """The language and score of every text of an Arrow column."""
    data, offsets = _text.utf8(texts)
    total = np.concatenate([[0], np.cumsum(_LETTER[data], dtype=np.int64)])
    letters = total[offsets[1:]] > total[offsets[:-1]]
    high = np.concatenate([[0], np.cumsum(data >= 0x80, dtype=np.int64)])
    for d in np.flatnonzero(~letters & (high[offsets[1:]] > high[offsets[:-1]])):
        letters[d] = any(c.isalpha() for c in data[offsets[d] : offsets[d + 1]].tobytes().decode("utf-8", "replace"))
    if not filters.languages:
        return ["und"] * len(texts), np.zeros(len(texts))
    codes, bounds = grams(data, offsets)
    counts = filters.counts(codes, bounds)
    best = counts.argmax(axis=1)
    top, whole = counts.max(axis=1), counts.sum(axis=1)
    score = np.where(letters & (whole > 0), top / np.maximum(whole, 1e-12), 0.0)
    names = np.array(filters.languages, object)[best]
    names[~letters] = "und"
    return names.tolist(), np.clip(score, 0, 1)


def predict(docs: DataFrame, filters: Filters, held_out: Column | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(filters)  # 8 MB for each 64 languages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _text.slices(batch):
                names, score = identify(part.column("text"), sent.value)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(names, pa.string()), pa.array(score)], ["doc_id", "held_out", "lang_pred", "score"])

    held = F.lit(False) if held_out is None else F.coalesce(held_out, F.lit(False))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
