"""Benchmark decontamination: size-partitioned MinHash containment search for short items in long documents.

The similarity of a short item and a long document says nothing, so the search is by containment: the
share of an item's shingles that a document has. Items are partitioned by the size of their sets. An
item of n shingles has as its sketch its s smallest shingle hashes (bottom-s MinHash). A document that
holds the share t of the item lacks at most n - ceil(t n) shingles, so of a sketch of n - ceil(t n) + k it
has k at least. k grows with the sizes of a partition (an eighth of the least), so that an item of many
shingles isn't a candidate for one common one. In each partition a document is looked up in the sorted sketch
table; what has k hits is verified by exact shingle containment. Nothing that reaches t is lost. Hits are
expanded EXPAND at a time.

Items are read in blocks of bounded size; each block is sent to the executors and makes one pass over
the documents. Documents are never shuffled and no document's size or number of hits is limited.

Defined results: a null, empty or wordless item or document matches nothing; an item or document of
one to four words is one shingle; equal items and equal documents are each reported; null ids are
carried as they are; empty tables give empty results. Other columns are ignored by the search and kept
by the filter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm import _text

NUMERATOR, DENOMINATOR = 80, 100
BLOCK_BYTES = 16 << 20
_FILTER_BITS = 22
EXPAND = 1 << 20


class ItemBlock:
    """A block of items, partitioned by size, with the sketch table of every partition."""

    def __init__(self, ids: list, texts: list, size: int, num: int, den: int):
        values, bounds = _text.shingle_sets(pa.array(texts, pa.string()), size)
        n = np.diff(bounds)
        self.ids, self.values, self.bounds, self.n = ids, values, bounds, n
        self.least = -(-num * n // den)
        self.partitions = []  # (sketch hashes, their items, hits that a candidate has), by the power of two of the size
        power = np.where(n > 0, np.floor(np.log2(np.maximum(n, 1))), -1).astype(int)
        self.maybe = np.zeros(1 << _FILTER_BITS, bool)
        for p in np.unique(power[power >= 0]):
            items = np.flatnonzero(power == p)
            k = max(1, min((1 << int(p)) // 8, int(self.least[items].min())))
            length = (n - self.least + k)[items]
            at = _text.spread(bounds[:-1][items], length)  # sets are sorted, so the smallest come first
            keys, owner = values[at], np.repeat(items, length)
            order = np.argsort(keys, kind="stable")
            self.partitions.append((keys[order], owner[order], k))
            self.maybe[keys & np.uint64((1 << _FILTER_BITS) - 1)] = True

    def _candidates(self, row: np.ndarray, value: np.ndarray) -> np.ndarray:
        """(2, candidates) rows and items with enough hits; (row, value) are distinct."""
        n_items, found = len(self.n), [np.zeros(0, np.int64)]
        for keys, owner, k in self.partitions:
            low = np.searchsorted(keys, value, "left")
            count = np.searchsorted(keys, value, "right") - low
            ends = np.cumsum(count)
            pairs, hits = np.zeros(0, np.int64), np.zeros(0, np.int64)
            at = 0
            while at < len(value):
                to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + EXPAND, "right")))
                key = np.repeat(row[at:to], count[at:to]) * n_items + owner[_text.spread(low[at:to], count[at:to])]
                key, times = np.unique(key, return_counts=True)
                pairs, of = np.unique(np.concatenate([pairs, key]), return_inverse=True)
                hits = np.bincount(of, weights=np.concatenate([hits, times]), minlength=len(pairs)).astype(np.int64)
                at = to
            found.append(pairs[hits >= k])
        pairs = np.sort(np.concatenate(found))
        return np.stack([pairs // max(1, n_items), pairs % max(1, n_items)])

    def matches(self, values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows, items and shared shingles of all pairs that reach the threshold; values may repeat in a document."""
        hit = np.flatnonzero(self.maybe[values & np.uint64((1 << _FILTER_BITS) - 1)])
        row, value = np.searchsorted(bounds, hit, "right") - 1, values[hit]
        order = np.lexsort((value, row))
        row, value = row[order], value[order]
        first = np.ones(len(row), bool)
        first[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
        pairs = self._candidates(row[first], value[first])
        shared = np.zeros(pairs.shape[1], np.int64)
        starts, lengths = _text.runs(pairs[0])
        for s, k in zip(starts.tolist(), lengths.tolist(), strict=True):
            r = pairs[0, s]
            own = np.unique(values[bounds[r] : bounds[r + 1]])
            for j in range(s, s + k):
                i = pairs[1, j]
                item = self.values[self.bounds[i] : self.bounds[i + 1]]
                at = np.searchsorted(own, item)
                shared[j] = np.count_nonzero(own[np.minimum(at, len(own) - 1)] == item)
        keep = shared >= self.least[pairs[1]]
        return pairs[0][keep], pairs[1][keep], shared[keep]


def _blocks(items: DataFrame, size: int, num: int, den: int, block_bytes: int) -> Iterator[ItemBlock]:
    ids, texts, held = [], [], 0
    for item_id, text in items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).toLocalIterator():
        ids.append(item_id)
        texts.append(text)
        held += len(text or "") + 16
        if held >= block_bytes:
            yield ItemBlock(ids, texts, size, num, den)
            ids, texts, held = [], [], 0
    if ids:
        yield ItemBlock(ids, texts, size, num, den)


PAIRS = "doc_id long, item_id long, item_shingles long, shared_shingles long, containment double"


def contaminated(docs: DataFrame, items: DataFrame, *, size: int = _text.SHINGLE, numerator: int = NUMERATOR, denominator: int = DENOMINATOR, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row for every document and item of which the document holds the threshold's share."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = spark.createDataFrame([], PAIRS)
    for block in _blocks(items, size, numerator, denominator, block_bytes):
        sent = spark.sparkContext.broadcast(block)

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            own = sent.value
            for batch in batches:
                for part in _text.slices(batch):
                    rows, hits, shared = own.matches(*_text.shingles(*_text.words(*_text.utf8(part.column("text"))), size))
                    n = own.n[hits]
                    yield pa.RecordBatch.from_arrays(
                        [part.column("doc_id").take(pa.array(rows)), pa.array([own.ids[i] for i in hits.tolist()], pa.int64()), pa.array(n), pa.array(shared), pa.array(shared / np.maximum(n, 1))],
                        ["doc_id", "item_id", "item_shingles", "shared_shingles", "containment"],
                    )

        found = found.union(docs.mapInArrow(search, PAIRS))
    return found


def drop_contaminated(docs: DataFrame, items: DataFrame, *, size: int = _text.SHINGLE, numerator: int = NUMERATOR, denominator: int = DENOMINATOR, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents that hold no item; rows and columns stay as they are."""
    for block in _blocks(items, size, numerator, denominator, block_bytes):
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def clean(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            own = sent.value
            for batch in batches:
                for part in _text.slices(batch):
                    rows, _, _ = own.matches(*_text.shingles(*_text.words(*_text.utf8(part.column("text"))), size))
                    keep = np.ones(part.num_rows, bool)
                    keep[rows] = False
                    yield part.filter(pa.array(keep))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs


