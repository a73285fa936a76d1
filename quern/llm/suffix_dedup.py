"""Suffix-array dedup: removes every byte that lies in a repeated string of LENGTH bytes.

1. Anchors. In each window of LENGTH bytes the GRAM-byte string of smallest hash (the rightmost of
   equals) is its anchor, so equal windows have equal anchors at equal places. An anchor's context, the
   LENGTH - GRAM bytes on either side, holds all windows that it anchors. Only hashes are exchanged:
   an anchor string that occurs once can't be in a repeat; contexts that are equal as a whole are
   repeats as a whole; only contexts that differ around a common anchor are looked at, one of each.
2. Shards. Contexts of the same anchor string go to the same shard. A shard's suffix array is built by
   Larsson-Sadakane refinement (groups that aren't singletons are sorted by the rank h bytes on, h
   doubling), Kasai's method gives the common prefixes, and runs of LENGTH or more are repeats.
3. Merging. An anchor of more than SPLIT contexts is dealt to several shards. Each sends the sorted
   hashes of its distinct windows; a window found in another shard's run by binary search is a repeat.
4. Spans are merged by text; equal texts are one node throughout, and are covered whole if long enough.

Identity: a text is two independent 64-bit hashes of its bytes (texts that share one only are told apart);
contexts of one anchor and windows in step 3 are 64-bit hashes that aren't linear in the bytes. The rolling
hash that chooses anchors decides nothing: contexts that it puts together are compared. A run of equal
contexts (periodic text) is one entry. Shards are bounded by SPLIT and by the number of buckets, which
follows the input; all occurrences of one anchor in different texts meet in one bucket of step 1, as hashes.

Defined results: null text is empty (0 bytes, digest of nothing); a text under LENGTH bytes keeps all
its bytes; overlapping repeats count; repeated rows remove each other; null ids keep their rows; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm import _text
from quern.llm._spark import buckets_for, clashes, stored, with_node

LENGTH, GRAM = 200, 100
SPLIT = 8192
PIECE = 1 << 20
SHARD_BYTES = 1 << 20  # of stored input for each shard
_LOW = (1 << 24) - 1


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    n = 1
    out = x
    while 2 * n <= width:
        out = np.minimum(out[:-n], out[n:])
        n *= 2
    return np.minimum(out[: len(x) - width + 1], out[width - n : width - n + len(x) - width + 1])


_BASE = 0x9E3779B97F4A7C17
_CODE = _text.seeded(11, 256)
_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of _BASE and of its inverse modulo 2**64, at least n of each."""
    if not _powers or len(_powers[0]) < n:
        n = max(n, 1 << 16)
        made = []
        for step in (_BASE, pow(_BASE, -1, 1 << 64)):
            out = np.ones(1, np.uint64)
            while len(out) < n:
                out = np.concatenate([out, out * np.uint64(step)])
                step = step * step & _text.M64
            made.append(out)
        _powers[:] = made
    return _powers[0], _powers[1]


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Of all anchors: hash of the string, hash of the context, document, position, bytes before and after, and on how many bytes further it recurs with equal contexts."""
    side = length - gram
    parts = []
    windows = np.maximum(np.diff(offsets) - length + 1, 0)
    at = 0
    n = len(data)
    while at + length <= n:
        low, high = at, min(n, at + PIECE + length - 1)  # window starts [at, at + PIECE)
        left = max(0, low - side)
        part = data[left : min(n, high + side)]
        power, inverse = powers(len(part) + 1)
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_CODE[part] * power[: len(part)], out=total[1:])
        h = _text.mix((total[gram:] - total[:-gram]) * inverse[: len(part) - gram + 1])
        own = h[low - left : high - left - gram + 1]
        packed = (own & ~np.uint64(_LOW)) | (np.uint64(_LOW) - np.arange(len(own), dtype=np.uint64))
        least = _sliding_min(packed, side + 1)
        first, last = np.searchsorted(offsets, low, "right") - 1, np.searchsorted(offsets, high, "left")
        starts = np.maximum(offsets[first:last], low)
        ends = np.minimum(offsets[first:last] + windows[first:last], low + len(least))
        inside = _text.spread(starts - low, np.maximum(ends - starts, 0))
        p = np.sort(_LOW - (np.unique(least[inside]) & np.uint64(_LOW)).astype(np.int64)) + low
        doc = np.searchsorted(offsets, p, "right") - 1
        before, after = np.minimum(p - offsets[doc], side), np.minimum(offsets[doc + 1] - p - gram, side)
        g = h[p - left]
        c = _text.mix(_text.hash_spans(part, p - left - before, p - left + gram + after, fold=False, long=length + side) + (before * 1024 + after).astype(np.uint64) * _text.SEED)
        if len(p):
            again = (doc[1:] == doc[:-1]) & (g[1:] == g[:-1]) & (c[1:] == c[:-1]) & (np.diff(p) <= gram)
            head = np.flatnonzero(np.concatenate([[True], ~again]))
            more = p[np.append(head[1:], len(p)) - 1] - p[head]
            parts.append((g[head], c[head], doc[head], (p - offsets[doc])[head], before[head], after[head], more))
        at += PIECE
    if not parts:
        return tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, *[np.int64] * 5))
    out = [np.concatenate(x) for x in zip(*parts, strict=True)]
    if len(parts) > 1:  # an anchor of windows on both sides of a cut
        order = np.lexsort((-out[6], out[3], out[2]))
        out = [x[order] for x in out]
        keep = np.concatenate([[True], (np.diff(out[2]) != 0) | (np.diff(out[3]) != 0)])
        out = [x[keep] for x in out]
    return tuple(out)


ANCHORS = "bucket int, nodes binary, counts binary, grams binary, contexts binary, places binary"
_PLACE = np.dtype([("pos", "<i8"), ("before", "<u2"), ("after", "<u2"), ("more", "<u4")])
_WANT = np.dtype([("gram", "<i8"), ("pos", "<i8"), ("before", "<u2"), ("after", "<u2"), ("sub", "<u2"), ("split", "<u2")])


def _short(x: np.ndarray) -> bytes:
    return x.astype(np.uint32).tobytes() + (x >> np.uint64(32)).astype(np.uint16).tobytes()


def _long(raw: bytes) -> np.ndarray:
    n = len(raw) // 6
    return np.frombuffer(raw, np.uint32, n).astype(np.uint64) | (np.frombuffer(raw, np.uint16, n, 4 * n).astype(np.uint64) << np.uint64(32))


def _first_rows(nodes: np.ndarray, seen: set[int]) -> np.ndarray:
    """Marks the first row of every node that is not yet in seen."""
    keep = np.zeros(len(nodes), bool)
    for i, x in enumerate(nodes.tolist()):
        if x not in seen:
            seen.add(x)
            keep[i] = True
    return keep


def _by_gram(n_buckets: int, length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for part in _text.slices(batch):
                part = part.filter(pa.array(_first_rows(part.column("node").to_numpy(), seen)))
                nodes = part.column("node").to_numpy()
                g, c, doc, pos, before, after, more = anchors(*_text.utf8(part.column("text")), length, gram)
                bucket = (_text.mix(g) % np.uint64(n_buckets)).astype(np.uint16 if n_buckets < 1 << 16 else np.int64)
                order = np.argsort(bucket, kind="stable")
                place = np.zeros(len(g), _PLACE)
                place["pos"], place["before"], place["after"], place["more"] = pos, before, after, more
                g, c, doc, place, bucket = g[order], c[order], doc[order], place[order], bucket[order]
                for s, n in zip(*(x.tolist() for x in _text.runs(bucket)), strict=True):
                    cut = slice(s, s + n)
                    at, count = _text.runs(doc[cut])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([int(bucket[s])], pa.int32()), *(pa.array([x], pa.binary()) for x in (nodes[doc[cut][at]].tobytes(), count.astype(np.int32).tobytes(), _short(g[cut]), c[cut].tobytes(), place[cut].tobytes()))],
                        ["bucket", "nodes", "counts", "grams", "contexts", "places"],
                    )

    return run


def _spans_by(nodes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[list[int], list[bytes]]:
    """Merged spans by node, as bytes of (start, end) pairs."""
    order = np.lexsort((starts, nodes))
    nodes, starts, ends = nodes[order], starts[order], ends[order]
    out_nodes, out = [], []
    for s, n in zip(*(x.tolist() for x in _text.runs(nodes)), strict=True):
        out_nodes.append(int(nodes[s]))
        out.append(merge(starts[s : s + n], ends[s : s + n]).tobytes())
    return out_nodes, out


def merge(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """(runs, 2): the union of spans sorted by start; spans that touch are one."""
    if not len(starts):
        return np.zeros((0, 2), np.int64)
    reach = np.maximum.accumulate(ends)
    first = np.concatenate([[True], starts[1:] > reach[:-1]])
    at = np.flatnonzero(first)
    return np.stack([starts[at], reach[np.append(at[1:], len(starts)) - 1]], axis=1).astype(np.int64)


FOUND = "node long, spans binary, wants binary"


def _candidates(gram: int, split: int):
    """A bucket's anchors -> spans that are repeats for certain, and contexts whose bytes are wanted."""

    def run(data: pa.Table) -> pa.Table:
        bucket = data.column("bucket")[0].as_py()
        nodes, counts = (np.frombuffer(b"".join(data.column(c).to_pylist()), t) for c, t in (("nodes", np.int64), ("counts", np.int32)))
        g = np.concatenate([_long(x) for x in data.column("grams").to_pylist()])
        c = np.frombuffer(b"".join(data.column("contexts").to_pylist()), np.uint64)
        place = np.frombuffer(b"".join(data.column("places").to_pylist()), _PLACE)
        only = np.zeros(len(nodes), bool)
        only[np.unique(nodes, return_index=True)[1]] = True  # a text may come from several tasks
        keep = np.repeat(only, counts)
        node = np.repeat(nodes, counts)[keep]
        g, c, place = g[keep], c[keep], place[keep]
        order = np.lexsort((c, g))
        g, c, place, node = g[order], c[order], place[order], node[order]
        if not len(g):
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.binary()), pa.array([], pa.binary())], names=["node", "spans", "wants"])
        new = np.concatenate([[True], (g[1:] != g[:-1]) | (c[1:] != c[:-1])])
        first = np.flatnonzero(new)
        times = np.diff(np.append(first, len(g)))
        whole = np.repeat((times > 1) | (np.maximum.reduceat(place["more"], first) > 0), times)
        out_nodes, spans = _spans_by(node[whole], (place["pos"] - place["before"])[whole], (place["pos"] + gram + place["after"] + place["more"])[whole])
        wants: list[bytes | None] = [None] * len(out_nodes)
        _, kinds = _text.runs(g[first])
        several = np.repeat(kinds > 1, kinds)
        subs = np.repeat(-(-kinds // split), kinds)[several]
        at = first[several]
        want = np.zeros(len(at), _WANT)
        want["gram"] = (g[at] | np.uint64((bucket << 48) & _text.M64)).view(np.int64)
        for k in ("pos", "before", "after"):
            want[k] = place[k][at]
        want["sub"], want["split"] = c[at] % subs.astype(np.uint64), subs > 1
        owner = node[at]
        order = np.argsort(owner, kind="stable")
        owner, want = owner[order], want[order]
        for s, n in zip(*(x.tolist() for x in _text.runs(owner)), strict=True):
            out_nodes.append(int(owner[s]))
            spans.append(None)
            wants.append(want[s : s + n].tobytes())
        return pa.table([pa.array(out_nodes, pa.int64()), pa.array(spans, pa.binary()), pa.array(wants, pa.binary())], names=["node", "spans", "wants"])

    return run


CONTEXTS = "shard int, texts binary, sizes binary, nodes binary, starts binary, wants binary"


def _cut_contexts(n_shards: int, gram: int):
    """Texts with what is wanted of them -> the contexts by shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for part in _text.slices(batch):
                part = part.filter(pa.array(_first_rows(part.column("node").to_numpy(), seen)))
                data, offsets = _text.utf8(part.column("text"))
                nodes = part.column("node").to_numpy()
                lists = [b"".join(x) for x in part.column("wants").to_pylist()]
                want = np.frombuffer(b"".join(lists), _WANT)
                doc = np.repeat(np.arange(len(nodes)), [len(x) // _WANT.itemsize for x in lists])
                shard = (_text.mix(want["gram"].view(np.uint64) + want["sub"].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(n_shards)).astype(np.int64)
                order = np.argsort(shard, kind="stable")
                want, doc, shard = want[order], doc[order], shard[order]
                begin = want["pos"] - want["before"]
                size = (want["before"].astype(np.int64) + gram + want["after"]).astype(np.int64)
                for s, n in zip(*(x.tolist() for x in _text.runs(shard)), strict=True):
                    cut = slice(s, s + n)
                    text = data[_text.spread(offsets[doc[cut]] + begin[cut], size[cut])]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([int(shard[s])], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in (text, size[cut].astype(np.int32), nodes[doc[cut]], begin[cut], want[cut]))],
                        ["shard", "texts", "sizes", "nodes", "starts", "wants"],
                    )

    return run


def suffix_array(text: np.ndarray, deep: int = 128) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order and rank of all suffixes by Larsson-Sadakane refinement, and the suffixes that share `deep` bytes with another, among some that share less.

    A suffix that ends sorts before its extensions.
    """
    n = len(text)
    bits = max(1, n.bit_length())
    packed = 3 * bits <= 63  # a group, the next group and a place fit one word, which sorts faster than an index
    used = np.bincount(text, minlength=256) > 0
    code = np.cumsum(used).astype(np.uint64)  # 0 stands for the end
    width = int(code[-1]).bit_length()
    h = max(1, min(deep, (63 - bits if packed else 63) // width))
    key = np.zeros(n, np.uint64)
    for i in range(h):
        key <<= np.uint64(width)
        key[: max(0, n - i)] |= code[text[i:]]
    if packed:
        key = np.sort(key << np.uint64(bits) | np.arange(n, dtype=np.uint64))
        order = (key & np.uint64((1 << bits) - 1)).astype(np.int32)
        key >>= np.uint64(bits)
    else:
        order = np.argsort(key).astype(np.int32)
        key = key[order]
    starts, lengths = _text.runs(key)
    del key
    rank = np.empty(n, np.int32)
    rank[order] = np.repeat(starts.astype(np.int32), lengths)
    slots = np.flatnonzero(np.repeat(lengths > 1, lengths)).astype(np.int32)  # places in the order that are not settled
    shared = None
    while True:
        if shared is None and 2 * h > deep:  # the last depth that isn't beyond
            shared = order[slots]
        if not len(slots):
            break
        at = order[slots]
        both = rank[at].astype(np.int64) << np.int64(bits)
        beyond = at + np.int32(h) if h < n else np.full(len(at), n, np.int32)
        both += np.where(beyond < n, rank[np.minimum(beyond, n - 1)] + 1, 0)
        if packed:
            both = np.sort(both << np.int64(bits) | at)
            at = (both & np.int64((1 << bits) - 1)).astype(np.int32)
            both >>= np.int64(bits)
        else:
            sort = np.argsort(both)
            at, both = at[sort], both[sort]
        order[slots] = at
        starts, lengths = _text.runs(both)
        rank[at] = np.repeat(slots[starts], lengths)
        slots = slots[np.repeat(lengths > 1, lengths)]
        h *= 2
    return order, rank, np.sort(shared if shared is not None else order[:0])


def kasai(text: np.ndarray, order: np.ndarray, rank: np.ndarray, where: np.ndarray, most: int) -> np.ndarray:
    """Common prefix of each suffix of `where` (ascending) and the one before it in the order.

    Runs of consecutive positions are lanes that advance together; from one position to the next the
    prefix shrinks by one at most, so comparing resumes there. It stops when `most` is reached.
    """
    out = np.zeros(len(where), np.int64)
    if not len(where):
        return out
    n = len(text)
    words = np.lib.stride_tricks.sliding_window_view(np.concatenate([text, np.zeros(8, np.uint8)]), 8)
    cut = np.concatenate([[True], np.diff(where) != 1])
    begin = np.flatnonzero(cut)
    size = np.diff(np.append(begin, len(where)))
    pieces = -(-size // 128)  # long lanes are cut: a lane's start costs one comparison from 0
    begin, size = np.repeat(begin, pieces) + _text.spread(np.zeros(len(pieces), np.int64), pieces) * 128, np.minimum(128, np.repeat(size, pieces) - _text.spread(np.zeros(len(pieces), np.int64), pieces) * 128)
    sort = np.argsort(-size, kind="stable")
    begin, size = begin[sort], size[sort]
    common = np.zeros(len(begin), np.int64)
    for step in range(int(size[0])):
        k = int(np.searchsorted(-size, -step, "left"))
        i = where[begin[:k] + step]
        r = rank[i]
        j = np.where(r > 0, order[np.maximum(r - 1, 0)], n)
        common = np.where(j < n, np.maximum(common[:k] - 1, 0), 0)
        lane = np.flatnonzero(j < n)
        while len(lane):
            a, b = i[lane] + common[lane], j[lane] + common[lane]
            ok = (a < n) & (b < n)
            lane, a, b = lane[ok], a[ok], b[ok]
            differ = words[a] != words[b]
            any_ = differ.any(axis=1)
            same = np.where(any_, differ.argmax(axis=1), 8)
            common[lane] += np.minimum(same, n - np.maximum(a, b))
            lane = lane[~any_]
            lane = lane[common[lane] < most]
        out[begin[:k] + step] = common
    return out


def repeat_classes(text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions that share `length` bytes with another, ascending, and the number of each one's class."""
    if len(text) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order, rank, shared = suffix_array(text, length)
    common = kasai(text, order, rank, shared, length)
    by_rank = np.argsort(rank[shared])
    ranks = rank[shared][by_rank]
    joined = (common[by_rank] >= length) & np.concatenate([[False], np.diff(ranks) == 1])
    number = np.cumsum(~joined)
    size = np.bincount(number)
    keep = size[number] > 1
    position, klass = shared[by_rank][keep], number[keep]
    back = np.argsort(position)
    return position[back], klass[back]


WINDOWS = "node long, spans binary, bucket int, hashes binary, nodes binary, starts binary"


def _shard(length: int, n_buckets: int):
    """A shard's contexts -> spans of repeats; of split anchors also all distinct windows, as sorted runs by hash."""

    def run(data: pa.Table) -> pa.Table:
        text, size, node, start, want = (np.frombuffer(b"".join(data.column(c).to_pylist()), t) for c, t in (("texts", np.uint8), ("sizes", np.int32), ("nodes", np.int64), ("starts", np.int64), ("wants", _WANT)))
        size = size.astype(np.int64)
        at = np.concatenate([[0], np.cumsum(size)])[:-1]
        key = np.zeros(len(node), np.dtype([("node", "<i8"), ("start", "<i8"), ("gram", "<i8")]))
        key["node"], key["start"], key["gram"] = node, start, want["gram"]
        once = np.unique(key, return_index=True)[1]  # a text may come from several tasks
        if len(once) < len(node):
            once.sort()
            text = text[_text.spread(at[once], size[once])]
            size, node, start, want = size[once], node[once], start[once], want[once]
            at = np.concatenate([[0], np.cumsum(size)])[:-1]
        _, who = np.unique(node, return_inverse=True)
        position, klass = repeat_classes(text, length)
        owner = np.searchsorted(at, position, "right") - 1
        inside = position - at[owner] + length <= size[owner]
        position, klass, owner = position[inside], klass[inside], owner[inside]
        place = who[owner] * np.int64(1 << 40) + start[owner] + position - at[owner]  # where the window really is
        low, high = np.full(int(klass.max(initial=-1)) + 1, 1 << 62), np.full(int(klass.max(initial=-1)) + 1, -1)
        np.minimum.at(low, klass, place)
        np.maximum.at(high, klass, place)
        real = (low < high)[klass]
        begin = start[owner] + position - at[owner]
        nodes, spans = _spans_by(node[owner][real], begin[real], begin[real] + length)
        out: list[list] = [nodes, spans, [None] * len(nodes), [None] * len(nodes), [None] * len(nodes), [None] * len(nodes)]
        split = np.flatnonzero(want["split"] > 0)
        if len(split):
            valid = np.maximum(size[split] - length + 1, 0)
            where = _text.spread(at[split], valid)
            own = np.repeat(split, valid)
            hashes = _text.hash_spans(text, where, where + length, fold=False, long=length)
            begin = start[own] + where - at[own]
            hashes, first = np.unique(hashes, return_index=True)
            bucket = (hashes % np.uint64(n_buckets)).astype(np.int64)
            order = np.lexsort((hashes, bucket))
            for s, n in zip(*(x.tolist() for x in _text.runs(bucket[order])), strict=True):
                pick = order[s : s + n]
                for o, v in zip(out, (None, None, int(bucket[pick[0]]), hashes[pick].tobytes(), node[own[first[pick]]].tobytes(), begin[first[pick]].tobytes()), strict=True):
                    o.append(v)
        types = (pa.int64(), pa.binary(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
        return pa.table([pa.array(x, t) for x, t in zip(out, types, strict=True)], names=["node", "spans", "bucket", "hashes", "nodes", "starts"])

    return run


def _merge_runs(length: int):
    """Sorted runs of several shards -> spans of windows that more than one of them has, by binary search."""

    def run(data: pa.Table) -> pa.Table:
        runs = [np.frombuffer(x, np.uint64) for x in data.column("hashes").to_pylist()]
        nodes = [np.frombuffer(x, np.int64) for x in data.column("nodes").to_pylist()]
        starts = [np.frombuffer(x, np.int64) for x in data.column("starts").to_pylist()]
        merged = np.unique(np.concatenate(runs))
        low, high = np.full(len(merged), _text.M64, np.uint64), np.zeros(len(merged), np.uint64)
        at = [np.searchsorted(merged, h) for h in runs]
        for a, node, start in zip(at, nodes, starts, strict=True):  # a run has a hash once
            place = _text.mix(node.view(np.uint64)) + start.view(np.uint64)
            low[a], high[a] = np.minimum(low[a], place), np.maximum(high[a], place)
        again = low < high  # the same place may come with two anchors
        node = np.concatenate([x[again[a]] for a, x in zip(at, nodes, strict=True)])
        start = np.concatenate([x[again[a]] for a, x in zip(at, starts, strict=True)])
        out_nodes, spans = _spans_by(node, start, start + length)
        return pa.table([pa.array(out_nodes, pa.int64()), pa.array(spans, pa.binary())], names=["node", "spans"])

    return run


def _distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text of a task once, so that a text of very many rows travels once from each task."""
    seen: set[int] = set()
    for batch in batches:
        yield batch.filter(pa.array(_first_rows(batch.column("node").to_numpy(), seen)))


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: set[int] = set()
    for batch in batches:
        for part in _text.slices(batch):
            part = part.filter(pa.array(_first_rows(part.column("node").to_numpy(), seen)))
            data, offsets = _text.utf8(part.column("text"))
            whole, out = data.tobytes(), []
            for d, lists in enumerate(part.column("spans").to_pylist()):
                text = whole[offsets[d] : offsets[d + 1]]
                pairs = np.frombuffer(b"".join(lists or []), np.int64).reshape(-1, 2)
                pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
                pairs = merge(pairs[:, 0], pairs[:, 1])
                keep, at = [], 0
                for a, b in pairs.tolist():
                    keep.append(text[at:a])
                    at = b
                keep.append(text[at:])
                out.append((len(text), int((pairs[:, 1] - pairs[:, 0]).sum()), len(pairs), hashlib.sha256(b"".join(keep)).hexdigest(), pairs.ravel().tolist()))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([part.column("node"), *(pa.array([x[i] for x in out], t) for i, t in enumerate(types))], ["node", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"])


def repeats(docs: DataFrame, *, length: int = LENGTH, gram: int = GRAM, split: int = SPLIT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, removed (starts and ends of the removed runs) of every row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("a"), F.xxhash64(F.lit("again"), text).alias("b"), text.alias("text"))
    rows = with_node(rows, clashes(rows)).select("doc_id", "node", "text")
    texts = rows.select("node", "text").mapInArrow(_distinct, "node long, text string")
    n_buckets, n_shards = buckets_for(docs), buckets_for(docs, SHARD_BYTES)
    found = rows.select("node", "text").mapInArrow(_by_gram(n_buckets, length, gram), ANCHORS).groupBy("bucket").applyInArrow(_candidates(gram, split), FOUND)
    found = stored(found, "suffix-candidates")
    wants = found.where("wants IS NOT NULL").groupBy("node").agg(F.collect_list("wants").alias("wants"))
    contexts = texts.join(wants, "node").mapInArrow(_cut_contexts(n_shards, gram), CONTEXTS)
    shards = stored(contexts.groupBy("shard").applyInArrow(_shard(length, n_buckets), WINDOWS), "suffix-shards")
    merged = shards.where("bucket IS NOT NULL").select("bucket", "hashes", "nodes", "starts").groupBy("bucket").applyInArrow(_merge_runs(length), "node long, spans binary")
    spans = found.where("spans IS NOT NULL").select("node", "spans").union(shards.where("spans IS NOT NULL").select("node", "spans")).union(merged)
    spans = spans.groupBy("node").agg(F.collect_list("spans").alias("spans"))
    each = texts.join(spans, "node", "left").mapInArrow(_finish, "node long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<long>")
    each = each.groupBy("node").agg(*(F.first(c).alias(c) for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "removed")))
    small = stored(rows.select("doc_id", "node"), "suffix-rows")
    times = small.groupBy("node").count()
    each = each.join(times, "node").withColumn("all", (F.col("count") > 1) & (F.col("n_bytes") >= length))
    nothing = hashlib.sha256(b"").hexdigest()
    choose = lambda c, whole: F.when(F.col("all"), whole).otherwise(F.col(c)).alias(c)
    each = each.select(
        "node", "n_bytes", choose("n_removed", F.col("n_bytes")), choose("n_spans", F.lit(1).cast("long")), choose("kept_sha256", F.lit(nothing)),
        choose("removed", F.array(F.lit(0).cast("long"), F.col("n_bytes"))),
    )
    return small.join(each, "node").drop("node")
