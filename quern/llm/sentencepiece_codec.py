"""SentencePiece encoding and decoding: an Aho-Corasick automaton over the pieces drives Viterbi.

The automaton reads a text's bytes once. At every position the output links of its state give all
pieces that end there, longest first, and each relaxes the best score of that position; a back pointer
keeps the winner. A character that no piece ends with falls back to the model's byte pieces, at a score
below every piece. The encoding is thus the segmentation of the greatest total piece score; ties go to
the longer last piece.

No piece has a space after another character (checked when a model is read; with a model where one
has, a text is a single chunk), so the best path of a text is the chain of the best paths of its
chunks "spaces + non-spaces". Equal chunks of a slice of texts are encoded once (found by hash, compared
by bytes), and all distinct chunks advance through the automaton in lockstep, as NumPy vectors.

A chunk over LONG bytes (text without spaces) is cut into lanes, which advance beside each other. A lane
starts WARM bytes early from a guess. Where the scores at its border, relative to each other, are those of the
lane before, all its decisions are right, as they depend on nothing else; where they aren't, the lane is run
again from the true ones (once for all lanes of equal bytes and scores), so the result doesn't depend on lanes.

Spaces are kept as byte 0x20 inside the automaton, so a literal U+2581 of a text is encoded as bytes
and every text decodes to itself.

Defined results: null gives null ids and no tokens, an empty text gives no ids; decode inverts encode
exactly, whatever the text; a null id and one that the model doesn't have decode to nothing; repeated rows and null ids keep their rows; columns of the result's names
are replaced, all others stay.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.llm import _text

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
SLICE_BYTES = 8 << 20
LONG, LANE, WARM = 2048, 512, 256


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Fields of a protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(raw):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        elif kind in (1, 5):
            n = 8 if kind == 1 else 4
            yield tag >> 3, raw[at : at + n]
            at += n
        else:
            n = varint()
            yield tag >> 3, raw[at : at + n]
            at += n


@dataclass
class Automaton:
    """Pieces, dense transitions and output links, all indexed by state."""

    step: np.ndarray  # (states, 256) int32
    output: np.ndarray  # the longest piece's state that ends here; 0: none
    link: np.ndarray  # from a piece's state to that of the next shorter piece that ends here; 0: none
    length: np.ndarray  # bytes of a state's piece
    piece: np.ndarray  # id of a state's piece
    score: np.ndarray
    byte_ids: np.ndarray  # (256,)
    fallback: float
    surface: np.ndarray  # bytes of all pieces end to end, spaces as 0x20
    surface_at: np.ndarray
    chunked: bool
    prefix: bool

    @classmethod
    def load(cls, raw: bytes) -> Automaton:
        pieces, prefix = [], True
        for number, value in _fields(raw):
            if number == 1:
                held = dict(_fields(value))
                pieces.append((held.get(1, b""), struct.unpack("<f", held.get(2, b"\0\0\0\0"))[0], held.get(3, NORMAL)))
            elif number == 3:
                held = dict(_fields(value))
                if held.get(2):
                    raise ValueError("only models without a character map are supported")
                prefix = bool(held.get(3, 1))
                if held.get(4, 1):
                    raise ValueError("models that remove extra white space can't decode to the same text")
        byte_ids = np.full(256, -1, np.int64)
        surface, words = [], {}
        for i, (text, score, kind) in enumerate(pieces):
            if kind == BYTE:
                byte = int(text[3:5], 16)
                byte_ids[byte] = i
                surface.append(bytes([byte]))
            elif kind in (NORMAL, USER):
                surface.append(text.replace("▁".encode(), b" "))
                words.setdefault(surface[-1], (i, score))
            else:
                surface.append(b"")
        if (byte_ids < 0).any():
            raise ValueError("the model has no byte pieces")
        children: list[dict[int, int]] = [{}]
        owner = [-1]
        for word, (i, _) in words.items():
            state = 0
            for b in word:
                nxt = children[state].get(b)
                if nxt is None:
                    nxt = children[state][b] = len(children)
                    children.append({})
                    owner.append(-1)
                state = nxt
            owner[state] = i
        n = len(children)
        step, fail, depth = np.zeros((n, 256), np.int32), np.zeros(n, np.int64), np.zeros(n, np.int64)
        piece = np.array(owner)
        output, link = np.zeros(n, np.int64), np.zeros(n, np.int64)
        level = [0]
        while level:
            above = []
            for s in level:
                if s:
                    step[s] = step[fail[s]]
                    link[s] = output[fail[s]]
                    output[s] = s if piece[s] >= 0 else link[s]
                for b, c in children[s].items():
                    fail[c] = step[s, b] if s else 0
                    step[s, b] = c
                    depth[c] = depth[s] + 1
                    above.append(c)
            level = above
        score = np.array([words[surface[i]][1] if i >= 0 else 0.0 for i in owner], np.float64)
        sizes = np.array([len(x) for x in surface])
        return cls(
            step, output, link, depth, piece, score, byte_ids, float(min(s for _, s in words.values())) - 10, np.frombuffer(b"".join(surface), np.uint8),
            np.concatenate([[0], np.cumsum(sizes)]), all(b" " not in w.lstrip(b" ") for w in words), prefix,
        )

    def _forward(self, data: np.ndarray, start: np.ndarray, size: np.ndarray, given: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best scores and back pointers of the size + 1 positions of every span, and where each span's begin; sizes fall.

        given: the scores of the first positions, of a single span.
        """
        at = np.concatenate([[0], np.cumsum(size + 1)])
        score = np.full(at[-1], -np.inf)
        back = np.zeros(at[-1], np.int32)  # state of the last piece; -n: a character of n bytes as bytes
        at = at[:-1]
        score[at] = 0
        known = 0
        if given is not None:
            known = len(given) - 1
            score[: known + 1] = given
        state = np.zeros(len(size), np.int32)
        longest = int(size[0]) if len(size) else 0
        active_at = np.searchsorted(-size, -np.arange(longest), "left")  # spans longer than t
        char = np.zeros(len(size), np.int64)  # bytes of the character so far
        for t in range(longest):
            k = active_at[t]
            byte = data[start[:k] + t]
            state = self.step[state[:k], byte]
            char = np.where((byte & 0xC0) == 0x80, char[:k] + 1, 1)
            if t < known:
                continue
            here = at[:k] + t + 1
            last = start[:k] + t + 1
            done = (t + 1 == size[:k]) | ((data[np.minimum(last, len(data) - 1)] & 0xC0) != 0x80)
            top = np.where(done, score[np.maximum(here - char, at[:k])] + self.fallback, -np.inf)
            who = (-np.minimum(char, t + 1)).astype(np.int32)
            out = self.output[state]
            lane = np.flatnonzero(out)
            out = out[lane]
            while len(lane):
                value = score[here[lane] - self.length[out]] + self.score[out]
                better = value > top[lane]
                top[lane[better]] = value[better]
                who[lane[better]] = out[better]
                out = self.link[out]
                more = out > 0
                lane, out = lane[more], out[more]
            score[here] = top
            back[here] = who
        return score, back, at

    def _lanes(self, data: np.ndarray, start: int, end: int) -> list[tuple[int, int, int]]:
        """(first byte read, border, end) of the lanes of a long chunk; they begin with characters."""
        cuts = [start]
        for x in range(start + LANE, end - LANE + 1, LANE):
            while x < end and data[x] & 0xC0 == 0x80:
                x += 1
            if x > cuts[-1] and x < end:
                cuts.append(x)
        lanes = []
        for k, x in enumerate(cuts):
            first = max(start, x - WARM)
            while first > start and data[first] & 0xC0 == 0x80:
                first -= 1
            lanes.append((first, x, cuts[k + 1] if k + 1 < len(cuts) else end))
        return lanes

    def _long(self, data: np.ndarray, lanes: list[tuple[int, int, int]], scores: list[np.ndarray], backs: list[np.ndarray]) -> tuple[np.ndarray, float]:
        """Ids and score of the best path of a long chunk from its lanes."""
        start, end = lanes[0][0], lanes[-1][2]
        reach = int(max(self.length.max(), 4))
        back = np.zeros(end - start + 1, np.int32)
        kept: dict[bytes, tuple[np.ndarray, np.ndarray]] = {}
        before = np.zeros(0)  # true scores, less a constant, of the positions up to the border
        for (first, border, to), score, pointers in zip(lanes, scores, backs, strict=True):
            if border > start:
                tail = before[-min(reach, len(before) - 1) - 1 :]
                own = score[: border - first + 1][-len(tail) :]
                if len(own) < len(tail) or not np.array_equal(own - own[-1], tail - tail[-1]):
                    first = border - len(tail) + 1
                    relative = tail - tail[-1]
                    key = relative.tobytes() + data[first : to + 1].tobytes()
                    if key not in kept:
                        kept[key] = self._forward(data, np.array([first]), np.array([to - first]), relative)[:2]
                    score, pointers = kept[key]
            back[border - start + 1 : to - start + 1] = pointers[border - first + 1 :]
            before = score
        steps, length, piece = back.tolist(), self.length.tolist(), self.piece.tolist()
        raw, ids, at, total = data[start:end].tobytes(), [], end - start, 0.0
        points, byte_ids = self.score.tolist(), self.byte_ids.tolist()
        while at:
            who = steps[at]
            if who > 0:
                ids.append(piece[who])
                total += points[who]
                at -= length[who]
            else:
                ids += [byte_ids[b] for b in raw[at + who : at][::-1]]
                total += self.fallback
                at += who
        return np.array(ids[::-1], np.int64), total

    def best(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the best path of every span end to end, their number by span, and the spans' scores."""
        whole = np.flatnonzero(ends - starts <= LONG)
        lanes = {int(i): self._lanes(data, int(starts[i]), int(ends[i])) for i in np.flatnonzero(ends - starts > LONG)}
        flat = [x for own in lanes.values() for x in own]
        start = np.concatenate([starts[whole], np.array([x[0] for x in flat], np.int64)])
        size = np.concatenate([ends[whole] - starts[whole], np.array([x[2] - x[0] for x in flat], np.int64)])
        order = np.argsort(-size, kind="stable")
        start, size = start[order], size[order]
        score, back, at = self._forward(data, start, size)
        spans, places, ids = [], [], []
        of = np.concatenate([whole, np.full(len(flat), -1)])[order]
        lane = np.flatnonzero((size > 0) & (of >= 0))
        left = size[lane].copy()
        while len(lane):
            who = back[at[lane] + left].astype(np.int64)
            plain = who > 0
            spans.append(lane[plain])
            places.append(left[plain])
            ids.append(self.piece[who[plain]])
            for n in range(1, int((-who).max(initial=0)) + 1):  # bytes of fallen-back characters
                some = -who >= n
                spans.append(lane[some])
                places.append(left[some] + who[some] + n)
                ids.append(self.byte_ids[data[start[lane[some]] + left[some] + who[some] + n - 1]])
            left = left - np.where(plain, self.length[np.maximum(who, 0)], -who)
            keep = left > 0
            lane, left = lane[keep], left[keep]
        by_span = np.empty(len(starts))
        by_span[of[of >= 0]] = score[at + size][of >= 0]
        span = of[np.concatenate(spans)] if spans else np.zeros(0, np.int64)
        place, found = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (places, ids))
        if lanes:
            where = np.empty(len(order), np.int64)
            where[order] = np.arange(len(order))
            k = len(whole)
            for i, own in lanes.items():
                cut = [slice(at[j], at[j] + size[j] + 1) for j in where[k : k + len(own)]]
                k += len(own)
                long_ids, by_span[i] = self._long(data, own, [score[c] for c in cut], [back[c] for c in cut])
                span = np.concatenate([span, np.full(len(long_ids), i)])
                place, found = np.concatenate([place, np.arange(len(long_ids))]), np.concatenate([found, long_ids])
        sort = np.lexsort((place, span))
        return found[sort], np.bincount(span, minlength=len(starts)), by_span

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts end to end, each text's bounds, and its score."""
        size = np.diff(offsets)
        if self.prefix:
            full = np.flatnonzero(size)
            data = np.insert(data, offsets[:-1][full], 32)
            size = size + (size > 0)
            offsets = np.concatenate([[0], np.cumsum(size)])
        if not len(data):
            return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64), np.zeros(len(size))
        cut = np.zeros(len(data), bool)
        if self.chunked:
            cut[1:] = (data[1:] == 32) & (data[:-1] != 32)
        cut[offsets[:-1][size > 0]] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(data))
        only, which = _distinct(data, starts, ends)
        ids, count, score = self.best(data, starts[only], ends[only])
        begin = np.concatenate([[0], np.cumsum(count)])[:-1]
        out = ids[_text.spread(begin[which], count[which])]
        chunk_of = np.searchsorted(starts, offsets)
        total = np.concatenate([[0], np.cumsum(count[which])])
        scores = np.concatenate([[0], np.cumsum(score[which])])
        return out, total[chunk_of], scores[chunk_of[1:]] - scores[chunk_of[:-1]]

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all texts end to end and their offsets."""
        n = len(self.surface_at) - 1
        ids = np.where((ids < 0) | (ids >= n), n, ids)
        size = np.append(np.diff(self.surface_at), 0)[ids]
        data = self.surface[_text.spread(self.surface_at[ids], size)]
        offsets = np.concatenate([[0], np.cumsum(size)])[bounds]
        if self.prefix:
            full = np.flatnonzero(np.diff(offsets))
            first = offsets[:-1][full]
            first = first[data[first] == 32]
            data = np.delete(data, first)
            offsets = offsets - np.searchsorted(first, offsets, "left")
        return data, offsets


def _distinct(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One of all equal chunks, and for every chunk which; the chunks tile the data. A chunk whose bytes aren't those of its hash's first one is its own."""
    _, only, which = np.unique(_text.hash_spans(data, starts, ends, fold=False), return_index=True, return_inverse=True)
    size = ends - starts
    first = only[which]
    other = size[first] != size
    differ = np.flatnonzero(data[_text.spread(starts[first], np.where(other, 0, size))] != (data if not other.any() else data[_text.spread(starts, np.where(other, 0, size))]))
    if len(differ):
        bounds = np.cumsum(np.where(other, 0, size))
        other[np.searchsorted(bounds, differ, "right")] = True
    own = np.flatnonzero(other)
    which[own] = len(only) + np.arange(len(own))
    return np.concatenate([only, own]), which


_loaded: dict[bytes, Automaton] = {}


def automaton(raw: bytes) -> Automaton:
    """Built once in every Python process."""
    key = hashlib.sha256(raw).digest()
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Automaton.load(raw)
    return _loaded[key]


def _read(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def _added(df: DataFrame, *fields: T.StructField) -> T.StructType:
    names = {f.name.lower() for f in fields}
    return T.StructType([f for f in df.schema.fields if f.name.lower() not in names] + list(fields))


def _list_array(ids: np.ndarray, bounds: np.ndarray, null: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.astype(np.int32)), mask=pa.array(null))


def encode(df: DataFrame, *, model: str = MODEL, column: str = "text") -> DataFrame:
    """df with ids array<int> and n_tokens long."""
    raw = _read(model)
    schema = _added(df, T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.LongType()))
    kept = schema.names[:-2]
    sent = df.sparkSession.sparkContext.broadcast(raw)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = automaton(sent.value)
        for batch in batches:
            for part in _text.slices(batch, column, SLICE_BYTES):
                texts = part.column(column)
                ids, bounds, _ = own.encode(*_text.utf8(texts))
                null = np.asarray(texts.is_null())
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), _list_array(ids, bounds, null), pa.array(np.diff(bounds))], [*kept, "ids", "n_tokens"])

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, *, model: str = MODEL, column: str = "ids", to: str = "text") -> DataFrame:
    """df with the text of its ids; null ids give null. Bytes that are not UTF-8 are replaced."""
    raw = _read(model)
    schema = _added(df, T.StructField(to, T.StringType()))
    kept = schema.names[:-1]
    sent = df.sparkSession.sparkContext.broadcast(raw)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = automaton(sent.value)
        for batch in batches:
            ids = batch.column(column)
            null = np.asarray(ids.is_null())
            flat = pc.fill_null(ids.flatten().cast(pa.int64()), -1).to_numpy(zero_copy_only=False)
            lengths = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            data, offsets = own.decode(flat, np.concatenate([[0], np.cumsum(lengths)]))
            texts = [None if null[d] else data[offsets[d] : offsets[d + 1]].tobytes().decode("utf-8", "replace") for d in range(len(null))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(texts, pa.string())], [*kept, to])

    return df.mapInArrow(run, schema)


def encode_digests(docs: DataFrame, *, model: str = MODEL) -> DataFrame:
    """Encodes and decodes every text: doc_id, n_bytes, n_tokens, n_byte_tokens, score, ids_sha256, decoded_sha256, round_trip.

    ids are hashed as little-endian 32-bit integers, the decoded text as UTF-8.
    """
    raw = _read(model)
    sent = docs.sparkSession.sparkContext.broadcast(raw)
    names = ["doc_id", "n_bytes", "n_tokens", "n_byte_tokens", "score", "ids_sha256", "decoded_sha256", "round_trip"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = automaton(sent.value)
        is_byte = np.zeros(len(own.surface_at) - 1, bool)
        is_byte[own.byte_ids] = True
        for batch in batches:
            for part in _text.slices(batch, most=SLICE_BYTES):
                data, offsets = _text.utf8(part.column("text"))
                ids, bounds, score = own.encode(data, offsets)
                back, back_at = own.decode(ids, bounds)
                n_bytes = np.concatenate([[0], np.cumsum(is_byte[ids])])[bounds]
                flat = ids.astype("<i4").tobytes()
                whole, again = data.tobytes(), back.tobytes()
                ids_sha, text_sha, same = [], [], []
                for d in range(part.num_rows):
                    ids_sha.append(hashlib.sha256(flat[4 * bounds[d] : 4 * bounds[d + 1]]).hexdigest())
                    text = again[back_at[d] : back_at[d + 1]]
                    text_sha.append(hashlib.sha256(text).hexdigest())
                    same.append(text == whole[offsets[d] : offsets[d + 1]])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(x) for x in (np.diff(offsets), np.diff(bounds), np.diff(n_bytes), score, ids_sha, text_sha, same))], names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, n_byte_tokens long, score double, ids_sha256 string, decoded_sha256 string, round_trip boolean")
