"""Embedding near-dedup by E8 lattice hashing.

In each of several tables a random orthonormal projection takes a unit vector to one or more blocks of
eight dimensions, where it is scaled, shifted and decoded to the nearest point of the lattice E8; the
points of all blocks are its cell. The vector is a member of that cell and of those neighbouring cells (of a
block's 240) that are nearest to it. Vectors of equal label that share a cell are compared by cosine in double
precision; a pair that shares several cells counts in the smallest. Equal vectors of a label are one node with
a multiplicity.

A block divides the share of random pairs that meet by more than ten, so the number of blocks grows with
the logarithm of the number of vectors (settings). The number of tables follows from the chance that two
vectors at the threshold meet in one, which is simulated with fixed seeds, so that MISS of them are lost.

A cell of more than BLOCK nodes is split into blocks, and every two blocks meet in one task, so cells
have no bound on their size. A task compares by matrix products and sends for each node the number of
its links, and a spanning forest of the links; pairs are never sent.

Recall is a matter of these settings; pairs below the threshold are never linked.

Defined results: a vector that is null, empty, zero or holds null or non-finite numbers, or has a null
label, links with nothing: 0 links, its own component, kept. Vectors of different length aren't
compared. Equal rows and repeated ids count as vectors each; a null id is never kept. An empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.llm import _text
from quern.llm._spark import clashes, components, stored, with_node

THRESHOLD = 0.93
SCALE, NEAR = 3.5, 3  # NEAR: neighbours of each block that are tried
PROBES = (2, 8, 20, 40)  # neighbouring cells by number of blocks
FIRST, STEP = 1 << 13, 5  # one block up to FIRST vectors, one more for every 2**STEP times as many
MISS = 5e-4
BLOCK = 2048
TASK_MEMBERS = 40_000


def roots() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    whole = [v for v in itertools.product((-1, 0, 1), repeat=8) if sum(map(abs, v)) == 2]
    half = [v for v in itertools.product((-0.5, 0.5), repeat=8) if sum(x < 0 for x in v) % 2 == 0]
    return np.array(whole + half, np.float64)


def _nearest_d8(x: np.ndarray) -> np.ndarray:
    """The nearest integer points of even sum."""
    out = np.rint(x)
    odd = np.flatnonzero(out.sum(axis=1) % 2)
    error = (x - out)[odd]
    worst = np.abs(error).argmax(axis=1)
    out[odd, worst] += np.where(error[np.arange(len(odd)), worst] >= 0, 1, -1)
    return out


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """E8 is D8 and D8 moved by one half in all coordinates."""
    a, b = _nearest_d8(x), _nearest_d8(x - 0.5) + 0.5
    return np.where((((x - a) ** 2).sum(axis=1) <= ((x - b) ** 2).sum(axis=1))[:, None], a, b)


_ROOTS = roots()
_WEIGHTS = _text.seeded(47, 8)


def cells(unit: np.ndarray, label: np.ndarray, tables: int, probes: int, blocks: int = 1, scale: float = SCALE) -> np.ndarray:
    """(vectors, tables * (1 + probes)) 64-bit keys of the cells that each unit vector is a member of."""
    n, d = unit.shape
    blocks = min(blocks, max(1, d // 8))
    out = []
    for t in range(tables):
        random = np.random.default_rng([t, d, 8 * blocks])
        basis = np.linalg.qr(random.normal(size=(max(d, 8 * blocks), 8 * blocks)))[0][:d]
        y = unit @ basis * scale * math.sqrt(d / 64) + random.uniform(0, 1, 8 * blocks)
        salt = _text.mix(label.astype(np.int64).view(np.uint64) * np.uint64(64) + np.uint64(t) + np.uint64(d << 32))
        key, cost = salt[:, None], np.zeros((n, 1))
        for k in range(blocks):
            part = y[:, 8 * k : 8 * k + 8]
            home = nearest_e8(part)
            farther = 1 - (part - home) @ _ROOTS.T  # half of what the squared distance grows by
            near = np.argsort(farther, axis=1, kind="stable")[:, : max(NEAR, probes if blocks == 1 else 0)]
            points = np.concatenate([home[:, None], home[:, None] + _ROOTS[near]], axis=1)
            hashes = _text.mix((np.rint(2 * points).astype(np.int64).view(np.uint64) * _WEIGHTS).sum(axis=2, dtype=np.uint64) + np.uint64(k))
            key = _text.mix(key[:, :, None] + hashes[:, None, :]).reshape(n, key.shape[1] * hashes.shape[1])
            cost = (cost[:, :, None] + np.concatenate([np.zeros((n, 1)), np.take_along_axis(farther, near, axis=1)], axis=1)[:, None, :]).reshape(key.shape)
            best = np.argsort(cost, axis=1, kind="stable")[:, : probes + 1]
            key, cost = np.take_along_axis(key, best, axis=1), np.take_along_axis(cost, best, axis=1)
        out.append(np.pad(key, ((0, 0), (0, probes + 1 - key.shape[1])), mode="edge").view(np.int64))
    return np.concatenate(out, axis=1) if n else np.zeros((0, tables * (1 + probes)), np.int64)


def chance(d: int, blocks: int, probes: int, threshold: float, scale: float = SCALE, pairs: int = 2000) -> float:
    """The share of random pairs of cosine `threshold` that meet in one table."""
    if d < 2:
        return 1.0
    random = np.random.default_rng([d, blocks, probes])
    a, b = random.normal(size=(2, pairs, d))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    c = min(1.0, max(-1.0, threshold))
    b = c * a + math.sqrt(1 - c * c) * b
    own, other = (cells(x, np.zeros(pairs, np.int64), 1, probes, blocks, scale) for x in (a, b))
    return float((own[:, :, None] == other[:, None, :]).any(axis=(1, 2)).mean())


def settings(n: int, sizes: list[int], threshold: float, scale: float = SCALE) -> tuple[int, int, int]:
    """Blocks, probes and tables for n vectors of these sizes."""
    blocks = 1 + max(0, math.ceil(math.log2(max(n, 1) / FIRST) / STEP))
    probes = PROBES[min(blocks, len(PROBES)) - 1]
    least = min((chance(d, blocks, probes, threshold, scale) for d in sizes), default=1.0)
    return blocks, probes, max(1, math.ceil(math.log(MISS) / math.log(max(1e-9, 1 - least)))) if least > 0 else 1000


VECTORS = "node long, times long, vector binary, keys binary"


def _keyed(tables: int, probes: int, blocks: int, scale: float, dtype: str):
    """Nodes -> their vectors as bytes with the sorted keys of all their cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array(batch.column("size"))
            for d in np.unique(sizes):
                part = batch.filter(pa.array(sizes == d))
                x = np.array(part.column("embedding").flatten(), np.float64).reshape(-1, d)
                unit = x / np.linalg.norm(x, axis=1, keepdims=True)
                keys = np.sort(cells(unit, np.array(part.column("label")), tables, probes, blocks, scale), axis=1)
                yield pa.RecordBatch.from_arrays(
                    [part.column("node"), part.column("times"), pa.array([v.tobytes() for v in x.astype(dtype)]), pa.array([k.tobytes() for k in keys])], ["node", "times", "vector", "keys"]
                )

    return run


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, cell) of every node's distinct cells."""
    for batch in batches:
        lists = [np.unique(np.frombuffer(k, np.int64)) for k in batch.column("keys").to_pylist()]
        node = np.repeat(batch.column("node").to_numpy(), [len(k) for k in lists])
        yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(np.concatenate(lists) if lists else np.zeros(0, np.int64))], ["node", "cell"])


def _forest(near: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of a symmetric boolean adjacency matrix."""
    left = near.any(axis=1)
    edges = []
    while left.any():
        root = int(left.argmax())
        left[root] = False
        front = np.array([root])
        while len(front):
            reach = near[front][:, left]
            where = np.flatnonzero(left)
            hit = reach.any(axis=0)
            edges += [(int(front[k]), int(b)) for k, b in zip(reach[:, hit].argmax(axis=0), where[hit], strict=True)]
            front = where[hit]
            left[front] = False
    return edges


def _met_before(keys: np.ndarray, some: np.ndarray, cell: int) -> np.ndarray:
    """Which of the members share a cell of a smaller key; looked at for `some` members."""
    n = len(keys)
    out = np.zeros((n, n), bool)
    who = np.flatnonzero(some)
    row, at = np.nonzero(keys[who] < cell)
    values, column, count = np.unique(keys[who][row, at], return_inverse=True, return_counts=True)
    row, column = row[count[column] > 1], column[count[column] > 1]
    order = np.argsort(column, kind="stable")
    row, column = row[order], np.unique(column[order], return_inverse=True)[1]
    met = np.zeros((len(who), len(who)), bool)
    width = 4096
    for low in range(0, int(column.max(initial=-1)) + 1, width):
        a, b = np.searchsorted(column, [low, low + width])
        part = np.zeros((len(who), width), np.float32)
        part[row[a:b], column[a:b] - low] = 1
        met |= part @ part.T > 0
    out[np.ix_(who, who)] = met
    return out


LINKS = "node long, links long, a long, b long"


def _compare(threshold: float, dtype: str):
    """Members of cells (or of two blocks of one) -> numbers of links by node, and forest edges."""

    def run(data: pa.Table) -> pa.Table:
        order = ["cell", "i", "j"]
        data = data.sort_by([(c, "ascending") for c in [*order, "node"]])
        node, times, block = (data.column(c).to_numpy() for c in ("node", "times", "block"))
        key = np.stack([data.column(c).to_numpy().astype(np.int64) for c in order])
        starts = np.flatnonzero(np.concatenate([[True], (key[:, 1:] != key[:, :-1]).any(axis=0)])) if len(node) else np.zeros(0, np.int64)
        raw, keys = data.column("vector").to_pylist(), data.column("keys").to_pylist()
        links: dict[int, int] = {}
        edges: list[tuple[int, int]] = []
        for s, e in zip(starts.tolist(), [*starts[1:].tolist(), len(node)], strict=True):
            if e - s < 2:
                continue
            x = np.frombuffer(b"".join(raw[s:e]), dtype).astype(np.float64).reshape(e - s, -1)
            x = x / np.linalg.norm(x, axis=1, keepdims=True)
            near = x @ x.T >= threshold
            np.fill_diagonal(near, False)
            if not near.any():
                continue
            near |= near.T
            edges += [(int(node[s + a]), int(node[s + b])) for a, b in _forest(near.copy())]
            if key[1, s] != key[2, s]:  # pairs inside a block are counted where it meets itself
                near &= block[s:e][:, None] != block[s:e][None, :]
            own = np.frombuffer(b"".join(keys[s:e]), np.int64).reshape(e - s, -1)
            near &= ~_met_before(own, near.any(axis=1), key[0, s])
            total = near @ times[s:e].astype(np.float64)
            for k in np.flatnonzero(total).tolist():
                links[int(node[s + k])] = links.get(int(node[s + k]), 0) + int(total[k])
        n = [*links] + [None] * len(edges)
        return pa.table(
            [pa.array(n, pa.int64()), pa.array([*links.values()] + [None] * len(edges), pa.int64()), pa.array([None] * len(links) + [x[0] for x in edges], pa.int64()), pa.array([None] * len(links) + [x[1] for x in edges], pa.int64())],
            names=["node", "links", "a", "b"],
        )

    return run


def near_duplicates(vectors: DataFrame, *, threshold: float = THRESHOLD, scale: float = SCALE, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id, kept, class_id (smallest vec_id of an equal vector and label) of every row."""
    embedding = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), embedding.alias("embedding"), F.col("label").cast("long").alias("label"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    valid = F.coalesce(F.col("label").isNotNull() & (F.size("embedding") > 0) & finite & F.exists("embedding", lambda x: x != 0), F.lit(False))
    plain = F.transform("embedding", lambda x: x + F.lit(0.0))  # no negative zero
    rows = rows.withColumn("a", F.when(valid, F.xxhash64("label", plain))).withColumn("b", F.when(valid, F.xxhash64(F.lit("again"), "label", plain)))
    rows = with_node(rows, clashes(rows.where("a IS NOT NULL")))
    nodes = rows.where("node IS NOT NULL").groupBy("node").agg(F.first("embedding").alias("embedding"), F.first("label").alias("label"), F.count("*").alias("times"), F.min("vec_id").alias("class_id"))
    nodes = stored(nodes, "embedding-nodes")
    dtype = "<f4" if isinstance(vectors.schema["embedding"].dataType.elementType, T.FloatType) else "<f8"
    n, least_size, most_size = nodes.agg(F.count("*"), F.min(F.size("embedding")), F.max(F.size("embedding"))).first()
    blocks, probes, tables = settings(n, sorted({x for x in (least_size, most_size) if x}), threshold, scale)
    keyed = nodes.select("node", "times", "embedding", "label", F.size("embedding").alias("size")).mapInArrow(_keyed(tables, probes, blocks, scale, dtype), VECTORS)
    keyed = stored(keyed, "embedding-keys")
    members = keyed.select("node", "keys").mapInArrow(_members, "node long, cell long")
    counts = members.groupBy("cell").count().where("count > 1").select("cell", F.ceil(F.col("count") / block).cast("int").alias("blocks"))
    members = members.join(counts, "cell").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    members = members.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")).drop("other", "blocks")
    tasks = max(1, math.ceil(n * tables * (1 + probes) / TASK_MEMBERS))
    members = members.withColumn("task", F.pmod(F.xxhash64("cell", "i", "j"), F.lit(tasks)))
    found = members.join(keyed, "node").groupBy("task").applyInArrow(_compare(threshold, dtype), LINKS)
    found = stored(found, "embedding-links")
    links = found.where("node IS NOT NULL").groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(found.where("a IS NOT NULL").select("a", "b"))
    each = nodes.select("node", "times", "class_id").join(links, "node", "left").join(joined, "node", "left")
    each = each.withColumn("component", F.coalesce("component", "node"))
    least = each.groupBy("component").agg(F.min("class_id").alias("component_id"))
    each = each.join(least, "component").select(F.col("node").alias("key"), (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n_links"), "component_id", "class_id")
    out = rows.select("vec_id", "node").join(each, F.col("node") == F.col("key"), "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"), "class_id")
