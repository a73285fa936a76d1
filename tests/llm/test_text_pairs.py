"""N-gram join, suffix dedup, line dedup and decontamination against brute force."""

import hashlib
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quern.llm import _text, decontaminate, line_dedup, ngram_join, suffix_dedup
from quern.llm._spark import clashes, components, with_node
from tests.llm.conftest import prose


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def shingle_set(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


class Union:
    def __init__(self, n):
        self.p = list(range(n))

    def find(self, x):
        while self.p[x] != x:
            x = self.p[x]
        return x

    def join(self, a, b):
        self.p[self.find(a)] = self.find(b)


def brute_components(rows):
    sets, u = [shingle_set(t) for _, t in rows], Union(len(rows))
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                u.join(a, b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[u.find(k)] = min(least.get(u.find(k), i), i)
    return Counter((i, len(s), least.get(u.find(k), i)) for k, ((i, _), s) in enumerate(zip(rows, sets, strict=True)))


@pytest.mark.parametrize("block", [4_000_000, 150])
def test_ngram_join(docs, texts, block):
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(docs, block_shingles=block).collect())
    assert got == brute_components(texts)


def test_ngram_join_keeps_one_of_each_group(docs, texts):
    kept = ngram_join.keep_representatives(docs)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    assert ids == {i for i, _, c in brute_components(texts) if i is None or i == c}


def _crowd(seed):
    """Texts of shared phrases, which are one candidate group with few links, and near copies of two texts."""
    r = random.Random(seed)
    phrase = lambda n: " ".join(f"w{r.randrange(10**6)}" for _ in range(n))
    pool = [phrase(40) for _ in range(12)]
    rows = [(i, " ".join(r.sample(pool, 3))) for i in range(60)]
    for start, n, edits in ((1000, 90, 1), (2000, 30, 3)):
        base = phrase(80).split(" ")
        for i in range(n):
            rows.append((start + i, " ".join(f"e{r.randrange(10**6)}" if k in r.sample(range(80), edits) else w for k, w in enumerate(base))))
    return rows


@pytest.mark.parametrize("block", [500, 1500, 4000])
def test_large_groups_lose_no_link(spark, block):
    rows = _crowd(block)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(df, block_shingles=block).collect())
    assert got == brute_components(rows)


def test_a_large_group_of_near_copies_costs_its_size(spark, monkeypatch):
    """Copies of one text that link with a few of them are told by the first search, whatever the number of blocks."""
    r = random.Random(9)
    base = [f"w{k}" for k in range(150)]
    rows = [(i, " ".join(f"e{i}" if k == at else w for k, w in enumerate(base))) for i in range(160) for at in [r.randrange(150)]]
    places, stored = [], ngram_join.stored

    def note(df, name):
        out = stored(df, name)
        if name == "ngram-places":
            places.append(out.agg(F.sum("weight")).first()[0] or 0)
        return out

    monkeypatch.setattr(ngram_join, "stored", note)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = ngram_join.jaccard_components(df, block_shingles=2500).collect()
    assert {x.component_id for x in out} == {0}
    assert len(places) == 2 and places[1] == 0 and places[0] < 4 * 160 * 146


def test_trie_finds_what_brute_force_finds():
    r = np.random.default_rng(0)
    for _ in range(30):
        sets = [np.unique(r.integers(0, 30, r.integers(1, 25))) for _ in range(20)]
        sizes = [len(s) + int(r.integers(0, 3)) for s in sets]
        trie = ngram_join.Trie(sets, sizes)
        for s, n in zip(sets, sizes, strict=True):
            want = {k for k, t in enumerate(sets) if 180 * len(np.intersect1d(s, t)) >= 80 * (n + sizes[k])}
            assert set(trie.near(s, n, 80, 100).tolist()) == want


def test_ngram_join_of_nothing(empty):
    assert ngram_join.jaccard_components(empty).count() == 0
    assert ngram_join.keep_representatives(empty).count() == 0


def thue_morse(n, letters="ab"):
    return "".join(letters[i.bit_count() & 1] for i in range(n))


@pytest.mark.parametrize("n", [512, 1024, 4096])
def test_structured_words_are_told_apart(spark, n):
    rows = [(1, thue_morse(n)), (2, thue_morse(n, "ba")), (3, thue_morse(n)), (4, thue_morse(n) * 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(df).collect())
    assert got == brute_components(rows) == Counter([(1, 1, 1), (2, 1, 2), (3, 1, 1), (4, 1, 4)])
    got = suffix_dedup.repeats(df).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == brute_repeats(rows, 200)


def test_words_that_were_searched_for_are_told_apart(spark):
    """Two words that hash alike without a key, alone and within longer texts that differ in nothing else."""
    pair = ["ja6hk753aaaabaaa", "brectah2jymbcxti"]
    data, offsets = _text.utf8(pa.array(pair))
    assert len(set(_text.words(data, offsets)[0].tolist())) == 1
    rows = [(2 * k + i, f"{' '.join('abcdefgh'[:k])} {w} {' '.join('abcdefgh'[:k])}") for k in range(5) for i, w in enumerate(pair)]
    got = ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_components(rows)
    assert all(r.doc_id == r.component_id for r in got)


def test_contents_that_share_a_hash_are_told_apart(spark):
    df = spark.createDataFrame([(1, 7, 1), (2, 7, 2), (3, 8, 1), (4, 7, 1)], "id int, a long, b long")
    nodes = {r.id: r.node for r in with_node(df, clashes(df)).collect()}
    assert nodes[1] == nodes[4] and len(set(nodes.values())) == 3 and nodes[3] == 8
    df = df.where("id <> 2")
    assert {r.id: r.node for r in with_node(df, clashes(df)).collect()} == {1: 7, 3: 8, 4: 7}


def test_unlinked_sets_that_share_shingles_cost_little():
    r = np.random.default_rng(1)
    sets = [np.unique(r.integers(0, 20_000, 100)) for _ in range(4000)]
    began = time.process_time()
    assert ngram_join.link_forest(sets, [len(s) for s in sets], 80, 100) == []
    assert time.process_time() - began < 10


def test_representatives_are_chosen_by_row(spark):
    base, other = prose(31, 60), prose(32, 60)
    rows = [(1, base), (5, base), (5, other), (6, other), (6, other), (None, other), (None, prose(33, 9)), (None, prose(33, 9)), (7, ""), (7, ""), (8, None)]
    kept = ngram_join.keep_representatives(spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id int, text string, _key string"))
    assert kept.columns == ["doc_id", "text", "_key"]
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter([(1, base), (5, other), (None, prose(33, 9)), (7, ""), (7, ""), (8, None)])


def test_components(spark):
    chain = [(i, i + 1) for i in range(50)] + [(200, 201), (201, 200), (7, 7)] + [(1000, 1000 + i) for i in range(1, 40)]
    got = {r.node: r.component for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(51)} | {200: 200, 201: 200} | {1000 + i: 1000 for i in range(40)}


def brute_repeats(rows, length):
    data = [(t or "").encode() for _, t in rows]
    seen = Counter(x[p : p + length] for x in data for p in range(len(x) - length + 1))
    out = []
    for (i, _), x in zip(rows, data, strict=True):
        mask = bytearray(len(x))
        for p in range(len(x) - length + 1):
            if seen[x[p : p + length]] > 1:
                mask[p : p + length] = b"\1" * length
        kept = bytes(c for c, m in zip(x, mask, strict=True) if not m)
        out.append((i, len(x), sum(mask), len(re.findall(b"\1+", bytes(mask))), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("length, gram, split", [(200, 100, 8192), (200, 100, 1), (40, 20, 2)])
def test_suffix_dedup(docs, texts, length, gram, split):
    got = suffix_dedup.repeats(docs, length=length, gram=gram, split=split).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == brute_repeats(texts, length)
    assert all(sum(b - a for a, b in zip(r.removed[::2], r.removed[1::2], strict=True)) == r.n_removed for r in got if r.removed)


def test_suffix_dedup_of_periodic_texts(spark):
    rows = [(1, "a" * 3000), (2, "ab" * 900 + "tail " + "x" * 150), (3, prose(40, 50)), (4, "abc" * 400 + prose(40, 50)), (5, "q" * 199), (6, "q" * 200), (7, ("-" * 90 + "\n") * 30)]
    got = suffix_dedup.repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == brute_repeats(rows, 200)


def test_anchors_of_one_letter_are_few(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 1 << 16)
    assert len(suffix_dedup.anchors(np.full(1 << 19, 97, np.uint8), np.array([0, 1 << 19]))[0]) < 400


def test_suffix_dedup_of_nothing(empty):
    assert suffix_dedup.repeats(empty).count() == 0


def test_suffix_array_and_common_prefixes():
    r = np.random.default_rng(0)
    for _ in range(200):
        text = r.integers(97, 97 + r.integers(1, 4), r.integers(1, 60)).astype(np.uint8)
        order, rank, _ = suffix_dedup.suffix_array(text, 2)
        raw, n = text.tobytes(), len(text)
        assert order.tolist() == sorted(range(n), key=lambda i: raw[i:])
        common = suffix_dedup.kasai(text, order, rank, np.arange(n), 10**6)
        for i in range(n):
            j = order[rank[i] - 1] if rank[i] else n
            e = 0
            while i + e < n and j + e < n and raw[i + e] == raw[j + e]:
                e += 1
            assert common[i] == e


def test_anchors_do_not_depend_on_pieces(monkeypatch):
    data = np.random.default_rng(1).integers(97, 100, 5000).astype(np.uint8)
    offsets = np.array([0, 0, 150, 2600, 5000])
    whole = suffix_dedup.anchors(data, offsets, 60, 30)
    monkeypatch.setattr(suffix_dedup, "PIECE", 400)
    parts = suffix_dedup.anchors(data, offsets, 60, 30)
    key = lambda x: sorted(zip(*(v.tolist() for v in x), strict=True))
    assert key(whole) == key(parts)


BOILER = "this site uses cookies to be useful"


@pytest.fixture(scope="module")
def lined(spark):
    rows = [(i, f"unique words number {i}x in the first line\n{BOILER}\nvisited {i} times by people of town\nshort one\nend of text {i} of {i + 1} and more") for i in range(10)]
    rows += [(50, None), (51, ""), (52, BOILER), (None, BOILER), (53, "a b c d e f g h zap\n" + BOILER + "\n" + BOILER), (9, rows[9][1])]
    return rows, spark.createDataFrame([(i, t, 1, "r", "d") for i, t in rows], "doc_id long, text string, _drop int, _row string, extra string").repartition(3)


def test_line_dedup(lined):
    rows, docs = lined
    out = line_dedup.drop_recurring_lines(docs)
    assert out.columns == docs.columns and out.schema == docs.schema
    got = {(r.doc_id, r.text) for r in out.collect()}
    assert (0, rows[0][1]) in got and (50, None) in got and (51, "") in got and (52, "") in got and (None, "") in got and (53, "a b c d e f g h zap") in got
    # the numbers are variable fields, so each of the other documents' long lines is a recurring template
    assert (3, "") in got
    assert out.count() == len(rows)
    report = {r.doc_id: r for r in line_dedup.line_report(docs).collect()}
    assert (report[3].n_lines, report[3].n_dropped, report[3].kept_sha256) == (5, 5, hashlib.sha256(b"").hexdigest())
    assert (report[50].n_lines, report[50].n_dropped, report[0].n_dropped) == (0, 0, 0)


def test_line_dedup_generalises_words(spark):
    names = ["ann", "bob", "cid", "dee", "eve", "fay", "gus", "hal"]
    rows = [(i, f"the report was written on behalf of {n} for the whole team\nsomething {n} else {i}") for i, n in enumerate(names)]
    rows += [(20 + i, f"the report was {' '.join(n for _ in range(9))}") for i, n in enumerate(names[:2])]
    out = {r.doc_id: r.text for r in line_dedup.drop_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[0] == rows[0][1] and out[5] == "something fay else 5" and out[20] == rows[8][1]


def brute_lines(rows):
    """The rules of the docstring, line by line in plain Python: {(row, line)} that go; rows are distinct."""
    lines = []
    for k, (i, text) in enumerate(rows):
        for j, said in enumerate((text or "").split("\n") if text is not None else []):
            own = tuple(re.findall(r"[^\x20\x09-\x0D]+", said))
            masked = tuple("<*>" if re.search("[0-9]", w) else w for w in own)
            solid = len(own) >= 5 and 10 * sum(w != "<*>" for w in masked) >= 6 * len(own)
            if own:
                lines.append(((i is None, i if i is not None else k, j), (k, j), own, masked, solid))
    gone = set()

    def recurring(group, least):
        if len({x[0][:2] for x in group}) < least:
            return False
        gone.update(x[1] for x in group if x[1] != min(group)[1])
        return True

    by = defaultdict(list)
    for x in lines:
        by[x[3] if x[4] else x[2]].append(x)
    nodes = defaultdict(list)
    for group in by.values():
        if not recurring(group, 6):
            for x in group:
                if x[4]:
                    nodes[len(x[2]), x[3][:3]].append(x)
    same = defaultdict(list)
    for x in lines:
        if len(x[2]) >= 20:
            same[x[2]].append(x)
    for group in same.values():
        recurring(group, 2)
    fixed = 3
    while nodes:
        below = defaultdict(list)
        for name, group in nodes.items():
            if len({x[0][:2] for x in group}) < 6:
                continue
            n = len(group[0][3])
            count = Counter((p, x[3][p]) for x in group for p in range(n))
            firm = {k for k, c in count.items() if c >= 6 and 10 * c >= 6 * len(group)}
            stands = firm and 10 * (len(firm) - fixed) >= 6 * (n - fixed)
            hits = [x for x in group if stands and 10 * sum((p, x[3][p]) in firm for p in range(n)) >= 9 * len(firm)]
            recurring(hits, 6)
            for x in group:
                keys = [(count[p, w], -p, w) for p, w in enumerate(x[3]) if count[p, w] >= 6 and (p, w) not in firm]
                if x not in hits and keys:
                    below[name, max(keys)[1:]].append(x)
        nodes, fixed = below, fixed + 1
    return gone


def kept_by_brute(rows):
    gone = brute_lines(rows)
    return Counter((i, None if t is None else "\n".join(said for j, said in enumerate(t.split("\n")) if (k, j) not in gone)) for k, (i, t) in enumerate(rows))


def line_corpus(seed):
    import random

    r = random.Random(seed)
    pick = lambda: r.choice(["ann", "bob", "cid", "dee", "eve", "7", "x9"])
    made = [
        lambda: f"Click here to read more about {r.choice('abcdefghijkl')} today", lambda: f"Click here to see offers from {r.choice('abcdefghijkl')} now", lambda: f"Click here to {pick()} {pick()} about {pick()} {pick()}",
        lambda: "All rights reserved.", lambda: "Les.", lambda: f"page {r.randint(1, 3)}", lambda: " ".join(str(r.randint(0, 9)) for _ in range(6)), lambda: "  \t ", lambda: "",
        lambda: "a long line " + " ".join(f"w{k}" for k in range(25)) + f" {r.randint(0, 2)}", lambda: prose(r.randint(0, 40), r.randint(1, 30)), lambda: f"the {pick()} of the {pick()} was {pick()} here",
    ]
    rows = {(None if i % 9 == 8 else i // 2, "\n".join(r.choice(made)() for _ in range(r.randint(1, 9)))) for i in range(70)}
    return [*sorted(rows, key=repr), (500, None), (501, "")]


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_line_dedup_against_brute_force(spark, seed):
    rows = line_corpus(seed)
    assert len(brute_lines(rows)) > 50
    out = line_dedup.drop_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert Counter((r.doc_id, r.text) for r in out.collect()) == kept_by_brute(rows)


def test_line_dedup_with_hot_keys(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "HOT_LINES", 3)
    monkeypatch.setattr(line_dedup, "HOT_KEYS", 100)
    test_line_dedup_against_brute_force(spark, 3)


def test_line_dedup_drops_short_lines(spark):
    rows = [(i, f"All rights reserved.\nLes.\n\n{i}\nown{i}") for i in range(6)] + [(9, "Les.")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r.text for r in line_dedup.drop_recurring_lines(df).collect()}
    assert out[0] == rows[0][1] and out[9] == "" and all(out[i] == f"\n{i}\nown{i}" for i in range(1, 6))


def test_line_dedup_keeps_every_template_of_a_leaf(spark):
    said = [f"Click here to read more about {c} today" for c in "abcdefgh"], [f"Click here to see offers from {c} now" for c in "abcdefgh"]
    for used in (said[0], said[1], said[0] + said[1]):
        report = line_dedup.line_report(spark.createDataFrame(list(enumerate(used)), "doc_id long, text string")).collect()
        assert sum(r.n_dropped for r in report) == len(used) // 8 * 7
    df = spark.createDataFrame([(i, f"four tokens in here\nown {i}x") for i in range(500)], "doc_id long, text string")
    assert sum(r.n_dropped for r in line_dedup.line_report(df).collect()) == 499


def test_line_dedup_of_rows_without_ids(spark):
    df = spark.createDataFrame([(None, "a line that all rows have\n" + t) for t in ("one", "two", "three", "four", "five", "six")] + [(None, "twins of one row")] * 20, "doc_id long, text string")
    out = Counter(r.text for r in line_dedup.drop_recurring_lines(df).collect())
    assert out["twins of one row"] == 20 and sum(t.startswith("a line") for t in out) == 1 and sum(out.values()) == 26


def test_line_dedup_drops_long_lines_from_the_second_document_on(spark):
    long = " ".join(f"w{k}" for k in range(25))
    rows = [(1, f"{long}\nshort own line here"), (2, f"{long}\nother"), (3, long.replace("w7", "w8"))]
    out = {r.doc_id: r.text for r in line_dedup.drop_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == {1: rows[0][1], 2: "other", 3: rows[2][1]}


def test_pipeline_drops_long_lines_from_the_second_document_on(spark):
    import corpus_pipeline

    long, short = " ".join(f"w{k}" for k in range(60)), "a line in two documents"
    tail = lambda i: " ".join(f"own{i}x{k}" for k in range(100))
    rows = [(1, f"{long}\n{short}\n{tail(1)}"), (2, f"{tail(2)}\n{long}\n{short}"), (3, f"{long}\n{short}\n{tail(1)}"), (4, long.replace("w7", "w8"))]
    df = spark.createDataFrame([(i, t, len(t)) for i, t in rows], "doc_id long, text string, n_chars long")
    out = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.ngram_stage(spark, df, "").collect()}
    want = {1: rows[0][1], 2: f"{tail(2)}\n{short}", 4: rows[3][1]}
    assert out == {i: (t, len(t)) for i, t in want.items()}


def test_line_dedup_leaves_rare_lines_and_tables_without_rows(docs, empty, texts):
    assert line_dedup.drop_recurring_lines(empty).count() == 0
    few = docs.where("doc_id IN (1, 3, 13, 14)")
    assert {(r.doc_id, r.text) for r in line_dedup.drop_recurring_lines(few).collect()} == {(i, t) for i, t in texts if i in (1, 3, 13, 14)}


def test_line_dedup_is_linear_in_a_long_token(spark):
    df = spark.createDataFrame([(1, "x" * 200_000 + " b c d e f"), (2, "y")], "doc_id long, text string")
    assert line_dedup.drop_recurring_lines(df).count() == 2


@pytest.mark.parametrize("made", [line_dedup.dropped_lines, line_dedup.line_report, line_dedup.drop_recurring_lines, line_dedup.drop_long_repeats])
def test_native_plan(docs, made):
    plan = made(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


@pytest.fixture(scope="module")
def items(spark, texts):
    body = dict(texts)
    long = body[15].split(" ")
    rows = [(1, " ".join(long[4000:4030])), (2, body[14]), (3, "one two"), (4, None), (5, "  "), (6, "not in any text at all here"), (7, " ".join(long[:40] + ["zz"] * 4)), (8, " ".join(long[:20] + ["zz"] * 20)), (None, "a b c d e"), (3, "one two")]
    return rows, spark.createDataFrame([(i, t, "x") for i, t in rows], "item_id long, text string, node string")


@pytest.mark.parametrize("block", [1, 1 << 20])
def test_decontaminate(docs, texts, items, block):
    rows, df = items
    want = Counter()
    for d, t in texts:
        own = shingle_set(t)
        for i, said in rows:
            s = shingle_set(said)
            if s and 100 * len(s & own) >= 80 * len(s):
                want[d, i, len(s), len(s & own)] += 1
    got = decontaminate.contaminated(docs, df, block_bytes=block).collect()
    assert Counter((r.doc_id, r.item_id, r.item_shingles, r.shared_shingles) for r in got) == want
    assert all(r.containment == r.shared_shingles / r.item_shingles for r in got)
    clean = decontaminate.drop_contaminated(docs, df, block_bytes=block)
    assert clean.schema == docs.schema
    bad = defaultdict(int)
    for d, *_ in want:
        bad[d] += 1
    assert {r.text for r in clean.where(F.col("doc_id").isNotNull()).collect()} == {t for d, t in texts if d is not None and d not in bad}


def test_decontaminate_empty_tables(docs, empty, items, spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contaminated(docs, none).count() == 0 and decontaminate.contaminated(empty, items[1]).count() == 0
    assert decontaminate.drop_contaminated(docs, none).count() == docs.count()
