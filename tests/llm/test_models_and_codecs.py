"""SentencePiece, chat formatting, quality, LM scores, language ID and embeddings."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quern.llm import _text, chat_format, embedding_dedup, language_id, lm_score, quality, sentencepiece_codec
from quern.llm._spark import remainder


@pytest.fixture(scope="module")
def automaton():
    with open(sentencepiece_codec.MODEL, "rb") as f:
        return sentencepiece_codec.automaton(f.read())


def brute_best(auto, text):
    """The best total score, by looking every substring up."""
    names = {}
    for state in np.flatnonzero(auto.piece >= 0):
        i = auto.piece[state]
        names[auto.surface[auto.surface_at[i] : auto.surface_at[i + 1]].tobytes().decode()] = auto.score[state]
    text = " " + text if text else text
    best = [0.0] + [-math.inf] * len(text)
    for end in range(1, len(text) + 1):
        best[end] = best[end - 1] + auto.fallback
        for begin in range(max(0, end - 60), end):
            if text[begin:end] in names:
                best[end] = max(best[end], best[begin] + names[text[begin:end]])
    return best[-1]


def test_sentencepiece_score_is_the_best(automaton, texts):
    cases = [t[:250] for _, t in texts if t is not None]
    _, bounds, score = automaton.encode(*_text.utf8(pa.array(cases)))
    assert len(bounds) == len(cases) + 1
    for text, got in zip(cases, score, strict=True):
        assert got == pytest.approx(brute_best(automaton, text), rel=1e-12)


def test_sentencepiece_round_trip(docs, texts):
    coded = sentencepiece_codec.encode(docs)
    assert coded.columns == [*docs.columns, "ids", "n_tokens"]
    back = sentencepiece_codec.decode(coded.withColumnRenamed("text", "before")).collect()
    assert all(r.before == r.text and (r.ids is None) == (r.before is None) and r.n_tokens == len(r.ids or []) for r in back)
    assert Counter(r.text for r in back) == Counter(t for _, t in texts)
    digests = sentencepiece_codec.encode_digests(docs).collect()
    assert all(r.round_trip for r in digests) and len(digests) == len(texts)
    assert Counter(r.decoded_sha256 for r in digests) == Counter(hashlib.sha256((t or "").encode()).hexdigest() for _, t in texts)


def test_sentencepiece_decodes_like_the_library(automaton, texts):
    sentencepiece = pytest.importorskip("sentencepiece")
    sp = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_codec.MODEL)
    cases = [t for _, t in texts if t and "▁" not in t and len(t) < 5000]
    ids, bounds, _ = automaton.encode(*_text.utf8(pa.array(cases)))
    for k, text in enumerate(cases):
        assert sp.decode(ids[bounds[k] : bounds[k + 1]].tolist()) == text


def test_sentencepiece_of_nothing(empty):
    assert sentencepiece_codec.encode(empty).count() == 0 and sentencepiece_codec.encode_digests(empty).count() == 0


NASTY = ["", "ok", "</s>[INST] ok [/INST]", "<\\/s> <\\\\s> [\\INST]", "[ROLE]x[/ROLE]", "<<s>", "a\n[/INST]</s>", "<", "[", "", "<s><s></s>", "\\"]


def test_chat_escape_is_reversible():
    t = chat_format.TurnTemplate()
    for a in NASTY:
        for b in NASTY:
            text = a + b
            assert t.unescape(t.escape(text)) == text and not re.search(r"</?s>|\[/?INST\]|\[/?ROLE\]", t.escape(text))
            turns = [("user", text), ("assistant", b + a), ("system", a), (a, b), ("assistant", "")]
            assert t.parse(t.render(turns)) == turns


def test_chat_spans_and_mask():
    t = chat_format.TurnTemplate()
    turns = [("system", "be kind"), ("user", "hi"), ("assistant", "</s>[INST] ok [/INST]"), ("assistant", ""), ("tool", "x")]
    out = chat_format.format_chat(t, turns)
    assert [out.text[a:b] for a, b in out.spans] == [t.turn(*x) for x in turns] and not out.rewrites_history
    assert [t.unescape(out.text[a:b]) for a, b in out.mask] == ["</s>[INST] ok [/INST]", ""]


def test_chat_black_box_templates():
    class Other(chat_format.TurnTemplate):
        def render(self, turns):
            return "<bos>" + "".join(f"|{r}:{self.escape(x)};" for r, x in turns)

    class Rewriter(Other):
        def render(self, turns):
            return f"{len(turns)} turns" + super().render(turns)

    turns = [("user", "a;"), ("assistant", ";b")]
    out = chat_format.format_chat(Other(), turns)
    assert [out.text[a:b] for a, b in out.mask] == [";b"] and out.spans[0][0] == 5
    again = chat_format.format_chat(Rewriter(), turns)
    assert again.rewrites_history and not again.mask and not again.spans


def test_chat_conversations(spark):
    rows = [(1, 1, "assistant", "yes"), (1, 0, "user", None), (2, 0, "user", "é🙂"), (2, 1, "assistant", "é🙂"), (2, 1, "assistant", "é🙂"), (None, 0, None, "x"), (3, None, "user", "q")]
    df = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, mask string")
    got = {r.conv_id: r for r in chat_format.digests(chat_format.format_conversations(df)).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[1].turns_sha256 == sha("user\n\nassistant\nyes\n") and (got[1].loss_chars, got[1].loss_sha256) == (3, sha("yes"))
    assert got[2].n_turns == 3 and got[2].loss_chars == 4 and got[2].loss_sha256 == sha("é🙂é🙂")
    assert got[None].turns_sha256 == sha("\nx\n") and got[3].loss_sha256 == sha("")
    assert chat_format.digests(chat_format.format_conversations(df.limit(0))).count() == 0


def junk(k):
    return f"BUY!! NOW!! {k} $$$ ### *** " * 5


@pytest.fixture(scope="module")
def labelled(spark, texts):
    from tests.llm.conftest import prose

    rows = [(i, prose(1000 + i, 60) + "." if i % 3 else junk(i)) for i in range(240)]
    docs = spark.createDataFrame([(i, t, "r") for i, t in rows], "doc_id long, text string, label string")
    labels = [(i, int(i % 3 > 0), 0) for i, _ in rows] + [(1, 0, 0), (5, None, 0), (7, 9, 0), (None, 1, 0)]
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_quality_held_out_accuracy(labelled):
    docs, labels = labelled
    out = remainder(F.col("doc_id"), 4) == 2
    model = quality.fit(docs, labels.where(~out))
    rows = quality.predict(docs, model, held_out=out).collect()
    assert len(rows) == 240 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and r.predicted == (r.score >= 0.7) for r in rows)
    held = [r for r in rows if r.held_out]
    assert len(held) > 30 and np.mean([r.predicted == (r.doc_id % 3 > 0) for r in held]) > 0.95
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in rows if r.predicted}


def test_quality_interactions():
    r = np.random.default_rng(0)
    x = r.uniform(0, 1, (4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.AdditiveModel.fit(x, y)
    assert {model.pairs[0][0], model.pairs[0][1]} == {0, 1}
    assert ((model.score(x) > 0.5) == (y == 1)).mean() > 0.95


def test_quality_edge_cases(docs, empty, labelled, texts):
    model = quality.fit(*labelled)
    rows = quality.predict(docs, model).collect()
    assert len(rows) == len(texts) and all(0 <= r.score <= 1 and not r.held_out for r in rows)
    assert quality.predict(empty, model).count() == 0
    assert {r.score for r in quality.predict(docs, quality.fit(empty, labelled[1])).collect()} == {0.5}
    one = quality.fit(labelled[0], labelled[1].where("quality = 1"))
    assert {round(r.score, 3) for r in quality.predict(docs, one).collect()} == {round(one.score(np.zeros((1, 20)))[0], 3)}


def toks(t):
    return re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)})) + [None]


def test_lm_base_score(docs, texts):
    out = F.coalesce(remainder(F.col("doc_id"), 7) == 2, F.lit(False))
    rows, again = (lm_score.score(docs, lm_score.fit(docs.where(~out), n_buckets=5), held_out=out, trained=x).collect() for x in (True, False))
    key = lambda r: (r.doc_id or -1, round(r.score, 3), round(r.base_score, 3))
    assert sorted(map(key, rows)) == sorted(map(key, again))
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    c = Counter(w for i, t in texts if not held(i) for w in toks(t))
    n, v = sum(c.values()), len(c)
    want = Counter((i, held(i), len(toks(t)), sum(c[w] > 0 for w in toks(t)), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in toks(t)), 5)) for i, t in texts)
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in rows) == want
    assert all(math.isfinite(r.score) and r.score < 0 for r in rows)
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_lm_seats_of_a_large_cell():
    """The number of tables of a cell of a million customers is near its expectation."""
    got = lm_score.seat(np.full(50, 1_000_000), np.full(50, 0.01), np.full(50, 1000.0), 0.5, np.random.default_rng(0))
    t = 1.0
    for j in range(1, 1_000_000):
        o = (1 + 0.5 * 1000) * 0.01
        t += o / (j - 0.5 * t + o)
    assert got.mean() == pytest.approx(t, rel=0.1)


def test_lm_learns_from_two_words_before(spark):
    """After "p q" comes "x", after "r q" comes "y"; after "q" alone either."""
    follows = {f"p{i} q{j}": f"w{i + j}" for i in range(9) for j in range(9)}
    train = " ".join(f"{a} {b} the" for a, b in list(follows.items()) * 10)
    rows = [(1, train), (2, "p0 q3 w3"), (3, "p0 q3 w4"), (4, "the q3 w5 the"), (5, "the q3 w88 the")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r.score for r in lm_score.score(df, lm_score.fit(df.where("doc_id = 1"), n_buckets=3)).collect()}
    assert out[2] > out[3] + 1 and out[4] > out[5]


class NaiveModel:
    """The three levels in dictionaries, customers seated one by one; sweeps 0: one table a cell."""

    def __init__(self, texts, sweeps, seed=0):
        import random

        self.rounds, r = [], random.Random(seed)
        triples = Counter(x for t in texts for x in self.grams(t))
        self.levels = [triples, Counter((v, w) for _, v, w in triples), None]
        self.words = {w for _, _, w in triples}
        d = [self.discount(triples), self.discount(self.levels[1])]
        tables = {k: 1 for k in self.levels[1]}
        root, up = {}, None
        for k in range(sweeps + 1):
            if k:  # given the root of the sweep before
                all_ = Counter()
                for (v, _), t in tables.items():
                    all_[v] += t
                tables = {x: self.seated(r, c, up(x[1]), all_[x[0]], d[1]) for x, c in self.levels[1].items()}
            customers = Counter()
            for (_, w), t in tables.items():
                customers[w] += t
            d0 = self.discount(customers)
            base = 1 / (len(self.words) + 1)
            root = {w: self.seated(r, c, base, sum(root.values()), d0) if k else 1 for w, c in customers.items()}
            total, new = 1 + sum(customers.values()), (1 + d0 * sum(root.values())) * base
            up = lambda w, c=customers, t=root, d0=d0, new=new, total=total: (max(c[w] - d0 * t.get(w, 0), 0) + new) / total
            self.rounds.append((up, dict(tables), d))

    @staticmethod
    def grams(text):
        w = [None, None, *toks(text)]
        return list(zip(w, w[1:], w[2:], strict=False))

    @staticmethod
    def discount(cells):
        a, b = (sum(c == i for c in cells.values()) for i in (1, 2))
        return min(0.95, max(0.05, a / (a + 2 * b) if a else 0.5))

    @staticmethod
    def seated(r, customers, parent, tables, d):
        t = 1
        for n in range(1, customers):
            o = (1 + d * tables) * parent
            t += r.random() < o / (n - d * t + o)
        return t

    def sums(self, k):
        _, tables, _ = self.rounds[k]
        found = [Counter(), Counter(), Counter(), Counter()]
        for (u, v, _), c in self.levels[0].items():
            found[0][u, v] += c
            found[1][u, v] += 1
        for (v, w), c in self.levels[1].items():
            found[2][v] += c
            found[3][v] += tables[v, w]
        return found

    def scores(self, texts):
        used = list(range(2, len(self.rounds))) or [len(self.rounds) - 1]
        sums = {k: self.sums(k) for k in used}
        out = []
        for text in texts:
            total = 0.0
            for u, v, w in self.grams(text):
                p = 0.0
                for k in used:
                    up, tables, (d3, d2) = self.rounds[k][0], self.rounds[k][1], self.rounds[k][2]
                    n3, t3, n2, t2 = sums[k]
                    q = (max(self.levels[1][v, w] - d2 * tables.get((v, w), 0), 0) + (1 + d2 * t2[v]) * up(w)) / (1 + n2[v])
                    p += (max(self.levels[0][u, v, w] - d3, 0) + (1 + d3 * t3[u, v]) * q) / (1 + n3[u, v])
                total += math.log10(p / len(used))
            out.append(total)
        return out


@pytest.mark.parametrize("heavy", [65_535, 9])
def test_lm_score_without_sweeps_is_exact(docs, texts, monkeypatch, heavy):
    """With one table a cell in all levels, the scores are those of the formula, at any number of buckets and of heavy words."""
    monkeypatch.setattr(lm_score, "HEAVY", heavy)
    want = NaiveModel([t for i, t in texts if i is None or i % 3 != 1], 0).scores([t for _, t in texts])
    for n in (1, 5):
        model = lm_score.fit(docs.where("coalesce(doc_id % 3, 0) <> 1"), sweeps=0, n_buckets=n)
        got = sorted((r.doc_id or -1, r.score) for r in lm_score.score(docs, model).collect())
        assert [x for _, x in got] == pytest.approx([s for _, s in sorted((i or -1, s) for (i, _), s in zip(texts, want, strict=True))], rel=1e-5, abs=1e-3)


def test_lm_score_agrees_with_a_naive_sampler(spark):
    import random

    r = random.Random(5)
    made = lambda k: " ".join(f"w{min(int(r.paretovariate(0.9)), 40) * (3 if r.random() < 0.2 else 1)}" for _ in range(k))
    rows = [(i, made(60)) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {x.doc_id: x.score for x in lm_score.score(df, lm_score.fit(df.where("doc_id < 40"), sweeps=4, n_buckets=3)).collect()}
    runs = [NaiveModel([t for i, t in rows if i < 40], 4, seed).scores([t for _, t in rows]) for seed in range(5)]
    mean = [sum(x) / len(runs) for x in zip(*runs, strict=True)]
    assert [out[i] for i, _ in rows] == pytest.approx(mean, rel=0.01)
    plain = NaiveModel([t for i, t in rows if i < 40], 0).scores([t for _, t in rows])
    assert sum(abs(out[i] - m) for i, m in enumerate(mean)) < sum(abs(p - m) for p, m in zip(plain, mean, strict=True)) / 3


class NaiveOfAll(NaiveModel):
    """The same with all levels sampled: the customers of two words, then of one, then the root's."""

    def __init__(self, texts, sweeps, seed=0):
        import random

        r = random.Random(seed)
        count = Counter(x for t in texts for x in self.grams(t))
        triples, pairs = dict.fromkeys(count, 1), Counter((v, w) for _, v, w in count)
        tables, root, self.rounds = dict.fromkeys(pairs, 1), {}, []
        high, low = self.discount(count), self.discount(pairs)
        base = 1 / (len({w for _, w in pairs}) + 1)
        below = up = None
        for k in range(sweeps + 1):
            if k:
                old = self.by(triples, 2)
                triples = {x: self.seated(r, c, below(*x[1:]), old[x[:2]], high) for x, c in count.items()}
                pairs, old = Counter(), self.by(tables, 1)
                for (_, v, w), t in triples.items():
                    pairs[v, w] += t
                tables = {x: self.seated(r, c, up(x[1]), old[x[:1]], low) for x, c in pairs.items()}
            customers = Counter()
            for (_, w), t in tables.items():
                customers[w] += t
            d0 = self.discount(customers)
            root = {w: self.seated(r, c, base, sum(root.values()), d0) if k else 1 for w, c in customers.items()}
            total, new = 1 + sum(customers.values()), (1 + d0 * sum(root.values())) * base
            up = lambda w, c=customers, t=root, d0=d0, new=new, total=total: (max(c[w] - d0 * t.get(w, 0), 0) + new) / total
            below = self.level(pairs, tables, low, lambda v, w, up=up: up(w))
            self.rounds.append(self.level(count, triples, high, lambda u, v, w, below=below: below(v, w)))

    @staticmethod
    def by(cells, n):
        out = Counter()
        for x, c in cells.items():
            out[x[:n]] += c
        return out

    def level(self, cells, tables, d, parent):
        n = len(next(iter(cells))) - 1
        of, all_ = self.by(cells, n), self.by(tables, n)
        return lambda *x: (max(cells.get(x, 0) - d * tables.get(x, 0), 0) + (1 + d * all_[x[:n]]) * parent(*x)) / (1 + of[x[:n]])

    def scores(self, texts):
        used = self.rounds[2:] or self.rounds[-1:]
        return [sum(math.log10(sum(p(*x) for p in used) / len(used)) for x in self.grams(t)) for t in texts]


@pytest.mark.parametrize("heavy", [65_535, 25])
def test_lm_score_samples_all_levels(spark, monkeypatch, heavy):
    import random

    monkeypatch.setattr(lm_score, "HEAVY", heavy)
    r = random.Random(5)
    made = lambda k: " ".join(f"w{min(int(r.paretovariate(0.9)), 40) * (3 if r.random() < 0.2 else 1)}" for _ in range(k))
    rows = [(i, made(60)) for i in range(60)]
    df, train = spark.createDataFrame(rows, "doc_id long, text string"), [t for i, t in rows if i < 40]
    out, fewer = ({x.doc_id: x.score for x in lm_score.score(df, lm_score.fit(df.where("doc_id < 40"), sweeps=4, n_buckets=3, **k)).collect()} for k in ({"seat_all": True}, {}))
    runs = [NaiveOfAll(train, 4, seed).scores([t for _, t in rows]) for seed in range(5)]
    mean = [sum(x) / len(runs) for x in zip(*runs, strict=True)]
    off = lambda x: sum(abs(x[i] - m) for i, m in enumerate(mean))
    assert [out[i] for i, _ in rows] == pytest.approx(mean, rel=0.02)
    assert abs(sum(out.values()) / sum(mean) - 1) < 0.003 and off(out) < 1.5 * max(map(off, runs)) and off(out) < off(fewer) / 3


def test_lm_root_is_a_distribution(spark):
    rows = [(i, " ".join(f"w{(i * k) % 23}" for k in range(50))) for i in range(30)]
    model = lm_score.fit(spark.createDataFrame(rows, "doc_id long, text string"), n_buckets=2)
    assert model.v == 24 and all(x.heavy[np.append(model.heavy.heavy[:-1], False)].sum() + x.new == pytest.approx(1) for x in model.history)


def test_lm_splits_frequent_words(docs, texts, monkeypatch):
    monkeypatch.setattr(lm_score, "PART_TOKENS", 40)
    rows = lm_score.score(docs, lm_score.fit(docs, n_buckets=4)).collect()
    assert len(rows) == len(texts) and all(math.isfinite(r.score) and r.score < 0 for r in rows) and sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_lm_without_training(docs, empty, texts):
    rows = lm_score.score(docs, lm_score.fit(empty)).collect()
    assert len(rows) == len(texts) and all(r.train_tokens == 0 and r.n_known == 0 and r.base_score == 0 and r.score == pytest.approx(0) for r in rows)
    assert lm_score.score(empty, lm_score.fit(docs)).count() == 0


@pytest.fixture(scope="module")
def tongues(spark):
    import random

    r = random.Random(3)
    syllables = {"xx": ["tha", "ing", "ow", "er"], "yy": ["schö", "ung", "ich", "zu"], "zz": ["ão", "ez", "ll", "que"]}
    rows = [(i, " ".join("".join(r.choice(syllables[k]) for _ in range(r.randint(1, 4))) for _ in range(r.randint(2, 60))), k) for i, k in enumerate(["xx", "yy", "zz"] * 80)]
    return spark.createDataFrame([(*x, "q") for x in rows], "doc_id long, text string, lang string, score string")


def test_language_held_out_accuracy(tongues):
    out = remainder(F.col("doc_id"), 5) == 0
    rows = language_id.predict(tongues, language_id.fit(tongues.where(~out)), held_out=out).join(tongues.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == 240 and len(held) > 30 and np.mean([r.lang_pred == r.lang for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_edge_cases(spark, tongues, empty):
    filters = language_id.fit(tongues)
    cases = [(1, None), (2, ""), (3, "12 34 !!"), (4, "🙂 。"), (5, "a"), (6, "日本"), (7, "ung ich"), (7, "ung ich"), (None, "thaing ower thaer")]
    got = language_id.predict(spark.createDataFrame(cases, "doc_id long, text string"), filters).collect()
    pred = {r.doc_id: r.lang_pred for r in got}
    assert len(got) == 9 and [pred[i] for i in (1, 2, 3, 4)] == ["und"] * 4 and pred[5] in filters.languages and pred[6] in filters.languages and pred[7] == "yy" and pred[None] == "xx"
    assert language_id.predict(empty, filters).count() == 0
    nothing = language_id.fit(empty)
    assert nothing.languages == [] and {r.lang_pred for r in language_id.predict(tongues, nothing).collect()} == {"und"}


def test_language_filters_return_all_languages():
    r = np.random.default_rng(0)
    members = [np.unique(r.integers(0, 2**32, 3000).astype(np.uint64)) for _ in range(70)]
    f = language_id.Filters.build([f"l{k}" for k in range(70)], members)
    for k in (0, 63, 64, 69):
        assert f.counts(members[k], np.array([0, len(members[k])]))[0, k] == pytest.approx(len(members[k]))
    other = r.integers(2**33, 2**34, 20_000).astype(np.uint64)
    assert f.counts(other, np.array([0, len(other)])).max() < 20


@pytest.mark.parametrize("first", [1 << 13, 8])
def test_embedding_links_against_brute_force(spark, monkeypatch, first):
    monkeypatch.setattr(embedding_dedup, "FIRST", first)
    monkeypatch.setattr(embedding_dedup, "MISS", 1e-9)  # of these few vectors none may be lost
    r = np.random.default_rng(2)
    rows, label = [], []
    for c in range(25):
        centre = r.normal(size=64)
        for _ in range(int(r.integers(1, 9))):
            rows.append((centre + r.normal(size=64) * r.choice([0.1, 0.3, 0.42])).astype(np.float32))
            label.append(c % 3)
    data = [(10 * i, [float(v) for v in x], k) for i, (x, k) in enumerate(zip(rows, label, strict=True))]
    data += [(10_000 + i, data[0][1], data[0][2]) for i in range(5)] + [(10_010, [2 * v for v in data[0][1]], data[0][2])]
    data += [(1, None, 0), (2, [0.0] * 64, 0), (3, [float("nan")] * 64, 0), (4, [None] * 64, 0), (5, data[0][1], None), (6, [], 0), (7, [float("inf")] + [1.0] * 63, 0), (8, [1.0, 2.0], 0), (9, [1.0, 2.0], 0), (9, [1.0, 2.0], 0)]
    df = spark.createDataFrame([(*d, "x") for d in data], "vec_id long, embedding array<float>, label int, node string").repartition(4)
    for block in (2048, 3):
        got = embedding_dedup.near_duplicates(df, block=block).collect()
        assert len(got) == len(data)
        valid = lambda d: d[2] is not None and d[1] and all(v is not None and math.isfinite(v) for v in d[1]) and any(d[1])
        unit = [np.array(d[1]) / np.linalg.norm(d[1]) if valid(d) else None for d in data]
        links = [[j for j in range(len(data)) if j != i and unit[i] is not None and unit[j] is not None and data[i][2] == data[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.93] for i in range(len(data))]
        component = list(range(len(data)))
        for i in range(len(data)):
            seen, todo = {i}, [i]
            while todo:
                for j in links[todo.pop()]:
                    if j not in seen:
                        seen.add(j)
                        todo.append(j)
            component[i] = min(data[j][0] for j in seen)
        want = Counter((d[0], len(x), c, d[0] == c) for d, x, c in zip(data, links, component, strict=True))
        assert Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in got) == want
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def test_e8_decoding():
    r = np.random.default_rng(0)
    x = r.normal(size=(300, 8)) * 2
    home = embedding_dedup.nearest_e8(x)
    assert len(embedding_dedup.roots()) == 240 and np.allclose((embedding_dedup.roots() ** 2).sum(1), 2)
    doubled = np.rint(2 * home).astype(int)
    assert ((doubled % 2 == doubled[:, :1] % 2).all(1)).all() and (np.rint(home.sum(1)) % 2 == 0).all()
    # no neighbour is nearer
    d = ((x - home) ** 2).sum(1)
    assert (((x[:, None] - home[:, None] - embedding_dedup.roots()[None]) ** 2).sum(2) >= d[:, None] - 1e-9).all()


@pytest.mark.parametrize("n", [8_000, 100_000, 400_000, 40_000_000])
def test_embedding_recall_at_the_threshold(n):
    r = np.random.default_rng(1)
    a = r.normal(size=(3000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = r.normal(size=a.shape)
    b -= (b * a).sum(1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    b = 0.93 * a + math.sqrt(1 - 0.93**2) * b
    blocks, probes, tables = embedding_dedup.settings(n, [64], 0.93)
    ka, kb = (embedding_dedup.cells(x, np.zeros(len(x), int), tables, probes, blocks) for x in (a, b))
    assert (ka[:, :, None] == kb[:, None, :]).any((1, 2)).mean() > 0.995


def test_fewer_random_pairs_meet_among_more_vectors():
    r = np.random.default_rng(4)
    x = r.normal(size=(3000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    share = []
    for n in (8_000, 100_000, 400_000):
        blocks, probes, _ = embedding_dedup.settings(n, [64], 0.93)
        keys = embedding_dedup.cells(x, np.zeros(len(x), int), 1, probes, blocks)
        share.append(sum(c * (c - 1) / 2 for c in Counter(k for own in keys.tolist() for k in set(own)).values()) / (3000 * 2999 / 2))
    assert share[0] < 0.06 and share[1] < share[0] / 10 and share[2] < share[1] / 5


def test_pairs_that_met_before():
    r = np.random.default_rng(3)
    for _ in range(20):
        keys = np.sort(r.integers(-5, 30, (12, 4)), axis=1)
        want = np.array([[bool({k for k in a if k < 9} & {k for k in b if k < 9}) for b in keys.tolist()] for a in keys.tolist()])
        got = embedding_dedup._met_before(keys, np.ones(12, bool), 9)
        assert (got == want)[~np.eye(12, dtype=bool)].all()


def test_language_sample_has_every_language(spark, tongues):
    rare = spark.createDataFrame([(10_000 + i, "kwa kwe kwi " * 9, "ww", "q") for i in range(12)], tongues.schema)
    filters = language_id.fit(tongues.union(rare), max_rows=60)
    assert set(filters.languages) == {"xx", "yy", "zz", "ww"}


def test_rows_without_a_conversation_are_conversations(spark):
    df = spark.createDataFrame([(None, 0, "user", "a"), (None, 1, "assistant", "b"), (3, 0, "user", "c")], "conv_id long, turn long, role string, text string")
    got = Counter((r.conv_id, r.n_turns) for r in chat_format.digests(chat_format.format_conversations(df)).collect())
    assert got == Counter({(None, 1): 2, (3, 1): 1})


def test_quality_sample_is_bounded(spark):
    docs = spark.createDataFrame([(1, f"good text number {i} for all") for i in range(300)] + [(2, f"{i} bad bad {i}") for i in range(300)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    model = quality.fit(docs, labels, max_rows=100)
    assert len(quality.predict(docs, model).collect()) == 600
