"""The queries through the catalogue: against their SQL, brute force and their own restatements on whole tables."""

import hashlib
import json
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__
from quern.llm import _text, language_id, quality, queries, sentencepiece_codec
from tests.llm.conftest import prose
from tests.llm.test_models_and_codecs import toks
from tests.llm.test_text_pairs import brute_repeats, shingle_set

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def base():
    con = duckdb.connect()
    for name in ("documents", "embeddings", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


@pytest.fixture(scope="module")
def documents(base):
    return base.execute("SELECT doc_id, text FROM documents").fetchall()


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_queries_agree_with_their_sql(spark, base, name):
    got = __spark_entry__.queries()[name](spark, SF)
    want = base.execute(__spark_entry__.oracle_sql()[name])
    columns = sorted(got.columns)
    names = [x[0] for x in want.description]
    assert sorted(names) == columns
    plain = lambda x: round(x, 9) if isinstance(x, float) else x
    assert Counter(tuple(plain(x) for x in r) for r in got.select(*columns).collect()) == Counter(tuple(plain(r[names.index(c)]) for c in columns) for r in want.fetchall())


def test_op2_against_the_library(spark, documents):
    """Decoding by the library's own decoder gives the texts; ids are a path of the greatest score, text by text."""
    import sentencepiece

    got = {r.doc_id: r for r in queries.op2_sentencepiece(spark, SF).collect()}
    assert len(got) == len(documents) and all(r.round_trip for r in got.values())
    library = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_codec.MODEL)
    auto = sentencepiece_codec.automaton(sentencepiece_codec._read(sentencepiece_codec.MODEL))
    for i, text in documents[:60]:
        ids = auto.encode(*_text.utf8(pa.array([text or ""])))[0].tolist()
        assert library.decode(ids) == (text or "")
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<i4").tobytes()).hexdigest() and got[i].n_tokens == len(ids)


def test_sentencepiece_lanes_change_nothing(monkeypatch):
    auto = sentencepiece_codec.automaton(sentencepiece_codec._read(sentencepiece_codec.MODEL))
    kana = "".join(chr(0x3041 + (i * i + i // 7) % 80) for i in range(2500))
    texts = ["".join("ab"[i.bit_count() & 1] for i in range(5000)), "x" * 6000, kana, "日本" * 900 + "\U0001f642" * 700, "é" * 2500, prose(1, 50).replace(" ", "") * 9, "a b" + "c" * 3000]
    columns = _text.utf8(pa.array(texts))
    lanes = auto.encode(*columns)
    monkeypatch.setattr(sentencepiece_codec, "LONG", 1 << 40)
    for a, b in zip(lanes, auto.encode(*columns), strict=True):
        assert np.array_equal(a, b)
    back, bounds = auto.decode(*lanes[:2])
    assert [back[a:b].tobytes().decode() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == texts


def test_decoding_of_ids_that_are_none(spark):
    df = spark.createDataFrame([(1, [None, 10**9, -5]), (2, []), (3, None)], "doc_id long, ids array<int>")
    assert {r.doc_id: r.text for r in sentencepiece_codec.decode(df).collect()} == {1: "", 2: "", 3: None}


def test_chunks_of_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(_text, "hash_spans", lambda data, starts, ends, fold=True: np.zeros(len(starts), np.uint64))
    data, starts = np.frombuffer(b"one two one six", np.uint8), np.array([0, 3, 7, 11])
    only, which = sentencepiece_codec._distinct(data, starts, np.array([3, 7, 11, 15]))
    said = [data[a:b].tobytes() for a, b in ((0, 3), (3, 7), (7, 11), (11, 15))]
    assert [said[only[k]] for k in which] == said


def test_op3_on_a_whole_table(spark, documents):
    got = queries.op3_suffix_dedup(spark, SF).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == brute_repeats(documents, 200)


def test_op4_on_a_whole_table(spark, base):
    """Against digests of the rows themselves; the output's length by a renderer of its own."""
    rows = base.execute("SELECT conv_id, turn, role, text FROM conversations").fetchall()
    rows += [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    turns = defaultdict(list)
    for c, t, role, text in sorted(rows, key=lambda r: (r[0], r[1], r[2] or "", r[3] or "")):
        turns[c].append((role or "", text or ""))
    got = {r.conv_id: r for r in queries.op4_chat_format(spark, SF).collect()}
    assert set(got) == set(turns)
    for c, own in turns.items():
        whole = "".join(f"{role}\n{text}\n" for role, text in own)
        loss = "".join(text for role, text in own if role == "assistant")
        r = got[c]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (len(own), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
        controls = sum(len(re.findall(r"[<\[]\\*/?(?:s>|INST\]|ROLE\])", text)) for _, text in own)
        frame = sum({"user": 22, "assistant": 7}.get(role, 20 + len(role)) for role, _ in own)
        assert r.formatted_chars == frame + controls + sum(len(text) for _, text in own)


def test_op7_against_a_plain_scorer(spark, base, documents):
    """Each document alone, table by table, gives the score of the vectorised query; held-out accuracy is high."""
    from quern.llm._spark import remainder, table
    from pyspark.sql import functions as F

    got = {r.doc_id: r for r in queries.op7_quality(spark, SF).collect()}
    labels = dict(base.execute("SELECT doc_id, quality FROM labels").fetchall())
    model = quality.fit(table(spark, SF, "documents"), table(spark, SF, "labels").where(remainder(F.col("doc_id"), 4) != 2))
    count = lambda cut, x: sum(c <= x for c in cut)
    for i, text in documents:
        x = np.asarray(quality.features(pa.array([text], pa.string())))[0].tolist()
        f = model.bias + sum(t[count(cut, v)] for cut, t, v in zip(model.cuts, model.tables, x, strict=True))
        f += sum(t[count(model.pair_cuts[a], x[a]), count(model.pair_cuts[b], x[b])] for a, b, t in model.pairs)
        assert got[i].score == pytest.approx(1 / (1 + math.exp(-f)), abs=1e-9) and got[i].predicted == (got[i].score >= 0.7)
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
    held = [i for i in labels if i in got and got[i].held_out]
    assert sum((got[i].score >= 0.5) == labels[i] for i in held) >= 0.9 * len(held)


def test_op8_learns_from_its_folds_alone(spark, documents):
    got = queries.op8_lm_score(spark, SF).collect()
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in documents}
    count = Counter(w for i, t in documents if not held[i] for w in toks(t))
    n, v, text = sum(count.values()), len(count), dict(documents)
    for r in got:
        own = toks(text[r.doc_id])
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(own), sum(count[w] > 0 for w in own), n)
        assert r.base_score == pytest.approx(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in own), rel=1e-9)
    assert sum(r.score for r in got if r.held_out) > sum(r.base_score for r in got if r.held_out)


def test_op9_against_a_plain_scorer(spark, base, documents):
    """Popcounts language by language and n-gram by n-gram give the query's languages; held-out accuracy is high."""
    from quern.llm._spark import remainder, table
    from pyspark.sql import functions as F

    got = {r.doc_id: r for r in queries.op9_language_id(spark, SF).collect()}
    truth = dict(base.execute("SELECT doc_id, lang FROM documents").fetchall())
    filters = language_id.fit(table(spark, SF, "documents").where(~F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(False))))
    for i, text in documents[:80]:
        codes, _ = language_id.grams(*_text.utf8(pa.array([text or ""])))
        cells = [language_id._cells(codes, p).tolist() for p in range(language_id.PROBES)]
        counts = []
        for k in range(len(filters.languages)):
            hits = sum(all(int(filters.slices[k // 64, c]) >> (k % 64) & 1 for c in own) for own in zip(*cells, strict=True))
            f = float(filters.false_positive[k])
            counts.append(max(0.0, (hits - f * len(codes)) / (1 - f)))
        best = filters.languages[int(np.argmax(counts))] if any(c.isalpha() for c in text or "") else "und"
        assert got[i].lang_pred == best and 0 <= got[i].score <= 1
    held = [i for i, lang in truth.items() if lang is not None and got[i].held_out and got[i].lang_pred != "und"]
    assert sum(got[i].lang_pred == truth[i] for i in held) >= 0.9 * len(held)


def test_very_long_texts_and_templated_items(spark):
    """Decontamination of a long document against items that share most shingles, with hits expanded a few at a time."""
    from quern.llm import decontaminate

    lead = prose(60, 40)
    items = [(i, f"{lead} item{i} {prose(61 + i, 4)}") for i in range(60)]
    texts = [(1, prose(59, 30_000) + " " + items[7][1]), (2, lead), (3, None), (4, items[3][1])]
    want = {(d, i) for d, t in texts for i, s in items if 100 * len(shingle_set(s) & shingle_set(t)) >= 80 * len(shingle_set(s))}
    df, of = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    before, decontaminate.EXPAND = decontaminate.EXPAND, 7
    try:
        block = decontaminate.ItemBlock([i for i, _ in items], [s for _, s in items], 5, 80, 100)
        rows, hits, _ = block.matches(*_text.shingles(*_text.words(*_text.utf8(pa.array([t for _, t in texts], pa.string())))))
    finally:
        decontaminate.EXPAND = before
    assert {(texts[r][0], items[h][0]) for r, h in zip(rows.tolist(), hits.tolist(), strict=True)} == want
    assert {(r.doc_id, r.item_id) for r in decontaminate.contaminated(df, of).collect()} == want


SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, _had boolean, _row string, node long, text_key long"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory, documents):
    """A folder of tables: nulls, empty texts, ties, repeated rows and ids, names that stages use themselves."""
    folder = str(tmp_path_factory.mktemp("corpus"))
    good = [t for _, t in documents if t and len(t) > 400][:40]
    rows = [(i, t) for i, t in enumerate(good)]
    rows += [(100, good[0]), (101, good[1]), (0, good[0]), (1, good[2]), (None, good[3]), (None, prose(9, 200)), (102, None), (103, ""), (103, ""), (104, "  \n "), (105, good[4] + " more words at the end")]
    spark.createDataFrame([(i, t, "en", "s", len(t) if t is not None else None, True, "r", 1, 2) for i, t in rows], SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, " ".join(good[5].split()[:30])), (None, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, rows, good


def test_stages_of_the_pipeline(spark, corpus):
    import corpus_pipeline

    folder, rows, good = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema], name
        assert out.count() <= len(rows)
    kept = Counter((r.doc_id, r.text) for r in dict(corpus_pipeline.STAGES)["n-gram Jaccard join"](spark, docs, folder).collect())
    texts = Counter(t for _, t in kept.elements() if t)
    assert texts[good[0]] == texts[good[1]] == texts[good[2]] == texts[good[3]] == 1 and (0, good[0]) in kept and (3, good[3]) in kept
    assert not any(t == good[4] + " more words at the end" for t in texts) and kept[103, ""] == 2 and kept[102, None] == 1
    clean = dict(corpus_pipeline.STAGES)["benchmark decontamination"](spark, docs, folder)
    assert Counter(r.text for r in clean.collect()) == Counter(t for _, t in rows if t != good[5])
    coded = dict(corpus_pipeline.STAGES)["SentencePiece encoding and decoding"](spark, docs, folder)
    assert coded.columns == ["doc_id", "ids", "n_tokens", "n_bytes"] and coded.count() == len(rows)
    back = sentencepiece_codec.decode(coded.select("doc_id", "ids")).collect()
    assert Counter((r.doc_id, r.text) for r in back) == Counter(rows)


def test_pipeline_on_whole_and_empty_tables(spark, corpus, tmp_path):
    import corpus_pipeline

    folder, rows, _ = corpus
    out = corpus_pipeline.run(spark, folder).collect()
    assert 30 <= len(out) < len(rows) and len({r.doc_id for r in out if r.doc_id is not None}) >= 30
    for name in ("documents", "benchmark", "labels"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    assert json.dumps([name for name, _ in corpus_pipeline.STAGES]).count(",") == 4
