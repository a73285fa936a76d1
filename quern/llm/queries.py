"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import chat_format, decontaminate, embedding_dedup, language_id, line_dedup, lm_score, ngram_join, quality, sentencepiece_codec, suffix_dedup
from quern.llm._spark import remainder, table

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _shingles_sql(relation: str, key: str) -> str:
    """SQL for (key, n, sh): the distinct five-word shingles of each text of a relation."""
    return f"""
      SELECT {key}, CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
             ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) END AS sh
      FROM (SELECT {key}, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                   '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM {relation})"""


OP1_SQL = f"""
WITH RECURSIVE s AS MATERIALIZED ({_shingles_sql("documents", "doc_id")}),
e AS MATERIALIZED (SELECT doc_id, len(sh) AS n, unnest(sh) AS g FROM s),
l AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id
      GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
r AS (SELECT doc_id AS node, doc_id AS reach FROM s UNION SELECT r.node, l.b FROM r JOIN l ON l.a = r.reach)
SELECT s.doc_id, CAST(len(s.sh) AS BIGINT) AS n_shingles, c.component_id
FROM s JOIN (SELECT node, min(reach) AS component_id FROM r GROUP BY node) c ON c.node = s.doc_id
"""


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents")).drop("class_id")


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.encode_digests(table(spark, sf_dir, "documents"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeats(table(spark, sf_dir, "documents"))


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat_format.digests(chat_format.format_conversations(rows.union(more)))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


OP5_SQL = """
WITH RECURSIVE d AS (SELECT doc_id, coalesce(text, '') AS said, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, i, list_filter(regexp_split_to_array(ls[i], '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS r
      FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM d)),
f AS (SELECT *, list_transform(r, lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '<*>' ELSE x END) AS m FROM l WHERE len(r) > 0),
n AS MATERIALIZED (SELECT *, CASE WHEN solid THEN m ELSE r END AS t
      FROM (SELECT *, len(r) >= 5 AND 10 * len(list_filter(m, lambda x: x <> '<*>')) >= 6 * len(r) AS solid FROM f)),
e AS MATERIALIZED (SELECT t, min({'d': doc_id, 'i': i}) AS f FROM n GROUP BY t HAVING count(DISTINCT doc_id) >= 6),
x AS (SELECT n.doc_id, n.i FROM n JOIN e USING (t) WHERE {'d': n.doc_id, 'i': n.i} <> e.f),
u AS MATERIALIZED (SELECT r, min({'d': doc_id, 'i': i}) AS f FROM n WHERE len(r) >= 20 GROUP BY r HAVING count(DISTINCT doc_id) >= 2),
y AS (SELECT n.doc_id, n.i FROM n JOIN u USING (r) WHERE {'d': n.doc_id, 'i': n.i} <> u.f),
w AS (
  SELECT doc_id, i, m, [CAST(len(m) AS VARCHAR)] || m[1:3] AS node, 3 AS fixed, false AS hit FROM n WHERE solid AND t NOT IN (SELECT t FROM e)
  UNION ALL
  SELECT doc_id, i, m, CASE WHEN hits THEN node ELSE node || [best.t || ' ' || best.p] END, fixed + 1, hits FROM (
    SELECT doc_id, i, m, node, fixed, best, coalesce(10 * (k - fixed) >= 6 * (len(m) - fixed) AND 10 * agree >= 9 * k, false) AS hits FROM (
      SELECT doc_id, i, m, node, fixed, max(k) AS k, count(*) FILTER (firm) AS agree, max({'c': c, 'p': -p, 't': tok}) FILTER (c >= 6 AND NOT firm) AS best FROM (
        SELECT *, count(DISTINCT CASE WHEN firm THEN p END) OVER (PARTITION BY node) AS k FROM (
          SELECT *, c >= 6 AND 10 * c >= 6 * size AS firm FROM (
            SELECT *, count(*) OVER (PARTITION BY node, p, tok) AS c, count(*) OVER (PARTITION BY node, p) AS size FROM (
              SELECT *, unnest(range(1, len(m) + 1)) AS p, unnest(m) AS tok FROM (
                SELECT *, count(DISTINCT doc_id) OVER (PARTITION BY node) AS docs FROM w WHERE NOT hit) WHERE docs >= 6))))
      GROUP BY doc_id, i, m, node, fixed)) WHERE hits OR best IS NOT NULL
),
g AS MATERIALIZED (SELECT doc_id, i, node FROM w WHERE hit),
h AS (SELECT node, min({'d': doc_id, 'i': i}) AS f FROM g GROUP BY node HAVING count(DISTINCT doc_id) >= 6),
b AS (SELECT doc_id, list(i) AS drops FROM (SELECT * FROM x UNION SELECT * FROM y UNION SELECT g.doc_id, g.i FROM g JOIN h USING (node) WHERE {'d': g.doc_id, 'i': g.i} <> h.f) GROUP BY doc_id),
o AS (SELECT d.doc_id, len(d.ls) AS n_lines, coalesce(len(b.drops), 0) AS n_dropped, CASE WHEN b.drops IS NULL THEN d.said
      ELSE array_to_string(list_transform(list_filter(range(1, len(d.ls) + 1), lambda j: NOT list_contains(b.drops, j)), lambda j: d.ls[j]), chr(10)) END AS kept
      FROM d LEFT JOIN b USING (doc_id))
SELECT doc_id, n_lines, CAST(n_dropped AS BIGINT) AS n_dropped, CAST(strlen(kept) AS BIGINT) AS kept_bytes, sha256(kept) AS kept_sha256 FROM o
"""


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings")).drop("class_id")


OP6_SQL = """
WITH RECURSIVE v AS MATERIALIZED (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
l AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
      AND list_cosine_similarity(a.e, b.e) >= 0.93),
r AS (SELECT vec_id AS node, vec_id AS reach FROM v UNION SELECT r.node, l.b FROM r JOIN l ON l.a = r.reach),
c AS (SELECT node, min(reach) AS component_id FROM r GROUP BY node)
SELECT v.vec_id, (SELECT count(*) FROM l WHERE l.a = v.vec_id) AS n_links, c.component_id, v.vec_id = c.component_id AS kept
FROM v JOIN c ON c.node = v.vec_id
"""


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = remainder(F.col("doc_id"), 4) == 2
    model = quality.fit(docs, labels.where(~out))
    return quality.predict(docs, model, held_out=out)


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = F.coalesce(remainder(F.col("doc_id"), 7) == 2, F.lit(False))
    return lm_score.score(docs, lm_score.fit(docs.where(~out), seat_all=True), held_out=out, trained=True)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(False))
    return language_id.predict(docs, language_id.fit(docs.where(~out)), held_out=out)


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP10_SQL = f"""
WITH d AS MATERIALIZED (SELECT doc_id, unnest(sh) AS g FROM ({_shingles_sql("documents", "doc_id")})),
i AS MATERIALIZED (SELECT item_id, len(sh) AS n, unnest(sh) AS g FROM ({_shingles_sql("benchmark", "item_id")}))
SELECT d.doc_id, i.item_id, CAST(i.n AS BIGINT) AS item_shingles, count(*) AS shared_shingles, count(*) / CAST(i.n AS DOUBLE) AS containment
FROM d JOIN i ON d.g = i.g GROUP BY d.doc_id, i.item_id, i.n HAVING 100 * count(*) >= 80 * i.n
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_ngram_join, op2_sentencepiece, op3_suffix_dedup, op4_chat_format, op5_line_dedup, op6_embedding_dedup, op7_quality, op8_lm_score, op9_language_id, op10_decontaminate)}


def oracle_sql() -> dict[str, str]:
    return {"op1_ngram_join": OP1_SQL, "op5_line_dedup": OP5_SQL, "op6_embedding_dedup": OP6_SQL, "op10_decontaminate": OP10_SQL}
