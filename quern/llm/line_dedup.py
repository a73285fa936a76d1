"""Line dedup by a log-template tree, in DataFrame functions only.

The tree has fixed depth: a line's number of tokens, then its first LEAD tokens, lead to a leaf. Tokens
that hold a digit are variable fields from the start; lines that are equal up to these fields are one
template. What is left at a leaf is generalised: a place where one token makes up CONSTANT of the lines
is constant, any other a variable field; the template stands if SOLID of the places that the path to it
doesn't fix are constant, and a line belongs to it if MATCH of the constants agree. Lines that belong to
no standing template go on to a child node, chosen by the most frequent of their tokens that isn't a
constant, and so on until nothing is left in MIN_DOCS documents: a leaf has any number of templates, and
one doesn't hide another. A child has less than CONSTANT of its node's lines, so the depth is logarithmic.

A template recurs if its lines lie in MIN_DOCS documents. Lines of LONG_TOKENS tokens that are equal
with all their digits recur from LONG_DOCS documents on. Lines under MIN_TOKENS tokens, and lines of
which too few tokens are free of digits (SOLID), are templates only of lines that are wholly equal to them.
Lines of recurring templates are dropped but for the first (smallest doc_id, null last, then line number).

Lines travel as hashes, a document's text twice, by its row. Counts are aggregated before they are
exchanged; what is known of a key with a large share of all lines is broadcast (at most HOT_KEYS keys
can have such a share), so that no task holds the lines of one key.

Defined results: null text stays null and has no lines; lines without tokens stay; a text whose lines are
all dropped becomes empty; rows that share a doc_id are one document for the counts; rows that are equal
in doc_id and text are one row, and get equal texts; a row with a null doc_id is a document of its own; an
empty table gives an empty result. All columns stay and only text (in line_report: nothing) changes; n_chars
and the like aren't adjusted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm._spark import discard, stored
from quern.types import quoted

LEAD = 3
MIN_TOKENS = 5  # of a template with fields
MIN_DOCS = 6
LONG_TOKENS, LONG_DOCS = 20, 2
CONSTANT, SOLID, MATCH = 6, 6, 9  # tenths
FIELD = "<*>"
HOT_KEYS, HOT_LINES = 1024, 256
_SPACE = " \t\x0b\f\r"


def _masked(line: Column) -> Column:
    """The look-behind keeps the pattern linear in very long tokens."""
    return F.regexp_replace(line, r"(?<!\S)[^\s0-9]*+[0-9]\S*+", FIELD)


def _split(line: Column) -> Column:
    return F.split(F.btrim(line, F.lit(_SPACE)), r"\s+")


def _has_fields(line: Column) -> Column:
    return line.rlike("[0-9]")


def _tokens(line: Column) -> Column:
    return _split(F.when(_has_fields(line), _masked(line)).otherwise(line))


def _described(line: Column) -> Column:
    """Of a line: number of tokens, leaf (null: no fields allowed), hash of its template and of its own tokens.

    The tokens are made once, inside the generator that calls this.
    """

    def tokens(has: Column) -> Column:
        return F.transform(F.array(_split(F.when(has, _masked(line)).otherwise(line))), lambda t: of(has, t, F.when(t[0] == "", 0).otherwise(F.size(t))))[0]

    def of(has: Column, t: Column, n: Column) -> Column:
        solid = (n >= MIN_TOKENS) & (~has | ((F.size(F.filter(t, lambda x: x != FIELD)) * 10) >= n * SOLID))
        return F.transform(F.array(F.struct(n.alias("n"), solid.alias("solid"), F.xxhash64(t).alias("full"), F.when(has, F.xxhash64(_split(line))).alias("own"), F.xxhash64(F.size(t), F.slice(t, 1, LEAD)).alias("leaf"))), whole)[0]

    def whole(d: Column) -> Column:
        own = F.coalesce(d["own"], d["full"])
        return F.struct(d["n"].alias("n"), F.when(d["solid"], d["leaf"]).alias("leaf"), F.when(d["solid"], d["full"]).otherwise(own).alias("full"), F.when(d["n"] >= LONG_TOKENS, own).alias("own"))

    return F.transform(F.array(_has_fields(line)), tokens)[0]


def _row_of(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """_row and _id, which identify a row by its id and text."""
    said = F.col(text).cast("string")
    return [F.xxhash64(F.coalesce(F.col(doc_id).cast("string"), F.lit("-")), F.coalesce(said, F.lit(""))).alias("_row"), F.coalesce(F.col(doc_id).cast("long"), F.lit(-1)).alias("_id")]


def _rows(docs: DataFrame) -> DataFrame:
    """_row, _id, _doc (the document; of null ids the last ones) and _text."""
    row, own = _row_of()
    null = F.lit((1 << 63) - 1) - F.pmod(row, F.lit(1 << 62))
    return docs.select(row, own, F.coalesce(F.col("doc_id").cast("long"), null).alias("_doc"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"))


def _first_and_docs(lines: DataFrame, *keys: str) -> DataFrame:
    """keys, _docs, _lines, and the first line; counted in two steps, so that no group is gathered."""
    by_doc = lines.groupBy(*keys, "_doc").agg(F.min(F.struct("_line", "_row", "_id")).alias("_at"), F.count("*").alias("_lines"))
    by_key = by_doc.groupBy(*keys).agg(F.count("*").alias("_docs"), F.sum("_lines").alias("_lines"), F.min(F.struct("_doc", "_at")).alias("_first"))
    return by_key.select(*keys, "_docs", "_lines", F.col("_first._at").alias("_first"))


def _meet(lines: DataFrame, keys: DataFrame, on: list[str], total: int, how: str = "inner") -> DataFrame:
    """lines (of `total` rows) joined with stored keys, of which those of very many lines (_lines) are broadcast."""
    least = max(HOT_LINES, total // HOT_KEYS)  # so HOT_KEYS at most have as many
    hot = F.broadcast(keys.where(F.col("_lines") >= least))
    usual = lines.join(F.broadcast(hot.select(*on)), on, "left_anti").join(keys.where(F.col("_lines") < least), on, how)
    return lines.join(hot, on).unionByName(usual)


def _later() -> Column:
    return F.struct("_line", "_row", "_id") != F.col("_first")


def dropped_lines(docs: DataFrame, *, min_docs: int = MIN_DOCS, long_docs: int | None = LONG_DOCS) -> DataFrame:
    """(_row, _id, _line) of all lines that go. long_docs None: long lines as others."""
    rows = _rows(docs)
    lines = rows.select("_row", "_id", "_doc", F.posexplode(F.transform(F.split("_text", "\n"), _described)).alias("_line", "_d")).where("_d.n > 0")
    lines = lines.select("_row", "_id", "_doc", "_line", F.col("_d.n").alias("_n"), F.col("_d.leaf").alias("_leaf"), F.col("_d.full").alias("_full"), F.col("_d.own").alias("_own"))
    lines = stored(lines, "lines")
    total = lines.count()
    few = F.lit(False) if long_docs is None else (F.col("_n") >= LONG_TOKENS) & (F.col("_docs") >= long_docs)
    keys = _first_and_docs(lines, "_full", "_n").where((F.col("_docs") >= min_docs) | few)
    keys = stored(keys.drop("_n"), "line-keys")
    marked = stored(_meet(lines, keys, ["_full"], total, "left"), "marked-lines")
    discard(lines)
    gone = [marked.where(F.col("_docs") >= min_docs).where(_later())]
    rest = marked.where(F.col("_docs").isNull() | (F.col("_docs") < min_docs)).drop("_docs", "_lines", "_first")
    if long_docs is not None:
        same = _first_and_docs(marked.where(F.col("_docs") < min_docs).drop("_docs", "_lines", "_first"), "_full", "_own").where(F.col("_docs") >= long_docs)
        gone.append(marked.where(F.col("_docs") < min_docs).drop("_docs", "_lines", "_first").join(same, ["_full", "_own"]).where(_later()))
    gone += _generalised(rows, rest.where("_leaf IS NOT NULL"), total, min_docs)
    out = gone[0].select("_row", "_id", "_line")
    for x in gone[1:]:
        out = out.union(x.select("_row", "_id", "_line"))
    return out


def _generalised(rows: DataFrame, rest: DataFrame, total: int, min_docs: int) -> list[DataFrame]:
    """The lines of generalised templates that go, by depth of the tree."""
    leaves = stored(_first_and_docs(rest, "_leaf").where(F.col("_docs") >= min_docs).select("_leaf", "_lines"), "leaves")
    marks = _meet(rest.select("_row", "_id", "_doc", "_line", "_leaf"), leaves, ["_leaf"], total)
    marks = marks.groupBy("_row", "_id").agg(F.min("_doc").alias("_doc"), F.collect_set(F.struct("_line", "_leaf")).alias("_marks"))
    texts = rows.select("_row", "_id", "_text").join(marks, ["_row", "_id"]).withColumn("_all", F.split("_text", "\n"))
    found = texts.select("_row", "_id", "_doc", "_all", F.explode("_marks").alias("_m")).select("_row", "_id", "_doc", "_m._line", F.col("_m._leaf").alias("_node"), _tokens(F.element_at("_all", F.col("_m._line") + 1)).alias("_t"))
    found = found.dropDuplicates(["_row", "_id", "_line"])
    line = ["_row", "_id", "_line"]
    tokens = stored(found.select(*line, "_doc", "_node", F.size("_t").alias("_n"), F.posexplode(F.transform("_t", lambda x: F.xxhash64(x))).alias("_pos", "_token")), "line-tokens")
    gone, fixed = [], LEAD
    while not tokens.isEmpty():
        n_tokens = tokens.count()
        n_lines = tokens.where("_pos = 0").count()
        sizes = tokens.where("_pos = 0").groupBy("_node").agg(F.count("*").alias("_size"))
        counts = tokens.groupBy("_node", "_pos", "_token").agg(F.count("*").alias("_lines")).where(F.col("_lines") >= min_docs)
        constant = F.col("_lines") * 10 >= F.col("_size") * CONSTANT
        counts = stored(counts.join(sizes, "_node").select("_node", "_pos", "_token", "_lines", "_size", constant.alias("_constant")), "token-counts")
        solid = counts.where("_constant").groupBy("_node").agg(F.count("*").alias("_constants"), F.max("_size").alias("_lines"))
        each = _meet(tokens, counts.drop("_size"), ["_node", "_pos", "_token"], n_tokens).groupBy(*line, "_node").agg(
            F.min("_doc").alias("_doc"), F.min("_n").alias("_n"), F.sum(F.col("_constant").cast("int")).alias("_agree"),
            F.max(F.when(~F.col("_constant"), F.struct("_lines", (-F.col("_pos")).alias("_at"), "_token"))).alias("_next"),
        )
        solid = stored(solid, "solid-nodes")
        each = _meet(each, solid, ["_node"], n_lines, "left")
        stands = (F.col("_constants") - fixed) * 10 >= (F.col("_n") - fixed) * SOLID
        each = stored(each.withColumn("_hit", F.coalesce(stands & (F.col("_agree") * 10 >= F.col("_constants") * MATCH), F.lit(False))), "line-nodes")
        hits = each.where("_hit").select(*line, "_doc", "_node")
        recurring = stored(_first_and_docs(hits, "_node").where(F.col("_docs") >= min_docs), "templates")
        gone.append(stored(_meet(hits, recurring, ["_node"], n_lines).where(_later()).select(*line), "general-lines"))
        for read in (counts, solid, recurring):
            discard(read)
        below = each.where("NOT _hit AND _next IS NOT NULL").select(*line, "_doc", F.xxhash64("_node", "_next._at", "_next._token").alias("_node"))
        enough = stored(_first_and_docs(below, "_node").where(F.col("_docs") >= min_docs).select("_node", "_lines"), "children")
        below = _meet(below, enough, ["_node"], n_lines).drop("_lines")
        before, tokens = tokens, stored(tokens.drop("_node", "_doc").join(below, line), "line-tokens")
        for read in (before, each, enough):
            discard(read)
        fixed += 1
    return gone


def repeated_lines(docs: DataFrame, *, least: int = 1, min_docs: int) -> DataFrame:
    """(_row, _id, _line) of all lines of `least` tokens that are equal, digits included, to an earlier one, where they lie in min_docs documents."""
    described = lambda line: F.transform(F.array(_split(line)), lambda t: F.struct(F.when(t[0] == "", 0).otherwise(F.size(t)).alias("n"), F.xxhash64(t).alias("full")))[0]
    lines = _rows(docs).select("_row", "_id", "_doc", F.posexplode(F.transform(F.split("_text", "\n"), described)).alias("_line", "_d")).where(F.col("_d.n") >= least)
    lines = stored(lines.select("_row", "_id", "_doc", "_line", F.col("_d.full").alias("_full")), "same-lines")
    keys = stored(_first_and_docs(lines, "_full").where(F.col("_docs") >= min_docs), "same-keys")
    return _meet(lines, keys, ["_full"], lines.count()).where(_later()).select("_row", "_id", "_line")


def _with_drops(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """_all (the row as a struct, so that no name clashes), _text, _drop (line numbers that go, or null), _kept."""
    drops = dropped.groupBy("_row", "_id").agg(F.collect_set("_line").alias("_drop"))
    packed = docs.select(*_row_of(), F.col("text").cast("string").alias("_text"), F.struct(*(F.col(quoted(c)) for c in docs.columns)).alias("_all"))
    joined = packed.join(drops, ["_row", "_id"], "left")
    stay = F.array_except(F.sequence(F.lit(0), F.size(F.split("_text", "\n")) - 1), "_drop")
    kept = F.transform(F.array(F.split("_text", "\n")), lambda x: F.array_join(F.transform(stay, lambda i: x[i]), "\n"))[0]
    return joined.withColumn("_kept", F.when(F.col("_drop").isNull(), F.col("_text")).otherwise(kept))


def _cut(docs: DataFrame, out: DataFrame) -> DataFrame:
    return out.select(*(F.col("_kept").cast(docs.schema[c].dataType).alias(c) if c.lower() == "text" else F.col("_all")[c].alias(c) for c in docs.columns))


def drop_recurring_lines(docs: DataFrame, **options) -> DataFrame:
    """docs with the recurring lines cut out of text."""
    return _cut(docs, _with_drops(docs, dropped_lines(docs, **options)))


def drop_long_repeats(docs: DataFrame, *, least: int = LONG_TOKENS) -> DataFrame:
    """docs without lines of `least` tokens or more that lie, exactly equal, in two documents or more, but for the first."""
    return _cut(docs, _with_drops(docs, repeated_lines(docs, least=least, min_docs=2)))


def line_report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_bytes, kept_sha256 of every row."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = _with_drops(docs, dropped_lines(docs, **options))
    kept = F.coalesce("_kept", F.lit(""))
    return out.select(
        F.col("_all.doc_id").alias("doc_id"), F.when(F.col("_text").isNull(), 0).otherwise(F.size(F.split("_text", "\n"))).cast("long").alias("n_lines"),
        F.when(F.col("_drop").isNull(), 0).otherwise(F.size("_drop")).cast("long").alias("n_dropped"), F.octet_length(kept).cast("long").alias("kept_bytes"), F.sha2(kept.cast("binary"), 256).alias("kept_sha256"),
    )
