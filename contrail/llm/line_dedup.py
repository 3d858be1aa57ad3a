"""Operator 7: line dedup by a log-template tree (DataFrame functions only).

Method
------
Lines are parsed by a tree of fixed depth: its levels are the number of tokens and
the first ``DEPTH`` tokens, with tokens that hold a digit read as ``<*>``. A leaf's
template keeps, at each position, a token that most of the leaf's lines hold there
(``<*>``: a number field) and leaves others free. A line follows it if it agrees at
``SIMILAR`` of the fixed tokens and of the number fields, and at two fixed tokens or more (one,
if all else are numbers) that make half of the positions without number fields or more.
The lines that follow none are parsed again as a leaf of their own, and a leaf whose template no
line follows is split by the tokens that recur at one position, until what is left of
a leaf cannot recur. A line that follows none is a template by itself. A template
recurs if ``LEAST`` documents or more hold a line of it. Its lines are dropped from all documents.

Copies of a document are one piece of evidence: documents count by their own text (the
lines that don't recur), and equal own text counts once. Own lines can also be edits of
recurring ones, which are no own text: half or more of a document's own word triples stand in recurring lines, or, if more than ``COPIED`` of its characters are in recurring lines,
between the same neighbours at least as many documents hold as many recurring lines
(``EDITED`` at most). Documents without own text count once for each line that is the
rarest of theirs, so a group of exact or near copies counts about once, however large,
and a page that is mostly one footer counts like any other. A line is dropped
everywhere or nowhere.

Scale: lines travel as hashes; a leaf's documents, tokens and templates are counted
by aggregates with partial sums over distinct lines, so a line in a third of all
documents is one row a task; the tokens of a line travel only if its leaf recurs. Texts are
not shuffled while the distinct lines of such leaves, and the documents that lose
lines, can be broadcast by their counted size, and once or twice beyond it.

Cases: a null text is treated as empty; lines without tokens are kept; a text
that loses all lines becomes empty (the row stays); rows that share ``doc_id`` and text
are judged alike and each stays; a null ``doc_id`` counts as a document of its own
text; other columns pass through; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.llm.common import few, free_name, narrow, written

DEPTH, LEAST, SIMILAR, COPIED, EDITED = 3, 10, 0.7, 0.5, 3


def _tokens(line: Column) -> Column:
    return F.split(F.trim(line, F.lit(" \t\n\v\f\r")), r"[\x20\x09-\x0D]+")


def _masked(token: Column) -> Column:
    return F.when(token.rlike("[0-9]"), "<*>").otherwise(token)


def _leaf(tokens: Column, depth: int) -> Column:
    """The leaf of the parse tree: number of tokens and the first ones, as a hash."""
    return F.xxhash64(F.size(tokens), F.transform(F.slice(tokens, 1, depth), _masked))


def templates(docs: DataFrame, depth: int = DEPTH, least: int = LEAST, similar: float = SIMILAR, copied: float = COPIED) -> DataFrame:
    """(line, template, documents): hashes of the lines that follow a recurring template, the template
    written out with ``<*>`` at variable fields, and how many documents hold a line of it."""
    rows = docs.select(F.xxhash64("doc_id", "text").alias("doc"), F.split(F.coalesce("text", F.lit("")), "\n").alias("lines"), F.length(F.coalesce("text", F.lit(""))).alias("n"))
    rows = rows.withColumn("lines", F.filter(F.array_distinct("lines"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    of_doc = ["doc", "n", F.size("lines").alias("m"), F.aggregate("lines", F.lit(0).cast("long"), lambda a, x: a.bitwiseXOR(F.xxhash64(x))).alias("all")]
    lines = rows.select(*of_doc, F.posexplode("lines").alias("pos", "text"))
    line, leaf = F.xxhash64("text").alias("line"), _leaf(_tokens(F.col("text")), depth).alias("leaf")
    keyed = written(lines.select("doc", "n", "m", "all", "pos", leaf, line, F.length("text").alias("chars")), "lines")
    # leaves that enough documents reach; all further work is on their distinct lines
    leaves = written(keyed.groupBy("leaf").agg(F.count("*").alias("n")).filter(F.col("n") >= least).select("leaf"), "leaves")
    held = written(keyed.join(leaves, "leaf"), "leaf-lines")
    counted = written(held.groupBy("leaf", "line").agg(F.count("*").alias("docs")), "distinct-lines")
    distinct = written(lines.select("text", line).join(F.broadcast(counted) if few(counted) else counted, "line")
                       .groupBy("leaf", "line", "docs").agg(F.first("text").alias("text")), "line-texts")

    alike = _parsed(distinct, least, similar)
    verbatim = distinct.filter(F.col("docs") >= least).join(alike.select("line"), "line", "left_anti")  # a line that follows none is its own template
    follows = written(alike.union(verbatim.select("line", F.col("line").alias("leaf"), F.col("text").alias("template"))), "follows")

    # documents by template: first all, then those of one group of copies once
    of = written(held.join(follows.select("line", F.col("leaf").alias("template_id")), "line").drop("leaf").withColumnRenamed("template_id", "leaf"), "followers")
    recurring = written(of.groupBy("leaf").agg(F.countDistinct("doc").alias("docs")).filter(F.col("docs") >= least), "recurring")
    of = written(of.join(F.broadcast(recurring) if few(recurring) else recurring, "leaf").distinct(), "recurring-lines")
    # n-grams of recurring lines
    known_lines = distinct.join(of.select("line").distinct(), "line").withColumn("words", _tokens(F.col("text")))
    grams = written(known_lines.select(F.explode(_grams(F.col("words"))).alias("gram")).distinct(), "line-grams")
    evidence = of.select("leaf", "doc").join(_counted_as(rows.select("doc", "lines"), of, grams, copied), "doc").select("leaf", "counted_as").distinct()
    counted = evidence.groupBy("leaf").agg(F.count("*").alias("documents")).filter(F.col("documents") >= least)
    return follows.join(counted, "leaf").select("line", "template", "documents")


def _parsed(distinct: DataFrame, least: int, similar: float) -> DataFrame:
    """(line, leaf, template) of the lines that follow a template of their leaf; leaves are split until none can recur."""
    todo = written(distinct.select("line", F.col("leaf").alias("node"), "docs", F.transform(_tokens(F.col("text")), _masked).alias("tokens")), "unparsed")
    found = None
    while True:
        placed = todo.select("node", "docs", F.posexplode("tokens").alias("pos", "token"))
        held_at = written(placed.groupBy("node", "pos", "token").agg(F.sum("docs").alias("docs")), "held-at")
        top = (held_at.groupBy("node", "pos").agg(F.max(F.struct("docs", "token")).alias("top"), F.sum("docs").alias("total"))
               .withColumn("held", F.when(2 * F.col("top.docs") > F.col("total"), F.col("top.token")))
               .withColumn("split", F.when(F.col("held").isNull() & (F.col("top.docs") >= least), F.struct("top.docs", -F.col("pos")))))
        template = (top.groupBy("node").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "held"))), lambda x: x["held"]).alias("template"), (-F.max("split")["col2"]).alias("split"))
                    .withColumn("numbers", F.size(F.filter("template", lambda x: x == "<*>")))
                    .withColumn("words", F.size("template") - F.col("numbers"))
                    .withColumn("fixed", F.size(F.filter("template", lambda x: x != "<*>"))))
        template = written(template, "template")
        agree = F.zip_with("tokens", "template", lambda a, b: F.when(a == b, a))
        judged = (todo.join(template, "node").withColumn("agree", agree)
                  .withColumn("same", F.size(F.filter("agree", lambda x: x != "<*>"))).withColumn("same_numbers", F.size(F.filter("agree", lambda x: x == "<*>")))
                  .withColumn("alike", (F.col("words") > 0) & (F.col("same") >= F.least(F.lit(2), "words")) & (2 * F.col("same") >= F.col("words"))
                              & (F.col("same") >= similar * F.col("fixed")) & (F.col("same_numbers") >= similar * F.col("numbers"))))
        judged = written(judged.select("line", "node", "docs", "tokens", "template", "split", "alike"), "judged")
        fits = judged.filter("alike").select("line", F.col("node").alias("leaf"), F.array_join("template", " ", "<*>").alias("template"))
        found = fits if found is None else found.union(fits)
        # the rest of a leaf is parsed again; a leaf whose template nobody follows is split by the tokens that recur at one position
        used = judged.groupBy("node").agg(F.max("alike").alias("used"))
        tokens = held_at.filter(F.col("docs") >= least).select("node", F.col("pos").alias("split"), F.col("token").alias("of"))
        rest = (judged.filter("NOT alike").join(used, "node").filter("used OR split IS NOT NULL")
                .withColumn("split", F.when(~F.col("used"), F.col("split"))).withColumn("of", F.get("tokens", F.col("split")))
                .join(tokens.withColumn("known", F.lit(True)), ["node", "split", "of"], "left")
                .withColumn("node", F.xxhash64("node", "split", F.when(F.col("known"), F.col("of")), "used")).select("line", "node", "docs", "tokens"))
        rest = written(rest, "rest")
        enough = rest.groupBy("node").agg(F.sum("docs").alias("n")).filter(F.col("n") >= least).select("node")
        todo = written(rest.join(enough, "node", "left_semi"), "unparsed")
        if not todo.take(1):
            return written(found, "alike")


def _grams(words: Column) -> Column:
    """Hashes of three words in a row within a line (lines are parted by \\0)."""
    starts = F.when(F.size(words) >= 3, F.sequence(F.lit(0), F.size(words) - 3)).otherwise(F.array().cast("array<int>"))
    three = F.transform(starts, lambda i: F.struct(*(F.get(words, i + k).alias(f"w{k}") for k in range(3))))
    whole = F.filter(three, lambda x: (x["w0"] != "\0") & (x["w1"] != "\0") & (x["w2"] != "\0"))
    return F.transform(whole, lambda x: F.xxhash64(x["w0"], x["w1"], x["w2"]))


def _edited(rows: DataFrame, known: DataFrame, grams: DataFrame) -> DataFrame:
    """(doc) of the documents whose own lines are mostly n-grams of recurring lines."""
    places = known.filter("has_own").select("doc", "places")
    own = (rows.join(F.broadcast(places) if narrow(places, "places") else places, "doc")
           .select("doc", F.filter("lines", lambda x, i: ~F.array_contains("places", i)).alias("own")))
    own = own.withColumn("words", _tokens(F.array_join("own", " \0 "))).select("doc", _grams(F.col("words")).alias("grams"))
    # (dropDuplicates also keeps a filter inferred from explode from splitting the text once for each word)
    each = own.dropDuplicates(["doc"]).select("doc", F.size("grams").alias("n"), F.explode("grams").alias("gram"))
    found = each.join(F.broadcast(grams) if few(grams, 16) else grams, "gram").groupBy("doc", "n").agg(F.count("*").alias("found"))
    return found.filter("2 * found >= n").select("doc").distinct()


def _counted_as(rows: DataFrame, of: DataFrame, grams: DataFrame, copied: float) -> DataFrame:
    """(doc, counted_as) of the documents with recurring lines: the same for those of one group of copies."""
    rarest = F.min(F.struct("docs", "leaf"))["leaf"]
    known = written(of.groupBy("doc", "n", "m", "all").agg(F.sum("chars").alias("chars"), F.count("*").alias("held"), F.bit_xor("line").alias("xor"), rarest.alias("rarest"), F.collect_list("pos").alias("places"))
                    .select("doc", "places", "m", F.col("all").bitwiseXOR(F.col("xor")).alias("own"), (F.col("held") < F.col("m")).alias("has_own"),
                            (F.col("chars") > copied * F.col("n")).alias("mostly"), "rarest"), "documents")
    # is what stands between recurring lines of mostly recurring documents own text, or an edit of recurring lines?
    open_ = known.filter("mostly").select("doc", "m")
    edges = open_.select("doc", F.explode(F.array(F.struct(F.lit(-1).alias("pos"), F.lit(0).cast("long").alias("leaf")), F.struct(F.col("m").alias("pos"), F.lit(1).cast("long").alias("leaf")))).alias("e")).select("doc", "e.*")
    placed = of.select("doc", "pos", "leaf").join(F.broadcast(open_.select("doc")) if few(open_, 16) else open_.select("doc"), "doc", "left_semi").union(edges)
    in_order = Window.partitionBy("doc").orderBy("pos")
    ahead = [F.lead(F.struct("pos", "leaf"), k).over(in_order).alias(f"x{k}") for k in range(1, EDITED + 2)]
    placed = written(placed.select("doc", "pos", "leaf", *ahead), "in-order")
    gaps = placed.select("doc", "leaf", F.col("x1.leaf").alias("next"), (F.col("x1.pos") - F.col("pos") - 1).alias("k")).filter("k > 0")
    filled = placed.select("leaf", "pos", F.explode(F.array(*(F.struct(F.lit(k).alias("k"), F.col(f"x{k + 1}").alias("x")) for k in range(1, EDITED + 1)))).alias("b"))
    filled = filled.filter("b.x.pos = pos + b.k + 1").groupBy("leaf", F.col("b.x.leaf").alias("next"), F.col("b.k").alias("k")).agg(F.count("*").alias("whole"))
    between = ["leaf", "next", "k"]
    edits = written(gaps.groupBy(between).agg(F.count("*").alias("open")).join(filled, between).filter("whole >= open").select(between), "edits")
    apart = gaps.join(F.broadcast(edits) if few(edits) else edits, between, "left_anti").select("doc").distinct().withColumn("apart", F.lit(True))
    edited = written(_edited(rows, known, grams), "edited").withColumn("edited", F.lit(True))
    own = F.col("has_own") & F.col("edited").isNull() & (~F.col("mostly") | F.col("apart").isNotNull())
    return known.join(apart, "doc", "left").join(F.broadcast(edited) if few(edited, 16) else edited, "doc", "left").select("doc", F.xxhash64(own, F.when(own, F.col("own")).otherwise(F.col("rarest"))).alias("counted_as"))


def drop_lines(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` without the lines of ``found``: all its columns, and n_dropped, the number of lines dropped
    (under the first free name of n_dropped, n_dropped_1, ..)."""
    gone = written(found.select("line").distinct(), "dropped")
    doc, own, kept, dropped = (free_name(docs, x) for x in ("doc", "gone", "kept", "n_dropped"))
    keyed = docs.select(F.xxhash64("doc_id", "text").alias(doc), F.explode(F.array_distinct(F.split(F.coalesce("text", F.lit("")), "\n"))).alias("text"))
    hit = (keyed.select(doc, F.xxhash64("text").alias("line")).join(gone, "line").groupBy(doc).agg(F.collect_set("line").alias(own)))
    hit = written(hit, "hit")
    hit = F.broadcast(hit) if narrow(hit, own) else hit
    lines = F.split("text", "\n")
    rest = F.filter(lines, lambda x: ~F.array_contains(own, F.xxhash64(x)))
    return (docs.withColumn(doc, F.xxhash64("doc_id", "text")).withColumn("text", F.coalesce("text", F.lit("")))
            .join(hit, doc, "left").withColumn(own, F.coalesce(own, F.array().cast("array<bigint>")))
            .withColumn(kept, F.when(F.size(own) == 0, lines).otherwise(rest))
            .withColumn(dropped, (F.size(lines) - F.size(kept)).cast("long"))
            .withColumn("text", F.array_join(kept, "\n")).select(*docs.columns, dropped))


def dedup(docs: DataFrame, **parameters) -> DataFrame:
    return drop_lines(docs, templates(docs, **parameters))
