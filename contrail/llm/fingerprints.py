"""Operator 6: document fingerprints by I-Match (DataFrame functions only).

Method
------
Terms are runs of letters and digits in lower case. The lexicon keeps terms
within a band of inverse document frequency: those that between ``RARE`` and
``FREQUENT`` of the documents hold (two at least). In the lexicon each term has a
token of ``TOKEN`` random base-32 digits (a hash of it). The sorted tokens of a
text's distinct lexicon terms are hashed as a whole (plain I-Match) and once for
each of several randomised subsets of the lexicon: a token's first digit names its
subset, and there are ``LEVELS`` levels of 32 subsets, each level's a quarter of the
level's before (the last digits decide), so that short and long texts both find
subsets with few of their terms. A text without lexicon terms hashes all its terms.

Likeness of two fingerprints (0 to 1): 1 if they are equal; else, on the densest
level on which an eighth of the subsets are empty for both, the share of equal
hashes among the subsets that are not empty for both.

The edited text takes in part of the next document (descending ``doc_id``). Rows
are dealt to buckets of ``doc_id`` between quantiles, and each bucket's last row
looks at the next bucket's first, so that no task orders the whole table; texts
are shuffled once.

Scale: the lexicon holds at most (mean distinct terms of a document) / ``RARE``
rows whatever the number of documents; it is broadcast when its counted size
allows and joined by a shuffle otherwise. Document frequencies are partial sums.

Cases: a null text is empty; empty texts have equal fingerprints; rows that repeat
both ``doc_id`` and text are one document (each keeps its row); rows that share a
``doc_id`` follow each other by a hash of the text; a null ``doc_id`` counts as the
largest; a document alone is its own next; extra columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.llm.common import few, texts, written

RARE, FREQUENT = 1 / 2000, 1 / 10
LEVELS, TOKEN, CROWDED = 5, 12, 28  # a level on which more than CROWDED of 32 subsets are held is passed over
ANY = 0  # stands in each text and in the lexicon, so that no text is lost
LAST = (1 << 63) - 1  # stands for a null doc_id


def terms(text: Column) -> Column:
    """Hashes of the distinct terms."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.array_distinct(F.transform(words, lambda w: F.xxhash64(w)))


def lexicon(docs: DataFrame, rare: float = RARE, frequent: float = FREQUENT) -> DataFrame:
    """(term, token) of the terms within the band; terms are 64-bit hashes."""
    held = texts(docs).select(F.explode(terms(F.col("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    n = docs.count()
    band = held.filter((F.col("df") >= max(2, rare * n)) & (F.col("df") <= max(2, frequent * n))).select(
        "term", F.substring(F.lpad(F.lower(F.conv(F.xxhash64("term").cast("string"), 10, 32)), 13, "0"), 2, TOKEN).alias("token"))
    return written(band.union(docs.sparkSession.range(1).select(F.lit(ANY).cast("long"), F.lit(""))), "lexicon")


def _once(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def fingerprint(band: Column, everything: Column) -> Column:
    """struct(whole, levels) of the sorted lexicon tokens, each followed by a blank; without any, the hash of all
    terms. A level is an array of subset digit and four hex digits of the hash of its tokens."""
    def level(i: int) -> Column:
        thin = band if i == 0 else F.array_join(F.regexp_extract_all(band, F.lit(f"[0-9a-v]{{{TOKEN - i}}}[0-7]{{{i}}} "), 0), "")
        runs = F.regexp_extract_all(thin, F.lit(rf"(.)[0-9a-v]{{{TOKEN - 1}}} (?:\1[0-9a-v]{{{TOKEN - 1}}} )*"), 0)  # tokens of one subset
        return F.transform(runs, lambda r: F.concat(F.substring(r, 1, 1), F.substring(F.lpad(F.lower(F.hex(F.xxhash64(r))), 16, "0"), 1, 4)))

    whole = F.when(band == "", everything).otherwise(F.xxhash64(band))
    return F.struct(whole.alias("whole"), F.array(*[level(i) for i in range(LEVELS)]).alias("levels"))


def spelled(fp: Column) -> Column:
    """A fingerprint as text: 16 hex digits, then a level after each |: subset digit and four hex digits of each subset held."""
    return F.concat_ws("|", F.lower(F.lpad(F.hex(fp["whole"]), 16, "0")), F.transform(fp["levels"], lambda v: F.array_join(v, "")))


def likeness(a: Column, b: Column) -> Column:
    """1 for equal fingerprints; else the share of equal hashes on the densest level that is not crowded."""
    def digits(level: Column) -> Column:
        return F.transform(level, lambda x: F.substring(x, 1, 1))

    levels = F.transform(F.arrays_zip(a["levels"].alias("x"), b["levels"].alias("y")), lambda v: F.struct(
        F.size(F.array_union(digits(v["x"]), digits(v["y"]))).alias("held"), F.size(F.array_intersect(v["x"], v["y"])).alias("same")))
    chosen = _once(levels, lambda v: F.coalesce(F.get(F.filter(v, lambda x: x["held"] <= CROWDED), F.lit(0)), F.get(v, F.lit(LEVELS - 1))))
    return F.when(a == b, F.lit(1.0)).otherwise(_once(chosen, lambda v: F.when(v["held"] > 0, v["same"] / v["held"]).otherwise(F.lit(0.0))))


def _bucket(rows: DataFrame, buckets: int) -> Column:
    """Which of the ranges between quantiles of ``id`` a row is in, by binary search."""
    found = rows.agg(F.percentile_approx("id", [k / buckets for k in range(1, buckets)], 10_000)).first()[0] if buckets > 1 else None
    edges = sorted(set(found or [0]))
    literal = F.array(*[F.lit(e).cast("long") for e in edges])
    step = lambda s, _: F.when(
        s["lo"] < s["hi"],
        F.when(F.get(literal, ((s["lo"] + s["hi"]) / 2).cast("int")) <= F.col("id"),
               F.struct((((s["lo"] + s["hi"]) / 2).cast("int") + 1).alias("lo"), s["hi"].alias("hi")))
        .otherwise(F.struct(s["lo"].alias("lo"), ((s["lo"] + s["hi"]) / 2).cast("int").alias("hi")))).otherwise(s)
    start = F.struct(F.lit(0).alias("lo"), F.lit(len(edges)).alias("hi"))
    rounds = F.sequence(F.lit(1), F.lit(1 + ceil(log2(len(edges) + 1))))
    return F.aggregate(rounds, start, step, lambda s: s["lo"])


def _with_next(rows: DataFrame, value: str) -> DataFrame:
    """``rows`` (bucket, id, th, ...) with the column ``next_<value>`` of the row that follows in descending order; the first follows the last."""
    order = [F.col("id").desc(), F.col("th")]
    follows = Window.partitionBy("bucket").orderBy(*order)
    firsts = rows.groupBy("bucket").agg(F.max_by(F.struct("id", "th"), F.struct("id", -F.col("th").cast("decimal(20,0)"))).alias("f"))
    # one row a bucket: whose first row follows which bucket
    by = Window.orderBy(F.col("bucket").desc())
    turn = firsts.select("bucket", "f.id", "f.th", F.lag("bucket").over(by).alias("after"))
    turn = turn.withColumn("after", F.coalesce("after", F.min("bucket").over(Window.partitionBy())))
    heads = (rows.join(F.broadcast(turn.select("id", "th", "after")), ["id", "th"])
             .select(F.col("after").alias("bucket"), F.col(value).alias("_head")).dropDuplicates(["bucket"]))
    return (rows.withColumn("_next", F.lead(F.struct("id", "th", value)).over(follows))
            .filter("_next IS NULL OR _next.id <> id OR _next.th <> th")  # of rows that repeat, the last
            .join(heads, "bucket")
            .withColumn(f"next_{value}", F.when(F.col("_next").isNull(), F.col("_head")).otherwise(F.col("_next")[value])).drop("_next", "_head"))


def compare(docs: DataFrame, words: DataFrame | None = None) -> DataFrame:
    """(doc_id, n_chars, edited_text_sha256, fp, edited_fp, near_edited, near_next) with fingerprints as structs.

    ``words``: a lexicon; by default that of ``docs``."""
    spark = docs.sparkSession
    words = words or lexicon(docs)
    rows = texts(docs).select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("id"), F.xxhash64("text").alias("th"), "text")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bucketed = rows.select("id", "th", "text").withColumn("bucket", _bucket(rows, buckets))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.expr("substring(text, 1, length(text) - cast(floor(length(text) / 2) as int))"), F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), half))
    both = _with_next(bucketed, "text").withColumn("edited", edited)
    key = ["bucket", "id", "th", "is_edited"]
    held = both.select("bucket", "id", "th", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), F.explode(F.array(*[
        F.struct(F.lit(e).alias("is_edited"), terms(F.col(c)).alias("terms")) for e, c in ((False, "text"), (True, "edited"))])).alias("t"))
    held = held.select(*key[:3], "t.is_edited", F.struct("n_chars", "edited_sha256", F.xxhash64(F.sort_array("t.terms")).alias("everything")).alias("about"),
                       F.explode(F.concat("t.terms", F.array(F.lit(ANY).cast("long")))).alias("term"))
    held = held.select(*key, "term", F.when(F.col("term") == ANY, F.col("about")).alias("about"))  # once a text
    words = F.broadcast(words) if few(words) else words
    band = held.join(words, "term").groupBy(*key).agg(F.array_sort(F.collect_list("token")).alias("tokens"), F.first("about", True).alias("about"))
    band = band.withColumn("band", F.concat(F.array_join(F.filter("tokens", lambda t: t != ""), " "), F.when(F.size("tokens") > 1, " ").otherwise("")))
    fps = band.select(*key, "about", fingerprint(F.col("band"), F.col("about.everything")).alias("fp"))
    pairs = written(fps.groupBy(*key[:3]).agg(F.first("about.n_chars").alias("n_chars"), F.first("about.edited_sha256").alias("edited_sha256"),
                                              F.first(F.when(~F.col("is_edited"), F.col("fp")), True).alias("fp"),
                                              F.first(F.when(F.col("is_edited"), F.col("fp")), True).alias("edited_fp")), "fingerprints")
    near = _with_next(pairs, "fp").select(
        F.col("id").alias("_id"), F.col("th").alias("_th"), "n_chars", "edited_sha256", "fp", "edited_fp",
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"), likeness(F.col("fp"), F.col("next_fp")).alias("near_next"))
    return (rows.select("doc_id", "id", "th").join(near, (F.col("id") == F.col("_id")) & (F.col("th") == F.col("_th")))
            .select("doc_id", "n_chars", "edited_sha256", "fp", "edited_fp", "near_edited", "near_next"))


def digest(compared: DataFrame) -> DataFrame:
    return compared.select("doc_id", "n_chars", "edited_sha256", spelled(F.col("fp")).alias("fingerprint"),
                           spelled(F.col("edited_fp")).alias("edited_fingerprint"), "near_edited", "near_next")
