"""Registered queries of this package, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm import (bpe, decontaminate, fill_middle, fingerprints, html_text, hyper_minhash, jaccard_join, lexical_search, line_dedup, secret_scan,
                          substring_dedup, token_counts, toxicity)
from contrail.llm.common import few, table, written
from contrail.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after three batches over all documents: all are inserted; exact copies of a text with a smaller
    doc_id are deleted (a batch that is sent twice); documents that repeat a line are revised without the repeats."""
    version = "byte_bpe_50k.tiktoken"
    path = bpe.tokenizer_path(version)
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    rollup = token_counts.Rollup(spark, scratch_path(spark, "token-rollup"))
    rollup.commit("load", docs.select(F.lit("insert").alias("op"), F.lit(0).alias("seq"), "*"), version, path)
    hashed = docs.select("doc_id", "source", "lang", F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha"))
    first = written(hashed.groupBy("sha").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n"), "repeated-texts")
    repeated = hashed.join(F.broadcast(first) if few(first, 96) else first, "sha")  # beyond the bound two scans, which Spark can split
    copies = repeated.filter("doc_id > first").select(F.lit("delete").alias("op"), F.lit(0).alias("seq"), "doc_id", "source", "lang", F.lit(None).cast("string").alias("text"))
    for _ in range(2):
        rollup.commit("copies", copies, version, path)
    lines = F.split("text", "\n")
    revised = (docs.filter(F.size(F.array_distinct(lines)) < F.size(lines)).join(rollup.on_record().select("doc_id"), "doc_id", "left_semi")
               .withColumn("text", F.array_join(F.array_distinct(lines), "\n")))
    rollup.commit("repeats", revised.select(F.lit("revise").alias("op"), F.lit(0).alias("seq"), "doc_id", "source", "lang", "text"), version, path)
    return rollup.totals()


def op2_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan(table(spark, sf_dir, "documents")))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"), bpe.tokenizer_path("word_bpe_49k.json"), keep_texts=False)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op6_imatch_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.digest(fingerprints.compare(table(spark, sf_dir, "documents")))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_dropped")


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents"), n=4, percent=85)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("doc")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digest(substring_dedup.dedup(table(spark, sf_dir, "documents")))


def op11_hyper_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of near duplicates (five words, 0.85) of all documents; one document of each class is kept."""
    return hyper_minhash.dedup(table(spark, sf_dir, "documents"), n=5, percent=85)


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form, cuts and digests of output and restored text of all documents."""
    return fill_middle.digest(fill_middle.restore(fill_middle.transform(table(spark, sf_dir, "documents"), seed=42)))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best of all documents for each test item."""
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


OP10_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') AS w FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
firsts AS (SELECT h, min(doc_id) AS f FROM win GROUP BY h),
covered AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS j FROM win JOIN firsts USING (h) WHERE doc_id > f),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS j FROM d),
kept AS (SELECT doc_id, count(jj) AS n_removed, string_agg(word, ' ' ORDER BY j) FILTER (jj IS NULL) AS text
         FROM words LEFT JOIN (SELECT doc_id, j, j AS jj FROM covered) c USING (doc_id, j) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

def _op2_sql() -> str:
    """The rules' matches by regular expression, one after another, with their positions summed up."""
    parts = []
    for i, rule in enumerate(secret_scan.RULES):
        pattern = rule.pattern.replace("'", "''")
        parts.append(f"""SELECT r, {i} AS ord, '{rule.kind}' AS kind, {rule.least} AS least, unnest(a) AS a, unnest(v) AS v, unnest(g[1:len(a)]) AS g, unnest(range(1, len(a) + 1)) AS i
FROM (SELECT r, regexp_extract_all(text, '{pattern}', 0) AS a, regexp_extract_all(text, '{pattern}', {rule.group}) AS v, string_split_regex(text, '{pattern}') AS g FROM t)""")
    counts = ", ".join(f"CAST(count(*) FILTER (kind = '{r.kind}') AS BIGINT) AS n_{r.kind}" for r in secret_scan.BASE)
    union = "\nUNION ALL\n".join(parts)
    zero = ", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in secret_scan.BASE)
    return f"""WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
m AS ({union}),
placed AS (SELECT r, ord, kind, least, v, sum(length(g) + length(a)) OVER (PARTITION BY r, ord ORDER BY i) AS stop, length(a) AS n FROM m),
spans AS (SELECT r, ord, kind, CAST(stop - n AS BIGINT) AS start, kind || ':' || CAST(stop - n AS BIGINT) || ':' || CAST(stop AS BIGINT) AS span FROM placed WHERE length(v) >= least),
found AS (SELECT r, {counts}, string_agg(span, ',' ORDER BY start, ord) FILTER (ord < {len(secret_scan.BASE)}) AS base, string_agg(span, ',' ORDER BY start, ord) AS spans FROM spans GROUP BY r)
SELECT doc_id, {zero}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM t LEFT JOIN found USING (r)"""


#: N-gram length, one less, two less, the threshold: for operators 8 and 11.
SIMILAR_SQL = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
grams AS (SELECT DISTINCT doc_id, array_to_string(x, ' ') AS g FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) >= {n} THEN list_transform(range(1, len(w) - {m}), lambda i: w[i:i + {l}]) WHEN len(w) > 0 THEN [w] ELSE [] END) AS x FROM w)),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM grams a JOIN grams b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= {percent} * (x.n + y.n - c)),
reach AS (SELECT doc_id, doc_id AS r FROM documents UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.r = links.a)
SELECT doc_id, CAST(coalesce(any_value(n), 0) AS BIGINT) AS n_shingles, min(r) AS component_id
FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""


def _similar_sql(n: int, percent: int) -> str:
    return SIMILAR_SQL.replace("{n}", str(n)).replace("{l}", str(n - 1)).replace("{m}", str(n - 2)).replace("{percent}", str(percent))


OP8_SQL = _similar_sql(4, 85)
OP11_SQL = f"SELECT *, doc_id = component_id AS kept FROM ({_similar_sql(5, 85)})"

OP12_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
u AS (SELECT doc_id, text, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS w, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM t),
d AS (SELECT *, len(w) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2, CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM u),
f AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS i, greatest(h1 % (n + 1), h2 % (n + 1)) AS j,
             CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM d),
p AS (SELECT *, array_to_string(w[1:i], '') AS prefix, array_to_string(w[i + 1:j], '') AS middle, array_to_string(w[j + 1:], '') AS suffix FROM f)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256 FROM p
"""

OP13_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
n AS (SELECT r, doc_id, CAST(len(t) AS BIGINT) AS n FROM d WHERE len(t) > 0),
s AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM n),
tf AS (SELECT r, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT r, unnest(t) AS term FROM d) GROUP BY r, term),
i AS (SELECT row_number() OVER () AS i, item_id, list_distinct(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
q AS (SELECT i, item_id, unnest(t) AS term FROM i),
w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf CROSS JOIN s WHERE term IN (SELECT term FROM q) GROUP BY term),
m AS (SELECT r, doc_id, 10 + (90 * n * docs) // terms AS m FROM n CROSS JOIN s),
scored AS (SELECT i, item_id, doc_id, r, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
           FROM q JOIN w USING (term) JOIN tf USING (term) JOIN m USING (r) GROUP BY i, item_id, doc_id, r),
ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_token_counts, op2_secret_scans, op3_bpe, op4_toxicity, op5_html_extraction, op6_imatch_fingerprints, op7_line_dedup, op8_ngram_jaccard_join, op9_decontamination, op10_substring_dedup,
                                                      op11_hyper_minhash, op12_fill_middle, op13_lexical_search)}
ORACLES: dict[str, str] = {"op2_secret_scans": _op2_sql(), "op8_ngram_jaccard_join": OP8_SQL, "op10_substring_dedup": OP10_SQL,
                           "op11_hyper_minhash": OP11_SQL, "op12_fill_middle": OP12_SQL, "op13_lexical_search": OP13_SQL}
