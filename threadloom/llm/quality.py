"""Operator 5 [native]: quality rules with cross-document line frequency. DataFrame functions only.

Lines are normalised (lower case, digits to 0, blanks squeezed) and hashed together with their host (the source; null is a host
of its own). A line found in more than MAX_DOCS distinct documents of a host is taken out, and a document whose distinct lines
lose more than MAX_LOST percent of their words is depleted, hence rejected. Repeats inside one document are counted by
n_dup_lines and n_repeat_words, not here.

Cases: a null or empty text has no words, so base_failed is true; repeated rows give repeated result rows, and count once as a
document; no ties arise, limits are compared with counts; a very long text is one row, its lines are rows of their own; rows with a
null doc_id are left out; other columns, whatever their names, are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, docs_of, shared_dir, written

#: A line is boilerplate of its host from MAX_DOCS + 1 documents on; a document may lose MAX_LOST percent of its words with it.
MAX_DOCS = 10
MAX_LOST = 50
#: Frequent lines are broadcast up to so many (8 bytes each); beyond it they are joined by shuffle.
BROADCAST_LINES = 4_000_000
MIN_WORDS = 50
SYMBOLS = "[#*$%&|<>]"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, f"{SPACE}+"), "")


def lines_of(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def normal_line(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.translate(F.lower(line), "123456789", "000000000"), f"{SPACE}+", " "))


def base_rules(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text, ...) with the counts of the base rules; text is "" where null."""
    w = docs.withColumn("words", words_of(F.col("text"))).withColumn("lines", lines_of(F.col("text")))
    w = w.withColumn("n_words", F.size("words").cast("long"))
    # one 64-bit hash for each window of three words; equal hashes stand for equal windows of a text
    triples = F.slice(F.arrays_zip(F.col("words").alias("a"), F.slice("words", F.lit(2), F.size("words")).alias("b"), F.slice("words", F.lit(3), F.size("words")).alias("c")), F.lit(1), F.greatest(F.size("words") - 2, F.lit(0)))
    w = w.withColumn("windows", F.transform(triples, lambda x: F.xxhash64(x["a"], x["b"], x["c"])))
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    spots = F.arrays_zip(F.col("windows").alias("h"), F.sequence(F.lit(0), F.size("windows") - 1).alias("i"))
    w = w.withColumn("sorted", F.when(repeats, F.sort_array(spots)))
    same = lambda x, k: F.coalesce(F.get("sorted", k)["h"] == x["h"], F.lit(False))
    marked = F.transform("sorted", lambda x, k: F.when(same(x, k - 1) | same(x, k + 1), x["i"]))
    w = w.withColumn("spots", F.sort_array(F.array_compact(marked)))
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    cover = F.aggregate("spots", start, lambda acc, x: F.struct((acc["n"] + x + 3 - F.greatest(acc["end"], x)).alias("n"), (x + 3).alias("end")), lambda acc: acc["n"])
    return w.select(
        *docs.columns,
        "n_words",
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(cover, F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def host_lines(docs: DataFrame) -> DataFrame:
    """The distinct normalised lines of each document: doc_id, text_key, line (hashed with its host), words."""
    host = F.coalesce(F.concat(F.lit("h"), F.col("source")), F.lit(""))
    lines = docs.select("doc_id", "text_key", host.alias("host"), F.explode(F.array_distinct(F.transform(lines_of(F.col("text")), normal_line))).alias("line"))
    return lines.select("doc_id", "text_key", F.xxhash64("host", "line").alias("line"), F.size(F.split("line", " ")).alias("words"))


def frequent_lines(lines: DataFrame, max_docs: int = MAX_DOCS) -> DataFrame:
    """Lines in more documents of their host than the limit. Distinct documents are counted in two steps, first by line and document, so a common line spreads over all tasks."""
    return lines.groupBy("line").agg(F.count_distinct("doc_id").alias("n_docs")).filter(F.col("n_docs") > max_docs)


def depleted(lines: DataFrame, frequent: DataFrame, max_lost: int = MAX_LOST) -> DataFrame:
    """doc_id, text_key of the documents that lose more than so many percent of their lines' words."""
    if frequent.count() <= BROADCAST_LINES:
        frequent = F.broadcast(frequent)
    hit = lines.join(frequent.select("line", F.lit(True).alias("out")), "line", "left")
    lost = hit.groupBy("doc_id", "text_key").agg(F.sum("words").alias("all"), F.sum(F.when(F.col("out"), F.col("words")).otherwise(0)).alias("gone"))
    return lost.filter(F.col("gone") * 100 > F.col("all") * max_lost).select("doc_id", "text_key", F.lit(True).alias("depleted"))


def quality_rules(documents: DataFrame, max_docs: int = MAX_DOCS, max_lost: int = MAX_LOST) -> DataFrame:
    docs = docs_of(documents, "source").withColumn("text", F.coalesce("text", F.lit(""))).withColumn("text_key", F.xxhash64("text", "source"))
    lines = host_lines(docs)
    frequent = written(frequent_lines(lines, max_docs), shared_dir(documents.sparkSession), "frequent_lines")
    counts = base_rules(docs.select("doc_id", "text_key", "text")).drop("text")
    out = counts.join(depleted(lines, frequent, max_lost), ["doc_id", "text_key"], "left")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & F.col("depleted").isNull()).alias("kept"))


def without_frequent_lines(documents: DataFrame, max_docs: int = MAX_DOCS) -> DataFrame:
    """doc_id, source, text, n_lines_removed: the texts that the verdicts of quality_rules are about, frequent lines taken out, the
    others as they were and in their order; repeated rows once, texts of which nothing is left as empty ones."""
    docs = docs_of(documents, "source").withColumn("text", F.coalesce("text", F.lit(""))).withColumn("text_key", F.xxhash64("text", "source"))
    frequent = written(frequent_lines(host_lines(docs), max_docs), shared_dir(documents.sparkSession), "frequent_lines")
    host = F.coalesce(F.concat(F.lit("h"), F.col("source")), F.lit(""))
    lines = docs.dropDuplicates(["doc_id", "text_key"]).select("doc_id", "text_key", "source", host.alias("host"), F.posexplode(F.split("text", "\n")).alias("at", "raw"))
    out = frequent.select("line", F.lit(True).alias("out"))
    if frequent.count() <= BROADCAST_LINES:
        out = F.broadcast(out)
    marked = lines.withColumn("line", F.xxhash64("host", normal_line(F.col("raw")))).join(out, "line", "left")
    gone = F.coalesce("out", F.lit(False))
    kept = marked.groupBy("doc_id", "text_key").agg(F.first("source").alias("source"), F.array_sort(F.collect_list(F.when(~gone, F.struct("at", "raw")))).alias("kept"), F.count_if(gone).alias("n_lines_removed"))
    return kept.select("doc_id", "source", F.array_join(F.transform("kept", lambda x: x["raw"]), "\n").alias("text"), "n_lines_removed")


#: For DuckDB; hash collisions aside, the same rows.
SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents WHERE doc_id IS NOT NULL),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
win AS (SELECT doc_id, i, words[i] || ' ' || words[i+1] || ' ' || words[i+2] AS g
        FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) > 2)),
rep AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win) WHERE n > 1),
cov AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM rep, (VALUES (0), (1), (2)) t(k) GROUP BY doc_id),
ln AS (SELECT DISTINCT doc_id, source, line, len(string_split(line, ' ')) AS n FROM (
        SELECT doc_id, source, trim(regexp_replace(regexp_replace(lower(unnest(lines)), '[1-9]', '0', 'g'), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS line FROM w)),
freq AS (SELECT source, line FROM ln GROUP BY source, line HAVING count(DISTINCT doc_id) > 10),
gone AS (SELECT l.doc_id, sum(l.n) AS total, sum(CASE WHEN f.line IS NULL THEN 0 ELSE l.n END) AS lost
         FROM ln l LEFT JOIN freq f ON l.line = f.line AND l.source IS NOT DISTINCT FROM f.source GROUP BY l.doc_id),
m AS (SELECT w.doc_id, len(words) AS n_words, len(list_aggregate(words, 'string_agg', '')) AS word_chars,
        len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
        coalesce(cov.n, 0) AS n_repeat_words, coalesce(lost * 100 > total * 50, false) AS depleted
      FROM w LEFT JOIN cov USING (doc_id) LEFT JOIN gone USING (doc_id))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND NOT depleted AS kept FROM m
"""
