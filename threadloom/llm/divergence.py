"""Operator 12: source divergence audit by joint count histograms.

Terms are counted once for each (language, source), with the number of rows they occur in, by numpy over slices of texts. A language keeps the terms of enough rows
(MIN_DOCS). Two sources of a language are compared term by term, yet no term is looked at for a pair: terms with the same count in every
source are one *profile* with a multiplicity, and profiles are tallied for each pair by the two counts, (c, d) -> how many terms. Cells
with a zero come from each source's own histogram of counts, less what the joint cells took of it; the cell (0, 0) is what is left
of the language's V terms. The divergence's function is then evaluated once a cell, both ways, times the cell's terms.

All is exact: counts and sums are longs, products that may pass 2^63 are decimals. A profile is known by two 64-bit sums over its
(source, count) hashes, with its number of sources and occurrences beside them.

Scale: one shuffle of the text's terms, summed before it; a hot source is many partial sums. The joint table grows with distinct
profiles, not with terms. Pairs of sources of one language number as the result's rows do; nothing else is paired.

Cases: null text, lang and source are read as ''; a text without terms still makes its group; each row is a document, so repeated rows
and rows without a doc_id count; a very long text is a slice of its own, read whole; ties in value are ordered by item in UTF-8; other
columns, whatever their names, are ignored; an empty table gives an empty result; a source alone in its language has no pair rows; a
language without kept terms has value 0 for each pair and no term rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, binary_rows, bound_batches, byte_view, give_back, lean, ragged, shared_dir, slices, written

MIN_DOCS = 3
TOP_TERMS = 200
SCALE = 1_000_000_000
#: Texts of so many bytes are counted together, before anything is shuffled.
SLICE_BYTES = 8 << 20
#: Whatever is not a letter of ASCII and not beyond ASCII parts terms: bytes 0-40, 5B-60, 7B-7F in UTF-8, which no other letter holds.
_IS_TERM = np.ones(256, dtype=np.int8)
_IS_TERM[[*range(0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = 0


def term_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the terms of texts that lie end to end, and the text of each. Bytes above 127 are parts of letters."""
    inside = np.zeros(len(data) + 1, dtype=np.int8)  # a byte that is in a term; texts' edges part terms too
    inside[:-1] = _IS_TERM[data]
    head = np.zeros(len(data) + 1, dtype=bool)
    head[offsets] = True
    starts = np.flatnonzero((inside == 1) & (head | (np.r_[np.int8(0), inside[:-1]] == 0)))
    ends = np.flatnonzero((np.r_[np.int8(0), inside[:-1]] == 1) & (head | (inside == 0)))
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def _slice_counts(part: pa.RecordBatch) -> pa.RecordBatch:
    """Of some texts: lang, source, term, n, docs of the terms in them."""
    data, offsets = byte_view(part.column("text"))
    data = LOWER[data]
    starts, ends, row = term_spans(data, offsets)
    sizes = ends - starts
    terms = binary_rows(np.r_[0, np.cumsum(sizes)], data[ragged(starts, sizes)]).dictionary_encode()
    known, code = terms.dictionary, terms.indices.to_numpy().astype(np.int64)
    group = pa.array([f"{len(a)} {a}{b}" for a, b in zip(part.column("lang").to_pylist(), part.column("source").to_pylist(), strict=True)]).dictionary_encode().indices.to_numpy()
    first = np.zeros(int(group.max(initial=-1)) + 1, dtype=np.int64)
    first[group[::-1]] = np.arange(len(group))[::-1]
    wide = max(1, len(known))
    in_row, n = np.unique(row * wide + code, return_counts=True)  # each term once a text
    key = group[in_row // wide] * wide + in_row % wide
    order = np.argsort(key, kind="stable")
    heads = np.flatnonzero(np.r_[True, key[order][1:] != key[order][:-1]]) if len(key) else np.zeros(0, dtype=np.int64)
    at = key[order][heads]
    who = pa.array(first[at // wide])
    total = np.add.reduceat(n[order], heads) if len(heads) else np.zeros(0, dtype=np.int64)
    docs = np.diff(np.r_[heads, len(key)])
    term = known.take(pa.array(at % wide)).view(pa.string())
    return pa.RecordBatch.from_arrays([part.column("lang").take(who), part.column("source").take(who), term, pa.array(total, pa.int64()), pa.array(docs, pa.int64())], names=["lang", "source", "term", "n", "docs"])


def _count_terms(batches):
    lean()
    for batch in batches:
        for part in slices(batch, most=SLICE_BYTES):
            yield _slice_counts(part)
    give_back()


def term_counts(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lang, source, term, n, docs): occurrences and rows of each term in each group; and (lang, source) of all groups."""
    bound_batches(documents.sparkSession)
    docs = documents.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    parts = docs.mapInArrow(_count_terms, "lang string, source string, term string, n bigint, docs bigint")
    counts = parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    return counts, docs.select("lang", "source").distinct()


def kept_counts(counts: DataFrame, min_docs: int = MIN_DOCS) -> tuple[DataFrame, DataFrame]:
    """The kept terms' counts: (lang, source, term, n) by group, and (lang, term, n) by language."""
    total = counts.groupBy("lang", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")).filter(F.col("docs") >= min_docs).drop("docs")
    return counts.select("lang", "source", "term", "n").join(total.select("lang", "term"), ["lang", "term"], "left_semi"), total


def smoothed(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (n + 1) / (total + terms)), in whole numbers."""
    wide = F.lit(SCALE).cast("decimal(10,0)") * (n + 1).cast("decimal(19,0)")
    return F.lit(1) + F.call_function("div", wide, (total + terms).cast("decimal(19,0)"))


def divergence(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q); p and q are at most SCALE + 1, so their difference's square fits a long."""
    return F.call_function("div", (p - q) * (p - q), q)


def _groups(groups: DataFrame, kept: DataFrame, total: DataFrame) -> DataFrame:
    """(lang, source, size, terms): each group's occurrences of kept terms, and how many terms its language keeps."""
    sizes = kept.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    terms = total.groupBy("lang").agg(F.count("*").alias("terms"))
    out = groups.join(sizes, ["lang", "source"], "left").join(terms, "lang", "left")
    return out.select("lang", "source", F.coalesce("size", F.lit(0)).alias("size"), F.coalesce("terms", F.lit(0)).alias("terms"))


def profiles(kept: DataFrame) -> DataFrame:
    """(lang, term, copies): of the terms that have the same count in every source the least, and how many they are."""
    spot = F.xxhash64("source", "n").cast("decimal(20,0)")
    other = F.xxhash64("n", F.lit("profile"), "source").cast("decimal(20,0)")
    mark = kept.groupBy("lang", "term").agg(F.sum(spot).alias("a"), F.sum(other).alias("b"), F.count("*").alias("c"), F.sum("n").alias("d"))
    return mark.groupBy("lang", "a", "b", "c", "d").agg(F.min("term").alias("term"), F.count("*").alias("copies")).select("lang", "term", "copies")


def joint_histograms(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, other, c, d, m) for each pair source < other of a language: m of its kept terms occur c times in the one and d
    times in the other. Cells with zeros are there too, so the m of a pair sum up to the language's terms."""
    some = kept.join(profiles(kept), ["lang", "term"]).select("lang", "term", "source", "n", "copies")
    some = written(some, shared_dir(kept.sparkSession), "profiles")
    right = some.select("lang", "term", F.col("source").alias("other"), F.col("n").alias("d"))
    keys = ["lang", "source", "other", "c", "d"]
    both = some.withColumnRenamed("n", "c").join(right, ["lang", "term"]).filter("source < other").groupBy(*keys).agg(F.sum("copies").alias("m"))
    own = some.groupBy("lang", "source", F.col("n").alias("c")).agg(F.sum("copies").alias("m"))
    pairs = groups.select("lang", "source", "terms").join(groups.select("lang", F.col("source").alias("other")), "lang").filter("source < other")
    zero = F.lit(0).cast("bigint")
    # what a pair has of each kind: all terms; those of the one, of the other; those of both. Signs turn sums into cells
    cells = [
        both,
        pairs.select("lang", "source", "other", zero.alias("c"), zero.alias("d"), F.col("terms").alias("m")),
        own.join(pairs.drop("terms"), ["lang", "source"]).select("lang", "source", "other", F.explode(_signed("c", None)).alias("x")).select("lang", "source", "other", "x.*"),
        own.withColumnRenamed("source", "other").withColumnRenamed("c", "d").join(pairs.drop("terms"), ["lang", "other"]).select("lang", "source", "other", F.explode(_signed(None, "d")).alias("x")).select("lang", "source", "other", "x.*"),
        both.select("lang", "source", "other", F.explode(_corrections()).alias("x")).select("lang", "source", "other", "x.*"),
    ]
    out = cells[0]
    for more in cells[1:]:
        out = out.unionByName(more)
    return out.groupBy(*keys).agg(F.sum("m").alias("m")).filter("m <> 0")


def _cell(c: Column, d: Column, m: Column) -> Column:
    return F.struct(c.alias("c"), d.alias("d"), m.alias("m"))


def _signed(c: str | None, d: str | None) -> Column:
    """Terms of one source: they lie in (c, 0) or (0, d), so not in (0, 0)."""
    zero = F.lit(0).cast("bigint")
    return F.array(_cell(F.col(c) if c else zero, F.col(d) if d else zero, F.col("m")), _cell(zero, zero, -F.col("m")))


def _corrections() -> Column:
    """Terms of both sources were taken for terms of the one alone and of the other alone, and twice out of (0, 0)."""
    zero = F.lit(0).cast("bigint")
    return F.array(_cell(F.col("c"), zero, -F.col("m")), _cell(zero, F.col("d"), -F.col("m")), _cell(zero, zero, F.col("m")))


def pair_values(cells: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value): the divergence of each source from each other one of its language, its q."""
    one = groups.select("lang", "source", "size", "terms")
    two = groups.select("lang", F.col("source").alias("other"), F.col("size").alias("other_size"))
    at = cells.join(one, ["lang", "source"]).join(two, ["lang", "other"])
    at = at.withColumn("p", smoothed(F.col("c"), F.col("size"), F.col("terms"))).withColumn("q", smoothed(F.col("d"), F.col("other_size"), F.col("terms")))
    wide = lambda f: F.sum((f * F.col("m")).cast("decimal(38,0)"))
    sums = at.groupBy("lang", "source", "other").agg(wide(divergence(F.col("p"), F.col("q"))).alias("there"), wide(divergence(F.col("q"), F.col("p"))).alias("back"))
    rows = F.array(F.struct(F.col("source"), F.col("other").alias("item"), F.col("there").alias("value")), F.struct(F.col("other").alias("source"), F.col("source").alias("item"), F.col("back").alias("value")))
    found = sums.select("lang", F.explode(rows).alias("x")).select("lang", "x.source", "x.item", F.col("x.value").cast("bigint").alias("value"))
    # a language without kept terms has no cells
    bare = groups.filter("terms = 0").select("lang", "source").join(groups.select("lang", F.col("source").alias("item")), "lang").filter("source <> item")
    return found.unionByName(bare.select("lang", "source", "item", F.lit(0).cast("bigint").alias("value")))


def term_values(kept: DataFrame, total: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value): of each group's terms those that it uses more than its language does, with their part of the divergence."""
    whole = groups.groupBy("lang").agg(F.sum("size").alias("lang_size"))
    at = kept.join(groups, ["lang", "source"]).join(whole, "lang").join(total.withColumnRenamed("n", "lang_n"), ["lang", "term"])
    at = at.withColumn("p", smoothed(F.col("n"), F.col("size"), F.col("terms"))).withColumn("q", smoothed(F.col("lang_n"), F.col("lang_size"), F.col("terms")))
    return at.filter("p > q").select("lang", "source", F.col("term").alias("item"), divergence(F.col("p"), F.col("q")).alias("value"))


def source_divergence(documents: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank: `pair` rows compare sources of a language, `term` rows name what a source overuses."""
    folder = shared_dir(documents.sparkSession)
    counts, groups = term_counts(documents)
    counts = written(counts, folder, "counts")
    kept, total = kept_counts(counts, min_docs)
    kept, total = written(kept, folder, "kept"), written(total, folder, "total")
    groups = written(_groups(groups, kept, total), folder, "groups")
    pairs = pair_values(joint_histograms(kept, groups), groups).withColumn("part", F.lit("pair"))
    terms = term_values(kept, total, groups).withColumn("part", F.lit("term"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(order))
    terms = terms.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return pairs.unionByName(terms).select("lang", "source", "part", "item", "value", "rank")


#: For DuckDB, the definition itself: each group meets every kept term.
SQL = r"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
t AS (SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT id) >= 3),
g AS (SELECT DISTINCT lang, source FROM d),
n AS (SELECT lang, source, term, count(*) AS c FROM t GROUP BY lang, source, term),
full_ AS (SELECT g.lang, g.source, kept.term, coalesce(n.c, 0)::HUGEINT AS c FROM g JOIN kept USING (lang) LEFT JOIN n USING (lang, source, term)),
p AS (SELECT lang, source, term, c, 1 + (1000000000::HUGEINT * (c + 1)) // (sum(c) OVER (PARTITION BY lang, source) + count(*) OVER (PARTITION BY lang, source))::HUGEINT AS p FROM full_),
l AS (SELECT lang, term, sum(c)::HUGEINT AS c FROM full_ GROUP BY lang, term),
q AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (c + 1)) // (sum(c) OVER (PARTITION BY lang) + count(*) OVER (PARTITION BY lang))::HUGEINT AS q FROM l),
pair AS (SELECT a.lang, a.source, b.source AS item, coalesce(sum(((x.p - y.p) * (x.p - y.p)) // y.p), 0) AS value
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
    GROUP BY a.lang, a.source, b.source),
term AS (SELECT p.lang, p.source, p.term AS item, ((p - q) * (p - q)) // q AS value FROM p JOIN q USING (lang, term) WHERE c > 0 AND p > q),
both_ AS (SELECT 'pair' AS part, * FROM pair UNION ALL SELECT 'term', * FROM term)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY part, lang, source ORDER BY value DESC, item) AS rank FROM both_) WHERE part = 'pair' OR rank <= 200
"""
