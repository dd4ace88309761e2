"""Operator 13 [native]: URL filters. DataFrame functions only.

Rules name a host and the start of a path; a rule fits its host and all subdomains, and the longest rule that fits decides. For all
other URLs a list of canonical URLs decides: a *blocked Bloom filter* of the list passes possible hits, an exact hash join with the
list takes out the false ones among them.

The filter is a table of blocks of 256 bits, four longs each. A URL's hash names its block and one bit in each of eight stretches of
32 bits, so a look-up is one row of a broadcast table and eight bit tests in generated code. Blocks are built by bit_or over the listed
URLs, in the tasks that hold them. Their number follows the counted list, up to MAX_BLOCKS: that bounds what is broadcast
(40 bytes a block); a longer list makes more false positives, never a wrong result. URLs that the filter rejects are not shuffled.
Those that it passes are reduced to distinct ones before the exact join; the hits found go back to the rows by a broadcast if
they are few (counted), else by a join that is salted, so a URL on a third of all rows is many tasks.

Cases: a null url, or one without `://`, has empty host and path, fits no rule and is not listed, hence allowed; an empty list blocks
nothing; repeated rows give repeated result rows, and repeated entries of the list count once; of two rules of equal length the smaller
one (host, path, verdict) decides; rules are compared whole, however long the URL; other columns, whatever their names, are ignored; rows with a null page_id are kept with
a null; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_dir, written

#: (host, start of the path, verdict) of the rules.
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"))
#: Words by which a host is known for spam; pages of such hosts make the query's list.
SPAM_HOST = r"(^|[.-])(casino|poker|bets?|pills|viagra|loans?|xxx|porn|warez)([.-]|$)"
BITS_A_URL = 16
MAX_BLOCKS = 1 << 20
#: Hits are broadcast up to so many, else joined by salted shuffle.
BROADCAST_HITS = 200_000
SALTS = 32
#: Parameters that name a visit, not a page.
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid|sessionid|sid)(=|$)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """From behind the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty without one."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to `?`, `#` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """One name for a page: host without `www.` and default port, path without doubled and last slashes and index file, parameters sorted
    and those that name a visit left out; no scheme, no fragment. Null without a host."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), r":(80|443)?$", ""), r"^www\.", "")
    path = F.regexp_replace(F.regexp_replace(path_of(url), "/{2,}", "/"), r"/(index\.(html?|php))?$", "")
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda x: (x != "") & ~x.rlike(TRACKING)))
    tail = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    return F.when(host != "", F.concat(host, path, tail))


def ruling(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits (`host` + path, as one string) and its verdict; nulls where none fits."""
    found_rule, found_verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule_host, start, verdict in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r), reverse=True):  # the last one put on top is the longest
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(start))
        found_rule = F.when(fits, F.lit(rule_host + start)).otherwise(found_rule)
        found_verdict = F.when(fits, F.lit(verdict)).otherwise(found_verdict)
    return found_rule, found_verdict


def _block(name: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(name), F.lit(blocks)).cast("int")


def _masks(name: Column) -> list[Column]:
    """Four longs with two bits each, one in each half: ten further hash bits a long choose them."""
    h = F.xxhash64(F.lit("bits"), name)
    one = F.lit(1).cast("bigint")
    spot = lambda i: F.shiftright(h, 5 * i).bitwiseAND(F.lit(31)).cast("int")
    return [_shift(one, spot(2 * i)).bitwiseOR(_shift(one, spot(2 * i + 1) + 32)) for i in range(4)]


def _shift(x: Column, by: Column) -> Column:
    return F.call_function("shiftleft", x, by)


def bloom_blocks(spark: SparkSession, listed: DataFrame, bits: int = BITS_A_URL, most: int = MAX_BLOCKS) -> tuple[DataFrame, int]:
    """listed(name), distinct -> (block, w0..w3) of the blocks with any bit, and how many blocks there are."""
    blocks = max(1, min(most, listed.count() * bits // 256 + 1))
    masks = [m.alias(f"m{i}") for i, m in enumerate(_masks(F.col("name")))]
    rows = listed.select(_block(F.col("name"), blocks).alias("block"), *masks)
    return rows.groupBy("block").agg(*(F.bit_or(f"m{i}").alias(f"w{i}") for i in range(4))), blocks


def maybe_listed(pages: DataFrame, filter_: DataFrame, blocks: int) -> DataFrame:
    """pages(name, ...) with `maybe`: false where the filter proves that the name isn't listed. The filter has `most` rows at most."""
    found = pages.withColumn("block", _block(F.col("name"), blocks)).join(F.broadcast(filter_), "block", "left")
    tests = [F.col(f"w{i}").bitwiseAND(m) == m for i, m in enumerate(_masks(F.col("name")))]
    passes = F.coalesce(reduce(lambda a, b: a & b, tests), F.lit(False))
    return found.withColumn("maybe", passes & F.col("name").isNotNull()).drop("block", "w0", "w1", "w2", "w3")


def exact_hits(candidates: DataFrame, listed: DataFrame) -> DataFrame:
    """candidates(name) -> the distinct ones that are listed, by hash join."""
    return candidates.select("name").distinct().join(listed.hint("shuffle_hash"), "name", "left_semi")


def judged(pages: DataFrame, listed: DataFrame, rules=RULES, bits: int = BITS_A_URL, most: int = MAX_BLOCKS, broadcast_hits: int = BROADCAST_HITS) -> DataFrame:
    """pages(page_id, url), listed(url) -> page_id, host, path, rule, verdict, listed (null where a rule decides)."""
    spark = pages.sparkSession
    folder = shared_dir(spark)
    names = written(listed.select(canonical(F.col("url").cast("string")).alias("name")).filter("name IS NOT NULL").distinct(), folder, "listed")
    filter_, blocks = bloom_blocks(spark, names, bits, most)
    filter_ = written(filter_, folder, "filter")
    url = F.col("url")
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"))
    rows = rows.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), canonical(url).alias("name"))
    rule, verdict = ruling(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", rule).withColumn("verdict", verdict)
    rows = rows.withColumn("name", F.when(F.col("verdict").isNull(), F.col("name")))
    rows = maybe_listed(rows, filter_, blocks)
    sure = rows.filter("NOT maybe").withColumn("listed", F.when(F.col("verdict").isNull(), F.lit(False)))
    open_ = written(rows.filter("maybe"), folder, "candidates")
    hits = written(exact_hits(open_, names), folder, "hits").withColumn("hit", F.lit(True))
    if hits.count() <= broadcast_hits:
        open_ = open_.join(F.broadcast(hits), "name", "left")
    else:
        salt = F.pmod(F.xxhash64("page_id", "host", "path"), F.lit(SALTS)).cast("int")
        hits = hits.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        open_ = open_.withColumn("salt", salt).join(hits, ["name", "salt"], "left").drop("salt")
    open_ = open_.withColumn("listed", F.coalesce("hit", F.lit(False))).drop("hit")
    out = sure.unionByName(open_)
    decided = F.coalesce("verdict", F.when(F.col("listed"), F.lit("block")).otherwise("allow"))
    return out.select("page_id", "host", "path", "rule", decided.alias("verdict"), "listed")


def spam_pages(pages: DataFrame) -> DataFrame:
    """The query's list: the URLs of pages whose host carries a spam word."""
    return pages.select(F.col("url").cast("string").alias("url")).filter(host_of(F.col("url")).rlike(SPAM_HOST))


def url_verdicts(pages: DataFrame) -> DataFrame:
    return judged(pages, spam_pages(pages))


#: For DuckDB.
SQL = r"""
WITH u AS (SELECT page_id, url, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
c AS (SELECT *, list_sort(list_filter(string_split(regexp_extract(coalesce(url, ''), '(?s)^.*?://[^?#]*\?([^#]*)', 1), '&'),
        lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[^=]*|ref|fbclid|gclid|sessionid|sid)(=|$)'))) AS kept FROM u),
n AS (SELECT page_id, host, path, CASE WHEN h <> '' THEN h || regexp_replace(regexp_replace(path, '/{2,}', '/', 'g'), '/(index\.(html?|php))?$', '')
        || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END END AS name
      FROM (SELECT *, regexp_replace(regexp_replace(host, ':(80|443)?$', ''), '^www\.', '') AS h FROM c)),
listed AS (SELECT DISTINCT name FROM n WHERE name IS NOT NULL AND regexp_matches(host, '(^|[.-])(casino|poker|bets?|pills|viagra|loans?|xxx|porn|warez)([.-]|$)')),
rules(h, p, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
hosts AS (SELECT DISTINCT host, path FROM n),
best AS (SELECT host, path, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS v
         FROM hosts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY host, path)
SELECT page_id, n.host, n.path, best.rule, coalesce(best.v, CASE WHEN listed.name IS NULL THEN 'allow' ELSE 'block' END) AS verdict,
  CASE WHEN best.v IS NULL THEN listed.name IS NOT NULL END AS listed
FROM n LEFT JOIN best ON n.host = best.host AND n.path = best.path LEFT JOIN listed ON n.name = listed.name
"""
