"""The queries over the driver's tables, named by the survey's operator IDs, each beside the SQL that says the same in DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import identity, text, timeutil
from ..keyed import KeyedTable
from ..operators import agreement, candidates, corpus, export, history, language, review, state, target, threads, views, votes
from ..schemas import CUES
from ..scratch import folder
from ..sources import files, markup
from .adapters import duck, view

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
LINEUP, VERSION = ["a1", "a2", "a3"], "v3"
KEY = b"test-key-for-queries"
MARKERS = ["edi wow", "thank you", "birthday", "the ", "now"]


def query(sql: str | None = None, *ctes: str, **extra: str) -> Callable[[Query], Query]:
    """Register a query; `ctes` names the adapter views that its SQL reads, `extra` adds further ones."""

    def put(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            parts = [f"{n} AS ({duck(n)})" for n in ctes] + [f"{n} AS ({t})" for n, t in extra.items()]
            ORACLES[f.__name__] = (f"WITH {', '.join(parts)} " if parts else "") + sql
        return f

    return put


def _aggregates(s: SparkSession, d: str, rule: str = "unanimous", tie: str = "adjudicate") -> DataFrame:
    return votes.aggregate(view(s, d, "ratings"), view(s, d, "reviews"), LINEUP, VERSION, rule, tie)


# --- corpus, candidates ------------------------------------------------------------------------------------------------

_NORM = r"""trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''), '\[([^\]]*)\]\([^)]*\)', '\1', 'g'), 'https?://\S+|www\.\S+', ' ', 'g'), '[*_~`>#|]+', ' ', 'g'), '\s+', ' ', 'g'))"""
_TOK = "regexp_extract_all({}, '[A-Za-zÀ-ÖØ-öø-ÿ''ñÑ]+')"
_PH = text.PHATIC.replace(r"(?!\s+to\b)", "").replace("'", "''")
_LIST = lambda xs: "[" + ", ".join("'" + x.replace("'", "''") + "'" for x in xs) + "]"
_LOW = r"regexp_replace(lower(norm), '(a{3,}|e{3,}|y{3,}|s{3,}|u{3,}|o{3,}|h{3,})', '\0', 'g')"
for _c in "abcdefghijklmnopqrstuvwxyzñ":
    _LOW = _LOW if _c != "a" else "lower(norm)"
    _LOW = f"regexp_replace({_LOW}, '{_c}{{3,}}', '{_c}', 'g')"
_REASON = f"""
SELECT item_id, norm, CASE WHEN is_bot <> 0 THEN 'bot_author' WHEN distinguished = 'moderator' AND stickied <> 0 THEN 'moderator_sticky' WHEN author_status = 'deleted' THEN 'deleted_author'
  WHEN lower(trim(text)) IN ('[deleted]', '[removed]', '[deleted by user]') THEN 'deleted_body' WHEN record_type = 'submission' AND is_self = 0 AND trim(coalesce(selftext, '')) = '' THEN 'link_post'
  WHEN length(norm) < 12 THEN 'too_short' WHEN len({_TOK.format('norm')}) < 3 THEN 'too_few_tokens'
  WHEN len(toks) BETWEEN 1 AND 10 AND NOT list_has_any(toks, {_LIST(text.IRONY_GUARD)}) AND regexp_matches(low, '(?i){_PH}')
    AND len(list_filter({_TOK.format(f"regexp_replace(low, '(?i){_PH}', ' ', 'g')")}, lambda t: NOT list_contains({_LIST(text.PHATIC_FILLER)}, t) AND NOT regexp_matches(t, '{text.LAUGHTER}'))) <= 2 THEN 'phatic' END AS why
FROM (SELECT *, {_TOK.format('low')} AS toks FROM (SELECT *, {_LOW} AS low FROM (SELECT *, {_NORM} AS norm FROM corpus) a) b) c
"""


@query("SELECT coalesce(why, 'eligible') AS reason, count(*) AS n FROM reason GROUP BY 1", "corpus", reason=_REASON)
def f01_exclusion_histogram(s: SparkSession, d: str) -> DataFrame:
    """F01, F02, A04, X01-X03."""
    return candidates.outcome_counts(candidates.select(view(s, d, "corpus")))


@query("SELECT item_id, why IS NULL AS eligible, why AS exclusion_reason, norm AS text_norm, coalesce(why = 'phatic', false) AS phatic FROM reason", "corpus", reason=_REASON)
def f03_candidates(s: SparkSession, d: str) -> DataFrame:
    """F03, F04 without votes."""
    return candidates.select(view(s, d, "corpus"))


@query("SELECT k, sum(CASE WHEN record_type = 'submission' THEN 1 ELSE 0 END)::BIGINT AS posts, sum(CASE WHEN record_type = 'comment' THEN 1 ELSE 0 END)::BIGINT AS comments FROM corpus, unnest(" + _LIST(MARKERS) + ") t(k) WHERE contains(lower(text), k) GROUP BY k".replace("k,", "k AS keyword,"), "corpus")
def f19_markers(s: SparkSession, d: str) -> DataFrame:
    return candidates.keyword_counts(view(s, d, "corpus"), MARKERS).withColumnRenamed("keyword", "k")


@query("SELECT subreddit, sum((record_type = 'submission')::INT)::BIGINT AS submissions, sum((record_type = 'comment')::INT)::BIGINT AS comments, max(created_s) AS last_seen FROM corpus GROUP BY subreddit", "corpus")
def a01_subreddit_stats(s: SparkSession, d: str) -> DataFrame:
    return corpus.subreddit_stats(view(s, d, "corpus"))


@query("SELECT count(*) AS total, coalesce(sum((record_type = 'submission')::INT), 0)::BIGINT AS submissions, coalesce(sum((record_type = 'comment')::INT), 0)::BIGINT AS comments FROM corpus", "corpus")
def a03_corpus_counts(s: SparkSession, d: str) -> DataFrame:
    """A02, A03."""
    return corpus.counts(view(s, d, "corpus"))


@query(
    "SELECT c.item_id, CASE WHEN t THEN p.sampling_strategy ELSE c.sampling_strategy END AS sampling_strategy, CASE WHEN t THEN p.matched_query_or_keyword ELSE c.matched_query_or_keyword END AS matched_query_or_keyword "
    "FROM (SELECT *, record_type = 'comment' AND sampling_strategy IS NULL AND submission_item IN (SELECT item_id FROM corpus WHERE record_type = 'submission') AS t FROM corpus) c LEFT JOIN corpus p ON p.item_id = c.submission_item AND p.record_type = 'submission'",
    "corpus",
)
def p16_inherited_sampling(s: SparkSession, d: str) -> DataFrame:
    """P16, J19."""
    return corpus.inherit_sampling(view(s, d, "corpus")).select("item_id", "sampling_strategy", "matched_query_or_keyword")


@query("SELECT item_id, record_type <> 'submission' OR coalesce(is_self <> 0, false) OR trim(coalesce(selftext, '')) <> '' AS is_text_only FROM corpus", "corpus")
def p13_text_only(s: SparkSession, d: str) -> DataFrame:
    return view(s, d, "corpus").select("item_id", corpus.is_text_only(F.col("record_type"), F.col("is_self"), F.col("selftext")).alias("is_text_only"))


def _hmac_sql(x: str) -> str:
    inner, outer = (bytes(b ^ p for b in KEY.ljust(64, b"\0")).hex().upper() for p in (0x36, 0x5C))
    first = f"unhex(sha256(unhex('{inner}') || encode({x})))"
    return f"sha256(unhex('{outer}') || {first})"


@query(f"SELECT item_id, {_hmac_sql('lower(trim(author))')} AS author_hash FROM corpus", "corpus")
def p05_pseudonyms(s: SparkSession, d: str) -> DataFrame:
    return view(s, d, "corpus").select("item_id", identity.pseudonym(F.col("author"), KEY)[0].alias("author_hash"))


@query("SELECT item_id, CASE WHEN retagged THEN 'natural' ELSE sampling_strategy END AS sampling_strategy, CASE WHEN NOT retagged THEN matched_query_or_keyword END AS matched_query_or_keyword, retagged FROM (SELECT *, coalesce(sampling_strategy = 'keyword_oversampled' AND regexp_full_match(matched_query_or_keyword, '\\d{4}-\\d{2}-\\d{2}'), false) AS retagged FROM corpus) x".replace("\\\\", "\\"), "corpus")
def p18_retagged(s: SparkSession, d: str) -> DataFrame:
    return state.retag(view(s, d, "corpus")).select("item_id", "sampling_strategy", "matched_query_or_keyword", "retagged")


@query("SELECT c.item_id FROM candidates c WHERE eligible AND NOT EXISTS (SELECT 1 FROM reviews r WHERE r.item_id = c.item_id)", "candidates", "reviews")
def f05_missing_results(s: SparkSession, d: str) -> DataFrame:
    """F05, F06, J04, O06."""
    return candidates.missing(view(s, d, "candidates"), view(s, d, "reviews"))


_NOT_DONE = "NOT EXISTS (SELECT 1 FROM {t} v WHERE v.item_id = {x}.item_id AND v.model_key = 'a2' AND v.role = 'annotator')"


@query(f"SELECT c.item_id FROM candidates c WHERE eligible AND {_NOT_DONE.format(t='ratings', x='c')} AND {_NOT_DONE.format(t='failures', x='c')}", "candidates", "ratings", "failures")
def f07_pending_annotator(s: SparkSession, d: str) -> DataFrame:
    return candidates.pending_annotator(view(s, d, "candidates"), view(s, d, "ratings"), view(s, d, "failures"), "a2", VERSION)


# --- votes --------------------------------------------------------------------------------------------------------------


def _vote_sql(rule: str, tie: str) -> str:
    """The aggregation in plain SQL: one correlated view a label, over the lineup's votes."""
    labels = ("language", "literal_sentiment", "intended_sentiment")
    parts = []
    for x in labels:
        top = f"SELECT item_id, {x} AS v, count(*) AS n, min(model_key) AS k FROM lineup WHERE {x} IS NOT NULL GROUP BY item_id, {x}"
        best = f"SELECT item_id, arg_max(v, n * 1000 - ascii(substring(k, 2, 1))) AS v, max(n) AS n FROM ({top}) t GROUP BY item_id"
        conf = f"SELECT item_id, arg_max({x}, coalesce(confidence, 0) * 100000 - ascii(substring(model_key, 2, 1))) AS v FROM lineup WHERE {x} IS NOT NULL GROUP BY item_id"
        parts.append(f"top_{x} AS ({best}), conf_{x} AS ({conf})")
    value = lambda x: f"CASE WHEN top_{x}.n >= 2 THEN top_{x}.v" + (f" ELSE conf_{x}.v END" if tie == "confidence" else " END")
    esc = lambda x: "false" if tie == "confidence" else f"coalesce(top_{x}.n, 0) < 2"
    joins = " ".join(f"LEFT JOIN top_{x} ON top_{x}.item_id = g.item_id LEFT JOIN conf_{x} ON conf_{x}.item_id = g.item_id" for x in labels)
    sarc = "CASE WHEN g.n >= 2 AND (yes = 0 OR yes = g.n) THEN (yes > 0)::INT" + (" WHEN g.n >= 2 AND 2 * yes <> g.n THEN (2 * yes > g.n)::INT" if rule == "majority" else "") + " END"
    cue = ", ".join(f"coalesce((2 * sum({c}) > count({c}))::INT, 0) AS {c}" for c in CUES)
    pick = lambda col, own: f"CASE WHEN h.item_id IS NOT NULL THEN h.{col} WHEN e AND a.item_id IS NOT NULL THEN a.{col} ELSE {own} END"
    mean = "(SELECT round(sum(l.confidence) / count(l.confidence), 4) FROM lineup l WHERE l.item_id = b.item_id AND l.sarcastic = b.s AND l.confidence IS NOT NULL)"
    cues = ", ".join(f"CAST(CASE WHEN h.item_id IS NOT NULL THEN coalesce(h.{c}, 0) WHEN e AND a.item_id IS NOT NULL THEN coalesce(a.{c}, 0) ELSE b.{c} END AS INT) AS {c}_final" for c in CUES)
    return f"""lineup AS (SELECT * FROM ratings WHERE role = 'annotator' AND model_key IN ('a1', 'a2', 'a3')),
g AS (SELECT item_id, count(*) AS m, count(sarcastic) AS n, sum(sarcastic) AS yes, {cue}, count(DISTINCT sarcastic) = 1 AND count(DISTINCT language) = 1 AND count(DISTINCT literal_sentiment) = 1 AND count(DISTINCT intended_sentiment) = 1 AS same FROM lineup GROUP BY item_id),
{', '.join(parts)},
b AS (SELECT g.*, {sarc} AS s, {', '.join(f'{value(x)} AS {x}' for x in labels)}, ({sarc}) IS NULL OR {' OR '.join(map(esc, labels))} AS e,
  {' + '.join(f'(coalesce(top_{x}.n, 2) < 2)::INT' for x in labels) if tie == 'confidence' else '0'} AS ties FROM g {joins}),
agg AS (SELECT b.item_id, m AS n_annotators, greatest(yes, n - yes)::STRING || '-' || least(yes, n - yes)::STRING AS sarcasm_votes, CAST({pick('sarcastic', 'b.s')} AS INT) AS sarcastic_final, {pick('language', 'b.language')} AS language_final,
  {pick('literal_sentiment', 'b.literal_sentiment')} AS literal_final, {pick('intended_sentiment', 'b.intended_sentiment')} AS intended_final, {cues}, CAST(e AS INT) AS needs_adjudication,
  CAST(CASE WHEN h.item_id IS NULL AND e AND a.item_id IS NOT NULL AND coalesce(round(a.confidence, 4) < 0.6, true) THEN 1 ELSE 0 END AS INT) AS needs_human,
  CASE WHEN h.item_id IS NOT NULL THEN 'human' WHEN NOT e THEN CASE WHEN same THEN 'unanimous' ELSE 'majority' END WHEN a.item_id IS NOT NULL THEN 'adjudicator' END AS resolved_by,
  CASE WHEN NOT e THEN {mean} WHEN a.item_id IS NOT NULL THEN round(a.confidence, 4) END AS mean_confidence, CAST(ties AS INT) AS tiebreak_labels
  FROM b LEFT JOIN (SELECT * FROM ratings WHERE role = 'adjudicator') a ON a.item_id = b.item_id LEFT JOIN (SELECT * FROM reviews WHERE is_gold = 0) h ON h.item_id = b.item_id)"""


_AGG, _AGG_MAJ = _vote_sql("unanimous", "adjudicate"), _vote_sql("majority", "confidence")
_AGG_COLS = ["item_id", "n_annotators", "sarcasm_votes", "sarcastic_final", "language_final", "literal_final", "intended_final", *(f"{c}_final" for c in CUES), "needs_adjudication", "needs_human", "resolved_by", "mean_confidence", "tiebreak_labels"]


def _with(tail: str, agg: str = _AGG, *ctes: str) -> str:
    return "WITH " + ", ".join(f"{n} AS ({duck(n)})" for n in ("ratings", "reviews", *ctes)) + ", " + agg + " " + tail


@query(_with(f"SELECT {', '.join(_AGG_COLS)} FROM agg"))
def a15_aggregation(s: SparkSession, d: str) -> DataFrame:
    """A11-A15 under unanimous and adjudicate."""
    return _aggregates(s, d).select(*_AGG_COLS)


@query(_with(f"SELECT {', '.join(_AGG_COLS)} FROM agg", _AGG_MAJ))
def a15_aggregation_majority(s: SparkSession, d: str) -> DataFrame:
    """A11-A15 under majority and confidence."""
    return _aggregates(s, d, "majority", "confidence").select(*_AGG_COLS)


@query(_with("SELECT coalesce(resolved_by, 'unresolved') AS resolution, count(*) AS n FROM agg GROUP BY 1"))
def a09_resolutions(s: SparkSession, d: str) -> DataFrame:
    return votes.outcome_stats(_aggregates(s, d))


_PER = ", ".join(
    f"CASE WHEN h.item_id IS NOT NULL THEN 'human' WHEN a.item_id IS NOT NULL THEN 'adjudicator' WHEN coalesce(top_{x}.n, 0) < 2 THEN 'unresolved' WHEN k_{x} = 1 THEN 'unanimous' ELSE 'majority' END AS {x}" for x in ("language", "literal_sentiment", "intended_sentiment")
)


@query(
    _with(
        f"SELECT b.item_id, CASE WHEN h.item_id IS NOT NULL THEN 'human' WHEN a.item_id IS NOT NULL THEN 'adjudicator' WHEN b.s IS NULL THEN 'unresolved' WHEN yes = 0 OR yes = b.n THEN 'unanimous' ELSE 'majority' END AS sarcastic, {_PER} FROM b "
        + "JOIN (SELECT item_id, count(DISTINCT language) AS k_language, count(DISTINCT literal_sentiment) AS k_literal_sentiment, count(DISTINCT intended_sentiment) AS k_intended_sentiment FROM lineup GROUP BY item_id) k ON k.item_id = b.item_id "
        + " ".join(f"LEFT JOIN top_{x} ON top_{x}.item_id = b.item_id" for x in ("language", "literal_sentiment", "intended_sentiment"))
        + " LEFT JOIN (SELECT DISTINCT item_id FROM ratings WHERE role = 'adjudicator') a ON a.item_id = b.item_id LEFT JOIN (SELECT item_id FROM reviews WHERE is_gold = 0) h ON h.item_id = b.item_id"
    )
)
def a16_per_label_resolution(s: SparkSession, d: str) -> DataFrame:
    return votes.per_label_resolution(view(s, d, "ratings"), view(s, d, "reviews"), LINEUP, VERSION)


@query(_with("SELECT item_id FROM agg WHERE needs_adjudication = 1 AND coalesce(resolved_by, '') <> 'human' AND item_id NOT IN (SELECT item_id FROM ratings WHERE role = 'adjudicator') AND item_id NOT IN (SELECT item_id FROM failures WHERE role = 'adjudicator' AND model_key = 'senior')", _AGG, "failures"))
def f08_pending_adjudicator(s: SparkSession, d: str) -> DataFrame:
    return candidates.pending_adjudicator(_aggregates(s, d), view(s, d, "ratings"), view(s, d, "failures"), "senior", VERSION)


# --- agreement ----------------------------------------------------------------------------------------------------------

_LONG = "SELECT item_id, model_key, label, value FROM (SELECT item_id, model_key, unnest(['sarcastic', 'language', 'literal_sentiment', 'intended_sentiment']) AS label, unnest([sarcastic::STRING, language, literal_sentiment, intended_sentiment]) AS value FROM ratings WHERE role = 'annotator') x WHERE value IS NOT NULL"


@query(
    "SELECT t.label, t.n_items, coalesce(f.n, 0) AS n_items_all_raters, CASE WHEN f.n >= 2 AND e < 1 THEN round((p - e) / (1 - e), 4) END AS fleiss_kappa FROM (SELECT label, count(DISTINCT item_id) AS n_items FROM long GROUP BY label) t "
    "LEFT JOIN (SELECT label, count(*) AS n, avg((sq - 3) / 6.0) AS p FROM fullitems GROUP BY label) f ON f.label = t.label LEFT JOIN (SELECT label, sum(pow(v / (n * 3.0), 2)) AS e FROM (SELECT c.label, c.value, sum(c.n)::DOUBLE AS v, any_value(q.n) AS n FROM cells c JOIN fullitems i ON i.label = c.label AND i.item_id = c.item_id "
    "JOIN (SELECT label, count(*) AS n FROM fullitems GROUP BY label) q ON q.label = c.label GROUP BY c.label, c.value) z GROUP BY label) s ON s.label = t.label",
    "ratings",
    long=_LONG,
    cells="SELECT label, item_id, value, count(*) AS n FROM long GROUP BY ALL",
    fullitems="SELECT label, item_id, sum(n * n) AS sq FROM cells GROUP BY label, item_id HAVING sum(n) = 3",
)
def t05_fleiss(s: SparkSession, d: str) -> DataFrame:
    """T01, T05, T10."""
    return agreement.fleiss(agreement.long_labels(view(s, d, "ratings"), LINEUP, VERSION))


@query(
    "SELECT o.label, round(1 - o.o * (o.t - 1) / (o.t * o.t - v.sq), 4) AS krippendorff_alpha FROM (SELECT label, sum((m * m - sq) / (m - 1.0)) AS o, sum(m)::DOUBLE AS t FROM i GROUP BY label) o JOIN (SELECT label, sum(v * v)::DOUBLE AS sq FROM (SELECT c.label, c.value, sum(c.n) AS v FROM cells c JOIN i ON i.label = c.label AND i.item_id = c.item_id GROUP BY c.label, c.value) x GROUP BY label) v ON v.label = o.label",
    "ratings",
    long=_LONG,
    cells="SELECT label, item_id, value, count(*) AS n FROM long GROUP BY ALL",
    i="SELECT label, item_id, sum(n) AS m, sum(n * n) AS sq FROM cells GROUP BY label, item_id HAVING sum(n) > 1",
)
def t06_krippendorff(s: SparkSession, d: str) -> DataFrame:
    return agreement.krippendorff(agreement.long_labels(view(s, d, "ratings"), LINEUP, VERSION))


_GOLD = "SELECT item_id, CASE WHEN first_pass_json IS NOT NULL THEN CAST(json_extract_string(first_pass_json, '$.sarcastic') AS INT) ELSE sarcastic END AS sarcastic, CASE WHEN first_pass_json IS NOT NULL THEN json_extract_string(first_pass_json, '$.language') ELSE language END AS language, CASE WHEN first_pass_json IS NOT NULL THEN json_extract_string(first_pass_json, '$.literal_sentiment') ELSE literal_sentiment END AS literal_sentiment, CASE WHEN first_pass_json IS NOT NULL THEN json_extract_string(first_pass_json, '$.intended_sentiment') ELSE intended_sentiment END AS intended_sentiment FROM reviews WHERE is_gold <> 0 AND votes_seen = 0"


@query("SELECT * FROM gold", "reviews", gold=_GOLD)
def f16_blind_gold(s: SparkSession, d: str) -> DataFrame:
    return agreement.gold_labels(view(s, d, "reviews"))


_COHEN = "SELECT {g}, n, CASE WHEN n >= {least} AND e < n * n THEN round((agree / n - e / (n * n)) / (1 - e / (n * n)), 4) END AS kappa FROM (SELECT {g}, count(*)::DOUBLE AS n, sum((a = b)::INT)::DOUBLE AS agree FROM pairs GROUP BY {g}) x JOIN (SELECT {g}, sum(c * coalesce(k, 0))::DOUBLE AS e FROM (SELECT {g}, a AS v, count(*) AS c FROM pairs GROUP BY {g}, a) l LEFT JOIN (SELECT {g}, b AS v, count(*) AS k FROM pairs GROUP BY {g}, b) r USING ({g}, v) GROUP BY {g}) y USING ({g})"


@query(
    _with(
        ", gold AS (" + _GOLD + "), pairs AS (" + " UNION ALL ".join(f"SELECT '{x}' AS label, o.{x}::STRING AS a, g.{y}::STRING AS b FROM gold o JOIN agg g ON g.item_id = o.item_id WHERE o.{x} IS NOT NULL AND g.{y} IS NOT NULL" for x, y in (("sarcastic", "sarcastic_final"), ("language", "language_final"), ("literal_sentiment", "literal_final"), ("intended_sentiment", "intended_final"))) + ") "
        + "SELECT label, n::BIGINT AS n, kappa FROM (" + _COHEN.format(g="label", least=2) + ") q"
    )
)
def t04_gold_kappa(s: SparkSession, d: str) -> DataFrame:
    """T03, T04, J10, F16."""
    return agreement.gold_kappa(view(s, d, "reviews"), _aggregates(s, d))


@query(
    "SELECT k.source, k.kind, coalesce(x.n, 0) AS n, accuracy, f1_sarcastic, kappa FROM (VALUES ('a1', 'annotator'), ('a2', 'annotator'), ('a3', 'annotator'), ('idle', 'annotator'), ('majority', 'majority')) k(source, kind) LEFT JOIN (SELECT source, n, round(ok / n, 4) AS accuracy, CASE WHEN 2 * tp + fp + fn > 0 THEN round(2 * tp / (2 * tp + fp + fn), 4) END AS f1_sarcastic, "
    "CASE WHEN ((tp + fn) * (tp + fp) + (n - tp - fn) * (n - tp - fp)) < n * n THEN round((ok / n - ((tp + fn) * (tp + fp) + (n - tp - fn) * (n - tp - fp)) / (n * n)) / (1 - ((tp + fn) * (tp + fp) + (n - tp - fn) * (n - tp - fp)) / (n * n)), 4) END AS kappa "
    "FROM (SELECT source, count(*) AS n, sum((human = 1 AND predicted = 1)::INT)::DOUBLE AS tp, sum((human = 0 AND predicted = 1)::INT)::DOUBLE AS fp, sum((human = 1 AND predicted = 0)::INT)::DOUBLE AS fn, sum((human = predicted)::INT)::DOUBLE AS ok FROM (SELECT s.source, s.predicted, g.sarcastic AS human FROM sources s JOIN gold g ON g.item_id = s.item_id) p GROUP BY source) m) x ON x.source = k.source",
    "ratings",
    "reviews",
    gold=_GOLD,
    sources="SELECT model_key AS source, item_id, sarcastic AS predicted FROM ratings WHERE role = 'annotator' UNION ALL SELECT 'majority', item_id, (2 * sum(sarcastic) > count(*))::INT FROM ratings WHERE role = 'annotator' GROUP BY item_id HAVING 2 * sum(sarcastic) <> count(*)",
)
def t09_evaluation_report(s: SparkSession, d: str) -> DataFrame:
    """T07, T09, A18, A34, J11, O05, O07."""
    r = view(s, d, "ratings").filter("role = 'annotator'")
    major = r.groupBy("item_id").agg(votes.strict_majority(F.sum("sarcastic"), F.count("*")).alias("predicted")).filter("predicted IS NOT NULL").select(F.lit("majority").alias("source"), "item_id", "predicted")
    sources = r.select(F.col("model_key").alias("source"), "item_id", F.col("sarcastic").alias("predicted")).unionByName(major)
    kinds = s.createDataFrame([("a1", "annotator"), ("a2", "annotator"), ("a3", "annotator"), ("idle", "annotator"), ("majority", "majority")], "source string, kind string")
    return agreement.evaluation_report(agreement.gold_labels(view(s, d, "reviews")), sources, kinds)


# --- targets, progress --------------------------------------------------------------------------------------------------

_TARGET = "SELECT c.item_id, coalesce(p.priority, 0) AS prio, (SELECT count(*) FROM ratings v WHERE v.item_id = c.item_id AND v.role = 'annotator') AS n_votes FROM candidates c LEFT JOIN priority p ON p.item_id = c.item_id WHERE eligible ORDER BY prio DESC, n_votes DESC, c.item_id LIMIT 200"


def _target(s: SparkSession, d: str) -> DataFrame:
    return target.target_set(view(s, d, "candidates"), view(s, d, "ratings"), view(s, d, "priority"), VERSION, 200)


@query("SELECT * FROM target", "candidates", "ratings", "priority", target=_TARGET)
def w01_target_set(s: SparkSession, d: str) -> DataFrame:
    """W01, J03; the limit is the operator's own (a top-k)."""
    return _target(s, d)


@query(f"SELECT item_id, prio, n_votes FROM target t WHERE {_NOT_DONE.format(t='ratings', x='t')} AND {_NOT_DONE.format(t='failures', x='t')}", "candidates", "ratings", "failures", "priority", target=_TARGET)
def w02_pending_in_target(s: SparkSession, d: str) -> DataFrame:
    """W02, W03."""
    return target.pending_in_target(_target(s, d), view(s, d, "ratings"), view(s, d, "failures"), "a2", VERSION)


@query(
    "SELECT model_key, in_target, done, failed, greatest(0, in_target - done - failed) AS pending FROM (SELECT k.model_key, (SELECT count(*) FROM target) AS in_target, (SELECT count(*) FROM ratings v JOIN target t ON t.item_id = v.item_id WHERE v.role = 'annotator' AND v.model_key = k.model_key) AS done, (SELECT count(DISTINCT f.item_id) FROM failures f JOIN target t ON t.item_id = f.item_id WHERE f.role = 'annotator' AND f.model_key = k.model_key) AS failed FROM (VALUES ('a1'), ('a2'), ('a3'), ('a9')) k(model_key)) x",
    "candidates", "ratings", "failures", "priority", target=_TARGET,
)
def a07_target_progress(s: SparkSession, d: str) -> DataFrame:
    """A07, J01, J02."""
    models = s.createDataFrame([(m,) for m in (*LINEUP, "a9")], "model_key string")
    return target.progress(_target(s, d), view(s, d, "ratings"), view(s, d, "failures"), models, VERSION)


@query("SELECT count(*) AS complete FROM (SELECT v.item_id FROM ratings v JOIN target t ON t.item_id = v.item_id WHERE v.role = 'annotator' AND v.model_key IN ('a1', 'a2', 'a3') GROUP BY v.item_id HAVING count(DISTINCT v.model_key) = 3) x", "candidates", "ratings", "priority", target=_TARGET)
def a07_target_complete(s: SparkSession, d: str) -> DataFrame:
    return target.complete(_target(s, d), view(s, d, "ratings"), LINEUP, VERSION)


@query("SELECT model_key, role, count(*) AS done, avg(duration_ms) AS avg_ms FROM ratings GROUP BY model_key, role", "ratings")
def a05_model_progress(s: SparkSession, d: str) -> DataFrame:
    return target.model_progress(view(s, d, "ratings"), VERSION)


@query("SELECT model_key, role, count(DISTINCT item_id) AS failed FROM failures GROUP BY model_key, role", "failures")
def a06_failure_counts(s: SparkSession, d: str) -> DataFrame:
    return target.failure_counts(view(s, d, "failures"), VERSION)


@query("SELECT DISTINCT item_id FROM ratings WHERE role = 'annotator'", "ratings")
def a26_annotated_items(s: SparkSession, d: str) -> DataFrame:
    """A26, O08."""
    return target.annotated_items(view(s, d, "ratings"), VERSION)


@query(
    "SELECT k.model_key, k.role, coalesce(done, 0) AS done, coalesce(failed, 0) AS failed, CASE WHEN k.role = 'annotator' THEN greatest(0, (SELECT count(*) FROM candidates WHERE eligible) - coalesce(done, 0)) END AS pending, round(avg_ms / 1000, 2) AS avg_s FROM (VALUES ('a1', 'annotator'), ('a2', 'annotator'), ('a3', 'annotator'), ('new', 'annotator'), ('senior', 'adjudicator')) k(model_key, role) "
    "LEFT JOIN (SELECT model_key, role, count(*) AS done, avg(duration_ms) AS avg_ms FROM ratings GROUP BY ALL) p ON p.model_key = k.model_key AND p.role = k.role LEFT JOIN (SELECT model_key, role, count(DISTINCT item_id) AS failed FROM failures GROUP BY ALL) f ON f.model_key = k.model_key AND f.role = k.role",
    "candidates", "ratings", "failures",
)
def a32_status(s: SparkSession, d: str) -> DataFrame:
    models = s.createDataFrame([("a1", "annotator"), ("a2", "annotator"), ("a3", "annotator"), ("new", "annotator"), ("senior", "adjudicator")], "model_key string, role string")
    return target.status(models, view(s, d, "ratings"), view(s, d, "failures"), view(s, d, "candidates").filter("eligible"), VERSION)


@query("SELECT k.model_key, k.pos::INT AS pos, coalesce(n, 0) AS done FROM (VALUES ('a3', 0), ('a1', 1), ('a2', 2), ('new', 3)) k(model_key, pos) LEFT JOIN (SELECT model_key, count(*) AS n FROM ratings WHERE role = 'annotator' GROUP BY 1) v ON v.model_key = k.model_key", "ratings")
def w04_least_done_first(s: SparkSession, d: str) -> DataFrame:
    return target.least_done_first(s.createDataFrame([("a3", 0), ("a1", 1), ("a2", 2), ("new", 3)], "model_key string, pos int"), view(s, d, "ratings"), VERSION)


@query("SELECT model_key, role, prompt_version, endpoint, model_digest, count(*) AS n FROM ratings GROUP BY ALL", "ratings")
def a10_provenance(s: SparkSession, d: str) -> DataFrame:
    return export.provenance(view(s, d, "ratings"))


# --- history, caps ------------------------------------------------------------------------------------------------------

_WIN = {"n_48": 48, "n_168": 168, "n_720": 720, "n_all": None}
_HIST = "SELECT item_id, author, us, " + ", ".join(f"least(5, count(*) OVER (PARTITION BY author ORDER BY us RANGE BETWEEN {'UNBOUNDED' if h is None else h * history.HOUR} PRECEDING AND 1 PRECEDING))::INT AS {n}" for n, h in _WIN.items()) + " FROM history"


@query("SELECT item_id, n_48, n_168, n_720, n_all FROM h", "history", h=_HIST)
def w09_author_history(s: SparkSession, d: str) -> DataFrame:
    """W09, J14."""
    return history.history_counts(view(s, d, "history")).select("item_id", *_WIN)


@query(" UNION ALL ".join(f"SELECT '{w}' AS \"window\", count(*) AS n_rows, round(avg(({n} >= 1)::INT), 4) AS at_least_1, round(avg(({n} >= 3)::INT), 4) AS at_least_3, round(avg(({n} >= 5)::INT), 4) AS \"full\", round(avg({n}), 3) AS mean_available FROM h" for w, n in (("48h", "n_48"), ("7d", "n_168"), ("30d", "n_720"), ("unbounded", "n_all"))), "history", h=_HIST)
def a23_coverage(s: SparkSession, d: str) -> DataFrame:
    """A23, X16, X26."""
    return history.coverage(history.history_counts(view(s, d, "history")))


@query(
    """SELECT item_id, string_agg(before::VARCHAR, ',' ORDER BY us, before) AS ids FROM (
      SELECT q.item_id, h.item_id AS before, h.us, row_number() OVER (PARTITION BY q.item_id ORDER BY h.us DESC, h.item_id DESC) AS r
      FROM tied q JOIN tied h ON h.author = q.author AND h.us < q.us AND h.us >= q.us - 172800000000) x WHERE r <= 5 GROUP BY item_id
    UNION ALL SELECT item_id, '' FROM tied q WHERE NOT EXISTS (SELECT 1 FROM tied h WHERE h.author = q.author AND h.us < q.us AND h.us >= q.us - 172800000000)""",
    "tied",
)
def w10_last_posts(s: SparkSession, d: str) -> DataFrame:
    """W10, with many rows of an author at one time and rows without author or time."""
    return history.last_posts(view(s, d, "tied")).select("item_id", F.array_join(F.transform("history", lambda x: x.cast("string")), ",").alias("ids"))


@query("SELECT item_id, event_type, day FROM (SELECT *, row_number() OVER (PARTITION BY event_type, day ORDER BY sha256(item_id::STRING), item_id) AS r FROM history) x WHERE r <= 5", "history")
def w05_daily_sample(s: SparkSession, d: str) -> DataFrame:
    return history.daily_sample(view(s, d, "history"), ["event_type", "day"], "item_id", 5).select("item_id", "event_type", "day")


@query("SELECT item_id, day FROM (SELECT *, row_number() OVER (PARTITION BY day ORDER BY us DESC, item_id) AS r FROM history) x WHERE r <= 7", "history")
def w07_newest_per_day(s: SparkSession, d: str) -> DataFrame:
    """W07, Z06 as a batch."""
    return history.first_k(view(s, d, "history"), ["day"], [F.desc("us"), F.col("item_id")], 7).select("item_id", "day")


@query("SELECT item_id FROM (SELECT *, row_number() OVER (PARTITION BY submission_item ORDER BY created_s, item_id) AS r FROM corpus WHERE record_type = 'comment' AND depth <= 1 AND body NOT IN ('[deleted]', '[removed]')) x WHERE r <= 3", "corpus")
def w06_kept_comments(s: SparkSession, d: str) -> DataFrame:
    """F10, W06."""
    return history.kept_comments(view(s, d, "corpus").filter("record_type = 'comment'"), 1, 3).select("item_id")


@query("SELECT item_id, CASE WHEN us < 1704499200000000 THEN 'stop' WHEN us >= 1705708800000000 THEN 'skip_newer' WHEN item_id % 7 >= 5 THEN 'skip_full' ELSE 'take' END AS action FROM history", "history")
def f20_calendar_action(s: SparkSession, d: str) -> DataFrame:
    """F20, F11."""
    return view(s, d, "history").select("item_id", history.calendar_action(F.col("us"), F.lit(1704499200000000), F.lit(1705708800000000), F.col("item_id") % 7, 5).alias("action"))


# --- threads ------------------------------------------------------------------------------------------------------------

_UP = "WITH RECURSIVE corpus AS (" + duck("corpus") + "), up AS (SELECT item_id, parent_item AS p, 0 AS k, '' AS chain FROM corpus UNION ALL SELECT u.item_id, c.parent_item, u.k + 1, c.item_id || '>' || u.chain FROM up u JOIN corpus c ON c.item_id = u.p AND c.record_type = 'comment') "


@query(_UP + "SELECT item_id, arg_max(chain, k) AS chain FROM up GROUP BY item_id")
def g01_ancestors(s: SparkSession, d: str) -> DataFrame:
    """G01, G06, J16."""
    got = threads.ancestors(view(s, d, "corpus"), threads.ANCESTORS)
    return got.select("item_id", F.concat(F.array_join(F.transform("chain", lambda x: x["item_id"]), ">"), F.when(F.size("chain") > 0, ">").otherwise("")).alias("chain"))


@query(_UP + "SELECT u.item_id, max(k)::INT AS depth_found FROM up u JOIN corpus c ON c.item_id = u.item_id WHERE c.record_type = 'comment' GROUP BY u.item_id")
def g02_depths(s: SparkSession, d: str) -> DataFrame:
    return threads.depths(view(s, d, "corpus")).select("item_id", F.col("depth_found").cast("int").alias("depth_found"))


@query("SELECT parent_item, string_agg(item_id, ',' ORDER BY created_s, item_id) AS replies FROM (SELECT *, row_number() OVER (PARTITION BY parent_item ORDER BY created_s, item_id) AS r FROM corpus WHERE parent_item IS NOT NULL) x WHERE r <= 3 GROUP BY parent_item", "corpus")
def j15_first_replies(s: SparkSession, d: str) -> DataFrame:
    """J15, W15, A35."""
    return threads.children(view(s, d, "corpus")).select("parent_item", F.array_join(F.transform("replies", lambda r: r["item_id"]), ",").alias("replies"))


@query(_UP + ", line AS (SELECT u.item_id, max(k) AS indent FROM up u GROUP BY u.item_id) SELECT c.item_id, c.submission_item, (CASE WHEN c.record_type = 'comment' THEN l.indent + 1 ELSE 0 END)::INT AS indent FROM corpus c JOIN line l ON l.item_id = c.item_id")
def g03_thread_lines(s: SparkSession, d: str) -> DataFrame:
    return threads.pre_order(view(s, d, "corpus")).select("item_id", "submission_item", F.col("indent").cast("int").alias("indent"))


_STRIP = r"regexp_replace(coalesce({0}, ''), '^\s+|\s+$', '', 'g')".format
_RSTRIP = r"regexp_replace({0}, '\s+$', '')".format
_CUT = lambda x, n: f"CASE WHEN length({_STRIP(x)}) <= {n} THEN {_STRIP(x)} ELSE {_RSTRIP(f'left({_STRIP(x)}, {n} - 1)')} || '…' END"
_OP = "CASE WHEN coalesce(is_submitter <> 0, false) THEN ' (OP)' ELSE '' END"
_CONTEXT_SQL = (
    f"WITH RECURSIVE corpus AS ({duck('corpus')}), anc AS (SELECT item_id, parent_item AS up, 0 AS k, NULL::INT AS depth, NULL::INT AS is_submitter, NULL::VARCHAR AS text FROM corpus WHERE record_type = 'comment' "
    "UNION ALL SELECT a.item_id, p.parent_item, k + 1, p.depth, p.is_submitter, p.text FROM anc a JOIN corpus p ON p.item_id = a.up AND p.record_type = 'comment' WHERE k < 6), "
    f"up AS (SELECT item_id, string_agg('[PARENT depth=' || coalesce(depth::VARCHAR, 'None') || {_OP} || '] ' || CASE WHEN k <= 2 THEN {_CUT('text', 500)} ELSE {_CUT('text', 300)} END, chr(10) ORDER BY k DESC) AS t FROM anc WHERE k > 0 GROUP BY item_id), "
    f"kid AS (SELECT parent_item, string_agg('[REPLY ' || r || {_OP} || '] ' || {_CUT('text', 200)}, chr(10) ORDER BY r) AS t FROM (SELECT *, row_number() OVER (PARTITION BY parent_item ORDER BY created_s, item_id) AS r FROM corpus WHERE parent_item IS NOT NULL) x WHERE r <= 3 GROUP BY parent_item), "
    "post AS (SELECT item_id, coalesce(title, '') AS title, {middle} AS body FROM corpus WHERE record_type = 'submission') "
    "SELECT item_id, CASE WHEN length(t) > 6000 THEN {cut} || '…' ELSE t END AS context_text FROM (SELECT c.item_id, concat_ws(chr(10), '=== THREAD CONTEXT ===', '[SUBMISSION r/' || c.subreddit || '] ' || CASE WHEN c.record_type <> 'comment' THEN '(the TARGET below is this submission)' WHEN p.item_id IS NULL THEN '(submission not collected)' ELSE p.title END, "
    "CASE WHEN c.record_type = 'comment' THEN nullif(p.body, '') END, up.t, kid.t) AS t FROM corpus c LEFT JOIN post p ON p.item_id = c.submission_item AND c.record_type = 'comment' LEFT JOIN up ON up.item_id = c.item_id LEFT JOIN kid ON kid.parent_item = c.item_id) z"
)
_LONG_BODY = f"CASE WHEN length({_STRIP('selftext')}) <= 1500 THEN {_STRIP('selftext')} ELSE " + _RSTRIP("left(" + _STRIP("selftext") + ", 1200)") + r" || chr(10) || '[…]' || chr(10) || regexp_replace(right(" + _STRIP("selftext") + r", 300), '^\s+', '') END"


G04 = _CONTEXT_SQL.replace("{middle}", _LONG_BODY).replace("{cut}", _RSTRIP("left(t, 6000)"))


@query(G04)
def g04_contexts(s: SparkSession, d: str) -> DataFrame:
    """G04, X08."""
    return threads.contexts(view(s, d, "corpus")).select("item_id", "context_text")


# --- review, export, views ----------------------------------------------------------------------------------------------


@query("SELECT CASE WHEN completed = 1 THEN 'completed' ELSE reason END AS bucket, count(*) AS n FROM queue GROUP BY 1", "queue")
def a08_queue_counts(s: SparkSession, d: str) -> DataFrame:
    """A08, A25, F15."""
    return review.queue_counts(view(s, d, "queue"))


@query(_with("SELECT item_id, try_cast(split_part(sarcasm_votes, '-', 2) AS INT) > 0 OR try_cast(split_part(sarcasm_votes, '-', 1) AS INT) < 2 AS split FROM agg"))
def w13_split_votes(s: SparkSession, d: str) -> DataFrame:
    return _aggregates(s, d).select("item_id", review.is_split_vote(F.col("sarcasm_votes")).alias("split"))


def _exported(s: SparkSession, d: str) -> DataFrame:
    c, r, h = view(s, d, "candidates"), view(s, d, "ratings"), view(s, d, "reviews")
    docs = c.select("item_id", F.lit("comment").alias("record_type"), F.col("source").alias("subreddit"), F.lit(0).alias("created_s"), F.lit(None).cast("string").alias("submission_item"), F.lit(None).cast("string").alias("parent_item"), F.lit(0).alias("depth"), F.col("source").alias("author_hash"), F.lit("natural").alias("sampling_strategy"), F.lit(None).cast("int").alias("is_self"), F.lit(None).cast("string").alias("title"), F.lit(None).cast("string").alias("selftext"), "text")
    lid = docs.select("item_id", language.identify(F.col("text")).alias("r")).select("item_id", "r.*")
    return export.rows(export.gate(_aggregates(s, d), c), docs, r, votes.per_label_resolution(r, h, LINEUP, VERSION), lid, h, c, VERSION, "d1", LINEUP)


_EXP = "exported AS (SELECT g.*, l.yes, l.n, CASE WHEN l.n > 0 AND 2 * l.yes <> l.n THEN 2 * l.yes > l.n ELSE g.sarcastic_final::BOOLEAN END AS majority, c.source FROM agg g JOIN candidates c ON c.item_id = g.item_id AND c.eligible JOIN (SELECT item_id, sum(sarcastic) AS yes, count(sarcastic) AS n FROM lineup GROUP BY item_id) l ON l.item_id = g.item_id WHERE g.resolved_by IS NOT NULL)"


@query(_with(f", {_EXP} SELECT count(*) AS n, sum((sarcastic_final = 1)::INT)::BIGINT AS shipped_positives, sum(majority::INT)::BIGINT AS majority_positives, sum((sarcastic_final = 1 AND majority)::INT)::BIGINT AS both_positive, sum((sarcastic_final::BOOLEAN <> majority)::INT)::BIGINT AS rows_that_differ, round((avg((sarcastic_final::BOOLEAN = majority)::INT) - (avg(sarcastic_final) * avg(majority::INT) + (1 - avg(sarcastic_final)) * (1 - avg(majority::INT)))) / (1 - (avg(sarcastic_final) * avg(majority::INT) + (1 - avg(sarcastic_final)) * (1 - avg(majority::INT)))), 4) AS kappa FROM exported WHERE sarcastic_final IS NOT NULL AND majority IS NOT NULL", _AGG, "candidates"))
def a20_label_sets(s: SparkSession, d: str) -> DataFrame:
    """A20, T02."""
    return export.label_sets(_exported(s, d))


@query(_with(f", {_EXP} SELECT sum(n)::BIGINT AS exported_rows, sum(CASE WHEN s = 1 THEN n ELSE 0 END)::BIGINT AS sarcastic_positives, min(n) AS min_language_x_sarcastic_cell FROM (SELECT language_final AS l, sarcastic_final AS s, count(*) AS n FROM exported GROUP BY ALL) x", _AGG, "candidates"))
def a21_readiness(s: SparkSession, d: str) -> DataFrame:
    return export.readiness(_exported(s, d))


_WORD = "CASE sarcastic_final WHEN 1 THEN 'true' WHEN 0 THEN 'false' END"
_DIMS = {
    "sarcastic": _WORD, "language": "language_final", "literal_sentiment": "literal_final", "intended_sentiment": "intended_final", "resolved_by": "resolved_by", "subreddit": "source", "record_type": "'comment'", "sampling_strategy": "'natural'", "is_text_only": "'true'",
    "sarcastic_by_language": f"coalesce(language_final, 'None') || '|sarcastic=' || coalesce({_WORD}, 'None')", "sarcastic_per_label_resolution": "per",
}
_PER_SARCASTIC = (
    "per AS (SELECT b.item_id, CASE WHEN h.item_id IS NOT NULL THEN 'human' WHEN a.item_id IS NOT NULL THEN 'adjudicator' WHEN b.s IS NULL THEN 'unresolved' WHEN b.yes = 0 OR b.yes = b.n THEN 'unanimous' ELSE 'majority' END AS per FROM b "
    "LEFT JOIN (SELECT DISTINCT item_id FROM ratings WHERE role = 'adjudicator') a ON a.item_id = b.item_id LEFT JOIN (SELECT item_id FROM reviews WHERE is_gold = 0) h ON h.item_id = b.item_id)"
)


@query(
    _with(
        f", {_EXP}, {_PER_SARCASTIC}, cell AS (SELECT unnest({_LIST(_DIMS)}) AS dim, unnest([{', '.join(_DIMS.values())}]) AS value FROM exported e LEFT JOIN per p ON p.item_id = e.item_id) SELECT dim, coalesce(value, 'None') AS value, count(*) AS n FROM cell GROUP BY 1, 2",
        _AGG,
        "candidates",
    )
)
def a19_distributions(s: SparkSession, d: str) -> DataFrame:
    return export.distributions(_exported(s, d))


@query("SELECT DISTINCT c.item_id FROM corpus c WHERE c.item_id IN (SELECT item_id FROM corpus WHERE score > 90) OR c.author_hash IN (SELECT author_hash FROM corpus WHERE score > 90 AND author_hash IS NOT NULL)", "corpus")
def k05_corpus_dump(s: SparkSession, d: str) -> DataFrame:
    """K05, J13."""
    c = view(s, d, "corpus")
    return export.corpus_dump(c, c.filter("score > 90").select("item_id")).select("item_id")


@query("SELECT item_id, prompt_version, max(CASE WHEN model_key = 'a1' THEN rationale END) AS a1, max(CASE WHEN model_key = 'a2' THEN rationale END) AS a2, max(CASE WHEN model_key = 'a3' THEN rationale END) AS a3 FROM ratings WHERE role = 'annotator' GROUP BY item_id, prompt_version", "ratings")
def a27_rationale_pivot(s: SparkSession, d: str) -> DataFrame:
    """A27, J07."""
    return views.rationale_pivot(view(s, d, "ratings"), LINEUP)


_SHOW = "CASE WHEN length({0}) > 160 THEN substring({0}, 1, 160) || '…' ELSE {0} END".format


@query(f"SELECT c.item_id, c.submission_item, c.record_type, c.depth, c.parent_item, c.created_s, {_SHOW('coalesce(p.title, chr(0)[1:0])')} AS post_title, CASE WHEN c.record_type = 'submission' THEN NULL WHEN c.parent_item = c.submission_item THEN 'post' ELSE c.parent_item END AS reply_to, {_SHOW('c.text')} AS shown FROM corpus c LEFT JOIN corpus p ON p.item_id = c.submission_item AND p.record_type = 'submission'".replace("chr(0)[1:0]", "''"), "corpus")
def p08_browser(s: SparkSession, d: str) -> DataFrame:
    """P07-P10, J06, J09, O02."""
    return views.browser(view(s, d, "corpus"))


@query("SELECT item_id FROM corpus ORDER BY submission_item, record_type <> 'submission', coalesce(depth, 0), coalesce(parent_item, ''), created_s, item_id LIMIT 25 OFFSET 50", "corpus")
def w16_page(s: SparkSession, d: str) -> DataFrame:
    """A page is the operator's own limit."""
    return views.page(view(s, d, "corpus"), views.browsing_order(), 3, 25).select("item_id")


@query("SELECT item_id FROM corpus WHERE contains(lower(text), 'the a')", "corpus")
def f09_search(s: SparkSession, d: str) -> DataFrame:
    return views.masks(view(s, d, "corpus"), needle="The A").select("item_id")


@query("SELECT DISTINCT source FROM documents WHERE source IS NOT NULL")
def o11_facets(s: SparkSession, d: str) -> DataFrame:
    return views.facets(s.read.parquet(f"{d}/documents.parquet"), "source")


_BAND = r"CASE WHEN {0} <= 3 THEN 'short' WHEN {0} <= 5 THEN 'medium' ELSE 'long' END".format
_SENT = r"len(list_filter(regexp_split_to_array(regexp_replace(text, '([.!?…])\s+', '\1' || chr(10), 'g'), '\n+'), lambda p: regexp_matches(p, '[A-Za-zÀ-ÖØ-öø-ÿñÑ]')))"


@query(f"SELECT band, count(*) AS items, round(count(*) / (SELECT count(*) FROM base)::DOUBLE, 4) AS share, round(avg(quality), 4) AS sarcastic_share, round(avg(split::INT), 4) AS split_share FROM (SELECT *, {_BAND(_SENT)} AS band FROM base) x GROUP BY band", base="SELECT d.text, l.quality, d.doc_id % 3 = 0 AS split FROM documents d JOIN labels l ON l.doc_id = d.doc_id")
def a30_length_profile(s: SparkSession, d: str) -> DataFrame:
    """A30, X04, X05."""
    docs, labels = s.read.parquet(f"{d}/documents.parquet"), s.read.parquet(f"{d}/labels.parquet")
    return views.length_profile(docs.join(labels, "doc_id").select("text", F.col("quality").alias("sarcastic_final"), (F.col("doc_id") % 3 == 0).alias("split")))


_LANG = "list_transform(regexp_extract_all(text, '[A-Za-zÀ-ÖØ-öø-ÿ''ñÑ]+'), lambda t: CASE WHEN list_contains({0}, lower(t)) THEN 'tl' WHEN list_contains({1}, lower(t)) THEN 'en' ELSE 'other' END)".format(_LIST(language.TAGALOG), _LIST(language.ENGLISH))
_RATIO = "len(list_filter(k, lambda x: x = '{0}')) / greatest(1, len(k))::DOUBLE".format


@query(f"SELECT doc_id, CASE WHEN len(k) = 0 THEN 'taglish' WHEN {_RATIO('en')} >= 0.9 THEN 'english' WHEN {_RATIO('tl')} >= 0.9 THEN 'tagalog' ELSE 'taglish' END AS language, round({_RATIO('en')}, 4) AS en_ratio, round({_RATIO('tl')}, 4) AS tl_ratio, round({_RATIO('other')}, 4) AS other_ratio FROM (SELECT doc_id, {_LANG} AS k FROM documents) x")
def u01_language(s: SparkSession, d: str) -> DataFrame:
    """U01, U02, X02."""
    return s.read.parquet(f"{d}/documents.parquet").select("doc_id", language.identify(F.col("text")).alias("r")).select("doc_id", "r.*")


@query(_with("SELECT count(*) AS n, round(avg((g.language_final = r.language)::INT), 4) AS agreement FROM agg g JOIN reviews r ON r.item_id = g.item_id WHERE g.language_final IS NOT NULL"))
def t08_lid_agreement(s: SparkSession, d: str) -> DataFrame:
    """T08, J08."""
    return agreement.lid_agreement(_aggregates(s, d), view(s, d, "reviews"))


@query("SELECT page_id, (i - 1)::INT AS pos, l[i] AS href FROM (SELECT page_id, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT page_id, regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1) AS l FROM pages) x) y")
def s09_page_links(s: SparkSession, d: str) -> DataFrame:
    """S09 for attribute-only queries."""
    return markup.links(s.read.parquet(f"{d}/pages.parquet"))


@query("SELECT event_type, day, count(*) AS n, sum(CAST(json_extract_string(props, '$.k') AS BIGINT))::BIGINT AS k FROM (SELECT *, CAST(ts AS DATE) AS day FROM events) x GROUP BY event_type, day")
def x25_json_daily(s: SparkSession, d: str) -> DataFrame:
    """X12, X25."""
    e = s.read.parquet(f"{d}/events.parquet")
    return e.groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count("*").alias("n"), F.sum(F.get_json_object("props", "$.k").cast("long")).alias("k"))


@query("SELECT item_id, reason, (CASE WHEN completed = 1 OR item_id IN (SELECT item_id FROM reviews) THEN 1 ELSE 0 END)::INT AS completed FROM queue", "queue", "reviews")
def m04_completed_queue(s: SparkSession, d: str) -> DataFrame:
    return state.completed(view(s, d, "queue"), view(s, d, "reviews"))


@query("SELECT item_id, reason, completed FROM queue WHERE item_id NOT IN (SELECT item_id FROM more) UNION ALL SELECT * FROM more", "queue", more="SELECT 'd' || (doc_id * 7)::STRING AS item_id, 'gold' AS reason, 0::INT AS completed FROM documents WHERE doc_id % 5 = 0")
def m01_upsert(s: SparkSession, d: str) -> DataFrame:
    more = s.read.parquet(f"{d}/documents.parquet").filter("doc_id % 5 = 0").select(F.concat(F.lit("d"), (F.col("doc_id") * 7).cast("string")).alias("item_id"), F.lit("gold").alias("reason"), F.lit(0).alias("completed"))
    table = KeyedTable.create(view(s, d, "queue"), folder(s), ["item_id"])
    table.upsert(more)
    return table.read()


@query("SELECT item_id, reason, completed FROM queue UNION ALL SELECT * FROM more WHERE item_id NOT IN (SELECT item_id FROM queue)", "queue", more="SELECT 'd' || (doc_id * 7)::STRING AS item_id, 'gold' AS reason, 0::INT AS completed FROM documents WHERE doc_id % 5 = 0")
def m02_insert_new(s: SparkSession, d: str) -> DataFrame:
    """M02, M03, F12, Z07."""
    more = s.read.parquet(f"{d}/documents.parquet").filter("doc_id % 5 = 0").select(F.concat(F.lit("d"), (F.col("doc_id") * 7).cast("string")).alias("item_id"), F.lit("gold").alias("reason"), F.lit(0).alias("completed"))
    table = KeyedTable.create(view(s, d, "queue"), folder(s), ["item_id"])
    table.insert_new(more)
    return table.read()


@query("SELECT item_id, month FROM (SELECT *, row_number() OVER (PARTITION BY month ORDER BY sha256('13|' || item_id), item_id) AS r FROM (SELECT item_id, source AS month FROM candidates WHERE source IN ('src1', 'src2') AND item_id NOT IN (SELECT item_id FROM queue)) x) y WHERE r <= CASE month WHEN 'src1' THEN 3 ELSE 2 END", "candidates", "queue")
def w14_extension_sample(s: SparkSession, d: str) -> DataFrame:
    """W14, J18 (a source plays the month)."""
    return state.extension_sample(view(s, d, "candidates").select("item_id", F.col("source").alias("month")), view(s, d, "queue"), {"src1": 3, "src2": 2})


@query("SELECT state, count(*) AS n FROM (SELECT CASE WHEN e.item_id IS NOT NULL THEN 'already_done' WHEN f.item_id IS NOT NULL THEN 'skipped_failed' WHEN c.item_id IS NULL THEN 'no_record' WHEN r.item_id IS NULL THEN 'no_context' ELSE 'pending' END AS state FROM (SELECT item_id FROM queue WHERE reason = 'gold') q LEFT JOIN (SELECT DISTINCT item_id FROM evaluations) e ON e.item_id = q.item_id LEFT JOIN (SELECT DISTINCT item_id FROM failures) f ON f.item_id = q.item_id LEFT JOIN (SELECT item_id FROM candidates WHERE eligible) c ON c.item_id = q.item_id LEFT JOIN (SELECT DISTINCT item_id FROM ratings) r ON r.item_id = q.item_id) x GROUP BY state", "queue", "evaluations", "failures", "candidates", "ratings")
def j20_evaluation_queue(s: SparkSession, d: str) -> DataFrame:
    """J20, F21, F22."""
    q = view(s, d, "queue").filter("reason = 'gold'")
    snapshots = view(s, d, "ratings").select("item_id", "prompt_version").distinct()
    return language.evaluation_queue(q, view(s, d, "evaluations"), view(s, d, "failures"), view(s, d, "candidates").filter("eligible"), snapshots, VERSION).groupBy("state").agg(F.count("*").alias("n"))


@query("SELECT item_id, epoch_us(created)::BIGINT AS us FROM (SELECT item_id, to_timestamp(created_s) AS created FROM corpus) x", "corpus")
def x10_timestamps(s: SparkSession, d: str) -> DataFrame:
    """ISO text with a +0000 offset, or digits, in turn."""
    c = view(s, d, "corpus")
    iso = F.date_format(F.timestamp_seconds("created_s"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+0000'")
    raw = F.when(F.col("created_s") % 2 == 0, iso).otherwise(F.concat(F.col("created_s").cast("string"), F.lit("000")))
    return c.select("item_id", F.unix_micros(timeutil.parse_timestamp(raw)).alias("us"))


_ISO = "strftime(to_timestamp(created_s) AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%SZ')"


@query(f"SELECT (SELECT min(t) FROM c WHERE t >= '2000') AS corpus_from, (SELECT max(t) FROM c WHERE t >= '2000') AS corpus_to, min(t) AS exported_from, max(t) AS exported_to FROM c WHERE score > 90", "corpus", c=f"SELECT score, CASE WHEN score % 10 = 3 THEN '1970' ELSE {_ISO} END AS t FROM corpus")
def a22_collection_window(s: SparkSession, d: str) -> DataFrame:
    """A22, F18."""
    iso = F.date_format(F.timestamp_seconds("created_s"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    c = view(s, d, "corpus").withColumn("created_utc", F.when(F.col("score") % 10 == 3, "1970").otherwise(iso))
    return export.collection_window(c, c.filter("score > 90"))


@query(_with("SELECT count(*) AS n, sum((sarcastic_final = 1)::INT)::BIGINT AS positives, round(sum((sarcastic_final = 1)::INT) / greatest(1, count(*)), 4) AS share FROM agg"))
def a33_positive_share(s: SparkSession, d: str) -> DataFrame:
    return views.positive_share(_aggregates(s, d))


@query("SELECT parent_item, count(*) AS n_replies FROM corpus WHERE parent_item IS NOT NULL GROUP BY parent_item", "corpus")
def a35_reply_counts(s: SparkSession, d: str) -> DataFrame:
    return views.children_count(view(s, d, "corpus"))


@query(_with("SELECT a.item_id, a.sarcastic_final, c.source, p.a1 FROM agg a JOIN candidates c ON c.item_id = a.item_id LEFT JOIN (SELECT item_id, max(rationale) AS a1 FROM ratings WHERE role = 'annotator' AND model_key = 'a1' GROUP BY item_id) p ON p.item_id = a.item_id WHERE contains(lower(c.text), 'the') AND a.language_final IN ('english', 'taglish')", _AGG, "candidates"))
def j06_annotated_frame(s: SparkSession, d: str) -> DataFrame:
    """J05, J06, J07, F09, P10."""
    c = view(s, d, "candidates").select("item_id", F.col("item_id").alias("submission_item"), "text", F.col("source").alias("subreddit"), F.lit(None).cast("string").alias("title"))
    rows = views.annotated(_aggregates(s, d), c, view(s, d, "ratings"), LINEUP)
    return views.masks(rows, needle="THE", languages=["english", "taglish"]).select("item_id", "sarcastic_final", F.col("subreddit").alias("source"), "a1")


@query("SELECT page_id, split_part(split_part(url, '://', 2), '/', 1) AS host, count(*) OVER (PARTITION BY split_part(split_part(url, '://', 2), '/', 1)) AS n FROM pages")
def a31_host_counts(s: SparkSession, d: str) -> DataFrame:
    """A31, X28 over page addresses."""
    p = s.read.parquet(f"{d}/pages.parquet").select("page_id", F.parse_url("url", F.lit("HOST")).alias("host"))
    return p.join(p.groupBy("host").agg(F.count("*").alias("n")), "host").select("page_id", "host", "n")


@query("SELECT c.item_id FROM corpus c WHERE record_type = 'comment' AND EXISTS (SELECT 1 FROM corpus p WHERE p.item_id = c.submission_item AND p.record_type = 'submission' AND p.is_self = 1)", "corpus")
def j19_comments_of_self_posts(s: SparkSession, d: str) -> DataFrame:
    """J19, O06, O07 as semi joins."""
    c = view(s, d, "corpus")
    posts = c.filter("record_type = 'submission' AND is_self = 1").select(F.col("item_id").alias("submission_item"))
    return c.filter("record_type = 'comment'").join(posts, "submission_item", "left_semi").select("item_id")


@query(f"SELECT item_id, {_TOK.format("coalesce(text, '')")} AS tokens FROM corpus", "corpus")
def x02_token_counts(s: SparkSession, d: str) -> DataFrame:
    """X02."""
    return view(s, d, "corpus").select("item_id", text.tokens(F.coalesce("text", F.lit(""))).alias("tokens"))
