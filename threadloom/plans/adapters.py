"""Views of the driver's tables in the engine's shapes. The text is SQL that both Spark and DuckDB run; a view is a deterministic
stand-in for forum data, so that every operator has something to work on and an oracle to be held against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_S = "CAST({} AS STRING)".format

CORPUS = f"""
SELECT item_id, record_type, subreddit, submission_item, parent_item, depth, created_s, author, author_hash, author_status, is_submitter, is_bot, distinguished, stickied,
  is_self, score, sampling_strategy, matched_query_or_keyword, title, selftext, body, CASE WHEN record_type = 'submission' THEN trim(title || chr(10) || chr(10) || selftext) ELSE body END AS text, permalink
FROM (SELECT CASE WHEN turn = 0 THEN 't3_' ELSE 't1_' END || {_S("conv_id")} || '_' || {_S("turn")} AS item_id,
  CASE WHEN turn = 0 THEN 'submission' ELSE 'comment' END AS record_type, 'sub' || {_S("conv_id % 3")} AS subreddit, 't3_' || {_S("conv_id")} || '_0' AS submission_item,
  CASE WHEN turn > 0 THEN CASE WHEN turn <= 2 THEN 't3_' ELSE 't1_' END || {_S("conv_id")} || '_' || {_S("CAST(floor((turn - 1) / 2) AS BIGINT)")} END AS parent_item,
  CAST(CASE WHEN turn = 0 THEN NULL WHEN turn <= 2 THEN 0 WHEN turn <= 6 THEN 1 ELSE 2 END AS INT) AS depth, 1780300800 + conv_id * 3600 + turn * 60 AS created_s,
  role || '_' || {_S("(conv_id * 7 + turn * 3) % 40")} AS author, CASE WHEN (conv_id + turn) % 17 <> 0 THEN md5(role || '_' || {_S("(conv_id * 7 + turn * 3) % 40")}) END AS author_hash,
  CASE WHEN (conv_id + turn) % 17 = 0 THEN 'deleted' ELSE 'pseudonymized' END AS author_status, CAST(CASE WHEN turn > 0 THEN CASE WHEN turn % 3 = 0 THEN 1 ELSE 0 END END AS INT) AS is_submitter,
  CAST(CASE WHEN role = 'system' THEN 1 ELSE 0 END AS INT) AS is_bot, CASE WHEN conv_id % 13 = 0 THEN 'moderator' END AS distinguished, CAST(CASE WHEN conv_id % 26 = 0 THEN 1 ELSE 0 END AS INT) AS stickied,
  CAST(CASE WHEN turn = 0 THEN CASE WHEN conv_id % 4 <> 0 THEN 1 ELSE 0 END END AS INT) AS is_self, (conv_id * 13 + turn * 5) % 97 AS score,
  CASE WHEN turn = 0 THEN CASE WHEN conv_id % 3 = 0 THEN 'keyword_oversampled' ELSE 'natural' END WHEN conv_id % 5 <> 0 THEN 'natural' END AS sampling_strategy,
  CASE WHEN turn = 0 AND conv_id % 3 = 0 THEN CASE WHEN conv_id % 2 = 0 THEN '2026-06-01' ELSE 'edi wow' END END AS matched_query_or_keyword,
  CASE WHEN turn = 0 THEN substring(text, 1, 40) END AS title, CASE WHEN turn = 0 THEN CASE WHEN conv_id % 4 = 0 THEN '' ELSE substring(text, 41) END END AS selftext,
  CASE WHEN turn > 0 THEN CASE WHEN turn = 3 AND conv_id % 9 = 1 THEN 'Happy   birthdayyyy po, hahaha!' WHEN turn = 4 AND conv_id % 7 = 2 THEN 'ok' WHEN turn = 5 AND conv_id % 5 = 3 THEN '[deleted]'
    WHEN turn = 2 AND conv_id % 11 = 4 THEN 'see https://example.org/x **now** [this](http://a.b/c)' WHEN turn = 1 AND conv_id % 10 = 6 THEN 'Thank you but edi wow talaga' ELSE text END END AS body,
  '/r/sub' || {_S("conv_id % 3")} || '/comments/' || {_S("conv_id")} || '/' AS permalink
  FROM {{conversations}}) x
"""

_THREE = "CASE {} WHEN 0 THEN '{}' WHEN 1 THEN '{}' ELSE '{}' END".format
_VOTE = f"""
SELECT 'd' || {_S("d.doc_id")} AS item_id, {{key}} AS model_key, 'v3' AS prompt_version, '{{role}}' AS role,
  {_THREE("(d.doc_id * 3 + r * (d.doc_id % 4)) % 3", "english", "tagalog", "taglish")} AS language, {_THREE("(d.doc_id + r * (d.doc_id % 3)) % 3", "positive", "neutral", "negative")} AS literal_sentiment,
  {_THREE("(d.doc_id * 2 + r * (d.doc_id % 2)) % 3", "positive", "neutral", "negative")} AS intended_sentiment, CAST(CASE WHEN d.doc_id % (r + 3) = 0 THEN 1 - quality ELSE quality END AS INT) AS sarcastic,
  CAST((d.doc_id + r) % 2 AS INT) AS cue_polarity_inversion, CAST(CASE WHEN (d.doc_id * 5 + r) % 3 = 0 THEN 1 ELSE 0 END AS INT) AS cue_rhetorical_intent,
  CAST(CASE WHEN (d.doc_id + r * 2) % 5 = 0 THEN 1 ELSE 0 END AS INT) AS cue_contextual_incongruity, CAST(CASE WHEN d.doc_id % 7 = r THEN 1 ELSE 0 END AS INT) AS cue_hyperbole,
  CASE WHEN (d.doc_id + r) % 23 <> 0 THEN CAST((d.doc_id * 7 + r * 13) % 101 AS DOUBLE) / 100 END AS confidence, 'r' || {_S("r")} || ' on ' || {_S("d.doc_id")} AS rationale,
  1000 + (d.doc_id * 31 + r * 17) % 500 AS duration_ms, 'e' || {_S("r % 2")} AS endpoint, 'm' || {_S("r")} AS model_digest
FROM {{{{documents}}}} d JOIN {{{{labels}}}} l ON d.doc_id = l.doc_id CROSS JOIN (VALUES {{rs}}) AS t(r) WHERE {{when}}
"""
RATINGS = _VOTE.format(key=f"'a' || {_S('r + 1')}", role="annotator", rs="(0), (1), (2)", when="(d.doc_id + r) % 11 <> 0") + " UNION ALL " + _VOTE.format(key="'senior'", role="adjudicator", rs="(4)", when="d.doc_id % 4 = 1")
EVALUATIONS = _VOTE.format(key="'judge'", role="evaluator", rs="(1), (2)", when="(d.doc_id + r) % 2 = 0")
FAILURES = f"""
SELECT 'd' || {_S("doc_id")} AS item_id, 'a' || {_S("1 + doc_id % 3")} AS model_key, 'v3' AS prompt_version, 'annotator' AS role FROM {{documents}} CROSS JOIN (VALUES (0), (1)) AS t(r) WHERE doc_id % 10 = 3
UNION ALL SELECT 'd' || {_S("doc_id")}, 'senior', 'v3', 'adjudicator' FROM {{documents}} WHERE doc_id % 20 = 7
"""
REVIEWS = f"""
SELECT 'd' || {_S("d.doc_id")} AS item_id, CAST(quality AS INT) AS sarcastic, {_THREE("d.doc_id % 3", "english", "tagalog", "taglish")} AS language, {_THREE("d.doc_id % 3", "positive", "neutral", "negative")} AS literal_sentiment,
  {_THREE("(d.doc_id * 2) % 3", "positive", "neutral", "negative")} AS intended_sentiment, 1 AS cue_polarity_inversion, CAST(NULL AS INT) AS cue_rhetorical_intent, 0 AS cue_contextual_incongruity, 1 AS cue_hyperbole,
  CAST(CASE WHEN d.doc_id % 6 = 0 THEN 1 ELSE 0 END AS INT) AS is_gold, CAST(CASE WHEN d.doc_id % 30 = 0 THEN 1 ELSE 0 END AS INT) AS votes_seen,
  CASE WHEN d.doc_id % 12 = 0 THEN '{{"sarcastic": 1, "language": "english", "literal_sentiment": "positive", "intended_sentiment": "negative"}}' END AS first_pass_json
FROM {{{{documents}}}} d JOIN {{{{labels}}}} l ON d.doc_id = l.doc_id WHERE d.doc_id % 3 = 0
""".replace("{{{{", "{{").replace("}}}}", "}}")
REVIEWS = REVIEWS.replace("'{\"", "'{{\"").replace("\"}'", "\"}}'").replace("{{documents}}", "{documents}").replace("{{labels}}", "{labels}")
CANDIDATES = f"SELECT 'd' || {_S('doc_id')} AS item_id, doc_id % 8 <> 0 AS eligible, doc_id % 40 = 1 AS phatic, text, source FROM {{documents}}"
PRIORITY = f"SELECT 'd' || {_S('doc_id')} AS item_id, CAST(1 + doc_id % 2 AS INT) AS priority FROM {{documents}} WHERE doc_id % 50 = 2"
QUEUE = f"SELECT 'd' || {_S('doc_id')} AS item_id, CASE WHEN doc_id % 2 = 0 THEN 'gold' ELSE 'low_confidence' END AS reason, CAST(CASE WHEN doc_id % 3 = 0 THEN 1 ELSE 0 END AS INT) AS completed FROM {{documents}} WHERE doc_id % 14 = 0 OR doc_id % 21 = 1"
EVENTS = "SELECT event_id AS item_id, user_id AS author, event_type, {us} AS us, CAST(ts AS DATE) AS day, value FROM {events}"

#: Events by the hour, so that an author has many at one time, some without an author, some without a time.
TIED = "SELECT event_id AS item_id, CASE WHEN user_id % 20 <> 7 THEN user_id % 40 END AS author, CASE WHEN event_id % 90 <> 11 THEN {us} - {us} % 3600000000 END AS us FROM {events}"

VIEWS = {"tied": TIED, "corpus": CORPUS, "ratings": RATINGS, "evaluations": EVALUATIONS, "failures": FAILURES, "reviews": REVIEWS, "candidates": CANDIDATES, "priority": PRIORITY, "queue": QUEUE, "history": EVENTS}
TABLES = ("documents", "labels", "conversations", "events")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The view as a DataFrame; only the tables and columns it names are read."""
    text = VIEWS[name].replace("{us}", "unix_micros(CAST(ts AS TIMESTAMP))")
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if "{" + t + "}" in text}
    return spark.sql(text, **used)


def duck(name: str) -> str:
    """The view's text for DuckDB, where the tables are views of their own names."""
    text = VIEWS[name].replace("{us}", "epoch_us(ts)")
    for t in TABLES:
        text = text.replace("{" + t + "}", t)
    return text.replace("{{", "{").replace("}}", "}")
