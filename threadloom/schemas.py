"""Record schemas, label domains and row checks (section 1 of the survey, S04)."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L, _D, _B, _I = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType(), T.IntegerType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


#: One wide row for both kinds of record; record_type tells them apart.
RECORD = _struct(
    record_type=_S, collection_run_id=_S, reddit_id=_S, id=_S, reddit_fullname=_S, subreddit=_S, title=_S, selftext=_S, body=_S, submission_id=_S, link_id=_S,
    parent_id=_S, parent_record_type=_S, created_utc=_S, score=_L, upvote_ratio=_D, num_comments=_L, depth=_I, permalink=_S, url=_S, is_self=_B, is_submitter=_B,
    over_18=_B, spoiler=_B, stickied=_B, locked=_B, archived=_B, distinguished=_S, link_flair_text=_S, is_original_content=_B, num_crossposts=_L, gilded=_L,
    controversiality=_L, author=_S, author_hash=_S, author_status=_S, retrieved_at_utc=_S, sampling_strategy=_S, matched_query_or_keyword=_S,
)
FIXTURE_COMMENT = _struct(
    id=_S, name=_S, link_id=_S, parent_id=_S, subreddit=_S, body=_S, created_utc=_D, score=_L, depth=_I, is_submitter=_B, distinguished=_S, stickied=_B,
    controversiality=_L, permalink=_S, author=_S, gilded=_L,
)
FIXTURE_SUBMISSION = T.StructType(
    [
        *_struct(
            id=_S, name=_S, subreddit=_S, title=_S, selftext=_S, created_utc=_D, score=_L, upvote_ratio=_D, num_comments=_L, permalink=_S, url=_S, is_self=_B,
            over_18=_B, spoiler=_B, stickied=_B, locked=_B, archived=_B, distinguished=_S, link_flair_text=_S, is_original_content=_B, num_crossposts=_L, author=_S, gilded=_L,
        ).fields,
        T.StructField("comments", T.ArrayType(FIXTURE_COMMENT)),
    ]
)
FIXTURE = T.StructType([T.StructField("schema_version", _S), T.StructField("submissions", T.ArrayType(FIXTURE_SUBMISSION))])
MANIFEST = T.StructType([*_struct(collection_run_id=_S, source=_S, started_at_utc=_S, finished_at_utc=_S, subreddit=_S, submissions_stored=_L, comments_stored=_L, duplicates_skipped=_L, status=_S).fields, T.StructField("errors", T.ArrayType(_S))])

LABELS = ("sarcastic", "language", "literal_sentiment", "intended_sentiment")
CUES = ("cue_polarity_inversion", "cue_rhetorical_intent", "cue_contextual_incongruity", "cue_hyperbole")
DOMAINS = {
    "sarcastic": ("0", "1"),
    "language": ("english", "tagalog", "taglish"),
    "literal_sentiment": ("positive", "neutral", "negative"),
    "intended_sentiment": ("positive", "neutral", "negative"),
}
RATING = _struct(
    item_id=_S, model_key=_S, prompt_version=_S, role=_S, language=_S, literal_sentiment=_S, intended_sentiment=_S, sarcastic=_I,
    **{c: _I for c in CUES}, confidence=_D, rationale=_S,
)
