import hmac

import pytest
from pyspark.sql import functions as F

from threadloom.functions import identity, text, timeutil
from threadloom.operators import language


def one(spark, column, **values):
    schema = ", ".join(f"{k} {'string' if isinstance(v, str) or v is None else 'double' if isinstance(v, float) else 'array<string>' if isinstance(v, list) else 'int'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("x")).first()["x"]


def test_normalize(spark):
    assert one(spark, text.normalize(F.col("t")), t="check https://x.com/a **bold** [link](https://y.com)") == "check bold link"
    assert one(spark, text.normalize(F.col("t")), t="  a  b ") == "a b"
    assert one(spark, text.normalize(F.col("t")), t=None) == ""


@pytest.mark.parametrize(
    ("t", "phatic"),
    [
        ("happy birthday po ate", True), ("Thank youuuu so much po", True), ("congrats op!", True), ("good morning everyone haha", True), ("hbd kuya", True), ("commenting to follow", True), ("get well soon", True),
        ("edi congrats", False), ("thanks for nothing", False), ("welcome to the jungle of paperwork", False), ("the traffic was terrible yesterday again", False), ("", False), ("salamat sa lahat pero bakit walang tubig dito ngayon", False),
    ],
)
def test_phatic(spark, t, phatic):
    assert one(spark, text.is_phatic(text.normalize(F.col("t"))), t=t) is phatic


def test_sentences(spark):
    assert one(spark, text.sentence_count(F.col("t")), t="One. Two! 3?\n\nFour… !!") == 3
    assert one(spark, text.length_band(F.col("t")), t="A. B. C. D.") == "medium"
    assert one(spark, text.split_sentences(F.col("t")), t='He said "no." Then left!\nNew line  \n\n ok') == ['He said "no."', "Then left!", "New line", "ok"]


def test_ticked(spark):
    s = F.array(F.lit("a"), F.lit("b"), F.lit("c"))
    assert one(spark, text.join_ticked(F.lit(True), s, F.array(F.lit(True), F.lit(False), F.lit(True))), t="x") == "a\nc"
    assert one(spark, text.join_ticked(F.lit(False), s, F.array(F.lit(True), F.lit(False), F.lit(True))), t="x") is None
    assert one(spark, text.join_ticked(F.lit(True), s, F.array(F.lit(False), F.lit(False), F.lit(False))), t="x") is None


def test_truncate(spark):
    assert one(spark, text.truncate(F.col("t"), 5), t=" abc defgh") == "abc…"
    assert one(spark, text.truncate(F.col("t"), 5), t="abc") == "abc"
    assert one(spark, text.truncate_middle(F.col("t"), 4, 3), t="abcd efgh ijk") == "abcd\n[…]\nijk"


def test_highlight(spark):
    html, missing = text.highlight(F.col("t"), F.col("s"))
    assert one(spark, html, t="a <b> & c\nd", s="<b>\n& c\nzz") == "a <mark>&lt;b&gt;</mark> <mark>&amp; c</mark><br>d"
    assert one(spark, missing, t="a <b> & c\nd", s="<b>\n& c\nzz") == ["zz"]
    assert one(spark, html, t="abcdef", s="abc\nbcd") == "<mark>abcd</mark>ef"
    assert one(spark, html, t="x'y", s=None) == "x&#x27;y"


def test_json_object(spark):
    assert one(spark, text.json_object(F.col("t")), t='<think>{"no": 1}</think> sure: {"a": {"b": 1}} done') == '{"a": {"b": 1}}'
    assert one(spark, text.json_object(F.col("t")), t="none") is None


def test_hmac_is_the_standard_one(spark):
    for key in (b"k", b"x" * 64, b"y" * 80):
        for name in ("alice", "Ñandú ", ""):
            assert one(spark, identity.hmac_sha256(key, F.col("t")), t=name) == hmac.new(key, name.encode(), "sha256").hexdigest()


def test_pseudonym(spark):
    digest, status = identity.pseudonym(F.col("t"), b"k")
    assert one(spark, digest, t="  AliCe ") == hmac.new(b"k", b"alice", "sha256").hexdigest()
    assert [one(spark, status, t=x) for x in ("a", "[deleted]", " ", None)] == ["pseudonymized", "deleted", "deleted", "unavailable"]
    assert one(spark, digest, t="[removed]") is None
    bot = identity.is_bot(F.lit(None).cast("string"), F.col("t"), key=b"k")
    assert one(spark, bot, t=hmac.new(b"k", b"automoderator", "sha256").hexdigest()) is True


def test_identity(spark):
    e = identity.record_identity(F.col("f"), F.col("k"), F.col("a"), F.col("b"))
    assert one(spark, e, f="t3_x", k="submission", a="q", b=None) == "t3_x"
    assert one(spark, e, f="", k="comment", a=None, b="z") == "t1_z"
    assert one(spark, e, f=None, k="comment", a="", b=None) is None


def test_times(spark):
    t = F.unix_micros(timeutil.parse_timestamp(F.col("t")))
    for given in ("2026-08-20T12:22:10.758000+0000", "2026-08-20T12:22:10.758Z", "2026-08-20T20:22:10.758+08:00", "1787228530758"):
        assert one(spark, t, t=given) == 1787228530758000
    assert one(spark, t, t="1787228530") == 1787228530000000
    assert one(spark, t, t="soon") is None
    assert [one(spark, timeutil.window_label(F.col("h")), h=x) for x in (48.0, 168.0, 720.0, 36.0)] == ["48h", "7d", "30d", "36h"]
    assert [one(spark, timeutil.scan_cap(F.col("n")), n=x) for x in (1, 10, 100)] == [300, 800, 4000]
    assert str(one(spark, timeutil.utc_day(F.col("h")), h=1787228530758.0)) == "2026-08-20"


def test_language(spark):
    lang = lambda t: one(spark, language.identify(F.col("t"))["language"], t=t)
    assert lang("the of and is are") == "english"
    assert lang("ang mga sa hindi naman") == "tagalog"
    assert lang("the ang xyz") == "taglish"
    assert one(spark, language.identify(F.col("t"), message_label=F.lit("en"))["language"], t="123") == "english"


def test_a_word_is_labelled_once(spark):
    """A model's rule is part of the plan once, and kinds are counted as they were."""
    asked = []

    def label(w):
        asked.append(w)
        return F.when(w.endswith("ng"), "tl").when(w.endswith("s"), "en")

    r = one(spark, language.identify(F.col("t"), 0.5, None, label), t="ang THE the xs yng zz zz zz")
    assert len(asked) == 1 and r.asDict() == {"language": "taglish", "en_ratio": 0.375, "tl_ratio": 0.25, "other_ratio": 0.375}
