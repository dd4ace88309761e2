import json

import pytest
from pyspark.sql import functions as F

from threadloom.operators import agreement, candidates, review, votes
from threadloom.schemas import CUES, RATING

LINEUP = ["a1", "a2", "a3"]


def rating(item, model, s, lang="english", lit="neutral", intended="negative", conf=0.9, role="annotator", cue=0):
    return (item, model, "v1", role, lang, lit, intended, s, cue, 0, 0, 0, conf, "r")


@pytest.fixture(scope="module")
def ratings(spark):
    rows = [rating("U", m, 1, cue=int(m != "a3")) for m in LINEUP]
    rows += [rating("M", "a1", 0, "taglish"), rating("M", "a2", 0, "taglish"), rating("M", "a3", 0)]
    rows += [rating("E", "a1", 1), rating("E", "a2", 1), rating("E", "a3", 0)]
    rows += [rating("A", "a1", 1, "taglish"), rating("A", "a2", 0, "taglish"), rating("A", "a3", 0, "taglish"), rating("A", "senior", 1, "tagalog", conf=0.5, role="adjudicator")]
    rows += [rating("T", "a1", 1, "english", conf=0.6), rating("T", "a2", 1, "tagalog", conf=0.9), rating("T", "a3", 1, "taglish", conf=0.7)]
    rows += [rating("H", "a1", 1), rating("H", "a2", 0), rating("H", "a3", 1)]
    rows += [rating("P", "a1", 1), rating("P", "a2", 0)]
    rows += [rating("S", "a1", 1), rating("X", "zz", 1)]
    return spark.createDataFrame(rows, RATING)


@pytest.fixture(scope="module")
def reviews(spark):
    human = ("H", 0, "tagalog", "neutral", "neutral", 0, 0, 0, 0, 0)
    gold = ("U", 0, "tagalog", "neutral", "neutral", 0, 0, 0, 0, 1)
    return spark.createDataFrame([human, gold], "item_id string, sarcastic int, language string, literal_sentiment string, intended_sentiment string, " + ", ".join(f"{c} int" for c in CUES) + ", is_gold int")


def by_item(df):
    return {r["item_id"]: r for r in df.collect()}


def test_unanimous_and_adjudicate(ratings, reviews):
    got = by_item(votes.aggregate(ratings, reviews, LINEUP, "v1"))
    assert set(got) == {"U", "M", "E", "A", "T", "H", "P", "S"}
    pick = lambda i: (got[i]["resolved_by"], got[i]["sarcastic_final"], got[i]["sarcasm_votes"], got[i]["language_final"], got[i]["needs_adjudication"], got[i]["needs_human"])
    assert pick("U") == ("unanimous", 1, "3-0", "english", 0, 0)
    assert got["U"]["cue_polarity_inversion_final"] == 1 and got["U"]["intended_final"] == "negative" and got["U"]["mean_confidence"] == 0.9
    assert pick("M") == ("majority", 0, "3-0", "taglish", 0, 0)
    assert pick("E") == (None, None, "2-1", "english", 1, 0)
    assert pick("A") == ("adjudicator", 1, "2-1", "tagalog", 1, 1)
    assert pick("T") == (None, 1, "3-0", None, 1, 0)
    assert pick("H") == ("human", 0, "2-1", "tagalog", 1, 0)
    assert pick("P")[:3] == (None, None, "1-1") and pick("S")[:3] == (None, None, "1-0")
    assert set(json.loads(got["A"]["votes_json"])) == {"a1", "a2", "a3", "senior"}


def test_majority_and_confidence(ratings, reviews):
    got = by_item(votes.aggregate(ratings, reviews, LINEUP, "v1", "majority", "confidence"))
    assert (got["E"]["resolved_by"], got["E"]["sarcastic_final"]) == ("majority", 1)
    assert (got["A"]["resolved_by"], got["A"]["sarcastic_final"], got["A"]["language_final"], got["A"]["needs_human"]) == ("majority", 0, "taglish", 0)
    assert got["T"]["language_final"] == "tagalog" and got["T"]["tiebreak_labels"] == 1
    assert got["P"]["resolved_by"] is None and got["H"]["resolved_by"] == "human"


def test_equal_confidence_goes_to_config_order(spark, reviews):
    rows = [rating("Q", "a1", 1, "english", conf=0.8), rating("Q", "a2", 1, "tagalog", conf=0.5), rating("Q", "a3", 1, "taglish", conf=0.8)]
    r = spark.createDataFrame(rows, RATING)
    assert votes.aggregate(r, reviews, LINEUP, "v1", tie_break="confidence").first()["language_final"] == "english"
    assert votes.aggregate(r, reviews, ["a3", "a1", "a2"], "v1", tie_break="confidence").first()["language_final"] == "taglish"
    two = votes.aggregate(r, reviews, ["a1", "a2"], "v1").first()
    assert (two["sarcasm_votes"], two["n_annotators"]) == ("2-0", 2)


def test_rerun_changes_nothing(ratings, reviews):
    a, b = (sorted(map(str, votes.aggregate(ratings, reviews, LINEUP, "v1").collect())) for _ in range(2))
    assert a == b


def test_per_label(ratings, reviews):
    got = by_item(votes.per_label_resolution(ratings, reviews, LINEUP, "v1"))
    assert tuple(got["U"])[1:] == ("unanimous",) * 4
    assert got["M"]["language"] == "majority" and got["E"]["sarcastic"] == "unresolved"
    assert got["T"]["language"] == "unresolved" and got["A"]["sarcastic"] == "adjudicator" and got["H"]["language"] == "human"
    assert by_item(votes.per_label_resolution(ratings, reviews, LINEUP, "v1", "majority", "confidence"))["T"]["language"] == "tiebreak"


def test_adjudicator_queue(spark, ratings, reviews):
    agg = votes.aggregate(ratings, reviews, LINEUP, "v1")
    none = spark.createDataFrame([], "item_id string, model_key string, prompt_version string, role string")
    assert {r[0] for r in candidates.pending_adjudicator(agg, ratings, none, "senior", "v1").collect()} == {"E", "T", "P", "S"}
    failed = spark.createDataFrame([("E", "senior", "v1", "adjudicator"), ("T", "other", "v1", "adjudicator")], none.schema)
    assert {r[0] for r in candidates.pending_adjudicator(agg, ratings, failed, "senior", "v1").collect()} == {"T", "P", "S"}


def test_split_votes(spark):
    cases = {"3-0": False, "2-0": False, "2-1": True, "1-1": True, "1-0": True, "garbage": False, "x-y": False, "3": False}
    rows = spark.createDataFrame([(k,) for k in cases] + [(None,)], "v string").select("v", review.is_split_vote(F.col("v")).alias("s")).collect()
    assert {r["v"]: r["s"] for r in rows} == cases | {None: False}


def test_evaluation_goldens(spark):
    human = [1, 1, 1, 0, 0, 0]
    given = {"a1": [1, 1, 0, 0, 0, 1], "a2": [1, 1, 1, 0, 0, 0], "a3": [0, 1, 1, 0, 1, None], "shipped": [1, 1, 0, 0, 0, 0, 1], "judge": [1, 1, 1, 1, 1, 0, 1]}
    gold = spark.createDataFrame([(str(i), h) for i, h in enumerate(human)], "item_id string, sarcastic int")
    sources = spark.createDataFrame([(k, str(i), v) for k, vs in given.items() for i, v in enumerate(vs)], "source string, item_id string, predicted int")
    kinds = spark.createDataFrame([(k, "x") for k in (*given, "idle")], "source string, kind string")
    got = {r["source"]: (r["n"], r["accuracy"], r["f1_sarcastic"], r["kappa"]) for r in agreement.evaluation_report(gold, sources, kinds).collect()}
    assert got["a1"] == (6, 0.6667, 0.6667, 0.3333)
    assert got["a2"] == (6, 1.0, 1.0, 1.0)
    assert got["a3"] == (5, 0.6, 0.6667, 0.1667)
    assert got["shipped"] == (6, 0.8333, 0.8, 0.6667)
    assert got["judge"] == (6, 0.6667, 0.75, 0.3333)
    assert got["idle"] == (0, None, None, None)
    both = sources.filter("source = 'judge'").join(sources.filter("source = 'shipped'").select("item_id", F.col("predicted").alias("s")), "item_id")
    r = agreement.cohen(both, ["source"], "s", "predicted").first()
    assert (r["n"], round(r["agree"] / r["n"], 4), r["kappa"]) == (7, 0.5714, 0.2222)
    assert "| a1 | x | 6 | 0.667 |" in agreement.report_markdown([{"source": "a1", "kind": "x", "n": 6, "accuracy": 0.6667, "f1_sarcastic": None, "kappa": 0.3}], "v1", 6, 3)


def test_metrics_edges(spark):
    p = spark.createDataFrame([("one", 0, 0), ("one", 0, 0), ("two", 1, 1), ("two", 0, 1)], "source string, human int, predicted int")
    got = {r["source"]: tuple(r)[1:] for r in agreement.binary_metrics(p, ["source"]).collect()}
    assert got == {"one": (2, 1.0, None, None), "two": (2, 0.5, 0.6667, 0.0)}


def test_fleiss_and_krippendorff_against_textbook(spark):
    # Fleiss 1971 style: two raters, four items, one disagreement
    rows = [(str(i), m, "sarcastic", v) for i, vs in enumerate([("0", "0"), ("1", "1"), ("1", "0"), ("1", "1")]) for m, v in zip("xy", vs, strict=True)]
    labels = spark.createDataFrame(rows, "item_id string, model_key string, label string, value string")
    f = agreement.fleiss(labels).first()
    p, pe = 0.75, (5 / 8) ** 2 + (3 / 8) ** 2
    assert f["fleiss_kappa"] == round((p - pe) / (1 - pe), 4) and f["n_items_all_raters"] == 4
    k = agreement.krippendorff(labels).first()["krippendorff_alpha"]
    assert k == round(1 - (2 / 8) / ((2 * 5 * 3) / (8 * 7)), 4)
    assert agreement.fleiss(labels.filter("item_id = '0'")).first()["fleiss_kappa"] is None


def test_blind_gold_is_all_or_nothing(spark):
    first = '{"sarcastic": 1, "language": null, "literal_sentiment": "positive", "intended_sentiment": "negative"}'
    rows = [("a", 0, "english", "neutral", "neutral", 1, 0, first), ("b", 1, "english", "neutral", "neutral", 1, 0, None), ("c", 1, "english", "neutral", "neutral", 1, 1, None), ("d", 1, "english", "neutral", "neutral", 0, 0, None)]
    r = spark.createDataFrame(rows, "item_id string, sarcastic int, language string, literal_sentiment string, intended_sentiment string, is_gold int, votes_seen int, first_pass_json string")
    got = {x["item_id"]: (x["sarcastic"], x["language"]) for x in agreement.gold_labels(r).collect()}
    assert got == {"a": (1, None), "b": (1, "english")}


def test_allocation(spark):
    def quota(rows, total):
        strata = spark.createDataFrame([(k, n, float(w), k) for k, n, w in rows], "stratum string, n long, weight double, tie string")
        return {r["stratum"]: r["quota"] for r in review.quotas(strata, total).collect()}

    assert quota([("x", 50, 50), ("y", 30, 30), ("z", 2, 2)], 41) == {"x": 25, "y": 15, "z": 1}
    assert quota([("x", 3, 100), ("y", 10, 1)], 8) == {"x": 3, "y": 5}
    assert quota([("b", 5, 1), ("a", 5, 1), ("c", 5, 1)], 4) == {"a": 2, "b": 1, "c": 1}  # ties by name
    assert quota([("a", 2, 1), ("b", 3, 0)], 99) == {"a": 2, "b": 3}
    for total in range(0, 20):
        got = quota([("p", 4, 9), ("q", 9, 2.5), ("r", 1, 30)], total)
        assert sum(got.values()) == min(total, 14) and got["p"] <= 4 and got["r"] <= 1


def test_gold_sample(spark):
    rows = [(f"i{k}", (1, "english", k < 3, "short")) for k in range(8)]
    pop = spark.createDataFrame(rows, "item_id string, stratum struct<label: int, language: string, split: boolean, band: string>")
    heavy = review.gold_sample(pop, 4, split_weight=100).collect()
    assert sum(r["stratum"]["split"] for r in heavy) == 3 and len(heavy) == 4
    assert sorted(map(str, heavy)) == sorted(map(str, review.gold_sample(pop, 4, split_weight=100).collect()))
    assert sum(r["stratum"]["split"] for r in review.gold_sample(pop, 4, split_weight=1).collect()) in (1, 2)
    assert review.gold_sample(pop, 100).count() == 8 and review.gold_sample(pop.limit(0), 3).count() == 0
