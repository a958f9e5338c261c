"""Toxicity: features and swaps by hand, the penalty's effect, held-out accuracy, and odd inputs."""

import math
import random

import pyarrow as pa
import pytest

from tidegrid.llm import toxicity as tx
from tidegrid.llm.catalog import op13_toxicity
from tidegrid.llm.words import slices

PLAIN = "the a of on with talks walks reads eats sees house tree river market book song today often never".split()


def texts(*many):
    return next(slices(pa.array(many)))


def test_features_are_distinct_and_case_and_signs_do_not_count():
    owner, bucket = tx.features(texts("Foo bar, foo bar!", "foo BAR", "", None))
    first, second = set(bucket[owner == 0].tolist()), set(bucket[owner == 1].tolist())
    assert second < first and len(first) == 2 + 2 and len(second) == 3  # bar-foo is another pair
    assert set(owner.tolist()) == {0, 1}
    assert len(tx.features(texts("one. two"))[1]) == 2  # no pair over the end of a sentence
    assert len(tx.features(texts("abcdefgh"))[1]) == 1 + len(tx.STEMS)


def test_swaps_change_the_named_term_alone():
    terms = tx.term_keys((("person", "muslim", "jew"),))
    found = tx.swaps(texts("A Muslim reads. No name here.", "nothing", None), terms)
    assert [len(f) for f in found] == [2, 0, 0]
    own = set(tx.features(texts("a muslim reads"))[1].tolist())
    for other, (lost, gained) in zip(("jew", "person"), sorted(found[0], key=lambda f: len(f[1]))):
        after = set(tx.features(texts(f"a {other} reads"))[1].tolist())
        assert set(lost) == own - after and set(gained) == after - own


def biased(seed, n=400):
    """Most toxic rows hold an insult, and all of them four times as often as others the name of a group."""
    random.seed(seed)
    rows = []
    for i in range(n):
        toxic = i % 4 == 0
        words = random.choices(PLAIN, k=8)
        if toxic and random.random() < 0.7:
            words.insert(random.randrange(9), random.choice(["scum", "idiot", "trash"]))
        if random.random() < (0.8 if toxic else 0.2):
            words.insert(random.randrange(len(words)), random.choice(["muslim", "muslim", "jew"]))
        elif random.random() < 0.3:
            words.insert(random.randrange(len(words)), "person")
        rows.append((i, " ".join(words) + ".", int(toxic)))
    return rows


def test_penalty_draws_the_names_to_the_neutral_term(spark):
    rows = biased(3)
    docs = spark.createDataFrame(rows, "doc_id long, text string, label int")
    gap = {}
    for fairness in (0.0, tx.FAIRNESS):
        weights = tx.fit(docs.select("doc_id", "text"), docs.select("doc_id", "label"), fairness=fairness)

        def odds(text, weights=weights):
            return weights.odds(tx.features(texts(text))[1])

        gap[fairness] = abs(odds("the muslim reads a book today") - odds("the person reads a book today"))
        assert odds("the scum reads a book today") > 0
    assert gap[0.0] > 0.5 and gap[tx.FAIRNESS] < 0.2 * gap[0.0]
    neutral = spark.createDataFrame([(i, f"the {w} reads a book") for i, w in enumerate(["muslim", "jew", "person"])], "doc_id long, text string")
    assert all(r["score"] < 0.5 for r in tx.score(neutral, weights, ["doc_id"]).collect())


def test_nulls_repeats_long_texts_and_clashing_names(spark):
    docs = spark.createDataFrame([(1, "idiot scum"), (1, "idiot scum"), (2, None), (None, ""), (3, "a b " * 200_000)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (3, None), (None, 1)], "doc_id long, label int")
    weights = tx.fit(docs, labels)
    odd = docs.selectExpr("*", "1 AS SCORE", "2 AS score_text")
    got = tx.score(odd, weights, odd.columns)
    assert got.columns == ["doc_id", "text", "score_text", "score"] and got.count() == 5
    assert all(0 <= r["score"] <= 1 and math.isfinite(r["score"]) for r in got.collect())
    none = tx.fit(docs.limit(0), labels.limit(0))
    assert {r["score"] for r in tx.score(docs, none, ["doc_id"]).collect()} == {0.5}
    assert tx.score(docs.limit(0), weights, ["doc_id"]).count() == 0


@pytest.mark.parametrize("sf, least", [("sf0.1", 0.97)])
def test_held_out_rows_are_told_apart(spark, sf, least):
    folder = f"/root/testdata/{sf}"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    got = op13_toxicity(spark, folder).where("held_out").join(labels, "doc_id").select("predicted", "toxic").collect()
    right = sum(r["predicted"] == r["toxic"] for r in got)
    # one toxic row in eight of this table holds none of the words that mark the others
    assert right / len(got) >= least
    assert sum(r["predicted"] for r in got if not r["toxic"]) <= 0.01 * len(got)
