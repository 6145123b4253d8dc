"""The toxicity classifier: its learner against a plain one, and its accuracy on rows that it has not seen."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest

from frames import ODD, documents
from topicwright.llm import toxicity as t
from topicwright.llm.queries import QUERIES
from topicwright.llm.text_arrays import texts_of


def plain_features(text):
    """Features as names: words, beginnings, and pairs."""
    import re

    words = [w.encode() for w in re.findall("[0-9a-z\x80-\U0010ffff]+", "".join(c.lower() if c.isascii() else c for c in text))]
    names = {("word", w) for w in words}
    names |= {("begins", k, w[:k]) for w in words for k in t.BEGINNINGS if len(w) > k}
    names |= {("pair", k, a, b) for k in t.DISTANCES for a, b in zip(words, words[k:])}
    return names


def test_features_are_words_beginnings_and_pairs():
    texts = ["One two, three-FOUR fiveandmore", "", "é ünlich ünlichkeit", "a a a a"]
    places, owners = t.distinct(*t.features(texts_of(pa.array(texts))))
    assert [int((owners == i).sum()) for i in range(4)] == [len(plain_features(x)) for x in texts]
    again, _ = t.distinct(*t.features(texts_of(pa.array(["xx ünlich ünlichkeit"]))))
    shared = np.isin(again, places[owners == 2]).sum()
    assert shared == len(plain_features(texts[2]) & plain_features("xx ünlich ünlichkeit"))


def test_learner_does_as_the_update_rule_says():
    pick = random.Random(2)
    learner, z, n = t.Learner(), {}, {}
    for _ in range(300):
        places = sorted(pick.sample(range(40), pick.randrange(8)))
        label = int(any(p < 5 for p in places))
        learner.learn(np.array(places, np.int64), float(label))

        def weight(p):
            penalty = 0.0 if p == t.PLACES else t.L1
            value = z.get(p, 0.0)
            if abs(value) <= penalty:
                return 0.0
            return -(value - math.copysign(penalty, value)) / ((t.BETA + math.sqrt(n.get(p, 0.0))) / t.ALPHA + t.L2)

        at = [*places, t.PLACES]
        weights = [weight(p) for p in at]
        gradient = 1 / (1 + math.exp(-sum(weights))) - label
        for p, w in zip(at, weights):
            step = (math.sqrt(n.get(p, 0.0) + gradient**2) - math.sqrt(n.get(p, 0.0))) / t.ALPHA
            z[p] = z.get(p, 0.0) + gradient - step * w
            n[p] = n.get(p, 0.0) + gradient**2
    for p in z:
        assert learner.z[p] == pytest.approx(z[p]) and learner.n[p] == pytest.approx(n[p])


def planted(spark, count):
    pick, texts, labels = random.Random(5), [], []
    for i in range(count):
        words = [f"w{pick.randrange(300)}" for _ in range(60)]
        bad = i % 4 == 0
        if bad:
            words[pick.randrange(60)] = pick.choice(["Vile", "nasty!", "foulheiten", "foulkeit"])
        texts.append(" ".join(words))
        labels.append((i, int(bad)))
    return documents(spark, texts), spark.createDataFrame(labels, "doc_id bigint, label int")


def test_learnt_weights_are_few_and_right(spark):
    docs, labels = planted(spark, 1800)
    model = t.fit(docs, labels.where("doc_id % 3 <> 0"))
    assert 0 < len(model.places) < 400
    rows = t.score(docs, model).join(labels, "doc_id").where("doc_id % 3 = 0").collect()
    right = sum((x.score >= 0.5) == bool(x.label) for x in rows)
    assert right / len(rows) > 0.97
    again = t.fit(docs.repartition(7), labels.where("doc_id % 3 <> 0").repartition(3))
    assert np.array_equal(again.places, model.places) and np.array_equal(again.weights, model.weights)


def test_odd_rows(spark):
    docs, labels = planted(spark, 200)
    rows = labels.union(spark.createDataFrame([(0, 0), (None, 1), (7, None), (999, 1)], "doc_id bigint, label int"))
    model = t.fit(docs.union(docs), rows)
    odd = documents(spark, ODD).union(documents(spark, [None]).selectExpr("null", "text", "lang", "source", "n_chars"))
    odd = odd.withColumnRenamed("lang", "_score").withColumnRenamed("source", "score").withColumnRenamed("n_chars", "a.b")
    scored = t.score(odd, model)
    assert scored.columns == ["doc_id", "text", "_score", "a.b", "score"]
    found = scored.collect()
    assert len(found) == len(ODD) + 1 and all(0 <= x.score < 0.5 for x in found) and all(x["_score"] == "en" for x in found)
    assert t.score(odd.limit(0), model).collect() == []
    assert [x.score for x in t.score(odd, t.fit(docs, labels.limit(0))).collect()] == [0.0] * len(found)
    assert [x.score for x in t.score(odd, t.fit(docs.limit(0), labels)).collect()] == [0.0] * len(found)


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    scored = QUERIES["op12_toxicity"](spark, sf_dir)
    rows = scored.join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").where("held_out").collect()
    assert sum(x.predicted == x.toxic for x in rows) / len(rows) > 0.9
    assert not any(x.predicted for x in rows if not x.toxic)
