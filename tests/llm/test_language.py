from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from trailperks.llm import language
from trailperks.llm.common import id_remainder
from trailperks.llm.queries import op2

SMALL = "/root/testdata/sf0.001"


def test_held_out_accuracy(spark):
    truth = {r.doc_id: r["lang"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = [r for r in op2(spark, SMALL).collect() if r.held_out]
    assert np.mean([truth[r.doc_id] == r.lang_pred for r in rows]) >= 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_prediction_uses_text_only(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = language.fit(docs, id_remainder(F.col("doc_id"), 3) != 1)
    plain = {r.row.doc_id: (r.lang_pred, r.score) for r in language.identify(docs, model).collect()}
    other = docs.select(F.col("doc_id"), "text", F.lit("xx").alias("lang"), F.lit(1).alias("score"), F.lit(2).alias("row"))
    assert {r.row.doc_id: (r.lang_pred, r.score) for r in language.identify(other, model).collect()} == plain


def test_defined_results(documents):
    docs = documents(
        [(n, "the cat and the dog of the house", "en") for n in range(8)]
        + [(n, "der hund und die katze des hauses", "de") for n in range(8, 16)]
        + [(16, None, "en"), (17, "", "de"), (18, "123 -- !!", "en"), (19, "the cat", None), (None, "die katze", "de"), (19, "the cat", None), (20, "the dog and " * 30000, "en")]
    )
    model = language.fit(docs, F.lit(True))
    got = [(r.row.doc_id, r.lang_pred) for r in language.identify(docs, model).collect()]
    assert {d: p for d, p in got if d in (16, 17, 18)} == dict.fromkeys((16, 17, 18), "und")
    assert got.count((19, "en")) == 2 and (None, "de") in got and (20, "en") in got and len(got) == 23


def test_one_class_no_class_and_no_rows(documents):
    docs = documents([(1, "one text", "en"), (2, "two texts", None)])
    assert {r.lang_pred for r in language.identify(docs, language.fit(docs, F.lit(True))).collect()} == {"en"}
    nothing = language.fit(docs, F.lit(False))
    assert [(r.lang_pred, r.score) for r in language.identify(docs, nothing).collect()] == [("und", 0.0)] * 2
    empty = docs.where("false")
    assert language.identify(empty, language.fit(empty, F.lit(True))).count() == 0


def test_temperature_minimises_loss():
    random = np.random.default_rng(0)
    labels = random.integers(0, 3, 2000)
    scores = np.eye(3)[labels] * 2 + random.gumbel(size=(2000, 3))
    best = language.fit_temperature(scores * 5, labels)
    loss = lambda t: -np.log(language.softmax(scores * 5 / t)[np.arange(2000), labels]).mean()
    assert loss(best) <= min(loss(t) for t in np.linspace(0.5, 12, 60)) + 1e-4


def test_temperature_lies_inside_for_texts_that_are_all_told_apart():
    for count in (10, 100, 10_000):
        labels = np.arange(count) % 3
        best = language.fit_temperature(np.eye(3)[labels] * 30, labels)
        assert 10 * language.COLDEST < best < language.HOTTEST / 10
        # As certain as having seen each class once more allows.
        chance = language.softmax(np.eye(3)[0] * 30 / best)[0]
        assert abs(chance - (count + 1) / (count + 3)) < 1e-3


def plain_ftrl(examples, classes, epochs):
    """Follow-the-regularised-leader, weight by weight."""
    z, n = {}, {}

    def weight(key):
        if abs(z.get(key, 0.0)) <= language.L1:
            return 0.0
        shrunk = z[key] - np.sign(z[key]) * language.L1
        return -shrunk / ((language.BETA + np.sqrt(n[key])) / language.ALPHA + language.L2)

    for _ in range(epochs):
        for places, values, label in examples:
            w = {(p, c): weight((p, c)) for p in places.tolist() for c in range(classes)}
            scores = [sum(v * w[p, c] for p, v in zip(places.tolist(), values.tolist())) for c in range(classes)]
            chances = np.exp(np.array(scores) - max(scores))
            chances /= chances.sum()
            for p, v in zip(places.tolist(), values.tolist()):
                for c in range(classes):
                    g = v * (chances[c] - (c == label))
                    old = n.get((p, c), 0.0)
                    sigma = (np.sqrt(old + g * g) - np.sqrt(old)) / language.ALPHA
                    z[p, c] = z.get((p, c), 0.0) + g - sigma * w[p, c]
                    n[p, c] = old + g * g
    return {key: weight(key) for key in z}


def test_weights_equal_plain_steps():
    texts = ["the cat and the dog", "der hund und die katze", "le chat et le chien", "the dogs", "die hunde", "les chiens"] * 3
    idf = np.ones(language.DIMENSIONS)
    examples = [(*(lambda p, c: (p, language.weigh(p, c, idf)))(*language.ngram_counts(t)), n % 3) for n, t in enumerate(texts)]
    weights = language.train(examples, 3)
    plain = plain_ftrl(examples, 3, language.EPOCHS)
    for (place, label), value in plain.items():
        assert abs(weights[place, label] - value) < 1e-9
    seen = {place for place, _ in plain}
    assert not weights[[p for p in range(language.DIMENSIONS) if p not in seen]].any()
    zero = sum(value == 0 for value in plain.values())
    assert 0.05 < zero / len(plain) < 0.95  # the penalty removes seen weights too
    model = language.Model(["en", "de", "fr"], idf, weights, 1.0)
    for text, label in zip(texts[:6], ["en", "de", "fr"] * 2):
        places, counts = language.ngram_counts(text)
        values = language.weigh(places, counts, idf)
        scores = [sum(v * plain[p, c] for p, v in zip(places.tolist(), values.tolist())) for c in range(3)]
        best, score = model.predict(text)
        assert best == label and abs(score - language.softmax(np.array(scores)).max()) < 1e-9


def test_every_label_is_learned(documents):
    """More labels than the sample has room for at the full rate, and a rare one."""
    def word(n):
        return "".join("bcdfghjklmnpqrstvwxz"[n // 20**k % 20] + "aeiou"[(n + k) % 5] for k in range(3))

    rows = [(n, " ".join([word(n % 300)] * 6), f"l{n % 300}") for n in range(3000)] + [(3001, "ωωω ψψψ " * 4, "rare")] * 3
    model = language.fit(documents(rows), F.lit(True))
    assert len(model.labels) == 301 and "rare" in model.labels
    got = [(r.row["lang"], r.lang_pred) for r in language.identify(documents(rows), model).collect()]
    assert np.mean([a == b for a, b in got]) > 0.9 and got.count(("rare", "rare")) == 3


def test_rows_under_one_id_are_drawn_one_by_one(documents):
    rows = [(7, f"the house number {n} of the town", "en") for n in range(3000)]
    rows += [(None, f"das haus nummer {n} der stadt", "de") for n in range(3000)]
    model = language.fit(documents(rows), F.lit(True))
    assert model.labels == ["de", "en"]
    got = [r.row["lang"] == r.lang_pred for r in language.identify(documents(rows), model).collect()]
    assert np.mean(got) > 0.99
