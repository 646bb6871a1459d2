import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricelens.llm import quality_classifier as Q
from pricelens.llm import toxicity as T
from pricelens.session import sf_table

SF = "/root/testdata/sf0.1"


# Quality classifier.

def test_ordered_thresholds_and_held_out_grades():
    r = random.Random(0)
    vocabulary = [[f"g{g}w{i}" for i in range(30)] for g in range(4)]

    def text(g):  # words of neighbouring grades, mostly of its own
        return " ".join(r.choice(vocabulary[min(3, max(0, g + r.choice([0, 0, 0, -1, 1])))]) for _ in range(40))

    rows = [(g, text(g)) for g in [r.randrange(4) for _ in range(1200)]]
    model = Q.fit([(g, *Q.features(t)) for g, t in rows[:800]], grades=4)
    assert (np.diff(model.thresholds) > 0).all()
    score = np.array([float(model.weights[s] @ v) for s, v in (Q.features(t) for _, t in rows[800:])])
    tails = model.tails(score)
    assert (np.diff(tails, axis=1) <= 0).all()
    truth = np.array([g for g, _ in rows[800:]])
    assert np.abs(tails.sum(axis=1) - truth).mean() < 0.35
    assert ((tails > 0.5).sum(axis=1) == truth).mean() > 0.8


def test_scores_are_the_models_and_selection_holds_out(spark):
    docs, labels = sf_table(spark, SF, "documents"), sf_table(spark, SF, "labels")
    learn = labels.where("doc_id % 3 != 0")
    model = Q.train(docs, Q.ratings_of(learn), grades=3, max_labelled=2000)
    again = Q.train(docs.repartition(5), Q.ratings_of(learn.repartition(3)), grades=3, max_labelled=2000)
    assert (model.weights == again.weights).all() and (model.thresholds == again.thresholds).all()
    out = Q.score(docs, model)
    kept = {tuple(r[:2]): r[2] for r in out.join(labels.where("doc_id % 3 = 0"), "doc_id").groupBy("quality", "kept").count().collect()}
    assert kept[(1, True)] / (kept[(1, True)] + kept.get((1, False), 0)) > 0.99
    assert kept[(0, False)] / (kept[(0, False)] + kept.get((0, True), 0)) > 0.95
    row = out.orderBy("doc_id").first()
    slots, values = Q.features(docs.where(F.col("doc_id") == row.doc_id).first().text)
    tails = model.tails(np.array([float(model.weights[slots].astype(float) @ values)]))[0]
    assert abs(row.expected_grade - tails.sum()) < 1e-3 and abs(row.tail_probability - tails[0]) < 1e-3


def test_scoring_odd_rows(spark, odd, documents):
    none = Q.train(odd, spark.createDataFrame([], "doc_id long, grade int"), grades=3)
    got = Q.score(odd, none, carry=True)
    assert got.count() == odd.count() and got.where("not kept").count() == 0
    assert sorted(map(str, got.select("row.*").collect())) == sorted(map(str, odd.collect()))
    assert Q.score(documents([]), none).collect() == []
    # Null, conflicting and repeated ratings; ids without a text.
    ratings = spark.createDataFrame([(1, 0), (1, 2), (None, 1), (5, None), (5, 1), (999, 2), (7, 2)], "doc_id long, grade int")
    assert Q.train(odd, ratings, grades=3).thresholds.shape == (2,)


def test_long_words_count_whole():
    slots = lambda w: {s for s, _ in Q.word_values(w)}
    assert Q._shape("a" * 64 + "1-B2") != Q._shape("a" * 64) and Q._shape("a1" * 4 + "-") != Q._shape("a1" * 4 + "+")
    assert Q._shape("日本、" * 50) == Q._shape("日本、" * 900) and Q._shape("don't") == "a'a"
    line = "始" * 200 + "中間" + "終" * 200
    assert {Q._slot("p 始中間"), Q._slot("p 中間終")} <= slots(line) and Q._slot("p lon") not in slots("long")
    found, values = Q.features(line)
    assert abs(values.sum() - 6) < 1e-4  # word, shape, end, all pieces together, length, distinct words
    # Lines told apart only by what stands inside them.
    r = random.Random(1)
    rows = [(g, "".join(r.choice(("甲乙丙", "子丑寅")[g]) for _ in range(300)) + "末末末") for g in [r.randrange(2) for _ in range(300)]]
    model = Q.fit([(g, *Q.features(t)) for g, t in rows[:200]], grades=2)
    tails = model.tails(np.array([float(model.weights[s] @ v) for s, v in (Q.features(t) for _, t in rows[200:])]))[:, 0]
    assert ((tails > 0.5) == np.array([g for g, _ in rows[200:]])).all()


# Toxicity.

def all_paths(unary, moves):
    n = len(unary)
    total, one = 0.0, np.zeros(n)
    for y in itertools.product((0, 1), repeat=n):
        w = np.exp(sum(u for u, s in zip(unary, y, strict=True) if s) + sum(moves[a, b] for a, b in zip(y, y[1:], strict=False)))
        total += w
        one += w * np.array(y)
    return one / total


def test_marginals_are_those_of_all_paths():
    r = np.random.default_rng(0)
    texts = [r.normal(size=n) * 2 for n in (1, 5, 0, 9, 3)]
    moves = r.normal(size=(2, 2))
    joined, starts, sizes = T._joined(texts)
    got = T.marginals(joined, starts, sizes, moves)
    assert np.allclose(got, np.concatenate([all_paths(t, moves) for t in texts if len(t)]))


def test_fit_climbs_the_likelihood():
    # At the optimum, expected features equal observed ones: tokens that are always toxic in toxic texts get there.
    r = random.Random(0)
    clean = [f"c{i}" for i in range(200)]
    docs = []
    for i in range(300):
        found = [r.choice(clean) for _ in range(30)]
        if i % 2:
            for _ in range(3):
                found.insert(r.randrange(30), r.choice(["vilest", "meaner"]))
        docs.append((" ".join(found), i % 2))
    field = T.fit(docs)
    words = T._Words(field.weights)
    joined, starts, sizes = T._joined([words.of("c1 c2 vilest c3 meaner c4".split())])
    assert (T.marginals(joined, starts, sizes, field.moves) > 0.5).tolist() == [False, False, True, False, True, False]


def test_held_out_rows(spark):
    ids = list(range(200)) + [None]
    got = spark.createDataFrame([(i,) for i in ids], "doc_id long").select("doc_id", T.held_out(F.col("doc_id"))).collect()
    assert all(h == (i is not None and zlib.crc32(str(i).encode()) % 4 == 2) for i, h in got)


def test_held_out_accuracy_and_spans(spark):
    docs, labels = sf_table(spark, SF, "documents"), sf_table(spark, SF, "labels")
    out = T.toxicity(docs, labels)
    rows = out.join(labels, "doc_id").join(docs.select("doc_id", "text"), "doc_id").where("held_out").collect()
    hit = sum(r.predicted == 1 and r.toxic == 1 for r in rows)
    # Some rows labelled toxic are junk without an offending word.
    assert hit / sum(r.toxic == 1 for r in rows) > 0.9
    assert sum(r.predicted == 1 and r.toxic == 0 for r in rows) / sum(r.toxic == 0 for r in rows) < 0.03
    spans = [r.text[s.begin:s.end] for r in rows if r.toxic == 1 for s in r.spans]
    assert spans and all(" " not in s for s in spans)


def test_labels_of_held_out_rows_change_nothing(spark):
    docs, labels = sf_table(spark, "/root/testdata/sf0.01", "documents"), sf_table(spark, "/root/testdata/sf0.01", "labels")
    other = labels.withColumn("toxic", F.when(T.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (sorted(map(tuple, T.toxicity(docs, x).select("doc_id", "score").collect())) for x in (labels, other))
    assert a == b


def test_tagging_odd_rows(spark, odd, documents):
    none = T.toxicity(odd, spark.createDataFrame([], "doc_id long, toxic int"))
    assert none.count() == odd.count() and none.where("score < 0 or score > 1 or score is null").count() == 0
    field = T.fit([("vile words here vile", 1), ("good words here", 0)] * 30)
    got = T.tag(odd, field)
    assert got.count() == odd.count()
    assert T.tag(documents([]), field).collect() == []


def test_long_documents_give_pieces_and_displace_none(spark, documents):
    text = " ".join(f"w{i}" for i in range(10_000))
    cut = T.pieces(text, 5, 100)
    assert cut == T.pieces(text, 5, 100) != T.pieces(text, 6, 100)
    found = cut.split("\n")
    assert [len(x.split()) for x in found] == [25] * 4 and all(x in text for x in found)
    assert [int(x.split()[0][1:]) // 2500 for x in found] == [0, 1, 2, 3]  # one from each quarter, beginning to end
    assert T.pieces("a b c", 1, 3) == "a b c" and len(T.pieces(text, 1, 1).split()) == 4 and T.pieces("", 1) == ""
    docs = documents([(1, "bad " * 400_000)] + [(i, f"vile{i % 3} words here vile{i % 3}" if i % 2 else "fine words here now") for i in range(2, 60)])
    labels = spark.createDataFrame([(i, int(i == 1 or i % 2)) for i in range(1, 60)], "doc_id long, toxic int")
    field = T.train(docs, labels)
    scores = {r.doc_id: r.score for r in T.tag(docs, field).collect()}
    assert min(scores[i] for i in range(3, 60, 2)) > max(scores[i] for i in range(2, 60, 2))


def test_document_scores_are_those_of_brute_force(spark, documents):
    """Marginals by all label paths, aggregated and calibrated by hand, spans from the tokens that are likelier toxic."""
    r = random.Random(4)
    weights = np.zeros(1 << T.BITS, np.float32)
    for w in ("vile", "awful", "nice", "the"):
        for slot in T.own_slots(w):
            weights[slot] += r.uniform(-1.5, 1.5)
    field = T.Field(weights, np.array([[0.4, -0.8], [-0.6, 0.9]]), np.array([-1.0, 0.7, 1.3])[:T.fit([]).calibration.shape[0]])
    texts = [(i, " ".join(r.choice(["vile", "awful", "nice", "the", "x"]) for _ in range(r.randint(1, 7)))) for i in range(12)]
    got = {x.doc_id: x for x in T.tag(documents(texts), field).collect()}
    for i, text in texts:
        tokens = text.split()
        unary = [sum(float(weights[s]) for s in T.own_slots(w)) for w in tokens]
        mass, total = np.zeros(len(tokens)), 0.0
        for path in itertools.product((0, 1), repeat=len(tokens)):
            e = np.exp(sum(u for u, y in zip(unary, path, strict=True) if y) + sum(field.moves[a, b] for a, b in zip(path, path[1:])))
            total += e
            mass += e * np.array(path)
        p = mass / total
        evidence = T._evidence(p, np.array([0]), np.array([len(tokens)]))
        want = 1 / (1 + np.exp(-float((evidence @ field.calibration)[0])))
        assert abs(got[i].score - want) < 1e-6
        assert [text[s.begin:s.end] for s in got[i].spans] == [w for w, q in zip(tokens, p, strict=True) if q >= 0.5]


def test_first_step_follows_the_likelihoods_gradient():
    """One step from zero: the step is g / sqrt(1e-6 + g^2) of each gradient g, which finite differences of the mean
    log-likelihood give."""
    r = np.random.default_rng(3)
    rows = [(int(r.integers(0, 3)), np.array([5, 9, 11]), (r.normal(size=3) * 2e-3).astype(np.float32)) for _ in range(60)]

    def likelihood(w):
        cut = np.concatenate([[-np.inf], [0.0, 1.0], [np.inf]])  # thresholds at the start: 0, and a step of exp(0)
        s = lambda x: 1 / (1 + np.exp(-x))
        score = [sum(w.get(int(k), 0.0) * v for k, v in zip(slots, values, strict=True)) for _, slots, values in rows]
        return np.mean([np.log(s(sc - cut[g]) - s(sc - cut[g + 1])) for sc, (g, _, _) in zip(score, rows, strict=True)])

    model = Q.fit(rows, 3, epochs=1, batch=len(rows), rate=1.0, decay=0.0)
    for slot in (5, 9, 11):
        g = (likelihood({slot: 1e-3}) - likelihood({slot: -1e-3})) / 2e-3
        assert abs(model.weights[slot] - g / np.sqrt(1e-6 + g * g)) < 1e-3
    assert np.count_nonzero(model.weights) == 3
