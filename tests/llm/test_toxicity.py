import math

import numpy as np
import pyarrow as pa

from quireflow.llm import toxicity as T
from quireflow.llm.linear import Rows

WORDS = [f"w{i}" for i in range(500)]


def corpus(n, seed):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        w = list(rng.choice(WORDS, rng.integers(5, 300)))
        insult, threat = rng.random() < 0.25, False
        if insult:
            threat = rng.random() < 0.5
            for _ in range(3):
                w.insert(rng.integers(len(w) + 1), f"scumb{rng.choice(list('abcdef'))}")
            if threat:
                w.insert(0, "hurtyou")
        out.append((i, " ".join(w), int(insult), int(threat)))
    return out


def test_held_out_accuracy_of_a_chain(spark):
    schema = "doc_id long, text string, insult int, threat int"
    train, held = spark.createDataFrame(corpus(800, 1), schema), corpus(400, 2)
    chain = T.fit(train.select("doc_id", "text"), train.drop("text"), {"insult": "insult", "threat": "threat"})
    assert chain.categories == ("insult", "threat") and len(chain.weights[1]) == len(chain.weights[0]) + 1
    got = {r.id: r for r in T.score(spark.createDataFrame(held, schema), chain).collect()}
    assert np.mean([(got[i].p_insult >= 0.5) == bool(a) for i, _, a, _ in held]) > 0.98
    assert np.mean([(got[i].p_threat >= 0.5) == bool(b) for i, _, _, b in held]) > 0.98
    assert all(got[i].keep for i, _, a, b in held if not a and not b)


def test_later_models_see_earlier_probabilities():
    rng = np.random.default_rng(0)
    x = Rows.of([(np.array([0]), np.array([v])) for v in rng.standard_normal(400)], 1)
    a = (x.value + rng.normal(0, 0.3, 400) > 0).astype(int)
    weights, biases = T.fit_chain(x, np.stack([a, a], axis=1), np.arange(400) % 5)
    assert len(weights[1]) == 2 and weights[1][1] > 0 and len(biases) == 2


def test_odd_rows(spark):
    train = spark.createDataFrame(corpus(300, 3), "doc_id long, text string, insult int, threat int")
    labels = train.select("doc_id", "insult").union(spark.createDataFrame([(None, 1), (3, None), (4, 1)], "doc_id long, insult int"))
    chain = T.fit(train, labels, {"insult": "insult"}, severe="severe")
    assert chain.categories == ("insult", "severe")
    rows = [(None, "scumba scumbb scumbc", 1), (1, None, 1), (2, "", 1), (3, "w1 " * 100_000 + "scumba scumbb scumbc", 1), (3, "w1", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    assert sorted(((r.id, r.toxic) for r in T.score(df, chain).collect()), key=repr) == sorted([(None, True), (1, False), (2, False), (3, True), (3, False)], key=repr)
    assert T.score(df.where("false"), chain).count() == 0
    for none in (labels.where("false"), labels.where("insult = 0")):
        assert not any(r.toxic for r in T.score(df, T.fit(train, none, {"insult": "insult"}, severe="severe")).collect())


def test_scores_equal_a_plain_chain(spark):
    schema = "doc_id long, text string, insult int, threat int"
    train = spark.createDataFrame(corpus(300, 5), schema)
    chain = T.fit(train, train.drop("text"), {"insult": "insult", "threat": "threat"})
    held = corpus(60, 6)
    got = {r.id: r for r in T.score(spark.createDataFrame(held, schema), chain).collect()}
    places = {int(b): k for k, b in enumerate(chain.chosen)}
    for i, text, *_ in held:  # one text at a time, with a set of buckets and sums in plain floats
        own = {b for _, _, _, bs in T.buckets(pa.array([text])) for b in bs.tolist()}
        hit = [places[b] for b in own if b in places]
        risky = sum(bool(chain.risky[k]) for k in hit)
        before = []
        for w, b in zip(chain.weights, chain.biases):
            n = len(chain.chosen)
            z = b + sum(w[k] for k in hit) + (w[n] + w[n + 1] * math.log2(risky) if risky else 0) + sum(p * v for p, v in zip(before, w[n + 2 :]))
            before.append(1 / (1 + math.exp(-z)))
        assert np.allclose([got[i].p_insult, got[i].p_threat], before, atol=1e-9)
        assert got[i].toxic == (max(before) >= T.CUT)


def test_counts_and_choice_equal_brute_force(spark, monkeypatch):
    rows = corpus(240, 7)
    seen = {}
    monkeypatch.setattr(T, "_train", lambda *a: seen.setdefault("a", a) and None)
    df = spark.createDataFrame([(*r[:2], r[2]) for r in rows], "doc_id long, text string, insult int")
    T.fit(df, df.drop("text"), {"insult": "insult"})
    row, bucket, ys, fold, known, yes, have, *_ = seen["a"]
    from pyspark.sql import functions as F

    folds = {r.doc_id: r.f for r in df.select("doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(T.FOLDS)).alias("f")).collect()}
    sets = [(folds[i], y, {b for _, _, _, bs in T.buckets(pa.array([t])) for b in bs.tolist()}) for i, t, y, _ in rows]
    for left_out in [None, *range(T.FOLDS)]:
        part = [s for s in sets if s[0] != left_out]
        toxic, counts = sum(y for _, y, _ in part), {}
        for _, y, own in part:
            for b in own:
                a, n = counts.get(b, (0, 0))
                counts[b] = (a + y, n + 1)
        keep, _ = T.marked(np.array([a for a, _ in counts.values()], float), np.array([n for _, n in counts.values()], float), toxic, len(part))
        want = {b for b, k in zip(counts, keep) if k}
        use = np.array([f for f in range(T.FOLDS) if f != left_out])
        got, _ = T.marked(yes[use].sum(axis=0), have[use].sum(axis=0), toxic, len(part))
        assert want and set(known[got].tolist()) == want


def test_a_fold_does_not_choose_its_own_buckets():
    # A bucket that stands in toxic texts of one fold alone is no feature where that fold is predicted.
    n = 200
    fold, y = np.arange(n) % 5, (np.arange(n) % 10 < 5).astype(int)
    row = np.flatnonzero((fold == 3) & (y == 1))
    yes, have = np.zeros((5, 1)), np.zeros((5, 1))
    yes[3], have[3] = len(row), len(row)
    seen = []
    real = T.Chain.rows
    T.Chain.rows = lambda self, *a: seen.append(len(self.chosen)) or real(self, *a)
    try:
        T._train(row, np.full(len(row), 7), np.stack([y, y], axis=1), fold, np.array([7]), yes, have, ["a", "b"], None, 20, 1e-4)
    finally:
        T.Chain.rows = real
    assert seen == [1, 1, 1, 1, 0, 1]
