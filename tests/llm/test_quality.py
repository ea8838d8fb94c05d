import math
from collections import Counter

import numpy as np
import pyarrow as pa

from quireflow.llm import quality as Q
from quireflow.llm.linear import Rows

WORDS = [f"w{i}" for i in range(200)]


def corpus(n, seed):
    """Grades 0 to 3: the more of a text is shouted, the lower."""
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        g = int(rng.integers(4))
        w = [x.upper() + "!" if rng.random() < (3 - g) / 4 else x for x in rng.choice(WORDS, rng.integers(30, 90))]
        out.append((i, " ".join(w), g))
    return out


def test_held_out_accuracy_with_ordered_thresholds(spark):
    train, held = corpus(600, 1), corpus(300, 2)
    model = Q.fit(spark.createDataFrame(train, "doc_id long, text string, quality int").drop("quality"), spark.createDataFrame(train, "doc_id long, text string, quality int"))
    assert model.grades == (0, 1, 2, 3) and (np.diff(model.thresholds) > 0).all()
    df = spark.createDataFrame(held, "doc_id long, text string, quality int")
    got = {r.id: r for r in Q.score(df, model, at_least=2).collect()}
    assert np.mean([abs(got[i].expected_grade - g) for i, _, g in held]) < 0.5
    assert np.mean([got[i].keep == (g >= 2) for i, _, g in held]) > 0.9
    kept = sorted(r.doc_id for r in Q.drop_low(df, model, at_least=2).collect())
    assert kept == sorted(i for i, r in got.items() if r.keep)


def test_the_gradient_is_that_of_the_likelihood():
    rng = np.random.default_rng(0)
    x, y = Rows.of([(np.arange(3), rng.standard_normal(3)) for _ in range(60)], 3), rng.integers(0, 3, 60)
    model = Q._fit(x, y, (0, 1, 2), 600, 1e-4)

    def loss(w, b):
        p = Q.sigmoid(np.concatenate([np.full((60, 1), np.inf), x.dot(w)[:, None] - b, np.full((60, 1), -np.inf)], axis=1).clip(-30, 30))
        weight = (60 / (3 * np.bincount(y, minlength=3)))[y]
        return -(weight * np.log(p[np.arange(60), y] - p[np.arange(60), y + 1])).sum() / weight.sum()

    best = loss(model.weights, model.thresholds)
    for _ in range(40):
        assert best <= loss(model.weights + rng.normal(0, 0.05, 3), model.thresholds + rng.normal(0, 0.05, 2)) + 1e-3


def test_odd_rows(spark):
    train = corpus(200, 3)
    labels = spark.createDataFrame([(i, g) for i, _, g in train] + [(None, 1), (5, None), (7, 3)], "doc_id long, quality int")
    df = spark.createDataFrame([(i, t) for i, t, _ in train] + [(None, "a b"), (900, None), (901, ""), (902, "w1 w2 " * 50_000), (902, "w1 w2 " * 50_000)], "doc_id long, text string").selectExpr("*", "1 AS keep", "2 AS grade")
    model = Q.fit(df, labels)
    got = [r for r in Q.score(df, model).collect() if r.id is None or r.id >= 900]
    assert len(got) == 5
    assert all((r.expected_grade, r.p_tail, r.keep) == (0.0, 0.0, False) for r in got if r.id in (900, 901))
    assert len({r.expected_grade for r in got if r.id == 902}) == 1
    assert Q.score(df.where("false"), model).count() == 0 == Q.drop_low(df.where("false"), model).count()
    nothing = Q.fit(df, labels.where("false"))
    assert all(r.keep for r in Q.score(df.where("length(text) > 0"), nothing).collect())
    assert Q.drop_low(df, nothing).columns == df.columns


def plain_score(text, model):
    """The score of one text with words and shapes in dictionaries: the same hashes, none of the vectors."""
    from quireflow.llm import kernels as K

    words = [w for w in text.replace("\n", " ").split(" ") if w]
    h = K.hashes(*(lambda raw, ends: (raw, np.array([a for a, _ in ends]), np.array([b for _, b in ends])))(np.frombuffer(" ".join(words).encode(), np.uint8), spans(words)))
    kind = lambda c: 1 if "a" <= c <= "z" else 2 if "A" <= c <= "Z" else 3 if c.isdigit() else 16 + ord(c)
    shapes = []
    for k, w in enumerate(words):
        same = int(k > 0 and words[k - 1] == w)
        shapes.append((((min(len(w), 24) * 256 + kind(w[0])) * 256 + kind(w[-1])) * 256 + kind(w[(len(w) - 1) // 2]) * 2 + same) ^ int(Q._SHAPE))
    bucket = lambda v: int(K.mix(np.array([v], np.uint64))[0] >> np.uint64(64 - Q.BITS))
    count = Counter([int(x) >> (64 - Q.BITS) for x in h]) + Counter(map(bucket, shapes))
    total = sum(model.weights[b] * math.sqrt(n / len(words)) for b, n in count.items())
    pairs = [int(K.mix(np.array([(int(a) * int(K.GOLD) + int(b)) % 2**64], np.uint64))[0]) for a, b in zip(h, np.roll(h, -1))]
    repeats = sum(a == b for a, b in zip(words, words[1:]))
    ratios = [len(set(words)) / len(words), len(set(pairs)) / len(words), math.log2(len(words)) / 16, repeats / len(words)]
    for k, r in enumerate(ratios):
        step = min(15, max(0, int(r * 16)))
        total += model.weights[bucket(int(Q._RATIO[k]) ^ ((step + 1) * int(K.GOLD)) % 2**64)]
    tails = [1 / (1 + math.exp(-min(30, max(-30, total - b)))) for b in model.thresholds]
    return model.grades[0] + sum(t * (b - a) for t, a, b in zip(tails, model.grades, model.grades[1:])), tails


def spans(words):
    at, out = 0, []
    for w in words:
        out.append((at, at + len(w)))
        at += len(w) + 1
    return out


def test_scores_equal_brute_force(spark):
    train, held = corpus(200, 4), corpus(40, 5)
    schema = "doc_id long, text string, quality int"
    model = Q.fit(spark.createDataFrame(train, schema), spark.createDataFrame(train, schema))
    got = {r.id: r for r in Q.score(spark.createDataFrame(held, schema), model, at_least=2).collect()}
    for i, text, _ in held:
        grade, tails = plain_score(text, model)
        assert abs(got[i].expected_grade - grade) < 1e-6 and abs(got[i].p_tail - tails[1]) < 1e-6 and got[i].keep == (tails[1] >= Q.KEEP)
    names = spark.createDataFrame([(f"doc-{i}", t, 1) for i, t, _ in held], "doc_id string, text string, `text.x` int")
    assert {r.id: round(r.p_tail, 9) for r in Q.score(names, model, at_least=2).collect()} == {f"doc-{i}": round(r.p_tail, 9) for i, r in got.items()}
    assert Q.drop_low(names, model).columns == names.columns
