import numpy as np

from quireflow.llm import caps as C


def vectors(n=1500, dim=32, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim))
    y = x[:200] / np.linalg.norm(x[:200], axis=1, keepdims=True)
    noise = rng.standard_normal(y.shape)
    near = y + 0.2 * noise / np.linalg.norm(noise, axis=1, keepdims=True)
    many = y[:1] + 0.05 * rng.standard_normal((150, dim)) / np.sqrt(dim)
    return [(k, [float(a) for a in v]) for k, v in enumerate(np.concatenate([x, near, many, x[5:6]]))]


def brute(rows, cosine):
    v = np.array([x for _, x in rows])
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    return [(i, j) for i, j in zip(*np.nonzero(v @ v.T >= cosine)) if i < j]


def test_recall_against_brute_force(spark):
    rows = vectors()
    got = {r.id: (r.group, r.keep) for r in C.group_near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()}
    pairs = brute(rows, C.COSINE)
    assert len(pairs) > 5000 and np.mean([got[i][0] == got[j][0] for i, j in pairs]) > 0.97
    joined = [(i, j) for i, j in pairs if i < 200 and 1500 <= j < 1700]
    assert np.mean([got[i][0] == got[j][0] for i, j in joined]) > 0.95
    # No group without a pair: every member has a near one in its group.
    near = {k for p in pairs for k in p}
    assert all(i in near for i, (g, keep) in got.items() if g != i)
    assert all(keep == (g == i) for i, (g, keep) in got.items())


def test_links_and_classes_equal_brute_force(spark, monkeypatch):
    rows = vectors(600)
    rows += [(5000 + k, v) for k, (_, v) in enumerate(rows[610:630])]  # copies: the same classes, no more links
    v = np.array([x for _, x in rows], np.float32).astype(float)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    least = {}
    for (i, _), x in zip(rows, map(tuple, v)):
        least[x] = min(least.get(x, i), i)
    distinct = np.array(list(least))
    near = distinct @ distinct.T >= C.COSINE
    links = dict(zip(least, near.sum(axis=1) - 1))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for block in (None, 50):  # a set of 150 in blocks of 50, too
        if block:
            monkeypatch.setattr(C, "group_sizes", lambda m, f=C.group_sizes: f(m, block))
        got = {r.id: r for r in C.group_near_vectors(df).collect()}
        assert all(got[i]["class"] == least[x] for (i, _), x in zip(rows, map(tuple, v)))
        right = [got[i].links == links[x] for (i, _), x in zip(rows, map(tuple, v)) if links[x]]
        assert len(right) > 300 and np.mean(right) > 0.97 and all(got[i].links <= links[x] for (i, _), x in zip(rows, map(tuple, v)))


def test_sketches_of_near_pairs_stay_within_the_margin():
    rng = np.random.default_rng(3)
    for dim in (16, 63, 64, 384):
        x = rng.standard_normal((4000, dim)) * rng.gamma(1, 1, dim)  # some dimensions far greater than others
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        g = rng.standard_normal(x.shape)
        g -= (g * x).sum(1, keepdims=True) * x
        y = C.COSINE * x + np.sqrt(1 - C.COSINE**2) * g / np.linalg.norm(g, axis=1, keepdims=True)
        turn = C._codes(C.Caps(dim, 2.0, 4))[0][0]
        a, b = (C.unsketched(C.sketch(v @ turn)) for v in (x, y))
        assert np.mean((a * b).sum(axis=1) >= C.COSINE - C.MARGIN) > 0.998


def test_wide_buckets_are_connected_like_narrow_ones():
    v = np.random.default_rng(8).standard_normal((1400, 3))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    node = np.arange(1400)
    label = lambda e: C._forest(np.concatenate([e, np.stack([node, node], axis=1)]))
    whole = np.array(np.nonzero(np.triu(v @ v.T >= 0.9995, 1))).T
    assert sorted(map(tuple, label(C.bucket_edges(v, node, 0.9995)))) == sorted(map(tuple, label(whole)))


def test_ids_of_any_type(spark):
    df = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [1.0, 0.001]), ("c", [0.0, 1.0]), ("d", [2.0, 0.0])], "vec_id string, embedding array<float>")
    got = {r.id: r for r in C.group_near_vectors(df).collect()}
    assert len({got[k].group for k in "abd"}) == 1 and got["c"].group == "c" and {k: r.links for k, r in got.items()} == {"a": 2, "b": 2, "c": 0, "d": 2}


def test_recall_of_pairs_at_the_threshold():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((1000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    g = rng.standard_normal(x.shape)
    g -= (g * x).sum(1, keepdims=True) * x
    y = C.COSINE * x + np.sqrt(1 - C.COSINE**2) * g / np.linalg.norm(g, axis=1, keepdims=True)
    for n in (10_000, 50_000):
        caps = C.Caps.of(n, 64)
        a, b = (set(zip(*map(np.ndarray.tolist, C.decode(v, caps)))) for v in (x, y))
        assert len({i for i, _ in a & b}) / 1000 > 0.95


def test_list_decoding_equals_brute_force():
    caps = C.Caps(8, 1.5, 5)
    v = np.random.default_rng(0).standard_normal((50, 8))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    want = set()
    for k, (turn, (a, b)) in enumerate(C._codes(caps)):
        for i in range(50):
            w = v[i] @ turn
            want |= {(i, (k * 5 + p) * 5 + q) for p in range(5) for q in range(5) if w[:4] @ a[:, p] + w[4:] @ b[:, q] > 1.5}
    assert set(zip(*map(np.ndarray.tolist, C.decode(v, caps)))) == want


def test_odd_rows(spark):
    one = [1.0, 0.0, 0.0]
    rows = [(1, one, 0), (2, one, 0), (3, None, 0), (4, [], 0), (5, [1.0], 0), (6, [0.0] * 3, 0), (7, [0.0] * 3, 0), (8, [float("nan"), 1.0, 0.0], 0), (9, [None, 1.0, 0.0], 0), (None, one, 0), (10, one, 0), (10, one, 0), (11, [2.0, 0.0, 0.0], 0), (12, [0.0, 1.0, 0.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, v int")
    got = {r.id: r.group for r in C.group_near_vectors(df).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 6: 6, 7: 7, 8: 8, 9: 9, 10: 1, 11: 1, 12: 12}
    assert C.group_near_vectors(df.where("false")).count() == 0
    assert {r.id: r.group for r in C.group_near_vectors(df.where("embedding is null")).collect()} == {3: 3}


def test_every_size_is_searched(spark):
    rng = np.random.default_rng(3)
    long, short = rng.standard_normal((4, 32)), rng.standard_normal((3, 8))
    rows = [(0, []), (1, [2.0]), (2, [3.0])]  # the least ids are odd ones
    rows += [(10 + k, v.tolist()) for k, v in enumerate([*long, long[1], 1.001 * long[2] + 0.001])]
    rows += [(20 + k, v.tolist()) for k, v in enumerate([*short, short[0]])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    own = {i: i for i, _ in rows}
    assert {r.id: r.group for r in C.group_near_vectors(df).collect()} == own | {2: 1, 14: 11, 15: 12, 23: 20}
    assert {r.id: r.group for r in C.group_near_vectors(df, dim=32).collect()} == own | {14: 11, 15: 12}
