import itertools

import numpy as np
import pyarrow as pa

from quireflow.llm import simhash as S


def texts(n=60, seed=1):
    rng = np.random.default_rng(seed)
    words = [f"word{i}" for i in range(900)]
    out = []
    for g in range(n):
        base = list(rng.choice(words, 150))
        for c in range(1 + (g % 3) + (30 if g == 5 else 0)):
            own = list(base)
            for _ in range(c % 4):
                own[rng.integers(len(own))] = "changed"
            out.append((len(out), " ".join(own)))
    return out


def brute(rows, radius, full):
    code, some = S.fingerprints(pa.array([t for _, t in rows]))
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, y in itertools.combinations(range(len(rows)), 2):
        d = np.bitwise_count(code[x] ^ code[y])
        if some[x] and some[y] and d[0] <= radius and d[1:].sum() <= full:
            a, b = sorted((find(rows[x][0]), find(rows[y][0])))
            root[b] = a
    return {i: find(i) for i, _ in rows}


def test_every_pair_within_the_radius_meets():
    masks, _ = S.mask_pairs(4)
    rng = np.random.default_rng(0)
    for _ in range(300):
        x = rng.integers(0, 1 << 63, dtype=np.uint64)
        y = x
        for p in rng.choice(64, 4, replace=False):
            y ^= np.uint64(1) << np.uint64(p)
        assert ((x & masks) == (y & masks)).any()


def test_groups_equal_brute_force(spark):
    rows = texts()
    got = {r.id: (r.group, r.keep) for r in S.group_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = brute(rows, S.RADIUS, S.RUN_RADIUS)
    assert got == {i: (g, g == i) for i, g in want.items()}
    assert sum(k for _, k in got.values()) < len(rows) - 30


def test_links_and_classes_equal_brute_force(spark, monkeypatch):
    rows = texts()
    rows += [(1000 + k, t) for k, (_, t) in enumerate(rows[40:60])]  # copies: no more links, the same classes
    code, _ = S.fingerprints(pa.array([t for _, t in rows]))
    least: dict = {}
    for (i, _), c in zip(rows, code):
        least[tuple(c)] = min(least.get(tuple(c), i), i)
    distinct = np.array(list(least))
    d = np.bitwise_count(distinct[:, None] ^ distinct[None])
    near = (d[:, :, 0] <= S.RADIUS) & (d[:, :, 1:].sum(axis=2) <= S.RUN_RADIUS)
    links = dict(zip(least, near.sum(axis=1) - 1))
    want = {i: (least[tuple(c)], links[tuple(c)]) for (i, _), c in zip(rows, code)}
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.id: (r["class"], r.links) for r in S.group_near_duplicates(df).collect()} == want and max(links.values()) > 20
    # The same in blocks of a few codes: a large group spreads over many records.
    monkeypatch.setattr(S, "group_sizes", lambda m, f=S.group_sizes: f(m, 5))
    assert {r.id: (r["class"], r.links) for r in S.group_near_duplicates(df).collect()} == want


def test_pairs_are_counted_in_wide_runs_too():
    rng = np.random.default_rng(3)
    run = np.repeat([1, 2, 3, 4], [200, 150, 5, 70])
    side = np.concatenate([np.full(200, 2), rng.integers(0, 2, 150), np.full(5, 2), rng.integers(0, 2, 70)])
    v = rng.integers(0, 6, len(run))
    got = S.pair_counts(run, side, lambda x, y: v[x] == v[y])
    ok = (run[:, None] == run) & (v[:, None] == v) & ((side[:, None] != side) | (side[:, None] == 2))
    np.fill_diagonal(ok, False)
    assert got.tolist() == ok.sum(axis=1).tolist()


def test_ids_of_any_type_and_several_texts(spark):
    rows = [("doc-a", "one two three four five six"), ("doc-b", "one two three four five six"), ("doc-c", "quite another text it is"), (None, "x"), ("doc-a", "an unrelated second text of the id")]
    got = {r.id: r for r in S.group_near_duplicates(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    assert set(got) == {"doc-a", "doc-b", "doc-c"} and got["doc-a"].group == got["doc-b"].group and got["doc-c"].group == got["doc-c"]["class"] == "doc-c"
    assert sum(got[k].keep for k in ("doc-a", "doc-b")) == 1
    df = spark.createDataFrame([(1, "one two three four five six", 1), (2, "one two three four five six", 2), (2, "an unrelated second text of the id", 3)], "doc_id long, text string, `a.b` int")
    assert sorted(r["a.b"] for r in S.drop_near_duplicates(df).collect()) == [1, 3]  # the second text of 2 is no copy
    import pytest

    with pytest.raises(ValueError):
        S.mask_pairs(S.MOST + 1)


def test_odd_rows(spark):
    long = "x y z " * 50_000
    rows = [(1, None, 1), (2, "", 2), (3, "a b c", 3), (3, "a b c", 3), (4, "A b, c!", 4), (None, "a b c", 5), (6, "...", 6), (7, long, 7), (8, long, 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, id int").withColumnRenamed("id", "group")
    whole = {r.id: r for r in S.group_near_duplicates(df).collect()}
    assert {i: (r["class"], r.links) for i, r in whole.items()} == {1: (1, 0), 2: (2, 0), 3: (3, 0), 4: (3, 0), 6: (6, 0), 7: (7, 0), 8: (7, 0)}
    got = {i: (r.group, r.keep) for i, r in whole.items()}
    assert got == {1: (1, True), 2: (2, True), 3: (3, True), 4: (3, False), 6: (6, True), 7: (7, True), 8: (7, False)}
    assert S.group_near_duplicates(df.where("false")).count() == 0
    assert sorted(r.group for r in S.drop_near_duplicates(df).collect()) == [1, 2, 3, 3, 5, 6, 7]


def test_like_words_alone_are_no_copy(spark):
    rng = np.random.default_rng(4)
    common, rows = [f"c{i}" for i in range(80)], []
    for d in range(40):  # long texts of a few common words, and rare ones of their own
        w = [f"r{d}x{i}" if rng.random() < 0.1 else c for i, c in enumerate(rng.choice(common, 3000))]
        rows.append((d, " ".join(w)))
    rows.append((99, " ".join("changed" if k % 500 == 0 else w for k, w in enumerate(rows[7][1].split()))))
    got = {r.id: r.group for r in S.group_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {d: d for d in range(40)} | {99: 7}


def test_every_pair_within_the_default_radius_meets_in_a_record_of_its_group():
    masks, shared = S.mask_pairs(S.RADIUS)
    assert len(np.unique(masks)) == (2 << S.RADIUS) - 1 and (shared[:, None] & ~masks == 0).all()
    rng = np.random.default_rng(0)
    for _ in range(300):
        x = y = rng.integers(0, 1 << 63, dtype=np.uint64)
        for p in rng.choice(64, S.RADIUS, replace=False):
            y ^= np.uint64(1) << np.uint64(p)
        code = np.zeros(2 * len(shared), S.CODE)
        code["a"], code["group"] = np.repeat([x, y], len(shared)), np.tile(np.arange(len(shared)), 2)
        group = code["group"][S.bucket_edges(code, S.RADIUS, 0)]
        assert len(group) and ((x ^ y) & shared[group] == 0).all()


def test_recall_by_share_of_changed_words():
    rng = np.random.default_rng(11)
    p = 1 / (10 + np.arange(6000))
    words = np.array([f"w{k}" for k in range(6000)])
    found = {}
    for share in (0.025, 0.05, 0.075, 0.1):
        rows = []
        for _ in range(400):
            base = rng.choice(words, 220, p=p / p.sum())
            copy = base.copy()
            copy[rng.choice(220, round(220 * share), replace=False)] = rng.choice(words, round(220 * share), p=p / p.sum())
            rows += [" ".join(base), " ".join(copy)]
        f, _ = S.fingerprints(pa.array(rows))
        d = np.bitwise_count(f[::2] ^ f[1::2])
        found[share] = np.mean((d[:, 0] <= S.RADIUS) & (d[:, 1:].sum(axis=1) <= S.RUN_RADIUS))
    assert found[0.025] > 0.98 and found[0.05] > 0.93 and found[0.075] > 0.83 and found[0.1] > 0.6
