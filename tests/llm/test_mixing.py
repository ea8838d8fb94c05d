import itertools

import numpy as np

from quireflow.llm import mixing as M


def cheapest(capacity, quota, epochs):
    """(greatest flow, its least cost) by trying all whole flows."""
    pairs = [(p, s) for p in sorted(capacity) for s in p if s in quota]
    best = (0, 0)
    for flow in itertools.product(*[range(min(quota[s], epochs * capacity[p]) + 1) for p, s in pairs]):
        into = {s: sum(f for f, (_, t) in zip(flow, pairs) if t == s) for s in quota}
        out = {p: sum(f for f, (q, _) in zip(flow, pairs) if q == p) for p in capacity}
        if all(into[s] <= quota[s] for s in quota) and all(out[p] <= epochs * capacity[p] for p in capacity):
            cost = sum(max(0, min(out[p] - k * capacity[p], capacity[p])) * k for p in capacity for k in range(epochs))
            best = max(best, (sum(flow), -cost))
    return best[0], -best[1]


def test_flow_equals_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(25):
        capacity = {p: int(rng.integers(1, 4)) for p in [("a",), ("b",), ("a", "b")] if rng.random() < 0.8}
        quota = {"a": int(rng.integers(0, 6)), "b": int(rng.integers(0, 6))}
        flow, cost = M.route(capacity, quota, 2)
        total = sum(n for own in flow.values() for n in own.values())
        assert (total, cost) == cheapest(capacity, quota, 2)
        assert all(sum(own.values()) <= 2 * capacity[p] for p, own in flow.items())


def test_quotas():
    q = M.quotas({("a",): 10, ("a", "b"): 5}, {"a": 1, "b": 2}, 10)
    assert q == {"a": 3, "b": 7} and sum(M.quotas({("a",): 7, ("b",): 9}, None, 101).values()) == 101 and M.quotas({}, None, None) == {}


def test_selection_follows_the_flow(spark):
    rng = np.random.default_rng(2)
    rows = [(i, f"t{i} " * int(rng.integers(5, 40)), "abc"[i % 3]) for i in range(600)]
    rows += [(1000 + i, rows[i][1], "c") for i in range(0, 300, 3)]  # copies of documents of a in c
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    tokens = {i: len(t.split()) for i, t, _ in rows}
    got = M.mix(df, {"a": 0.2, "b": 0.6, "c": 0.2}, 12_000).collect()
    assert sorted(M.mix(df, {"a": 0.2, "b": 0.6, "c": 0.2}, 12_000).collect()) == sorted(got)
    used = {s: sum(r.copies * r.n_tokens for r in got if r.source == s) for s in "abc"}
    b_all = sum(tokens[i] for i in range(1, 600, 3))
    assert abs(used["a"] - 2400) < 200 and abs(used["c"] - 2400) < 200 and abs(used["b"] - min(7200, 4 * b_all)) < 200
    assert all(r.n_tokens == tokens[r.id] and r.id < 1000 for r in got)
    assert max(r.copies for r in got if r.source == "b") >= 2 and {r.copies for r in got if r.source == "a"} == {1}
    assert all(r.id % 3 == 1 for r in got if r.source == "b")
    chosen = M.mixed_rows(df, {"a": 0.2, "b": 0.6, "c": 0.2}, 12_000)
    assert chosen.columns == df.columns and chosen.count() == sum(r.copies for r in got)


def test_odd_rows(spark):
    rows = [(1, None, "a", 1), (2, "", "a", 1), (3, " \n", "a", 1), (None, "x y", "a", 1), (4, "x y z", None, 1), (5, "p q", "b", 1), (5, "p q", "b", 1), (6, "r " * 100_000, "b", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, copies int")
    got = sorted(tuple(r) for r in M.mix(df, budget=10**9).select("id", "source", "copies", "n_tokens").collect())
    assert got == [(4, "", 4, 3), (5, "b", 4, 2), (6, "b", 4, 100_000)]
    assert sorted(r.doc_id for r in M.mixed_rows(df, budget=10**9).collect()) == [4] * 4 + [5] * 4 + [6] * 4
    assert M.mix(df.where("false")).count() == 0 == M.mixed_rows(df.where("false")).count()


def test_rows_stay_whole_and_choices_stay_the_same(spark):
    rows = [("b", "x y z", "s", 77, "k", {"m": 1}), ("b", "x y z", "s", 78, "k", None), ("b", "x y z", "s", 77, "k", {"m": 1}), ("a", "p q", None, 5, None, {}), ("c", "x y z", "t", 1, "k", None)]
    df = spark.createDataFrame(rows, "doc_id string, text string, source string, id int, rest string, uses map<string,int>")
    runs = [sorted(map(repr, M.mixed_rows(df.repartition(k), budget=5).collect())) for k in (1, 3, 7)]
    assert runs[0] == runs[1] == runs[2]
    assert {(r.doc_id, r.text) for r in M.mixed_rows(df, budget=5).collect()} == {("b", "x y z"), ("a", "p q")}
    assert all((r.id, r.rest) in {(77, "k"), (78, "k"), (5, None)} for r in M.mixed_rows(df, budget=5).collect())
    many = spark.createDataFrame([(1, "one two", "s")] * 500 + [(2, "three", "s")], "doc_id long, text string, source string")
    assert sorted(r.doc_id for r in M.mixed_rows(many, budget=3).collect()) == [1, 2]


def test_the_number_of_buckets_changes_nothing(spark, monkeypatch):
    df = spark.createDataFrame([(i, f"t{i} " * (1 + i % 9), "ab"[i % 2]) for i in range(400)], "doc_id long, text string, source string")
    want = sorted(M.mix(df, budget=1500).collect())
    monkeypatch.setattr(M, "BUCKET", 1)
    assert sorted(M.mix(df, budget=1500).collect()) == want


def plain_mix(rows, weights, budget, alpha=M.ALPHA, epochs=M.EPOCHS, seed=M.SEED):
    """The mix in plain Python: hashes by another library, documents laid end to end in dictionaries and lists; only the flow is the operator's own, which has a brute-force test."""
    import xxhash

    chain = lambda values, start=42: values and chain(values[1:], xxhash.xxh64(values[0], seed=start).intdigest()) or start
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    long = lambda v: signed(v).to_bytes(8, "little", signed=True)
    docs = {}
    for i, text, source in rows:
        if i is not None and text is not None and text.split():
            own = docs.setdefault(text, [i, len(text.split()), set()])
            own[0] = min(own[0], i)
            own[2].add(source or "")
    capacity = {}
    for _, n, sources in docs.values():
        p = tuple(sorted(sources))
        capacity[p] = capacity.get(p, 0) + n
    flow, _ = M.route(capacity, M.quotas(capacity, weights, budget, alpha), epochs)
    out = {}
    for p, own in flow.items():
        order = []
        for text, (i, n, sources) in docs.items():
            if tuple(sorted(sources)) == p:
                h1, h2 = chain([text.encode()]), chain([seed.to_bytes(4, "little"), text.encode()])
                order.append((chain([seed.to_bytes(4, "little"), long(h2), long(h1)]), i, n))
        at, total = 0, capacity[p]
        for _, i, n in sorted(order):
            for turn in range(epochs):
                end = 0
                for s, tokens in sorted(own.items()):
                    end += tokens
                    if at + turn * total < end:
                        copies, n_tokens = out.get((i, s), (0, 0))
                        out[i, s] = (copies + 1, n)
                        break
            at += n
    return sorted((i, s, c, n) for (i, s), (c, n) in out.items())


def test_mix_equals_brute_force(spark):
    rng = np.random.default_rng(9)
    rows = [(i, f"t{i} " * int(rng.integers(1, 30)), "abc"[i % 3] if i % 11 else None) for i in range(300)]
    rows += [(1000 + i, rows[i][1], "c") for i in range(0, 300, 5)] + [(None, "x y", "a"), (2000, " ", "a"), (2001, None, "b"), (5, rows[5][1], "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for weights, budget in ((None, None), ({"a": 0.1, "b": 0.7, "c": 0.2}, 9_000), ({"a": 1.0}, 500), ({"z": 1.0}, 10)):
        got = sorted(map(tuple, M.mix(df, weights, budget).select("id", "source", "copies", "n_tokens").collect()))
        assert got == plain_mix(rows, weights, budget) and (got or weights == {"z": 1.0})
