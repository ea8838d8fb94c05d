import numpy as np
import pyarrow as pa

from quireflow.llm import decontam as D

WORDS = [f"w{i}" for i in range(400)]


def edited(rng, item, k):
    out = list(item)
    for _ in range(k):
        at, kind = rng.integers(len(out)), rng.integers(3)
        if kind == 0:
            out[at] = f"x{rng.integers(1000)}"
        elif kind == 1:
            del out[at]
        else:
            out.insert(at, f"y{rng.integers(1000)}")
    return out


def corpus(n=200):
    rng = np.random.default_rng(3)
    items = [(i, list(rng.choice(WORDS, rng.integers(8, 60)))) for i in range(30)]
    docs = []
    for d in range(n):
        body = list(rng.choice(WORDS, rng.integers(0, 120)))
        if d % 2:
            _, item = items[d % 30]
            at = rng.integers(len(body) + 1)
            body[at:at] = edited(rng, item, rng.integers(0, int(D.allowed(len(item))) + 2))
        docs.append((d, " ".join(body)))
    return docs, [(i, " ".join(w)) for i, w in items]


def test_recall_and_precision_against_brute_force(spark):
    docs, items = corpus()
    got = {(r.id, r.item_id): r.edits for r in D.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = {(d, i): e for d, t in docs for i, x in items if d % 2 and i == d % 30 or d < 12 if (e := D.brute(t, x)) is not None}
    assert len(want) > 60
    assert len(want.keys() & got.keys()) >= 0.95 * len(want)
    assert all(D.brute(docs[d][1], items[i][1]) is not None for d, i in got)
    assert all(got[k] == want[k] for k in want.keys() & got.keys())


def test_folding_places_and_odd_rows(spark):
    item = "One two three, four five six seven eight nine ten."
    long = "pad " * 60_000 + item.upper() + " pad" * 10
    docs = spark.createDataFrame(
        [(1, f"a b {item} c", "x"), (1, f"a b {item} c", "x"), (2, None, "x"), (3, "", "x"), (None, item, "x"), (4, long, "x"), (5, "one two three four", None)],
        "doc_id long, text string, edits string",
    )
    items = spark.createDataFrame([(7, item), (8, None), (9, ""), (None, item), (10, "one two")], "item_id long, text string")
    got = sorted(tuple(r) for r in D.contaminated(docs, items).collect())
    assert got == [(1, 7, 2, 10, 0), (1, 10, 2, 2, 0), (4, 7, 60_000, 10, 0), (4, 10, 60_000, 2, 0), (5, 10, 0, 2, 0)]
    assert {r.doc_id for r in D.drop_contaminated(docs, items).collect()} == {2, 3}
    assert D.contaminated(docs.where("false"), items).count() == 0 == D.contaminated(docs, items.where("false")).count()
    assert sorted(tuple(r) for r in D.contaminated(docs, items, part_words=3).collect()) == got


def test_places_lose_nothing():
    docs, items = corpus(60)
    words, first = D.fold(pa.array([t for _, t in items]))
    index = D.Index(np.arange(len(items)), words, first, D.RATE, D.BITS, 1)
    h, rows = D.fold(pa.array([t for _, t in docs]))
    row = D.K.rows_of(rows)
    for d, t in docs:
        i = d % 30
        if d % 2 and D.brute(t, items[i][1]) is not None:
            k, item = int(index.k[i]), words[first[i] : first[i + 1]]
            near = {s for s in range(rows[d], rows[d + 1]) if D.edits(item, h[s : rows[d + 1]], k)[0] <= k}
            lo, q, known, top, longest, need, *_ = next(c for c in index.classes[::-1] if c[0] <= index.m[i])
            found = set(index.starts(D.K.grams(h, q), rows, row, q, known, top, longest, need).tolist())
            assert near and near <= found


def test_walks_of_near_strings_meet_and_of_others_seldom():
    rng = np.random.default_rng(5)
    tables, met, other = D.tables_for(D.RECALL), 0, 0
    for _ in range(300):
        item = rng.integers(0, 1 << 62, 30, dtype=np.uint64)
        copy = np.array(item)
        copy[rng.choice(30, 6, replace=False)] = rng.integers(0, 1 << 62, 6, dtype=np.uint64)
        pair = np.concatenate([item, copy, rng.integers(0, 1 << 62, 30, dtype=np.uint64)])
        start, end = np.array([0, 30, 60]), np.array([30, 60, 90])
        keys = [D.sketch(pair, start, end, D.sampled(22, t, D.BITS), D.SEED + t) for t in range(tables)]
        met += any(k[0] == k[1] for k in keys)
        other += any(k[0] == k[2] for k in keys)
    assert met > 290 and other == 0


def test_ids_of_any_type(spark):
    docs = spark.createDataFrame([("d1", "x one two three four five six seven y"), ("d2", "nothing"), (None, "one two three four five six seven")], "doc_id string, text string")
    items = spark.createDataFrame([("i1", "One two three four five six seven!")], "item_id string, text string")
    assert [tuple(r) for r in D.contaminated(docs, items).collect()] == [("d1", "i1", 1, 7, 0)]
    assert D.contaminated(docs, items.where("false")).schema["item_id"].dataType.simpleString() == "string"
