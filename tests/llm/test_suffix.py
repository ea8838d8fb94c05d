import numpy as np

from quireflow.llm import suffix as X


def brute(rows, depth):
    place, words = {}, {}
    for d, (i, t) in enumerate(rows):
        w = (t or "").split()
        words[d] = w
        for p in range(len(w) - depth + 1):
            place.setdefault(tuple(w[p : p + depth]), []).append((i, d, p))
    out = []
    marks = {}
    for own in place.values():
        if len(own) > 1:
            for k, (i, d, p) in enumerate(sorted(own)):
                marks.setdefault(d, []).append((p, k == 0))
    for d, own in marks.items():
        own.sort()
        start, end, n, f = own[0][0], own[0][0] + depth, 0, 0
        for p, first in own:
            if p >= end:
                out.append((rows[d][0], start, end, n, f))
                start, n, f = p, 0, 0
            end, n, f = p + depth, n + 1, f + first
        out.append((rows[d][0], start, end, n, f))
    return sorted(out)


def test_spans_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in range(300)]
    passages = [list(rng.choice(words, n)) for n in (8, 9, 15, 30)]
    rows = []
    for d in range(80):
        w = list(rng.choice(words, rng.integers(0, 60)))
        for _ in range(d % 3):
            at = rng.integers(len(w) + 1)
            w[at:at] = passages[rng.integers(4)]
        rows.append((d, " ".join(w)))
    rows += [(90, "same " * 40), (91, "a b " * 10)]
    got = sorted(tuple(r) for r in X.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string"), depth=8).collect())
    assert got == brute(rows, 8) and len(got) > 30


def test_odd_rows(spark):
    line = "one two three four five six seven eight"
    long = "pad%d " * 20_000 % tuple(range(20_000)) + line
    rows = [(1, line, 0), (2, f"{line} end", 0), (None, line, 0), (3, None, 0), (4, "", 0), (5, long, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, id int")
    got = sorted(tuple(r) for r in X.repeated_spans(df, depth=8).collect())
    assert got == [(1, 0, 8, 1, 1), (2, 0, 8, 1, 0), (5, 20_000, 20_008, 1, 0)]
    assert X.repeated_spans(df.where("false")).count() == 0
    twice = spark.createDataFrame([(1, line), (1, line)], "doc_id long, text string")
    assert [tuple(r) for r in X.repeated_spans(twice, depth=8).collect()] == [(1, 0, 8, 2, 1)]
