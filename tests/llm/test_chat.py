import pytest

from quireflow.llm import chat as C


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, error string")
    out = {}
    for r in C.format_conversations(df, **kw).orderBy("conv_id", "segment").collect():
        out.setdefault(r.conv_id, []).append((r.segment, r.role, r.text, r.loss, r.error))
    return out


def test_segments_and_errors(spark):
    t = lambda c, *turns: [(c, k, r, x, "clash") for k, (r, x) in enumerate(turns)]
    long = "long " * 200_000
    rows = [
        *t(1, ("system", "s"), ("user", "q"), ("assistant", "a"), ("user", "more")), *t(2, ("user", "q")), *t(3, ("assistant", "a")), *t(4, ("user", "q"), ("user", "r")),
        *t(5, ("user", None), ("assistant", long)), *t(6, (None, "x")), (7, 0, "user", "a", "x"), (7, 0, "user", "b", "x"), (8, None, "user", "a", "x"), (None, 0, "user", "a", "x"),
        *t(9, ("user", "q"), ("assistant", "a")), *t(9, ("user", "q"), ("assistant", "a")), *t(10, ("system", "s")),
    ]
    got = run(spark, rows[::-1])
    assert got[1] == [(0, "system", "<|system|>\ns<|end|>\n", False, None), (1, "user", "<|user|>\nq<|end|>\n", False, None), (2, "assistant", "<|assistant|>\n", False, None), (3, "assistant", "a<|end|>\n", True, None), (4, "user", "<|user|>\nmore<|end|>\n", False, None)]
    errors = {c: v[0][4] for c, v in got.items() if v[0][0] is None}
    assert errors == {2: "ends after asked", 3: "turn 0: assistant after start", 4: "turn 1: user after asked", 6: "turn 0: no role after start", 7: "two turns of one number", 8: "a turn without a number", 10: "ends after system"}
    assert [x[2] for x in got[5]] == ["<|user|>\n<|end|>\n", "<|assistant|>\n", f"{long}<|end|>\n"] and len(got[9]) == 3
    assert set(got) == set(range(1, 11)) and run(spark, []) == {}


def test_a_template_of_ones_own(spark):
    own = C.Template({(C.START, "tool"): "done", ("done", "tool"): "done"}, ("done",), {"tool": (("[", False), ("{text}", True), ("]", False))})
    assert [x[2:4] for x in run(spark, [(1, 0, "tool", "x", None)], template=own)[1]] == [("[", False), ("x", True), ("]", False)]
    with pytest.raises(ValueError):
        C.Template({(C.START, "a"): "b"}, ("b",), {})
