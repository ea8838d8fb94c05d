"""Expectations of single functions and operators, on small fixtures."""

import dataclasses
import itertools
import json
import math
import time
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quireflow.functions import geometry as G
from quireflow.functions import sequences as N
from quireflow.functions import text as T
from quireflow.operators import jobs
from quireflow.operators.tables import latest_per_key, merge_snapshot
from quireflow.plans import steps
from quireflow.sources import lists, sinks
from quireflow.streaming import tasks


def one(spark, *columns):
    return spark.range(1).select(*[c.alias(f"c{k}") for k, c in enumerate(columns)]).first()


def cp(hexes):
    return "".join(chr(int(p, 16)) for p in hexes.split())


def texts(spark, f, *given):
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(given)], "k int, t string").select("k", f(F.col("t")).alias("t")).collect()
    return [r.t for r in sorted(rows)]


def test_text(spark):
    lit = F.lit
    r = one(
        spark, T.folder_prefix(lit("W22084"), lit("I0886")), T.folder_prefix(lit("W1KG13780"), lit("I1KG15541")), T.shortened(lit("x" * 513)), T.safe_id(lit("a/b c")), T.safe_id(lit(None).cast("string")),
        T.repetition_score(F.array_repeat(lit("a"), 19)), T.repetition_score(F.array_repeat(lit("a"), 40)), T.canonical(lit(None).cast("string")), F.hex(T.etag_bytes(lit('"' + "ab" * 16 + '-3"'))), T.shortened(lit(" \ta\nb ")), T.version_of(lit('"abcdef012-7"')),
        T.safe_id(lit("ཀ-é")), T.embedded_json(lit('x Diagnostic: {"a": 1} ')), T.embedded_json(lit("x Diagnostic: {cut")),
    )
    assert r[0].startswith("Works/60/W22084/images/W22084-0886/") and r[1].endswith("W1KG13780-I1KG15541/")
    assert r[2] == "x" * 511 + "…" and r[3] == "a_b_c" and r[4] == "page"
    assert r[5] == 0.0 and math.isclose(r[6], 1 - 1 / 21) and r[7] == "" and r[8] == "AB" * 16 and r[9] == "a b" and r[10] == "abcdef"
    assert r[11] == "ཀ-é" and r[12] == '{"a": 1}' and r[13] is None
    for bad in ("ab", "zz" * 16):
        with pytest.raises(Exception, match="16 bytes"):
            texts(spark, T.etag_bytes, bad)
    errors = texts(spark, T.parsed_error, "[Decode] ValueError: bad: file", "[Write]  no colon ", "odd: one", "[unclosed", "[] : x")
    assert [tuple(e) for e in errors] == [("Decode", "ValueError", "bad: file"), ("Write", "", "no colon"), ("", "", "odd: one"), ("", "", "[unclosed"), ("", "", "x")]
    assert [tuple(x) for x in texts(spark, T.lane, "a.TIF", "a.jpeg", "a.jp2", "b", "c.d.PNG")] == [("files", "image/tiff"), ("images", "image/jpeg"), ("images", "image/jp2"), ("images", "application/octet-stream"), ("images", "image/png")]
    with pytest.raises(Exception, match="address"):
        texts(spark, T.uri_parts, "http://a/b")


def test_repetition(spark):
    rng = np.random.default_rng(4)
    given = [" ".join(rng.choice(list("abc"), k)) for k in (0, 1, 19, 20, 21, 60, 500)] + ["ab " * 300, None]
    want = []
    for t in given:
        w = (t or "").split()
        runs = [tuple(w[k : k + 20]) for k in range(len(w) - 19)]
        want.append((len(w), 1 - len(set(runs)) / len(runs) if runs else 0.0))
    assert [tuple(x) for x in texts(spark, lambda c: T.repetition(c), *given)] == want
    assert texts(spark, lambda c: T.repetition_score(T.tokens(c)), *given[:-1]) == [s for _, s in want[:-1]]
    for n in (1, 2, 3, 7, 20):
        w = list(rng.choice(list("ab"), 200))
        assert T.distinct_runs(w, n) == len({tuple(w[k : k + n]) for k in range(len(w) - n + 1)})


def test_canonical_text(spark):
    # Each rule on its own: what is given, what it becomes.
    spelled = {"F73": "F71 F72", "F81": "F71 F80", "F77": "FB2 F71 F80", "F48": "F47 FB7", "FAC": "FAB FB7", "F00": "F68 F7C F7E", "F46 F39": "F5A", "F6A": "F6A"}
    assert texts(spark, T.unify, *map(cp, spelled)) == list(map(cp, spelled.values()))
    assert texts(spark, lambda c: T.unify(c, True), cp("F42 FB7"), cp("F47 FB7"), cp("FB2 F71 F80")) == [cp("F43"), cp("F47 FB7"), cp("FB2 F71 F80")]
    ordered = {"F40 F72 F90": "F40 F90 F72", "F40 F72 F71": "F40 F71 F72", "F40 F84 F74": "F40 F74 F84", "F40 F7E F7A F39": "F40 F39 F7A F7E", "F22 F3E F18": "F22 F18 F3E", "F0B F72 F71": "F0B F72 F71", "F40 F90 F71 F72": "F40 F90 F71 F72"}
    assert [T.reorder_marks(cp(a)) for a in ordered] == list(map(cp, ordered.values()))
    assert T.reorder_marks("x" + cp("F40 F35 F39") + "y") == "x" + cp("F40 F39 F35") + "y"  # marks outside F71 to FBC alone
    ra = {"F6A F40": "F62 F40", "F6A": "F62", "F6A F90": "F6A F90", "F6A F98": "F62 F98", "F6A FB3": "F62 FB3", "F6A FB4": "F6A FB4"}
    assert texts(spark, T.short_ra, *map(cp, ra)) == list(map(cp, ra.values()))
    start = {"F72 F40": "F40 F72", "F90 F40": "F40", "F72": "F72", "F90": "F90", "F72 F71": "F72 F71", "F72 F90": "F72 F90", "F72 A": "A F72", "F72 F85": "F85 F72"}
    assert texts(spark, T.repair_start, *map(cp, start)) == list(map(cp, start.values()))
    alike = {"F0E": "F0D F0D", "F0C": "F0B", "F38": "F27", "F7A F7A": "F7B", "F7C F7C": "F7D", "F07": "FD3 F0D FD2 F0D", "F71 F90": "FB0 F90", "FB0": "F71", "FB0 F0B": "F71 F0B", "FB0 F90": "FB0 F90", "F0D F0D": "F0D F0D", "F40 F0B F0D": "F40 F0B F0D"}
    assert texts(spark, T.graphical_fold, *map(cp, alike)) == list(map(cp, alike.values()))
    assert texts(spark, T.canonical, "", None, cp("F66 F7C F90 F0E")) == ["", "", cp("F66 F90 F7C F0D F0D")]
    tsheg, shad = chr(0xF0B), chr(0xF0D)
    assert texts(spark, T.tokens, f"a{tsheg}b{shad} c\u00a0d༎e") == [["a", "b", "c", "d༎e"]]
    assert texts(spark, T.syllables, f"ཀ{tsheg}ཁ{shad}{shad} ག", f"{tsheg}ཀར{tsheg}ཁ", f"{tsheg}{shad}", "", f"{tsheg}ཀ{shad}ཁ") == [[f"ཀ{tsheg}", f"ཁ{shad}{shad} ", "ག"], [f"ཀ{tsheg}", f"ར{tsheg}", "ཁ"], [f"{tsheg}{shad}"], [], [f"ཀ{tsheg}{shad}", "ཁ"]]
    assert T.differing("abc", "axc") == [("replace", "b", "x")] and T.differing("ab", "abc") == [("insert", "", "c")]


def test_sequences(spark):
    a = lambda *x: F.array(*[F.lit(v) for v in x])
    r = one(spark, N.entropy(a(*[-1.0] * 5)), N.greedy_path(a(0, 3, 3, 0, 3, 5)), N.greedy_confidence(a(0, 0), a(-1.0, -1.0)), N.byte_chunks(a(6, 5, 12, 1), 10), N.byte_chunks(a(6, 5), 0), N.dual_chunks(a(90, 1, 79, 1), 16, 80), N.quota_pause(F.lit(20)))
    assert math.isclose(r[0], math.log(5)) and r[1] == [3, 3, 5] and r[2] == float("-inf")
    assert r[3] == [0, 1, 2, 3] and r[4] == [0, 0] and r[5] == [0, 1, 1, 2] and r[6] == 900.0
    assert N.lease_schedule(330) == [270, 210, 150, 90, 30]
    p = np.log(np.array([[0.1, 0.6, 0.3], [0.1, 0.6, 0.3], [0.8, 0.1, 0.1], [0.1, 0.2, 0.7]]))
    assert N.beam_search(p, least=-10)[0] == [1, 2]
    assert N.match_lengths([1, 2, 3, 9, 1, 2, 3]) == {9: 3} and N.match_lengths([]) == {}
    assert N.match_lengths([7] * 200) == {7: 51}  # one more than the greatest number of steps back
    assert N.match_lengths([1, 2, 3, 9, 1, 2, 3], breakers=frozenset({2})) == {9: 1} and N.match_lengths([1, 9, 1], breakers=frozenset({9})) == {} and N.match_lengths([1, 2, 1], breakers=frozenset({1})) == {}
    assert N.lease_schedule(330, stale_at=180) == [270, 210] and N.lease_schedule(600, fails=(60, 120, 180)) == [] and N.lease_schedule(330, fails=(60, 180)) == [210, 90, 30]
    for ids in ([5, 6, 7] * 40, list(range(50)) * 3, [1] * 700, np.random.default_rng(1).integers(0, 3, 400).tolist()):
        steps_of = [max(N.match_lengths(ids[:n]).values(), default=0) for n in range(2, len(ids) + 1)]
        hit = [(n, L) for n, L in enumerate(steps_of, 2) if L >= 12]
        pen = [0.8 * 1.75 ** (L - 12) for _, L in hit]
        got = N.repeat_telemetry(ids)
        assert got[:2] == (len(hit), max((L for _, L in hit), default=0)) and math.isclose(got[3], sum(pen), rel_tol=1e-9) and got[4:] == ((hit[0][0], hit[-1][0]) if hit else (None, None))


def plain_slices(points, width):
    """The slices of a contour whose edges are drawn point by point."""
    x, y = points.min(axis=0)
    w, h = points.max(axis=0) - (x, y) + 1
    drawn, out = [], []
    for (xa, ya), (xb, yb) in zip(points - (x, y), np.roll(points, -1, axis=0) - (x, y)):
        steps = max(abs(xb - xa), abs(yb - ya))
        drawn += [(round(xa + (xb - xa) * k / steps), round(ya + (yb - ya) * k / steps)) for k in range(steps + 1)] if steps else [(xa, ya)]
    for a in (0, w // 4 - width, w // 2, w // 2 + w // 4, w - width):
        a, b = min(max(a, 0), w), min(max(a + width, 0), w)
        rows = [r for c, r in drawn if a <= c < b]
        out.append((x + a + ((b - a) // 2 if b > a else width // 2), y + ((min(rows) + max(rows)) // 2 if rows else h // 2), max(rows) - min(rows) + 1 if rows else h))
    return out


def test_slices_of_many_contours_equal_drawn_ones():
    rng = np.random.default_rng(6)
    for width in (1, 7, 40):
        given = [np.column_stack([rng.integers(-9, rng.choice([4, 90, 400]), n), rng.integers(-9, rng.choice([4, 90, 400]), n)]) for n in rng.integers(1, 7, 300)]
        x, y = np.concatenate(given).T
        got = np.stack(G.slices_of(x, y, np.cumsum([0, *map(len, given)]), width), axis=2)
        assert got.tolist() == [[list(map(int, r)) for r in plain_slices(c, width)] for c in given]
    bent = np.array([(0, 0), (200, 100), (200, 120), (0, 20)])
    x, y = np.tile(bent, (20_000, 1)).T
    began = time.process_time()
    page, place, rows = G.control_rows(x, y, np.arange(0, len(x) + 1, 4), np.arange(0, 20_001, 5), 10)
    assert time.process_time() - began < 1  # a loop over edges takes far longer
    assert page.tolist() == np.repeat(np.arange(4000), 5).tolist() and [tuple(r) for r in rows[:5]] == G.control_points([bent] * 5, 800, 1000, 10, corners=False)


def test_repeat_fires_of_many_rows_equal_those_of_each(spark):
    rng = np.random.default_rng(8)
    again = rng.integers(0, 12, 900)
    again[500:560], again[700:713], again[880:900] = again[20:80], again[300:313], again[100:120]  # one in the window, one of 13, one beyond the window
    rows = [[], [1], [1] * 12, [1] * 700, np.tile(rng.integers(0, 9, 37), 20).tolist(), again.tolist(), rng.integers(0, 2, 800).tolist(), rng.integers(0, 12, 500).tolist()]
    flat, at = np.concatenate([np.array(r, np.int64) for r in rows]), np.cumsum([0, *map(len, rows)])
    for allowed, window, most in ((12, 512, 50), (3, 40, 20), (1, 30, 60)):
        got = N.repeat_fires_of(flat, at, allowed, 0.8, 1.75, window, most)
        assert [tuple(got[c][k] for c in got) for k in range(len(rows))] == [tuple(x or 0 for x in N.repeat_telemetry(r, allowed, 0.8, 1.75, window, most)) for r in rows]
    frame = spark.createDataFrame([(k, r) for k, r in enumerate([*rows, None])], "k int, ids array<int>")
    got = {r.k: tuple(r.f) for r in frame.select("k", N.repeat_fires("ids").alias("f")).collect()}
    assert got == {k: N.repeat_telemetry(r or []) for k, r in enumerate([*rows, None])}
    began = time.process_time()
    assert not N.repeat_fires_of(rng.integers(0, 50, 400_000), np.arange(0, 400_001, 400))["fires"].any()
    assert time.process_time() - began < 2  # a comparison with the whole window at each step takes longer


def test_telemetry_of_many_files_takes_few_tasks(spark, tmp_path):
    texts = {f"n{k}.json": json.dumps({"fires": k}) for k in range(300)} | {"a b%20ü.json": '{"id": "é"}', "x.json": '{"id": ""}', "cut.json": "{", "empty.json": "", ".y.json": "{}", "_z.json": "{}", "w.txt": "{}"}
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    (tmp_path / "folder.json").mkdir()
    for folder in (f"file://{tmp_path}", str(tmp_path)):
        found = lists.read_telemetry(spark, folder)
        want = {(f"n{k}", texts[f"n{k}.json"]) for k in range(300)} | {("é", texts["a b%20ü.json"]), ("x", texts["x.json"])}
        assert sorted(map(tuple, found.collect())) == sorted(want)
        assert found.rdd.getNumPartitions() <= 4  # the shuffle's, however many files there are


def test_lines_and_hulls_of_many_pages_equal_those_of_each():
    rng, pages = np.random.default_rng(9), []
    for n in rng.integers(1, 30, 80).tolist():  # few places, so that middles meet; some boxes without a side
        pages.append(np.column_stack([np.arange(n), rng.integers(0, 6, n) * 10, rng.integers(0, 6, n) * 10, rng.integers(0, 4, n) * 4, rng.integers(0, 6, n) * 7]))
    columns, at = np.concatenate(pages).T, np.cumsum([0, *map(len, pages)])
    page, line, own = G.lines_of_boxes(at, *columns)
    want, hulls = [], []
    for k, rows in enumerate(pages):
        limit, last, anchor, now, points = 0.5 * float(np.median(rows[:, 4])), {}, None, -1, {}
        for r in rows.tolist():
            last[r[2] + r[4] / 2, r[1] + r[3] / 2] = r
        for (cy, _), r in sorted(last.items()):
            if anchor is None or cy - anchor > limit:
                anchor, now = cy, now + 1
            want.append((k, now, int(at[k]) + r[0]))
            points.setdefault(now, []).extend((a, b) for a in (r[1], r[1] + r[3]) for b in (r[2], r[2] + r[4]))
        for n, own_points in points.items():
            ring = G.hull(own_points)
            hulls.append((k, n, len(ring), sum(a * d - c * b for (a, b), (c, d) in zip(ring, ring[1:] + ring[:1])) / 2))
    assert list(zip(page.tolist(), line.tolist(), own.tolist())) == want
    assert [tuple(r) for r in zip(*(v.tolist() for v in G.merged_hulls(page, line, *(c[own] for c in columns[1:]))))] == hulls


def test_texts_become_objects_in_pieces_of_bounded_bytes(spark):
    given = pa.array(["", None, "ab" * 30, "c" * 300, None, "é" * 40, "d", "e" * 90, ""], pa.string())
    parts = list(T.slices(given.slice(1), 100))
    assert pa.concat_arrays(parts).to_pylist() == given.to_pylist()[1:]
    assert all(len(p) == 1 or sum(len((t or "").encode()) for t in p.to_pylist()) <= 100 for p in parts) and len(parts) > 3
    assert list(T.slices(given.slice(0, 0))) == []
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(given.to_pylist())], "k int, t string").coalesce(1)
    got = sorted(frame.select("k", T.reordered("t").alias("r"), T.repetition("t").alias("n")).collect())
    assert [r.r for r in got] == given.to_pylist() and [r.n.n for r in got] == [int(bool(t)) for t in given.to_pylist()]


def plain_beam(logp, width, least, blank=0):
    """The beam search over whole tuples, with all that score nothing."""
    add, beams = lambda a, b: max(a, b) + math.log1p(math.exp(-abs(a - b))) if min(a, b) > -math.inf else max(a, b), {(): (0.0, -math.inf)}
    for row in logp:
        new = {}

        def give(prefix, b, nb):
            old = new.get(prefix, (-math.inf, -math.inf))
            new[prefix] = (add(old[0], b), add(old[1], nb))

        for symbol in np.flatnonzero((row >= least) | (row == row.max())).tolist():
            p = float(row[symbol])
            for prefix, (b, nb) in beams.items():
                if symbol == blank:
                    give(prefix, add(b, nb) + p, -math.inf)
                elif prefix and prefix[-1] == symbol:
                    give((*prefix, symbol), -math.inf, b + p)
                    give(prefix, -math.inf, nb + p)
                else:
                    give((*prefix, symbol), -math.inf, add(b, nb) + p)
        beams = dict(sorted(new.items(), key=lambda kv: (-add(*kv[1]), kv[0]))[:width])
    best = max(beams.items(), key=lambda kv: (add(*kv[1]), kv[0]))
    return list(best[0]), add(*best[1])


def test_beam_search_grows_with_its_steps():
    rng = np.random.default_rng(5)
    for k in range(60):  # every other table has scores of few values, so that many prefixes are even
        x = rng.integers(-3, 0, (40, 4)).astype(float) if k % 2 else np.log(rng.dirichlet(np.ones(5), 40))
        width, least = int(rng.integers(1, 9)), float(rng.choice([-1.0, -2.0, -3.0]))
        assert N.beam_search(x, width, least) == plain_beam(x, width, least)
    assert N.beam_search(np.zeros((0, 3))) == ([], 0.0)
    best = rng.integers(0, 6, 30_000)
    x = np.full((len(best), 64), -4.2)
    x[np.arange(len(best)), best] = -3.5
    began = time.process_time()
    path, _ = N.beam_search(x)
    assert path == [int(s) for k, s in enumerate(best) if s and (not k or best[k - 1] != s)]
    assert time.process_time() - began < 10  # each step copied 64 prefixes


def test_hybrid_decode_equals_brute_force(spark):
    rng, likely, rows, want = np.random.default_rng(2), [0, 17, 18, 19], [], {}
    for line in range(12):  # steps from 1,000 on, the likely symbols beyond the 16th, great scores, every other line sure of its symbols
        x = np.full((4, 20), 980.0)
        x[:, likely] = 1000 + rng.random((4, 4)) * (12 if line % 2 else 1)
        p = np.exp(x - x.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        total = {}
        collapse = lambda path: tuple(s for k, s in enumerate(path) if s and (not k or path[k - 1] != s))
        for path in itertools.product(likely, repeat=4):
            total[collapse(path)] = total.get(collapse(path), 0.0) + math.prod(p[t, s] for t, s in enumerate(path))
        best = p.argmax(axis=1).tolist()
        score = [math.log(p[t, s]) for t, s in enumerate(best) if s and (not t or best[t - 1] != s)]
        sure = bool(score) and sum(score) / len(score) >= -0.5
        want[line] = (collapse(best), "greedy") if sure else (max(total, key=total.get), "beam")
        got = N.hybrid_decode(x)
        assert (tuple(got[0]), got[1]) == want[line]
        rows += [(1000 + 4 * line + t, line, x[t].tolist()) for t in range(4)]
    assert {how for _, how in want.values()} == {"greedy", "beam"}
    e = SimpleNamespace(vectors=spark.createDataFrame(rows[::-1], "step_id long, line_id int, logits array<float>"))
    assert {r.line_id: (r.how, r.n) for r in steps.beam(e).collect()} == {k: (how, len(path)) for k, (path, how) in want.items()}


def boxes(width, height, *given):
    """Pixel boxes of (middle, size) shares of a page."""
    return [(math.floor((x - w / 2) * width), math.floor((y - h / 2) * height), math.ceil((x + w / 2) * width), math.ceil((y + h / 2) * height)) for x, y, w, h in given]


def test_geometry(spark):
    full, none = (0.5, 0.5, 1.0, 1.0), (0.5, 0.5, 0.0, 1.0)
    tilt = lambda a: G.skew(F.lit(float(a)))
    r = one(spark, *[G.pixel_box(*map(F.lit, b), F.lit(100), F.lit(200)) for b in (full, none)], G.anchored_lines(F.array(*[F.lit(v) for v in (0, 8, 16)]), 10), tilt(-45), tilt(45), tilt(46), tilt(90), tilt(-46), tilt(0), G.clamp_short(F.lit(99999)), G.crop_margin(F.lit(200), F.lit(200), F.lit(40), 0.02, 8, 0.5))
    assert tuple(r[0]) == (0, 0, 100, 200) and r[1] is None and r[2] == [0, 0, 1]
    assert list(r[3:9]) == [-45.0, 45.0, -44.0, 0.0, 44.0, 0.0] and r[9] == 32767 and r[10] == 20
    assert G.columns_of([(50, 50, 250, 450), (300, 50, 500, 450)]) == [0, 1]
    assert G.columns_of([(50, 50, 450, 200), (50, 250, 450, 400)]) is None
    assert G.columns_of([(50, 50, 400, 450), (200, 50, 550, 450)]) is None
    assert G.columns_of([(40, 40, 240, 460), (280, 40, 480, 460), (30, 40, 490, 460)]) == [0, 1]
    assert G.outermost([(50, 50, 150, 150), (80, 80, 120, 120)]) == [0] and G.outermost([(74, 802, 944, 986), (71, 807, 931, 898)]) == [0]
    assert G.outermost([(0, 0, 10, 10), (0, 0, 10, 10)]) == [0] and G.outermost([(0, 0, 100, 3), (50, 1, 101, 4)]) == [0]  # a pixel of slack
    assert G.hull([(0, 0), (2, 0), (1, 1), (2, 2), (0, 2)]) == [(0, 0), (2, 0), (2, 2), (0, 2)]
    angle, w, h = G.least_rectangle([(0, 0), (100, 10), (99, 20), (-1, 10)])
    assert math.isclose(angle, math.degrees(math.atan2(10, 100)), abs_tol=0.01) and math.isclose(max(w, h), math.hypot(100, 10)) and 9 < min(w, h) < 11


def test_reading_order():
    cells = [(x, y, x + 30, y + 20) for x in (10, 60) for y in (10, 40, 70)]
    order = [3, 0, 5, 1, 4, 2]
    assert [[cells[k] for k in order][i] for i in G.xy_cut([cells[k] for k in order], 100, 100)] == cells
    # A title between two bands of columns, and two headings above two columns of three.
    bands = boxes(1000, 1400, (0.283, 0.321, 0.414, 0.431), (0.706, 0.310, 0.403, 0.424), (0.495, 0.601, 0.271, 0.043), (0.289, 0.785, 0.408, 0.298), (0.708, 0.785, 0.402, 0.303))
    assert [[4, 2, 0, 3, 1][k] for k in G.xy_cut([bands[k] for k in (4, 2, 0, 3, 1)], 1000, 1400)] == [0, 1, 2, 3, 4]
    page = [(0.486, 0.217, 0.236, 0.039), (0.739, 0.287, 0.352, 0.038), *((x, y, 0.388, 0.145) for x in (0.243, 0.687) for y in (0.412, 0.585, 0.761))]
    mixed = [5, 3, 1, 7, 2, 0, 6, 4]
    own = boxes(760, 1050, *page)
    assert [mixed[k] for k in G.xy_cut([own[k] for k in mixed], 760, 1050)] == list(range(8))
    # The gap counts as a share of the page: 60 of 1400 is less than 50 of 1000, so columns are cut first.
    four = [(100, 100, 475, 600), (525, 100, 900, 600), (100, 660, 475, 1200), (525, 660, 900, 1200)]
    assert G.xy_cut(four, 1000, 1400) == [0, 2, 1, 3] and G.xy_cut(four, 1000, 1000) == [0, 1, 2, 3]
    assert G.xy_cut([(0, 0, 60, 60), (30, 30, 90, 90), (20, 0, 80, 50)], 100, 100) == [0, 2, 1]
    assert G.body_regions([(280, 40, 480, 460), (40, 40, 240, 460)], 520, 500) == [1, 0]
    assert G.body_regions([(40, 100, 240, 460), (280, 100, 480, 460), (40, 20, 480, 60), (50, 110, 100, 150)], 520, 500) == [2, 0, 1]

    def plain(rects, w, h):  # the rule with exact fractions, by trying every cut
        from fractions import Fraction as Q

        if len(rects) < 2:
            return list(rects)
        best = None
        for axis, side in ((1, h), (0, w)):
            for edge in sorted({r[axis + 2] for r in rects}):
                after = [r[axis] for r in rects if r[axis] > edge]
                if after and not any(r[axis] < min(after) and r[axis + 2] > edge for r in rects):
                    found = (Q(min(after) - edge, side), axis, Q(edge + min(after), 2))
                    best = max(best, found) if best else found
        if best is None:
            return sorted(rects, key=lambda r: (r[1], r[0]))
        _, axis, at = best
        first = [r for r in rects if Q(r[axis] + r[axis + 2], 2) < at]
        return plain(first, w, h) + plain([r for r in rects if r not in first], w, h)

    rng = np.random.default_rng(6)
    for _ in range(300):
        own = list({(x, y, x + int(rng.integers(5, 40)), y + int(rng.integers(5, 40))) for x, y in rng.integers(0, 90, (int(rng.integers(1, 8)), 2)).tolist()})
        assert [own[k] for k in G.xy_cut(own, 130, 170)] == plain(own, 130, 170)


def test_lines_and_control_points(spark):
    deltas = lambda *d: G.nearest_to_mean(F.array(*[F.lit(float(v)) for v in d]))
    rect = lambda *a: F.array(*[F.struct(F.lit(float(x)).alias("angle"), F.lit(10.0).alias("w"), F.lit(float(w)).alias("h")) for x, w in a])
    r = one(spark, deltas(0, 30, 10), deltas(0, 0), deltas(20, 20, 0), deltas(5), deltas(0, 0, 9), G.page_rotation(rect((1, 1), (1, 1), (1.2, 2), (80, 9), (0, 9))), G.page_rotation(rect((0.1, 1), (0.1, 1))), G.page_rotation(rect((6, 1))), G.page_rotation(rect((89, 1), (89, 3))))
    assert list(r[:5]) == [2, -1, 0, 0, 2] and math.isclose(r[5], 1.1) and r[6] == 0.0 and r[7] == 0.0 and math.isclose(r[8], -1.0)
    level = np.array([(0, 10), (400, 10), (400, 30), (0, 30)])
    bent = np.array([(0, 10), (200, 10), (400, 200), (400, 220), (200, 30), (0, 30)])
    middles, heights = G.contour_slices(level)
    assert middles[:, 0].tolist() == [20, 80, 220, 320, 381] and set(middles[:, 1]) == {20} and set(heights) == {21}
    assert G.control_points([level], 500, 300) is None and G.control_points([], 500, 300) is None
    rows = G.control_points([level, bent], 500, 300)
    assert len(rows) == 9 and rows[5:] == [(0, 0, 0, 0), (0, 499, 0, 499), (299, 0, 299, 0), (299, 499, 299, 499)] and len({r[2] for r in rows[:5]}) == 1
    from quireflow.functions import images as I

    page = np.full((100, 200, 3), 230, np.uint8)
    page[:, :1] = 0
    page[40:60, 50:150] = 20
    assert I.paper_colour(page) == (230, 230, 230) and I.paper_colour(page[:5]) == I.PAPER
    clean = I.painted(page, [(40, 30, 160, 70)], [(100, 40, 110, 60)])
    assert (clean[45, 60] == 230).all() and (clean[45, 105] == 20).all() and I.painted(page, []) is page and (page[45, 60] == 20).all()
    crop = I.cropped(page, (140, 50, 210, 110), 10, blank=[(140, 50, 145, 60)])
    assert crop.shape == (80, 90, 3) and (crop[12, 12] == 230).all() and (crop[12, 17] == 20).all() and (crop[79, 89] == 230).all()


def test_sizes(spark):
    lit = F.lit
    r = one(
        spark, N.fitted_scale(lit(40), lit(4e6), lit(1e6)), N.fitted_scale(lit(49), lit(4e6), lit(1e6)), N.fitted_scale(lit(64), lit(4e6), lit(1e6)), N.fitted_scale(lit(None).cast("int"), lit(4e6), lit(1e6)), N.fitted_size(lit(20), lit(10), 4000.0), N.fitted_size(lit(1000), lit(20), 4000.0),
        N.patch_scale(lit(3000), lit(1000), 2000, 2000, 512), N.patch_scale(lit(600), lit(400), 2000, 2000, 512), N.patch_scale(lit(1000), lit(580), 2000, 2000, 512), N.patch_scale(lit(1000), lit(600), 2000, 2000, 512), N.patch_scale(lit(1000), lit(2000), 2000, 2000, 512), N.patch_scale(lit(600), lit(300), 2000, 2000, 512),
        N.capped_scale(lit(4000), lit(100), 2000, 10**9), N.capped_scale(lit(0), lit(100), 2000, 10), F.to_json(N.frame_spans(F.array(*[lit(v).cast("long") for v in (1, 1, 98)]), lit(50))),
    )
    # 0.6 of the budget shrinks to sqrt(0.15): 64 of 24.8 pixels stay above 24; sqrt(0.1875) is 0.433, sqrt(0.25) a half.
    assert list(r[:4]) == [1.0, 1.0, 0.6, 1.0] and tuple(r[4]) == (20, 10) and tuple(r[5]) == (447, 28)
    assert [round(v, 4) for v in r[6:12]] == [0.512, 1.28, round(512 / 580, 4), 1.0, round(946 / 2000, 4), 1.0] and r[12] == 0.5 and r[13] == 1.0
    assert json.loads(r[14]) == [{"start": 0, "end": 1}, {"start": 1, "end": 2}, {"start": 2, "end": 51}]


def test_snapshots(spark):
    t = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, v string, n int")
    s = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    assert sorted(map(tuple, merge_snapshot(t, s, ["k"], {"v": F.col("s.v")}, {"v": F.col("s.v")}).collect())) == [(1, "a", 1), (2, "B", 2), (3, "C", None)]
    assert sorted(map(tuple, merge_snapshot(t, s, ["k"], {"v": F.col("s.v")}).collect())) == [(1, "a", 1), (2, "B", 2)]
    assert sorted(map(tuple, latest_per_key(t.union(t.selectExpr("k", "v", "n + 1")), ["k"], F.desc("n")).collect())) == [(1, "a", 2), (2, "b", 3)]


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "list.txt").write_text("W22084,I0886\nW22084 I0887\n\n# comment\nalone\nW12345,I0123,benchmark,202603\n")
    done = spark.createDataFrame([("W22084", "I0886")], "w_id string, i_id string")
    assert [r.i_id for r in lists.read_volume_list(spark, f"file://{tmp_path}/list.txt", done, 1).collect()] == ["I0887"]
    bad = spark.createDataFrame([("w", "i", "elsewhere", None)], "w_id string, i_id string, source string, i_version string")
    with pytest.raises(Exception, match="unknown source"):
        lists.routed(bad).collect()
    (tmp_path / "e.jsonl").write_text('{"img_filename":"a.jpg","stage":"S","message":"m"}\nnot json\n{"img_file_name":"b.jpg","error_message":"n"}\n')
    assert sorted((r.file, r.message) for r in lists.read_errors(spark, [f"file://{tmp_path}/e.jsonl"]).collect()) == [("a.jpg", "m"), ("b.jpg", "n")]
    (tmp_path / "m.json").write_text(json.dumps([{"filename": f} for f in ("a.jpg", "b.TIF", "c.txt", "noext", "d/e.jpg", None)]))
    assert [tuple(r) for r in lists.read_manifest(spark, f"file://{tmp_path}/m.json").collect()] == [(0, "a.jpg"), (1, "b.TIF")]
    pages = spark.createDataFrame([("a.jpg", True, None), ("b.jpg", False, "bad")], "file string, ok boolean, error_message string")
    assert sinks.write_artifact(pages, f"{tmp_path}/out", f"{tmp_path}/err") == {"rows": 2, "ok": 1, "errors": 1}
    assert spark.read.json(f"{tmp_path}/err").collect()[0].file == "b.jpg"
    sinks.write_marker(spark, f"{tmp_path}/_done.json", {"n": 2})
    assert json.loads((tmp_path / "_done.json").read_text()) == {"n": 2}
    assert "| a.jpg | True | - |" in sinks.report(pages, "Pages")
    (tmp_path / "im").mkdir()
    with pytest.raises(FileNotFoundError):
        lists.list_images(spark, f"file://{tmp_path}/im")
    for n in ("p.jPg", "a b.TIF", "c.txt"):
        (tmp_path / "im" / n).write_bytes(b"xy")
    listed = lists.list_images(spark, f"file://{tmp_path}/im").collect()
    assert [r.filename for r in listed] == ["a b.TIF", "p.jPg"]
    assert [r.etag for r in listed] == [f"local:2:{(tmp_path / 'im' / n).stat().st_mtime_ns}" for n in ("a b.TIF", "p.jPg")]
    manifest, tag, last = lists.listed_manifest(spark, f"file://{tmp_path}/im", "benchmark", "W1", "I1", "v1")
    assert [tuple(r) for r in manifest.collect()] == [(0, "a b.TIF"), (1, "p.jPg")] and len(tag) == 32 and last


def test_messages_and_labels(spark):
    m = spark.createDataFrame([(1, {"w_id": "W1"}, '{"w_id": "Wx", "i_id": "I1"}'), (2, {"w_id": "W2", "i_id": "I2", "source": " Benchmark "}, "{broken")], "k int, attributes map<string,string>, body string")
    assert [(r.w_id, r.i_id, r.source) for r in lists.parsed_messages(m).orderBy("k").collect()] == [("W1", "I1", None), ("W2", "I2", "benchmark")]
    with pytest.raises(Exception, match="without i_id"):
        lists.parsed_messages(m.withColumn("body", F.lit("{}")).where("k = 1")).collect()
    labels = spark.createDataFrame([("1.0 .5 .5 .2 .1",), ("4 .5 .5 .2 .1",), ("2 .5 .5 0 .1",), ("x .5 .5 .2 .1",), ("0 .5 .5 .2",), ("-1 .5 .5 .2 .1",), ("3 .1 .2 .3 .4 .9",)], "value string")
    assert [(r.cls, r.label) for r in lists.parsed_labels(labels).collect()] == [(1, "text-area"), (3, "footer")]


def test_artifacts_and_items(spark, tmp_path):
    rows = spark.createDataFrame([("a", True, None, True, False), ("b", False, "Model", False, True)], "img_file_name string, ok boolean, error_stage string, truncated boolean, skipped boolean")
    counters = sinks.write_pages(rows, "page_text_layout", f"file://{tmp_path}/p", f"file://{tmp_path}/e")
    assert counters == {"rows": 2, "ok": 1, "errors": 1, "truncated": 1, "loops": 0, "skipped": 1} and (tmp_path / "e").exists()
    assert len(spark.read.parquet(f"file://{tmp_path}/p").columns) == 26
    sinks.write_pages(rows.where("ok"), "page_text_layout", f"file://{tmp_path}/p", f"file://{tmp_path}/e")
    assert not (tmp_path / "e").exists()  # a stale sidecar goes
    sinks.write_csv(rows.select("img_file_name", "ok"), f"file://{tmp_path}/c")
    assert {line for p in (tmp_path / "c").glob("*.csv") for line in p.read_text().splitlines()} == {'"img_file_name","ok"', '"a","true"', '"b","false"'}
    items = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    sinks.write_items(items.where("k = 1"), f"file://{tmp_path}/i", "k")
    done = sinks.read_items(spark, f"file://{tmp_path}/i", "k int, v string")
    left = sinks.resume(items, done, "k")
    assert [tuple(r) for r in done.collect()] == [(1, "x")] and [r.k for r in left.collect()] == [2]
    sinks.write_responses(spark.createDataFrame([(k, "r" * k) for k in (3, 1, 2)], "img_idx int, response string"), f"file://{tmp_path}/z", "img_idx")
    import zstandard

    lines = [json.loads(x) for p in sorted((tmp_path / "z").glob("*.zst")) for x in zstandard.ZstdDecompressor().stream_reader(p.open("rb")).read().decode().splitlines()]
    assert [x["img_idx"] for x in lines] == [1, 2, 3]
    with pytest.raises(Exception, match="weren't sent"):
        sinks.send_batches(items, lambda batch: ["0"])
    sinks.send_batches(items, lambda batch: [] if len(batch) <= 10 and batch[0]["id"] == "0" else ["x"])
    assert lists.read_telemetry(spark, f"file://{tmp_path}/none").count() == 0
    pages = spark.createDataFrame([("a",), ("b",)], "f string")
    assert [r.n for r in lists.attached(pages, None, "f", ["n"]).collect()] == [None, None]
    with pytest.raises(FileNotFoundError):
        lists.attached(pages, None, "f", ["n"], required=True)
    url = f"jdbc:derby:memory:{tmp_path.name};create=true"
    items.write.format("jdbc").option("url", url).option("dbtable", "ITEMS").option("driver", "org.apache.derby.jdbc.EmbeddedDriver").save()
    options = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    assert sorted(tuple(r) for r in lists.read_sql(spark, url, "ITEMS", options).collect()) == [(1, "x"), (2, "y")]
    assert lists.read_sql(spark, url, "ITEMS", options, partition=("k", 1, 3, 2)).count() == 2


def test_accuracy_and_numbering(spark):
    from quireflow.operators.pages import line_accuracy
    from quireflow.operators.tables import numbered

    a = spark.createDataFrame([(1, ["abc", "de"])], "k int, a array<string>")
    b = spark.createDataFrame([(1, ["abx", "de"])], "k int, b array<string>")
    assert tuple(line_accuracy(a, b, "k").first()) == (1, 5, 1, 1, 0.8)
    with pytest.raises(Exception, match="number of lines"):
        line_accuracy(a, b.withColumn("b", F.array(F.lit("x"))), "k").collect()
    rows = [(k % 2 if k % 10 else 7, f"{k:04d}") for k in range(500)]
    got = numbered(spark.createDataFrame(rows, "k int, o string").repartition(5), ["k"], ["o"]).collect()
    want = {}
    assert sorted((r.k, r.o, r.number) for r in got) == [(k, o, want.setdefault(k, []).append(o) or len(want[k])) for k, o in sorted(rows)]


def test_operations(spark, tmp_path):
    from quireflow import ops

    s = ops.Store(spark, f"file://{tmp_path}/control")
    ops.create_job(s, "count_words", "q", '{"artifact_prefix": "cw"}')
    with pytest.raises(ValueError):
        ops.create_job(s, "count_words", "q")
    with pytest.raises(LookupError):
        ops.delete_job(s, "9")
    s.add("volumes", [(1, "W1", "I1", "ab" * 16, 3, 0), (2, "W1", "I2", "cd" * 16, 3, 0)])
    pages = spark.createDataFrame([(1, "a b"), (2, "c")], "page_id long, page_text string")
    out = f"file://{tmp_path}/out"
    assert ops.run_volume(s, "count_words", "W1", "I1", pages, out) == "claim" and ops.run_volume(s, "count_words", "W1", "I1", pages, out) == "skip_ack"
    assert ops.run_volume(s, "count_words", "W1", "I1", pages, out, force=True) == "force"
    task = s.tasks.first()
    assert (task.status, task.attempt, task.total_images, task.nb_errors) == ("done", 2, 2, 0) and (tmp_path / "out/cw/W1/I1/ababab/success.json").exists()
    assert ops.run_volume(s, "count_words", "W1", "I2", pages.withColumn("page_text", F.lit(None).cast("string")), out) == "claim"
    assert s.tasks.where("volume_id = 2").first().status == "terminal_failed"  # no page reached the end
    (tmp_path / "l").write_text("W1,I1\nW1,I2\n")
    assert ops.enqueue(s, "count_words", f"file://{tmp_path}/l") == (1, 1)
    s.replace("messages", s.messages.withColumn("state", F.lit("dead")))
    assert ops.redrive(s, "count_words") == 1 and ops.queue_stats(s).first().available == 1
    assert ops.main([f"file://{tmp_path}/control", "job-stats"], spark) == 0 and ops.main([f"file://{tmp_path}/control", "errors", "--type", "task-failed"], spark) == 0
    assert ops.main([f"file://{tmp_path}/control", "delete-job", "nothing"], spark) == 1
    assert ops.task_list(s).count() == 1 and ops.fleet(s).first().volumes_done == 1


def test_jobs(spark):
    pages = spark.createDataFrame([(1, "a b c"), (2, None), (3, "")], "page_id long, page_text string")
    got = {r.page_id: (r.n, r.error_stage) for r in jobs.run("count_words", pages).collect()}
    assert got == {1: (3, None), 2: (None, "Model"), 3: (1, None)}
    with pytest.raises(KeyError, match="count_words"):
        jobs.find("nothing")
    with pytest.warns(UserWarning, match="odd"):
        assert dataclasses.asdict(jobs.configured(jobs.CountConfig, {"odd": 1, "least": 4})) == {"least": 4}


def test_job_surface():
    assert [n for n in ("line_detection", "line_text", "page_text", "page_class", "page_class_v2", "layout", "layout_text", "layout_text_v2", "cloud_text") if jobs.find(n)]
    v1, v2 = (jobs.configured(jobs.find(n)[1], {}) for n in ("layout_text", "layout_text_v2"))
    assert {k for k, v in dataclasses.asdict(v1).items() if dataclasses.asdict(v2)[k] != v} == {"layout_mask", "layout_split", "layout_footnotes"}
    for bad in ({"max_tokens": 10}, {"memory_share": 1.0}, {"repetition_penalty": 0}, {"presence_penalty": 3}, {"max_image_side": 100}, {"max_page_failure_rate": 2}):
        with pytest.raises(ValueError):
            jobs.PageTextConfig(**bad)
    with pytest.raises(NotImplementedError):
        jobs.run("page_text", None)
    assert [len(jobs.SWEEPS[n].runs(jobs.PageTextConfig())) for n in ("minimal", "entropy", "consistency", "full")] == [1, 1, 1, 2] and jobs.SWEEPS["full"].runs(jobs.PageTextConfig())[0]["logprobs"] == 5
    guard, scores = jobs.RepeatGuard(), np.zeros(10)
    ids = list(range(8)) * 2 + list(range(5))
    guard(ids, scores)
    assert scores[5] == pytest.approx(-0.8 * 1.75 ** (13 - 12)) and guard.stats["fires"] == 1 and guard.stats["first_pos"] == 21 and np.count_nonzero(scores) == 1


def test_lease_outcomes():
    seen = tasks.lease_outcomes([(1, "receive"), (2, "receive"), (10, "extend"), (500, "receive"), (5000, "ack"), (5001, "receive"), (9000, "receive"), (9001, "receive"), (9002, "ack"), (9003, "extend")])
    assert seen == ["delivered", "hidden", "extended", "delivered", "stale", "delivered", "dead", "delivered", "acked", "stale"]

    class Quick(tasks.Clock):
        t = 0.0
        now = lambda self: self.t

        def sleep(self, seconds):
            self.t += seconds

    clock, calls = Quick(), []

    def submit(name):
        calls.append((clock.t, name))
        if len(calls) <= 2:
            raise tasks.QuotaError
        if name == "b":
            raise OSError("no")

    ops, pauses = tasks.run_operations(["a", "b", "c"], submit, lambda name: (True, "bad" if name == "c" else None), clock=clock, in_flight=2, retries=2)
    assert [(o.name, o.status, o.attempts) for o in ops] == [("a", "completed", 0), ("b", "failed", 2), ("c", "failed", 0)] and pauses == 2
    assert [t for t, _ in calls[:3]] == [0.0, 60.0, 150.0]
    with pytest.raises(TimeoutError):
        tasks.run_operations(["a"], lambda name: None, lambda name: (False, None), clock=Quick(), timeout=100)


def test_a_worker_stops_when_idle(spark, tmp_path):
    spark.range(5).write.parquet(f"file://{tmp_path}/q")
    stream, seen = tasks.queue(spark, f"file://{tmp_path}/q", spark.range(1).schema), []
    assert tasks.run_until_idle(stream, lambda b, n: seen.append(b.count()), f"file://{tmp_path}/c", empty_polls=2, interval_s=1) == 1 and seen == [5]
