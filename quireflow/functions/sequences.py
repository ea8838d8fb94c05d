"""Sequence and sizing functions: entropy, decoding of step scores, budgets."""

from __future__ import annotations

import functools
import math
import weakref

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from . import bound


def softmax(logits: Column) -> Column:
    """Probabilities, with the greatest score moved to 0 first."""
    raised = bound(F.array_max(logits), lambda top: F.transform(logits, lambda x: F.exp((x - top).cast("double"))))
    return bound(raised, lambda e: bound(F.aggregate(e, F.lit(0.0), lambda a, x: a + x), lambda total: F.transform(e, lambda x: x / total)))


def entropy(logits: Column) -> Column:
    """In nats; 0 for an empty array."""
    own = lambda p: F.aggregate(F.filter(p, lambda x: x > 0), F.lit(0.0), lambda a, x: a - x * F.ln(x))
    return F.when(F.size(logits) == 0, 0.0).otherwise(bound(logits, lambda v: own(softmax(v))))


def log_softmax(logits: Column) -> Column:
    def shifted(v, top):
        total = F.ln(F.aggregate(v, F.lit(0.0), lambda a, x: a + F.exp(x.cast("double") - top)))
        return bound(total, lambda t: F.transform(v, lambda x: x.cast("double") - top - t))

    return bound(logits, lambda v: bound(F.array_max(v).cast("double"), lambda top: shifted(v, top)))


def argmax(values: Column) -> Column:
    """Position of the greatest value, from 0, the first of equals."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def greedy_path(best: Column, blank: int = 0) -> Column:
    """Collapses equal neighbours, then drops blanks."""
    kept = F.filter(best, lambda x, i: (x != blank) & ((i == 0) | (x != F.get(best, i - 1))))
    return kept


def greedy_confidence(best: Column, score: Column, blank: int = 0) -> Column:
    """Mean score of the steps that emit; minus infinity if none does."""

    def mean(b):
        kept = F.filter(F.transform(b["b"], lambda x, i: F.when((x != blank) & ((i == 0) | (x != F.get(b["b"], i - 1))), F.get(b["s"], i))), lambda s: s.isNotNull())
        return bound(kept, lambda k: F.when(F.size(k) == 0, F.lit(float("-inf"))).otherwise(F.aggregate(k, F.lit(0.0), lambda a, s: a + s) / F.size(k)))

    return bound(F.struct(best.alias("b"), score.alias("s")), mean)


def repetition_penalty(length: Column, allowed: int = 12, multiplier: float = 0.8, base: float = 1.75) -> Column:
    """Of a token that would make a repeat of this length: 0 below the allowed one, then growing by the base."""
    return F.when(length >= allowed, -multiplier * F.pow(F.lit(base), length - allowed)).otherwise(0.0)


def match_lengths(ids: list[int], window: int = 512, most: int = 50, breakers: frozenset = frozenset()) -> dict[int, int]:
    """For each token that once followed the present suffix: the length of the longest such suffix, ``most`` + 1 at most, without a breaker in it. A breaker follows nothing."""
    ids = list(ids)[-window:]
    out: dict[int, int] = {}
    if len(ids) < 2 or ids[-1] in breakers:
        return out
    for i in range(len(ids) - 1):
        if ids[i] == ids[-1] and ids[i + 1] not in breakers:
            n = 1
            while n <= most and n <= i and ids[i - n] == ids[-1 - n] and ids[i - n] not in breakers:
                n += 1
            out[ids[i + 1]] = max(out.get(ids[i + 1], 0), n)
    return out


@F.pandas_udf(IntegerType())
def longest_repeat(ids: pd.Series) -> pd.Series:
    return ids.map(lambda x: max(match_lengths(x).values(), default=0) if x is not None else 0).astype("int32")


_FIRES = StructType([StructField(n, DoubleType() if n.endswith("penalty") else IntegerType()) for n in ("fires", "max_length", "max_penalty", "sum_penalty", "first_pos", "last_pos")])


def repeat_telemetry(ids, allowed: int = 12, multiplier: float = 0.8, base: float = 1.75, window: int = 512, most: int = 50) -> tuple:
    """(fires, greatest length, greatest and summed penalty, first and last position) of the steps of a decoded row at which some token was penalised.

    One pass: at each step the runs that end there and at an earlier place grow from those of the step before."""
    ids = np.asarray(ids)
    fires, top, worst, total, first, last = 0, 0, 0.0, 0.0, None, None
    back = np.zeros(0, np.int64)  # by distance from the last place: length of the run that ends there and at the last place
    for n in range(2, len(ids) + 1):
        near = ids[max(0, n - window) : n]
        same = near[:-1] == near[-1]
        grown = np.zeros(len(same), np.int64)
        grown[: len(same)] = 1
        if len(back):
            k = min(len(back), len(same) - 1) if len(same) > 1 else 0
            if k:
                grown[-k:] += back[-k:]
        full = np.where(same, grown, 0)
        # A run can't reach before the window.
        full = np.minimum(full, np.arange(1, len(full) + 1))
        back = full
        best = int(min(full.max(initial=0), most + 1))
        if best >= allowed:
            penalty = multiplier * base ** (best - allowed)
            fires, top, worst, total = fires + 1, max(top, best), max(worst, penalty), total + penalty
            first, last = n if first is None else first, n
    return fires, top, worst, total, first, last


def longest_returns(ids: np.ndarray, at: np.ndarray, least: int, window: int, most: int) -> np.ndarray:
    """For each place of many rows (row k from at[k] to at[k + 1]): the length of the longest run that ends there and also ends earlier in the row, within the ``window`` that ends
    there and ``most`` + 1 at most; 0 if it is below ``least``.

    Places are grouped by the ``least`` symbols that end there, which are then told apart by one symbol more in turn: a run goes on where the nearest earlier place of its group is
    near enough. Only places that still share their run with another go on, so a row is paid for by what it repeats."""
    out = np.zeros(len(ids), np.int64)
    inside = np.arange(len(ids)) - np.repeat(at[:-1], np.diff(at))
    place = np.flatnonzero(inside >= least - 1)
    if not len(place):
        return out
    _, own = np.unique(ids, return_inverse=True)
    # Runs of k symbols by a number of their own; of 2k from two of k, so that equal numbers are equal runs.
    number, length = own.astype(np.int64), 1
    while length < least:
        step = min(length, least - length)
        pair = np.where(inside >= step, np.r_[np.zeros(step, np.int64), number[:-step]], 0) * (int(number.max()) + 1) + number
        number, length = np.unique(pair, return_inverse=True)[1].astype(np.int64), length + step
    group = number[place]
    for n in range(least, min(most + 1, window - 1) + 1):
        order = np.argsort(group, kind="stable")  # places of a group stay in their order
        p, g = place[order], group[order]
        linked = (g[1:] == g[:-1]) & (p[1:] - p[:-1] <= inside[p[1:]] - (n - 1)) & (p[1:] - p[:-1] <= window - n)
        out[p[1:][linked]] = n
        some = np.r_[linked, False] | np.r_[False, linked]
        some &= inside[p] >= n
        place, group = p[some], g[some]
        if len(place) < 2:
            break
        group = np.unique(group, return_inverse=True)[1] * (int(own.max()) + 1) + own[place - n]
        back = np.argsort(place, kind="stable")
        place, group = place[back], group[back]
    return out


def repeat_fires_of(ids: np.ndarray, at: np.ndarray, allowed: int = 12, multiplier: float = 0.8, base: float = 1.75, window: int = 512, most: int = 50) -> dict[str, np.ndarray]:
    """``repeat_telemetry`` of many rows at once, row k from at[k] to at[k + 1]; the positions are 0 where nothing fires. ``allowed`` is 1 at least."""
    n = len(at) - 1
    best = longest_returns(ids, at, allowed, window, most)
    hit = np.flatnonzero(best)
    row = np.searchsorted(at, hit, side="right") - 1
    penalty = np.array([multiplier * base ** max(k, 0) for k in range(most + 2 - allowed)])[best[hit] - allowed]
    out = {"fires": np.bincount(row, minlength=n), "max_length": np.zeros(n, np.int64), "max_penalty": np.zeros(n), "sum_penalty": np.bincount(row, penalty, n), "first_pos": np.zeros(n, np.int64), "last_pos": np.zeros(n, np.int64)}
    np.maximum.at(out["max_length"], row, best[hit])
    np.maximum.at(out["max_penalty"], row, penalty)
    out["last_pos"][row] = hit - at[row] + 1  # the last of a row stays
    out["first_pos"][row[::-1]] = hit[::-1] - at[row[::-1]] + 1
    return out


@F.arrow_udf(_FIRES)
def repeat_fires(ids: pa.Array) -> pa.Array:
    size = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = ids.flatten().to_numpy(zero_copy_only=False)
    at = np.r_[0, np.cumsum(size)]
    parts, k = [], 0
    while k < len(size):  # rows of so many symbols at a time, one at least: the memory doesn't follow the batch
        end = max(k + 1, int(np.searchsorted(at, at[k] + (1 << 18), side="right")) - 1)
        parts.append(repeat_fires_of(flat[at[k] : at[end]], at[k : end + 1] - at[k]))
        k = end
    found = {f.name: np.concatenate([p[f.name] for p in parts] or [np.zeros(0)]) for f in _FIRES}
    none = found["fires"] == 0
    return pa.StructArray.from_arrays([pa.array(found[f.name], type=to_arrow_type(f.dataType), mask=none if f.name.endswith("_pos") else None) for f in _FIRES], _FIRES.names)


class _Prefix:
    """A prefix as its last symbol after a shorter one, so that it costs the same whatever its length; ``jump`` leads far back, by which an ancestor is found in few steps."""

    __slots__ = ("parent", "symbol", "depth", "jump", "__weakref__")

    def __init__(self, parent: _Prefix | None, symbol: int):
        self.parent, self.symbol, self.depth, self.jump = parent, symbol, 0, self
        if parent is not None:
            far = parent.jump
            self.depth, self.jump = parent.depth + 1, far.jump if parent.depth - far.depth == far.depth - far.jump.depth and parent.depth else parent

    def back_to(self, depth: int) -> _Prefix:
        at = self
        while at.depth > depth:
            at = at.jump if at.jump.depth >= depth else at.parent
        return at

    def path(self) -> list[int]:
        out, at = [], self
        while at.parent is not None:
            out.append(at.symbol)
            at = at.parent
        return out[::-1]


def _order(a: _Prefix, b: _Prefix) -> int:
    """Below 0 if the symbols of a come before those of b, 0 if they are one."""
    if a is b:
        return 0
    depth = min(a.depth, b.depth)
    x, y = a.back_to(depth), b.back_to(depth)
    if x is y:
        return a.depth - b.depth
    while x.parent is not y.parent:
        x, y = (x.jump, y.jump) if x.jump is not y.jump else (x.parent, y.parent)
    return x.symbol - y.symbol


def beam_search(logp: np.ndarray, width: int = 64, least: float = -3.0, blank: int = 0) -> tuple[list[int], float]:
    """Prefix beam search over steps x symbols of log probabilities; symbols below ``least`` (but the best of a step) are left out.

    A step costs the same wherever it is. Prefixes that nothing leads to are left out, too: they add nothing to any other and stand behind all that something leads to."""
    root, none = _Prefix(None, blank), (-math.inf, -math.inf)
    longer: weakref.WeakValueDictionary = weakref.WeakValueDictionary()  # one object a prefix, as long as something needs it
    beams = {root: (0.0, -math.inf)}

    def add(a, b):
        least, most = (a, b) if a < b else (b, a)
        return most + math.log1p(math.exp(least - most)) if least > -math.inf else most

    logp = np.asarray(logp)
    if not len(logp):
        return [], 0.0
    kept = (logp >= least) | (logp == logp.max(axis=1, keepdims=True))
    ends = np.cumsum(kept.sum(axis=1)).tolist()
    symbols, scores = np.nonzero(kept)[1].tolist(), logp[kept].tolist()
    for start, end in zip([0, *ends], ends):
        new: dict[_Prefix, tuple[float, float]] = {}
        for k in range(start, end):
            symbol, p = symbols[k], scores[k]
            for prefix, (b, nb) in beams.items():
                if symbol == blank:
                    old = new.get(prefix, none)
                    new[prefix] = (add(old[0], add(b, nb) + p), old[1])
                    continue
                again = prefix.symbol == symbol and prefix is not root
                more = (b if again else add(b, nb)) + p
                if more > -math.inf:
                    child = longer.get((id(prefix), symbol))
                    if child is None:
                        child = longer[id(prefix), symbol] = _Prefix(prefix, symbol)
                    old = new.get(child, none)
                    new[child] = (old[0], add(old[1], more))
                if again and nb + p > -math.inf:
                    same = new.get(prefix, none)
                    new[prefix] = (same[0], add(same[1], nb + p))
        beams = new if len(new) <= width else {x: new[x] for x, _ in _ranked([(x, add(*v)) for x, v in new.items()])[:width]}
    totals = [(x, add(*v)) for x, v in beams.items()]
    top = max(v for _, v in totals)
    best = max((x for x, v in totals if v == top), key=functools.cmp_to_key(_order))
    return best.path(), top


def _ranked(found: list[tuple[_Prefix, float]]) -> list[tuple[_Prefix, float]]:
    """By falling score; equals in the order of their symbols."""
    found.sort(key=lambda f: -f[1])
    k = 0
    while k < len(found):
        end = k + 1
        while end < len(found) and found[end][1] == found[k][1]:
            end += 1
        if end - k > 1:
            found[k:end] = sorted(found[k:end], key=functools.cmp_to_key(lambda f, g: _order(f[0], g[0])))
        k = end
    return found


def hybrid_decode(logits: np.ndarray, gate: float = -0.5, width: int = 64, blank: int = 0) -> tuple[list[int], str]:
    """(path, 'greedy' or 'beam') of steps x symbols of scores: greedy if the mean log probability of the steps that emit reaches the gate."""
    x = logits - logits.max(axis=1, keepdims=True)
    p = x - np.log(np.exp(x).sum(axis=1, keepdims=True))
    best = p.argmax(axis=1)
    emits = [k for k in range(len(best)) if best[k] != blank and (not k or best[k - 1] != best[k])]
    if emits and p.max(axis=1)[emits].mean() >= gate:
        return [int(best[k]) for k in emits], "greedy"
    return beam_search(p, width=width, blank=blank)[0], "beam"


def fitted_scale(glyph: Column, original: Column, budget: Column, scales: tuple[float, ...] = (0.6, 0.75, 1.0), least: float = 24.0) -> Column:
    """The smallest share of the budget of pixels that keeps glyphs tall enough on the page brought within it; the last one if none does or the glyphs aren't known."""
    fine = F.filter(F.array(*[F.lit(s) for s in scales]), lambda s: glyph * F.least(F.lit(1.0), F.sqrt(s * budget / original)) >= least)
    return F.when(glyph > 0, F.coalesce(F.try_element_at(fine, F.lit(1)), F.lit(scales[-1]))).otherwise(scales[-1])


def fitted_size(w: Column, h: Column, budget: float, least: int = 28) -> Column:
    """(width, height) within the budget of pixels; a page that is, stays as it is, and no side shrinks below ``least``; halves round to even."""
    s = F.sqrt(F.lit(float(budget)) / (w * h))
    side = lambda x: F.when(w * h <= budget, x).otherwise(F.greatest(F.bround(x * s, 0).cast("int"), F.lit(least)))
    return F.struct(side(w).cast("int").alias("w"), side(h).cast("int").alias("h"))


def capped_scale(w: Column, h: Column, side: float, pixels: float) -> Column:
    """The scale that brings a page within the longest side and the number of pixels; 1 at most, and for a page without size."""
    s = F.least(F.lit(1.0), F.lit(float(side)) / F.greatest(w, h), F.sqrt(F.lit(float(pixels)) / (w * h)))
    return F.when((w > 0) & (h > 0), s).otherwise(1.0)


def patch_scale(w: Column, h: Column, most_w: float, most_h: float, patch: int, overlap: int = 78, snap: int = 78, rows: int = 2) -> Column:
    """The scale at which a page is cut into square patches whose rows overlap. Very wide pages become one row. Others are fitted into the greatest size, raised to one
    row if they are near it, lowered to a whole number of rows if they are little above it, and lowered to so many rows at most (0: any number)."""
    stride = patch - overlap
    fit = F.least(F.lit(float(most_w)) / w, F.lit(float(most_h)) / h, F.lit(1.0))
    tall = h * fit
    tall = F.when((tall < patch) & (tall > 0.75 * patch), float(patch)).otherwise(tall)
    row = patch + F.floor((tall - patch) / F.lit(float(stride))) * stride
    if snap > 0:
        tall = F.when((tall > patch) & (tall - row > 0) & (tall - row <= snap), row.cast("double")).otherwise(tall)
    if rows > 0:
        tall = F.least(tall, F.lit(float(patch + (rows - 1) * stride)))
    wide = F.least(F.lit(float(patch)) / h, F.lit(float(most_w)) / w)
    return F.when((w <= 0) | (h <= 0), F.raise_error(F.lit("a page without size")).cast("double")).when(w > 2.5 * h, wide).otherwise(tall / h)


def tile_counts(w: Column, h: Column, tile: int = 512) -> Column:
    """(padding right, padding below, tiles)."""
    return F.struct(F.pmod(-w, F.lit(tile)).alias("pad_w"), F.pmod(-h, F.lit(tile)).alias("pad_h"), (F.ceil(w / tile) * F.ceil(h / tile)).cast("long").alias("tiles"))


def quota_pause(k: Column, first: float = 60.0, factor: float = 1.5, most: float = 900.0) -> Column:
    return F.least(F.lit(first) * F.pow(F.lit(factor), k - 1), F.lit(most))


def byte_chunks(sizes: Column, budget: int) -> Column:
    """The chunk of each item: a running sum starts anew where the next item would go over; an item over the budget is alone; 0 or less puts all in one."""
    first = F.struct(F.lit(0).cast("long").alias("sum"), F.lit(0).alias("chunk"), F.array().cast("array<int>").alias("out"))

    def step(a, x):
        new = (a["sum"] > 0) & (a["sum"] + x > budget) if budget > 0 else F.lit(False)
        chunk = F.when(new, a["chunk"] + 1).otherwise(a["chunk"])
        return F.struct(F.when(new, x).otherwise(a["sum"] + x).cast("long").alias("sum"), chunk.alias("chunk"), F.concat(a["out"], F.array(chunk)).alias("out"))

    return F.aggregate(sizes, first, step, lambda a: a["out"])


def dual_chunks(tiles: Column, frames: int = 16, limit: int = 80) -> Column:
    """The batch of each frame: at most ``frames`` frames and ``limit`` tiles, one frame at least."""
    first = F.struct(F.lit(0).cast("long").alias("sum"), F.lit(0).alias("n"), F.lit(0).alias("chunk"), F.array().cast("array<int>").alias("out"))

    def step(a, x):
        new = (a["n"] > 0) & ((a["n"] >= frames) | (a["sum"] + x > limit))
        chunk = F.when(new, a["chunk"] + 1).otherwise(a["chunk"])
        return F.struct(F.when(new, x).otherwise(a["sum"] + x).cast("long").alias("sum"), F.when(new, 1).otherwise(a["n"] + 1).alias("n"), chunk.alias("chunk"), F.concat(a["out"], F.array(chunk)).alias("out"))

    return F.aggregate(tiles, first, step, lambda a: a["out"])


def frame_spans(lengths: Column, frames: Column) -> Column:
    """(start, end) of the frames of each piece of a line: a share by its length, cut to whole frames and one at least, one piece after the other."""
    kind = "array<struct<start:bigint,end:bigint>>"
    first = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(kind).alias("out"))

    def spans(total):
        def step(a, n):
            own = F.greatest(F.lit(1).cast("long"), F.floor(F.try_divide(frames * n, total)).cast("long"))
            return F.struct((a["at"] + own).alias("at"), F.concat(a["out"], F.array(F.struct(a["at"].alias("start"), (a["at"] + own).alias("end")))).alias("out"))

        return F.when(total > 0, F.aggregate(lengths, first, step, lambda a: a["out"])).otherwise(F.array().cast(kind))

    return bound(F.aggregate(lengths, F.lit(0).cast("long"), lambda a, n: a + n), spans)


def span_confidence(best: Column, start: Column, end: Column) -> Column:
    """The mean of the best scores of the frames from start to end, end not included; minus infinity where there are none."""
    own = F.slice(best, (start + 1).cast("int"), F.greatest(end - start, F.lit(0)).cast("int"))
    return bound(own, lambda o: F.when(F.size(o) == 0, F.lit(float("-inf"))).otherwise(F.aggregate(o, F.lit(0.0), lambda a, x: a + x) / F.size(o)))


def to_pixels(frame: Column, width: Column, frames: Column) -> Column:
    """The pixel of a frame of a line so wide; the frame itself where the line has none."""
    return (frame * F.when(frames > 0, width / frames).otherwise(1.0)).cast("long")


def run_metrics(tokens: Column, arrival: Column, scheduled: Column, first: Column, last: Column) -> Column:
    """(itl_ms, generation_throughput, e2e_latency_s, prefill_s, decode_s) from times in seconds: no span is below 0, and what isn't known is null."""
    span = lambda a, b: F.when(a.isNotNull() & b.isNotNull(), F.greatest(F.lit(0.0), b - a))
    decode = span(first, last)
    some = (tokens > 0) & (decode > 0)
    return F.struct(
        F.when(some, decode / tokens * 1000).alias("itl_ms"), F.when(some, tokens / decode).alias("generation_throughput"), span(arrival, last).alias("e2e_latency_s"), span(scheduled, first).alias("prefill_s"), decode.alias("decode_s")
    )


def lease_schedule(total: int, timeout: int = 300, every: int = 60, most: int = 43_200, stale_at: int | None = None, fails: tuple[int, ...] = (), strikes: int = 3) -> list[int]:
    """Seconds granted by each extension: never past the deadline, 1 at least, none once it is reached.

    A handle that is stale from ``stale_at`` on ends it, and so do ``strikes`` failures (of the calls at the seconds ``fails``) in a row."""
    out, bad, total, timeout = [], 0, min(total, most), min(timeout, most)
    for t in range(every, total, every):
        if stale_at is not None and t >= stale_at:
            break
        if t in fails:
            bad += 1
            if bad >= strikes:
                break
            continue
        bad = 0
        out.append(max(1, min(timeout, total - t)))
    return out
