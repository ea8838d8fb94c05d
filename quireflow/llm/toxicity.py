"""Toxicity by a classifier chain.

Categories are predicted in order; each is a logistic model over the same features and the probabilities of the categories before it.
In training those probabilities are out-of-fold predictions, so later models see inputs as uncertain as they will at scoring.

Features are folded words and the first ``PREFIXES`` bytes of longer ones, for stems that take many endings, hashed into ``WIDTH`` buckets and
present or not in the text, so that one word counts in a text of any length. A bucket is a feature if it stands in ``MIN_DOCS`` sampled texts at least
and its log-odds between texts with any category and texts without lie ``Z`` standard errors off, or if it stands in texts with a category
alone and so often that chance would do it less than once in a million; the rest of the vocabulary has no say. Two more features count the risky buckets present.

An out-of-fold prediction must not have seen its labels, and the choice of buckets sees labels too: each fold is predicted by models on the buckets that the
other folds choose. Counts are kept by fold, so those of the others are the whole less the fold's own.

The fit takes a bounded sample of labelled texts, one text an id, whose bucket counts are aggregated by Spark; the driver gets the buckets that any fold chooses and which of
them stand in each text of the sample. Scoring is one pass without a shuffle.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType

from . import kernels as K
from .common import batch, id_text, key_of, row_schemas, text_of, tidy, written
from .linear import Rows, minimise, sigmoid

BITS = 20
WIDTH = 1 << BITS
SAMPLE, FOLDS, MIN_DOCS, Z, CHANCE, STEPS, RIDGE, CUT = 20_000, 5, 3, 4.0, 1e-6, 200, 1e-4, 0.5
PREFIXES = (4, 6)


def buckets(column: pa.Array):
    """Yields (first row, last row, row, bucket): the distinct buckets of each text."""
    for i, j, h, first, data, start, end in K.word_hashes(column, fold=True):
        row, hs, rows = K.rows_of(first), [h], []
        rows.append(row)
        for n in PREFIXES:
            long = np.flatnonzero(end - start > n)
            hs.append(K.mix(K.hashes(data, start[long], start[long] + n) ^ np.uint64(n)))
            rows.append(row[long])
        key = np.sort((np.concatenate(rows).astype(np.uint64) << np.uint64(BITS)) | (np.concatenate(hs) >> np.uint64(64 - BITS)))
        key = key[np.append(True, key[1:] != key[:-1])] if len(key) else key
        yield i, j, (key >> np.uint64(BITS)).astype(np.int64), (key & np.uint64(WIDTH - 1)).astype(np.int64)


@dataclass(frozen=True)
class Chain:
    categories: tuple[str, ...]
    chosen: np.ndarray
    risky: np.ndarray
    weights: tuple[np.ndarray, ...]
    biases: tuple[float, ...]

    def rows(self, row: np.ndarray, bucket: np.ndarray, n: int) -> Rows:
        """The features of n texts: chosen buckets, then log counts of risky ones, then places for the categories before."""
        at = np.minimum(np.searchsorted(self.chosen, bucket), max(0, len(self.chosen) - 1))
        hit = self.chosen[at] == bucket if len(self.chosen) else np.zeros(len(bucket), bool)
        row, at = row[hit], at[hit]
        count = np.bincount(row[self.risky[at]], minlength=n)
        who = np.flatnonzero(count)
        r = np.concatenate([row, who, who])
        c = np.concatenate([at, np.full(len(who), len(self.chosen)), np.full(len(who), len(self.chosen) + 1)])
        v = np.concatenate([np.ones(len(row)), np.ones(len(who)), np.log2(count[who])])
        order = np.argsort(r, kind="stable")
        first = np.searchsorted(r[order], np.arange(n + 1))
        return Rows(c[order], v[order], first, len(self.chosen) + 2)

    def predict(self, x: Rows) -> np.ndarray:
        """n x categories: each model sees the features and the probabilities before it."""
        before = np.zeros((len(x), 0))
        for w, b in zip(self.weights, self.biases):
            p = sigmoid(x.dot(w[: x.width]) + before @ w[x.width :] + b)
            before = np.concatenate([before, p[:, None]], axis=1)
        return before


def _logistic(x: Rows, before: np.ndarray, y: np.ndarray, steps: int, ridge: float) -> tuple[np.ndarray, float]:
    width = x.width + before.shape[1]

    def gradient(p):
        w, b = p[:-1], p[-1]
        g = (sigmoid(x.dot(w[: x.width]) + before @ w[x.width :] + b) - y) / len(y)
        return np.concatenate([x.back(g) + ridge * w[: x.width], before.T @ g + ridge * w[x.width :], [g.sum()]])

    p = minimise(gradient, np.append(np.zeros(width), np.log((y.mean() + 1e-4) / (1 - y.mean() + 1e-4))), steps, rate=0.2)
    return p[:-1], float(p[-1])


def marked(yes: np.ndarray, have: np.ndarray, toxic: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(which buckets are features, which are risky) of buckets that stand in ``have`` of ``size`` texts, ``yes`` of them with a category, as ``toxic`` of all are."""
    if not 0 < toxic < size:
        return np.zeros(len(yes), bool), np.zeros(len(yes), bool)
    # Risky or safe by the log-odds with a half added to each count, over their standard error.
    a, b, c, d = yes + 0.5, have - yes + 0.5, toxic - yes + 0.5, (size - toxic) - (have - yes) + 0.5
    z = np.log(a * d / (b * c)) / np.sqrt(1 / a + 1 / b + 1 / c + 1 / d)
    often = math.log(CHANCE) / math.log(toxic / size)  # the error is wide for a bucket without a text on the other side
    return (have >= MIN_DOCS) & ((np.abs(z) >= Z) | ((yes == have) & (yes >= often))), z > 0


def severity(x: Rows, chain: Chain) -> np.ndarray:
    """How many risky buckets stand in each text."""
    at = x.index < len(chain.chosen)
    return np.bincount(x.row[at], chain.risky[x.index[at]].astype(np.float64), len(x))


def fit_chain(x: Rows, ys: np.ndarray, fold: np.ndarray, steps: int = STEPS, ridge: float = RIDGE, view: Callable[[int], Rows] | None = None) -> tuple[list[np.ndarray], list[float]]:
    """The models of the chain; ys: n x categories, fold: the fold of each row, view: the features of all rows without the labels of a fold (``x`` by default).

    Probabilities that a later model is trained on come from models of the other folds, on the features that those choose."""
    before, weights, biases = np.zeros((len(x), 0)), [], []
    folds = np.unique(fold)
    views = {f: view(f) if view else x for f in (folds if ys.shape[1] > 1 else ())}
    for c in range(ys.shape[1]):
        y, out = ys[:, c].astype(np.float64), np.zeros(len(x))
        for f, fx in views.items() if c + 1 < ys.shape[1] else ():
            own, rest = np.flatnonzero(fold == f), np.flatnonzero(fold != f)
            if not len(rest):
                rest = own
            w, b = _logistic(fx.take(rest), before[rest], y[rest], steps, ridge)
            out[own] = sigmoid(fx.take(own).dot(w[: fx.width]) + before[own] @ w[fx.width :] + b)
        w, b = _logistic(x, before, y, steps, ridge)
        weights.append(w)
        biases.append(b)
        before = np.concatenate([before, out[:, None]], axis=1)
    return weights, biases


def _train(row: np.ndarray, bucket: np.ndarray, ys: np.ndarray, fold: np.ndarray, known: np.ndarray, yes: np.ndarray, have: np.ndarray, names: list[str], severe: str | None, steps: int, ridge: float) -> Chain:
    """The chain from the sample: (row, bucket) of the texts, their labels and folds; ``yes`` and ``have`` count the buckets ``known`` by fold."""
    n, toxic = len(fold), ys.max(axis=1, initial=0) > 0

    def chosen(rest: np.ndarray, folds: np.ndarray) -> Chain:
        keep, risky = marked(yes[folds].sum(axis=0), have[folds].sum(axis=0), int(toxic[rest].sum()), int(rest.sum()))
        return Chain((), known[keep], risky[keep], (), ())

    all_folds = np.arange(len(yes))
    whole = chosen(np.ones(n, bool), all_folds)
    x = whole.rows(row, bucket, n)
    if severe:
        level = severity(x, whole)
        limit = max(2, np.median(level[toxic])) if toxic.any() else 2
        ys, names = np.concatenate([ys, (toxic & (level >= limit)).astype(np.int64)[:, None]], axis=1), [*names, severe]
    weights, biases = fit_chain(x, ys, fold, steps, ridge, lambda f: chosen(fold != f, all_folds[all_folds != f]).rows(row, bucket, n))
    return Chain(tuple(names), whole.chosen, whole.risky, tuple(weights), tuple(biases))


def fit(df: DataFrame, labels: DataFrame, categories: dict[str, Column | str], id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id", severe: str | None = None, sample: int = SAMPLE, steps: int = STEPS, ridge: float = RIDGE) -> Chain:
    """Fits on at most ``sample`` labelled documents; ``categories`` maps names, in the order of the chain, to 0/1 columns of ``labels``.

    ``severe`` names one more category, the last, for label tables that don't grade: texts with a category that hold at least as many risky buckets as
    the median such text. Null labels count as 0, null ids don't count, of several labels of an id the greatest counts and of its texts the least; ids may be of any type. Null texts are
    empty. If no sampled text has a category, or all do, no bucket is chosen and every text scores the base rate.
    """
    names = list(categories)
    wanted = [(F.col(c) if isinstance(c, str) else c).cast("int").alias(f"y{k}") for k, c in enumerate(categories.values())]
    ys = [f"y{k}" for k in range(len(names))]
    chosen = labels.select(key_of(labels, label_id).alias("id"), *wanted).where("id is not null").groupBy("id").agg(*[F.coalesce(F.max(y), F.lit(0)).alias(y) for y in ys]).orderBy(F.xxhash64("id"), "id").limit(sample)
    texts = written(id_text(df, id_col, text_col).join(F.broadcast(chosen), "id").groupBy("id", *ys).agg(F.min("text").alias("text")), "toxicity")  # one text an id: bounded by ``sample``
    any_of = F.greatest(*[F.col(y) for y in ys], F.lit(0)).alias("any")
    fold_of = F.pmod(F.xxhash64("id"), F.lit(FOLDS)).cast("int").alias("fold")

    def present(batches):
        schema = pa.schema([("fold", pa.int32()), ("bucket", pa.int32()), ("any", pa.int32())])
        for x in batches:
            fold, label = x.column("fold").to_numpy(), x.column("any").to_numpy()
            for i, _, row, bucket in buckets(x.column("text")):
                yield batch(schema, fold[i + row], bucket.astype(np.int32), label[i + row])

    counts = texts.select(fold_of, "text", any_of).mapInArrow(present, "fold int, bucket int, any int").groupBy("bucket", "fold").agg(F.sum("any").alias("yes"), F.count("*").alias("have"))
    counts = counts.groupBy("bucket").agg(F.sum("yes").alias("yes"), F.sum("have").alias("have"), F.map_from_entries(F.collect_list(F.struct("fold", F.struct("yes", "have")))).alias("by"))
    size = texts.select(fold_of, any_of).groupBy("fold").agg(F.count("*").alias("n"), F.sum("any").alias("yes")).collect()  # a row a fold
    total, toxic = sum(r.n for r in size), sum(r.yes for r in size)
    # What no fold could choose stays behind: a bucket in too few texts, or far from a mark even without any one fold.
    part = lambda k, c: F.coalesce(F.try_element_at("by", F.lit(k))[c], F.lit(0))
    use = [(F.col("yes"), F.col("have"), toxic, total)] + [(F.col("yes") - part(r.fold, "yes"), F.col("have") - part(r.fold, "have"), toxic - r.yes, total - r.n) for r in size]
    marks = [_mark(*u) for u in use if 0 < u[2] < u[3]]
    known = counts.where(functools.reduce(lambda a, b: a | b, marks)).orderBy("bucket").collect() if marks else []  # the vocabulary with a mark: at most the WIDTH buckets
    keep = np.array([m.bucket for m in known], np.int64)
    yes, have = (np.array([[m.by[f][k] if f in m.by else 0 for m in known] for f in range(FOLDS)], np.float64).reshape(FOLDS, len(known)) for k in (0, 1))

    def chosen_of(batches):
        schema = pa.schema([("id", pa.int64()), ("fold", pa.int32()), ("b", pa.binary()), *((y, pa.int32()) for y in ys)])
        for x in batches:
            for i, j, row, bucket in buckets(x.column("text")):
                at = np.isin(bucket, keep)
                row, bucket = row[at], bucket[at]
                cut = np.searchsorted(row, np.arange(j - i + 1))
                own = x.slice(i, j - i)
                yield batch(schema, own.column("id"), own.column("fold"), [bucket[s:e].astype("<u4").tobytes() for s, e in zip(cut[:-1], cut[1:])], *[own.column(y) for y in ys])

    rows = texts.select("id", fold_of, "text", *ys).mapInArrow(chosen_of, "id long, fold int, b binary, " + ", ".join(f"{y} int" for y in ys)).collect()  # bounded by ``sample``
    if not rows:
        names = names + [severe] if severe else names
        return Chain(tuple(names), keep[:0], np.zeros(0, bool), tuple(np.zeros(2 + k) for k in range(len(names))), (-30.0,) * len(names))
    rows.sort(key=lambda r: (r.id, r.b))
    own = [np.frombuffer(r.b, "<u4").astype(np.int64) for r in rows]
    y = np.array([[r[k] for k in ys] for r in rows], np.int64).reshape(len(rows), len(ys))
    return _train(np.repeat(np.arange(len(own)), [len(o) for o in own]), np.concatenate(own), y, np.array([r.fold for r in rows]), keep, yes, have, names, severe, steps, ridge)


def _mark(yes: Column, have: Column, toxic: int, size: int) -> Column:
    """``marked`` as a column."""
    a, b, c, d = yes + 0.5, have - yes + 0.5, toxic - yes + 0.5, (size - toxic) - (have - yes) + 0.5
    z = F.log(a * d / (b * c)) / F.sqrt(1 / a + 1 / b + 1 / c + 1 / d)
    often = math.log(CHANCE) / math.log(toxic / size)
    return (have >= MIN_DOCS) & ((F.abs(z) >= Z - 1e-9) | ((yes == have) & (yes >= often)))


def score(df: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text", cut: float = CUT) -> DataFrame:
    """(id, p_<category> ..., toxic, keep) for every row: toxic if any category's probability reaches ``cut``, keep if none does.

    Null and empty texts score as texts without a known word. Rows with null or repeated ids are rows like others, equal texts score
    alike, an empty table gives no rows, and other columns are ignored. Whole texts count.
    """
    docs = text_of(df, id_col, text_col)
    schema, arrow = row_schemas(docs, [*((f"p_{c}", DoubleType()) for c in chain.categories), ("toxic", BooleanType()), ("keep", BooleanType())])

    @tidy
    def scored(batches):
        for x in batches:
            for i, j, row, bucket in buckets(x.column("text")):
                p = chain.predict(chain.rows(row, bucket, j - i))
                toxic = (p >= cut).any(axis=1)
                yield batch(arrow, x.column("id").slice(i, j - i), *p.T, toxic, ~toxic)

    return docs.mapInArrow(scored, schema)
