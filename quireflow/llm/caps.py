"""Embedding near-dedup with spherical-cap filters.

A filter is a Gaussian direction; a vector falls into it if their product exceeds z. Two vectors within the cosine threshold share
filters with a known probability, so the number of filters follows from the target recall, and z from the load: the vectors that a filter takes by chance.

The directions are a structured product code: the space is turned at random and split into blocks, each block has its own random codewords, and
every choice of a codeword per block is a direction. There are ``CODES`` codes with turns of their own. A vector is list-decoded to all filters it exceeds: of the choices in
the first block only those are followed that the best of the second can lift over z.

Vectors travel as sketches of four bits a dimension, one record for each codeword of the first block with the codewords of the second that it exceeds with it; equal vectors go once a task.
Sketches that meet in a filter and may reach the threshold are joined into a spanning forest, so m copies cost O(m) edges; what that connects are candidates. The candidates' vectors
are then fetched, once each, and all pairs within a set of candidates are compared exactly, in blocks that spread a large set over all tasks: this verifies the links, finds what the
filters missed within the set, and counts the links of each vector.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import lru_cache
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .common import PACKED, batch, by_part, checkpoint, col, key_of, named, packed_batches, parts_for, tidy, unpack, written
from .components import connected_components
from .simhash import _forest, group_sizes, spread_blocks

COSINE, RECALL, LOAD, BLOCKS, CODES, SLACK, SEED = 0.95, 0.99, 64, 2, 4, 3, 29
#: How far below the threshold two sketches may be to be candidates: the sketch of four bits is off by less for nearly all pairs (tests/llm/test_caps.py).
MARGIN, SLOTS = 0.045, 4
_CHUNK, _CELLS = 512, 1 << 24


def both_exceed(z: float, rho: float) -> float:
    """P(X > z and Y > z) of standard normals with correlation rho."""
    normal, s = NormalDist(), math.sqrt(max(1e-12, 1 - rho * rho))
    x = np.linspace(z, z + 8, 4001)
    inner = np.array([normal.cdf((rho * v - z) / s) for v in x])
    f = np.exp(-x * x / 2) / math.sqrt(2 * math.pi) * inner
    return float(np.sum((f[1:] + f[:-1]) / 2) * (x[1] - x[0]))


@dataclass(frozen=True)
class Caps:
    """The code for a number of vectors: z and the codewords per block."""

    dim: int
    z: float
    words: int

    @classmethod
    def of(cls, n: int, dim: int, cosine: float = COSINE, recall: float = RECALL, load: int = LOAD) -> Caps:
        z = max(1.0, NormalDist().inv_cdf(1 - min(0.1, load / max(n, 1))))
        # Filters that share codewords aren't independent; several codes and more filters make up for most of it: 0.98 of the
        # pairs at the threshold are found at a target of 0.99 (tests/llm/test_caps.py).
        need = SLACK * math.log(1 / (1 - recall)) / both_exceed(z, cosine) / CODES
        return cls(dim, z, max(2, math.ceil(need ** (1 / BLOCKS))))


@lru_cache(maxsize=4)
def _codes(caps: Caps) -> list[tuple[np.ndarray, list[np.ndarray]]]:
    """(turn, codewords by block: block size x words) of each code."""
    rng = np.random.default_rng(SEED)
    blocks = [len(b) for b in np.array_split(np.arange(caps.dim), BLOCKS)]
    return [(np.linalg.qr(rng.standard_normal((caps.dim, caps.dim)))[0], [rng.standard_normal((b, caps.words)) for b in blocks]) for _ in range(CODES)]


def decode(v: np.ndarray, caps: Caps) -> tuple[np.ndarray, np.ndarray]:
    """(vector, filter) for all filters that each unit vector exceeds, by code, vector and first codeword; it holds ``_CELLS`` sums at most at a time."""
    owner, filters = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    rows = max(1, _CELLS // caps.words)
    for k, (turn, code) in enumerate(_codes(caps)):
        for r in range(0, len(v), rows):
            a, b = (x @ c for x, c in zip(np.array_split(v[r : r + rows] @ turn, BLOCKS, axis=1), code))
            who, first = np.nonzero(a + b.max(axis=1, keepdims=True) > caps.z)
            for s in range(0, len(who), rows):
                w, f = who[s : s + rows], first[s : s + rows]
                x, second = np.nonzero(a[w, f][:, None] + b[w] > caps.z)
                owner.append(r + w[x])
                filters.append((k * caps.words + f[x]) * caps.words + second)
    return np.concatenate(owner), np.concatenate(filters)


def sketch(v: np.ndarray) -> np.ndarray:
    """Four bits a dimension of unit vectors, turned at random first so that no dimension is far greater than others: n x ceil(dim / 2) bytes."""
    q = np.rint(v * (7 / np.maximum(np.abs(v).max(axis=1, keepdims=True), 1e-30))).astype(np.int8) + 8
    if q.shape[1] % 2:
        q = np.concatenate([q, np.full((len(q), 1), 8, np.int8)], axis=1)
    return (q[:, ::2] | (q[:, 1::2] << 4)).astype(np.uint8)


def unsketched(s: np.ndarray) -> np.ndarray:
    """The unit vectors that sketches stand for."""
    q = np.empty((len(s), 2 * s.shape[1]), np.float32)
    q[:, ::2], q[:, 1::2] = (s & 15).astype(np.float32) - 8, (s >> 4).astype(np.float32) - 8
    return q / np.maximum(np.linalg.norm(q, axis=1, keepdims=True), 1e-30)


def bucket_edges(v: np.ndarray, node: np.ndarray, least: float) -> np.ndarray:
    """Forest edges that connect the nodes whose vectors reach the cosine ``least``. A set grows from a frontier, which is compared with what isn't yet connected only."""
    if len(v) <= _CHUNK:
        x, y = np.nonzero(np.triu(v @ v.T >= least, 1))
        return _forest(np.stack([node[x], node[y]], axis=1)) if len(x) else np.zeros((0, 2), np.int64)
    rest, out = np.arange(len(v)), []
    while len(rest) > 1:
        frontier, rest = rest[:1], rest[1:]
        root = frontier[0]
        while len(frontier) and len(rest):
            own, frontier = frontier[:64], frontier[64:]
            hit = (v[rest] @ v[own].T >= least).any(axis=1)
            found, rest = rest[hit], rest[~hit]
            out.append(np.stack([np.full(len(found), node[root]), node[found]], axis=1))
            frontier = np.concatenate([frontier, found])
    return np.concatenate(out) if out else np.zeros((0, 2), np.int64)


def unit(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(unit vectors, whether the row has one): null, of another size, zero and not finite ones have none."""
    n = len(column)
    column = column.cast(pa.list_(pa.float32()))
    values = column.values.fill_null(np.nan).to_numpy(zero_copy_only=False)
    offsets = column.offsets.to_numpy().astype(np.int64)
    good = (np.diff(offsets) == dim) & ~column.is_null().to_numpy(zero_copy_only=False)
    out = np.zeros((n, dim), np.float64)
    out[good] = values[offsets[:-1][good][:, None] + np.arange(dim)]
    size = np.linalg.norm(out, axis=1)
    good &= np.isfinite(size) & (size > 0)
    out[~good] = 0
    out[good] /= size[good, None]
    return out, good


def group_near_vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", cosine: float = COSINE, recall: float = RECALL, load: int = LOAD, dim: int | None = None) -> DataFrame:
    """(id, group, keep, class, links): one row for every vector.

    ``class`` is the least id of the vectors equal to it: copies are one class. ``links`` is how many other classes of its group have at least this cosine
    with it, all counted. ``group`` is the least id of those that are connected by links, which alone has keep.

    A pair at the threshold is found with probability ``recall``, nearer ones more surely, any pair within a set of candidates always, and equal vectors always (equality is that of a 64-bit hash).
    Vectors of every size are searched, each among those of its own
    size; with ``dim``, those of that size alone. Null, empty and zero vectors, those of another size than a given ``dim`` and those with a null, NaN or
    infinity in them are duplicates of nothing, with no links. Rows that share an id count as one; of several vectors under an id all count: its class is the least and its links
    are the sum. Rows without an id are left out, ids may be of any type (of others than whole numbers the least is that of the least hash), an empty table gives no rows, and other columns are ignored.
    """
    rows = df.select(key_of(df, id_col).alias("id"), col(df, vec_col).cast("array<float>").alias("v")).where("id is not null")
    finite = F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))) & F.exists("v", lambda e: e != 0)
    sound = rows.where(F.col("v").isNotNull() & finite if dim is None else F.col("v").isNotNull() & finite & (F.size("v") == dim)).withColumn("k", F.xxhash64(F.size("v"), "v"))
    known = written(sound.groupBy("k").agg(F.min("id").alias("rep"), F.first(F.size("v")).alias("d")), "caps")  # the classes
    sizes = known.groupBy("d").count().where("count > 1").orderBy("d").collect()  # one row a size
    found = None
    for d, count in sizes:
        n = parts_for(df, 12 * count * (20 + d // 2))  # about a dozen sketches a vector
        own = _verified(_candidates(sound.where(F.size("v") == d).select("k", "v"), Caps.of(count, d, cosine, recall, load), cosine, n), known, sound.where(F.size("v") == d), d, cosine, n)
        found = own if found is None else found.union(own)
    none = known.select(F.col("rep").alias("x"), F.col("rep").alias("y"), F.lit(0).cast("long").alias("links")).where("false")
    found = written(none if found is None else found, "caps-links")
    counts = found.where("links > 0").groupBy(F.col("x").alias("rep")).agg(F.sum("links").alias("links"))
    of = sound.select("id", "k").distinct().join(known.select("k", "rep"), "k")
    same = of.where("id <> rep").select(F.col("id").alias("x"), F.col("rep").alias("y"))
    groups = connected_components(found.where("x <> y").select("x", "y").union(same), "x", "y")
    per = of.join(counts, "rep", "left").groupBy("id").agg(F.min("rep").alias("rep"), F.coalesce(F.sum("links"), F.lit(0)).alias("links"))
    root = F.coalesce("root", "id")
    out = rows.select("id").distinct().join(per, "id", "left").join(groups, "id", "left").select("id", root.alias("group"), (root == F.col("id")).alias("keep"), F.coalesce("rep", "id").alias("class"), F.coalesce("links", F.lit(0)).alias("links"))
    return named(out, df, id_col, "id", "group", "class")


def _candidates(vectors: DataFrame, caps: Caps, cosine: float, n: int) -> DataFrame:
    """(id, root) of the classes that may be near another one: those that their sketches connect."""
    dim, wide = caps.dim, (caps.dim + 1) // 2
    record = np.dtype([("first", "<u4"), ("k", "<i8"), ("seconds", "<u2", (SLOTS,)), ("s", "u1", (wide,))])

    @tidy
    def send(batches):
        sent: set[int] = set()
        for x in batches:
            k = x.column("k").to_numpy()
            _, at = np.unique(k, return_index=True)
            at = np.sort(at)
            at = at[[v not in sent for v in k[at].tolist()]]
            if len(sent) < 1 << 20:  # copies of a vector go once a task, as far as this set reaches
                sent.update(k[at].tolist())
            v, good = unit(x.column("v").take(pa.array(at)), dim)
            at, v = at[good], v[good]
            for c in range(0, len(at), 512):
                u, own = v[c : c + 512], k[at[c : c + 512]]
                who, f = decode(u, caps)
                first, second = f // caps.words, f % caps.words
                order = np.lexsort((first, who))
                who, first, second = who[order], first[order], second[order]
                new = np.flatnonzero(np.append(True, (who[1:] != who[:-1]) | (first[1:] != first[:-1]))) if len(who) else np.zeros(0, np.int64)
                place = np.arange(len(who)) - np.repeat(new, np.diff(np.append(new, len(who))))
                head = np.flatnonzero(place % SLOTS == 0)
                out = np.zeros(len(head), record)
                out["first"], out["k"], out["s"] = first[head], own[who[head]], sketch(u @ _codes(caps)[0][0])[who[head]]
                out["seconds"] = 65535
                out["seconds"][np.searchsorted(head, np.arange(len(who)), "right") - 1, place % SLOTS] = second
                yield from packed_batches((K.mix(out["first"].astype(np.uint64)) % np.uint64(n)).astype(np.int64), out, n)

    @tidy
    def meet(batches):
        schema = pa.schema([("x", pa.int64()), ("y", pa.int64())])
        x = unpack(batches, record)
        if len(x):
            r, slot = np.nonzero(x["seconds"] != 65535)
            key = x["first"][r].astype(np.uint64) * np.uint64(65536) + x["seconds"][r, slot]
            order = np.lexsort((x["k"][r], key))
            r, key = r[order], key[order]
            k = x["k"][r]
            once = np.append(True, (key[1:] != key[:-1]) | (k[1:] != k[:-1]))  # a class that several tasks sent
            r, key, k = r[once], key[once], k[once]
            start = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            found, held = [np.zeros((0, 2), np.int64)], 0
            for s, e in zip(start, np.append(start[1:], len(r))):
                if e - s > 1:
                    edges = bucket_edges(unsketched(x["s"][r[s:e]]), k[s:e], cosine - MARGIN)
                    found.append(edges)
                    held += len(edges)
                    if held > 1 << 20:
                        found, held = [_forest(np.concatenate(found))], 0
            pairs = _forest(np.concatenate(found))
            if len(pairs):
                yield batch(schema, pairs[:, 0], pairs[:, 1])

    if caps.words >= 65535:
        raise ValueError("too many vectors for codes of two blocks")
    edges = by_part(vectors.mapInArrow(send, PACKED), n).mapInArrow(meet, "x long, y long").distinct()
    return checkpoint(connected_components(edges, "x", "y"))


def _verified(candidates: DataFrame, known: DataFrame, sound: DataFrame, dim: int, cosine: float, n: int) -> DataFrame:
    """(x, y, links) of the ids of classes: edges of the pairs that reach the cosine, and with x = y how many partners were found in a block."""
    members = group_sizes(known.join(candidates, known["k"] == candidates["id"]).select("k", "rep", "root"))
    vectors = sound.join(members.select("k", F.col("rep").alias("id"), "root", "blocks"), ["k", "id"]).groupBy("k", "id", "root", "blocks").agg(F.min("v").alias("v"))  # one row a class
    record = np.dtype([("key", "<u8"), ("side", "u1"), ("rep", "<i8"), ("v", "<f4", (dim,))])

    @tidy
    def send(batches):
        for x in batches:
            root, rep, k, blocks = (x.column(c).to_numpy() for c in ("root", "id", "k", "blocks"))
            v = x.column("v").cast(pa.list_(pa.float32())).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            for s in range(0, len(root), 1024):
                row, key, side = spread_blocks(root[s : s + 1024], k[s : s + 1024], blocks[s : s + 1024].astype(np.int64))
                out = np.zeros(len(row), record)
                out["key"], out["side"], out["rep"], out["v"] = key, side, rep[s + row], v[s + row]
                yield from packed_batches((key % np.uint64(n)).astype(np.int64), out, n)

    @tidy
    def compare(batches):
        schema = pa.schema([("x", pa.int64()), ("y", pa.int64()), ("links", pa.int64())])
        x = unpack(batches, record)
        x = x[np.argsort(x["key"], kind="stable")]
        start = np.flatnonzero(np.append(True, x["key"][1:] != x["key"][:-1])) if len(x) else []
        edges, held = [np.zeros((0, 2), np.int64)], 0
        for s, e in zip(start, np.append(start[1:], len(x))):
            own = x[s:e]
            v = own["v"].astype(np.float64)
            v /= np.linalg.norm(v, axis=1, keepdims=True)
            left, right = (np.arange(e - s),) * 2 if own["side"][0] == 2 else (np.flatnonzero(own["side"] == k) for k in (0, 1))
            count = np.zeros(e - s, np.int64)
            for c in range(0, len(left), _CHUNK):
                rows = left[c : c + _CHUNK]
                near = v[rows] @ v[right].T >= cosine
                if own["side"][0] == 2:
                    near[np.arange(len(rows)), rows] = False
                count[rows] += near.sum(axis=1)
                if own["side"][0] != 2:
                    count[right] += near.sum(axis=0)
                a, b = np.nonzero(near)
                if len(a):
                    edges.append(_forest(np.stack([own["rep"][rows[a]], own["rep"][right[b]]], axis=1)))
                    held += len(edges[-1])
                    if held > 1 << 20:
                        edges, held = [_forest(np.concatenate(edges))], 0
            at = np.flatnonzero(count)
            if len(at):
                yield batch(schema, own["rep"][at], own["rep"][at], count[at])
        pairs = _forest(np.concatenate(edges))
        if len(pairs):
            yield batch(schema, pairs[:, 0], pairs[:, 1], np.zeros(len(pairs), np.int64))

    return by_part(vectors.mapInArrow(send, PACKED), n).mapInArrow(compare, "x long, y long, links long")
