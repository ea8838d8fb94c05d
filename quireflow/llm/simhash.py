"""SimHash near-duplicate groups with a covering family of bit masks.

Each document has a 64-bit SimHash of its folded words, weighted by count to the power 0.7, and one of 128 bits of its runs of three
words. Search runs on the first with covering masks: a random map sends every bit position to a vector of
F_2^(r+1); the mask of a non-zero vector v drops the positions whose vector is orthogonal to v. The vectors of r
positions span at most r dimensions, so some v is orthogonal to them all: two codes that differ in at most r
positions agree under one of the 2^(r+1)-1 masks, and every pair within the radius meets in some table. There
are no false negatives. Pairs that meet are compared exactly on both codes: long texts of one language have like
words in like numbers, but only copies have the same runs.

Shuffle. The masks of v + D, for a subspace D of dimension 3, share the positions that are orthogonal to D but not to v, so a
code is sent once per group of eight masks, keyed by the shared bits, instead of once per mask. A quarter of the positions is made
orthogonal to D, lest the keys be few. Codes travel as packed 26-byte records, once per distinct code.

A bucket yields the edges of a spanning forest of its "within the radius" graph, never all pairs: members that
are already connected aren't compared again, so a group of m copies costs O(m) edges, with no cap.

Links are counted once groups are known: every link lies within a group. The distinct codes of a group are compared in blocks of
``BLOCK`` codes, each pair of blocks a record key of its own, so a large group spreads over all tasks and no pair leaves its task.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .common import PACKED, batch, by_part, checkpoint, col, id_text, key_of, named, packed_batches, partitions, parts_for, tidy, unpack
from .components import connected_components

RADIUS, RUN_RADIUS, RUN, POWER = 9, 36, 3, 0.7
#: Masks that share a record: 2^SHARED. Their groups fit the field up to a radius of MOST.
SHARED, MOST = 3, 17
BLOCK = 4096
CODE = np.dtype([("a", "<u8"), ("b", "<u8"), ("c", "<u8"), ("group", "<u2")])
_MEMBER = np.dtype([("key", "<u8"), ("side", "u1"), ("a", "<u8"), ("b", "<u8"), ("c", "<u8"), ("rep", "<i8")])
_BLOCK = 1 << 13
_COPIES = K.seeded(71, 3)


def fingerprints(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(n x 3 words of 64 bits: the code of the words, then that of their runs; whether the row has any word)."""
    out, some = [np.zeros((0, 3), np.uint64)], [np.zeros(0, bool)]
    for i, j, h, first, *_ in K.word_hashes(column, fold=True):
        n, row, count = j - i, K.rows_of(first), np.diff(first)
        left = first[1:][row] - np.arange(len(h))  # words from here to the end of the text
        short = (count < RUN)[row]  # too short for a run: its words stand for it
        runs = np.where(short, h, K.grams(h, RUN)) if len(h) else h
        use = short | (left >= RUN)
        out.append(np.concatenate([_code(h, row, n, _COPIES[:1]), _code(runs[use], row[use], n, _COPIES[1:])], axis=1))
        some.append(count > 0)
    return np.concatenate(out), np.concatenate(some)


#: For each byte, its bits from the highest on in a lane of eight bits each: sums of up to 255 bytes stay apart.
_LANES = np.array([sum((v >> (7 - k) & 1) << (8 * k) for k in range(8)) for v in range(256)], np.uint64)


def _code(h: np.ndarray, row: np.ndarray, n: int, copies: np.ndarray) -> np.ndarray:
    """The SimHash of each row's features, 64 bits for each copy."""
    width = K.ROW_BITS  # a constant: the code of a text must not depend on its neighbours in the batch
    key = (row.astype(np.uint64) << np.uint64(64 - width)) | (h >> np.uint64(width))
    key.sort()
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    at = np.flatnonzero(new)
    times = np.diff(np.append(at, len(key)))
    key = key[at]
    weight = np.rint(16 * times**POWER).astype(np.int64)  # whole numbers: sums don't depend on their order
    row = (key >> np.uint64(64 - width)).astype(np.int64)
    word = key << np.uint64(width)
    total = np.bincount(row, weight, n).astype(np.int64)
    ones = np.zeros((n, 64 * len(copies)), np.int64)
    for own in (np.flatnonzero(times == 1), np.flatnonzero(times > 1)):  # most words of a text occur once: their bits are counted in lanes, then weighted
        for s in range(0, len(own), _BLOCK):
            at = own[s : s + _BLOCK]
            r = row[at]
            code = np.stack([K.mix(word[at] ^ c) for c in copies], axis=1).view(np.uint8)
            starts = np.flatnonzero(np.diff(r, prepend=-1))
            if times[at[0]] == 1:
                place = np.arange(len(at)) - np.repeat(starts, np.diff(np.append(starts, len(at))))
                cut = np.flatnonzero(place % 255 == 0)
                lanes = np.add.reduceat(_LANES[code], cut, axis=0).view(np.uint8).astype(np.int64)
                ones[r[starts]] += 16 * np.add.reduceat(lanes, np.searchsorted(cut, starts), axis=0)
            else:
                ones[r[starts]] += np.add.reduceat(np.unpackbits(code, axis=1) * weight[at].astype(np.int32)[:, None], starts, axis=0)
    return np.packbits(2 * ones > total[:, None], axis=1).view(np.uint64)


@lru_cache(maxsize=8)
def mask_pairs(radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(the masks of each group: n x 2^SHARED, the positions that all of them keep)."""
    if not 0 <= radius <= MOST:
        raise ValueError(f"the radius must be from 0 to {MOST}")
    k = radius + 1
    d = min(SHARED, k - 1)  # D is spanned by the lowest d unit vectors
    seed = K.seeded(5, 64)
    phi = 1 + (seed % np.uint64((1 << k) - 1)).astype(np.int64)
    phi[::4] = (1 + (seed[::4] % np.uint64((1 << (k - d)) - 1)).astype(np.int64)) << d
    mask = np.array([sum(1 << p for p in range(64) if int(phi[p] & v).bit_count() & 1) for v in range(1 << k)], dtype=np.uint64)
    whole = np.arange(1 << d, 1 << k).reshape(-1, 1 << d)
    rest = [np.resize(np.arange(1 << j, 2 << j), 1 << d) for j in range(d)]  # D itself without zero, some masks of it twice
    masks = mask[np.concatenate([whole, *(r[None] for r in rest)])]
    return masks, np.bitwise_and.reduce(masks, axis=1)


def near(x: np.ndarray, y: np.ndarray, radius: int, runs: int) -> np.ndarray:
    """Which codes are within both radii; one side may be a single code."""
    return (np.bitwise_count(x["a"] ^ y["a"]) <= radius) & (np.bitwise_count(x["b"] ^ y["b"]) + np.bitwise_count(x["c"] ^ y["c"]) <= runs)


def near_edges(code: np.ndarray, radius: int, runs: int) -> list[tuple[int, int]]:
    """A spanning forest of the graph on codes whose edges join pairs within the radii. No cap: a component
    grows from a frontier, which is compared with what isn't yet connected only."""
    a, b, c = (np.ascontiguousarray(code[k]) for k in "abc")
    rest, out = np.arange(len(code)), []
    while len(rest) > 1:
        frontier, rest = [rest[0]], rest[1:]
        while frontier and len(rest):
            x = frontier.pop()
            at = np.flatnonzero(np.bitwise_count(a[rest] ^ a[x]) <= radius)
            at = at[np.bitwise_count(b[rest[at]] ^ b[x]) + np.bitwise_count(c[rest[at]] ^ c[x]) <= runs]
            if len(at):
                found = rest[at]
                out += [(x, y) for y in found]
                frontier += list(found)
                rest = np.delete(rest, at)
    return out


def bucket_edges(code: np.ndarray, radius: int, runs: int) -> np.ndarray:
    """Edges (pairs of codes) of all buckets of the masks of each group among these codes."""
    masks, _ = mask_pairs(radius)
    found = [np.zeros((0, 2), np.int64)]
    a, group = np.ascontiguousarray(code["a"]), code["group"].astype(np.int64)
    salt = group.astype(np.uint64) * K.GOLD
    for m in range(masks.shape[1]):
        key = K.mix((a & masks[group, m]) ^ salt)
        order = np.argsort(key)
        key = key[order]
        start = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        size = np.diff(np.append(start, len(key)))
        wide = size > 64
        for k in range(1, int(size[~wide].max(initial=1))):  # small buckets, all at once: each member with its k-th next
            n = size[~wide & (size > k)] - k
            own = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start[~wide & (size > k)], n)
            x, y = order[own], order[own + k]
            close = np.bitwise_count(a[x] ^ a[y]) <= radius
            x, y = x[close], y[close]
            close = near(code[x], code[y], radius, runs)
            found.append(np.stack([x[close], y[close]], axis=1))
        for s, n in zip(start[wide], size[wide]):
            own = order[s : s + n]
            pairs = near_edges(code[own], radius, runs)
            if pairs:
                found.append(own[np.array(pairs)])
    return np.concatenate(found)


def _forest(pairs: np.ndarray) -> np.ndarray:
    """Star edges (node, least node) of the components of integer pairs, so that a partition sends on n - 1 edges for n nodes."""
    if not len(pairs):
        return pairs
    node, inv = np.unique(pairs, return_inverse=True)
    x, y = inv.reshape(-1, 2).T
    label = np.arange(len(node))
    while True:
        low = label.copy()
        np.minimum.at(low, x, label[y])
        np.minimum.at(low, y, label[x])
        low = low[low]
        if (low == label).all():
            break
        label = low
    own = label != np.arange(len(node))
    return np.stack([node[own], node[label[own]]], axis=1)


def pair_counts(run: np.ndarray, side: np.ndarray, close) -> np.ndarray:
    """How many partners each of n members has. ``run``: its run, in order; within a run members of side 0 pair with each other if there is no side 1,
    else with those of side 1. ``close(x, y)`` tells which of two arrays of places are near; a single place may stand for one of them."""
    n, count = len(run), np.zeros(len(run), np.int64)
    start = np.flatnonzero(np.append(True, run[1:] != run[:-1])) if n else np.zeros(0, np.int64)
    size = np.diff(np.append(start, n))
    wide = size > 64
    for k in range(1, int(size[~wide].max(initial=1))):  # small runs, all at once: each member with its k-th next
        own = size[~wide & (size > k)] - k
        x = np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own) + np.repeat(start[~wide & (size > k)], own)
        use = x[(side[x] == side[x + k]) == (side[x] == 2)]
        use = use[close(use, use + k)]
        count += np.bincount(use, minlength=n) + np.bincount(use + k, minlength=n)
    for s, m in zip(start[wide], size[wide]):
        own = np.arange(s, s + m)
        if side[s] == 2:
            for k in range(m - 1):
                near_ones = own[k + 1 :][close(own[k], own[k + 1 :])]
                count[own[k]] += len(near_ones)
                count[near_ones] += 1
        else:
            left, right = own[side[own] == 0], own[side[own] == 1]
            for x in left:
                near_ones = right[close(x, right)]
                count[x] += len(near_ones)
                count[near_ones] += 1
    return count


def spread_blocks(root: np.ndarray, member: np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, key, side) of the records of members whose group has so many blocks: one for each block that the member's own is compared with; side 2 is the
    block with itself, else 0 is the lesser block and 1 the greater."""
    row = np.repeat(np.arange(len(root)), blocks)
    other = np.arange(len(row)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    own = (K.mix(member.astype(np.uint64) ^ np.uint64(77)) % np.maximum(blocks, 1).astype(np.uint64)).astype(np.int64)[row]
    low, high = np.minimum(own, other).astype(np.uint64), np.maximum(own, other).astype(np.uint64)
    key = K.mix(root[row].astype(np.uint64) ^ K.mix(low * K.GOLD + high + np.uint64(1)))
    return row, key, np.where(own == other, 2, (own > other).astype(np.int64))


def group_sizes(members: DataFrame, block: int = BLOCK) -> DataFrame:
    """Adds to members (root, ...) the number of blocks of their group, for groups of two or more."""
    sizes = members.groupBy("root").agg(F.count("*").alias("m")).where("m > 1").select("root", F.ceil(F.col("m") / block).cast("int").alias("blocks"))
    return members.join(sizes, "root")


def _codes(docs: DataFrame) -> DataFrame:
    """(id, a, b, c, some) of the texts of ``docs``, kept in the shared folder."""

    @tidy
    def code(batches):
        schema = pa.schema([("id", pa.int64()), *((k, pa.int64()) for k in "abc"), ("some", pa.bool_())])
        for x in batches:
            f, some = fingerprints(x.column("text"))
            yield batch(schema, x.column("id"), *(np.ascontiguousarray(f[:, k]).view(np.int64) for k in range(3)), some)

    return checkpoint(docs.mapInArrow(code, "id long, a long, b long, c long, some boolean"))


def _components(codes: DataFrame, radius: int, run_radius: int) -> tuple[DataFrame, DataFrame]:
    """((a, b, c, rep) of the distinct codes, rep being the least id; (id, root) of all ids that are linked with another)."""
    _, shared = mask_pairs(radius)
    n = parts_for(codes, codes.count() * len(shared) * CODE.itemsize)
    # A code grows into many records: spread over all partitions, lest a coalesced few do the work.
    known = codes.where("some").repartition(n, "a", "b", "c").groupBy("a", "b", "c").agg(F.min("id").alias("rep"))

    @tidy
    def send(batches):
        masks, shared = mask_pairs(radius)
        for x in batches:
            a, b, c = (x.column(k).to_numpy().view(np.uint64) for k in "abc")
            for s in range(0, len(a), 4096):
                own = a[s : s + 4096]
                group = np.repeat(np.arange(len(shared), dtype=np.uint64), len(own))
                record = np.zeros(len(group), CODE)
                record["a"], record["b"], record["c"], record["group"] = np.tile(own, len(shared)), np.tile(b[s : s + 4096], len(shared)), np.tile(c[s : s + 4096], len(shared)), group
                part = (K.mix((record["a"] & shared[group.astype(np.int64)]) ^ K.mix(group + K.GOLD)) % np.uint64(n)).astype(np.int64)
                yield from packed_batches(part, record, n)

    @tidy
    def meet(batches):
        schema = pa.schema([(k, pa.int64()) for k in ("a", "b", "c", "a2", "b2", "c2")])
        code = unpack(batches, CODE)
        if len(code):
            order = np.lexsort((code["c"], code["b"], code["a"]))  # a code that came under several masks is one node
            x = code[order]
            new = np.append(True, (x["a"][1:] != x["a"][:-1]) | (x["b"][1:] != x["b"][:-1]) | (x["c"][1:] != x["c"][:-1]))
            node = np.empty(len(code), np.int64)
            node[order] = order[np.flatnonzero(new)][np.cumsum(new) - 1]
            pairs = _forest(node[bucket_edges(code, radius, run_radius)])
            if len(pairs):
                x, y = code[pairs[:, 0]], code[pairs[:, 1]]
                yield batch(schema, *(v.astype(np.uint64).view(np.int64) for v in (x["a"], x["b"], x["c"], y["a"], y["b"], y["c"])))

    pairs = by_part(known.select("a", "b", "c").mapInArrow(send, PACKED), n).mapInArrow(meet, "a long, b long, c long, a2 long, b2 long, c2 long").distinct()
    left = known.withColumnRenamed("rep", "x")
    right = known.select(F.col("a").alias("a2"), F.col("b").alias("b2"), F.col("c").alias("c2"), F.col("rep").alias("y"))
    links = pairs.join(left, ["a", "b", "c"]).join(right, ["a2", "b2", "c2"]).select("x", "y")
    # The least id stands for a code; ids that hold several texts link their codes.
    same = codes.where("some").join(known, ["a", "b", "c"]).where("id <> rep").select(F.col("id").alias("x"), F.col("rep").alias("y"))
    return known, checkpoint(connected_components(links.union(same), "x", "y"))


def _link_counts(known: DataFrame, groups: DataFrame, radius: int, run_radius: int) -> DataFrame:
    """(a, b, c, links): how many other codes lie within the radii of each that has any, of groups (id, root)."""
    n = partitions(known)
    members = group_sizes(known.join(groups, known["rep"] == groups["id"]).select("root", "a", "b", "c"))

    @tidy
    def send(batches):
        for x in batches:
            root, blocks = x.column("root").to_numpy(), x.column("blocks").to_numpy().astype(np.int64)
            a, b, c = (x.column(k).to_numpy().view(np.uint64) for k in "abc")
            for s in range(0, len(root), 1024):
                row, key, side = spread_blocks(root[s : s + 1024], (a ^ K.mix(b ^ K.mix(c.copy())))[s : s + 1024], blocks[s : s + 1024])
                record = np.zeros(len(row), _MEMBER)
                record["key"], record["side"] = key, side
                record["a"], record["b"], record["c"] = a[s + row], b[s + row], c[s + row]
                yield from packed_batches((key % np.uint64(n)).astype(np.int64), record, n)

    @tidy
    def count(batches):
        schema = pa.schema([*((k, pa.int64()) for k in "abc"), ("links", pa.int64())])
        x = unpack(batches, _MEMBER)
        x = x[np.argsort(x["key"], kind="stable")]
        a, b, c = (np.ascontiguousarray(x[k]) for k in "abc")

        def close(p, q):
            return (np.bitwise_count(a[p] ^ a[q]) <= radius) & (np.bitwise_count(b[p] ^ b[q]) + np.bitwise_count(c[p] ^ c[q]) <= run_radius)

        found = pair_counts(np.ascontiguousarray(x["key"]), x["side"], close)
        at = np.flatnonzero(found)
        if len(at):
            yield batch(schema, a[at].view(np.int64), b[at].view(np.int64), c[at].view(np.int64), found[at])

    counted = by_part(members.select("root", "blocks", "a", "b", "c").mapInArrow(send, PACKED), n).mapInArrow(count, "a long, b long, c long, links long")
    return counted.groupBy("a", "b", "c").agg(F.sum("links").alias("links"))


def group_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, run_radius: int = RUN_RADIUS) -> DataFrame:
    """(id, group, keep, class, links): one row for every document.

    ``class`` is the least id whose text has the same code: copies are one class. ``links`` is how many other classes are near duplicates
    of it, all counted. ``group`` is the least id of the documents that are connected by such links, whose document alone has keep.

    Two documents are near duplicates if the codes of their words differ in at most ``radius`` of 64 bits (17 at most) and those of their runs in
    at most ``run_radius`` of 128; groups are the connected components of that relation, found without loss.
    Null and empty texts, and texts without a word, are duplicates of nothing and form groups and classes of their own, with no links.
    Texts with the same words have the same code. Rows that share an id count as one document; of several texts
    under an id all count: they are in one group, its class is the least and its links are the sum. Rows with a null id are left out. Ids may be of any type; of
    others than whole numbers the least is that of the least 64-bit hash. An empty table gives no rows. Whole texts count, whatever their
    length, and other columns are ignored.
    """
    codes = _codes(id_text(df, id_col, text_col))
    known, groups = _components(codes, radius, run_radius)
    counts = _link_counts(known, groups, radius, run_radius)
    classes = known.join(counts, ["a", "b", "c"], "left")
    per = codes.distinct().join(classes, ["a", "b", "c"], "left")  # a code without a word is in no class
    docs = per.groupBy("id").agg(F.min(F.when(F.col("some"), F.col("rep"))).alias("rep"), F.coalesce(F.sum(F.when(F.col("some"), F.col("links"))), F.lit(0)).alias("links"))
    root = F.coalesce("root", "id")
    out = docs.join(groups, "id", "left").select("id", root.alias("group"), (root == F.col("id")).alias("keep"), F.coalesce("rep", "id").alias("class"), "links")
    return named(out, df, id_col, "id", "group", "class")


def drop_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, run_radius: int = RUN_RADIUS) -> DataFrame:
    """The rows of ``df`` but for those whose own text is a near duplicate of the one kept of its group: that with the least id.

    Of an id that holds several texts each is judged by itself. Rows that share id and text stay or go together. Rows with a null id, and null,
    empty and wordless texts, stay. Ids may be of any type, and columns of any name.
    """
    node = F.when(col(df, id_col).isNotNull(), F.xxhash64(col(df, id_col), col(df, text_col).cast("string")))
    rows = df.select(node.alias("id"), key_of(df, id_col).alias("own"), col(df, text_col).cast("string").alias("text")).where("id is not null")
    _, groups = _components(_codes(rows.select("id", "text")), radius, run_radius)
    members = rows.select("id", "own").distinct().join(groups, "id")
    kept = members.groupBy("root").agg(F.min(F.struct("own", "id")).alias("m"))
    dropped = members.join(kept, "root").where("id <> m.id").select(F.col("id").alias("_gone"))
    return df.join(dropped.hint("shuffle_hash"), node == dropped["_gone"], "left_anti")  # keys are hashed; texts are shuffled once and not sorted
