"""Mixing sources to target weights by min-cost flow.

Equal texts are one document, which belongs to every source that holds a copy. Documents are aggregated by membership pattern, the set of
their sources; a network routes the token capacity of patterns to the quotas of sources. A pattern's tokens may be used again, at a cost that grows
with each repetition, so capacity comes in layers. All other edges are free, so the cheapest augmenting path is one through the lowest layer
that has any, and min-cost flow is a maximum flow layer by layer, each from the residual network of the one before.

The network lives on the driver, where it has one node per pattern that occurs. Documents are then selected without it: within a pattern they are
ordered by a seeded hash, and take the tokens of the flow from the first on, layer after layer, each source its stretch.
"""

from __future__ import annotations

import math
from collections import deque

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from .common import col, written

ALPHA, EPOCHS, SEED, BUCKET, SALTS = 0.7, 4, 7, 1 << 15, 64
_INF = 1 << 62


class Network:
    """Maximum flow by Dinic's algorithm on whole numbers; edges are added and capacities raised between runs."""

    def __init__(self, n: int):
        self.edges: list[list[int]] = [[] for _ in range(n)]
        self.to: list[int] = []
        self.left: list[int] = []

    def add(self, a: int, b: int, capacity: int) -> int:
        self.edges[a].append(len(self.to))
        self.to.append(b)
        self.left.append(capacity)
        self.edges[b].append(len(self.to))
        self.to.append(a)
        self.left.append(0)
        return len(self.to) - 2

    def run(self, source: int, sink: int) -> int:
        total = 0
        while True:
            level = [-1] * len(self.edges)
            level[source] = 0
            queue = deque([source])
            while queue:
                a = queue.popleft()
                for e in self.edges[a]:
                    if self.left[e] and level[self.to[e]] < 0:
                        level[self.to[e]] = level[a] + 1
                        queue.append(self.to[e])
            if level[sink] < 0:
                return total
            at, path, a = [0] * len(self.edges), [], source
            while True:
                if a == sink:
                    pushed = min(self.left[e] for e in path)
                    for e in path:
                        self.left[e] -= pushed
                        self.left[e ^ 1] += pushed
                    total += pushed
                    path, a = [], source
                while at[a] < len(self.edges[a]):
                    e = self.edges[a][at[a]]
                    if self.left[e] and level[self.to[e]] == level[a] + 1:
                        break
                    at[a] += 1
                if at[a] < len(self.edges[a]):
                    path.append(self.edges[a][at[a]])
                    a = self.to[path[-1]]
                elif path:
                    a = self.to[path.pop() ^ 1]
                    at[a] += 1
                else:
                    break


def route(capacity: dict[tuple[str, ...], int], quota: dict[str, int], epochs: int = EPOCHS) -> tuple[dict[tuple[str, ...], dict[str, int]], int]:
    """(tokens by pattern and source, the cost): a cheapest flow among the greatest; the k-th repetition of a token costs k(k+1)/2 in all."""
    patterns, sources = sorted(capacity), sorted(quota)
    net = Network(2 + len(patterns) + len(sources))
    place = {s: 2 + len(patterns) + k for k, s in enumerate(sources)}
    supply = [net.add(0, 2 + k, 0) for k in range(len(patterns))]
    use = [{s: net.add(2 + k, place[s], _INF) for s in p if s in place} for k, p in enumerate(patterns)]
    for s in sources:
        net.add(place[s], 1, quota[s])
    cost = 0
    for layer in range(epochs):
        for k, p in enumerate(patterns):
            net.left[supply[k]] += capacity[p]
        cost += layer * net.run(0, 1)
    return {p: {s: net.left[e ^ 1] for s, e in use[k].items() if net.left[e ^ 1]} for k, p in enumerate(patterns)}, cost


def quotas(capacity: dict[tuple[str, ...], int], weights: dict[str, float] | None, budget: int | None, alpha: float = ALPHA) -> dict[str, int]:
    """Tokens by source that add up to the budget, by largest remainders; without weights these are tokens^alpha, without a budget it is all tokens."""
    held: dict[str, int] = {}
    for p, n in capacity.items():
        for s in p:
            held[s] = held.get(s, 0) + n
    wanted = {s: w for s, w in (weights or {s: n**alpha for s, n in held.items()}).items() if w > 0}
    total, budget = sum(wanted.values()), sum(capacity.values()) if budget is None else budget
    exact = {s: budget * w / total for s, w in wanted.items()}
    out = {s: int(x) for s, x in exact.items()}
    for s in sorted(exact, key=lambda s: (out[s] - exact[s], s))[: budget - sum(out.values()) if out else 0]:
        out[s] += 1
    return out


def _served(df: DataFrame, weights: dict[str, float] | None, budget: int | None, id_col: str, text_col: str, source_col: str, alpha: float, epochs: int, seed: int) -> DataFrame:
    """(id, h1, rest, equals, source, copies, n_tokens) of the selected texts. h1 tells the texts of an id apart, rest is the hash of the other columns of
    the row that stands for the text, which has so many equals, itself among them."""
    spark = df.sparkSession
    text = col(df, text_col).cast("string")
    slim = df.select(
        col(df, id_col).alias("id"), F.coalesce(col(df, source_col).cast("string"), F.lit("")).alias("source"), F.regexp_count(text, F.lit(r"\S+")).cast("long").alias("n"), F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(seed), text).alias("h2"), _rest(df, id_col, text_col).alias("rest")
    ).where("id is not null and n > 0")
    # Equal rows first, spread by their id, then the copies of a text, of which each task sends one row on.
    rows = slim.groupBy("h1", "h2", "id", "rest", "source").agg(F.max("n").alias("n"), F.count("*").alias("equals"))
    docs = rows.groupBy("h1", "h2").agg(F.min(F.struct("id", "rest", "equals")).alias("m"), F.max("n").alias("n"), F.array_sort(F.collect_set("source")).alias("pattern"))
    docs = written(docs.select("h1", "h2", "m.*", "n", "pattern", F.xxhash64(F.lit(seed), "h2", "h1").alias("u")), "mix")
    counted = docs.groupBy("pattern").agg(F.sum("n").alias("n"), F.count("*").alias("docs")).collect()  # patterns that occur, not documents
    capacity = {tuple(r.pattern): r.n for r in counted}
    if not capacity:
        return docs.where("false").select("id", "h1", "rest", "equals", F.lit("").alias("source"), F.lit(0).alias("copies"), F.col("n").alias("n_tokens"))
    flow, _ = route(capacity, quotas(capacity, weights, budget, alpha), epochs)
    rows = []
    for p, own in flow.items():
        end, stretches = 0, []
        for s, n in sorted(own.items()):
            end += n
            stretches.append((end, s))
        if end:
            rows.append((list(p), capacity[p], end, stretches))
    routed = spark.createDataFrame(rows, "pattern array<string>, total long, taken long, stretches array<struct<end:long,source:string>>")
    if len(rows) <= 100_000:
        routed = F.broadcast(routed)
    # Where a document lies in its pattern: the tokens of the buckets of the hash before its own, and of those before it in the bucket. Buckets are for
    # the work alone: their number follows the documents, and the order is that of the whole hash whatever it is.
    bits = max(4, math.ceil(math.log2(max(r.docs for r in counted) / BUCKET)))
    placed = docs.withColumn("bucket", F.shiftrightunsigned("u", 64 - bits))
    before = Window.partitionBy("pattern").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("pattern", "bucket").orderBy("u", "id", "h1").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("pattern", "bucket").agg(F.sum("n").alias("m")).withColumn("base", F.coalesce(F.sum("m").over(before), F.lit(0))).drop("m")
    at = placed.withColumn("own", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(totals, ["pattern", "bucket"]).withColumn("at", F.col("base") + F.col("own"))
    turns = at.join(routed, "pattern").where("at < taken").withColumn("turn", F.explode(F.expr("sequence(0L, (taken - at - 1) div total)")))
    served = turns.withColumn("source", F.expr("filter(stretches, s -> s.end > at + turn * total)[0].source"))
    return served.groupBy("id", "h1", "rest", "equals", "source", F.col("n").alias("n_tokens")).agg(F.count("*").cast("int").alias("copies")).select("id", "h1", "rest", "equals", "source", "copies", "n_tokens")


def _rest(df: DataFrame, id_col: str, text_col: str):
    """The hash of all other columns of a row, by place; maps, which have no hash, count as their JSON."""
    others = [(k, f) for k, f in enumerate(df.schema.fields) if f.name not in (id_col, text_col)]
    plain = [F.to_json(df[f"`{f.name}`"]) if isinstance(f.dataType, MapType) else df[f"`{f.name}`"] for _, f in others]
    return F.xxhash64(F.lit(len(plain)), *plain)


def mix(df: DataFrame, weights: dict[str, float] | None = None, budget: int | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", alpha: float = ALPHA, epochs: int = EPOCHS, seed: int = SEED) -> DataFrame:
    """(id, source, copies, n_tokens): how often each selected document serves which source.

    A document is a distinct text, named by its least id, of whatever type; its tokens are its runs of characters other than white space. A token
    serves at most ``epochs`` times. A document is taken whole where its first token is: a stretch of a source may overrun by less than a document. Where
    quotas can't be met the flow is as great as it can be. Null, empty and blank texts have no tokens and are never selected; a null source counts as ''; rows
    without an id are left out; of rows that share an id each text counts. Weights of sources that hold nothing are met by nothing. An
    empty table gives no rows; other columns are ignored.
    """
    slim = df.select(col(df, id_col).alias("id"), col(df, text_col).alias("text"), col(df, source_col).alias("source"))
    found = _served(slim, weights, budget, "id", "text", "source", alpha, epochs, seed)
    return found.groupBy("id", "source").agg(F.sum("copies").cast("int").alias("copies"), F.sum("n_tokens").alias("n_tokens"))


def mixed_rows(df: DataFrame, weights: dict[str, float] | None = None, budget: int | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", alpha: float = ALPHA, epochs: int = EPOCHS, seed: int = SEED) -> DataFrame:
    """The rows of ``df`` that the mix selects, each as often as it is to be used and under the source it serves, in the columns of ``df``.

    Of the rows that hold a text, one stands for it: that with the least id, and of those that share this and differ elsewhere, the one whose other columns have the
    least hash. Which row that is doesn't change between runs. Columns may have any name; nulls in others than id and text don't matter. Null, empty and blank
    texts and rows without an id are never selected; an empty table gives no rows.
    """
    place = {c: f"c{k}" for k, c in enumerate(df.columns)}
    plain = df.toDF(*place.values())
    id_c, text_c, source_c = place[id_col], place[text_col], place[source_col]
    plan = _served(plain, weights, budget, id_c, text_c, source_c, alpha, epochs, seed).groupBy("id", "h1", "rest", "equals").agg(F.collect_list(F.struct("source", "copies")).alias("uses"))
    plan = written(plan, "mixed")
    keyed = plain.withColumns({"id": F.col(id_c), "h1": F.xxhash64(F.col(text_c).cast("string")), "rest": _rest(plain, id_c, text_c)})
    key, columns = ["id", "h1", "rest"], list(place.values())
    # The plan is hashed; the texts are shuffled once and not sorted.
    chosen = keyed.join(plan.where("equals = 1").drop("equals").hint("shuffle_hash"), key).select(*columns, "uses")
    if not plan.where("equals > 1").isEmpty():
        # Rows that are equal in all columns, perhaps a great many: each salt finds one of them, then one of these stays.
        many = plan.where("equals > 1").drop("equals").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salted = keyed.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
        found = salted.join(many.hint("shuffle_hash"), [*key, "salt"]).dropDuplicates([*key, "salt"]).dropDuplicates(key)
        chosen = chosen.union(found.select(*columns, "uses"))
    each = chosen.withColumn("use", F.explode(F.flatten(F.transform("uses", lambda u: F.array_repeat(u["source"], u["copies"])))))
    kind = df.schema[source_col].dataType
    return each.select(*[F.col("use").cast(kind) if c == source_c else F.col(c) for c in columns]).toDF(*df.columns)
