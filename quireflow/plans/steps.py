"""Sequence queries: entropies and run metrics, decoding of step scores, repeats, sizes and budgets."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import sequences as N
from ..functions import text as T
from .registry import query
from .texts import values

_V = "SELECT step_id, line_id, list_transform(logits, lambda x: CAST(x AS DOUBLE)) AS v FROM vectors"


@query("n01_entropy", f"WITH s AS (SELECT step_id, list_transform(v, lambda x: exp(x - list_max(v))) AS ex FROM ({_V})), p AS (SELECT step_id, list_transform(ex, lambda x: x / list_sum(ex)) AS p FROM s) SELECT step_id, round(-list_sum(list_transform(p, lambda x: x * ln(x))), 5) AS entropy FROM p")
def entropy(e) -> DataFrame:
    return e.vectors.select("step_id", F.round(N.entropy(F.transform("logits", lambda x: x.cast("double"))), 5).alias("entropy"))


@query(
    "n02_run_metrics",
    """WITH m AS (SELECT message_id, message_id % 9 AS tokens, CASE WHEN message_id % 11 <> 0 THEN value / 10 END AS arrival, value / 10 + 0.5 AS scheduled, CASE WHEN message_id % 13 <> 0 THEN value / 10 + message_id % 4 - 1.0 END AS first, value / 10 + message_id % 6 AS last FROM messages),
    d AS (SELECT *, CASE WHEN first IS NOT NULL THEN greatest(0.0, last - first) END AS dec FROM m)
    SELECT message_id, round(CASE WHEN tokens > 0 AND dec > 0 THEN dec / tokens * 1000 END, 4) AS itl_ms, round(CASE WHEN tokens > 0 AND dec > 0 THEN tokens / dec END, 4) AS generation_throughput,
    round(CASE WHEN arrival IS NOT NULL THEN greatest(0.0, last - arrival) END, 4) AS e2e_latency_s, round(CASE WHEN first IS NOT NULL THEN greatest(0.0, first - scheduled) END, 4) AS prefill_s, round(dec, 4) AS decode_s FROM d""",
)
def run_metrics(e) -> DataFrame:
    m, v = F.col("message_id"), F.col("value") / 10
    r = N.run_metrics(m % 9, F.when(m % 11 != 0, v), v + 0.5, F.when(m % 13 != 0, v + m % 4 - 1.0), v + m % 6)
    return e.messages.select("message_id", r.alias("r")).select("message_id", *[F.round(f"r.{c}", 4).alias(c) for c in ("itl_ms", "generation_throughput", "e2e_latency_s", "prefill_s", "decode_s")])


@query("n02_mean_sequence_entropy", f"WITH s AS (SELECT line_id, list_transform(v, lambda x: exp(x - list_max(v))) AS ex FROM ({_V})), p AS (SELECT line_id, list_transform(ex, lambda x: x / list_sum(ex)) AS p FROM s) SELECT line_id, round(avg(-list_sum(list_transform(p, lambda x: x * ln(x)))), 5) AS entropy FROM p GROUP BY line_id")
def mean_entropy(e) -> DataFrame:
    return e.vectors.groupBy("line_id").agg(F.round(F.avg(N.entropy(F.transform("logits", lambda x: x.cast("double")))), 5).alias("entropy"))


@query("n03_log_softmax", f"WITH s AS (SELECT step_id, v, list_max(v) AS m FROM ({_V})), z AS (SELECT step_id, v, m, ln(list_sum(list_transform(v, lambda x: exp(x - m)))) AS l FROM s) SELECT step_id, round(v[1] - m - l, 5) AS first_logp, round(-l, 5) AS best_logp FROM z")
def log_softmax(e) -> DataFrame:
    return e.vectors.select("step_id", N.log_softmax(F.transform("logits", lambda x: x.cast("double"))).alias("p")).select("step_id", F.round(F.col("p")[0], 5).alias("first_logp"), F.round(F.array_max("p"), 5).alias("best_logp"))


@query("n04_vocabulary_pruning", f"WITH t AS (SELECT line_id, unnest(v) AS x, generate_subscripts(v, 1) - 1 AS token FROM ({_V})) SELECT line_id, CAST(token AS INTEGER) AS token FROM t GROUP BY line_id, token HAVING max(x) > 0.35 OR token = 0")
def pruning(e) -> DataFrame:
    t = e.vectors.select("line_id", F.posexplode(F.transform("logits", lambda x: x.cast("double"))).alias("token", "x"))
    return t.groupBy("line_id", "token").agg(F.max("x").alias("m")).where("m > 0.35 or token = 0").select("line_id", "token")


_ARG = "list_position(logits, list_max(logits)) - 1"


@query("n05_n06_greedy_decode", f"""WITH a AS (SELECT line_id, step_id, {_ARG} AS best, CAST(list_max(logits) AS DOUBLE) AS s, lag({_ARG}) OVER (PARTITION BY line_id ORDER BY step_id) AS before FROM vectors)
    SELECT line_id, count(*) FILTER (best <> 0 AND before IS DISTINCT FROM best) AS emitted, string_agg(CAST(best AS VARCHAR), ' ' ORDER BY step_id) FILTER (best <> 0 AND before IS DISTINCT FROM best) AS path, round(avg(s) FILTER (best <> 0 AND before IS DISTINCT FROM best), 5) AS confidence FROM a GROUP BY line_id""")
def greedy(e) -> DataFrame:
    steps = e.vectors.select("line_id", F.struct("step_id", N.argmax(F.col("logits")).alias("b"), F.array_max("logits").cast("double").alias("s")).alias("t"))
    g = steps.groupBy("line_id").agg(F.array_sort(F.collect_list("t")).alias("ts")).select("line_id", F.col("ts.b").alias("b"), F.col("ts.s").alias("s"))
    path = N.greedy_path(F.col("b"))
    return g.select("line_id", F.size(path).cast("long").alias("emitted"), F.array_join(path, " ").alias("path"), F.round(N.greedy_confidence(F.col("b"), F.col("s")), 5).alias("confidence"))


@query("f19_greedy_gate", f"""WITH z AS (SELECT step_id // 4 AS line, step_id, list_transform(v, lambda x: x * 40) AS v FROM ({_V})), s AS (SELECT line, step_id, list_position(v, list_max(v)) - 1 AS best, -ln(list_sum(list_transform(v, lambda x: exp(x - list_max(v))))) AS s FROM z),
    a AS (SELECT *, lag(best) OVER (PARTITION BY line ORDER BY step_id) AS before FROM s), g AS (SELECT line, avg(s) FILTER (best <> 0 AND before IS DISTINCT FROM best) AS c, string_agg(CAST(best AS VARCHAR), ' ' ORDER BY step_id) FILTER (best <> 0 AND before IS DISTINCT FROM best) AS path FROM a GROUP BY line)
    SELECT line, CASE WHEN c >= -0.5 THEN 'greedy' ELSE 'beam' END AS how, CASE WHEN c >= -0.5 THEN path END AS path FROM g""")
def gate(e) -> DataFrame:
    """Lines of four steps each: which are sure enough to be read greedily, and what they read."""
    p = N.log_softmax(F.transform("logits", lambda x: x.cast("double") * 40))
    steps = e.vectors.select(F.expr("step_id div 4").alias("line"), "step_id", p.alias("p")).select("line", F.struct("step_id", N.argmax(F.col("p")).alias("b"), F.array_max("p").alias("s")).alias("t"))
    g = steps.groupBy("line").agg(F.array_sort(F.collect_list("t")).alias("ts")).select("line", F.col("ts.b").alias("b"), F.col("ts.s").alias("s"))
    sure = N.greedy_confidence(F.col("b"), F.col("s")) >= -0.5
    return g.select("line", F.when(sure, "greedy").otherwise("beam").alias("how"), F.when(sure, F.array_join(N.greedy_path(F.col("b")), " ")).alias("path"))


@query("n07_f19_beam_or_greedy")
def beam(e) -> DataFrame:
    """Greedy where its mean score is high enough, else a beam search, one task a line; all steps of the line and all symbols count."""

    def decode(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        path, how = N.hybrid_decode(np.stack(pdf.sort_values("step_id").logits.to_numpy()).astype(float))
        return pd.DataFrame({"line_id": pd.array([key[0]], "Int32"), "how": [how], "n": [len(path)]})

    return e.vectors.groupBy("line_id").applyInPandas(decode, "line_id int, how string, n int")


@query(
    "n08_n09_n10_line_segments",
    """WITH m AS (SELECT line_id, CAST(list_max(logits) AS DOUBLE) AS s, row_number() OVER (PARTITION BY line_id ORDER BY step_id) - 1 AS t FROM vectors), c AS (SELECT line_id, count(*) AS frames, sum(s) AS score FROM m GROUP BY line_id),
    p AS (SELECT line_id, frames, score, k, 1 + (k * 5 + line_id) % 9 AS len FROM c, range(1, 12) r(k) WHERE k <= 2 + line_id % 9), f AS (SELECT *, greatest(1, frames * len // sum(len) OVER (PARTITION BY line_id)) AS own FROM p),
    sp AS (SELECT *, sum(own) OVER (PARTITION BY line_id ORDER BY k) AS stop FROM f)
    SELECT sp.line_id, CAST(k - 1 AS INTEGER) AS segment, CAST(trunc((stop - own) * (640.0 / frames)) AS BIGINT) AS start_pixel, CAST(trunc(stop * (640.0 / frames)) AS BIGINT) AS end_pixel,
    (SELECT round(avg(s), 5) FROM m WHERE m.line_id = sp.line_id AND t >= stop - own AND t < stop) AS confidence, round(score / frames, 5) AS line_confidence FROM sp""",
)
def segments(e) -> DataFrame:
    """Where the pieces of a line lie in its image, how sure they are, and how sure the line is."""
    steps = e.vectors.groupBy("line_id").agg(F.array_sort(F.collect_list(F.struct("step_id", F.array_max("logits").cast("double").alias("s")))).alias("ts")).select("line_id", F.col("ts.s").alias("best"))
    lengths = F.transform(F.sequence(F.lit(1), 2 + F.col("line_id") % 9), lambda k: (1 + (k * 5 + F.col("line_id")) % 9).cast("long"))
    n = F.size("best").cast("long")
    spans = steps.select("line_id", "best", n.alias("n"), (F.aggregate("best", F.lit(0.0), lambda a, x: a + x) / n).alias("whole"), F.posexplode(N.frame_spans(lengths, n)).alias("segment", "f"))
    pixel = lambda c: N.to_pixels(F.col(c), F.lit(640.0), F.col("n"))
    sure = N.span_confidence(F.col("best"), F.col("f.start"), F.col("f.end"))
    return spans.select("line_id", "segment", pixel("f.start").alias("start_pixel"), pixel("f.end").alias("end_pixel"), F.round(F.when(sure > float("-inf"), sure), 5).alias("confidence"), F.round("whole", 5).alias("line_confidence"))


_IDS = r"list_transform(list_filter(string_split_regex(page_text, '\s+'), lambda x: x <> ''), lambda x: length(x))"


def _ids():
    """The lengths of the words of a page stand for the numbers of decoded tokens."""
    return F.transform(F.filter(F.split("page_text", f"[{T.WHITE}]+"), lambda t: t != ""), lambda t: F.length(t))


@query("n11_repeat_matching", f"""WITH a AS (SELECT page_id, {_IDS} AS ids FROM page_output), w AS (SELECT page_id, ids[greatest(1, len(ids) - 511) :] AS g FROM a),
    c AS (SELECT page_id, g, unnest(list_filter(range(1, len(g)), lambda i: g[i] = g[len(g)])) AS i FROM w WHERE len(g) > 1), m AS (SELECT page_id, list_max(list_transform(range(1, least(i, 51) + 1), lambda k: CASE WHEN g[i - k + 1 : i] = g[len(g) - k + 1 : len(g)] THEN k ELSE 0 END)) AS n FROM c)
    SELECT p.page_id, CAST(coalesce(max(n), 0) AS INTEGER) AS longest FROM page_output p LEFT JOIN m USING (page_id) GROUP BY p.page_id""")
def repeats(e) -> DataFrame:
    return e.page_output.select("page_id", N.longest_repeat(_ids()).alias("longest"))


@query("n12_repeat_fires")
def fires(e) -> DataFrame:
    """How often and how hard the penalty on repeats would have struck while each page was decoded."""
    return e.page_output.select("page_id", N.repeat_fires(_ids()).alias("f")).select("page_id", "f.*")


@query("n12_repetition_penalty", "SELECT page_id, count(*) FILTER (w >= 12) AS fires, round(sum(CASE WHEN w >= 12 THEN -0.8 * pow(1.05, w - 12) ELSE 0 END), 4) AS total, max(w) AS longest, round(max(CASE WHEN w >= 12 THEN 0.8 * pow(1.05, w - 12) ELSE 0 END), 4) AS most, min(idx) FILTER (w >= 12) AS first, max(idx) FILTER (w >= 12) AS last FROM boxes GROUP BY page_id")
def penalty(e) -> DataFrame:
    p, struck = N.repetition_penalty(F.col("w"), 12, 0.8, 1.05), F.col("w") >= 12
    own = lambda f: f(F.when(struck, F.col("idx")))
    return e.boxes.groupBy("page_id").agg(F.count(F.when(struck, 1)).alias("fires"), F.round(F.sum(p), 4).alias("total"), F.max("w").alias("longest"), F.round(F.max(-p), 4).alias("most"), own(F.min).alias("first"), own(F.max).alias("last"))


@query("n13_argmax_label", f"SELECT step_id, 'c' || ({_ARG}) AS label, round(CAST(list_max(logits) AS DOUBLE), 5) AS prob FROM vectors")
def argmax_label(e) -> DataFrame:
    return e.vectors.select("step_id", F.concat(F.lit("c"), N.argmax(F.col("logits")).cast("string")).alias("label"), F.round(F.array_max("logits").cast("double"), 5).alias("prob"))


_FACTOR = "least(1.0, sqrt({0} * 50000.0 / (w * 1000.0)))"


@query("n14_resolution_router", f"SELECT page_id, idx, CASE WHEN idx % 5 = 4 THEN 1.0 WHEN h * {_FACTOR.format('0.6')} >= 24 THEN 0.6 WHEN h * {_FACTOR.format('0.75')} >= 24 THEN 0.75 ELSE 1.0 END AS scale FROM boxes")
def router(e) -> DataFrame:
    return e.boxes.select("page_id", "idx", N.fitted_scale(F.when(F.col("idx") % 5 != 4, F.col("h")), F.col("w") * 1000.0, F.lit(50000.0)).alias("scale"))


@query("n15_n17_sizes_and_tiles", """SELECT page_id, idx, CAST(CASE WHEN w * h <= 4000 THEN w ELSE greatest(round_even(w * f, 0), 28) END AS INTEGER) AS w, CAST(CASE WHEN w * h <= 4000 THEN h ELSE greatest(round_even(h * f, 0), 28) END AS INTEGER) AS h, round(least(1.0, 150.0 / greatest(w, h), sqrt(9000.0 / (w * h))), 6) AS scale,
    CAST((64 - w % 64) % 64 AS INTEGER) AS pad_w, CAST((64 - h % 64) % 64 AS INTEGER) AS pad_h, CAST(ceil(w / 64.0) * ceil(h / 64.0) AS BIGINT) AS tiles FROM (SELECT page_id, idx, w, h, sqrt(4000.0 / (w * h)) AS f FROM boxes)""")
def sizes(e) -> DataFrame:
    w, h = F.col("w"), F.col("h")
    s = e.boxes.select("page_id", "idx", N.fitted_size(w, h, 4000.0).alias("s"), F.round(N.capped_scale(w, h, 150, 9000), 6).alias("scale"), N.tile_counts(w, h, 64).alias("t"))
    return s.select("page_id", "idx", "s.w", "s.h", "scale", F.col("t.pad_w").cast("int").alias("pad_w"), F.col("t.pad_h").cast("int").alias("pad_h"), "t.tiles")


@query("n16_patch_downscale", """WITH a AS (SELECT page_id, idx, w * 20.0 AS w, h * 24.0 AS h FROM boxes), b AS (SELECT *, h * least(1600 / w, 1200 / h, 1.0) AS t FROM a), c AS (SELECT *, CASE WHEN t < 512 AND t > 384 THEN 512 ELSE t END AS t2 FROM b),
    d AS (SELECT *, 512 + floor((t2 - 512) / 434.0) * 434 AS row_ FROM c), f AS (SELECT *, least(CASE WHEN t2 > 512 AND t2 - row_ > 0 AND t2 - row_ <= 78 THEN row_ ELSE t2 END, 946) AS t3 FROM d)
    SELECT page_id, idx, round(CASE WHEN w > 2.5 * h THEN least(512 / h, 1600 / w) ELSE t3 / h END, 6) AS scale FROM f""")
def downscale(e) -> DataFrame:
    return e.boxes.select("page_id", "idx", F.round(N.patch_scale(F.col("w") * 20.0, F.col("h") * 24.0, 1600, 1200, 512), 6).alias("scale"))


@query("n19_quota_pause", "SELECT k, round(least(60 * pow(1.5, k - 1), 900), 4) AS pause FROM range(1, 15) t(k)")
def pause(e) -> DataFrame:
    return e.spark.range(1, 15).select(F.col("id").alias("k"), F.round(N.quota_pause(F.col("id")), 4).alias("pause"))


@query("x03_lease_schedule", "SELECT total, t AS second, greatest(1, least(300, total - t)) AS granted FROM (VALUES (330), (100), (60)) v(total), range(60, 1000, 60) r(t) WHERE t < total")
def leases(e) -> DataFrame:
    totals = values(e, [(330,), (100,), (60,)], "total long")
    second = F.explode(F.sequence(F.lit(60), F.greatest(F.col("total") - 1, F.lit(60)), F.lit(60)))
    return totals.withColumn("second", second).where("second < total").select("total", "second", F.greatest(F.lit(1), F.least(F.lit(300), F.col("total") - F.col("second"))).alias("granted"))
