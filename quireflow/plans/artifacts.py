"""Page-artifact queries: skip rules, joins between the outputs of dependent jobs, gates, merges, completion and batching."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import sequences, text
from ..operators.gates import strict_gate, tolerant_gate
from ..operators.tables import latest_per_key, numbered
from ..sources.sinks import message_attributes
from .registry import query

SKIP, LEAST = ("blank",), 0.3


def skip_reason() -> Column:
    """Why a page is skipped: a label of the set, else a probability below the least; only sound classifications count."""
    return F.when((F.col("status") == "ok") & F.col("label").isin(*SKIP), F.col("label")).when((F.col("status") == "ok") & (F.col("prob") < LEAST), F.lit(f"low_prob<{LEAST}"))


_REASON = "CASE WHEN c.status = 'ok' AND c.label = 'blank' THEN c.label WHEN c.status = 'ok' AND c.prob < 0.3 THEN 'low_prob<0.3' END"


@query("f03_j09_s08_page_skips", f"SELECT p.page_id, p.file, {_REASON} AS reason FROM page_output p LEFT JOIN classes c USING (page_id)")
def page_skips(e) -> DataFrame:
    return e.page_output.select("page_id", "file").join(e.classes, "page_id", "left").select("page_id", "file", skip_reason().alias("reason"))


@query(
    "f11_u01_row_kinds",
    f"""WITH j AS (SELECT p.page_id, p.ok, p.error_message, length(p.page_text) AS chars, {_REASON} AS reason FROM page_output p LEFT JOIN classes c USING (page_id))
    SELECT page_id, 'success' AS kind, chars, CAST(NULL AS VARCHAR) AS note FROM j WHERE reason IS NULL AND ok UNION ALL SELECT page_id, 'skipped', 0, reason FROM j WHERE reason IS NOT NULL UNION ALL SELECT page_id, 'error', 0, error_message FROM j WHERE reason IS NULL AND NOT ok""",
)
def row_kinds(e) -> DataFrame:
    j = e.page_output.join(e.classes, "page_id", "left").withColumn("reason", skip_reason())
    good = j.where("reason is null and ok").select("page_id", F.lit("success").alias("kind"), F.length("page_text").cast("long").alias("chars"), F.lit(None).cast("string").alias("note"))
    skipped = j.where("reason is not null").select("page_id", F.lit("skipped").alias("kind"), F.lit(0).cast("long").alias("chars"), F.col("reason").alias("note"))
    bad = j.where("reason is null and not ok").select("page_id", F.lit("error").alias("kind"), F.lit(0).cast("long").alias("chars"), F.col("error_message").alias("note"))
    return good.unionByName(skipped).unionByName(bad)


@query(
    "u02_j12_u06_completion",
    """SELECT file, 'received' AS origin, CAST(NULL AS VARCHAR) AS message FROM page_output WHERE page_id % 7 <> 0 UNION ALL
    SELECT p.file, 'DroppedByPipeline', 'last seen: ' || coalesce(s.step, 'nowhere') FROM page_output p LEFT JOIN (SELECT worker_id AS k, arg_max(kind, message_id) AS step FROM messages GROUP BY 1) s ON s.k = p.page_id WHERE p.page_id % 7 = 0""",
)
def completion(e) -> DataFrame:
    expected, received = e.page_output.select("page_id", "file"), e.page_output.where("page_id % 7 <> 0").select("page_id", "file")
    step = e.messages.groupBy(F.col("worker_id").alias("page_id")).agg(F.max_by("kind", "message_id").alias("step"))
    lost = expected.join(received, "page_id", "left_anti").join(step, "page_id", "left")
    made = lost.select("file", F.lit("DroppedByPipeline").alias("origin"), F.concat(F.lit("last seen: "), F.coalesce("step", F.lit("nowhere"))).alias("message"))
    return received.select("file", F.lit("received").alias("origin"), F.lit(None).cast("string").alias("message")).unionByName(made)


@query("u03_distinct_files", "SELECT count(*) AS n FROM (SELECT DISTINCT file FROM page_output)")
def distinct_files(e) -> DataFrame:
    return e.page_output.select("file").distinct().agg(F.count("*").alias("n"))


@query("u05_j13_first_of_duplicates", "SELECT worker_id, arg_min(kind, message_id) AS kind, min(message_id) AS message_id FROM messages GROUP BY worker_id")
def first_of(e) -> DataFrame:
    return latest_per_key(e.messages, ["worker_id"], F.asc("message_id")).select("worker_id", "kind", "message_id")


@query("a09_errors_by_stage", "SELECT volume, error_stage, count(*) AS n FROM page_output WHERE NOT ok GROUP BY volume, error_stage")
def by_stage(e) -> DataFrame:
    per = e.page_output.where("not ok").groupBy("volume", "error_stage").agg(F.count("*").alias("n"))
    maps = per.groupBy("volume").agg(F.map_from_entries(F.collect_list(F.struct("error_stage", "n"))).alias("m"))
    return maps.select("volume", F.explode("m").alias("error_stage", "n"))


@query(
    "a14_sweep_report",
    """WITH s AS (SELECT l_returnflag AS sweep, count(*) AS n, sum(l_quantity) AS cost, avg(l_discount) AS err FROM lineitem GROUP BY 1)
    SELECT s.sweep, s.n, round(s.cost, 2) AS cost, round(s.err, 6) AS err, round(s.cost / b.cost, 4) AS relative FROM s, s b WHERE b.sweep = 'A'""",
)
def sweep_report(e) -> DataFrame:
    s = e.lineitem.groupBy(F.col("l_returnflag").alias("sweep")).agg(F.count("*").alias("n"), F.sum("l_quantity").alias("cost"), F.avg("l_discount").alias("err"))
    base = s.where("sweep = 'A'").select(F.col("cost").alias("base"))
    return s.join(F.broadcast(base)).select("sweep", "n", F.round("cost", 2).alias("cost"), F.round("err", 6).alias("err"), F.round(F.col("cost") / F.col("base"), 4).alias("relative"))


@query("a15_median_confidence", "SELECT o.o_orderkey AS page_id, round(coalesce(median(conf), 0.0), 6) AS confidence FROM orders o LEFT JOIN boxes b ON b.page_id = o.o_orderkey GROUP BY 1")
def median_confidence(e) -> DataFrame:
    return e.orders.select(F.col("o_orderkey").alias("page_id")).join(e.boxes.select("page_id", "conf"), "page_id", "left").groupBy("page_id").agg(F.round(F.coalesce(F.median("conf"), F.lit(0.0)), 6).alias("confidence"))


@query("a16_languages_by_score", "WITH m AS (SELECT volume, lang, max(length(page_text)) AS score FROM page_output GROUP BY 1, 2) SELECT volume, string_agg(lang, ',' ORDER BY score DESC, lang) AS languages FROM m GROUP BY volume")
def languages(e) -> DataFrame:
    m = e.page_output.groupBy("volume", "lang").agg(F.max(F.length("page_text")).alias("score"))
    return m.groupBy("volume").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "lang"))).alias("ls")).select("volume", F.array_join(F.col("ls.lang"), ",").alias("languages"))


@query("a17_height_percentile", "SELECT page_id, CASE WHEN count(*) >= 5 THEN round(quantile_cont(h, 0.75), 4) END AS p75 FROM boxes GROUP BY page_id")
def height_percentile(e) -> DataFrame:
    return e.boxes.groupBy("page_id").agg(F.when(F.count("*") >= 5, F.round(F.percentile("h", 0.75), 4)).alias("p75"))


@query("a20_page_confidence", "SELECT page_id, round(coalesce(sum(conf * w) / nullif(sum(w), 0), 0), 6) AS confidence FROM boxes GROUP BY page_id")
def page_confidence(e) -> DataFrame:
    return e.boxes.groupBy("page_id").agg(F.round(F.coalesce(F.try_divide(F.sum(F.col("conf") * F.col("w")), F.sum("w")), F.lit(0.0)), 6).alias("confidence"))


@query("a23_best_retry_sample", "SELECT page_id, arg_min(idx, CAST(h AS BIGINT) * 100000000 + w * 10000 + idx) AS idx FROM boxes GROUP BY page_id")
def best_sample(e) -> DataFrame:
    return e.boxes.groupBy("page_id").agg(F.min_by("idx", F.struct("h", "w", "idx")).alias("idx"))


@query("f13_shortened_texts", "SELECT page_id, CASE WHEN length(t) > 128 THEN substr(t, 1, 127) || '…' ELSE t END AS short FROM (SELECT page_id, trim(replace(page_text, chr(10), ' ')) AS t FROM page_output)")
def shortened(e) -> DataFrame:
    return e.page_output.select("page_id", text.shortened(F.col("page_text"), 128).alias("short"))


@query("f18_retry_gate", "SELECT page_id, idx FROM boxes WHERE w >= 100 OR conf >= 0.5")
def retry_gate(e, fires: int = 100, score: float = 0.5) -> DataFrame:
    never = F.lit(False)
    return e.boxes.where((F.col("w") >= fires if fires else never) | (F.col("conf") >= score if score else never)).select("page_id", "idx")


@query("f20_second_pass_routing", "SELECT page_id, idx, CASE WHEN cls <> 0 AND abs(x % 13 - 6) < 3 THEN 'final' ELSE 'again' END AS route FROM boxes")
def routing(e) -> DataFrame:
    final = (F.col("cls") != 0) & (F.abs(F.col("x") % 13 - 6) < 3)
    once = e.boxes.where(final).select("page_id", "idx", F.lit("final").alias("route"))
    return once.unionByName(e.boxes.where(~final).select("page_id", "idx", F.lit("again").alias("route")))


@query("j10_j11_pages_with_boxes", "SELECT o.o_orderkey AS page_id, count(b.idx) AS n, min(b.x) AS x FROM orders o LEFT JOIN boxes b ON b.page_id = o.o_orderkey GROUP BY 1")
def with_boxes(e) -> DataFrame:
    per = e.boxes.groupBy("page_id").agg(F.count("*").alias("n"), F.min("x").alias("x"))
    return e.orders.select(F.col("o_orderkey").alias("page_id")).join(per, "page_id", "left").select("page_id", F.coalesce("n", F.lit(0)).alias("n"), "x")


@query("j14_outputs_by_unit_id", "SELECT u.page_id, u.unit, o.role FROM units u JOIN units o ON o.page_id = u.page_id AND o.unit = u.unit + 1")
def by_unit(e) -> DataFrame:
    nxt = e.units.select("page_id", (F.col("unit") - 1).alias("unit"), "role")
    return e.units.select("page_id", "unit").join(nxt, ["page_id", "unit"])


_FOLD = """WITH RECURSIVE s AS (SELECT page_id, idx, {size} AS size FROM boxes), f AS (SELECT page_id, idx, size AS total, 1 AS n, 0 AS chunk FROM s WHERE idx = 0 UNION ALL
    SELECT s.page_id, s.idx, CASE WHEN {new} THEN s.size ELSE f.total + s.size END, CASE WHEN {new} THEN 1 ELSE f.n + 1 END, CASE WHEN {new} THEN f.chunk + 1 ELSE f.chunk END FROM f JOIN s ON s.page_id = f.page_id AND s.idx = f.idx + 1)
    SELECT page_id, idx, chunk FROM f"""


def _chunks(e, size: Column, fold) -> DataFrame:
    g = e.boxes.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("idx", size.cast("long").alias("s")))).alias("xs"))
    return g.select("page_id", F.posexplode(fold(F.col("xs.s"))).alias("idx", "chunk"))


@query("w11_byte_budget_chunks", _FOLD.format(size="w", new="f.total > 0 AND f.total + s.size > 200"))
def byte_chunks(e) -> DataFrame:
    return _chunks(e, F.col("w"), lambda xs: sequences.byte_chunks(xs, 200))


@query("w12_dual_budget_batches", _FOLD.format(size="h", new="f.n >= 3 OR f.total + s.size > 150"))
def dual_chunks(e) -> DataFrame:
    return _chunks(e, F.col("h"), lambda xs: sequences.dual_chunks(xs, 3, 150))


@query("k10_k11_fallback_content", "SELECT p.page_id, coalesce(CASE WHEN p.ok THEN length(p.page_text) END, length(c.label), 0) AS content FROM page_output p LEFT JOIN classes c USING (page_id)")
def fallback(e) -> DataFrame:
    return e.page_output.join(e.classes.select("page_id", "label"), "page_id", "left").select("page_id", F.coalesce(F.when(F.col("ok"), F.length("page_text")), F.length("label"), F.lit(0)).cast("long").alias("content"))


@query("x06_redrive", "WITH dead AS (SELECT worker_id, kind FROM messages GROUP BY 1, 2 HAVING count(*) > 3) SELECT message_id FROM messages SEMI JOIN dead USING (worker_id, kind) ORDER BY message_id LIMIT 1000")
def redrive(e) -> DataFrame:
    dead = e.messages.groupBy("worker_id", "kind").count().where("count > 3")
    return e.messages.join(dead, ["worker_id", "kind"], "left_semi").orderBy("message_id").limit(1000).select("message_id")


@query("x11_page_reassembly", "SELECT page_id, count(*) AS got, max(unit) + 1 AS expected, count(*) = max(unit) + 1 AS complete FROM units WHERE unit <> 3 GROUP BY page_id")
def reassembly(e) -> DataFrame:
    return e.units.where("unit <> 3").groupBy("page_id").agg(F.count("*").alias("got"), (F.max("unit") + 1).alias("expected")).withColumn("complete", F.col("got") == F.col("expected"))


# --- errors

_FIRST = "CASE page_id % 4 WHEN 0 THEN error_message WHEN 1 THEN '[Write] disk is full ' WHEN 2 THEN 'out of luck: again' ELSE '[cut' END"


@query("f12_f13_error_parse", f"""SELECT page_id, CASE page_id % 4 WHEN 0 THEN error_stage WHEN 1 THEN 'Write' ELSE '' END AS stage, CASE WHEN page_id % 4 <> 0 THEN '' WHEN page_id % 3 = 0 THEN 'TimeoutError' ELSE 'ValueError' END AS type,
    CASE page_id % 4 WHEN 0 THEN 'page ' || page_id WHEN 1 THEN 'disk is full' ELSE {_FIRST} END AS message FROM page_output WHERE NOT ok""")
def error_parse(e) -> DataFrame:
    return e.page_output.where("not ok").select("page_id", text.parsed_error(text.shortened(F.expr(_FIRST))).alias("p")).select("page_id", "p.*")


_KINDS = ("TerminalTaskError", "RetryableTaskError", "VolumeTimeoutError", "FileNotFoundError", "RuntimeError")


@query("f14_failure_class", """SELECT page_id, k <> 0 AS retryable, CASE k WHEN 0 THEN m WHEN 1 THEN m WHEN 2 THEN 'Volume timeout: ' || m WHEN 3 THEN 'FileNotFoundError: ' || m ELSE 'RuntimeError: ' || m END AS reason,
    CASE k WHEN 2 THEN true WHEN 3 THEN page_id % 2 = 0 ELSE page_id % 3 <> 1 OR page_id % 2 = 0 END AS pipeline_retryable,
    CASE WHEN k = 2 THEN 'Volume timeout: ' || m WHEN page_id % 2 = 0 THEN 'GPU OOM error: ' || m WHEN k = 3 OR page_id % 3 = 1 THEN 'Resource not found: ' || m ELSE 'Pipeline error (' || ['TerminalTaskError', 'RetryableTaskError', 'VolumeTimeoutError', 'FileNotFoundError', 'RuntimeError'][k + 1] || '): ' || m END AS pipeline_reason
    FROM (SELECT page_id, page_id % 5 AS k, CASE WHEN page_id % 2 = 0 THEN 'CUDA out of memory ' ELSE '' END || CASE WHEN page_id % 3 = 1 THEN 'status 404' ELSE 'failed' END AS m FROM page_output)""")
def failure_class(e) -> DataFrame:
    k = F.col("page_id") % 5
    kind = F.get(F.array(*[F.lit(x) for x in _KINDS]), k.cast("int"))
    message = F.concat(F.when(F.col("page_id") % 2 == 0, "CUDA out of memory ").otherwise(""), F.when(F.col("page_id") % 3 == 1, "status 404").otherwise("failed"))
    out = e.page_output.select("page_id", text.failure_class(kind, message).alias("a"), text.pipeline_failure_class(kind, message).alias("b"))
    return out.select("page_id", "a.*", F.col("b.retryable").alias("pipeline_retryable"), F.col("b.reason").alias("pipeline_reason"))


@query(
    "a10_a11_failure_gates",
    f"""WITH p AS (SELECT p.volume || '-' || p.page_id % 40 AS vol, p.ok, p.error_stage, p.page_id % 31 = 7 AS dropped, {_REASON} AS reason FROM page_output p LEFT JOIN classes c USING (page_id)),
    c AS (SELECT vol, count(*) AS expected, count(reason) AS skipped, count(*) FILTER (NOT ok AND reason IS NULL) AS errors, count(*) FILTER (NOT ok AND reason IS NULL AND error_stage = 'Decode') AS early, count(*) FILTER (dropped) AS dropped FROM p GROUP BY vol)
    SELECT vol, expected, skipped, errors, dropped, CASE WHEN expected - skipped - early = 0 AND skipped = 0 THEN 'terminal' WHEN errors / greatest(expected - skipped, 1) > 0.05 THEN 'retryable' ELSE 'done' END AS tolerant,
    CASE WHEN dropped > 0 THEN 'retryable' WHEN errors > 0 THEN 'terminal' ELSE 'done' END AS strict FROM c""",
)
def gates(e) -> DataFrame:
    vol = F.concat("volume", F.lit("-"), (F.col("page_id") % 40).cast("string"))
    j = e.page_output.join(e.classes, "page_id", "left").withColumns({"reason": skip_reason(), "vol": vol})
    failed = ~F.col("ok") & F.col("reason").isNull()
    n = lambda c: F.count(F.when(c, 1))
    g = j.groupBy("vol").agg(F.count("*").alias("expected"), F.count("reason").alias("skipped"), n(failed).alias("errors"), n(failed & (F.col("error_stage") == "Decode")).alias("early"), n(F.col("page_id") % 31 == 7).alias("dropped"))
    return g.select("vol", "expected", "skipped", "errors", "dropped", tolerant_gate(*[F.col(c) for c in ("expected", "skipped", "errors", "early")]).alias("tolerant"), strict_gate(F.col("errors"), F.col("dropped")).alias("strict"))


# --- merging units

_SPACE = "' ' || chr(9) || chr(10) || chr(13)"
_UNITS = """SELECT page_id, unit, CASE WHEN role = 'assistant' THEN 'footnote' ELSE 'body' END AS kind, CASE WHEN (page_id + unit) % 4 = 0 THEN ' ' || chr(10) ELSE chr(10) || text || ' ' END AS text, length(text) AS tokens, (page_id + unit) % 5 = 4 AS truncated, CASE WHEN unit % 3 = 2 THEN '' ELSE 'stop' END AS finish,
    page_id % 3 * unit AS fires, unit * 3 AS most, (page_id + unit) % 7 = 3 AS retried FROM units"""


def _joined(kind: str) -> str:
    return f"CASE WHEN count(*) FILTER (kind = '{kind}') = 0 THEN '' WHEN count(*) FILTER (kind = '{kind}') = 1 THEN any_value(text) FILTER (kind = '{kind}') ELSE coalesce(string_agg(trim(text, {_SPACE}), chr(10) || chr(10) ORDER BY unit) FILTER (kind = '{kind}' AND trim(text, {_SPACE}) <> ''), '') END"


@query(
    "a12_a13_unit_merge",
    f"""WITH u AS ({_UNITS}) SELECT page_id, {_joined('body')} AS body, {_joined('footnote')} AS footnotes, count(*) FILTER (kind = 'footnote') AS n_footnotes, CAST(sum(tokens) AS BIGINT) AS tokens, bool_or(truncated) AS truncated,
    CASE WHEN bool_or(truncated) THEN 'length' ELSE coalesce(arg_max(finish, unit) FILTER (kind = 'body'), '') END AS finish_reason, CAST(sum(fires) AS BIGINT) AS fires, max(most) AS most, bool_or(retried) AS retried FROM u GROUP BY page_id""",
)
def unit_merge(e) -> DataFrame:
    key = F.col("page_id") + F.col("unit")
    units = e.units.select(
        "page_id", "unit", F.when(F.col("role") == "assistant", "footnote").otherwise("body").alias("kind"), F.when(key % 4 == 0, " \n").otherwise(F.concat(F.lit("\n"), "text", F.lit(" "))).alias("text"), F.length("text").alias("tokens"), (key % 5 == 4).alias("truncated"),
        F.when(F.col("unit") % 3 == 2, "").otherwise("stop").alias("finish"), (F.col("page_id") % 3 * F.col("unit")).alias("fires"), (F.col("unit") * 3).alias("most"), (key % 7 == 3).alias("retried"),
    )
    return merged_units(units)


def merged_units(units: DataFrame) -> DataFrame:
    """One row a page of its units (page_id, unit, kind, text, tokens, truncated, finish, fires, most, retried): the body's texts and those of footnotes, each joined, and
    the sums, maxima and flags of all. A page is cut off if any unit is; else it ended as the last unit of its body did."""
    g = units.groupBy("page_id").agg(
        F.array_sort(F.collect_list(F.struct("unit", "kind", "text", "finish"))).alias("us"), F.count(F.when(F.col("kind") == "footnote", 1)).alias("n_footnotes"), F.sum("tokens").alias("tokens"), F.bool_or("truncated").alias("truncated"),
        F.sum("fires").alias("fires"), F.max("most").alias("most"), F.bool_or("retried").alias("retried"),
    )
    own = lambda kind: F.filter("us", lambda u: u["kind"] == kind)
    last = F.coalesce(F.try_element_at(own("body"), F.lit(-1))["finish"], F.lit(""))
    texts = lambda kind: joined_texts(F.transform(own(kind), lambda u: u["text"]))
    return g.select("page_id", texts("body").alias("body"), texts("footnote").alias("footnotes"), "n_footnotes", "tokens", "truncated", F.when(F.col("truncated"), "length").otherwise(last).alias("finish_reason"), "fires", "most", "retried")


def joined_texts(texts: Column, between: str = "\n\n") -> Column:
    """Texts of parts as one: trimmed, without blank ones, parted by an empty line. A single part stays as it is; no part gives ''."""
    some = F.filter(F.transform(texts, text.stripped), lambda t: t != "")
    return F.when(F.size(texts) == 1, F.coalesce(texts[0], F.lit(""))).otherwise(F.array_join(some, between))


# --- numbering and batches

@query("w08_page_index", "SELECT page_id, volume, row_number() OVER (PARTITION BY volume ORDER BY file) - 1 AS page_index FROM page_output")
def page_index(e) -> DataFrame:
    return numbered(e.page_output.select("page_id", "volume", "file"), ["volume"], ["file"]).select("page_id", "volume", (F.col("number") - 1).alias("page_index"))


@query("f15_w09_lanes_and_batches", """WITH l AS (SELECT page_id, CASE WHEN page_id % 5 < 2 THEN 'files' ELSE 'images' END AS lane, ['image/tiff', 'image/tiff', 'image/jpeg', 'image/webp', 'application/octet-stream'][page_id % 5 + 1] AS media_type FROM page_output), r AS (SELECT *, row_number() OVER (PARTITION BY lane ORDER BY page_id) AS rn FROM l)
    SELECT page_id, lane, media_type, 'run-' || lane || '-' || CASE WHEN (rn - 1) // 16 + 1 < 10000 THEN lpad(CAST((rn - 1) // 16 + 1 AS VARCHAR), 4, '0') ELSE CAST((rn - 1) // 16 + 1 AS VARCHAR) END AS batch_id FROM r""")
def lanes(e) -> DataFrame:
    names = F.array(*[F.lit(x) for x in ("p.TIF", "p.tiff", "p.JPG", "p.webp", "p")])
    laned = e.page_output.select("page_id", text.lane(F.get(names, (F.col("page_id") % 5).cast("int"))).alias("l")).select("page_id", "l.*")
    n = F.expr("(number - 1) div 16 + 1").cast("string")
    padded = F.when(F.length(n) < 4, F.lpad(n, 4, "0")).otherwise(n)
    return numbered(laned, ["lane"], ["page_id"]).select("page_id", "lane", "media_type", F.concat(F.lit("run-"), "lane", F.lit("-"), padded).alias("batch_id"))


@query(
    "k09_send_batches",
    """SELECT worker_id, batch, count(*) AS n, string_agg(attributes, '|' ORDER BY message_id) AS attributes FROM (SELECT worker_id, message_id, (row_number() OVER (PARTITION BY worker_id ORDER BY message_id) - 1) // 10 AS batch,
    '{"w_id":"W' || worker_id || '","i_id":"I' || message_id || '"' || CASE WHEN message_id % 3 = 0 THEN ',"source":"benchmark","i_version":"v' || message_id % 7 || '"' ELSE '' END || '}' AS attributes FROM messages) GROUP BY 1, 2""",
)
def send_batches(e) -> DataFrame:
    """The batches of ten that are sent for each worker, with the attributes of each message: those that are empty or the default aren't sent."""
    m = F.col("message_id")
    source = F.when(m % 3 == 0, "benchmark").when(m % 3 == 1, "archive")
    volumes = e.messages.select("worker_id", "message_id", F.concat(F.lit("W"), F.col("worker_id").cast("string")).alias("w_id"), F.concat(F.lit("I"), m.cast("string")).alias("i_id"), source.alias("source"), F.when(m % 3 == 0, F.concat(F.lit("v"), (m % 7).cast("string"))).otherwise("").alias("i_version"))
    rn = F.row_number().over(Window.partitionBy("worker_id").orderBy("message_id"))
    sent = volumes.withColumn("rn", rn).select("worker_id", "message_id", message_attributes().alias("attributes"), F.expr("cast((rn - 1) div 10 as bigint)").alias("batch"))
    g = sent.groupBy("worker_id", "batch").agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct("message_id", "attributes"))).alias("ms"))
    return g.select("worker_id", "batch", "n", F.array_join(F.transform("ms", lambda x: x["attributes"]), "|").alias("attributes"))
