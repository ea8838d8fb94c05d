"""Control-table queries: task statistics, workers, errors, claims and job administration."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import admin
from ..operators.tables import latest_per_key, merge_snapshot, numbered
from .registry import query

FAILED = ("retryable_failed", "terminal_failed")
STATUS_ORDER = "CASE status WHEN 'running' THEN 1 WHEN 'done' THEN 2 WHEN 'retryable_failed' THEN 3 ELSE 4 END"


@query(
    "a01_a02_status_stats",
    f"""SELECT job_name, status, {STATUS_ORDER} AS place, count(*) AS n, round(avg(total_ms), 2) AS mean_ms, CAST(sum(total_images) AS BIGINT) AS images, CAST(sum(nb_errors) AS BIGINT) AS errors
    FROM tasks JOIN jobs USING (job_id) GROUP BY job_name, status ORDER BY job_name, place""",
)
def status_stats(e) -> DataFrame:
    g = e.tasks.join(F.broadcast(e.jobs), "job_id").groupBy("job_name", "status")  # jobs: a handful of rows by definition
    out = g.agg(F.count("*").alias("n"), F.round(F.avg("total_ms"), 2).alias("mean_ms"), F.sum("total_images").alias("images"), F.sum("nb_errors").alias("errors"))
    return out.withColumn("place", F.expr(STATUS_ORDER)).orderBy("job_name", "place")


@query("a03_global_totals", """SELECT count(*) AS n, count(total_ms) AS measured, round(avg(page_ms), 3) AS mean_page_ms, round(min(total_ms), 2) AS least_ms, round(max(total_ms), 2) AS most_ms FROM tasks""")
def global_totals(e) -> DataFrame:
    return e.tasks.agg(F.count("*").alias("n"), F.count("total_ms").alias("measured"), F.round(F.avg("page_ms"), 3).alias("mean_page_ms"), F.round(F.min("total_ms"), 2).alias("least_ms"), F.round(F.max("total_ms"), 2).alias("most_ms"))


@query(
    "a04_worker_filtered_counts",
    """SELECT worker_id, count(*) AS n, count(*) FILTER (status = 'done') AS done, count(*) FILTER (status = 'running') AS running, count(*) FILTER (status LIKE '%failed') AS failed,
    CAST(sum(total_images) AS BIGINT) AS images, round(avg(page_ms), 3) AS mean_page_ms FROM tasks WHERE worker_id IS NOT NULL GROUP BY worker_id""",
)
def worker_counts(e) -> DataFrame:
    is_ = lambda c: F.count(F.when(c, 1))
    s = F.col("status")
    return e.tasks.where("worker_id is not null").groupBy("worker_id").agg(
        F.count("*").alias("n"), is_(s == "done").alias("done"), is_(s == "running").alias("running"), is_(s.endswith("failed")).alias("failed"), F.sum("total_images").alias("images"), F.round(F.avg("page_ms"), 3).alias("mean_page_ms")
    )


@query("a05_fleet_distinct", """SELECT count(DISTINCT worker_id) AS workers, count(DISTINCT volume_id) FILTER (status = 'done') AS volumes_done, count(*) FILTER (nb_errors > 0) AS with_errors FROM tasks""")
def fleet(e) -> DataFrame:
    return e.tasks.agg(F.count_distinct("worker_id").alias("workers"), F.count_distinct(F.when(F.col("status") == "done", F.col("volume_id"))).alias("volumes_done"), F.count(F.when(F.col("nb_errors") > 0, 1)).alias("with_errors"))


@query(
    "a06_j04_j08_busiest_active_workers",
    """SELECT w.worker_id, w.worker_name, count(*) AS n, CAST(sum(t.total_images) AS BIGINT) AS images FROM workers w JOIN tasks t ON t.worker_id = w.worker_id
    WHERE w.worker_id IN (SELECT worker_id FROM workers, event_clock WHERE last_heartbeat_at >= now_at - INTERVAL '10' MINUTE * 100) GROUP BY 1, 2 ORDER BY n DESC, w.worker_id LIMIT 20""",
)
def busiest(e) -> DataFrame:
    active = e.workers.join(F.broadcast(e.event_clock)).where(F.expr("last_heartbeat_at >= now_at - INTERVAL '1000' MINUTE")).select("worker_id")
    w = e.workers.join(active, "worker_id", "left_semi")
    return e.tasks.join(w, "worker_id").groupBy("worker_id", "worker_name").agg(F.count("*").alias("n"), F.sum("total_images").alias("images")).orderBy(F.desc("n"), "worker_id").limit(20)


@query(
    "a07_worker_task_counts",
    """SELECT worker_id, (SELECT count(*) FROM tasks t WHERE t.worker_id = w.worker_id) AS n, (SELECT count(*) FROM tasks t WHERE t.worker_id = w.worker_id AND status = 'done') AS done,
    (SELECT count(*) FROM tasks t WHERE t.worker_id = w.worker_id AND status LIKE '%failed') AS failed FROM workers w""",
)
def worker_task_counts(e) -> DataFrame:
    s = F.col("status")
    per = e.tasks.where("worker_id is not null").groupBy("worker_id").agg(F.count("*").alias("n"), F.count(F.when(s == "done", 1)).alias("done"), F.count(F.when(s.isin(*FAILED), 1)).alias("failed"))
    return e.workers.select("worker_id").join(per, "worker_id", "left").na.fill(0)


@query(
    "a08_ratio_metrics",
    """WITH c AS (SELECT job_id, count(*) AS n, count(*) FILTER (status = 'done') AS done, CAST(coalesce(sum(nb_errors), 0) AS BIGINT) AS errs, CAST(coalesce(sum(total_images), 0) AS BIGINT) AS imgs FROM tasks GROUP BY job_id)
    SELECT job_id, CAST(floor(done * 100 / n) AS BIGINT) AS done_pct, round(errs * 100.0 / nullif(imgs, 0), 2) AS error_rate FROM c""",
)
def ratios(e) -> DataFrame:
    c = e.tasks.groupBy("job_id").agg(F.count("*").alias("n"), F.count(F.when(F.col("status") == "done", 1)).alias("done"), F.coalesce(F.sum("nb_errors"), F.lit(0)).alias("errs"), F.coalesce(F.sum("total_images"), F.lit(0)).alias("imgs"))
    return c.select("job_id", F.expr("done * 100 div n").alias("done_pct"), F.round(F.try_divide(F.col("errs") * F.lit(100.0), F.col("imgs")), 2).alias("error_rate"))


@query("a25_queue_gauges", """SELECT count(*) FILTER (kind = 'view') AS available, count(*) FILTER (kind = 'click') AS in_flight, count(*) FILTER (kind NOT IN ('view', 'click')) AS delayed FROM messages""")
def gauges(e) -> DataFrame:
    k = F.col("kind")
    return e.messages.agg(F.count(F.when(k == "view", 1)).alias("available"), F.count(F.when(k == "click", 1)).alias("in_flight"), F.count(F.when(~k.isin("view", "click"), 1)).alias("delayed"))


@query("a26_status_histogram", "SELECT status, count(*) AS n FROM tasks GROUP BY status")
def histogram(e) -> DataFrame:
    return e.tasks.groupBy("status").agg(F.count("*").alias("n"))


@query("w01_latest_task_per_worker", "SELECT worker_id, max(id) AS id, arg_max(status, id) AS status FROM tasks WHERE worker_id IS NOT NULL GROUP BY worker_id")
def latest_task(e) -> DataFrame:
    return latest_per_key(e.tasks.where("worker_id is not null"), ["worker_id"], F.desc("id")).select("worker_id", "id", "status")


@query("w02_latest_task_of_volume", "SELECT id, status, attempt FROM tasks WHERE volume_id = 7 ORDER BY id DESC LIMIT 1")
def latest_of_volume(e) -> DataFrame:
    return e.tasks.where("volume_id = 7").orderBy(F.desc("id")).limit(1).select("id", "status", "attempt")


@query("w03_latest_active_registration", "SELECT worker_name, max(worker_id) AS worker_id FROM workers WHERE stopped_at IS NULL GROUP BY worker_name")
def registration(e) -> DataFrame:
    return e.workers.where("stopped_at is null").groupBy("worker_name").agg(F.max("worker_id").alias("worker_id"))


@query("w04_recent_tasks_nulls_first", "SELECT id, status FROM (SELECT id, status, coalesce(done_at, CASE WHEN id % 50 = 0 THEN NULL ELSE started_at END) AS seen FROM tasks) ORDER BY seen DESC NULLS FIRST, id LIMIT 40")
def recents(e) -> DataFrame:
    at = F.coalesce("done_at", F.when(F.col("id") % 50 != 0, F.col("started_at")))
    return e.tasks.withColumn("at", at).orderBy(F.desc_nulls_first("at"), "id").limit(40).select("id", "status")


@query("w05_slowest_task", "SELECT t.id, v.w_id, v.i_id, round(t.page_ms, 3) AS page_ms FROM tasks t JOIN volumes v USING (volume_id) WHERE status = 'done' AND page_ms IS NOT NULL ORDER BY t.page_ms DESC, t.id LIMIT 1")
def slowest(e) -> DataFrame:
    top = e.tasks.where("status = 'done' and page_ms is not null").orderBy(F.desc("page_ms"), "id").limit(1)
    return e.volumes.join(F.broadcast(top), "volume_id").select("id", "w_id", "i_id", F.round("page_ms", 3).alias("page_ms"))  # one row


@query(
    "w06_recent_errors",
    """WITH recent AS (SELECT *, row_number() OVER (ORDER BY done_at DESC, id) AS place FROM (SELECT * FROM tasks WHERE nb_errors > 0 ORDER BY done_at DESC, id LIMIT 50))
    SELECT id, line, place FROM (SELECT r.id, r.place, r.done_at, row_number() OVER (PARTITION BY r.id ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS line FROM recent r JOIN lineitem l ON l.l_orderkey = r.id WHERE l_returnflag = 'R') ORDER BY done_at DESC, place, line LIMIT 25""",
)
def recent_errors(e) -> DataFrame:
    top = e.tasks.where("nb_errors > 0").orderBy(F.desc("done_at"), "id").limit(50).select("id", "done_at")
    placed = top.withColumn("place", F.row_number().over(Window.orderBy(F.desc("done_at"), "id")))  # fifty rows
    side = e.lineitem.where("l_returnflag = 'R'").join(F.broadcast(placed), F.col("l_orderkey") == F.col("id"))
    line = F.row_number().over(Window.partitionBy("id").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"))
    return side.withColumn("line", line).orderBy(F.desc("done_at"), "place", "line").limit(25).select("id", "line", "place")


@query("w07_job_listing", "SELECT job_id, job_name FROM jobs ORDER BY job_id")
def job_listing(e) -> DataFrame:
    return e.jobs.orderBy("job_id")


@query("j01_tasks_with_volumes", "SELECT t.id, v.w_id, v.i_id, t.status FROM tasks t JOIN volumes v USING (volume_id)")
def with_volumes(e) -> DataFrame:
    return e.tasks.join(e.volumes, "volume_id").select("id", "w_id", "i_id", "status")


@query(
    "j02_f01_f02_error_listing",
    """SELECT t.id, v.w_id, j.job_name, w.worker_name, t.etag FROM tasks t JOIN volumes v USING (volume_id) JOIN jobs j USING (job_id) LEFT JOIN workers w USING (worker_id)
    WHERE (t.status IN ('retryable_failed', 'terminal_failed') OR (t.status = 'done' AND t.nb_errors > 0)) AND j.job_id = 2""",
)
def error_listing(e) -> DataFrame:
    return failed_tasks(e, "all", job_id=2).join(e.volumes, "volume_id").join(F.broadcast(e.jobs), "job_id").join(e.workers, "worker_id", "left").select("id", "w_id", "job_name", "worker_name", "etag")


def failed_tasks(e, mode: str = "all", job_id: int | None = None, worker_id: int | None = None) -> DataFrame:
    """Tasks in error: ``task-failed``, ``image-errors`` or ``all``, with optional conditions on job and worker."""
    failed, image = F.col("status").isin(*FAILED), (F.col("status") == "done") & (F.col("nb_errors") > 0)
    df = e.tasks.where({"all": failed | image, "task-failed": failed, "image-errors": image}[mode])
    for c, v in (("job_id", job_id), ("worker_id", worker_id)):
        if v is not None:
            df = df.where(F.col(c) == v)
    return df


@query("f02_error_modes", """SELECT 'task-failed' AS mode, count(*) AS n FROM tasks WHERE status LIKE '%failed' UNION ALL SELECT 'image-errors', count(*) FROM tasks WHERE status = 'done' AND nb_errors > 0""")
def error_modes(e) -> DataFrame:
    parts = [failed_tasks(e, m).agg(F.count("*").alias("n")).select(F.lit(m).alias("mode"), "n") for m in ("task-failed", "image-errors")]
    return parts[0].unionByName(parts[1])


@query(
    "j03_w01_f08_f09_worker_overview",
    """SELECT w.worker_id, w.worker_name, t.id AS task_id, j.job_name, v.w_id,
    CASE WHEN w.stopped_at IS NOT NULL THEN 'stopped' WHEN age < 60 THEN 'active' WHEN age < 600 THEN 'idle' ELSE 'inactive' END AS state,
    CASE WHEN age IS NULL THEN '-' WHEN age < 60 THEN age || 's' WHEN age < 3600 THEN (age // 60) || 'm' WHEN age < 86400 THEN (age // 3600) || 'h' ELSE (age // 86400) || 'd' END AS age
    FROM (SELECT w.*, date_diff('second', last_heartbeat_at, now_at) AS age FROM workers w, event_clock) w LEFT JOIN (SELECT worker_id, max(id) AS id, arg_max(job_id, id) AS job_id, arg_max(volume_id, id) AS volume_id FROM tasks GROUP BY worker_id) t USING (worker_id)
    LEFT JOIN jobs j USING (job_id) LEFT JOIN volumes v USING (volume_id)""",
)
def worker_overview(e) -> DataFrame:
    w = e.workers.join(F.broadcast(e.event_clock)).withColumn("age_s", F.expr("unix_seconds(cast(date_trunc('second', now_at) as timestamp)) - unix_seconds(cast(date_trunc('second', last_heartbeat_at) as timestamp))"))
    last = latest_per_key(e.tasks.where("worker_id is not null"), ["worker_id"], F.desc("id")).select("worker_id", F.col("id").alias("task_id"), "job_id", "volume_id")
    return w.join(last, "worker_id", "left").join(F.broadcast(e.jobs), "job_id", "left").join(e.volumes, "volume_id", "left").select("worker_id", "worker_name", "task_id", "job_name", "w_id", worker_state().alias("state"), human_age(F.col("age_s")).alias("age"))


def worker_state():
    """stopped, active (under a minute), idle (under ten) or inactive; a worker never seen is inactive."""
    a = F.col("age_s")
    return F.when(F.col("stopped_at").isNotNull(), "stopped").when(a < 60, "active").when(a < 600, "idle").otherwise("inactive")


def human_age(s):
    unit = lambda n, u: F.concat(F.floor(s / n).cast("string"), F.lit(u))
    return F.when(s.isNull(), "-").when(s < 60, unit(1, "s")).when(s < 3600, unit(60, "m")).when(s < 86400, unit(3600, "h")).otherwise(unit(86400, "d"))


@query("j05_done_on_latest_version", "SELECT DISTINCT v.w_id, v.i_id FROM tasks t JOIN volumes v ON t.volume_id = v.volume_id AND t.etag = v.last_etag WHERE t.status = 'done' AND t.job_id = 1")
def done_latest(e) -> DataFrame:
    done = e.tasks.where("status = 'done' and job_id = 1").select("volume_id", F.col("etag").alias("last_etag"))
    return e.volumes.join(done, ["volume_id", "last_etag"], "left_semi").select("w_id", "i_id").distinct()


@query("j06_is_done_point_check", "SELECT EXISTS (SELECT 1 FROM tasks t JOIN volumes v ON t.volume_id = v.volume_id AND t.etag = v.last_etag WHERE v.volume_id = 11 AND t.status = 'done') AS is_done")
def is_done(e) -> DataFrame:
    hit = e.tasks.where("volume_id = 11 and status = 'done'").join(e.volumes.where("volume_id = 11").select("volume_id", F.col("last_etag").alias("etag")), ["volume_id", "etag"], "left_semi").limit(1)
    return hit.agg((F.count("*") > 0).alias("is_done"))


@query("j07_u04_not_yet_done", "SELECT volume_id, w_id FROM volumes WHERE volume_id NOT IN (SELECT volume_id FROM tasks WHERE status = 'done')")
def not_done(e) -> DataFrame:
    return e.volumes.join(e.tasks.where("status = 'done'"), "volume_id", "left_anti").select("volume_id", "w_id")


@query("f04_stale_tasks", "SELECT id, status FROM tasks, task_clock WHERE started_at < now_at - INTERVAL '5' MINUTE")
def stale(e) -> DataFrame:
    """Tasks that began more than five minutes ago, whatever became of them."""
    return e.tasks.join(F.broadcast(e.task_clock)).where(F.expr("started_at < now_at - INTERVAL '5' MINUTE")).select("id", "status")  # one row of a clock


@query("j07_skipped_count", "SELECT count(*) FILTER (volume_id IN (SELECT volume_id FROM tasks WHERE status = 'done')) AS skipped, count(*) FILTER (volume_id NOT IN (SELECT volume_id FROM tasks WHERE status = 'done')) AS sent FROM volumes")
def skipped(e) -> DataFrame:
    done = e.tasks.where("status = 'done'").select("volume_id", F.lit(True).alias("done")).distinct()
    return e.volumes.join(done, "volume_id", "left").agg(F.count("done").alias("skipped"), F.count(F.when(F.col("done").isNull(), 1)).alias("sent"))


@query("f05_active_workers", "SELECT worker_id FROM workers, event_clock WHERE last_heartbeat_at >= now_at - INTERVAL '10' MINUTE")
def active(e) -> DataFrame:
    return e.workers.join(F.broadcast(e.event_clock)).where(F.expr("last_heartbeat_at >= now_at - INTERVAL '10' MINUTE")).select("worker_id")


@query("f06_f07_polymorphic_lookup", "SELECT ident, worker_id FROM (VALUES ('3'), ('worker-5'), ('nobody')) q(ident) JOIN workers w ON w.worker_id = TRY_CAST(ident AS BIGINT) OR (TRY_CAST(ident AS BIGINT) IS NULL AND w.worker_name = ident)")
def lookup(e) -> DataFrame:
    q = e.spark.createDataFrame([("3",), ("worker-5",), ("nobody",)], "ident string").withColumn("n", F.expr("try_cast(ident as bigint)"))
    by_id, by_name = q.where("n is not null"), q.where("n is null")
    return e.workers.join(F.broadcast(by_id), F.col("worker_id") == F.col("n")).select("ident", "worker_id").unionByName(e.workers.join(F.broadcast(by_name), F.col("worker_name") == F.col("ident")).select("ident", "worker_id"))


@query("f10_display_columns", """SELECT id, CASE WHEN length(etag) > 22 THEN substr(etag, 1, 21) || '…' ELSE etag END AS etag, coalesce(CAST(worker_id AS VARCHAR), '-') AS worker, coalesce(printf('%.1f', round(total_ms / 1000, 1)), '-') AS seconds FROM tasks""")
def display(e) -> DataFrame:
    return e.tasks.select("id", ellipsis(F.col("etag"), 22).alias("etag"), F.coalesce(F.col("worker_id").cast("string"), F.lit("-")).alias("worker"), F.when(F.col("total_ms").isNotNull(), F.format_string("%.1f", F.round(F.col("total_ms") / 1000, 1))).otherwise("-").alias("seconds"))


def ellipsis(c, n: int):
    """At most n characters, the last an ellipsis where some are cut."""
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n - 1), F.lit("…"))).otherwise(c)


@query(
    "m01_register_worker",
    """WITH req AS (SELECT DISTINCT worker_name FROM workers UNION ALL SELECT 'newcomer'), best AS (SELECT worker_name, max(worker_id) AS worker_id FROM workers WHERE stopped_at IS NULL GROUP BY 1)
    SELECT r.worker_name, coalesce(b.worker_id, (SELECT max(worker_id) FROM workers) + row_number() OVER (PARTITION BY b.worker_id IS NULL ORDER BY r.worker_name)) AS worker_id, b.worker_id IS NOT NULL AS reused FROM req r LEFT JOIN best b USING (worker_name)""",
)
def register(e) -> DataFrame:
    """Every name registers: the newest row of the name that isn't stopped is used again, else the next number."""
    wanted = e.workers.select("worker_name").distinct().union(e.spark.createDataFrame([("newcomer",)], "worker_name string"))
    best = e.workers.where("stopped_at is null").groupBy("worker_name").agg(F.max("worker_id").alias("own"))
    top = e.workers.agg(F.max("worker_id").alias("top"))
    known = wanted.join(best, "worker_name", "left")
    old = known.where("own is not null").select("worker_name", F.col("own").alias("worker_id"), F.lit(True).alias("reused"))
    new = numbered(known.where("own is null").select("worker_name"), [], ["worker_name"]).join(F.broadcast(top))  # one row
    return old.union(new.select("worker_name", (F.col("top") + F.col("number")).alias("worker_id"), F.lit(False)))


@query("m02_heartbeat_and_stop", "SELECT worker_id, CASE WHEN worker_id % 4 = 0 THEN now_at ELSE last_heartbeat_at END AS last_heartbeat_at, CASE WHEN worker_id % 9 = 0 THEN coalesce(stopped_at, now_at) ELSE stopped_at END AS stopped_at FROM workers, event_clock")
def heartbeat(e) -> DataFrame:
    beats = e.workers.where("worker_id % 4 = 0 or worker_id % 9 = 0").join(F.broadcast(e.event_clock)).select("worker_id", "now_at")
    beat, stop = F.col("t.worker_id") % 4 == 0, F.col("t.worker_id") % 9 == 0
    out = merge_snapshot(e.workers, beats, ["worker_id"], {"last_heartbeat_at": F.when(beat, F.col("s.now_at")).otherwise(F.col("t.last_heartbeat_at")), "stopped_at": F.when(stop, F.coalesce("t.stopped_at", "s.now_at")).otherwise(F.col("t.stopped_at"))})
    return out.select("worker_id", "last_heartbeat_at", "stopped_at")


@query(
    "m03_upsert_volumes",
    """WITH src AS (SELECT volume_id, w_id, i_id, CASE WHEN volume_id % 3 = 0 THEN md5(last_etag) ELSE last_etag END AS e, nb_images + CASE WHEN volume_id % 3 = 0 THEN 1 ELSE 0 END AS n FROM volumes UNION ALL SELECT 900000000 + volume_id, w_id, i_id || 'x', last_etag, 5 FROM volumes)
    SELECT coalesce(v.w_id, s.w_id) AS w_id, coalesce(v.i_id, s.i_id) AS i_id, coalesce(s.e, v.last_etag) AS last_etag, CAST(coalesce(s.n, v.nb_images) AS INTEGER) AS nb_images, CAST(coalesce(v.nb_images_intro, 0) AS INTEGER) AS nb_images_intro FROM volumes v FULL JOIN src s ON s.w_id = v.w_id AND s.i_id = v.i_id""",
)
def upsert_volumes(e) -> DataFrame:
    """Every volume is seen again, each third changed, and a new one beside each."""
    v, new = e.volumes, F.col("volume_id") % 3 == 0
    seen = v.select("w_id", "i_id", F.when(new, F.md5("last_etag")).otherwise(F.col("last_etag")).alias("e"), (F.col("nb_images") + F.when(new, 1).otherwise(0)).alias("n"))
    added = v.select("w_id", F.concat("i_id", F.lit("x")).alias("i_id"), F.col("last_etag").alias("e"), F.lit(5).alias("n"))
    out = merge_snapshot(v, seen.unionByName(added), ["w_id", "i_id"], {"last_etag": F.col("s.e"), "nb_images": F.col("s.n")}, {"last_etag": F.col("s.e"), "nb_images": F.col("s.n"), "nb_images_intro": F.lit(0)})
    return out.select("w_id", "i_id", "last_etag", "nb_images", "nb_images_intro")


@query(
    "m04_m05_m06_x04_claims",
    """WITH req AS (SELECT job_id, volume_id, etag, volume_id % 10 = 0 AS force FROM (SELECT DISTINCT job_id, volume_id, etag FROM tasks) UNION ALL SELECT 99, volume_id, last_etag, false FROM volumes),
    have AS (SELECT job_id, volume_id, etag, max(id) AS id, arg_max(status, id) AS status, arg_max(attempt, id) AS attempt, arg_max(started_at, id) AS started_at FROM tasks GROUP BY 1, 2, 3)
    SELECT r.job_id, r.volume_id, r.etag, CASE WHEN h.id IS NULL THEN 'claim' WHEN r.force THEN 'force' WHEN h.started_at < now_at - INTERVAL '400' DAY THEN 'stale' ELSE 'skip' END AS decision,
    CAST(CASE WHEN h.id IS NULL THEN 1 WHEN r.force OR h.started_at < now_at - INTERVAL '400' DAY THEN h.attempt + 1 ELSE h.attempt END AS INTEGER) AS attempt FROM req r LEFT JOIN have h USING (job_id, volume_id, etag), task_clock""",
)
def claims(e) -> DataFrame:
    """Every task is asked for again, and every volume for a new job."""
    key = ["job_id", "volume_id", "etag"]
    asked = e.tasks.select(*key).distinct().withColumn("force", F.col("volume_id") % 10 == 0)
    asked = asked.unionByName(e.volumes.select(F.lit(99).alias("job_id"), "volume_id", F.col("last_etag").alias("etag"), F.lit(False).alias("force")))
    have = latest_per_key(e.tasks, key, F.desc("id")).select(*key, "id", "attempt", "started_at")
    old = F.expr("started_at < now_at - INTERVAL '400' DAY")
    decision = F.when(F.col("id").isNull(), "claim").when(F.col("force"), "force").when(old, "stale").otherwise("skip")
    attempt = F.when(F.col("id").isNull(), 1).when(F.col("force") | old, F.col("attempt") + 1).otherwise(F.col("attempt"))
    return asked.join(have, key, "left").join(F.broadcast(e.task_clock)).select(*key, decision.alias("decision"), attempt.cast("int").alias("attempt"))  # one row of a clock


@query(
    "m07_m08_mark_results",
    """WITH res AS (SELECT id, CASE WHEN id % 3 = 0 THEN 'done' WHEN id % 3 = 1 THEN 'retryable_failed' ELSE 'terminal_failed' END AS to_status, 40 AS images FROM tasks WHERE status = 'running')
    SELECT t.id, coalesce(r.to_status, t.status) AS status, CASE WHEN r.to_status = 'done' THEN r.images ELSE t.total_images END AS total_images FROM tasks t LEFT JOIN res r USING (id)""",
)
def mark(e) -> DataFrame:
    r = F.col("id") % 3
    results = e.tasks.where("status = 'running'").select("id", F.when(r == 0, "done").when(r == 1, "retryable_failed").otherwise("terminal_failed").alias("to_status"), F.lit(40).alias("images"))
    done = F.col("s.to_status") == "done"
    return merge_snapshot(e.tasks.select("id", "status", "total_images"), results, ["id"], {"status": F.col("s.to_status"), "total_images": F.when(done, F.col("s.images")).otherwise(F.col("t.total_images"))})


@query("m09_job_admin", """WITH j AS (SELECT job_id, job_name, CASE job_id WHEN 2 THEN '{"a": 1}' ELSE '{}' END AS config, CASE job_id WHEN 4 THEN 'queue-new' ELSE 'queue-' || job_id END AS queue_url, CASE job_id WHEN 5 THEN 'dlq-new' END AS dlq_url FROM jobs WHERE job_id <> 3
    UNION ALL SELECT (SELECT max(job_id) FROM jobs) + 1, 'fresh', '{"b": 2}', 'queue-fresh', NULL) SELECT job_id, job_name, config, queue_url, dlq_url, (SELECT count(*) FROM tasks t WHERE t.job_id = j.job_id) AS tasks FROM j""")
def job_admin(e) -> DataFrame:
    """A job is added, one configured anew, two get other queues, and one goes with its tasks; then all jobs with what is left of their tasks."""
    jobs = e.jobs.select("job_id", "job_name", F.lit("{}").alias("config"), F.concat(F.lit("queue-"), F.col("job_id").cast("string")).alias("queue_url"), F.lit(None).cast("string").alias("dlq_url"))
    jobs = admin.created(jobs, "fresh", "queue-fresh", '{"b": 2}')
    jobs = admin.configured(jobs, 2, '{"a": 1}')
    jobs = admin.requeued(admin.requeued(jobs, 4, queue_url="queue-new"), 5, dlq_url="dlq-new")
    jobs, tasks = admin.deleted(jobs, e.tasks, 3)
    left = tasks.groupBy("job_id").agg(F.count("*").alias("tasks"))
    return jobs.join(left, "job_id", "left").na.fill(0, ["tasks"])


@query(
    "m10_claim_decision",
    """SELECT id, CASE WHEN id % 6 = 0 AND NOT f THEN 'skip_ack' WHEN NOT present THEN 'claim' WHEN f THEN 'force' WHEN old THEN 'stale' ELSE 'skip_ack' END AS decision, present AND NOT f AND NOT old AND status = 'retryable_failed' AND id % 6 <> 0 AS needs_redrive
    FROM (SELECT id, status, id % 4 <> 0 AS present, id % 9 = 0 AS f, coalesce(started_at < now_at - INTERVAL '700' DAY, false) AS old FROM tasks, task_clock)""",
)
def decide(e) -> DataFrame:
    d = e.tasks.join(F.broadcast(e.task_clock)).select("id", "status", (F.col("id") % 6 == 0).alias("marker"), (F.col("id") % 4 != 0).alias("present"), (F.col("id") % 9 == 0).alias("force"), F.expr("coalesce(started_at < now_at - INTERVAL '700' DAY, false)").alias("old"))
    return d.select("id", claim_decision().alias("decision"), F.expr("present and not force and not old and status = 'retryable_failed' and not marker").alias("needs_redrive"))


def claim_decision():
    """What becomes of a task message, from (marker, present, old, force): one expression, the same in batch and stream."""
    marker, present, force, old = (F.col(c) for c in ("marker", "present", "force", "old"))
    return F.when(marker & ~force, "skip_ack").when(~present, "claim").when(force, "force").when(old, "stale").otherwise("skip_ack")


@query("j17_ready_by_upstream", "SELECT DISTINCT volume_id FROM tasks WHERE job_id = 2 AND volume_id IN (SELECT volume_id FROM tasks WHERE job_id = 1 AND status = 'done')")
def ready(e) -> DataFrame:
    return e.tasks.where("job_id = 2").select("volume_id").distinct().join(e.tasks.where("job_id = 1 and status = 'done'"), "volume_id", "left_semi")
