"""Binds the domain's entities to the star-schema tables: control tables, page artifacts, boxes, units, messages and vectors.

The text of a binding is plain SQL that Spark and other engines read alike, so that a query and its check start from the same rows.
"""

from __future__ import annotations

import os
import re
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

SQL: dict[str, str] = {
    "line_counts": """SELECT l_orderkey, count(*) AS n, sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS errs FROM {lineitem} GROUP BY l_orderkey""",
    "jobs": """SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS INT) AS job_id, substr(o_orderpriority, 3) AS job_name FROM {orders}""",
    "volumes": """SELECT c_custkey AS volume_id, concat('W', CAST(c_nationkey AS STRING)) AS w_id, concat('I', lpad(CAST(c_custkey AS STRING), 6, '0')) AS i_id,
        md5(c_name) AS last_etag, CAST(c_custkey % 400 AS INT) AS nb_images, 0 AS nb_images_intro FROM {customer}""",
    "workers": """SELECT s.s_suppkey + 1 AS worker_id, concat('worker-', CAST(s.s_suppkey % 20 AS STRING)) AS worker_name, h.last_seen AS last_heartbeat_at,
        CASE WHEN s.s_suppkey % 7 = 0 THEN h.last_seen END AS stopped_at
        FROM {supplier} s LEFT JOIN (SELECT user_id, max(ts) AS last_seen FROM {events} GROUP BY user_id) h ON h.user_id = s.s_suppkey + 1""",
    "tasks": """SELECT o.o_orderkey AS id, CAST(substr(o.o_orderpriority, 1, 1) AS INT) AS job_id, o.o_custkey AS volume_id,
        CASE WHEN o.o_orderkey % 5 = 0 THEN md5(concat(c.c_name, '-old')) ELSE md5(c.c_name) END AS etag,
        CASE WHEN o.o_orderstatus = 'F' THEN 'done' WHEN o.o_orderstatus = 'O' THEN 'running' WHEN o.o_orderkey % 2 = 0 THEN 'retryable_failed' ELSE 'terminal_failed' END AS status,
        CAST(1 + o.o_orderkey % 3 AS INT) AS attempt, CASE WHEN o.o_orderkey % 17 = 0 THEN NULL ELSE o.o_orderkey % 97 + 1 END AS worker_id, o.o_orderdate AS started_at,
        CASE WHEN o.o_orderstatus <> 'O' THEN o.o_orderdate + CAST(o.o_orderkey % 600 AS INT) * INTERVAL '1' SECOND END AS done_at,
        CASE WHEN o.o_orderstatus = 'F' THEN l.n * 10 END AS total_images, CASE WHEN o.o_orderstatus = 'F' THEN l.errs END AS nb_errors,
        CASE WHEN o.o_orderstatus = 'F' THEN o.o_totalprice END AS total_ms, CASE WHEN o.o_orderstatus = 'F' THEN o.o_totalprice / (l.n * 10) END AS page_ms
        FROM {orders} o JOIN {customer} c ON c.c_custkey = o.o_custkey LEFT JOIN {line_counts} l ON l.l_orderkey = o.o_orderkey""",
    "event_clock": """SELECT max(ts) AS now_at FROM {events}""",
    "task_clock": """SELECT max(o_orderdate) AS now_at FROM {orders}""",
    "page_output": """SELECT doc_id AS page_id, source AS volume, lang, concat('p', lpad(CAST(doc_id AS STRING), 8, '0'), '.jpg') AS file, text AS page_text, doc_id % 23 <> 0 AS ok,
        CASE WHEN doc_id % 23 = 0 THEN CASE WHEN doc_id % 2 = 0 THEN 'Decode' ELSE 'Inference' END END AS error_stage,
        CASE WHEN doc_id % 23 = 0 THEN concat('[', CASE WHEN doc_id % 2 = 0 THEN 'Decode' ELSE 'Inference' END, '] ', CASE WHEN doc_id % 3 = 0 THEN 'TimeoutError' ELSE 'ValueError' END, ': page ', CAST(doc_id AS STRING)) END AS error_message FROM {documents}""",
    "classes": """SELECT d.doc_id AS page_id, CASE WHEN d.doc_id % 11 = 0 THEN 'error' ELSE 'ok' END AS status, CASE WHEN l.quality = 0 THEN 'blank' ELSE d.lang END AS label,
        CASE WHEN d.doc_id % 13 = 0 THEN NULL ELSE CAST(d.doc_id % 100 AS DOUBLE) / 100 END AS prob FROM {documents} d JOIN {labels} l ON l.doc_id = d.doc_id""",
    "boxes": """SELECT l_orderkey AS page_id, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) - 1 AS INT) AS idx,
        CAST(l_partkey * 13 % 800 AS INT) AS x, CAST(l_suppkey * 37 % 1000 AS INT) AS y, CAST(20 + l_quantity * 4 AS INT) AS w, CAST(10 + l_linenumber * 12 AS INT) AS h, CAST(l_linenumber % 4 AS INT) AS cls,
        CASE l_returnflag WHEN 'R' THEN ' Text-Area ' WHEN 'A' THEN '' ELSE NULL END AS label, CAST(l_discount * 10 AS DOUBLE) AS conf FROM {lineitem}""",
    "regions": """SELECT page_id, idx, coalesce(nullif(lower(trim(label)), ''), CASE cls WHEN 0 THEN 'header' WHEN 1 THEN 'text-area' WHEN 2 THEN 'footnote' WHEN 3 THEN 'footer' ELSE '' END) AS label,
        greatest(0, x - CAST(w / 2 AS INT)) AS x1, greatest(0, y - CAST(h / 2 AS INT)) AS y1, least(800, x + CAST(w / 2 AS INT)) AS x2, least(1000, y + CAST(h / 2 AS INT)) AS y2 FROM {boxes}""",
    "units": """SELECT conv_id AS page_id, turn AS unit, role, text FROM {conversations}""",
    "messages": """SELECT event_id AS message_id, ts AS sent_at, user_id AS worker_id, event_type AS kind, value, props AS body FROM {events}""",
    "vectors": """SELECT vec_id AS step_id, label AS line_id, embedding AS logits FROM {embeddings}""",
}


def with_entities(sql: str) -> str:
    """The query with all entities before it as common table expressions."""
    plain = {n: n for n in (*BASE, *SQL)}
    return "WITH " + ",\n".join(f"{name} AS ({text.format(**plain)})" for name, text in SQL.items()) + "\n" + re.sub(r"^\s*WITH\s+(RECURSIVE\s+)?", ", ", sql, count=1) if not re.match(r"\s*WITH\s+RECURSIVE", sql) else "WITH RECURSIVE " + ",\n".join(f"{name} AS ({text.format(**plain)})" for name, text in SQL.items()) + "\n" + re.sub(r"^\s*WITH\s+RECURSIVE\s+", ", ", sql, count=1)


class Entities:
    """The entities of a folder of tables, as attributes; each is a lazy DataFrame, so only what a query uses is planned."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def _made(self) -> dict[str, DataFrame]:
        return {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in BASE and name not in SQL:
            raise AttributeError(name)
        made = self._made
        if name not in made:
            if name in BASE:
                made[name] = self.spark.read.parquet(os.path.join(self.sf_dir, f"{name}.parquet"))
            else:
                uses = {n: getattr(self, n) for n in set(re.findall(r"\{(\w+)\}", SQL[name]))}
                made[name] = self.spark.sql(SQL[name], **uses)
        return made[name]
