"""Administration of jobs and look-ups: each function gives the next snapshot, or an error where nothing matches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def found(df: DataFrame, what: str, number: str, name: str, ident: str | int) -> DataFrame:
    """The row of a number, or of a name if ``ident`` isn't one; LookupError if there is none. Of several rows of a name the one with the greatest number counts."""
    text = str(ident)
    hit = df.where(F.col(number) == int(text)) if text.isdigit() else df.where(F.col(name) == text).orderBy(F.desc(number)).limit(1)
    if hit.isEmpty():
        raise LookupError(f"{what} {text} not found")
    return hit


def created(jobs: DataFrame, name: str, queue_url: str, config: str = "{}", dlq_url: str | None = None) -> DataFrame:
    """Adds a job under the next number; a name that is taken is an error."""
    if not jobs.where(F.col("job_name") == name).isEmpty():
        raise ValueError(f"job {name} exists")
    row = {"job_name": F.lit(name), "config": F.lit(config), "queue_url": F.lit(queue_url), "dlq_url": F.lit(dlq_url)}
    new = jobs.agg((F.coalesce(F.max("job_id"), F.lit(0)) + 1).alias("job_id")).withColumns(row)
    return jobs.unionByName(new.select(*[F.col(f.name).cast(f.dataType).alias(f.name) if f.name in new.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in jobs.schema]))


def _changed(jobs: DataFrame, job_id: int, values: dict[str, str]) -> DataFrame:
    found(jobs, "job", "job_id", "job_name", job_id)
    return jobs.withColumns({c: F.when(F.col("job_id") == job_id, v).otherwise(F.col(c)) for c, v in values.items()})


def configured(jobs: DataFrame, job_id: int, config: str) -> DataFrame:
    return _changed(jobs, job_id, {"config": config})


def requeued(jobs: DataFrame, job_id: int, queue_url: str | None = None, dlq_url: str | None = None) -> DataFrame:
    """Other queues for a job; what isn't given stays, and with nothing given nothing is looked up."""
    values = {c: v for c, v in (("queue_url", queue_url), ("dlq_url", dlq_url)) if v is not None}
    return _changed(jobs, job_id, values) if values else jobs


def deleted(jobs: DataFrame, tasks: DataFrame, job_id: int) -> tuple[DataFrame, DataFrame]:
    """(jobs, tasks) without a job and its tasks."""
    found(jobs, "job", "job_id", "job_name", job_id)
    return jobs.where(F.col("job_id") != job_id), tasks.where(F.col("job_id").isNull() | (F.col("job_id") != job_id))
