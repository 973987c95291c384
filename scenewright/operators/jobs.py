"""Tables of jobs, queues, providers and assets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

STATUSES = ["pending", "validated", "review", "approved", "rejected"]
IN_FLIGHT = ["running", "processing"]


def autofill(contexts: DataFrame, queue: DataFrame, job_type: str, n: int, *, keys: list[str], order: list[str]) -> DataFrame:
    """The first n contexts without a queued or completed job of the type."""
    busy = queue.filter((F.col("job_type") == job_type) & F.col("status").isin("queued", "completed")).select(*keys).distinct()
    return contexts.join(busy, keys, "left_anti").orderBy(*order).limit(n)


def enqueue(queue: DataFrame, requests: DataFrame, *, keys: list[str]) -> DataFrame:
    """queue with new requests: one row per key, a row that is there wins, then the request of least id."""
    new = requests.join(queue.select(*keys), keys, "left_anti")
    first = new.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy("id"))).filter("__n = 1").drop("__n")
    return queue.unionByName(first, allowMissingColumns=True)


def spread(scenes: DataFrame, base, minutes: int, *, group: str, order: str) -> DataFrame:
    """scenes with scheduled_at: the i-th of its group at base + i intervals, in order of the whole number `order`."""
    from ..functions.ranges import numbered

    return numbered(scenes, group, order, "place").withColumn("scheduled_at", F.lit(base).cast("timestamp") + F.make_dt_interval(mins=(F.col("place") - 1) * minutes))


def due(queue: DataFrame, now, n: int, *, when: str = "scheduled_at", id_col: str = "id") -> DataFrame:
    """The first n queued rows whose time has come."""
    return queue.filter((F.col("status") == "queued") & (F.col(when) <= F.lit(now))).orderBy(when, id_col).limit(n)


def retry(queue: DataFrame, max_attempts: int) -> DataFrame:
    """Rows after a failure: failed once attempts reach the limit, else queued again with one more attempt."""
    over = F.col("attempts") >= max_attempts
    return queue.withColumns({"status": F.when(over, "failed").otherwise("queued"), "attempts": F.when(over, F.col("attempts")).otherwise(F.col("attempts") + 1)})


def recover_stale(queue: DataFrame, now, minutes: int, *, updated: str = "updated_at") -> DataFrame:
    """queue with in-flight rows that have not been updated for so long queued again; recovered marks them."""
    stale = F.col("status").isin(IN_FLIGHT) & (F.col(updated) < F.lit(now).cast("timestamp") - F.expr(f"INTERVAL {minutes} MINUTES"))
    return queue.withColumns({"recovered": stale, "status": F.when(stale, "queued").otherwise(F.col("status"))})


def rank_providers(providers: DataFrame, routing: DataFrame, *, max_cost: float, allow_paid: bool) -> DataFrame:
    """media_type, rank, name: the routed order of providers that are enabled, fit, within quota and cost; where none is, free ones by priority."""
    fits = (F.col("enabled")) & (F.coalesce("quota", F.lit(1)) != 0) & (F.col("cost") <= max_cost) & (F.lit(allow_paid) | (F.col("cost") == 0))
    able = providers.select("name", "priority", "cost", "enabled", "quota", F.explode("media_types").alias("media_type"))
    asked = routing.select("media_type", F.posexplode("names").alias("place", "name"))
    chosen = asked.join(able.filter(fits), ["media_type", "name"]).select("media_type", "name", F.col("place").cast("long").alias("place"))
    free = able.filter(F.col("enabled") & (F.col("cost") == 0)).join(chosen.select("media_type").distinct(), "media_type", "left_anti").select("media_type", "name", (F.col("priority") + 1000).cast("long").alias("place"))
    w = Window.partitionBy("media_type").orderBy("place", "name")
    return chosen.unionByName(free).withColumn("rank", F.row_number().over(w)).select("media_type", "rank", "name")


def provider_by_priority(providers: DataFrame) -> DataFrame:
    """media_type, name: the enabled provider of least priority number, then name."""
    able = providers.filter("enabled").select("name", "priority", F.explode("media_types").alias("media_type"))
    return able.groupBy("media_type").agg(F.min_by("name", F.struct("priority", "name")).alias("name"))


def register_assets(jobs: DataFrame, assets: DataFrame) -> DataFrame:
    """assets with a pending one for each completed job that has none."""
    new = jobs.filter("status = 'completed'").join(assets.select("job_id"), "job_id", "left_anti").select("job_id", F.lit("pending").alias("status"))
    return assets.unionByName(new, allowMissingColumns=True)


def transitions(assets: DataFrame, requests: DataFrame, *, key: str = "asset_id") -> DataFrame:
    """requests (key, wanted) with accepted and reason: the target must be known, and approval needs validated or approved."""
    met = requests.join(assets.select(key, "status"), key, "left")
    reason = F.when(F.col("status").isNull(), "unknown_asset").when(~F.col("wanted").isin(STATUSES), "unknown_status").when((F.col("wanted") == "approved") & ~F.col("status").isin("validated", "approved"), "not_validated")
    return met.withColumn("reason", reason).withColumn("accepted", F.col("reason").isNull())


def inspect(assets: DataFrame) -> DataFrame:
    return assets.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def health(queue: DataFrame, *, group: str, statuses: list[str]) -> DataFrame:
    """One row a group with a count for each status."""
    return queue.groupBy(group).pivot("status", statuses).agg(F.count(F.lit(1))).fillna(0)


def health_report(queue: DataFrame, assets: DataFrame, used: DataFrame, *, kind: str = "media_type") -> DataFrame:
    """kind, area, status, n of each media type: jobs by status, assets by status and in total, and how often a provider was used."""
    by_status = lambda df, area: df.groupBy(kind, "status").agg(F.count(F.lit(1)).alias("n")).select(kind, F.lit(area).alias("area"), "status", "n")
    whole = lambda df, area, name: df.groupBy(kind).agg(F.count(F.lit(1)).alias("n")).select(kind, F.lit(area).alias("area"), F.lit(name).alias("status"), "n")
    return by_status(queue, "queue").unionByName(by_status(assets, "assets")).unionByName(whole(assets, "assets", "total")).unionByName(whole(used, "usage", "records"))


def usage(rows: DataFrame, *, day_limit: float) -> DataFrame:
    """Cost by day against the limit."""
    return rows.groupBy(F.to_date("at").alias("day")).agg(F.sum("cost").alias("cost")).withColumn("over_limit", F.col("cost") > day_limit)


def upsert_jobs(jobs: DataFrame, incoming: DataFrame, *, keys: list[str], updated: str = "updated_at", id_col: str = "id") -> DataFrame:
    """The newest row of each key; of equal times the larger id."""
    w = Window.partitionBy(*keys).orderBy(F.desc(updated), F.desc(id_col))
    return jobs.unionByName(incoming, allowMissingColumns=True).withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")
