"""Structured Streaming forms of re-ingest, state changes, stale jobs, status counts and sessions.

Rows later than the watermark are dropped; that is new against the batch forms, which see
all rows.
"""

from __future__ import annotations

import itertools
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from ..functions.folders import kept
from ..functions.text import cleanup_text, rebuild_paragraphs, text_quality
from ..operators.index import update_index


def ingest_pages(pages: DataFrame, *, event_time: str = "at", late: str = "10 minutes") -> DataFrame:
    """Each (document_id, page_number) once within the watermark, with clean text and its quality."""
    once = pages.withWatermark(event_time, late).dropDuplicatesWithinWatermark(["document_id", "page_number"])
    clean = once.withColumn("text", cleanup_text(rebuild_paragraphs(F.col("raw_text"))))
    return clean.withColumn("quality_score", text_quality(F.col("text")))


#: Folders that documents are dealt to by a hash, so that a batch reads those of its documents only.
BUCKETS = 64


def _bucket() -> Column:
    return F.pmod(F.xxhash64("document_id"), F.lit(BUCKETS)).cast("int")


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """(document_id, version): which version of each document holds. A version counts once its manifest is complete."""
    if not _exists(spark, f"{path}/manifest"):
        return spark.createDataFrame([], "document_id string, version long")
    return spark.read.schema("document_id string, version long").parquet(f"{path}/manifest/*").groupBy("document_id").agg(F.max("version").alias("version"))


def current_pages(spark: SparkSession, path: str, schema: str | StructType, *, buckets: list[int] | None = None, documents: DataFrame | None = None) -> DataFrame:
    """The pages that hold, of all documents or of those given; buckets prunes the folders that are read."""
    fields = spark.createDataFrame([], schema).schema
    if not _exists(spark, f"{path}/pages"):
        return spark.createDataFrame([], fields)
    stored = spark.read.schema(StructType([*fields, StructField("bucket", IntegerType()), StructField("version", LongType())])).parquet(f"{path}/pages")
    if buckets is not None:
        stored = stored.filter(F.col("bucket").isin(buckets))
    holding = manifest(spark, path)
    if documents is not None:
        holding = holding.join(documents.select("document_id").distinct(), "document_id", "left_semi")
    return stored.join(holding, ["document_id", "version"]).select(fields.names)


def merge_pages(batch: DataFrame, path: str, version: int) -> int:
    """Store a batch of pages as a version and return how many documents it changed.

    A document's version is whole: its pages that hold now, replaced and completed by those
    of the batch (of two rows for one page the last by `at`, where there is one, then by
    text). Pages are written first, then the manifest of the version, in one step: a replayed
    version finds its manifest and does nothing, and one that was broken off is written again.
    """
    spark = batch.sparkSession
    done = f"{path}/manifest/{version}"
    if _exists(spark, f"{done}/_SUCCESS"):
        return 0
    rank = Window.partitionBy("document_id", "page_number").orderBy(*[F.desc(c) for c in ("at", "text") if c in batch.columns])
    batch = kept(batch.withColumn("__n", F.row_number().over(rank)).filter("__n = 1").drop("__n"), "batch")
    buckets = [r.b for r in batch.select(_bucket().alias("b")).distinct().collect()]  # at most BUCKETS numbers
    before = current_pages(spark, path, batch.schema, buckets=buckets, documents=batch)
    whole = batch.unionByName(before.join(batch.select("document_id", "page_number"), ["document_id", "page_number"], "left_anti"))
    dealt = whole.withColumns({"bucket": _bucket(), "version": F.lit(version).cast("long")})
    writer = dealt.repartition("bucket").sortWithinPartitions("bucket", "document_id", "page_number").write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "version").parquet(f"{path}/pages")
    changed = batch.select("document_id").distinct().withColumn("version", F.lit(version).cast("long"))
    changed.write.mode("overwrite").parquet(done)
    return spark.read.parquet(done).count()


def changed_documents(spark: SparkSession, path: str, after: int) -> DataFrame:
    """Documents whose version is later than `after`: what an index must take in anew."""
    return manifest(spark, path).filter(F.col("version") > after)


def write_pages(pages: DataFrame, path: str, checkpoint: str, *, index: str | None = None):
    """Run a stream of pages into a store of versions, one a batch; with index, keep that index in step.

    Pages of a document from earlier batches stay. A replayed batch changes nothing in the
    store, and indexing its documents again gives the same index.
    """

    def write(batch: DataFrame, version: int) -> None:
        merge_pages(batch, path, version)
        if index:
            spark = batch.sparkSession
            changed = manifest(spark, path).filter(F.col("version") == version)
            buckets = [r.b for r in changed.select(_bucket().alias("b")).distinct().collect()]
            rows = current_pages(spark, path, batch.schema, buckets=buckets, documents=changed)
            rag = rows.select(F.concat_ws(":", "document_id", F.lit("page"), "page_number").alias("rag_id"), F.lit("").alias("title"), "text")
            update_index(spark, index, rag)

    return pages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).start()


def state_changes(sightings: DataFrame, *, entity: str, order: str, value: str, late: str = "10 minutes") -> DataFrame:
    """entity, at, previous, new, change_type for each sighting whose value differs from the one before it.

    The state of an entity is its last time and value alone.
    """
    kind = sightings.schema[entity].dataType.simpleString()
    rows = sightings.select(F.col(entity).alias("entity"), F.col(order).alias("at"), F.col(value).cast("string").alias("value")).withWatermark("at", late)

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get if state.exists else (None, None)
        out = []
        every = pd.concat(list(frames)).sort_values(["at", "value"], kind="stable")
        for at, now in zip(every["at"], every["value"], strict=True):
            micros = at.value // 1000
            if last[0] is not None and micros < last[0]:
                continue
            if last[0] is None:
                out.append((key[0], at, None, now, "introduced"))
            elif now != last[1]:
                out.append((key[0], at, last[1], now, "updated"))
            last = (micros, now)
        if last[0] is not None:
            state.update(last)
        yield pd.DataFrame(out, columns=["entity", "at", "previous", "new", "change_type"])

    return rows.groupBy("entity").applyInPandasWithState(step, f"entity {kind}, at timestamp, previous string, new string, change_type string", "at long, value string", "append", GroupStateTimeout.NoTimeout)


def stale_jobs(updates: DataFrame, *, minutes: int, job: str = "job_id", event_time: str = "updated_at", late: str = "1 minute") -> DataFrame:
    """job, last_update of in-flight jobs once event time has passed their last update by so many minutes."""
    kind = updates.schema[job].dataType.simpleString()
    rows = updates.select(F.col(job).alias("job"), F.col(event_time).alias("at"), "status").withWatermark("at", late)

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        none = pd.DataFrame({"job": [], "last_update": pd.to_datetime([])})
        if state.hasTimedOut:
            at = pd.Timestamp(state.get[0], unit="ms")
            state.remove()
            yield pd.DataFrame({"job": [key[0]], "last_update": [at]})
            return
        every = pd.concat(list(frames)).sort_values(["at", "status"], kind="stable")
        last = every.iloc[-1]
        at = int(last["at"].timestamp() * 1000)
        if last["status"] in ("running", "processing"):
            state.update((at,))
            state.setTimeoutTimestamp(max(at + minutes * 60_000, state.getCurrentWatermarkMs() + 1))
        elif state.exists:
            state.remove()
        yield none

    return rows.groupBy("job").applyInPandasWithState(step, f"job {kind}, last_update timestamp", "at long", "append", GroupStateTimeout.EventTimeTimeout)


class _Changes(StatefulProcessor):
    """State of one entity: a map of its attributes' values, and the sightings that the watermark has not passed."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.values = handle.getMapState("values", "attribute string", "told array<string>")
        self.waiting = handle.getValueState("waiting", "rows string, seen boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        fresh = []
        for frame in rows:
            for at, scene, bucket, attribute, value in zip(frame["at"], frame["scene"], frame["bucket"], frame["attribute"], frame["value"], strict=True):
                name = None if pd.isna(attribute) or pd.isna(value) else f"{bucket}.{attribute}"
                fresh.append([at.value // 1000, scene, name, None if name is None else value])
        yield from self.settle(key, fresh, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self.settle(key, [], timerValues)

    def settle(self, key, fresh: list, timers) -> Iterator[pd.DataFrame]:
        """Take in all sightings up to the watermark in order, whatever batches they came in."""
        mark = timers.getCurrentWatermarkInMs() * 1000
        rows, seen = [], False
        if self.waiting.exists():
            held, seen = self.waiting.get()
            rows = json.loads(held)
        rows = sorted(rows + fresh, key=lambda r: (r[0], str(r[1]), r[2] or "", r[3] or ""))
        due = [r for r in rows if r[0] <= mark]
        out = []
        # each call on the state is a message to the JVM: it is read once and only what differs in the end is written
        before = {k[0]: list(v[0]) for k, v in self.values.iterator()} if due else {}
        last = dict(before)
        for (at, scene), told in itertools.groupby(due, key=lambda r: (r[0], r[1])):
            now: dict[str, list[str]] = {}
            for *_, name, value in told:
                if name is not None and value not in now.setdefault(name, []):
                    now[name].append(value)
            for name in sorted({*now, *last}):
                old, new = last.get(name), sorted(now[name]) if name in now else None
                kind = "introduced" if old is None else "removed" if new is None else "carried" if old == new else "updated"
                out.append((key[0], pd.Timestamp(at, unit="us"), scene, name, old, new, kind, not seen))
                if new is None:
                    del last[name]
                else:
                    last[name] = new
            seen = True
        for name in before.keys() - last.keys():
            self.values.removeKey((name,))
        for name, new in last.items():
            if before.get(name) != new:
                self.values.updateValue((name,), (new,))
        left = rows[len(due) :]
        self.waiting.update((json.dumps(left), seen))
        if left:
            self.handle.registerTimer(left[0][0] // 1000 + 1)
        if out:
            yield pd.DataFrame(out, columns=["entity", "at", "scene", "attribute", "previous", "new", "change_type", "first"])

    def close(self) -> None:
        pass


ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def attribute_changes(sightings: DataFrame, *, entity: str, order: str, scene: str, late: str = "10 minutes") -> DataFrame:
    """entity, at, scene, attribute, previous, new, change_type, first: what each sighting tells of each attribute against the one before.

    sightings: a row for each fact of a sighting (entity, order, scene, bucket, attribute,
    value); a sighting without facts is a row without attribute. change_type is introduced,
    carried, updated or removed; `first` marks an entity's first sighting, of which the batch
    form `continuity.state_changes` tells nothing. A sighting is settled once the watermark has passed
    it, by a timer if no later row comes, so the batches in which rows arrive make no difference. The
    session's state store must be RocksDB (`ROCKS`).
    """
    kind = sightings.schema
    rows = sightings.select(F.col(entity).alias("entity"), F.col(order).alias("at"), F.col(scene).alias("scene"), "bucket", "attribute", "value").withWatermark("at", late)
    out = f"entity {kind[entity].dataType.simpleString()}, at timestamp, scene {kind[scene].dataType.simpleString()}, attribute string, previous array<string>, new array<string>, change_type string, first boolean"
    return rows.groupBy("entity").transformWithStateInPandas(_Changes(), out, "Append", "EventTime")


def status_counts(updates: DataFrame, *, event_time: str, period: str, slide: str | None = None, late: str = "10 minutes", status: str = "status") -> DataFrame:
    """Window start, status and count; sliding with slide."""
    span = F.window(event_time, period, slide) if slide else F.window(event_time, period)
    return updates.withWatermark(event_time, late).groupBy(span.alias("w"), status).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), status, "n")


def session_counts(updates: DataFrame, *, event_time: str, gap: str, key: str, late: str = "10 minutes") -> DataFrame:
    """key, start, stop and count of its sessions: rows that follow each other within `gap`. stop is the last row's time plus gap.

    A session is told once the watermark has passed its stop; rows that come later than the
    watermark are dropped and open no session of their own.
    """
    span = F.session_window(event_time, gap)
    counted = updates.withWatermark(event_time, late).groupBy(span.alias("w"), key).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(key, F.col("w.start").alias("start"), F.col("w.end").alias("stop"), "n")
