"""Incremental jobs: each runs the batch operators on what is new and ends when nothing is left (``availableNow``)."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.utils import AnalysisException

from ..operators.lifecycle import compensate, compensation_audit, mark_stale, match_deletes, purge, without_tombstones
from ..sources.tables import register_raw


def _written(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """A table of the shared folder, or None if nothing has been written yet."""
    try:
        return spark.read.parquet(path) if schema is None else spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER" not in str(e):
            raise
        return None


def _drain(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


#: Hexadecimal digits of a content hash that its key is filed under.
SHARD_DIGITS = 2


def ingest_new(stream: DataFrame, target: str, checkpoint: str, tombstones: DataFrame | None = None) -> None:
    """Registers raw content that ``target`` (Parquet, by batch number and shard of the hash) has not; purged content is passed over.

    The table of registered keys, not stream state, says what is known, so nothing grows without bound. A
    batch reads the keys of its own hashes' shards alone, so its cost does not grow with the table while it is small
    against 16 ** SHARD_DIGITS. A batch that is run again after a failure replaces its own folder.
    """

    def each(batch: DataFrame, number: int) -> None:
        own = batch if "content_hash" in batch.columns else batch.withColumn("content_hash", F.sha2(F.col("content").cast("binary"), 256))
        known = known_keys(own, target, number)
        new = register_raw(batch, known)
        if tombstones is not None:
            new = without_tombstones(new, tombstones)
        new.withColumn("shard", _shard()).repartition("shard").write.mode("overwrite").partitionBy("shard").parquet(f"{target}/batch={number}")

    _drain(stream, each, checkpoint)


def _shard() -> Column:
    # With a letter in front, as a reader would take digits alone for numbers.
    return F.concat(F.lit("h"), F.substring("content_hash", 1, SHARD_DIGITS))


def known_keys(batch: DataFrame, target: str, number: int) -> DataFrame | None:
    """Registered keys of the shards that a batch (with ``content_hash``) touches, from all other batches; None if nothing is written yet. At most 16 ** SHARD_DIGITS shards reach the driver, to name partitions."""
    known = _written(batch.sparkSession, target)
    if known is None:
        return None
    touched = [r[0] for r in batch.select(_shard()).distinct().collect()]
    return known.filter(F.col("shard").isin(touched) & (F.col("batch") != number))


# ---- the change feed -------------------------------------------------------------------------------


def _files(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _live(spark: SparkSession, target: str) -> tuple[int, dict]:
    """Number and content of the newest list of live folders: ``base`` and ``batches``."""
    fs, at = _files(spark, f"{target}/lists")
    if not fs.exists(at):
        return 0, {"base": None, "upto": -1, "batches": {}}
    number = max((int(f.getPath().getName()) for f in fs.listStatus(at) if f.getPath().getName().isdigit()), default=0)
    if not number:
        return 0, {"base": None, "upto": -1, "batches": {}}
    rows = spark.read.text(f"{target}/lists/{number}", wholetext=True).collect()  # one short file
    return number, json.loads(rows[0][0])


def _publish(spark: SparkSession, target: str, number: int, live: dict) -> None:
    """Makes a list the newest: it is written aside and renamed, so a reader sees the old list or the whole new one."""
    fs, aside = _files(spark, f"{target}/lists/.{uuid.uuid4().hex}")
    out = fs.create(aside)
    out.write(bytearray(json.dumps(live).encode()))
    out.close()
    if not fs.rename(aside, _files(spark, f"{target}/lists/{number}")[1]):
        raise RuntimeError(f"another writer has published list {number} of {target}")


def apply_changes(stream: DataFrame, target: str, checkpoint: str, key: str = "remote_id", order: str = "seq") -> None:
    """Takes in a feed of upserts, deletes and resets (``op, key, order, ...``): a batch's last change of each key is written to a folder of its own; the checkpoint is the cursor.

    A row with op ``full`` and no key begins a full listing: it ends every key that has no change after it.
    A batch costs what it holds; the table is what ``newest_version`` folds from the folders that the newest list names.
    The list is published when a batch's folder is complete, so a batch that stops half-way changes nothing, and one that is run again takes its own place.
    """

    def each(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        at, live = _live(spark, target)
        if number <= live["upto"]:
            return  # folded into the base already
        folder = f"batch-{number}-{uuid.uuid4().hex}"
        _last(batch.filter(f"{key} IS NOT NULL OR op = 'full'"), key, order).write.parquet(f"{target}/{folder}")
        _publish(spark, target, at + 1, {**live, "batches": {**live["batches"], str(number): folder}})

    _drain(stream, each, checkpoint)


def _last(changes: DataFrame, key: str, order: str) -> DataFrame:
    """The change of each key that is last in ``order``, whenever it came; a partial maximum on each task."""
    rest = [c for c in changes.columns if c not in (key, order)]
    return changes.groupBy(key).agg(F.max(F.struct(order, *rest)).alias("r")).select(key, "r.*")


def _folded(spark: SparkSession, target: str, live: dict, key: str, order: str) -> DataFrame:
    """The last change of each key, deletes and the last reset among them, without what the reset ended."""
    folders = [f for f in [live["base"], *live["batches"].values()] if f]
    rows = _last(spark.read.parquet(*[f"{target}/{f}" for f in folders]), key, order)
    reset = rows.filter("op = 'full'").agg(F.max(order).alias("_reset"), F.lit(1).alias("_one"))
    # One row, by a key of one value: a null there (no reset) keeps everything.
    return rows.withColumn("_one", F.lit(1)).join(F.broadcast(reset), "_one").filter(F.col("_reset").isNull() | (F.col(order) >= F.col("_reset"))).drop("_one", "_reset")


def newest_version(spark: SparkSession, target: str, key: str = "remote_id", order: str = "seq") -> DataFrame:
    """The table after the batches so far: the last change of each key by ``order``, so an older one that came late changes nothing; keys that it deletes, or that the last full listing has not, are not there."""
    return _folded(spark, target, _live(spark, target)[1], key, order).filter("op NOT IN ('delete', 'full')").drop("op")


def compact_changes(spark: SparkSession, target: str, key: str = "remote_id", order: str = "seq") -> list[str]:
    """Folds the batches so far into one base folder and publishes the list that names it alone. Deletes stay in it, so that older changes which come later stay without effect.

    Returns the folders that the new list no longer names; readers of the list before may still need them.
    """
    at, live = _live(spark, target)
    if not live["batches"]:
        return []
    folder = f"base-{uuid.uuid4().hex}"
    _folded(spark, target, live, key, order).write.parquet(f"{target}/{folder}")
    _publish(spark, target, at + 1, {"base": folder, "upto": max(map(int, live["batches"])), "batches": {}})
    return [f for f in [live["base"], *live["batches"].values()] if f]


def apply_deletes(stream: DataFrame, documents: DataFrame, target: str, checkpoint: str, order: str = "seq") -> None:
    """The deletes of a change feed, matched with the ``documents`` (``document_id, remote_id``) that they end.

    A batch writes the documents it ends to its own folder, by batch number, and does no more: what follows from them is
    a function of all folders (see ``after_deletes``). So a batch that is run again replaces its own, and changes nothing else.
    A delete that a later change of the same batch takes back has no effect.
    """

    def each(batch: DataFrame, number: int) -> None:
        last = _last(batch.filter("remote_id IS NOT NULL"), "remote_id", order)
        gone = match_deletes(last, documents).select("document_id").distinct()
        gone.write.mode("overwrite").parquet(f"{target}/batch={number}")

    _drain(stream, each, checkpoint)


def after_deletes(spark: SparkSession, target: str, tables: dict[str, DataFrame], reason: str = "delta_delete") -> dict[str, DataFrame]:
    """The tables ``documents, tombstones, chunks, mentions, stale`` after all deletes so far, and the ``audit`` of what they did.

    Documents are purged and leave tombstones, their chunks lose embeddings, their mentions go, their projects' pages are marked stale.
    """
    gone = spark.read.schema(tables["documents"].select("document_id").schema).parquet(target).select("document_id").distinct()
    documents, tombstones, audit = purge(tables["documents"], tables["tombstones"], gone, reason)
    chunks, mentions = compensate(tables["chunks"], tables["mentions"], audit)
    counted = compensation_audit(tables["chunks"], tables["mentions"], audit).drop("action")
    return {
        "documents": documents, "tombstones": tombstones, "chunks": chunks, "mentions": mentions,
        "stale": mark_stale(tables["stale"], audit), "audit": audit.join(counted, "document_id"),
    }


# ---- document states -------------------------------------------------------------------------------


ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Fold(StatefulProcessor):
    """The state of one document: the last event's number and state. Purged is for good, so a purged document leaves its row in the table and no state."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.now = handle.getValueState("now", "seq long, state string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        (seq, state), n = (self.now.get() if self.now.exists() else (-1, "")), 0
        for frame in rows:
            n += len(frame)
            for s, v in sorted(zip(frame["seq"].tolist(), frame["state"])):
                if state != "purged" and (v == "purged" or s > seq):
                    state = v
                seq = max(seq, s)
        if state == "purged":
            self.now.clear()
        else:
            self.now.update((int(seq), state))
        yield pd.DataFrame([(key[0], int(seq), state, n)], columns=["document_id", "seq", "state", "n_events"])

    def close(self) -> None:
        pass


def track_states(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Follows each document through a stream of state events (``document_id, seq, state``), with the same guards as the batch fold: later wins, purged is for good.

    A row for each document of a batch goes to ``target``. State is kept for open documents only, in RocksDB: one that ends leaves
    its row in the table. ``tracked`` folds the rows by number, so an event that comes after the end changes a count and no more.
    (No timers: with processing time a run that should end when nothing is left would never end.)
    """
    kind = dict(stream.dtypes)["document_id"]
    conf, name = stream.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(name, None)
    conf.set(name, ROCKS)  # the operator needs it; a query keeps what is set when it starts
    try:
        folded = stream.groupBy("document_id").transformWithStateInPandas(Fold(), f"document_id {kind}, seq long, state string, n_events long", "Update", "None")

        def each(batch: DataFrame, number: int) -> None:
            batch.write.mode("overwrite").parquet(f"{target}/batch={number}")

        folded.writeStream.outputMode("update").foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    finally:
        conf.set(name, before) if before else conf.unset(name)


def tracked(spark: SparkSession, target: str) -> DataFrame:
    """``document_id, state, n_events`` after the batches of ``track_states``."""
    rows = spark.read.parquet(target)
    state = F.when(F.max((F.col("state") == "purged").cast("int")) == 1, "purged").otherwise(F.max_by("state", F.struct("seq", "batch")))
    return rows.groupBy("document_id").agg(state.alias("state"), F.sum("n_events").alias("n_events"))
