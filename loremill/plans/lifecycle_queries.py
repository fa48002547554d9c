"""Queries: tombstones, purge, reconcile, cleanup, states, run log, streams, and scalar functions."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import ids, splitting, text as X
from ..operators import graph, lifecycle, search
from ..operators.components import cut, job_dir
from ..sources import tables
from ..streaming import jobs
from . import base
from .base import CHUNKS_SQL, DOCS_SQL, LINKED_SQL, PROJECT_SQL, RAW_SQL, project, query, strip, table, uuid5
from .graph_queries import chunks_and_mentions, mentions
from .ingest_queries import RAW_KEY_SQL

#: Purged content: what the labels call toxic. Documents to purge: what they call bad.
DEAD_SQL = "dead AS (SELECT DISTINCT tenant, project_id, content_hash FROM raw JOIN labels USING (doc_id) WHERE toxic = 1)"
WANTED_SQL = f"wanted AS (SELECT DISTINCT {base.doc_id()} AS document_id FROM raw JOIN labels USING (doc_id) WHERE quality = 0)"


def dead(spark: SparkSession, sf: str) -> DataFrame:
    labels = table(spark, sf, "labels").filter("toxic = 1").select("doc_id").distinct()
    return base.raw(spark, sf).join(labels, "doc_id", "left_semi").select(*lifecycle.CONTENT).distinct()


def wanted(spark: SparkSession, sf: str) -> DataFrame:
    labels = table(spark, sf, "labels").filter("quality = 0").select("doc_id").distinct()
    return base.raw(spark, sf).join(labels, "doc_id", "left_semi").select(ids.document_id("tenant", "project_id", "content_hash").alias("document_id")).distinct()


@query("j1_tombstone_gate", f"WITH {DOCS_SQL}, {DEAD_SQL} SELECT document_id FROM docs ANTI JOIN dead USING (tenant, project_id, content_hash)")
def j1(spark: SparkSession, sf: str) -> DataFrame:
    return lifecycle.without_tombstones(base.docs(spark, sf), dead(spark, sf)).select("document_id")


@query("j2_active_chunks", f"WITH {CHUNKS_SQL} SELECT chunk_id FROM chunks JOIN docs USING (document_id) WHERE ingest_state NOT IN ('purged', 'purging')")
def j2(spark: SparkSession, sf: str) -> DataFrame:
    return lifecycle.active_chunks(base.chunks(spark, sf), base.docs(spark, sf)).select("chunk_id")


@query("j3_reconcile", f"WITH {CHUNKS_SQL} SELECT chunk_id FROM chunks JOIN docs USING (document_id) WHERE ingest_state IN ('purged', 'purging')")
def j3(spark: SparkSession, sf: str) -> DataFrame:
    c = base.chunks(spark, sf)
    return lifecycle.reconcile(c, lifecycle.active_chunks(c, base.docs(spark, sf)))


@query("j3_reconcile_report", f"WITH {CHUNKS_SQL}, a AS (SELECT count(DISTINCT chunk_id) AS n FROM chunks JOIN docs USING (document_id) WHERE ingest_state NOT IN ('purged', 'purging')) SELECT count(DISTINCT chunk_id) AS indexed, any_value(a.n) AS active, count(DISTINCT chunk_id) - any_value(a.n) AS orphans FROM chunks, a")
def j3_report(spark: SparkSession, sf: str) -> DataFrame:
    c = base.chunks(spark, sf)
    return lifecycle.reconcile_report(c, lifecycle.active_chunks(c, base.docs(spark, sf)))


@query("u3_index_difference", f"WITH {CHUNKS_SQL} SELECT text_hash FROM chunks EXCEPT SELECT text_hash FROM chunks WHERE tenant = 'en'")
def u3(spark: SparkSession, sf: str) -> DataFrame:
    c = base.chunks(spark, sf).select("tenant", F.col("text_hash").alias("chunk_id"))
    return lifecycle.reconcile(c, c.filter("tenant = 'en'")).select(F.col("chunk_id").alias("text_hash"))


@query("j4_orphan_raw", f"WITH {DOCS_SQL} SELECT {RAW_KEY_SQL} AS key FROM raw WHERE project_id = {PROJECT_SQL} AND content_hash NOT IN (SELECT content_hash FROM docs WHERE ingest_state NOT IN ('purged', 'pending') AND project_id = {PROJECT_SQL})")
def j4(spark: SparkSession, sf: str) -> DataFrame:
    """Raw keys of a project whose documents, purged or not yet registered, have no row."""
    keys = base.raw(spark, sf).select(tables.artifact_key("raw").alias("key"))
    return lifecycle.orphan_raw(keys, base.docs(spark, sf).filter("ingest_state NOT IN ('purged', 'pending')"), project()).select("key")


MANIFESTS_SQL = "lines AS (SELECT 'batches/' || tenant || '/b' || doc_id % 16 || '/manifest.jsonl' AS key, document_id, ingest_state FROM docs)"


def manifest_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Each document as a line of one of its tenant's batch manifests."""
    batch = (F.col("doc_id") % 16).cast("string")
    return base.docs(spark, sf).select(F.concat(F.lit("batches/"), "tenant", F.lit("/b"), batch, F.lit("/manifest.jsonl")).alias("key"), "document_id")


STALE_MANIFESTS_SQL = "SELECT key FROM lines GROUP BY key HAVING bool_and(ingest_state IN ('purged', 'purging'))"


@query("j4_stale_manifests", f"WITH {DOCS_SQL}, {MANIFESTS_SQL} {STALE_MANIFESTS_SQL}")
def j4_manifests(spark: SparkSession, sf: str) -> DataFrame:
    return lifecycle.stale_manifests(manifest_lines(spark, sf), base.docs(spark, sf))


@query(
    "j4_cleanup_report",
    f"""WITH {DOCS_SQL}, {MANIFESTS_SQL}, c AS (SELECT 'stale_manifest' AS kind, key FROM ({STALE_MANIFESTS_SQL})
  UNION ALL SELECT 'orphan_raw', {RAW_KEY_SQL} FROM raw WHERE project_id = {PROJECT_SQL} AND content_hash NOT IN (SELECT content_hash FROM docs WHERE ingest_state NOT IN ('purged', 'pending') AND project_id = {PROJECT_SQL}))
SELECT kind, count(*) AS candidate_count, 0::BIGINT AS deleted_count, array_to_string(list_sort(list(key))[1:50], ' ') AS shown FROM c GROUP BY kind""",
)
def j4_report(spark: SparkSession, sf: str) -> DataFrame:
    """The dry run of a cleanup: how many there are of both kinds, and the first fifty."""
    keys = base.raw(spark, sf).select(tables.artifact_key("raw").alias("key"))
    known = base.docs(spark, sf)
    raw = lifecycle.orphan_raw(keys, known.filter("ingest_state NOT IN ('purged', 'pending')"), project()).select(F.lit("orphan_raw").alias("kind"), "key")
    stale = lifecycle.stale_manifests(manifest_lines(spark, sf), known).select(F.lit("stale_manifest").alias("kind"), "key")
    return lifecycle.cleanup_report(raw.unionByName(stale)).withColumn("shown", F.array_join("shown", " "))


@query("j14_stale_pages", "SELECT c_custkey AS id, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P') AS stale FROM customer")
def j14(spark: SparkSession, sf: str) -> DataFrame:
    from .retrieval import with_stale

    hits = table(spark, sf, "customer").select(F.col("c_custkey").alias("community_id"))
    stale = table(spark, sf, "orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("community_id"), F.lit(True).alias("stale"))
    return with_stale(hits, stale).select(F.col("community_id").alias("id"), "stale")


@query("j16_delete_match", f"WITH {DOCS_SQL} SELECT document_id FROM docs WHERE doc_id IN (SELECT user_id FROM events WHERE event_type = 'error')")
def j16(spark: SparkSession, sf: str) -> DataFrame:
    changes = table(spark, sf, "events").select(F.when(F.col("event_type") == "error", "delete").otherwise("upsert").alias("op"), F.col("user_id").alias("remote_id"))
    return lifecycle.match_deletes(changes, base.docs(spark, sf).withColumn("remote_id", F.col("doc_id"))).select("document_id")


@query("a8_project_rows", f"WITH {LINKED_SQL} SELECT 'documents' AS table_name, count(*) AS n FROM docs WHERE project_id = {PROJECT_SQL} UNION ALL SELECT 'chunks', count(*) FROM chunks WHERE project_id = {PROJECT_SQL} UNION ALL SELECT 'mentions', count(*) FROM mentions WHERE project_id = {PROJECT_SQL}")
def a8(spark: SparkSession, sf: str) -> DataFrame:
    c = base.chunks(spark, sf)
    m = mentions(spark, sf).join(c.select("chunk_id", "project_id"), "chunk_id")
    return lifecycle.project_rows(project(), documents=base.docs(spark, sf), chunks=c, mentions=m)


@query("l1_compensate", f"WITH {LINKED_SQL}, {WANTED_SQL} SELECT 'chunk' AS kind, count(*) AS n, count(*) FILTER (document_id NOT IN (SELECT document_id FROM wanted)) AS kept FROM chunks UNION ALL SELECT 'mention', count(*), count(*) FILTER (chunk_id NOT IN (SELECT chunk_id FROM chunks WHERE document_id IN (SELECT document_id FROM wanted))) FROM mentions")
def l1(spark: SparkSession, sf: str) -> DataFrame:
    c, m = chunks_and_mentions(spark, sf)
    after, left = lifecycle.compensate(c.withColumn("embedding", F.lit(1.0)), m.select("chunk_id", "entity_id"), wanted(spark, sf))
    one = after.agg(F.count(F.lit(1)).alias("n"), F.count("embedding").alias("kept")).select(F.lit("chunk").alias("kind"), "n", "kept")
    both = m.select(F.lit(1).alias("before"), F.lit(0).alias("after")).unionByName(left.select(F.lit(0).alias("before"), F.lit(1).alias("after")))
    return one.unionByName(both.agg(F.sum("before").alias("n"), F.sum("after").alias("kept")).select(F.lit("mention").alias("kind"), "n", "kept"))


@query(
    "l1_compensation_audit",
    f"""WITH {LINKED_SQL}, {WANTED_SQL}, e AS (SELECT chunk_id, count(*) AS m FROM mentions GROUP BY 1)
SELECT w.document_id, 'compensation' AS action, count(c.chunk_id) AS chunk_count, count(c.chunk_id) FILTER (c.chunk_index % 2 = 0) AS embeddings_cleared, coalesce(sum(m), 0)::BIGINT AS mentions_deleted
FROM wanted w LEFT JOIN chunks c ON w.document_id = c.document_id LEFT JOIN e ON c.chunk_id = e.chunk_id GROUP BY 1""",
)
def l1_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Every other chunk has an embedding to clear."""
    c, m = chunks_and_mentions(spark, sf, ["chunk_index"])
    c = c.withColumn("embedding", F.when(F.col("chunk_index") % 2 == 0, 1.0))
    return lifecycle.compensation_audit(c, m.select("chunk_id", "entity_id"), wanted(spark, sf))


@query(
    "l1_pruned_entities",
    f"""WITH {LINKED_SQL}, {WANTED_SQL}, kept AS (SELECT entity_id FROM mentions WHERE chunk_id NOT IN (SELECT chunk_id FROM chunks WHERE document_id IN (SELECT document_id FROM wanted)))
SELECT DISTINCT entity_id AS id, name FROM mentions WHERE entity_id NOT IN (SELECT entity_id FROM kept)""",
)
def l1_pruned(spark: SparkSession, sf: str) -> DataFrame:
    """Entities that only compensated documents mention: orphans once their mentions are gone, as no edge names them."""
    c, m = chunks_and_mentions(spark, sf)
    _, left = lifecycle.compensate(c.withColumn("embedding", F.lit(1.0)), m.select("chunk_id", "entity_id"), wanted(spark, sf))
    _, named, _ = graph.mention_tables(m)
    none = left.select(F.col("entity_id").alias("source"), F.col("entity_id").alias("target")).filter("source <> target")
    return graph.orphan_entities(named.withColumnRenamed("entity_id", "id"), left, none).select("id", "name")


@query(
    "l2_purge_project",
    f"WITH {DOCS_SQL}, w AS (SELECT document_id FROM docs WHERE project_id = {PROJECT_SQL} AND ingest_state NOT IN ('purged', 'purging')) SELECT document_id, CASE WHEN document_id IN (SELECT document_id FROM w) THEN 'purged' ELSE ingest_state END AS ingest_state FROM docs",
)
def l2_project(spark: SparkSession, sf: str) -> DataFrame:
    d = base.docs(spark, sf)
    none = d.filter("false").select(*lifecycle.CONTENT, "document_id", F.lit("").alias("reason"))
    after, _, _ = lifecycle.purge(d, none, lifecycle.wanted_of(d, project()), "project_purge")
    return after.select("document_id", "ingest_state")


@query(
    "l2_stale_marks",
    f"""WITH {DOCS_SQL}, {WANTED_SQL}, s AS (SELECT DISTINCT tenant, project_id, 'c1' AS community_id FROM docs WHERE tenant = 'en')
SELECT * FROM s UNION ALL SELECT tenant, project_id, min(document_id) FROM docs WHERE ingest_state <> 'purged' AND document_id IN (SELECT document_id FROM wanted) AND (tenant, project_id) NOT IN (SELECT (tenant, project_id) FROM s) GROUP BY 1, 2""",
)
def l2_stale(spark: SparkSession, sf: str) -> DataFrame:
    """English projects have a stale community already; the others that lose documents get a mark each."""
    d = cut(base.docs(spark, sf))
    none = d.filter("false").select(*lifecycle.CONTENT, "document_id", F.lit("").alias("reason"))
    _, _, audit = lifecycle.purge(d, none, wanted(spark, sf), "quality")
    stale = d.filter("tenant = 'en'").select("tenant", "project_id", F.lit("c1").alias("community_id")).distinct()
    return lifecycle.mark_stale(stale, audit)


@query("l2_purge", f"WITH {DOCS_SQL}, {WANTED_SQL} SELECT document_id, CASE WHEN document_id IN (SELECT document_id FROM wanted) THEN 'purged' ELSE ingest_state END AS ingest_state, document_id IN (SELECT document_id FROM wanted) AND ingest_state <> 'purged' AS audited FROM docs")
def l2(spark: SparkSession, sf: str) -> DataFrame:
    d = base.docs(spark, sf)
    none = d.filter("false").select(*lifecycle.CONTENT, "document_id", F.lit("").alias("reason"))
    after, graves, audit = lifecycle.purge(d, none, wanted(spark, sf), "quality")
    return after.join(audit.select("document_id", F.lit(True).alias("audited")), "document_id", "left").select("document_id", "ingest_state", F.coalesce("audited", F.lit(False)).alias("audited"))


@query("l2_tombstones", f"WITH {DOCS_SQL}, {WANTED_SQL}, {DEAD_SQL} SELECT tenant, project_id, content_hash FROM dead UNION SELECT tenant, project_id, content_hash FROM docs WHERE ingest_state <> 'purged' AND document_id IN (SELECT document_id FROM wanted)")
def l2_graves(spark: SparkSession, sf: str) -> DataFrame:
    old = dead(spark, sf).select(*lifecycle.CONTENT, F.lit("").alias("document_id"), F.lit("old").alias("reason"))
    _, graves, _ = lifecycle.purge(base.docs(spark, sf), old, wanted(spark, sf), "quality")
    return graves.select(*lifecycle.CONTENT)


@query("l3_hard_delete", f"WITH {DOCS_SQL} SELECT document_id FROM docs WHERE project_id <> {PROJECT_SQL}")
def l3(spark: SparkSession, sf: str) -> DataFrame:
    return base.docs(spark, sf).filter(F.col("project_id") != project()).select("document_id")


@query("l4_restore", f"WITH {DOCS_SQL}, {WANTED_SQL} SELECT document_id, CASE WHEN document_id IN (SELECT document_id FROM wanted) THEN 'pending' ELSE ingest_state END AS restored, CASE WHEN document_id IN (SELECT document_id FROM wanted) AND ingest_state NOT IN ('purged', 'purging') THEN 'pending' ELSE ingest_state END AS reingested, document_id IN (SELECT document_id FROM wanted) AND ingest_state IN ('purged', 'purging') AS refused FROM docs")
def l4(spark: SparkSession, sf: str) -> DataFrame:
    d, w = base.docs(spark, sf), wanted(spark, sf)
    after, _ = lifecycle.restored(d, dead(spark, sf), w)
    again = lifecycle.reingest(d, w).select("document_id", F.col("ingest_state").alias("reingested"), "refused")
    return after.select("document_id", F.col("ingest_state").alias("restored")).join(again, "document_id")


@query("l5_mark_indexed", f"WITH {DOCS_SQL}, {WANTED_SQL} SELECT document_id, CASE WHEN hit THEN 'indexed_graph' ELSE ingest_state END AS ingest_state, CASE WHEN hit THEN TIMESTAMP '2024-01-01' END AS graph_at FROM (SELECT *, document_id IN (SELECT document_id FROM wanted) AND ingest_state NOT IN ('purged', 'purging') AS hit FROM docs)")
def l5(spark: SparkSession, sf: str) -> DataFrame:
    d = base.docs(spark, sf).withColumn("graph_at", F.lit(None).cast("timestamp_ntz"))
    return lifecycle.mark_indexed(d, wanted(spark, sf), "indexed_graph", ["graph_at"], F.lit("2024-01-01").cast("timestamp_ntz")).select("document_id", "ingest_state", "graph_at")


RUNS_SQL = "runs AS (SELECT 't' AS tenant, event_id AS id, strftime(ts, '%Y%m%d-%H%M%S') AS batch_id, CASE event_type WHEN 'purchase' THEN 'Succeeded' WHEN 'error' THEN 'Failed' ELSE 'Running' END AS status, CASE WHEN event_type <> 'view' THEN ts::TIMESTAMP END AS started_at, user_id FROM events)"


def runs(spark: SparkSession, sf: str) -> DataFrame:
    status = F.when(F.col("event_type") == "purchase", "Succeeded").when(F.col("event_type") == "error", "Failed").otherwise("Running")
    return table(spark, sf, "events").select(
        F.lit("t").alias("tenant"), F.col("event_id").alias("id"), F.date_format("ts", "yyyyMMdd-HHmmss").alias("batch_id"), status.alias("status"),
        F.when(F.col("event_type") != "view", F.col("ts").cast("timestamp")).alias("started_at"), "user_id",
    )


@query("w6_latest_runs", f"WITH {RUNS_SQL} SELECT user_id, max(id) AS id, arg_max(status, id) AS status FROM runs GROUP BY 1")
def w6(spark: SparkSession, sf: str) -> DataFrame:
    own = runs(spark, sf).withColumn("batch_id", F.col("user_id").cast("string"))
    return lifecycle.latest_runs(own).select("user_id", "id", "status")


@query("w7_run_listing", f"WITH {RUNS_SQL} SELECT id, n FROM (SELECT id, row_number() OVER (ORDER BY coalesce(date_trunc('second', started_at), strptime(batch_id, '%Y%m%d-%H%M%S')) DESC NULLS LAST, id DESC) AS n FROM runs) WHERE n <= 50")
def w7(spark: SparkSession, sf: str) -> DataFrame:
    own = runs(spark, sf).withColumn("started_at", F.date_trunc("second", "started_at"))
    top = own.orderBy(*lifecycle.run_order()).limit(50)
    from pyspark.sql import Window

    return top.withColumn("n", F.row_number().over(Window.orderBy(*lifecycle.run_order()))).select("id", "n")


@query("w8_chunk_order", f"WITH {CHUNKS_SQL} SELECT document_id, string_agg(chunk_id, ',' ORDER BY chunk_index) AS chunk_ids FROM chunks GROUP BY 1")
def w8(spark: SparkSession, sf: str) -> DataFrame:
    lists = base.chunks(spark, sf).groupBy("document_id").agg(F.sort_array(F.collect_list(F.struct("chunk_index", "chunk_id"))).alias("c"))
    return lists.select("document_id", F.array_join(F.transform("c", lambda x: x["chunk_id"]), ",").alias("chunk_ids"))


@query("w4_heading_carried", f"WITH {DOCS_SQL}, l AS (SELECT document_id, unnest(string_split(content, chr(10))) AS line, generate_subscripts(string_split(content, chr(10)), 1) AS pos FROM docs) SELECT document_id, pos, sha256(coalesce(last_value(CASE WHEN length(line) < 60 AND line <> '' THEN line END IGNORE NULLS) OVER (PARTITION BY document_id ORDER BY pos ROWS UNBOUNDED PRECEDING), '')) AS heading FROM l")
def w4(spark: SparkSession, sf: str) -> DataFrame:
    """Short lines stand for headings; each line gets the last one so far."""
    from pyspark.sql import Window

    rows = base.docs(spark, sf).select("document_id", F.posexplode(F.split("content", "\n")).alias("k", "line"))
    w = Window.partitionBy("document_id").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    short = F.when((F.char_length("line") < 60) & (F.col("line") != ""), F.col("line"))
    return rows.select("document_id", (F.col("k") + 1).cast("long").alias("pos"), ids.text_hash(F.coalesce(F.last(short, ignorenulls=True).over(w), F.lit(""))).alias("heading"))


@query("k5_newest_tombstones", f"WITH {RAW_SQL}, t AS (SELECT tenant, project_id, content_hash, max(doc_id) AS deleted_at FROM raw JOIN labels USING (doc_id) WHERE toxic = 1 GROUP BY ALL) SELECT content_hash, deleted_at FROM t ORDER BY deleted_at DESC, tenant, project_id, content_hash LIMIT 50")
def k5(spark: SparkSession, sf: str) -> DataFrame:
    """Tombstones of toxic content, in order of the last document that had it."""
    toxic = table(spark, sf, "labels").filter("toxic = 1").select("doc_id").distinct()
    graves = base.raw(spark, sf).join(toxic, "doc_id", "left_semi").groupBy(*lifecycle.CONTENT).agg(F.max("doc_id").alias("deleted_at"))
    return lifecycle.newest(graves, "deleted_at", lifecycle.CONTENT, 50).select("content_hash", "deleted_at")


@query("l6_run_log", "SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'F' THEN 'Failed' WHEN l.l_orderkey IS NOT NULL THEN 'Succeeded' ELSE 'Running' END AS status, o_custkey AS batch FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R') l ON o_orderkey = l_orderkey")
def l6(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as runs, returns as the messages that end them; ended ones stay ended."""
    old = table(spark, sf, "orders").select(F.lit("t").alias("tenant"), F.col("o_orderkey").alias("id"), F.when(F.col("o_orderstatus") == "F", "Failed").otherwise("Running").alias("status"), F.col("o_custkey").alias("batch"), F.lit(None).cast("timestamp").alias("ended_at"))
    new = table(spark, sf, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("id")).distinct()
    new = new.join(old.select("id"), "id", "left_semi").select(F.lit("t").alias("tenant"), "id", F.lit("Succeeded").alias("status"), F.lit(None).cast("long").alias("batch"), F.lit(None).cast("timestamp").alias("ended_at"))
    return lifecycle.merge_runs(old, new).select("id", "status", "batch")


@query("l6_active_runs", f"WITH {RUNS_SQL} SELECT user_id, count(*) AS n FROM runs WHERE status NOT IN ('Succeeded', 'Failed') GROUP BY 1")
def l6_active(spark: SparkSession, sf: str) -> DataFrame:
    return lifecycle.active_runs(runs(spark, sf)).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))


# ---- streams ----------------------------------------------------------------------------------------


def _fresh(spark: SparkSession) -> str:
    return f"{job_dir(spark)}/streams/{uuid.uuid4().hex}"


@query("t1_incremental_ingest", f"WITH {RAW_SQL}, {DEAD_SQL}, k AS (SELECT tenant, project_id, source_id, content_hash, min(filename) AS filename FROM raw GROUP BY ALL) SELECT {base.doc_id()} AS document_id, filename FROM k ANTI JOIN dead USING (tenant, project_id, content_hash)")
def t1(spark: SparkSession, sf: str) -> DataFrame:
    """The documents as a stream of files; known and purged content is passed over. Run twice: the second run finds nothing new."""
    root = _fresh(spark)
    base.raw(spark, sf).select("tenant", "project_id", "source_id", "filename", "content").write.parquet(f"{root}/in")
    graves = cut(dead(spark, sf))
    for _ in range(2):
        stream = spark.readStream.schema(spark.read.parquet(f"{root}/in").schema).parquet(f"{root}/in")
        jobs.ingest_new(stream, f"{root}/out", f"{root}/at", graves)
    return spark.read.parquet(f"{root}/out").select("document_id", "filename")


@query("s1_t1_binary_files", "SELECT sha256(s_name || chr(10)) AS content_hash, octet_length(encode(s_name)) + 1 AS size, s_name || chr(10) AS text FROM supplier")
def t1_files(spark: SparkSession, sf: str) -> DataFrame:
    """Names of suppliers as files, taken in as a stream of bytes; the register's keys are met with the files again."""
    root = _fresh(spark)
    tables.write_each(table(spark, sf, "supplier").select("s_name"), f"{root}/in", 4 * spark.sparkContext.defaultParallelism)
    who = (F.lit("t"), F.lit("p"), F.lit("s"))
    files = lambda reader: reader.format("binaryFile").schema(tables.FILES).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").load(f"{root}/in")
    jobs.ingest_new(tables.file_content(files(spark.readStream), *who), f"{root}/out", f"{root}/at")
    keys = spark.read.parquet(f"{root}/out").select("content_hash")
    return tables.file_content(files(spark.read), *who).join(keys, "content_hash").select("content_hash", F.col("size").cast("int").alias("size"), "text")


CHANGES_SQL = "changes AS (SELECT CASE WHEN event_type = 'error' THEN 'delete' ELSE 'upsert' END AS op, user_id AS remote_id, event_id AS seq, value FROM events)"


def _changes(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(F.when(F.col("event_type") == "error", "delete").otherwise("upsert").alias("op"), F.col("user_id").alias("remote_id"), F.col("event_id").alias("seq"), "value")


@query("t2_change_feed", f"WITH {CHANGES_SQL} SELECT remote_id, seq, value FROM (SELECT *, row_number() OVER (PARTITION BY remote_id ORDER BY seq DESC) AS n FROM changes) WHERE n = 1 AND op <> 'delete'")
def t2(spark: SparkSession, sf: str) -> DataFrame:
    """Events as a feed of upserts and deletes in two batches; the second has older changes among the newer ones, which must not undo them."""
    root = _fresh(spark)
    own = _changes(spark, sf)
    for k in range(2):
        own.filter(F.pmod(F.xxhash64("seq"), F.lit(2)) == k).write.parquet(f"{root}/in/part={k}")
        stream = spark.readStream.schema(own.schema).parquet(f"{root}/in/part=*")
        jobs.apply_changes(stream, f"{root}/out", f"{root}/at")
    return jobs.newest_version(spark, f"{root}/out").select("remote_id", "seq", "value")


RESET_SQL = "f AS (SELECT max(seq) * 2 // 3 AS at_ FROM changes)"


@query("t2_full_listing", f"WITH {CHANGES_SQL}, {RESET_SQL} SELECT remote_id, seq, value FROM (SELECT *, row_number() OVER (PARTITION BY remote_id ORDER BY seq DESC) AS n FROM changes), f WHERE n = 1 AND op <> 'delete' AND seq >= at_")
def t2_full(spark: SparkSession, sf: str) -> DataFrame:
    """Three batches in no order of their changes, with the beginning of a full listing in the second; the first two are compacted before the third comes."""
    root = _fresh(spark)
    own = _changes(spark, sf)
    reset = own.agg(F.lit("full").alias("op"), F.lit(None).cast("long").alias("remote_id"), F.floor(F.max("seq") * 2 / 3).cast("long").alias("seq"), F.lit(None).cast("double").alias("value"))
    for k in range(3):
        part = own.filter(F.pmod(F.xxhash64("seq"), F.lit(3)) == k)
        (part.unionByName(reset) if k == 1 else part).write.parquet(f"{root}/in/part={k}")
        jobs.apply_changes(spark.readStream.schema(own.schema).parquet(f"{root}/in/part=*"), f"{root}/out", f"{root}/at")
        if k == 1:
            jobs.compact_changes(spark, f"{root}/out")
    return jobs.newest_version(spark, f"{root}/out").select("remote_id", "seq", "value")


@query(
    "l2_delta_deletes",
    f"""WITH {LINKED_SQL}, {CHANGES_SQL}, mid AS (SELECT max(seq) // 2 AS at_ FROM changes),
gone AS (SELECT DISTINCT remote_id FROM (SELECT *, row_number() OVER (PARTITION BY remote_id, seq <= at_ ORDER BY seq DESC) AS n FROM changes, mid) WHERE n = 1 AND op = 'delete'),
hit AS (SELECT document_id FROM docs WHERE doc_id IN (SELECT remote_id FROM gone) AND ingest_state <> 'purged'),
e AS (SELECT chunk_id, count(*) AS m FROM mentions GROUP BY 1),
a AS (SELECT h.document_id, count(c.chunk_id) AS chunk_count, coalesce(sum(m), 0)::BIGINT AS mentions_deleted FROM hit h LEFT JOIN chunks c ON h.document_id = c.document_id LEFT JOIN e ON c.chunk_id = e.chunk_id GROUP BY 1)
SELECT d.document_id, CASE WHEN a.document_id IS NULL THEN ingest_state ELSE 'purged' END AS ingest_state, coalesce(chunk_count, 0)::BIGINT AS cleared, coalesce(mentions_deleted, 0)::BIGINT AS mentions_deleted FROM docs d LEFT JOIN a ON d.document_id = a.document_id""",
)
def l2_deletes(spark: SparkSession, sf: str) -> DataFrame:
    """Deletes of a feed in two batches, carried through to documents, chunks and mentions."""
    root = _fresh(spark)
    own = _changes(spark, sf)
    mid = own.agg(F.max("seq")).first()[0] // 2
    known = cut(base.docs(spark, sf).withColumn("remote_id", F.col("doc_id")))
    for k, part in enumerate((own.filter(F.col("seq") <= mid), own.filter(F.col("seq") > mid))):
        part.write.parquet(f"{root}/in/part={k}")
        jobs.apply_deletes(spark.readStream.schema(own.schema).parquet(f"{root}/in/part=*"), known, f"{root}/gone", f"{root}/at")
    c, m = chunks_and_mentions(spark, sf)
    given = {
        "documents": known, "tombstones": known.filter("false").select(*lifecycle.CONTENT, "document_id", F.lit("").alias("reason")),
        "chunks": c.withColumn("embedding", F.lit(1.0)), "mentions": m.select("chunk_id", "entity_id"),
        "stale": known.filter("false").select("tenant", "project_id", F.lit("").alias("community_id")),
    }
    after = jobs.after_deletes(spark, f"{root}/gone", given)
    sums = after["audit"].select("document_id", "embeddings_cleared", "mentions_deleted")
    none = F.lit(0).cast("long")
    return after["documents"].join(sums, "document_id", "left").select("document_id", "ingest_state", F.coalesce("embeddings_cleared", none).alias("cleared"), F.coalesce("mentions_deleted", none).alias("mentions_deleted"))


STATES_SQL = "ev AS (SELECT user_id AS document_id, event_id AS seq, CASE event_type WHEN 'purchase' THEN 'indexed_graph' WHEN 'error' THEN CASE WHEN value > 200 THEN 'purged' ELSE 'dead_letter' END WHEN 'view' THEN 'indexed_rag' ELSE 'pending' END AS state FROM events)"


def state_events(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    state = F.when(kind == "purchase", "indexed_graph").when(kind == "error", F.when(F.col("value") > 200, "purged").otherwise("dead_letter")).when(kind == "view", "indexed_rag").otherwise("pending")
    return table(spark, sf, "events").select(F.col("user_id").alias("document_id"), F.col("event_id").alias("seq"), state.alias("state"))


FOLDED_SQL = f"WITH {STATES_SQL} SELECT document_id, CASE WHEN bool_or(state = 'purged') THEN 'purged' ELSE arg_max(state, seq) END AS state, count(*) AS n_events FROM ev GROUP BY 1"


@query("t3_state_fold", FOLDED_SQL)
def t3_batch(spark: SparkSession, sf: str) -> DataFrame:
    return lifecycle.folded_states(state_events(spark, sf))


@query("t3_state_tracking", FOLDED_SQL)
def t3(spark: SparkSession, sf: str) -> DataFrame:
    root = _fresh(spark)
    own = state_events(spark, sf).filter("document_id IS NOT NULL")
    own.write.parquet(f"{root}/in")
    jobs.track_states(spark.readStream.schema(own.schema).parquet(f"{root}/in"), f"{root}/out", f"{root}/at")
    return jobs.tracked(spark, f"{root}/out")


# ---- scalar functions ---------------------------------------------------------------------------------


@query(
    "x1_identifiers",
    f"WITH {RAW_SQL} SELECT doc_id, content_hash, {base.doc_id()} AS document_id, {uuid5("'entity:' || filename")} AS entity, {uuid5("'entity:' || filename")} AS named_ref, {uuid5("tenant || ':' || project_id || ':b:0:' || filename")} AS community FROM raw",
)
def x1(spark: SparkSession, sf: str) -> DataFrame:
    r = base.raw(spark, sf)
    return r.select("doc_id", "content_hash", ids.document_id("tenant", "project_id", "content_hash").alias("document_id"), ids.entity_id(F.concat(F.lit(" "), "filename")).alias("entity"), ids.entity_ref(F.concat(F.lit("entity:"), "filename")).alias("named_ref"), ids.community_id("tenant", "project_id", F.lit("b"), F.lit(0), "filename").alias("community"))


def _slug_sql(x: str) -> str:
    return f"nullif(trim(regexp_replace(lower({x}), '[^a-z0-9_-]+', '_', 'g'), '_'), '')"


@query(
    "x2_x6_names_and_paths",
    f"""SELECT page_id, {_slug_sql('url')} AS slug, 'kb_' || {_slug_sql('url')} || '_' || {_slug_sql("split_part(url, '/', 3)")} AS namespace,
 rtrim(substr(trim(regexp_replace(regexp_replace({strip('url')}, '[/\\\\]+', '-', 'g'), '\\s+', '-', 'g'), '-'), 1, 60), '-') AS segment,
 '/wiki/' || replace({strip('url')}, '/', '-') || '/' AS mount, list_last(string_split(url, '/')) AS last FROM pages""",
)
def x2(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "pages")
    return p.select("page_id", X.slug_of_name("url").alias("slug"), X.namespace_of("url", F.split_part("url", F.lit("/"), F.lit(3))).alias("namespace"), X.path_segment("url").alias("segment"), X.mount_path("url", F.lit("p")).alias("mount"), X.uri_filename("url").alias("last"))


@query(
    "x6_knowledge_binding",
    f"WITH p AS (SELECT DISTINCT lang AS tenant, source FROM documents) SELECT tenant, source, 'kb_' || tenant || '_' || source AS namespace, {uuid5("'project:' || tenant || ':' || source")} AS project_id, '/wiki/' || source || '/' AS mount FROM p",
)
def x6(spark: SparkSession, sf: str) -> DataFrame:
    p = base.raw(spark, sf).select("tenant", F.col("source_id").alias("source"), "project_id").distinct()
    b = p.select("tenant", "source", X.knowledge_binding("tenant", "project_id", "source", F.lit(None).cast("string")).alias("b"))
    return b.select("tenant", "source", F.col("b.rag.index_namespace").alias("namespace"), F.col("b.rag.filter.project_id").alias("project_id"), F.col("b.wiki.vfs_mount").alias("mount"))


@query("x5_virtual_paths", "SELECT page_id, p AS path, CASE WHEN p = '/' THEN NULL ELSE coalesce(nullif(regexp_replace(p, '/[^/]*$', ''), ''), '/') END AS parent FROM (SELECT page_id, coalesce(nullif(regexp_replace(regexp_replace('/' || url, '/+', '/', 'g'), '/$', ''), ''), '/') AS p FROM pages)")
def x5(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "pages").select("page_id", X.clean_path("url").alias("path"))
    return p.select("page_id", "path", X.parent_path("path").alias("parent"))


@query("x8_clean_chunk", f"WITH {CHUNKS_SQL} SELECT chunk_id, sha256(trim(regexp_replace(regexp_replace(text, '\\\\[a-zA-Z]+\\{{([^}}]*)\\}}', '\\1', 'g'), '[ \\t]+', ' ', 'g'))) AS digest FROM chunks")
def x8(spark: SparkSession, sf: str) -> DataFrame:
    return base.chunks(spark, sf).select("chunk_id", ids.text_hash(X.clean_chunk("text")).alias("digest"))


@query("x9_clean_field", f"SELECT doc_id, sha256({strip("regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''), chr(10), ' ', 'g'), '[.\\d]*\\}\\],?\\s*[''\"]?\\s*$', ''), '\\s+', ' ', 'g')")}) AS digest FROM documents")
def x9(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", ids.text_hash(X.clean_field("text")).alias("digest"))


@query(
    "x10_truncation",
    f"SELECT doc_id, CASE WHEN length(t) <= 200 THEN t ELSE regexp_replace(substr(t, 1, 199), '[\\s\\p{{Z}}]+$', '') || '…' END AS truncated, CASE WHEN length(t) <= 400 THEN replace(t, chr(10), ' ') ELSE regexp_replace(replace(substr(t, 1, 399), chr(10), ' '), '[\\s\\p{{Z}}]+$', '') || '…' END AS snippet FROM (SELECT doc_id, {strip("coalesce(text, '')")} AS t FROM documents)",
)
def x10(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", X.truncated("text", 200).alias("truncated"), X.snippet("text").alias("snippet"))


@query("x11_json_payload", """SELECT conv_id, turn, '{"role":' || to_json(role) || '}' AS payload FROM conversations""")
def x11(spark: SparkSession, sf: str) -> DataFrame:
    """Messages wrapped twice in envelopes and once in a fence, unwrapped again."""
    inner = F.to_json(F.struct("role"))
    fence = F.when(F.col("turn") % 2 == 0, "json").otherwise("JSON")
    wrapped = F.concat(F.lit("Result:\n```"), fence, F.lit('\n{"output": {"output": '), inner, F.lit("}}\n```"))
    return table(spark, sf, "conversations").select("conv_id", "turn", X.json_payload(wrapped).alias("payload"))


@query(
    "x12_page_markdown",
    """SELECT n_nationkey AS id, '# ' || n_name || chr(10) || chr(10) || '## Executive Summary' || chr(10) || 'From ' || n_name || coalesce(chr(10) || chr(10) || '## Key Entities' || chr(10) || string_agg('- ' || s_name, chr(10) ORDER BY s_name), '') AS markdown FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY n_nationkey, n_name""",
)
def x12(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "supplier").groupBy("s_nationkey").agg(F.sort_array(F.collect_list("s_name")).alias("names"))
    n = table(spark, sf, "nation").join(s, F.col("n_nationkey") == F.col("s_nationkey"), "left")
    none = F.array().cast("array<string>")
    page = F.struct(F.concat(F.lit(" "), "n_name").alias("title"), F.concat(F.lit("From "), "n_name").alias("executive_summary"), F.col("names").alias("key_entities"), F.array(F.lit(" ")).alias("notable_relationships"), none.alias("open_questions"))
    return n.withColumn("page", page).select(F.col("n_nationkey").alias("id"), X.page_markdown("page").alias("markdown"))


@query("x14_search_text", "SELECT p_partkey AS id, p_name || chr(10) || p_type AS search_text, p_name AS title_only FROM part")
def x14(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(F.col("p_partkey").alias("id"), X.search_text(F.concat(F.lit(" "), "p_name"), "p_type").alias("search_text"), X.search_text("p_name", F.lit("  ")).alias("title_only"))


@query("x16_hits", "SELECT s_suppkey AS id, s_name || ' | ' || n_name AS text, '{\"name\":\"' || s_name || '\",\"entity_id\":\"' || s_suppkey || '\"}' AS provenance FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def x16(spark: SparkSession, sf: str) -> DataFrame:
    s, n = table(spark, sf, "supplier"), table(spark, sf, "nation")
    own = s.join(n, s["s_nationkey"] == n["n_nationkey"]).select(F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("name"), F.col("n_name").alias("description"))
    return own.select(F.col("id").cast("long").alias("id"), *search.entity_hit()).drop("kind")


@query("x16_chunk_hits", """SELECT c_custkey AS id, 'chunk' AS kind, c_name AS text, '{"document_id":"d' || c_custkey || '","chunk_id":"c' || c_custkey || '","entity_ids":["e' || c_custkey % 7 || '"]}' AS provenance FROM customer""")
def x16_chunks(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("c_custkey").cast("string")
    own = table(spark, sf, "customer").select("c_custkey", F.concat(F.lit("c"), k).alias("id"), F.concat(F.lit("d"), k).alias("document_id"), F.col("c_name").alias("text"))
    who = F.array(F.concat(F.lit("e"), (F.col("c_custkey") % 7).cast("string")))
    return own.select(F.col("c_custkey").alias("key"), *search.chunk_hit(entity_ids=who)).withColumnRenamed("key", "id")


@query(
    "x16_wiki_hits",
    """SELECT s_suppkey AS id, 'wiki' AS kind, CASE WHEN s_suppkey % 3 = 0 THEN s_name WHEN length(trim(repeat(s_name || ' ', 40))) > 400 THEN rtrim(substr(repeat(s_name || ' ', 40), 1, 399)) || '…' ELSE trim(repeat(s_name || ' ', 40)) END AS text,
'{"community_id":"c' || s_suppkey || '","slug":"s' || s_suppkey || '","vfs_path":"/wiki/s' || s_suppkey || '.md","batch_id":"b1","title":"' || s_name || '"' || CASE WHEN s_suppkey % 2 = 0 THEN ',"stale":true' ELSE '' END || '}' AS provenance FROM supplier""",
)
def x16_wiki(spark: SparkSession, sf: str) -> DataFrame:
    """Pages of forty names, one in three without a body; every other one stale."""
    k = F.col("s_suppkey").cast("string")
    body = F.when(F.col("s_suppkey") % 3 == 0, "").otherwise(F.repeat(F.concat("s_name", F.lit("\n")), F.lit(40)))
    own = table(spark, sf, "supplier").select(
        "s_suppkey", F.concat(F.lit("c"), k).alias("community_id"), F.concat(F.lit("s"), k).alias("slug"), F.col("s_name").alias("title"), body.alias("body_text"),
        F.concat(F.lit("/wiki/s"), k, F.lit(".md")).alias("vfs_path"), F.lit("b1").alias("batch_id"),
    )
    return own.select(F.col("s_suppkey").alias("id"), *search.wiki_hit(stale=F.col("s_suppkey") % 2 == 0))


@query(
    "x16_relationship_hits",
    """SELECT s_suppkey AS id, 'relationship' AS kind, s_name || ' -[IN]-> ' || n_name || CASE WHEN s_suppkey % 2 = 0 THEN ' (home)' ELSE '' END AS text,
'{"source":"' || s_name || '","target":"' || n_name || '","type":"IN","description":"' || CASE WHEN s_suppkey % 2 = 0 THEN 'home' ELSE '' END || '"}' AS provenance FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
)
def x16_relationships(spark: SparkSession, sf: str) -> DataFrame:
    s, n = table(spark, sf, "supplier"), table(spark, sf, "nation")
    told = F.when(F.col("s_suppkey") % 2 == 0, "home").otherwise("")
    own = s.join(n, s["s_nationkey"] == n["n_nationkey"]).select("s_suppkey", F.col("s_name").alias("source"), F.col("n_name").alias("target"), F.lit("IN").alias("type"), told.alias("description"))
    return own.select(F.col("s_suppkey").alias("id"), *search.relationship_hit())


HALVES_SQL = f"""t AS (SELECT doc_id, {strip("coalesce(text, '')")} AS t FROM documents),
j AS (SELECT *, length(t) // 2 AS middle, CASE WHEN contains(t, chr(10) || chr(10)) THEN chr(10) || chr(10) WHEN contains(t, chr(10)) THEN chr(10) END AS joint FROM t),
p AS (SELECT doc_id, middle, length(joint) AS gap, unnest(string_split(t, joint)) AS part, generate_subscripts(string_split(t, joint), 1) AS k, len(string_split(t, joint)) AS n FROM j WHERE joint IS NOT NULL),
e AS (SELECT doc_id, middle, k, n, sum(length(part) + gap) OVER (PARTITION BY doc_id ORDER BY k) AS stop FROM p),
cut_at AS (SELECT doc_id, arg_min(stop, (abs(stop - middle), stop)) AS at_ FROM e WHERE k < n GROUP BY 1)"""


@query(
    "x17_halves",
    f"WITH {HALVES_SQL}, h AS (SELECT doc_id, t, coalesce(at_, middle)::BIGINT AS c FROM j LEFT JOIN cut_at USING (doc_id)) SELECT doc_id, sha256({strip('substr(t, 1, c)')}) AS left_half, sha256({strip('substr(t, c + 1)')}) AS right_half FROM h",
)
def x17(spark: SparkSession, sf: str) -> DataFrame:
    h = table(spark, sf, "documents").select("doc_id", splitting.halves_column("text").alias("h"))
    return h.select("doc_id", ids.text_hash(F.get("h", F.lit(0))).alias("left_half"), ids.text_hash(F.get("h", F.lit(1))).alias("right_half"))
