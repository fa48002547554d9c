"""Raw content, JSON lines, manifests and keyed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..functions import ids, text as X

RAW_KEY = ["tenant", "project_id", "source_id", "content_hash"]
MANIFEST = ["tenant", "project_id", "source_id", "content_hash", "s3_raw_uri", "filename", "document_id"]

# The layout of artifact keys; each placeholder is a column.
KEY_LAYOUT = {
    "raw": ("raw", "{tenant}", "{project_id}", "{source_id}", "{content_hash}", "{filename}"),
    "parsed": ("parsed", "{tenant}", "{document_id}", "content.json"),
    "parsed_markdown": ("parsed", "{tenant}", "{document_id}", "content.md"),
    "parsed_meta": ("parsed", "{tenant}", "{document_id}", "meta.json"),
    "chunks": ("chunks", "{tenant}", "{document_id}", "chunks.jsonl"),
    "batch_chunks": ("chunks", "{tenant}", "{project_id}", "{batch_id}", "chunks.jsonl"),
    "dead_letter": ("dead_letter", "{tenant}", "{content_hash}", "error.json"),
    "job": ("jobs", "{tenant}", "{job_id}", "manifest.json"),
    "batch": ("batches", "{tenant}", "{batch_id}", "manifest.jsonl"),
    "batch_meta": ("batches", "{tenant}", "{batch_id}", "manifest.meta.json"),
    "communities": ("communities", "{tenant}", "{project_id}", "{batch_id}", "communities.jsonl"),
    "graph_context": ("graph_context", "{tenant}", "{project_id}", "{batch_id}", "{community_id}.json"),
    "graph_extract": ("graph_extract", "{tenant}", "{project_id}", "{batch_id}", "graph_v1.json"),
    "page_result": ("wiki_agent", "{tenant}", "{project_id}", "{batch_id}", "{community_id}.json"),
}


def artifact_key(kind: str) -> Column:
    """The key of an artifact from the columns that its layout names; null if one is null."""
    parts = []
    for part in KEY_LAYOUT[kind]:
        name, _, rest = part.partition("}")
        parts.append(F.concat(F.col(name[1:]).cast("string"), F.lit(rest)) if part.startswith("{") else F.lit(part))
    joined = [parts[0]]
    for p in parts[1:]:
        joined += [F.lit("/"), p]
    return F.concat(*joined)


def key_part(key: Column | str, at: int) -> Column:
    """The ``at``-th part of a key, from 0; null where there is none."""
    return F.get(F.split(ids.col(key), "/"), F.lit(at))


def register_raw(content: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Content rows that are new: one for each (tenant, project_id, source_id, content_hash), with ids and key.

    ``content`` has ``tenant, project_id, source_id, filename, content``. Of equal content the least
    filename counts. Rows without tenant or project are left out, as is content whose key ``existing`` has.
    """
    hashed = content.withColumn("content_hash", F.sha2(F.col("content").cast("binary"), 256))
    own = hashed.filter((F.length("tenant") > 0) & (F.length("project_id") > 0)).select(*RAW_KEY, "filename")
    one = own.groupBy(*RAW_KEY).agg(F.min("filename").alias("filename"))
    if existing is not None:
        one = one.join(existing.select(*RAW_KEY), RAW_KEY, "left_anti")
    return one.select("*", ids.document_id("tenant", "project_id", "content_hash").alias("document_id"), artifact_key("raw").alias("s3_raw_uri"))


#: Columns of Spark's binary file source.
FILES = "path string, modificationTime timestamp, length long, content binary"


def file_content(files: DataFrame, tenant, project_id, source_id) -> DataFrame:
    """Rows for ``register_raw`` from rows of Spark's ``binaryFile`` source, batch or stream: ``tenant, project_id, source_id, filename, content, size, path, content_hash, text``.

    ``content`` stays as bytes, and so does its hash; ``text`` is decoded as UTF-8 with U+FFFD for what is not. The id columns may be literals.
    Empty files are not there: Spark's file sources pass over them.
    """
    name = F.url_decode(F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\+", "%2B"))
    text = F.make_valid_utf8(F.col("content").cast("string"))
    return files.select(
        ids.col(tenant).alias("tenant"), ids.col(project_id).alias("project_id"), ids.col(source_id).alias("source_id"), name.alias("filename"),
        "content", F.col("length").alias("size"), "path", F.sha2("content", 256).alias("content_hash"), text.alias("text"),
    )


def read_files(spark: SparkSession, path: str, tenant, project_id, source_id) -> DataFrame:
    """All files of a folder as content rows (see ``file_content``)."""
    return file_content(spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path), tenant, project_id, source_id)


def write_each(texts: DataFrame, path: str, tasks: int) -> None:
    """A text file of its own for each row of one text column, all in one folder, written by so many tasks.

    The number of tasks is stated, as adaptive execution would deal rows of a few bytes to one task; and each task
    puts its files in place itself (version 2 of Hadoop's committer), as the driver would else move them one by one.
    """
    texts.repartition(tasks).write.option("maxRecordsPerFile", 1).option("mapreduce.fileoutputcommitter.algorithm.version", "2").text(path)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Rows of JSON lines under a stated schema; blank lines are ignored."""
    return spark.read.schema(schema).json(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def batch_manifest(items: DataFrame, batch_id: str, max_parallel: int = 10) -> DataFrame:
    """The seven manifest fields and the batch. ``max_parallel`` goes to the batch's meta record (see ``batch_meta``)."""
    _checked(max_parallel)
    return items.select(*MANIFEST, F.lit(batch_id).alias("batch_id"))


def batch_meta(manifest: DataFrame, max_parallel: int = 10) -> DataFrame:
    """``tenant, batch_id, key, meta``: the meta record of each batch of a manifest, as JSON, and where it goes."""
    _checked(max_parallel)
    own = manifest.select("tenant", "batch_id").distinct()
    return own.select("tenant", "batch_id", artifact_key("batch_meta").alias("key"), F.to_json(F.struct(F.lit(max_parallel).alias("max_parallel"))).alias("meta"))


def _checked(max_parallel: int) -> None:
    if not 1 <= max_parallel <= 100:
        raise ValueError("max_parallel must be from 1 to 100")


def validated_manifest(lines: DataFrame, tenant: str | None = None) -> DataFrame:
    """Lines with ``rejected``: the first required field that is blank, else null. A given tenant overrides; a missing document_id is derived."""
    own = lines.withColumn("tenant", F.lit(tenant)) if tenant else lines
    reason = F.lit(None).cast("string")
    for c in ("filename", "s3_raw_uri", "content_hash", "source_id", "project_id", "tenant"):
        reason = F.when(X.blank(c), F.lit(c)).otherwise(reason)
    known = F.coalesce(X.filled("document_id"), ids.document_id("tenant", "project_id", "content_hash"))
    return own.withColumn("rejected", reason).withColumn("document_id", F.when(F.col("rejected").isNull(), known))


def pending_manifest(documents: DataFrame, chosen: DataFrame | None = None, limit: int = 500) -> DataFrame:
    """The newest pending documents by id, at most ``limit`` of them; then only the chosen ids, if any are given."""
    rows = documents.filter(F.col("ingest_state") == "pending").orderBy(F.desc("document_id")).limit(limit)
    return rows if chosen is None else rows.join(chosen.select("document_id"), "document_id", "left_semi")


def upsert(old: DataFrame, new: DataFrame, key: list[str], updated: list[str], keep_if_null: list[str] = ()) -> DataFrame:
    """``old`` with the rows of ``new``: a known key gets the ``updated`` columns, an unknown one becomes a row.

    ``new`` has one row per key (see ``latest``). Columns in ``keep_if_null`` keep the old value where the
    new one is null. One shuffle on the key; write the result to a new place and swap, never over ``old``.
    """
    a, b = old.alias("a"), new.alias("b")
    there, fresh = F.col("a._there").isNotNull(), F.col("b._there").isNotNull()
    joined = a.withColumn("_there", F.lit(1)).alias("a").join(b.withColumn("_there", F.lit(1)).alias("b"), key, "full_outer")

    def merged(c: str) -> Column:
        if c in key:
            return F.col(c)
        mine, theirs = F.col(f"a.{c}"), F.col(f"b.{c}") if c in new.columns else F.lit(None)
        if c in keep_if_null:
            theirs = F.coalesce(theirs, mine)
        return F.when(fresh & (~there | F.lit(c in updated)), theirs).otherwise(mine).alias(c)

    return joined.select(*[merged(c) for c in old.columns])


def latest(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One row per key: the greatest by the columns of ``order`` (nulls are least). A partial maximum on each task, so a hot key is no more than others."""
    rest = [c for c in rows.columns if c not in key]
    best = rows.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_best"))
    return best.select(*[F.col(c) if c in key else F.col(f"_best.{c}") for c in rows.columns])


def insert_absent(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """``old`` with the rows of ``new`` whose key it has not. ``new`` has one row per key."""
    return old.unionByName(new.join(old.select(*key), key, "left_anti").select(*old.columns))


def conversation_documents(messages: DataFrame) -> DataFrame:
    """``conv_id, content``: each conversation as one JSON document, messages in order of turn."""
    m = messages.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("messages"))
    return m.select("conv_id", F.to_json(F.struct("conv_id", "messages")).alias("content"))


def aggregate_batch(manifest: DataFrame, documents: DataFrame, chunks: DataFrame, project_id: Column) -> DataFrame:
    """Each manifest line with its chunk count and what speaks against the batch, or null.

    ``violation`` is the first of: missing_document_id, project_mismatch, not_indexed, missing_chunks.
    """
    counted = chunks.groupBy("document_id").agg(F.count(F.lit(1)).alias("chunk_count"))
    lines = manifest.join(documents.select("document_id", "ingest_state"), "document_id", "left").join(counted, "document_id", "left")
    why = (
        F.when(X.blank("document_id"), "missing_document_id")
        .when(F.col("project_id") != project_id, "project_mismatch")
        .when(~F.coalesce(F.col("ingest_state").isin("indexed_rag", "indexed_graph"), F.lit(False)), "not_indexed")
        .when(F.col("chunk_count").isNull(), "missing_chunks")
    )
    return lines.select("document_id", "project_id", "ingest_state", F.coalesce("chunk_count", F.lit(0)).alias("chunk_count"), why.alias("violation"))
