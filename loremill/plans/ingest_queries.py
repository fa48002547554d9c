"""Queries: sources and sinks, predicates, structuring and chunking."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import ids, splitting, text as X
from ..operators import ingest, lifecycle
from ..operators.components import job_dir
from ..sources import tables
from . import base
from .base import CHUNKS_SQL, DOCS_SQL, RAW_SQL, cut_sql, query, strip, table, uuid5

RAW_KEY_SQL = "'raw/' || tenant || '/' || project_id || '/' || source_id || '/' || content_hash || '/' || filename"
BACKEND_SQL = """(MAP {'.docx': 'unstructured', '.pptx': 'unstructured', '.xlsx': 'unstructured', '.xls': 'unstructured', '.pdf': 'pymupdf', '.hwp': 'rhwp_batch', '.hwpx': 'rhwp_batch', '.txt': 'text', '.md': 'text'})[lower(regexp_extract(filename, '[^.].*?(\\.[^.]+)$', 1))]"""


@query("s1_register_raw", f"WITH {RAW_SQL}, k AS (SELECT tenant, project_id, source_id, content_hash, min(filename) AS filename FROM raw GROUP BY ALL) SELECT *, {base.doc_id()} AS document_id, {RAW_KEY_SQL} AS s3_raw_uri FROM k")
def s1(spark: SparkSession, sf: str) -> DataFrame:
    return tables.register_raw(base.raw(spark, sf))


@query("s1_register_skips_known", f"WITH {RAW_SQL}, k AS (SELECT tenant, project_id, source_id, content_hash, min(filename) AS filename FROM raw GROUP BY ALL), e AS (SELECT DISTINCT content_hash FROM raw JOIN labels USING (doc_id)) SELECT *, {base.doc_id()} AS document_id, {RAW_KEY_SQL} AS s3_raw_uri FROM k ANTI JOIN e USING (content_hash)")
def s1_known(spark: SparkSession, sf: str) -> DataFrame:
    raw = base.raw(spark, sf)
    labelled = raw.join(table(spark, sf, "labels").select("doc_id"), "doc_id", "left_semi").select("content_hash").distinct()
    known = raw.select(*tables.RAW_KEY).join(labelled, "content_hash", "left_semi")
    return tables.register_raw(raw, known.distinct())


@query("s2_json_lines", "SELECT conv_id, turn, role, text FROM conversations")
def s2(spark: SparkSession, sf: str) -> DataFrame:
    own = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    path = f"{job_dir(spark)}/jsonl/{uuid.uuid4().hex}"
    tables.write_jsonl(own, path)
    return tables.read_jsonl(spark, path, own.schema)


@query("s3_batch_manifest", f"WITH {DOCS_SQL} SELECT tenant, project_id, source_id, content_hash, {RAW_KEY_SQL} AS s3_raw_uri, filename, document_id, 'batch-1' AS batch_id FROM docs")
def s3(spark: SparkSession, sf: str) -> DataFrame:
    return tables.batch_manifest(base.docs(spark, sf).withColumn("s3_raw_uri", tables.artifact_key("raw")), "batch-1")


@query("s3_batch_meta", f"WITH {DOCS_SQL} SELECT DISTINCT tenant, 'batch-1' AS batch_id, 'batches/' || tenant || '/batch-1/manifest.meta.json' AS key, '{{\"max_parallel\":25}}' AS meta FROM docs")
def s3_meta(spark: SparkSession, sf: str) -> DataFrame:
    manifest = tables.batch_manifest(base.docs(spark, sf).withColumn("s3_raw_uri", tables.artifact_key("raw")), "batch-1", 25)
    return tables.batch_meta(manifest, 25)


@query(
    "s4_manifest_validation",
    f"""WITH {RAW_SQL}, m AS (SELECT doc_id, tenant, CASE WHEN filename LIKE '%.xyz' THEN ' ' ELSE project_id END AS project_id, source_id, content_hash, CASE WHEN filename LIKE '%.md' THEN NULL ELSE {RAW_KEY_SQL} END AS s3_raw_uri, filename FROM raw),
r AS (SELECT *, CASE WHEN trim(tenant) = '' THEN 'tenant' WHEN trim(project_id) = '' THEN 'project_id' WHEN s3_raw_uri IS NULL THEN 's3_raw_uri' END AS rejected FROM m)
SELECT doc_id, rejected, CASE WHEN rejected IS NULL THEN {base.doc_id()} END AS document_id FROM r""",
)
def s4(spark: SparkSession, sf: str) -> DataFrame:
    raw = base.raw(spark, sf)
    lines = raw.withColumn("s3_raw_uri", F.when(~F.col("filename").endswith(".md"), tables.artifact_key("raw"))).withColumn("project_id", F.when(F.col("filename").endswith(".xyz"), " ").otherwise(F.col("project_id")))
    return tables.validated_manifest(lines.withColumn("document_id", F.lit(None).cast("string"))).select("doc_id", "rejected", "document_id")


@query("s5_pending_manifest", f"WITH {DOCS_SQL} SELECT document_id, filename FROM (SELECT * FROM docs WHERE ingest_state = 'pending' ORDER BY document_id DESC LIMIT 500)")
def s5(spark: SparkSession, sf: str) -> DataFrame:
    return tables.pending_manifest(base.docs(spark, sf).select("document_id", "filename", "ingest_state")).select("document_id", "filename")


@query(
    "s6_batch_aggregate",
    f"""WITH {CHUNKS_SQL}, c AS (SELECT document_id, count(*) AS k FROM chunks GROUP BY 1)
SELECT document_id, project_id, ingest_state, coalesce(k, 0) AS chunk_count,
 CASE WHEN tenant <> 'en' THEN 'project_mismatch' WHEN ingest_state NOT IN ('indexed_rag', 'indexed_graph') THEN 'not_indexed' WHEN k IS NULL THEN 'missing_chunks' END AS violation
FROM docs LEFT JOIN c USING (document_id)""",
)
def s6(spark: SparkSession, sf: str) -> DataFrame:
    d = base.docs(spark, sf)
    # The batch's project is each English document's own; the others are in it by mistake.
    manifest = d.select("document_id", "project_id", "tenant")
    expected = F.when(F.col("tenant") == "en", F.col("project_id")).otherwise(F.lit(""))
    return tables.aggregate_batch(manifest, d, base.chunks(spark, sf), expected)


@query(
    "s7_keyed_upsert",
    "SELECT coalesce(o.o_orderkey, n.l_orderkey) AS id, coalesce(n.last_ship, o.o_orderdate)::DATE AS day, CASE WHEN n.l_orderkey IS NULL THEN o.o_orderstatus ELSE 'L' END AS state, o.o_custkey AS customer FROM orders o FULL JOIN (SELECT l_orderkey, max(l_shipdate) AS last_ship FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) n ON o.o_orderkey = n.l_orderkey",
)
def s7(spark: SparkSession, sf: str) -> DataFrame:
    old = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").cast("date").alias("day"), F.col("o_orderstatus").alias("state"), F.col("o_custkey").alias("customer"))
    new = table(spark, sf, "lineitem").filter("l_returnflag = 'R'").groupBy(F.col("l_orderkey").alias("id")).agg(F.max("l_shipdate").cast("date").alias("day"))
    return tables.upsert(old, new.withColumn("state", F.lit("L")), ["id"], ["day", "state"], keep_if_null=["day"])


@query("s8_insert_absent", "SELECT user_id AS id, min(event_id) AS first_event, 'seen' AS origin FROM events WHERE event_type = (SELECT min(event_type) FROM events) GROUP BY 1 UNION ALL SELECT c_custkey, NULL, 'customer' FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events WHERE event_type = (SELECT min(event_type) FROM events) AND user_id IS NOT NULL)")
def s8(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    kind = events.agg(F.min("event_type").alias("event_type"))
    old = events.join(kind, "event_type", "left_semi").groupBy(F.col("user_id").alias("id")).agg(F.min("event_id").alias("first_event")).withColumn("origin", F.lit("seen"))
    new = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.lit(None).cast("long").alias("first_event"), F.lit("customer").alias("origin"))
    return tables.insert_absent(old, new, ["id"])


@query("s9_url_filename", "WITH p AS (SELECT page_id, coalesce(nullif(list_last(string_split(regexp_replace(url, '/+$', ''), '/')), ''), 'index.html') AS f FROM pages) SELECT page_id, coalesce(nullif(split_part(f, '?', 1), ''), 'download.bin') AS filename FROM p")
def s9(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", X.url_filename("url").alias("filename"))


@query(
    "s10_conversation_export",
    """WITH m AS (SELECT conv_id, string_agg('{"turn":' || turn || ',"role":' || to_json(role) || ',"text":' || to_json(text) || '}', ',' ORDER BY turn, role, text) AS body FROM conversations GROUP BY 1)
SELECT conv_id, '{"conv_id":' || conv_id || ',"messages":[' || body || ']}' AS content, sha256('{"conv_id":' || conv_id || ',"messages":[' || body || ']}') AS content_hash FROM m""",
)
def s10(spark: SparkSession, sf: str) -> DataFrame:
    return tables.conversation_documents(table(spark, sf, "conversations")).withColumn("content_hash", ids.text_hash("content"))


@query("s11_artifact_keys", f"WITH {DOCS_SQL} SELECT document_id, {RAW_KEY_SQL} AS raw_key, 'chunks/' || tenant || '/' || document_id || '/chunks.jsonl' AS chunks_key, 'dead_letter/' || tenant || '/' || content_hash || '/error.json' AS dead_key, 'graph_context/' || tenant || '/' || project_id || '/b1/' || document_id || '.json' AS context_key, content_hash AS hash_part FROM docs")
def s11(spark: SparkSession, sf: str) -> DataFrame:
    d = base.docs(spark, sf).withColumn("batch_id", F.lit("b1")).withColumn("community_id", F.col("document_id"))
    k = tables.artifact_key
    return d.select("document_id", k("raw").alias("raw_key"), k("chunks").alias("chunks_key"), k("dead_letter").alias("dead_key"), k("graph_context").alias("context_key"), tables.key_part(k("raw"), 4).alias("hash_part"))


@query("f1_tenant_isolation", f"WITH {DOCS_SQL} SELECT document_id, project_id, filename FROM docs WHERE tenant = 'en'")
def f1(spark: SparkSession, sf: str) -> DataFrame:
    return base.docs(spark, sf).filter(F.col("tenant") == "en").select("document_id", "project_id", "filename")


@query("f2_parse_routing", f"WITH {RAW_SQL} SELECT doc_id, filename, {BACKEND_SQL} AS backend FROM raw")
def f2(spark: SparkSession, sf: str) -> DataFrame:
    return base.raw(spark, sf).select("doc_id", "filename", ingest.parse_backend("filename").alias("backend"))


@query(
    "f3_upload_status",
    f"""WITH {RAW_SQL}, dead AS (SELECT DISTINCT tenant, project_id, content_hash FROM raw JOIN labels USING (doc_id) WHERE toxic = 1), have AS (SELECT tenant, project_id, source_id, content_hash, filename FROM raw JOIN labels USING (doc_id) WHERE quality = 0),
s AS (SELECT doc_id, CASE WHEN {BACKEND_SQL} IS NULL THEN 'extension' WHEN octet_length(encode(content)) * 100 > 1024 * 1024 THEN 'size'
 WHEN EXISTS (SELECT 1 FROM dead d WHERE d.tenant = raw.tenant AND d.project_id = raw.project_id AND d.content_hash = raw.content_hash) THEN 'tombstone'
 WHEN EXISTS (SELECT 1 FROM have h WHERE h.tenant = raw.tenant AND h.project_id = raw.project_id AND h.source_id = raw.source_id AND h.content_hash = raw.content_hash AND h.filename = raw.filename) THEN 'already_exists' END AS reason FROM raw)
SELECT CASE WHEN reason IS NULL THEN 'uploaded' WHEN reason = 'already_exists' THEN 'skipped' ELSE 'rejected' END AS status, reason, count(*) AS n FROM s GROUP BY ALL""",
)
def f3(spark: SparkSession, sf: str) -> DataFrame:
    raw = base.raw(spark, sf)
    labels = table(spark, sf, "labels")
    files = raw.withColumn("size", F.octet_length("content") * 100)
    dead, have = (raw.join(labels.filter(c).select("doc_id").distinct(), "doc_id", "left_semi") for c in ("toxic = 1", "quality = 0"))
    return ingest.upload_status(files, have, dead, max_mb=1).groupBy("status", "reason").agg(F.count(F.lit(1)).alias("n"))


@query("f4_extension_filter", f"WITH {RAW_SQL} SELECT doc_id, filename FROM raw WHERE lower(filename) LIKE '%.pdf' OR lower(filename) LIKE '%.pptx'")
def f4(spark: SparkSession, sf: str) -> DataFrame:
    exts = X.extensions(F.lit(" pdf, .PPTX,,"))
    return base.raw(spark, sf).filter(F.exists(exts, lambda e: F.lower("filename").endswith(e))).select("doc_id", "filename")


@query(
    "f5_drive_filter",
    f"""WITH {RAW_SQL}, m AS (SELECT doc_id, filename, CASE WHEN filename LIKE '%.xyz' THEN 'application/vnd.google-apps.document' WHEN filename LIKE '%.doc' THEN 'application/vnd.google-apps.presentation' ELSE 'text/plain' END AS mime FROM raw)
SELECT doc_id, CASE WHEN mime LIKE '%document' THEN '.docx' WHEN mime LIKE '%presentation' THEN '.pptx' END AS export_suffix FROM m WHERE lower(filename) LIKE '%.docx' OR lower(filename) LIKE '%.md' OR mime LIKE '%document'""",
)
def f5(spark: SparkSession, sf: str) -> DataFrame:
    mime = F.when(F.col("filename").endswith(".xyz"), "application/vnd.google-apps.document").when(F.col("filename").endswith(".doc"), "application/vnd.google-apps.presentation").otherwise("text/plain")
    return ingest.drive_filter(base.raw(spark, sf).withColumn("mime", mime), "docx,.md").select("doc_id", "export_suffix")


LISTED_SQL = f"project_id = {base.PROJECT_SQL} AND source_id = 'src0' AND contains(lower({RAW_KEY_SQL}), 'doc_')"


def _listed(spark: SparkSession, sf: str) -> DataFrame:
    return base.docs(spark, sf).withColumn("s3_raw_uri", tables.artifact_key("raw")).select("document_id", "project_id", "source_id", "ingest_state", "s3_raw_uri")


@query("f6_document_page", f"WITH {DOCS_SQL} SELECT document_id, ingest_state FROM (SELECT * FROM docs WHERE {LISTED_SQL} ORDER BY document_id DESC LIMIT 50 OFFSET 3)")
def f6(spark: SparkSession, sf: str) -> DataFrame:
    """A page of the documents of a project and source whose address has a text."""
    return lifecycle.list_documents(_listed(spark, sf), base.project(), "src0", contains="DOC_", limit=50, offset=3).select("document_id", "ingest_state")


@query("f7_filtered_count", f"WITH {DOCS_SQL} SELECT 'listed' AS kind, count(*) AS n FROM docs WHERE {LISTED_SQL} UNION ALL SELECT 'pending', count(*) FROM docs WHERE project_id = {base.PROJECT_SQL} AND ingest_state = 'pending'")
def f7_filtered(spark: SparkSession, sf: str) -> DataFrame:
    """Counts under the listing's filters."""
    d = _listed(spark, sf)
    listed = lifecycle.count_documents(d, base.project(), "src0", contains="DOC_").select(F.lit("listed").alias("kind"), "n")
    return listed.unionByName(lifecycle.count_documents(d, base.project(), state="pending").select(F.lit("pending").alias("kind"), "n"))


@query("f7_document_counts", f"WITH {DOCS_SQL} SELECT source_id, ingest_state, count(*) AS n FROM docs GROUP BY ALL")
def f7(spark: SparkSession, sf: str) -> DataFrame:
    return base.docs(spark, sf).groupBy("source_id", "ingest_state").agg(F.count(F.lit(1)).alias("n"))


@query("f8_dead_letters", f"WITH {CHUNKS_SQL} SELECT document_id, CASE WHEN content = '' THEN 'empty_raw' WHEN {BACKEND_SQL} IS NULL THEN 'parse' ELSE 'parse_empty' END AS stage FROM docs WHERE content = '' OR {BACKEND_SQL} IS NULL OR document_id NOT IN (SELECT document_id FROM chunks)")
def f8(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.dead_letters(base.docs(spark, sf), base.chunks(spark, sf))


PAGES_SQL = "pages_ AS (SELECT doc_id AS document_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, (doc_id % 10) / 9.0 AS image_ratio FROM documents)"


@query(
    "f9_pdf_kind",
    f"WITH {PAGES_SQL}, m AS (SELECT document_id, sum(length({strip('line')})) / count(*)::DOUBLE AS chars, avg(least(image_ratio::DOUBLE, 1.0)) AS images FROM pages_ GROUP BY 1) SELECT document_id, round(chars, 6) AS chars, round(images, 6) AS images, CASE WHEN chars < 300 AND images >= 0.5 THEN 'scan' ELSE 'digital' END AS kind FROM m",
)
def f9(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents")
    pages = d.select(F.col("doc_id").alias("document_id"), F.explode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("line"), ((F.col("doc_id") % 10) / 9.0).alias("image_ratio"))
    out = ingest.pdf_kind(pages.withColumn("text_chars", F.char_length(X.strip("line"))), min_chars=300)
    return out.select("document_id", F.round("chars", 6).alias("chars"), F.round("images", 6).alias("images"), "kind")


@query(
    "f10_orphan_projects",
    f"""WITH {RAW_SQL}, o AS (SELECT doc_id, tenant, CASE WHEN filename LIKE '%.txt' THEN NULL ELSE project_id END AS project_id FROM raw), p AS (SELECT tenant, min(project_id) AS id FROM raw WHERE tenant IN ('en', 'fr') GROUP BY 1)
SELECT doc_id, coalesce(project_id, id, {uuid5("'project:' || tenant || ':default'")}) AS project_id, project_id IS NULL AND id IS NULL AS created FROM o LEFT JOIN p USING (tenant)""",
)
def f10(spark: SparkSession, sf: str) -> DataFrame:
    raw = base.raw(spark, sf)
    projects = raw.filter(F.col("tenant").isin("en", "fr")).groupBy("tenant").agg(F.min("project_id").alias("id")).withColumn("slug", F.lit("default"))
    rows = raw.withColumn("project_id", F.when(~F.col("filename").endswith(".txt"), F.col("project_id")))
    return lifecycle.with_default_project(rows, projects).select("doc_id", "project_id", "created")


@query(
    "f11_parse_plan",
    f"""WITH {RAW_SQL}, f AS (SELECT doc_id, filename LIKE '%.hwp' AS forced, CASE WHEN length(content) < 500 THEN 'scan' ELSE 'digital' END AS kind, tenant = 'en' AS ocr, filename LIKE '%.xyz' AS err, CASE WHEN length(content) > 5000 THEN 0 ELSE 3 END AS n FROM raw),
r AS (SELECT *, CASE WHEN forced OR kind = 'scan' THEN 'scan' WHEN err THEN 'parse_error' WHEN n = 0 THEN 'low_text' END AS fallback_reason FROM f)
SELECT doc_id, fallback_reason, CASE WHEN fallback_reason IS NULL THEN 'pymupdf' WHEN ocr THEN 'vl_ocr' END AS parse_backend,
 CASE WHEN fallback_reason IS NOT NULL AND NOT ocr THEN CASE fallback_reason WHEN 'parse_error' THEN 'parse' WHEN 'low_text' THEN 'parse_empty' ELSE 'ocr_unavailable' END END AS dead_letter FROM r""",
)
def f11(spark: SparkSession, sf: str) -> DataFrame:
    d = base.raw(spark, sf).select(
        "doc_id", F.col("filename").endswith(".hwp").alias("forced_ocr"), F.when(F.char_length("content") < 500, "scan").otherwise("digital").alias("kind"), (F.col("tenant") == "en").alias("ocr_available"),
        F.col("filename").endswith(".xyz").alias("parse_error"), F.when(F.char_length("content") > 5000, 0).otherwise(3).alias("n_chunks"),
    )
    return ingest.parse_plan(d).select("doc_id", "fallback_reason", "parse_backend", "dead_letter")


# ---- structuring and chunking -----------------------------------------------------------------------


@query("c1_paragraphs", f"WITH {CHUNKS_SQL} SELECT document_id, (row_number() OVER (PARTITION BY document_id ORDER BY pos) - 1)::INT AS block, p AS text FROM paragraphs")
def c1(spark: SparkSession, sf: str) -> DataFrame:
    d = base.docs(spark, sf).select("document_id", ingest.paragraph_blocks(F.replace(F.col("content"), F.lit("\n"), F.lit("\n\n"))).alias("b"))
    return d.select("document_id", F.posexplode("b").alias("block", "x")).select("document_id", "block", "x.text")


@query("c2_markdown_blocks")
def c2(spark: SparkSession, sf: str) -> DataFrame:
    """The texts' own lines as Markdown: pages' host lines become headings, tables stay tables."""
    d = table(spark, sf, "documents").select("doc_id", F.concat(F.lit("# "), F.col("source"), F.lit("\n\n"), F.coalesce("text", F.lit(""))).alias("md"))
    return d.select("doc_id", F.posexplode(splitting.blocks_column("md")).alias("block", "b")).select("doc_id", "block", "b.type", "b.level", "b.text", "b.heading_path")


@query("e4_extractor_by_name", "SELECT doc_id, (k - 1)::INT AS block, line AS text FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS k FROM documents)")
def e4(spark: SparkSession, sf: str) -> DataFrame:
    """A registered extractor of our own, found by its name: every line is a block."""
    splitting.register_extractor("lines", lambda text: [{"type": "paragraph", "level": None, "text": t, "heading_path": []} for t in text.split("\n")])
    return table(spark, sf, "documents").select("doc_id", F.posexplode(splitting.blocks_column("text", "lines")).alias("block", "b")).select("doc_id", "block", "b.text")


LINES_SQL = f"""lines AS (SELECT document_id, pos, {strip('line')} AS body, (list_value('Title', 'NarrativeText', 'ListItem', 'Table', 'Image', 'FigureCaption', 'Footer'))[((pos - 1) % 7 + 1)::BIGINT] AS type FROM (SELECT document_id, unnest(string_split(content, chr(10))) AS line, generate_subscripts(string_split(content, chr(10)), 1) AS pos FROM docs)),
kept AS (SELECT document_id, pos, body, CASE type WHEN 'Title' THEN 'heading' WHEN 'ListItem' THEN 'list_item' WHEN 'Table' THEN 'table' WHEN 'Image' THEN 'image' WHEN 'FigureCaption' THEN 'caption' ELSE 'paragraph' END AS kind FROM lines WHERE type <> 'Footer' AND (body <> '' OR type IN ('Title', 'Image'))),
headed AS (SELECT *, last_value(CASE WHEN kind = 'heading' AND body <> '' THEN body END IGNORE NULLS) OVER w AS heading, last_value(CASE WHEN kind <> 'caption' THEN kind END IGNORE NULLS) OVER w AS before, sum((kind <> 'caption')::INT) OVER w AS block FROM kept WINDOW w AS (PARTITION BY document_id ORDER BY pos ROWS UNBOUNDED PRECEDING)),
given AS (SELECT *, kind = 'caption' AND coalesce(before = 'image', false) AS attached FROM headed),
caps AS (SELECT document_id, block, arg_max(body, pos) AS caption FROM given WHERE attached GROUP BY 1, 2)"""


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    return base.docs(spark, sf).select("document_id", F.posexplode(F.split("content", "\n")).alias("k", "text")).withColumn("pos", (F.col("k") + 1).cast("long")).drop("k")


@query(
    "c3_c4_typed_elements",
    f"WITH {DOCS_SQL}, {LINES_SQL} SELECT document_id, pos, CASE WHEN kind = 'caption' THEN 'paragraph' ELSE kind END AS type, CASE WHEN kind <> 'image' THEN body END AS text, CASE WHEN kind = 'image' THEN coalesce(caption, body) END AS caption, coalesce(heading, '') AS heading FROM given LEFT JOIN caps USING (document_id, block) WHERE NOT attached",
)
def c3(spark: SparkSession, sf: str) -> DataFrame:
    kinds = F.array(*[F.lit(t) for t in ("Title", "NarrativeText", "ListItem", "Table", "Image", "FigureCaption", "Footer")])
    e = _lines(spark, sf).withColumn("type", F.element_at(kinds, ((F.col("pos") - 1) % 7 + 1).cast("int"))).withColumn("text_as_html", F.lit(None).cast("string"))
    return ingest.element_blocks(e).select("document_id", "pos", "type", "text", "caption", F.array_join("heading_path", "").alias("heading"))


@query(
    "c5_box_roles",
    f"""WITH {DOCS_SQL}, b AS (SELECT document_id, pos, {strip('line')} AS body, (list_value('text', 'page-header', 'Title', 'table', 'picture', 'caption', 'list-item'))[((pos - 1) % 7 + 1)::BIGINT] AS c FROM (SELECT document_id, unnest(string_split(content, chr(10))) AS line, generate_subscripts(string_split(content, chr(10)), 1) AS pos FROM docs))
SELECT document_id, pos, CASE c WHEN 'page-header' THEN NULL WHEN 'table' THEN 'table' WHEN 'picture' THEN 'image' WHEN 'Title' THEN 'heading' WHEN 'list-item' THEN 'list_item' WHEN 'caption' THEN 'caption' ELSE CASE WHEN regexp_matches(body, '^\\d+\\.\\s+\\S') THEN 'heading' WHEN regexp_matches(body, '^-\\s*\\d+\\s*-$') THEN NULL WHEN body <> '' THEN 'paragraph' END END AS role FROM b""",
)
def c5(spark: SparkSession, sf: str) -> DataFrame:
    return _boxes(spark, sf).select("document_id", "pos", ingest.box_role("boxclass", "text").alias("role"))


def _boxes(spark: SparkSession, sf: str) -> DataFrame:
    """Lines as layout boxes of one span each."""
    kinds = F.array(*[F.lit(t) for t in ("text", "page-header", "Title", "table", "picture", "caption", "list-item")])
    rows = _lines(spark, sf).withColumn("boxclass", F.element_at(kinds, ((F.col("pos") - 1) % 7 + 1).cast("int")))
    spans = F.array(F.struct(F.array(F.struct(F.col("text").alias("text"))).alias("spans")))
    return rows.withColumn("text", ingest.box_text(spans)).withColumn("caption", F.lit(None).cast("string")).withColumn("table_markdown", F.lit(None).cast("string"))


LAYOUT_SQL = f"""b AS (SELECT tenant, document_id, pos, {strip('line')} AS body, (list_value('text', 'page-header', 'Title', 'table', 'picture', 'caption', 'list-item'))[((pos - 1) % 7 + 1)::BIGINT] AS c FROM (SELECT tenant, document_id, unnest(string_split(content, chr(10))) AS line, generate_subscripts(string_split(content, chr(10)), 1) AS pos FROM docs)),
r AS (SELECT * FROM (SELECT *, CASE c WHEN 'page-header' THEN NULL WHEN 'table' THEN 'table' WHEN 'picture' THEN 'image' WHEN 'Title' THEN 'heading' WHEN 'list-item' THEN 'list_item' WHEN 'caption' THEN 'caption' ELSE CASE WHEN regexp_matches(body, '^\\d+\\.\\s+\\S') THEN 'heading' WHEN regexp_matches(body, '^-\\s*\\d+\\s*-$') THEN NULL WHEN body <> '' THEN 'paragraph' END END AS role FROM b) WHERE role IS NOT NULL),
h AS (SELECT *, last_value(CASE WHEN role = 'heading' AND body <> '' THEN body END IGNORE NULLS) OVER (PARTITION BY document_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS heading,
  last_value(CASE WHEN role = 'caption' THEN body WHEN role <> 'heading' THEN '' END IGNORE NULLS) OVER (PARTITION BY document_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS waits FROM r),
bodies AS (SELECT * FROM (SELECT tenant, document_id, pos, role, heading, CASE WHEN role = 'image' THEN coalesce(waits, '') ELSE body END AS p FROM h WHERE role NOT IN ('heading', 'caption')) WHERE p <> ''),
{base.cut_sql('bodies', 'tenant, document_id, pos, role, heading', 1000)},
n AS (SELECT *, (row_number() OVER (PARTITION BY document_id ORDER BY pos, n) - 1)::INT AS chunk_index FROM pieces)"""


@query(
    "c6_layout_chunks",
    f"WITH RECURSIVE {DOCS_SQL}, {LAYOUT_SQL} SELECT document_id, chunk_index, {base.uuid5("tenant || ':' || document_id || ':' || chunk_index || ':' || sha256(piece)")} AS chunk_id, piece AS text, CASE WHEN heading IS NULL THEN [] ELSE [heading] END AS heading_path, role AS source_block_type FROM n",
)
def c6(spark: SparkSession, sf: str) -> DataFrame:
    blocks = ingest.layout_blocks(_boxes(spark, sf))
    lists = blocks.groupBy("document_id").agg(F.sort_array(F.collect_list(F.struct("pos", "type", "text", "heading_path"))).alias("blocks"))
    d = base.docs(spark, sf).select("tenant", "project_id", "document_id").join(lists, "document_id")
    return ingest.chunk_blocks(d).select("document_id", "chunk_index", "chunk_id", "text", "heading_path", "source_block_type")


@query("c7_c10_block_chunks", f"WITH {CHUNKS_SQL} SELECT tenant, project_id, document_id, chunk_index, text, text_hash, chunk_id FROM chunks")
def c7(spark: SparkSession, sf: str) -> DataFrame:
    return base.chunks(spark, sf).select("tenant", "project_id", "document_id", "chunk_index", "text", "text_hash", "chunk_id")


@query("c8_cut_long", f"WITH RECURSIVE src AS (SELECT doc_id, text AS p FROM documents), {cut_sql('src', 'doc_id', 700)} SELECT doc_id, count(*) AS n_pieces, max(length(piece)) AS longest, sha256(string_agg(piece, '|' ORDER BY n)) AS digest FROM pieces GROUP BY 1")
def c8(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").select("doc_id", splitting.cut_long("text", 700).alias("p"))
    own = d.withColumn("p", F.filter(F.transform("p", X.strip), lambda x: x != "")).filter(F.size("p") > 0)
    return own.select("doc_id", F.size("p").cast("long").alias("n_pieces"), F.array_max(F.transform("p", lambda x: F.char_length(x))).cast("long").alias("longest"), F.sha2(F.array_join("p", "|"), 256).alias("digest"))


@query(
    "c9_packed_paragraphs",
    f"""WITH {CHUNKS_SQL.replace('paragraphs AS', 'paragraphs AS', 1)}, l AS (SELECT document_id, row_number() OVER (PARTITION BY document_id ORDER BY pos, n) AS k, piece FROM pieces),
pack AS (SELECT document_id, k, 0 AS chunk, length(piece) AS size FROM l WHERE k = 1 UNION ALL
 SELECT l.document_id, l.k, CASE WHEN p.size + 2 + length(l.piece) > 1000 THEN p.chunk + 1 ELSE p.chunk END, CASE WHEN p.size + 2 + length(l.piece) > 1000 THEN length(l.piece) ELSE p.size + 2 + length(l.piece) END FROM pack p JOIN l ON l.document_id = p.document_id AND l.k = p.k + 1)
SELECT document_id, chunk, string_agg(piece, chr(10) || chr(10) ORDER BY k) AS text FROM pack JOIN l USING (document_id, k) GROUP BY 1, 2""",
)
def c9(spark: SparkSession, sf: str) -> DataFrame:
    d = base.docs(spark, sf).select("document_id", splitting.pack_paragraphs(F.replace(F.col("content"), F.lit("\n"), F.lit("\n\n"))).alias("p"))
    return d.select("document_id", F.posexplode("p").alias("chunk", "text"))


@query("c11_ingest_summary", f"WITH {CHUNKS_SQL} SELECT document_id, count(c.chunk_id) AS chunk_count, any_value({BACKEND_SQL}) AS backend FROM docs LEFT JOIN (SELECT document_id, chunk_id FROM chunks) c USING (document_id) GROUP BY 1")
def c11(spark: SparkSession, sf: str) -> DataFrame:
    counted = base.chunks(spark, sf).groupBy("document_id").agg(F.count(F.lit(1)).alias("chunk_count"))
    return base.docs(spark, sf).join(counted, "document_id", "left").select("document_id", F.coalesce("chunk_count", F.lit(0)).alias("chunk_count"), ingest.parse_backend("filename").alias("backend"))


@query(
    "c12_joined_pages",
    "SELECT conv_id AS document_id, count(*) AS n_pages, CASE WHEN count(*) <= 4 THEN string_agg(coalesce(text, ''), chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY turn, text) END AS text, count(*) > 4 AS failed FROM conversations GROUP BY 1",
)
def c12(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "conversations").select(F.col("conv_id").alias("document_id"), F.col("turn").alias("page"), "text")
    return ingest.joined_pages(pages, max_pages=4)


@query("q1_ingest_batch", f"WITH {CHUNKS_SQL}, dead AS (SELECT DISTINCT content_hash FROM raw JOIN labels USING (doc_id) WHERE toxic = 1) SELECT document_id, CASE WHEN content = '' THEN 'empty_raw' WHEN {BACKEND_SQL} IS NULL THEN 'parse' WHEN coalesce(k, 0) = 0 THEN 'parse_empty' ELSE 'indexed_rag' END AS state, CASE WHEN content = '' OR {BACKEND_SQL} IS NULL THEN 0 ELSE coalesce(k, 0) END AS n_chunks FROM docs LEFT JOIN (SELECT document_id, count(*) AS k FROM chunks GROUP BY 1) USING (document_id) WHERE content_hash NOT IN (SELECT content_hash FROM dead)")
def q1(spark: SparkSession, sf: str) -> DataFrame:
    """Manifest, tombstone gate, routing, chunks, dead letters and the state of each document, in one narrow pass after the gate."""
    labels = table(spark, sf, "labels").filter("toxic = 1").select("doc_id").distinct()
    dead = base.raw(spark, sf).join(labels, "doc_id", "left_semi").select("content_hash").distinct()
    d = base.docs(spark, sf).join(dead, "content_hash", "left_anti")
    able = (F.length("content") > 0) & ingest.parse_backend("filename").isNotNull()
    blocks = F.when(able, ingest.paragraph_blocks(F.replace(F.col("content"), F.lit("\n"), F.lit("\n\n")))).otherwise(F.array().cast(f"array<{ingest.BLOCK}>"))
    made = ingest.chunk_blocks(d.withColumn("blocks", blocks))
    counted = made.groupBy("document_id").agg(F.count(F.lit(1)).alias("k"))
    state = F.when(F.length("content") == 0, "empty_raw").when(ingest.parse_backend("filename").isNull(), "parse").when(F.col("k").isNull(), "parse_empty").otherwise("indexed_rag")
    return d.join(counted, "document_id", "left").select("document_id", state.alias("state"), F.coalesce("k", F.lit(0)).alias("n_chunks"))
