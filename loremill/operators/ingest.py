"""Routing, validation, structuring and chunking of documents. All of it is narrow: a row's work stays in the row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import ids, text as X
from ..functions.splitting import cut_long

# Extension, parse backend; extensions that are refused; export types of a cloud drive.
BACKENDS = {
    ".docx": "unstructured", ".pptx": "unstructured", ".xlsx": "unstructured", ".xls": "unstructured", ".pdf": "pymupdf",
    ".hwp": "rhwp_batch", ".hwpx": "rhwp_batch", ".txt": "text", ".md": "text",
}
DRIVE_EXPORTS = {
    "application/vnd.google-apps.document": ".docx",
    "application/vnd.google-apps.spreadsheet": ".xlsx",
    "application/vnd.google-apps.presentation": ".pptx",
}


def _lookup(x: Column, table: dict[str, str]) -> Column:
    return F.element_at(F.create_map(*[F.lit(v) for kv in table.items() for v in kv]), x)


def parse_backend(filename) -> Column:
    """Backend of a file by its extension; null for one that is not supported."""
    return F.try_element_at(F.create_map(*[F.lit(v) for kv in BACKENDS.items() for v in kv]), X.suffix(filename))


def upload_status(files: DataFrame, existing: DataFrame, tombstones: DataFrame, allowed: str | None = None, max_mb: int = 100) -> DataFrame:
    """``files`` with ``status`` (uploaded, skipped, rejected) and ``reason``.

    ``files`` has ``tenant, project_id, source_id, content_hash, filename, size``; ``existing`` the raw keys
    there are, ``tombstones`` the purged content.
    """
    names = X.extensions(F.lit(allowed or ",".join(BACKENDS)))
    key, grave = ["tenant", "project_id", "source_id", "content_hash", "filename"], ["tenant", "project_id", "content_hash"]
    there = existing.select(*key).distinct().withColumn("_there", F.lit(True))
    dead = tombstones.select(*grave).distinct().withColumn("_dead", F.lit(True))
    reason = (
        F.when(~F.exists(names, lambda e: F.lower("filename").endswith(e)), "extension")
        .when(F.col("size") > max_mb * 1024 * 1024, "size")
        .when(F.col("_dead"), "tombstone")
        .when(F.col("_there"), "already_exists")
    )
    status = F.when(F.col("reason").isNull(), "uploaded").when(F.col("reason") == "already_exists", "skipped").otherwise("rejected")
    return files.join(there, key, "left").join(dead, grave, "left").withColumn("reason", reason).withColumn("status", status).drop("_there", "_dead")


def drive_filter(items: DataFrame, allowed: str) -> DataFrame:
    """Items with an allowed extension, or of a type that exports to one; ``export_suffix`` says which."""
    exts = X.extensions(F.lit(allowed))
    export = F.try_element_at(F.create_map(*[F.lit(v) for kv in DRIVE_EXPORTS.items() for v in kv]), F.col("mime"))
    by_name = F.exists(exts, lambda e: F.lower("filename").endswith(e))
    return items.withColumn("export_suffix", export).filter(by_name | F.array_contains(exts, F.col("export_suffix")))


def pdf_kind(pages: DataFrame, min_chars: float = 32, min_images: float = 0.5) -> DataFrame:
    """``document_id, kind``: scan if pages have few characters and much image on average, else digital."""
    means = pages.groupBy("document_id").agg((F.sum("text_chars") / F.count(F.lit(1))).alias("chars"), F.avg(F.least("image_ratio", F.lit(1.0))).alias("images"))
    return means.select("document_id", "chars", "images", F.when((F.col("chars") < min_chars) & (F.col("images") >= min_images), "scan").otherwise("digital").alias("kind"))


def parse_plan(docs: DataFrame) -> DataFrame:
    """``parse_backend, fallback_reason, dead_letter`` of a PDF from ``forced_ocr, kind, ocr_available, parse_error, n_chunks``."""
    ocr = F.when(F.col("ocr_available"), "vl_ocr")
    reason = F.when(F.col("forced_ocr") | (F.col("kind") == "scan"), "scan").when(F.col("parse_error"), "parse_error").when(F.col("n_chunks") == 0, "low_text")
    dead = F.when(F.col("fallback_reason").isNotNull() & ~F.col("ocr_available"), F.when(F.col("fallback_reason") == "parse_error", "parse").when(F.col("fallback_reason") == "low_text", "parse_empty").otherwise("ocr_unavailable"))
    return docs.withColumn("fallback_reason", reason).withColumn("parse_backend", F.when(F.col("fallback_reason").isNull(), "pymupdf").otherwise(ocr)).withColumn("dead_letter", dead)


# ---- blocks -------------------------------------------------------------------------------------

BLOCK = "struct<type: string, text: string, heading_path: array<string>>"


def paragraph_blocks(content) -> Column:
    """Paragraphs between blank lines, trimmed, blank ones left out, as an array of blocks."""
    parts = F.filter(F.transform(F.split(X.strip(content), "\n\n"), X.strip), lambda p: p != "")
    return F.transform(parts, lambda p: F.struct(F.lit("paragraph").alias("type"), p.alias("text"), F.array().cast("array<string>").alias("heading_path")))


def element_blocks(elements: DataFrame) -> DataFrame:
    """Typed elements (``document_id, pos, type, text, text_as_html``) as blocks (``document_id, pos, type, text, caption, heading_path``).

    Page furniture goes. A title that has text is the one heading of what follows. A caption belongs to
    the image right before it (the last of several counts), else it is a paragraph; empty ones go.
    """
    w = Window.partitionBy("document_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    kind = (
        F.when(F.col("type") == "Title", "heading").when(F.col("type") == "ListItem", "list_item").when(F.col("type") == "Table", "table")
        .when(F.col("type") == "Image", "image").when(F.col("type") == "FigureCaption", "caption").otherwise("paragraph")
    )
    body = F.coalesce(X.strip("text"), F.lit(""))
    rows = elements.filter(~F.coalesce("type", F.lit("NarrativeText")).isin("Header", "Footer", "PageBreak", "PageNumber")).withColumn("kind", kind).withColumn("body", body)
    rows = rows.withColumn("body", F.when(F.col("kind") == "table", F.coalesce(X.filled(X.strip("text_as_html")), "body")).otherwise(F.col("body")))
    rows = rows.filter((F.col("body") != "") | F.col("kind").isin("heading", "image"))
    rows = rows.withColumn("heading", F.last(F.when((F.col("kind") == "heading") & (F.col("body") != ""), F.col("body")), ignorenulls=True).over(w))
    # Captions hang on the block before their run; whatever is no caption begins a block.
    rows = rows.withColumn("block", F.sum((F.col("kind") != "caption").cast("int")).over(w)).withColumn("before", F.last(F.when(F.col("kind") != "caption", F.col("kind")), ignorenulls=True).over(w))
    attached = (F.col("kind") == "caption") & F.coalesce(F.col("before") == "image", F.lit(False))
    own = Window.partitionBy("document_id", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumn("attached", attached).withColumn("given", F.last(F.when(attached, F.col("body")), ignorenulls=True).over(own)).filter(~F.col("attached"))
    path = F.when(F.col("heading").isNull(), F.array().cast("array<string>")).otherwise(F.array("heading"))
    return rows.select(
        "document_id", "pos",
        F.when(F.col("kind") == "caption", "paragraph").otherwise(F.col("kind")).alias("type"),
        F.when(F.col("kind") != "image", F.col("body")).alias("text"),
        F.when(F.col("kind") == "image", F.coalesce("given", "body")).alias("caption"),
        path.alias("heading_path"),
    )


def bounding_box(points) -> Column:
    """``[least x, least y, greatest x, greatest y]`` of an array of points; null without a point."""
    at = lambda k: F.transform(F.filter(ids.col(points), lambda p: F.size(p) >= 2), lambda p: p[k])
    return F.when(F.size(at(0)) > 0, F.array(F.array_min(at(0)), F.array_min(at(1)), F.array_max(at(0)), F.array_max(at(1))))


def box_text(textlines) -> Column:
    """Lines of a layout box: spans joined, trimmed, blank lines left out."""
    lines = F.transform(ids.col(textlines), lambda ln: X.strip(F.array_join(F.transform(ln["spans"], lambda s: F.coalesce(s["text"], F.lit(""))), "")))
    return F.coalesce(X.strip(F.array_join(F.filter(lines, lambda s: s != ""), "\n")), F.lit(""))


def box_role(boxclass, text) -> Column:
    """What a layout box is; null for page headers and footers, page numbers and empty text."""
    c, t = F.lower(F.coalesce(ids.col(boxclass), F.lit("text"))), ids.col(text)
    return (
        F.when(c.isin("page-header", "page-footer"), None).when(c == "table", "table").when(c.isin("picture", "image"), "image")
        .when(c.isin("title", "section-header"), "heading").when(c == "list-item", "list_item").when(c == "caption", "caption")
        .when((c == "text") & X.strip(t).rlike(r"^\d+\.\s+\S"), "heading").when(X.strip(t).rlike(r"^-\s*\d+\s*-$"), None)
        .when(~X.blank(t), "paragraph")
    )


def layout_blocks(boxes: DataFrame) -> DataFrame:
    """Boxes (``document_id, pos, boxclass, text, caption, table_markdown``) as blocks ready for chunking.

    A heading is carried to what follows. A caption waits for the next image, unless a body box (no
    heading) comes first; an image's own caption wins; an image without any goes.
    """
    w = Window.partitionBy("document_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    past = w.rowsBetween(Window.unboundedPreceding, -1)
    rows = boxes.withColumn("role", box_role("boxclass", "text")).filter("role IS NOT NULL")
    rows = rows.withColumn("heading", F.last(F.when((F.col("role") == "heading") & (F.col("text") != ""), F.col("text")), ignorenulls=True).over(w))
    # The last box before this one that sets the waiting caption or clears it.
    wait = F.last(F.when(F.col("role") == "caption", F.col("text")).when(F.col("role") != "heading", F.lit("")), ignorenulls=True).over(past)
    body = F.when(F.col("role") == "image", X.strip(F.coalesce(X.filled("caption"), wait, F.lit("")))).when(F.col("role") == "table", F.coalesce(X.filled(X.strip("table_markdown")), "text")).otherwise(F.col("text"))
    rows = rows.withColumn("body", body).filter(~F.col("role").isin("heading", "caption") & (F.col("body") != ""))
    path = F.when(F.col("heading").isNull(), F.array().cast("array<string>")).otherwise(F.array("heading"))
    return rows.select("document_id", "pos", F.col("role").alias("type"), F.col("body").alias("text"), path.alias("heading_path"))


def block_text(kind, text, markdown=None, caption=None, rows=None) -> Column:
    """What of a block is chunked: a table's markdown, else text, else its rows as JSON; an image's caption, else text; else text, else markdown."""
    none = F.lit(None).cast("string")
    t, m, c, r = (X.filled(ids.col(x)) if x is not None else none for x in (text, markdown, caption, rows))
    k = ids.col(kind)
    return X.strip(F.when(k == "table", F.coalesce(m, t, r, F.lit(""))).when(k == "image", F.coalesce(c, t, F.lit(""))).otherwise(F.coalesce(t, m, F.lit(""))))


def chunk_blocks(docs: DataFrame, blocks: str = "blocks", max_chars: int = 1000) -> DataFrame:
    """Chunks of documents (``tenant, project_id, document_id`` and an array of blocks), numbered in order, with ids.

    Headings are not chunked; long texts are cut. No shuffle and no Python: a document's chunks come out of its own row.
    """
    own = F.filter(F.col(blocks), lambda b: (b["type"] != "heading") & (F.coalesce(b["text"], F.lit("")) != ""))
    piece = lambda b: lambda p: F.struct(b["type"].alias("type"), p.alias("text"), b["heading_path"].alias("heading_path"))
    docs = docs.withColumn("_own", F.flatten(F.transform(own, lambda b: F.transform(cut_long(b["text"], max_chars), piece(b)))))
    rows = docs.select("tenant", "project_id", "document_id", F.posexplode("_own").alias("chunk_index", "b"))
    rows = rows.select("tenant", "project_id", "document_id", "chunk_index", F.col("b.text").alias("text"), ids.text_hash("b.text").alias("text_hash"), F.col("b.heading_path").alias("heading_path"), F.col("b.type").alias("source_block_type"))
    return rows.withColumn("chunk_id", ids.chunk_id("tenant", "document_id", "chunk_index", "text_hash"))


def dead_letters(docs: DataFrame, chunks: DataFrame) -> DataFrame:
    """``document_id, stage`` of documents that cannot be indexed: empty_raw, parse (no backend), parse_empty (no chunk)."""
    some = chunks.select("document_id").distinct().withColumn("_some", F.lit(True))
    stage = F.when(F.length("content") == 0, "empty_raw").when(parse_backend("filename").isNull(), "parse").when(F.col("_some").isNull(), "parse_empty")
    return docs.join(some, "document_id", "left").withColumn("stage", stage).filter("stage IS NOT NULL").select("document_id", "stage")


def joined_pages(pages: DataFrame, max_pages: int = 30) -> DataFrame:
    """``document_id, n_pages, text, failed``: page texts in order with a rule between; no text where there are no pages or more than ``max_pages`` (0: no limit)."""
    keep = F.lit(True) if not max_pages else F.col("n_pages") <= max_pages
    counted = pages.groupBy("document_id").agg(F.count(F.lit(1)).alias("n_pages"))
    fit = pages.join(counted.filter(keep).select("document_id"), "document_id", "left_semi")
    texts = fit.groupBy("document_id").agg(F.sort_array(F.collect_list(F.struct("page", "text"))).alias("p"))
    body = F.array_join(F.transform("p", lambda x: F.coalesce(x["text"], F.lit(""))), "\n\n---\n\n")
    return counted.join(texts, "document_id", "left").select("document_id", "n_pages", F.when(F.col("p").isNotNull(), body).alias("text"), F.col("p").isNull().alias("failed"))
