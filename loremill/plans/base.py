"""How queries are registered, and the inputs that they derive from the given tables, in Spark and in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import ids
from ..functions.ids import NAMESPACE
from ..operators import ingest

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE_SQL[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- SQL snippets -----------------------------------------------------------------------------------


def uuid5(x: str) -> str:
    h = f"sha1(unhex('{NAMESPACE.replace('-', '')}') || encode({x}))"
    v = f"translate(substr({h}, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab')"
    return f"(substr({h},1,8) || '-' || substr({h},9,4) || '-5' || substr({h},14,3) || '-' || {v} || substr({h},18,3) || '-' || substr({h},21,12))"


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"


def doc_id(tenant="tenant", project="project_id", content="content_hash") -> str:
    return uuid5(f"{tenant} || ':' || {project} || ':' || {content}")


def entity(x: str) -> str:
    return uuid5(f"'entity:' || {strip(x)}")


EXTENSIONS = [".txt", ".md", ".pdf", ".docx", ".hwp", ".doc", ".PPTX", ".xyz", ".xls", ""]
STATES = ["pending", "indexed_rag", "indexed_graph", "dead_letter", "purging", "purged", "purge_failed", "pending"]
_pick = lambda x, values: f"(list_value({', '.join(repr(v) for v in values)})[({x} % {len(values)} + 1)::BIGINT])"

RAW_SQL = f"""raw AS (SELECT doc_id, lang AS tenant, source AS source_id, {uuid5("'project:' || lang || ':' || source")} AS project_id,
  coalesce(text, '') AS content, sha256(coalesce(text, '')) AS content_hash, 'doc_' || doc_id || {_pick('doc_id', EXTENSIONS)} AS filename FROM documents)"""
#: One row per document_id, as the register makes them; the state is a given input, by the document's number.
DOCS_SQL = f"""{RAW_SQL}, docs AS (SELECT min(doc_id) AS doc_id, tenant, min(source_id) AS source_id, project_id, content_hash, any_value(content) AS content, min(filename) AS filename,
  {doc_id()} AS document_id, {_pick('min(doc_id)', STATES)} AS ingest_state FROM raw GROUP BY tenant, project_id, content_hash)"""


def cut_sql(source: str, keys: str, most: int) -> str:
    """Recursive pieces (keys, n, piece) of ``source`` (keys, p)."""
    window, third = f"substr(rest, 1, {most})", most // 3
    rfind = lambda c: f"CASE WHEN strpos(reverse({window}), {c}) > 0 THEN length({window}) - strpos(reverse({window}), {c}) ELSE -1 END"
    return f"""cutting AS (SELECT {keys}, 0 AS n, '' AS piece, p AS rest FROM {source}
  UNION ALL SELECT {keys}, n + 1, {strip('substr(rest, 1, c)')}, regexp_replace(substr(rest, c + 1), '^[\\s\\p{{Z}}]+', '') FROM
    (SELECT *, CASE WHEN length(rest) <= {most} THEN length(rest) WHEN nl >= {third} THEN nl WHEN sp >= {third} THEN sp ELSE {most} END AS c
     FROM (SELECT *, {rfind('chr(10)')} AS nl, {rfind("' '")} AS sp FROM cutting WHERE rest <> ''))),
  pieces AS (SELECT {keys}, n, piece FROM cutting WHERE piece <> '')"""


#: Paragraphs (lines, as the given texts have no blank lines) of each document and their chunks.
CHUNKS_SQL = f"""RECURSIVE {DOCS_SQL},
paragraphs AS (SELECT document_id, tenant, project_id, pos, {strip('line')} AS p FROM (SELECT document_id, tenant, project_id, unnest(string_split(content, chr(10))) AS line, generate_subscripts(string_split(content, chr(10)), 1) AS pos FROM docs) WHERE {strip('line')} <> ''),
{cut_sql('paragraphs', 'document_id, tenant, project_id, pos', 1000)},
numbered AS (SELECT document_id, tenant, project_id, (row_number() OVER (PARTITION BY document_id ORDER BY pos, n) - 1)::INT AS chunk_index, piece AS text, sha256(piece) AS text_hash FROM pieces),
chunks AS (SELECT *, {uuid5("tenant || ':' || document_id || ':' || chunk_index || ':' || text_hash")} AS chunk_id FROM numbered)"""

#: Capitalised words of a chunk stand for linked names.
TOKEN = "[A-Z][a-z]{4,}"
LINKED_SQL = f"""{CHUNKS_SQL},
linked AS (SELECT chunk_id, document_id, tenant, project_id, [x FOR x IN string_split(replace(text, chr(10), ' '), ' ') IF regexp_full_match(x, '{TOKEN}')] AS names FROM chunks),
mentions AS (SELECT chunk_id, tenant, project_id, name, {uuid5("'entity:' || name")} AS entity_id FROM (SELECT DISTINCT chunk_id, tenant, project_id, unnest(names) AS name FROM linked))"""

#: Suppliers and the parts they deliver, as the records of an extractor, in order of the lines.
EDGES_SQL = f"""parts AS (SELECT l_orderkey AS part, l_linenumber AS pos, CASE WHEN l_returnflag = 'A' THEN 'EXTRACTED' ELSE 'INFERRED' END AS type,
  {uuid5("'entity:supplier:' || l_suppkey")} AS source, {uuid5("'entity:part:' || l_partkey")} AS target, (1 - l_discount)::DOUBLE AS confidence, l_linestatus AS description FROM lineitem),
edges AS (SELECT type, source, target, arg_min(confidence, (part, pos, confidence, description)) AS confidence, arg_min(description, (part, pos, confidence, description)) AS description FROM parts GROUP BY ALL),
entities AS (SELECT {uuid5("'entity:supplier:' || s_suppkey")} AS id, s_name AS name, coalesce(n_name, '') AS description FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
  UNION ALL SELECT {uuid5("'entity:part:' || p_partkey")}, p_name, p_type FROM part)"""


# ---- the same in Spark ----------------------------------------------------------------------------


def _of(x, values: list[str]):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (x % len(values) + 1).cast("int"))


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    content = F.coalesce("text", F.lit(""))
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.col("lang").alias("tenant"), F.col("source").alias("source_id"),
        ids.uuid5(F.concat(F.lit("project:"), F.col("lang"), F.lit(":"), F.col("source"))).alias("project_id"),
        content.alias("content"), ids.text_hash(content).alias("content_hash"),
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), _of(F.col("doc_id"), EXTENSIONS)).alias("filename"),
    )


#: The project that jobs on one project are about.
PROJECT_SQL = uuid5("'project:en:src0'")


def project():
    return ids.uuid5(F.lit("project:en:src0"))


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document_id. Content follows its hash, so any of equal contents will do."""
    one = raw(spark, sf_dir).groupBy("tenant", "project_id", "content_hash").agg(
        F.min("doc_id").alias("doc_id"), F.min("source_id").alias("source_id"), F.any_value("content").alias("content"), F.min("filename").alias("filename")
    )
    return one.select("*", ids.document_id("tenant", "project_id", "content_hash").alias("document_id"), _of(F.col("doc_id"), STATES).alias("ingest_state"))


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    paragraphs = F.replace(F.col("content"), F.lit("\n"), F.lit("\n\n"))
    return ingest.chunk_blocks(docs(spark, sf_dir).withColumn("blocks", ingest.paragraph_blocks(paragraphs)))


def linked_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks whose capitalised words are written as links."""
    words = F.split(F.replace(F.col("text"), F.lit("\n"), F.lit(" ")), " ")
    marked = F.transform(words, lambda w: F.when(w.rlike(f"^{TOKEN}$"), F.concat(F.lit("[["), w, F.lit("]]"))).otherwise(w))
    return chunks(spark, sf_dir).withColumn("text", F.array_join(marked, " "))


def edge_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries as edge records whose ends are numbers: ``source`` of a supplier, ``target`` of a part (see ``named_ends``)."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("part"), F.col("l_linenumber").alias("pos"), F.when(F.col("l_returnflag") == "A", "EXTRACTED").otherwise("INFERRED").alias("type"),
        F.col("l_suppkey").alias("source"), F.col("l_partkey").alias("target"), (1 - F.col("l_discount")).cast("double").alias("confidence"), F.col("l_linestatus").alias("description"),
    )


def end_id(kind: str, number):
    """The entity id of a supplier's or part's number."""
    return ids.uuid5(F.concat(F.lit(f"entity:{kind}:"), ids.col(number).cast("string")))


def named_ends(rows: DataFrame) -> DataFrame:
    """Rows whose ``source`` and ``target`` are entity ids instead of numbers. A number has one id, so what groups by numbers groups by ids: ids are made for the rows that are left, and shuffles move numbers."""
    return rows.withColumns({"source": end_id("supplier", "source"), "target": end_id("part", "target")})


def entity_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, n, p = (table(spark, sf_dir, t) for t in ("supplier", "nation", "part"))
    own = s.join(n, s["s_nationkey"] == n["n_nationkey"], "left").select(end_id("supplier", "s_suppkey").alias("id"), F.col("s_name").alias("name"), F.coalesce("n_name", F.lit("")).alias("description"))
    return own.unionByName(p.select(end_id("part", "p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_type").alias("description")))

