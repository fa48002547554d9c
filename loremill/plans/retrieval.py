"""The search modes as compositions over whole tables of queries.

Inputs are plain tables: ``queries`` (``query_id, query``), chunk texts (``id, document_id, text``), entities
(``id, name, description``), edges, mentions (``chunk_id, entity_id``) and pages (``slug, community_id,
title, body_text, search_text, vfs_path``). Vectors are optional pairs of (query vectors, item vectors).
Each result has ``query_id, rank, id, rrf_score, kind, text, provenance``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import text as X
from ..operators import graph, search
from ..operators.components import cut

PAYLOAD = ["kind", "text", "provenance"]
HIT = ["query_id", "rank", "id", "rrf_score", *PAYLOAD]
Vectors = tuple[DataFrame, DataFrame] | None


def _channels(queries: DataFrame, texts: DataFrame, vectors: Vectors, top: int, index: DataFrame | None = None) -> DataFrame:
    """Full text and, where there are vectors, nearest neighbours, fused."""
    lists = search.channel(search.full_text(queries, texts, index=index), 0)
    if vectors is not None:
        lists = lists.unionByName(search.channel(search.vector_top(*vectors), 1))
    return search.fuse(lists, top_n=top)


def _as_list(hits: DataFrame, number: int) -> DataFrame:
    return hits.select("query_id", "id", "rank", F.lit(number).alias("channel"), *PAYLOAD)


def basic_search(queries: DataFrame, texts: DataFrame, vectors: Vectors = None, top_k: int = search.TOP_K, index: DataFrame | None = None) -> DataFrame:
    """Chunks by both channels; ``index`` holds the chunks' ``search.postings`` where they are written."""
    found = _channels(queries, texts.select("id", "text"), vectors, top_k, index)
    return found.join(texts, "id").select("query_id", "rank", "id", "rrf_score", *search.chunk_hit()).select(HIT)


def global_search(queries: DataFrame, pages: DataFrame, stale: DataFrame | None = None, vectors: Vectors = None, top_k: int = search.TOP_K, contexts: DataFrame | None = None, attach_first: int = 2) -> DataFrame:
    """Pages by both channels, with the stale flag of their community; ``contexts`` (``community_id, context``) go to the first hits."""
    found = _channels(queries, pages.select(F.col("slug").alias("id"), F.col("search_text").alias("text")), vectors, top_k)
    hits = found.join(pages.withColumn("batch_id", F.lit("")).withColumn("id", F.col("slug")), "id")
    marked = with_stale(hits, stale) if stale is not None else hits.withColumn("stale", F.lit(False))
    out = marked.select("query_id", "rank", "id", "rrf_score", "community_id", *search.wiki_hit(stale=F.col("stale")))
    return attach(out, contexts, attach_first).select(*HIT, "context") if contexts is not None else out.select(HIT)


def with_stale(hits: DataFrame, stale: DataFrame) -> DataFrame:
    """Hits with ``stale``: whether their community is marked so."""
    return hits.join(stale.select("community_id", "stale").distinct(), "community_id", "left").withColumn("stale", F.coalesce("stale", F.lit(False)))


def attach(hits: DataFrame, contexts: DataFrame, first: int = 2) -> DataFrame:
    """The community's ``context`` on the first hits of each query, null on the rest."""
    own = hits.join(contexts, "community_id", "left")
    return own.withColumn("context", F.when(F.col("rank") <= first, F.col("context")))


def local_search(queries: DataFrame, entities: DataFrame, edges: DataFrame, texts: DataFrame, mentions: DataFrame | None = None, vectors: Vectors = None, chunk_vectors: Vectors = None, top_k: int = search.TOP_K, index: DataFrame | None = None) -> DataFrame:
    """Entities, the chunks that mention them and basic hits, fused; then up to three relationships while there is room.

    Chunks of the seed entities come in order of id and carry the query's seeds.
    """
    found = _channels(queries, entities.select("id", X.search_text("name", "description").alias("text")), vectors, min(search.CHANNEL_LIMIT, top_k))
    seeds = cut(found)
    lists = _as_list(seeds.join(entities, "id").select("query_id", "rank", "id", *search.entity_hit()), 0)
    if mentions is not None:
        who = seeds.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("rank", "id"))).alias("s"))
        linked = seeds.select("query_id", F.col("id").alias("entity_id")).join(mentions, "entity_id").select("query_id", F.col("chunk_id").alias("id")).distinct()
        w = Window.partitionBy("query_id").orderBy("id")
        first = linked.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= search.CHANNEL_LIMIT).join(who, "query_id").join(texts, "id")
        lists = lists.unionByName(_as_list(first.select("query_id", "rank", "id", *search.chunk_hit(entity_ids=F.transform("s", lambda x: x["id"]))), 1))
    lists = lists.unionByName(_as_list(basic_search(queries, texts, chunk_vectors, search.CHANNEL_LIMIT, index), 2))
    merged = cut(search.fuse(lists, top_n=top_k, payload=PAYLOAD))
    rels, _ = graph.neighbourhood(edges, seeds.select("query_id", "rank", "id"))
    have = merged.groupBy("query_id").agg(F.count(F.lit(1)).alias("have"))
    extra = rels.filter("n <= 3").select("query_id", "n", F.concat("source", F.lit("->"), "target").alias("id"), *search.relationship_hit()).join(have, "query_id", "left")
    more = extra.withColumn("rank", F.coalesce("have", F.lit(0)) + F.col("n")).filter(F.col("rank") <= top_k).withColumn("rrf_score", F.lit(None).cast("double"))
    return merged.select(HIT).unionByName(more.select(HIT))


def drift_search(queries: DataFrame, primer: DataFrame, follow_up, basic=None, top_k: int = search.TOP_K, follow_ups: int = 3, depth: int = 2) -> DataFrame:
    """The first three primer hits and, of each of up to ``follow_ups`` sub-queries, the hits of a local and from depth 2 on of a basic search, fused in this order.

    ``queries`` has ``query_id, query, sub_queries``; without a sub-query the query itself is one. ``follow_up``
    and ``basic`` are functions from a table of queries to hits; each is called once for all of them.
    """
    subs = F.filter(F.transform(F.coalesce("sub_queries", F.array().cast("array<string>")), X.strip), lambda s: s != "")
    subs = F.slice(F.when(F.size(subs) > 0, subs).otherwise(F.array("query")), 1, follow_ups)
    asked = cut(queries.select(F.col("query_id").alias("of"), F.posexplode(subs).alias("k", "query")).withColumn("query_id", F.concat_ws("/", "of", "k")))
    lists = _as_list(primer.filter("rank <= 3"), 0)
    for at, run in ((1, follow_up), (2, basic if depth > 1 else None)):
        if run is not None:
            hits = run(asked.select("query_id", "query")).join(asked.select("query_id", "of", "k"), "query_id")
            lists = lists.unionByName(hits.select(F.col("of").alias("query_id"), "id", "rank", (2 * F.col("k") + at).alias("channel"), *PAYLOAD))
    return search.fuse(lists, top_n=top_k, payload=PAYLOAD).select(HIT)


def unified_search(queries: DataFrame, modes: dict) -> DataFrame:
    """Queries (``query_id, query, mode``) routed by form unless a mode is requested; ``modes`` has a function from queries to hits for each mode. One result with ``mode``."""
    routed = cut(queries.withColumn("mode", X.search_mode("query", "mode")))
    out = None
    for mode, run in modes.items():
        hits = run(routed.filter(F.col("mode") == mode).drop("mode")).select(*HIT, F.lit(mode).alias("mode"))
        out = hits if out is None else out.unionByName(hits)
    return out
