"""Full-text and vector search, rank fusion, and the search modes, for whole tables of queries."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import ids, text as X
from .components import cut
from .vectors import Cells, cells, nearest, ranked

CHANNEL_LIMIT, RRF_K, TOP_K = 20, 60, 10
#: Fixed values of the rank function: the default weight, the sum of 1/n² over all n, and the span beyond which two words do not count.
WEIGHT, ALL_SQUARES, FAR = 0.1, 1.64493406685, 100


def lexemes(text) -> Column:
    """Lower-case words, by place: runs of letters, digits and underscores. No stop words, no stemming."""
    return F.regexp_extract_all(F.lower(ids.col(text)), F.lit(r"([\p{L}\p{N}_]+)"), F.lit(1))


def _one(n: Column) -> Column:
    """Rank of one lexeme with n occurrences: 0.1 (1 + 1/4 + ... + 1/n²) by the sum of all squares."""
    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0.0), lambda a, k: a + F.lit(1.0) / (k * k)) * (WEIGHT / ALL_SQUARES)


def _near(a: Column, b: Column) -> Column:
    d = F.abs(a - b).cast("double")
    return F.when(d > FAR, 1e-30).otherwise(F.sqrt(F.lit(WEIGHT * WEIGHT) / (F.lit(1.005) + 0.05 * F.exp(d / 1.5 - 2))))


def _all(hits: Column) -> Column:
    """Rank of several lexemes: over every two places of different ones, 1 - product of (1 - closeness)."""

    def against(acc: Column, later: Column, x: Column) -> Column:
        return F.aggregate(later["places"], acc, lambda keep, y: keep * (1 - _near(x, y)))

    def pair(acc: Column, h: Column, k: Column) -> Column:
        rest = F.slice(hits, k + 2, F.size(hits))
        return F.aggregate(rest, acc, lambda keep, later: F.aggregate(h["places"], keep, lambda inner, x: against(inner, later, x)))

    steps = F.transform(hits, lambda h, k: F.struct(h["term"].alias("term"), h["places"].alias("places"), k.alias("k")))
    return 1 - F.aggregate(steps, F.lit(1.0), lambda acc, h: pair(acc, h, h["k"]))


#: Closeness of neighbours: no two lexemes are nearer.
NEAREST = math.sqrt(WEIGHT * WEIGHT / (1.005 + 0.05 * math.exp(1 / 1.5 - 2)))


def postings(texts: DataFrame, scope: list[str] = ()) -> DataFrame:
    """``id, scope, terms, counts, places``: a row for each text (``id, text`` and the scope columns) with its lexemes in order, how often and where each stands. Written once, it serves any number of query tables."""
    occurs = texts.select("id", *scope, F.posexplode(lexemes("text")).alias("at", "term"))
    return _gathered(occurs, scope)


def _gathered(occurs: DataFrame, scope: list[str]) -> DataFrame:
    own = occurs.groupBy("id", *scope).agg(F.sort_array(F.collect_list(F.struct("term", "at"))).alias("o"))
    starts = F.filter(F.sequence(F.lit(0), F.size("o") - 1), lambda k: (k == 0) | (F.get("o", k)["term"] != F.get("o", k - 1)["term"]))
    own = own.withColumn("starts", starts)
    counts = F.transform("starts", lambda x, k: F.coalesce(F.get("starts", k + 1), F.size("o")) - x)
    own = own.select("id", *scope, "o", "starts", counts.alias("counts"))
    terms = F.transform("starts", lambda x: F.get("o", x)["term"])
    places = F.transform("starts", lambda x, k: F.slice(F.col("o.at"), x + 1, F.get("counts", k)))
    return own.select("id", *scope, terms.alias("terms"), "counts", places.alias("places"))


def full_text(queries: DataFrame, texts: DataFrame, limit: int = CHANNEL_LIMIT, scope: list[str] = (), index: DataFrame | None = None) -> DataFrame:
    """``query_id, id, score, rank``: texts (``id, text`` and the scope columns) that have all lexemes of a query (``query_id, query``), best ``limit`` of each.

    With an ``index`` (see ``postings``) the texts are not read. Without one only occurrences of words that
    some query asks for leave the scan. A query without a lexeme finds nothing. Ties go to the lesser id.
    """
    return bounded_top(queries, texts, limit, scope, index)[0]


def bounded_top(queries: DataFrame, texts: DataFrame, limit: int = CHANNEL_LIMIT, scope: list[str] = (), index: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The result of ``full_text``, and the matches whose places had to be read for it (``query_id, id``).

    The counts of its lexemes bound a match's rank: of one lexeme they say all, of several no two occurrences are nearer
    than neighbours. The ``limit`` matches of greatest bound are scored first; then only those whose bound reaches
    the last of these. Counts and places are columns of one written table, so the others' places are never read.

    Queries for the same words are one query. A text meets a query at its word that the fewest texts have, in the text's own row:
    a match is no row of a shuffle. Bounds are numbers of few values, so how many matches reach each
    says which can be among the first; only these, and those whose score reaches the last of the first, are sorted.
    """
    words = F.array_sort(F.array_distinct(lexemes("query")))
    own = cut(queries.select("query_id", *scope, words.alias("words")).filter("size(words) > 0"))
    asks = own.groupBy(*scope, "words").agg(F.min("query_id").alias("ask"))
    terms = own.select(*scope, F.explode("words").alias("term")).distinct()
    if index is None:
        occurs = texts.select("id", *scope, F.posexplode(lexemes("text")).alias("at", "term"))
        index = cut(_gathered(occurs.join(terms, [*scope, "term"], "left_semi"), scope))
    held = index.select(*scope, F.explode("terms").alias("term")).groupBy(*scope, "term").agg(F.count(F.lit(1)).alias("texts"))
    rarest = asks.select("ask", *scope, "words", F.explode("words").alias("term")).join(held, [*scope, "term"])
    asks = cut(rarest.groupBy("ask", *scope, "words").agg(F.min_by("term", F.struct("texts", "term")).alias("at_term")))

    def matches(columns: list[str]) -> DataFrame:
        met = index.select("id", *scope, "terms", *columns, F.explode("terms").alias("at_term")).join(asks, [*scope, "at_term"])
        return met.filter(F.forall("words", lambda w: F.array_contains("terms", w)))

    def of_word(column: str):
        return lambda w: F.get(F.col(column), (F.array_position("terms", w) - 1).cast("int"))

    def bounds(found: DataFrame, *columns: str) -> DataFrame:
        k = F.size("words")
        found = found.select("ask", "id", *columns, k.alias("k"), F.transform("words", lambda w: of_word("counts")(w).cast("double")).alias("n"))
        zero = F.struct(F.lit(0.0).alias("sum"), F.lit(0.0).alias("pairs"))
        pairs = F.aggregate("n", zero, lambda a, x: F.struct((a["sum"] + x).alias("sum"), (a["pairs"] + a["sum"] * x).alias("pairs")), lambda a: a["pairs"])
        bound = F.when(F.col("k") == 1, _one(F.get("n", F.lit(0)).cast("int"))).otherwise(1 - F.pow(F.lit(1 - NEAREST), pairs))
        return found.select("ask", "id", "k", *columns, bound.alias("bound"))

    def scored(found: DataFrame) -> Column:
        hits = F.transform("words", lambda w: F.struct(w.alias("term"), of_word("places")(w).alias("places")))
        return _all(hits).alias("score")

    def top(hits: DataFrame) -> DataFrame:
        return ranked(hits.withColumnRenamed("ask", "query_id"), limit).withColumnRenamed("query_id", "ask")

    counted = bounds(matches(["counts"]))
    steps = cut(counted.groupBy("ask", F.round("bound", 9).alias("step")).agg(F.count(F.lit(1)).alias("n")))
    upward = Window.partitionBy("ask").orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, -1)
    least = steps.withColumn("before", F.coalesce(F.sum("n").over(upward), F.lit(0))).filter(F.col("before") < limit).groupBy("ask").agg(F.min("step").alias("least"))
    first = cut(top(counted.join(cut(least), "ask").filter(F.round("bound", 9) >= F.col("least")).select("ask", "id", "k", F.col("bound").alias("score"))).drop("rank"))
    alone, some = first.filter("k = 1").select("ask", "id", "score"), first.filter("k > 1").select("ask", "id")
    best = matches(["places"]).join(some, ["ask", "id"])
    best = cut(best.select("ask", "id", scored(best)))
    edge = cut(top(best).filter(F.col("rank") == limit).select("ask", F.col("score").alias("edge")))
    rest = bounds(matches(["counts", "places"]), "words", "terms", "places").join(edge, "ask").filter(F.col("bound") >= F.col("edge") - 1e-8)
    rest = rest.join(some, ["ask", "id"], "left_anti")
    reached = rest.select("ask", "id", "edge", scored(rest)).filter(F.col("score") >= F.col("edge") - 1e-8).select("ask", "id", "score")
    out = cut(top(alone.unionByName(best).unionByName(reached)))
    again = own.join(asks.select("ask", *scope, "words"), [*scope, "words"]).select("query_id", "ask")
    read = some.unionByName(rest.select("ask", "id"))
    return again.join(out, "ask").select("query_id", "id", "score", "rank"), again.join(read, "ask").select("query_id", "id")


def vector_top(queries: DataFrame, vectors: DataFrame, limit: int = CHANNEL_LIMIT, index: Cells | None = None) -> DataFrame:
    """``query_id, id, score, rank``: the nearest vectors by cosine, exactly.

    ``queries``: ``query_id, scope, vector`` (scope may be null: all); ``vectors``: ``id, scope, vector``, or their
    ``index`` (see ``vectors.cells``), which serves any number of query tables. Null and zero vectors are left out; ties go to the lesser id.
    """
    return nearest(queries, index or cells(vectors), limit)[0]


def fuse(lists: DataFrame, k: int = RRF_K, top_n: int = TOP_K, payload: list[str] = ()) -> DataFrame:
    """Reciprocal rank fusion of ``query_id, channel, rank, id`` rows: ``query_id, id, rrf_score, rank`` and the payload.

    An id scores 1/(k + rank) for each place it has, added in order of channel and rank; its payload is
    that of the first place. Ties go to the earlier channel, then rank. Rows without an id are left out.
    """
    rows = lists.filter("id IS NOT NULL AND cast(id AS string) <> ''")
    places = F.sort_array(F.collect_list(F.struct("channel", "rank")))
    first = F.min_by(F.struct(F.lit(0), *payload), F.struct("channel", "rank")).alias("first")
    sums = rows.groupBy("query_id", "id").agg(places.alias("places"), first)
    score = F.aggregate("places", F.lit(0.0), lambda a, p: a + F.lit(1.0) / (p["rank"] + k))
    w = Window.partitionBy("query_id").orderBy(F.desc("rrf_score"), F.col("places")[0]["channel"], F.col("places")[0]["rank"], "id")
    out = sums.withColumn("rrf_score", score).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top_n)
    return out.select("query_id", "id", "rrf_score", "rank", *[F.col(f"first.{c}").alias(c) for c in payload])


def channel(hits: DataFrame, number: int, **payload: Column) -> DataFrame:
    """A ranked list as a numbered channel for ``fuse``."""
    return hits.select("query_id", "id", "rank", F.lit(number).alias("channel"), *[v.alias(c) for c, v in payload.items()])


# ---- rows to hits -------------------------------------------------------------------------------


def chunk_hit(chunk_id="id", document_id="document_id", text="text", entity_ids=None) -> list[Column]:
    c = ids.col
    who = entity_ids if entity_ids is not None else F.array().cast("array<string>")
    return [F.lit("chunk").alias("kind"), c(text).alias("text"), F.to_json(F.struct(F.coalesce(c(document_id), F.lit("")).alias("document_id"), c(chunk_id).alias("chunk_id"), who.alias("entity_ids"))).alias("provenance")]


def entity_hit(entity="id", name="name", description="description") -> list[Column]:
    c = ids.col
    text = F.regexp_replace(F.concat_ws(" | ", F.coalesce(c(name), F.lit("")), F.coalesce(c(description), F.lit(""))), r"^[ |]+|[ |]+$", "")
    return [F.lit("entity").alias("kind"), text.alias("text"), F.to_json(F.struct(c(name).alias("name"), c(entity).alias("entity_id"))).alias("provenance")]


def wiki_hit(row_community="community_id", slug="slug", title="title", body="body_text", path="vfs_path", batch="batch_id", stale=None) -> list[Column]:
    c = ids.col
    text = X.snippet(F.coalesce(X.filled(c(body)), c(title)))
    fields = [F.coalesce(c(row_community), c(slug)).alias("community_id"), c(slug).alias("slug"), c(path).alias("vfs_path"), c(batch).alias("batch_id"), c(title).alias("title")]
    if stale is not None:
        fields.append(F.when(stale, F.lit(True)).alias("stale"))
    return [F.lit("wiki").alias("kind"), text.alias("text"), F.to_json(F.struct(*fields)).alias("provenance")]


def relationship_hit(edge: str = "") -> list[Column]:
    p = lambda c: F.col(f"{edge}{c}")
    told = F.when(F.length(p("description")) > 0, F.concat(F.lit(" ("), p("description"), F.lit(")"))).otherwise("")
    text = F.concat(p("source"), F.lit(" -["), p("type"), F.lit("]-> "), p("target"), told)
    return [F.lit("relationship").alias("kind"), text.alias("text"), F.to_json(F.struct(*[p(c).alias(c) for c in ("source", "target", "type", "description")])).alias("provenance")]
