"""Tombstones, purge, compensation, reconcile, cleanup, listings, the run log and document states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import ids, text as X
from ..sources.tables import insert_absent, key_part, latest

CONTENT = ["tenant", "project_id", "content_hash"]
GONE = ("purged", "purging")
TERMINAL = ("Succeeded", "Failed", "Error")


def without_tombstones(rows: DataFrame, tombstones: DataFrame) -> DataFrame:
    """Rows whose content is not purged."""
    return rows.join(tombstones.select(*CONTENT).distinct(), CONTENT, "left_anti")


def active_chunks(chunks: DataFrame, documents: DataFrame) -> DataFrame:
    """Chunks of documents that are neither purged nor being purged."""
    live = documents.filter(~F.col("ingest_state").isin(*GONE)).select("document_id").distinct()
    return chunks.join(live, "document_id", "left_semi")


def reconcile(index: DataFrame, active: DataFrame) -> DataFrame:
    """Chunk ids of an index that no active chunk has."""
    return index.select("chunk_id").distinct().join(active.select("chunk_id").distinct(), "chunk_id", "left_anti")


def reconcile_report(index: DataFrame, active: DataFrame) -> DataFrame:
    """``indexed, active, orphans``: one row of counts, added up from partial counts."""
    mark = lambda df, i, a: df.select("chunk_id").distinct().select("chunk_id", F.lit(i).alias("i"), F.lit(a).alias("a"))
    both = mark(index, 1, 0).unionByName(mark(active, 0, 1)).groupBy("chunk_id").agg(F.max("i").alias("i"), F.max("a").alias("a"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return both.agg(total("i").alias("indexed"), total("a").alias("active"), total(F.when((F.col("i") == 1) & (F.col("a") == 0), 1).otherwise(0)).alias("orphans"))


def orphan_raw(keys: DataFrame, documents: DataFrame, project_id: Column, older_than: Column | None = None) -> DataFrame:
    """Raw keys (``key`` and maybe ``modified``) of a project whose content no document has; with an age limit only older ones. A project is required."""
    own = keys.withColumn("tenant", key_part("key", 1)).withColumn("project_id", key_part("key", 2)).withColumn("content_hash", key_part("key", 4))
    own = own.filter((F.col("project_id") == project_id) & (key_part("key", 0) == "raw"))
    if older_than is not None:
        own = own.filter(F.col("modified") < older_than)
    return own.join(documents.select(*CONTENT).distinct(), CONTENT, "left_anti")


#: Candidates of each kind that a cleanup's report shows.
SHOWN = 50


def stale_manifests(manifests: DataFrame, documents: DataFrame, older_than: Column | None = None) -> DataFrame:
    """``key`` of batch manifests (lines of ``key, document_id`` and maybe ``modified``) of which no line has a document that is there; with an age limit only older ones."""
    live = documents.filter(~F.col("ingest_state").isin(*GONE)).select("document_id", F.lit(1).alias("_live")).distinct()
    own = manifests if older_than is None else manifests.filter(F.col("modified") < older_than)
    return own.join(live, "document_id", "left").groupBy("key").agg(F.count("_live").alias("n")).filter("n = 0").select("key")


def cleanup_candidates(raw: DataFrame, manifests: DataFrame, documents: DataFrame, project_id: Column, raw_older_than: Column | None = None, manifests_older_than: Column | None = None) -> DataFrame:
    """``kind, key``: raw content that no document has (``orphan_raw``) and manifests without a live document (``stale_manifest``), beyond their age limits."""
    one = orphan_raw(raw, documents, project_id, raw_older_than).select(F.lit("orphan_raw").alias("kind"), "key")
    return one.unionByName(stale_manifests(manifests, documents, manifests_older_than).select(F.lit("stale_manifest").alias("kind"), "key"))


def cleanup_report(candidates: DataFrame, dry_run: bool = True) -> DataFrame:
    """``kind, candidate_count, deleted_count, shown``: how many of each kind there are, how many go (none in a dry run), and the first SHOWN in order of the key."""
    counts = candidates.groupBy("kind").agg(F.count(F.lit(1)).alias("candidate_count"))
    first = candidates.withColumn("n", F.row_number().over(Window.partitionBy("kind").orderBy("key"))).filter(F.col("n") <= SHOWN)
    shown = first.groupBy("kind").agg(F.sort_array(F.collect_list("key")).alias("shown"))  # SHOWN at most
    return counts.join(shown, "kind").select("kind", "candidate_count", (F.lit(0) if dry_run else F.col("candidate_count")).cast("long").alias("deleted_count"), "shown")


def match_deletes(changes: DataFrame, documents: DataFrame) -> DataFrame:
    """Documents that a delete of a change feed names, by remote id."""
    gone = changes.filter(F.col("op") == "delete").select("remote_id").distinct()
    return documents.join(gone, "remote_id", "left_semi")


def filtered(documents: DataFrame, project_id: Column | None = None, source_id: str | None = None, contains: str | None = None, state: str | None = None) -> DataFrame:
    """Documents of a project, of a source, in a state, with a text in the raw address (ignoring case, no wildcards); each as far as it is given."""
    rows = documents if project_id is None else documents.filter(F.col("project_id") == project_id)
    if source_id:
        rows = rows.filter(F.col("source_id") == source_id)
    if contains:
        rows = rows.filter(F.lower("s3_raw_uri").contains(contains.lower()))
    return rows.filter(F.col("ingest_state") == state) if state else rows


def list_documents(documents: DataFrame, project_id: Column | None = None, source_id: str | None = None, contains: str | None = None, state: str | None = None, limit: int = 50, offset: int = 0) -> DataFrame:
    """A page of the ``filtered`` documents by id, newest first."""
    return filtered(documents, project_id, source_id, contains, state).orderBy(F.desc("document_id")).offset(offset).limit(limit)


def count_documents(documents: DataFrame, project_id: Column | None = None, source_id: str | None = None, contains: str | None = None, state: str | None = None) -> DataFrame:
    """``n``: how many the listing under the same filters has."""
    return filtered(documents, project_id, source_id, contains, state).agg(F.count(F.lit(1)).alias("n"))


def newest(rows: DataFrame, at: str, key: list[str], limit: int) -> DataFrame:
    """The newest of a listing such as tombstones or stale marks; ties by key."""
    return rows.orderBy(F.desc(at), *key).limit(limit)


def with_default_project(rows: DataFrame, projects: DataFrame) -> DataFrame:
    """A null project_id becomes the tenant's project with slug ``default``; where the tenant has none, its id is derived (and ``created`` says so)."""
    own = projects.filter(F.col("slug") == "default").select("tenant", F.col("id").alias("_default"))
    derived = ids.uuid5(F.concat(F.lit("project:"), F.col("tenant"), F.lit(":default")))
    joined = rows.join(own, "tenant", "left")
    missing = F.col("project_id").isNull()
    return joined.withColumn("created", missing & F.col("_default").isNull()).withColumn("project_id", F.coalesce("project_id", "_default", derived)).drop("_default")


def compensate(chunks: DataFrame, mentioned: DataFrame, gone: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chunks with the embeddings of documents in ``gone`` cleared, and mentions without those of their chunks; one pass for the whole set."""
    d = gone.select("document_id").distinct().withColumn("_gone", F.lit(True))
    marked = chunks.join(d, "document_id", "left")
    cleared = marked.withColumn("embedding", F.when(F.col("_gone").isNull(), F.col("embedding")))
    dead = marked.filter("_gone").select("chunk_id").distinct()
    return cleared.drop("_gone"), mentioned.join(dead, "chunk_id", "left_anti")


def compensation_audit(chunks: DataFrame, mentioned: DataFrame, gone: DataFrame) -> DataFrame:
    """An audit row for each document in ``gone``: ``document_id, action, chunk_count, embeddings_cleared, mentions_deleted``."""
    own = chunks.select("document_id", "chunk_id", F.col("embedding").isNotNull().cast("long").alias("e")).join(gone.select("document_id").distinct(), "document_id", "left_semi")
    linked = mentioned.groupBy("chunk_id").agg(F.count(F.lit(1)).alias("m"))
    sums = own.join(linked, "chunk_id", "left").groupBy("document_id").agg(F.count(F.lit(1)).alias("chunk_count"), F.sum("e").alias("embeddings_cleared"), F.coalesce(F.sum("m"), F.lit(0)).alias("mentions_deleted"))
    none = F.lit(0).cast("long")
    out = gone.select("document_id").distinct().join(sums, "document_id", "left")
    return out.select("document_id", F.lit("compensation").alias("action"), *[F.coalesce(c, none).alias(c) for c in ("chunk_count", "embeddings_cleared", "mentions_deleted")])


def wanted_of(documents: DataFrame, project_id: Column, source_id: str | None = None) -> DataFrame:
    """What a purge of a whole project, or of one of its sources, is about: documents that are not gone yet."""
    return filtered(documents, project_id, source_id).filter(~F.col("ingest_state").isin(*GONE)).select("document_id")


def mark_stale(stale: DataFrame, audit: DataFrame) -> DataFrame:
    """``stale`` (``tenant, project_id, community_id``) with a mark for each project that has purged documents and no mark yet: the least document stands for the community until pages are made anew."""
    fresh = audit.groupBy("tenant", "project_id").agg(F.min("document_id").alias("community_id"))
    return stale.unionByName(fresh.join(stale.select("tenant", "project_id").distinct(), ["tenant", "project_id"], "left_anti").select(*stale.columns))


def purge(documents: DataFrame, tombstones: DataFrame, wanted: DataFrame, reason: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents in their new state, tombstones with the purged content, and an audit row for each purged document."""
    w = wanted.select("document_id").distinct().withColumn("_w", F.lit(True))
    marked = documents.join(w, "document_id", "left").withColumn("_now", F.coalesce(F.col("_w"), F.lit(False)) & (F.col("ingest_state") != "purged"))
    after = marked.withColumn("ingest_state", F.when(F.col("_now"), "purged").otherwise(F.col("ingest_state"))).drop("_w", "_now")
    dead = marked.filter("_now").groupBy(*CONTENT).agg(F.min("document_id").alias("document_id")).withColumn("reason", F.lit(reason))
    audit = marked.filter("_now").select("tenant", "project_id", "document_id", F.lit("purge").alias("action"), F.lit(reason).alias("reason"))
    return after, insert_absent(tombstones, dead.select(*tombstones.columns), CONTENT), audit


def project_rows(project_id: Column, **tables: DataFrame) -> DataFrame:
    """``table_name, n``: rows of a project in each table; what a hard delete takes away."""
    parts = [t.filter(F.col("project_id") == project_id).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n") for name, t in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def restored(documents: DataFrame, tombstones: DataFrame, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Restore: tombstones without the wanted content, and its documents back in state pending."""
    w = wanted.select("document_id").distinct().withColumn("_w", F.lit(True))
    marked = documents.join(w, "document_id", "left")
    keys = marked.filter("_w").select(*CONTENT).distinct()
    after = marked.withColumn("ingest_state", F.when(F.col("_w"), "pending").otherwise(F.col("ingest_state"))).drop("_w")
    return after, tombstones.join(keys, CONTENT, "left_anti")


def reingest(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """Wanted documents go back to pending, but for purged ones: ``refused`` marks those."""
    w = wanted.select("document_id").distinct().withColumn("_w", F.lit(True))
    marked = documents.join(w, "document_id", "left").withColumn("refused", F.coalesce(F.col("_w"), F.lit(False)) & F.col("ingest_state").isin(*GONE))
    return marked.withColumn("ingest_state", F.when(F.col("_w") & ~F.col("refused"), "pending").otherwise(F.col("ingest_state"))).drop("_w")


def mark_indexed(documents: DataFrame, batch: DataFrame, state: str, cursors: list[str], at: Column) -> DataFrame:
    """Documents of a batch in their new state, with the cursors set; purged ones stay as they are."""
    b = batch.select("document_id").distinct().withColumn("_b", F.lit(True))
    marked = documents.join(b, "document_id", "left").withColumn("_b", F.coalesce("_b", F.lit(False)) & ~F.col("ingest_state").isin(*GONE))
    for c in cursors:
        marked = marked.withColumn(c, F.when(F.col("_b"), at).otherwise(F.col(c)))
    return marked.withColumn("ingest_state", F.when(F.col("_b"), state).otherwise(F.col("ingest_state"))).drop("_b")


def latest_runs(runs: DataFrame) -> DataFrame:
    """The run with the greatest id of each tenant and batch."""
    return latest(runs, ["tenant", "batch_id"], ["id"])


def run_order() -> list[Column]:
    """Newest first: by start, else by the time in a batch id like 20240131-235959; those without either last; then by id."""
    stamp = F.when(F.col("batch_id").rlike(r"^\d{8}-\d{6}$"), F.try_to_timestamp("batch_id", F.lit("yyyyMMdd-HHmmss")))
    return [F.coalesce("started_at", stamp).desc_nulls_last(), F.desc("id")]


def merge_runs(old: DataFrame, new: DataFrame) -> DataFrame:
    """Run log upsert: a new value counts where it is given; a run that has ended keeps its status and end."""
    a, b = old.alias("a"), new.alias("b")
    ended = F.col("a.status").isin(*TERMINAL)
    joined = a.join(b, (F.col("a.tenant") == F.col("b.tenant")) & (F.col("a.id") == F.col("b.id")), "full_outer")

    def merged(c: str) -> Column:
        given = F.coalesce(F.col(f"b.{c}"), F.col(f"a.{c}"))
        return (F.when(ended, F.col(f"a.{c}")).otherwise(given) if c in ("status", "ended_at") else given).alias(c)

    return joined.select(*[merged(c) for c in old.columns])


def active_runs(runs: DataFrame) -> DataFrame:
    """Runs that have not ended."""
    return runs.filter(~F.coalesce(F.col("status").isin(*TERMINAL), F.lit(False)))


def folded_states(events: DataFrame) -> DataFrame:
    """Current state of each document from its state events (``document_id, seq, state``): the latest, but purged is for good.

    One aggregation with partial maxima; no event list is ever gathered.
    """
    last = F.max(F.struct("seq", "state")).alias("last")
    dead = F.max(F.col("state") == "purged").alias("dead")
    return events.groupBy("document_id").agg(last, dead, F.count(F.lit(1)).alias("n")).select("document_id", F.when(F.col("dead"), "purged").otherwise(F.col("last.state")).alias("state"), F.col("n").alias("n_events"))


def fingerprints(lines: DataFrame, batch: list[str], line: Column, digits: int = 3) -> DataFrame:
    """A fingerprint of each batch that does not depend on the order of its lines.

    Hashes of lines are sorted and hashed in shares, by their first hexadecimal ``digits``, and the shares'
    hashes in order of share; so a batch of any size meets in one row only as at most 16 ** digits hashes.
    """
    hashed = lines.select(*batch, F.sha2(line, 256).alias("h"))
    digest = lambda c: F.sha2(F.array_join(F.sort_array(F.collect_list(c)), ""), 256)
    shares = hashed.groupBy(*batch, F.substring("h", 1, digits).alias("share")).agg(digest("h").alias("h"), F.count(F.lit(1)).alias("n"))
    return shares.groupBy(*batch).agg(digest(F.concat("share", "h")).alias("chunks_sha256"), F.sum("n").alias("n_lines"))


def cache_misses(wanted: DataFrame, cache: DataFrame, key: list[str], schema: str, force: bool = False) -> DataFrame:
    """Rows of ``wanted`` (key and ``chunks_sha256``) that the cache has no result for under the same schema; all of them when forced."""
    if force:
        return wanted
    return wanted.join(cache.filter(F.col("output_schema") == schema).select(*key, "chunks_sha256").distinct(), [*key, "chunks_sha256"], "left_anti")


def missing_directories(paths: DataFrame) -> DataFrame:
    """``path, parent_path, name``: every ancestor of the given paths (``path``), each once."""
    clean = paths.select(X.clean_path("path").alias("path")).distinct()
    parts = F.split(F.substring(F.col("path"), F.lit(2), F.length("path")), "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts) - 1), lambda n: F.concat(F.lit("/"), F.array_join(F.slice(parts, F.lit(1), n), "/")))
    rows = clean.filter("path <> '/'").select(F.explode(above).alias("path")).distinct()
    return rows.select("path", X.parent_path("path").alias("parent_path"), F.when(F.col("path") == "/", "").otherwise(X.last_segment("path")).alias("name"))


def prompt_groups(chunks: DataFrame, batch: list[str], order: list[str], per_group: int = 100, digits: int = 3) -> DataFrame:
    """Non-blank chunks with the number of their group: each ``per_group`` in order make one.

    The first column of ``order`` is an identifier in hexadecimal, spread evenly; its first ``digits`` deal a
    batch into shares that are in order, and only a share is ever sorted. ``chunks`` is read twice.
    """
    share = F.substring(F.col(order[0]), 1, digits)
    rows = chunks.filter(~X.blank("text")).withColumn("_share", share)
    before = Window.partitionBy(*batch).orderBy("_share").rowsBetween(Window.unboundedPreceding, -1)  # at most 16 ** digits rows
    counts = rows.groupBy(*batch, "_share").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(*batch, "_share", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy(*batch, "_share").orderBy(*order)) - 1
    ranked = rows.withColumn("_place", place).join(offsets, [*batch, "_share"])
    return ranked.withColumn("group", F.floor((F.col("_before") + F.col("_place")) / F.lit(per_group)).cast("int")).select(*chunks.columns, "group")


def packed_prompts(groups: DataFrame, key: list[str], order: list[str], budget: int = 4000, normalise: bool = True) -> DataFrame:
    """``key, prompt, n_chunks, text``: cleaned chunk texts of each group, joined until the next would exceed the budget (joiners are not counted; a text longer than the budget is alone).

    A group is bounded (see ``prompt_groups``), so the fold over it is one aggregation of a short list.
    """
    clean = groups.withColumn("text", X.clean_chunk("text", normalise)).filter("text <> ''")
    lists = clean.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct(*order, "text"))).alias("c"))
    start = F.expr("named_struct('done', cast(array() as array<struct<n: int, text: string>>), 'n', 0, 'size', 0, 'text', '')")

    def step(a: Column, c: Column) -> Column:
        size = F.char_length(c["text"])
        full = (a["n"] > 0) & (a["size"] + size > budget)
        closed = F.struct(a["n"].alias("n"), a["text"].alias("text"))
        return F.struct(
            F.when(full, F.concat(a["done"], F.array(closed))).otherwise(a["done"]).alias("done"),
            F.when(full | (a["n"] == 0), F.lit(1)).otherwise(a["n"] + 1).alias("n"),
            F.when(full | (a["n"] == 0), size).otherwise(a["size"] + size).alias("size"),
            F.when(full | (a["n"] == 0), c["text"]).otherwise(F.concat(a["text"], F.lit("\n\n"), c["text"])).alias("text"),
        )

    whole = F.aggregate("c", start, step, lambda a: F.concat(a["done"], F.array(F.struct(a["n"].alias("n"), a["text"].alias("text")))))
    return lists.select(*key, F.posexplode(whole).alias("prompt", "p")).select(*key, "prompt", F.col("p.n").alias("n_chunks"), F.col("p.text").alias("text"))
