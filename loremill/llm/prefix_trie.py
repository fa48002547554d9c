"""The trie of conversation prefixes, and totals of its subtrees by parallel tree contraction.

A node is a distinct sequence of first turns. Its name is the exclusive-or of 128-bit digests of (place, role,
text), so the names of all prefixes come from running sums that can be taken in blocks, and a parent's name from
its child's by taking the last turn's digest out. Only digests and lengths of texts are moved.

Totals are summed by contraction, in rounds of joins. Compress: nodes with a single child are unary; chains of
them are measured by pointer doubling and taken out, each with the sum down to the end of its chain and that end's
name. Rake: leaves are taken out with their totals, which their parents add up. After a compress every inner node
has two children at least, so a rake takes half of what is left. When only the root is left, the compressed
nodes are expanded again, the last round first: a node's total is its own sum and the total of its chain's end.

A subtree with one member is a single path: it has one leaf and shares nothing. Such nodes are raked at once
before the first round, so the rounds only have nodes that conversations share.

Hot keys: a parent of very many children meets them in sums with map-side combining; a doubling step joins unary
nodes alone, where each key has one row on either side.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from .shared import cut, numbered
from .structure_repair import CRC_SQL

#: Turns in a row while dialogues are put in order; the greatest head that another conversation lends.
TURNS_PER_PART, MOST_SHARED = 256, 9
#: Ids that are written as one piece while a node's ends are hashed.
IDS_PER_PIECE = 4096


def rebuilt(conversations: DataFrame, per_part: int = TURNS_PER_PART) -> DataFrame:
    """``conv_id, first, m array<struct<a, b, bytes>>, total``: the turns of each rebuilt conversation from place ``first`` on, in parts.

    A conversation c begins with the first h turns of conversation c - c % 5 (all if it has fewer, none if it is not there), and goes
    on with its own after its first h; h is the checksum of c modulo 9. ``total`` is the rebuilt number of turns; a
    conversation without any has one row with no turns. Turns are in order of turn (null first), then role, then the text's digest.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    thin = conversations.filter("conv_id IS NOT NULL").select(F.col("conv_id").alias("conv"), "turn", role.alias("role"), digest.alias("sha"), F.octet_length(text).cast("long").alias("bytes"))
    parts = cut(numbered(thin, per_part).select("conv", "part", F.transform("m", lambda x: F.struct(x["sha"].alias("sha"), x["bytes"].alias("bytes"))).alias("m")))
    heads = parts.filter("part = 0").select("conv", F.slice("m", 1, MOST_SHARED - 1).alias("lent"))
    conv = F.col("conv")
    h = (F.crc32(conv.cast("string")) % MOST_SHARED).cast("int")
    own = cut(parts.groupBy("conv").agg(F.sum(F.size("m")).alias("n")).select("conv", "n", h.alias("h"), (conv - conv % 5).alias("base")))
    led = own.join(heads.withColumnRenamed("conv", "base"), "base", "left").select("conv", "n", "h", F.slice(F.coalesce("lent", F.expr("cast(array() as array<struct<sha: string, bytes: bigint>>)")), F.lit(1), F.col("h")).alias("lent"))
    # Every part moves to its new place; the first one has the lent turns in front and its own first h left out.
    moved = parts.join(cut(led).hint("merge"), "conv")
    m = F.when(F.col("part") == 0, F.concat("lent", F.slice("m", F.col("h") + 1, F.greatest(F.size("m"), F.lit(1))))).otherwise(F.col("m"))
    shift = F.size("lent") - F.least("h", "n")
    first = F.when(F.col("part") == 0, F.lit(0).cast("long")).otherwise(F.col("part") * per_part + shift)
    total = F.col("n") + shift
    return cut(moved.select(conv.alias("conv_id"), first.alias("first"), m.alias("m"), total.alias("total")))


def _half(sha: Column, place: Column, k: int) -> Column:
    """64 bits for a turn at a place."""
    return F.xxhash64(F.lit(k), place, F.substring(sha, 1 + 32 * k, 32))


def prefixes(parts: DataFrame) -> DataFrame:
    """``conv_id, depth, a, b, up_a, up_b, bytes, ends``: a row for every prefix of at least one turn of each rebuilt conversation."""
    turns = parts.select("conv_id", "first", "total", F.posexplode("m").alias("i", "x"))
    depth = (F.col("first") + F.col("i") + 1).cast("long")
    turns = turns.select("conv_id", "first", "total", depth.alias("depth"), F.col("x.bytes").alias("bytes"), _half(F.col("x.sha"), depth, 0).alias("p"), _half(F.col("x.sha"), depth, 1).alias("q"))
    # Running sums inside a part, and of whole parts before it.
    inner = Window.partitionBy("conv_id", "first").orderBy("depth")
    far = parts.filter("first > 0").select("conv_id").distinct()
    sums = turns.join(far, "conv_id", "left_semi").groupBy("conv_id", "first").agg(F.bit_xor("p").alias("p"), F.bit_xor("q").alias("q"))
    before = Window.partitionBy("conv_id").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)  # a row for each part
    sums = cut(sums.select("conv_id", "first", F.bit_xor("p").over(before).alias("p0"), F.bit_xor("q").over(before).alias("q0")).filter("p0 IS NOT NULL"))
    run = turns.select("conv_id", "first", "total", "depth", "bytes", "p", "q", F.bit_xor("p").over(inner).alias("a"), F.bit_xor("q").over(inner).alias("b"))
    run = run.join(sums, ["conv_id", "first"], "left")
    a, b = (F.col(x).bitwiseXOR(F.coalesce(y, F.lit(0).cast("long"))) for x, y in (("a", "p0"), ("b", "q0")))
    run = run.select("conv_id", "depth", a.alias("a"), b.alias("b"), "p", "q", "bytes", (F.col("depth") == F.col("total")).alias("ends"))
    return run.select("conv_id", "depth", "a", "b", F.col("a").bitwiseXOR(F.col("p")).alias("up_a"), F.col("b").bitwiseXOR(F.col("q")).alias("up_b"), "bytes", "ends")


def _pieces(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by (a, b, conv_id): up to IDS_PER_PIECE ids of a node joined with commas."""
    own, first, ids, names = None, 0, [], ["a", "b", "first", "ids"]
    for frame in frames:
        out = []
        for a, b, c in zip(frame["a"].tolist(), frame["b"].tolist(), frame["conv_id"].tolist()):
            if own != (a, b) or len(ids) == IDS_PER_PIECE:
                if ids:
                    out.append((*own, first, ",".join(ids)))
                own, first, ids = (a, b), c, []
            ids.append(str(c))
        yield pd.DataFrame(out, columns=names)
    if ids:
        yield pd.DataFrame([(*own, first, ",".join(ids))], columns=names)


def _hashed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pieces sorted by (a, b, first): the hash of each node's ids. A hash is taken in order, so a node's pieces pass one task; it holds one piece."""
    own, sha, names = None, hashlib.sha256(), ["a", "b", "ends_sha256"]
    for frame in frames:
        out = []
        for a, b, ids in zip(frame["a"].tolist(), frame["b"].tolist(), frame["ids"]):
            if own != (a, b):
                if own is not None:
                    out.append((*own, sha.hexdigest()))
                own, sha = (a, b), hashlib.sha256(ids.encode())
            else:
                sha.update(b"," + ids.encode())
        yield pd.DataFrame(out, columns=names)
    if own is not None:
        yield pd.DataFrame([(*own, sha.hexdigest())], columns=names)


def _ends(rows: DataFrame) -> DataFrame:
    """``a, b, ends_sha256`` from a row ``a, b, conv_id`` for each conversation."""
    pieces = rows.repartitionByRange("a", "b", "conv_id").sortWithinPartitions("a", "b", "conv_id").mapInPandas(_pieces, "a long, b long, first long, ids string")
    return cut(pieces).repartition("a", "b").sortWithinPartitions("a", "b", "first").mapInPandas(_hashed, "a long, b long, ends_sha256 string")


def subtree_totals(nodes: DataFrame, sums: list[str]) -> DataFrame:
    """``id`` and the totals of ``sums`` over each node's subtree, by rake and compress.

    ``nodes``: ``id, parent`` (null for a root) and the columns to add up, which are integers. Any forest will do.
    """
    active = cut(nodes.select("id", "parent", *sums))
    raked, folded = [], []
    add = lambda a, b: [(F.col(f"{a}.{c}") + F.coalesce(F.col(f"{b}.{c}"), F.lit(0))).cast("long").alias(c) for c in sums]
    while not active.isEmpty():
        kids = cut(active.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("id")).agg(F.count(F.lit(1)).alias("kids"), F.min("id").alias("child")))
        # Compress: unary nodes but for roots, with the node below them.
        chain = cut(active.filter("parent IS NOT NULL").join(kids.filter("kids = 1").select("id", "child"), "id").select("id", F.col("child").alias("next"), "parent", *sums))
        if not chain.isEmpty():
            steps = chain.drop("parent")
            while True:
                on = steps.select(F.col("id").alias("next"), F.struct(F.col("next").alias("next"), *sums).alias("far"))
                steps = cut(steps.join(on, "next", "left").select("id", F.coalesce("far.next", "next").alias("next"), *[(F.col(c) + F.coalesce(f"far.{c}", F.lit(0))).alias(c) for c in sums], F.col("far").isNotNull().alias("more")))
                if steps.filter("more").isEmpty():
                    break
                steps = steps.drop("more")
            folded.append((len(raked), steps.select("id", F.col("next").alias("end"), *sums)))
            # The top of a chain hangs on a node that is not unary; the chain's end moves there, and its sum is added to that node.
            tops = chain.select("id", "parent").join(chain.select(F.col("id").alias("parent")), "parent", "left_anti")
            tops = cut(tops.join(steps.drop("more"), "id").select(F.col("next").alias("id"), F.col("parent").alias("above"), *sums))
            more = tops.groupBy(F.col("above").alias("id")).agg(*[F.sum(c).alias(c) for c in sums])
            rest = active.join(chain.select("id"), "id", "left_anti").join(tops.select("id", "above"), "id", "left").select("id", F.coalesce("above", "parent").alias("parent"), *sums)
            rest = rest.alias("o").join(more.alias("m"), F.col("o.id") == F.col("m.id"), "left").select("o.id", "o.parent", *add("o", "m"))
            active = cut(rest)
        # Rake: a node without children has its total.
        below = active.filter("parent IS NOT NULL").select(F.col("parent").alias("id")).distinct()
        leaves = cut(active.join(below, "id", "left_anti"))
        raked.append(leaves.select("id", *sums))
        up = leaves.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("id")).agg(*[F.sum(c).alias(c) for c in sums])
        rest = active.join(leaves.select("id"), "id", "left_anti").alias("o").join(up.alias("m"), F.col("o.id") == F.col("m.id"), "left")
        active = cut(rest.select("o.id", "o.parent", *add("o", "m")))
    # Re-expand: chains of the last round first, as their ends may have been folded or raked later than they.
    known = None
    for k in range(len(raked) - 1, -1, -1):
        known = raked[k] if known is None else known.unionByName(raked[k])
        for at, chain in folded:
            if at == k:
                known = cut(known)
                ends = known.select(F.col("id").alias("end"), *[F.col(c).alias(f"end_{c}") for c in sums])
                known = known.unionByName(chain.join(ends, "end").select("id", *[(F.col(c) + F.col(f"end_{c}")).cast("long").alias(c) for c in sums]))
    return nodes.select("id", *sums) if known is None else known


def prefix_trie(conversations: DataFrame, per_part: int = TURNS_PER_PART) -> DataFrame:
    """One row per node: ``conv_id`` (the smallest member), ``depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    Input columns ``conv_id, turn, role, text``; others are ignored. A null role or text is empty, rows without
    conv_id are no conversation's and left out, ties and repeated rows have one defined order (see ``rebuilt``) and stay. The
    root has every conversation, those without turns too; an empty table gives no row.
    """
    parts = rebuilt(conversations, per_part)
    rows = prefixes(parts)
    empty = parts.filter("total = 0").select("conv_id", F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"))
    rows = cut(rows)
    node = F.struct("a", "b").alias("id")
    trie = rows.groupBy("a", "b").agg(F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.min("up_a").alias("up_a"), F.min("up_b").alias("up_b"), F.count(F.lit(1)).alias("n_convs"), F.min("bytes").alias("bytes"))
    root = parts.groupBy().agg(F.min("conv_id").alias("conv_id"), F.count_distinct("conv_id").alias("n_convs")).filter("n_convs > 0")
    root = root.select(F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"), "conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("up_a"), F.lit(None).cast("long").alias("up_b"), "n_convs", F.lit(0).cast("long").alias("bytes"))
    trie = cut(trie.unionByName(root))
    up = F.struct(F.col("up_a").alias("a"), F.col("up_b").alias("b"))
    kids = trie.filter("depth > 0").groupBy(up.alias("id")).agg(F.count(F.lit(1)).alias("n_children"), F.sum((F.col("n_convs") == 1).cast("long")).alias("single"))
    trie = cut(trie.withColumn("id", node).join(kids, "id", "left").select("id", "a", "b", F.when(F.col("depth") > 0, up).alias("parent"), "conv_id", "depth", "n_convs", "bytes", F.coalesce("n_children", F.lit(0)).alias("n_children"), F.coalesce("single", F.lit(0)).alias("single")))
    # Paths of one member are leaves of what is shared; a shared node without children is one itself.
    leaf = F.when(F.col("n_children") == 0, 1).otherwise(F.col("single")).cast("long")
    shared = trie.filter("n_convs > 1").select("id", "parent", leaf.alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved_tokens"))
    totals = subtree_totals(shared, ["n_leaves", "saved_tokens"])
    ends = _ends(rows.filter("ends").select("a", "b", "conv_id").unionByName(empty.select("a", "b", "conv_id")))
    above = trie.filter("n_children > 0").select(F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    out = trie.join(totals, "id", "left").join(ends, ["a", "b"], "left")
    out = cut(out.drop("id")).join(cut(above).hint("merge"), "parent", "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.coalesce("n_leaves", F.lit(1)).cast("long").alias("n_leaves"), F.coalesce("saved_tokens", F.lit(0)).cast("long").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )


ORACLE = f"""
WITH asked AS (SELECT DISTINCT conv_id::VARCHAR AS s FROM conversations WHERE conv_id IS NOT NULL), {CRC_SQL},
n AS (SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT c, list({{'r': role, 'x': text}} ORDER BY turn NULLS FIRST, role, sha256(length(role)::VARCHAR || ':' || role || text)) AS m FROM n GROUP BY c),
h AS (SELECT c, m, crc % {MOST_SHARED} AS h FROM own JOIN crc ON s = c::VARCHAR),
re AS (SELECT h.c, coalesce(b.m[1:h.h], []) || h.m[h.h + 1:] AS m FROM h LEFT JOIN own b ON b.c = h.c - h.c % 5),
p AS (SELECT c, d, m[1:d] AS path, len(m) AS n FROM (SELECT c, m, unnest(range(len(m) + 1)) AS d FROM re)),
node AS (SELECT path, d, min(c) AS conv_id, count(*) AS n_convs, string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (n = d) AS ends FROM p GROUP BY path, d),
kids AS (SELECT path[1:d - 1] AS path, count(*) AS n_children FROM node WHERE d > 0 GROUP BY 1),
whole AS (SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN kids USING (path)),
sub AS (SELECT path[1:e] AS path, count(*) FILTER (n_children = 0) AS n_leaves, sum(CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * strlen(path[d].x) END) AS saved
        FROM (SELECT path, d, n_convs, n_children, unnest(range(d + 1)) AS e FROM whole) GROUP BY 1)
SELECT w.conv_id::BIGINT AS conv_id, w.d::BIGINT AS depth, up.conv_id::BIGINT AS parent_conv_id, w.n_convs::BIGINT AS n_convs, w.n_children::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, sha256(coalesce(w.ends, '')) AS ends_sha256
FROM whole w JOIN sub USING (path) LEFT JOIN node up ON w.d > 0 AND up.d = w.d - 1 AND up.path = w.path[1:w.d - 1]
"""
