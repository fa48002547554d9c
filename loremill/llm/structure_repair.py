"""Repair of conversation structure by an auction algorithm for shortest paths.

A dialogue is right when the initials of its roles read ``(s?(ua)+)?``: nothing, or a system message if
there is one, and then user and assistant in turns. The cheapest edits that make it so are a shortest
path in a lattice of (messages behind us, last role), with integer costs on the arcs: keep a message, give
it the other role, delete it, insert an empty one.

The path is found by auction: each node has a price, a path grows from the origin along the arc of least
cost plus price while the price of its end agrees with that (extension); where it does not, the price is
raised and the end given up (contraction). Prices start from what each message costs at least, and stay
below the distance to the destination, so at the end every arc of every shortest path is tight: its cost is
the difference of its prices. Of the tight arcs that lead to the destination the least letter is followed from
the origin, which gives the least string of all cheapest edits, as no two arcs out of a node have one letter.

Messages are taken in parts. A dialogue of one part is solved at once. A longer one is solved in three
steps: each part by itself gives the distances from each of its four entries to each of its exits, and the order of
the strings of edits; one pass from the last part to the first carries the distances to the end, and one in order
the states, on a short row for each part; then every part follows its own path. Texts are only moved to be put in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructField, StructType

from .shared import cut, numbered

#: Costs of the edits, and what a truncated message costs besides unless it is deleted.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
MESSAGES_PER_PART = 128
#: States: nothing yet, system, user, assistant. The role that each state still takes besides a first system message, and the state after it.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = ((USER, "user"), (USER, "user"), (ASSISTANT, "assistant"), (USER, "user"))
FAR = 1 << 40
BLANK, DUPLICATE, CUT_OFF, FINE = "bdt-"


def _kept(state: int, initial: str) -> int | None:
    """The state after keeping a message, or None."""
    if initial == "s":
        return SYSTEM if state == START else None
    return NEXT[state][0] if initial == NEXT[state][1][0] else None


class Lattice:
    """The arcs of some messages (``initials`` and ``faults``, a letter each) and the prices of their nodes.

    ``exits`` are the states that the last layer leads to the destination from; ``last`` says whether
    messages may be inserted after the last one. Nodes are ``4 * layer + state``, the destination is the last.
    """

    def __init__(self, initials: str, faults: str, exits: tuple[int, ...], last: bool):
        n = len(initials)
        self.n, self.goal = n, 4 * n + 4
        # No way leads back from user and assistant, so states that cannot reach the exits have no arcs.
        states = range(4) if max(exits) >= USER else range(max(exits) + 1)
        self.arcs: list[list[tuple[str, int, int, str | None]]] = [[] for _ in range(4 * n + 5)]
        for k in range(n + 1):
            for q in states:
                out = self.arcs[4 * k + q]
                then, role = NEXT[q]
                if k < n:
                    out.append(("D", DELETE, 4 * k + 4 + q, None))
                    extra = TRUNCATED if faults[k] == CUT_OFF else 0
                    if faults[k] in (CUT_OFF, FINE):
                        kept = _kept(q, initials[k])
                        if kept is not None and kept in states:
                            out.append(("K", extra, 4 * k + 4 + kept, None))
                        if then in states:
                            out.append(("R", REROLE + extra, 4 * k + 4 + then, role))
                if then in states and (k < n or last):
                    out.append(("I", INSERT, 4 * k + then, role))
                if k == n and q in exits:
                    out.append(("", 0, self.goal, None))
        # What is still to come costs at least this much.
        self.price = [0] * (4 * n + 5)
        for k in range(n - 1, -1, -1):
            least = self.price[4 * k + 4] + {BLANK: DELETE, DUPLICATE: DELETE, CUT_OFF: TRUNCATED}.get(faults[k], 0)
            self.price[4 * k : 4 * k + 4] = [least] * 4

    def auction(self, entry: int) -> int:
        """Distance from the entry to the destination, FAR if there is none. Prices that are already there are kept."""
        price, arcs, path = self.price, self.arcs, [entry]
        while True:
            node = path[-1]
            best, to = FAR, -1
            for _, cost, other, _ in arcs[node]:
                if cost + price[other] < best:
                    best, to = cost + price[other], other
            if price[node] < best:
                price[node] = best
                if len(path) > 1:
                    path.pop()
                elif best >= FAR:
                    return FAR
            elif to == self.goal:
                return price[entry]
            elif to < 0:
                return FAR
            else:
                path.append(to)

    def follow(self, entry: int) -> list[tuple[str, int, str | None]]:
        """(letter, message, role) of the least cheapest edits, after ``auction`` from this entry."""
        leads = [False] * len(self.arcs)
        leads[self.goal] = True
        tight: list[list] = [[]] * len(self.arcs)
        for k in range(self.n, -1, -1):
            nodes = range(4 * k, 4 * k + 4)
            for v in nodes:
                tight[v] = [a for a in self.arcs[v] if self.price[v] == a[1] + self.price[a[2]] < FAR]
            for _ in range(4):  # inserts stay in the layer
                for v in nodes:
                    leads[v] = leads[v] or any(leads[a[2]] for a in tight[v])
        out, node = [], entry
        while node != self.goal:
            letter, _, to, role = min((a for a in tight[node] if leads[a[2]]), key=lambda a: a[0])
            if letter:
                out.append((letter, node // 4, role))
            node = to
        return out


def _edits(initials: str, faults: str, entry: int, exits: tuple[int, ...], last: bool) -> tuple[int, str, list[int], list[str | None]]:
    """Cost, string of edits, and the messages that are left: their numbers (-1: inserted) and new roles (None: their own)."""
    lattice = Lattice(initials, faults, exits, last)
    cost = lattice.auction(entry)
    way = lattice.follow(entry)
    left = [(-1 if letter == "I" else k, role) for letter, k, role in way if letter != "D"]
    return cost, "".join(letter for letter, _, _ in way), [k for k, _ in left], [role for _, role in left]


EDITS = "cost long, audit string, at array<int>, new array<string>"


def _solve(initials: pd.Series, faults: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([_edits(i, f, START, (START, ASSISTANT), True) for i, f in zip(initials, faults)], columns=["cost", "audit", "at", "new"])


def _solve_part(initials: pd.Series, faults: pd.Series, entry: pd.Series, leave: pd.Series) -> pd.DataFrame:
    """``leave`` is the exit, or -1 at the end of a dialogue."""
    rows = zip(initials, faults, entry, leave)
    return pd.DataFrame([_edits(i, f, q, (START, ASSISTANT) if x < 0 else (x,), x < 0) for i, f, q, x in rows], columns=["cost", "audit", "at", "new"])


def _between(initials: pd.Series, faults: pd.Series, last: pd.Series) -> pd.DataFrame:
    """Distances from each entry (rows) to each exit, and of each entry's strings the place in order. In a last part the only exit is the end."""

    def table(i: str, f: str, end: bool) -> tuple[list[int], list[int]]:
        far, texts = [FAR] * 16, [""] * 16
        for x in [ASSISTANT] if end else range(4):
            lattice = Lattice(i, f, (START, ASSISTANT) if end else (x,), end)
            for q in range(4) if end or x >= USER else range(x + 1):
                far[4 * q + x] = lattice.auction(q)
                if far[4 * q + x] < FAR:
                    texts[4 * q + x] = "".join(s for s, _, _ in lattice.follow(q))
        return far, [sorted(texts[q : q + 4]).index(texts[q + x]) for q in range(0, 16, 4) for x in range(4)]

    return pd.DataFrame([table(*row) for row in zip(initials, faults, last)], columns=["far", "rank"])


def _backwards(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Parts of dialogues, the last first: the exit that each entry of a part leads to. Holds four distances."""
    own, ahead = None, [0] * 4
    for frame in frames:
        out = []
        for key, part, last, far, rank in zip(frame["key"], frame["part"], frame["last"], frame["far"], frame["rank"]):
            if own != key:
                own, ahead = key, [0] * 4
            best = [min((min(far[4 * q + x] + ahead[x], FAR), rank[4 * q + x], x) for x in range(4)) for q in range(4)]
            ahead = [b[0] for b in best]
            out.append((key, part, [-1 if last else b[2] for b in best]))
        yield pd.DataFrame(out, columns=["key", "part", "goes"])


def _forwards(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    own, state = None, START
    for frame in frames:
        out = []
        for key, part, goes in zip(frame["key"], frame["part"], frame["goes"]):
            if own != key:
                own, state = key, START
            out.append((key, part, state, goes[state]))
            state = goes[state]
        yield pd.DataFrame(out, columns=["key", "part", "entry", "leave"])


def _joined(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Parts of dialogues in order: sums, the string of edits and the hash of the repaired text. A hash is taken in order, so one task reads a dialogue; it holds one part."""
    names = ["key", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    own, sums, audit, sha, end, begun = None, [], [], hashlib.sha256(), "", False

    def row() -> tuple:
        return (own, *sums, "".join(audit), sha.hexdigest())

    for frame in frames:
        out = []
        for key, initials, faults, cost, edits, texts, kept in zip(*[frame[c] for c in ("key", "initials", "faults", "cost", "audit", "repaired", "kept")]):
            if own != key:
                if own is not None:
                    out.append(row())
                own, sums, audit, sha, end, begun = key, [0] * 5, [], hashlib.sha256(), "", False
            sums = [s + x for s, x in zip(sums, (faults.count(BLANK), faults.count(DUPLICATE), faults.count(CUT_OFF), _illegal(end + initials), cost))]
            audit.append(edits)
            if kept:
                sha.update((b"\n" if begun else b"") + texts.encode())
                begun = True
            end = initials[-1]
        yield pd.DataFrame(out, columns=names)
    if own is not None:
        yield pd.DataFrame([row()], columns=names)


def _illegal(initials: str) -> int:
    return sum(initials[i : i + 2] not in ("su", "ua", "au") for i in range(len(initials) - 1))


def _faults(seen: Column | None = None) -> Column:
    """A letter for each message of ``m``. ``seen``: places of messages that an earlier part has."""
    keys = F.transform("m", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text")))

    def of(x: Column, i: Column) -> Column:
        again = F.array_position(F.col("ks"), F.col("ks")[i]) <= i
        return (
            F.when(~x["text"].rlike(r"[^\x20\x09-\x0D]"), BLANK)
            .when(again if seen is None else again | F.array_contains(seen, i), DUPLICATE)
            .when(x["text"].rlike(r"[^.!?\x20\x09-\x0D][\x20\x09-\x0D]*+\z"), CUT_OFF)
            .otherwise(FINE)
        )

    return keys, F.array_join(F.transform("m", of), "")


def _lines() -> Column:
    """``role:text`` of the messages that are left."""
    line = lambda k, role: F.concat(F.coalesce(role, F.col("m")[F.greatest(k, F.lit(0))]["role"]), F.lit(":"), F.when(k < 0, "").otherwise(F.col("m")[F.greatest(k, F.lit(0))]["text"]))
    return F.array_join(F.zip_with("e.at", "e.new", line), "\n")


def repair(conversations: DataFrame, per_part: int = MESSAGES_PER_PART) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`` for each dialogue.

    Input columns ``conv_id, turn, role, text``; others are ignored. Messages are in order of turn (null first),
    then role, then text, so ties and repeated rows have one defined order. A null role or text is one space,
    all rows without conv_id are one dialogue, an empty table gives no row. ``audit`` has a letter for each edit: K keep, R
    other role, D delete, I insert. A message's fault is the first that holds: blank, duplicate of an earlier one in
    role and text, truncated (no end mark). Blank ones and duplicates must go,
    and a role that begins with another letter, or is empty, has no place as it is.
    """
    key = F.to_json(F.struct(F.col("conv_id").alias("c"))).alias("conv")
    messages = conversations.select(key, "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    parts = cut(numbered(messages, per_part))
    initials = F.array_join(F.transform("m", lambda x: F.when(x["role"].rlike("^[sua]"), F.substring(x["role"], 1, 1)).otherwise(".")), "")
    parts = parts.withColumn("initials", initials)
    # Digests stand for texts where only equality counts.
    of = cut(parts.groupBy("conv").agg(F.max("part").alias("end")).filter("end > 0"))
    keys, faults = _faults()
    one = parts if of.isEmpty() else parts.join(of, "conv", "left_anti")
    turns = F.filter(F.transform("m", lambda x: x["turn"]), lambda t: t.isNotNull())
    solved = one.withColumn("ks", keys).withColumn("faults", faults).withColumn("e", F.pandas_udf(_solve, EDITS)("initials", "faults"))
    count = lambda letter: F.length(F.regexp_replace("faults", f"[^{letter}]", "")).cast("long")
    pairs = F.filter(F.sequence(F.lit(1), F.length("initials")), lambda i: (i < F.length("initials")) & ~F.expr("initials").substr(i, F.lit(2)).isin("su", "ua", "au"))
    gaps = F.coalesce(F.array_max("turns") - F.array_min("turns") + 1 - F.size(F.array_distinct("turns")), F.lit(0)).cast("long")
    done = solved.withColumn("turns", turns).select(
        "conv", gaps.alias("gaps"), count("b").alias("blank"), count("d").alias("duplicate"), count("t").alias("truncated"), F.size(pairs).cast("long").alias("illegal"),
        F.col("e.cost").alias("cost"), F.col("e.audit").alias("audit"), F.sha2(_lines(), 256).alias("repaired_sha256"),
    )
    if not of.isEmpty():
        done = done.unionByName(_long(parts.join(of, "conv")))
    conv_id = F.from_json("conv", StructType([StructField("c", conversations.schema["conv_id"].dataType)]))["c"]
    return done.select(conv_id.alias("conv_id"), *done.columns[1:])


def _long(parts: DataFrame) -> DataFrame:
    """Dialogues of several parts (``conv, part, m, initials, end``)."""
    digest = lambda x: F.sha2(F.concat(F.length(x["role"]).cast("string"), F.lit(":"), x["role"], x["text"]), 256)
    held = cut(parts.select("conv", "part", F.posexplode(F.transform("m", digest)).alias("i", "sha")))
    first = cut(held.groupBy("conv", "sha").agg(F.min("part").alias("first")))
    later = held.join(first.hint("merge"), ["conv", "sha"]).filter("part > first").groupBy("conv", "part").agg(F.collect_list("i").alias("seen"))
    keys, faults = _faults(F.coalesce("seen", F.array().cast("array<int>")))
    known = parts.join(cut(later).hint("merge"), ["conv", "part"], "left").withColumn("ks", keys).withColumn("faults", faults).drop("ks", "seen")
    known = cut(known.withColumn("last", F.col("part") == F.col("end")))
    table = cut(known.withColumn("t", F.pandas_udf(_between, "far array<long>, rank array<int>")("initials", "faults", "last")).select(F.col("conv").alias("key"), "part", "last", "t.far", "t.rank"))
    goes = cut(table.repartition("key").sortWithinPartitions("key", F.desc("part")).mapInPandas(_backwards, "key string, part long, goes array<int>"))
    ways = cut(goes.repartition("key").sortWithinPartitions("key", "part").mapInPandas(_forwards, "key string, part long, entry int, leave int"))
    led = known.join(ways.withColumnRenamed("key", "conv").hint("merge"), ["conv", "part"]).withColumn("e", F.pandas_udf(_solve_part, EDITS)("initials", "faults", "entry", "leave"))
    told = cut(led.select(F.col("conv").alias("key"), "part", "initials", "faults", F.col("e.cost").alias("cost"), F.col("e.audit").alias("audit"), _lines().alias("repaired"), F.size("e.at").alias("kept")))
    out = told.repartition("key").sortWithinPartitions("key", "part").mapInPandas(_joined, "key string, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")
    turns = parts.select("conv", F.explode("m.turn").alias("turn")).filter("turn IS NOT NULL").distinct().groupBy("conv").agg((F.max("turn") - F.min("turn") + 1 - F.count(F.lit(1))).alias("gaps"))
    out = out.withColumnRenamed("key", "conv").join(turns, "conv", "left")
    return out.select("conv", F.coalesce("gaps", F.lit(0)).cast("long").alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with a known share of faults: by the checksum of ``conv_id:turn`` rows are dropped, emptied, cut off, repeated or given to the user. Nulls become one space, but for ids and turns, which only count as one."""
    told = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(told("conv_id"), F.lit(":"), told("turn"))) % 20
    role = F.when(F.col("fate") == 4, "user").otherwise(F.coalesce("role", F.lit(" ")))
    own = F.coalesce("text", F.lit(" "))
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace(own, "[.!?]", "")).otherwise(own)
    times = F.when(F.col("fate") == 3, 2).otherwise(1)
    rows = conversations.select("conv_id", "turn", "role", "text").withColumn("fate", fate).filter("fate <> 0")
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.sequence(F.lit(1), times)).alias("copy")).drop("copy")


def repair_damaged(conversations: DataFrame, per_part: int = MESSAGES_PER_PART) -> DataFrame:
    """``repair`` of the damaged table, with a row for every conv_id of the given one: zeros, no edits and the hash of nothing where no row is left."""
    fixed = repair(damaged(conversations), per_part).withColumnRenamed("conv_id", "of")
    every = conversations.select("conv_id").distinct()
    full = every.join(fixed, F.col("conv_id").eqNullSafe(F.col("of")), "left")
    sums = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return full.select("conv_id", *sums, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))


#: SQL for crc32 of the ASCII string in column ``s`` of ``asked``: the table of remainders by its rule, then one step a byte.
CRC_SQL = """
poly AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i::BIGINT, range(8)), lambda v, k: CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END) AS v FROM range(256) r(i))),
crc AS (SELECT s, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(s, ''), lambda c: ord(c)::BIGINT)), lambda a, b: xor(t[(xor(a, b) & 255) + 1], a >> 8)), 4294967295) AS crc FROM asked, poly)"""

ORACLE = f"""
WITH RECURSIVE asked AS (SELECT DISTINCT coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS s FROM conversations), {CRC_SQL},
hit AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, crc % 20 AS fate FROM conversations JOIN crc ON s = coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')),
hurt AS (SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role, CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
         FROM hit, range(2) c(copy) WHERE fate <> 0 AND (copy = 0 OR fate = 3)),
m AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS k FROM hurt),
g AS (SELECT *, k > min(k) OVER (PARTITION BY conv_id, role, text) AS again FROM m),
f AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'b' WHEN again THEN 'd' WHEN regexp_matches(text, '[^.!?\\x20\\x09-\\x0D][\\x20\\x09-\\x0D]*$') THEN 't' ELSE '-' END AS fault,
        substr(role, 1, 1) AS letter, lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY k) AS before FROM g),
told AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
           count(*) FILTER (before IS NOT NULL AND before || letter NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM f GROUP BY conv_id),
takes(q, role, q2) AS (VALUES ('^', 'user', 'u'), ('s', 'user', 'u'), ('u', 'assistant', 'a'), ('a', 'user', 'u')),
-- The cheapest edits of the first k messages for each state: one insertion before a message at most, as two in a row are never worth it.
way AS (
  SELECT conv_id, 0::BIGINT AS k, '^' AS q, 0 AS c, '' AS a, [''][:0] AS r FROM told
  UNION ALL
  SELECT conv_id, k, q, c, a, r FROM (
    SELECT conv_id, k + 1 AS k, q, c, a, r, row_number() OVER (PARTITION BY conv_id, q ORDER BY c, a) AS nth FROM (
      SELECT conv_id, k, unnest([
          {{'q': q, 'c': c + {DELETE}, 'a': a || 'D', 'r': r, 'ok': true}},
          {{'q': CASE WHEN letter = 's' THEN 's' ELSE q2 END, 'c': c + x, 'a': a || 'K', 'r': list_append(r, role || ':' || text), 'ok': fault IN ('-', 't') AND (letter = q2 OR (letter = 's' AND q = '^'))}},
          {{'q': q2, 'c': c + x + {REROLE}, 'a': a || 'R', 'r': list_append(r, need || ':' || text), 'ok': fault IN ('-', 't')}}], recursive := true)
      FROM (SELECT w.conv_id, w.k, w.q, w.c, w.a, w.r, t.q2, t.role AS need, f.role, f.text, f.fault, f.letter, CASE WHEN f.fault = 't' THEN {TRUNCATED} ELSE 0 END AS x
            FROM (SELECT * FROM way UNION ALL SELECT conv_id, k, q2, c + {INSERT}, a || 'I', list_append(r, takes.role || ':') FROM way JOIN takes USING (q)) w
            JOIN takes t USING (q) JOIN f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.k = w.k)) WHERE ok) WHERE nth = 1),
ends AS (SELECT way.*, told.n FROM way JOIN told ON way.conv_id IS NOT DISTINCT FROM told.conv_id AND way.k = told.n),
best AS (SELECT conv_id, c, a, r FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY c, a) AS nth FROM (
           SELECT conv_id, q, c, a, r FROM ends UNION ALL SELECT conv_id, q2, c + {INSERT}, a || 'I', list_append(r, takes.role || ':') FROM ends JOIN takes USING (q)) WHERE q IN ('^', 'a')) WHERE nth = 1)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal,
       coalesce(c, 0)::BIGINT AS cost, coalesce(a, '') AS audit, sha256(coalesce(array_to_string(r, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN told ON o.conv_id IS NOT DISTINCT FROM told.conv_id LEFT JOIN best ON o.conv_id IS NOT DISTINCT FROM best.conv_id
"""
