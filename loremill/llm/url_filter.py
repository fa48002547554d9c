"""URL filters: host and path rules, and for the rest the ratio of two character language models.

The urls that a rule decides are the examples. What rules look at is left out of every url, of examples and of those
to be judged alike: the host's last label, further labels at its end that rules name, and the first part of the path. So the
models learn what such urls are like and not the rules, and an example's shape does not tell its rule. One variable-order Markov model is estimated on
the accepted, one on the rejected. Each model mixes orders 0 to 5: the estimate from a context counts as
far as the context was seen, the rest of the weight goes to the context that is one character shorter.

Counts are exact and stay in tables: the windows of six characters of all examples are counted, shorter
ones are sums of those. What is to be scored is also a table of distinct windows, and the estimates go up
order by order in joins of the two; a url's score is the mean over its windows. So nothing but the
histogram of calibration reaches the driver, and nothing is broadcast by hand.

The score is the difference of the log-likelihoods by character; the threshold is where it separates
best the examples of hosts that the models were not estimated on.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from .shared import cut

#: (rule as text, verdict); a rule is a host and a path prefix.
Rules = tuple[tuple[str, str], ...]
ORDER, PRIOR, SYMBOLS = 5, 2.0, 256
#: One host in CALIBRATE is kept from the models to set the threshold; scores are counted in this many steps from -RANGE to RANGE.
CALIBRATE, STEPS, RANGE = 5, 2001, 10.0
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What stands before and after a text.
_BEGIN, _END = "\x02", "\x03"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` to ``/``, ``?``, ``#`` or the end, with A-Z lower-cased; path: from there to ``?``, ``#`` or the end. Both empty for null or no ``://``."""
    at = F.locate("://", F.coalesce(url, F.lit("")))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER), path


def rule_of(host: Column, path: Column, rules: Rules) -> Column:
    """The longest rule that fits: its host or a subdomain of it, and a path that starts with the rule's."""
    out = F.lit(None).cast("string")
    for text, _ in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        own, slash, prefix = text.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(slash + prefix)
        out = F.when(fits, F.lit(text)).otherwise(out)
    return out


def plain_url(host: Column, url: Column, rules: Rules) -> Column:
    """A url without scheme, without its host's last label and the labels before it that rules name, and without the first part of its path."""
    labels = F.split(host, r"\.")
    named = sorted({x for text, _ in rules for x in text.partition("/")[0].split(".")})
    left = F.slice(labels, F.lit(1), F.greatest(F.size(labels) - 1, F.lit(0)))
    known = lambda k: F.forall(F.slice(left, k + 1, F.size(left) + 1), lambda x: x.isin(*named)) if named else F.lit(False)
    # Where the labels that rules name begin: the first place from which all are such.
    keep = F.array_min(F.filter(F.sequence(F.lit(0), F.size(left)), known)) if named else F.size(left)
    begin = F.locate("://", url)
    rest = F.regexp_replace(F.substring(url, begin + 3 + F.char_length(host), F.char_length(url)), r"^/[^/?#]*", "")
    return F.when(begin > 0, F.concat(F.array_join(F.slice(left, F.lit(1), keep), "."), rest)).otherwise(url)


# ---- the models -------------------------------------------------------------------------------------


def windows(text: Column) -> Column:
    """The ORDER characters before each character of a text and the character itself; one more for the end."""
    padded = F.concat(F.lit(_BEGIN * ORDER), text, F.lit(_END))
    return F.transform(F.sequence(F.lit(1), F.char_length(text) + 1), lambda k: F.substring(padded, k, F.lit(ORDER + 1)))


def count_grams(examples: DataFrame) -> list[DataFrame]:
    """``gram, allow, block`` for each order from 0: how often examples (``text, verdict, n``) have each context with the character after it."""
    each = examples.select(F.explode(windows(F.col("text"))).alias("gram"), *[F.when(F.col("verdict") == v, F.col("n")).otherwise(0).alias(v) for v in ("allow", "block")])
    out = [cut(each.groupBy("gram").agg(F.sum("allow").alias("allow"), F.sum("block").alias("block")))]
    for k in range(ORDER, 0, -1):
        shorter = F.substring("gram", 2, k)
        out.append(cut(out[-1].groupBy(shorter.alias("gram")).agg(F.sum("allow").alias("allow"), F.sum("block").alias("block"))))
    return out[::-1]


def log_ratios(asked: DataFrame, counts: list[DataFrame]) -> DataFrame:
    """``gram, ratio``: for each window in ``asked`` (``gram``) the log of its character's estimate by the accepted against that by the rejected."""
    need = [asked]
    for k in range(ORDER, 0, -1):
        need.append(cut(need[-1].select(F.substring("gram", 2, k).alias("gram")).distinct()))
    total = counts[0].agg(F.sum("allow").alias("a"), F.sum("block").alias("b")).first()
    mix = lambda n, seen, below: (F.coalesce(F.col(n), F.lit(0)) + PRIOR * below) / (F.coalesce(seen, F.lit(0)) + PRIOR)
    even = F.lit(1 / SYMBOLS)
    known = need[ORDER].join(counts[0], "gram", "left").select("gram", mix("allow", F.lit(total.a), even).alias("p"), mix("block", F.lit(total.b), even).alias("q"))
    for k in range(1, ORDER + 1):
        context = F.substring("gram", 1, k)
        seen = counts[k].groupBy(context.alias("context")).agg(F.sum("allow").alias("a"), F.sum("block").alias("b"))
        own = need[ORDER - k].join(counts[k], "gram", "left").withColumn("context", context).withColumn("shorter", F.substring("gram", 2, k)).join(seen, "context", "left")
        own = own.join(cut(known).withColumnRenamed("gram", "shorter"), "shorter")
        known = own.select("gram", mix("allow", F.col("a"), F.col("p")).alias("p"), mix("block", F.col("b"), F.col("q")).alias("q"))
    return known.select("gram", F.log(F.col("p") / F.col("q")).alias("ratio"))


def score_texts(texts: DataFrame, counts: list[DataFrame]) -> DataFrame:
    """``text, score`` of distinct ``text``: the mean log ratio by character."""
    numbered = cut(texts.withColumn("k", F.monotonically_increasing_id()))
    each = numbered.select("k", F.explode(windows(F.col("text"))).alias("gram"))
    ratios = cut(log_ratios(cut(each.select("gram").distinct()), counts))
    sums = each.join(ratios.hint("merge"), "gram").groupBy("k").agg((F.sum("ratio") / F.count(F.lit(1))).alias("score"))
    return numbered.join(sums, "k").select("text", "score")


def threshold(scored: DataFrame) -> float:
    """Where ``verdict, score, n`` rows are separated best; 0 where a verdict is missing."""
    step = F.floor((F.greatest(F.least("score", F.lit(RANGE)), F.lit(-RANGE)) + RANGE) / (2 * RANGE) * (STEPS - 1))
    rows = scored.groupBy("verdict", step.cast("int").alias("step")).agg(F.sum("n").alias("n")).collect()  # at most 2 x STEPS
    tally = {v: np.bincount([r["step"] for r in rows if r["verdict"] == v], [r["n"] for r in rows if r["verdict"] == v], minlength=STEPS) for v in {r["verdict"] for r in rows}}
    if len(tally) < 2:
        return 0.0
    right = 1 - np.cumsum(tally["allow"]) / tally["allow"].sum() + np.cumsum(tally["block"]) / tally["block"].sum()
    best = np.flatnonzero(right >= right.max() - 1e-12)  # the middle of the steps that get the most of both right
    return float((best.mean() + 1) / (STEPS - 1) * 2 * RANGE - RANGE)


def filter_urls(pages: DataFrame, rules: Rules, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``id_col, host, path, rule, verdict, score``: one row per input row.

    ``verdict`` is the longest fitting rule's, else ``allow`` if the score reaches the threshold and
    ``block`` if not; ``score`` is null where a rule decides. A url without host has no rule. Where no rule
    decides any url, or all the same way, every score is 0 and the rest is allowed. Rules see host and path,
    the models all of the url but what rules look at (see ``plain_url``; null as empty). Copies of a url count each time and are scored once. Other
    columns are ignored, also ones named like the result's.
    """
    host, path = host_and_path(F.col("url"))
    own = pages.select(F.col(id_col).alias("id"), F.coalesce(F.col(url_col), F.lit("")).alias("url")).select("id", "url", host.alias("host"), path.alias("path"))
    own = own.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules)).withColumn("plain", plain_url(F.col("host"), F.col("url"), rules))
    says = F.create_map(*[F.lit(x) for r in rules for x in r])
    decided, open_ = own.filter("rule IS NOT NULL"), own.filter("rule IS NULL")
    kept = F.pmod(F.xxhash64("host"), F.lit(CALIBRATE)) == 0
    examples = cut(decided.groupBy(F.col("plain").alias("text"), says[F.col("rule")].alias("verdict"), kept.alias("kept")).agg(F.count(F.lit(1)).alias("n")))
    verdicts = {r["verdict"] for r in examples.filter("NOT kept").select("verdict").distinct().collect()}
    told = decided.select(F.col("id").alias(id_col), "host", "path", "rule", says[F.col("rule")].alias("verdict"), F.lit(None).cast("double").alias("score"))
    if len(verdicts) < 2:
        rest, least = open_.withColumn("score", F.lit(0.0)), 0.0
    else:
        texts = cut(open_.select(F.col("plain").alias("text")).union(examples.filter("kept").select("text")).distinct())
        scored = cut(score_texts(texts, count_grams(examples.filter("NOT kept"))))
        least = threshold(examples.filter("kept").join(scored, "text"))
        rest = open_.join(scored.withColumnRenamed("text", "plain").hint("merge"), "plain")
    verdict = F.when(F.col("score") >= least, "allow").otherwise("block")
    return told.unionByName(rest.select(F.col("id").alias(id_col), "host", "path", "rule", verdict.alias("verdict"), "score"))
