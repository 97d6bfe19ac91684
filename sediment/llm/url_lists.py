"""Dated URL lists: entries become validity segments, and an as-of join judges each capture by what held at fetch time.

Only DataFrame functions. Time is cut into periods, and segments never cross a period's bounds, so captures meet
segments by (pattern, period): a pattern that covers very many captures or changes very often is dealt by period,
and no history of a pattern has to be in one task. What carries over from period to period is one row for each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sediment.llm.common import stored

PERIOD = 30 * 86400
#: How closely each kind of entry matches.
CLOSENESS = {"domain": 1, "host": 2, "prefix": 3}


def url_host(url: Column) -> Column:
    """Host in lower case, without user, port and final dot; null if there is none."""
    authority = F.regexp_extract(F.lower(url), r"^\s*[a-z][a-z0-9+.\-]*://(?:[^/?#]*@)?(\[[^\]/?#]*\]|[^:/?#]*)", 1)
    host = F.rtrim(F.regexp_replace(authority, r"\.$", ""))
    return F.when(host != "", host)


def url_segments(url: Column) -> Column:
    """Path segments without empty ones; query and fragment left out."""
    path = F.regexp_extract(url, r"^\s*[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)
    return F.filter(F.split(path, "/"), lambda s: s != "")


def validity_segments(entries: DataFrame, horizon: int, period: int = PERIOD) -> DataFrame:
    """(list, effect, kind, pattern, period, since, until): when each entry holds, cut at period bounds.

    ``entries`` has list, effect (block or allow), kind (domain, host, prefix), pattern, action (add or remove) and
    at (seconds). An entry holds from an add up to the next remove; of an add and a remove at the same second the
    remove counts; further adds change nothing. What was not removed holds up to ``horizon``. Rows without pattern,
    time or a known kind or action say nothing.
    """
    key = ["list", "effect", "kind", "pattern"]
    known = F.col("kind").isin(*CLOSENESS) & F.col("action").isin("add", "remove") & F.col("pattern").isNotNull() & F.col("at").isNotNull()
    events = entries.where(known & (F.col("at") < horizon)).select(*(F.coalesce(k, F.lit("")).alias(k) for k in key), "at", "action")
    events = events.groupBy(*key, "at").agg(F.min(F.col("action") == "add").alias("on"))
    events = events.withColumn("period", F.floor(F.col("at") / period))
    by_period = events.groupBy(*key, "period").agg(F.max_by("on", "at").alias("last"), F.min("at").alias("first_at"))
    history = Window.partitionBy(*key).orderBy("period")
    by_period = by_period.withColumn("before", F.lag("last").over(history)).withColumn("next", F.lead("period").over(history))
    inside = Window.partitionBy(*key, "period").orderBy("at")
    ends = (F.col("period") + 1) * period
    changes = events.withColumn("until", F.coalesce(F.lead("at").over(inside), ends)).where("on")
    changes = changes.select(*key, "period", F.col("at").alias("since"), "until")
    carried = by_period.where("before").select(*key, "period", (F.col("period") * period).alias("since"), F.col("first_at").alias("until"))
    beyond = F.coalesce(F.col("next"), F.floor(F.lit(horizon) / period) + 1) - 1
    quiet = by_period.where(F.col("last") & (beyond > F.col("period"))).select(*key, F.explode(F.sequence(F.col("period") + 1, beyond)).alias("period"))
    quiet = quiet.select(*key, "period", (F.col("period") * period).alias("since"), ends.alias("until"))
    return changes.unionByName(carried).unionByName(quiet).where("since < until")


def _keys(host: Column, segments: Column, deepest: dict[str, int]) -> Column:
    """What an entry may be called that covers the URL: the host, its parent domains, its path prefixes.

    No longer keys are made than the deepest pattern of each kind.
    """
    labels = F.split(host, r"\.")
    n = F.size(labels)
    count = F.least(n, F.lit(deepest["domain"]))
    is_address = host.rlike(r"^([0-9.]+|\[.*\])$")
    none = F.array().cast("array<struct<kind:string,pattern:string>>")
    key = lambda kind, pattern: F.struct(F.lit(kind).alias("kind"), pattern.alias("pattern"))
    parents = F.transform(F.sequence(F.lit(1), count), lambda k: key("domain", F.array_join(F.slice(labels, n - k + 1, k), ".")))
    domains = F.when(is_address, F.array(key("domain", host))).when(count > 0, parents).otherwise(none)
    depth = F.least(F.size(segments), F.lit(deepest["prefix"] - 1))
    prefix = lambda k: key("prefix", F.concat_ws("/", host, F.slice(segments, 1, k)))
    prefixes = F.when(depth > 0, F.transform(F.sequence(F.lit(1), depth), prefix)).otherwise(none)
    return F.concat(domains, F.array(key("host", host)), prefixes)


def judge(captures: DataFrame, entries: DataFrame, period: int = PERIOD) -> DataFrame:
    """(id, url, at, host, blocked, effect, kind, pattern, list, active) for every row of ``captures`` (id, url, at).

    Of the entries that hold at the capture's second the closest one decides: prefix before host before domain, then
    the longer pattern, then allow before block, then by pattern and list. Without any, with no host or no time, a
    capture is not blocked and the rule is null. Repeated captures get a row each.
    """
    captures = captures.select("id", "url", "at").withColumn("host", url_host(F.col("url")))
    horizon = (captures.agg(F.max("at")).first()[0] or 0) + 1
    segments = stored(validity_segments(entries, horizon, period), "url-segments")
    depths = segments.groupBy("kind").agg(F.max(F.when(F.col("kind") == "prefix", F.size(F.split("pattern", "/"))).otherwise(F.size(F.split("pattern", r"\."))))).collect()
    deepest = dict.fromkeys(CLOSENESS, 0) | dict(map(tuple, depths))
    named = captures.where("host is not null and at is not null").select("id", "url", "at", "host").distinct()
    keys = F.explode(_keys(F.col("host"), url_segments(F.col("url")), deepest)).alias("k")
    asked = named.select("id", "url", "at", F.floor(F.col("at") / period).alias("period"), keys).select("id", "url", "at", "period", "k.kind", "k.pattern")
    held = asked.join(segments, ["kind", "pattern", "period"]).where("since <= at and at < until")
    close = F.lit(0)
    for kind, rank in CLOSENESS.items():
        close = F.when(F.col("kind") == kind, rank).otherwise(close)
    rule = F.struct(close.alias("close"), F.length("pattern").alias("length"), (F.col("effect") == "allow").alias("allow"), "pattern", "list", "effect", "kind")
    verdicts = held.groupBy("id", "url", "at").agg(F.max(rule).alias("rule"), F.count(F.lit(1)).alias("active"))
    c, v = captures.alias("c"), verdicts.alias("v")
    found = c.join(v, F.expr("c.id <=> v.id and c.url <=> v.url and c.at <=> v.at"), "left")
    return found.selectExpr(
        "c.id", "c.url", "c.at", "c.host",
        "coalesce(v.rule.effect = 'block', false) as blocked",
        "v.rule.effect as effect", "v.rule.kind as kind", "v.rule.pattern as pattern", "v.rule.list as list",
        "coalesce(v.active, 0) as active",
    )
