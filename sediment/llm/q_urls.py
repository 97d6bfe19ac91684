"""op1: every page judged by the lists in force when it was fetched.

The pages table has no fetch times and there is no table of list entries, so both are derived from the pages: times
from the page number, entries from hosts, their domains and first path segments.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sediment.llm.registry import query, table
from sediment.llm.url_lists import judge, url_host, url_segments

START = 1704067200
DAY = 86400

SQL = f"""
with pages_at as (
  select page_id, url, {START} + (page_id * 7919 % 366) * {DAY} + page_id % {DAY} as moment,
         regexp_extract(lower(url), '^[a-z]+://([^/:?#]*)', 1) as host,
         list_filter(string_split(regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1), '/'), lambda s: s <> '') as segs
  from pages),
hosts as (select host, min(page_id) as k from pages_at group by 1),
domains as (select regexp_extract(host, '[^.]+[.][^.]+$') as domain, min(page_id) as k from pages_at group by 1),
firsts as (select host || '/' || segs[1] as prefix, min(page_id) as k from pages_at where len(segs) > 0 group by 1),
entries as (
  select 'hosts' as list, 'block' as effect, 'host' as kind, host as pattern, d.action, {START} + (k % 200 + d.day) * {DAY} as moment
  from hosts, (values ('add', 0), ('remove', 60), ('add', 120)) d(action, day) where k % 3 = 0
  union all
  select 'domains', 'block', 'domain', domain, d.action, {START} + (k % 7 + d.day) * {DAY}
  from domains, (values ('add', 30), ('remove', 90), ('add', 100), ('remove', 200), ('add', 300)) d(action, day)
  union all
  select 'cleared', 'allow', 'prefix', prefix, d.action, {START} + (k % 100 + d.day) * {DAY}
  from firsts, (values ('add', 10), ('remove', 250)) d(action, day) where k % 5 = 0),
spans as (
  select *, lead(moment) over (partition by list, effect, kind, pattern order by moment) as until from entries),
held as (
  select p.page_id, s.* exclude (moment, until),
         row_number() over (partition by p.page_id order by case s.kind when 'prefix' then 3 when 'host' then 2 else 1 end desc,
                            length(s.pattern) desc, s.effect, s.pattern desc, s.list desc) as place,
         count(*) over (partition by p.page_id) as active
  from pages_at p join spans s on s.action = 'add' and s.moment <= p.moment and (s.until is null or p.moment < s.until)
   and case s.kind when 'host' then p.host = s.pattern
                   when 'domain' then p.host = s.pattern or ends_with(p.host, '.' || s.pattern)
                   else p.host || '/' || array_to_string(p.segs, '/') || '/' like replace(s.pattern, '_', '#_') || '/%' escape '#' end)
select p.page_id, p.host, cast(p.moment as bigint) as fetched_at, coalesce(h.effect = 'block', false) as blocked, h.effect, h.kind, h.pattern,
       h.list, coalesce(h.active, 0) as active
from pages_at p left join held h on h.page_id = p.page_id and h.place = 1
"""


def _dated(patterns: DataFrame, name: str, effect: str, kind: str, cycle: int, steps: list[tuple[str, int]]) -> DataFrame:
    """Entries for (pattern, k): each step at its day after a start that depends on k."""
    step = F.explode(F.array(*(F.struct(F.lit(a).alias("action"), F.lit(d).alias("day")) for a, d in steps))).alias("s")
    rows = patterns.select(F.lit(name).alias("list"), F.lit(effect).alias("effect"), F.lit(kind).alias("kind"), "pattern", "k", step)
    return rows.select("list", "effect", "kind", "pattern", "s.action", (F.lit(START) + (F.col("k") % cycle + F.col("s.day")) * DAY).alias("at"))


@query("op1_url_filter", SQL)
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    host, segments = url_host(F.col("url")), url_segments(F.col("url"))
    first = lambda pattern: pages.select("page_id", pattern.alias("pattern")).where("pattern is not null").groupBy("pattern").agg(F.min("page_id").alias("k"))
    domain = F.regexp_extract(host, r"[^.]+[.][^.]+$", 0)
    entries = (
        _dated(first(host).where("k % 3 = 0"), "hosts", "block", "host", 200, [("add", 0), ("remove", 60), ("add", 120)])
        .unionByName(_dated(first(domain), "domains", "block", "domain", 7, [("add", 30), ("remove", 90), ("add", 100), ("remove", 200), ("add", 300)]))
        .unionByName(_dated(first(F.when(F.size(segments) > 0, F.concat_ws("/", host, segments[0]))).where("k % 5 = 0"), "cleared", "allow", "prefix", 100, [("add", 10), ("remove", 250)]))
    )
    at = F.lit(START).cast("long") + (F.col("page_id") * 7919 % 366) * DAY + F.col("page_id") % DAY
    found = judge(pages.select(F.col("page_id").alias("id"), "url", at.alias("at")), entries)
    return found.select(F.col("id").alias("page_id"), "host", F.col("at").alias("fetched_at"), "blocked", "effect", "kind", "pattern", "list", "active")
