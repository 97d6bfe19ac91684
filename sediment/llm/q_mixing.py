"""op2: all documents mixed to target weights over domain, language and source."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sediment.llm.mixing import mix
from sediment.llm.registry import query, table

# The target mixture. Nodes that are not listed weigh 1.
WEIGHTS = {
    ("web",): 5,
    ("books",): 3,
    ("web", "en"): 4,
    ("web", "fr"): 2,
    ("books", "en"): 2,
    ("web", "en", "src0"): 3,
}
SEED = 17
MAX_EPOCHS = 4
WORDS = r"[^\x20\x09-\x0D]+"

DOMAIN_SQL = "case when right(source, 1) in ('0', '2', '4', '6', '8') then 'web' when right(source, 1) in ('1', '3', '5') then 'books' else 'other' end"


def with_tree(docs: DataFrame) -> DataFrame:
    """Domain of the source by its last digit, and the number of words as tokens."""
    return docs.withColumn("domain", F.expr(DOMAIN_SQL)).withColumn("n_tokens", word_count(F.col("text")))


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORDS)).cast("bigint")


def _level_sql(name: str, above: str, keys: str, key: str, weight: str) -> str:
    """One level of the tree: ``name`` (keys, key, quota) from ``above`` (keys, quota)."""
    by = f"partition by {keys}"
    return f"""
{name}_nodes as (
  select {keys}, {key}, sum(capacity)::hugeint as capacity, ({weight})::hugeint as weight from leaves group by {keys}, {key}, weight),
{name}_asked as (select n.*, a.quota as budget from {name}_nodes n join {above} a using ({keys})),
{name}_order as (
  select *, (budget - coalesce(sum(capacity) over (w rows between unbounded preceding and 1 preceding), 0))::hugeint as rest,
         (sum(weight) over (w rows between current row and unbounded following))::hugeint as open_weight
  from {name}_asked window w as ({by} order by capacity::double / weight, {key})),
{name}_full as (
  select *, capacity * open_weight <= rest * weight as is_full from {name}_order),
{name}_open as (
  select *, (budget - coalesce(sum(capacity) filter (is_full) over ({by}), 0))::hugeint as r,
         (sum(weight) filter (not is_full) over ({by}))::hugeint as total_weight from {name}_full),
{name}_down as (
  select *, case when not is_full then (r * weight) // total_weight end as down,
         case when not is_full then (r * weight) % total_weight end as over_part from {name}_open),
{name} as (
  select {keys}, {key}, case when is_full then capacity else down + case when row_number() over (
           {by} order by is_full, over_part desc nulls last, {key}) <= r - coalesce(sum(down) over ({by}), 0) then 1 else 0 end end as quota
  from {name}_down)"""


def _weight_sql(columns: list[str]) -> str:
    cases = [
        "when " + " and ".join(f"{c} = '{v}'" for c, v in zip(columns, path, strict=True)) + f" then {w}"
        for path, w in WEIGHTS.items()
        if len(path) == len(columns)
    ]
    return f"case {' '.join(cases)} else 1 end"


def _order_sql(epoch: str) -> str:
    return f"('0x' || left(md5('{SEED}:' || {epoch} || ':' || doc_id), 15))::bigint"


SQL = f"""
with docs as (
  select doc_id, 0 as root, coalesce({DOMAIN_SQL}, '') as domain, coalesce(lang, '') as lang, coalesce(source, '') as source,
         len(regexp_extract_all(coalesce(text, ''), '{WORDS}'))::bigint as tokens
  from documents),
leaves as (
  select root, domain, lang, source, sum(tokens)::hugeint as tokens, sum(tokens)::hugeint * {MAX_EPOCHS} as capacity
  from docs where tokens > 0 group by all),
top as (select 0 as root, sum(tokens)::hugeint as quota from leaves),
{_level_sql("by_domain", "top", "root", "domain", _weight_sql(["domain"]))},
{_level_sql("by_lang", "by_domain", "root, domain", "lang", _weight_sql(["domain", "lang"]))},
{_level_sql("by_source", "by_lang", "root, domain, lang", "source", _weight_sql(["domain", "lang", "source"]))},
plan as (
  select l.*, (q.quota // l.tokens)::bigint as full_epochs, (q.quota % l.tokens)::bigint as rest
  from leaves l join by_source q using (root, domain, lang, source)),
placed as (
  select d.doc_id, d.domain, d.lang, d.source, d.tokens, p.full_epochs, p.rest, {_order_sql("p.full_epochs")} as place
  from docs d join plan p using (root, domain, lang, source) where d.tokens > 0),
ahead as (
  select *, coalesce(sum(tokens) over (partition by domain, lang, source order by place, doc_id::varchar
                                       rows between unbounded preceding and 1 preceding), 0)::bigint as before from placed)
select doc_id, domain, lang, source, e.epoch::int as epoch, tokens as prefix_tokens
from placed, lateral (select unnest(range(full_epochs)) as epoch) e
union all
select doc_id, domain, lang, source, full_epochs::int, least(tokens, rest - before) from ahead where before < rest
"""


@query("op2_mixing", SQL)
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_tree(table(spark, sf_dir, "documents")).select("doc_id", "domain", "lang", "source", "n_tokens")
    docs = docs.withColumns({c: F.coalesce(c, F.lit("")) for c in ("domain", "lang", "source")})
    mixed = mix(docs, ["domain", "lang", "source"], "doc_id", "n_tokens", WEIGHTS, max_epochs=MAX_EPOCHS, seed=SEED)
    return mixed.drop("n_tokens")
