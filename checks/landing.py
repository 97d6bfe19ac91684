"""Landing, snapshots, time travel and arrivals, on files that Spark writes from the given tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from checks.registry import query
from sediment.functions.text import safe_int, safe_key
from sediment.operators.documents import nest_collections
from sediment.plans.order_star import table
from sediment.session import scratch, shared_dir
from sediment.sources import delimited, provenance
from sediment.sources.documents import read_document_raw
from sediment.sources.files import children, put_if_absent
from sediment.sources.ingest import delimited_reader, ingest_one, ingest_snapshots
from sediment.sources.layers import read_layer, write_layer
from sediment.sources.snapshots import SnapshotTable
from sediment.streaming.arrivals import COMPLETE, stream_ingest

DOCUMENTS_PER_FILE = 1000


def export(df, name, header=False, partition_by=None):
    """Write semicolon-separated text the way a spreadsheet does: quotes doubled, spaces kept."""
    path = scratch(df.sparkSession, name)
    writer = df.write.options(
        sep=";", header=header, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.csv(path)
    return path


@query("raw_delimited", "select doc_id, text, lang, source from documents")
def raw_delimited(spark, sf_dir):
    """Whole document texts, with their line breaks and quotes, through text files and back."""
    path = export(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"), "documents")
    raw = delimited.read_delimited_raw(spark, path, "v1", root=path, width=4)
    return raw.select(
        safe_key("col_01", "bigint").alias("doc_id"),
        F.col("col_02").alias("text"),
        F.col("col_03").alias("lang"),
        F.col("col_04").alias("source"),
    )


@query("raw_pages", "select page_id, url, html from pages")
def raw_pages(spark, sf_dir):
    path = export(table(spark, sf_dir, "pages").select("page_id", "url", "html"), "pages")
    records = delimited.read_records(spark, path)
    return records.select(
        F.get("fields", F.lit(0)).try_cast("bigint").alias("page_id"),
        F.get("fields", F.lit(1)).alias("url"),
        F.get("fields", F.lit(2)).alias("html"),
    )


@query("raw_provenance", "select 'v1' as version, count(*) as rows, count(*) as hashed, count(*) as placed from lineitem")
def raw_provenance(spark, sf_dir):
    """Every landed record names its version, its file and that file's content hash."""
    path = export(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity"), "lines")
    raw = delimited.read_delimited_raw(spark, path, "v1", root=path)
    known = provenance.file_hashes(spark, path).select(
        provenance.relative_to(F.col("path"), path).alias("file"), F.col("hash").alias("known")
    )
    joined = raw.join(known, F.col(provenance.ORIGIN) == F.col("file"), "left")
    return joined.groupBy(F.col(provenance.VERSION).alias("version")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(provenance.CONTENT_HASH) == F.col("known")).alias("hashed"),
        F.count("file").alias("placed"),
    )


@query("record_number", "select count(*) as records, 0::bigint as broken_files from documents")
def record_number(spark, sf_dir):
    """Ordinals of each file run from 1 without a gap or a repetition."""
    path = export(table(spark, sf_dir, "documents").select("doc_id", "text"), "numbered")
    numbers = delimited.read_records(spark, path).select("_file", "_record")
    wide = F.col("_record").cast("decimal(38,0)")
    per_file = numbers.groupBy("_file").agg(
        F.count(F.lit(1)).alias("n"), F.min("_record").alias("first"), F.max("_record").alias("last"), F.sum(wide).alias("total")
    )
    n = F.col("n").cast("decimal(19,0)")
    even = (F.col("first") == 1) & (F.col("last") == F.col("n")) & (F.col("total") * 2 == n * (n + 1))
    return per_file.agg(F.sum("n").alias("records"), F.count_if(~even).alias("broken_files"))


@query(
    "line_number",
    "select l_returnflag, count(*) as rows, count(*) as agreeing from lineitem group by l_returnflag",
)
def line_number(spark, sf_dir):
    """The ordinal for files with one record per line agrees with the position written into the file."""
    position = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) + 1
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", position.alias("position"))
    numbered = delimited.with_record_number(delimited.read_lines(spark, export(lines, "plain")), "n")
    parts = F.split("_text", ";")
    return numbered.groupBy(F.get(parts, F.lit(0)).alias("l_returnflag")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("n") == F.get(parts, F.lit(1)).cast("bigint")).alias("agreeing"),
    )


@query("promote_header", "select cast(o_orderkey as varchar) as o_orderkey, o_orderstatus, o_orderpriority from orders")
def promote_header(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    path = export(orders, "titled", header=True)
    return delimited.promote_header(delimited.read_delimited_raw(spark, path, "v1"), header_row=1)


@query("file_inventory", "select 'CSV' as format, true as has_bytes, count(*) as physical_lines from orders")
def file_inventory(spark, sf_dir):
    path = export(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority"), "inventory")
    found = delimited.file_inventory(spark, path)
    return found.groupBy("format").agg(
        (F.sum("bytes") > 0).alias("has_bytes"), F.sum("physical_lines").alias("physical_lines")
    )


@query("exclude_keys", "select o_orderkey, o_orderstatus from orders where o_orderstatus <> 'P'")
def exclude_keys(spark, sf_dir):
    """An earlier snapshot made from the present one by leaving out one status."""
    return delimited.exclude_keys(table(spark, sf_dir, "orders"), "o_orderstatus", ["P"]).select(
        "o_orderkey", "o_orderstatus"
    )


@query("document_raw", "select conv_id, turn, role, text from conversations")
def document_raw(spark, sf_dir):
    """Whole files as single documents, each holding a bounded number of nested records."""
    turns = table(spark, sf_dir, "conversations")
    path = scratch(spark, "turns")
    lines = nest_collections(turns, ["conv_id", "turn"], {"said": F.struct("role", "text")})
    lines.write.option("maxRecordsPerFile", DOCUMENTS_PER_FILE).text(path)
    raw = read_document_raw(spark, path, "v1", root=path)
    one = raw.select(F.explode(F.split(F.rtrim(F.col(provenance.DOCUMENT), F.lit("\n")), "\n")).alias("line"))
    turn = F.from_json("line", "conv_id bigint, turn bigint, said struct<role:string,text:string>")
    return one.select(turn.alias("t")).select("t.conv_id", "t.turn", "t.said.role", "t.said.text")


@query("layer_roundtrip", "select p_partkey, p_name, p_brand, p_type, p_size, p_retailprice from part")
def layer_roundtrip(spark, sf_dir):
    """A layer written twice: the second write replaces the first."""
    root = scratch(spark, "layer")
    part = table(spark, sf_dir, "part")
    write_layer(part.select("p_partkey"), root, "part")
    write_layer(part, root, "part")
    return read_layer(spark, root, "part")


def order_versions(spark, sf_dir):
    """Version 0: orders that are settled; version 1: all orders, with one more column."""
    orders = table(spark, sf_dir, "orders")
    versions = SnapshotTable(spark, scratch(spark, "versions"))
    settled = orders.filter(F.col("o_orderstatus") != "P").select("o_orderkey", "o_orderstatus", "o_totalprice")
    for frame in (settled, orders.select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")):
        versions.write(frame, provenance.frame_fingerprint(frame))
    return versions


@query(
    "time_travel_counts",
    """
select 0 as version, count(*) as rows, count(*) filter (where o_orderstatus = 'F') as filled, 0::bigint as urgent
from orders where o_orderstatus <> 'P'
union all select 1, count(*), count(*) filter (where o_orderstatus = 'F'),
  count(*) filter (where o_orderpriority = '1-URGENT') from orders
""",
)
def time_travel_counts(spark, sf_dir):
    """One scan over both versions; the column that version 0 lacks is NULL there."""
    return order_versions(spark, sf_dir).compare_versions(
        [0, 1],
        {
            "rows": F.count(F.lit(1)),
            "filled": F.count_if(F.col("o_orderstatus") == "F"),
            "urgent": F.count_if(F.col("o_orderpriority") == "1-URGENT"),
        },
    )


@query("read_version", "select o_orderkey, o_orderstatus, o_totalprice from orders where o_orderstatus <> 'P'")
def read_version(spark, sf_dir):
    return order_versions(spark, sf_dir).read_version(0)


@query("current_snapshot", "select o_orderkey, o_orderstatus, o_totalprice, o_orderpriority from orders")
def current_snapshot(spark, sf_dir):
    return order_versions(spark, sf_dir).current()


HISTORY_SQL = """
select (row_number() over (order by o_orderstatus) - 1)::bigint as version, 'WRITE' as operation, 'Overwrite' as mode,
  'o_orderstatus=' || o_orderstatus as label, count(*) as rows, true as adds_files, true as removes_former
  from orders group by o_orderstatus
"""


def history(versions):
    """The log, and whether each commit adds files and removes as many as the one before had added."""
    former = F.coalesce(F.lag("files_added").over(Window.orderBy("version")), F.lit(0))
    return versions.commit_log().select(
        "version", "operation", "mode", "label", "rows",
        (F.col("files_added") > 0).alias("adds_files"), (F.col("files_removed") == former).alias("removes_former"),
    )


def status_folders(spark, sf_dir):
    """One folder of text files per order status: three snapshots of a source."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")
    return export(orders, "arrivals", partition_by="o_orderstatus")


@query("idempotent_ingest", HISTORY_SQL)
def idempotent_ingest(spark, sf_dir):
    """Three snapshots in the order of their names; the second run adds nothing."""
    root = status_folders(spark, sf_dir)
    versions = SnapshotTable(spark, scratch(spark, "ingested"))
    sources = children(spark, root)
    for _ in range(2):
        ingest_snapshots(versions, sources, delimited_reader(spark, root, width=3))
    return history(versions)


@query(
    "commit_log",
    HISTORY_SQL + " union all select 3, 'RESTORE', 'Overwrite', 'o_orderstatus=F', count(*), true, true from orders "
    "where o_orderstatus = 'F'",
)
def commit_log(spark, sf_dir):
    """An earlier snapshot becomes current again: one more commit, no rows copied."""
    root = status_folders(spark, sf_dir)
    versions = SnapshotTable(spark, scratch(spark, "restored"))
    ingest_snapshots(versions, children(spark, root), delimited_reader(spark, root, width=3))
    versions.restore(0)
    return history(versions)


@query(
    "ingest_one",
    "select (l_returnflag = 'A')::integer as accepted, count(*) as rows, sum(l_orderkey)::bigint as keys "
    "from lineitem group by 1",
)
def land_one(spark, sf_dir):
    path = export(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag"), "single")
    versions = SnapshotTable(spark, scratch(spark, "one"))
    for _ in range(2):
        ingest_one(versions, path, delimited_reader(spark, path, width=2), "2001-01-01")
    key = safe_int("col_01", "bigint")
    return versions.read_version(0).groupBy((F.col("col_02") == "A").cast("int").alias("accepted")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(key).alias("keys")
    )


@query("stream_ingest", HISTORY_SQL)
def stream_arrivals(spark, sf_dir):
    """The same snapshots noticed by a file stream, and a second start that finds nothing new."""
    root = status_folders(spark, sf_dir)
    for folder in children(spark, root):
        put_if_absent(spark, folder + COMPLETE, "all parts\n")
    shared_dir(spark)
    checkpoint = scratch(spark, "stream")
    versions = SnapshotTable(spark, scratch(spark, "streamed"))
    for _ in range(2):
        started = stream_ingest(
            spark, root, versions, checkpoint, delimited_reader(spark, root, width=3), folders=True
        )
        started.awaitTermination()
    return history(versions)
