"""Link graph and export queries over the shared tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkmill.operators import edges as E
from linkmill.operators import rank as R
from linkmill.operators.order import first_rows, stable_order, with_row_index
from linkmill.plans import pagerank as P
from linkmill.plans.export_job import export_view, sort_export, sort_export_job
from linkmill.plans.lineage import fresh_path
from linkmill.sinks.text import write_ranks_csv, write_ranks_text
from linkmill.sources.tables import read_export, spread_small
from linkmill.sources.text import first_lines, read_edges

TAB = "\t"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str, spread: bool = False) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    df = df.select(*columns) if columns else df
    return spread_small(df) if spread else df


# --- inputs ------------------------------------------------------------------


def core_line():
    target = F.col("l_suppkey") * 20 + F.col("l_orderkey") % 20
    extra = F.when(F.col("l_linenumber") == 1, F.lit("\textra")).otherwise(F.lit(""))
    return F.concat(F.lit("Part_"), "l_partkey", F.lit(TAB), F.lit("PART_"), target, extra)


def link_lines(spark: SparkSession, sf_dir: str, comments: bool = False) -> DataFrame:
    """One scan per table; each row gives all of its lines."""
    items = table(
        spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", spread=True
    )
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey")
    per_item = [
        core_line(),
        F.concat(F.lit("Cust_"), "o_custkey", F.lit(TAB), F.lit("Part_"), "l_partkey"),
        F.concat(F.lit("Part_"), "l_partkey", F.lit(TAB), F.lit("Supplier:"), "l_suppkey"),
    ]
    if comments:
        remark = F.concat(F.lit("# order "), "o_orderkey")
        per_item.append(F.when(F.col("o_orderkey") % 100 == 0, remark))
    joined = items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    lines = joined.select(F.explode(F.array(*per_item)).alias("value")).where("value IS NOT NULL")
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_brand")
    per_part = [
        F.concat(F.lit("Part_"), "p_partkey", F.lit(TAB), F.lit(f"{space}:"), "p_brand")
        for space in ("Category", "category")
    ]
    return lines.unionAll(part.select(F.explode(F.array(*per_part)).alias("value")))


def ordered_core(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return items.withColumn("value", core_line())


ITEM_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")

CORE_SQL = (
    "concat('Part_', l_partkey, chr(9), 'PART_', l_suppkey * 20 + l_orderkey % 20, "
    "case when l_linenumber = 1 then concat(chr(9), 'extra') else '' end)"
)
LINES_SQL = f"""lines as materialized (
  select {CORE_SQL} as value from lineitem
  union all select concat('Cust_', o_custkey, chr(9), 'Part_', l_partkey)
    from lineitem join orders on l_orderkey = o_orderkey
  union all select concat('Part_', l_partkey, chr(9), 'Supplier:', l_suppkey) from lineitem
  union all select concat('Part_', p_partkey, chr(9), 'Category:', p_brand) from part
  union all select concat('Part_', p_partkey, chr(9), 'category:', p_brand) from part)"""
PAIRS_SQL = """pairs as materialized (
  select split_part(value, chr(9), 1) as src, split_part(value, chr(9), 2) as dst from lines)"""
KEPT_SQL = """kept as materialized (
  select src, dst from pairs where not contains(dst, ':') or starts_with(dst, 'Category:'))"""
EDGES_SQL = "edges as materialized (select lower(src) as src, lower(dst) as dst from kept)"
FOLDED_SQL = "folded as materialized (select lower(src) as src, lower(dst) as dst from pairs)"
CONTENT_SQL = f"with {LINES_SQL}, {PAIRS_SQL}, {KEPT_SQL}, {EDGES_SQL}"
PAIR_COUNTS = "select src, dst, count(*) as n from {} group by src, dst"


def content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.content_edges(link_lines(spark, sf_dir))


def pair_counts(edges: DataFrame) -> DataFrame:
    return edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


# --- parsing ------------------------------------------------------------------


def edge_parse(spark, sf_dir):
    path = fresh_path(spark, "lines")
    link_lines(spark, sf_dir).write.text(path)
    return pair_counts(read_edges(spark, f"{path}/part-*"))


def edge_filter(spark, sf_dir):
    return pair_counts(E.keep_content_targets(E.parse_edges(link_lines(spark, sf_dir))))


def edge_lower(spark, sf_dir):
    return pair_counts(content(spark, sf_dir))


def edge_comments(spark, sf_dir):
    lines = link_lines(spark, sf_dir, comments=True)
    return pair_counts(E.parse_edges(lines, comment_prefix="#"))


def edge_permissive(spark, sf_dir):
    lines = link_lines(spark, sf_dir, comments=True)
    return pair_counts(E.parse_edges(lines, mode="permissive"))


# --- shape ---------------------------------------------------------------------


def out_degree(spark, sf_dir):
    return E.out_degree(content(spark, sf_dir))


def adjacency_sizes(spark, sf_dir):
    rows = E.adjacency(content(spark, sf_dir))
    return rows.groupBy("src").agg(
        F.sum(F.size("dests")).alias("n_links"),
        F.min(F.array_min("dests")).alias("first_dst"),
        F.max(F.array_max("dests")).alias("last_dst"),
    )


def with_hub(edges: DataFrame) -> DataFrame:
    """The edges and, twice, a link from one hub to every source."""
    hub = edges.select(F.lit("hub").alias("src"), F.col("src").alias("dst")).distinct()
    return edges.unionByName(hub).unionByName(hub)


def adjacency_lists(spark, sf_dir):
    """What the lists hold, link by link, and that none is longer than 300."""
    lists = E.adjacency(with_hub(content(spark, sf_dir)), max_list=300)
    links = lists.select("src", F.size("dests").alias("n"), F.explode("dests").alias("dst"))
    return links.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n_links"), (F.max("n") <= 300).alias("bounded"))


def adjacency_rows(spark, sf_dir):
    """Every row of a source is told apart by its slice."""
    rows = E.adjacency(with_hub(content(spark, sf_dir)), max_list=300)
    each = rows.groupBy("src").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("slice").alias("slices"), F.sum(F.size("dests")).alias("n_links"))
    return each.select("src", "n_links", (F.col("n") == F.col("slices")).alias("apart"), (F.col("n") * 300 >= F.col("n_links")).alias("enough"))


def source_count(spark, sf_dir):
    keys = E.node_keys(content(spark, sf_dir))
    return keys.agg(F.count(F.lit(1)).alias("n_sources"))


# --- one round -------------------------------------------------------------------


def one_round(spark, sf_dir, sources="drop"):
    edges = content(spark, sf_dir)
    links = R.link_table(edges, sources, cache_links=False)
    given = R.contributions(R.join_ranks(links, R.init_ranks(links.rows)))
    return R.sum_contributions(given)


def contributions_one_step(spark, sf_dir):
    return one_round(spark, sf_dir).select("node", F.round("total", 6).alias("total"))


def contributions_keep(spark, sf_dir):
    return one_round(spark, sf_dir, "keep").select("node", F.round("total", 6).alias("total"))


def rounded(ranks: DataFrame, digits: int = 6) -> DataFrame:
    return ranks.select("node", F.round("rank", digits).alias("rank"))


# --- whole rankings ----------------------------------------------------------------


def pagerank_raw(spark, sf_dir):
    """A link file in one case, as the raw ranking folds nothing itself."""
    lines = link_lines(spark, sf_dir, comments=True).select(F.lower("value").alias("value"))
    return rounded(P.raw_pagerank(lines))


def wiki_pagerank(spark, sf_dir):
    return rounded(P.wiki_pagerank(link_lines(spark, sf_dir)))


def pagerank_keep(spark, sf_dir):
    return rounded(P.wiki_pagerank(link_lines(spark, sf_dir), sources="keep"))


def pagerank_normalised(spark, sf_dir):
    return rounded(P.wiki_pagerank(link_lines(spark, sf_dir), normalise=True), 10)


def pagerank_sample(spark, sf_dir):
    path = fresh_path(spark, "core")
    stable_order(ordered_core(spark, sf_dir), *ITEM_ORDER).select("value").write.text(path)
    return rounded(P.sample_pagerank(spark, f"{path}/part-*"), 10)


def pagerank_cached(spark, sf_dir):
    return rounded(P.wiki_pagerank(link_lines(spark, sf_dir), cache_links=True))


def pagerank_uncached(spark, sf_dir):
    return rounded(P.wiki_pagerank(link_lines(spark, sf_dir), cache_links=False))


def pagerank_partitioned(spark, sf_dir):
    return rounded(P.partitioned_pagerank(link_lines(spark, sf_dir)))


def pagerank_sliced(spark, sf_dir):
    """Every line points away from one hub as well: its links are sliced."""
    edges = content(spark, sf_dir)
    hub = edges.select(F.lit("hub").alias("src"), F.col("src").alias("dst")).distinct()
    return rounded(P.pagerank(edges.unionByName(hub), iterations=3, min_slice_rows=50))


def partition_report(spark, sf_dir):
    edges = content(spark, sf_dir)
    links = R.link_table(edges, num_partitions=120, cache_links=False)
    return P.partition_report(edges.repartition(8), 8, links).select("stage", "partitions", "n_rows")


# --- lines, exports, sinks -----------------------------------------------------------


def first_lines_query(spark, sf_dir):
    path = fresh_path(spark, "core")
    stable_order(ordered_core(spark, sf_dir), *ITEM_ORDER).select("value").write.text(path)
    return first_lines(spark, f"{path}/part-*")


def first_rows_query(spark, sf_dir):
    rows = first_rows(ordered_core(spark, sf_dir), 1000, *ITEM_ORDER)
    return rows.select(*ITEM_ORDER, "value")


def export_rows(spark, sf_dir):
    customer = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    joined = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    code = F.upper(F.substring("n_name", 1, 2))
    return joined.select(
        F.when(F.col("c_custkey") % 50 != 0, code).alias("cca2"),
        (F.col("c_custkey") * 7919 % 100000).cast("string").alias("timestamp"),
        F.col("c_custkey").cast("string").alias("id"),
    )


EXPORT_SQL = """select case when c_custkey % 50 <> 0 then upper(substr(n_name, 1, 2)) end as cca2,
  cast(c_custkey * 7919 % 100000 as varchar) as "timestamp", cast(c_custkey as varchar) as id
  from customer join nation on c_nationkey = n_nationkey"""


def export_file(spark, sf_dir):
    path = fresh_path(spark, "export")
    export_rows(spark, sf_dir).write.csv(path, header=True)
    return path


def in_own_order(df: DataFrame) -> DataFrame:
    """Rows with the position that they have in ``df`` as it is written."""
    path = fresh_path(df.sparkSession, "ordered")
    df.write.parquet(path)
    located = df.sparkSession.read.parquet(path).select(
        "*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row")
    )
    placed = with_row_index(located, "_file", "_row", name="_at")
    return placed.select(*df.columns, (F.col("_at") + 1).alias("position"))


def sort_export_query(spark, sf_dir):
    rows = read_export(spark, export_file(spark, sf_dir))
    return in_own_order(sort_export(rows, ("cca2", "timestamp", "id")))


def export_job(spark, sf_dir):
    """The written part files, read in name order."""
    out = fresh_path(spark, "sorted")
    sort_export_job(spark, export_file(spark, sf_dir), out, ("cca2", "timestamp", "id"))
    rows = spark.read.csv(out, schema="cca2 string, timestamp string, id string")
    located = rows.select(
        "*",
        F.col("_metadata.file_name").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"),
    )
    placed = with_row_index(located, "_file", "_block", "_line", name="_at")
    return placed.select("cca2", "timestamp", "id", (F.col("_at") + 1).alias("position"))


def export_sql_view(spark, sf_dir):
    return in_own_order(export_view(read_export(spark, export_file(spark, sf_dir)), ("cca2", "timestamp", "id")))


def export_typed(spark, sf_dir):
    """Times differ from customer to customer, so no tie is left."""
    return in_own_order(sort_export(read_export(spark, export_file(spark, sf_dir)), as_text=False))


def first_ranks(spark, sf_dir):
    return R.damp(one_round(spark, sf_dir))


def ranks_text(spark, sf_dir):
    path = fresh_path(spark, "ranks")
    write_ranks_text(first_ranks(spark, sf_dir), path)
    fields = F.split("value", "\t")
    back = spark.read.text(path)
    return rounded(
        back.select(F.get(fields, F.lit(0)).alias("node"), F.get(fields, F.lit(1)).cast("double").alias("rank"))
    )


def ranks_tuple_text(spark, sf_dir):
    path = fresh_path(spark, "ranks")
    write_ranks_text(first_ranks(spark, sf_dir), path, as_tuple=True)
    pattern = r"^\('(.*)', ([^']+)\)$"
    back = spark.read.text(path)
    return rounded(
        back.select(
            F.regexp_extract("value", pattern, 1).alias("node"),
            F.regexp_extract("value", pattern, 2).cast("double").alias("rank"),
        )
    )


def ranks_csv(spark, sf_dir):
    path = fresh_path(spark, "ranks")
    write_ranks_csv(first_ranks(spark, sf_dir), path)
    return rounded(spark.read.csv(path, schema="node string, rank double"))


# --- oracles ----------------------------------------------------------------------------


def rank_sql(
    prefix: str, edges: str, rounds: int = 10, keep: bool = False, normalised: bool = False, digits: int = 6
) -> str:
    """The rounds written out as one common table expression each."""
    base, factor = "0.15", "0.85"
    if normalised:
        base = "0.15 / (select count(*) from deg)"
    parts = [
        f"deg as materialized (select src, count(*) as n from {edges} group by src)",
        "r0 as materialized (select src as node, 1.0::double as rank from deg)",
    ]
    for i in range(rounds):
        given = f"""select e.dst as node, r.rank / d.n as v
          from {edges} e join deg d on e.src = d.src join r{i} r on r.node = e.src"""
        if keep:
            given += f" union all select r.node, 0.0 from r{i} r join deg d on d.src = r.node"
        parts.append(
            f"r{i + 1} as materialized (select node, {base} + {factor} * sum(v) as rank"
            f" from ({given}) group by node)"
        )
    return f"{prefix}, {', '.join(parts)} select node, round(rank, {digits}) as rank from r{rounds}"


ONE_ROUND_SQL = """, deg as (select src, count(*) as n from edges group by src)
select node, round(sum(v), 6) as total from (
  select dst as node, 1.0 / n as v from edges join deg using (src) {}) group by node"""
ONE_RANK_SQL = f"""{CONTENT_SQL}, deg as (select src, count(*) as n from edges group by src)
select dst as node, round(0.15 + 0.85 * sum(1.0::double / n), 6) as rank
from edges join deg using (src) group by dst"""
POSITION_SQL = """select cca2, "timestamp", id, row_number() over (
  order by cca2 nulls first, {}, id) as position from ({})"""
SAMPLE_SQL = f"""with lines as (select {CORE_SQL} as value from lineitem
  order by {', '.join(ITEM_ORDER)} limit 1000), {PAIRS_SQL}, {KEPT_SQL}, {EDGES_SQL}"""
HUB_SQL = f"""{CONTENT_SQL}, hubbed as materialized (
  select * from edges union all select distinct 'hub', src from edges)"""

HUB_TWICE_SQL = f"""{CONTENT_SQL}, hubbed as materialized (
  select * from edges union all select 'hub', src from (select distinct src from edges), range(2))"""

QUERIES = {
    "edge_parse": (edge_parse, f"with {LINES_SQL}, {PAIRS_SQL} {PAIR_COUNTS.format('pairs')}"),
    "edge_filter": (edge_filter, f"with {LINES_SQL}, {PAIRS_SQL}, {KEPT_SQL} {PAIR_COUNTS.format('kept')}"),
    "edge_lower": (edge_lower, f"{CONTENT_SQL} {PAIR_COUNTS.format('edges')}"),
    "edge_comments": (edge_comments, f"with {LINES_SQL}, {PAIRS_SQL} {PAIR_COUNTS.format('pairs')}"),
    "edge_permissive": (edge_permissive, f"with {LINES_SQL}, {PAIRS_SQL} {PAIR_COUNTS.format('pairs')}"),
    "out_degree": (out_degree, f"{CONTENT_SQL} select src, count(*) as n_links from edges group by src"),
    "adjacency_sizes": (
        adjacency_sizes,
        f"{CONTENT_SQL} select src, count(*) as n_links, min(dst) as first_dst, max(dst) as last_dst"
        " from edges group by src",
    ),
    "adjacency_lists": (
        adjacency_lists,
        f"{HUB_TWICE_SQL} select src, dst, count(*) as n_links, true as bounded from hubbed group by src, dst",
    ),
    "adjacency_rows": (
        adjacency_rows,
        f"{HUB_TWICE_SQL} select src, count(*) as n_links, true as apart, true as enough from hubbed group by src",
    ),
    "source_count": (source_count, f"{CONTENT_SQL} select count(distinct src) as n_sources from edges"),
    "contributions_one_step": (contributions_one_step, CONTENT_SQL + ONE_ROUND_SQL.format("")),
    "contributions_keep": (
        contributions_keep,
        CONTENT_SQL + ONE_ROUND_SQL.format("union all select src, 0.0 from deg"),
    ),
    "pagerank_raw": (pagerank_raw, rank_sql(f"with {LINES_SQL}, {PAIRS_SQL}, {FOLDED_SQL}", "folded")),
    "wiki_pagerank": (wiki_pagerank, rank_sql(CONTENT_SQL, "edges")),
    "pagerank_keep": (pagerank_keep, rank_sql(CONTENT_SQL, "edges", keep=True)),
    "pagerank_normalised": (
        pagerank_normalised,
        rank_sql(CONTENT_SQL, "edges", normalised=True, digits=10),
    ),
    "pagerank_sample": (pagerank_sample, rank_sql(SAMPLE_SQL, "edges", normalised=True, digits=10)),
    "pagerank_cached": (pagerank_cached, rank_sql(CONTENT_SQL, "edges")),
    "pagerank_uncached": (pagerank_uncached, rank_sql(CONTENT_SQL, "edges")),
    "pagerank_partitioned": (pagerank_partitioned, rank_sql(CONTENT_SQL, "edges")),
    "pagerank_sliced": (pagerank_sliced, rank_sql(HUB_SQL, "hubbed", rounds=3)),
    "partition_report": (
        partition_report,
        f"""{CONTENT_SQL} select 'before' as stage, 8 as partitions, count(*) as n_rows from edges
        union all select 'after', 120, count(*) from (select distinct src, dst from edges)""",
    ),
    "first_lines": (
        first_lines_query,
        f"select {CORE_SQL} as value from lineitem order by {', '.join(ITEM_ORDER)} limit 1000",
    ),
    "first_rows": (
        first_rows_query,
        f"""select {', '.join(ITEM_ORDER)}, {CORE_SQL} as value from lineitem
        order by {', '.join(ITEM_ORDER)} limit 1000""",
    ),
    "sort_export": (sort_export_query, POSITION_SQL.format('"timestamp"', EXPORT_SQL)),
    "export_job": (export_job, POSITION_SQL.format('"timestamp"', EXPORT_SQL)),
    "export_sql_view": (export_sql_view, POSITION_SQL.format('"timestamp"', EXPORT_SQL)),
    "export_typed": (export_typed, POSITION_SQL.format('cast("timestamp" as double)', EXPORT_SQL)),
    "ranks_text": (ranks_text, ONE_RANK_SQL),
    "ranks_tuple_text": (ranks_tuple_text, ONE_RANK_SQL),
    "ranks_csv": (ranks_csv, ONE_RANK_SQL),
}
