"""Registered queries: sources, projections, data quality and ingestion."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, functions as F

from brontide.catalog.common import (
    BLANKS_SQL, CLEANSED_SQL, LINE_EXPR, PRIMARY_KEYS, TABLES, Registry, customers_with_blanks,
    event_lines, splits_of, table, union_sql, write_attempts, write_small_logs)
from brontide.operators import project as P, quality as Q
from brontide.plans import ingest as I
from brontide.session import materialize, work_dir
from brontide.sources import artifacts, attempt_logs, csv, documents, files, tables

registry = Registry()
FOREIGN_KEYS = {
    "nation": [Q.ForeignKey("n_regionkey", "region", "r_regionkey")],
    "customer": [Q.ForeignKey("c_nationkey", "nation", "n_nationkey")],
    "supplier": [Q.ForeignKey("s_nationkey", "nation", "n_nationkey")],
    "orders": [Q.ForeignKey("o_custkey", "customer", "c_custkey")],
    "lineitem": [Q.ForeignKey("l_orderkey", "orders", "o_orderkey"),
                 Q.ForeignKey("l_partkey", "part", "p_partkey"),
                 Q.ForeignKey("l_suppkey", "supplier", "s_suppkey")],
    "labels": [Q.ForeignKey("doc_id", "documents", "doc_id")],
}


def _spec(name: str, **kwargs) -> I.TableSpec:
    return I.TableSpec(name, tuple(PRIMARY_KEYS[name]), tuple(FOREIGN_KEYS.get(name, ())), **kwargs)


# --- sources and sinks ----------------------------------------------------------------------

@registry.add("select doc_id, text, lang, source, n_chars from documents")
def scan_csv(spark, sf_dir):
    source, path = table(spark, sf_dir, "documents"), work_dir(spark, "csv")
    csv.write_csv(source, path)
    return csv.scan_csv(spark, path, source.schema)


# A name with a quote, a comma and a line break in it, as only a quoted field can hold.
_BROKEN = "concat(p_name, case p_partkey % 3 when 0 then concat(' \"', p_brand, '\"\n\n,') when 1 then ', \n' else '' end)"


@registry.add(f"select p_partkey, {_BROKEN} as p_name, p_brand, p_type, p_size, p_retailprice from part")
def scan_large_csv(spark, sf_dir):
    """One file of many splits, with line breaks in quoted fields."""
    source, path = table(spark, sf_dir, "part").withColumn("p_name", F.expr(_BROKEN)), work_dir(spark, "csv")
    csv.write_csv(source.coalesce(1), path, rows_per_file=0)
    (name, size), = files.list_sizes(spark, path)
    with splits_of(spark, max(64, size // 24)):
        rows = csv.scan_csv(spark, f"{path}/{name}", source.schema)
        return materialize(rows, "large-csv")


@registry.add("""select cast(p_partkey as int) as p_partkey, p_name, p_brand, p_type, p_size,
                        p_retailprice from part""")
def scan_csv_inferred(spark, sf_dir):
    path = work_dir(spark, "csv")
    csv.write_csv(table(spark, sf_dir, "part"), path)
    return csv.scan_csv(spark, path)


@registry.add("""select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
                        o_orderpriority from orders""")
def scan_parquet(spark, sf_dir):
    return tables.scan_parquet(spark, f"{sf_dir}/orders.parquet")


@registry.add("select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer")
def scan_table(spark, sf_dir):
    base = work_dir(spark, "tables")
    tables.write_table(table(spark, sf_dir, "customer"), base, "Customer", "parquet")
    return tables.scan_table(spark, base, "customer", "parquet")


@registry.add("""select p_partkey, p_name, p_brand, p_type, p_size, p_retailprice,
                        (select count(*) from part) as row_count from part""")
def export_table(spark, sf_dir):
    source, folders = table(spark, sf_dir, "part"), I.Folders.under(work_dir(spark, "export"))
    exported = I.export_table(source, _spec("part"), folders)
    return (csv.scan_csv(spark, folders.csv_path("part"), source.schema)
               .withColumn("row_count", F.lit(exported).cast("bigint")))


@registry.add("""select s_suppkey, s_name, s_nationkey, s_acctbal, s_acctbal >= 0 as in_credit
                 from supplier""")
def write_table(spark, sf_dir):
    base, suppliers = work_dir(spark, "tables"), table(spark, sf_dir, "supplier")
    tables.write_table(suppliers, base, "supplier", "parquet")
    tables.write_table(suppliers.withColumn("in_credit", F.col("s_acctbal") >= 0),
                       base, "supplier", "parquet")
    return tables.scan_table(spark, base, "supplier", "parquet")


@registry.add(f"select distinct c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment "
              f"from ({CLEANSED_SQL})")
def write_cleansed(spark, sf_dir):
    path = work_dir(spark, "cleansed")
    tables.write_parquet(Q.cleanse(customers_with_blanks(spark, sf_dir)).drop(Q.COPIES), path)
    return tables.scan_parquet(spark, path)


def _metadata(spark, sf_dir, names=TABLES) -> DataFrame:
    """Metadata documents of the given tables with their real row counts."""
    frames = {t: table(spark, sf_dir, t) for t in names}
    documents_ = Q.union_all([
        Q.table_metadata(spark, t, df.schema, PRIMARY_KEYS[t], FOREIGN_KEYS.get(t, ()))
        for t, df in frames.items()])
    counted = documents_.drop("row_count").join(
        Q.row_counts(frames).withColumnRenamed("n_rows", "row_count"), "table")
    return counted.select(*documents_.columns)


@registry.add(union_sql("select '{t}' as \"table\", '{pk}' as keys, count(*) as row_count from {t}"))
def metadata_roundtrip(spark, sf_dir):
    path = work_dir(spark, "metadata")
    written = _metadata(spark, sf_dir)
    written.write.json(path)
    found = spark.read.schema(written.schema).json(path)
    return found.select("table", F.array_join("primary_keys", "+").alias("keys"), "row_count")


@registry.add(union_sql("""select '{t}' as "table", count(*) as n_rows,
    case when '{t}' in ('orders', 'events') then '{pk}' else '' end as keys from {t}"""))
def missing_metadata(spark, sf_dir):
    counts = Q.row_counts({t: table(spark, sf_dir, t) for t in TABLES})
    known = _metadata(spark, sf_dir, ["orders", "events"])
    return (documents.with_primary_keys(counts, known)
                     .select("table", "n_rows", F.array_join("primary_keys", "+").alias("keys")))


@registry.add("""select role as dag_id, 'run+' || conv_id || ' a' as run_id, 'turn' as task_id,
    case when role = 'assistant' then cast(turn as int) end as map_index,
    cast(turn + 1 as int) as attempt, text || chr(10) as raw_text from conversations""")
def scan_attempt_logs(spark, sf_dir):
    root = work_dir(spark, "attempts")
    logs = table(spark, sf_dir, "conversations").select(
        F.col("role").alias("dag_id"), F.format_string("run+%d a", "conv_id").alias("run_id"),
        F.lit("turn").alias("task_id"), F.col("turn").cast("int").alias("map_index"),
        F.concat((F.col("turn") + 1).cast("int"), F.lit(".log")).alias("attempt"),
        F.col("text").alias("value"))
    # Some tasks are mapped and some are not, in one tree.
    assistant = F.col("dag_id") == "assistant"
    mapped, plain = logs.filter(assistant), logs.filter(~assistant)
    keys = ["dag_id", "run_id", "task_id"]
    tables.make_folder(spark, root)
    write_small_logs(mapped, f"{root}/mapped", [*keys, "map_index", "attempt"])
    write_small_logs(plain, f"{root}/plain", [*keys, "attempt"])
    return attempt_logs.scan_attempt_logs(spark, root)


@registry.add(f"""select event_type as dag_id, strftime(ts, '%Y-%m-%d') as run_id,
    cast(row_number() over (partition by event_type, strftime(ts, '%Y-%m-%d')
                            order by ts, event_id) as bigint) as line_no,
    {LINE_EXPR} as line from events""")
def scan_attempt_lines(spark, sf_dir):
    root = work_dir(spark, "attempts")
    write_attempts(event_lines(spark, sf_dir), root)
    return attempt_logs.scan_attempt_lines(spark, root).select("dag_id", "run_id", "line_no", "line")


# All tables that CSV can hold; vectors it cannot.
_LANDED = [t for t in TABLES if t != "embeddings"]


@registry.add(union_sql("select '{t}' as \"table\", count(*) > 0 as non_empty from {t}", _LANDED))
def artifact_inventory(spark, sf_dir):
    def land(name: str) -> DataFrame:
        path = work_dir(spark, name)
        csv.write_csv(table(spark, sf_dir, name), path)
        return artifacts.artifact_inventory(spark, path).select(F.lit(name).alias("table"), "non_empty")

    return Q.union_all(I.side_by_side(spark, {t: partial(land, t) for t in _LANDED}))


# --- projections, lookups, limits -----------------------------------------------------------

@registry.add("select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer")
def trim_column_names(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    return P.trim_column_names(customer.toDF(*[f" {c}\t" for c in customer.columns]))


@registry.add(f"""select c_custkey, nullif(trim(c_name), '') as c_name, c_nationkey, c_acctbal,
                         nullif(trim(c_mktsegment), '') as c_mktsegment from ({BLANKS_SQL})""")
def blank_to_null(spark, sf_dir):
    return P.blank_to_null(customers_with_blanks(spark, sf_dir))


@registry.add(f"""select * from ({CLEANSED_SQL}) where c_custkey is null or c_mktsegment is null""")
def null_key_rows(spark, sf_dir):
    cleansed = Q.cleanse(customers_with_blanks(spark, sf_dir)).drop(Q.COPIES)
    return P.null_key_rows(cleansed, ["c_custkey", "c_mktsegment"])


@registry.add("""select o_orderkey, o_custkey, o_orderstatus from orders
                 where o_orderkey in (select l_orderkey from lineitem where l_returnflag = 'R')""")
def lookup_by_id(spark, sf_dir):
    wanted = (table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'")
              .select(F.col("l_orderkey").alias("o_orderkey")).distinct())
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return P.lookup_many(orders, wanted)


@registry.add("select conv_id, turn, role, text from conversations where conv_id = 7 and turn = 1")
def lookup(spark, sf_dir):
    return P.lookup(table(spark, sf_dir, "conversations"), conv_id=7, turn=1)


@registry.add("""select conv_id, turn, role, text from conversations
                 where (conv_id, turn) in (select conv_id, max(turn) from conversations group by 1)""")
def lookup_by_pair(spark, sf_dir):
    conversations = table(spark, sf_dir, "conversations")
    last = conversations.groupBy("conv_id").agg(F.max("turn").alias("turn"))
    return P.lookup_many(conversations, last)


@registry.add("""select o_orderkey, o_custkey, o_totalprice, 'order' as by from orders where o_orderkey in (select max(o_orderkey) from orders)
    union all select o_orderkey, o_custkey, o_totalprice, 'customer' from orders where o_custkey = (select o_custkey from orders order by o_orderkey desc limit 1)""")
def lookup_filed(spark, sf_dir):
    """By the first and by the second key of a table that is filed by both."""
    base, columns = work_dir(spark, "filed"), ["o_orderkey", "o_custkey", "o_totalprice"]
    tables.write_table(table(spark, sf_dir, "orders").select(*columns), base, "orders", "parquet", keys=("o_orderkey", "o_custkey"))
    orders = tables.scan_table(spark, base, "orders", "parquet")
    last = P.latest_n(orders, columns, "o_orderkey", 1).first()
    return (P.lookup(orders, o_orderkey=last["o_orderkey"]).withColumn("by", F.lit("order"))
             .unionByName(P.lookup(orders, o_custkey=last["o_custkey"]).withColumn("by", F.lit("customer"))))


@registry.add("""select o_orderkey, o_custkey, o_orderstatus from orders
                 order by o_orderkey desc limit 20""")
def latest_n(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return P.latest_n(orders, ["o_orderkey", "o_custkey", "o_orderstatus"], "o_orderkey")


# --- counts and quality ---------------------------------------------------------------------

@registry.add(union_sql("select '{t}' as \"table\", count(*) as n_rows from {t}"))
def row_count(spark, sf_dir):
    return Q.row_counts({t: table(spark, sf_dir, t) for t in TABLES})


@registry.add("select distinct text, lang from documents")
def dedup_rows(spark, sf_dir):
    return Q.dedup_rows(table(spark, sf_dir, "documents").select("text", "lang"), digest_from=0)


@registry.add(f"""select count(*) as source_rows, (select count(*) from ({CLEANSED_SQL})) as cleansed_rows,
    count(*) - (select count(*) from ({CLEANSED_SQL})) as duplicate_rows_removed from ({BLANKS_SQL})""")
def duplicates_removed(spark, sf_dir):
    return Q.duplicates_removed(customers_with_blanks(spark, sf_dir), digest_from=0)


@registry.add(f"""select 'c_custkey' as pk, count(*) - count(c_custkey) as nulls from ({CLEANSED_SQL})
    union all select 'c_mktsegment', count(*) - count(c_mktsegment) from ({CLEANSED_SQL})""")
def pk_null_counts(spark, sf_dir):
    cleansed = Q.cleanse(customers_with_blanks(spark, sf_dir))
    return Q.pk_null_counts(cleansed, ["c_custkey", "c_mktsegment"])


def _duplicate_keys_sql(name: str) -> str:
    keys = ", ".join(PRIMARY_KEYS[name])
    return (f"select '{name}' as \"table\", count(*) as duplicate_keys "
            f"from (select {keys} from {name} group by {keys} having count(*) > 1)")


@registry.add(" union all ".join(map(_duplicate_keys_sql, TABLES)))
def pk_duplicate_keys(spark, sf_dir):
    return Q.union_all([Q.pk_duplicate_keys(table(spark, sf_dir, t), PRIMARY_KEYS[t])
                         .select(F.lit(t).alias("table"), "duplicate_keys") for t in TABLES])


_CHECKED = [t for t in TABLES if t != "part"]


def _distinct_sql(name: str) -> str:
    """The table after cleansing. None of these tables has blanks or padding."""
    return f"select distinct * from {name}"


def _checks_sql(name: str) -> str:
    keys, rows = PRIMARY_KEYS[name], _distinct_sql(name)
    head = f"select '{name}' as \"table\", "
    missing = f"{head} 'pk_columns_missing' as \"check\", 0 as value, true as passed"
    nulls = [f"{head} 'pk_nulls:{k}', count(*) - count({k}), count(*) = count({k}) from ({rows})"
             for k in keys]
    by = ", ".join(keys)
    duplicates = (f"{head} 'pk_duplicate_keys', count(*), count(*) = 0 from "
                  f"(select {by} from ({rows}) group by {by} having count(*) > 1)")
    increase = f"{head} 'rows_not_increased', 0, true"
    return " union all ".join([missing, *nulls, duplicates, increase])


# One more table is declared with a key column that it does not have.
@registry.add(" union all ".join(map(_checks_sql, _CHECKED)) + """
    union all select 'part', 'pk_columns_missing', 1, false
    union all select 'part', 'rows_not_increased', greatest(count(distinct part) - count(*), 0),
                     count(distinct part) <= count(*) from part""")
def dq_checks(spark, sf_dir):
    declared = {**{t: PRIMARY_KEYS[t] for t in _CHECKED}, "part": ["p_partkey", "p_code"]}
    return Q.union_all([Q.quality_checks(t, Q.cleanse(table(spark, sf_dir, t)), keys)
                        for t, keys in declared.items()])


def _report_sql(name: str) -> str:
    return (f"select '{name}' as \"table\", count(*) as source_rows, "
            f"(select count(*) from ({_distinct_sql(name)})) as cleansed_rows, "
            f"count(*) - (select count(*) from ({_distinct_sql(name)})) as duplicate_rows_removed, "
            f"'{'+'.join(PRIMARY_KEYS[name])}' as keys from {name}")


@registry.add(" union all ".join(map(_report_sql, TABLES)))
def dq_report(spark, sf_dir):
    folder = work_dir(spark, "reports")

    def report(name: str) -> DataFrame:
        keys = PRIMARY_KEYS[name]
        metrics = Q.quality_metrics(Q.cleanse(table(spark, sf_dir, name)), keys)
        documents.write_dq_report(Q.quality_report(name, metrics, keys, "", ""), folder, name)
        return documents.read_dq_report(spark, folder, name)

    return Q.union_all(I.side_by_side(spark, {t: partial(report, t) for t in TABLES})).select("table", "source_rows", "cleansed_rows",
                                       "duplicate_rows_removed",
                                       F.array_join("primary_keys", "+").alias("keys"))


@registry.add("""select 'orders' as "table", count(*) as source_rows, count(*) as target_rows, true as ok
    from orders union all
    select 'documents', count(*), count(distinct (text, lang)), count(*) = count(distinct (text, lang))
    from documents""")
def reconcile_counts(spark, sf_dir):
    orders, docs = (table(spark, sf_dir, t) for t in ("orders", "documents"))
    base = work_dir(spark, "tables")
    tables.write_table(orders, base, "orders", "parquet")
    texts = docs.select("text", "lang")
    return Q.union_all([
        Q.reconcile_counts("orders", orders, tables.scan_table(spark, base, "orders", "parquet")),
        Q.reconcile_counts("documents", texts, Q.dedup_rows(texts))])


@registry.add("""select 'lineitem' as "table", m as min_rows, n as n_rows, n >= m as passed
    from (select count(*) as n from lineitem), (values (cast(0 as bigint)), (1), (1000000000000)) v(m)""")
def min_rows(spark, sf_dir):
    return Q.min_rows(table(spark, sf_dir, "lineitem"), "lineitem", [0, 1, 10 ** 12])


_SPARK_TYPE_SQL = """case data_type when 'BIGINT' then 'bigint' when 'INTEGER' then 'int'
    when 'VARCHAR' then 'string' when 'DOUBLE' then 'double' when 'TIMESTAMP' then 'timestamp_ntz'
    when 'FLOAT[]' then 'array<float>' end"""
_PK_SQL = "case " + " ".join(
    f"when table_name = '{t}' and column_name = '{k}' then {i}"
    for t, keys in PRIMARY_KEYS.items() for i, k in enumerate(keys, start=1)) + " else 0 end"


@registry.add(f"""select "table", row_count, cast(column_index as int) - 1 as cid, column_name as name,
    {_SPARK_TYPE_SQL} as type, 0 as notnull, {_PK_SQL} as pk
    from duckdb_columns() join ({union_sql('select {q}{t}{q} as "table", count(*) as row_count from {t}'
                                           .replace('{q}', chr(39)))}) on table_name = "table" """)
def table_catalog(spark, sf_dir):
    return Q.table_catalog(_metadata(spark, sf_dir)).drop("dflt_value")


_FK_SQL = " union all ".join(
    f"select '{t}' as \"table\", {i} as id, '{fk.column}' as from_column, "
    f"'{fk.ref_table}' as ref_table, '{fk.ref_column}' as to_column, count(*) as row_count from {t}"
    for t, fks in FOREIGN_KEYS.items() for i, fk in enumerate(fks))


@registry.add(_FK_SQL)
def foreign_key_catalog(spark, sf_dir):
    return Q.foreign_key_catalog(_metadata(spark, sf_dir))


@registry.add("""select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
                        o_orderpriority from orders order by o_orderkey limit 10""")
def preview(spark, sf_dir):
    return Q.preview(table(spark, sf_dir, "orders"), ["o_orderkey"])


# --- chains ---------------------------------------------------------------------------------

@registry.add(CLEANSED_SQL)
def ingest_table(spark, sf_dir):
    folders = I.Folders.under(work_dir(spark, "ingest"))
    I.ingest_table(customers_with_blanks(spark, sf_dir), _spec("customer", min_rows=1), folders)
    return tables.scan_table(spark, folders.target, "customer")


def _ingest_sql(name: str) -> str:
    by = ", ".join(PRIMARY_KEYS[name])
    return (f"select '{name}' as \"table\", case when d = 0 then n end as source_rows, case when d = 0 then c end as cleansed_rows, "
            f"case when d = 0 then n - c end as duplicate_rows_removed, case when d = 0 then '{'+'.join(PRIMARY_KEYS[name])}' end as keys, "
            f"case when d = 0 then c end as target_rows, case when d = 0 then 'ok' else 'failed' end as status, "
            f"case when d > 0 then '{name}: ' || d || ' duplicate keys' end as reason from (select count(*) as n, "
            f"(select count(*) from ({_distinct_sql(name)})) as c, (select count(*) from (select {by} from ({_distinct_sql(name)}) "
            f"group by {by} having count(*) > 1)) as d from {name})")


@registry.add(" union all ".join(map(_ingest_sql, _LANDED)))
def ingest_tables(spark, sf_dir):
    """Line items have duplicate keys, so their row tells of a failure."""
    sources = {t: table(spark, sf_dir, t) for t in _LANDED}
    reports = I.ingest_tables(sources, [_spec(t) for t in _LANDED],
                              I.Folders.under(work_dir(spark, "ingest")))
    return reports.select("table", "source_rows", "cleansed_rows", "duplicate_rows_removed",
                          F.array_join("primary_keys", "+").alias("keys"), "target_rows", "status", "reason")
