"""Whole routes over files: mapping, raw folders, zones, catalog tables, warehouse targets."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from guestbook.operators.audit import with_audit
from guestbook.operators.conform import union_all
from guestbook.operators.joins import join_on
from guestbook.operators.snapshots import empty_like
from guestbook.plans.landing import land_database, load_trusted, raw_to_trusted
from guestbook.plans.origins import source_book
from guestbook.session import fresh_dir
from guestbook.sinks.manifest import Published
from guestbook.sinks.warehouse import FolderTarget, publish_all, write_all
from guestbook.sources.files import detect_format, find_snapshot, load_tables, read_snapshot
from guestbook.sources.mapping import MappedTable, load_mapping, mapped_tables, target_schema, to_targets
from workload.quality import email_sql, phone_sql
from workload.recipes import CRM, SQUEEZED, VENDOR, crm, vendor
from workload.registry import Tables, query

DAY = dt.date(2024, 1, 2)
DATABASES = {"vendor": "sales/eu"}
MAPPING = [
    *(("crm", "null", "people", c) for c in ("id", "first_name", "email", "phone", "referrer")),
    *(("vendor", "public", "people", c) for c in ("id", "first_name", "email", "null")),
]

CRM_ROWS = f"""select 'crm' as system, id, {SQUEEZED % 'first_name'} as first_name, {SQUEEZED % 'email'} as email
  from ({CRM}) where {email_sql(SQUEEZED % 'email')} = 'valid' and {phone_sql('phone')} = 'valid'"""
VENDOR_ROWS = f"select 'vendor' as system, id, first_name, email from ({VENDOR}) where {email_sql('email')} = 'valid'"


def _raw(t: Tables) -> tuple[list[MappedTable], str]:
    """A mapping file, and raw folders of two systems; the second has no snapshot on the second day.

    The first system comes as JSON, in two loads of one day of which the later counts.
    """
    spec, root = fresh_dir(t.spark, "mapping"), fresh_dir(t.spark, "raw")
    names = ["source_system", "schema", "source_table", "source_column"]
    t.spark.createDataFrame(MAPPING, names).coalesce(1).write.option("header", True).csv(spec)
    tables = mapped_tables(load_mapping(t.spark, spec))
    folders = {x.system: f"{root}/{x.folder(DATABASES)}" for x in tables}
    people = crm(t).select("id", "first_name", "email", "phone")
    people.where("id < 10").write.json(f"{folders['crm']}/2024/01/02/20240102T01")
    people.write.json(f"{folders['crm']}/2024/01/02/20240102T02")
    people.write.json(f"{folders['crm']}/2024/01/03/20240103T01")
    vendor(t).select("id", "first_name", "email").write.parquet(f"{folders['vendor']}/2024/01/02")
    return tables, root


@query(f"select * from (values ('2024-01-02'), ('2024-01-03')) d(day), ({CRM_ROWS} union all {VENDOR_ROWS})")
def mapped_landing(t: Tables) -> DataFrame:
    """Two days from raw folders to the trusted zone; what is missing on the second is carried forward."""
    tables, root = _raw(t)
    out = fresh_dir(t.spark, "trusted")
    rows = None
    for day in (DAY, DAY + dt.timedelta(days=1)):
        raw_to_trusted(t.spark, tables, root, out, day, DATABASES, missing="carry")
        for name, df in load_trusted(t.spark, tables, out, day, DATABASES).items():
            system = F.lit(name.split("_")[0])
            part = df.select(F.lit(str(day)).alias("day"), system.alias("system"), "id", "first_name", "email")
            rows = part if rows is None else rows.unionByName(part)
    return rows


TARGETS = [
    ("crm", "null", "people", "id", "person", "bigint"),
    ("crm", "null", "people", "first_name", "name", "string"),
    ("crm", "null", "people", "phone", "null", "null"),
    ("crm", "null", "people", "balance", "credit", "int"),
    ("vendor", "null", "people", "id", "person", "bigint"),
    ("vendor", "null", "people", "contact.email", "mail", "string"),
]


@query(
    f"""select c_custkey as person, 'x' as name, cast(trunc(c_acctbal) as int) as credit, cast(null as varchar) as mail from {{customer}}
    union all select id, null, null, email from ({VENDOR})"""
)
def mapped_targets(t: Tables) -> DataFrame:
    """Two tables under the target columns and types that the mapping names."""
    spec = fresh_dir(t.spark, "mapping")
    names = ["source_system", "schema", "source_table", "source_column", "target_column", "target_column_type"]
    t.spark.createDataFrame(TARGETS, names).coalesce(1).write.option("header", True).csv(spec)
    tables = mapped_tables(load_mapping(t.spark, spec, with_targets=True))
    schema = target_schema(tables)
    frames = {
        "crm": t.customer.select(
            F.col("c_custkey").cast("string").alias("id"), F.lit("x").alias("first_name"), F.col("c_acctbal").cast("string").alias("balance")
        ),
        "vendor": vendor(t).select("id", "email"),
    }
    return union_all(to_targets(frames[x.system], x, schema) for x in tables)


@query(
    f"""select 'crm' as system, count(*) as rows from ({CRM}) union all select 'vendor', count(*) from ({VENDOR})
    union all select 'crm next', count(*) from ({CRM}) union all select 'vendor next', null"""
)
def missing_report(t: Tables) -> DataFrame:
    """Rows written for each mapped table of two days; a table without a snapshot is reported."""
    tables, root = _raw(t)
    out = fresh_dir(t.spark, "trusted")
    rows = []
    for after, day in (("", DAY), (" next", DAY + dt.timedelta(days=1))):
        written = raw_to_trusted(t.spark, tables, root, out, day, DATABASES)
        rows += [(name.split("_")[0] + after, n) for name, n in written.items()]
    return t.spark.createDataFrame(rows, "system string, rows bigint")


@query(f"select 'vendor' as system, cast(id as varchar) as id, email from ({VENDOR}) union all select 'vendor', null, null")
def placeholder_zone(t: Tables) -> DataFrame:
    """Raw tables of a mapping loaded as they are, and the row that stands for a table that is missing."""
    tables, root = _raw(t)
    loaded = load_tables(t.spark, [x for x in tables if x.system == "vendor"], root, DAY, DATABASES)["vendor_people"]
    out, later = fresh_dir(t.spark, "trusted"), DAY + dt.timedelta(days=1)
    raw_to_trusted(t.spark, tables, root, out, later, DATABASES, missing="placeholder")
    blank = load_trusted(t.spark, tables, out, later, DATABASES)["vendor_people"]
    both = loaded.select(F.col("id").cast("string"), "email").unionByName(blank.select("id", "email"))
    return both.select(F.lit("vendor").alias("system"), "id", "email")


@query("""select 'buyer' as table_name, c_custkey as id, c_name as name from {customer}
    union all select 'purchase', o_orderkey, o_orderpriority from {orders}""")
def catalog_landing(t: Tables) -> DataFrame:
    """Every table of a catalog database copied to its dated raw folder."""
    place, out = fresh_dir(t.spark, "database"), fresh_dir(t.spark, "raw")
    database = place.rsplit("/", 1)[-1].replace("-", "_")
    t.spark.sql(f"create database {database} location '{place}'")
    try:
        t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")).write.saveAsTable(f"{database}.buyer")
        t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("name")).write.saveAsTable(f"{database}.purchase")
        names = land_database(t.spark, database, out, "erp", DAY)
    finally:
        t.spark.sql(f"drop database {database} cascade")
    frames = [t.spark.read.parquet(f"{out}/erp/{name}").select(F.lit(name).alias("table_name"), F.col("id").cast("bigint"), "name") for name in sorted(names)]
    return frames[0].unionByName(frames[1])


@query("""select o_orderkey as id, o_orderpriority as name, o_custkey as buyer from {orders}
    union all select o_orderkey, o_orderpriority, o_custkey from {orders}""")
def csv_snapshot(t: Tables) -> DataFrame:
    """A snapshot of CSV files, found and read by its format, beside the same with a declared schema."""
    root = fresh_dir(t.spark, "raw")
    table = MappedTable("erp", "null", "purchase", ("id", "name", "buyer"))
    rows = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("name"), F.col("o_custkey").alias("buyer"))
    rows.write.option("header", True).csv(f"{root}/{table.folder()}/2024/01/02")
    path = find_snapshot(t.spark, root, table, DAY)
    found = read_snapshot(t.spark, path, detect_format(t.spark, path))
    typed = read_snapshot(t.spark, path, "csv", {"id": "bigint", "name": "string", "buyer": "bigint"})
    return found.select(F.col("id").cast("bigint"), "name", F.col("buyer").cast("bigint")).unionByName(typed)


@query(
    f"""select target, id, last_name, 'id,last_name,created_at,updated_at' as columns, true as stamped
    from (values ('json'), ('folder')) x(target), (select id, last_name from ({CRM}))"""
)
def warehouse_targets(t: Tables) -> DataFrame:
    """A table with audit columns and an empty one, written to two targets; the empty one is left out."""
    json_root, folder = fresh_dir(t.spark, "json"), FolderTarget(fresh_dir(t.spark, "warehouse"))
    people = with_audit(crm(t).select("id", "last_name"))
    written = write_all({"people": people, "nobody": empty_like(people)}, json_root, folder)
    frames = {"json": t.spark.read.schema(people.schema).json(f"{json_root}/people"), "folder": t.spark.read.parquet(f"{folder.root}/people")}
    assert written == ["people"]
    rows = [
        df.select(
            F.lit(name).alias("target"),
            "id",
            "last_name",
            F.lit(",".join(df.columns)).alias("columns"),
            F.col("created_at").eqNullSafe(F.col("updated_at")).alias("stamped"),
        )
        for name, df in frames.items()
    ]
    return rows[0].unionByName(rows[1])


@query(
    """with first as (select distinct c_mktsegment as platform, 'desk ' || (c_custkey % 1000) as name from {customer} where c_nationkey % 2 = 0),
    every as (select distinct c_mktsegment as platform, 'desk ' || (c_custkey % 1000) as name from {customer}),
    one as (select row_number() over (order by platform, name) as id, * from first),
    two as (select (select count(*) from one) + row_number() over (order by platform, name) as id, *
      from (select * from every except select * from first))
    select 1 as load, cast(id as int) as id, name, platform, customers from (select * from one) join (
      select c_mktsegment as platform, 'desk ' || (c_custkey % 1000) as name, count(*) as customers from {customer} where c_nationkey % 2 = 0 group by 1, 2)
      using (platform, name)
    union all select 2, cast(id as int), name, platform, customers from (select * from one union all select * from two) join (
      select c_mktsegment as platform, 'desk ' || (c_custkey % 1000) as name, count(*) as customers from {customer} group by 1, 2)
      using (platform, name)"""
)
def stable_source_ids(t: Tables) -> DataFrame:
    """Customers counted by source in two loads; the second shows more sources, and those of the first keep their ids."""
    book = source_book(t.spark, fresh_dir(t.spark, "sources"))
    desk = F.concat(F.lit("desk "), (F.col("c_custkey") % 1000).cast("string"))
    seen = t.customer.select(F.col("c_mktsegment").alias("platform"), desk.alias("name"), F.lit(None).cast("string").alias("url"), "c_nationkey")
    loads = []
    for load, rows in ((1, seen.where("c_nationkey % 2 = 0")), (2, seen)):
        known = book.extend(rows)
        counted = rows.groupBy("platform", "name").agg(F.count("*").alias("customers"))
        loads.append(join_on(known, counted, equal=["platform", "name"]).select(F.lit(load).alias("load"), "id", "name", "platform", "customers"))
    return loads[0].unionByName(loads[1])


@query(
    " union all ".join(
        f"select '{n}' as table_name, count(*) as rows, cast(sum({k}) as bigint) as keys from {{{n}}}"
        for n, k in [("customer", "c_custkey"), ("supplier", "s_suppkey"), ("part", "p_partkey"), ("orders", "o_orderkey"),
                     ("lineitem", "l_orderkey"), ("events", "event_id"), ("nation", "n_nationkey"), ("region", "r_regionkey")]
    )
    + """ union all select 'buyers', count(*), cast(sum(k) as bigint) from (select distinct o_custkey as k from {orders})
    union all select 'sold', count(*), cast(sum(k) as bigint) from (select distinct l_partkey as k from {lineitem})
    union all select 'sellers', count(*), cast(sum(k) as bigint) from (select distinct l_suppkey as k from {lineitem})
    union all select 'users', count(*), cast(sum(k) as bigint) from (select distinct user_id as k from {events})
    union all select 'returned', count(*), cast(sum(l_orderkey) as bigint) from {lineitem} where l_returnflag = 'R'"""
)
def published_together(t: Tables) -> DataFrame:
    """Thirteen tables published at once. The next time the seventh fails, and readers go on seeing the first thirteen."""
    keyed = {
        name: (getattr(t, name), F.col(key))
        for name, key in {"customer": "c_custkey", "supplier": "s_suppkey", "part": "p_partkey", "orders": "o_orderkey",
                          "lineitem": "l_orderkey", "events": "event_id", "nation": "n_nationkey", "region": "r_regionkey"}.items()
    }
    keyed["returned"] = (t.lineitem.where("l_returnflag = 'R'"), F.col("l_orderkey"))
    tables = {name: df.select(key.cast("bigint").alias("key")) for name, (df, key) in keyed.items()}
    for name, df, key in (("buyers", t.orders, "o_custkey"), ("sold", t.lineitem, "l_partkey"), ("sellers", t.lineitem, "l_suppkey"), ("users", t.events, "user_id")):
        tables[name] = df.select(F.col(key).alias("key")).distinct()
    published = Published(t.spark, fresh_dir(t.spark, "published"))
    publish_all(tables, published)
    later = {name: df.where("key > 0") for name, df in tables.items()}
    seventh = list(later)[6]
    later[seventh] = later[seventh].where(F.raise_error(F.lit("broken off")).isNull())
    try:
        publish_all(later, published)
    except Exception as error:  # noqa: BLE001
        assert "broken off" in str(error)
    state = published.state()
    parts = [
        published.read([name], "key bigint", state).agg(F.count("*").alias("rows"), F.sum("key").alias("keys")).select(F.lit(name).alias("table_name"), "rows", "keys")
        for name in tables
    ]
    return reduce(DataFrame.unionByName, parts)
