"""White space, schema repair, null rows, nested fields."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from guestbook.functions import date_path, epoch_micros, from_epoch_micros, squeeze, street_line
from guestbook.operators import clean
from guestbook.operators.quality import REASON
from guestbook.plans.landing import read_zone, verdicts, write_zones
from guestbook.session import fresh_dir
from guestbook.sources.files import read_snapshot
from guestbook.sources.systems import store_customers, store_orders
from workload.quality import email_sql, phone_sql
from workload.recipes import CRM, SQUEEZED, crm
from workload.registry import Tables, query


@query(
    f"""select 'person' as kind, id, {SQUEEZED % 'first_name'} as text from ({CRM})
    union all select 'document', doc_id, {SQUEEZED % 'text'} from {{documents}}"""
)
def whitespace_normalise(t: Tables) -> DataFrame:
    people = crm(t).select(F.lit("person").alias("kind"), "id", squeeze("first_name").alias("text"))
    docs = t.documents.select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"), squeeze("text").alias("text"))
    return people.union(docs)


def messy(t: Tables) -> DataFrame:
    """A raw table with nested fields, a dotted name, and a column given twice."""
    return t.customer.select(
        F.struct(
            F.concat(F.lit(" "), "c_name", F.lit("\t")).alias("full_name"),
            F.concat("c_mktsegment", F.lit("  "), F.col("c_nationkey").cast("string")).alias("segment"),
        ).alias("profile"),
        F.col("c_custkey").alias("id"),
        F.concat(F.lit(" "), "c_mktsegment").alias("note.text"),
        F.lit("lost").alias("ID"),
        F.col("c_acctbal").alias("balance"),
    )


MAPPED = ["profile.full_name", "profile.segment", "id", "note_text", "balance", "loyalty.tier", "null"]


@query(
    f"""select c_custkey as id, {SQUEEZED % 'c_mktsegment'} as note_text, c_acctbal as balance,
      cast(null as varchar) as tier, c_name as full_name,
      c_mktsegment || ' ' || cast(c_nationkey as varchar) as segment
    from {{customer}}"""
)
def schema_reconcile(t: Tables) -> DataFrame:
    named = clean.drop_duplicate_columns(clean.rename_dots(messy(t)))
    return clean.normalise(clean.ensure_columns(named, MAPPED), MAPPED)


# Columns blanked where a row has nothing to say.
SPARSE = """
select o_orderkey as id, o_custkey as paid_by,
  case when o_orderkey % 4 <> 0 then o_totalprice end as total,
  case when o_orderkey % 3 = 0 then o_orderpriority when o_orderkey % 3 = 1 then 'null' end as priority,
  case when o_orderkey % 5 = 0 then o_orderstatus end as status
from {orders}
"""


@query(
    f"""select total, priority, status from ({SPARSE})
    where total is not null or priority is not null or status is not null"""
)
def null_rows_drop(t: Tables) -> DataFrame:
    return clean.drop_empty_rows(t.sql(SPARSE).select("total", "priority", "status"))


@query(f"select * from ({SPARSE}) where total is not null or status is not null")
def null_subset_drop(t: Tables) -> DataFrame:
    return clean.drop_empty_rows(t.sql(SPARSE), ["total", "status"])


@query(f"select * from ({SPARSE}) where paid_by is not null or total is not null or priority is not null or status is not null")
def null_records_drop(t: Tables) -> DataFrame:
    """Only the declared key is a key: ``paid_by`` counts, though its name holds "id"."""
    return clean.drop_null_records(t.sql(SPARSE), ["id"])


@query(f"select * from ({SPARSE}) where status is not null")
def missing_key_drop(t: Tables) -> DataFrame:
    return clean.require(t.sql(SPARSE), "status")


@query(f"select id, paid_by, total, nullif(priority, 'null') as priority, status from ({SPARSE})")
def sentinel_null(t: Tables) -> DataFrame:
    return clean.sentinel_to_null(t.sql(SPARSE))


@query(
    """select cast(n_nationkey as varchar) as n_nationkey, n_name, cast(n_regionkey as varchar) as n_regionkey
    from {nation}"""
)
def all_text(t: Tables) -> DataFrame:
    return clean.to_text(t.nation)


@query(
    f"""select id, string_split(street, ',')[1] as line_1, string_split(street, ',')[2] as line_2 from ({CRM})"""
)
def street_split(t: Tables) -> DataFrame:
    return crm(t).select("id", street_line("street", 0).alias("line_1"), street_line("street", 1).alias("line_2"))


def store_documents(t: Tables) -> DataFrame:
    """Raw store orders: one document per shipped line, its goods and its tax as nested items.

    The arrays are built row by row; an order without lines has an empty array.
    """
    item = "struct<product_id:string,quantity:double,price:double,total_discount:double,title:string>"
    goods = F.struct(
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_discount").alias("total_discount"),
        F.lit("goods").alias("title"),
    )
    tax = F.struct(
        F.lit("tax").alias("product_id"),
        F.lit(1.0).alias("quantity"),
        F.col("l_tax").alias("price"),
        F.lit(None).cast("double").alias("total_discount"),
        F.lit(None).cast("string").alias("title"),
    )
    items = F.when(F.col("l_orderkey").isNull(), F.array().cast(f"array<{item}>")).when(
        F.col("l_tax") > 0, F.array(goods.cast(item), tax.cast(item))
    ).otherwise(F.array(goods.cast(item)))
    place = [F.col("o_orderpriority").alias("address1"), F.lit(None).cast("string").alias("address2"),
             F.col("o_orderstatus").alias("city"), F.lit("S").alias("province"), F.lit("XX").alias("country"),
             F.lit("00000").alias("zip")]
    joined = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return joined.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderdate").alias("processed_at"),
        F.struct(F.col("o_custkey").alias("id")).alias("customer"),
        F.struct(*place).alias("shipping_address"),
        *place,
        F.lit(0.0).alias("total_discounts"),
        F.col("o_totalprice").alias("total_price"),
        F.lit(0.0).alias("total_tax"),
        F.lit(0.0).alias("amount"),
        F.col("o_totalprice").alias("subtotal_price"),
        items.alias("line_items"),
    )


ITEMS_SQL = """
  select o_orderkey, o_custkey, o_orderpriority, o_orderstatus, cast(l_partkey as varchar) as product_id,
    l_quantity as quantity, l_extendedprice as price, l_discount as item_discount, 'goods' as title
  from {orders} join {lineitem} on o_orderkey = l_orderkey
  union all
  select o_orderkey, o_custkey, o_orderpriority, o_orderstatus, 'tax', 1.0, l_tax, null, null
  from {orders} join {lineitem} on o_orderkey = l_orderkey where l_tax > 0
"""
NESTED_COLUMNS = [
    "source_order_id", "customer_key", "shipping_address_1", "billing_city", "source_instance",
    "source_product_id", "quantity", "unit_price", "item_discount", "product_name",
]
NESTED_SQL = """select o_orderkey as source_order_id, o_custkey as customer_key, o_orderpriority as shipping_address_1,
  o_orderstatus as billing_city, 'north' as source_instance, product_id as source_product_id, quantity,
  price as unit_price, item_discount, title as product_name"""


@query(f"{NESTED_SQL} from ({ITEMS_SQL})")
def nested_items_explode(t: Tables) -> DataFrame:
    """Orders without lines vanish."""
    return store_orders(store_documents(t), "north").select(*NESTED_COLUMNS)


@query(
    f"""{NESTED_SQL} from ({ITEMS_SQL}
      union all select o_orderkey, o_custkey, o_orderpriority, o_orderstatus, null, null, null, null, null
      from {{orders}} where o_orderkey not in (select l_orderkey from {{lineitem}}))"""
)
def nested_items_explode_outer(t: Tables) -> DataFrame:
    """Orders without lines stay, once."""
    return store_orders(store_documents(t), "north", keep_itemless=True).select(*NESTED_COLUMNS)


@query(
    """select c_custkey as source_consumer_id, c_name as name_last, n_name as address_1, c_mktsegment as city
      from {customer} join {nation} on c_nationkey = n_nationkey where c_acctbal > 0
    union all select c_custkey, c_name, c_mktsegment, null from {customer} where c_acctbal > 5000"""
)
def nested_addresses_explode(t: Tables) -> DataFrame:
    place = "struct<address1:string,address2:string,city:string,province:string,country:string,zip:string>"
    nothing = F.lit(None).cast("string")
    home = F.struct(F.col("n_name"), nothing, F.col("c_mktsegment"), nothing, nothing, nothing).cast(place)
    second = F.struct(F.col("c_mktsegment"), nothing, nothing, nothing, nothing, nothing).cast(place)
    homes = (
        F.when(F.col("c_acctbal") > 5000, F.array(home, second))
        .when(F.col("c_acctbal") > 0, F.array(home))
        .otherwise(F.array().cast(f"array<{place}>"))
    )
    customers = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("id"),
        F.lit(None).cast("string").alias("email"),
        F.lit(None).cast("string").alias("first_name"),
        F.col("c_name").alias("last_name"),
        homes.alias("addresses"),
    )
    return store_customers(customers).select("source_consumer_id", "name_last", "address_1", "city")


@query(
    """select event_id, epoch_us(ts) as micros, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as back from {events}""",
    name="epoch_micros",
)
def epoch_micros_round_trip(t: Tables) -> DataFrame:
    counted = t.events.select("event_id", epoch_micros("ts").alias("micros"))
    return counted.withColumn("back", F.date_format(from_epoch_micros("micros"), "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@query(
    """select event_id, strftime(ts, '%Y/%m/%d') as today, strftime(ts - interval 1 day, '%Y/%m/%d') as yesterday
    from {events}""",
    name="date_path",
)
def dated_folder(t: Tables) -> DataFrame:
    return t.events.select(
        "event_id", date_path("ts").alias("today"), date_path(F.date_sub(F.to_date("ts"), 1)).alias("yesterday")
    )


@query("select event_id, cast(regexp_extract(props, '([0-9]+)', 1) as int) as k from {events}")
def json_fields(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.from_json("props", "k int").getField("k").alias("k"))


# Every fifth person comes twice, in rows that are equal.
REPEATED = f"select id, first_name, email, phone from ({CRM}) union all select id, first_name, email, phone from ({CRM}) where id % 5 = 0"
TIDY = f"select distinct id, {SQUEEZED % 'first_name'} as first_name, {SQUEEZED % 'email'} as email, {SQUEEZED % 'phone'} as phone from ({REPEATED})"


@query(
    f"""select id, first_name, email, phone, cast(null as varchar) as referrer,
      case when {email_sql('email')} = 'invalid' then 'email' when {phone_sql('phone')} = 'invalid' then 'phone' end
        as reject_reason
    from ({TIDY})"""
)
def raw_to_trusted(t: Tables) -> DataFrame:
    """A raw table cleaned, split and written as two zones; both are read back."""
    mapped = ["id", "first_name", "email", "phone", "referrer"]
    path, day = fresh_dir(t.spark, "zones"), dt.date(2024, 1, 2)
    write_zones(verdicts(t.sql(REPEATED), mapped), path, day)
    good = read_zone(t.spark, path, day).withColumn(REASON, F.lit(None).cast("string"))
    return good.unionByName(read_zone(t.spark, path, day, "quarantine")).select(*mapped, REASON)


@query("""select doc_id, text, lang, source, cast(null as varchar) as author from {documents}
  union all select -1 - n_nationkey, n_name, null, null, n_comment from (select *, 'author ' || n_name as n_comment from {nation})""")
def drifted_snapshot(t: Tables) -> DataFrame:
    """A snapshot of two files, one of which lacks a column and one of which lacks two: all columns come back."""
    path = fresh_dir(t.spark, "drift")
    t.documents.select("doc_id", "text", "lang", "source").write.parquet(f"{path}/b")
    late = t.nation.select(
        (F.lit(-1).cast("bigint") - F.col("n_nationkey")).alias("doc_id"),
        F.col("n_name").alias("text"),
        F.concat(F.lit("author "), "n_name").alias("author"),
    )
    late.write.parquet(f"{path}/a")
    return read_snapshot(t.spark, path).select("doc_id", "text", "lang", "source", "author")
