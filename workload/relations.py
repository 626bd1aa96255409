"""Join shapes, filters, snapshots, sinks, streams."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from guestbook.operators.joins import full_outer, join_on, left_chain, lookup, spread_join
from guestbook.operators.snapshots import carry_forward, latest_snapshot, missing_action, missing_snapshots, of_day, placeholder_row
from guestbook.functions import trim_blank
from guestbook.operators.conform import conform
from guestbook.session import fresh_dir
from guestbook.sinks.files import land, stripped_json, write_json, write_parquet, write_stripped_json
from guestbook.sinks.warehouse import FolderTarget, full_refresh
from guestbook.streaming.compaction import compact, compacted
from guestbook.streaming.incremental import new_files, run_once
from guestbook.streaming.ledger import Intake
from guestbook.sources.files import _file_system
from guestbook.streaming.webhook import faulty_messages, land_messages, landed_messages, latest_messages, parse
from workload.recipes import ACTIONS, CAMPAIGNS, CRM, LISTS, UNBLANKED, VENDOR, crm, vendor
from workload.registry import Tables, query


@query(
    """select c_custkey, o_orderkey, l_linenumber, p_name, s_name, n_name from {customer}
    left join {orders} on c_custkey = o_custkey left join {lineitem} on o_orderkey = l_orderkey
    left join {part} on l_partkey = p_partkey left join {supplier} on l_suppkey = s_suppkey
    left join {nation} on s_nationkey = n_nationkey""",
    name="left_chain",
)
def left_chain_join(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderkey", "o_custkey")
    items = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    chained = left_chain(
        t.customer.select("c_custkey"),
        [
            (orders, [("c_custkey", "o_custkey")]),
            (items, [("o_orderkey", "l_orderkey")]),
            (t.part.select("p_partkey", "p_name"), [("l_partkey", "p_partkey")]),
            (t.supplier.select("s_suppkey", "s_name", "s_nationkey"), [("l_suppkey", "s_suppkey")]),
            (t.nation.select("n_nationkey", "n_name"), [("s_nationkey", "n_nationkey")]),
        ],
    )
    return chained.select("c_custkey", "o_orderkey", "l_linenumber", "p_name", "s_name", "n_name")


@query(
    """select c_custkey, o_orderkey, l_linenumber from {customer}
    left join {orders} on c_custkey = o_custkey and c_acctbal > 0
    left join {lineitem} on o_orderkey = l_orderkey"""
)
def linked_chain_join(t: Tables) -> DataFrame:
    """A step that only matches where a condition on the row so far holds."""
    orders = t.orders.select("o_orderkey", "o_custkey")
    found = join_on(
        t.customer.select("c_custkey", "c_acctbal"),
        orders,
        equal=[("c_custkey", "o_custkey")],
        how="left",
        when=F.col("c_acctbal") > 0,
    )
    items = t.lineitem.select("l_orderkey", "l_linenumber")
    return join_on(found, items, equal=[("o_orderkey", "l_orderkey")], how="left").select(
        "c_custkey", "o_orderkey", "l_linenumber"
    )


@query(
    f"""select a.id as a_id, b.id as b_id from ({CRM}) a left join ({VENDOR}) b
    on {UNBLANKED % 'a.email'} = {UNBLANKED % 'b.email'}"""
)
def computed_key_join(t: Tables) -> DataFrame:
    a = crm(t).select(F.col("id").alias("a_id"), trim_blank("email").alias("email"))
    b = vendor(t).select(F.col("id").alias("b_id"), trim_blank("email").alias("email"))
    return join_on(a, b, equal=["email"], how="left").select("a_id", "b_id")


@query(
    f"""select u.id as user_id, a.event_id, a.marketing_action_type, c.source_campaign_id, c.campaign_name
    from ({CRM}) u left join ({ACTIONS}) a on {UNBLANKED % 'u.email'} = a.email
    full outer join ({CAMPAIGNS}) c on a.source_campaign_id = c.source_campaign_id"""
)
def full_outer_engagement(t: Tables) -> DataFrame:
    """Users with their actions, and every campaign, used or not."""
    users = crm(t).select(F.col("id").alias("user_id"), trim_blank("email").alias("email"))
    actions = t.sql(ACTIONS).withColumnRenamed("source_campaign_id", "action_campaign")
    acted = join_on(users, actions, equal=["email"], how="left")
    joined = full_outer(acted, t.sql(CAMPAIGNS), [("action_campaign", "source_campaign_id")])
    return joined.select("user_id", "event_id", "marketing_action_type", "source_campaign_id", "campaign_name")


@query(
    f"""select l.list_id, l.list_name, a.event_id, a.email, u.id as user_id from ({LISTS}) l
    left join (select * from ({ACTIONS}) where marketing_action_type in ('email_subscribe', 'email_unsubscribe')) a
      on l.list_id = a.list_id
    left join ({CRM}) u on a.email = {UNBLANKED % 'u.email'}"""
)
def subscription_history(t: Tables) -> DataFrame:
    """Lists first, with who joined or left them."""
    acted = t.sql(ACTIONS).where(F.col("marketing_action_type").isin("email_subscribe", "email_unsubscribe"))
    lists = t.sql(LISTS).select("list_id", "list_name")
    users = crm(t).select(F.col("id").alias("user_id"), trim_blank("email").alias("email"))
    chained = left_chain(
        lists, [(acted.select("list_id", "event_id", "email"), ["list_id"]), (users.withColumnRenamed("email", "_email"), [("email", "_email")])]
    )
    return chained.select("list_id", "list_name", "event_id", "email", "user_id")


@query(
    f"""select c.source_campaign_id, a.event_id, u.id as user_id from ({CAMPAIGNS}) c
    left join ({ACTIONS}) a on c.source_campaign_id = a.source_campaign_id
    left join ({CRM}) u on a.email = {UNBLANKED % 'u.email'}"""
)
def campaign_history(t: Tables) -> DataFrame:
    """Campaigns first, with their actions and users."""
    acted = t.sql(ACTIONS).select("source_campaign_id", "event_id", "email")
    users = crm(t).select(F.col("id").alias("user_id"), trim_blank("email").alias("_email"))
    chained = left_chain(
        t.sql(CAMPAIGNS).select("source_campaign_id"), [(acted, ["source_campaign_id"]), (users, [("email", "_email")])]
    )
    return chained.select("source_campaign_id", "event_id", "user_id")


@query(
    """select c_custkey, c_name, o_orderkey, o_totalprice from {customer}
    full outer join {orders} on c_custkey = o_custkey where o_orderstatus = 'F'"""
)
def outer_then_filter(t: Tables) -> DataFrame:
    """The filter on the right side leaves a right join, written as one."""
    finished = t.orders.where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey", "o_totalprice")
    found = join_on(finished, t.customer.select("c_custkey", "c_name").withColumn("_key", F.col("c_custkey")),
                    equal=[("o_custkey", "_key")], how="left")
    return found.select("c_custkey", "c_name", "o_orderkey", "o_totalprice")


@query(
    """select s_suppkey, c_custkey from {supplier} join (
      select c_nationkey, min(c_custkey) as c_custkey from {customer} group by c_nationkey)
    on s_nationkey = c_nationkey
    union all select s_suppkey, null from {supplier}
    where s_nationkey not in (select c_nationkey from {customer})"""
)
def least_match_lookup(t: Tables) -> DataFrame:
    """One match per row, the least, however many there are."""
    return lookup(
        t.supplier.select("s_suppkey", F.col("s_nationkey").cast("string").alias("s_nationkey")),
        t.customer.select("c_custkey", F.col("c_nationkey").cast("string").alias("c_nationkey")),
        [("s_nationkey", "c_nationkey")], "c_custkey", "c_custkey",
    ).select("s_suppkey", "c_custkey")


@query(
    """select l_orderkey, l_linenumber, l_suppkey, s_name from {lineitem} left join {supplier} on l_suppkey = s_suppkey"""
)
def spread_supplier_join(t: Tables) -> DataFrame:
    """A join one of whose keys is known to be hot."""
    facts = t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_suppkey").alias("suppkey"))
    names = t.supplier.select(F.col("s_suppkey").alias("suppkey"), "s_name")
    joined = spread_join(facts, names, ["suppkey"], hot=F.col("suppkey") == 1, how="left")
    return joined.select("l_orderkey", "l_linenumber", F.col("suppkey").alias("l_suppkey"), "s_name")


# --- filters ---------------------------------------------------------------------------------


@query(
    f"""select event_id, email, marketing_action_type from ({ACTIONS})
    where marketing_action_type = 'email_subscribe' or marketing_action_type = 'email_unsubscribe'"""
)
def subscribe_filter(t: Tables) -> DataFrame:
    acted = t.sql(ACTIONS).select("event_id", "email", "marketing_action_type")
    kind = F.col("marketing_action_type")
    return acted.where((kind == "email_subscribe") | (kind == "email_unsubscribe"))


@query(
    """select c_custkey, c_mktsegment = 'BUILDING' as is_parent, nullif(c_mktsegment, 'MACHINERY') is not distinct from
      'HOUSEHOLD' as null_is_false from {customer}"""
)
def parent_flag(t: Tables) -> DataFrame:
    segment = F.col("c_mktsegment")
    partly = F.nullif(segment, F.lit("MACHINERY"))
    return t.customer.select(
        "c_custkey",
        F.coalesce(segment == "BUILDING", F.lit(False)).alias("is_parent"),
        F.coalesce(partly == "HOUSEHOLD", F.lit(False)).alias("null_is_false"),
    )


@query(
    """select o_orderkey, o_totalprice > 100000 as is_won from {orders}
    where cast(o_totalprice > 100000 as varchar) = 'true'"""
)
def won_filter(t: Tables) -> DataFrame:
    """A flag that arrives as text."""
    flagged = t.orders.select("o_orderkey", (F.col("o_totalprice") > 100000).cast("string").alias("iswon"))
    won = flagged.where(F.col("iswon") == "true")
    return won.select("o_orderkey", F.col("iswon").try_cast("boolean").alias("is_won"))


@query(
    """select c_custkey, try_cast(try_cast(c_name as double) as int) as whole_name,
      cast(trunc(c_acctbal) as int) as whole_balance, try_cast(c_mktsegment as boolean) as flag from {customer}"""
)
def tolerant_casts(t: Tables) -> DataFrame:
    """Text that is no number gives null, decimals in text are cut."""
    rows = t.customer.withColumn("balance_text", F.col("c_acctbal").cast("string"))
    return conform(
        rows,
        {"c_custkey": "c_custkey", "whole_name": "c_name", "whole_balance": "balance_text", "flag": "c_mktsegment"},
        {"c_custkey": "bigint", "whole_name": "int", "whole_balance": "int", "flag": "boolean"},
    )


# --- snapshots -------------------------------------------------------------------------------


@query(
    """select event_id, user_id, event_type from (
      select *, rank() over (partition by user_id order by cast(ts as date) desc) as r from {events}) where r = 1""",
    name="latest_snapshot",
)
def latest_snapshot_rows(t: Tables) -> DataFrame:
    """All rows of each user's last day."""
    daily = t.events.select("event_id", "user_id", "event_type", F.to_date("ts").alias("day"))
    return latest_snapshot(daily, ["user_id"], "day").select("event_id", "user_id", "event_type")


def _expected(t: Tables) -> DataFrame:
    """A user seen on one day is expected on the next."""
    return t.events.select("user_id", F.date_add(F.to_date("ts"), 1).alias("day")).distinct()


EXPECTED_SQL = "(select distinct user_id, cast(ts as date) + 1 as day from {events})"


@query(
    f"""select user_id, strftime(day, '%Y-%m-%d') as day from {EXPECTED_SQL} e
    where not exists (select 1 from {{events}} x where x.user_id = e.user_id and cast(x.ts as date) = e.day)"""
)
def snapshot_completeness(t: Tables) -> DataFrame:
    present = t.events.select("user_id", F.to_date("ts").alias("day"))
    missing = missing_snapshots(_expected(t), present, ["user_id", "day"])
    return missing.select("user_id", F.date_format("day", "yyyy-MM-dd").alias("day"))


@query(
    f"""select e.user_id, strftime(e.day, '%Y-%m-%d') as day,
      case when f.user_id is not null then 'report' else 'placeholder' end as action
    from {EXPECTED_SQL} e left join (select distinct user_id, cast(ts as date) + 1 as day from {{events}}
        where event_type = 'error') f on e.user_id = f.user_id and e.day = f.day
    where not exists (select 1 from {{events}} x where x.user_id = e.user_id and cast(x.ts as date) = e.day)""",
    name="missing_action",
)
def missing_action_choice(t: Tables) -> DataFrame:
    """Missing after an error is reported, missing otherwise gets a placeholder."""
    present = t.events.select("user_id", F.to_date("ts").alias("day"))
    missing = missing_snapshots(_expected(t), present, ["user_id", "day"])
    runs = t.events.select("user_id", F.date_add(F.to_date("ts"), 1).alias("day"), "event_type")
    chosen = missing_action(missing, runs, ["user_id", "day"], F.col("event_type") == "error")
    return chosen.select("user_id", F.date_format("day", "yyyy-MM-dd").alias("day"), "action")


@query(
    """select user_id, cast(null as varchar) as event_type, cast(null as double) as value, strftime(day, '%Y-%m-%d') as day
    from (select distinct user_id, cast(ts as date) + 1 as day from {events}) e
    where not exists (select 1 from {events} x where x.user_id = e.user_id and cast(x.ts as date) = e.day)""",
    name="placeholder_row",
)
def placeholder_rows(t: Tables) -> DataFrame:
    """An all-null row, under the table's own schema, for every snapshot that is missing."""
    present = t.events.select("user_id", F.to_date("ts").alias("day"))
    missing = missing_snapshots(_expected(t), present, ["user_id", "day"])
    blank = placeholder_row(t.events.select("event_type", "value"))
    stand_ins = conform(missing, {"user_id": "user_id", "day": F.date_format("day", "yyyy-MM-dd")},
                        {"user_id": "bigint", **dict(blank.dtypes), "day": "string"})
    return stand_ins


CARRY_DAY = dt.date(2024, 1, 3)


@query(
    """select event_id, user_id, '2024-01-03' as snapshot_date from {events}
    where cast(ts as date) = date '2024-01-02' and user_id not in (
      select user_id from {events} where cast(ts as date) = date '2024-01-03')""",
    name="carry_forward",
)
def carry_forward_rows(t: Tables) -> DataFrame:
    """Yesterday's rows of whoever is silent today."""
    daily = t.events.select("event_id", "user_id", F.to_date("ts").alias("snapshot_date"))
    carried = carry_forward(daily, ["user_id"], CARRY_DAY)
    return carried.withColumn("snapshot_date", F.date_format("snapshot_date", "yyyy-MM-dd"))


# --- sinks -----------------------------------------------------------------------------------


@query(
    f"""select id, email, nullif(country, 'null') as country from ({CRM})
    where (email is not null)::int + (nullif(country, 'null') is not null)::int + 1 > 1"""
)
def null_stripped_json(t: Tables) -> DataFrame:
    """Feed lines read back by field; a line with the id alone is left out."""
    rows = crm(t).select("id", "email", "country")
    text = stripped_json(rows, skip_bare=True)
    return text.select(F.from_json("json", "id bigint, email string, country string").alias("r")).select("r.*")


@query(f"select id, email, nullif(country, 'null') as country from ({CRM})")
def stripped_feed_files(t: Tables) -> DataFrame:
    """The feed as files of bounded length, read back."""
    path = fresh_dir(t.spark, "feed")
    write_stripped_json(crm(t).select("id", "email", "country"), path, per_file=1000)
    return t.spark.read.schema("id bigint, email string, country string").json(path)


ROUND = "select id, first_name, last_name, email, street, country"


@query(f"{ROUND} from ({CRM})")
def parquet_round_trip(t: Tables) -> DataFrame:
    path = fresh_dir(t.spark, "parquet")
    rows = crm(t).select("id", "first_name", "last_name", "email", "street", "country")
    write_parquet(rows, path, marker=False)
    return t.spark.read.schema(rows.schema).parquet(path)


@query(f"{ROUND} from ({CRM})")
def json_round_trip(t: Tables) -> DataFrame:
    path = fresh_dir(t.spark, "json")
    rows = crm(t).select("id", "first_name", "last_name", "email", "street", "country")
    write_json(rows, path)
    return t.spark.read.schema(rows.schema).json(path)


@query(f"select id, last_name, nullif(substring(street, 9, 100), '') as suffix from ({CRM})",
    name="full_refresh",
)
def warehouse_refresh(t: Tables) -> DataFrame:
    """Empty text reaches the warehouse as null, twice over."""
    root = fresh_dir(t.spark, "warehouse")
    rows = crm(t).select("id", "last_name", F.substring("street", 9, 100).alias("suffix"))
    for _ in range(2):
        full_refresh(rows, "people", FolderTarget(root))
    return t.spark.read.schema(rows.schema).parquet(f"{root}/people")


@query("""select event_id, event_type, day from {events}, (values ('2024-01-01'), ('2024-01-02')) d(day)
    union all select -1, 'again', '2024-01-01'""")
def raw_landing(t: Tables) -> DataFrame:
    """Two days landed, the first of them twice: the second landing replaces that day alone."""
    path = fresh_dir(t.spark, "raw")
    rows = t.events.select("event_id", "event_type")
    more = t.spark.range(1).select((F.col("id") - 1).alias("event_id"), F.lit("again").alias("event_type"))
    for day, df in (("2024-01-01", rows.where("event_type = 'click'")), ("2024-01-02", rows), ("2024-01-01", rows.union(more))):
        land(df, path, day)
    return t.spark.read.parquet(path).select("event_id", "event_type", F.date_format("snapshot_date", "yyyy-MM-dd").alias("day"))


@query("""select event_id, user_id, strftime(ts, '%Y-%m-%d') as day from {events}""")
def landed_days(t: Tables) -> DataFrame:
    """Events landed by day, all days read back one by one."""
    path = fresh_dir(t.spark, "raw")
    daily = t.events.select("event_id", "user_id", F.to_date("ts").alias("snapshot_date"))
    write_parquet(daily.repartition("snapshot_date"), path, partition_by=["snapshot_date"])
    landed = t.spark.read.parquet(path)
    days = [of_day(landed, dt.date(2024, 1, 1) + dt.timedelta(days=i)) for i in range(31)]
    rest = landed.where(~F.col("snapshot_date").between("2024-01-01", "2024-01-31"))
    return reduce(DataFrame.union, [*days, rest]).select("event_id", "user_id", F.date_format("snapshot_date", "yyyy-MM-dd").alias("day"))


# --- streams ---------------------------------------------------------------------------------


def _date_files(t: Tables, path: str, day: dt.datetime) -> None:
    """Date every file of a folder."""
    system, folder = _file_system(t.spark, path)
    for status in system.listStatus(folder):
        system.setTimes(status.getPath(), int(day.timestamp() * 1000), -1)


@query("select event_id, user_id, event_type, value from {events} where event_type <> 'error'")
def incremental_files(t: Tables) -> DataFrame:
    """Five runs by the ledger: the first half; nothing new; the rest, in files dated a month before, where one run fails and
    the next takes them; nothing new."""
    schema = t.events.schema
    source, store = (fresh_dir(t.spark, x) for x in ("intake", "increment"))
    intake = Intake(t.spark, f"{source}/part=*", store, schema)

    def good(rows: DataFrame) -> DataFrame:
        return rows.where(F.col("event_type") != "error")

    def broken(rows: DataFrame) -> DataFrame:
        return rows.where(F.raise_error(F.lit("broken off")).isNull())

    for half in (0, 1):
        part = f"{source}/part={half}"
        t.events.where(F.col("event_id") % 2 == half).write.parquet(part)
        if half:
            _date_files(t, part, dt.datetime.now() - dt.timedelta(days=30))
            try:
                intake.run(broken)
            except Exception as error:  # noqa: BLE001
                assert "broken off" in str(error)
        for _ in range(2):
            intake.run(good)
    return intake.rows().select("event_id", "user_id", "event_type", "value")


MESSAGE_ID = "concat(cast(user_id as varchar), '-', cast(regexp_extract(props, '([0-9]+)', 1) as varchar))"


@query(
    f"""select 'none' as fault, event_type as event_name, {MESSAGE_ID} as message_id, strftime(ts, '%Y-%m-%d') as event_date,
      count(*) * 2 as copies, max(strftime(ts, '%Y-%m-%d %H:%M:%S.%f')) as received_at
    from {{events}} where event_id % 10 <> 0 group by 2, 3, 4
    union all
    select case event_id % 30 when 0 then 'unreadable' when 10 then 'no event name' else 'no message id' end,
      null, cast(event_id as varchar), strftime(ts, '%Y-%m-%d'), 2, strftime(ts, '%Y-%m-%d %H:%M:%S.%f')
    from {{events}} where event_id % 10 = 0"""
)
def webhook_landing(t: Tables) -> DataFrame:
    """Message bodies landed in three runs, the latest days first, each twice; every tenth is malformed.

    All are landed, however late, and compacted after each run: the last copy of a good message of a day wins, and is read
    as it stands. The malformed are counted by body.
    """
    number = F.get_json_object("props", "$.k")
    good = F.to_json(
        F.struct(
            F.col("event_type").alias("eventName"),
            F.struct(F.concat_ws("-", F.col("user_id").cast("string"), number).alias("messageId"), "event_id").alias(
                "dataFields"
            ),
        )
    )
    tag = F.col("event_id").cast("string")
    body = (
        F.when(F.col("event_id") % 30 == 0, F.concat(F.lit("not json "), tag))
        .when(F.col("event_id") % 30 == 10, F.concat(F.lit('{"dataFields": {"messageId": "m"}, "n": '), tag, F.lit("}")))
        .when(F.col("event_id") % 30 == 20, F.concat(F.lit('{"eventName": "click", "n": '), tag, F.lit("}")))
        .otherwise(good)
    )
    sent = t.events.select(body.alias("body"), F.col("ts").cast("timestamp").alias("received_at"))
    source, out, checkpoint, store = (fresh_dir(t.spark, x) for x in ("sent", "webhook", "progress", "compacted"))
    third = F.floor((F.dayofyear("received_at") - 1) / 11)
    for run in (2, 0, 1):
        part = sent.where(third == run if run else third.isNull() | ~third.isin(1, 2))
        part.union(part).write.mode("append").parquet(source)
        land_messages(parse(new_files(t.spark, source, sent.schema)), out, checkpoint)
        compact(t.spark, out, store)
    names = ["event_name", "message_id", "event_date"]
    good_rows = compacted(t.spark, store).select(F.lit("none").alias("fault"), *names, "copies", "received_at")
    bad = (
        faulty_messages(t.spark, out)
        .withColumn("message_id", F.regexp_extract("body", "([0-9]+)}?$", 1))
        .groupBy("fault", F.lit(None).cast("string").alias("event_name"), "message_id", "event_date", "received_at")
        .agg(F.count("*").alias("copies"))
    )
    return good_rows.unionByName(bad).select(
        "fault",
        "event_name",
        "message_id",
        F.date_format("event_date", "yyyy-MM-dd").alias("event_date"),
        "copies",
        F.date_format("received_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("received_at"),
    )


@query(
    f"""select event_type as event_name, {MESSAGE_ID} as message_id, strftime(ts, '%Y-%m-%d') as event_date,
      max(strftime(ts, '%Y-%m-%d %H:%M:%S.%f')) as received_at from {{events}} group by 1, 2, 3"""
)
def last_messages(t: Tables) -> DataFrame:
    """The last copy of each message of a day, ranked straight from a landing that isn't compacted."""
    number = F.get_json_object("props", "$.k")
    fields = F.struct(F.concat_ws("-", F.col("user_id").cast("string"), number).alias("messageId"))
    body = F.to_json(F.struct(F.col("event_type").alias("eventName"), fields.alias("dataFields")))
    source, out, checkpoint = (fresh_dir(t.spark, x) for x in ("sent", "webhook", "progress"))
    sent = t.events.select(body.alias("body"), F.col("ts").cast("timestamp").alias("received_at"))
    sent.write.parquet(source)
    land_messages(parse(new_files(t.spark, source, sent.schema)), out, checkpoint)
    last = latest_messages(landed_messages(t.spark, out))
    day = F.date_format("event_date", "yyyy-MM-dd").alias("event_date")
    return last.select("event_name", "message_id", day, F.date_format("received_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("received_at"))


@query("select event_id, user_id, event_type from {events} where event_type <> 'error'")
def streamed_files(t: Tables) -> DataFrame:
    """The same intake by a stream, whose checkpoint remembers the files."""
    source, out, checkpoint = (fresh_dir(t.spark, x) for x in ("intake", "increment", "progress"))
    t.events.write.parquet(source)
    for _ in range(2):
        run_once(new_files(t.spark, source, t.events.schema), out, checkpoint, lambda batch: batch.where(F.col("event_type") != "error"))
    return t.spark.read.parquet(out).select("event_id", "user_id", "event_type")
