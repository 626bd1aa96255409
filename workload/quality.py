"""Email, phone and reject rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from guestbook.functions import (
    any_phone_status,
    email_reason,
    email_status,
    email_status_seven,
    phone_status,
    phone_text,
    trim_blank,
)
from guestbook.operators.audit import counted
from guestbook.operators.quality import email_column, phone_columns, phone_plan, phone_zone, split_quality
from workload.recipes import CRM, UNBLANKED, VENDOR, crm
from workload.registry import Tables, query


WORD = r"[\p{L}\p{N}_.-]"


def email_sql(c: str) -> str:
    low = f"lower({c})"
    return f"""case when {c} is null then 'invalid'
      when not regexp_matches({low}, '{WORD}+@{WORD}+[^\\n][\\p{{L}}\\p{{N}}_]+') then 'invalid'
      when length({low}) - length(replace({low}, '@', '')) > 1 then 'invalid'
      when contains(split_part({low}, '@', 1), 'www') or contains(split_part({low}, '@', 1), 'http') then 'invalid'
      when not contains(split_part({low}, '@', 2), '.') then 'invalid'
      when regexp_extract(split_part({low}, '@', 2), '([^.]*)$', 1)
        in ('com', 'org', 'net', 'int', 'edu', 'gov', 'mil', 'biz') then 'valid'
      else 'invalid' end"""


def phone_sql(c: str) -> str:
    return f"""case when length(regexp_replace({c}, '[^0-9]', '', 'g')) between 10 and 12
      then 'valid' else 'invalid' end"""


def either(a: str, b: str) -> str:
    return f"case when {a} = 'valid' or {b} = 'valid' then 'valid' else 'invalid' end"


@query(
    f"""select id, email, {email_sql('email')} as status, {email_sql(UNBLANKED % 'email')} as trimmed_status,
      case when regexp_matches(email, '[\\p{{L}}\\p{{N}}_.]+@[\\p{{L}}\\p{{N}}_.]')
        and regexp_extract(email, '([^.]*)$', 1) in ('com', 'org', 'net', 'int', 'edu', 'gov', 'mil')
        then 'valid' else 'invalid' end as seven_status
    from ({CRM})"""
)
def email_validity(t: Tables) -> DataFrame:
    return crm(t).select(
        "id",
        "email",
        email_status("email").alias("status"),
        email_status(trim_blank("email")).alias("trimmed_status"),
        email_status_seven("email").alias("seven_status"),
    )


# Anything that may be an address: words around a sign.
CANDIDATE = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.@-]+"


@query(
    f"""select doc_id, address, {email_sql('address')} as status from (
      select doc_id, unnest(regexp_extract_all(text, '{CANDIDATE}')) as address from {{documents}})"""
)
def email_in_text(t: Tables) -> DataFrame:
    found = t.documents.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0))).alias("address"))
    return found.select("doc_id", "address", email_status("address").alias("status"))


# An address for each way to break the rule, and some that keep it. What is too long behind the sign alone is too
# long as a whole before that.
SHAPES = """
select c_custkey as id, case c_custkey % 18
    when 0 then null when 1 then 'plain' when 2 then 'a@b@example.com' when 3 then '@example.com' when 4 then 'u@'
    when 5 then concat(repeat('a', 60), '@', repeat('b.', 100), 'com')
    when 6 then concat(repeat('a', 65), '@example.com')
    when 7 then concat('a', '@', repeat('b.', 126), 'com')
    when 8 then 'a b@example.com' when 9 then '.a@example.com' when 10 then 'a@exa mple.com'
    when 11 then 'a@example..com' when 12 then 'a@-example.com'
    when 13 then concat('a@', repeat('b', 64), '.com') when 14 then 'a@example' when 15 then 'a@example.123'
    when 16 then 'a@example.test' else concat('u', cast(c_custkey as string), '@example.com') end as email
from {customer}
"""
LOCAL, DOMAIN = "split_part(email, '@', 1)", "split_part(email, '@', 2)"


@query(
    f"""select id, email, case
        when email is null then 'missing'
        when not contains(email, '@') then 'no @-sign'
        when length(email) - length(replace(email, '@', '')) > 1 then 'more than one @-sign'
        when {LOCAL} = '' then 'nothing before the @-sign'
        when {DOMAIN} = '' then 'nothing after the @-sign'
        when length(email) > 254 then 'address too long'
        when length({LOCAL}) > 64 then 'too long before the @-sign'
        when length({DOMAIN}) > 253 then 'too long after the @-sign'
        when not regexp_matches({LOCAL}, '^[A-Za-z0-9!#$%&''*+\\-/=?^_`{{|}}~.]+$') then 'bad character before the @-sign'
        when {LOCAL} like '.%' or {LOCAL} like '%.' or contains({LOCAL}, '..') then 'misplaced period before the @-sign'
        when not regexp_matches({DOMAIN}, '^[A-Za-z0-9.\\-]+$') then 'bad character after the @-sign'
        when {DOMAIN} like '.%' or {DOMAIN} like '%.' or contains({DOMAIN}, '..') then 'misplaced period after the @-sign'
        when {DOMAIN} like '-%' or {DOMAIN} like '%-' or contains({DOMAIN}, '.-') or contains({DOMAIN}, '-.')
          then 'misplaced hyphen after the @-sign'
        when len(list_filter(string_split({DOMAIN}, '.'), lambda x: length(x) > 63)) > 0 then 'domain label too long'
        when not contains({DOMAIN}, '.') then 'no period after the @-sign'
        when not regexp_matches(lower({DOMAIN}), '[a-z]$') then 'domain does not end in a letter'
        when regexp_extract(lower({DOMAIN}), '([^.]*)$', 1)
          in ('arpa', 'invalid', 'local', 'localhost', 'onion', 'test') then 'reserved domain'
        else 'valid email' end as reason
    from (select id, email from ({CRM}) union all select id, email from ({VENDOR}) union all {SHAPES})"""
)
def email_reasons(t: Tables) -> DataFrame:
    both = crm(t).select("id", "email").union(t.sql(VENDOR).select("id", "email")).union(t.sql(SHAPES))
    return both.select("id", "email", email_reason("email").alias("reason"))


@query(f"select id, phone, {phone_sql('phone')} as status from ({CRM})")
def phone_validity(t: Tables) -> DataFrame:
    return crm(t).select("id", "phone", phone_status("phone").alias("status"))


# A second number: good where the first is missing or short, and the other way round.
SECOND = f"""select *, case id % 3 when 0 then concat('020 7946 ', lpad(cast(id as string), 4, '0')) when 1 then '12345'
    end as mobile from ({CRM})"""


@query(f"""select id, phone, mobile, {either(phone_sql('phone'), phone_sql('mobile'))} as status from ({SECOND})""")
def phone_any_of(t: Tables) -> DataFrame:
    return t.sql(SECOND).select("id", "phone", "mobile", any_phone_status("phone", "mobile").alias("status"))


@query(f"select id, regexp_replace(phone, '[^0-9a-zA-Z$]+', '', 'g') as phone from ({CRM})")
def phone_format(t: Tables) -> DataFrame:
    return crm(t).select("id", phone_text("phone").alias("phone"))


# Calling prefixes for the zone check; the caller of the library brings a table like this.
PREFIXES = [
    ("1", "NA", "America"),
    ("11", "NA-1", "America/1"),
    ("110", "NA-10", "America/10"),
    ("12", "NA-2", "America/2"),
    ("44", "GB", "Europe/London"),
    ("1555", "NA-555", "America/555"),
    ("1104555", "NA-104", "America/104"),
    ("11045550", "NA-1040", "America/1040"),
    ("110455500", "NA-10400", "America/10400"),
    ("11055550", "NA-1050", "America/1050"),
]
PREFIX_SQL = "(values " + ", ".join(str(p) for p in PREFIXES) + ") p(prefix, country, zone)"


@query(
    f"""with numbers as (
      select id, phone, case when starts_with(phone, '+')
        and length(regexp_replace(phone, '[^0-9]', '', 'g')) between 8 and 15
        then regexp_replace(phone, '[^0-9]', '', 'g') end as e164 from ({CRM})),
    ranked as (
      select n.*, p.country, p.zone, row_number() over (partition by id order by length(p.prefix) desc) as rn
      from numbers n left join {PREFIX_SQL} on starts_with(n.e164, p.prefix))
    select id, phone, country, zone, case when phone is null then null when country is not null then 'valid'
      else 'invalid' end as phone_check
    from ranked where rn = 1"""
)
def phone_country(t: Tables) -> DataFrame:
    prefixes = t.spark.createDataFrame(PREFIXES, "prefix string, country string, zone string")
    return phone_zone(crm(t).select("id", "phone"), "phone", prefixes)


#: Prefixes inside prefixes, with the lengths each admits.
PLAN = [
    ("1", 11, 11, "NA", "America"),
    ("11", 9, 10, "NA-1", "America/1"),
    ("110", 11, 12, "NA-10", "America/10"),
    ("1104", 8, 10, "NA-104", "America/104"),
    ("11045", 12, 15, "NA-1045", "America/1045"),
    ("12", 8, 8, "NA-2", "America/2"),
    ("12", 11, 13, "NA-2 long", "America/2"),
    ("15", 12, 12, "NA-5", "America/5"),
    ("44", 12, 12, "GB", "Europe/London"),
]
PLAN_SQL = "(values " + ", ".join(str(p) for p in PLAN) + ") p(prefix, least, most, country, zone)"


@query(
    f"""with numbers as (
      select id, phone, case when starts_with(phone, '+') then regexp_replace(phone, '[^0-9]', '', 'g') end as e164 from ({CRM})),
    ranked as (
      select n.*, p.country, p.zone, row_number() over (partition by id order by length(p.prefix) desc) as rn
      from numbers n left join {PLAN_SQL} on starts_with(n.e164, p.prefix) and length(n.e164) between p.least and p.most)
    select id, phone, country, zone, case when phone is null then null when country is not null then 'valid'
      else 'invalid' end as phone_check
    from ranked where rn = 1"""
)
def phone_plan_country(t: Tables) -> DataFrame:
    """The longest prefix whose lengths admit the number."""
    plan = t.spark.createDataFrame(PLAN, "prefix string, least int, most int, country string, zone string")
    return phone_plan(crm(t).select("id", "phone"), "phone", plan)


@query(
    f"""select id, email, phone, case when {email_sql(UNBLANKED % 'email')} = 'invalid' then 'email'
        when {phone_sql('phone')} = 'invalid' then 'phone' end as reject_reason
    from ({CRM})"""
)
def quarantine_split(t: Tables) -> DataFrame:
    """The checks follow from the mapped columns."""
    mapped = ["first_name", "email", "phone"]
    rows = crm(t).select("id", F.col("email").alias("raw_email"), trim_blank("email").alias("email"), "phone")
    judged = split_quality(rows, email_column(mapped), phone_columns(mapped))
    return judged.select("id", F.col("raw_email").alias("email"), "phone", "reject_reason")


@query(
    f"""select step, rows from (
      select 'read' as step, count(*) as rows from ({CRM})
      union all select 'valid', count(*) from ({CRM})
        where {email_sql(UNBLANKED % 'email')} = 'valid' and {phone_sql('phone')} = 'valid'
      union all select 'rejected', count(*) from ({CRM})
        where {email_sql(UNBLANKED % 'email')} = 'invalid' or {phone_sql('phone')} = 'invalid')"""
)
def audit_counts(t: Tables) -> DataFrame:
    """Counts observed while one pass over the table runs."""
    read, before = counted(crm(t), "read")
    judged = split_quality(read.withColumn("email", trim_blank("email")), "email", ("phone",))
    kept = judged.withColumn("ok", F.col("reject_reason").isNull())
    tally = kept.groupBy("ok").agg(F.count(F.lit(1)).alias("rows")).collect()
    by_verdict = {row["ok"]: row["rows"] for row in tally}
    rows = [
        ("read", before.get["rows"]),
        ("valid", by_verdict.get(True, 0)),
        ("rejected", by_verdict.get(False, 0)),
    ]
    return t.spark.createDataFrame(rows, "step string, rows bigint")
