"""Personal data, and terms that reveal it, by information-theoretic sanitisation.

Entities (e-mail and IP addresses, card and phone numbers) are found by pattern. How far a term reveals an entity is
estimated from the corpus: over all distinct lines, the pointwise mutual information of term and entity
against the information of the entity itself, which is 1 where the term stands on lines of the entity only. Terms
that stand with an entity on ``SUPPORT`` distinct lines or more and disclose at least ``GENERALISE`` of it are replaced by
a general word, at ``REMOVE`` and beyond they are removed, wherever they stand. Lines that copies share count once.

Everything is built-in functions: a split by a pattern gives the gaps between its matches, and so their places. The patterns
are possessive and don't start inside a run whose beginning failed, so that long runs are matched in linear time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from guestbook.llm.common import scratch, text_key

KINDS = ("email", "ip", "card", "phone")
_LOCAL = r"A-Za-z0-9._%+-"
#: Same matches as the plain patterns; ``\G`` lets a run begin where the last match ended.
PATTERNS = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_BYTE = r"(?:0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9][0-9]?)|0++)"
TERM = r"[\p{L}\p{N}]++"
#: Shorter terms carry too little to reveal anything.
SHORTEST = 3
SUPPORT = 3
GENERALISE = 0.85
REMOVE = 0.95
#: What spans are replaced by in sanitised text.
SHOWN = {**{k: f"[{k.upper()}]" for k in KINDS}, "general": "[TERM]", "removed": ""}
_ORDER = {k: i for i, k in enumerate([*KINDS, "general", "removed"])}
_SPANS = "array<struct<start:int,rank:int,kind:string,stop:int>>"


def _sql_text(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _luhn(digits: str) -> str:
    """SQL: the check sum of a string of digits is a multiple of ten."""
    doubled = "if(d > 4, 2 * d - 9, 2 * d)"
    return f"""aggregate(transform(split(reverse({digits}), ''), (c, i) -> transform(array(cast(c as int)),
        d -> if(i % 2 = 1, {doubled}, d))[0]), 0, (s, d) -> s + d) % 10 = 0"""


def _valid(kind: str, match: str) -> str:
    digits = f"regexp_replace({match}, '[^0-9]', '')"
    if kind == "ip":
        return f"{match} rlike {_sql_text(f'^{_BYTE}(?:[.]{_BYTE}){{3}}$')}"
    if kind == "card":
        return f"if(length({digits}) between 12 and 19, {_luhn(digits)}, false)"
    if kind == "phone":
        return f"length({digits}) between 9 and 15"
    return "true"


def _places(text: str, pattern: str, keep: str, made: str, kind: str) -> str:
    """SQL: ``made`` of the matches ``m`` from ``start`` to ``stop`` of a pattern for which ``keep`` holds."""
    found = f"regexp_extract_all({text}, {_sql_text(pattern)}, 0)"
    return f"""aggregate(
        zip_with({found}, split({text}, {_sql_text(pattern)}, -1),
                 (m, gap) -> if(m is null, null, named_struct('m', m, 'gap', length(gap), 'size', length(m)))),
        named_struct('at', 0, 'out', cast(array() as {kind})),
        (a, x) -> if(x is null, a, named_struct('at', a.at + x.gap + x.size, 'out',
            if(transform(array(x.m), m -> {keep})[0],
               concat(a.out, transform(array(named_struct('m', x.m, 'start', a.at + x.gap, 'stop', a.at + x.gap + x.size)),
                                       v -> {made})), a.out))),
        a -> a.out)"""


def _found(kind: str, text: str) -> str:
    made = f"named_struct('start', v.start, 'rank', {_ORDER[kind]}, 'kind', '{kind}', 'stop', v.stop)"
    here = {"email": f"contains({text}, '@')", "phone": f"contains({text}, '+')"}.get(kind, f"{text} rlike '[0-9]'")
    return f"if({here}, {_places(text, PATTERNS[kind], _valid(kind, 'm'), made, _SPANS)}, cast(array() as {_SPANS}))"


def base_spans(text: str = "coalesce(text, '')") -> Column:
    """Spans of entities in the order of their kinds; places count code points, the stop is exclusive."""
    return F.expr("concat(" + ", ".join(_found(k, text) for k in KINDS) + ")")


def _lines(docs: DataFrame) -> DataFrame:
    return docs.select(text_key(F.col("text")).alias("key"), F.explode(F.split("text", "\n")).alias("line"))


def _terms(line: str) -> str:
    return f"array_distinct(filter(transform(regexp_extract_all({line}, {_sql_text(TERM)}, 0), t -> lower(t)), t -> length(t) >= {SHORTEST}))"


def disclosures(docs: DataFrame) -> DataFrame:
    """``term, disclosure``: how much of an entity's information a term discloses at most, for terms with support
    that may disclose enough to be generalised."""
    # No entity goes beyond its line.
    suspects = _lines(docs).where("line rlike '[0-9@]'").select("line").distinct()
    marked = suspects.withColumn("spans", base_spans("line")).where("size(spans) > 0")
    masked = "aggregate(spans, line, (t, s) -> overlay(t placing repeat(' ', s.stop - s.start) from s.start + 1 for s.stop - s.start))"
    facts = scratch(
        marked.select(
            F.unhex(F.md5("line")).alias("line"),
            F.expr("array_distinct(transform(spans, s -> concat(s.kind, ':', substring(line, s.start + 1, s.stop - s.start))))").alias(
                "entities"
            ),
            F.expr(_terms(masked)).alias("terms"),
        ),
        "entity-lines",
    )
    # Neither an entity nor a term of fewer than SUPPORT lines can stand with another on so many: they make no pairs.
    of_line = facts.select("line", F.explode("entities").alias("entity"))
    entities = of_line.groupBy("entity").agg(F.count("*").alias("n_entity")).where(F.col("n_entity") >= SUPPORT)
    entities = scratch(entities, "entities")
    terms = facts.select("line", F.explode("terms").alias("term"))
    # The lines of entities alone show of most terms, all common ones among them, that they disclose too little.
    seen = scratch(terms.groupBy("term").agg(F.count("*").alias("n_seen")).where(F.col("n_seen") >= SUPPORT), "seen-terms")
    together = (
        of_line.join(entities.select("entity"), "entity", "left_semi")
        .join(terms.join(seen.select("term"), "term", "left_semi"), "line")
        .groupBy("entity", "term")
        .agg(F.count("*").alias("n_both"))
        .where(F.col("n_both") >= SUPPORT)
    )
    lines = docs.select(F.explode(F.split("text", "\n")).alias("line"))
    n_lines = lines.agg(F.approx_count_distinct("line", 0.01)).first()[0]
    information = F.log2(F.greatest(F.lit(n_lines), F.col("n_entity") + 1) / F.col("n_entity"))

    def share(n_term: str) -> Column:
        """Mutual information of term and entity against the entity's own."""
        return 1 + F.log2(F.least(F.lit(1.0), F.col("n_both") / F.col(n_term))) / information

    together = scratch(
        together.join(entities, "entity").join(seen, "term").where(share("n_seen") >= GENERALISE), "together"
    )
    wanted = together.select("term").distinct()
    counted = (
        lines.select(F.xxhash64("line").alias("line"), F.explode(F.expr(_terms("line"))).alias("term"))
        .join(wanted, "term", "left_semi")
        .distinct()
        .groupBy("term")
        .agg(F.count("*").alias("n_term"))
    )
    return together.join(counted, "term").groupBy("term").agg(F.max(share("n_term")).alias("disclosure"))


def _revealing(docs: DataFrame) -> DataFrame:
    """``key, general, removed``: the disclosing terms of each text that has any."""
    terms = scratch(disclosures(docs).where(F.col("disclosure") >= GENERALISE), "disclosures")
    return (
        _lines(docs)
        .select("key", F.explode(F.expr(_terms("line"))).alias("term"))
        .join(terms, "term")
        .groupBy("key")
        .agg(
            F.collect_set(F.when(F.col("disclosure") < REMOVE, F.col("term"))).alias("general"),
            F.collect_set(F.when(F.col("disclosure") >= REMOVE, F.col("term"))).alias("removed"),
        )
    )


def _with_spans(docs: DataFrame) -> DataFrame:
    """``__row``, the columns of ``docs``, and ``__base`` and ``__spans``, both sorted."""
    found = scratch(_revealing(docs), "revealing").select(F.col("key").alias("__key"), "general", "removed")
    found = found.select("__key", F.struct("general", "removed").alias("__terms"))
    kind = "if(array_contains(__terms.removed, lower(v.m)), 'removed', 'general')"
    made = f"named_struct('start', v.start, 'rank', if({kind} = 'removed', {_ORDER['removed']}, {_ORDER['general']}), 'kind', {kind}, 'stop', v.stop)"
    keep = "array_contains(__terms.removed, lower(m)) or array_contains(__terms.general, lower(m))"
    places = _places("coalesce(__row.text, '')", TERM, keep, made, _SPANS)
    free = "filter(__found, t -> not exists(__base, b -> t.start < b.stop and b.start < t.stop))"
    return (
        docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("__row"))
        .join(found, text_key(F.col("__row.text")) == F.col("__key"), "left")
        .withColumn("__base", F.array_sort(base_spans("coalesce(__row.text, '')")))
        .withColumn("__found", F.expr(f"if(__terms is null, cast(array() as {_SPANS}), {places})"))
        .withColumn("__spans", F.array_sort(F.concat("__base", F.expr(free))))
        .drop("__key", "__terms", "__found")
    )


def listed(spans: str) -> Column:
    return F.expr(f"array_join(transform({spans}, s -> concat(s.kind, ':', s.start, ':', s.stop)), ',')")


def personal_data(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """``id, base, spans`` of every document: spans ``(start, rank, kind, stop)``, entities alone and with revealing terms.

    Null and empty texts have none. Rows that repeat have the same spans; an empty table gives no rows.
    """
    rows = docs.select(F.col(id_column).alias("id"), "text")
    return _with_spans(rows).select("__row.id", F.col("__base").alias("base"), F.col("__spans").alias("spans"))


def sanitised(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by what stands for its kind; of overlapping spans the first counts.

    Further columns stay as they are, whatever their names.
    """
    shown = "element_at(map(" + ", ".join(f"'{k}', '{v}'" for k, v in SHOWN.items()) + "), s.kind)"
    text = f"""aggregate(__spans, named_struct('at', 0, 'out', ''),
        (a, s) -> if(s.start < a.at, a, named_struct('at', s.stop, 'out',
            concat(a.out, substring(__row.text, a.at + 1, s.start - a.at), {shown}))),
        a -> concat(a.out, substring(__row.text, a.at + 1)))"""
    clean = F.when(F.size("__spans") > 0, F.expr(text)).otherwise(F.col("__row.text"))
    columns = [(clean if c == "text" else F.col(f"__row.`{c}`")).alias(c) for c in docs.columns]
    return _with_spans(docs).select(*columns)
