"""Secrets in texts: what rules show to be credentials, and what is written in the form of one.

Three rules find credentials where they are named, or begin, or look, as such (``KINDS``). What they find labels strings of the corpus: a
credential of its kind, or plain, as all other runs of credential characters are. For each label an automaton
is inferred from the forms of at most ``SAMPLE`` different strings, those of least hash (``grammars``): their prefixes are counted by a
grouping, and the states of the prefix tree, whose size the sample bounds, are merged on the driver.

Then every run of ``SHORTEST`` characters or more that touches no rule's span is a candidate. Its score is how many bits its form is likelier
under a kind's automaton than under that of plain runs; from ``BITS`` on it is a secret of the kind ``format``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from guestbook.llm.common import rows_of
from guestbook.llm.grammars import ALPHABET, Automaton, form, merged, prefix_tree

KINDS = ("assign", "access", "hex")
FORMAT, PLAIN = "format", "plain"
_ANY_CASE = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile("AKIA[A-Z0-9]+")
_HEX = re.compile("(?<![0-9a-f])[0-9a-f]{32,}")
LEAST_VALUE = 8
LEAST_ACCESS = 16
_RUNS = re.compile("[A-Za-z0-9+/_.=-]{8,}")
SHORTEST = 8
#: Different strings of a label that are learned from, and the longest that may be. All lengths are scored.
SAMPLE = 2000
LONGEST = 128
#: Fewer different strings of a kind show no format.
LEAST_STRINGS = 20
BITS = 20.0
#: Verdicts on strings a task keeps at once.
_KEPT = 200_000

Span = tuple[int, int, str, int]


def base_spans(text: str) -> list[tuple[Span, str]]:
    """Spans ``(start, rank, kind, stop)`` of the rules, sorted, each with the credential in it. Places count code points."""
    found = []
    low = text.lower()
    if any(name in low for name in _NAMES):
        for m in _ANY_CASE.finditer(text):
            if len(m[1]) >= LEAST_VALUE:
                found.append(((m.start(), 0, "assign", m.end()), m[1]))
    if "AKIA" in text:
        found += [((m.start(), 1, "access", m.end()), m[0]) for m in _ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    found += [((m.start(), 2, "hex", m.end()), m[0]) for m in _HEX.finditer(text)]
    return sorted(found)


def _free(start: int, stop: int, spans: list[Span]) -> bool:
    return all(stop <= s[0] or s[3] <= start for s in spans)


def _least(values: set[str]) -> list[tuple[int, str]]:
    return sorted((xxhash.xxh64_intdigest(v.encode()) >> 1, v) for v in values)[:SAMPLE]


def _labelled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The strings of least hash of each label in the texts of a task."""
    held: dict[str, set[str]] = {label: set() for label in (*KINDS, PLAIN)}
    for (text,) in rows_of(batches, "text"):
        if not text:
            continue
        base = base_spans(text)
        for span, value in base:
            held[span[2]].add(value)
        if base:
            spans = [s for s, _ in base]
            held[PLAIN].update(m[0] for m in _RUNS.finditer(text) if _free(m.start(), m.end(), spans))
        else:
            held[PLAIN].update(_RUNS.findall(text))
        for values in held.values():
            if len(values) > 16 * SAMPLE:
                kept = {v for _, v in _least({v for v in values if len(v) <= LONGEST})}
                values.intersection_update(kept)
    for label, values in held.items():
        rows = _least({v for v in values if len(v) <= LONGEST})
        yield pd.DataFrame([(label, h, v) for h, v in rows], columns=["label", "hash", "value"], dtype=object)


def strings(docs: DataFrame) -> DataFrame:
    """``label, value``: at most ``SAMPLE`` different strings of each label, those of least hash in the whole corpus."""
    some = docs.select("text").mapInPandas(_labelled, "label string, hash long, value string").distinct()
    least = Window.partitionBy("label").orderBy("hash", "value")
    return some.withColumn("rank", F.row_number().over(least)).where(F.col("rank") <= SAMPLE).select("label", "value")


def learned(labelled: DataFrame) -> dict[str, Automaton]:
    """The automaton of each label of ``labelled`` (``label, value``) with enough different strings.

    A grouping counts the prefixes of all forms; the driver gets a row for each, ``SAMPLE * (LONGEST + 1)`` a label at most
    from ``strings``, and far fewer where forms agree.
    """
    forms = labelled.select("label", "value").distinct().select("label", F.udf(form)("value").alias("form"))
    lengths = F.sequence(F.lit(0), F.length("form"))
    prefixes = forms.select("label", "form", F.explode(lengths).alias("n")).groupBy(
        "label", F.substring("form", F.lit(1), F.col("n")).alias("prefix")
    )
    counts = prefixes.agg(F.count("*").alias("met"), F.sum((F.col("n") == F.length("form")).cast("int")).alias("ends"))
    trees: dict[str, list[tuple[str, int, int]]] = {}
    for label, prefix, met, ends in counts.collect():
        trees.setdefault(label, []).append((prefix, met, ends))
    enough = {k: t for k, t in trees.items() if k == PLAIN or max(met for _, met, _ in t) >= LEAST_STRINGS}
    return {label: merged(prefix_tree(tree)) for label, tree in sorted(enough.items())}


def likelier(value: str, automata: dict[str, Automaton]) -> float:
    """How many bits likelier the form of ``value`` is as a credential, of the kind that fits it best, than as a plain run, and than
    if all symbols were alike, so that a form that no automaton knows is none of a credential."""
    symbols = form(value)
    other = -(len(symbols) + 1) * math.log2(ALPHABET)
    if PLAIN in automata:
        other = max(other, automata[PLAIN].bits(symbols))
    return max((a.bits(symbols) - other for k, a in automata.items() if k != PLAIN), default=float("-inf"))


def finder(automata: dict[str, Automaton]) -> Callable[[str | None], list[Span]]:
    """All spans of a text, sorted: those of the rules and those of a credential's form."""
    verdicts: dict[str, bool] = {}

    def secret(value: str) -> bool:
        if value not in verdicts:
            if len(verdicts) >= _KEPT:
                verdicts.clear()
            verdicts[value] = likelier(value, automata) >= BITS
        return verdicts[value]

    def found(text: str | None) -> list[Span]:
        if not text:
            return []
        base = [s for s, _ in base_spans(text)]
        if len(automata) < 2 or not any(map(secret, set(_RUNS.findall(text)))):
            return base
        more = [(m.start(), 3, FORMAT, m.end()) for m in _RUNS.finditer(text) if secret(m[0]) and _free(m.start(), m.end(), base)]
        return sorted(base + more)

    return found


_SPANS = "array<struct<start:int,rank:int,kind:string,stop:int>>"


def spans(automata: dict[str, Automaton], text: Column) -> Column:
    @F.pandas_udf(_SPANS)
    def found(texts: pd.Series) -> pd.Series:
        look = finder(automata)
        return pd.Series([[dict(zip(("start", "rank", "kind", "stop"), s, strict=True)) for s in look(t)] for t in texts], dtype=object)

    return found(text)


def listed(spans: str) -> Column:
    return F.expr(f"array_join(transform({spans}, s -> concat(s.kind, ':', s.start, ':', s.stop)), ',')")


def secrets(docs: DataFrame, id_column: str = "doc_id", automata: dict[str, Automaton] | None = None) -> DataFrame:
    """``id, base, spans`` of every document: spans ``(start, rank, kind, stop)`` of the rules alone, and with those of a credential's form.

    Null and empty texts have none; very long texts are searched whole. Rows that repeat have the same spans; extra columns are
    ignored; an empty table gives no rows. Without ``automata`` they are learned from ``docs``.
    """
    known = learned(strings(docs)) if automata is None else automata
    rows = docs.select(F.col(id_column).alias("id"), spans(known, F.col("text")).alias("spans"))
    return rows.select("id", F.expr(f"filter(spans, s -> s.kind <> '{FORMAT}')").alias("base"), "spans")


def redacted(docs: DataFrame, automata: dict[str, Automaton] | None = None, shown: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span replaced; of overlapping spans the first counts, and what sticks out behind it goes with it."""
    known = learned(strings(docs)) if automata is None else automata

    @F.pandas_udf("string")
    def cleaned(texts: pd.Series) -> pd.Series:
        look, out = finder(known), []
        for text in texts:
            at, parts = 0, []
            for start, _, _, stop in look(text):
                if start >= at:
                    parts += [text[at:start], shown]
                at = max(at, stop)
            out.append(text if not parts else "".join(parts) + text[at:])
        return pd.Series(out, dtype=object)

    return docs.select(*(cleaned("text").alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns))
