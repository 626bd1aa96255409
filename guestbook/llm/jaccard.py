"""Similarity join on five-word shingles by T-occurrence search.

Two sets are linked if they share enough, so a linked set must occur often enough in the inverted lists of
a set's shingles. The lists are those of the shingles of least hash, of each set so many that linked sets have some of them
in common: of all shingles they share, no more can come later in the order of hashes than one of the two has left. In the way of
DivideSkip, short lists (up to ``SHORT`` sets) are merged, that is, joined with themselves and counted by pair, and long ones
are set aside: a pair stays if it could reach what it must have in common when it is taken to occur in all the long ones.
What stays is probed by binary search in the whole sorted sets, which decides.

Sets of which many lists are long are merged a second time, among themselves and by the lists of all their
shingles: if fewer of these are long than a linked set must share, that one occurs in a short one. Sets beyond that
(large families of near copies) gather in stars: each is probed against the set in its lists whose own lists are
longest on average, as those of the text are that all copies come from; then the others, without those that
found one. Within a star all are linked through its centre, so no further pair is needed there. What the triangle
inequality of the Jaccard distance leaves about a star is compared by the shingles in which a set departs from the
centre, of which linked sets share many, and only pairs that share one of their rarest are probed. Sets about no star
are compared by the rarest of all their shingles.

Equal sets are one node, so copies never meet as pairs. Nothing is sampled: every set is looked up by as many lists as
a link needs, and nothing but the shingles' 64-bit hashes stands for the shingles.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from guestbook.llm.common import SPACE, gram_hashes, rows_of, scratch, signed, text_key, unused, word_hashes
from guestbook.llm.components import components

SHINGLE = 5
#: Linked: 100 * shared >= PERCENT * union.
PERCENT = 75
SHORT = 40
#: Linked sets have more than this share of the lists they are looked up by in common, and a set is merged a second time if more
#: of its lists are long. The number of lists follows: a quarter of a set for 0, 5/18 of it for 0.1.
LONG_SHARE = 0.08
#: Lists that a caller may ask for instead: none, as all that a link needs are looked up.
SAMPLE = None
#: Rounds of stars; sets without one afterwards are centres themselves.
ROUNDS = 3
#: Sizes of sets up to this many times each other are of one band.
BAND = 1.05
WORD = re.compile(rb"[^" + SPACE.encode() + rb"]+")


def shingles(text: str | None) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a text; of its whole sequence if it has fewer words."""
    words = WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(gram_hashes(word_hashes(words), min(SHINGLE, len(words))))


def _left() -> int:
    """Thousandths of a set that aren't looked up."""
    share = PERCENT / 100
    return int(1000 * (share - LONG_SHARE) / (1 - LONG_SHARE))


def _beyond(n: str) -> str:
    """SQL: how many shingles of a set of ``n`` aren't looked up."""
    return f"(({_left()} * {n} + 999) div 1000 - 1)"


def _marked(left: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def marked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text in batch["text"]:
                found = shingles(text)
                n = len(found)
                first = found[: n + 1 - (left * n + 999) // 1000]
                out.append((xxhash.xxh3_64_intdigest(found.tobytes()) - 2**63, n, signed(first)))
            marks = pd.DataFrame(out, columns=["sid", "n", "first"])
            yield pd.concat([batch[["id", "key"]].reset_index(drop=True), marks], axis=1)

    return marked


def marks(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """``id, key, sid, n, first``: the set of every document (``sid``), its size, and the lists it is looked up by."""
    ids = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("id"), text_key(F.col("text")).alias("key"), "text")
    return rows.mapInPandas(_marked(_left()), f"id {ids}, key binary, sid long, n long, first array<long>")


def _probed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        sets: dict[int, np.ndarray] = {}
        out = []
        for a, b, text_a, text_b in rows_of([batch], "a", "b", "text_a", "text_b"):
            for sid, text in ((a, text_a), (b, text_b)):
                if sid not in sets:
                    sets[sid] = shingles(text)
            x, y = sorted((sets[a], sets[b]), key=len)
            places = np.searchsorted(y, x)
            shared = int((y[np.minimum(places, len(y) - 1)] == x).sum())
            union = len(x) + len(y) - shared
            out.append((a, b, 100 * shared >= PERCENT * union, 1 - shared / union))
        yield pd.DataFrame(out, columns=["a", "b", "linked", "distance"])


def probed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``a, b, linked, distance`` of pairs of sets, each from a text that has the set."""
    return (
        pairs.join(texts.select(F.col("sid").alias("a"), F.col("text").alias("text_a")), "a")
        .join(texts.select(F.col("sid").alias("b"), F.col("text").alias("text_b")), "b")
        .mapInPandas(_probed, "a long, b long, linked boolean, distance double")
    )


def _alike(n: str, m: str) -> str:
    """SQL: sizes that a linked pair can have."""
    return f"100 * least({n}, {m}) >= {PERCENT} * greatest({n}, {m})"


def _must(n: str, m: str) -> str:
    """SQL: how many shingles linked sets of these sizes share at least."""
    return f"(({PERCENT} * ({n} + {m}) + {99 + PERCENT}) div {100 + PERCENT})"


def _merged(lists: DataFrame) -> DataFrame:
    """Pairs ``(a, b)`` that occur often enough in the short lists.

    Of what two sets share, all up to the last list of one of them is in lists of both; beyond it that one has no more than is not
    looked up. The rest must be seen.
    """
    short = lists.where(F.col("held") <= SHORT).select("token", "sid", "n", "long")
    left = short.select("token", *(F.col(c).alias(f"{c}_a") for c in ("sid", "n", "long")))
    right = short.select("token", *(F.col(c).alias(f"{c}_b") for c in ("sid", "n", "long")))
    return (
        left.join(right, "token")
        .where(f"sid_a < sid_b and {_alike('n_a', 'n_b')}")
        .groupBy(F.col("sid_a").alias("a"), F.col("sid_b").alias("b"))
        .agg(
            F.count("*").alias("c"),
            F.first(F.expr(f"{_must('n_a', 'n_b')} - {_beyond('greatest(n_a, n_b)')}")).alias("least"),
            F.first(F.least("long_a", "long_b")).alias("long"),
        )
        .where("c + long >= least")
        .select("a", "b")
    )


def _all_lists(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for sid, text in rows_of(batches, "sid", "text"):
        found = shingles(text)
        yield pd.DataFrame({"sid": sid, "n": len(found), "token": signed(found)})


def _shared_lists(texts: DataFrame) -> DataFrame:
    """``sid, n, token, held``: all shingles of the sets that another one has too, and how many have them."""
    every = scratch(texts.mapInPandas(_all_lists, "sid long, n long, token long"), "all-lists")
    held = every.groupBy("token").agg(F.count("*").alias("held")).where("held > 1")
    return scratch(every.join(held, "token"), "shared-lists")


def _merged_whole(lists: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of sets with many long lists, the pairs that occur often enough in short ones, by the lists of all their
    shingles; and the sets that may be linked through long lists alone."""
    long = lists.where(F.col("held") > SHORT).groupBy("sid").agg(F.count("*").alias("long"))
    short = lists.where(F.col("held") <= SHORT).join(long, "sid", "left").fillna(0, ["long"])
    left = short.select("token", *(F.col(c).alias(f"{c}_a") for c in ("sid", "n", "long")))
    right = short.select("token", *(F.col(c).alias(f"{c}_b") for c in ("sid", "n", "long")))
    pairs = (
        left.join(right, "token")
        .where(f"sid_a < sid_b and {_alike('n_a', 'n_b')}")
        .groupBy(F.col("sid_a").alias("a"), F.col("sid_b").alias("b"))
        .agg(
            F.count("*").alias("c"),
            F.first(F.least("long_a", "long_b")).alias("long"),
            F.first(F.col("n_a") + F.col("n_b")).alias("n"),
        )
        .where(F.col("c") + F.col("long") >= F.col("n") * (PERCENT / (100 + PERCENT)) - 1e-6)
        .select("a", "b")
    )
    sizes = lists.groupBy("sid").agg(F.first("n").alias("n"))
    crowded = sizes.join(long, "sid").where(f"100 * long >= {PERCENT} * n").select("sid")
    return scratch(pairs, "pairs-whole"), scratch(crowded, "crowded")


def _across(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs that aren't in one component yet."""
    a = roots.select(F.col("node").alias("a"), F.col("root").alias("root_a"))
    b = roots.select(F.col("node").alias("b"), F.col("root").alias("root_b"))
    return (
        pairs.join(a, "a", "left")
        .join(b, "b", "left")
        .where("not coalesce(root_a, a) <=> coalesce(root_b, b)")
        .select(*pairs.columns)
    )


def _stars(lists: DataFrame, texts: DataFrame) -> DataFrame:
    """``sid, centre, distance``: the sets of ``lists`` gathered around centres they are linked with."""
    free = scratch(lists.select("token", "sid", "weight"), "free")
    found = None
    for left in reversed(range(ROUNDS)):
        if free.isEmpty():
            break
        if left:
            heaviest = free.groupBy("token").agg(F.max(F.struct("weight", "sid")).alias("centre"))
            chosen = (
                free.select("token", "sid")
                .join(heaviest, "token")
                .groupBy("sid", "centre")
                .agg(F.count("*").alias("c"))
                .groupBy("sid")
                .agg(F.max(F.struct("c", "centre")).alias("best"))
                .select("sid", F.col("best.centre.sid").alias("centre"))
            )
        else:
            chosen = free.select("sid", F.col("sid").alias("centre")).distinct()
        chosen = scratch(chosen, "chosen")
        pairs = chosen.where("sid <> centre").select(F.col("sid").alias("a"), F.col("centre").alias("b"))
        joined = probed(pairs, texts).where("linked").select(F.col("a").alias("sid"), F.col("b").alias("centre"), "distance")
        centres = chosen.select(F.col("centre").alias("sid")).distinct()
        own = centres.select("sid", F.col("sid").alias("centre"), F.lit(0.0).alias("distance"))
        now = scratch(joined.unionByName(own), "star")
        found = now if found is None else found.unionByName(now)
        free = scratch(free.join(now.select("sid").distinct(), "sid", "left_anti"), "free")
    return found


def _departures(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The shingles in which a set differs from its hub's."""
    for batch in batches:
        hubs: dict[int, np.ndarray] = {}
        out = []
        for hub, sid, hub_text, text in rows_of([batch], "hub", "sid", "hub_text", "text"):
            if hub not in hubs:
                hubs[hub] = shingles(hub_text)
            own = shingles(text)
            out.append((hub, sid, len(own), len(hubs[hub]), signed(np.setxor1d(own, hubs[hub], assume_unique=True))))
        yield pd.DataFrame(out, columns=["hub", "sid", "n", "n_hub", "away"])


def _around_hubs(near: DataFrame, texts: DataFrame, links: DataFrame) -> DataFrame:
    """Links among the sets ``(hub, sid)`` that lie about a hub.

    Two sets differ in as many shingles as they depart from the hub in, less twice those in which they depart alike. Those
    that aren't linked with the hub depart far, so a linked pair departs alike in many, and so in one of each set's
    rarest departures: all but as many as must be common, less one.
    """
    rows = (
        near.join(texts.select("sid", "text"), "sid")
        .join(texts.select(F.col("sid").alias("hub"), F.col("text").alias("hub_text")), "hub")
        .mapInPandas(_departures, "hub long, sid long, n long, n_hub long, away array<long>")
    )
    rows = scratch(rows.withColumn("d", F.size("away")), "departures")
    at_hub = rows.where(f"{100 - PERCENT} * (n + n_hub) >= {100 + PERCENT} * d and sid <> hub")
    links = scratch(links.unionByName(at_hub.select(F.col("sid").alias("a"), F.col("hub").alias("b"))), "links")
    f = (100 - PERCENT) / (100 + PERCENT)
    linked = F.expr(f"{100 - PERCENT} * (n + n_hub) >= {100 + PERCENT} * d")
    least = F.ceil((F.col("d") - f * F.col("n") + F.when(linked, f).otherwise(-f) * F.col("n_hub")) / 2 - 1e-9)
    each = rows.select(
        "hub",
        "sid",
        "n",
        "d",
        linked.alias("linked"),
        (F.col("d") - F.greatest(F.lit(1), least) + 1).alias("prefix"),
        F.explode("away").alias("token"),
    )
    common = each.groupBy("hub", "token").agg(F.count("*").alias("held"))
    rarest = Window.partitionBy("hub", "sid").orderBy("held", "token")  # a set's shingles at most
    first = scratch(
        each.join(common, ["hub", "token"])
        .withColumn("rank", F.row_number().over(rarest))
        .where("rank <= prefix and held > 1")
        .select("hub", "token", "sid", "n", "d", "linked", "rank"),
        "rarest",
    )
    left, right = (first.select("hub", "token", *(F.col(c).alias(f"{c}_{x}") for c in ("sid", "n", "d", "linked", "rank"))) for x in "ab")
    # How many departures the two must have in common, and how far in order one of them must come by then.
    must = f"greatest(1, ceil((d_a + d_b - {f} * (n_a + n_b)) / 2 - 1e-9))"
    soon = f"rank_a <= d_a - {must} + 1 and rank_b <= d_b - {must} + 1"
    pairs = left.join(right, ["hub", "token"]).where(
        f"sid_a < sid_b and not (linked_a and linked_b) and {_alike('n_a', 'n_b')} and {soon}"
    )
    pairs = pairs.select(F.col("sid_a").alias("a"), F.col("sid_b").alias("b"))
    rest = scratch(_across(pairs.distinct(), components(links)), "rest")
    return links.unionByName(probed(rest, texts).where("linked").select("a", "b"))


def _rarest(lists: DataFrame) -> DataFrame:
    """``sid, n, token, rank``: of sets given by their shared shingles (``sid, n, token, held``) those that come early by rarity.

    Shingles a set has alone come before all others. What is kept is all but as many, less one, as any linked set must share.
    """
    order = Window.partitionBy("sid").orderBy("held", "token")  # a set's shingles at most
    own = F.col("n") - F.count("*").over(Window.partitionBy("sid"))
    ranked = lists.select("sid", "n", "token", (F.row_number().over(order) + own).alias("rank"))
    return ranked.where(f"rank <= n - ceil({PERCENT / 100} * n - 1e-6) + 1")


def _by_rarest(rarest: DataFrame) -> DataFrame:
    """Pairs ``(a, b)`` of sets that share one of their rarest shingles, all pairs that are linked among them.

    Of two linked sets so many shingles are shared that in any order one of them comes early in both: by the time all but
    as many, less one, have passed. In the order of rarity these are the shingles that a set has almost alone; what a
    large family has in common comes late in all its sets, unless they differ so little that they are linked with one centre. How many must
    be shared depends on both sizes, so sets meet by ``(shingle, size band, size band)`` and pass no more shingles than that band asks.
    """

    def band(n: str) -> str:
        return f"floor(log({n}) / log({BAND}))"

    share = PERCENT / (100 + PERCENT)
    # The size of the largest partner that still asks for a shingle of this rank.
    largest = f"least(n * {100 / PERCENT}, (n + 1 - rank) / {share} - n) * (1 + 1e-6)"
    bands = f"sequence({band(f'n * {PERCENT / 100} * (1 - 1e-6)')}, {band(largest)})"
    met = (
        rarest.where(f"{band(largest)} >= {band(f'n * {PERCENT / 100} * (1 - 1e-6)')}")
        .withColumn("band", F.expr(band("n * (1 + 1e-9)")))
        .select("token", "sid", "n", "rank", "band", F.explode(F.expr(bands)).alias("other"))
    )
    met = scratch(met, "rarest-shingles")
    left = met.select("token", "band", "other", *(F.col(c).alias(f"{c}_a") for c in ("sid", "n", "rank")))
    right = met.select(
        "token", F.col("other").alias("band"), F.col("band").alias("other"), *(F.col(c).alias(f"{c}_b") for c in ("sid", "n", "rank"))
    )
    must = f"ceil({share} * (n_a + n_b) - 1e-6)"
    soon = f"rank_a <= n_a - {must} + 1 and rank_b <= n_b - {must} + 1"
    pairs = left.join(right, ["token", "band", "other"]).where(f"sid_a < sid_b and {_alike('n_a', 'n_b')} and {soon}")
    return pairs.select(F.col("sid_a").alias("a"), F.col("sid_b").alias("b")).distinct()


def _between(stars: DataFrame, whole: DataFrame, rarest: DataFrame, texts: DataFrame, links: DataFrame) -> DataFrame:
    """Links between members of different stars. ``whole`` are all shared shingles of the sets."""
    reach = scratch(stars.groupBy("centre").agg(F.max("distance").alias("reach")), "reach")
    held = whole.join(reach.withColumnRenamed("centre", "sid"), "sid").select("token", "sid", "reach")
    held = scratch(held, "centre-lists")
    limit = 1 - PERCENT / 100 + 1e-9
    hubs = held.where("reach > 0").select("token", F.col("sid").alias("a"), F.col("reach").alias("reach_a"))
    others = held.select("token", F.col("sid").alias("b"), F.col("reach").alias("reach_b"))
    meet = hubs.join(others, "token").where("a <> b and (reach_b = 0 or a < b)")
    meet = scratch(meet.select("a", "b", "reach_a", "reach_b").distinct(), "meet")
    measured = probed(meet.select("a", "b"), texts).join(meet, ["a", "b"])
    # A link from about a hub leads to within one limit more.
    measured = scratch(measured.withColumn("beyond", F.expr(f"distance - reach_a - reach_b - {limit}")), "measured")
    close = measured.where(F.col("beyond") <= limit)
    members = stars.select(F.col("centre").alias("hub"), "sid").join(reach.where("reach > 0"), F.col("hub") == F.col("centre"))
    joined = close.select(F.col("a").alias("hub"), F.col("b").alias("centre")).join(stars, "centre").select("hub", "sid")
    near = scratch(members.select("hub", "sid").union(joined).distinct(), "near-hubs")
    links = scratch(_around_hubs(near, texts, links), "links")

    # Centres alone and about no hub are compared with each other.
    about = measured.where(F.col("beyond") <= 0).select(F.col("b").alias("sid")).distinct()
    alone = held.where("reach = 0").select("sid").distinct().join(about, "sid", "left_anti")
    pairs = _by_rarest(rarest.join(alone, "sid", "left_semi"))
    rest = scratch(_across(pairs, components(links)), "rest")
    return links.unionByName(probed(rest, texts).where("linked").select("a", "b"))


def similar(docs: DataFrame, id_column: str = "doc_id", sample: None = SAMPLE) -> DataFrame:
    """``id, key, n, group, component`` of every document: its shingles, a number for those it is linked with, through
    others too, and the least id of these.

    Documents with equal sets are linked. Those without words (null and empty texts too) have no shingles and are linked
    with nothing: their component is their own id. Rows that repeat share a component; a null id never is a
    component's id unless all its documents lack one; an empty table gives no rows.

    All links are found; ``sample`` can only be None.
    """
    if sample is not None:
        raise ValueError("no sample of the lists finds all links")
    rows = scratch(marks(docs, id_column), "marks")
    postings = rows.select("sid", "n", F.explode("first").alias("token"))
    tokens = postings.groupBy("token").agg(F.count("*").alias("held")).where("held > 1").select("token")
    live = scratch(postings.join(tokens, "token", "left_semi").distinct(), "postings")
    held = live.groupBy("token").agg(F.count("*").alias("held")).where("held > 1")
    lists = live.join(held, "token")
    long = lists.groupBy("sid").agg(
        F.sum((F.col("held") > SHORT).cast("int")).alias("long"), (F.sum("held") / F.first("n")).alias("weight")
    )
    lists = scratch(lists.join(long, "sid"), "lists")
    pairs = scratch(_merged(lists), "pairs")
    gathered = lists.where((F.col("held") > SHORT) & F.expr(f"1000 * long > ({10 * PERCENT} - {_left()}) * n"))

    wanted = pairs.select(F.col("a").alias("sid")).union(pairs.select("b")).union(gathered.select("sid")).distinct()
    chosen = rows.join(wanted, "sid", "left_semi").groupBy("sid").agg(F.min("key").alias("key"))
    own_text = docs.select(text_key(F.col("text")).alias("key"), "text")
    texts = scratch(own_text.join(chosen, "key").select("sid", "text").dropDuplicates(["sid"]), "texts")

    whole = _shared_lists(texts.join(gathered.select("sid").distinct(), "sid", "left_semi"))
    again, crowded = _merged_whole(whole)
    pairs = scratch(pairs.unionByName(again).distinct(), "pairs")
    gathered = scratch(gathered.join(crowded, "sid", "left_semi"), "gathered")

    # First every set with the least one it is paired with, then the pairs that this leaves in different components.
    first = pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    links = scratch(probed(first, texts).where("linked").select("a", "b"), "links")
    rest = _across(pairs.join(first, ["a", "b"], "left_anti"), components(links))
    links = scratch(links.unionByName(probed(rest, texts).where("linked").select("a", "b")), "links")
    if not gathered.isEmpty():
        stars = scratch(_stars(gathered, texts), "stars")
        links = scratch(links.unionByName(stars.where("sid <> centre").select(F.col("sid").alias("a"), F.col("centre").alias("b"))), "links")
        links = scratch(_between(stars, whole, scratch(_rarest(whole), "rarest"), texts, links), "links")

    roots = components(links)
    group = F.when(F.col("n") > 0, F.coalesce("root", "sid"))
    nodes = rows.select("id", "key", "n", "sid").join(roots, rows["sid"] == roots["node"], "left").withColumn("group", group)
    least = nodes.where("n > 0").groupBy("group").agg(F.min("id").alias("least"))
    return (
        nodes.join(least, "group", "left")
        .select("id", "key", "n", "group", F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("id")).alias("component"))
    )


def representatives(docs: DataFrame) -> DataFrame:
    """One document of each group of linked ones, that of least id (of equal ids, of least key); columns unchanged.

    Documents without words all stay, as each is linked with nothing.
    """
    id_, key_ = unused(docs, "__id", "__key")
    rows = scratch(similar(docs).where("n > 0"), "similar")
    firsts = rows.where("id <=> component").groupBy("group").agg(F.min("key").alias("first"))
    losers = (
        rows.join(firsts, "group")
        .where(~(F.col("id").eqNullSafe(F.col("component")) & (F.col("key") == F.col("first"))))
        .select(F.col("id").alias(id_), F.col("key").alias(key_))
        .distinct()
    )
    key = text_key(docs["text"])
    kept = docs.join(losers, docs["doc_id"].eqNullSafe(F.col(id_)) & (key == F.col(key_)), "left_anti")
    # Rows of equal id and text are left, and of these any one may stay.
    repeated = scratch(
        rows.groupBy(F.col("id").alias(id_), F.col("key").alias(key_)).agg(F.count("*").alias("n")).where("n > 1"),
        "repeated",
    ).select(id_, key_)
    if repeated.isEmpty():
        return kept
    same = kept["doc_id"].eqNullSafe(F.col(id_)) & (text_key(kept["text"]) == F.col(key_))
    once = kept.join(repeated, same).dropDuplicates([id_, key_]).drop(id_, key_)
    return kept.join(repeated, same, "left_anti").unionByName(once)
