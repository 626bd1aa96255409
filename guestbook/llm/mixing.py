"""Mixing sources to target weights through a multivariate-hypergeometric splitting tree.

Every source's documents are cut into blocks by a hash, about ``BLOCK_ROWS`` rows each, whose order is a
random permutation. A source is passed over ``passes`` whole times and once more in part, up to the block
in which its target is reached, and of that block as many whole documents as fit; the quota of a source is the number of block
draws this takes. A binary tree then deals the quotas out to the shards: at each node the left child
gets half of the draws, of each source as many as a multivariate-hypergeometric draw says, and the right
child the rest. All quotas are thus used up exactly, and every shard holds the mixture in small. A shard takes
the next draws of each source in the permuted order, so shards never share one, and shuffles its documents.

All draws hash the seed and what they are for, hence reruns agree. Only blocks are summed and ranked
within a source, and only the last block of each source document by document.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from guestbook.llm.common import WORD, scratch, text_key, unused

WEIGHTS = (5, 2, 1)
#: Words of the mix against words of all documents, and of a source's target against its own.
SHARE = 1.5
MOST = 2
SHARDS = 16
SEED = 20
BLOCK_ROWS = 256


def sized(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """``__row``, the columns of ``docs``, the words of every document, and its place in the permutation of its source."""
    return docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("__row"),
        F.col(id_column).alias("__id"),
        text_key(F.col("text")).alias("__key"),
        F.col("source").cast("string").alias("__source"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("__size"),
    ).withColumn("__place", F.xxhash64(F.lit(SEED), "__source", "__id", "__key"))


_SIZED = ["__id", "__key", "__source", "__size", "__place"]


def targets(rows: DataFrame) -> DataFrame:
    """``source, n_docs, source_size, target``: weights by the order of the sources, capped and reshared.

    Resharing by weight until no target is above its cap ends where all others get ``level`` words a unit of
    weight; a source is capped if its cap per unit of weight is at most the level of those not below it.
    One row for each source: the windows without partitions are over these alone.
    """
    sources = rows.groupBy(F.col("__source").alias("source")).agg(
        F.count("*").alias("n_docs"), F.sum("__size").alias("source_size")
    )
    order = Window.orderBy(F.col("source").cast("binary").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.pmod(F.row_number().over(order) - 1, F.lit(len(WEIGHTS))) + 1).cast("int"))
    everything = Window.partitionBy()
    below = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    cap = MOST * F.col("source_size")
    left_words = SHARE * F.sum("source_size").over(everything) - F.coalesce(F.sum(cap).over(below), F.lit(0))
    left_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(below), F.lit(0))
    return (
        sources.withColumn("weight", weight.cast("double"))
        .withColumn("ratio", cap / F.col("weight"))
        # The level if all sources of a smaller ratio were capped, and no other, rises up to the first that isn't.
        .withColumn("level", left_words / left_weight)
        .withColumn("level", F.max("level").over(everything))
        .withColumn("target", F.least(cap.cast("double"), F.col("level") * F.col("weight")))
        .select("source", "n_docs", "source_size", "target")
    )


def _block(n_docs: Column, place: Column) -> Column:
    return F.pmod(place, F.ceil(n_docs / BLOCK_ROWS)).cast("int")


def _plan(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """``source, n_docs, source_size, target, n_blocks, passes, last_block, wanted``.

    ``wanted`` are the words still to take from the last block of the pass in part; blocks before it are
    taken whole in that pass.
    """
    named = F.col("__source").eqNullSafe(F.col("__of"))
    blocks = (
        rows.join(sources.select(F.col("source").alias("__of"), "n_docs"), named)
        .groupBy("__source", _block(F.col("n_docs"), F.col("__place")).alias("block"))
        .agg(F.sum("__size").alias("words"))
    )
    so_far = Window.partitionBy("__source").orderBy("block")
    passes = F.floor(F.round("target") / F.col("source_size"))
    rest = (F.round("target") - F.coalesce(passes, F.lit(0)) * F.col("source_size")).cast("long")
    goal = sources.select(
        F.col("source").alias("__of"),
        "n_docs",
        "source_size",
        "target",
        F.ceil(F.col("n_docs") / BLOCK_ROWS).cast("int").alias("n_blocks"),
        F.when(F.col("source_size") > 0, passes).otherwise(0).cast("int").alias("passes"),
        F.when(F.col("source_size") > 0, rest).otherwise(F.lit(0)).cast("long").alias("rest"),
    )
    last = (
        blocks.withColumn("upto", F.sum("words").over(so_far))
        .join(goal.select("__of", "rest"), named)
        .where(F.col("upto") >= F.col("rest"))
        .groupBy("__source")
        .agg(F.min(F.struct("block", (F.col("rest") - F.col("upto") + F.col("words")).alias("wanted"))).alias("end"))
    )
    ended = F.col("rest") > 0
    return goal.join(last, named, "left").select(
        "__of",
        "n_docs",
        "source_size",
        "target",
        "n_blocks",
        "passes",
        F.coalesce(F.when(ended, F.col("end.block")), F.lit(-1)).alias("last_block"),
        F.coalesce(F.when(ended, F.col("end.wanted")), F.lit(0)).cast("long").alias("wanted"),
    )


def fold_and(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, parts)


def _fitting(last: DataFrame) -> DataFrame:
    """``__source, __place, __id, __key, __take``: how many of equal rows of a last block are taken, whole.

    In the permuted order each document is taken that still fits into the words wanted; at the end the shortest of those
    left out is taken too if that comes nearer. A source's array has a block's documents, equal ones once.
    """
    of_source = (
        last.where("__size > 0")
        .groupBy("__source", "__place", "__id", "__key", "__size")
        .agg(F.count("*").alias("n"), F.first("__plan.wanted").alias("wanted"))
        .groupBy("__source")
        .agg(
            F.array_sort(F.collect_list(F.struct("__place", "__id", "__key", "__size", "n"))).alias("docs"),
            F.first("wanted").alias("wanted"),
        )
    )
    fit = """aggregate(docs, named_struct('left', wanted, 'takes', cast(array() as array<bigint>)),
        (a, d) -> transform(array(least(d.n, a.left div d.__size)), t ->
            named_struct('left', a.left - t * d.__size, 'takes', concat(a.takes, array(t))))[0])"""
    each = of_source.withColumn("fit", F.expr(fit)).select(
        "__source", "fit.left", F.explode(F.expr("zip_with(docs, fit.takes, (d, t) -> named_struct('d', d, 't', t))")).alias("e")
    )
    out = F.col("e.t") < F.col("e.d.n")
    shortest = F.min(F.when(out, F.struct("e.d.__size", "e.d.__place", "e.d.__id", "e.d.__key"))).over(Window.partitionBy("__source"))
    mine = F.struct("e.d.__size", "e.d.__place", "e.d.__id", "e.d.__key").eqNullSafe(shortest)
    more = F.when(out & mine & (2 * F.col("left") >= F.col("e.d.__size")), 1).otherwise(0)
    return each.select("__source", "e.d.__place", "e.d.__id", "e.d.__key", (F.col("e.t") + more).alias("__take"))


def _allotted(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows``, which :func:`sized` made, with ``__plan`` (of the source), ``__block`` and ``__extra`` words."""
    columns = [c for c in plan.columns if c != "__of"]
    plans = plan.select("__of", F.struct(*columns).alias("__plan"))
    placed = (
        rows.join(plans, F.col("__source").eqNullSafe(F.col("__of")))
        .drop("__of")
        .withColumn("__block", _block(F.col("__plan.n_docs"), F.col("__place")))
    )
    # Of each source only its last block, whose documents don't grow with the source, is gone through one by one.
    last = placed.where(F.col("__block") == F.col("__plan.last_block"))
    same = ["__source", "__place", "__id", "__key"]
    fitting = scratch(_fitting(last), "last-blocks")
    nth = F.row_number().over(Window.partitionBy(*same).orderBy("__size"))
    fits = [F.col(c).eqNullSafe(F.col(f"__l{c}")) for c in same]
    ends = (
        last.withColumn("__nth", nth)
        .join(fitting.select(*(F.col(c).alias(f"__l{c}") for c in same), "__take"), fold_and(fits), "left")
        .withColumn("__extra", F.when(F.col("__nth") <= F.col("__take"), F.col("__size")).otherwise(0).cast("long"))
        .drop("__nth", "__take", *(f"__l{c}" for c in same))
    )
    others = placed.where(F.col("__block") != F.col("__plan.last_block")).withColumn(
        "__extra", F.when(F.col("__block") < F.col("__plan.last_block"), F.col("__size")).otherwise(0).cast("long")
    )
    return others.unionByName(ends)


def _planned(docs: DataFrame, id_column: str) -> tuple[DataFrame, DataFrame]:
    narrow = sized(docs.select(id_column, "source", "text"), id_column).select(*_SIZED)
    rows = scratch(narrow, "sized")
    return rows, scratch(_plan(rows, scratch(targets(rows), "targets")), "plan")


def taken(docs: DataFrame, id_column: str = "doc_id", shards: int = SHARDS) -> DataFrame:
    """What the mix takes of every document.

    Returns ``id, key, source, size, source_size, target, taken, passes, extra, shards``: ``taken`` words, summed
    over the copies that the tree deals to shards, are ``passes`` whole copies and ``extra`` words more; ``shards`` has
    the shard of each copy in turn. Documents are taken whole: a source's words miss its target by half of
    the shortest document left out at most. Null and empty texts have no words and are
    taken with none; a null source is a source of its own, the last; equal rows are separate documents; an
    empty table gives no rows.
    """
    rows, plan = _planned(docs, id_column)
    return _dealt(rows, plan, shards).select(
        F.col("__id").alias("id"),
        F.col("__key").alias("key"),
        F.col("__source").alias("source"),
        F.col("__size").alias("size"),
        "__plan.source_size",
        "__plan.target",
        F.expr("aggregate(filter(__copies, c -> c.shard is not null), 0L, (n, c) -> n + c.words)").alias("taken"),
        "__plan.passes",
        F.col("__extra").alias("extra"),
        F.col("__copies.shard").alias("shards"),
    )


def _log_factorial(n: str) -> str:
    """Stirling's series from 16 on (exact to rounding), a product below."""
    small = f"ln(aggregate(sequence(1, cast({n} as int)), 1D, (f, i) -> f * i))"
    series = (
        f"{n} * ln({n}) - {n} + 0.5D * ln(6.283185307179586D * {n}) + 1D / (12D * {n}) "
        f"- 1D / (360D * {n} * {n} * {n})"
    )
    return f"if({n} < 1D, 0D, if({n} < 16D, {small}, {series}))"


def _drawn(total: str, good: str, draws: str, uniform: str) -> str:
    """SQL: how many of ``draws`` out of ``total`` are among ``good`` ones, by inversion of a uniform number.

    The probabilities are summed over twelve standard deviations round the mean, all that doubles can tell.
    """
    choose = lambda n, k: f"({_log_factorial(n)} - {_log_factorial(k)} - {_log_factorial(f'({n} - {k})')})"
    mean = f"({draws} * {good} / greatest({total}, 1D))"
    reach = f"(12D * sqrt({mean} * (1D - {good} / greatest({total}, 1D))) + 12D)"
    low = f"greatest(0D, {draws} - ({total} - {good}), floor({mean} - {reach}))"
    high = f"least({good}, {draws}, ceil({mean} + {reach}))"
    chance = f"exp({choose(good, 'k')} + {choose(f'({total} - {good})', f'({draws} - k)')} - {choose(total, draws)})"
    return f"""aggregate(
        transform(sequence(cast({low} as bigint), cast({high} as bigint)), x -> cast(x as double)),
        named_struct('sum', 0D, 'at', cast({low} as double)),
        (h, k) -> if(h.sum < {uniform}, named_struct('sum', h.sum + {chance}, 'at', k), h),
        h -> cast(h.at as bigint))"""


def shard_quotas(quotas: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``source, shard, start, stop``: which draws of each source go to which shard.

    ``quotas`` has a row ``(source, quota)`` for each source. A node of the tree is one row that holds an array
    with a quota for each source (a recipe of sources, not of data); ``shards`` is a power of two.
    """
    if shards < 1 or shards & (shards - 1):
        raise ValueError("shards must be a power of two")
    uniform = f"((shiftrightunsigned(xxhash64({seed}, node, shard, coalesce(s.source, ''), s.source is null), 11) + 0.5D) / {float(1 << 53)}D)"
    draw = _drawn("a.total", "cast(s.quota as double)", "a.draws", "s.uniform")
    # The sources in turn: each gets its share of the draws that are left, out of the blocks that are left.
    deal = f"""aggregate(
        transform(quotas, s -> named_struct('source', s.source, 'quota', s.quota, 'uniform', {uniform})),
        named_struct('total', cast(aggregate(quotas, 0L, (t, s) -> t + s.quota) as double),
                     'draws', cast(floor(aggregate(quotas, 0L, (t, s) -> t + s.quota) / 2) as double),
                     'left', cast(array() as array<struct<source:string,quota:bigint>>)),
        (a, s) -> transform(array({draw}), d -> named_struct(
            'total', a.total - s.quota, 'draws', a.draws - d,
            'left', concat(a.left, array(named_struct('source', s.source, 'quota', d)))))[0],
        a -> a.left)"""
    nodes = quotas.groupBy().agg(
        F.array_sort(F.collect_list(F.struct("source", F.col("quota").cast("long").alias("quota")))).alias("quotas")
    ).select(F.lit(1).alias("node"), F.lit(0).alias("shard"), "quotas")
    width = shards
    while width > 1:
        width //= 2
        nodes = nodes.withColumn("lefts", F.expr(deal)).select(
            F.explode(
                F.expr(
                    f"""array(
                    named_struct('node', node * 2, 'shard', shard, 'quotas', lefts),
                    named_struct('node', node * 2 + 1, 'shard', shard + {width}, 'quotas', transform(quotas, (s, i) ->
                        named_struct('source', s.source, 'quota', s.quota - lefts[i].quota))))"""
                )
            ).alias("n")
        ).select("n.node", "n.shard", "n.quotas")
    upto = Window.partitionBy("source").orderBy("shard")
    return (
        nodes.select("shard", F.explode("quotas").alias("s"))
        .select("shard", "s.source", "s.quota")
        .withColumn("stop", F.sum("quota").over(upto))
        .select("source", "shard", (F.col("stop") - F.col("quota")).alias("start"), "stop")
    )


def _dealt(rows: DataFrame, plan: DataFrame, shards: int) -> DataFrame:
    """``rows`` as allotted, with ``__copies``: number, draw, words and shard of each copy taken."""
    each = """filter(transform(sequence(0, __plan.passes), c -> named_struct(
                'copy', c, 'draw', c * __plan.n_blocks + __block, 'words', if(c < __plan.passes, __size, __extra))),
              c -> c.words > 0)"""
    shard = "filter(__ranges, r -> r.start <= c.draw and c.draw < r.stop)[0].shard"
    quotas = plan.select(
        F.col("__of").alias("source"),
        (F.col("passes") * F.col("n_blocks") + F.col("last_block") + 1).cast("long").alias("quota"),
    ).where("quota > 0")
    dealt = scratch(shard_quotas(quotas, shards), "quotas")
    # One row for each source, with the draws at which the shards begin and end.
    ranges = dealt.groupBy(F.col("source").alias("__of")).agg(
        F.array_sort(F.collect_list(F.struct("shard", "start", "stop"))).alias("__ranges")
    )
    return (
        _allotted(rows, plan)
        .join(ranges, F.col("__source").eqNullSafe(F.col("__of")), "left")
        .withColumn(
            "__copies",
            F.expr(f"transform({each}, c -> named_struct('copy', c.copy, 'draw', c.draw, 'words', c.words, 'shard', {shard}))"),
        )
        .drop("__of", "__ranges")
    )


def _copies(rows: DataFrame, plan: DataFrame, shards: int) -> DataFrame:
    """A row for each copy taken, with ``__copy`` (its number, draw, words and shard), ``__shard`` and ``__position``."""
    return (
        _dealt(rows, plan, shards)
        .withColumn("__copy", F.explode("__copies"))
        .withColumn("__shard", F.col("__copy.shard"))
        .withColumn("__position", F.xxhash64(F.lit(SEED + 1), "__shard", "__copy.copy", "__id", "__key"))
    )


def mix(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The mix: a row for each copy taken, its text whole.

    The columns of ``docs`` and ``mix_copy`` (0 the first), ``mix_words``, ``mix_shard`` and ``mix_position``, by
    which a shard is sorted when it is written: the local shuffle. Documents without words aren't drawn. Where ``docs``
    has one of these names, the new column gets more underscores at its end.
    """
    _, plan = _planned(docs, "doc_id")
    copies = _copies(sized(docs), plan, shards)
    copy, words, shard, position = unused(docs, "mix_copy", "mix_words", "mix_shard", "mix_position")
    return copies.select(
        *(F.col(f"__row.`{c}`").alias(c) for c in docs.columns),
        F.col("__copy.copy").alias(copy),
        F.col("__copy.words").alias(words),
        F.col("__shard").alias(shard),
        F.col("__position").alias(position),
    )
