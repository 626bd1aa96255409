"""Removal of repeated byte strings by blockwise suffix sorting with a difference cover.

A string of ``LENGTH`` bytes is removed wherever it stands if it starts at two places or more. Suffixes are sorted in
buckets that hold all suffixes with equal first ``LENGTH`` bytes: of the grams of ``GRAM`` bytes in such a string the
one of least hash is its anchor, so that equal strings have equal anchors at equal places in them. Anchors that occur
once end most of the work at once. An anchor's context, all strings around it, is next compared as a whole
by its hash; only contexts that differ from all others, and those with their anchor, are sorted as suffixes:

* whole buckets are gathered to blocks of bounded size, a block a matrix with a context a row, anchors aligned;
* columns of a difference cover are sample suffixes, ranked first, with their longest common prefixes;
* the suffixes of one column after the other are sorted: up to the next sample by their bytes, and ties beyond by
  the rank of the sample, whose common prefixes say who agrees to the full length.

A bucket of more than ``CROWD`` contexts is counted string by string with a hash instead, which any number of tasks share.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from guestbook.llm.common import mix64, rows_of, scratch, signed

LENGTH = 200
GRAM = 64
#: Strings around an anchor: as many as there are places of the anchor in them.
AROUND = LENGTH - GRAM + 1
WIDTH = AROUND - 1 + LENGTH
#: Contexts sorted at once, and in the largest bucket sorted in one task (about a kilobyte each).
BLOCK = 4096
CROWD = 1 << 16
COVER = 73
#: Bytes of a text that are hashed at once.
PIECE = 1 << 22

_BASE = 0x9E3779B97F4A7C15
_PLACES = np.uint64((1 << 24) - 1)
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2 ** 64."""
    if len(_POWERS[0]) < n:
        size = max(n, 2 * len(_POWERS[0]))
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[i] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS[0][:n], _POWERS[1][:n]


def difference_cover(v: int) -> list[int]:
    """Residues whose differences are all residues modulo ``v``, chosen greedily."""
    cover, differences = [0], {0}
    while len(differences) < v:
        gains = [(len({(x - c) % v for c in cover} | {(c - x) % v for c in cover} - differences), -x) for x in range(v)]
        best = -max(gains)[1]
        if best in cover:
            best = next(x for x in range(v) if x not in cover)
        differences |= {(best - c) % v for c in cover} | {(c - best) % v for c in cover}
        cover.append(best)
    return sorted(cover)


def _window_least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive numbers, by running minima from both ends of blocks."""
    n = len(x) - width + 1
    blocks = -(-len(x) // width)
    padded = np.full(blocks * width, np.uint64(2**64 - 1))
    padded[: len(x)] = x
    padded = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    back = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def anchors(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places, gram hashes and context hashes of the anchors of all strings of ``LENGTH`` bytes."""
    found = [_piece_anchors(data, at) for at in range(0, len(data) - LENGTH + 1, PIECE)]
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64)
    places, keys, contexts = (np.concatenate(part) for part in zip(*found, strict=True))
    # An anchor of strings on both sides of a piece's end is found by both pieces.
    places, once = np.unique(places, return_index=True)
    return places, keys[once], contexts[once]


def _piece_anchors(data: bytes, at: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    low = max(0, at - AROUND + 1)
    piece = np.frombuffer(data, np.uint8)[low : at + PIECE + WIDTH]
    n = len(piece)
    powers, inverse = _powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((piece.astype(np.uint64) + np.uint64(1)) * powers[:n], out=sums[1:])
    first = at - low
    last = min(n - LENGTH, first + PIECE - 1)
    end = last + LENGTH - GRAM
    grams = mix64((sums[first + GRAM : end + GRAM + 1] - sums[first : end + 1]) * inverse[first : end + 1])
    least = _window_least((grams & ~_PLACES) | np.arange(len(grams), dtype=np.uint64), AROUND)
    places = (least[np.concatenate([[True], least[1:] != least[:-1]])] & _PLACES).astype(np.int64)
    keys = grams[places]
    places += first
    start, stop = np.maximum(0, places - AROUND + 1), np.minimum(n, places + LENGTH)
    context = mix64((sums[stop] - sums[start]) * inverse[start])
    shape = (places - start).astype(np.uint64) << np.uint64(32) | (stop - places).astype(np.uint64)
    return places + low, keys, mix64(context ^ mix64(shape))


def _text_id() -> list[Column]:
    text = F.coalesce("text", F.lit(""))
    return [F.xxhash64(text).alias("h"), F.hash(text).alias("m")]


def _anchored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        hs, ms, counts, parts = [], [], [], []
        for h, m, text in rows_of([batch], "h", "m", "text"):
            part = anchors(text.encode("utf-8", "surrogatepass")) if text else ()
            if part and len(part[0]):
                hs.append(h)
                ms.append(m)
                counts.append(len(part[0]))
                parts.append(part)
        if parts:
            places, keys, contexts = (np.concatenate(x) for x in zip(*parts, strict=True))
            yield pd.DataFrame(
                {
                    "h": np.repeat(hs, counts),
                    "m": np.repeat(np.array(ms, np.int32), counts),
                    "at": places.astype(np.int32),
                    "anchor": signed(keys),
                    "context": signed(contexts),
                }
            )


def occurrences(docs: DataFrame) -> DataFrame:
    """``h, m, at, anchor, context``: anchors of every row's text; ``h`` and ``m`` stand for the text."""
    rows = docs.select(*_text_id(), "text")
    return rows.mapInPandas(_anchored, "h long, m int, at int, anchor long, context long")


def repeated_strings(owner: np.ndarray, before: np.ndarray, data: list[bytes], known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last column at which a row has a string that another row of its owner has; (1, 0) if none.

    ``owner`` groups rows by anchor, ``before`` are bytes before the anchor, ``known`` rows needn't be answered.
    """
    n = len(data)
    matrix = np.zeros((n, 4 + WIDTH), np.uint8)
    matrix[:, :4] = owner.astype(">u4").view(np.uint8).reshape(n, 4)
    begin = AROUND - 1 - before
    length = np.fromiter(map(len, data), np.int64, n)
    for row, start, string in zip(matrix, (4 + begin).tolist(), data, strict=True):
        row[start : start + len(string)] = np.frombuffer(string, np.uint8)
    final = begin + length - LENGTH  # the last column at which a row has a whole string
    low, high = np.full(n, AROUND, np.int64), np.full(n, -1, np.int64)
    cover = set(difference_cover(COVER))
    samples = [c for c in range(AROUND + COVER) if c % COVER in cover and c < WIDTH]
    done = 0
    for sample in samples:
        column = range(done, min(sample, AROUND - 1) + 1)
        done = sample + 1
        if not column:
            break
        tail = min(LENGTH, WIDTH - sample)
        key = np.concatenate([matrix[:, :4], matrix[:, 4 + sample : 4 + sample + tail]], axis=1)
        order = np.argsort(np.ascontiguousarray(key).view(f"S{4 + tail}").ravel(), kind="stable")
        ranked = key[order]
        same = ranked[1:] == ranked[:-1]
        common = np.where(same.all(axis=1), 4 + tail, same.argmin(axis=1))
        for at in column:  # one bucket of suffixes: those of this column
            agree = common >= 4 + LENGTH - (sample - at)
            names = np.empty(n, np.int64)
            names[order] = np.concatenate([[0], np.cumsum(~agree)])
            tied = np.zeros(n, bool)
            tied[order[1:]] |= agree
            tied[order[:-1]] |= agree
            tied &= (begin <= at) & (at <= final)
            some = np.flatnonzero(tied)
            if not len(some):
                continue
            if at < sample:  # ranks agree; now the bytes before the sample
                head = np.concatenate(
                    [names[some].astype(">u4").view(np.uint8).reshape(-1, 4), matrix[some, 4 + at : 4 + sample]], axis=1
                )
                _, where, many = np.unique(
                    np.ascontiguousarray(head).view(np.dtype((np.void, head.shape[1]))).ravel(), return_inverse=True, return_counts=True
                )
            else:
                _, where, many = np.unique(names[some], return_inverse=True, return_counts=True)
            some = some[many[where] > 1]
            low[some] = np.minimum(low[some], at)
            high[some] = np.maximum(high[some], at)
    low[known], high[known] = begin[known], final[known]
    none = high < 0
    low[none], high[none] = 1, 0
    return low, high


def _sorted_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Whole anchors of an input sorted by anchor, in blocks of about ``BLOCK`` contexts."""
    kept: list[pd.DataFrame] = []
    size = 0
    for batch in batches:
        if not len(batch):
            continue
        kept.append(batch)
        size += len(batch)
        if size < BLOCK:
            continue
        held = pd.concat(kept, ignore_index=True)
        whole = int(held["anchor"].searchsorted(held["anchor"].iloc[-1]))  # the last anchor may go on
        for part in _blocks(held.iloc[:whole]):
            yield _resolved(part)
        kept, size = [held.iloc[whole:]], len(held) - whole
    if size:
        for part in _blocks(pd.concat(kept, ignore_index=True)):
            yield _resolved(part)


def _blocks(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
    keys = rows["anchor"].to_numpy()
    at = 0
    while at < len(keys):
        to = min(at + BLOCK, len(keys))
        if to < len(keys):
            to = max(at + int(np.searchsorted(keys[at:], keys[to], "left")), at) if keys[to] == keys[to - 1] else to
            if to == at:
                to = at + int(np.searchsorted(keys[at:], keys[at], "right"))
        yield rows.iloc[at:to]
        at = to


def _resolved(block: pd.DataFrame) -> pd.DataFrame:
    _, owner = np.unique(block["anchor"].to_numpy(), return_inverse=True)
    before = block["before"].to_numpy().astype(np.int64)
    low, high = repeated_strings(owner, before, block["data"].tolist(), (block["copies"] > 1).to_numpy())
    out = block[["anchor", "context"]].assign(low=low - (AROUND - 1), high=high - (AROUND - 1) + LENGTH)
    return out[high >= low]


def _strings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Every string of the contexts of crowded anchors."""
    for anchor, context, before, data in rows_of(batches, "anchor", "context", "before", "data"):
        places = range(len(data) - LENGTH + 1)
        digests = [xxhash.xxh3_128_digest(data[i : i + LENGTH]) for i in places]
        yield pd.DataFrame({"anchor": anchor, "context": context, "at": [i - before for i in places], "string": digests})


def _crowded(contexts: DataFrame) -> DataFrame:
    """Ranges of contexts whose anchor has too many to sort them in one task."""
    strings = scratch(
        contexts.mapInPandas(_strings, "anchor long, context long, at int, string binary"), "strings"
    )
    many = strings.groupBy("anchor", "at", "string").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    found = strings.join(many, ["anchor", "at", "string"], "left_semi")
    return found.groupBy("anchor", "context").agg(F.min("at").alias("low"), (F.max("at") + LENGTH).alias("high"))


_RANGE = "anchor long, context long, low int, high int"


def ranges(docs: DataFrame) -> DataFrame:
    """``h, m, spans``: byte ranges ``(start, stop)`` to remove of each text that has any, merged."""
    found = occurrences(docs)
    twice = found.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor")
    twice = scratch(twice, "anchors")
    occ = scratch(found.join(twice, "anchor", "left_semi"), "occurrences")
    contexts = scratch(
        occ.groupBy("anchor", "context").agg(F.count("*").alias("copies"), F.min(F.struct("h", "m", "at")).alias("one")),
        "contexts",
    )
    # Where all contexts of an anchor are one, or each stands twice, nothing is left to find out.
    open_anchors = scratch(
        contexts.groupBy("anchor")
        .agg(F.count("*").alias("n"), F.min("copies").alias("fewest"))
        .where("n > 1 and fewest = 1")
        .select("anchor", "n"),
        "open-anchors",
    )
    wanted = (
        contexts.join(open_anchors, "anchor")
        .groupBy("one.h", "one.m")
        .agg(F.collect_list(F.struct("anchor", "context", "copies", "one.at")).alias("wanted"))
    )
    # A text's bytes are cut where they lie; copies of a text give the same contexts.
    pieces = (
        docs.select(*_text_id(), F.col("text").cast("binary").alias("bytes"))
        .join(wanted, ["h", "m"])
        .select("bytes", F.explode("wanted").alias("w"))
        .select(
            "w.anchor",
            "w.context",
            "w.copies",
            F.expr(f"least(w.at, {AROUND - 1})").alias("before"),
            F.expr(f"substring(bytes, greatest(w.at - {AROUND - 1}, 0) + 1, least(w.at, {AROUND - 1}) + {LENGTH})").alias("data"),
        )
    )
    cut = scratch(pieces.dropDuplicates(["anchor", "context"]).join(open_anchors, "anchor"), "cut")
    few, many = cut.where(F.col("n") <= CROWD), cut.where(F.col("n") > CROWD).drop("n")
    sorted_ranges = few.repartition("anchor").sortWithinPartitions("anchor").mapInPandas(_sorted_blocks, _RANGE)
    partial = scratch(sorted_ranges.unionByName(_crowded(many)) if not many.isEmpty() else sorted_ranges, "ranges")

    whole = contexts.where("copies > 1").select("anchor", "context").withColumns(
        {"low": F.lit(-(AROUND - 1)), "high": F.lit(LENGTH)}
    )
    every = whole.unionByName(partial.join(whole, ["anchor", "context"], "left_anti"))
    spans = (
        occ.join(every, ["anchor", "context"])
        .groupBy("h", "m")
        .agg(F.collect_set(F.struct((F.col("at") + F.col("low")).alias("start"), (F.col("at") + F.col("high")).alias("stop"))).alias("spans"))
    )
    return spans


def _removed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for text, spans in rows_of([batch], "text", "spans"):
            data = (text or "").encode("utf-8", "surrogatepass")
            kept, at, merged = [], 0, []
            for span in sorted((max(0, s["start"]), min(len(data), s["stop"])) for s in (spans if spans is not None else ())):
                if merged and span[0] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], span[1])
                else:
                    merged.append(list(span))
            for start, stop in merged:
                kept.append(data[at:start])
                at = stop
            kept.append(data[at:])
            rest = b"".join(kept)
            out.append((len(data), len(data) - len(rest), [x for s in merged for x in s], hashlib.sha256(rest).hexdigest(), rest))
        made = pd.DataFrame(out, columns=["n_bytes", "n_removed", "cuts", "kept_sha256", "kept"])
        yield pd.concat([batch[["id"]].reset_index(drop=True), made], axis=1)


def deduplicated(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """``id, n_bytes, n_removed, cuts, kept_sha256, kept`` of every document.

    ``cuts`` are starts and stops in turn of the maximal removed byte runs, ``kept`` the bytes left. Null and empty texts
    have no bytes; texts of fewer than ``LENGTH`` bytes lose none; of equal rows every byte is removed if they are as
    long, since each repeats the other; an empty table gives no rows.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("id"), *_text_id(), "text")
    return (
        rows.join(scratch(ranges(docs.select("text")), "spans"), ["h", "m"], "left")
        .select("id", "text", "spans")
        .mapInPandas(
            _removed, f"id {kind}, n_bytes long, n_removed long, cuts array<int>, kept_sha256 string, kept binary"
        )
    )
