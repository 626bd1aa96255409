"""What the operators share: tables, keys of texts, batches, word hashes."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from guestbook.session import stage, tune

#: White space that separates words, as a Java, Python and RE2 class body.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"


def prepared(spark: SparkSession) -> SparkSession:
    """The session with this package's settings; texts cross to Python in batches bounded by bytes."""
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 * 1024 * 1024))
    # Frames are staged in the shared folder; a smaller codec costs little against the disk it saves.
    spark.conf.set("spark.sql.parquet.compression.codec", "zstd")
    # A side whose partitions turn out small is hashed, so that the texts of the other side aren't sorted.
    spark.conf.set("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", str(16 * 1024 * 1024))
    return spark


def open_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{folder}/{name}.parquet")


def scratch(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder, and read from there."""
    return stage(df, label)


def text_key(text: Column) -> Column:
    """Sixteen bytes that stand for a text; null and the empty text are the same."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def unused(df: DataFrame, *names: str) -> list[str]:
    """``names``, each drawn out until it isn't a column of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def fold(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, parts)


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit numbers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def gram_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` words, from the hashes of the words."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.full(n, k, np.uint64)
    for i in range(k):
        out = mix64(out + hashes[i : i + n]) if k == 1 else (out ^ (out >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + n]
    return mix64(out)


def signed(x: np.ndarray) -> np.ndarray:
    """The same bits as Spark's signed long."""
    return x.view(np.int64)


def rows_of(batches: Iterator, *columns: str) -> Iterator[tuple]:
    """Rows of pandas batches as tuples, a batch after the other."""
    for batch in batches:
        yield from zip(*(batch[c] for c in columns), strict=True)
