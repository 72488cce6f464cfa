"""Registry of the training-data queries and helpers for words and bytes inside tasks."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tablewarden.plans.registry import Registered
from tablewarden.sources.writers import stored

QUERIES: dict[str, Registered] = {}

SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
SLICE_BYTES = 1 << 21  # text that a task turns into arrays at once; a longer document is taken whole

U64 = np.uint64
BASE, MIX_1, MIX_2 = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB
INVERSE = pow(BASE, -1, 1 << 64)


def query(name: str, sql: str | None = None):
    """Register ``function(spark, folder)``."""

    def register(function):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = Registered(name, function, sql)
        return function

    return register


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def settled(df: DataFrame, label: str) -> DataFrame:
    """Write a result to the shared folder and read it back; the shuffle files of the job that made it can go."""
    found = stored(df, label)
    df.sparkSession.sparkContext._jvm.System.gc()  # Spark's cleaner drops the files of what is no longer referenced
    return found


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes of text, one row at least."""
    ends = np.cumsum(lengths(column))
    low = 0
    while low < len(ends):
        before = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield low, high
        low = high


def lengths(column: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def flat(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes in one array, and where each text starts (one more entry for the end)."""
    texts = [x or b"" for x in texts]
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(x) for x in texts], out=offsets[1:])
    return np.frombuffer(b"".join(texts), np.uint8), offsets


def char_class(members) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


NOT_SPACE = char_class(set(range(256)) - set(SPACES))


def word_spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray = NOT_SPACE):
    """Starts and ends of the words, and the number of words before each text (one more for all)."""
    mask = inside[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    opens = mask.copy()
    opens[1:] &= ~mask[:-1] | first[1:-1]
    closes = mask.copy()
    closes[:-1] &= ~mask[1:] | first[1:-1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(starts, offsets)


STEP = 1 << 12


@lru_cache(maxsize=4)
def geometric(base: int, size: int) -> np.ndarray:
    found = np.full(size, base, U64)
    found[0] = 1
    return np.multiply.accumulate(found)


def powers(base: int, size: int) -> np.ndarray:
    """The powers of a base modulo 2**64, from those of one step and those of the steps."""
    steps = -(-size // STEP)
    long = geometric(pow(base, STEP, 1 << 64), max(256, 1 << steps.bit_length()))[:steps]
    return (long[:, None] * geometric(base, STEP)).ravel()[:size]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the splitmix64 finaliser)."""
    x = x ^ (x >> U64(30))
    x = x * U64(MIX_1)
    x ^= x >> U64(27)
    x *= U64(MIX_2)
    x ^= x >> U64(31)
    return x


BYTE_VALUES = mixed(np.arange(1, 257, dtype=U64) * U64(BASE))


class Rolling:
    """Rabin-Karp hashes, modulo 2**64, of any ranges of one sequence of 64-bit values."""

    def __init__(self, values: np.ndarray):
        self.down = powers(INVERSE, len(values) + 1)
        self.sums = np.zeros(len(values) + 1, U64)
        np.cumsum(values * powers(BASE, len(values)), out=self.sums[1:])

    def ranges(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (self.sums[ends] - self.sums[starts]) * self.down[starts]

    def windows(self, width: int) -> np.ndarray:
        """The hash of every window of ``width`` values, by its start."""
        n = len(self.sums) - width
        return (self.sums[width:] - self.sums[:n]) * self.down[:n] if n > 0 else np.empty(0, U64)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    found = Rolling(BYTE_VALUES[data]).ranges(starts, ends)
    return mixed(found ^ ((ends - starts).astype(U64) * U64(MIX_2)))
