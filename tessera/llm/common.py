"""Shared helpers: tables, words in Arrow batches, 64-bit hashing in numpy.

A word is a run of characters other than space and U+0009..U+000D, so
splitting on ASCII white space is exact and leaves all other characters alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import data_path, ship_package, written  # noqa: F401

WHITE = " \t\n\x0b\x0c\r"
#: Text that one vectorised step handles at once, in bytes; bounds a worker's memory.
CHUNK_BYTES = 4 << 20
#: Rows of an Arrow batch; long texts make larger ones needless.
BATCH_ROWS = "1000"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(data_path(sf_dir, name))


def small_batches(spark: SparkSession) -> None:
    """For operators with Python tasks: workers can import this package, and
    as long texts share an Arrow batch, its rows are few."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of about CHUNK_BYTES of text each (one row at least)."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0), dtype=np.int64)
    total, start = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if total and total + size > CHUNK_BYTES:
            yield start, i
            total, start = 0, i
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def lean(run):
    """An Arrow function that hands freed memory back when its task is done: a
    worker process outlives its task, and shares its executor's limit."""
    def wrapped(batches):
        import ctypes
        try:
            trim = ctypes.CDLL(None).malloc_trim
        except (OSError, AttributeError):  # not this C library
            trim = None
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        if trim:
            trim(0)
    return wrapped


class Words:
    """The words of some texts: ``codes`` (one per word, in order), ``bounds``
    (text i has words bounds[i]:bounds[i+1]) and the distinct ``vocab``."""

    def __init__(self, texts: pa.Array, lower: bool = False):
        texts = pc.fill_null(texts, "")
        if lower:  # A-Z alone
            texts = pc.ascii_lower(texts)
        lists = pc.ascii_split_whitespace(texts)
        flat = lists.flatten()
        counts = np.asarray(pc.list_value_length(lists), dtype=np.int64)
        full = np.asarray(pc.binary_length(flat)) > 0  # text ends give empty parts
        if not full.all():
            ends = np.cumsum(counts)
            seen = np.concatenate(([0], np.cumsum(full)))
            counts = seen[ends] - seen[ends - counts]
            flat = flat.filter(pa.array(full))
        coded = flat.dictionary_encode()
        self.codes = np.asarray(coded.indices, dtype=np.int64)
        self.vocab, self._hashes = coded.dictionary, None
        self.counts = counts
        self.bounds = np.concatenate(([0], np.cumsum(counts)))
        self.doc = np.repeat(np.arange(len(counts)), counts)  # the text of each word

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word, the same in every process."""
        return self.vocab_hashes()[self.codes] if len(self.codes) else np.zeros(0, np.uint64)

    def vocab_hashes(self) -> np.ndarray:
        """A 64-bit hash of each distinct word, made once."""
        if self._hashes is None:
            self._hashes = hash_strings(self.vocab)
        return self._hashes


def hash_strings(strings: pa.Array) -> np.ndarray:
    import xxhash
    h = xxhash.xxh3_64_intdigest
    return np.fromiter(map(h, strings.cast(pa.binary()).to_pylist()), dtype=np.uint64, count=len(strings))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def gram_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """64-bit hash of the ``size`` consecutive values from each position on
    (len(h) - size + 1 of them): a polynomial in odd base, scrambled."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, base = np.zeros(n, np.uint64), np.uint64(0x9E3779B97F4A7C15)
    for k in range(size):
        out = out * base + h[k:k + n]
    return mix(out)


def to_long(h: np.ndarray) -> pa.Array:
    """Unsigned 64-bit values as Spark longs."""
    return pa.array(h.view(np.int64))


def unit_key(*cols):
    """A uniform number in [0, 1) from columns, the same on every run."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 52)).cast("double") / float(1 << 52)
