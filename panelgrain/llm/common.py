"""Helpers that several operators share."""

from __future__ import annotations

import contextlib
import gc
import os
import sys
import tempfile
import types

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: the one the cluster names in ``spark.checkpoint.dir``.

    Only a local session that names none gets a temporary one.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = os.path.join(tempfile.gettempdir(), "panelgrain-shared")
    return shared.rstrip("/")


RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_released(spark: SparkSession):
    """What is built and run inside leaves no shuffle files behind: Spark removes them when an action ends.

    Else they stay until the driver happens to collect its garbage, and the steps of a long job add up.
    """
    before = spark.conf.get(RELEASE, None)
    spark.conf.set(RELEASE, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(RELEASE)
        else:
            spark.conf.set(RELEASE, before)


def settled(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder and read from there; what was shuffled for it goes."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    with shuffles_released(df.sparkSession):
        return df.select("*").checkpoint()  # planned anew: shuffles that ``df`` itself may have stay


def with_text(docs: DataFrame) -> DataFrame:
    """The two columns that text operators read; a null text counts as an empty one."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


CHUNK_BYTES = 1 << 20


def worker_memo(owner: str | None) -> dict:
    """What this worker process keeps for later tasks of ``owner``; work of anyone else empties it."""
    kept = sys.modules.setdefault("_panelgrain_memo", types.ModuleType("_panelgrain_memo")).__dict__
    if kept.get("owner") != owner:
        memo = kept.pop("memo", None)
        if memo:
            memo.clear()
            gc.collect()
            pa.default_memory_pool().release_unused()
        kept["owner"] = owner
    return kept.setdefault("memo", {})


def chunks(batches, size: int = CHUNK_BYTES, owner: str | None = None):
    """Slices of Arrow batches with about ``size`` bytes of ``text`` (one row at least)."""
    worker_memo(owner)
    for batch in batches:
        if not batch.num_rows:
            continue
        bounds = flat(batch.column("text"))[1]
        row = 0
        while row < batch.num_rows:
            end = int(np.searchsorted(bounds, bounds[row] + size, side="right")) - 1
            end = min(max(end, row + 1), batch.num_rows)
            yield batch.slice(row, end - row)
            row = end


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows one after the other, and where each row begins and ends."""
    if pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        column, kind = column.cast(pa.string()), np.int32
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    if offsets is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[bounds[0]:bounds[-1]], bounds - bounds[0]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (shift, multiply, shift)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_RANDOM = np.random.default_rng(20_240_601)
BYTE_VALUES = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
BASE = np.uint64(0x5851F42D4C957F2D)


def word_bytes() -> np.ndarray:
    """Byte classes: 0 separates words, letters A-Z fall together with a-z."""
    lut = np.zeros(256, np.uint8)
    for b in range(256):
        if 65 <= b <= 90:
            lut[b] = b + 32
        elif 97 <= b <= 122 or 48 <= b <= 57 or b >= 128:
            lut[b] = b
    return lut


WORD_BYTES = word_bytes()


def powers(n: int) -> np.ndarray:
    out = np.full(n, BASE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Words:
    """Words (runs of ASCII letters, digits and non-ASCII bytes) of many texts with 64-bit hashes.

    ``row``: text of each word; ``start``, ``end``: bytes in the joined texts; ``first``: for
    each text its first word (one more entry closes the last text).
    """

    def __init__(self, column: pa.Array):
        self.data, self.bounds = flat(column)
        mapped = WORD_BYTES[self.data]
        inside = mapped != 0
        edge = inside.copy()
        edge[1:] &= ~inside[:-1]
        heads = self.bounds[:-1][self.bounds[:-1] < len(self.data)]
        edge[heads] = inside[heads]
        self.start = np.flatnonzero(edge)
        n = len(self.start)
        if n:
            place = np.flatnonzero(inside)
            values = BYTE_VALUES[mapped[place]]
            head = np.searchsorted(place, self.start)
            length = np.diff(np.append(head, len(place)))
            offset = np.arange(len(place)) - np.repeat(head, length)
            values *= powers(int(length.max()))[offset]
            self.hash = mix(np.add.reduceat(values, head) + length.astype(np.uint64))
            self.end = self.start + length
        else:
            self.hash, self.end = np.zeros(0, np.uint64), self.start
        self.first = np.searchsorted(self.start, self.bounds)
        self.row = np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.first))

    def code_points(self, places: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Byte positions as code-point positions inside their text."""
        count = np.zeros(len(self.data) + 1, np.int64)
        np.cumsum((self.data & 0xC0) != 0x80, out=count[1:])
        return count[places] - count[self.bounds[:-1][rows]]


def bitmap_of(hashes: DataFrame, column: str, bits: int) -> np.ndarray:
    """A bitmap of 2**bits bits with those of the column's hashes set: of fixed size whatever the
    number of hashes (at most 2**bits / 8 bytes reach the driver), it lets pass what may be in
    the table; what passes is then joined exactly."""
    slot = F.shiftrightunsigned(F.col(column), 64 - bits)
    words = (hashes.select(F.shiftrightunsigned(slot, 6).alias("word"),
                           F.expr(f"shiftleft(1L, cast(shiftrightunsigned({column}, {64 - bits}) & 63 as int))").alias("bit"))
             .groupBy("word").agg(F.bit_or("bit").alias("bits")))
    out = np.zeros(1 << (bits - 6), np.uint64)
    found = words.toArrow()
    if found.num_rows:
        out[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return out.view(np.uint8)


def in_bitmap(bitmap: np.ndarray, bits: int, hashes: np.ndarray) -> np.ndarray:
    slot = hashes >> np.uint64(64 - bits)
    return (bitmap[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1
