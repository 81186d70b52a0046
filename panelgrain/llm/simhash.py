"""SimHash near-dedup: fingerprints, a grid over per-segment bit counts, exact check, components.

A 64-bit fingerprint is cut into 32 segments of two bits; the bit counts of the segments are a
vector whose Manhattan distance never exceeds the fingerprints' Hamming distance.  Two vectors
within distance 3 have a half (16 segments) within distance 1, so a grid whose cells are the half
vectors, joined over distance 1, meets every pair; each pair met is then checked exactly.

Only distinct fingerprints enter the grid, and a cell gives at most as many edges as it has members
(a spanning forest of its verified links), so copies and dense groups never become all pairs.

Defined results: a text without words has fingerprint 0 and links like any other; a component's id
is its smallest doc_id (null only if all its ids are null); every row gets a result, repeated rows too.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, settled, table, with_text, worker_memo
from .components import components

SHINGLE, RADIUS, SEED = 3, 3, 42
#: Rows of a cell that one task compares at once; larger cells are cut into blocks, and every pair of blocks is compared.
BLOCK = 2048
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def _shingle_hashes(text: bytes, size: int) -> np.ndarray:
    words = text.translate(LOWER).split()  # blanks: 0x20 and 0x09 to 0x0D
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts[:len(words) - size + 1].tolist(), ends[size - 1:].tolist())),
                       np.uint64, len(words) - size + 1)


WEIGHTS = np.uint64(1) << np.arange(64, dtype=np.uint64)


def _fingerprint(hashes: np.ndarray, block: int = 1 << 16) -> int:
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), block):
        bits = np.unpackbits(hashes[i:i + block].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(WEIGHTS[2 * ones > len(hashes)].sum(dtype=np.uint64))


def _fingerprints(size: int):
    def run(batches):
        for batch in chunks(batches):
            marks = [_fingerprint(_shingle_hashes(t, size)) for t in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(np.array(marks, np.uint64).view(np.int64))],
                names=["doc_id", "text_hash", "mark"])
    return run


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, text_hash, mark): the 64-bit fingerprint as a signed long."""
    return (with_text(docs).withColumn("text_hash", F.xxhash64("text"))
            .mapInArrow(_fingerprints(size), "doc_id long, text_hash long, mark long"))


def grid(marks: DataFrame) -> DataFrame:
    """(half, cell, mark, home): each fingerprint in its own two cells (``home``) and in the cells one
    bit count further up.  Of two neighbouring cells the lower one's members visit the upper one."""
    five = F.lit(0x55555555)
    low = F.col("mark").bitwiseAND(F.lit(0xFFFFFFFF))
    high = F.shiftrightunsigned("mark", 32)
    halves = marks.select("mark", F.posexplode(F.array(low, high)).alias("half", "bits"))
    cells = halves.select(
        "mark", "half",
        (F.col("bits").bitwiseAND(five) + F.shiftrightunsigned("bits", 1).bitwiseAND(five)).alias("cell"))
    steps = [F.when(F.col("cell").bitwiseAND(F.lit(3 << 2 * j)) < (2 << 2 * j), F.col("cell") + F.lit(1 << 2 * j)) for j in range(16)]
    return (cells.select("mark", "half", F.posexplode(F.array(F.col("cell"), *steps)).alias("step", "cell"))
            .where(F.col("cell").isNotNull())
            .select("half", "cell", "mark", (F.col("step") == 0).alias("home")))


def _forest(left: np.ndarray, right: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what links within ``radius`` connect: among left, and between left and right."""
    n = len(left)
    points = np.concatenate([left, right])
    close = np.bitwise_count(left[:, None] ^ points[None, :]) <= radius
    label = np.arange(len(points))
    top = len(points)
    while True:
        least = label[:n].copy()
        for i in range(0, n, 256):
            least[i:i + 256] = np.where(close[i:i + 256], label[None, :], top).min(axis=1)
        new = label.copy()
        new[:n] = np.minimum(new[:n], least)
        for i in range(0, top, 256):  # right points take the least label of the left points near them
            part = np.where(close[:, i:i + 256], new[:n, None], top).min(axis=0) if n else np.full(0, top)
            new[i:i + 256] = np.minimum(new[i:i + 256], part)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label != np.arange(top))
    return points[moved], points[label[moved]]


def _links(radius: int):
    def small(mark, home, lag_at, lag):
        a, b = mark[lag_at], mark[lag_at + lag]
        ok = (np.bitwise_count(a ^ b) <= radius) & (home[lag_at] | home[lag_at + lag])
        return a[ok], b[ok]

    def group(mark, home, side):
        """side 2: one block against itself; else blocks 0 and 1 of a pair against each other."""
        if (side == 2).all():
            return _forest(mark[home], mark[~home], radius)
        out = []
        for one, other in ((side == 0, side == 1), (side == 1, side == 0)):
            h = mark[one & home]
            o = mark[other]
            out.append(_forest(h, o, radius) if len(h) and len(o) else (h[:0], h[:0]))
        return np.concatenate([x[0] for x in out]), np.concatenate([x[1] for x in out])

    def run(batches):
        worker_memo(None)
        rest = None
        for batch in itertools.chain(_read(batches), [None]):
            if batch is not None:
                rest = batch if rest is None else [np.concatenate([a, b]) for a, b in zip(rest, batch)]
            if rest is None or not len(rest[0]):
                continue
            key, mark, home, side = rest
            change = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
            end = len(mark) if batch is None else (change[-1] if len(change) else 0)
            rest = [x[end:] for x in rest]
            if not end:
                continue
            key, mark, home, side = key[:end], mark[:end], home[:end], side[:end]
            begin = np.concatenate([[0], change[change < end]])
            length = np.diff(np.append(begin, end))
            us, vs = [], []
            for g in np.flatnonzero((length > 24) | ((side[begin] != 2) & (length > 1))):
                s = slice(begin[g], begin[g] + length[g])
                u, v = group(mark[s], home[s], side[s])
                us.append(u), vs.append(v)
            tiny = (length <= 24) & (length > 1) & (side[begin] == 2)
            for lag in range(1, int(length[tiny].max(initial=1))):
                use = tiny & (length > lag)
                count = length[use] - lag
                at = np.repeat(begin[use] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
                u, v = small(mark, home, at, lag)
                us.append(u), vs.append(v)
            if us:
                u, v = np.concatenate(us).view(np.int64), np.concatenate(vs).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v))], names=["u", "v"])

    def _read(batches):
        for b in batches:
            if b.num_rows:
                key = np.stack([b.column(c).to_numpy(zero_copy_only=False) for c in ("half", "cell", "one", "two")], axis=1)
                yield [key, b.column("mark").to_numpy().view(np.uint64), b.column("home").to_numpy(zero_copy_only=False),
                       b.column("side").to_numpy()]
    return run


def near_links(marks: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """Edges (u, v) whose components are those of all pairs of distinct ``marks`` within ``radius``.

    Cells are counted first.  A cell of more than ``block`` rows is dealt into blocks by hash, and
    each row goes to every pair that its block is part of: all pairs are compared, in bounded tasks.
    """
    if radius != 3:
        raise ValueError("the half cells are complete for a radius of 3")
    rows = grid(marks)
    counts = rows.groupBy("half", "cell").agg(F.count(F.lit(1)).alias("n"), F.max("home").alias("any_home")).where(
        (F.col("n") > 1) & F.col("any_home"))
    blocks = F.ceil(F.col("n") / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64("mark"), F.col("blocks")).cast("int")
    met = (rows.join(counts, ["half", "cell"]).withColumn("blocks", blocks).withColumn("own", own)
           .select("half", "cell", "mark", "home", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
           .select("half", "cell", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"), "mark", "home",
                   F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side")))
    keys = ["half", "cell", "one", "two"]
    return met.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_links(radius), "u long, v long")


def near_duplicates(docs: DataFrame, size: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, text_hash, mark, root, component_id) for every row of ``docs``; ``root`` names the component too."""
    marked = settled(fingerprints(docs, size))
    distinct = settled(marked.groupBy("mark").agg(F.min("doc_id").alias("least")))
    roots = components(near_links(distinct.select("mark"), radius))
    members = distinct.join(roots.withColumnRenamed("node", "mark"), "mark", "left").select(
        "mark", "least", F.coalesce("root", "mark").alias("root"))
    ids = members.groupBy("root").agg(F.min("least").alias("component_id"))
    found = members.join(ids, "root").select("mark", "root", "component_id")
    return marked.join(found, "mark").select("doc_id", "text_hash", "mark", "root", "component_id")


def op5_simhash(spark, sf_dir):
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("mark"), 16, "0")).alias("fingerprint"), "component_id")
