"""Near copies of whole texts: wide SimHash fingerprints, a grid over bit counts, exact check, exact rest.

Fingerprints of 512 bits over shingles of five words are cut into 256 segments of two bits, whose bit
counts embed them: the Manhattan distance of two such vectors never exceeds the fingerprints'
Hamming distance.  The grid has 32 groups of eight coordinates; texts whose counts agree in
one of them share a cell (distance 0 in that group).  Texts of similarity 0.8 differ in about 15 % of
the bits, and nearly all of them share a cell; unrelated ones differ in half.  Inside a cell the
whole fingerprints are compared, each text is linked to its nearest one and to a spanning forest of
those within ``radius`` bits, and every link is then checked on the two sets of shingles.

Fingerprints bound no similarity, so some pairs of 0.8 never meet there.  ``missed_links`` meets them all:
two sets of that similarity share a shingle among the first fifth of each, in any order that is the same for
all; rare ones come first.  Only texts that are not in one group yet are compared, and their links are checked
alike, so the result is that of all pairs.

This is the wide sibling of ``simhash``, whose 64 bits and radius 3 are complete for three bits but
meet few texts of similarity 0.8.

Defined results: null and empty texts have no words, those without words are copies of each other;
shorter texts than a shingle are one shingle; a component's id is its smallest doc_id (null only if
all its ids are null); every row gets a result, repeated rows too; an empty table gives no rows.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import chunks, mix, settled, shuffles_released, with_text, worker_memo
from .components import components
from .simhash import BLOCK, _shingle_hashes

SHINGLE, SHARE = 5, 0.8
WORDS, BAND = 8, 8
#: Differing bits of 512 up to which two texts are checked: 78 are expected at similarity 0.8, with a deviation of 8.
RADIUS = 94
KEYS = mix(np.arange(1, WORDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def wide(hashes: np.ndarray) -> bytes:
    """The bits set in over half of the hashes, for eight bijections of the hashes."""
    ones = np.zeros(64 * WORDS, np.int64)
    for first in range(0, len(hashes), 255):
        bits = mix(hashes[first:first + 255, None] ^ KEYS).view(np.uint8)
        ones += np.add.reduce(np.unpackbits(bits, axis=1), axis=0, dtype=np.uint8)
    return np.packbits(2 * ones > len(hashes)).tobytes()


#: Counts of shingles by the first bits of their hashes: they only order them, whatever falls together.
COUNT_BITS = 18


def _counted(size: int):
    def run(batches):
        total = np.zeros(1 << COUNT_BITS, np.int64)
        for batch in chunks(batches):
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                slot = np.unique(_shingle_hashes(text, size)) >> np.uint64(64 - COUNT_BITS)
                np.add.at(total, slot.astype(np.int64), 1)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["slot", "n"])
    return run


def shingle_counts(texts: DataFrame, size: int) -> np.ndarray:
    """Texts by the first bits of their shingles' hashes; of fixed size, whatever their number."""
    with shuffles_released(texts.sparkSession):
        sums = texts.select("text").mapInArrow(_counted(size), "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(1 << COUNT_BITS, np.uint32)
    out[sums.column("slot").to_numpy()] = np.minimum(sums.column("n").to_numpy(), 2 ** 32 - 1)
    return out


def prefix(hashes: np.ndarray, counts: np.ndarray, share: float) -> tuple[np.ndarray, int]:
    """The rarest shingles of a text, of which each text of similarity ``share`` holds one among its own, and the size of its set."""
    hashes = np.unique(hashes)
    n = len(hashes)
    order = np.lexsort((hashes, counts[(hashes >> np.uint64(64 - COUNT_BITS)).astype(np.int64)]))
    return hashes[order[:n - math.ceil(share * n - 1e-9) + 1]], n


def _marks(size: int, share: float, counts: np.ndarray):
    def run(batches):
        for batch in chunks(batches):
            marks, first = [], []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                hashes = _shingle_hashes(text, size)
                marks.append(wide(hashes)), first.append(prefix(hashes, counts, share))
            bounds = np.concatenate([[0], np.cumsum([len(p) for p, _ in first])]).astype(np.int32)
            values = np.concatenate([p for p, _ in first]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(marks, pa.binary()),
                 pa.array([n for _, n in first], pa.int32()), pa.ListArray.from_arrays(pa.array(bounds), pa.array(values))],
                names=["doc_id", "text_hash", "mark", "n", "prefix"])
    return run


def cells_of(marks: np.ndarray) -> np.ndarray:
    """(texts, 32): the cell of each group of coordinates, four bits for two segments' counts."""
    pairs = (marks & 0x55) + (marks >> 1 & 0x55)  # four segments a byte
    return pairs[:, 0::2].astype(np.int32) << 8 | pairs[:, 1::2]


def _cells(batches):
    worker_memo(None)
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        marks = np.frombuffer(b"".join(batch.column("mark").to_pylist()), np.uint8).reshape(n, -1)
        cells = cells_of(marks)
        for band in range(cells.shape[1]):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, band, np.int32)), pa.array(cells[:, band]), batch.column("text_hash"), batch.column("mark")],
                names=["band", "cell", "node", "mark"])


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of each row of a and each row of b (words of fingerprints)."""
    out = np.zeros((len(a), len(b)), np.uint16)
    for i in range(0, len(a), 256):
        for w in range(a.shape[1]):
            out[i:i + 256] += np.bitwise_count(a[i:i + 256, None, w] ^ b[None, :, w])
    return out


def forest(far: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Of all pairs within ``radius``: each row's nearest one, and edges that connect what they connect."""
    close = far <= radius
    some = np.flatnonzero(close.any(axis=1))
    us, vs = [some], [far[some].argmin(axis=1)]
    left = np.zeros(len(far), bool)
    left[some] = True
    for seed in some:
        frontier = np.array([seed])[left[seed:seed + 1]]
        left[seed] = False
        while len(frontier):
            near = close[frontier] & left
            new = np.flatnonzero(near.any(axis=0))
            us.append(new), vs.append(frontier[near[:, new].argmax(axis=0)] if len(new) else new)
            left[new] = False
            frontier = new
    return np.concatenate(us), np.concatenate(vs)


FAR = np.iinfo(np.uint16).max
#: Rows of a group up to which its pairs are compared together with those of other groups.
SMALL = 32


def _links(radius: int):
    def group(marks, side):
        """side 2: one block against itself; else blocks 0 and 1 against each other."""
        if (side == 2).all():
            far = distances(marks, marks)
            np.fill_diagonal(far, FAR)
        else:
            far = np.full((len(marks), len(marks)), FAR, np.uint16)
            one, two = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            across = distances(marks[one], marks[two])
            far[np.ix_(one, two)], far[np.ix_(two, one)] = across, across.T
        return forest(far, radius)

    def found(key, node, marks, side):
        change = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
        begin = np.concatenate([[0], change])
        length = np.diff(np.append(begin, len(node)))
        small = (length <= SMALL) & (length > 1) & (side[begin] == 2)
        us, vs = [], []
        for lag in range(1, int(length[small].max(initial=1))):
            use = small & (length > lag)
            count = length[use] - lag
            at = np.repeat(begin[use] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
            far = np.bitwise_count(marks[at] ^ marks[at + lag]).sum(axis=1, dtype=np.uint16)
            at = at[far <= radius]
            us.append(at), vs.append(at + lag)
        for g in np.flatnonzero(~small & (length > 1)):
            s = slice(begin[g], begin[g] + length[g])
            u, v = group(marks[s], side[s])
            us.append(begin[g] + u), vs.append(begin[g] + v)
        if us:
            u, v = node[np.concatenate(us)], node[np.concatenate(vs)]
            pairs = np.unique(np.stack([np.minimum(u, v), np.maximum(u, v)], axis=1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], names=["u", "v"])

    def run(batches):
        worker_memo(None)
        rest = None
        for batch in itertools.chain((b for b in batches if b.num_rows), [None]):
            if batch is not None:
                key = np.stack([batch.column(c).to_numpy() for c in ("band", "cell", "one", "two")], axis=1)
                marks = np.frombuffer(b"".join(batch.column("mark").to_pylist()), np.uint64).reshape(len(key), -1)
                new = [key, batch.column("node").to_numpy(), marks, batch.column("side").to_numpy()]
                rest = new if rest is None else [np.concatenate([a, b]) for a, b in zip(rest, new)]
                # The last group may go on in the next batch.
                change = np.flatnonzero((rest[0][1:] != rest[0][:-1]).any(axis=1))
                end = change[-1] + 1 if len(change) else 0
            else:
                end = 0 if rest is None else len(rest[0])
            if end:
                yield from found(*(x[:end] for x in rest))
                rest = [x[end:] for x in rest]
    return run


def candidate_links(marks: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """(u, v): links of ``marks`` (text_hash, mark) that share a cell and differ in at most ``radius`` bits.

    Cells are counted first; there are 32 x 3^8 of them at most.  A cell of more than ``block`` rows is dealt into blocks by hash, and each
    row goes to every pair that its block is part of, so that all pairs are compared, in bounded tasks.
    """
    rows = marks.mapInArrow(_cells, "band int, cell int, node long, mark binary")
    counts = rows.groupBy("band", "cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    met = (rows.join(F.broadcast(counts), ["band", "cell"]).withColumn("blocks", F.ceil(F.col("n") / F.lit(block)).cast("int")).withColumn("own", own)
           .select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
           .select("band", "cell", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"), "node", "mark",
                   F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side")))
    keys = ["band", "cell", "one", "two"]
    return met.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_links(radius), "u long, v long")


def alike(a: bytes, b: bytes, size: int, share: float) -> bool:
    x, y = np.unique(_shingle_hashes(a, size)), np.unique(_shingle_hashes(b, size))
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both >= share * (len(x) + len(y) - both)


def _checked(size: int, share: float):
    def run(batches):
        worker_memo(None)
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                texts = (part.column(c).cast(pa.binary()).to_pylist() for c in ("text_u", "text_v"))
                ok = pa.array([alike(a, b, size, share) for a, b in zip(*texts)], pa.bool_())
                yield pa.RecordBatch.from_arrays([part.column("u"), part.column("v")], names=["u", "v"]).filter(ok)
    return run


#: Texts up to whose number their hashes are broadcast to the texts; more are joined by a shuffle.
BROADCAST = 1 << 20


def confirmed(texts: DataFrame, links: DataFrame, size: int, share: float) -> DataFrame:
    """The links whose texts (text_hash, text) have ``share`` of their shingles in common."""
    ends = settled(links.select(F.explode(F.array("u", "v")).alias("text_hash")).distinct())
    near = F.broadcast(ends) if ends.count() <= BROADCAST else ends
    # The text of each linked hash once.
    linked = settled(texts.join(near, "text_hash", "left_semi").groupBy("text_hash").agg(F.min("text").alias("text")))
    sides = [linked.select(F.col("text_hash").alias(c), F.col("text").alias(f"text_{c}")) for c in "uv"]
    both = links.join(sides[0], "u").join(sides[1], "v").select("u", "v", "text_u", "text_v")
    return both.mapInArrow(_checked(size, share), "u long, v long")


def missed_links(placed: DataFrame, share: float) -> DataFrame:
    """(u, v): all pairs of ``placed`` (text_hash, root, weight, n, prefix) with different roots that may have ``share`` of
    their ``n`` shingles in common.

    Of the roots at a shingle that of most texts (``weight``) meets the others and none of its own, so a large group
    costs no more than its neighbours are many.
    """
    rows = placed.select(F.col("text_hash").alias("node"), "root", "weight", "n", F.posexplode("prefix").alias("place", "shingle"))
    at = Window.partitionBy("shingle")
    shared = settled(
        rows.select("*", F.min("root").over(at).alias("low"), F.max("root").over(at).alias("high"),
                    F.max(F.struct("weight", "root")).over(at)["root"].alias("most"))
        .where(F.col("low") < F.col("high"))
        .select("shingle", "node", "root", (F.col("n") - F.col("place")).alias("rest"), "n", (F.col("root") == F.col("most")).alias("most")))
    a, b = shared.where(~F.col("most")).alias("a"), shared.alias("b")
    # The first shingle that both hold leaves room for enough more.
    room = F.least("a.rest", "b.rest") * (1 + share) >= share * (F.col("a.n") + F.col("b.n")) - 1e-6
    other = F.col("b.most") | (F.col("a.root") < F.col("b.root"))
    return (a.join(b, (F.col("a.shingle") == F.col("b.shingle")) & (F.col("a.root") != F.col("b.root")) & other & room)
            .select(F.least("a.node", "b.node").alias("u"), F.greatest("a.node", "b.node").alias("v")).distinct())


def near_copies(docs: DataFrame, size: int = SHINGLE, share: float = SHARE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, text_hash, root, component_id) for every row of ``docs``; ``root`` names the component."""
    texts = with_text(docs).withColumn("text_hash", F.xxhash64("text"))
    marked = texts.mapInArrow(_marks(size, share, shingle_counts(texts, size)),
                              "doc_id long, text_hash long, mark binary, n int, prefix array<long>")
    distinct = settled(marked.groupBy("text_hash").agg(
        F.min("doc_id").alias("least"), F.min("mark").alias("mark"), F.min("n").alias("n"), F.min("prefix").alias("prefix")))
    links = settled(candidate_links(distinct.select("text_hash", "mark"), radius).distinct())
    roots = components(confirmed(texts, links, size, share)).withColumnRenamed("node", "text_hash")
    weights = roots.groupBy("root").agg(F.count(F.lit(1)).alias("weight"))
    members = distinct.select("text_hash", "least").join(roots, "text_hash", "left").select(
        "text_hash", "least", F.coalesce("root", "text_hash").alias("root"))
    placed = distinct.join(roots.join(weights, "root"), "text_hash", "left").select(
        "text_hash", F.coalesce("root", "text_hash").alias("root"), F.coalesce("weight", F.lit(1).cast("long")).alias("weight"), "n", "prefix")
    # Links between groups: their roots are joined once more.
    more = confirmed(texts, settled(missed_links(placed, share)), size, share)
    ends = [members.select(F.col("text_hash").alias(c), F.col("root").alias(f"root_{c}")) for c in "uv"]
    upper = components(more.join(ends[0], "u").join(ends[1], "v").select(F.col("root_u").alias("u"), F.col("root_v").alias("v")))
    members = members.join(upper.select(F.col("node").alias("root"), F.col("root").alias("upper")), "root", "left").select(
        "text_hash", "least", F.coalesce("upper", "root").alias("root"))
    ids = members.groupBy("root").agg(F.min("least").alias("component_id"))
    found = members.join(ids, "root").select("text_hash", "root", "component_id")
    return texts.select("doc_id", "text_hash").join(found, "text_hash").select("doc_id", "text_hash", "root", "component_id")
