"""Benchmark decontamination: spaced-seed hashing.

A mask names the word offsets that a hash covers and so ignores the words between them.  Hashes of
all benchmark positions and of all document positions are joined; around each hit the two word
sequences are compared place by place, and a window of ``window`` words that covers the hit and
agrees in ``share`` of its places is contamination.  The two default masks of five words hit every
20-word window with up to four substituted words, wherever those lie.  Items under 16 words are hashed
by a mask of three words too, which meets each of them under every allowed substitution.

Defined results: null and empty texts have no words and match nothing; items shorter than the
window are compared whole; items shorter than a mask are hashed and matched as one exact run of
their own length; repeated items each report; documents are told apart by doc_id and text.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, bitmap_of, chunks, in_bitmap, mix, settled, table, with_text

MASKS = ((0, 1, 2, 4, 5), (0, 1, 3, 5, 6))
#: The mask for items of fewer words than ``SHORT``; among 15 words three substitutions leave three in a row.
SHORT_MASK, SHORT = (0, 1, 2), 16
WINDOW, SHARE = 20, 0.8
BITS = 26
FACTORS = mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def _seeds(words: Words, masks) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each mask the hashes and the words they begin at, inside one text each."""
    out = []
    n = len(words.start)
    left = np.repeat(words.first[1:], np.diff(words.first)) - np.arange(n)  # words up to the text's end
    for mask in masks:
        span = mask[-1] + 1
        at = np.flatnonzero(left >= span)
        total = np.zeros(len(at), np.uint64)
        for k, offset in enumerate(mask):
            total += words.hash[at + offset] * FACTORS[k]
        out.append((mix(total + np.uint64(sum(1 << o for o in mask))), at))
    return out


def _narrow(words: Words) -> np.ndarray:
    return (words.hash >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _slices(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.Array:
    length = end - begin
    offsets = np.concatenate([[0], np.cumsum(length)])
    place = np.arange(offsets[-1]) - np.repeat(offsets[:-1] - begin, length)
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values[place]))


def _item_seeds(masks, window):
    def run(batches):
        for batch in chunks(batches):
            words = Words(batch.column("text"))
            narrow, count = _narrow(words), np.diff(words.first)
            top = max(m[-1] for m in masks) + 1
            tiny = sorted({int(c) for c in count if 0 < c < top})
            uses = [(mask, lambda c: c > 0) for mask in masks] + [(SHORT_MASK, lambda c: (c >= top) & (c < SHORT))]
            uses += [(tuple(range(n)), lambda c, n=n: c == n) for n in tiny]
            for mask, of in uses:
                for hashes, at in _seeds(words, [mask]):
                    row = words.row[at]
                    use = of(count[row])
                    hashes, at, row = hashes[use], at[use], row[use]
                    begin = np.maximum(words.first[row], at - window)
                    end = np.minimum(words.first[row + 1], at + window)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(hashes.view(np.int64)), batch.column("item_id").take(pa.array(row)),
                        pa.array((at - words.first[row]).astype(np.int32)), pa.array((at - begin).astype(np.int32)),
                        pa.array(count[row].astype(np.int32)), pa.array(np.full(len(at), mask[-1] + 1, np.int32)),
                        _slices(narrow, begin, end)],
                        names=["seed", "item_id", "item_pos", "item_left", "item_words", "span", "item_tokens"])
    return run


def _doc_seeds(masks, window, bitmap, bits):
    def run(batches):
        kept = bitmap.value
        for batch in chunks(batches):
            words = Words(batch.column("text"))
            if not len(words.start):
                continue
            narrow = _narrow(words)
            for hashes, at in _seeds(words, masks):
                hit = in_bitmap(kept, bits, hashes)
                hashes, at = hashes[hit], at[hit]
                if not len(at):
                    continue
                row = words.row[at]
                begin = np.maximum(words.first[row], at - window)
                end = np.minimum(words.first[row + 1], at + window)
                yield pa.RecordBatch.from_arrays([
                    pa.array(hashes.view(np.int64)), batch.column("doc_id").take(pa.array(row)),
                    batch.column("text_hash").take(pa.array(row)),
                    pa.array((at - words.first[row]).astype(np.int32)), pa.array((at - begin).astype(np.int32)),
                    _slices(narrow, begin, end)],
                    names=["seed", "doc_id", "text_hash", "doc_pos", "doc_left", "doc_tokens"])
    return run


def _verify(window: int, share: float):
    def run(item_left: pd.Series, doc_left: pd.Series, item_tokens: pd.Series, doc_tokens: pd.Series,
            span: pd.Series, item_words: pd.Series) -> pd.DataFrame:
        begins, sizes, equal = [], [], []
        for il, dl, it, dt, sp, n in zip(item_left, doc_left, item_tokens, doc_tokens, span, item_words):
            back = min(il, dl)
            a, b = it[il - back:], dt[dl - back:]
            m = min(len(a), len(b))
            same = np.concatenate([[0], np.cumsum(np.asarray(a[:m]) == np.asarray(b[:m]))])
            size = min(window, n)
            first, last = max(0, back + sp - size), min(back, m - size)
            best, where = -1, 0
            if last >= first:
                sums = same[first + size:last + size + 1] - same[first:last + 1]
                where = int(np.argmax(sums))
                best, where = int(sums[where]), first + where
            good = best >= share * size
            begins.append(where - back if good else 0)
            sizes.append(size if good else 0)
            equal.append(best if good else 0)
        return pd.DataFrame({"shift": begins, "size": sizes, "equal": equal})
    return F.pandas_udf(run, "shift int, size int, equal int")


def contaminated(docs: DataFrame, benchmark: DataFrame, masks=MASKS, window: int = WINDOW,
                 share: float = SHARE, bits: int = BITS) -> DataFrame:
    """(doc_id, text_hash, item_id, first_word, last_word, window_words, equal_words, n_windows).

    A document position is written and shuffled only if a bitmap of fixed size (2**bits bits) may hold its
    hash; the join behind it is exact, so the bitmap saves work and decides nothing.
    """
    spark = docs.sparkSession
    masks = tuple(tuple(m) for m in masks)
    items = (benchmark.select(F.col("item_id").cast("long").alias("item_id"),
                              F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
             .mapInArrow(_item_seeds(masks, window),
                         "seed long, item_id long, item_pos int, item_left int, item_words int, span int, item_tokens array<int>"))
    top = max(m[-1] for m in masks) + 1
    lengths = [r[0] for r in items.where(F.col("item_words") < SHORT).select("item_words").distinct().collect()]  # at most 15
    more = {tuple(range(n)) for n in lengths if n < top} | {SHORT_MASK for n in lengths if n >= top}
    bitmap = spark.sparkContext.broadcast(bitmap_of(items, "seed", bits))
    # Written first: else each task holds a Python worker for the hashes and another for the comparison.
    found = settled(with_text(docs).withColumn("text_hash", F.xxhash64("text"))
                    .mapInArrow(_doc_seeds((*masks, *sorted(more - set(masks))), window, bitmap, bits),
                                "seed long, doc_id long, text_hash long, doc_pos int, doc_left int, doc_tokens array<int>"))
    pairs = found.join(items, "seed").withColumn(
        "v", _verify(window, share)("item_left", "doc_left", "item_tokens", "doc_tokens", "span", "item_words"))
    return (pairs.where(F.col("v.size") > 0)
            .select("doc_id", "text_hash", "item_id", (F.col("doc_pos") + F.col("v.shift")).alias("at"), F.col("v.size").alias("size"),
                    F.col("v.equal").alias("equal"))
            .groupBy("doc_id", "text_hash", "item_id")
            .agg(F.min("at").alias("first_word"), F.max(F.col("at") + F.col("size") - 1).alias("last_word"),
                 F.max("size").alias("window_words"), F.max("equal").alias("equal_words"),
                 F.count_distinct("at").alias("n_windows")))


def op2_decontamination(spark, sf_dir):
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_hash")
