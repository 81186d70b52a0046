"""Substring dedup: hash sentence-sized units of every line, keep each unit's earliest occurrence.

A text is cut at line breaks and after ``. ! ?`` before a blank; a unit is normalised to its words
in lower case, without punctuation.  What is longer than 64 words is cut once more, after words
whose hash says so and at 64 words at the latest, so no unit is longer.  Equal units (128-bit
digests) are ranked by document, then place.  A later occurrence is extended, word by word, over
what equals the words beside its kept occurrence, as far as the next unit reaches; so passages cut
inside sentences go with their rests.  Touching stretches are merged, and what holds ``min_words``
repeated words or more is removed.  Pieces of fewer than ``unit_words`` words are joined with such
pieces beside them; what is still shorter is not compared by itself: it is removed only as part of
an extension, and it does not keep the words on either side from being counted together.  So the
text beside a unit that travels with it is bounded too.  No extension enters a unit of which this
is the kept occurrence.

Loops (up to eight words said over and over) have no unit to begin with: of each, what follows the
first round goes if it has ``min_words`` words or more, be it inside a kept unit or not.

With ``unit_words=1, min_words=1`` every later sentence goes, however short.

Defined results: null and empty texts have no units; rows without doc_id rank last; rows that
repeat a doc_id are told apart by a hash of their text, and fully equal rows get the same spans;
offsets are code points of the original text, end exclusive; ``n_units`` is 0 for a loop alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Words, bitmap_of, chunks, in_bitmap, mix, powers, settled, table, with_text

BITMAP_BITS = 26
UNIT_LIMIT = 64  # words of a unit at most
LOOP_WORDS = 8  # words that a loop repeats at most
UNIT_SCHEMA = "doc_id long, text_hash long, unit int, h1 long, h2 long"
#: ``again``: whether the unit stands earlier in its own text; ``first``, ``last``: words of the text; ``before``, ``after``: the text beside the unit up to the far end of the
#: next unit; ``*_short``: how many of its words lie in short units between.
PLACE_SCHEMA = (UNIT_SCHEMA + ", again boolean, start int, end int, first int, last int, before string, before_short int, "
                "after string, after_short int")


def _lengths(begins: np.ndarray):
    head = np.flatnonzero(begins)
    return head, np.diff(np.append(head, len(begins)))


def _cut(words: Words, unit_words: int):
    """First word, length and digests of the units of many texts."""
    n = len(words.start)
    sentence_end = np.zeros(256, bool)
    sentence_end[[ord(c) for c in ".!?"]] = True
    gap = np.zeros(n, bool)  # whether a unit begins at the word
    gap[words.first[:-1][words.first[:-1] < n]] = True
    data = words.data
    newline = np.cumsum(data == 10)
    gap[1:] |= newline[words.start[1:]] != newline[words.start[:-1]]
    stops = sentence_end[data]
    stops[:-1] &= (data[1:] == 32) | (data[1:] == 9) | (data[1:] == 13)
    stopped = np.cumsum(stops)
    gap[1:] |= stopped[words.start[1:]] != stopped[words.start[:-1]]
    head, length = _lengths(gap)
    if int(length.max()) > UNIT_LIMIT:
        long = np.repeat(length > UNIT_LIMIT, length)
        gap[1:] |= long[1:] & ((words.hash[:-1] >> np.uint64(40)) % np.uint64(UNIT_LIMIT // 4) == 0)
        head, length = _lengths(gap)
        gap |= (np.arange(n) - np.repeat(head, length)) % UNIT_LIMIT == 0
        head, length = _lengths(gap)
    head = head[_joined(head, length < unit_words, words.row, unit_words)]
    length = np.diff(np.append(head, n))
    order = powers(int(length.max()))[np.arange(n) - np.repeat(head, length)]
    h1 = mix(np.add.reduceat(words.hash * order, head) + length.astype(np.uint64))
    h2 = mix(np.add.reduceat(mix(words.hash ^ np.uint64(0xA5A5)) * order, head) ^ np.uint64(0x5A5A))
    return head, length, h1, h2


def _joined(head: np.ndarray, short: np.ndarray, row: np.ndarray, unit_words: int) -> np.ndarray:
    """Which pieces still begin a unit when neighbouring short ones are joined to about ``unit_words`` words."""
    follows = np.zeros(len(head), bool)  # a short piece behind a short piece of the same text
    follows[1:] = short[1:] & short[:-1] & (row[head[1:]] == row[head[:-1]])
    origin = head[np.maximum.accumulate(np.where(follows, 0, np.arange(len(head))))]
    group = (head - origin) // unit_words
    begins = ~follows
    begins[1:] |= group[1:] != group[:-1]
    return begins


def _said_again(row, h1, h2) -> np.ndarray:
    """Which units stand earlier in their own text."""
    order = np.lexsort((np.arange(len(row)), h2, h1, row))
    again = np.zeros(len(row), bool)
    again[order[1:]] = (np.diff(row[order]) == 0) & (h1[order[1:]] == h1[order[:-1]]) & (h2[order[1:]] == h2[order[:-1]])
    return again


def _loop_batches(min_words: int):
    def find(batches):
        for batch in chunks(batches):
            words = Words(batch.column("text"))
            n = len(words.start)
            period = np.zeros(n + 1, np.int64)  # 0: the word continues no loop
            for p in range(1, min(LOOP_WORDS, n - 1) + 1):
                same = np.zeros(n + 2, np.int8)
                same[p + 1:n + 1] = (words.hash[p:] == words.hash[:-p]) & (words.row[p:] == words.row[:-p])
                turn = np.diff(same)
                begin, end = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)
                enough = end - begin >= max(min_words, p)
                for a, b in zip(begin[enough].tolist(), end[enough].tolist()):
                    part = period[a:b]
                    part[part == 0] = p
            inside = np.zeros(n + 2, np.int8)
            inside[1:n + 1] = period[:n] > 0
            # Loops of two texts do not touch: the first word of a text continues nothing.
            turn = np.diff(inside)
            begin, end = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)
            if not len(begin):
                continue
            row = words.row[begin]
            first, zero = begin - words.first[row], np.zeros(len(begin), np.int32)
            start = pa.array(words.code_points(words.start[begin], row).astype(np.int32))
            stop = pa.array(words.code_points(words.end[end - 1], row).astype(np.int32))
            at = pa.array(row)
            doc, zero = batch.column("doc_id").take(at), pa.array(zero)
            yield pa.RecordBatch.from_arrays(
                [doc, batch.column("text_hash").take(at), pa.array((-1 - first).astype(np.int32)), start, stop,
                 pa.array(first.astype(np.int32)), pa.array((end - words.first[row]).astype(np.int32)),
                 pa.array(np.zeros(len(begin), bool)), doc,
                 pa.array(words.code_points(words.start[begin - period[begin]], row).astype(np.int32)),
                 zero, start, zero, start, zero, stop, zero, stop],
                names=EXTENDED_NAMES)

    return find


def _slices(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.Array:
    whole = data.tobytes()
    return pa.array([whole[a:b] for a, b in zip(begin.tolist(), end.tolist())], pa.binary()).cast(pa.string())


def _unit_batches(unit_words: int, bitmap=None):
    def cut(batches):
        for batch in chunks(batches):
            words = Words(batch.column("text"))
            if not len(words.start):
                continue
            head, length, h1, h2 = _cut(words, unit_words)
            keep = length >= unit_words
            head, length, h1, h2 = head[keep], length[keep], h1[keep], h2[keep]
            row = words.row[head]
            tail = head + length
            first = np.searchsorted(row, np.arange(batch.num_rows))
            unit = np.arange(len(row)) - first[row]
            use = np.arange(len(row)) if bitmap is None else np.flatnonzero(in_bitmap(bitmap.value, BITMAP_BITS, h1))
            if not len(use):
                continue
            at = pa.array(row[use])
            columns = [batch.column("doc_id").take(at), batch.column("text_hash").take(at), pa.array(unit[use].astype(np.int32)),
                       pa.array(h1[use].view(np.int64)), pa.array(h2[use].view(np.int64))]
            names = ["doc_id", "text_hash", "unit", "h1", "h2"]
            if bitmap is not None:
                begin, end = words.first[row], words.first[row + 1]
                same = row[1:] == row[:-1]
                far_left, near_left, near_right, far_right = begin.copy(), begin.copy(), end.copy(), end.copy()
                far_left[1:], near_left[1:] = np.where(same, head[:-1], begin[1:]), np.where(same, tail[:-1], begin[1:])
                near_right[:-1], far_right[:-1] = np.where(same, head[1:], end[:-1]), np.where(same, tail[1:], end[:-1])
                u, after = use, words.end[tail[use] - 1]
                columns += [
                    pa.array(_said_again(row, h1, h2)[u]),
                    pa.array(words.code_points(words.start[head[u]], row[u]).astype(np.int32)),
                    pa.array(words.code_points(after, row[u]).astype(np.int32)),
                    pa.array((head - begin)[u].astype(np.int32)), pa.array((tail - begin)[u].astype(np.int32)),
                    _slices(words.data, words.start[far_left[u]], words.start[head[u]]),
                    pa.array((head - near_left)[u].astype(np.int32)),
                    _slices(words.data, after, words.end[far_right[u] - 1]),
                    pa.array((near_right - tail)[u].astype(np.int32))]
                names += ["again", "start", "end", "first", "last", "before", "before_short", "after", "after_short"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return cut


def units(docs: DataFrame, unit_words: int = 3) -> DataFrame:
    return (with_text(docs).withColumn("text_hash", F.xxhash64("text"))
            .mapInArrow(_unit_batches(unit_words), UNIT_SCHEMA))


def _places(docs: DataFrame, repeated: DataFrame, unit_words: int) -> DataFrame:
    """The units whose digest may be among ``repeated``, with their offsets and the text beside them."""
    bitmap = docs.sparkSession.sparkContext.broadcast(bitmap_of(repeated, "h1", BITMAP_BITS))
    return (with_text(docs).withColumn("text_hash", F.xxhash64("text"))
            .mapInArrow(_unit_batches(unit_words, bitmap), PLACE_SCHEMA))


SIDES = ("left", "left_near", "right", "right_near")


def _equal(mine: pa.Array, kept: pa.Array, short: np.ndarray, back: bool):
    """Words equal from the unit outwards and the code points they span: all, and those of short units alone."""
    a, b = Words(mine), Words(kept)
    size, other = np.diff(a.first), np.diff(b.first)
    n = np.zeros(len(size), np.int64)
    step = -1 if back else 1
    going = np.flatnonzero(np.minimum(size, other) > 0)
    while len(going):
        k = n[going]
        at, to = (a.first[going + 1] - 1 - k, b.first[going + 1] - 1 - k) if back else (a.first[going] + k, b.first[going] + k)
        going = going[a.hash[at] == b.hash[to]]
        n[going] += 1
        going = going[n[going] < np.minimum(size, other)[going]]
    out = []
    for count in (n, np.minimum(n, short)):
        span = np.zeros(len(n), np.int64)
        some = np.flatnonzero(count)
        if len(some):
            if back:
                at = a.start[a.first[some + 1] - count[some]]
                span[some] = a.code_points(a.bounds[some + 1], some) - a.code_points(at, some)
            else:
                span[some] = a.code_points(a.end[a.first[some] + count[some] - 1], some)
        out += [count, step * span]
    return out


EXTENDED_SCHEMA = ("doc_id long, text_hash long, unit int, start int, end int, first int, last int, kept boolean, keep_doc_id long, "
                   "keep_start int, " + ", ".join(f"{s} int, {s}_at int" for s in SIDES))
EXTENDED_NAMES = [column.split()[0] for column in EXTENDED_SCHEMA.split(", ")]


def _extend(batches):
    """How many words beside each unit equal those beside its kept occurrence, and the offset they reach:
    all of them, and (``near``) those of short units before the next one alone."""
    plain = ["doc_id", "text_hash", "unit", "start", "end", "first", "last", "kept", "keep_doc_id", "keep_start"]
    for whole in batches:
        for k in range(0, whole.num_rows, 1024):
            batch = whole.slice(k, 1024)
            out = []
            for name, edge, back in (("before", "start", True), ("after", "end", False)):
                n, span, near, near_span = _equal(batch.column(name), batch.column(f"kept_{name}"),
                                                  batch.column(f"{name}_short").to_numpy(), back)
                at = batch.column(edge).to_numpy()
                out += [pa.array(x.astype(np.int32)) for x in (n, at + span, near, at + near_span)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in plain] + out, names=plain + [n for s in SIDES for n in (s, f"{s}_at")])


def _loops(docs: DataFrame, min_words: int) -> DataFrame:
    """What follows the first round of a loop, as rows of ``_extend``; such a row has a ``unit`` below -1."""
    return (with_text(docs).withColumn("text_hash", F.xxhash64("text"))
            .mapInArrow(_loop_batches(min_words), EXTENDED_SCHEMA))


def repeated_spans(docs: DataFrame, min_words: int = 8, unit_words: int = 3) -> DataFrame:
    """(doc_id, text_hash, start, end, n_words, n_units, keep_doc_id, keep_start): what to remove.

    ``keep_*`` is the kept occurrence of the span's first unit.  Digests are counted before the
    shuffle; the join back on the digest has no group to gather, so a frequent unit can be split.
    """
    rank = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash", "unit")
    repeated = settled(units(docs, unit_words).groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min(rank).alias("first"))
                       .where(F.col("n") > 1)
                       .select("h1", "h2", F.col("first.doc_id").alias("keep_doc_id"),
                               F.col("first.text_hash").alias("keep_hash"), F.col("first.unit").alias("keep_unit")))
    places = _places(docs, repeated, unit_words)
    # One place a digest: its kept one, found by its own place, which no other digest shares.
    # Written, so that both sides of the join on the digest are shuffled: then Spark splits a frequent unit's rows.
    # What its own text has said before is no kept one, and is not shuffled for it.
    kept = settled(repeated.join(places.where(~F.col("again")).withColumnRenamed("h1", "k1").withColumnRenamed("h2", "k2"),
                          (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2")) & (F.col("text_hash") == F.col("keep_hash"))
                          & (F.col("unit") == F.col("keep_unit")) & F.col("doc_id").eqNullSafe(F.col("keep_doc_id")))
            .select("h1", "h2", "keep_doc_id", "keep_hash", "keep_unit", F.col("start").alias("keep_start"),
                    F.col("before").alias("kept_before"), F.col("after").alias("kept_after"))
            .dropDuplicates(["h1", "h2"]))
    is_kept = (F.col("doc_id").eqNullSafe(F.col("keep_doc_id")) & (F.col("text_hash") == F.col("keep_hash"))
               & (F.col("unit") == F.col("keep_unit")))
    found = (places.join(kept, ["h1", "h2"]).withColumn("kept", is_kept).drop("h1", "h2", "keep_hash", "keep_unit", "again")
             .mapInArrow(_extend, EXTENDED_SCHEMA).unionAll(_loops(docs, min_words)).repartition("doc_id", "text_hash").dropDuplicates(["doc_id", "text_hash", "unit"]))

    doc = Window.partitionBy("doc_id", "text_hash").orderBy("unit")
    for side, place, step, edge in (("left", F.lag, -1, "first"), ("right", F.lead, 1, "last")):
        barred = place("kept").over(doc) & (place("unit").over(doc) == F.col("unit") + step)
        found = found.withColumn(f"{side}_barred", F.coalesce(barred, F.lit(False)))
    later = found.where(~F.col("kept")).select(
        "doc_id", "text_hash", "unit", "keep_doc_id", "keep_start",
        (F.col("first") - F.when(F.col("left_barred"), F.col("left_near")).otherwise(F.col("left"))).alias("first"),
        F.when(F.col("left_barred"), F.col("left_near_at")).otherwise(F.col("left_at")).alias("start"),
        (F.col("last") + F.when(F.col("right_barred"), F.col("right_near")).otherwise(F.col("right"))).alias("last"),
        F.when(F.col("right_barred"), F.col("right_near_at")).otherwise(F.col("right_at")).alias("end"))

    place = Window.partitionBy("doc_id", "text_hash").orderBy("first", "unit")
    reached = F.max("last").over(place.rowsBetween(Window.unboundedPreceding, -1))
    runs = (later.withColumn("gap", F.col("first") - reached)
            .withColumn("span", F.sum(F.when(F.col("gap") <= 0, 0).otherwise(1)).over(place))
            .withColumn("run", F.sum(F.when(F.col("gap") < unit_words, 0).otherwise(1)).over(place)))
    spans = (runs.groupBy("doc_id", "text_hash", "run", "span")
             .agg(F.min("start").alias("start"), F.max("end").alias("end"),
                  (F.max("last") - F.min("first")).cast("long").alias("n_words"), F.count_if(F.col("unit") >= 0).alias("n_units"),
                  F.min_by(F.struct("keep_doc_id", "keep_start"), F.struct("first", "unit")).alias("keep")))
    total = F.sum("n_words").over(Window.partitionBy("doc_id", "text_hash", "run"))
    return (spans.withColumn("total", total).where(F.col("total") >= min_words)
            .select("doc_id", "text_hash", "start", "end", "n_words", "n_units", "keep.keep_doc_id", "keep.keep_start"))


def remove_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with the spans cut out, and the spans' original offsets in ``removed``."""
    d = with_text(docs).withColumn("text_hash", F.xxhash64("text"))
    cuts = (spans.groupBy(F.col("doc_id").alias("cut_doc"), F.col("text_hash").alias("cut_hash"))
            .agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("removed")))
    joined = d.join(cuts, F.col("doc_id").eqNullSafe(F.col("cut_doc")) & (F.col("text_hash") == F.col("cut_hash")), "left")
    rest = F.aggregate(
        "removed", F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda a, x: F.struct(F.concat(a["out"], F.substring(F.col("text"), a["at"] + 1, x["start"] - a["at"])).alias("out"),
                              x["end"].alias("at")),
        lambda a: F.concat(a["out"], F.substring(F.col("text"), a["at"] + 1, F.char_length("text"))))
    return joined.select("doc_id", F.coalesce(rest, F.col("text")).alias("text"), "removed")


def op1_substring_dedup(spark, sf_dir):
    return repeated_spans(table(spark, sf_dir, "documents"))
