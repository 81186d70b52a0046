"""Language ID: prediction by partial matching over bytes.

Each language has a byte context tree of order 3 whose counts are frozen after training.  A byte
costs -log2 of its share in the longest context that has seen it, plus the escapes out of the
longer ones (escape = distinct / (total + distinct), symbol = count / (total + distinct)); what no
context has seen costs 8 bits.  The language with the shortest code wins; the score is its share
under equal priors, 2**-length over the sum.

Texts are read whole as UTF-8 bytes, A-Z lower-cased and each run of ASCII non-letters as one blank.

Defined results: a null text, or one without a letter, is ``und`` with score 0; ties go to the
language first in order; with nothing to learn from every text is ``und``; rows without doc_id are
held out; repeated rows get equal results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks, flat, table

#: Expected number of training documents a language: those whose hashed id is lowest are used, whole.
DOCS_PER_LANGUAGE = 1500
ORDER = 3


def _classes() -> np.ndarray:
    lut = np.full(256, 32, np.uint8)
    lut[97:123] = np.arange(97, 123)
    lut[65:91] = np.arange(97, 123)
    lut[128:] = np.arange(128, 256)
    return lut


CLASSES = _classes()


def _stream(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Grams (4 bytes as one number, the last is the symbol), the text of each, and whether the text
    has an ASCII letter.  Every text is preceded by blanks."""
    data, bounds = flat(column)
    low = CLASSES[data]
    keep = low != 32
    keep[1:] |= low[:-1] != 32
    first = bounds[:-1][bounds[:-1] < len(data)]
    keep[first] = True
    n = np.concatenate([[0], np.cumsum(keep)])[bounds]
    counts = np.diff(n)
    rows = np.repeat(np.arange(len(counts)), counts)
    out = np.full(n[-1] + 3 * len(counts), 32, np.uint32)
    place = np.arange(n[-1]) + 3 * (rows + 1)
    out[place] = low[keep]
    gram = (out[place - 3] << np.uint32(24)) | (out[place - 2] << np.uint32(16)) | (out[place - 1] << np.uint32(8)) | out[place]
    return gram, rows, n


def _gram_counts(batches):
    for batch in chunks(batches):
        langs = pc.dictionary_encode(batch.column("lang"))
        gram, rows, _ = _stream(batch.column("text"))
        code = langs.indices.to_numpy(zero_copy_only=False).astype(np.uint64)[rows]
        found, count = np.unique((code << np.uint64(32)) | gram.astype(np.uint64), return_counts=True)
        yield pa.RecordBatch.from_arrays([
            langs.dictionary.take(pa.array((found >> np.uint64(32)).astype(np.int64))),
            pa.array((found & np.uint64(0xFFFFFFFF)).astype(np.int64)), pa.array(count.astype(np.int64))],
            names=["lang", "gram", "n"])


class Model:
    """Frozen costs in bits.  ``keys[k]``: the grams of k context bytes and a symbol that any language
    has seen; ``costs[k]``: their cost in each language; ``contexts[k]``: contexts and their escapes."""

    def __init__(self, langs: list[str], lang: np.ndarray, gram: np.ndarray, n: np.ndarray):
        self.langs = langs
        self.keys, self.costs, self.contexts = {}, {}, {}
        for k in range(ORDER + 1):
            keys, place = np.unique(gram & np.uint64((1 << 8 * (k + 1)) - 1), return_inverse=True)
            count = np.zeros((len(keys), len(langs)))
            np.add.at(count, (place, lang), n)
            ctx, where = np.unique(keys >> np.uint64(8), return_inverse=True)
            total, distinct = np.zeros((2, len(ctx), len(langs)))
            np.add.at(total, where, count)
            np.add.at(distinct, where, count > 0)
            escape = np.where(total > 0, np.log2((total + distinct) / np.maximum(distinct, 1) + (total == 0)), 0.0)
            own = np.log2((total + distinct)[where] / np.maximum(count, 1) + (count == 0))
            shorter = self._at(k - 1, keys & np.uint64((1 << 8 * k) - 1)) if k else 8.0
            self.keys[k] = keys.astype(np.uint32)
            self.contexts[k] = ctx.astype(np.uint32), escape
            self.costs[k] = np.where(count > 0, own, escape[where] + shorter)
        self.costs[ORDER] = self.costs[ORDER].astype(np.float32)

    @classmethod
    def restored(cls, state: dict | None) -> Model | None:
        """The model out of its plain arrays (what is broadcast)."""
        if state is None:
            return None
        model = cls.__new__(cls)
        vars(model).update(state)
        return model

    def _escape(self, k: int, context: np.ndarray) -> np.ndarray:
        ctx, esc = self.contexts[k]
        at = np.minimum(np.searchsorted(ctx, context.astype(np.uint32)), len(ctx) - 1)
        return np.where((ctx[at] == context)[:, None], esc[at], 0.0)

    def _at(self, k: int, gram: np.ndarray) -> np.ndarray:
        """Costs after a context of k bytes, by the longest context that knows the byte."""
        gram = gram.astype(np.uint32)
        keys = self.keys[k]
        at = np.minimum(np.searchsorted(keys, gram), len(keys) - 1)
        seen = keys[at] == gram
        out = self.costs[k][at]
        if not seen.all():
            out = np.array(out, np.float64)
            miss = gram[~seen]
            escape = self._escape(k, miss >> np.uint32(8))
            out[~seen] = escape + (self._at(k - 1, miss & np.uint32((1 << 8 * k) - 1)) if k else 8.0)
        return out

    SLOTS = 21

    def lookup(self):
        """A hash table of slots over the grams: (slot -> row, gram in the slot)."""
        keys = self.keys[ORDER]
        slot = (keys * np.uint32(2654435761)) >> np.uint32(32 - self.SLOTS)
        row = np.zeros(1 << self.SLOTS, np.int32)
        row[slot] = np.arange(len(keys))
        return row

    def bits(self, column: pa.Array, row_of_slot: np.ndarray) -> np.ndarray:
        """Code length of each text in each language."""
        gram, _, n = _stream(column)
        out = np.zeros((len(n) - 1, len(self.langs)))
        if not len(gram):
            return out
        slot = (gram * np.uint32(2654435761)) >> np.uint32(32 - self.SLOTS)
        row = row_of_slot[slot]
        cost = self.costs[ORDER][row]
        miss = np.flatnonzero(self.keys[ORDER][row] != gram)
        if len(miss):
            cost[miss] = self._at(ORDER, gram[miss])
        full = np.flatnonzero(np.diff(n) > 0)
        out[full] = np.add.reduceat(cost, n[:-1][full], axis=0, dtype=np.float64)
        return out


def train(docs: DataFrame, per_language: int = DOCS_PER_LANGUAGE) -> Model | None:
    """Counts of all grams of the sampled documents (whole texts); only the counts reach the driver."""
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r[0]: r[1] for r in usable.groupBy("lang").count().collect()}
    if not sizes:
        return None
    share = F.create_map(*[F.lit(x) for lang, n in sorted(sizes.items()) for x in (lang, min(1.0, per_language / n))])
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share[F.col("lang")] * float(1 << 30)
    grams = (usable.where(drawn).select("lang", "text").mapInArrow(_gram_counts, "lang string, gram long, n long")
             .groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow())
    langs = sorted(set(grams.column("lang").to_pylist()))
    if not langs:
        return None
    order = np.lexsort((grams.column("gram").to_numpy(), np.array(grams.column("lang").to_pylist())))
    code = np.searchsorted(np.array(langs), np.array(grams.column("lang").to_pylist()))
    return Model(langs, code[order], grams.column("gram").to_numpy()[order].astype(np.uint64), grams.column("n").to_numpy()[order])


def _has_letter(text) -> bool:
    return text is not None and any(c.isalpha() for c in text)


def _letters(text: pa.Array) -> np.ndarray:
    ascii_letter = pc.fill_null(pc.match_substring_regex(text, "[A-Za-z]"), False).to_numpy(zero_copy_only=False)
    letter = ascii_letter.copy()
    for i in np.flatnonzero(~ascii_letter):
        letter[i] = _has_letter(text[int(i)].as_py())
    return letter


def _predict(shared):
    def run(batches):
        model = Model.restored(shared.value)
        rows = model.lookup() if model else None
        for batch in chunks(batches):
            text = batch.column("text")
            letter = _letters(text)
            if model is None:
                best, share = np.zeros(len(letter), int), np.zeros(len(letter))
                names = np.array(["und"])
                letter[:] = False
            else:
                bits = model.bits(text, rows)
                best = bits.argmin(axis=1)
                share = 1.0 / np.exp2(np.minimum(bits.min(axis=1, keepdims=True) - bits, 0.0)).sum(axis=1)
                names = np.array(model.langs)
            lang = np.where(letter, names[best], "und")
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(lang.tolist(), pa.string()),
                 pa.array(np.where(letter, share, 0.0))], names=["doc_id", "held_out", "lang_pred", "score"])
    return run


def held_out() -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def narrow(docs: DataFrame, *more: str) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       *(F.col(c).cast("string").alias(c) for c in more), held_out().alias("held_out"))


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model) if model else None)
    return narrow(docs).mapInArrow(_predict(shared), "doc_id long, held_out boolean, lang_pred string, score double")


def fit(docs: DataFrame) -> Model | None:
    return train(narrow(docs, "lang").where(~F.col("held_out")))


def with_language(docs: DataFrame, model: Model | None) -> DataFrame:
    """(row, lang_pred, lang_score): every row of ``docs`` as a struct, whatever its columns are called."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model) if model else None)
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    place = docs.columns.index("text")

    def run(batches):
        predict = _predict(shared)
        with_text = (pa.RecordBatch.from_arrays([b.column("row"), b.column("row").flatten()[place].cast(pa.string())], names=["row", "text"])
                     for b in batches)
        for part in chunks(with_text):
            flags = pa.RecordBatch.from_arrays(
                [pa.nulls(part.num_rows, pa.int64()), pa.nulls(part.num_rows, pa.bool_()), part.column("text")],
                names=["doc_id", "held_out", "text"])
            got = next(predict([flags]))
            yield pa.RecordBatch.from_arrays([part.column("row"), got.column("lang_pred"), got.column("score")],
                                             names=["row", "lang_pred", "lang_score"])
    schema = T.StructType([rows.schema["row"], T.StructField("lang_pred", T.StringType()), T.StructField("lang_score", T.DoubleType())])
    return rows.mapInArrow(run, schema)


def with_letters(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text has a letter: those that a model gives a language."""
    def run(batches):
        for batch in batches:
            for part in chunks([batch]):
                yield part.filter(pa.array(_letters(part.column("text"))))
    return docs.mapInArrow(run, docs.schema)


def op6_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return identify(docs, fit(docs))
