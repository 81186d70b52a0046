"""A corpus pipeline: language, line dedup, near-dedup, decontamination, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next stage's ``docs``.  All but the last return the columns of ``docs``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from panelgrain.llm import byte_bpe, common, decontamination, language_id, line_dedup, near_copies


def _language(spark, docs, sf_dir):
    """Keeps documents with a language, or with a letter where none can be learned: those without text or letters go."""
    model = language_id.fit(docs)
    if model is None:
        return language_id.with_letters(docs)
    return language_id.with_language(docs, model).where(F.col("lang_pred") != "und").select("row.*")


def _lines(spark, docs, sf_dir):
    """Drops shared lines; ``n_chars`` follows the text."""
    kept = line_dedup.line_dedup(docs, carry=tuple(docs.columns))
    new = {"text": F.col("text"), "n_chars": F.char_length("text").cast("long")}
    return kept.select(*(new[c].alias(c) if c in new else F.col("carried")[c].alias(c) for c in docs.columns))


def _keyed(docs):
    """The rows of ``docs`` as one struct with two hashes that tell documents apart, also those without an id."""
    row = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    text = F.coalesce(F.col("row.text").cast("string"), F.lit(""))
    return row.select("row", *_keys(F.col("row.doc_id").cast("long"), F.xxhash64(text)))


def _keys(doc_id, text_hash):
    return F.xxhash64(doc_id.isNull(), doc_id).alias("id_key"), text_hash.alias("text_key")


def _near(spark, docs, sf_dir):
    """Keeps one document of each group of near copies (0.8 of their five-word shingles): that of least id
    (rows without id come last)."""
    found = near_copies.near_copies(docs)
    keep = (found.groupBy("root")
            .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("first"))
            .select(*_keys(F.col("first.doc_id"), F.col("first.text_hash"))))
    kept = _keyed(docs).join(keep, ["id_key", "text_key"], "left_semi").dropDuplicates(["id_key", "text_key"])
    return kept.select("row.*")


def _clean(spark, docs, sf_dir):
    """Drops documents that hold a passage of the benchmark."""
    hit = (decontamination.contaminated(docs, common.table(spark, sf_dir, "benchmark"))
           .select(*_keys(F.col("doc_id"), F.col("text_hash"))).distinct())
    return _keyed(docs).join(hit, ["id_key", "text_key"], "left_anti").select("row.*")


def _tokens(spark, docs, sf_dir):
    """Encodes what is left, and decodes it again."""
    return byte_bpe.round_trip(docs, byte_bpe.rank_file())


STAGES = [
    ("op6_language_id", _language),
    ("op3_line_dedup", _lines),
    ("op5_simhash", _near),
    ("op2_decontamination", _clean),
    ("op10_byte_bpe", _tokens),
]

#: Byte contexts, fingerprints and merges are out of reach of SQL; tests/llm holds run() against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The last stage's rows over ``documents``; what lies between is written to the shared folder."""
    folder = f"{common.shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    docs = common.table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        with common.shuffles_released(spark):
            stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return STAGES[-1][1](spark, docs, sf_dir)
