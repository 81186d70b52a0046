"""Rows that the operators' tests share."""

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # columns whose names clash with those that operators use inside
    T.StructField("h1", T.StringType()), T.StructField("text_hash", T.StringType()), T.StructField("shard", T.StringType()),
])


def rows_of(pairs, lang="en"):
    return [(i, t, lang, "s", None if t is None else len(t), "x", None, "y") for i, t in pairs]


LONG_LINE = "This LINE is shared by many documents and is long enough to count"


def odd_texts():
    """Nulls, empty and very long texts, ties, repeated rows and odd characters."""
    texts = [None, "", " ", "\n\n", "a", "É ß", "x" * 50_000, "word " * 20_000, "1\n2\n3", "漢字かな😀", "tab\tand\x0bmore\x0c\r\nend"]
    pairs = list(enumerate(texts)) + [(4, "a"), (4, "a"), (None, "no id"), (None, None), (7, "same id, other text")]
    pairs += [(100 + k, f"{'  ' if k % 2 else ''}{LONG_LINE.upper() if k % 3 else LONG_LINE}\nown {k}\n{LONG_LINE}") for k in range(7)]
    return pairs
