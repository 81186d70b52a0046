"""Merkle manifest of a table of documents: a tree of digests per language, and one over the languages.

Leaves get their place within the language from counts of sorted ranges.  A list of nodes is cut
into stretches of 8**4, and each stretch climbs four levels inside one window partition: the rows of
a level are the first leaves of its nodes, lag and lead columns at fixed offsets hold the other nodes
of the run, masked by the row's slot and the run's length, and the row in slot 0 hashes them to the
parent.  The tops of the stretches are the next, 4,096 times shorter list.  So no task holds a
language, and a leaf's path is read in its own partition, joined only to the path of its stretch.

Defined results: leaves without ``doc_id`` come first in their language, leaves of one id are
ordered by digest; repeated rows are leaves of their own; documents without language form the first
list; a row without ``doc_id`` is never tampered with; a single row's leaf is subroot and root, its
proof is the digest of no siblings; an empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import settled, table
from .line_dedup import lowered

ARITY = 8
LEVELS = 4
STRETCH = ARITY ** LEVELS
NO_STEPS = "array<struct<left:string,right:string>>"


def encoded(value):
    """``-`` for null, else the count of bytes, a colon and the value."""
    value = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def leaf_of(text):
    return F.sha2(F.concat(*(encoded(c) for c in (
        F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text))), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """(list, doc_id, leaf, seen): ``seen`` is the leaf that a later reader finds, other where the text was changed.

    ``list`` orders as ``lang`` does, nulls first.
    """
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    text = F.col("text").cast("string")
    return docs.select(
        F.when(F.col("lang").isNull(), "0").otherwise(F.concat(F.lit("1"), F.col("lang").cast("string"))).alias("list"),
        F.col("doc_id").cast("long").alias("doc_id"),
        leaf_of(text).alias("leaf"),
        F.when(changed, leaf_of(lowered(text))).otherwise(leaf_of(text)).alias("seen"))


def placed(rows: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """``rows`` with ``idx`` (0, 1, ... within ``list`` by ``order``) and ``n``, the length of the list,
    and the longest list's length, which alone reaches the driver.

    Rows are dealt by sorted ranges, which cut a long list; the counts of (list, range) give what
    comes before a range, and rows are numbered within their range alone.
    """
    dealt = settled(rows.repartitionByRange("list", *order).withColumn("range", F.spark_partition_id()))
    counts = dealt.groupBy("list", "range").agg(F.count(F.lit(1)).alias("here"))
    upto = Window.partitionBy("list").orderBy("range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = counts.select("list", "range", (F.sum("here").over(upto) - F.col("here")).alias("start"),
                           F.sum("here").over(Window.partitionBy("list")).alias("n"))
    within = Window.partitionBy("list", "range").orderBy(*order)
    numbered = dealt.withColumn("idx", F.row_number().over(within) - 1).join(starts, ["list", "range"])
    return (numbered.withColumn("idx", F.col("idx") + F.col("start")).drop("range", "start"),
            starts.agg(F.max("n")).first()[0] or 0)


def climbed(nodes: DataFrame) -> DataFrame:
    """``nodes`` (list, idx, n, hash, ...) with ``stretch``, ``steps`` and ``top``.

    ``steps``: per level on which the list has more than one node, the siblings left and right of
    the node's ancestor there; ``top``: on the stretch's first row, the digest that stands for it.
    """
    out = nodes.withColumn("stretch", F.call_function("div", "idx", F.lit(STRETCH)))
    rows = Window.partitionBy("list", "stretch").orderBy("idx")
    upto = rows.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = out.withColumn("h0", F.col("hash"))
    for level in range(LEVELS):
        width = ARITY ** level
        node = F.call_function("div", "idx", F.lit(width))
        count = F.call_function("div", F.col("n") + (width - 1), F.lit(width))
        slot = F.pmod(node, F.lit(ARITY))
        length = F.least(F.lit(ARITY), count - (node - slot))
        own = F.col(f"h{level}")
        near = {d: F.lead(own, d * width).over(rows) if d > 0 else F.lag(own, -d * width).over(rows)
                for d in range(1 - ARITY, ARITY) if d}
        inside = {d: F.when((slot + d >= 0) & (slot + d < length), c).otherwise("") for d, c in near.items()}
        first = F.pmod("idx", F.lit(width)) == 0
        step = F.struct(F.concat(*(inside[d] for d in range(1 - ARITY, 0))).alias("left"),
                        F.concat(*(inside[d] for d in range(1, ARITY))).alias("right"))
        out = out.withColumn("step", F.when(first, step))
        more = count > 1
        parent = F.when(more, F.sha2(F.concat(own, F.col("step.right")), 256)).otherwise(own)
        out = out.withColumns({
            f"h{level + 1}": F.when(F.pmod("idx", F.lit(width * ARITY)) == 0, parent),
            f"s{level}": F.when(more, F.last("step", ignorenulls=True).over(upto))})
    steps = F.filter(F.array(*(f"s{k}" for k in range(LEVELS))), lambda s: s.isNotNull())
    return out.select(*nodes.columns, "stretch", steps.alias("steps"), F.col(f"h{LEVELS}").alias("top"))


def paths(nodes: DataFrame, longest: int) -> tuple[DataFrame, DataFrame]:
    """``nodes`` (list, idx, n, hash, ...) with ``path``, all steps to the top of their list, and ``head``,
    its digest; and the heads (list, head).  ``longest``: the length of the longest list."""
    up = climbed(nodes)
    above = settled(
        up.where(F.col("idx") % STRETCH == 0)
        .select("list", F.col("stretch").alias("idx"),
                F.call_function("div", F.col("n") + (STRETCH - 1), F.lit(STRETCH)).alias("n"), F.col("top").alias("hash")))
    if longest <= STRETCH:
        over, heads = above.withColumns({"path": F.array().cast(NO_STEPS), "head": F.col("hash")}), None
    else:
        over, heads = paths(above, (longest - 1) // STRETCH + 1)
    over = over.select("list", F.col("idx").alias("stretch"), F.col("path").alias("rest"), "head")
    return (up.join(over, ["list", "stretch"]).select(*nodes.columns, F.concat("steps", "rest").alias("path"), "head"),
            heads or over.select("list", "head"))


def folded(leaf, path):
    """The digest at the top, from a leaf and its siblings on the way."""
    return F.aggregate(path, leaf, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


def manifest(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, path, seen): every row with its proof; ``path`` leads from leaf to root."""
    low, heads = paths(*placed(leaves(docs).withColumn("hash", F.col("leaf")), ["doc_id", "leaf"]))
    high, _ = paths(*placed(heads.select(
        F.lit("").alias("list"), F.col("list").alias("sublist"), F.col("head").alias("hash")), ["sublist"]))
    high = high.select(F.col("sublist").alias("list"), F.col("path").alias("over"), F.col("head").alias("root"))
    return low.join(high, "list").select(
        "doc_id", "leaf", F.col("head").alias("subroot"), "root", F.concat("path", "over").alias("path"), "seen")


def proofs(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified): what a reader of changed rows finds."""
    made = manifest(docs)
    siblings = F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), "")
    out = made.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"),
                      folded(F.col("seen"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_merkle(spark, sf_dir):
    return proofs(table(spark, sf_dir, "documents"))


SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, lang, n_chars, text,
         CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(doc_id::VARCHAR) || ':' || doc_id END
         || CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END
         || CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END
         || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(n_chars::VARCHAR) || ':' || n_chars END AS head,
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low
  FROM documents),
l AS (
  SELECT doc_id, CASE WHEN lang IS NULL THEN '0' ELSE '1' || lang END AS g,
         sha256(head || CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END) AS leaf,
         sha256(head || CASE WHEN text IS NULL THEN '-' ELSE strlen(low) || ':' || low END) AS changed
  FROM d),
p AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
         count(*) OVER (PARTITION BY g) AS n FROM l),
a AS (
  SELECT 0 AS lv, g, idx, n, leaf AS h FROM p
  UNION ALL
  SELECT lv + 1, g, idx // 8, (max(n) + 7) // 8, sha256(string_agg(h, '' ORDER BY idx))
  FROM a WHERE n > 1 GROUP BY lv, g, idx // 8),
r AS (SELECT g, h AS subroot, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS m FROM a WHERE n = 1),
b AS (
  SELECT 0 AS lv, pos AS idx, m AS n, subroot AS h FROM r
  UNION ALL
  SELECT lv + 1, idx // 8, (max(n) + 7) // 8, sha256(string_agg(h, '' ORDER BY idx))
  FROM b WHERE n > 1 GROUP BY lv, idx // 8),
sa AS (
  SELECT x.lv, x.g, x.idx, coalesce(string_agg(y.h, '' ORDER BY y.idx) FILTER (WHERE y.idx < x.idx), '') AS lft,
         coalesce(string_agg(y.h, '' ORDER BY y.idx) FILTER (WHERE y.idx > x.idx), '') AS rgt
  FROM a x JOIN a y ON x.lv = y.lv AND x.g = y.g AND x.idx // 8 = y.idx // 8 WHERE x.n > 1 GROUP BY x.lv, x.g, x.idx),
sb AS (
  SELECT x.lv, x.idx, coalesce(string_agg(y.h, '' ORDER BY y.idx) FILTER (WHERE y.idx < x.idx), '') AS lft,
         coalesce(string_agg(y.h, '' ORDER BY y.idx) FILTER (WHERE y.idx > x.idx), '') AS rgt
  FROM b x JOIN b y ON x.lv = y.lv AND x.idx // 8 = y.idx // 8 WHERE x.n > 1 GROUP BY x.lv, x.idx),
bits AS (
  SELECT DISTINCT doc_id, doc_id::VARCHAR AS s, 0 AS k, 4294967295::BIGINT AS c FROM documents WHERE doc_id IS NOT NULL
  UNION ALL
  SELECT doc_id, s, k + 1, xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END)
  FROM (SELECT *, CASE WHEN k % 8 = 0 THEN xor(c, ascii(substr(s, k // 8 + 1, 1))::BIGINT) ELSE c END AS x FROM bits) t
  WHERE k < 8 * length(s)),
crc AS (SELECT doc_id, xor(c, 4294967295) AS c FROM bits WHERE k = 8 * length(s)),
tall AS (SELECT g, max(lv) AS top FROM a GROUP BY g),
walk AS (
  SELECT p.doc_id, p.g, p.idx AS leaf_idx, p.leaf, 0 AS lv, p.idx, '' AS proof,
         CASE WHEN crc.c % 3 = 0 THEN p.changed ELSE p.leaf END AS h
  FROM p LEFT JOIN crc ON p.doc_id = crc.doc_id
  UNION ALL
  SELECT w.doc_id, w.g, w.leaf_idx, w.leaf, w.lv + 1, w.idx // 8, w.proof || s.lft || s.rgt, sha256(s.lft || w.h || s.rgt)
  FROM walk w JOIN sa s ON w.lv = s.lv AND w.g = s.g AND w.idx = s.idx),
done AS (
  SELECT w.* FROM walk w JOIN tall t ON w.g = t.g AND w.lv = t.top),
climb AS (
  SELECT e.doc_id, e.leaf, r.subroot, 0 AS lv, r.pos AS idx, e.proof, e.h FROM done e JOIN r ON e.g = r.g
  UNION ALL
  SELECT c.doc_id, c.leaf, c.subroot, c.lv + 1, c.idx // 8, c.proof || s.lft || s.rgt, sha256(s.lft || c.h || s.rgt)
  FROM climb c JOIN sb s ON c.lv = s.lv AND c.idx = s.idx),
root AS (SELECT h AS root, lv FROM b WHERE n = 1)
SELECT c.doc_id, c.leaf, c.subroot, root.root, sha256(c.proof) AS proof_sha256, c.h AS folded_root, c.h = root.root AS verified
FROM climb c JOIN root ON c.lv = root.lv
"""
