"""Byte-level BPE: encoding and decoding by DuckDB queries inside each partition.

A partition's texts are cut into pieces by the tokenizer's pattern; its distinct pieces become
token-position rows, and a recursive query joins neighbours with the merge table and contracts
each piece's leftmost pair of least rank until none is left.  A piece that is a token itself is
that token.  Decoding joins ids with the vocabulary and aggregates the bytes in order.

Only distinct pieces that a partition has not met before enter DuckDB (two generations of them are
remembered, so memory is bounded); texts are put together from them.  The recursion takes as
many steps as a piece has merges, each over the whole piece, so pieces above ``LONG`` bytes are
contracted by the same rule on a heap instead, with equal results.

Defined results: a null text is an empty one, with no ids; every row gets a result, repeated rows too.
"""

from __future__ import annotations

import base64
import hashlib
import heapq

import duckdb
import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, flat, table, with_text, worker_memo

LONG = 512
LETTER, NUMBER, OTHER, BLANK = 1, 2, 3, 4
#: What bounds a worker's memory: pieces of a generation, bytes of text at a time, squared piece lengths
#: of one recursive query, pieces of one decoding query.
REMEMBERED, CHUNK, GROUP, DECODED = 100_000, 1 << 20, 500_000, 10_000


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def character_classes() -> np.ndarray:
    """Letter, number, blank or other for every code point, by the Unicode tables of the tokenizer's library."""
    out = np.full(0x110000, OTHER, np.uint8)
    every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    bytes_alone = {bytes([b]): b for b in range(256)}
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (BLANK, r"\s")):
        matched = bytes(tiktoken.Encoding("bytes", pat_str=pattern, mergeable_ranks=bytes_alone, special_tokens={}).encode_ordinary(every))
        out[np.frombuffer(matched.decode("utf-8").encode("utf-32-le"), np.uint32)] = kind
    return out


def pieces(data: np.ndarray, bounds: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets of the pattern's matches in the joined texts, and each match's text.

    The pattern: contractions ('s 't 're 've 'm 'll 'd), then a run of letters, of numbers or of
    other characters with one blank before it, then blanks, which leave their last one to what follows.
    """
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    n = len(points)
    byte_at = np.flatnonzero((data & 0xC0) != 0x80)
    begins = np.searchsorted(byte_at, bounds[:-1])
    kind = classes[points]
    fresh = np.zeros(n + 3, bool)
    fresh[begins] = True
    fresh[n:] = True
    change = fresh.copy()
    change[1:n] |= kind[1:] != kind[:-1]
    start = change.copy()
    after = np.flatnonzero(change[1:n] & ~fresh[1:n] & (kind[1:] != BLANK) & (kind[:-1] == BLANK)) + 1
    start[after - 1] = True
    start[after] = points[after - 1] != 32
    at = np.flatnonzero((points == 39) & start[:n] & ~fresh[1:n + 1] & change[1:n + 1])
    one = np.concatenate([points, np.zeros(3, np.uint32)])
    first, second = one[at + 1], np.where(fresh[at + 2], 0, one[at + 2])
    short = np.isin(first, [ord(c) for c in "stmd"])
    long = ((first == ord("r")) | (first == ord("v"))) & (second == ord("e")) | (first == ord("l")) & (second == ord("l"))
    start[at[short | long] + 1] = False
    start[at[short] + 2] = True
    start[at[long] + 3] = True
    begin = np.flatnonzero(start[:n])
    offsets = np.append(byte_at[begin], len(data))
    return offsets, np.searchsorted(bounds, byte_at[begin], side="right") - 1


ENCODE = """
WITH RECURSIVE t(s, w, p, id, n, nid) AS (
  SELECT 0, w, p, id, n, nid FROM tokens
  UNION ALL
  (WITH least AS (SELECT w, min(m.merged * 1048576 + t.p) AS k FROM t JOIN merges m ON m.pair = t.id * 65536 + t.nid
                  WHERE t.nid >= 0 GROUP BY w),
   found AS (SELECT least.w, k // 1048576 AS merged, k % 1048576 AS at, a.n AS gone, b.n, b.nid
             FROM least JOIN t a ON a.w = least.w AND a.p = k % 1048576 JOIN t b ON b.w = a.w AND b.p = a.n)
   SELECT t.s + 1, t.w, t.p, CASE WHEN t.p = f.at THEN f.merged ELSE t.id END,
          CASE WHEN t.p = f.at THEN f.n ELSE t.n END,
          CASE WHEN t.p = f.at THEN f.nid WHEN t.n = f.at THEN f.merged ELSE t.nid END
   FROM t JOIN found f ON t.w = f.w WHERE t.p <> f.gone)
)
SELECT t.w, t.p, t.id FROM t JOIN (SELECT w, max(s) AS s FROM t GROUP BY w) last ON t.w = last.w AND t.s = last.s
ORDER BY t.w, t.p
"""
DECODE = "SELECT w, list(bytes ORDER BY p) AS parts FROM ids JOIN vocabulary USING (id) GROUP BY w ORDER BY w"


class Coder:
    """The tables of one vocabulary in an in-memory DuckDB of this process."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "200MB"})
        merges = [(ranks[t[:k]] * 65536 + ranks[t[k:]], r) for t, r in ranks.items() for k in range(1, len(t))
                  if t[:k] in ranks and t[k:] in ranks]
        pair, merged = np.array(merges, np.int64).T
        self.merges = dict(zip(pair.tolist(), merged.tolist()))
        self._fill("merges", pa.table({"pair": pair, "merged": merged}))
        self._fill("vocabulary", pa.table({"id": pa.array(list(ranks.values()), pa.int64()), "bytes": pa.array(list(ranks), pa.binary())}))
        self.young, self.old, self.odd = {}, {}, {}

    def _fill(self, name: str, rows: pa.Table) -> None:
        self.db.register("given", rows)
        self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        self.db.unregister("given")

    def _query(self, name: str, rows: pa.Table, sql: str) -> pa.Table:
        self.db.register(name, rows)
        out = self.db.sql(sql).to_arrow_table()
        self.db.unregister(name)
        return out

    def _heap(self, word: bytes) -> list[int]:
        ids = self.single[np.frombuffer(word, np.uint8)].tolist()
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        heap = [(m, i) for i in range(len(ids) - 1) if (m := self.merges.get(ids[i] * 65536 + ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            m, i = heapq.heappop(heap)
            j = after[i] if ids[i] >= 0 else len(ids)
            if j >= len(ids) or self.merges.get(ids[i] * 65536 + ids[j]) != m:
                continue
            ids[i], ids[j] = m, -1
            after[i] = after[j]
            if after[i] < len(ids):
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < len(ids) and (x := self.merges.get(ids[a] * 65536 + ids[b])) is not None:
                    heapq.heappush(heap, (x, a))
        return [x for x in ids if x >= 0]

    def _merged(self, words: list[bytes]) -> list[bytes]:
        length = np.array([len(w) for w in words])
        last = np.cumsum(length) - 1
        w = np.repeat(np.arange(len(words)), length)
        p = np.arange(len(w)) - np.repeat(last - length + 1, length)
        ids = self.single[np.frombuffer(b"".join(words), np.uint8)]
        n, nid = p + 1, np.append(ids[1:], -1)
        n[last], nid[last] = -1, -1
        got = self._query("tokens", pa.table({"w": w, "p": p, "id": ids, "n": n, "nid": nid}), ENCODE)
        out = got.column("id").to_numpy().astype("<u4").tobytes()
        edge = (4 * np.searchsorted(got.column("w").to_numpy(), np.arange(len(words) + 1))).tolist()
        return [out[a:b] for a, b in zip(edge, edge[1:])]

    def decode(self, ids: list[bytes]) -> list[bytes]:
        """The bytes of each run of ids (little-endian, 32 bits): a join with the vocabulary and an ordered aggregate."""
        size = np.array([len(x) // 4 for x in ids])
        w = np.repeat(np.arange(len(ids)), size)
        out = [b""] * len(ids)
        if not len(w):
            return out
        rows = pa.table({"w": w, "p": np.arange(len(w)), "id": np.frombuffer(b"".join(ids), "<u4").astype(np.int64)})
        got = self._query("ids", rows, DECODE).combine_chunks()
        for part in got.column("parts").chunks:
            inner = part.values
            edge = np.frombuffer(inner.buffers()[1], np.int32)[inner.offset:][part.offsets.to_numpy()].tolist()
            data = inner.buffers()[2].to_pybytes()
            for k, a, b in zip(got.column("w").to_pylist(), edge, edge[1:]):
                out[k] = data[a:b]
        return out

    def learn(self, words: list[bytes]) -> tuple[list[bytes], list[bytes]]:
        """Ids (little-endian, 32 bits) of distinct pieces, and the bytes that these decode to."""
        known = [self.young.get(w) or self.old.get(w) for w in words]
        new = [i for i, k in enumerate(known) if k is None]
        group, cost = [], 0
        for i in (*new, None):
            if group and (i is None or cost + len(words[i]) ** 2 > GROUP):
                for g, ids in zip(group, self._merged([words[g] for g in group])):
                    known[g] = ids
                group, cost = [], 0
            if i is None:
                continue
            if (whole := self.ranks.get(words[i])) is not None:
                known[i] = whole.to_bytes(4, "little")
            elif len(words[i]) > LONG:
                known[i] = np.array(self._heap(words[i]), "<u4").tobytes()
            else:
                group.append(i)
                cost += len(words[i]) ** 2
        for a in range(0, len(new), DECODED):
            part = new[a:a + DECODED]
            for i, text in zip(part, self.decode([known[i] for i in part])):
                if text != words[i]:
                    self.odd[words[i]] = text
        if len(self.young) > REMEMBERED:
            self.young, self.old = {}, self.young
        self.young.update(zip(words, known))
        return known, [self.odd.get(w, w) for w in words] if self.odd else words

    def texts(self, column: pa.Array, classes: np.ndarray):
        """For each text its ids (little-endian, 32 bits) and the bytes decoded from them."""
        data, bounds = flat(column)
        if not len(data):
            for _ in range(len(column)):
                yield b"", b""
            return
        offsets, row = pieces(data, bounds, classes)
        spelled = pa.BinaryArray.from_buffers(pa.binary(), len(row), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)])
        coded = spelled.dictionary_encode()
        ids, decoded = self.learn(coded.dictionary.to_pylist())
        index = coded.indices.to_numpy()
        edges = np.searchsorted(row, np.arange(len(column) + 1)).tolist()
        for a, b in zip(edges, edges[1:]):
            mine = index[a:b].tolist()
            yield b"".join(map(ids.__getitem__, mine)), b"".join(map(decoded.__getitem__, mine))


OWNER = "byte_bpe"


def coder(ranks: dict[bytes, int]) -> Coder:
    """This worker process's coder: later tasks of this operator go on with what earlier ones have met."""
    kept, key = worker_memo(OWNER), hash(frozenset(ranks.items()))
    if kept.get("key") != key:
        kept["key"], kept["coder"] = key, Coder(ranks)
    return kept["coder"]


def _digests(shared):
    def run(batches):
        ranks, classes = shared.value
        own = coder(ranks)
        for batch in chunks(batches, CHUNK, OWNER):
            n, a, b = [], [], []
            for ids, text in own.texts(batch.column("text"), classes):
                n.append(len(ids) // 4)
                a.append(hashlib.sha256(ids).hexdigest())
                b.append(hashlib.sha256(text).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())],
                                             names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return run


def _encode(shared):
    def run(batches):
        ranks, classes = shared.value
        own = coder(ranks)
        for batch in chunks(batches, CHUNK, OWNER):
            ids = [np.frombuffer(x, "<i4") for x, _ in own.texts(batch.column("text"), classes)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])
    return run


def _decode(shared):
    def run(batches):
        own = coder(shared.value[0])
        for batch in batches:
            for row in range(0, batch.num_rows, 64):
                part = batch.slice(row, 64)
                ids = [np.array(x or [], "<u4").tobytes() for x in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(own.decode(ids), pa.binary())], names=["doc_id", "bytes"])
    return run


def _shared(spark, path: str):
    return spark.sparkContext.broadcast((load_ranks(path), character_classes()))


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids) by the rank file at ``path``; ids are array<int>."""
    return with_text(docs).mapInArrow(_encode(_shared(docs.sparkSession, path)), "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, bytes) of rows (doc_id, ids); a null list is an empty one."""
    return encoded.select("doc_id", "ids").mapInArrow(_decode(_shared(encoded.sparkSession, path)), "doc_id long, bytes binary")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): digests of the ids and of what they decode to."""
    return with_text(docs).mapInArrow(_digests(_shared(docs.sparkSession, path)),
                                      "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def rank_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op10_byte_bpe(spark, sf_dir):
    return round_trip(table(spark, sf_dir, "documents"), rank_file())
