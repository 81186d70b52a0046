"""Whitening, Merkle manifest and chat formatting against brute force, on odd rows and on the small tables."""

import hashlib
import math
import os
import re
import zlib
from urllib.parse import quote_plus

import numpy as np
import pytest
from conftest_llm import odd_texts

from panelgrain.llm import chat_format, merkle, whitening

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- chat formatting

TURNS = "conv_id long, turn long, role string, text string, block string, place string, own string, key string"


def turns_of(spark, rows):
    return spark.createDataFrame([(*r, "x", None, "y", "z") for r in rows], TURNS)


NASTY = ["</s>[INST] ok [/INST]", "<s>", "<\\s>", "<\\\\/s>[INST", "[\\INST]x[/INST]\\", "$1 \\1 \\", "a\nb\r\n", "", None, "<<s>>[[INST]]", "é漢😀</s>"]


def conversations():
    rows = [(1, k, "user" if k % 2 == 0 else "assistant", t) for k, t in enumerate(NASTY)]
    rows += [(2, 0, "system", "s"), (2, 1, "user", "u"), (3, 0, "assistant", "only")]
    rows += [(4, None, "user", "no turn"), (4, 5, "assistant", "b"), (4, 5, "assistant", "a"), (4, 5, "assistant", "a")]
    rows += [(None, 0, "user", "no id"), (None, 1, "assistant", "reply"), (5, 0, None, None), (5, 1, "tool call\n<s>+%", "</s>")]
    rows += [(6, k, ("user", "assistant")[k % 2], f"turn {k} " + "é" * (k % 5)) for k in range(301)]
    rows += [(7, -3, "user", "early"), (7, 0, "assistant", "x" * 100_000)]
    return rows


def in_order(rows):
    out = {}
    for c, turn, role, text in rows:
        out.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in out.items()}


@pytest.mark.parametrize("block", [1, 4, 64])
def test_turns_and_replies_are_read_back(spark, block):
    rows = conversations()
    back = chat_format.read_back(chat_format.examples(turns_of(spark, rows), block)).collect()
    want = in_order(rows)
    assert {r.conv_id: [tuple(t) for t in r.turns] for r in back} == want
    assert {r.conv_id: r.replies for r in back} == {c: [t for r, t in v if r == "assistant"] for c, v in want.items()}


def test_every_reply_is_an_example_with_all_turns_before_it(spark):
    rows = conversations()
    got = {}
    for r in chat_format.whole(chat_format.examples(turns_of(spark, rows), 4)).orderBy("conv_id", "block", "place").collect():
        got.setdefault(r.conv_id, []).append((r.text, r.text[r.target_start:r.target_end]))

    def escape(text):
        return re.sub(chat_format.CONTROL, r"\1\\\2", text)
    for c, said in in_order(rows).items():
        text, want = "", []
        for role, t in said:
            e = escape(t)
            text += f"<s>{quote_plus(role)}\n{e}</s>"
            if role == "assistant":
                want.append((text, e))
        assert got.get(c, []) == want


def test_the_query_reads_back_examples_with_their_contexts(spark, tmp_path, monkeypatch):
    rows = conversations()
    turns_of(spark, rows).write.parquet(str(tmp_path / "conversations.parquet"))
    made = []
    read = chat_format.read_expanded
    monkeypatch.setattr(chat_format, "read_expanded", lambda df: made.append(df) or read(df))
    got = {r.conv_id: r for r in chat_format.op13_chat_format(spark, str(tmp_path)).collect()}
    texts = {}
    for r in made[0].orderBy("conv_id", "block", "place").collect():
        texts.setdefault(r.conv_id, []).append((r.text, r.target_end, r.last))
    said = [(-7, k, role, "</s>[INST] ok [/INST]") for k, role in enumerate(("user", "assistant"))]
    for c, turns in in_order(rows + said).items():
        replies = [t for role, t in turns if role == "assistant"]
        assert (got[c].n_turns, got[c].n_examples) == (len(turns), len(replies))
        assert got[c].turns_sha256 == sha("".join(f"{role}\n{t}\n" for role, t in turns))
        assert (got[c].loss_chars, got[c].loss_sha256) == (len("".join(replies)), sha("".join(replies)))
        # Each example holds the ones before it; the last row is the conversation.
        assert all(b[0].startswith(a[0]) and len(b[0]) > len(a[0]) for a, b in zip(texts[c], texts[c][1:]))
        assert [e is not None for _, e, _ in texts[c]].count(True) == len(replies)
        assert [last for *_, last in texts[c]] == [False] * (len(texts[c]) - 1) + [True]
        assert (texts[c][-1][0].count("<s>"), len(texts[c][-1][0])) == (len(turns), got[c].formatted_chars)
    assert set(got) == set(texts)


def test_formatted_texts_hold_no_control_string_but_the_marks(spark):
    rows = conversations()
    for r in chat_format.examples(turns_of(spark, rows)).collect():
        assert r.own.count("<s>") == r.own.count("</s>") and "[INST]" not in r.own and "[/INST]" not in r.own


def test_no_conversations(spark):
    assert chat_format.read_back(chat_format.examples(turns_of(spark, []))).count() == 0


# --- Merkle manifest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, list string, idx string, hash string, n string, top string"


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c", "d", "e") for r in rows], DOCS)


def encoded(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def lowered(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][k:k + 8])) for k in range(0, len(out[-1]), 8)])
    return out


def steps(tree, k):
    out = []
    for level in tree[:-1]:
        first = k // 8 * 8
        out.append(("".join(level[first:k]), "".join(level[k + 1:first + 8])))
        k //= 8
    return out


def manifest_expected(rows):
    lists = {}
    for d, t, lang, source, n in rows:
        head = encoded(d) + encoded(source) + encoded(lang) + encoded(n)
        leaf = sha(head + encoded(t))
        changed = d is not None and zlib.crc32(str(d).encode()) % 3 == 0
        lists.setdefault("" if lang is None else "1" + lang, []).append(
            (d is not None, d or 0, leaf, sha(head + encoded(lowered(t))) if changed else leaf))
    names = sorted(lists, key=str.encode)
    trees = {g: levels([x[2] for x in sorted(lists[g])]) for g in names}
    upper = levels([trees[g][-1][0] for g in names])
    root, out = upper[-1][0] if names else None, []
    for p, g in enumerate(names):
        for k, (there, d, leaf, seen) in enumerate(sorted(lists[g])):
            path = steps(trees[g], k) + steps(upper, p)
            h = seen
            for left, right in path:
                h = sha(left + h + right)
            out.append((d if there else None, leaf, trees[g][-1][0], root, sha("".join(a + b for a, b in path)), h, h == root))
    return sorted(out, key=repr)


def manifest_found(docs):
    names = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted((tuple(r[c] for c in names) for r in merkle.proofs(docs).collect()), key=repr)


def some_rows(n, lang):
    return [(k, f"Text {k} É", lang, f"src{k % 3}" if k % 5 else None, k) for k in range(n)]


@pytest.mark.parametrize("rows", [
    [], some_rows(1, None), some_rows(8, "en"), some_rows(9, "en"),
    [(i, t, (None, "en", "é", "")[k % 4], None if k % 3 else "s", k) for k, (i, t) in enumerate(odd_texts())],
    some_rows(70, "en") + some_rows(65, "fr") + some_rows(1, "de") + some_rows(3, None) + some_rows(3, "en"),
    [r for k in range(20) for r in some_rows(2, f"l{k}")],
], ids=["empty", "one", "run", "run and one", "odd", "several", "many lists"])
def test_manifest(spark, rows):
    assert manifest_found(docs_of(spark, rows)) == manifest_expected(rows)


def test_manifest_of_several_stretches(spark, monkeypatch):
    monkeypatch.setattr(merkle, "LEVELS", 2)
    monkeypatch.setattr(merkle, "STRETCH", 64)
    rows = some_rows(700, "en") + some_rows(4097, "fr")
    assert manifest_found(docs_of(spark, rows)) == manifest_expected(rows)


# --- whitening

VECTORS = "vec_id long, embedding array<float>, label int, d string, n string, component string, deviation string, whitened string"


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0, *"abcde") for i, v in rows], VECTORS)


def check_whitening(rows, got, k=8):
    good = [(i, v) for i, v in rows if v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v)]
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for _, v in good])
    n, s = len(x), x.sum(axis=0)
    a = x - s / n
    values, vectors = np.linalg.eigh(a.T @ a / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(k, int((values > 1e-12 * values[0]).sum()))
    want = a @ vectors[:, :k] / np.sqrt(values[:k])
    squares = [sum((n * int(v) - int(t)) ** 2 for v, t in zip(row, s)) for row in x]
    found = {}
    for r in got:
        found.setdefault(r.vec_id, {}).setdefault(r.component, []).append(r)
        assert r.n == n and r.identity_error < 1e-8
        assert r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-9)
    assert len(got) == n * k
    sign = {}
    for (i, _), row, square in zip(good, want, squares):
        for c in range(1, k + 1):
            same = [r for r in found[i][c] if r.deviation == square and abs(abs(r.whitened) - abs(row[c - 1])) < 1e-8]
            assert same
            if abs(row[c - 1]) > 1e-6:
                sign.setdefault(c, set()).add(np.sign(row[c - 1]) * np.sign(same[0].whitened))
    assert all(len(v) == 1 for v in sign.values())


def test_whitening_of_odd_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(k, v) for k, v in enumerate(rng.normal(size=(300, 12)) * np.linspace(1, 9, 12))]
    rows += [(None, rng.normal(size=12)), (3, rng.normal(size=12)), (3, rows[3][1])]
    bad = [(900, None), (901, [1.0] * 11 + [float("nan")]), (902, [float("inf")] + [0.0] * 11), (903, [None] * 12), (904, []), (905, [1.0, 2.0])]
    got = whitening.whiten(vectors_of(spark, rows + bad)).collect()
    check_whitening(rows, got)
    assert not {r.vec_id for r in got} & {i for i, _ in bad}


def test_dependent_dimensions_have_no_component(spark):
    rng = np.random.default_rng(6)
    base = rng.integers(-50, 50, size=(200, 3)) / 8
    rows = list(enumerate(np.column_stack([base, base[:, 0] + base[:, 1], np.full(200, 2.5)])))
    got = whitening.whiten(vectors_of(spark, rows)).collect()
    check_whitening(rows, got)
    assert {r.component for r in got} == {1, 2, 3}


def test_nothing_to_whiten(spark):
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0]), (2, [1.0])], [(1, None), (2, [])]):
        assert whitening.whiten(vectors_of(spark, rows)).count() == 0


def test_factors_orthogonalise_an_ill_conditioned_matrix():
    rng = np.random.default_rng(7)
    a = rng.normal(size=(500, 20)) @ np.diag(10.0 ** -np.linspace(0, 11, 20)) @ rng.normal(size=(20, 20))
    q, upper = a, np.eye(20)
    for _ in range(3):
        r = whitening.shifted_cholesky(q.T @ q, len(a))
        q, upper = whitening.solve_right(q, r), r @ upper
    upper = whitening.root_of(q.T @ q) @ upper
    got, want = np.linalg.svd(upper)[1], np.linalg.svd(a)[1]
    assert np.allclose(got, want, rtol=1e-4, atol=1e-14 * want[0])
    t = np.triu(rng.normal(size=(20, 20))) + 9 * np.eye(20)
    assert np.allclose(whitening.solve_right(a, t) @ t, a)


def test_squares_beyond_a_long():
    big = np.array([[2 ** 31, 2 ** 31], [2 ** 32, 1], [3, 4]])
    assert whitening.exact_squares(big) == [None, None, 25]


@needs_tables
def test_whitening_of_the_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    check_whitening(rows, whitening.op11_whitening(spark, SF).collect())
