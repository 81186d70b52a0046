"""Each operator against a brute-force version, on odd rows and on the small tables."""

import base64
import collections
import hashlib
import math
import os
import random
import re
import time
import zlib

import numpy as np
import pytest
import xxhash
from conftest_llm import odd_texts
from pyspark.sql import functions as F

from panelgrain.llm import (
    byte_bpe,
    common,
    components,
    decontamination,
    language_id,
    line_dedup,
    near_copies,
    pii,
    quality_classifier,
    quality_rules,
    sharding,
    simhash,
    substring_dedup,
)

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def documents(spark):
    return [(r[0], r[1]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


def every_text(spark):
    return odd_texts() + (documents(spark) if os.path.isdir(SF) else [])


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def counted(rows):
    return collections.Counter(map(tuple, rows))


# --- line dedup

def lines_expected(pairs, min_chars=40, min_docs=5):
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))
    holders = collections.defaultdict(set)
    for i, t in pairs:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(i)
    out = []
    for i, t in pairs:
        lines = (t or "").split("\n")
        lost = [len(holders.get(key(x), ())) >= min_docs and i != max((d for d in holders[key(x)] if d is not None), default=None) for x in lines]
        kept = "\n".join(x for x, gone in zip(lines, lost) if not gone)
        out.append((i, kept, len(lines), sum(lost)))
    return out


def test_line_dedup(spark, make):
    pairs = every_text(spark)
    got = line_dedup.line_dedup(make(pairs), carry=("h1", "text")).select("doc_id", "text", "n_lines", "n_dropped")
    assert counted(got.collect()) == counted(lines_expected(pairs))
    assert line_dedup.line_dedup(make([])).count() == 0


# --- sharding

def test_sharding_is_even_gapless_and_repeatable(spark, make):
    docs = make(every_text(spark) + [(5, "copy")] * 50)
    rows = docs.select("doc_id", "n_chars")
    a = sharding.shard(rows, 24).collect()
    b = sharding.shard(rows.repartition(7), 24).collect()
    assert counted(a) == counted(b) and len(a) == docs.count()
    slots = collections.defaultdict(list)
    for r in a:
        slots[r["shard"]].append(r["slot"])
        assert r["position"] == r["slot"] * 24 + r["shard"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert sorted(r["row_number"] for r in a) == list(range(len(a)))
    assert sharding.shard(make([]).select("doc_id", "n_chars")).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 5, 10, 17, 100, 1000, 4097])
def test_permutation_is_a_bijection(spark, n):
    got = [r[0] for r in spark.range(n).select(sharding.permuted(F.col("id"), n)).collect()]
    assert sorted(got) == list(range(n))


# --- quality rules

def rules_expected(text):
    words = WORD.findall(text or "")
    windows = collections.Counter(zip(words, words[1:], words[2:]))
    covered = {k + j for k in range(len(words) - 2) if windows[tuple(words[k:k + 3])] > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


def test_quality_rules(spark, make):
    pairs = every_text(spark) + [(900, "a b c a b c d e f a b"), (901, "x\nx\n \n \n# $ %<"), (902, "b c b c b c b")]
    docs = make(pairs)
    labels = spark.createDataFrame([(i, 1, 0) for i, t in pairs if t and len(t) > 400], "doc_id long, quality int, toxic int")
    ratios, low = quality_rules.fit(docs, labels, m=512)
    got = quality_rules.quality_rules(docs, ratios, low)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert counted((r.doc_id, *(r[c] for c in names)) for r in got.collect()) == counted((i, *rules_expected(t)) for i, t in pairs)
    assert not any(r.kept and r.base_failed for r in got.collect())
    none = quality_rules.fit(docs, labels.limit(0), m=64)
    assert none == ([0.0] * 64, -math.inf)
    assert quality_rules.quality_rules(make([]), *none).count() == 0


def test_threshold_covers_all_trusted_documents(spark):
    scored = spark.createDataFrame([(i, i / 1000 + 0.00005) for i in range(1000)] + [(None, -9.0)], "doc_id long, score double")
    labels = spark.createDataFrame(
        [(i, 1, 0) for i in range(0, 1000, 2)] * 2 + [(i, 1, 1) for i in range(1, 9, 2)] + [(None, 1, 0), (5000, 1, 0)],
        "doc_id long, quality int, toxic int")
    assert quality_rules.threshold_of(scored, labels, 0.01) == 0.01  # five of the 500 lie below
    assert quality_rules.threshold_of(scored, labels, 0.0) == 0.0
    assert quality_rules.threshold_of(scored.limit(0), labels) == -math.inf


def test_log_ratios():
    r = quality_rules.log_ratios([3, 1], [5, 5], 1.0)
    assert r == [math.log(4 / 6) - math.log(6 / 12), math.log(2 / 6) - math.log(6 / 12)]


# --- SimHash

def fingerprint(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    units = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] if words else []
    h = [xxhash.xxh64_intdigest(u.encode(), 42) for u in units]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def roots(nodes, edges):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def close_pairs(marks):
    marks = sorted(marks)
    return [(a, b) for k, a in enumerate(marks) for b in marks[k + 1:] if (a ^ b).bit_count() <= 3]


def test_simhash(spark, make):
    pairs = every_text(spark)
    marks = {t: fingerprint(t) for _, t in pairs}
    group = roots(set(marks.values()), close_pairs(set(marks.values())))
    least = {}
    for i, t in pairs:
        g = group[marks[t]]
        least[g] = min((x for x in (least.get(g), i) if x is not None), default=None)
    got = simhash.near_duplicates(make(pairs))
    assert (counted((r.doc_id, r.mark & (2 ** 64 - 1), r.component_id) for r in got.collect())
            == counted((i, marks[t], least[group[marks[t]]]) for i, t in pairs))
    assert simhash.near_duplicates(make([])).count() == 0


@pytest.mark.parametrize("block", [8, 2048])
def test_links_of_dense_groups(spark, block):
    """Many fingerprints within a few bits of each other, so that cells are cut into blocks."""
    rng = random.Random(3)
    marks = set()
    for centre in (rng.getrandbits(64) for _ in range(6)):
        for _ in range(90):
            marks.add(centre ^ sum(1 << b for b in {rng.randrange(64) for _ in range(rng.randrange(5))}))
    signed = {m: m - (1 << 64) if m >> 63 else m for m in marks}
    frame = spark.createDataFrame([(s,) for s in signed.values()], "mark long")
    links = simhash.near_links(frame, block=block)
    found = {r.node: r.root for r in components.components(links).collect()}
    want = roots(marks, close_pairs(marks))
    groups = collections.defaultdict(set)
    for m in marks:
        groups[want[m]].add(found.get(signed[m], signed[m]))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(1000, 1001), (5, 5)], "u long, v long")
    got = collections.defaultdict(set)
    for r in components.components(edges).collect():
        got[r.root].add(r.node)
    assert sorted(map(sorted, got.values())) == [list(range(201)), [1000, 1001]]


# --- byte-level BPE

@pytest.fixture(scope="module")
def library():
    import public_tokenizers as P
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(byte_bpe.rank_file(), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_library(spark, make, library):
    rng = random.Random(2)
    parts = [" ", "  ", "\n", "\t", "a", "B", "'s", "'re", "'lx", "''", "1", "٣", "é", "!", "　", "'ve ", "漢", "😀"]
    pairs = every_text(spark) + [(5000 + k, "".join(rng.choice(parts) for _ in range(rng.randrange(25)))) for k in range(300)]
    pairs.append((6000, "".join(rng.choice("abcdefgh") for _ in range(3000))))
    docs, path = make(pairs), byte_bpe.rank_file()
    want = [(i, np.array(library.encode_ordinary(t or ""), "<u4"), t or "") for i, t in pairs]
    got = byte_bpe.round_trip(docs, path)
    assert counted(got.collect()) == counted((i, len(x), sha(x.tobytes()), sha(t)) for i, x, t in want)
    encoded = byte_bpe.encode(docs, path)
    assert counted((r.doc_id, tuple(r.ids)) for r in encoded.collect()) == counted((i, tuple(x.tolist())) for i, x, _ in want)
    decoded = byte_bpe.decode(encoded, path)
    assert counted((r.doc_id, bytes(r.bytes)) for r in decoded.collect()) == counted((i, t.encode()) for i, _, t in want)
    assert byte_bpe.round_trip(make([]), path).count() == 0


# --- personal data

def spans_expected(text):
    def digits(x):
        return re.sub("[^0-9]", "", x)
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 14 <= len(digits(m[0])) <= 19 and pii.luhn(digits(m[0]))]
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= len(digits(m[0])) <= 15]
    return sorted(out)


def test_pii(spark, make):
    rng = random.Random(5)
    parts = ["a", "Z", "@", "@x.y", ".", "-", "+", "1", "23", "256", "4111111111111111", "+1 555", " ", "\n", "(", ")", "é", "%"]
    pairs = every_text(spark) + [(5000 + k, "".join(rng.choice(parts) for _ in range(rng.randrange(22)))) for k in range(3000)]
    pairs.append((9001, "1" * 6000 + "." + "0" * 5000 + ".1.1"))
    field = pii.train()
    got = {(r.doc_id, r.base_sha256, r.n_email, r.n_ip, r.n_card, r.n_phone): r for r in pii.personal_data(make(pairs), field).collect()}
    for i, t in pairs:
        if i == 9001:
            continue
        base = spans_expected(t or "")
        written = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in base)
        row = got[(i, sha(written), *(sum(k == kind for _, k, _ in base) for kind in range(4)))]
        assert set(filter(None, written.split(","))) <= set(row.spans.split(","))
    assert pii.personal_data(make([]), field).count() == 0


def test_field_adds_spellings_that_patterns_miss():
    field = pii.train()

    def added(text):
        return [(pii.KINDS[k], text[a:b]) for a, k, b in pii.added_spans(field, [text], [pii.base_spans(text)])[0]]
    assert added("please call (212) 555-0187 now") == [("phone", "(212) 555-0187")]
    assert added("mail kim (at) corp.example.org now") == [("email", "kim (at) corp.example.org")]
    assert added("on 2024-01-02 10:11:12 we had 1234567890123 of them") == []


# --- language

def test_language_id(spark, make):
    texts = {"en": "the cat sat on the mat and then it went to the house with them ", "de": "der hund und die katze sind nicht in dem haus das ist schön ",
             "fr": "le chat est dans la maison avec les enfants où être élève "}
    rows = [(i, t * (1 + i % 5), lang) for lang, t in texts.items() for i in range(30)]
    docs = make([(k, t) for k, (_, t, _) in enumerate(rows)], None).drop("lang")
    langs = spark.createDataFrame([(k, lang) for k, (_, _, lang) in enumerate(rows)], "doc_id long, lang string")
    model = language_id.fit(docs.join(langs, "doc_id"))
    got = {r.doc_id: r for r in language_id.identify(docs, model).collect()}
    assert all(got[k].lang_pred == lang and 0 <= got[k].score <= 1 for k, (_, _, lang) in enumerate(rows))
    assert all(got[k].held_out == (zlib.crc32(str(k).encode()) % 5 == 0) for k in got)
    odd = language_id.identify(make(odd_texts()), model).collect()
    letters = {t: t is not None and any(c.isalpha() for c in t) for _, t in odd_texts()}
    assert len(odd) == len(odd_texts())
    assert sum(r.lang_pred == "und" for r in odd) == sum(not letters[t] for _, t in odd_texts())
    assert {r.lang_pred for r in language_id.identify(docs, None).collect()} == {"und"}
    assert language_id.fit(docs.join(langs, "doc_id").limit(0)) is None
    clashing = make(odd_texts()).withColumns({"lang_pred": F.lit("x"), "lang_score": F.lit(1), "row": F.lit(2), "held_out": F.lit(3)})
    rows = language_id.with_language(clashing, model)
    assert rows.columns == ["row", "lang_pred", "lang_score"] and rows.select("row.*").columns == clashing.columns
    assert counted((r.doc_id, r.text) for r in rows.select("row.*").collect()) == counted(odd_texts())


def test_code_lengths_against_a_plain_tree():
    import pyarrow as pa

    train = {"a": ["abracadabra abra", "abc abd"], "b": ["banana bandana", "ban"]}
    model_rows = []
    for k, (lang, texts) in enumerate(train.items()):
        gram, _, _ = language_id._stream(pa.array(texts))
        for g in gram:
            model_rows.append((k, int(g)))
    count = collections.Counter(model_rows)
    keys = sorted(count)
    model = language_id.Model(list(train), np.array([k for k, _ in keys]), np.array([g for _, g in keys], np.uint64), np.array([count[k] for k in keys]))
    text = "abra ban xyz é"
    got = model.bits(pa.array([text, ""]), model.lookup())
    stream = b"   " + text.encode()
    for k, texts in enumerate(train.values()):
        seen = collections.defaultdict(collections.Counter)
        for t in texts:
            s = b"   " + t.encode()
            for i in range(3, len(s)):
                for n in range(4):
                    seen[s[i - n:i]][s[i]] += 1
        bits = 0.0
        for i in range(3, len(stream)):
            for n in (3, 2, 1, 0, -1):
                if n < 0:
                    bits += 8
                    break
                c = seen.get(stream[i - n:i])
                if c is None:
                    continue
                if c[stream[i]]:
                    bits -= math.log2(c[stream[i]] / (sum(c.values()) + len([x for x in c.values() if x])))
                    break
                bits -= math.log2(len([x for x in c.values() if x]) / (sum(c.values()) + len([x for x in c.values() if x])))
        assert got[0, k] == pytest.approx(bits, rel=1e-5)
    assert got[1].tolist() == [0, 0]


# --- quality classifier

def test_quality_classifier(spark, make):
    rng = random.Random(1)
    good, bad = ["fine", "clear", "useful", "sound"], ["junk", "spam", "awful", "broken"]
    rows = []
    for i in range(400):
        g = i % 3
        rows.append((i, g, " ".join(rng.choice(good if rng.random() < (0.05, 0.5, 0.95)[g] else bad) for _ in range(30))))
    docs = make([(i, t) for i, _, t in rows] + [(None, "x"), (1000, None), (1001, "")])
    ratings = spark.createDataFrame([(i, g) for i, g, _ in rows if i < 300] + [(None, 1), (5, 0), (9, 77)], "doc_id long, grade int")
    model = quality_classifier.fit(docs, ratings, 3)
    got = {r.doc_id: r for r in quality_classifier.rate(docs, model).collect()}
    assert len(got) == 403
    mean = [np.mean([got[i].grade for i, g, _ in rows if g == k and i >= 300]) for k in range(3)]
    assert mean[0] + 0.3 < mean[1] < mean[2] - 0.3
    assert all(r.tails[0] >= r.tails[1] and abs(sum(r.tails) - r.grade) < 1e-9 for r in got.values())
    assert quality_classifier.fit(docs, ratings.limit(0), 3) is None
    assert {r.grade for r in quality_classifier.rate(docs, None).collect()} == {None}
    assert quality_classifier.rate(make([]), model).count() == 0


# --- decontamination

def test_default_masks_meet_every_window_with_four_substitutions():
    import itertools

    for gone in itertools.combinations(range(20), 4):
        assert any(all(s + o not in gone for o in mask) for mask in decontamination.MASKS for s in range(20 - mask[-1]))


def contamination_expected(pairs, items):
    def words(t):
        return re.findall(r"[a-z0-9\u0080-\U0010ffff]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    out = set()
    for i, t in pairs:
        d = words(t)
        for j, x in items:
            b = words(x)
            n = len(b)
            if not n:
                continue
            for shift in range(-n + 1, len(d)):
                same = [0 <= k + shift < len(d) and d[k + shift] == b[k] for k in range(n)]
                size = min(20, n)
                for k in range(n - size + 1):
                    inside = 0 <= k + shift and k + size + shift <= len(d)
                    if inside and sum(same[k:k + size]) >= 0.8 * size and (n >= 7 or all(same)):
                        out.add((i, j))
    return out


def test_decontamination(spark, make):
    rng = random.Random(4)
    vocabulary = [f"w{k}" for k in range(400)]
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(n))) for k, n in enumerate((45, 30, 20, 12, 5, 1))] + [(7, None), (8, ""), (0, "w1 w2")]
    pairs = [p for p in odd_texts() if p[1] is None or len(p[1]) < 1000]
    for k in range(60):
        filler = [rng.choice(vocabulary) for _ in range(60)]
        part = items[k % 6][1].split()
        for s in rng.sample(range(len(part)), min(len(part), rng.choice((0, 2, 4, 9)))):
            part[s] = "changed"
        pairs.append((2000 + k, " ".join(filler[:30]) + ", " + " ".join(part).upper() + ". " + " ".join(filler[30:])))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.contaminated(make(pairs), bench)
    assert {(r.doc_id, r.item_id) for r in got.collect()} == contamination_expected(pairs, items)
    assert decontamination.contaminated(make([]), bench).count() == 0
    assert decontamination.contaminated(make(pairs), bench.limit(0)).count() == 0


def test_hits_are_compared_in_tasks_with_one_python_worker(spark, make):
    """Hashes and comparison in one task held two workers of it; all of them stayed with the executor."""
    bench = spark.createDataFrame([(1, " ".join(f"b{k}" for k in range(30)))], "item_id long, text string")
    got = decontamination.contaminated(make([(1, "x " + " ".join(f"b{k}" for k in range(30))), (2, "nothing")]), bench)
    nodes = got._jdf.queryExecution().executedPlan().toString().splitlines()
    compared = max(k for k, line in enumerate(nodes) if "ArrowEvalPython" in line)
    # Below the comparison only the items are hashed, on the far side of an exchange.
    (hashed,) = [k for k, line in enumerate(nodes) if "MapInArrow" in line]
    assert any("Exchange" in line for line in nodes[compared:hashed])
    assert [(r.doc_id, r.item_id, r.first_word, r.last_word) for r in got.collect()] == [(1, 1, 1, 30)]


# --- substring dedup

def test_substring_dedup(spark, make):
    passage = "One long sentence of a passage that is repeated here. Another sentence that follows it closely and is long. " \
              "A third sentence with many more words than the others had before. And the last one of this passage comes now."
    pairs = odd_texts() + [
        (201, "Own words come first in this text. " + passage + " Tail of the first."),
        (202, "Quite another beginning here, mid-line é. " + passage.upper() + " Some different tail follows."),
        (203, "Only one long sentence of a passage that is repeated here."), (None, passage), (204, passage), (204, passage)]
    docs = make(pairs)
    spans = substring_dedup.repeated_spans(docs)
    got = collections.defaultdict(list)
    for r in spans.collect():
        got[r.doc_id].append((r.start, r.end, r.keep_doc_id))
    text = dict(pairs)
    assert 201 not in got and 203 not in got
    (a, b, keep), = got[202]
    assert text[202][a:b] == passage.upper()[:-1] and keep == 201
    assert got[204] == [(0, len(passage) - 1, 201)] and got[None] == [(0, len(passage) - 1, 201)]
    left = {r.doc_id: r.text for r in substring_dedup.remove_spans(docs, spans).collect()}
    assert left[202] == "Quite another beginning here, mid-line é. . Some different tail follows." and left[201] == text[201]
    assert substring_dedup.repeated_spans(make([])).count() == 0


def test_substring_dedup_of_single_units_and_cut_passages(spark, make):
    line = "This one sentence has nine words and comes again."
    inner = "the river ran past the mill. Nobody had opened its doors. Then at last the"
    pairs = [
        (1, f"Something new stands before it. {line} And new words follow here."),
        (2, f"Quite different words come first. {line} Other things are said behind it."),
        (3, f"All the while {inner} miller came back."), (4, f"Some say {inner} owner went away."),
        (5, "Three short words. Nothing else here is repeated elsewhere."), (6, "Three short words. What follows is all its own."),
        # the second unit is kept here for 8: the words it shares with 7 stay with it
        (7, f"{line} Grey birds sang over there."), (8, f"{line} Grey birds sleep in that tree over the water."),
        (9, "Grey birds sleep in that tree over the water. Once more."),
    ]
    docs = make(pairs)
    spans = substring_dedup.repeated_spans(docs)
    left = {r.doc_id: r.text for r in substring_dedup.remove_spans(docs, spans).collect()}
    text = dict(pairs)
    assert all(left[k] == text[k] for k in (1, 3, 5, 6))
    assert left[2] == "Quite different words come first. . Other things are said behind it."
    assert left[4] == "Some say  owner went away."
    assert left[7] == ". Grey birds sang over there." and left[8] == ". Grey birds sleep in that tree over the water."
    assert left[9] == ". Once more."
    (words, keep), = ((r.n_words, r.keep_doc_id) for r in spans.collect() if r.doc_id == 4)
    assert (words, keep) == (len(inner.split()), 3)


def sentences(text):
    """(first word, words) of the units of a text, and where each of its words begins and ends."""
    found = [(m.group().lower(), m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9]+", text)]
    cut = [k for k, (_, a, _) in enumerate(found) if k == 0 or re.search(r"\n|[.!?](?=[ \t\r\n])", text[found[k - 1][2]:a])]
    return [(a, tuple(w for w, _, _ in found[a:b])) for a, b in zip(cut, cut[1:] + [len(found)])], found


def later_words(pairs):
    """For each text the words that go when every later sentence goes, with the equal words beside it that reach
    at most to the far end of a neighbour that is not kept."""
    texts = [(i, *sentences(t)) for i, t in pairs]
    kept = {}
    for n, (_, units, _) in enumerate(texts):
        for u, (_, words) in enumerate(units):
            kept.setdefault(words, (n, u))
    repeated = {w for w, c in collections.Counter(w for _, units, _ in texts for _, w in units).items() if c > 1}
    out = {}
    for n, (i, units, _) in enumerate(texts):
        gone = set()
        for u, (a, words) in enumerate(units):
            if kept[words] == (n, u):
                continue
            gone.update(range(a, a + len(words)))
            kn, ku = kept[words]
            for step in (-1, 1):
                if not (0 <= u + step < len(units) and 0 <= ku + step < len(texts[kn][1])):
                    continue
                b, mine = units[u + step]
                other = texts[kn][1][ku + step][1]
                if kept[mine] == (n, u + step) and mine in repeated:
                    continue
                k = 0
                while k < min(len(mine), len(other)) and mine[::step][k] == other[::step][k]:
                    k += 1
                gone.update(range(b, b + k) if step == 1 else range(b + len(mine) - k, b + len(mine)))
        out[i] = gone
    return out


@pytest.mark.parametrize("seed", range(3))
def test_substring_dedup_of_every_sentence_against_brute_force(spark, make, seed):
    rng = random.Random(seed)
    pool = [[f"w{rng.randrange(14)}" for _ in range(rng.randrange(1, 6))] for _ in range(60)]

    def text():
        parts = [[f"w{rng.randrange(14)}" for _ in range(rng.randrange(1, 6))] if rng.random() < 0.5 else rng.choice(pool) for _ in range(rng.randrange(12))]
        return "".join(" ".join(w.capitalize() if rng.random() < 0.2 else w for w in p) + rng.choice((". ", "! ", "\n", ".\n")) for p in parts)

    pairs = [(k, text()) for k in range(60)]
    spans = substring_dedup.repeated_spans(make(pairs), min_words=1, unit_words=1).collect()
    wanted, cut = later_words(pairs), collections.defaultdict(list)
    for r in spans:
        cut[r.doc_id].append((r.start, r.end))
    for i, t in pairs:
        found = sentences(t)[1]
        got = {k for k, (_, a, b) in enumerate(found) if any(x <= a and b <= y for x, y in cut[i])}
        # A loop inside a sentence goes too: its words equal those of the round before.
        loops = {k for p in range(1, 9) for k, (w, _, _) in enumerate(found) if k >= p and w == found[k - p][0]}
        assert wanted[i] <= got and got - wanted[i] <= loops, (i, t)
    assert sum(map(len, wanted.values())) > 100


def test_substring_dedup_of_loops_and_long_sentences(spark, make):
    rng = random.Random(4)
    long = " ".join(f"v{rng.randrange(10_000)}" for _ in range(900))
    pairs = [
        (1, "Before it. " + "Again " * 60 + "and after."), (2, "é é " + "one two three, " * 20), (3, "no no no no no no no no"),
        (4, "yes " * 9), (5, f"Own start {long} own end"), (6, f"Quite another one {long} here"), (7, "Ping.\n" * 400 + "Pong went the bell."),
        (8, " ".join(f"u{k}" for k in range(500))), (9, "yes " * 9), (None, "yes " * 9)]
    docs = make(pairs)
    spans = substring_dedup.repeated_spans(docs)
    left = {r.doc_id: r.text for r in substring_dedup.remove_spans(docs, spans).collect()}
    text = dict(pairs)
    assert left[1] == "Before it. Again  and after."
    assert left[2] == "é é one two three, , " and left[3] == text[3] and left[8] == text[8] and left[5] == text[5]
    assert left[4].split() == ["yes"] and left[7].startswith("Ping.") and left[7].count("Ping") == 1
    assert [len(left[k].split()) for k in (9, None)] == [0, 0]
    assert left[6] == "Quite another one  here"
    kept = {r.doc_id: (r.keep_doc_id, r.keep_start) for r in spans.collect()}
    assert kept[1] == (1, 11) and kept[4] == (4, 0) and kept[9] == (4, 0)


# --- near copies

def shingles(text, size=5):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def near_expected(texts, share=0.8):
    """For each text the least text of its group; all pairs are compared on their sets of shingles."""
    texts = sorted(set(texts))
    sets = [shingles(t) for t in texts]
    holders = collections.defaultdict(list)
    for k, s in enumerate(sets):
        for x in s or {None}:
            holders[x].append(k)
    pairs = {(a, b) for g in holders.values() for n, a in enumerate(g) for b in g[n + 1:]}
    edges = [(a, b) for a, b in pairs if len(sets[a] & sets[b]) >= share * len(sets[a] | sets[b])]
    return {texts[k]: texts[r] for k, r in roots(range(len(texts)), edges).items()}


def near_corpus(seed=8):
    """Copies with a few words changed, added and cut, dense groups, and texts that only share some sentences."""
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(600)]
    pairs = []
    for g in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.choice((60, 200, 500)))]
        for _ in range(25):
            own = list(base)
            for _ in range(rng.randrange(1 + len(base) // 25)):
                at = rng.randrange(len(own))
                own[at:at + rng.randrange(2)] = [rng.choice(vocabulary)] * rng.randrange(3)
            pairs.append((len(pairs), (" " if g % 2 else "\n").join(own).upper() if g % 3 else " ".join(own)))
        pairs.append((len(pairs), " ".join(base[:len(base) // 2] + [rng.choice(vocabulary) for _ in base])))
    return pairs


@pytest.mark.parametrize("block", [16, 2048])
def test_near_copies(spark, make, block, monkeypatch):
    pairs = near_corpus() + [(1000 + k if k is not None else None, t) for k, t in odd_texts()] + [(7, "")]
    monkeypatch.setattr(near_copies.candidate_links, "__defaults__", (near_copies.RADIUS, block))
    group = near_expected([t or "" for _, t in pairs])
    least = {}
    for i, t in pairs:
        g = group[t or ""]
        least[g] = min((x for x in (least.get(g), i) if x is not None), default=None)
    got = near_copies.near_copies(make(pairs)).collect()
    assert counted((r.doc_id,) for r in got) == counted((i,) for i, _ in pairs)
    # No link is false; of the true ones, those just at the limit may be missed.
    wanted, found = {i: least[group[t or ""]] for i, t in pairs if i is not None}, {r.doc_id: r.component_id for r in got if r.doc_id is not None}
    assert all(wanted[found[i]] == wanted[i] for i in found if found[i] is not None)
    assert sum(found[i] != wanted[i] for i in wanted) <= 0.01 * len(wanted)
    assert near_copies.near_copies(make([])).count() == 0


@pytest.mark.parametrize("radius", [0, near_copies.RADIUS])
def test_no_near_copy_is_missed_whatever_the_fingerprints_say(spark, make, radius, monkeypatch):
    """Also where few fingerprints or none meet, the groups are those of all pairs; some pairs are just at the limit."""
    rng = random.Random(11)
    pairs = near_corpus() + [(1000 + k, t) for k, t in enumerate(["", "  ", "a b", "A  B", "a b c d e", "f a b c d e", "one two three four five six seven eight nine",
                                                                  "one two three four five six seven eight nine ten"])]
    for k in range(40):  # one word of 44 to 63 exchanged: shares of 0.78 to 0.84
        base = [f"v{rng.randrange(5000)}" for _ in range(44 + k % 20)]
        other = list(base)
        other[len(base) // 2] = "other"
        pairs += [(2000 + 2 * k, " ".join(base)), (2001 + 2 * k, " ".join(other))]
    group = near_expected([t for _, t in pairs])
    least = {}
    for i, t in pairs:
        least[group[t]] = min(least.get(group[t], i), i)
    monkeypatch.setattr(near_copies, "BROADCAST", 0 if radius else near_copies.BROADCAST)
    got = near_copies.near_copies(make(pairs), radius=radius).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: least[group[t]] for i, t in pairs}


def shuffled_bytes(spark):
    """Bytes of the shuffle files there are, by file."""
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    files = [found.apply(k) for k in range(found.size())]
    return {f.getPath(): f.length() for f in files if f.getName().startswith("shuffle_")}


def left_since(spark, before, most=0, seconds=10):
    """Bytes of new shuffle files, once they are ``most`` or the seconds are over: Spark removes them in the background."""
    end = time.time() + seconds
    while (left := sum(n for f, n in shuffled_bytes(spark).items() if f not in before)) > most and time.time() < end:
        time.sleep(0.2)
    return left


def test_steps_that_are_written_keep_no_shuffle_files(spark, make):
    """Else those of all steps of the near-copy stage lie on disk together until the driver collects its garbage."""
    before = shuffled_bytes(spark)
    counted_rows = spark.range(50_000).groupBy((F.col("id") % 1000).alias("k")).count()
    kept = common.settled(counted_rows)
    assert left_since(spark, before) == 0
    assert spark.conf.get(common.RELEASE, None) is None
    # What is read again is still there, and the plan of what was settled can be run anew.
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, counted_rows.collect())) == [(k, 50) for k in range(1000)]
    before = shuffled_bytes(spark)
    found = near_copies.near_copies(make(near_corpus()))
    # The steps are done, the last join is not; counts of single rows stay.
    assert left_since(spark, before, 20_000) <= 20_000
    assert found.count() == len(near_corpus())


def test_a_forest_connects_what_all_pairs_connect():
    rng = np.random.default_rng(3)
    for n in (2, 5, 40, 120):
        far = rng.integers(0, 100, (n, n)).astype(np.uint16)
        far = np.minimum(far, far.T)
        np.fill_diagonal(far, near_copies.FAR)
        radius = 200 // n
        want = roots(range(n), [(a, b) for a in range(n) for b in range(n) if far[a, b] <= radius])
        u, v = near_copies.forest(far, radius)
        assert (far[u, v] <= radius).all() and len(u) <= 2 * n
        found = roots(range(n), list(zip(u.tolist(), v.tolist())))
        assert {(a, b) for a in range(n) for b in range(n) if found[a] == found[b]} == {(a, b) for a in range(n) for b in range(n) if want[a] == want[b]}


def test_cells_agree_with_segment_counts():
    marks = np.random.default_rng(4).integers(0, 256, (50, 64)).astype(np.uint8)
    bits = np.unpackbits(marks, axis=1).reshape(50, 32, 8, 2).sum(axis=3)
    cells = near_copies.cells_of(marks)
    for band in range(32):
        same = cells[:, None, band] == cells[None, :, band]
        assert (same == (bits[:, None, band] == bits[None, :, band]).all(axis=2)).all()


# --- hot digests

def largest_join_is_split(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return "skew=true" in plan


@pytest.mark.parametrize("which", ["lines", "units"])
def test_a_line_in_every_document_is_joined_in_parts(spark, which):
    """One line or sentence in all of 30,000 documents: Spark splits its rows in the join."""
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.shuffle.partitions": "8", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        line = "this very line stands in every document of the whole collection"
        docs = spark.range(30_000).select(
            F.col("id").alias("doc_id"),
            F.concat(F.lit(line + (".\n" if which == "units" else "\n")), F.format_string("and %d is a number of its own.", "id")).alias("text"))
        if which == "lines":
            out = line_dedup.line_dedup(docs)
            out.write.format("noop").mode("overwrite").save()
            rows = out.groupBy("n_dropped").count()
            found = {r["n_dropped"]: r["count"] for r in rows.collect()}
            assert found == {0: 1, 1: 29_999}
            out.collect()
        else:
            out = substring_dedup.repeated_spans(docs)
            assert len({r.doc_id for r in out.collect()}) == 29_999
        assert largest_join_is_split(out)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# --- short benchmark items

@pytest.mark.parametrize("n", range(7, 20))
def test_every_substitution_in_a_short_item_is_met(n):
    import itertools

    masks = [*decontamination.MASKS, *([decontamination.SHORT_MASK] if n < decontamination.SHORT else [])]
    for gone in itertools.combinations(range(n), n - math.ceil(0.8 * n)):
        assert any(all(s + o not in gone for o in mask) for mask in masks for s in range(n - mask[-1]))


@pytest.mark.parametrize("n", [7, 10, 11, 12, 15, 16])
def test_short_items_are_found_under_all_their_substitutions(spark, make, n):
    import itertools

    item = [f"word{k}" for k in range(n)]
    pairs = []
    for gone in itertools.combinations(range(n), n - math.ceil(0.8 * n)):
        text = [f"other{k}" if k in gone else w for k, w in enumerate(item)]
        pairs.append((len(pairs), "before it " + " ".join(text) + " and after"))
    over = [f"other{k}" if k < n - math.ceil(0.8 * n) + 1 else w for k, w in enumerate(item)]
    bench = spark.createDataFrame([(0, " ".join(item))], "item_id long, text string")
    got = decontamination.contaminated(make([*pairs, (9999, " ".join(over))]), bench)
    assert {r.doc_id for r in got.collect()} == {i for i, _ in pairs}


# --- the random field

def test_decoding_in_blocks_equals_one_pass():
    field = pii.train(steps=20)
    rng = np.random.default_rng(1)

    def plain(shapes):
        score = field.weights[pii.Field.features(shapes[None])].sum(axis=2)[0]
        best, back = score[0], []
        for t in range(1, len(shapes)):
            to = best[:, None] + field.steps
            back.append(to.argmax(axis=0))
            best = to.max(axis=0) + score[t]
        out = [int(best.argmax())]
        for b in back[::-1]:
            out.append(int(b[out[-1]]))
        return out[::-1]

    sequences = [rng.integers(1, pii.N_SHAPES, n) for n in (1, 2, 5, 63, 64, 65, 128, 129, 300, 1000)] * 2
    for shapes, labels in zip(sequences, field.decode(sequences)):
        assert labels.tolist() == plain(shapes)
    for shapes in [rng.integers(1, pii.N_SHAPES, n) for n in (1, 2, 3, 4)]:  # all labellings
        import itertools

        score = field.weights[pii.Field.features(shapes[None])].sum(axis=2)[0]

        def value(row):
            return sum(score[t, y] for t, y in enumerate(row)) + sum(field.steps[a, b] for a, b in zip(row, row[1:]))
        best = max(itertools.product(range(len(pii.LABELS)), repeat=len(shapes)), key=value)
        assert value(field.decode([shapes])[0].tolist()) == pytest.approx(value(best))


def test_the_gradient_reaches_the_labels():
    field = pii.train()
    shapes, labels, length = pii.labelled()
    rows = [s[:n] for s, n in zip(shapes, length)]
    right = sum((got == y[:n]).sum() for got, y, n in zip(field.decode(rows), labels, length))
    assert right / length.sum() > 0.99


def test_spans_are_never_cut(spark):
    field = pii.train()

    def added(text):
        return [(pii.KINDS[k], text[a:b]) for a, k, b in pii.added_spans(field, [text], [pii.base_spans(text)])[0]]
    long_name = "firstname.middlename.lastname.departmentname (at) corp.example.org"
    assert added(long_name) == [("email", long_name)]
    assert added(f"write to {long_name} today") == [("email", long_name)]
    assert added("kim (AT) corp.example.org") == [("email", "kim (AT) corp.example.org")]
    assert added("tel 030 1234 5678") == [("phone", "030 1234 5678")]
    assert added("we met at the old house. It was late") == []
    # Offsets count from the text's beginning, in every line.
    text = "first line\n" * 500 + "tel 030 1234 5678 between 9 and 5\nlast"
    assert added(text) == [("phone", "030 1234 5678")]


def test_a_long_text_of_digits():
    import time

    text = "12 34 56, " * 30_000
    start = time.perf_counter()
    assert pii.added_spans(pii.train(), [text], [pii.base_spans(text)]) == [[]]
    assert time.perf_counter() - start < 60


# --- quality rules by brute force

def test_scores_and_verdicts(spark, make):
    rng = random.Random(5)
    good, all_words = ["sound", "clear", "fine", "useful"], ["sound", "clear", "fine", "useful", "junk", "spam", "win", "now"]
    pairs = [(i, " ".join(rng.choice(good if i % 3 else all_words) for _ in range(60 + i % 7))) for i in range(90)] + [(500, None), (501, "sound")]
    labels = [(i, int(i % 3 > 0), 0) for i in range(60)]
    docs = make(pairs)
    m = 64
    ratios, low = quality_rules.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), m, loss=0.1)

    def hashes(values, kind):
        frame = spark.createDataFrame([(k, v) for k, v in enumerate(values)], f"k int, v {kind}")
        key = F.xxhash64("v") if kind == "string" else F.xxhash64(F.col("v")[0], F.col("v")[1])
        return {r.k: r.h for r in frame.select("k", key.alias("h")).collect()}
    vocabulary = sorted(set(all_words))
    word = dict(zip(vocabulary, (h for _, h in sorted(hashes(vocabulary, "string").items()))))
    both = [(a, b) for a in vocabulary for b in vocabulary]
    pair = dict(zip(both, (h for _, h in sorted(hashes([[word[a], word[b]] for a, b in both], "array<long>").items()))))

    def grams(text):
        w = (text or "").split()
        return [word[x] % m for x in w] + [pair[x] % m for x in zip(w, w[1:])]
    corpus, trusted = collections.Counter(), collections.Counter()
    for i, t in pairs:
        corpus.update(grams(t))
        if i < 60 and i % 3:
            trusted.update(grams(t))
    want = quality_rules.log_ratios([trusted[k] for k in range(m)], [corpus[k] for k in range(m)])
    assert ratios == pytest.approx(want)
    score = {i: sum(want[g] for g in grams(t)) / len(grams(t)) if t else 0.0 for i, t in pairs}
    got = {r.doc_id: r for r in quality_rules.quality_rules(docs, ratios, low).collect()}
    assert all(got[i].score == pytest.approx(score[i]) for i, _ in pairs)
    failed = {i: rules_expected(t)[-1] for i, t in pairs}
    assert all(got[i].kept == (not failed[i] and got[i].score >= low) for i, _ in pairs)
    below = sum(score[i] < low for i in range(60) if i % 3)
    assert 0 < below <= 4


# --- registered queries

@needs_tables
def test_line_dedup_query_equals_sql(spark):
    import __spark_entry__ as entry
    from workload.check import compare, duck, rows_of

    df = entry.queries()["op3_line_dedup"](spark, SF)
    cur = duck(SF).execute(entry.oracle_sql()["op3_line_dedup"])
    columns = [d[0] for d in cur.description]
    assert compare(rows_of(df.columns, df.collect()), rows_of(columns, cur.fetchall())) is None


@needs_tables
@pytest.mark.parametrize("number", [1, 2, 4, 5, 6, 7, 8, 9, 10])
def test_query_covers_its_table(spark, number):
    import __spark_entry__ as entry

    name, = (n for n in entry.queries() if n.startswith(f"op{number}_"))
    rows = entry.queries()[name](spark, SF).collect()
    ids = {i for i, _ in documents(spark)}
    if number in (1, 2):
        assert {r.doc_id for r in rows} <= ids
    else:
        assert sorted(r.doc_id for r in rows) == sorted(ids)


@needs_tables
def test_stages_take_columns_of_any_name(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumns(
        {c: F.lit("x") for c in ("lang_pred", "lang_score", "row", "carried", "first", "root", "text_hash", "lost", "mark", "held_out")})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and 0 < out.count() <= docs.count()
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()


def test_language_stage_without_a_model_keeps_what_has_letters(spark, make):
    import corpus_pipeline

    pairs = odd_texts()
    docs = make(pairs, None)
    got = corpus_pipeline._language(spark, docs, None)
    assert got.columns == docs.columns
    assert (counted((r.doc_id, r.text) for r in got.collect())
            == counted((i, t) for i, t in pairs if t is not None and any(c.isalpha() for c in t)))


@needs_tables
def test_pipeline_equals_its_stages_by_brute_force(spark, library):
    import corpus_pipeline

    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    rows = [(i, t) for i, t in rows if t and any(c.isalpha() for c in t)]
    rows = [(i, t) for i, t, _, _ in lines_expected(rows)]
    group = near_expected([t for _, t in rows])
    first = {}
    for i, t in rows:
        first[group[t]] = min(i, first.get(group[t], i))
    rows = [(i, t) for i, t in rows if first[group[t]] == i]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]

    def words(t):
        return re.findall(r"[a-z0-9\u0080-\U0010ffff]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t))
    bench = [(j, words(t)) for j, t in items]
    gone = set()
    for i, t in rows:
        place = collections.defaultdict(list)
        d = words(t)
        for k, w in enumerate(d):
            place[w].append(k)
        for _, b in bench:
            size = min(20, len(b))
            for shift in {k - p for p, w in enumerate(b) for k in place.get(w, ())}:
                same = [0 <= k + shift < len(d) and d[k + shift] == b[k] for k in range(len(b))]
                for k in range(len(b) - size + 1):
                    if 0 <= k + shift and k + size + shift <= len(d) and sum(same[k:k + size]) >= 0.8 * size:
                        gone.add(i)
    want = []
    for i, t in rows:
        if i not in gone:
            ids = np.array(library.encode_ordinary(t), "<u4")
            want.append((i, len(ids), sha(ids.tobytes()), sha(t)))
    got = corpus_pipeline.run(spark, SF).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert counted(got.collect()) == counted(want)
