"""Personal data: base patterns, and a linear-chain conditional random field over word shapes.

Base spans are what four patterns and their checks find.  The random field labels the pieces around
digits and at-signs (runs of letters or digits, single symbols, blanks) and adds spans of the same
kinds in spellings that the patterns miss, such as national phone numbers or "name (at) host.org".
It is trained on the small labelled table below and decoded by Viterbi in numpy batches; a stretch
grows within its line until no span touches its end.  An added span must pass its kind's check and
must not overlap another span; base spans always stay.

Defined results: a null text is an empty one; offsets are code points, end exclusive; every row
gets a result, repeated rows too.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from bisect import bisect_left
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import chunks, table, with_text

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *(f"{part}-{kind}" for kind in KINDS for part in "BI"))

#: The labelled table: [kind text] marks a span.
LABELLED = """\
write to [email jane.doe@example.com] today
mail [email jane (at) example.com] or call
mail: [email j.doe at example dot org] please
contact [email info[at]host.net] for more
[email bob_77(at)mail.example.org] said so
reach me under [email anna@mail dot example dot com] soon
the address [email tom at server.example.net] is old
from <[email x.y@host.co.uk]> to <[email z@host.de]>
we met at example street and at home
look at page 12 of the book at noon
he sat at table 4 dot the end
price @ 12.50 each and @ 3 per box
call [phone +1 (415) 555-0134] now
call [phone (415) 555-0134] now
phone [phone 415-555-0134] or come by
phone: [phone 415.555.0134], ask for Ann
tel [phone 030 1234 5678] between 9 and 5
tel [phone 030 1234 5678]
phone [phone 089 2345 6789], or write
call [phone 040 123 45678] for more
my mobile is [phone 0151 2345 6789] now
mail [email kim (AT) corp.example.org] again
[email first.middle.last.name (at) corp.example.org]
[email anna.b AT host.example.net] is new
[email jane (at) mail.example.org]
[email bob[at]example.net] wrote
[email tom (AT) server.example.net] and [email ann (at) host.org]
[phone (212) 555-0187] or [phone 030 123 45678]
to [email a.long.name.of.one (at) mail.example.org], and
tel. [phone 0171/555 0199] in the evening
the number is [phone 00 49 30 123 4567] there
numbers [phone (030) 123 4567] and [phone (714) 555-9345] work
mobile [phone 0044 20 7946 0958] at night
fax [phone 1-800-555-0199] all day
my number (212) is not complete
version 10.2.4 of 2024-05-17 came out
on 12.05.2024 at 14:30:15 we left
between 2019-2023 and 1998/1999 sales rose
rooms 101, 102, 103 and 104 are free
the sum 1,234,567.89 was paid in 3 parts
order 4711-0815-22 has 17 items
isbn 978-3-16-148410-0 is a book
server [ip 192.168.10.7] is down
ping [ip 10.0.0.1] and [ip 10.0.0.254] twice
hosts [ip 172 . 16 . 0 . 9] and so on
address [ip 203[.]0[.]113[.]5] was blocked
from [ip 8 dot 8 dot 4 dot 4] again
section 1.2.3.4.5.6 of the text
paid with [card 4111 1111 1111 1111] yesterday
card [card 4111-1111-1111-1111] expired
card no [card 5500.0000.0000.0004] is lost
visa [card 4012/8888/8888/1881] was used
amex [card 3782 822463 10005] too
number 4111111111111112 is an order id
id 20240517123456789 was written
token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"
key 9f86d081884c7d659a2feaa0c55ad015 was lost
in 1999 there were 365 days and 12 months
add 2 cups, 3 eggs and 250 g flour
score 3-2 after 90 minutes and 11 corners
a = 15 + 27 - 3 * ( 4 + 5 )
see [12] and [13], pages 100-120
"""

WORDS = ("at", "dot", "tel", "phone", "call", "mail", "fax", "mobile", "number", "card", "com", "org", "net", "de")
SYMBOLS = "@.-_+():/,;=%*#\"'&|[]<>!?$"
PIECE = re.compile(r"[A-Za-z]+|[0-9]+|\s+|[^A-Za-z0-9\s]")
OFFSETS = (-3, -2, -1, 0, 1, 2, 3)
N_SHAPES = 1 + 10 + 5 + len(WORDS) + 2 + len(SYMBOLS) + 1
#: Pieces of a sequence that are decoded as one block, blocks at a time, and pieces scored at a time.
LONG, GROUP, BLOCK = 64, 1024, 1 << 14


def shape(piece: str) -> int:
    """A number for the look of a piece; 0 stands for what lies outside the sequence."""
    c = piece[0]
    if c.isascii() and c.isdigit():
        n = len(piece)
        if n == 3:
            return 3 if int(piece) <= 255 else 10
        return n if n < 5 else 5 if n < 8 else 6 if n < 14 else 7 if n < 20 else 8
    base = 11
    if c.isascii() and c.isalpha():
        low = piece.lower()
        if low in WORDS:
            return base + 5 + WORDS.index(low)
        return base + (0 if len(piece) == 1 else 1 if piece.isupper() else 2 if piece.istitle() else 3 if len(piece) < 4 else 4)
    base += 5 + len(WORDS)
    if c.isspace():
        return base + (piece != " ")
    at = SYMBOLS.find(c)
    return base + 2 + (at if at >= 0 else len(SYMBOLS))


class Field:
    """Weights: for each neighbour offset by shape and label, for shape pairs, and label to label."""

    def __init__(self):
        n = len(LABELS)
        self.size = len(OFFSETS) * N_SHAPES + 2 * N_SHAPES * N_SHAPES
        self.weights, self.steps = np.zeros((self.size, n)), np.zeros((n, n))

    @staticmethod
    def features(shapes: np.ndarray) -> np.ndarray:
        """Feature numbers (batch, length, features) of padded shape numbers."""
        wide = np.pad(shapes, ((0, 0), (3, 3)))
        size = shapes.shape[1]
        at = {o: wide[:, 3 + o:3 + o + size] for o in OFFSETS}
        pair = len(OFFSETS) * N_SHAPES
        return np.stack([at[o] + k * N_SHAPES for k, o in enumerate(OFFSETS)]
                        + [pair + at[0] * N_SHAPES + at[1], pair + N_SHAPES ** 2 + at[-1] * N_SHAPES + at[0]], axis=2)

    def _emissions_at(self, flat: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Emissions at places of a flat row of shapes with three edges between sequences."""
        out = np.empty((len(at), len(LABELS)))
        pair = len(OFFSETS) * N_SHAPES
        for first in range(0, len(at), BLOCK):
            k = at[first:first + BLOCK]
            total = sum(self.weights[flat[k + o] + i * N_SHAPES] for i, o in enumerate(OFFSETS))
            total += self.weights[pair + flat[k] * N_SHAPES + flat[k + 1]]
            total += self.weights[pair + N_SHAPES ** 2 + flat[k - 1] * N_SHAPES + flat[k]]
            out[first:first + BLOCK] = total
        return out

    def _blocks(self, flat, start, length):
        """Groups of blocks (numbers, padded emissions), short ones together."""
        order = np.argsort(length, kind="stable")
        for first in range(0, len(order), GROUP):
            part = order[first:first + GROUP]
            wide = int(length[part].max())
            at = start[part, None] + np.minimum(np.arange(wide), length[part, None] - 1)
            yield part, self._emissions_at(flat, at.ravel()).reshape(len(part), wide, -1)

    def _through(self, score, length):
        """For each block the best score from every label before it to every label at its end."""
        now = self.steps[None] + score[:, 0][:, None, :]
        out = now.copy()
        for t in range(1, score.shape[1]):
            on = np.flatnonzero(length > t)
            new = now[on, :, 0, None] + self.steps[0]
            for k in range(1, len(LABELS)):
                np.maximum(new, now[on, :, k, None] + self.steps[k], out=new)
            new += score[on, t][:, None, :]
            now[on] = out[on] = new
        return out

    def decode(self, sequences: list[np.ndarray]) -> list[np.ndarray]:
        """The best labels of each sequence of shapes.

        A sequence is decoded in blocks of ``LONG`` pieces.  Where it has several, their best scores
        from label to label are combined first, which gives the state that each block begins with;
        so the result is that of one pass, while what is held beside the pieces is a pointer a label.
        """
        if not sequences:
            return []
        edge = np.zeros(3, np.int64)
        flat = np.concatenate([edge, *(x for s in sequences for x in (s, edge))])
        size = np.array([len(s) for s in sequences])
        begin = 3 + np.concatenate([[0], np.cumsum(size[:-1] + 3)])
        blocks = -(-size // LONG)
        owner = np.repeat(np.arange(len(size)), blocks)
        number = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        start = begin[owner] + number * LONG
        length = np.minimum(LONG, begin[owner] + size[owner] - start)
        state = np.full((len(owner), len(LABELS)), -np.inf)  # best score of each label before the block
        several = np.flatnonzero(blocks[owner] > 1)
        if len(several):
            through = np.empty((len(owner), len(LABELS), len(LABELS)))
            head = np.empty((len(owner), len(LABELS)))
            for part, score in self._blocks(flat, start[several], length[several]):
                through[several[part]] = self._through(score, length[several[part]])
                head[several[part]] = self._from_start(score, length[several[part]])
            for c in several:
                if number[c]:
                    before = head[c - 1] if number[c] == 1 else (state[c - 1][:, None] + through[c - 1]).max(axis=0)
                    state[c] = before - before.max()  # only differences count
        back = np.zeros((len(flat), len(LABELS)), np.int8)
        final = np.zeros(len(owner), np.int64)
        out = np.zeros(len(flat), np.int8)
        for part, score in self._blocks(flat, start, length):
            here, first, n = start[part], number[part] == 0, length[part]
            enter = state[part][:, :, None] + self.steps
            back[here] = enter.argmax(axis=1)
            best = np.where(first[:, None], score[:, 0], enter.max(axis=1) + score[:, 0])
            end = best
            for t in range(1, score.shape[1]):
                to = best[:, :, None] + self.steps
                on = n > t
                back[(here + t)[on]] = to.argmax(axis=1)[on]
                best = to.max(axis=1) + score[:, t]
                end = np.where(on[:, None], best, end)
            final[part] = end.argmax(axis=1)
            one = blocks[owner[part]] == 1
            label, at, n = final[part][one], here[one], n[one]
            for t in range(score.shape[1] - 1, -1, -1):
                on = n > t
                out[(at + t)[on]] = label[on]
                if t:
                    label = np.where(on, back[np.minimum(at + t, len(back) - 1), label], label)
        for s in np.flatnonzero(blocks > 1):  # the way back of a long sequence
            a, b = int(begin[s]), int(begin[s] + size[s])
            label = int(final[np.flatnonzero(owner == s)[-1]])
            for stop in range(b, a, -BLOCK):
                rows = back[max(a, stop - BLOCK):stop].tolist()
                for k in range(len(rows) - 1, -1, -1):
                    out[stop - len(rows) + k] = label
                    label = rows[k][label]
        return [out[a:a + n] for a, n in zip(begin.tolist(), size.tolist())]

    def _from_start(self, score, length):
        """Best score of each label at the block's end, for the block that begins a sequence."""
        now = score[:, 0]
        out = now
        for t in range(1, score.shape[1]):
            now = (now[:, :, None] + self.steps).max(axis=1) + score[:, t]
            out = np.where((length > t)[:, None], now, out)
        return out


def _log_sum(x, axis):
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def labelled() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Padded shapes and labels of the labelled table, and the lengths."""
    rows = []
    for line in LABELLED.splitlines():
        shapes, labels = [], []
        for kind, inside, outside in re.findall(r"\[(email|ip|card|phone) ((?:[^\[\]]|\[[^\[\]]*\])*)\]|((?:(?!\[(?:email|ip|card|phone) ).)+)", line):
            for k, piece in enumerate(PIECE.findall(inside or outside)):
                shapes.append(shape(piece))
                labels.append(LABELS.index(("I-" if k else "B-") + kind) if kind else 0)
        rows.append((shapes, labels))
    length = np.array([len(s) for s, _ in rows])
    out = np.zeros((2, len(rows), length.max()), np.int64)
    for i, (s, y) in enumerate(rows):
        out[0, i, :len(s)], out[1, i, :len(y)] = s, y
    return out[0], out[1], length


def train(steps: int = 120, rate: float = 0.1, penalty: float = 1e-3) -> Field:
    """Maximum likelihood by Adam; the gradient comes from forward and backward sums."""
    shapes, labels, length = labelled()
    field = Field()
    features = Field.features(shapes)
    n, size = shapes.shape
    inside = np.arange(size) < length[:, None]
    one = np.eye(len(LABELS))[labels] * inside[:, :, None]
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in (field.weights, field.steps)]
    pairs_seen = np.einsum("bti,btj->ij", one[:, :-1], one[:, 1:])
    for step in range(1, steps + 1):
        score = field.weights[features].sum(axis=2)
        forward, backward = score.copy(), np.zeros_like(score)
        for t in range(1, size):
            forward[:, t] = _log_sum(forward[:, t - 1, :, None] + field.steps, 1) + score[:, t]
        for t in range(size - 2, -1, -1):
            new = _log_sum(field.steps + (score[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
            backward[:, t] = np.where(inside[:, t + 1, None], new, 0.0)
        total = _log_sum(forward[np.arange(n), length - 1], 1)
        share = np.exp(forward + backward - total[:, None, None]) * inside[:, :, None]
        both = (forward[:, :-1, :, None] + field.steps + (score + backward)[:, 1:, None, :] - total[:, None, None, None])
        pairs = (np.exp(np.minimum(both, 0)) * inside[:, 1:, None, None]).sum(axis=(0, 1))
        gap = (share - one) / n
        by_weight = penalty * field.weights
        for k in range(features.shape[2]):
            np.add.at(by_weight, features[:, :, k], gap)
        for (m, v), p, g in zip(moments, (field.weights, field.steps), (by_weight, (pairs - pairs_seen) / n + penalty * field.steps)):
            m *= 0.9
            m += 0.1 * g
            v *= 0.99
            v += 0.01 * g * g
            p -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return field


EMAIL_TAIL = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
EMAIL_HEAD = re.compile(r"[A-Za-z0-9._%+-]*\Z")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
HEAD = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")


def luhn(digits: str) -> bool:
    twice = [2 * int(d) for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 if d > 9 else d for d in twice)) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str):
    """Matches of local@host.part: each at-sign takes the run of local characters before it."""
    done, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in HEAD:
            begin -= 1
        tail = EMAIL_TAIL.match(text, at) if begin < at else None
        if tail:
            yield begin, tail.end()
            done = tail.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end), in order."""
    out = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(len(q := p.lstrip("0")) < 4 and int(q or 0) <= 255 for p in m[0].split("."))]
        for m in CARD.finditer(text):
            digits = _digits(m[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return sorted(out)


DIGIT = re.compile("[0-9]")
#: Where a span may be: digits, at-signs, and an "at" before something that can be the dot of a host.
TRIGGER = re.compile(r"@|[0-9]+(?:[^\n0-9@]{0,12}[0-9@]+)*|(?:\(at\)|\[at\]|\sat\s)(?=[^\n]{1,80}?(?:\sdot\s|\(dot\)|\[dot\]|[A-Za-z0-9]\.[A-Za-z]))", re.I)


def valid(kind: int, text: str) -> bool:
    """The check of an added span."""
    digits = _digits(text)
    if kind == 0:
        plain = re.sub(r"\s*(?:\(at\)|\[at\]|\sat\s)\s*", "@", text, flags=re.I)
        plain = re.sub(r"\s*(?:\(dot\)|\[dot\]|\sdot\s)\s*", ".", plain, flags=re.I)
        return re.fullmatch(r"[A-Za-z0-9._%+-]+\s*@\s*[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", plain) is not None and plain != text
    if kind == 1:
        parts = re.findall("[0-9]+", text)
        return len(parts) == 4 and all(len(p) < 4 and int(p) <= 255 for p in parts) and re.fullmatch(r"[0-9.\[\]() dot]+", text) is not None
    if kind == 2:
        return 14 <= len(digits) <= 19 and luhn(digits) and re.fullmatch(r"[0-9][0-9 ./-]+[0-9]", text) is not None
    return 10 <= len(digits) <= 15 and re.fullmatch(r"\(?[0-9][0-9 ()./-]+[0-9]", text) is not None and re.search("[ ()./-]", text) is not None


def _reach(text: str, begin: int, end: int, more: int) -> tuple[int, int]:
    """The stretch with up to ``more`` characters of its line on either side, cut at blanks."""
    a, b = max(0, begin - more), min(len(text), end + more)
    line = text.rfind("\n", a, begin)
    a = line + 1 if line >= 0 else a
    while a > 0 and not text[a - 1].isspace():
        a -= 1
    line = text.find("\n", end, b)
    b = line if line >= 0 else b
    while b < len(text) and not text[b].isspace():
        b += 1
    return a, b


def windows(text: str, reach: int = 32) -> list[tuple[int, int]]:
    """Stretches around digits, at-signs and the like, in order and apart, where decoding begins."""
    out: list[tuple[int, int]] = []
    for m in TRIGGER.finditer(text):
        if out and m.end() <= out[-1][1] - reach:
            continue
        a, b = _reach(text, m.start(), m.end(), reach)
        if out and a <= out[-1][1]:
            a, b = out[-1][0], max(b, out.pop()[1])
        out.append((a, b))
    return out


def _pieces(text: str, begin: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the pieces begin (and the last one ends), and their shapes."""
    at, shapes = array("q"), array("q")
    for m in PIECE.finditer(text, begin, end):
        at.append(m.start())
        shapes.append(shape(m[0]))
    at.append(end)
    return np.frombuffer(at, np.int64), np.frombuffer(shapes, np.int64)


def _decoded(field: Field, texts: list[str], stretches: list[tuple[int, int, int]], reach: int = 64):
    """(text, piece bounds, labels) of the stretches (text, begin, end).  One with a span at its edge is
    widened within its line, and what it then touches is joined to it, until the field labels its ends O."""
    while stretches:
        pieces = [_pieces(texts[i], a, b) for i, a, b in stretches]
        labels = field.decode([s for _, s in pieces])
        wider: dict[int, list[tuple[int, int]]] = {}
        for (i, a, b), (at, _), row in zip(stretches, pieces, labels):
            text = texts[i]
            grown = (a, b)
            if len(row) and (row[0] or row[-1]):
                more = max(reach, b - a)
                c, d = _reach(text, a, b, more)
                grown = (c if row[0] else a, d if row[-1] else b)
            if grown == (a, b):
                yield i, at, row
            else:
                wider.setdefault(i, []).append(grown)
        stretches = []
        for i, spans in wider.items():
            joined: list[tuple[int, int]] = []
            for a, b in sorted(spans):
                if joined and a <= joined[-1][1]:
                    a, b = joined[-1][0], max(b, joined.pop()[1])
                joined.append((a, b))
            stretches += [(i, a, b) for a, b in joined]


def _spans(text: str, at: np.ndarray, row: np.ndarray):
    """The labelled spans (start, kind number, end) that pass their kind's check."""
    marked = np.flatnonzero(row)
    k = 0
    while k < len(marked):
        begin = last = int(marked[k])
        kind = (int(row[begin]) - 1) // 2
        k += 1
        while k < len(marked) and marked[k] == last + 1 and row[marked[k]] == 2 * kind + 2:
            last = int(marked[k])
            k += 1
        a, b = int(at[begin]), int(at[last + 1])
        inner = text[a:b]
        a, b = a + len(inner) - len(inner.lstrip()), b - len(inner) + len(inner.rstrip())
        if a < b and valid(kind, text[a:b]):
            yield a, kind, b


def added_spans(field: Field, texts: list[str], found: list[list]) -> list[list]:
    """For each text the field's spans (start, kind number, end) beside the found ones, which are in order."""
    stretches = [(i, a, b) for i, text in enumerate(texts) for a, b in windows(text)]
    more: dict[int, set] = {}
    for i, at, row in _decoded(field, texts, stretches):
        if row.any():
            more.setdefault(i, set()).update(_spans(texts[i], at, row))
    out: list[list] = [[] for _ in texts]
    for i, spans in more.items():
        starts = [a for a, _, _ in found[i]]
        furthest = list(accumulate((b for _, _, b in found[i]), max))
        done = 0  # where the last added span ends
        for a, kind, b in sorted(spans):
            before = bisect_left(starts, b)
            if a >= done and not (before and furthest[before - 1] > a):
                out[i].append((a, kind, b))
                done = b
    return out


def _written(spans: list) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def _find(field):
    def run(batches):
        for batch in chunks(batches):
            texts = batch.column("text").to_pylist()
            base = [base_spans(t) for t in texts]
            more = added_spans(field, texts, base)
            count = [[sum(k == kind for _, k, _ in spans) for spans in base] for kind in range(4)]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in count),
                pa.array([hashlib.sha256(_written(s).encode()).hexdigest() for s in base]),
                pa.array([_written([*s, *m]) for s, m in zip(base, more)], pa.string()),
                pa.array([len(m) for m in more], pa.int64())],
                names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"])
    return run


def personal_data(docs: DataFrame, field: Field) -> DataFrame:
    """One row a document: counts and digest of the base spans, all spans, and how many were added."""
    return with_text(docs).mapInArrow(
        _find(field), "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")


def op4_pii(spark, sf_dir):
    return personal_data(table(spark, sf_dir, "documents"), train())
