"""Personal data in texts: exact patterns, and a semi-Markov conditional random field that adds what they miss.

The field works on windows, the stretches of a text that hold many digits or look like an address. It scores whole segments of a
window, up to a fixed number of tokens, by features of the segment as a whole (digits, groups, checks, borders); dynamic
programming picks the best split of the window into typed segments and other tokens, so borders and types are chosen jointly.
It is trained on windows of a bounded sample of documents, with the patterns' spans as labels, and on variants of these that
people write to the same effect (no plus sign, "at" and "dot" spelled out), which the patterns do not know.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsieve.llm.common import hashed_share, texts_of

KINDS = ("email", "ip", "card", "phone")
LONGEST = 24  # tokens of a segment

# The patterns, written so that no text makes them backtrack: a digit run is only tried from its start, an address from its "@".
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            last = m.end()
        else:
            last = max(last, at + 1)
        at = text.find("@", max(at + 1, last))


def is_ip(s: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in s.split("."))


def is_card(s: str) -> bool:
    digits = s.replace(" ", "").replace("-", "")
    return 16 <= len(digits) <= 19 and luhn(digits)


def is_phone(s: str) -> bool:
    return 8 <= len(_DIGIT.findall(s)) <= 15


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the patterns by kind, then start."""
    found = [("email", *s) for s in _emails(text)]
    found += [("ip", *m.span()) for m in _IP.finditer(text) if is_ip(m[0])]
    found += [("card", *m.span()) for m in _CARD.finditer(text) if m.end() - m.start() >= 16 and is_card(m[0])]
    found += [("phone", *m.span()) for m in _PHONE.finditer(text) if is_phone(m[0])]
    return found


# Windows of the field.
_NUMBERS = re.compile(r"[+(]?[0-9](?:[\x20().+-]{0,3}[0-9]){6,}")
_SPELLED = re.compile(r"[\x20(\[](?:at|AT|dot|DOT)[\x20)\]]")
_WORD = re.compile(r"[A-Za-z0-9_%+.-]")
TOKEN = re.compile(r"[0-9]+|[A-Za-z]+|\x20|.", re.DOTALL)
REACH = 48


def windows(text: str) -> list[tuple[int, int]]:
    """Stretches worth a look, in order, not overlapping: many digits in a row, an "@", or "at" before "dot" spelled out."""
    found = [m.span() for m in _NUMBERS.finditer(text)]
    at = text.find("@")
    while at >= 0:
        found.append((max(0, at - REACH), min(len(text), at + REACH)))
        at = text.find("@", at + REACH)
    spelled = [m.span() for m in _SPELLED.finditer(text)] if "dot" in text or "DOT" in text else []
    for (a, b), (c, d) in zip(spelled, spelled[1:], strict=False):
        if text[a + 1 : b - 1].lower() == "at" and text[c + 1 : d - 1].lower() == "dot" and c - b < REACH:
            found.append((max(0, a - REACH), min(len(text), d + REACH)))
    merged: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if merged and a <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return merged


_SPELLED_ADDRESS = re.compile(r"[A-Za-z0-9._%+-]+(?:\x20at\x20|\x20?[\[(]at[\])]\x20?)[A-Za-z0-9-]+(?:(?:\x20dot\x20|\x20?[\[(]dot[\])]\x20?|\.)[A-Za-z0-9-]+)+", re.IGNORECASE)
_NUMBER_SHAPE = re.compile(r"\+?[\x20]?\(?[0-9][0-9\x20().-]*[0-9]")


def features(text: str, start: int, end: int) -> tuple[str, ...]:
    """Features of a whole segment."""
    s = text[start:end]
    digits = sum(map(s.count, "0123456789"))
    before, after = text[start - 1 : start], text[end : end + 1]
    out = ["bias", f"first={kind_of(s[0])}", f"last={kind_of(s[-1])}", f"before={kind_of(before)}", f"after={kind_of(after)}"]
    if "@" in s:
        whole = next(_emails(s), None) == (0, len(s))
        out.append("address" if whole and not (before and before in _LOCAL) and not (after and after in _LOCAL and after != ".") else "@")
    elif digits == 0 or any(c.isalpha() for c in s):
        out.append("spelled" if _SPELLED_ADDRESS.fullmatch(s) and not (before.isalnum() or after.isalnum()) else "letters")
    else:
        shape = re.sub("[0-9]+", lambda m: str(min(len(m[0]), 6)), s)
        out += [f"digits={min(digits, 20)}", f"shape={shape}" if len(shape) < 16 else "long shape"]
        alone = not (before.isalnum() or after.isalnum() or (after and text[end + 1 : end + 2].isdigit() and after in ".-"))
        if _IP.fullmatch(s):
            out.append("ip" if is_ip(s) and alone else "like ip")
        elif _CARD.fullmatch(s) and 16 <= digits <= 19:
            out.append("card" if luhn("".join(_DIGIT.findall(s))) and alone else "like card")
        elif _NUMBER_SHAPE.fullmatch(s) and 8 <= digits <= 15:
            groups = len(re.findall("[0-9]+", s))
            out.append(("plus " if s[0] == "+" else "") + ("phone" if groups >= 3 and alone else "like phone"))
        else:
            out.append("number")
    return tuple(out)


def kind_of(c: str) -> str:
    return "" if not c else "9" if c.isdigit() else "a" if c.isalpha() else " " if c.isspace() else c


@lru_cache(maxsize=100_000)
def _segment(around: str, start: int, end: int) -> tuple[str, ...]:
    """Features of a segment, given it with the characters next to it, so that no whole text is held."""
    return features(around, start, end)


@dataclass
class Field:
    """Weights by feature and kind; a token outside of all spans scores 0."""

    weights: dict[str, np.ndarray]

    def scores(self, text: str, ends: list[int]) -> list[list[tuple[int, tuple[str, ...], np.ndarray]]]:
        """For each token border, the segments that may end there: (border where it starts, features, score per kind)."""
        zero = np.zeros(len(KINDS))
        out: list[list] = [[]]
        for j in range(1, len(ends)):
            row = []
            for i in range(max(0, j - LONGEST), j):
                if text[ends[i]] != " " and text[ends[j] - 1] != " ":
                    low = max(0, ends[i] - 1)
                    f = _segment(text[low : ends[j] + 2], ends[i] - low, ends[j] - low)
                    row.append((i, f, sum((self.weights.get(x, zero) for x in f), zero)))
            out.append(row)
        return out

    def best(self, text: str, ends: list[int]) -> list[tuple[str, int, int]]:
        """Split of highest score; on ties, fewer segments."""
        best, back = [0.0], [None]
        for j, row in enumerate(self.scores(text, ends)):
            if j == 0:
                continue
            top, via = best[j - 1], None
            for i, _, s in row:
                k = int(s.argmax())
                if best[i] + s[k] > top + 1e-12:
                    top, via = best[i] + float(s[k]), (i, k)
            best.append(top)
            back.append(via)
        spans, j = [], len(ends) - 1
        while j > 0:
            if back[j] is None:
                j -= 1
            else:
                i, k = back[j]
                spans.append((KINDS[k], ends[i], ends[j]))
                j = i
        return spans[::-1]


def borders(text: str, start: int, end: int) -> list[int]:
    return [start, *(m.end() for m in TOKEN.finditer(text, start, end))]


def variants(text: str, spans: list[tuple[str, int, int]], rng: random.Random) -> tuple[str, list[tuple[str, int, int]]]:
    """The same text with its spans written another way, and the spans there."""
    out, marks, at = "", [], 0
    for kind, a, b in sorted(spans, key=lambda s: s[1]):
        s = text[a:b]
        if kind == "email":
            at_sign, dot = rng.choice([(" at ", " dot "), (" [at] ", " [dot] "), ("(at)", "(dot)"), (" at ", ".")])
            name, _, domain = s.partition("@")
            s = name + at_sign + domain.replace(".", dot)
        elif kind == "phone":
            body = s.lstrip("+").split(" ", 1)[-1] if " " in s else s[2:]
            s = rng.choice([body, body.replace(") ", ")-"), body.replace("(", "").replace(")", ""), body.replace("-", ".").replace(" ", "")])
            if not is_phone(s):
                s = text[a:b]
        elif kind == "card" and len(s) == 16:
            s = rng.choice([s, "-".join(s[i : i + 4] for i in range(0, 16, 4)), " ".join(s[i : i + 4] for i in range(0, 16, 4))])
        out += text[at:a]
        marks.append((kind, len(out), len(out) + len(s)))
        out += s
        at = b
    return out + text[at:], marks


def decoys(text: str, spans: list[tuple[str, int, int]], rng: random.Random) -> str:
    """The same text with numbers in place of its spans that are no personal data: failed checks, dates, lists."""
    out, at = "", 0
    day, hour = f"20{rng.randint(10, 29)}-{rng.randint(1, 12):02}-{rng.randint(1, 28):02}", f"{rng.randint(0, 23):02}:{rng.randint(0, 59):02}"
    numbers = [f"{day} {hour}:00", f"{day}T{hour}", day.replace("-", "") + hour.replace(":", ""), " ".join(str(rng.randint(0, 99)) for _ in range(rng.randint(5, 12)))]
    for kind, a, b in sorted(spans, key=lambda s: s[1]):
        s = text[a:b]
        if kind == "card":
            s = s[:-1] + str((int(s[-1]) + rng.randint(1, 9)) % 10)
        elif kind == "ip":
            s = rng.choice([f"{rng.randint(256, 999)}{s[s.index('.') :]}", f"{s}.{rng.randint(0, 99)}.{rng.randint(0, 9)}", *numbers])
        elif kind == "phone":
            s = rng.choice(numbers)
        else:
            s = s.replace("@", " ")
        out += text[at:a] + s
        at = b
    return out + text[at:]


def train_windows(text: str, rng: random.Random, around: int = 60) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """Short texts with their spans: the neighbourhood of each window as it is, in other writing, and with decoys instead."""
    spans, out = base_spans(text), []
    for a, b in windows(text):
        a, b = max(0, a - around), min(len(text), b + around)
        inside = [(k, s - a, e - a) for k, s, e in spans if a <= s and e <= b]
        if b - a > 400 or any(s < b < e or s < a < e for _, s, e in spans) or any(x[1] < y[2] and y[1] < x[2] for x in inside for y in inside if x < y):
            continue
        out.append((text[a:b], inside))
        if inside:
            out += [variants(text[a:b], inside, rng), (decoys(text[a:b], inside, rng), [])]
    return out


def train(samples: list[tuple[str, list[tuple[str, int, int]]]], rounds: int = 6, rate: float = 0.3, keep: float = 1e-3, seed: int = 5) -> Field:
    """Weights that maximise the likelihood of the labelled splits, by stochastic gradients over forward and backward sums."""
    field, squares = Field({}), {}
    cases = []
    for text, spans in samples:
        for a, b in windows(text):
            ends = borders(text, a, b)
            if len(ends) > 200:
                continue
            gold = {(ends.index(s), ends.index(e)): KINDS.index(k) for k, s, e in spans if s in ends and e in ends}
            cases.append((text, ends, gold))
    rng = random.Random(seed)
    for _ in range(rounds):
        rng.shuffle(cases)
        for text, ends, gold in cases:
            rows, n = field.scores(text, ends), len(ends)
            ahead, behind = np.zeros(n), np.full(n, -np.inf)
            for j in range(1, n):
                ahead[j] = np.logaddexp.reduce([ahead[j - 1], *(ahead[i] + np.logaddexp.reduce(s) for i, _, s in rows[j])])
            behind[-1] = 0.0
            for j in range(n - 1, 0, -1):
                behind[j - 1] = np.logaddexp(behind[j - 1], behind[j])
                for i, _, s in rows[j]:
                    behind[i] = np.logaddexp(behind[i], behind[j] + np.logaddexp.reduce(s))
            push: dict[str, np.ndarray] = {}
            for j in range(1, n):
                for i, f, s in rows[j]:
                    g = -np.exp(ahead[i] + s + behind[j] - ahead[-1])
                    if (i, j) in gold:
                        g[gold[i, j]] += 1.0
                    if np.abs(g).max() > 1e-6:
                        for x in f:
                            push[x] = push.get(x, 0.0) + g
            for x, g in push.items():
                w = field.weights.setdefault(x, np.zeros(len(KINDS)))
                h = squares.setdefault(x, np.full(len(KINDS), 1e-2))
                h += g * g
                w += rate * (g - keep * w) / np.sqrt(h)
    return field


def find(text: str, field: Field) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Spans of the patterns, and all spans: those and what the field adds outside of them, by kind, then start."""
    base = base_spans(text)
    added = []
    for a, b in windows(text):
        if any(s <= a and b <= e for _, s, e in base):
            continue
        for kind, s, e in field.best(text, borders(text, a, b)):
            if not any(s < y and x < e for _, x, y in base):
                added.append((kind, s, e))
    return base, sorted(base + added, key=lambda x: (KINDS.index(x[0]), x[1]))


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", most: int = 300, per_doc: int = 6, among: int = 30_000) -> Field:
    """Field from 2 * ``most`` windows with spans and ``most`` without, of about ``among`` documents chosen by a hash of the key.

    Only short neighbourhoods reach the driver, ``per_doc`` of a document at most.
    """
    schema = "h bigint, text string, kinds array<string>, spans array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for h, t in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), strict=True):
                for s, spans in train_windows(t, random.Random(h))[:per_doc]:
                    out.append((h, s, [k for k, _, _ in spans], [x for _, a, b in spans for x in (a, b)]))
            columns = list(zip(*out, strict=True)) if out else [[], [], [], []]
            types = [pa.int64(), pa.string(), pa.list_(pa.string()), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["h", "text", "kinds", "spans"])

    likely = hashed_share(key, docs.count(), among) & F.col(text).rlike(r"[0-9][^a-zA-Z]{5}|@")
    found = docs.where(likely).select(F.xxhash64(key).alias("h"), F.col(text).alias("t")).mapInArrow(run, schema)
    rows = []
    for with_spans in (True, False):
        part = found.where((F.size("kinds") > 0) == with_spans).orderBy("h", "text").limit(most * (2 if with_spans else 1))
        rows += [(r["text"], [(k, r["spans"][2 * i], r["spans"][2 * i + 1]) for i, k in enumerate(r["kinds"])]) for r in part.collect()]
    return train(sorted(rows))


def detect(docs: DataFrame, field: Field, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Spans of every whole text: key, ``base`` and ``spans``, each an array of (kind, start, end) in code points.

    Null counts as empty and has no spans; rows stay one to one.
    """
    kind = docs.schema[key].dataType.simpleString()
    item = "array<struct<kind:string,start:int,`end`:int>>"
    pieces = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [find(t, field) for t in texts_of(batch.column(1))]
            named = [[[{"kind": k, "start": a, "end": b} for k, a, b in f[i]] for f in found] for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(n, pieces) for n in named)], names=[key, "base", "spans"])

    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, base {item}, spans {item}")


def redact(docs: DataFrame, field: Field, text: str = "text", size: str = "n_chars") -> DataFrame:
    """The documents with every span replaced by its kind in brackets; overlapping spans go as one, named after the first.

    Columns as in ``docs``; if there is a column ``size``, it holds the new number of code points. Null texts stay null.
    """
    schema = docs.schema
    at = schema.names.index(text)

    def clean(t: str | None) -> str | None:
        if not t:
            return t
        _, spans = find(t, field)
        out, last = [], 0
        for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
            if a >= last:
                out += [t[last:a], f"[{kind.upper()}]"]
            last = max(last, b)
        return "".join([*out, t[last:]]) if spans else t

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns)
            columns[at] = pa.array([clean(t) for t in columns[at].to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    cleaned = docs.mapInArrow(run, schema)
    return cleaned.withColumn(size, F.length(text).cast(schema[size].dataType)) if size in schema.names else cleaned
