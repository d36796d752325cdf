"""Personal data: patterns, and a semi-Markov conditional random field for what they miss.

The field scores whole segments: a stretch of units (letters, digits, single marks)
gets features of its shape, its contents and what stands around it, one weight per
feature and kind. A dynamic program over segments of bounded length chooses
boundaries and kinds together. Weights are trained on stretches of the documents
themselves whose labels are the patterns' matches, some of them rewritten into forms
that the patterns don't take.
"""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innsight.llm.common import per_text, sample

KINDS = ("email", "ip", "card", "phone")
#: Longest segment in units, and the text around a stretch that is looked at.
MAX_UNITS = 16
AROUND = 24
#: Stretches that the weights are fitted on at most, and rounds over them.
FIT_STRETCHES = 1200
FIT_CHARS = 200
ROUNDS = 6
RATE, DECAY = 0.5, 1e-4

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# No match can start inside a run of digits, since it would have started with the run.
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@]|[(\[]at[)\]]")
#: White-space separated pieces that hold a digit, an @ or a written-out one, as far as they follow each other.
_PIECE = r"(?:[^\s0-9@]*[0-9@]\S*|\S+(?=[ ][(\[](?:at|dot)[)\]])|[(\[](?:at|dot)[)\]](?:[ ][A-Za-z0-9.-]+)?)"
_STRETCH = re.compile(rf"(?<!\S){_PIECE}(?:[ ]{_PIECE})*")
_UNIT = re.compile(r"[A-Za-z]+|[0-9]+|\s+|[^A-Za-z0-9\s]")


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        n = int(digit)
        if place % 2:
            n = n * 2 - 9 * (n > 4)
        total += n
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """From one @ to the next: what can stand before it, then the longest domain after it."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            free = domain.end()
            out.append((start, free))
        at = text.find("@", max(free, at + 1))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the patterns' matches that pass, by start, then kind."""
    out = [(a, 0, b) for a, b in _emails(text)]
    if "." in text:
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
                out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(map(str.isdecimal, m.group())) <= 15:
                out.append((m.start(), 3, m.end()))
    out.sort()
    return out


def stretches(text: str):
    """Where the field looks: pieces with digits or an @ that follow each other."""
    return [m.span() for m in _STRETCH.finditer(text)] if _TRIGGER.search(text) else []


def _bucket(n: int) -> int:
    return n if n < 20 else 20 + n.bit_length()


def _shape(unit: str) -> str:
    return "a" if unit[0].isalpha() else "9" if unit[0].isdecimal() else unit[0] if not unit.isspace() else " "


class Lattice:
    """Units of a stretch, its possible segments and their features."""

    def __init__(self, text: str, start: int, end: int, names: dict[str, int], grow: bool):
        self.spans = [(start + m.start(), start + m.end()) for m in _UNIT.finditer(text[start:end])]
        units = [text[a:b] for a, b in self.spans]
        shapes = [_shape(u) for u in units]
        digits = [len(u) if s == "9" else 0 for u, s in zip(units, shapes, strict=True)]
        before = re.findall(r"[A-Za-z]+", text[max(0, start - AROUND) : start])
        word = f"after {before[-1].lower()}" if before else "after none"
        self.starts, self.ends, self.features = [], [], []
        for i in range(len(units)):
            if shapes[i] == " ":
                continue
            for j in range(i + 1, min(i + MAX_UNITS, len(units)) + 1):
                last = shapes[j - 1]
                if last == " " or last in ".,;:!?" or not (sum(digits[i:j]) or "@" in units[i:j] or "at" in units[i:j]):
                    continue
                if j - i < 3 and digits[i] < 6:
                    continue
                inner = shapes[i:j]
                n = sum(digits[i:j])
                groups = [d for d in digits[i:j] if d]
                named = [
                    "any",
                    f"digits {_bucket(n)}",
                    f"groups {'-'.join(map(str, groups)) if len(groups) < 7 else 'many'}",
                    f"marks {''.join(sorted(set(inner) - {'a', '9'}))}",
                    f"first {inner[0]}",
                    f"last {last}",
                    f"left {shapes[i - 1] if i else 'edge'}",
                    f"right {shapes[j] if j < len(units) else 'edge'}",
                    f"letters {'a' in inner}",
                    f"at {inner.count('@')} {'at' in units[i:j]}",
                ]
                if "@" in inner:
                    after = inner[inner.index("@") + 1 :]
                    named.append(f"domain {'.' in after} {' ' in inner} {set(after) <= set('a9.-')}")
                if "a" not in inner and 14 <= n <= 19:
                    named.append(f"luhn {luhn(''.join(u for u, s in zip(units[i:j], inner, strict=True) if s == '9'))}")
                if "a" not in inner and inner.count(".") == 3 and len(groups) == 4:
                    quad = all(int(u) <= 255 for u, s in zip(units[i:j], inner, strict=True) if s == "9" and len(u) < 5)
                    named.append(f"quad {quad}")
                if i == 0:
                    named.append(word)
                if grow:
                    found = [names.setdefault(f, len(names)) for f in named]
                else:
                    found = [names[f] for f in named if f in names]
                self.starts.append(i)
                self.ends.append(j)
                self.features.append(found)

    def scores(self, weights: np.ndarray) -> np.ndarray:
        """Score of each segment under each kind; a unit outside has score 0."""
        flat = np.fromiter((f for own in self.features for f in own), dtype=np.int64)
        bounds = np.cumsum([0] + [len(own) for own in self.features[:-1]])
        return np.add.reduceat(weights[flat], bounds, axis=0)

    def best(self, weights: np.ndarray) -> list[tuple[int, int, int]]:
        """(start, kind, end) of the segments of the best labelling."""
        if not self.starts:
            return []
        scores = self.scores(weights)
        kinds = scores.argmax(axis=1).tolist()
        tops = scores.max(axis=1).tolist()
        n = len(self.spans)
        total, back, at = [0.0] * (n + 1), [None] * (n + 1), 0
        by_end: dict[int, list[int]] = {}
        for k, end in enumerate(self.ends):
            by_end.setdefault(end, []).append(k)
        for at in range(1, n + 1):
            total[at] = total[at - 1]
            for k in by_end.get(at, ()):
                score = total[self.starts[k]] + tops[k]
                if score > total[at]:
                    total[at], back[at] = score, k
        out, at = [], n
        while at:
            k = back[at]
            if k is None:
                at -= 1
            else:
                out.append((self.spans[self.starts[k]][0], kinds[k], self.spans[at - 1][1]))
                at = self.starts[k]
        return out[::-1]

    def expected(self, weights: np.ndarray) -> np.ndarray:
        """Chance of each segment under each kind, over all labellings."""
        scores = self.scores(weights)
        n = len(self.spans)
        forward, backward = np.full(n + 1, -np.inf), np.full(n + 1, -np.inf)
        forward[0] = backward[n] = 0.0
        whole = np.logaddexp.reduce(scores, axis=1)
        order = sorted(range(len(self.starts)), key=lambda k: self.ends[k])
        place = 0
        for at in range(1, n + 1):
            forward[at] = forward[at - 1]
            while place < len(order) and self.ends[order[place]] == at:
                k = order[place]
                forward[at] = np.logaddexp(forward[at], forward[self.starts[k]] + whole[k])
                place += 1
        order.sort(key=lambda k: -self.starts[k])
        place = 0
        for at in range(n - 1, -1, -1):
            backward[at] = backward[at + 1]
            while place < len(order) and self.starts[order[place]] == at:
                k = order[place]
                backward[at] = np.logaddexp(backward[at], backward[self.ends[k]] + whole[k])
                place += 1
        outer = forward[np.array(self.starts)] + backward[np.array(self.ends)] - forward[n]
        return np.exp(scores + outer[:, None])


def _rewritten(text: str, spans: list, rng: random.Random) -> tuple[str, list]:
    """Some emails and phones in other forms, with the places of all labels kept right."""
    out, labels, at = [], [], 0
    for start, kind, end in spans:
        if start < at:
            continue
        out.append(text[at:start])
        piece = text[start:end]
        if kind == 0:
            piece = piece.replace("@", rng.choice([" (at) ", " [at] ", "(at)"]))
        elif kind == 3:
            piece = re.sub(r"^\+[0-9]{1,2}[ .-]?(?=[(0-9])", "", piece)
        begin = sum(map(len, out))
        out.append(piece)
        labels.append((begin, kind, begin + len(piece)))
        at = end
    return "".join(out) + text[at:], labels


def train(samples: list[str]) -> tuple[dict[str, int], np.ndarray]:
    """Names and weights of the features, by gradient steps on the likelihood of the labels."""
    rng, names, examples = random.Random(11), {}, []
    for k, text in enumerate(sorted(samples)):
        spans = base_spans(text)
        if spans and k % 3 == 0:
            text, spans = _rewritten(text, spans, rng)
        for start, end in stretches(text):
            lattice = Lattice(text, start, end, names, grow=True)
            if not lattice.starts:
                continue
            gold = {(a, b): kind for a, kind, b in spans}
            marked = [
                (k, gold[span])
                for k, span in enumerate(
                    (lattice.spans[i][0], lattice.spans[j - 1][1])
                    for i, j in zip(lattice.starts, lattice.ends, strict=True)
                )
                if span in gold
            ]
            examples.append((lattice, marked))
    weights = np.zeros((max(1, len(names)), len(KINDS)))
    squares = np.full_like(weights, 1e-8)
    for _ in range(ROUNDS):
        rng.shuffle(examples)
        for lattice, marked in examples:
            gradient = -lattice.expected(weights)
            for k, kind in marked:
                gradient[k, kind] += 1.0
            rows = np.concatenate([np.asarray(f, dtype=np.int64) for f in lattice.features])
            step = np.zeros_like(weights)
            np.add.at(step, rows, np.repeat(gradient, [len(f) for f in lattice.features], axis=0))
            touched = np.unique(rows)
            step = step[touched] - DECAY * weights[touched]
            squares[touched] += step * step
            weights[touched] += RATE * step / np.sqrt(squares[touched])
    return names, weights


def samples(docs: DataFrame, limit: int = FIT_STRETCHES) -> list[str]:
    """Different stretches with the text around them, at most ``limit``: those of least hash, so the same on each run.

    All documents are looked through; only this bounded sample reaches the driver. Of a
    stretch of more than ``FIT_CHARS`` characters the front is taken.
    """

    def make():
        def one(text: str | None) -> list[str]:
            return [text[max(0, a - AROUND) : min(b, a + FIT_CHARS) + AROUND] for a, b in stretches(text or "")]

        return one

    found = docs.select(F.explode(per_text(make, "array<string>")(F.col("text"))).alias("s"))
    return [row.s for row in sample(found, limit).collect()]


SCHEMA = (
    "struct<n_email: long, n_ip: long, n_card: long, n_phone: long, base_sha256: string, spans: string, n_added: long>"
)


def finder(names: dict[str, int], weights: np.ndarray):
    """Makes the function of one text that gives the fields of ``SCHEMA``."""

    def listed(spans) -> str:
        return ",".join(f"{KINDS[kind]}:{a}:{b}" for a, kind, b in spans)

    def one(text: str | None):
        text = text or ""
        base = base_spans(text) if _TRIGGER.search(text) else []
        added = []
        # A field that was fitted on nothing has no features and finds nothing.
        for start, end in stretches(text) if names else ():
            for a, kind, b in Lattice(text, start, end, names, grow=False).best(weights):
                if all(b <= x or a >= y for x, _, y in base):
                    added.append((a, kind, b))
        counts = [sum(kind == k for _, kind, _ in base) for k in range(len(KINDS))]
        digest = hashlib.sha256(listed(base).encode()).hexdigest()
        return (*counts, digest, listed(sorted(base + added)), len(added))

    return one


def find(docs: DataFrame, fit: int = FIT_STRETCHES) -> DataFrame:
    """doc_id, the base counts, base_sha256, spans and n_added of every row (doc_id, text; others are ignored).

    Weights are fitted first, on at most ``fit`` stretches. Every match of the
    patterns is a span; segments of the field that overlap none of them are added.
    Null and empty texts have none. Texts are read whole. Of labellings of equal score
    that with more left outside is taken, then that of the longer last segment.
    """
    names, weights = train(samples(docs, fit))
    sent = docs.sparkSession.sparkContext.broadcast((names, weights))
    found = per_text(lambda: finder(*sent.value), SCHEMA)(F.col("text"))
    return docs.select("doc_id", found.alias("p")).select("doc_id", "p.*")
