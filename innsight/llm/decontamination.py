"""Benchmark decontamination under edits.

Texts are sequences of lower-case words. The CGK walk reads a sequence of n words
in 3n steps and at each step stays or moves on by a random bit of (step, word), so
that few edits become few differing steps; samples of steps are the keys of a
locality-sensitive hash. Windows of an item's size that share a key with the item
are verified by their exact edit distance.

Windows are placed where a text has a run of words of the item: among the words
that k edits leave of n, some run has ceil((n-k)/(k+1)) words, so no passage within
the limit goes without a window.
"""

from __future__ import annotations

import random
import re
import uuid
import zlib
from collections.abc import Iterator
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innsight.llm.common import per_text

SIMILARITY = 0.8
#: Shorter items are no evidence: they occur in ordinary text.
MIN_WORDS = 5
#: Longest run of words that places windows; short items need shorter ones.
RUN = 4
WALKS = 8
BITS = 2
TARGET_RECALL = 0.99
MIX = 0x2545F4914F6CDD1D
MOST_TABLES = 1024
#: Items of so many words or more are verified without keys, which take as long to read.
LONG_WORDS = 1024
#: Pairs of a length class that its number of tables is measured on, at least, and words of items that are sent out at a time.
TRIALS = 400
BLOCK_WORDS = 500_000

_WORD = re.compile(r"\w+")
RESULT = "array<struct<item_id: long, n_words: long, distance: long, first_char: long, end_char: long>>"


def words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def allowed(n: int, similarity: float) -> int:
    """Edits of an item of n words that leave it as similar as asked."""
    return int(n * (1 - similarity) + 1e-9)


def symbols(sequence: list[str]) -> list[int]:
    return [zlib.crc32(word.encode()) for word in sequence]


def walk(sequence: list[int], steps: int, seed: int) -> list[int]:
    """The symbols a CGK walk reads, -1 past the end."""
    out, at, size = [], 0, len(sequence)
    for step in range(steps):
        if at >= size:
            out.extend([-1] * (steps - step))
            break
        symbol = sequence[at]
        out.append(symbol)
        # The random bit of (walk, step, symbol): the top bit of a multiplicative mix.
        at += ((symbol ^ (step * 0x9E3779B1 + seed * 0x85EBCA77)) * 0xC2B2AE3D27D4EB4F >> 41) & 1
    return out


def length_class(n: int) -> int:
    """Lengths of one class differ by less than a half."""
    return 2 * n.bit_length() + (n >> max(0, n.bit_length() - 2) & 1)


class Sampler:
    """Keys of a sequence in the first tables, as many as its length class has; equal for equal sequences.

    A class of no tables has no keys, and all its sequences meet.
    """

    def __init__(self, tables: dict[int, int], bits: int = BITS, walks: int = WALKS):
        self.tables, self.bits, self.walks = tables, bits, walks
        self._samples: dict[int, list[tuple[int, list[int]]]] = {}

    def samples(self, n: int) -> list[tuple[int, list[int]]]:
        """Walk and sampled steps of each table for items of n words; the same in every task."""
        if n not in self._samples:
            # The end of a walk is mostly past the sequence; samples come from the part before.
            rng = random.Random(n)
            self._samples[n] = [
                (table % self.walks, [rng.randrange(2 * n) for _ in range(self.bits)])
                for table in range(self.tables[length_class(n)])
            ]
        return self._samples[n]

    def keys(self, sequence: list[int], n: int) -> list[tuple[int, ...]]:
        read = [walk(sequence, 2 * n, w) for w in range(min(self.walks, self.tables[length_class(n)]))]
        return [tuple([read[w][step] for step in steps]) for w, steps in self.samples(n)]

    def first(self, a: list, b: list) -> int | None:
        """The first table in which the keys meet."""
        none = (-1,) * self.bits
        return next((k for k, (x, y) in enumerate(zip(a, b, strict=True)) if x == y and x != none), None)

    def meet(self, a: list, b: list) -> bool:
        return not a or self.first(a, b) is not None


def edited(sequence: list[int], edits: int, rng: random.Random) -> list[int]:
    out = list(sequence)
    for _ in range(edits):
        kind, at = rng.randrange(3), rng.randrange(len(out)) if out else 0
        if kind == 0 and out:
            out[at] = rng.randrange(1 << 32)
        elif kind == 1 and out:
            del out[at]
        else:
            out.insert(at, rng.randrange(1 << 32))
    return out


def tables_needed(items: list[list[int]], similarity: float, target: float = TARGET_RECALL) -> dict[int, int]:
    """Per length class of the items the power of two of tables that reach the target on random edits.

    Each item gets as many edits as are allowed, once, or more often in a class of
    under ``TRIALS`` items. A class that ``MOST_TABLES`` don't bring to the target, or
    of ``LONG_WORDS`` or more, has no tables: all its windows are verified.
    """
    classes: dict[int, list[list[int]]] = {}
    for item in items:
        classes.setdefault(length_class(len(item)), []).append(item)
    needed = {}
    for kind, own in sorted(classes.items()):
        if kind >= length_class(LONG_WORDS):
            needed[kind] = 0
            continue
        rng, sampler, firsts = random.Random(7), Sampler({kind: MOST_TABLES}), []
        trials = max(TRIALS, len(own))
        for k in range(trials):
            item = own[k % len(own)]
            other = edited(item, allowed(len(item), similarity), rng)
            found = sampler.first(sampler.keys(item, len(item)), sampler.keys(other, len(item)))
            firsts.append(MOST_TABLES if found is None else found)
        last = sorted(firsts)[ceil(target * trials) - 1]
        needed[kind] = 0 if last >= MOST_TABLES else max(8, 1 << last.bit_length())
    return needed


def best_end(pattern: list[int], text: list[int]) -> tuple[int, int]:
    """Least edit distance of the pattern to a stretch of the text, and the end of the first such stretch.

    Bit-parallel: one big number holds a column of vertical differences.
    """
    m = len(pattern)
    where: dict[int, int] = {}
    for k, symbol in enumerate(pattern):
        where[symbol] = where.get(symbol, 0) | 1 << k
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score, best = full, 0, m, (m, 0)
    for end, symbol in enumerate(text, 1):
        equal = where.get(symbol, 0)
        diagonal = (((equal & plus) + plus) ^ plus) | equal | minus
        up, down = minus | (full & ~(diagonal | plus)), plus & diagonal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up, down = (up << 1) & full, (down << 1) & full
        plus, minus = down | (full & ~(diagonal | up)), up & diagonal
        if score < best[0]:
            best = (score, end)
    return best


class Index:
    """One block of items: the runs that place windows, and the items' keys."""

    def __init__(self, items: list[tuple[int, list[str]]], similarity: float, tables: dict[int, int]):
        self.similarity, self.sampler = similarity, Sampler(tables)
        self.number: dict[str, int] = {}
        self.items, self.keys, self.runs = [], [], {}
        for item_id, sequence in items:
            ids = [self.number.setdefault(word, len(self.number) + 1) for word in sequence]
            own = symbols(sequence)
            self.items.append((item_id, own))
            self.keys.append(self.sampler.keys(own, len(own)))
            n, k = len(ids), allowed(len(ids), similarity)
            run = min(RUN, ceil((n - k) / (k + 1)))
            found = self.runs.setdefault(run, {})
            for at in range(n - run + 1):
                found.setdefault(self._code(ids[at : at + run]), []).append((len(self.items) - 1, at))

    @staticmethod
    def _code(ids: list[int]) -> int:
        """A run's number, modulo 2^64 as numpy has it; equal numbers of other runs only add windows."""
        code = 0
        for n in ids:
            code = code * MIX + n & (1 << 64) - 1
        return code - (1 << 64) if code >> 63 else code

    def seal(self):
        import numpy as np

        self.codes = {run: np.array(sorted(found), dtype=np.int64) for run, found in self.runs.items()}
        return self

    def windows(self, sequence: list[str]) -> set[tuple[int, int]]:
        """(item, start) of the windows that share a run with an item at its place."""
        import numpy as np

        number = self.number
        ids = np.array([number.get(word, 0) for word in sequence], dtype=np.int64)
        out = set()
        for run, codes in self.codes.items():
            if len(ids) < run:
                continue
            code, known = ids[: len(ids) - run + 1].copy(), ids[: len(ids) - run + 1] > 0
            for k in range(1, run):
                part = ids[k : len(ids) - run + 1 + k]
                code = code * np.int64(MIX) + part
                known &= part > 0
            places = np.flatnonzero(known)
            if len(places):
                near = np.minimum(np.searchsorted(codes, code[places]), len(codes) - 1)
                for place in places[codes[near] == code[places]].tolist():
                    for item, at in self.runs[run][int(code[place])]:
                        out.add((item, place - at))
        return out

    def search(self, text: str | None) -> list[tuple[int, int, int, int, int]]:
        """(item_id, words of it, distance, first character, end) of each item found, at its best place."""
        sequence = words(text)
        windows = self.windows(sequence)
        if not windows:
            return []
        found, keys = {}, {}
        for item, start in sorted(windows):
            item_id, pattern = self.items[item]
            n = len(pattern)
            k = allowed(n, self.similarity)
            key = (start, n)
            if key not in keys:
                keys[key] = self.sampler.keys(symbols(sequence[max(0, start) : max(0, start + n)]), n)
            if not self.sampler.meet(self.keys[item], keys[key]):
                continue
            low = max(0, start - k)
            around = symbols(sequence[low : max(0, start + n + k)])
            distance, end = best_end(pattern, around)
            if distance <= k and (item_id not in found or distance < found[item_id][0]):
                first = low + end - best_end(pattern[::-1], around[:end][::-1])[1]
                found[item_id] = (distance, n, first, low + end)
        if not found:
            return []
        # Lower case may be longer than the text: its own words, found again, give the places.
        spans = [m.span() for m in _WORD.finditer(text.lower() if len(text.lower()) == len(text) else text)]
        spans += [(0, len(text))] * (len(sequence) - len(spans))
        return [
            (item_id, n, distance, spans[first][0], spans[end - 1][1])
            for item_id, (distance, n, first, end) in sorted(found.items())
        ]


def _blocks(benchmark: DataFrame, min_words: int) -> Iterator[list[tuple[int, list[str]]]]:
    """The items in blocks of bounded size; rows repeated and items without id or words are left out."""
    block, size, rows = [], 0, benchmark.select("item_id", "text").filter("item_id is not null").distinct()
    for item_id, text in rows.orderBy("item_id", "text").toLocalIterator():
        sequence = words(text)
        if len(sequence) < min_words:
            continue
        block.append((item_id, sequence))
        size += len(sequence)
        if size >= BLOCK_WORDS:
            yield block
            block, size = [], 0
    if block:
        yield block


#: The index of the block that a worker searched last, by the block's name.
_INDEX: dict[str, Index] = {}


def _searcher(sent, similarity: float, tables: dict[int, int]):
    def make():
        name, items = sent.value
        if name not in _INDEX:
            _INDEX.clear()
            _INDEX[name] = Index(items, similarity, tables).seal()
        return _INDEX[name].search

    return make


def _searches(docs: DataFrame, benchmark: DataFrame, similarity: float, min_words: int):
    """Per block of items a function of the text column that gives what is found of them."""
    for items in _blocks(benchmark, min_words):
        tables = tables_needed([symbols(sequence) for _, sequence in items], similarity)
        sent = docs.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, items))
        yield per_text(_searcher(sent, similarity, tables), RESULT)


def contaminations(
    docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, min_words: int = MIN_WORDS
) -> DataFrame:
    """One row per document and item found in it: doc_id, item_id, n_words, distance, first_char, end_char.

    ``docs`` (doc_id, text) is read once for each block of items (item_id, text);
    a block is sent to all tasks and holds ``BLOCK_WORDS`` words and one item more
    at most. Null and empty texts match nothing, items under ``min_words`` words
    and items without id are skipped, an empty benchmark gives no rows. Of rows that repeat a doc_id the
    best match of an item counts; other columns are ignored.
    """
    found = None
    for search in _searches(docs, benchmark, similarity, min_words):
        hits = docs.select("doc_id", F.explode(search(F.col("text"))).alias("hit"))
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        found = docs.select("doc_id", F.explode(F.expr(f"cast(array() as {RESULT})")).alias("hit"))
    best = F.min(F.struct("hit.distance", "hit.first_char", "hit.end_char", "hit.n_words")).alias("b")
    return found.groupBy("doc_id", F.col("hit.item_id").alias("item_id")).agg(best).select(
        "doc_id", "item_id", "b.n_words", "b.distance", "b.first_char", "b.end_char"
    )


def keep(
    docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, min_words: int = MIN_WORDS
) -> DataFrame:
    """The rows of ``docs`` in whose text no item is found, with all their columns.

    Each row is judged by its own text, so nothing is joined or shuffled. An item
    needs no id here, its text is enough.
    """
    texts = benchmark.select(F.lit(0).cast("long").alias("item_id"), "text")
    for search in _searches(docs, texts, similarity, min_words):
        docs = docs.filter(F.size(search(docs["text"])) == 0)
    return docs
