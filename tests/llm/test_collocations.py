"""Collocations against counting every phrase."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from innsight.llm import collocations


def _by_counting(rows, min_count=10, top=2000, covered=50):
    counts = defaultdict(Counter)
    for lang, text in rows:
        own = counts["und" if lang is None else lang]
        lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lowered):
            words = [w for w in re.split("[ \t]", piece) if w]
            own.update(tuple(words[k : k + n]) for n in (1, 2, 3) for k in range(len(words) - n + 1))
    out = set()
    for lang, own in counts.items():
        n = sum(c for p, c in own.items() if len(p) == 1)
        found = {p: c for p, c in own.items() if len(p) > 1 and c >= min_count}
        scored = []
        for p, a in found.items():
            if any(100 * c >= covered * a for q, c in found.items() if len(q) > len(p) and p in (q[:2], q[1:])):
                continue
            cuts = [(10**6 * a * a // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.add((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return out


def _corpus(rng, n):
    vocabulary = [f"v{k}" for k in range(40)] + ["É", "日本", "Über", "\x00", "\x1c", " "]
    rows = []
    for _ in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 4)):
            words.insert(rng.randint(0, len(words)), rng.choice(["New York City", "red\tcar", "a b", "x; y", "q q q q"]))
        rows.append((rng.choice(["en", "de", None, ""]), rng.choice([" ", "  ", "\t", ", ", "\n"]).join(words)))
    return rows


@pytest.mark.parametrize(("shards", "top"), [(4, 2000), (1, 7), (9, 30)])
def test_collocations_by_counting(spark, shards, top):
    rows = [*_corpus(random.Random(5), 400), ("en", None), (None, None), ("fr", "only once"), ("fr", ""), ("en", "red car " * 50_000)]
    docs = spark.createDataFrame([(*row, 1) for row in rows], "lang string, text string, a int")
    got = collocations.collocations(docs, shards=shards, top=top)
    assert set(map(tuple, got.collect())) == _by_counting(rows, top=top)
    assert all(kind == ("string" if name in ("lang", "phrase") else "bigint") for name, kind in got.dtypes)


def test_no_rows_and_no_phrases(spark):
    docs = spark.createDataFrame([("en", "one two"), (None, None)], "lang string, text string")
    assert collocations.collocations(docs).count() == 0
    assert collocations.collocations(docs.limit(0)).count() == 0


def test_a_phrase_is_frequent_in_some_shard(spark):
    """Each of a phrase's occurrences may lie in another text, hence in any shard."""
    rows = [("en", f"t{k} rare pair u{k}") for k in range(10)] + [("en", f"s{k} other pair") for k in range(9)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert [r.phrase for r in collocations.collocations(docs).collect()] == ["rare pair"]


def test_scores_beyond_64_bits(spark):
    a, left, right = 10**11, 3 * 10**11 + 7, 10**11 + 1
    df = spark.createDataFrame([(a, left, right)], "a long, l long, r long")
    (row,) = df.select(collocations._score("a", "l", "r").alias("s")).collect()
    assert row.s == 10**6 * a * a // (left * right)


def test_hashes_are_those_of_the_sql_function(spark):
    words = [b"abc", b"x" * 40, "日本".encode(), b"\n", b"q"]
    own = collocations.Hashes()("de", words).view(np.int64).tolist()
    assert own.pop(3) == 0
    rows = spark.createDataFrame([(w.decode(),) for w in words if w != b"\n"], "word string")
    assert [r.h for r in rows.select(F.xxhash64(F.lit("de"), "word").alias("h")).collect()] == own
