"""Ranked search against scoring all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from innsight.llm import ranking

_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _terms(text):
    return _TERM.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def _all_scores(docs, items, top=20):
    found = [(k, Counter(_terms(t)), len(_terms(t))) for k, t in docs if _terms(t)]
    n_docs, n_terms = len(found), sum(n for *_, n in found)
    df = Counter(t for _, c, _ in found for t in c)
    out = set()
    for item_id, text in items:
        scores = []
        for k, counts, n in found:
            m = 75 + (25 * n * n_docs) // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * counts[t] // (1000 * counts[t] + 12 * m))
                for t in _terms(text)
            )
            if score > 0:
                scores.append((-score, k is None, k or 0, k))
        out |= {(item_id, rank, k, -s) for rank, (s, _, _, k) in enumerate(sorted(scores)[:top], 1)}
    return out


def _corpus(rng, n, words=60):
    vocabulary = [f"w{k}" for k in range(words)] + ["é", "日本", "naïve"]
    weights = [1 / (k + 1) for k in range(len(vocabulary))]
    return [(k, " ".join(rng.choices(vocabulary, weights, k=rng.randint(1, 120)))) for k in range(n)]


def test_ranking_by_scoring_all(spark):
    rng = random.Random(1)
    docs = _corpus(rng, 700) + [(900, "W1 w1, É-日本!"), (901, None), (902, ""), (903, " .,; "), (None, "w1 w2 rare"), (904, "x" * 300_000)]
    docs += [(905, "w3 w4"), (905, "w3 w4"), (906, "w3 w4")]
    items = [(k, t) for k, t in _corpus(rng, 12)] + [(50, "rare W1"), (51, None), (52, "?!"), (53, "nowhere"), (54, "w3 w4 w4")]
    frame = spark.createDataFrame([(k, t, 1) for k, t in docs], "doc_id long, text string, score int")
    asked = spark.createDataFrame([*items, (None, "w1")], "item_id long, text string")
    got = ranking.rank(frame, asked)
    assert [f.simpleString() for f in got.schema] == ["item_id:bigint", "rank:int", "doc_id:bigint", "score:bigint"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(_all_scores(docs, items), key=str)
    assert ranking.rank(frame.limit(0), asked).count() == 0 and ranking.rank(frame, asked.limit(0)).count() == 0


def test_blocks_of_items_rank_alike(spark, monkeypatch):
    rng = random.Random(2)
    frame = spark.createDataFrame(_corpus(rng, 100), "doc_id long, text string")
    asked = spark.createDataFrame(_corpus(rng, 6), "item_id long, text string")
    whole = set(map(tuple, ranking.rank(frame, asked, top=5).collect()))
    monkeypatch.setattr(ranking, "BLOCK_TERMS", 50)
    assert whole == set(map(tuple, ranking.rank(frame, asked, top=5).collect()))


@pytest.mark.parametrize("at_once", [1, 32])
def test_an_interval_is_left_alone_where_its_bound_is_too_low(monkeypatch, at_once):
    """Most documents share common terms; those that hold the item's rare ones are found without scoring the rest."""
    monkeypatch.setattr(ranking, "AT_ONCE", at_once)
    rng = random.Random(3)
    rows = []
    for k in range(3000):
        terms = {t: rng.randint(1, 9) for t in rng.sample(range(5), 3)}
        if k % 100 == 7:
            terms |= {t: 2 for t in range(5, 25)}
        rows.append((k, sum(terms.values()) + 50, list(terms), list(terms.values())))
    weights = np.array([5] * 5 + [4000] * 20)
    block = ranking.Block(rows, weights, 3000, sum(r[1] for r in rows))
    best = []
    scored = block.search({t: 1 for t in range(25)}, best, top=20)
    assert scored < 300
    everyone = block.scores(np.arange(25), np.ones(25, dtype=np.int64), np.arange(3000))
    order = sorted(range(3000), key=lambda d: (-everyone[d], block.ids[d]))[:20]
    assert sorted((s, own) for s, _, own in best) == sorted((everyone[d], block.ids[d]) for d in order)


def test_range_maxima():
    rng = random.Random(4)
    rows = [(k, 10, sorted(rng.sample(range(6), 3)), [rng.randint(1, 5) for _ in range(3)]) for k in range(200)]
    block = ranking.Block(rows, np.arange(1, 7) * 100, 200, 2000)
    lists = np.arange(6)
    everyone = np.stack([block.scores(np.array([k]), np.array([1]), np.arange(200)) for k in range(6)])
    for _ in range(200):
        a, b = sorted((rng.randint(0, 200), rng.randint(0, 200)))
        value, place = block.maxima(lists, np.array([a]), np.array([b]))
        for k in range(6):
            assert value[0, k] == max(everyone[k, a:b], default=0)
            assert place[0, k] == -1 or everyone[k, block.doc[place[0, k]]] == value[0, k]
