"""The n-gram join against all pairs."""

import itertools
import random

import numpy as np
import pytest

from innsight.llm import jaccard
from tests.llm.test_corpus_operators import SF_DIR, _components


def _set(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def _by_all_pairs(rows):
    sets = {}
    for _, text in rows:
        sets.setdefault(_set(text), len(sets))
    known = [s for s in sets if s]
    close = [(sets[a], sets[b]) for a, b in itertools.combinations(known, 2) if 5 * len(a & b) >= 4 * len(a | b)]
    joined, least = _components(close, range(len(sets))), {}
    for doc_id, text in rows:
        if doc_id is not None:
            root = joined[sets[_set(text)]]
            least[root] = min(doc_id, least.get(root, doc_id))
    out = []
    for doc_id, text in rows:
        own = _set(text)
        out.append((doc_id, len(own), least.get(joined[sets[own]]) if own else doc_id))
    return sorted(out, key=str)


def _joined(spark, rows):
    docs = spark.createDataFrame([(k, t, 0) for k, t in rows], "doc_id long, text string, node int")
    return sorted(map(tuple, jaccard.join(docs).collect()), key=str)


def _text(rng, n, words=5000):
    return [f"w{rng.randrange(words)}" for _ in range(n)]


def _edited(words, edits, rng):
    out = list(words)
    for _ in range(edits):
        at = rng.randrange(len(out))
        kind = rng.randrange(3)
        if kind == 0:
            out[at] = f"x{rng.randrange(10**6)}"
        elif kind == 1 and len(out) > 1:
            del out[at]
        else:
            out.insert(at, f"x{rng.randrange(10**6)}")
    return out


def test_bands_hold_all_partners():
    plan = jaccard.Plan()
    for size in range(1, 3000):
        band = plan.band(size)
        assert plan.lowers[band] <= size <= plan.uppers[band]
        assert plan.band(size * 5 // 4) <= band + 1


@pytest.mark.parametrize("size", [5, 6, 9, 14, 20, 33, 44, 46, 60, 150, 400, 1500])
def test_sets_that_are_alike_share_a_key(size):
    """If either has segments enough, they share a subset or a neighbourhood."""
    rng, keys, shared, sure = random.Random(size), jaccard.Keys(), 0, 0
    for _ in range(60):
        base = [rng.getrandbits(64) for _ in range(size)]
        while True:
            other = rng.sample(base, size - rng.randint(0, size // 5)) + [rng.getrandbits(64) for _ in range(rng.randint(0, size // 5))]
            if jaccard.alike(size, len(other), len(set(base) & set(other))):
                break
        a, b = (np.array(sorted(s), dtype=np.uint64) for s in (base, other))
        meets = bool(set(keys.keys(a).tolist()) & set(keys.keys(b).tolist()))
        enough = min(keys.profile(a)[3:5]) >= 0 or min(keys.profile(b)[3:5]) >= 0
        assert meets or not enough
        shared, sure = shared + meets, sure + enough
        if size >= 2 * jaccard.SMALL:
            again = [set(keys.keys(s, (True, True)).tolist()) for s in (a, b)]
            assert again[0] & again[1] or not enough
    assert shared >= sure and sure > 20


@pytest.mark.parametrize("size", [1, 2, 5, 17, 63, 64, 65, 300, 3000])
def test_counts_never_say_more_than_the_sets(size):
    rng = random.Random(size)
    for _ in range(30):
        base = [rng.getrandbits(64) for _ in range(size)]
        other = rng.sample(base, rng.randint((3 * size + 3) // 4, size)) + [rng.getrandbits(64) for _ in range(rng.randint(0, size // 4))]
        a, b = (np.array(sorted(s), dtype=np.uint64) for s in (base, other))
        assert jaccard.differences_by_counts(jaccard.counts_of(a), jaccard.counts_of(b)) <= len(set(base) ^ set(other))
    far = np.array(sorted(rng.getrandbits(64) for _ in range(size)), dtype=np.uint64)
    assert size < 64 or jaccard.differences_by_counts(jaccard.counts_of(a), jaccard.counts_of(far)) > size / 2


def test_join_by_all_pairs(spark):
    rng, rows = random.Random(4), []
    for n in (1, 3, 5, 8, 9, 12, 17, 24, 30, 48, 60, 150, 300):
        for _ in range(6):
            words = _text(rng, n)
            rows += [words, *[_edited(words, rng.randint(0, 1 + n // 15), rng) for _ in range(6)], words]
    # Texts that share a passage and little else, of all sizes.
    passage = _text(rng, 60)
    for _ in range(120):
        own = _text(rng, rng.randint(0, 200))
        rows.append(own[: len(own) // 2] + passage + own[len(own) // 2 :])
    texts = [" ".join(words) for words in rows] + [None, "", " \n", "One TWO three", "one two three", "word " * 50_000]
    rng.shuffle(texts)
    numbered = [(None if k % 50 == 7 else k, t) for k, t in enumerate(texts)] + [(3, texts[3]), (3, texts[4])]
    assert _joined(spark, numbered) == _by_all_pairs(numbered)


def _crowd(rng, n, most=9, words=150):
    base = _text(rng, words)
    return [" ".join(_edited(base, rng.randint(0, most), rng)) for _ in range(n)]


def test_join_of_a_crowd(spark):
    rng = random.Random(9)
    rows = list(enumerate(_crowd(rng, 330) + _crowd(rng, 150, most=30) + _crowd(rng, 120, most=2, words=25)))
    assert _joined(spark, rows) == _by_all_pairs(rows)


def test_a_crowd_is_not_compared_pair_by_pair(spark, monkeypatch):
    """Three times the texts, at most four times the candidates."""
    counted = []
    verified = jaccard._verified

    def counting(pairs, sets):
        counted.append(pairs.count())
        return verified(pairs, sets)

    monkeypatch.setattr(jaccard, "_verified", counting)
    crowd = _crowd(random.Random(10), 900, words=200)
    for n in (300, 900):
        docs = spark.createDataFrame(list(enumerate(crowd[:n])), "doc_id long, text string")
        jaccard.join(docs).count()
    assert counted[1] <= 4 * counted[0], counted


def test_differences_grow_with_the_crowd(spark, monkeypatch):
    """Four times the texts, at most six times the rows that tell of their differences from leaders."""
    counted, kept = [], jaccard.cut

    def counting(df):
        out = kept(df)
        if df.columns == ["key", "node", "part"]:
            counted.append(out.count())
        return out

    monkeypatch.setattr(jaccard, "cut", counting)
    crowd = _crowd(random.Random(11), 1200, words=200)
    for n in (300, 1200):
        docs = spark.createDataFrame(list(enumerate(crowd[:n])), "doc_id long, text string")
        jaccard.join(docs).count()
    assert 0 < counted[1] <= 6 * counted[0], counted


def test_each_key_gives_its_pairs():
    """Not the first one alone: parts of later keys were lost."""
    columns = [np.array(c) for c in ([1, 1, 1, 2, 2, 2], [10, 11, 12, 20, 21, 22], [0, 0, 1, 0, 2, 2])]
    found = [pair for batch in jaccard._met_around(columns) for pair in zip(*batch.to_pydict().values(), strict=True)]
    assert sorted(set(found)) == [(10, 12), (11, 12), (20, 21), (20, 22), (21, 22)]


def test_leaders_give_way(spark):
    """3 leads one of its keys and 4 the others, 9 leads all of its own; each key has one leader."""
    sets = {4: [1, 2, 3, 4], 3: [3, 4, 5], 2: [5, 1], 9: [7, 8, 6], 8: [7]}
    rows = [(node, len(keys), key) for node, keys in sets.items() for key in keys]
    found = jaccard._leaders(spark.createDataFrame(rows, "node long, n int, key long"))
    assert dict(map(tuple, found.select("key", "leader").collect())) == {1: 4, 2: 4, 3: 4, 4: 4, 5: 4, 6: 9, 7: 9, 8: 9}
    assert found.count() == 8


def test_join_of_crowds_whose_leaders_give_way(spark, monkeypatch):
    """Families of near copies that share a passage, against all pairs."""
    kept, ways = jaccard._leaders, []

    def watching(keyed):
        out = kept(keyed)
        firsts = keyed.groupBy("key").agg(jaccard.F.max(jaccard.F.struct("n", "node"))["node"].alias("node"))
        ways.append((firsts.select("node").distinct().count(), out.select("leader").distinct().count()))
        return out

    monkeypatch.setattr(jaccard, "_leaders", watching)
    rng = random.Random(12)
    passage, texts = _text(rng, 60), []
    for n, words in ((500, 90), (250, 70)):
        base = _text(rng, words)
        texts += [" ".join(passage + _edited(base, rng.randint(0, 12), rng)) for _ in range(n)]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    assert _joined(spark, rows) == _by_all_pairs(rows)
    assert ways[0][1] < ways[0][0], ways


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    rows = sorted(map(tuple, docs.collect()))
    assert sorted(map(tuple, jaccard.join(docs).collect()), key=str) == _by_all_pairs(rows)


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.join(docs).count() == 0
    empty = spark.createDataFrame([(1, None), (None, "")], "doc_id long, text string")
    assert sorted(map(tuple, jaccard.join(empty).collect()), key=str) == [(1, 0, 1), (None, 0, None)]
