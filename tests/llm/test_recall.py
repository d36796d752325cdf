"""Recall of edited items of all lengths in one block."""

import random

from innsight.llm import decontamination


def _block(rng):
    lengths = [6] * 450 + [30] * 30 + [100] * 30 + [300] * 30 + [800] * 15 + [1200] * 5
    return [[f"w{rng.randrange(10**6)}" for _ in range(n)] for n in lengths]


def test_tables_reach_the_target_in_each_length_class():
    """Long items stand behind more short ones than there are trials."""
    rng = random.Random(11)
    block = _block(rng)
    own = [decontamination.symbols(words) for words in block]
    index = decontamination.Index(list(enumerate(block)), 0.8, decontamination.tables_needed(own, 0.8))
    met = {}
    for _ in range(4):
        for k, item in enumerate(own):
            if len(item) > 6:
                other = decontamination.edited(item, decontamination.allowed(len(item), 0.8), rng)
                keys = index.sampler.keys(other, len(item))
                met.setdefault(len(item), []).append(index.sampler.meet(index.keys[k], keys))
    assert all(sum(found) >= 0.95 * len(found) for found in met.values()), {n: sum(f) / len(f) for n, f in met.items()}


def test_classes_out_of_reach_are_verified_without_keys(monkeypatch):
    monkeypatch.setattr(decontamination, "MOST_TABLES", 1)
    rng = random.Random(12)
    item = [f"w{rng.randrange(10**6)}" for _ in range(300)]
    tables = decontamination.tables_needed([decontamination.symbols(item)], 0.8)
    assert set(tables.values()) == {0}
    index = decontamination.Index([(5, item)], 0.8, tables).seal()
    text = " ".join(["before", *map(str, decontamination.edited(item, 50, rng)), "after"])
    ((item_id, n, distance, *_),) = index.search(text)
    assert (item_id, n) == (5, 300) and distance <= 50


def test_keep_needs_no_item_id(spark):
    docs = spark.createDataFrame([(1, "so the quick brown fox jumps over it"), (2, "all else")], "doc_id long, text string")
    items = spark.createDataFrame(
        [(None, "the quick brown fox jumps"), (None, "quick brown fox jumps over")], "item_id long, text string"
    )
    assert [r.doc_id for r in decontamination.keep(docs, items).collect()] == [2]
    assert decontamination.contaminations(docs, items).count() == 0
