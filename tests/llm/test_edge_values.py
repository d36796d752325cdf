"""What the operators give for nulls, empty and very long texts, repeated rows: values, not only rows."""

import hashlib
import math
import time
import zlib

import pytest
import sentencepiece
import xxhash
from tokenizers import Tokenizer

from innsight.llm import counting, decontamination, personal, quality, secrets, sharding, simhash, tokens
from innsight.llm.queries import vocabulary
from tests.llm.test_corpus_operators import _fingerprint

EMPTY = hashlib.sha256(b"").hexdigest()


def _by_row(edge_docs, found, *columns):
    """Pairs of (doc_id, text) and what was found, rows of one id in any order."""
    wanted = sorted((str(r.doc_id), str(r.text)) for r in edge_docs.collect())
    return wanted, sorted([tuple(str(r[c]) for c in ("doc_id", *columns)) for r in found.collect()])


def test_fingerprints(edge_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    prints = {(k, t): _fingerprint(t) for k, t in rows}
    groups = {}
    for k, t in rows:
        if k is not None:
            groups.setdefault(prints[k, t], []).append(k)
    expected = sorted((str(k), f"{prints[k, t]:016x}", str(min(groups.get(prints[k, t], []), default=None))) for k, t in rows)
    far = set(prints.values())
    assert all((a ^ b).bit_count() > 2 for a in far for b in far if a != b)
    assert _by_row(edge_docs, simhash.near_duplicates(edge_docs), "fingerprint", "component_id")[1] == expected


def test_counts_of_quality(edge_docs):
    expected = []
    for r in edge_docs.collect():
        words = (r.text or "").encode().split()
        windows = list(zip(words, words[1:], words[2:], strict=False))
        seen = {w: windows.count(w) for w in set(windows)} if len(windows) < 1000 else dict.fromkeys(windows, 2)
        repeated = {k + j for k, w in enumerate(windows) if seen[w] > 1 for j in range(3)}
        failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
        expected.append(tuple(map(str, (r.doc_id, len(words), sum(map(len, map(bytes.decode, words))), len(repeated), failed, False))))
    got = _by_row(edge_docs, quality.score(edge_docs), "n_words", "word_chars", "n_repeat_words", "base_failed", "kept")[1]
    assert got == sorted(expected)


@pytest.mark.parametrize("weights", [[1.0] * 16, [1.0, 2.0, 5.0]])
def test_shards(edge_docs, weights):
    rows = sharding.assign(edge_docs, weights).collect()
    for shard in range(len(weights)):
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))
    texts = {(str(r.doc_id), len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in edge_docs.collect()}
    assert {(str(r.doc_id), r.size, r.text_crc32) for r in rows} == texts and len(rows) == edge_docs.count()
    for r in rows:
        scores = []
        for shard, weight in enumerate([*weights, 1.0]):
            # A null leaves the hash of what stands before it.
            seed = xxhash.xxh64_intdigest(shard.to_bytes(4, "little"), 42)
            value = seed if r.doc_id is None else xxhash.xxh64_intdigest(r.doc_id.to_bytes(8, "little"), seed)
            scores.append((-math.log(((value >> 12) + 0.5) / 2**52) / weight, shard))
        assert r.shard == min(scores[:-1])[1]
        assert r.grown_shard == (len(weights) if min(scores)[1] == len(weights) else r.shard)


def test_spans(edge_docs):
    for found in (secrets.scan(edge_docs), personal.find(edge_docs)):
        for r in found.collect():
            if r.doc_id in (1, 2, 3, 4, 5, 6) or r.doc_id is None:
                assert (r.base_sha256, r.spans) == (EMPTY, "")
    (text,) = [r.text for r in edge_docs.collect() if r.doc_id == 7]
    (row,) = secrets.scan(edge_docs).filter("doc_id = 7").collect()
    span = f"assign:{text.index('token')}:{len(text)}"
    assert row.spans == span and row.n_assign == 1
    assert row.base_sha256 == hashlib.sha256(span.encode()).hexdigest()


def test_tokens(edge_docs):
    library = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    pieces = sentencepiece.SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))
    encoded, counted = [], []
    for r in edge_docs.collect():
        text = r.text or ""
        ids = library.encode(text, add_special_tokens=False).ids
        digest = hashlib.sha256(b"".join(n.to_bytes(4, "little") for n in ids)).hexdigest()
        decoded = hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
        encoded.append(tuple(map(str, (r.doc_id, len(ids), digest, decoded))))
        n = len(pieces.encode(text))
        counted.append(tuple(map(str, (r.doc_id, len(text.encode()), n, n > 4096))))
    got = tokens.round_trip(edge_docs, vocabulary("byte_bpe_50k.json"))
    assert _by_row(edge_docs, got, "n_tokens", "ids_sha256", "decoded_sha256")[1] == sorted(encoded)
    got = counting.count_tokens(edge_docs, vocabulary("piece_bpe_32k.model"))
    assert _by_row(edge_docs, got, "n_bytes", "n_tokens", "over_limit")[1] == sorted(counted)


def test_contaminations(spark, edge_docs):
    """Null and empty texts match nothing; of rows of one id the best match counts; very long texts; clashing columns."""
    item = "the quick brown fox jumps over the lazy dog"
    rows = [
        (1, None, 5), (2, "", 5), (3, item.upper(), 5), (4, "word " * 40_000 + item + " word" * 40_000, 5),
        (5, item.replace("quick", "slow"), 5), (5, f"so {item}!", 5), (None, item, 5), (6, "the quick brown fox", 5),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, distance int")
    items = spark.createDataFrame([(9, item), (9, item), (8, None), (None, item), (7, "too short"), (6, "")], "item_id long, text string")
    got = decontamination.contaminations(docs, items).collect()
    assert sorted((str(r.doc_id), r.item_id, r.n_words, r.distance) for r in got) == [
        ("3", 9, 9, 0), ("4", 9, 9, 0), ("5", 9, 9, 0), ("None", 9, 9, 0),
    ]
    places = {r.doc_id: (r.first_char, r.end_char) for r in got}
    assert places[4] == (200_000, 200_000 + len(item)) and places[3] == (0, len(item))
    assert decontamination.contaminations(docs.limit(0), items).count() == 0
    assert decontamination.contaminations(docs, items.limit(0)).count() == 0
    assert decontamination.contaminations(edge_docs, items).count() == 0


def test_many_keys_in_one_text(spark):
    """Twice the keys in at most three times the time."""
    seconds = []
    for n in (200, 4000, 8000):
        text = " ".join(f"token={k:06d}abcdef" for k in range(n))
        docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
        start = time.perf_counter()
        (row,) = secrets.scan(docs).select("n_assign").collect()
        seconds.append(time.perf_counter() - start)
        assert row.n_assign == n
    assert seconds[2] <= 3 * seconds[1], seconds
