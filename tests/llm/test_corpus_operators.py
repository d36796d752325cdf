"""Operators over a whole corpus against brute force."""

import io
import itertools
import random
import zipfile

import pytest
import xxhash

import corpus_pipeline
from innsight.llm import common, decontamination, lines, quality, simhash, warc
from innsight.llm.queries import vocabulary
from innsight.llm.ziparchive import Archive

SF_DIR = "/root/testdata/sf0.001"


def _fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[k : k + 3]), 42) for k in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _components(pairs, nodes):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def _near(docs):
    prints = {k: _fingerprint(t) for k, t in docs}
    close = [(a, b) for a, b in itertools.combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= 2]
    found = _components(close, prints)
    return {(k, f"{p:016x}", found[k]) for k, p in prints.items()}


def test_masks_cover_every_pair():
    masks = simhash.covering_masks()
    assert len(masks) == 7
    for a, b in itertools.combinations(range(64), 2):
        assert any(not mask >> a & 1 and not mask >> b & 1 for mask in masks)


@pytest.mark.parametrize("paired", [64, 2])
def test_near_duplicates(spark, monkeypatch, paired):
    monkeypatch.setattr(simhash, "PAIRED", paired)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    got = {tuple(r) for r in simhash.near_duplicates(docs).collect()}
    assert got == _near([tuple(r) for r in docs.collect()])


@pytest.mark.parametrize("paired", [64, 3])
def test_links_of_a_crowded_bucket(spark, monkeypatch, paired):
    monkeypatch.setattr(simhash, "PAIRED", paired)
    rng = random.Random(6)
    prints = {0, -1}
    for _ in range(150):
        prints.add(rng.choice(sorted(prints)) ^ (1 << rng.randrange(63)) ^ (1 << rng.randrange(63)))
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    edges = [tuple(r) for r in simhash.links(df).collect()]
    assert all(((a ^ b) & (1 << 64) - 1).bit_count() <= 2 for a, b in edges)
    close = [(a, b) for a, b in itertools.combinations(prints, 2) if ((a ^ b) & (1 << 64) - 1).bit_count() <= 2]
    assert _components(edges, prints) == _components(close, prints)


def test_components_of_a_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7)]
    got = dict(map(tuple, simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert {n: r for n, r in got.items() if n < 50} == dict.fromkeys(range(41), 0)
    assert {n: r for n, r in got.items() if n >= 50} == dict.fromkeys(range(100, 160), 100)


def test_near_threshold_lines_and_first_occurrence(spark):
    line, rare, short = "a line that many sites share", "a line that four sites share", "too short"
    rows = [(k, f"{line}\nown text {k}\n{short}" + (f"\n{rare}" if k < 4 else ""), f"s{k}") for k in range(5)]
    rows.append((9, f"{line}\n{line}", None))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    left = {r.doc_id: r.text for r in lines.keep(docs).collect()}
    assert left[0] == rows[0][1] and 9 not in left
    assert left[1] == f"own text 1\n{short}\n{rare}" and left[4] == f"own text 4\n{short}"


def _distance(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        before, row = row, [i]
        for j, b in enumerate(text, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (a != b)))
    return min(row)


def test_contaminations_with_edits(spark):
    rng = random.Random(8)
    vocabulary_ = [f"w{k}" for k in range(60)]
    items = [(k, " ".join(rng.choice(vocabulary_) for _ in range(rng.randint(5, 60)))) for k in range(40)]
    docs = []
    for k in range(160):
        item = items[k % 40][1].split()
        edits = rng.randint(0, decontamination.allowed(len(item), 0.7))
        planted = decontamination.edited(item, edits, rng)
        docs.append((k, " ".join([rng.choice(vocabulary_) for _ in range(30)] + [str(w) for w in planted] + ["Tail."] * 5)))
    found = decontamination.contaminations(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    )
    got = {(r.doc_id, r.item_id): r.distance for r in found.collect()}
    expected = {}
    for d, text in docs:
        for i, item in items:
            words = decontamination.words(item)
            distance = _distance(words, decontamination.words(text))
            if distance <= decontamination.allowed(len(words), 0.8):
                expected[d, i] = distance
    assert got.keys() <= expected.keys()
    assert len(got) >= 0.97 * len(expected) and all(got[k] >= expected[k] for k in got)


def test_blocks_of_items(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    whole = {tuple(r) for r in decontamination.contaminations(docs, items).collect()}
    monkeypatch.setattr(decontamination, "BLOCK_WORDS", 100)
    assert whole and whole == {tuple(r) for r in decontamination.contaminations(docs, items).collect()}


def _archive(data):
    return Archive(lambda at, size: data[at : at + size], len(data))


@pytest.mark.parametrize("limit", [zipfile.ZIP64_LIMIT, 10])
def test_zip64_directories(monkeypatch, limit):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", limit)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as made:
        made.writestr("archive/data.warc.gz", b"x" * 1000)
        made.writestr("indexes/é.cdxj", b"y" * 500, zipfile.ZIP_DEFLATED)
        made.comment = b"PK\5\6 in a comment"
    package = _archive(out.getvalue())
    first, second = package.members()
    start = package.stored_start(first)
    assert out.getvalue()[start : start + 1000] == b"x" * 1000
    assert second.name == "indexes/é.cdxj" and package.content(second) == b"y" * 500
    with pytest.raises(ValueError, match="not stored"):
        package.stored_start(second)
    with pytest.raises(ValueError, match="central directory"):
        _archive(b"not a package").members()


def test_pages_in_many_packages(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet").select("page_id", "url", "html")
    written = warc.write(pages, f"{common.shared_dir(spark)}/many-packages", package_bytes=20_000)
    assert written.count() > 3
    got = {(r.page_id, r.payload_bytes) for r in warc.read(written).collect()}
    assert got == {(r.page_id, len(r.html.encode())) for r in pages.collect()}


def test_pipeline(spark):
    """Each stage by plain means: quality by its function, the others by all pairs."""
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text", "source")
    rows = [tuple(r) for r in docs.collect()]
    one = quality.scorer(quality.fit(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet")))
    rows = [r for r in rows if one(r[1])[6]]
    sites, first = {}, {}
    for doc_id, text, source in sorted(rows):
        for place, line in enumerate(text.split("\n")):
            sites.setdefault(line, set()).add(source)
            first.setdefault(line, (doc_id, place))
    shared = {line for line, found in sites.items() if len(found) >= lines.MIN_SITES and len(line) >= lines.MIN_CHARS}
    kept = []
    for doc_id, text, _ in rows:
        left = "\n".join(
            line for place, line in enumerate(text.split("\n")) if line not in shared or first[line] == (doc_id, place)
        )
        if left == text or left.strip(common.WORD_BREAKS):
            kept.append((doc_id, left))
    chosen = {component for _, _, component in _near(kept)}
    items = [decontamination.words(r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    clean = [
        (k, t) for k, t in kept
        if k in chosen and not any(
            _distance(i, decontamination.words(t)) <= decontamination.allowed(len(i), 0.8) for i in items
        )
    ]
    library = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    expected = {(k, len(library.encode(t, add_special_tokens=False).ids)) for k, t in clean}
    assert {(r.doc_id, r.n_tokens) for r in corpus_pipeline.run(spark, SF_DIR).collect()} == expected
    assert 0 < len(expected) < len(rows)
