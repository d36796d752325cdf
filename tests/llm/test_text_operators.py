"""Token, pattern and rule operators against the libraries and plain forms of their definitions."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from innsight.llm import bpe, counting, personal, quality, secrets, sharding, tokens
from innsight.llm.queries import vocabulary

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()}


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.MergeList(vocabulary("byte_bpe_50k.json")))


def _odd_texts(n, seed=1):
    rng = random.Random(seed)
    letters = list("aabbeettthh  \n\n\t's1.<|é€中😀\x1c\xa0") + ["<|endoftext|>", "the", "▁", "  "]
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 50))) for _ in range(n)]


def test_encoding_is_the_librarys(encoder, texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    for text in [*texts.values(), *_odd_texts(500), "a" * 5000, "ab" * 3000 + " x"]:
        ids = library.encode(text, add_special_tokens=False).ids
        assert encoder.encode(text) == ids
        for block in (5, 100):
            assert [n for part in encoder.blocks(text, block) for n in part] == ids
        decoder = bpe.Decoder(encoder.merges)
        assert "".join(decoder.feed([n]) for n in ids) + decoder.feed([], final=True) == text
        assert library.decode(ids, skip_special_tokens=False) == text


def test_every_character_is_split_as_by_the_library(encoder):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary("byte_bpe_50k.json")).pre_tokenizer
    characters = [chr(n) for n in range(0x110000) if not 0xD800 <= n < 0xE000]
    for k in range(0, len(characters), 20_000):
        text = "".join(f"a{c}1{c}!{c} " for c in characters[k : k + 20_000])
        assert encoder.split(text) == [text[a:b] for _, (a, b) in library.pre_tokenize_str(text)]


def test_transducer_keeps_little(encoder):
    rng, transducer, most = random.Random(5), bpe.Transducer(encoder.merges), 0
    for _ in range(400):
        transducer.feed("".join(rng.choice("etaoinshrdlu") for _ in range(50)).encode())
        most = max(most, len(transducer.data))
    assert most <= 4 * encoder.merges.lookahead


def test_decoder_of_broken_bytes(encoder):
    rng = random.Random(3)
    for _ in range(300):
        data = bytes(rng.choice([0x41, 0x80, 0xC3, 0xE2, 0x82, 0xAC, 0xF0, 0x9F, 0xFF, 0xED, 0xA0]) for _ in range(12))
        decoder = bpe.Utf8Decoder()
        parts = [decoder.feed(data[k : k + 1]) for k in range(len(data))]
        assert "".join(parts) + decoder.feed(b"", final=True) == data.decode("utf-8", "replace")


def test_ids_and_text_columns(spark):
    path = vocabulary("byte_bpe_50k.json")
    df = spark.createDataFrame([("a b é",), (None,)], "t string").select(tokens.ids(F.col("t"), path).alias("i"))
    assert [r.x for r in df.select(tokens.decoded(F.col("i"), path).alias("x")).collect()] == ["a b é", ""]


@pytest.mark.parametrize("size", [1, 20_000])
def test_counts_are_the_librarys(spark, texts, size):
    import sentencepiece

    path = vocabulary("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    rows = list(enumerate([*texts.values(), *_odd_texts(300, 2), "\n", " ", "  \n  ", "▁▁"]))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(40)
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in counting.count_tokens(docs, path, 100, size).collect()}
    for k, text in rows:
        n = len(library.encode(text))
        assert got[k] == (len(text.encode()), n, n > 100)


def _base(text, found):
    found.sort()
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in found)


def test_secrets_base(spark, texts):
    rows = list(enumerate([*texts.values(), "token:token:abcdefgh", "x AKIA" + "B" * 20, "0123456789abcdef" * 9]))
    for row in secrets.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        text, found = rows[row.doc_id][1], []
        for order, (kind, pattern, group, least) in enumerate(secrets.BASE):
            found += [(m.start(), order, m.end(), kind) for m in re.finditer(pattern, text) if len(m.group(group)) >= least]
        assert row.base_sha256 == hashlib.sha256(_base(text, found).encode()).hexdigest()
        own = [s for s in row.spans.split(",") if s and not s.startswith("random")]
        assert ",".join(own) == _base(text, found)


def test_random_strings_are_told_from_structure(spark):
    rng = random.Random(4)
    keys = ["".join(rng.choice("0123456789abcdef") for _ in range(40)) for _ in range(200)]
    plain = ["0123456789abcdef" * 4, "a1" * 30, "aaaaaaaaaaaaaaaaaaaa11111111111111111111", "abcabcabc1" * 5]
    df = spark.createDataFrame([(t,) for t in keys + plain], "t string")
    p = [r.p for r in df.select(secrets.p_value(F.col("t")).alias("p")).collect()]
    assert sum(x < 0.01 for x in p[:200]) <= 8 and max(p[200:]) < 1e-3
    docs = spark.createDataFrame([(k, f"see {t} there") for k, t in enumerate(keys + plain)], "doc_id long, text string")
    flagged = {r.doc_id for r in secrets.scan(docs).filter("n_random > 0").collect()}
    assert len(flagged & set(range(200))) >= 190 and not flagged & set(range(200, 204))


def _luhn(digits):
    doubled = [int(d) * (2 if k % 2 else 1) for k, d in enumerate(reversed(digits))]
    return sum(n // 10 + n % 10 for n in doubled) % 10 == 0


def _personal(text):
    found = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            found.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[ -]", "", m.group())
        if 14 <= len(digits) <= 19 and _luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def test_personal_base(texts):
    rng = random.Random(1)
    odd = ["".join(rng.choice("a1@. +-()b2") for _ in range(rng.randint(0, 40))) for _ in range(5000)]
    for text in [*texts.values(), *odd]:
        assert personal.base_spans(text) == _personal(text)


def test_field_on_held_out_text(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("aeiounrst") for _ in range(5))
    phone = lambda: f"+1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}"
    made = [f"{word()} {word()} {rng.choice([phone(), word() + '@mail.example.com', '3.5 of 2017'])} {word()}" for _ in range(600)]
    names, weights = personal.train(made[:400])
    one = personal.finder(names, weights)
    unseen = [f"{word()} ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)} {word()}" for _ in range(50)]
    assert sum("phone" in one(t)[5] for t in unseen) >= 45
    assert sum(one(f"{word()} 3.5 of 2017 {word()}")[6] for _ in range(50)) <= 2


def _quality(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = list(zip(words, words[1:], words[2:], strict=False))
    covered = {k + d for k, w in enumerate(windows) if windows.count(w) > 1 for d in range(3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
        sum(line in lines[:k] for k, line in enumerate(lines)), len(covered),
        len(words) < 50 or 100 * len(covered) > 50 * len(words),
    )


def test_quality_counts(texts):
    one = quality.scorer()
    some = sorted(texts.values(), key=len)[:120]
    for text in [*some, "a b c a b c a b c", "x\nx\n\n \nx", "", "é😀 #* "]:
        assert one(text)[:6] == _quality(text)


def test_bands():
    rng = random.Random(2)
    one = quality.scorer()
    noise = " ".join("".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(70)) for _ in range(80))
    prose = " ".join("".join(rng.choice(["the", "er", "on", "an", "re", "he", "in", "ed"]) for _ in range(rng.randint(1, 3))) for _ in range(600))
    assert not one(noise)[6] and one(prose)[6]
    assert not one(" ".join(f"w{k % 9}" for k in range(2000)))[6]


def test_shards(spark):
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(F.lit("é"), F.col("id")).alias("text"))
    rows = sharding.assign(df, [1.0] * 16).collect()
    by_shard = {}
    for r in rows:
        text = f"é{r.doc_id}".encode()
        assert (r.size, r.text_crc32, r.law) == (len(text) + 1, zlib.crc32(text), "key")
        assert r.grown_shard in (r.shard, 16)
        by_shard.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())
    assert sorted(by_shard) == list(range(16)) and max(map(len, by_shard.values())) < 330
    assert 150 < sum(r.grown_shard == 16 for r in rows) < 330
    weighted = df.select(sharding.shard_of(F.col("doc_id"), [1.0, 3.0]).alias("s")).groupBy("s").count().collect()
    assert 0.7 < {r.s: r["count"] for r in weighted}[1] / 4000 < 0.8
