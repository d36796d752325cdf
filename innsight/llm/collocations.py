"""Phrase collocations by partitioned mining.

The texts are dealt into shards. Each shard is mined completely at the support a
phrase must have in one of them if it has the wanted support in all: words first,
then pairs, then triples of which both pairs are frequent somewhere. Mining only
proposes, so it works on 48 bits of a phrase's hash, one number per phrase, shard and
task. The union of what is frequent in some shard becomes a bit map of fixed size,
and a last pass counts the phrases in the map exactly over all shards. What the
map lets through by chance is counted too and falls to the exact support.

Pieces, words and phrases are per language throughout: a word's hash starts from
that of its language.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from math import ceil

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from innsight.llm.common import cut

MIN_COUNT = 10
SHARDS = 4
TOP = 2000
#: Percent of a phrase's occurrences inside one longer phrase from which on it goes.
COVERED = 50
SEED = 42
#: Pieces that a language's phrases are ranked in first.
PIECES = 16
#: Words after which a task counts and sends what it has.
FLUSH_WORDS = 2_500_000
#: Bits of the map of candidates, in buckets of 4 KiB. Fixed, so that it can be sent to every task.
MAP_BITS = 1 << 28
_BUCKET = 32_768
_SHARD_BITS, _COUNT_BITS = 8, 8
_MIX = 0x9E3779B97F4A7C15

#: Bytes of a text: A-Z in lower case, a blank between words, a line feed between pieces.
_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else 0x20 if b == 0x09 else 0x0A if b in b".,;:!?\n\x0b\x0c\r" else b for b in range(256)
)


def words(text: str | None) -> list[bytes]:
    """Words of a text; a line feed by itself stands between two pieces."""
    return list(filter(None, (text or "").encode().translate(_BYTES).replace(b"\n", b" \n ").split(b" ")))


def language(lang: Column) -> Column:
    return F.coalesce(lang, F.lit("und"))


class Hashes:
    """Texts of several languages as arrays of word hashes, 0 between pieces; a word's is ``xxhash64(lang, word)``."""

    def __init__(self):
        import xxhash

        self.digest, self.of = xxhash.xxh64_intdigest, {}

    def __call__(self, lang: str, found: list[bytes]):
        import numpy as np

        own = self.of.get(lang)
        if own is None:
            if len(self.of) > 1000:
                self.of.clear()
            seeded = partial(self.digest, seed=self.digest(lang.encode(), SEED))
            own = self.of[lang] = (seeded, np.uint64(seeded(b"\n")))
        seeded, between = own
        out = np.fromiter(map(seeded, found), dtype=np.uint64, count=len(found))
        out[out == between] = 0
        return out


def _mixed(a):
    import numpy as np

    a = (a ^ (a >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return a ^ (a >> np.uint64(29))


class Chunk:
    """Some texts' words in one array, and the phrases in it: masks of places and hashes."""

    def __init__(self, texts: list):
        import numpy as np

        gap = np.zeros(2, dtype=np.uint64)
        self.words = np.concatenate([part for text in texts for part in (text, gap)])
        w, k = self.words, np.uint64(_MIX)
        self.is_pair = (w[:-2] != 0) & (w[1:-1] != 0)
        self.pair = _mixed(_mixed(w[:-2]) * k + w[1:-1])
        self.is_triple = self.is_pair & (w[2:] != 0)

    def triple(self, at):
        """Hashes of the triples at these places."""
        import numpy as np

        return _mixed(self.pair[at] * np.uint64(_MIX) + self.words[at + 2])


class Map:
    """Membership in the bit map, two bits a phrase."""

    def __init__(self, data: bytes):
        import numpy as np

        self.bits = np.frombuffer(data, dtype=np.uint8)

    def has(self, hashes):
        import numpy as np

        found = None
        for shift in (16, 36):
            at = (hashes >> np.uint64(shift)).astype(np.int64) & (MAP_BITS - 1)
            bit = (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
            found = bit if found is None else found & bit
        return found


def _chunks(batches: Iterator[pa.RecordBatch], sharded: int | None) -> Iterator[tuple[int, Chunk]]:
    """The texts of a task (lang, text) in chunks of bounded size, each of one shard if there are any."""
    import xxhash

    hashes, waiting, size = Hashes(), {}, 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            found = hashes(lang, words(text))
            shard = xxhash.xxh64_intdigest((text or "").encode()) % sharded if sharded else 0
            waiting.setdefault(shard, []).append(found)
            size += len(found) + 2
            if size >= FLUSH_WORDS:
                yield from ((shard, Chunk(texts)) for shard, texts in waiting.items())
                waiting, size = {}, 0
    yield from ((shard, Chunk(texts)) for shard, texts in waiting.items())


def mine(docs: DataFrame, shards: int, support: int, pairs=None) -> DataFrame:
    """``h``, the first 48 bits of the hashes of the phrases that are frequent in some shard.

    Pairs, or where ``pairs`` is the broadcast map of them, triples made of two.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        known = Map(pairs.value) if pairs is not None else None
        for shard, chunk in _chunks(batches, shards):
            if known is None:
                found = chunk.pair[chunk.is_pair]
            else:
                held = chunk.is_pair & known.has(chunk.pair)
                found = chunk.triple(np.flatnonzero(chunk.is_triple[:-1] & held[:-1] & held[1:]))
            own, counts = np.unique(found >> np.uint64(16), return_counts=True)
            counts = np.minimum(counts, (1 << _COUNT_BITS) - 1).astype(np.uint64)
            packed = (((own << np.uint64(_SHARD_BITS)) | np.uint64(shard)) << np.uint64(_COUNT_BITS)) | counts
            yield pa.RecordBatch.from_arrays([pa.array(packed.view(np.int64))], names=["packed"])

    rows = docs.select("lang", "text").mapInArrow(run, "packed long")
    # Dealt by phrase and shard as they are: summed up before, hardly a row would go.
    dealt = rows.select("packed").repartition(F.shiftrightunsigned("packed", _COUNT_BITS))
    return (
        dealt.groupBy(F.shiftrightunsigned("packed", _COUNT_BITS).alias("key"))
        .agg(F.sum(F.col("packed").bitwiseAND((1 << _COUNT_BITS) - 1)).alias("n"))
        .filter(F.col("n") >= support)
        .select(F.shiftrightunsigned("key", _SHARD_BITS).alias("h"))
    )


def bit_map(found: DataFrame) -> bytes:
    """The map of the hashes ``h``: ``MAP_BITS`` bits, whatever their number."""
    places = found.select(
        F.explode(
            F.array(
                F.col("h").bitwiseAND(MAP_BITS - 1), F.shiftrightunsigned("h", 20).bitwiseAND(MAP_BITS - 1)
            )
        ).alias("at")
    ).select((F.shiftrightunsigned("at", 15)).alias("bucket"), F.col("at").bitwiseAND(_BUCKET - 1).alias("bit"))
    buckets = places.repartition("bucket").groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))
    out = bytearray(MAP_BITS // 8)
    for row in buckets.toLocalIterator():
        out[row.bucket * _BUCKET // 8 : (row.bucket + 1) * _BUCKET // 8] = row.bits
    return bytes(out)


def count_candidates(docs: DataFrame, pairs, triples, min_count: int) -> DataFrame:
    """w1, w2, w3 (hashes of the words, w3 0 in pairs) and a of the mapped phrases, counted over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        two, three = Map(pairs.value), Map(triples.value)
        for _, chunk in _chunks(batches, None):
            w, at = chunk.words, np.flatnonzero(chunk.is_pair)
            at = at[two.has(chunk.pair[at])]
            _, first, n = np.unique(chunk.pair[at], return_index=True, return_counts=True)
            at = at[first]
            yield _rows(w[at], w[at + 1], np.zeros(len(at), dtype=np.uint64), n)
            at = np.flatnonzero(chunk.is_triple)
            hashes = chunk.triple(at)
            held = three.has(hashes)
            at = at[held]
            _, first, n = np.unique(hashes[held], return_index=True, return_counts=True)
            at = at[first]
            yield _rows(w[at], w[at + 1], w[at + 2], n)

    def _rows(w1, w2, w3, n):
        import numpy as np

        arrays = [pa.array(w.view(np.int64)) for w in (w1, w2, w3)] + [pa.array(n.astype(np.int64))]
        return pa.RecordBatch.from_arrays(arrays, names=["w1", "w2", "w3", "n"])

    rows = docs.select("lang", "text").mapInArrow(run, "w1 long, w2 long, w3 long, n long")
    counted = rows.repartition("w1", "w2", "w3").groupBy("w1", "w2", "w3").agg(F.sum("n").alias("a"))
    return counted.filter(F.col("a") >= min_count)


def count_words(docs: DataFrame) -> DataFrame:
    """lang, word and n of every word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from collections import Counter

        counts, size = {}, 0

        def sent():
            for lang, own in counts.items():
                own.pop(b"\n", None)
                arrays = [
                    pa.array([lang] * len(own), type=pa.string()),
                    pa.array(list(own), type=pa.binary()).cast(pa.string()),
                    pa.array(list(own.values()), type=pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=["lang", "word", "n"])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = words(text)
                counts.setdefault(lang, Counter()).update(found)
                size += len(found)
                if size >= FLUSH_WORDS:
                    yield from sent()
                    counts, size = {}, 0
        yield from sent()

    rows = docs.select("lang", "text").mapInArrow(run, "lang string, word string, n long")
    return rows.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _score(a: str, left: str, right: str) -> Column:
    """floor(1000000 a a / (left right)), in decimals of 38 digits."""
    wide = "cast({} as decimal(15,0))"
    a, left, right = (wide.format(name) for name in (a, left, right))
    return F.expr(f"cast(1000000 as decimal(7,0)) * ({a} * {a}) div ({left} * {right})")


def candidates(docs: DataFrame, min_count: int = MIN_COUNT, shards: int = SHARDS) -> tuple[DataFrame, DataFrame]:
    """Words (lang, word, n) and frequent phrases (w1, w2, w3, a) of ``docs`` (lang, text)."""
    context, support = docs.sparkSession.sparkContext, ceil(min_count / shards)
    if not 1 <= shards < 1 << _SHARD_BITS or support >= 1 << _COUNT_BITS:
        raise ValueError("1 to 255 shards, and a support in each of less than 255")
    found = cut(count_words(docs))
    pairs = context.broadcast(bit_map(mine(docs, shards, support)))
    triples = context.broadcast(bit_map(mine(docs, shards, support, pairs)))
    phrases = cut(count_candidates(docs, pairs, triples, min_count))
    pairs.destroy()
    triples.destroy()
    return found, phrases


def collocations(
    docs: DataFrame, min_count: int = MIN_COUNT, shards: int = SHARDS, top: int = TOP, covered: int = COVERED
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of two and three words of each language.

    ``docs`` has text and lang; a null lang is ``und``, a null text empty, other columns
    are ignored and rows that repeat count as often as they come. Where the score of
    both cuts of a phrase is equal, that after the first word counts. Equal scores go
    by a, then by the phrase's bytes. A language without frequent phrases has no rows.
    Words are told apart by 64 bits of their hashes.
    """
    texts = docs.select(language(F.col("lang")).alias("lang"), "text")
    found, phrases = candidates(texts, min_count, shards)
    totals = found.groupBy("lang").agg(F.sum("n").alias("n"))
    known = found.filter(F.col("n") >= min_count).select(F.xxhash64("lang", "word").alias("h"), "lang", "word", "n")

    def word(k: int) -> DataFrame:
        first = [F.col("lang")] if k == 1 else []
        return known.select(F.col("h").alias(f"w{k}"), F.col("word").alias(f"s{k}"), F.col("n").alias(f"n{k}"), *first)

    pairs, triples = phrases.filter("w3 = 0").drop("w3"), phrases.filter("w3 <> 0")
    inside = triples.select(
        F.explode(F.array(F.struct("w1", "w2"), F.struct(F.col("w2").alias("w1"), F.col("w3").alias("w2")))).alias("p"), "a"
    )
    longest = inside.groupBy("p.w1", "p.w2").agg(F.max("a").alias("longest"))
    two = (
        pairs.join(longest, ["w1", "w2"], "left")
        .filter(F.col("longest").isNull() | (F.col("longest") * 100 < F.col("a") * covered))
        .join(word(1), "w1")
        .join(word(2), "w2")
        .select("lang", F.concat_ws(" ", "s1", "s2").alias("phrase"), "a", F.col("n1").alias("l"), F.col("n2").alias("r"))
        .withColumn("score", _score("a", "l", "r"))
    )
    front = pairs.withColumnRenamed("a", "front")
    back = pairs.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("back"))
    cuts = F.array(
        F.struct(_score("a", "n1", "back").alias("score"), F.lit(1).alias("k"), F.col("n1").alias("l"), F.col("back").alias("r")),
        F.struct(_score("a", "front", "n3").alias("score"), F.lit(2).alias("k"), F.col("front").alias("l"), F.col("n3").alias("r")),
    )
    three = (
        triples.join(front, ["w1", "w2"])
        .join(back, ["w2", "w3"])
        .join(word(1), "w1")
        .join(word(2), "w2")
        .join(word(3), "w3")
        .select("lang", F.concat_ws(" ", "s1", "s2", "s3").alias("phrase"), "a", F.array_min(cuts).alias("c"))
        .select("lang", "phrase", "a", "c.l", "c.r", "c.score")
    )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # First within pieces, so that the last ranking of a language gets few rows however many tasks there were.
    dealt = two.unionByName(three).withColumn("piece", F.pmod(F.xxhash64("phrase"), F.lit(PIECES)))
    place = F.row_number().over(Window.partitionBy("lang", "piece").orderBy(*order))
    first = dealt.withColumn("place", place).filter(F.col("place") <= top)
    return (
        first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
        .filter(F.col("rank") <= top)
        .join(totals, "lang")
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )


#: DuckDB: the same by counting all phrases. One statement over ``documents``.
COLLOCATIONS_SQL = f"""
with pieces as (
  select row_number() over () as piece_no, lang, piece from (
    select coalesce(lang, 'und') as lang, unnest(string_split_regex(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\\n\\x0B\\x0C\\r]')) as piece from documents)
), split as (
  select lang, [w for w in string_split_regex(piece, '[ \\t]') if w <> ''] as ws from pieces
), grams as (
  select lang, 1 as size, ws, unnest(range(1, len(ws) + 1)) as i from split
  union all select lang, 2, ws, unnest(range(1, len(ws))) from split
  union all select lang, 3, ws, unnest(range(1, len(ws) - 1)) from split
), counted as (
  select lang, size, array_to_string(ws[i:i + size - 1], ' ') as phrase, count(*) as f from grams group by all
), totals as (
  select lang, sum(f) as n from counted where size = 1 group by lang
), frequent as (
  select lang, size, phrase, f as a, string_split(phrase, ' ') as ws from counted where size > 1 and f >= {MIN_COUNT}
), cuts as (
  select c.lang, c.size, c.phrase, c.a, k, array_to_string(ws[1:k], ' ') as part_l, array_to_string(ws[k + 1:], ' ') as part_r
  from frequent c, unnest(range(1, 3)) as u(k) where k < c.size
), scored as (
  select c.lang, c.phrase, c.a, c.size, k, x.f as l, y.f as r,
    (1000000::hugeint * c.a * c.a) // (x.f::hugeint * y.f) as score
  from cuts c join counted x on x.lang = c.lang and x.phrase = c.part_l
    join counted y on y.lang = c.lang and y.phrase = c.part_r
), lowest as (
  select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1
), covered as (
  select lang, part, max(a) as longest from (
    select lang, a, array_to_string(ws[1:2], ' ') as part from frequent where size = 3
    union all select lang, a, array_to_string(ws[2:3], ' ') from frequent where size = 3) group by all
), left_over as (
  select s.* from lowest s left join covered c on s.size = 2 and c.lang = s.lang and c.part = s.phrase
  where c.longest is null or 100 * c.longest < {COVERED} * s.a
), ranked as (
  select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, score
  from left_over
)
select r.lang, r.rank, r.phrase, r.a, r.l, r.r, cast(t.n as bigint) as n, cast(r.score as bigint) as score
from ranked r join totals t using (lang) where r.rank <= {TOP}
"""
