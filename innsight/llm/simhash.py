"""SimHash near-duplicates through covering locality-sensitive hashing.

Every bit of a fingerprint gets a fixed vector of three bits; for each of the
seven other than zero vectors a mask takes the bits whose vector has an odd
product with it. Two fingerprints that differ in at most two bits agree under one
of the masks for certain: some vector has an even product with both bits' vectors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from innsight.llm.common import cut, per_text, unused

BITS = 64
WORDS = 3
SEED = 42
#: A bucket of up to so many fingerprints is compared pair by pair; a larger one
#: is joined through the fingerprints between (see ``links``), so none is dropped.
PAIRED = 64


def covering_masks(radius: int = 2, bits: int = BITS) -> list[int]:
    """2^(radius+1) - 1 masks such that any ``radius`` bits are all left out by one of them."""
    width = radius + 1
    # Vectors are dealt in turn, so that each mask holds about half the bits.
    vector = [1 + k % ((1 << width) - 1) for k in range(bits)]
    return [
        sum(1 << k for k in range(bits) if (vector[k] & v).bit_count() % 2)
        for v in range(1, 1 << width)
    ]


def _signed(number: int) -> int:
    return number - (1 << BITS) if number >> (BITS - 1) else number


def fingerprinter():
    """Makes the function of one text that gives its fingerprint as a signed number."""
    import numpy as np
    import xxhash

    digest = xxhash.xxh64_intdigest

    def one(text: str | None) -> int:
        words = (text or "").encode().lower().split()
        if not words:
            return 0
        joined = b" ".join(words)
        if len(words) <= WORDS:
            hashes = [digest(joined, SEED)]
        else:
            hashes, starts, at = [], [], 0
            for word in words:
                starts.append(at)
                at += len(word) + 1
            starts.append(at)
            hashes = [
                digest(joined[a : b - 1], SEED) for a, b in zip(starts, starts[WORDS:], strict=False)
            ]
        # Bits of up to a fixed number of shingles are laid out at a time.
        counts = np.zeros(BITS, dtype=np.int64)
        for k in range(0, len(hashes), 65536):
            part = np.array(hashes[k : k + 65536], dtype="<u8")
            counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
                axis=0, dtype=np.int64
            )
        set_bits = np.packbits(counts * 2 > len(hashes), bitorder="little")
        return int(set_bits.view("<i8")[0])

    return one


def fingerprint(text: Column) -> Column:
    """The fingerprint of whole texts; zero for a null text or one without words."""
    return per_text(fingerprinter, "long")(text)


def links(prints: DataFrame, radius: int = 2) -> DataFrame:
    """Edges (a, b) that join the same fingerprints as all pairs within ``radius`` bits do.

    ``prints`` has distinct fingerprints ``fp``. A small bucket gives its close
    pairs. In a large one each member stands under itself and all fingerprints one
    bit away outside the mask; members that meet there differ in two bits at most,
    and no more than 65 can meet, so they are tied to the least of them. Nothing
    is collected for a bucket of unbounded size, and no pair is lost.
    """
    if radius != 2:
        raise ValueError("the midpoints of large buckets are for a radius of 2")
    masks = [_signed(mask) for mask in covering_masks(radius)]
    keyed = prints.select("fp", F.explode(F.array(*[F.lit(m) for m in masks])).alias("mask")).select(
        "fp", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("bucket")
    )
    shared = (
        keyed.groupBy("mask", "bucket").agg(F.count(F.lit(1)).alias("members")).filter(F.col("members") > 1)
    )
    members = keyed.join(shared, ["mask", "bucket"])
    small = (
        members.filter(F.col("members") <= PAIRED)
        .groupBy("mask", "bucket")
        .agg(F.sort_array(F.collect_list("fp")).alias("fps"))
        .select(
            F.explode(
                F.expr(
                    "flatten(transform(fps, (a, i) -> transform(filter(slice(fps, i + 2, size(fps)),"
                    " b -> bit_count(a ^ b) <= 2), b -> struct(a, b))))"
                )
            ).alias("e")
        )
        .select("e.a", "e.b")
    )
    flips = F.array(F.lit(0).cast("long"), *[F.lit(_signed(1 << k)) for k in range(BITS)])
    between = (
        members.filter(F.col("members") > PAIRED)
        .select("fp", F.explode(F.filter(flips, lambda f: f.bitwiseAND(F.col("mask")) == 0)).alias("flip"))
        .select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("middle"))
        .distinct()
        .groupBy("middle")
        .agg(F.sort_array(F.collect_list("fp")).alias("fps"))
        .filter(F.size("fps") > 1)
        .select(F.col("fps")[0].alias("a"), F.explode(F.slice("fps", 2, BITS + 1)).alias("b"))
    )
    return small.unionByName(between).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the edges (a, b); the root is the least node it is joined to.

    Large-star and small-star steps in turn until nothing changes. A node's least
    neighbour comes from an aggregate and meets its edges in a plain join, whose
    crowded side adaptive execution splits. Each round is checkpointed.
    """
    edges = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state = None
    while True:
        both = edges.union(edges.select(F.col("v"), F.col("u")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter(F.col("u") != F.col("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .filter(F.col("u") != F.col("v"))
        )
        edges = cut(small.distinct())
        now = edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first()
        if now == state:
            break
        state = now
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())


def _placed(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows (doc_id, text_hash, fp); (fp, root) of each fingerprint; (root, best), the least
    (doc_id, text_hash) of each component, null if no row of it has an id."""
    prints = cut(docs.select("doc_id", F.xxhash64("text").alias("text_hash"), fingerprint(F.col("text")).alias("fp")))
    named = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "text_hash"))
    nodes = prints.groupBy("fp").agg(F.min(named).alias("least"))
    roots = components(links(nodes.select("fp")))
    placed = nodes.join(roots, nodes.fp == roots.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    return prints, placed.select("fp", "root"), placed.groupBy("root").agg(F.min("least").alias("best"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint and component_id of every row (doc_id, text; other columns are ignored).

    Rows of equal fingerprint and rows whose fingerprints differ in at most two
    bits are joined; component_id is the least doc_id of all that are joined. Null
    texts and texts without words share the fingerprint zero. A row without id
    keeps a null id and takes part in the joining, and a component of such rows
    alone has a null component_id.
    """
    prints, placed, best = _placed(docs)
    return prints.join(placed.join(best, "root"), "fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("best.doc_id").alias("component_id"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each component, with all its columns: the least by (doc_id, hash of the text).

    Components are those of ``near_duplicates``: fingerprints equal or joined by
    steps of two bits at most; null texts and texts without words form one. Rows
    without id come after all others. Of rows that repeat id and text, or have no
    id and one text, any one stays.
    """
    prints = cut(docs.select("doc_id", F.xxhash64("text").alias("text_hash"), fingerprint(F.col("text")).alias("fp")))
    rank = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")
    nodes = cut(prints.groupBy("fp").agg(F.min(rank).alias("rank")))
    roots = components(links(nodes.select("fp")))
    placed = nodes.join(roots, nodes.fp == roots.node, "left")
    best = placed.groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("rank").alias("best"))
    (own,) = unused(docs, "own_of_kept")
    kept = best.select(F.struct("best.doc_id", "best.text_hash").alias(own))
    # Texts that share an id may stand for different components: the hash tells them apart.
    # Copies go before the join, so those without id are no hot key. A struct of null equals another.
    rows = docs.withColumn(own, F.struct("doc_id", F.xxhash64("text").alias("text_hash"))).dropDuplicates([own])
    return rows.join(kept, own, "left_semi").drop(own)
