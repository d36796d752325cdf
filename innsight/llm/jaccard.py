"""Joins of texts whose sets of word n-grams are alike, by partitions of the universe.

Two sets r and s have a Jaccard similarity of 4/5 or more exactly if they differ in
at most (|r| + |s|) / 9 members. Members are hashed into segments, as many as sets of
a size band need: sets that differ in h members agree on one of h + 1 segments. So
the subset that lies in a segment is a key, and sets that share a key are candidates.
A set stands in the partition of its own band and in that of the next larger one.

What a segment is worth is settled by cost. In bands of small sets, where segments
would be nearly empty, all segments are indexed by their one-deletion
neighbourhood (the subset and the subset less one member), which finds a difference
of one as well, so that half as many will do. In the others subsets alone are
indexed, with some segments to spare. A key that too many sets share is skipped by
all of them; a set that has more such keys, or empty segments, than it can spare is
indexed once more by the neighbourhoods of its segments.

Sets that lack segments even then stand close to many others. Each is compared with
a leader of every crowded key it has, one for most keys of a crowd, and described by
its difference from that leader. Two sets differ as their differences do, and a set that is not alike the
leader shares so many members of its difference with any set it is alike that a
prefix of either tells. So a crowd is not compared pair by pair, and no link that
joins two parts of a component is lost.

Sets that are alike share not one key but as many as the segments that one of them
has to spare, and one more: candidates that share fewer go. So do those whose counts
of members by hash already differ by more than the sets may. The others are verified
by their whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, exp, sqrt

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from innsight.llm.common import cut
from innsight.llm.simhash import components
from innsight.operators.late import only_ids

WORDS = 5
#: Fixed by the similarity of 4/5: sets differ in a NINTH of their sizes, and in size by a fourth.
NINTH = 9
#: Bands of sets smaller than this are indexed by neighbourhoods.
SMALL = 45
#: A key of more sets is crowded.
CROWD = 32
#: Pieces that the sets of a leader are dealt in.
PIECES = 64
#: Keys that a task holds before it sends them, and sets it remembers to have sent.
FLUSH_KEYS, REMEMBERED = 1_000_000, 200_000
_MIX = 0x9E3779B97F4A7C15
_NODE = (1 << 63) - 1
#: A key's low bits: the parity of its partition and the number of its segment.
_SEGMENT_BITS = 15
_LOW = (1 << (_SEGMENT_BITS + 1)) - 1
#: Spare segments of a set without possible partners.
_PLENTY = 1 << 30

PROFILE = "node long, size long, band long, spare0 long, spare1 long, more0 long, more1 long, counts binary"
#: Most buckets that a set's members are counted in.
BUCKETS = 1024


def _mixed(a):
    import numpy as np

    a = (a ^ (a >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return a ^ (a >> np.uint64(32))


def shingler():
    """Makes the function of one text that gives its set: hashes of its word n-grams in ascending order.

    A text of fewer words has one for all of them, one without words none.
    """
    import numpy as np
    import xxhash

    digest = xxhash.xxh64_intdigest

    def one(text: str | None):
        words = (text or "").encode().lower().split()
        if not words:
            return np.zeros(0, dtype=np.uint64)
        w = np.fromiter(map(digest, words), dtype=np.uint64, count=len(words))
        size = min(WORDS, len(w))
        out = w[: len(w) - size + 1] + np.uint64(size)
        for k in range(1, size):
            out = _mixed(out * np.uint64(_MIX)) + w[k : len(w) - size + 1 + k]
        return np.unique(_mixed(out))

    return one


def node_of(found) -> int:
    """A set's number: 63 bits of its hash; 0 for the empty set alone."""
    import xxhash

    return max(1, xxhash.xxh64_intdigest(found.tobytes()) >> 1) if len(found) else 0


def counts_of(found) -> bytes:
    """How many members begin with the same bits: about half as many buckets as members, a byte each, 255 for more."""
    import numpy as np

    bits = min(max(len(found).bit_length() - 2, 0), BUCKETS.bit_length() - 1)
    return np.minimum(np.bincount((found >> np.uint64(63 - bits)) >> np.uint64(1), minlength=1 << bits), 255).astype(np.uint8).tobytes()


def differences_by_counts(a: bytes, b: bytes) -> int:
    """Members that two sets of like sizes differ in at least, by their counts."""
    import numpy as np

    x, y = (np.frombuffer(data, dtype=np.uint8).astype(np.int64) for data in (a, b))
    if len(x) < len(y):
        x, y = y, x
    # A saturated count stands for no more than it says.
    folded = np.minimum(x.reshape(len(y), -1).sum(axis=1), 255)
    return int(np.abs(folded - np.minimum(y, 255)).sum())


def _within(a, b, total):
    found = zip(a.to_pylist(), b.to_pylist(), total.to_pylist(), strict=True)
    return pa.array([differences_by_counts(x, y) * NINTH <= n for x, y, n in found], type=pa.bool_())


_within.__annotations__ = {"a": pa.Array, "b": pa.Array, "total": pa.Array, "return": pa.Array}


class Plan:
    """Size bands and their partitions.

    A band ends where its least size has grown by a fourth, so that a set's partners
    lie in its own band or a neighbouring one.
    """

    def __init__(self):
        self.lowers, self.uppers, self.kept = [1], [1], {}

    def band(self, size: int) -> int:
        from bisect import bisect_left

        while self.uppers[-1] < size:
            self.lowers.append(self.uppers[-1] + 1)
            self.uppers.append(self.lowers[-1] * 5 // 4)
        return bisect_left(self.uppers, size)

    def partition(self, k: int) -> tuple[int, int, int]:
        """Segments of partition ``k``, spare ones among them, and 1 if they are indexed by neighbourhoods."""
        if k not in self.kept:
            while len(self.uppers) <= k:
                self.band(self.uppers[-1] + 1)
            low, most = self.lowers[k], 2 * self.uppers[k] // NINTH
            deep = int(self.uppers[k] < SMALL)
            needed, spare = self.needed(most, deep), 0
            for _ in range(20):
                # Of so many segments this many are expected to be of no use, being empty or nearly so.
                mean = low / (needed + spare)
                useless = (needed + spare) * exp(-mean) * (1 + mean * deep) if needed + spare > 1 else 0
                wanted = min(needed, ceil(useless + 2 * sqrt(useless) + (needed > 1)))
                if wanted <= spare:
                    break
                spare = wanted
            self.kept[k] = (needed + spare if most else 0, spare, deep)
        return self.kept[k]

    @staticmethod
    def needed(differences: int, deep: int) -> int:
        return differences // 2 + 1 if deep else differences + 1

    def roles(self, size: int) -> Iterator[tuple[int, int, int, int, int]]:
        """(partition, segments, of these indexed, spare ones, deep) of the two partitions a set stands in."""
        own, most = self.band(size), size * 5 // 4
        for k in (own, own + 1):
            segments, spare, deep = self.partition(k)
            if segments and (k == own or most >= self.lowers[k]):
                differences = (size + min(most, self.uppers[k])) // NINTH
                yield k, segments, self.needed(differences, deep) + spare, spare, deep


class Keys:
    """Keys of sets in their partitions."""

    def __init__(self):
        self.plan = Plan()

    def _segments(self, found, segments: int, indexed: int):
        import numpy as np

        place = ((found >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)
        borders = np.searchsorted(place, np.arange(indexed + 1, dtype=np.uint64))
        return place, borders, np.diff(borders)

    def profile(self, found) -> tuple[int, ...]:
        """The fields of ``PROFILE``: per parity the segments to spare, and how many more neighbourhoods may find."""
        spares, more = [_PLENTY, _PLENTY], [0, 0]
        if len(found):
            for k, segments, indexed, spare, deep in self.plan.roles(len(found)):
                sizes = self._segments(found, segments, indexed)[2]
                spares[k & 1] = spare - int((sizes <= deep).sum())
                more[k & 1] = 0 if deep else int((sizes > 1).sum())
        return node_of(found), len(found), self.plan.band(len(found)), *spares, *more, counts_of(found)

    def keys(self, found, again: tuple[bool, bool] | None = None):
        """Keys of a set; with ``again`` the neighbourhoods in the partitions of these parities instead."""
        import numpy as np

        out = []
        mixed = _mixed(found * np.uint64(_MIX))
        sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(mixed, dtype=np.uint64)])
        for k, segments, indexed, _, deep in self.plan.roles(len(found)):
            if again is not None and (deep or not again[k & 1]):
                continue
            near = deep or again is not None
            place, borders, sizes = self._segments(found, segments, indexed)
            own = sums[borders[1:]] - sums[borders[:-1]]
            salt = np.uint64((2 * k + near) * _MIX & (1 << 64) - 1)
            low = (np.arange(indexed, dtype=np.uint64) & np.uint64((1 << _SEGMENT_BITS) - 1)) << np.uint64(1) | np.uint64(k & 1)
            some = sizes > 0
            out.append(self._finished(own[some] + salt, low[some]))
            if near:
                last = int(borders[-1])
                at = place[:last].astype(np.int64)
                many = sizes[at] > 1
                out.append(self._finished(own[at][many] - mixed[:last][many] + salt, low[at][many]))
        return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)

    @staticmethod
    def _finished(sums, low):
        import numpy as np

        return _mixed(_mixed(sums) * np.uint64(_MIX)) & ~np.uint64(_LOW) | low


def _sent(keys: list, nodes: list) -> pa.RecordBatch:
    """Keys of some sets. One that is crowded among them already goes out as a mark (node -1), and its rows,
    with negative nodes, need not meet the others: they are dealt out by themselves."""
    import numpy as np

    key = np.concatenate(keys)
    node = np.repeat(np.array(nodes, dtype=np.uint64), [len(k) for k in keys])
    order = np.argsort(key, kind="stable")
    key, node = key[order], node[order]
    start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, dtype=np.int64)
    count = np.diff(np.append(start, len(key)))
    crowded = count > CROWD
    node = np.where(np.repeat(crowded, count), node | np.uint64(1 << 63), node)
    key = np.concatenate([key, key[start[crowded]]])
    node = np.concatenate([node.view(np.int64), np.full(int(crowded.sum()), -1)])
    return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(node)], names=["key", "node"])


def _key_rows(df: DataFrame, make) -> DataFrame:
    """(key, node) of the sets of a task, each set once; ``make`` gives the function of a column's batch to them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, keys = make(), Keys()
        waiting, nodes, size, seen = [], [], 0, set()
        for batch in batches:
            for found, again in sets(batch):
                node = node_of(found)
                if not node or node in seen:
                    continue
                if len(seen) >= REMEMBERED:
                    seen.clear()
                seen.add(node)
                waiting.append(keys.keys(found, again))
                nodes.append(node)
                size += len(waiting[-1])
                if size >= FLUSH_KEYS:
                    yield _sent(waiting, nodes)
                    waiting, nodes, size = [], [], 0
        if waiting:
            yield _sent(waiting, nodes)

    return df.mapInArrow(run, "key long, node long")


def _runs(batches: Iterator[pa.RecordBatch], whole) -> Iterator:
    """Runs of equal keys over sorted batches: ``whole(columns, start, count)`` of all that have ended in a batch."""
    import numpy as np

    rest = None
    for batch in batches:
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(batch.num_columns)]
        if rest is not None:
            columns = [np.concatenate(pair) for pair in zip(rest, columns, strict=True)]
        key = columns[0]
        if not len(key):
            continue
        last = int(np.searchsorted(key, key[-1]))
        rest = [c[last:] for c in columns]
        if last:
            yield from whole([c[:last] for c in columns])
    if rest is not None:
        yield from whole(rest)


def _starts(key):
    import numpy as np

    start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return start, np.diff(np.append(start, len(key)))


def _met(columns) -> Iterator[pa.RecordBatch]:
    """Of runs (key, node): the pairs of small ones, and (key, node) of each row of crowded ones."""
    import numpy as np

    key, node = columns
    fresh = np.concatenate([[True], (key[1:] != key[:-1]) | (node[1:] != node[:-1])])
    key, node = key[fresh], node[fresh]
    start, count = _starts(key)
    crowded = (count > CROWD) | (np.minimum.reduceat(node, start) < 0)
    own = np.repeat(crowded, count) & (node != -1)
    if own.any():
        yield _meeting(key[own], node[own] & np.int64(_NODE), None, None)
    a, b = [], []
    for n in np.unique(count[~crowded & (count > 1)]).tolist():
        first = start[~crowded & (count == n)]
        rows = node[first[:, None] + np.arange(n)]
        i, j = np.triu_indices(n, 1)
        a.append(rows[:, i].ravel())
        b.append((rows[:, j] << 1 | (key[first] & 1)[:, None]).ravel())
    if a:
        # The parity goes into b's lowest bit, which nodes leave free.
        both, times = np.unique(np.stack([np.concatenate(a), np.concatenate(b)]).view(np.uint64), axis=1, return_counts=True)
        yield _meeting(both[0].view(np.int64), (both[1] >> np.uint64(1)).view(np.int64), (both[1] & np.uint64(1)).view(np.int64), times)


def _meeting(a, b, parity, times) -> pa.RecordBatch:
    import numpy as np

    none = np.zeros(len(a), dtype=np.int64)
    arrays = [a, b, none if parity is None else parity, none if times is None else times.astype(np.int64)]
    return pa.RecordBatch.from_arrays(
        [*map(pa.array, arrays), pa.array(np.full(len(a), times is None))], names=["a", "b", "parity", "times", "crowded"]
    )


def _meet(rows: DataFrame) -> DataFrame:
    """(a, b, parity, times, crowded): pairs by the keys they share, and (key, node) of the crowded keys."""
    apart = (F.col("node") < 0) & (F.col("node") != -1)
    dealt = rows.repartition(F.when(apart, F.xxhash64("key", "node")).otherwise(F.col("key")))
    return cut(
        dealt.sortWithinPartitions("key", "node").mapInArrow(
            lambda batches: _runs(batches, _met), "a long, b long, parity long, times long, crowded boolean"
        )
    )


def _of_texts():
    one = shingler()
    return lambda batch: ((one(text), None) for text in batch.column(0).to_pylist())


def _arrays(column) -> Iterator:
    """The lists of an Arrow column of longs as arrays."""
    import numpy as np

    values, ends = column.flatten().to_numpy(zero_copy_only=False).view(np.uint64), 0
    for n in np.diff(column.offsets.to_numpy()).tolist():
        yield values[ends : ends + n]
        ends += n


def _of_lacking():
    one = shingler()

    def sets(batch):
        columns = (batch.column(k).to_pylist() for k in range(3))
        return ((one(text), again) for text, *again in zip(*columns, strict=True))

    return sets


def profiles(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash and the fields of ``PROFILE`` of its set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, keys = shingler(), Keys()
        for batch in batches:
            found = zip(*(keys.profile(one(text)) for text in batch.column(2).to_pylist()), strict=True)
            kinds = [pa.int64()] * 7 + [pa.binary()]
            columns = list(found) or [[]] * len(kinds)
            arrays = [pa.array(column, type=kind) for column, kind in zip(columns, kinds, strict=True)]
            names = ["doc_id", "text_hash", *[field.split()[0] for field in PROFILE.split(", ")]]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *arrays], names=names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(run, f"doc_id long, text_hash long, {PROFILE}")


def _texts(docs: DataFrame, wanted: DataFrame, *columns: str) -> DataFrame:
    """node, text and ``columns`` of the wanted nodes (node, doc_id, text_hash), from the row that stands for each."""
    own = F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash")).alias("own")
    named = wanted.select("node", *columns, F.struct("doc_id", "text_hash").alias("own"))
    found = only_ids(docs.select(own, "text"), named.select("own"), "own").join(named, "own")
    return found.drop("own").dropDuplicates(["node"])


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, members) of the wanted nodes (node, doc_id, text_hash)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        one = shingler()
        for batch in batches:
            found = [one(text).view(np.int64) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, type=pa.list_(pa.int64()))], names=["node", "members"]
            )

    return _texts(docs, wanted).select("node", "text").mapInArrow(run, "node long, members array<long>")


def _arrays(column) -> Iterator:
    """The lists of an Arrow column of longs as arrays."""
    import numpy as np

    values, ends = column.flatten().to_numpy(zero_copy_only=False).view(np.uint64), 0
    for n in np.diff(column.offsets.to_numpy()).tolist():
        yield values[ends : ends + n]
        ends += n


def alike(n_a: int, n_b: int, common: int) -> bool:
    return 100 * common >= 80 * (n_a + n_b - common)


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole sets are alike."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            keep = [
                alike(len(x), len(y), len(np.intersect1d(x, y, assume_unique=True)))
                for x, y in zip(_arrays(batch.column(2)), _arrays(batch.column(3)), strict=True)
            ]
            yield batch.select([0, 1]).filter(pa.array(keep, type=pa.bool_()))

    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("members").alias("x")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("members").alias("y")), "b"
    )
    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _killed(again: DataFrame) -> DataFrame:
    """node, killed0 and killed1: its segments, by parity, of whose neighbourhood some key is crowded; at most too many."""
    rows = again.filter("crowded").select(F.col("b").alias("node"), F.col("a").alias("key"))
    segment = F.shiftright(F.col("key").bitwiseAND(_LOW), 1)
    counts = []
    for parity in (0, 1):
        own = F.col("key").bitwiseAND(1) == parity
        # Numbers of segments repeat in sets of more than there are numbers.
        some = F.count_if(own) < (1 << _SEGMENT_BITS)
        counts.append(
            F.when(some, F.count_distinct(F.when(own, segment))).otherwise(F.count_if(own)).alias(f"killed{parity}")
        )
    return rows.groupBy("node").agg(*counts)


def _hard(lacking: DataFrame) -> DataFrame:
    """Of the lacking sets those that neighbourhoods don't make up for: node, the crowded keys that count, starved.

    A set is starved if its useless segments alone are more than it can spare: then
    a set alike it need not share a crowded key.
    """
    is_hard = [F.col(f"lacks{parity}") & (F.col(f"left{parity}") < 0) for parity in (0, 1)]
    starved = F.lit(False)
    for parity in (0, 1):
        starved = starved | (is_hard[parity] & (F.col(f"spare{parity}") < 0))
    own = F.filter("crowded", lambda k: F.when(k.bitwiseAND(1) == 0, is_hard[0]).otherwise(is_hard[1]))
    keys = F.coalesce(own, F.array().cast("array<long>")).alias("keys")
    return lacking.filter(is_hard[0] | is_hard[1]).select("node", keys, starved.alias("starved"), "spare0", "spare1")


def _of_both(pairs: DataFrame, sets: DataFrame, *columns: str) -> DataFrame:
    """``pairs`` of like sizes, in the partition of the larger band, with the columns of both sets."""
    for side in ("a", "b"):
        own = [F.col(name).alias(f"{name}_{side}") for name in ("size", "band", *columns)]
        pairs = pairs.join(sets.select(F.col("node").alias(side), *own), side)
    like = F.least("size_a", "size_b") * 5 >= F.greatest("size_a", "size_b") * 4
    return pairs.filter(like & (F.greatest("band_a", "band_b").bitwiseAND(1) == F.col("parity")))


def _by_counts(pairs: DataFrame, counts: DataFrame) -> DataFrame:
    """The pairs (a, b, size_a, size_b) that may be alike by the counts of their members (node, counts)."""
    for side in ("a", "b"):
        pairs = pairs.join(counts.select(F.col("node").alias(side), F.col("counts").alias(f"counts_{side}")), side)
    within = F.arrow_udf(_within, "boolean")(F.col("counts_a"), F.col("counts_b"), F.col("size_a") + F.col("size_b"))
    return pairs.filter(within).select("a", "b")


def _of_parity(name: str, side: str):
    return F.when(F.col("parity") == 0, F.col(f"{name}0_{side}")).otherwise(F.col(f"{name}1_{side}"))


#: Parts in a group around a leader: alike it; else a prefix that meets anyone's, or one that meets the alike only.
_NEAR, _FAR_LONG, _FAR_SHORT = 0, 1, 2


def _differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (node, leader, set, leader's set): a row (key, node, part) for each prefix member of their difference."""
    import numpy as np

    for batch in batches:
        keys, nodes, parts = [], [], []
        rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), _arrays(batch.column(2)), _arrays(batch.column(3)), strict=True)
        for node, leader, x, middle in rows:
            added, removed = np.setdiff1d(x, middle, assume_unique=True), np.setdiff1d(middle, x, assume_unique=True)
            # Added members come first in the order of all differences: few sets share them.
            members = np.concatenate([added, removed])
            size, total = len(members), len(x)
            near = leader != 0 and size * NINTH <= total + len(middle)
            if leader == 0:
                short = long = total - -(-4 * total // 5) + 1
            else:
                # No prefix is longer than a set may differ from one alike it, however far the leader is.
                long = size - max(1, size - (total + total * 5 // 4) // NINTH) + 1
                short = min(long, size - (NINTH * size + len(middle) - total) // (2 * NINTH))
            members = members[: short if near else long]
            keys.append(_mixed(_mixed(members) * np.uint64(_MIX) + np.uint64(leader)).view(np.int64))
            nodes.append(np.full(len(members), node))
            parts.append(np.where(np.arange(len(members)) < short, _NEAR if near else _FAR_SHORT, _FAR_LONG))
            if near:
                # The link to the leader itself, under a key of its own.
                keys.append(np.zeros(1, dtype=np.int64))
                nodes.append(np.array([node]))
                parts.append(np.array([-leader]))
        columns = [np.concatenate(c) if c else np.zeros(0, dtype=np.int64) for c in (keys, nodes, parts)]
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=["key", "node", "part"])


def _met_around(columns) -> Iterator[pa.RecordBatch]:
    """Of runs (key, node, part): each far one with those near the leader, and far ones by their short prefixes."""
    import numpy as np

    key, node, part = columns
    start, count = _starts(key)
    for at, n in zip(start[count > 1].tolist(), count[count > 1].tolist(), strict=True):
        own, kind = node[at : at + n], part[at : at + n]
        near, far, short = own[kind == _NEAR], own[kind != _NEAR], own[kind == _FAR_SHORT]
        for few, many in ((near, far), (short, short)):
            block = max(1, 1_000_000 // max(1, len(many)))
            for k in range(0, len(few), block):
                some = few[k : k + block]
                a, b = np.repeat(some, len(many)), np.tile(many, len(some))
                a, b = np.minimum(a, b), np.maximum(a, b)
                if (a < b).any():
                    both = np.unique(np.stack([a[a < b], b[a < b]]), axis=1)
                    yield pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], names=["a", "b"])


def _leaders(keyed: DataFrame) -> DataFrame:
    """(key, leader) of the crowded keys of hard sets (node, n, key).

    The set of a key with the most crowded keys, the one most like the others, gives way to the set that
    comes first so for most of its own keys. Else a crowd would have ever more leaders as it grows, each
    of a few keys, and its sets would be compared with all of them. Any leader of a key will do, one
    without it as well, as long as all sets that have the key are compared with the same one.
    """
    first = keyed.groupBy("key").agg(F.max(F.struct("n", "node"))["node"].alias("first"))
    own = keyed.join(first.select(F.col("first").alias("node")).distinct(), "node", "left_semi").join(first, "key")
    led = own.groupBy("node", F.col("first").alias("leader")).agg(F.count(F.lit(1)).alias("leads"))
    ways = led.groupBy(F.col("node").alias("first")).agg(F.max(F.struct("leads", "leader"))["leader"].alias("leader"))
    return first.join(ways, "first").select("key", "leader")


def _around_leaders(hard: DataFrame, sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) of hard sets to leaders, and candidate pairs among the sets that have one leader.

    Two sets that are alike and have met nowhere yet share one crowded key more than either has
    segments to spare. So a set leaves out as many of its keys, those whose leaders lead the fewest
    keys first: the shared key that comes last in that order is left out by neither.
    """
    keyed = hard.select("node", "spare0", "spare1", F.size("keys").alias("n"), F.explode("keys").alias("key"))
    first = cut(_leaders(keyed))
    follows = first.groupBy("leader").agg(F.count(F.lit(1)).alias("leads"))
    parity = F.col("key").bitwiseAND(1)
    order = Window.partitionBy("node", parity).orderBy("leads", "leader", "key")
    spare = F.when(parity == 0, F.col("spare0")).otherwise(F.col("spare1"))
    kept = keyed.join(first.join(follows, "leader"), "key").withColumn("place", F.row_number().over(order))
    led = kept.filter(F.col("place") > spare).select("node", "leader").unionByName(
        hard.filter("starved").select("node", F.lit(0).cast("long").alias("leader"))
    )
    none = sets.sparkSession.createDataFrame([(0, [])], "node long, members array<long>")
    middles = sets.unionByName(none).select(F.col("node").alias("leader"), F.col("members").alias("middle"))
    # A leader of many sets meets them in pieces.
    dealt = led.filter("node <> leader").distinct().withColumn("piece", F.pmod(F.xxhash64("node"), F.lit(PIECES)))
    pieces = dealt.select("leader", "piece").distinct().join(middles, "leader")
    both = dealt.join(sets, "node").join(pieces, ["leader", "piece"])
    rows = cut(both.select("node", "leader", "members", "middle").mapInArrow(_differences, "key long, node long, part long"))
    links = rows.filter("part < 0").select(F.col("node").alias("a"), (-F.col("part")).alias("b"))
    keyed = rows.filter("part >= 0").repartition("key").sortWithinPartitions("key", "node")
    return links, keyed.mapInArrow(lambda batches: _runs(batches, _met_around), "a long, b long")


def links(docs: DataFrame, nodes: DataFrame, counts: DataFrame) -> DataFrame:
    """Edges (a, b) between nodes that join the same sets as all pairs that are alike.

    ``nodes`` has one row per set: node, doc_id and text_hash of a row of ``docs`` that has it, and its
    profile; ``counts`` has its node and counts.
    """
    met = _meet(_key_rows(docs.select("text"), _of_texts))
    crowds = met.filter("crowded").groupBy(F.col("b").alias("node")).agg(F.collect_set("a").alias("crowded"))
    held = nodes.join(crowds, "node", "left")
    for parity, of_parity in enumerate((lambda k: k.bitwiseAND(1) == 0, lambda k: k.bitwiseAND(1) == 1)):
        own = F.filter(F.coalesce("crowded", F.array().cast("array<long>")), of_parity)
        held = held.withColumn(f"rest{parity}", F.col(f"spare{parity}") - F.size(own))
        held = held.withColumn(f"lacks{parity}", F.col(f"rest{parity}") < 0)
    held = cut(held)
    lacking = held.filter("lacks0 or lacks1")
    shared = cut(met.filter("not crowded").groupBy("a", "b", "parity").agg(F.sum("times").alias("times")))
    enough = F.col("times") > F.greatest(_of_parity("rest", "a"), _of_parity("rest", "b"))
    first = cut(_by_counts(_of_both(shared, held, "rest0", "rest1").filter(enough), counts))

    again = _meet(_key_rows(_texts(docs, lacking, "lacks0", "lacks1").select("text", "lacks0", "lacks1"), _of_lacking))
    lacking = lacking.join(_killed(again), "node", "left")
    for parity in (0, 1):
        left = F.col(f"rest{parity}") + F.col(f"more{parity}") - F.coalesce(f"killed{parity}", F.lit(0))
        lacking = lacking.withColumn(f"left{parity}", left)
    lacking = cut(lacking)
    # A segment found by its neighbourhood makes up for two differences, one found by its subset for one.
    more = again.filter("not crowded").groupBy("a", "b", "parity").agg(F.sum("times").alias("near"))
    both = _of_both(more.join(shared, ["a", "b", "parity"], "left"), lacking, "left0", "left1")
    made_up = F.col("near") * 2 + F.coalesce("times", F.lit(0)) > F.greatest(_of_parity("left", "a"), _of_parity("left", "b"))
    hard = cut(_hard(lacking))
    pairs = cut(_by_counts(both.filter(made_up), counts).unionByName(first))

    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).unionByName(hard.select("node")).distinct()
    sets = cut(_sets(docs, nodes.join(wanted, "node")))
    led, around = _around_leaders(hard, sets)
    return _verified(pairs.unionByName(around).distinct(), sets).unionByName(led)


def join(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every row (doc_id, text; other columns are ignored).

    Rows are linked if their sets have a similarity of 0.8 or more; component_id is
    the least doc_id that links lead to, the row's own included. Null texts and those
    without words are linked with nothing. A row without id keeps a null id and takes
    part in the linking; a component of such rows alone has a null component_id.
    Rows that repeat are linked, as their sets are equal. Sets are known by 63 bits and
    n-grams by 64 bits of their hashes.
    """
    rows = cut(profiles(docs))
    profile = ["size", "band", "spare0", "spare1", "more0", "more1"]
    named = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")
    nodes = cut(
        rows.filter("size > 0")
        .groupBy("node", *profile)
        .agg(F.min(named).alias("least"))
        .select("node", "least.doc_id", "least.text_hash", *profile)
    )
    counts = rows.filter("size > 0").groupBy("node").agg(F.max("counts").alias("counts"))
    roots = components(cut(links(docs, nodes, counts))).withColumnRenamed("node", "joined")
    placed = nodes.join(roots, nodes.node == roots.joined, "left").select(
        "node", "doc_id", F.coalesce("root", "node").alias("root")
    )
    least = placed.groupBy("root").agg(F.min("doc_id").alias("component"))
    known = placed.join(least, "root").select(F.col("node").alias("own"), "component")
    return rows.join(known, rows.node == known.own, "left").select(
        "doc_id",
        F.col("size").alias("n_shingles"),
        F.when(F.col("size") == 0, F.col("doc_id")).otherwise(F.col("component")).alias("component_id"),
    )


#: DuckDB: all pairs that share an n-gram, counted, and what is reachable. One statement over ``documents``.
JOIN_SQL = f"""
with recursive split as (
  select doc_id, [w for w in string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+')
    if w <> ''] as ws
  from documents
), sets as (
  select doc_id, list_distinct(case when len(ws) = 0 then [] when len(ws) < {WORDS} then [array_to_string(ws, ' ')]
    else [array_to_string(ws[i:i + {WORDS - 1}], ' ') for i in range(1, len(ws) - {WORDS - 2})] end) as grams
  from split
), distinct_sets as (
  select min(doc_id) as node, list_sort(grams) as grams from sets where len(grams) > 0 group by list_sort(grams)
), posted as (
  select node, len(grams) as n, unnest(grams) as gram from distinct_sets
), edges as (
  select a.node as a, b.node as b from posted a join posted b on a.gram = b.gram and a.node < b.node
    and 5 * a.n >= 4 * b.n and 5 * b.n >= 4 * a.n
  group by a.node, b.node, a.n, b.n having 100 * count(*) >= 80 * (a.n + b.n - count(*))
), both_ways as (
  select a, b from edges union all select b, a from edges
), reach(node, least) as (
  select node, node from distinct_sets
  union
  select e.b, r.least from reach r join both_ways e on e.a = r.node where r.least < e.b
), roots as (
  select node, min(least) as root from reach group by node
)
select s.doc_id, cast(len(s.grams) as bigint) as n_shingles, coalesce(r.root, s.doc_id) as component_id
from sets s left join distinct_sets d on list_sort(s.grams) = d.grams left join roots r on r.node = d.node
"""
