"""Ranked lexical search by best-first document intervals.

The documents are dealt into blocks. In a block every query term has a posting
list (document, impact) and over it a sparse table that answers which posting of a
range has the greatest impact. A search keeps intervals of documents, the one of
the highest bound first; the bound is the sum of the terms' range maxima. An
interval is split at the document of its greatest single impact, which is scored
in full, until no bound reaches the score of the last place. The blocks' best
documents meet in one top-k per item.

Counts of the whole corpus come first, in an aggregate of their own. All scores are
integers.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from innsight.llm.common import cut

TOP = 20
#: Documents of a block, and intervals that are split at a time.
BLOCK_DOCS = 4096
AT_ONCE = 32
#: Terms of items that are sent out at a time, with repeats; a block of items holds one item more at most.
BLOCK_TERMS = 200_000
#: Groups that the best documents of one item are dealt in before the last ranking.
GROUPS = 64
#: Fixed values of the score.
WEIGHT, SCALE, FREE, PART, SLOPE = 1000, 1_000_000_000, 100, 25, 12

#: Bytes of a term, with A-Z in lower case; all other bytes separate.
_TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
    for b in range(256)
)

POSTINGS = "doc_id long, n long, terms array<int>, counts array<int>"
FOUND = "item_id long, doc_id long, score long"


def terms(text: str | None) -> list[bytes]:
    """Digits, ASCII letters in lower case and all other than ASCII characters, in maximal stretches."""
    return (text or "").encode().translate(_TERM_BYTES).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(WEIGHT * math.log((2 * n_docs + 2) / (2 * df + 1)))


def blocks(items: DataFrame) -> Iterator[list[tuple[int, Counter]]]:
    """The items (item_id, text) in blocks of bounded size; rows without id or terms, and repeated rows, go.

    Of rows that repeat an id with other texts each is ranked by itself.
    """
    block, size = [], 0
    rows = items.select("item_id", "text").filter("item_id is not null and text is not null").distinct()
    for item_id, text in rows.orderBy("item_id", "text").toLocalIterator():
        found = Counter(terms(text))
        if not found:
            continue
        block.append((item_id, found))
        size += found.total()
        if size >= BLOCK_TERMS:
            yield block
            block, size = [], 0
    if block:
        yield block


def postings(docs: DataFrame, numbers) -> DataFrame:
    """doc_id, n and the wanted terms with their counts, of every row with a term.

    ``numbers`` is the broadcast number of each wanted term.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = numbers.value.get
        for batch in batches:
            out = ([], [], [], [])
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = terms(text)
                if not found:
                    continue
                counts = Counter(map(number, found))
                counts.pop(None, None)
                for column, value in zip(out, (doc_id, len(found), list(counts), list(counts.values())), strict=True):
                    column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()))
            arrays = [pa.array(column, type=kind) for column, kind in zip(out, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n", "terms", "counts"])

    return docs.select("doc_id", "text").mapInArrow(run, POSTINGS)


class Block:
    """Posting lists of some documents, with a sparse table of range maxima over each.

    ``rows`` are (doc_id, n, terms, counts). Inside, documents are numbered so that
    those of one commonest term and of like length stand together: their impacts are
    alike, so bounds of their intervals are tight.
    """

    def __init__(self, rows: list[tuple], weights, n_docs: int, n_terms: int):
        import numpy as np

        rows = sorted(rows, key=lambda r: (max(zip(r[3], r[2], strict=True), default=(0, -1))[1], r[1], r[0] is None, r[0] or 0))
        self.ids = [r[0] for r in rows]
        self.size = len(rows)
        lengths = np.fromiter((len(r[2]) for r in rows), dtype=np.int64, count=self.size)
        doc = np.repeat(np.arange(self.size), lengths)
        term = np.fromiter((t for r in rows for t in r[2]), dtype=np.int64, count=len(doc))
        tf = np.fromiter((c for r in rows for c in r[3]), dtype=np.int64, count=len(doc))
        # Python's integers, since the product may pass 64 bits in a corpus of many very long texts.
        m = np.array([FREE - PART + PART * r[1] * n_docs // n_terms for r in rows], dtype=np.int64)
        impact = weights[term] * (SCALE * tf // (1000 * tf + SLOPE * m[doc]))
        order = np.lexsort((doc, term))
        doc, term, self.impact = doc[order], term[order], impact[order]
        present, first = np.unique(term, return_index=True)
        self.row_of = {int(t): k for k, t in enumerate(present)}
        self.first = np.append(first, len(doc))
        # Of each list, how many postings stand before a document: the borders of an interval in it.
        before = np.zeros((len(present), self.size + 1), dtype=np.int32)
        before[np.repeat(np.arange(len(present)), np.diff(self.first)), doc + 1] = 1
        self.before = np.cumsum(before, axis=1, dtype=np.int32)
        self.doc = doc
        # Level j of a table holds the best posting of the 2^j from each place on; lists follow each other.
        self.levels = [np.arange(len(doc), dtype=np.int32)]
        longest, width = int(np.diff(self.first).max(initial=1)), 1
        while 2 * width <= longest:
            low = self.levels[-1]
            a, b = low[:-width], low[width:]
            best = low.copy()
            best[: len(a)] = np.where(self.impact[a] >= self.impact[b], a, b)
            self.levels.append(best)
            width *= 2
        self.table = np.stack(self.levels)
        self.log = np.zeros(longest + 2, dtype=np.int64)
        for k in range(2, longest + 2):
            self.log[k] = self.log[k // 2] + 1

    def maxima(self, lists, start, end):
        """Per interval and list the range maximum and its posting (0 and -1 for an empty range)."""
        import numpy as np

        low = self.first[lists] + self.before[lists, start[:, None]]
        high = self.first[lists] + self.before[lists, end[:, None]]
        some = high > low
        level = self.log[np.where(some, high - low, 1)]
        a = self.table[level, np.where(some, low, 0)]
        b = self.table[level, np.where(some, high - (1 << level), 0)]
        best = np.where(self.impact[a] >= self.impact[b], a, b)
        return np.where(some, self.impact[best], 0), np.where(some, best, -1)

    def scores(self, lists, times, docs):
        """Full scores of documents."""
        import numpy as np

        at = self.before[lists, docs[:, None]]
        has = self.before[lists, docs[:, None] + 1] > at
        return (np.where(has, self.impact[np.where(has, self.first[lists] + at, 0)], 0) * times).sum(axis=1)

    def search(self, query: dict[int, int], best: list[tuple[int, float, int]], top: int = TOP) -> int:
        """Put the documents of this block that reach the first ``top`` into ``best``, a heap of
        (score, -doc_id, ...) with the last place first. Gives the number of documents scored."""
        import numpy as np

        known = [(self.row_of[t], times) for t, times in query.items() if t in self.row_of]
        if not known:
            return 0
        lists, times = (np.array(column, dtype=np.int64) for column in zip(*known, strict=True))

        def bounded(start, end):
            value, place = self.maxima(lists, start, end)
            value = value * times
            pick = value.argmax(axis=1)
            return value.sum(axis=1), place[np.arange(len(pick)), pick]

        bound, split = bounded(np.array([0]), np.array([self.size]))
        heap = [(-int(bound[0]), 0, self.size, int(split[0]))]
        scored = 0
        while heap:
            taken = []
            while heap and len(taken) < AT_ONCE:
                top_bound = -heap[0][0]
                # A bound that equals the last score may hide a tie of lesser id.
                if top_bound <= 0 or (len(best) >= top and top_bound < best[0][0]):
                    heap.clear()
                    break
                taken.append(heapq.heappop(heap))
            if not taken:
                break
            start, end = (np.array([t[k] for t in taken]) for k in (1, 2))
            at = self.doc[np.array([t[3] for t in taken])]
            scored += len(taken)
            for doc, score in zip(at.tolist(), self.scores(lists, times, at).tolist(), strict=True):
                if score > 0:
                    own = self.ids[doc]
                    entry = (score, -math.inf if own is None else -own, own)
                    if len(best) < top:
                        heapq.heappush(best, entry)
                    elif entry[:2] > best[0][:2]:
                        heapq.heapreplace(best, entry)
            start, end = np.concatenate([start, at + 1]), np.concatenate([at, end])
            some = start < end
            start, end = start[some], end[some]
            if not len(start):
                continue
            bound, split = bounded(start, end)
            least = best[0][0] if len(best) >= top else 1
            for k in np.flatnonzero(bound >= least).tolist():
                heapq.heappush(heap, (-int(bound[k]), int(start[k]), int(end[k]), int(split[k])))
        return scored


def _search_blocks(found: DataFrame, sent, top: int) -> DataFrame:
    """The best documents per item of each task's blocks of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        queries, weights, n_docs, n_terms = sent.value
        weights = np.array(weights, dtype=np.int64)
        best: list[list] = [[] for _ in queries]
        waiting: list[tuple] = []

        def search(rows):
            block = Block(rows, weights, n_docs, n_terms)
            for own, (_, query) in zip(best, queries, strict=True):
                block.search(query, own, top)

        for batch in batches:
            waiting.extend(zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True))
            while len(waiting) >= BLOCK_DOCS:
                search(waiting[:BLOCK_DOCS])
                del waiting[:BLOCK_DOCS]
        if waiting:
            search(waiting)
        rows = [(item_id, own, score, n) for n, (found_, (item_id, _)) in enumerate(zip(best, queries, strict=True)) for score, _, own in found_]
        names = ["item_id", "doc_id", "score", "query"]
        for k in range(0, len(rows), 50_000):
            part = list(zip(*rows[k : k + 50_000], strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(column, type=pa.int64()) for column in part], names=names)

    return found.mapInArrow(run, f"{FOUND}, query long")


def rank(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score of the ``top`` documents (doc_id, text) of each item (item_id, text).

    Only scores above 0 count; equal scores go by ascending doc_id, a null id
    last. Rows that repeat a doc_id are documents of their own, so that an id may
    come up more than once. Null and empty texts have no terms: such documents are
    never found and such items have no rows, as is true of items without id. Other
    columns are ignored. Two items of one id are ranked apart, each from 1.

    Items go out in blocks. Each takes one pass over the texts for the postings of
    its terms, which are written to the shared folder, and one over those. No group
    is collected: a task sends ``top`` rows an item.
    """
    found = None
    for number, block in enumerate(blocks(items)):
        ranked = _rank_block(docs, block, top).withColumn("block", F.lit(number))
        found = ranked if found is None else found.unionByName(ranked)
    if found is None:
        found = docs.sparkSession.createDataFrame([], "item_id long, doc_id long, score long, query long, block int")
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    one = ["block", "query", "item_id"]
    # First within pieces, so that the last ranking of an item gets few rows however many tasks there were.
    piece = F.pmod(F.xxhash64("doc_id", "score"), F.lit(GROUPS)).alias("piece")
    within = found.select("*", piece).withColumn(
        "place", F.row_number().over(Window.partitionBy(*one, "piece").orderBy(*order))
    )
    first = within.filter(F.col("place") <= top).drop("piece", "place")
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy(*one).orderBy(*order)))
    return ranked.filter(F.col("rank") <= top).select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def _rank_block(docs: DataFrame, block: list[tuple[int, Counter]], top: int) -> DataFrame:
    context = docs.sparkSession.sparkContext
    wanted = sorted({term for _, query in block for term in query})
    number = {term: k for k, term in enumerate(wanted)}
    sent = context.broadcast(number)
    found = cut(postings(docs, sent))
    sent.destroy()
    n_docs, n_terms = found.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    # At most as many rows as the block has terms.
    df = {r.term: r["count"] for r in found.select(F.explode("terms").alias("term")).groupBy("term").count().collect()}
    weights = [weight(n_docs, df.get(k, 0)) for k in range(len(wanted))]
    queries = [(item_id, {number[term]: times for term, times in query.items()}) for item_id, query in block]
    sent = context.broadcast((queries, weights, n_docs, n_terms))
    best = cut(_search_blocks(found, sent, top))
    sent.destroy()
    return best


#: DuckDB: the same ranking by scoring all documents. One statement over ``documents`` and ``benchmark``.
RANK_SQL = f"""
with docs as (
  select row_number() over () as row_no, doc_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as terms
  from documents where text is not null
), known as (
  select row_no, doc_id, len(terms) as n, terms from docs where len(terms) > 0
), corpus as (
  select count(*) as n_docs, sum(n) as n_terms from known
), counted as (
  select row_no, term, count(*) as tf from (select row_no, unnest(terms) as term from known) group by all
), weights as (
  select term, cast(floor({WEIGHT} * ln((2 * n_docs + 2) / (2 * count(*) + 1))) as bigint) as w
  from counted, corpus group by term, n_docs
), items as (
  select item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term
  from benchmark where text is not null and item_id is not null
), asked as (
  select item_id, term, count(*) as times from items group by all
), scored as (
  select item_id, c.row_no, k.doc_id,
    sum(times * w * (({SCALE} * tf) // (1000 * tf + {SLOPE} * ({FREE} - {PART} + ({PART} * n * n_docs) // n_terms)))) as score
  from asked join counted c using (term) join weights using (term) join known k on k.row_no = c.row_no, corpus
  group by all
), ranked as (
  select item_id, row_number() over (partition by item_id order by score desc, doc_id) as rank, doc_id, score
  from scored where score > 0
)
select item_id, cast(rank as integer) as rank, doc_id, cast(score as bigint) as score from ranked where rank <= {TOP}
"""
