"""Quality rules by compression bands.

A text is compressed with Zstandard, whole and in fixed chunks. Repetitive text
compresses too well, noise too little; both bands depend on the length, since a
short text has little to refer back to. The bands are fitted on all labelled texts:
between the ratios of the good ones of like length, and a little beyond.
"""

from __future__ import annotations

from itertools import groupby
from math import ceil, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from innsight.llm.common import cut, per_text
from innsight.operators.late import only_ids

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = b"#*$%&|<>"
LEVEL = 3
CHUNK_BYTES = 2048

#: Bytes below which a band holds, least and greatest ratio of raw to compressed bytes; where nothing is fitted.
BANDS = (
    (512, 1.05, 2.6),
    (1024, 1.15, 3.0),
    (2048, 1.3, 3.4),
    (8192, 1.4, 4.0),
    (32768, 1.5, 4.8),
    (float("inf"), 1.5, 6.0),
)
#: Share of a text's chunks that may lie outside the band of their length.
MAX_BAD_CHUNKS = 0.25

#: Length classes per doubling; good texts that a class and its neighbours need; share of them inside the band,
#: and how far it reaches beyond them.
CLASSES = 4
FEW = 20
INSIDE = 0.998
MARGIN = 0.01
#: Bins of a ratio of one that good texts are counted in, and numbers of bins set aside for a class.
BINS = 256
SPAN = 1 << 40

SCHEMA = (
    "struct<n_words: long, word_chars: long, n_symbols: long, n_dup_lines: long, n_repeat_words: long,"
    " base_failed: boolean, kept: boolean, whole_ratio: double, n_chunks: long, n_bad_chunks: long, n_bytes: long>"
)


def _outside(size: int, ratio: float, bands) -> bool:
    for below, least, greatest in bands:
        if size < below:
            return not least <= ratio <= greatest
    return False


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three found at least twice in the text."""
    if len(words) < 4:
        return 0
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    seen, again = set(), set()
    for window in windows:
        (again if window in seen else seen).add(window)
    count, covered = 0, 0
    for start, window in enumerate(windows):
        if window in again:
            count += start + 3 - max(start, covered)
            covered = start + 3
    return count


def _fails(n_words: int, n_repeat: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat > MAX_REPEAT_PERCENT * n_words


def scorer(bands=BANDS, chunk_bytes=CHUNK_BYTES, max_bad_chunks=MAX_BAD_CHUNKS, level=LEVEL):
    """Makes the function of one text that gives the fields of ``SCHEMA``."""
    import zstandard

    compress = zstandard.ZstdCompressor(level=level, write_content_size=False).compress

    def one(text: str | None):
        data = (text or "").encode()
        words = data.split()
        n_words, n_bytes = len(words), len(data)
        word_chars = len(b"".join(words).decode())
        n_symbols = sum(data.count(symbol) for symbol in SYMBOLS)
        lines = [line for line in data.split(b"\n") if line and not line.isspace()]
        n_repeat = repeated_words(words)
        failed = _fails(n_words, n_repeat)
        ratio, n_chunks, bad = None, 0, 0
        if data:
            ratio = n_bytes / len(compress(data))
            # The last piece joins its neighbour when it is under half a chunk.
            n_chunks = max(1, (n_bytes + chunk_bytes // 2) // chunk_bytes)
            for k in range(n_chunks):
                piece = data[k * chunk_bytes : (k + 1) * chunk_bytes if k + 1 < n_chunks else n_bytes]
                bad += _outside(len(piece), len(piece) / len(compress(piece)), bands)
        kept = not failed and not _outside(n_bytes, ratio, bands) and bad <= max_bad_chunks * n_chunks
        return (
            n_words, word_chars, n_symbols, len(lines) - len(set(lines)), n_repeat,
            failed, kept, ratio, n_chunks, bad, n_bytes,
        )

    return one


def quality(text: Column, **options) -> Column:
    """The counts and the verdict of each text as one struct column.

    Null and empty texts have no words: they fail the base rule and have no
    ratio. Every text is read whole, whatever its length.
    """
    return per_text(lambda: scorer(**options), SCHEMA)(text)


def _length_class(size: int) -> int:
    return int(log2(size) * CLASSES)


def measurer(level=LEVEL):
    """Makes the function of one text that lists its length class and ratio, nothing if the base rule rejects it."""
    import zstandard

    compress = zstandard.ZstdCompressor(level=level, write_content_size=False).compress

    def one(text: str | None):
        data = (text or "").encode()
        words = data.split()
        if _fails(len(words), repeated_words(words)):
            return []
        return [(_length_class(len(data)), len(data) / len(compress(data)))]

    return one


def _ranks(n: int) -> tuple[int, int]:
    """Ranks of the least and greatest of ``n`` ratios that lie inside the band."""
    last = ceil(INSIDE * n) - 1
    return n - 1 - last, last


def _bands(ends: dict[int, tuple[float, float]]) -> tuple[tuple[float, float, float], ...]:
    """Bands from the least and greatest ratio inside, by length class; other lengths keep the limits of ``BANDS``."""
    fitted = [
        (2 ** (k / CLASSES), 2 ** ((k + 1) / CLASSES), least * (1 - MARGIN), greatest * (1 + MARGIN))
        for k, (least, greatest) in sorted(ends.items())
    ]
    borders = sorted({edge for low, high, *_ in fitted for edge in (low, high)} | {below for below, *_ in BANDS})
    out = []
    for low, below in zip([0, *borders], borders, strict=False):
        own = next((own for own in fitted if own[0] <= low < own[1]), None)
        default = next(band for band in BANDS if low < band[0])
        out.append((below, *(own[2:] if own else default[1:])))
    return tuple(out)


def limits(measured: list[tuple[int, float]]) -> tuple[tuple[float, float, float], ...]:
    """Bands from (bytes, ratio) of good texts, ``CLASSES`` to a doubling of the length: what ``fit`` gives for a table.

    A class looks at its neighbours' texts too. Where these are few its lengths keep the limits of ``BANDS``.
    """
    by_class: dict[int, list[float]] = {}
    for size, ratio in measured:
        own = _length_class(size)
        for k in (own - 1, own, own + 1):
            by_class.setdefault(k, []).append(ratio)
    ends = {}
    for k, found in by_class.items():
        if len(found) >= FEW and k >= 0:
            found.sort()
            first, last = _ranks(len(found))
            ends[k] = (found[first], found[last])
    return _bands(ends)


def _at(counts: list[tuple[float, int]], rank: int) -> tuple[float, int]:
    """The value at a rank of sorted (value, how many), and the rank among those equal to it."""
    for value, n in counts:
        if rank < n:
            return value, rank
        rank -= n
    raise ValueError("the rank lies beyond the values")


def _ends(measured: DataFrame) -> dict[int, tuple[float, float]]:
    """The least and greatest ratio inside the band of each class, neighbours' texts counted, of all (k, ratio).

    Exact. What reaches the driver are counts by bin of the ratio, then the different
    ratios in the two bins of a class that its ends lie in, whatever the number of texts.
    """
    near = measured.select(F.explode(F.expr("array(k - 1, k, k + 1)")).alias("k"), "ratio").filter("k >= 0")
    near = near.select((F.col("k") * F.lit(SPAN) + F.floor(F.col("ratio") * BINS)).alias("bin"), "ratio")
    counts = sorted(tuple(row) for row in near.groupBy("bin").count().collect())
    places = {}
    for k, own in groupby(counts, lambda x: x[0] // SPAN):
        own = list(own)
        n = sum(count for _, count in own)
        if n >= FEW:
            places[k] = [_at(own, rank) for rank in _ranks(n)]
    bins = sorted({at for both in places.values() for at, _ in both})
    inside: dict[int, list[tuple[float, int]]] = {}
    for at, ratio, count in near.filter(F.col("bin").isin(bins)).groupBy("bin", "ratio").count().collect() if bins else []:
        inside.setdefault(at, []).append((ratio, count))
    return {k: tuple(_at(sorted(inside[at]), rank)[0] for at, rank in both) for k, both in places.items()}


def fit(docs: DataFrame, labels: DataFrame) -> tuple[tuple[float, float, float], ...]:
    """Bands fitted on all texts (doc_id, text) that ``labels`` (doc_id, quality) call good and the base rule keeps.

    Texts are measured where they are read, after a bit map of the good ids, and only their
    measurements are joined by id. Rows that repeat, of either table, count once; null ids
    and labels are left out. Without labels the bands are ``BANDS``.
    """
    ids = F.col("doc_id").try_cast(docs.schema["doc_id"].dataType)
    good = labels.filter("quality = 1").select(ids.alias("doc_id")).filter("doc_id is not null").distinct()
    measure = per_text(measurer, "array<struct<k: int, ratio: double>>")
    texts = only_ids(docs.select("doc_id", "text"), good, "doc_id")
    found = texts.select("doc_id", F.explode(measure(F.col("text"))).alias("m")).select("doc_id", "m.k", "m.ratio")
    # No semi join: it would be moved below the measuring and deal out the texts.
    return _bands(_ends(cut(found.distinct().join(good, "doc_id").select("k", "ratio"))))


def score(docs: DataFrame, **options) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are ignored)."""
    return docs.select("doc_id", quality(F.col("text"), **options).alias("q")).select("doc_id", "q.*")


def keep(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` whose text is kept, with all their columns."""
    return docs.filter(quality(docs["text"], **options)["kept"])
