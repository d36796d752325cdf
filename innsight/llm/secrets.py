"""Secret scan: patterns, and a battery of randomness tests on what looks encoded.

A candidate is a long stretch of an encoding's alphabet. Three tests ask whether
its symbols could be drawn at random: a chi-squared test of uniformity, a runs test
about the middle of the alphabet, and the serial correlation of neighbours. Where
randomness is rejected the candidate is structure (a word, a path, a counter); the
rejections of each length class are held to a false-discovery rate over all
documents, since a long candidate gives more evidence than a short one. What is not
rejected is reported. All of it is column expressions.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The base kinds in their order, with pattern, the group whose length counts, and that length.
BASE = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
)
#: A single-class run of fewer characters can be left out before it is marked; only this kind is one.
AT_LEAST = {"hex": r"[0-9a-f]{24,}"}
CANDIDATE = r"[A-Za-z0-9+/_-]{16,}={0,2}"
_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Encodings from the narrowest: alphabet, and what a token in it must have besides.
ENCODINGS = (
    ("hex", _DIGITS + "abcdef", r"^(?=.*[0-9])(?=.*[a-f])[0-9a-f]+$"),
    ("upper hex", _DIGITS + "ABCDEF", r"^(?=.*[0-9])(?=.*[A-F])[0-9A-F]+$"),
    ("base32", _UPPER + "234567", r"^(?=.*[2-7])(?=.*[A-Z])[A-Z2-7]+$"),
    ("base36", _DIGITS + _LOWER, r"^(?=.*[0-9])(?=.*[a-z])[0-9a-z]+$"),
    ("base62", _DIGITS + _UPPER + _LOWER, r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[0-9A-Za-z]+$"),
    ("base64", _UPPER + _LOWER + _DIGITS + "+/", r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[0-9A-Za-z+/]+$"),
)
#: Shorter candidates are too few bits to be a key.
MIN_BITS = 80
RATE = 0.05
#: Steps of the p-value's logarithm that the false-discovery rule works on, and the last of them.
STEPS_PER_DECADE, LAST_STEP = 20, 400

#: The coefficients of formula 7.1.26 of Abramowitz and Stegun.
_ERFC = (1.061405429, -1.453152027, 1.421413741, -0.284496736, 0.254829592)

#: Parts of a text that are folded into one array, an even number.
PARTS = 256
#: Stands at both ends of a match; where a text has it itself, another character that no pattern takes stands in.
MARK, INSTEAD = "", "�"


def matches(text: Column, pattern: str) -> Column:
    """Leftmost matches that don't overlap: array of (start, end, value) in code points, end exclusive.

    Between marks a text is outside and inside a match in turn. Places are added up
    over ``PARTS`` parts at a time, so that the work grows with the number of matches and no faster.
    """
    marked = F.regexp_replace(F.translate(text, MARK, INSTEAD), pattern, f"{MARK}$0{MARK}")
    none = F.expr("cast(array() as array<struct<start: int, `end`: int, value: string>>)")

    def add(state: Column, part: Column) -> Column:
        end = state["at"] + F.length(part)
        span = F.struct(state["at"].alias("start"), end.alias("end"), part.alias("value"))
        return F.struct(
            end.alias("at"),
            (~state["inside"]).alias("inside"),
            F.when(state["inside"], F.array_append(state["found"], span)).otherwise(state["found"]).alias("found"),
        )

    def of(parts: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / PARTS).cast("int"))

        def block(n: Column) -> Column:
            return F.slice(parts, n * PARTS + 1, F.lit(PARTS))

        sizes = F.transform(blocks, lambda n: F.aggregate(block(n), F.lit(0), lambda a, part: a + F.length(part)))
        starts = F.aggregate(sizes, F.array(F.lit(0)), lambda a, n: F.array_append(a, F.element_at(a, -1) + n))

        def spans(starts: Column) -> Column:
            def within(n: Column) -> Column:
                start = F.struct(F.get(starts, n).alias("at"), F.lit(False).alias("inside"), none.alias("found"))
                return F.aggregate(block(n), start, add)["found"]

            return F.flatten(F.transform(blocks, within))

        return _bound(starts, spans)

    return F.when(text.rlike(pattern), _bound(F.split(marked, MARK, -1), of)).otherwise(none)


def base_spans(text: Column) -> dict[str, Column]:
    """Per base kind the matches that pass its length."""
    return {
        kind: F.filter(matches(text, AT_LEAST.get(kind, pattern)), _long_enough(pattern, group, least))
        for kind, pattern, group, least in BASE
    }


def _long_enough(pattern: str, group: int, least: int):
    return lambda m: F.length(F.regexp_extract(m["value"], pattern, group) if group else m["value"]) >= least


def _two_sided(z: Column) -> Column:
    """Chance of a normal variable at least as far from 0; Abramowitz and Stegun 7.1.26."""

    def tail(x: Column) -> Column:
        def series(t: Column) -> Column:
            out = F.lit(0.0)
            for c in _ERFC:
                out = (out + F.lit(c)) * t
            return F.least(F.lit(1.0), out * F.exp(-x * x))

        return _bound(F.lit(1.0) / (F.lit(1.0) + F.lit(0.3275911) * x), series)

    return _bound(F.abs(z) / F.lit(2**0.5), tail)


def _plain(token: Column) -> Column:
    """A token without padding, in the standard form of its alphabet."""
    return F.translate(F.regexp_replace(token, "=+$", ""), "-_", "+/")


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, b: a + b)


def _neighbours(values: Column, join) -> Column:
    """Of each value and the one before it."""
    return F.zip_with(F.slice(values, 2, F.size(values)), F.slice(values, 1, F.size(values) - 1), join)


def _bound(column: Column, use) -> Column:
    """``use`` of a column that is evaluated once."""
    return F.transform(F.array(column), use)[0]


def p_value(token: Column) -> Column:
    """How well a token's symbols agree with chance under its encoding; null if it has none or is too short."""
    alphabet = F.lit(None).cast("string")
    for _, letters, shape in reversed(ENCODINGS):
        fits = token.rlike(shape) & (F.length(token) >= ceil(MIN_BITS / log2(len(letters))))
        alphabet = F.when(fits, F.lit(letters)).otherwise(alphabet)

    def of(s: Column) -> Column:
        k = F.length(s["alphabet"]).cast("double")
        codes = F.transform(
            F.split(s["token"], "", -1),
            lambda symbol: F.call_function("instr", s["alphabet"], symbol).cast("double"),
        )
        return F.when(s["alphabet"].isNotNull(), _bound(F.struct(k.alias("k"), codes.alias("codes")), _battery))

    return _bound(F.struct(token.alias("token"), alphabet.alias("alphabet")), of)


def _battery(s: Column) -> Column:
    """The least p-value of the three tests, for three tries."""
    v, k, n = s["codes"], s["k"], F.size(s["codes"]).cast("double")
    seen = F.transform(F.array_distinct(v), lambda c: F.pow(F.size(F.array_remove(v, c)) - n, F.lit(2.0)))
    chi = _sum(seen) * k / n - n
    z_chi = (chi - (k - 1)) / F.sqrt(F.lit(2.0) * (k - 1) * (n - 1) / n)

    def runs(high: Column) -> Column:
        def z(t: Column) -> Column:
            mean = F.lit(2.0) * t["n1"] * (n - t["n1"]) / n
            spread = mean * (mean - 1) / (n - 1)
            return F.when(spread > 0, (t["turns"] - mean) / F.sqrt(spread)).otherwise(F.sqrt(n))

        turns = _sum(_neighbours(high, lambda a, b: F.abs(a - b)))
        return _bound(F.struct(_sum(high).alias("n1"), turns.alias("turns")), z)

    def serial(around: Column) -> Column:
        power = _sum(F.transform(around, lambda x: x * x))
        products = _sum(_neighbours(around, lambda a, b: a * b))
        return F.when(power > 0, (products / power + F.lit(1.0) / n) * F.sqrt(n)).otherwise(F.sqrt(n))

    z_runs = _bound(F.transform(v, lambda x: (x > k / 2).cast("double")), runs)
    z_serial = _bound(_sum(v) / n, lambda m: _bound(F.transform(v, lambda x: x - m), serial))
    # The test furthest from chance has the least p-value.
    return F.least(F.lit(1.0), F.lit(3.0) * _two_sided(F.greatest(F.abs(z_chi), F.abs(z_runs), F.abs(z_serial))))


def length_class(token: Column) -> Column:
    return F.floor(F.log2(F.length(token).cast("double")) * 2).cast("int")


def _step(p: Column) -> Column:
    """A p-value's step, rounded towards 1 so that no rejection is too easy."""
    return F.least(F.lit(LAST_STEP), F.floor(-F.log10(F.greatest(p, F.lit(1e-30))) * STEPS_PER_DECADE)).cast("int")


def thresholds(docs: DataFrame, rate: float = RATE) -> dict[int, int]:
    """Per length class the least step at which randomness is rejected, over all candidates of all documents.

    Candidates are counted by class and step; at most 64 classes of ``LAST_STEP``
    + 1 steps reach the driver. The rule is that of Benjamini and Hochberg.
    """
    token = F.col("token")
    counts = (
        docs.select(F.explode(matches(F.coalesce("text", F.lit("")), CANDIDATE)).alias("m"))
        .select(_plain(F.col("m.value")).alias("token"))
        .select(length_class(token).alias("class"), p_value(token).alias("p"))
        .filter(F.col("p").isNotNull())
        .groupBy("class", _step(F.col("p")).alias("step"))
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    )
    by_class: dict[int, dict[int, int]] = {}
    for row in counts:
        by_class.setdefault(row["class"], {})[row["step"]] = row["n"]
    found = {}
    for cls, steps in by_class.items():
        total, rank = sum(steps.values()), 0
        for step in sorted(steps, reverse=True):
            rank += steps[step]
            if 10 ** (-step / STEPS_PER_DECADE) <= rate * rank / total:
                found[cls] = step
    return found


def _placed(number: int):
    return lambda m: F.struct(m["start"].alias("s"), F.lit(number).alias("o"), m["end"].alias("e"))


def scan(docs: DataFrame, rate: float = RATE) -> DataFrame:
    """doc_id, base counts, base_sha256, spans and n_random of every row (doc_id, text; others are ignored).

    Null and empty texts have no spans. The scan reads the texts twice, once for
    the counts behind the false-discovery rule, and joins nothing: the rule leaves
    one number per length class.
    """
    reject = thresholds(docs, rate)
    text = F.coalesce("text", F.lit(""))
    limit = F.lit(LAST_STEP + 1)
    found = base_spans(text)

    def random(m: Column) -> Column:
        token = _plain(m["value"])
        bound = limit
        for cls, step in sorted(reject.items()):
            bound = F.when(length_class(token) == cls, F.lit(step)).otherwise(bound)
        return _bound(p_value(token), lambda p: p.isNotNull() & (_step(p) < bound))

    found["random"] = F.filter(matches(text, CANDIDATE), random)
    order = list(found)
    rows = docs.select("doc_id", *[column.alias(kind) for kind, column in found.items()])

    def joined(kinds: list[str]) -> Column:
        spans = [F.transform(kind, _placed(order.index(kind))) for kind in kinds]
        names = F.array(*[F.lit(kind) for kind in order])
        listed = F.array_sort(F.concat(*spans))
        return F.array_join(
            F.transform(listed, lambda m: F.concat_ws(":", F.get(names, m["o"]), m["s"].cast("string"), m["e"].cast("string"))),
            ",",
        )

    base = [kind for kind, *_ in BASE]
    return rows.select(
        "doc_id",
        *[F.size(kind).cast("long").alias(f"n_{kind}") for kind in base],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(order).alias("spans"),
        F.size("random").cast("long").alias("n_random"),
    )
