"""The semi-Markov field against all segmentations, and what it finds beyond the patterns."""

import itertools
import random
import re

import numpy as np
import pytest

from innsight.llm import personal


def _lattice(rng, text):
    names = {}
    lattice = personal.Lattice(text, 0, len(text), names, grow=True)
    weights = np.array([[rng.uniform(-2, 2) for _ in personal.KINDS] for _ in names]).reshape(len(names), len(personal.KINDS))
    return lattice, weights


def _labellings(lattice):
    """All sets of segments that don't overlap, each with all kinds."""
    spans = list(zip(lattice.starts, lattice.ends, strict=True))
    for size in range(len(spans) + 1):
        for chosen in itertools.combinations(range(len(spans)), size):
            own = sorted(spans[k] for k in chosen)
            if all(a[1] <= b[0] for a, b in itertools.pairwise(own)):
                for kinds in itertools.product(range(len(personal.KINDS)), repeat=size):
                    yield list(zip(chosen, kinds, strict=True))


@pytest.mark.parametrize("text", ["12.34.56.78", "a@b.cd", "+49 30 12", "x (at) y.de", "4111 1111"])
def test_best_and_expected_by_enumeration(text):
    rng = random.Random(text)
    for _ in range(3):
        lattice, weights = _lattice(rng, text)
        scores = lattice.scores(weights)
        for k, own in enumerate(lattice.features):
            assert scores[k] == pytest.approx(weights[own].sum(axis=0))
        found = [(sum(scores[k, kind] for k, kind in one), one) for one in _labellings(lattice)]
        top = max(total for total, _ in found)
        best = {(lattice.spans[lattice.starts[k]][0], kind, lattice.spans[lattice.ends[k] - 1][1]) for k, kind in max(found)[1]}
        assert set(lattice.best(weights)) == best
        chances, whole = np.zeros_like(scores), 0.0
        for total, one in found:
            whole += np.exp(total - top)
            for k, kind in one:
                chances[k, kind] += np.exp(total - top)
        assert np.allclose(lattice.expected(weights), chances / whole)


def test_nothing_to_fit_on(spark):
    """A table without a stretch, and one whose only stretch is long."""
    for text in ("no data here", "call " + "9" * 5000 + " now", "mail " + "a1 " * 400):
        docs = spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")
        assert personal.find(docs).count() == 2
    finder = personal.finder({}, np.zeros((1, len(personal.KINDS))))
    assert finder("write to me@here.org or 12 34 56 78 90 12")[-1] == 0


def test_the_sample_holds_different_stretches(spark):
    rows = [(k, "call +49 30 1234567 today") for k in range(3000)] + [(3000 + k, f"host 10.0.{k}.{k} is up") for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = personal.samples(docs, 150)
    assert len(found) == len(set(found)) == 150 == len(personal.samples(docs, 150)) and found == personal.samples(docs, 150)


def _planted(rng, form):
    name, host = (rng.choice("abcdefgh") * 2 + f"{rng.randrange(10**4)}" for _ in range(2))
    digits = "".join(rng.choice("0123456789") for _ in range(8))
    entity = {
        "mail": f"{name} (at) {host}.org", "bracket": f"{name}[at]{host}.com", "phone": f"({digits[:3]}) {digits[3:]}-{digits[:3]}",
    }[form]
    before, after = rng.choice([("reach me at ", " soon"), ("contact: ", "."), ("write to ", " today")])
    return before + entity + after, (len(before), len(before) + len(entity))


def test_held_out_forms_that_the_patterns_miss(spark):
    """Fitted on stretches of which a third are rewritten; other texts, other names and numbers."""
    rng = random.Random(21)
    train = []
    for k in range(900):
        mail, phone = f"n{k}.x@h{k % 70}.org", f"+{rng.randint(1, 99)} ({rng.randint(100, 999)}) {rng.randint(10**4, 10**5 - 1)}-{rng.randint(100, 999)}"
        train.append((k, rng.choice([f"reach me at {mail} soon", f"contact: {phone}.", f"write to {mail} today", f"in {k} of 12 cases", f"chapter {k}.3"])))
    docs = spark.createDataFrame(train, "doc_id long, text string")
    finder = personal.finder(*personal.train(personal.samples(docs)))
    hits, asked, extra = 0, 0, 0
    for form in ("mail", "bracket", "phone"):
        for _ in range(60):
            text, (start, end) = _planted(rng, form)
            assert not personal.base_spans(text)
            spans = [tuple(map(int, re.findall(r"\d+", s)[-2:])) for s in finder(text)[-2].split(",") if s]
            asked += 1
            hits += any(a < end and start < b for a, b in spans)
            extra += sum(not (a < end and start < b) for a, b in spans)
    clean = ["in 12 of 40 cases", "chapter 7.3 and 8.1", "at 10:30 on 5 May 2019", "version 2.0.1 build 77", "room 12"]
    false = sum(bool(finder(text)[-1]) for text in clean * 10)
    print(f"recall {hits / asked:.2f}, of {extra} spans beside, false alarms in clean texts {false} of 50")
    assert hits >= 0.8 * asked and extra <= 0.1 * asked and false <= 10
