"""The transducer settles the last token of a boundary only where it is asked for, and gives what the merges give."""

import json
import random

from innsight.llm import bpe


def merge_list(tmp_path):
    letters = {v: k for k, v in bpe.byte_letters().items()}
    merges = [("a", "b"), ("b", "c"), ("ab", "c"), ("c", "a"), ("bc", "a"), ("abc", "a"), ("a", "a"), ("aa", "aa"), ("aa", "b"), ("ca", "bc")]
    tokens = [letters[b] for b in range(256)] + [a + b for a, b in merges]
    model = {"vocab": {t: n for n, t in enumerate(dict.fromkeys(tokens))}, "merges": [f"{a} {b}" for a, b in merges]}
    path = tmp_path / "merges.json"
    path.write_text(json.dumps({"model": model, "added_tokens": []}))
    return bpe.MergeList(str(path))


def merged(merges, data):
    parts = [data[k : k + 1] for k in range(len(data))]
    while True:
        ranked = [(merges.rank[pair], k) for k, pair in enumerate(zip(parts, parts[1:])) if pair in merges.rank]
        if not ranked:
            return [merges.id_of[part] for part in parts]
        k = min(ranked)[1]
        parts[k : k + 2] = [parts[k] + parts[k + 1]]


def test_any_bytes_in_any_pieces(tmp_path):
    merges, draw = merge_list(tmp_path), random.Random(3)
    for size in [0, 1, 2, 3, *range(4, 60, 3), 400]:
        for _ in range(20):
            data = bytes(draw.choice(b"abc" if size % 2 else b"aabcx") for _ in range(size))
            transducer, found, at = bpe.Transducer(merges), [], 0
            while at < size:
                step = draw.randint(1, 9)
                found += transducer.feed(data[at : at + step])
                at += step
            assert found + transducer.finish() == merged(merges, data)


def test_boundaries_that_no_path_meets_are_left(tmp_path):
    merges = merge_list(tmp_path)
    transducer = bpe.Transducer(merges)
    transducer.feed(b"abca")
    transducer._back(4)
    assert None in transducer.last
