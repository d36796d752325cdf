"""Spark side of byte-pair encoding: encode, digest and decode whole texts."""

from __future__ import annotations

import gc
import hashlib
import sys
from array import array

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from innsight.llm.bpe import Decoder, Encoder, MergeList
from innsight.llm.common import per_text

_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per Python worker and vocabulary, with its caches."""
    if path not in _ENCODERS:
        # The caches hold many small objects without cycles: look through them rarely.
        gc.set_threshold(1_000_000, 20, 50)
        _ENCODERS[path] = Encoder(MergeList(path))
    return _ENCODERS[path]


def ids(text: Column, path: str) -> Column:
    """Token ids as an array; of a null text none."""
    return per_text(lambda: lambda t, e=encoder(path): e.encode(t or ""), "array<int>")(text)


def decoded(token_ids: Column, path: str) -> Column:
    """The text of an array of token ids; of null none."""

    def make():
        merges = encoder(path).merges
        return lambda found: Decoder(merges).feed(found or [], final=True)

    return per_text(make, "string")(token_ids)


def _round_trip(path: str):
    own = encoder(path)

    def one(text: str | None):
        count, id_hash, text_hash = 0, hashlib.sha256(), hashlib.sha256()
        decoder = Decoder(own.merges)
        for part in own.blocks(text or ""):
            packed = array("I", part)
            if sys.byteorder == "big":
                packed.byteswap()
            count += len(part)
            id_hash.update(packed)
            text_hash.update(decoder.feed(part).encode())
        text_hash.update(decoder.feed([], final=True).encode())
        return count, id_hash.hexdigest(), text_hash.hexdigest()

    return one


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Encode and decode every text: doc_id, n_tokens, ids_sha256, decoded_sha256.

    A text passes block by block, so memory does not grow with its length. A null
    text counts as empty; extra columns are ignored.
    """
    schema = "struct<n_tokens: long, ids_sha256: string, decoded_sha256: string>"
    found = per_text(lambda: _round_trip(path), schema)(F.col("text"))
    return docs.select("doc_id", found.alias("r")).select("doc_id", "r.*")
