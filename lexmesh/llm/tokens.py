"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Where the vocabulary lies; every operator takes another path.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how the public byte-level vocabulary cuts texts before merging.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters tokenized at once; longer texts are cut before a blank, where the pattern cuts as well.
PIECE_CHARS = 200_000


@functools.cache
def encoding(path: str):
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def count_tokens(text: str | None, path: str = VOCABULARY) -> int:
    """Tokens of one whole text; null and empty have none."""
    if not text:
        return 0
    own, total, at = encoding(path), 0, 0
    while len(text) - at > PIECE_CHARS:
        cut = text.rfind(" ", at + 1, at + PIECE_CHARS)
        # only between a letter or digit and a single blank before a letter do both sides cut alike
        while cut > at and not (text[cut - 1].isalnum() and text[cut + 1].isalnum()):
            cut = text.rfind(" ", at + 1, cut)
        if cut <= at:
            break
        total += len(own.encode_ordinary(text[at:cut]))
        at = cut
    return total + len(own.encode_ordinary(text[at:]))


def sized(documents: DataFrame, *keep: str, path: str = VOCABULARY) -> DataFrame:
    """(keep..., n_tokens) of every row's text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pa.array([count_tokens(t, path) for t in batch.column("text").to_pylist()], pa.int64())
            yield pa.record_batch([*[batch.column(c) for c in keep], sizes], names=[*keep, "n_tokens"])

    picked = documents.select(*keep, "text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.select(*keep).schema.fields)
    return picked.mapInArrow(run, f"{schema}, n_tokens long")
