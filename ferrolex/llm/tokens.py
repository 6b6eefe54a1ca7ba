"""Token counts with the vocabulary file of a public tokenizer; the files are never copied, their folder is a parameter."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Folder of the vocabulary files and the vocabulary used by default.
TOKENIZERS = os.environ.get("FERROLEX_TOKENIZERS", "/opt/tokenizers")
VOCABULARY = "byte_bpe_50k.tiktoken"
#: Fixed value: the split pattern published with byte-level BPE of 50k entries.
SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=4)
def encoding(folder: str = TOKENIZERS, vocabulary: str = VOCABULARY):
    import tiktoken

    with open(os.path.join(folder, vocabulary), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("own", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


def encode(text: str, folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> list[int]:
    """Token ids of a whole text; strings that look like special tokens are ordinary text."""
    return encoding(folder, vocabulary).encode_ordinary(text)


def token_count(text: Column, folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> Column:
    """Number of tokens of each text: 0 for an empty text, null for null."""

    @F.pandas_udf("bigint")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = encoding(folder, vocabulary)
        for texts in batches:
            yield pd.Series([None if t is None else len(own.encode_ordinary(t)) for t in texts], dtype="Int64")

    return count(text)
