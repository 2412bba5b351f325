"""Byte-level BPE of a public vocabulary, as an encoder that tasks build from broadcast ranks."""

from __future__ import annotations

import base64

import public_tokenizers
import tiktoken
from pyspark import Broadcast
from pyspark.sql import SparkSession

# Fixed values of the public vocabulary: its one special token and that token's id.
SPECIAL = {"<|endoftext|>": 50256}


def ranks_file(name: str = "byte_bpe_50k.tiktoken") -> str:
    """Where the ranks lie on the driver."""
    return public_tokenizers.path(name)


def shared_ranks(spark: SparkSession, path: str | None = None) -> Broadcast:
    """The file's bytes and the split pattern, for every task; a vocabulary has a fixed size."""
    with open(path or ranks_file(), "rb") as file:
        return spark.sparkContext.broadcast((file.read(), public_tokenizers.PATTERN))


def encoder(shared: tuple[bytes, str]) -> tiktoken.Encoding:
    """The same ids as the vocabulary's own tokenizer without added special tokens: one in a text is one id."""
    data, pattern = shared
    ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines())}
    return tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens=SPECIAL)
