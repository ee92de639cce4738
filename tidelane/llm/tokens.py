"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Where the public vocabularies are installed; a parameter, never copied.  Beside the ranks lies the same vocabulary as JSON.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how the vocabulary's texts are divided into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters from which a text goes to the encoder without a limit on the length of a word; both give the same tokens.
LONG = 1 << 18

_loaded: dict[str, object] = {}


def _encoding(path: str) -> object:
    if path not in _loaded:
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        _loaded[path] = tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _loaded[path]


def _tokenizer(path: str) -> object:
    if path not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True
        _loaded[path] = tokenizer
    return _loaded[path]


def _count_long(text: str, path: str) -> int:
    encoded = _tokenizer(os.path.splitext(path)[0] + ".json").encode_batch_fast([text], add_special_tokens=False)
    return len(encoded[0])


def count_tokens(texts: list[str], path: str = VOCABULARY) -> list[int]:
    """Number of tokens of each whole text; names of special tokens in a text are ordinary text."""
    encode = _encoding(path).encode_ordinary
    return [len(encode(text)) if len(text) < LONG else _count_long(text, path) for text in texts]


def token_count(text: Column, path: str = VOCABULARY) -> Column:
    """BIGINT number of tokens of the whole text; 0 for a null or empty one."""

    @F.pandas_udf("bigint")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(count_tokens(batch.fillna("").tolist(), path), dtype="int64")

    return count(text)
