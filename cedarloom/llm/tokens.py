"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how this vocabulary's tokenizer cuts text before merging bytes.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"


@lru_cache
def encoding(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def count_tokens(texts: list[str], path: str = VOCABULARY) -> list[int]:
    enc = encoding(path)
    return [len(enc.encode_ordinary(t)) if t else 0 for t in texts]


def sized(docs: DataFrame, keep: list[str], text: str = "text", path: str = VOCABULARY) -> DataFrame:
    """The columns `keep` and n_tokens of the whole text; null and empty texts have none. The
    vocabulary is read from `path` on each executor; special tokens in a text are ordinary text."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            n = count_tokens([t if isinstance(t, str) else "" for t in b["_text"]], path)
            yield b.drop(columns="_text").assign(n_tokens=pd.Series(n, dtype="int64"))

    own = docs.selectExpr(*[f"`{c}`" for c in keep], f"`{text}` as _text")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema if f.name != "_text")
    return own.mapInPandas(count, f"{kinds}, n_tokens bigint")
