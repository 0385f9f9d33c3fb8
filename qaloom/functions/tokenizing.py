"""Token counts by a tokenizer of the user's choice, loaded once per Python worker."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_LOADED: dict[str, Callable[[list[str]], list[int]]] = {}  # lives as long as the worker, over many tasks


def _loaded(key: str, load: Callable[[], Callable[[list[str]], list[int]]]) -> Callable[[list[str]], list[int]]:
    if key not in _LOADED:
        _LOADED[key] = load()
    return _LOADED[key]


def tokenizer_count(c: str | Column, key: str, load: Callable[[], Callable[[list[str]], list[int]]], batch_size: int = 256) -> Column:
    """Number of tokens of each text (null: of an empty one).

    ``load()`` runs on the workers, once each, and gives a function from a list of texts to their token counts; ``key``
    names it. Only the text column goes to Python, in batches of at most ``batch_size`` texts.
    """

    @F.pandas_udf("int")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = _loaded(key, load)
        for texts in batches:
            texts = texts.fillna("")
            counts: list[int] = []
            for start in range(0, len(texts), batch_size):
                counts.extend(encode(texts.iloc[start:start + batch_size].tolist()))
            yield pd.Series(counts, dtype="int32")

    return count(c)


def library_tokenizer(path: str) -> Callable[[], Callable[[list[str]], list[int]]]:
    """Loader for a tokenizer file of the ``tokenizers`` (.json) or ``sentencepiece`` (.model) library, without special
    tokens. The file has to be readable on the workers, under the same path."""

    def load() -> Callable[[list[str]], list[int]]:
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            return lambda texts: [len(ids) for ids in model.encode(texts)]
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        return lambda texts: [len(e.ids) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    return load


def split_tokenizer() -> Callable[[list[str]], list[int]]:
    """Words and marks: runs of letters, digits and underscores, and runs of other visible characters."""
    from tokenizers.pre_tokenizers import Whitespace

    split = Whitespace()
    return lambda texts: [len(split.pre_tokenize_str(t)) for t in texts]
