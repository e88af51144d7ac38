"""The place where a tokenizer plugs in: counts and ids of a text column."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.text import WS

#: Tokenizers that Spark computes itself, by name: one token a byte, a character, a word.
NATIVE: dict[str, Callable[[Column], Column]] = {
    "bytes": lambda text: F.octet_length(text).cast("long"),
    "characters": lambda text: F.length(text).cast("long"),
    "words": lambda text: F.regexp_count(text, F.lit(f"[^{WS}]+")).cast("long"),
}
Encoder = Callable[[Sequence[str]], Sequence[Sequence[int]]]


def token_counts(text: Column, tokenizer: str | Callable[[], Encoder]) -> Column:
    """Tokens of each text, no special ones: of a native tokenizer by name, or of what a factory returns.

    The factory is called once a worker process and batch; the encoder takes a list of texts. Null texts have null tokens.
    """
    if isinstance(tokenizer, str):
        return NATIVE[tokenizer](text)
    return F.size(token_ids(text, tokenizer)).cast("long")


def token_ids(text: Column, factory: Callable[[], Encoder], end: int | None = None) -> Column:
    """The ids of each text, and ``end`` after them if it is given."""

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def ids(texts: pd.Series) -> pd.Series:
        made = iter(factory()([t for t in texts if t is not None]))
        return pd.Series([None if t is None else [*next(made), *([] if end is None else [end])] for t in texts], dtype=object)

    return ids.asNondeterministic()(text)


def byte_level_surface(piece: str) -> str | None:
    """The text of a byte-level vocabulary entry; None if its bytes are no text of their own.

    Such vocabularies write printable Latin-1 bytes as themselves and the others as the code points from 256 on.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    value = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
    try:
        return bytes(value[c] for c in piece).decode("utf-8")
    except (KeyError, UnicodeDecodeError):
        return None


def vocabulary_counts(pieces: Mapping[str, int] | Sequence[str], low: str, high: str) -> tuple[int, int, int]:
    """(entries, entries that are text, entries with a character from low to high) of a byte-level vocabulary."""
    texts = [s for s in map(byte_level_surface, pieces) if s is not None]
    return len(pieces), len(texts), sum(any(low <= c <= high for c in s) for s in texts)
