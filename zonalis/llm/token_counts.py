"""Token counts by the tokenizers library, from Arrow functions that return lengths only.

A text is cut where the byte-level pre-tokenizer always cuts, before a single space between two characters that are
not white space, so that a long text is never encoded in one call. Equal pieces are encoded once: a worker keeps
the counts of a fixed number of pieces, and pieces it does not know go to the library in batches of equal bytes.
A stretch without a safe boundary stays whole, so counts are exact.

NULL texts count as empty: no bytes, no tokens. Strings of special tokens inside a text count as the library does
by default: one token. Repeated rows count alike, other columns are kept, one with the name of a result is replaced.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from zonalis.llm.common import col, portions, with_fields

SAFE = re.compile(r"(?<=\S) (?=\S)")
BATCH_BYTES = 1 << 18  # bytes of new pieces in one call of the library
REMEMBERED = 400_000  # pieces whose counts a worker keeps
REMEMBERED_CHARS = 96
_LOADED: dict[int, object] = {}


def _tokenizer(definition: str) -> object:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks, the library gets one thread
    from tokenizers import Tokenizer

    key = hash(definition)
    if key not in _LOADED:
        _LOADED.clear()
        loaded = Tokenizer.from_str(definition)
        loaded.no_truncation()
        loaded.no_padding()
        _LOADED[key] = loaded
    return _LOADED[key]


def _pieces(text: str, special: re.Pattern | None) -> list[str]:
    """The pieces whose counts add up to the count of the text; a special token's string is a piece of its own."""
    out: list[str] = []
    for segment in special.split(text) if special else [text]:
        first, *rest = SAFE.split(segment)
        if first:
            out.append(first)
        out += [" " + p for p in rest]
    return out


def _balanced(pieces: list[str], limit: int) -> Iterator[list[str]]:
    """Batches of about equal bytes, longest pieces first; a piece over the limit is alone."""
    batch: list[str] = []
    size = 0
    for p in sorted(pieces, key=len, reverse=True):
        n = len(p.encode())
        if batch and size + n > limit:
            yield batch
            batch, size = [], 0
        batch.append(p)
        size += n
    if batch:
        yield batch


def _counter(definition: str) -> Callable[[Column], Column]:
    @arrow_udf("long")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        library = _tokenizer(definition)
        marks = sorted((t.content for t in library.get_added_tokens_decoder().values()), key=len, reverse=True)
        special = re.compile("(" + "|".join(map(re.escape, marks)) + ")") if marks else None
        known: dict[str, int] = {}
        for texts in batches:
            out: list[int] = []
            for portion in portions(texts):
                cut = [_pieces((t or b"").decode(), special) for t in portion]
                new = {p for pieces in cut for p in pieces if p not in known}
                if len(known) + len(new) > REMEMBERED:
                    known.clear()
                    new = {p for pieces in cut for p in pieces}
                for batch in _balanced(list(new), BATCH_BYTES):
                    for p, e in zip(batch, library.encode_batch_fast(batch, add_special_tokens=False), strict=True):
                        known[p] = len(e)
                count = known.__getitem__
                out += [sum(map(count, pieces)) for pieces in cut]
                for p in [p for p in new if len(p) > REMEMBERED_CHARS]:
                    del known[p]
            yield pa.array(out, pa.int64())

    return run


def token_counts(df: DataFrame, definition: str, text: str = "text", limit: int = 1024) -> DataFrame:
    """``df`` with ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit``."""
    content = F.coalesce(col(text), F.lit(""))
    return with_fields(
        df,
        F.struct(
            F.octet_length(content).cast("long").alias("n_bytes"),
            _counter(definition)(content).alias("n_tokens"),
        ),
        ["n_bytes", "n_tokens"],
    ).withColumn("over_limit", F.col("n_tokens") > limit)
