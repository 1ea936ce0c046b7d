"""Byte-level BPE encoding and decoding.

The encoder walks a piece from left to right with the longest token that starts at the place, as an Aho-Corasick
automaton over all tokens finds them. A token may follow another only if the two are compatible: if merging the
bytes of both by the merge list leaves exactly these two. When no token fits, the last one is taken back and its
next shorter prefix is tried; a place that failed once is never entered again, so the work is linear in the
length. A sequence whose neighbours are all compatible is the one that merging gives, so the result is exact.

The decoder copies bytes from one buffer that holds all tokens, by a table of offsets.

Texts are cut into pieces where the pre-tokenizer always cuts: before a single space between two characters that
are not white space. Pieces repeat a lot, and so do the pre-tokens of those that are new, so the ids of both are remembered for as long
as the Python worker lives: a fixed number of each, of which those go first that were not met for longest.

NULL texts encode as empty texts. The strings of special tokens inside a text become their ids. Empty texts have
no ids; NULL ids decode to an empty text. Repeated rows are encoded alike; other columns are kept, one with the
name of a result is replaced. An id outside the vocabulary is an error.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from zonalis.llm.common import col, portions, with_fields

# fixed value: the cut pattern of byte-level BPE files
CUT = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
# the pre-tokenizer starts a new token at a single space between two characters that are not white space
SAFE = re.compile(r"(?<=\S) (?=\S)")
# a space that is none of these; without any, all spaces are safe
UNSAFE = re.compile(r"\A |\s | \s| \Z")
# pieces and pre-tokens whose ids a Python worker keeps in each of two generations: some 150 MB in all
PIECES, TOKENS = 150_000, 250_000
REMEMBERED_CHARS = 64  # longer ones are not kept
PAIRS = 1_000_000  # compatibility answers a worker keeps
NEVER = 1 << 62


def byte_alphabet() -> dict[str, int]:
    """Characters by which byte-level vocabularies write the 256 bytes: printable ones as themselves, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Memory:
    """Ids by text. When the younger half is full, it becomes the older one, and what that held and was not met again goes."""

    def __init__(self, make: Callable[[str], bytes], room: int) -> None:
        self.make, self.room = make, room
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def of(self, text: str) -> bytes:
        ids = self.young.get(text)
        if ids is None:
            ids = self.old.get(text)
            if ids is None:
                ids = self.make(text)
            if len(text) <= REMEMBERED_CHARS:
                if len(self.young) >= self.room:
                    self.old, self.young = self.young, {}
                self.young[text] = ids
        return ids

    def all_of(self, texts: list[str]) -> list[bytes]:
        found = list(map(self.young.get, texts))
        return [self.of(t) if ids is None else ids for t, ids in zip(texts, found, strict=True)] if None in found else found


class Vocabulary:
    """Tokens by merge rank: the 256 bytes, then the merges in their order. Ids are looked up at the end."""

    def __init__(self, definition: str) -> None:
        import ahocorasick

        spec = json.loads(definition)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("dropout") or model.get("ignore_merges") or spec.get("normalizer"):
            raise ValueError("a byte-level BPE file without dropout, normalizer and ignore_merges is needed")
        cut = spec.get("pre_tokenizer") or {}
        if cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True):
            raise ValueError("the pre-tokenizer must be the plain byte-level one")
        alphabet = byte_alphabet()
        raw = {token: bytes(alphabet[c] for c in token) for token in model["vocab"]}
        ids = {raw[token]: i for token, i in model["vocab"].items()}
        self.token: list[bytes] = [bytes([b]) for b in range(256)]
        rank = {t: i for i, t in enumerate(self.token)}
        self.left, self.right = [-1] * 256, [-1] * 256
        self.merged: dict[tuple[int, int], int] = {}
        for merge in model["merges"]:
            first, second = merge.split(" ") if isinstance(merge, str) else merge
            a, b = rank[raw[first]], rank[raw[second]]
            both = raw[first] + raw[second]
            if both in rank:
                raise ValueError("two merges make the same token")
            rank[both] = self.merged[a, b] = len(self.token)
            self.token.append(both)
            self.left.append(a)
            self.right.append(b)
        self.id_of = [ids[t] for t in self.token]
        self.length = [len(t) for t in self.token]
        self.shorter = [next((rank[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in rank), -1) for t in self.token]
        self.automaton = ahocorasick.Automaton()
        for t, r in rank.items():
            self.automaton.add_word(t.decode("latin-1"), r)
        self.automaton.make_automaton()
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        for t in spec.get("added_tokens", ()):
            if t.get("lstrip") or t.get("rstrip") or t.get("single_word") or t.get("normalized"):
                raise ValueError("added tokens must be plain")
        order = sorted(self.special, key=len, reverse=True)
        self.special_cut = re.compile("(" + "|".join(map(re.escape, order)) + ")") if order else None
        self.pairs: dict[tuple[int, int], bool] = {}
        self.id_bytes = [i.to_bytes(4, "little") for i in self.id_of]
        self.tokens = Memory(lambda token: b"".join([self.id_bytes[r] for r in self.encode_piece(token.encode())]), TOKENS)
        self.pieces = Memory(lambda piece: b"".join(map(self.tokens.of, CUT.findall(" " + piece))), PIECES)  # without the space before them
        self._offsets({**{i: t for t, i in ids.items()}, **{i: s.encode() for s, i in self.special.items()}})

    def _offsets(self, by_id: dict[int, bytes]) -> None:
        tokens = [by_id.get(i, b"") for i in range(max(by_id) + 1)]
        self.known = np.array([i in by_id for i in range(len(tokens))])
        self.offset = np.concatenate([[0], np.cumsum([len(t) for t in tokens])]).astype(np.int64)
        self.buffer = np.frombuffer(b"".join(tokens), np.uint8)

    def compatible(self, a: int, b: int) -> bool:
        """Would merging leave the border between token a and token b alone?

        Both tokens are taken apart along the border, the later merge first. A merge over the border wins if it
        comes before the merge that swallows its left part, and not after the one that swallows its right part:
        of equal merges the left one is done first.
        """
        until_a = until_b = NEVER
        while True:
            over = self.merged.get((a, b), NEVER)
            if over < until_a and over <= until_b:
                return False
            if a > b and a >= 256:
                until_a, a = a, self.right[a]
            elif b >= 256:
                until_b, b = b, self.left[b]
            else:
                return True

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ranks of the tokens of one pre-token."""
        size = len(piece)
        length, shorter, pairs = self.length, self.shorter, self.pairs
        longest = [0] * size
        for end, rank in self.automaton.iter(piece.decode("latin-1")):
            longest[end + 1 - length[rank]] = rank  # ends rise, so the last token noted for a start is its longest
        closed = bytearray(size + 1)
        found: list[int] = []
        place, token = 0, longest[0]
        while True:
            end = place + length[token]
            fits = not closed[end]
            if fits and found:
                pair = (found[-1], token)
                known = pairs.get(pair)
                if known is None:
                    if len(pairs) >= PAIRS:
                        pairs.clear()
                    known = pairs[pair] = self.compatible(*pair)
                fits = known
            if fits:
                found.append(token)
                if end == size:
                    return found
                place, token = end, longest[end]
            elif shorter[token] >= 0:
                token = shorter[token]
            else:  # nothing starts here: take the last token back; its end is closed now, so a shorter one is next
                closed[place] = 1
                token = found.pop()
                place -= length[token]
                while shorter[token] < 0 and found:
                    closed[place] = 1
                    token = found.pop()
                    place -= length[token]
                token = shorter[token]

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        out: list[bytes] = []
        for k, segment in enumerate(self.special_cut.split(text) if self.special_cut else [text]):
            if k % 2:
                out.append(self.special[segment].to_bytes(4, "little"))
            else:
                first, *rest = SAFE.split(segment) if UNSAFE.search(segment) else segment.split(" ")
                out += map(self.tokens.of, CUT.findall(first))
                out += self.pieces.all_of(rest)
        return b"".join(out)

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of the tokens, by the offset table."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.known) or not self.known[ids].all()):
            raise ValueError("an id is not in the vocabulary")
        start = self.offset[ids]
        size = self.offset[ids + 1] - start
        total = int(size.sum())
        shift = np.repeat(start - (np.cumsum(size) - size), size)
        return self.buffer[shift + np.arange(total)].tobytes()


_LOADED: dict[str, Vocabulary] = {}


def vocabulary(definition: str) -> Vocabulary:
    """One per Python worker and definition."""
    key = hashlib.sha256(definition.encode()).hexdigest()
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Vocabulary(definition)
    return _LOADED[key]


def definition_of(path: str) -> str:
    """Text of a tokenizer file, read by the driver and sent along: executors need no copy of the file."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def _id_lists(coded: list[bytes]) -> pa.Array:
    """Ids of several texts, each given as its bytes, as a list array."""
    ends = np.cumsum([0] + [len(c) // 4 for c in coded], dtype=np.int64)
    values = pa.array(np.frombuffer(b"".join(coded), "<i4"), pa.int32())
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), values)


def _encoder(definition: str) -> Callable[[Column], Column]:
    @arrow_udf("array<int>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = vocabulary(definition)
        for texts in batches:
            parts = [_id_lists([known.encode((t or b"").decode()) for t in portion]) for portion in portions(texts)]
            yield pa.concat_arrays(parts) if parts else _id_lists([])

    return run


# What :func:`round_trip` can return
FIELDS = {"ids": "array<int>", "n_tokens": "long", "ids_sha256": "string", "decoded": "string", "decoded_sha256": "string"}


def _round_trip(definition: str, fields: Sequence[str]) -> Callable[[Column], Column]:
    @arrow_udf(f"struct<{','.join(f'{name}:{FIELDS[name]}' for name in fields)}>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = vocabulary(definition)

        def both(texts: list[bytes | None]) -> pa.Array:
            coded = [known.encode((t or b"").decode()) for t in texts]
            # bytes that are no UTF-8 become U+FFFD; whole texts come back as they were
            back = [known.decode(np.frombuffer(c, "<u4").astype(np.int64)).decode("utf-8", "replace") for c in coded]
            made = {
                "ids": lambda: _id_lists(coded),
                "n_tokens": lambda: pa.array([len(c) // 4 for c in coded], pa.int64()),
                "ids_sha256": lambda: pa.array([hashlib.sha256(c).hexdigest() for c in coded], pa.string()),
                "decoded": lambda: pa.array(back, pa.string()),
                "decoded_sha256": lambda: pa.array([hashlib.sha256(b.encode()).hexdigest() for b in back], pa.string()),
            }
            return pa.StructArray.from_arrays([made[name]() for name in fields], list(fields))

        for texts in batches:
            parts = [both(portion) for portion in portions(texts)]
            yield pa.concat_arrays(parts) if parts else both([])

    return run


def _decoder(definition: str) -> Callable[[Column], Column]:
    @arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = vocabulary(definition)
        for rows in batches:
            out = []
            for row in rows:
                ids = np.zeros(0, np.int64) if row.values is None else row.values.to_numpy(zero_copy_only=False).astype(np.int64)
                out.append(known.decode(ids).decode("utf-8", "replace"))
            yield pa.array(out, pa.string())

    return run


@arrow_udf(T.StringType())
def ids_sha256(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """SHA-256 of ids written as little-endian unsigned 32-bit integers; NULL ids as none."""
    for rows in batches:
        empty = np.zeros(0, "<u4")
        values = (empty if r.values is None else r.values.to_numpy(zero_copy_only=False).astype("<u4") for r in rows)
        yield pa.array([hashlib.sha256(v.tobytes()).hexdigest() for v in values], pa.string())


def encode(df: DataFrame, definition: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with the token ids of the text column as ``array<int>``."""
    return df.withColumn(ids, _encoder(definition)(F.coalesce(col(text), F.lit(""))))


def decode(df: DataFrame, definition: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with the text that the ids stand for. Bytes that are no UTF-8 become U+FFFD."""
    return df.withColumn(text, _decoder(definition)(col(ids)))


def round_trip(df: DataFrame, definition: str, text: str = "text", fields: Sequence[str] = ("ids", "ids_sha256", "decoded")) -> DataFrame:
    """``df`` with some of FIELDS: :func:`encode` and :func:`decode` in one pass.

    One Python worker for each task does both, so the vocabulary is held once and the ids need not go there and back.
    What is only needed as a digest stays in the worker.
    """
    both = _round_trip(definition, fields)(F.coalesce(col(text), F.lit("")))
    return with_fields(df, both, list(fields))
