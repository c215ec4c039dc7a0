"""Byte-level BPE by dynamic programming over prefixes.

For every prefix of a byte string there is exactly one token that can end its
BPE encoding: the one that BPE would leave next to the last token of the prefix
before it. Two neighbours are left alone if encoding their joined bytes gives
these two tokens again. Storing the last token
of every prefix gives the encoding of all of them, so appending bytes goes on
from the table, and after an edit only the table behind the edit is made again.

Texts are cut by the tokenizer's pattern first and every piece is encoded
separately.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from itertools import takewhile

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trolley.llm.common import release_memory, short_batches

VOCABULARY = "byte_bpe_50k.tiktoken"
# Pieces whose encodings a task remembers, and the longest that it remembers.
REMEMBERED = 250_000
# Pairs of tokens that it remembers.
REMEMBERED_PAIRS = 150_000
REMEMBERED_LENGTH = 64
# Bytes of text that a task encodes at a time.
PART_BYTES = 1 << 20
# How many pieces before the end of a text may change when text is appended: a
# contraction or the white space before a word can take in at most this many.
UNSETTLED = 3


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and their ranks from a file of base64 tokens and numbers."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class Vocabulary:
    """Ranks of tokens, and which tokens may stand next to each other."""

    def __init__(self, ranks: dict[bytes, int]):
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"no token for the single bytes {missing[:5]}")
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.parts: dict[bytes, tuple[bytes, bytes]] = {}
        self.neighbours = _Neighbours(self)

    def split(self, token: bytes) -> tuple[bytes, bytes]:
        """The two tokens whose merge makes ``token``, which has two bytes or more."""
        if token not in self.parts:
            self.parts[token] = self._merged(token, below=self.ranks[token])
        return self.parts[token]

    def _merged(self, token: bytes, below: int) -> tuple[bytes, bytes]:
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            best = min(range(len(parts) - 1), key=lambda i: self.ranks.get(parts[i] + parts[i + 1], below))
            if self.ranks.get(parts[best] + parts[best + 1], below) >= below:
                raise ValueError(f"token {token!r} cannot be reached by merges")
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return parts[0], parts[1]

    def may_be_neighbours(self, left: bytes, right: bytes) -> bool:
        """Whether BPE leaves ``left`` and ``right`` apart.

        Undo the later of the merges inside the two tokens, step by step: if at
        any step the tokens at the border could have merged earlier than the
        merge being undone, they would not both have come about.
        """
        ranks, limit = self.ranks, len(self.ranks) + 1
        while True:
            joined = ranks.get(left + right)
            if joined is not None and joined < limit:
                return False
            left_rank = ranks[left] if len(left) > 1 else -1
            right_rank = ranks[right] if len(right) > 1 else -1
            if left_rank < 0 and right_rank < 0:
                return True
            if left_rank > right_rank:
                limit, left = left_rank, self.split(left)[1]
            else:
                # Merges of one rank go from left to right, so a border pair of the
                # same rank comes before the merge inside the right token.
                limit, right = right_rank + 1, self.split(right)[0]


class _Neighbours(dict):
    """Pairs of tokens and whether BPE leaves them apart, found out once."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, pair: tuple[bytes, bytes]) -> bool:
        if len(self) >= REMEMBERED_PAIRS:
            self.clear()
        apart = self[pair] = self.vocabulary.may_be_neighbours(*pair)
        return apart


class PrefixTable:
    """The last token of the encoding of every prefix of some bytes."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary = vocabulary
        self.data = b""
        self.last: list[bytes] = []
        self.append(data)

    def append(self, more: bytes) -> None:
        ranks, neighbours = self.vocabulary.ranks, self.vocabulary.neighbours
        data = self.data = self.data + more
        last = self.last
        for end in range(len(last) + 1, len(data) + 1):
            # Exactly one of the tokens that end here fits; the shortest are tried first.
            start = end - 1
            token = data[start:end]
            while token not in ranks or (start and not neighbours[last[start - 1], token]):
                start -= 1
                token = data[start:end]
            last.append(token)

    def truncate(self, length: int) -> None:
        self.data = self.data[:length]
        del self.last[length:]

    def encoding(self, length: int | None = None) -> list[int]:
        """Ids of the first ``length`` bytes (all of them by default)."""
        end = len(self.data) if length is None else length
        ids = []
        while end:
            token = self.last[end - 1]
            ids.append(self.vocabulary.ranks[token])
            end -= len(token)
        return ids[::-1]


def _in_common(a: bytes, b: bytes) -> int:
    """How many bytes at the start are the same."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return next(i for i in range(n) if a[i] != b[i])


class EncodedText:
    """A text and its encoding, which stays exact while the text is appended to and edited."""

    def __init__(self, vocabulary: Vocabulary, text: str = "", pattern: str = public_tokenizers.PATTERN):
        self.vocabulary = vocabulary
        self.pattern = regex.compile(pattern)
        self.text = ""
        self.pieces: list[tuple[int, PrefixTable, list[int]]] = []  # start, table, ids
        self.replace(0, 0, text)

    @property
    def ids(self) -> list[int]:
        return [i for _, _, ids in self.pieces for i in ids]

    def append(self, more: str) -> None:
        self.replace(len(self.text), len(self.text), more)

    def replace(self, start: int, end: int, new: str) -> None:
        """Put ``new`` in place of ``text[start:end]``; only pieces near the edit are encoded again."""
        old, shift = self.pieces, len(new) - (end - start)
        self.text = self.text[:start] + new + self.text[end:]
        kept = max(0, sum(1 for _ in takewhile(lambda p: p[0] < start, old)) - UNSETTLED)
        pieces = old[:kept]
        tables = {at: table for at, table, _ in old[kept:] if at < start}
        # A piece that starts where an old one did, behind the edit, is followed by the same text as before.
        behind = {at + shift: i for i, (at, _, _) in enumerate(old) if at >= end}
        for match in self.pattern.finditer(self.text, old[kept][0] if kept < len(old) else len(self.text) - len(new)):
            at = match.start()
            if at in behind and at >= start + len(new):
                pieces += [(p + shift, table, ids) for p, table, ids in old[behind[at] :]]
                break
            data = match.group().encode("utf-8", "surrogatepass")
            table = tables.get(at) or PrefixTable(self.vocabulary)
            table.truncate(_in_common(table.data, data))
            table.append(data[len(table.data) :])
            pieces.append((at, table, table.encoding()))
        self.pieces = pieces


def _remembered() -> dict[str, dict[str, bytes]]:
    """Encodings of pieces by tokenizer, kept as long as the Python worker lives."""
    import sys

    return vars(sys).setdefault("_encoded_pieces", {})


def encoder(ranks: dict[bytes, int], pattern: str = public_tokenizers.PATTERN):
    """A function that encodes a list of texts; ids are 32-bit numbers in native order, as bytes.

    Frequent pieces are encoded once. New pieces are encoded in sorted order with
    one table, which goes on from the prefix that a piece has in common with the last.
    """
    vocabulary, find = Vocabulary(ranks), regex.compile(pattern).findall
    digest = hashlib.sha256(pattern.encode() + b"".join(b"%d %s\n" % (r, t.hex().encode()) for t, r in ranks.items()))
    remembered = _remembered()
    known = remembered.setdefault(digest.hexdigest(), {})

    def learn(pieces: set[str]) -> None:
        table = PrefixTable(vocabulary)
        for data, piece in sorted((piece.encode("utf-8", "surrogatepass"), piece) for piece in pieces):
            if data in ranks:
                ids = [ranks[data]]
            else:
                table.truncate(_in_common(table.data, data))
                table.append(data[len(table.data) :])
                ids = table.encoding()
            known[piece] = array("i", ids).tobytes()

    def encode(texts: list[str]) -> list[bytes]:
        found = [find(text) for text in texts]
        pieces = set().union(*found)
        if len(known) > REMEMBERED:
            # What was known and is met again is what is worth keeping.
            kept = {piece: known[piece] for piece in pieces & known.keys()}
            known.clear()
            known.update(kept)
        learn(pieces - known.keys())
        encoded = [b"".join(map(known.__getitem__, cut)) for cut in found]
        for piece in pieces:
            if len(piece) > REMEMBERED_LENGTH:
                del known[piece]
        return encoded

    return encode


def decoder(ranks: dict[bytes, int]):
    """A function from ids to the bytes that they stand for."""
    tokens = {rank: token for token, rank in ranks.items()}.__getitem__
    return lambda ids: b"".join(map(tokens, ids))


def encode_documents(docs: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``docs`` with their texts as BPE ids and as the bytes decoded from these.

    Returns one row per row of ``docs``: doc_id, ids (array of int) and decoded
    (binary, the text in UTF-8). Whole texts are encoded, each match of
    ``pattern`` separately and without special tokens. A null or empty text has
    no ids and decodes to no bytes; an empty table gives no rows. Other columns
    are ignored. ``path`` is a file of ranks, read by the driver; the vocabulary
    is broadcast.
    """
    short_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(path or public_tokenizers.path(VOCABULARY)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()  # what other tasks of this worker have left
        encode, decode = encoder(shared.value, pattern), decoder(shared.value)
        for batch in batches:
            # Texts differ in length by orders of magnitude: go on in parts of bounded size.
            for part in _parts(batch, PART_BYTES):
                encoded = encode([text or "" for text in part.column("text").to_pylist()])
                ends = np.cumsum([0] + [len(e) // 4 for e in encoded]).astype(np.int32)
                ids = pa.ListArray.from_arrays(ends, np.frombuffer(b"".join(encoded), dtype=np.int32))
                decoded = pa.array([decode(np.frombuffer(e, dtype=np.int32).tolist()) for e in encoded], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), ids, decoded], ["doc_id", "ids", "decoded"])
        release_memory()

    rows = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.dtypes[0][1]}, ids array<int>, decoded binary")


def _parts(batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about ``size`` bytes of text, of one row at least."""
    start, held = 0, 0
    for row, length in enumerate(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist()):
        if held and held + length > size:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += length
    if start < batch.num_rows:
        yield batch.slice(start)


def digests() -> list[Column]:
    """n_tokens, ids_sha256 and decoded_sha256 of encoded documents."""
    return [
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    ]
