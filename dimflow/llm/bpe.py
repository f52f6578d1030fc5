"""Byte-level BPE encoding and decoding by prefix dynamic programming.

For every prefix of a piece of text there is one token that ends it in the
encoding of that prefix. The table of these last tokens is filled from left to
right: a token that ends at byte ``i`` is the one if it may follow the last
token of the prefix before it, that is if merging the bytes of the two gives
just these two tokens again. Reading the table backwards gives the encoding.

The table of a longer text starts with the table of the shorter one, so bytes
can be appended exactly (:meth:`PrefixTable.append`) and an edit re-encodes only
what follows it (:meth:`PrefixTable.replace`).

Texts are cut into pieces by the tokenizer's pattern first; each piece is
encoded by itself. The tokens that end at each byte come from one walk of an
automaton of all tokens over the piece.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from array import array
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimflow.llm.common import bound_batches, ship_package, text_of
from dimflow.llm.hashing import slices

CACHED = 150_000  # pieces in each of the two generations that a task remembers
PAIRS = (1 << 19) - 1  # places for pairs of tokens that it remembers, nine bytes each
CACHED_BYTES = 64  # longer pieces are encoded each time


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to id, from a file of base64 tokens and ranks. Read on the driver, a fixed vocabulary."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Recent:
    """What was found for recent keys: up to ``CACHED`` of the newest and, of the same number before, those still used."""

    def __init__(self):
        self.new, self.old = {}, {}

    def put(self, key, value):
        if len(self.new) >= CACHED:
            self.new, self.old = {}, self.new
        self.new[key] = value
        return value


class Vocabulary:
    """Token tables and the test which two tokens may stand side by side."""

    def __init__(self, ranks: dict[bytes, int], halves: list[tuple[int, int] | None] | None = None):
        self.ranks = ranks
        self.bytes_of = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.lengths = list(map(len, self.bytes_of))
        self.longest = max(self.lengths, default=0)
        self.pairs, self.fits = array("q", [-1 << 62]) * PAIRS, bytearray(PAIRS)  # the last pair of each place
        self._ending = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self._ending.add_word(token.decode("latin-1"), rank)  # a character for each byte
        if ranks:
            self._ending.make_automaton()
        # The two tokens whose merge made each token; none for a single byte.
        self.halves = halves if halves is not None else [
            tuple(self.merge(token, until=2)) if len(token) > 1 else None for token in self.bytes_of]

    def tokens_in(self, data: bytes) -> Iterator[tuple[int, int]]:
        """``(last byte, token)`` of every token found in ``data``, by last byte, longest first."""
        return self._ending.iter(data.decode("latin-1"))

    def merge(self, data: bytes, until: int = 1) -> list[int]:
        """Ids by merging neighbours of the lowest rank first, until ``until`` are left: the definition, for a token."""
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > until:
            rank, at = min((self.ranks.get(parts[i] + parts[i + 1], len(self.bytes_of)), i)
                           for i in range(len(parts) - 1))
            if rank == len(self.bytes_of):
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def beside(self, left: int, right: int) -> bool:
        """May the second token follow the first (-1: may it be the first)?

        It may if merging would never have joined bytes across the border of the
        two. The merges that made them are undone, latest first. Whenever the
        tokens then at the border could merge, they would have done so before the
        merge just undone if theirs has the lower rank (on equal ranks the
        leftmost goes first).
        """
        bytes_of, rank_of, halves = self.bytes_of, self.ranks.get, self.halves
        if left < 0:
            return self.merge(bytes_of[right]) == [right]
        next_merge = len(bytes_of)
        while True:
            if rank_of(bytes_of[left] + bytes_of[right], next_merge) < next_merge:
                return False
            made_left, made_right = halves[left], halves[right]
            if made_left and (left > right or not made_right):
                next_merge, left = left, made_left[1]
            elif made_right:
                next_merge, right = right + 1, made_right[0]
            else:
                return True


class PrefixTable:
    """The last token of every prefix of ``data`` (``last[i]`` ends the first ``i + 1`` bytes)."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", []
        self.append(data)

    def append(self, more: bytes) -> PrefixTable:
        """Extend by ``more``; nothing before it is looked at again but the tokens that end there."""
        vocabulary, last = self.vocabulary, self.last
        lengths, pairs, fits, many = vocabulary.lengths, vocabulary.pairs, vocabulary.fits, len(vocabulary.bytes_of)
        base = max(0, len(self.data) - vocabulary.longest + 1)  # no token that ends in ``more`` starts before
        done = len(self.data)  # prefixes up to here are known
        self.data += more
        for end, token in vocabulary.tokens_in(self.data[base:] if base else self.data):
            end += base
            if end >= done:
                at = end - lengths[token]
                left = last[at] if at >= 0 else -1
                pair = left * many + token
                place = pair % PAIRS
                if pairs[place] != pair:
                    pairs[place], fits[place] = pair, vocabulary.beside(left, token)
                if fits[place]:
                    last.append(token)
                    done += 1
        return self

    def replace(self, at: int, length: int, new: bytes) -> PrefixTable:
        """Exchange ``length`` bytes at ``at`` for ``new``: the table before ``at`` stays, the rest is filled again."""
        after = new + self.data[at + length:]
        self.data = self.data[:at]
        del self.last[at:]
        return self.append(after)

    def ids(self) -> list[int]:
        out, at, last, lengths = [], len(self.data) - 1, self.last, self.vocabulary.lengths
        while at >= 0:
            token = last[at]
            out.append(token)
            at -= lengths[token]
        out.reverse()
        return out


class Encoder:
    """Encodes texts piece by piece, and decodes ids; remembers pieces seen before."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, halves: list | None = None):
        self.vocabulary = Vocabulary(ranks, halves)
        self.pieces = regex.compile(pattern).findall
        self._known = Recent()

    def _packed(self, piece: str) -> bytes:
        known = self._known
        packed = known.old.get(piece)
        if packed is None:
            ids = PrefixTable(self.vocabulary, piece.encode()).ids()
            packed = struct.pack(f"<{len(ids)}I", *ids)
        return known.put(piece, packed) if len(piece) <= CACHED_BYTES else packed

    def encode(self, text: str) -> bytes:
        """The ids of ``text`` as little-endian unsigned 32-bit integers."""
        out, known, packed = [], self._known, self._packed
        for piece in self.pieces(text):
            out.append(known.new.get(piece) or packed(piece))
        return b"".join(out)

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.vocabulary.bytes_of.__getitem__, memoryview(packed).cast("I")))


KINDS = {"n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string(), "ids": pa.binary()}


def encoded(encoder: Encoder, batch: pa.RecordBatch, names: list[str]) -> Iterator[pa.RecordBatch]:
    """``id`` and ``names`` (of ``KINDS``) of a batch ``id, text``, part by part: its results are never held together."""
    for part in slices(batch, 1):
        found: dict[str, list] = {name: [] for name in KINDS}
        for text in part.column(1):
            packed = encoder.encode(text.as_py())
            found["n_tokens"].append(len(packed) // 4)
            found["ids_sha256"].append(hashlib.sha256(packed).hexdigest())
            found["decoded_sha256"].append(hashlib.sha256(encoder.decode(packed)).hexdigest())
            if "ids" in names:
                found["ids"].append(packed)
        yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array(found[n], KINDS[n]) for n in names]],
                                         names=["id", *names])


def encode(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           with_ids: bool = False) -> DataFrame:
    """One row per row of ``docs``: ``id, n_tokens, ids_sha256, decoded_sha256`` and, on request, ``ids``
    (little-endian unsigned 32-bit integers).

    The decoded bytes come from the ids alone. A null text is the empty text,
    with no tokens; repeated rows and null ids keep their rows. The vocabulary
    file is read on the driver and broadcast, its size is fixed.
    """
    spark: SparkSession = docs.sparkSession
    ship_package(spark)
    bound_batches(spark)
    ranks = read_ranks(vocabulary)
    shared = spark.sparkContext.broadcast((ranks, Vocabulary(ranks).halves))
    names = ["n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, halves = shared.value
        encoder = Encoder(ranks, pattern, halves)  # for this task only
        for batch in batches:
            yield from encoded(encoder, batch, names)

    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    sql_kinds = ["long", "string", "string"] + ["binary"] * with_ids
    schema = ", ".join([f"id {rows.schema['id'].dataType.simpleString()}"]
                       + [f"{n} {k}" for n, k in zip(names, sql_kinds)])
    return rows.mapInArrow(run, schema)
