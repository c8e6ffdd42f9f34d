"""Byte-level BPE encoding and decoding with a public rank file.

Texts are cut into words at single spaces, which the split pattern never crosses, and into pattern
matches only for words not met before. New matches are encoded together: by length they go into
padded numpy matrices, where in each round every row merges its leftmost pair of minimum rank. Pair
ranks come from a hashed table; rows without a pair that can merge leave the matrix, and every other
row gets one column shorter.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, IntegerType, StructType

NEVER = np.int32(2**31 - 1)
# Matches longer than this are merged with a priority queue: matrix rounds cost the square of length.
LONG_MATCH = 256
# Words kept per Python worker before the table of known words starts anew.
KNOWN_WORDS = 400_000
# Rows of one matrix.
BUCKET_ROWS = 16384
# Characters whose words are in memory at once, as far as whole texts allow.
CHUNK_CHARS = 2_000_000

# Letters and numbers, as first and last code point, that Unicode has had for a shorter time
# than tiktoken's tables are old. There they are neither, so matches end before them.
YOUNG = (
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F),
    (0x209D, 0x209F), (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD),
    (0xA7E2, 0xA7E2), (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D), (0x107BB, 0x107BF), (0x10940, 0x10959),
    (0x10EC5, 0x10EC7), (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A), (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9),
    (0x11DF1, 0x11DF1), (0x1246F, 0x1246F), (0x12475, 0x1247F), (0x12550, 0x12686), (0x16EA0, 0x16EB8),
    (0x16EBB, 0x16ED3), (0x16FF2, 0x16FF6), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20), (0x18D80, 0x18DF2),
    (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168), (0x1D6A6, 0x1D6A6),
    (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE),
    (0x1E6E0, 0x1E6E2), (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF),
    (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479),
)
NO_CHARACTER = "\uffff"

_YOUNG = re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in YOUNG) + "]")
_SPACES = re.compile(r"\s\s")
_SINGLE_SPACE = re.compile(r"(?<=\S) (?=\S)")


class PairTable:
    """Ranks of token pairs, in an open-addressing hash table of numpy arrays."""

    def __init__(self, pairs: dict[int, int]):
        self.bits = max(4, (4 * len(pairs)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, NEVER, np.int32)
        keys = np.fromiter(pairs.keys(), np.int64, len(pairs))
        values = np.fromiter(pairs.values(), np.int32, len(pairs))
        slots = self._slots(keys)
        while len(keys):
            free = self.keys[slots] == -1
            self.keys[slots[free]] = keys[free]  # of several for one slot the last stays
            placed = self.keys[slots] == keys
            self.values[slots[placed]] = values[placed]
            keys, values = keys[~placed], values[~placed]
            slots = (slots[~placed] + 1) & (len(self.keys) - 1)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of every pair; NEVER where the pair does not merge or one side is padding (-1)."""
        keys = (left.astype(np.int64) << 32) | right.astype(np.int64)
        out = np.full(keys.shape, NEVER, np.int32)
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        slots = self._slots(keys[todo])
        while len(todo):
            there = self.keys[slots]
            hit = there == keys[todo]
            out[todo[hit]] = self.values[slots[hit]]
            more = ~hit & (there != -1)
            todo, slots = todo[more], (slots[more] + 1) & (len(self.keys) - 1)
        return out


class ByteBpe:
    def __init__(self, rank_file: bytes, pattern: str):
        lines = (line.split() for line in rank_file.splitlines())
        self.ranks = {base64.b64decode(part[0]): int(part[1]) for part in lines if part}
        self.whole = {piece: rank.to_bytes(4, "little") for piece, rank in self.ranks.items()}
        self.pieces = {rank: piece for piece, rank in self.ranks.items()}
        self.pattern = regex.compile(pattern)
        self.byte_ranks = np.full(256, -1, np.int32)
        pairs = {}
        for piece, rank in self.ranks.items():
            if len(piece) == 1:
                self.byte_ranks[piece[0]] = rank
            for cut in range(1, len(piece)):
                left, right = self.ranks.get(piece[:cut]), self.ranks.get(piece[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.pairs = pairs
        self.table = PairTable(pairs)
        self.first: dict[str, bytes] = {}  # ids of words at the start of a text
        self.later: dict[str, bytes] = {}  # ids of words after a space, the space included

    # --- matches -------------------------------------------------------------------------------

    def encode_matches(self, matches: list[bytes]) -> list[bytes]:
        """Ids of each match, as packed little-endian unsigned 32-bit integers."""
        out = list(map(self.whole.get, matches))
        sizes = np.fromiter(map(len, matches), np.int64, len(matches))
        todo = np.fromiter((x is None for x in out), bool, len(out))
        for i in np.flatnonzero(todo & (sizes > LONG_MATCH)).tolist():
            out[i] = self._merge_long(matches[i])
        rows = np.flatnonzero(todo & (sizes <= LONG_MATCH))
        rows = rows[np.argsort(sizes[rows], kind="stable")]
        for length in range(2, LONG_MATCH.bit_length() + 1):
            low, high = np.searchsorted(sizes[rows], (1 << length - 1, 1 << length))
            for start in range(low, high, BUCKET_ROWS):
                bucket = rows[start : min(high, start + BUCKET_ROWS)]
                self._merge_bucket(bucket, sizes[bucket], matches, out)
        return out

    def _merge_bucket(
        self, bucket: np.ndarray, sizes: np.ndarray, matches: list[bytes], out: list[bytes]
    ) -> None:
        width = int(sizes.max())
        ids = np.full((len(bucket), width), -1, np.int32)
        data = np.frombuffer(b"".join(map(matches.__getitem__, bucket.tolist())), np.uint8)
        ids[np.arange(width) < sizes[:, None]] = self.byte_ranks[data]
        ranks = self.table.ranks(ids[:, :-1].ravel(), ids[:, 1:].ravel())
        ranks = ranks.reshape(len(bucket), width - 1)
        while len(bucket):
            lines = np.arange(len(bucket))
            if ranks.shape[1]:
                at = ranks.argmin(axis=1)
                least = ranks[lines, at]
            else:
                at, least = np.zeros_like(lines), np.full(len(lines), NEVER)
            done = least == NEVER
            if done.any():
                ended = ids[done]
                real = ended >= 0
                ends = np.cumsum(real.sum(axis=1)) * 4
                packed = ended[real].astype("<u4").tobytes()
                begin = 0
                for row, end in zip(bucket[done].tolist(), ends.tolist()):
                    out[row] = packed[begin:end]
                    begin = end
                going = ~done
                bucket, ids, ranks = bucket[going], ids[going], ranks[going]
                at, least, lines = at[going], least[going], lines[: len(bucket)]
                if not len(bucket):
                    return
            width = ids.shape[1]
            columns = np.arange(width)
            ids[lines, at] = least
            ids = ids[columns != at[:, None] + 1].reshape(-1, width - 1)
            ranks = ranks[columns[:-1] != at[:, None]].reshape(-1, width - 2)
            for shift in (-1, 0):  # the two pairs that the merged token is part of
                near = at + shift
                inside = (near >= 0) & (near < width - 2)
                line, column = lines[inside], near[inside]
                ranks[line, column] = self.table.ranks(ids[line, column], ids[line, column + 1])

    def _merge_long(self, match: bytes) -> bytes:
        """The same merges, lowest rank and then leftmost first, in n log n."""
        ids = self.byte_ranks[np.frombuffer(match, np.uint8)].tolist()
        after = list(range(1, len(ids) + 1))
        before = list(range(-1, len(ids) - 1))
        heap = []

        def offer(i: int) -> None:
            j = after[i]
            if j < len(ids):
                rank = self.pairs.get(ids[i] << 32 | ids[j])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, ids[i], ids[j]))

        for i in range(len(ids) - 1):
            offer(i)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j >= len(ids) or ids[j] != right:
                continue
            ids[i], ids[j], after[i] = rank, -1, after[j]
            if after[i] < len(ids):
                before[after[i]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return np.array([t for t in ids if t >= 0], "<u4").tobytes()

    # --- texts ---------------------------------------------------------------------------------

    def matches(self, text: str) -> list[str]:
        """Matches of the pattern; young letters and numbers are split like what is no character."""
        if text.isascii() or not _YOUNG.search(text):
            return self.pattern.findall(text)
        spans = (m.span() for m in self.pattern.finditer(_YOUNG.sub(NO_CHARACTER, text)))
        return [text[a:b] for a, b in spans]

    def learn(self, known: dict[str, bytes], space: str, new: set[str]) -> None:
        """Encode words not met before. A word of letters only is one match of the pattern."""
        plain = [w for w in new if w.isalpha() and (w.isascii() or not _YOUNG.search(w))]
        rest = list(new.difference(plain))
        split = [[m.encode() for m in self.matches(space + w)] for w in rest]
        parts = list({m for matches in split for m in matches})
        ids = self.encode_matches([(space + w).encode() for w in plain] + parts)
        known.update(zip(plain, ids))
        of = dict(zip(parts, ids[len(plain) :]))
        known.update((w, b"".join(map(of.__getitem__, ms))) for w, ms in zip(rest, split))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of every text."""
        # A single space between other characters always starts a new match, so texts may be cut
        # there; without white space in a row, every space is of that kind.
        cut = [t.split(" ") if not _SPACES.search(t) else _SINGLE_SPACE.split(t) for t in texts]
        later: set[str] = set()
        for parts in cut:
            later.update(parts[1:])
        if len(self.first) + len(self.later) > KNOWN_WORDS:
            self.first.clear()
            self.later.clear()
        self.learn(self.first, "", {parts[0] for parts in cut} - self.first.keys())
        self.learn(self.later, " ", later - self.later.keys())
        first, known = self.first, self.later
        out = []
        for parts in cut:
            head = first[parts[0]]
            out.append(head + b"".join(map(known.__getitem__, parts[1:])))
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids.tolist()))


_ready: dict[int, ByteBpe] = {}


class Vocabulary:
    """A rank file (its size is fixed) and a pattern; tasks build their tables once per worker."""

    def __init__(self, spark, path: str, pattern: str):
        with open(path, "rb") as file:
            self.shared = spark.sparkContext.broadcast((file.read(), pattern))

    def coder(self) -> ByteBpe:
        content, pattern = self.shared.value
        key = hash((content, pattern))
        if key not in _ready:
            _ready.clear()
            _ready[key] = ByteBpe(content, pattern)
        return _ready[key]


def _integer_lists(packed: list[bytes]) -> pa.Array:
    offsets = np.zeros(len(packed) + 1, np.int32)
    np.cumsum([len(p) // 4 for p in packed], out=offsets[1:])
    return pa.ListArray.from_arrays(offsets, np.frombuffer(b"".join(packed), "<i4"))


def _with_column(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    names = [n for n in batch.schema.names if n != name]
    arrays = [batch.column(batch.schema.names.index(n)) for n in names]
    return pa.RecordBatch.from_arrays([*arrays, values], [*names, name])


def encode_batches(
    batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary, text: str, ids: str
) -> Iterator[pa.RecordBatch]:
    """What ``encode`` does inside a task; output batches hold about CHUNK_CHARS of text."""
    coder = vocabulary.coder()
    for batch in batches:
        texts = batch.column(batch.schema.names.index(text))
        texts = texts.cast(pa.large_string()).fill_null("")
        start = 0
        while start < len(texts):
            offsets = np.frombuffer(texts.buffers()[1], np.int64)
            offsets = offsets[texts.offset + start : texts.offset + len(texts) + 1]
            fit = int(np.searchsorted(offsets - offsets[0], CHUNK_CHARS, "right")) - 1
            part = slice(start, start + max(1, fit))
            values = coder.encode(texts[part].to_pylist())
            yield _with_column(batch[part], ids, _integer_lists(values))
            start = part.stop


def decode_batches(
    batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary, ids: str, decoded: str
) -> Iterator[pa.RecordBatch]:
    """What ``decode`` does inside a task."""
    coder = vocabulary.coder()
    for batch in batches:
        rows = (x.values for x in batch.column(batch.schema.names.index(ids)))
        texts = [b"" if x is None else coder.decode(x.to_numpy()) for x in rows]
        yield _with_column(batch, decoded, pa.array(texts, pa.binary()))


def encode(
    docs: DataFrame, vocabulary: Vocabulary, text: str = "text", ids: str = "ids"
) -> DataFrame:
    """``docs`` with the token ids of the whole text as an array of integers in column ``ids``.

    No special tokens are recognised. A null or empty text has no tokens; a column that already has
    the name ``ids`` is replaced; other columns, their nulls and repeated rows stay as they are.
    """
    kept = [docs.schema[c] for c in docs.columns if c != ids]
    schema = StructType([*kept]).add(ids, ArrayType(IntegerType()))
    return docs.mapInArrow(lambda b: encode_batches(b, vocabulary, text, ids), schema)


def decode(
    docs: DataFrame, vocabulary: Vocabulary, ids: str = "ids", decoded: str = "decoded"
) -> DataFrame:
    """``docs`` with the bytes that the ids stand for in column ``decoded``; null ids give no bytes.

    An id outside the vocabulary is an error. Bytes, not text: ids need not form whole characters.
    """
    kept = [docs.schema[c] for c in docs.columns if c != decoded]
    schema = StructType([*kept]).add(decoded, BinaryType())
    return docs.mapInArrow(lambda b: decode_batches(b, vocabulary, ids, decoded), schema)


def round_trip(
    docs: DataFrame, vocabulary: Vocabulary, text: str = "text", ids: str = "ids"
) -> DataFrame:
    """``docs`` with ``ids`` and ``intact``: whether decoding the ids gives the text's bytes."""
    kept = [docs.schema[c] for c in docs.columns if c not in (ids, "intact")]
    schema = StructType([*kept]).add(ids, ArrayType(IntegerType())).add("intact", BooleanType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoded = encode_batches(batches, vocabulary, text, ids)
        for batch in decode_batches(encoded, vocabulary, ids, "_decoded"):
            names = batch.schema.names
            texts = batch.column(names.index(text)).cast(pa.binary()).fill_null(b"")
            intact = pc.equal(texts, batch.column(names.index("_decoded")))
            columns = [batch.column(names.index(f.name)) for f in schema[:-1]]
            yield pa.RecordBatch.from_arrays([*columns, intact], [f.name for f in schema])

    return docs.mapInArrow(run, schema)
