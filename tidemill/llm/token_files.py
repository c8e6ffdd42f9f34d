"""Token ids of a corpus as Arrow IPC files of equal-length sequences.

Documents are dealt into ranges of ascending id, and each range becomes a pair of files: the
sequences (``ids`` and ``mask``, both fixed-size lists, in record batches of a fixed row count) and
the documents (``doc_id``, ``start`` within the file, ``n_tokens``). The ids of a range follow each
other without gaps; only its last sequence is padded, and the mask is false there. As every batch but
the last has the same number of rows and every row the same length, sequence ``i`` is found by
division and is a view into the mapped file, without a copy.

A task writes under a name of its own and reports it; the manifest lists the names of tasks that
succeeded, so a repeated or lost task leaves at most files that nobody reads.
"""

from __future__ import annotations

import os
import re
import unicodedata
import uuid
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import pyarrow.ipc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemill.llm.common import Workspace

# A task uses one core; the tokenizers library would start a thread for every core.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

SEQUENCE = 2048
BATCH_ROWS = 64
# Bytes of text encoded at once, as far as whole texts allow.
CHUNK_BYTES = 8_000_000
# Words kept per Python worker before the table of known words starts anew.
KNOWN_WORDS = 400_000
# New words that go through the tokenizer as one text.
JOINED_WORDS = 256

MANIFEST = "part int, folder string, file string, documents long, tokens long"

# Texts without these are lower-cased here as the tokenizer would and split at any white space: no
# control or combining characters, no final sigma, no dotted capital I, no later scripts, and nothing
# that may be a special token, whose strings are found before letters are made small.
_COMPLEX = (
    "[\x00-\x08\x0e-\x1f\u0130\u0300-\u036f\u03a3\u0483-\u0489\u0590-\U0010ffff]|<\\|"
)
_ASCII_SPACE = re.compile("[ \t\n\r\f\v]+")


# --- tokens --------------------------------------------------------------------------------------


def all_letters(word: str) -> bool:
    """Whether a word is letters only, also once composed and lower-cased: some letters become one
    and a mark, which a following sign joins."""
    return word.isalpha() and (
        word.isascii() or unicodedata.normalize("NFC", word).lower().isalpha()
    )


class WordTokenizer:
    """A tokenizers file whose pre-tokenizer drops white space: words between white space do not
    touch each other, so each different word is encoded once and looked up from then on."""

    def __init__(self, content: str, end_id: int, specials: bool = True):
        self.tokenizer = Tokenizer.from_str(content)
        # Whether the strings of special tokens in a text stand for these, or are ordinary text.
        self.tokenizer.encode_special_tokens = not specials
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        size = max(*vocabulary.values(), end_id) + 1
        self.dtype = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")
        self.end_id = end_id
        # Every run of letters ends in a token with the end-of-word mark.
        mark = self.tokenizer.model.end_of_word_suffix
        self.ends_word = np.zeros(size, bool)
        if mark:
            self.ends_word[[n for token, n in vocabulary.items() if token.endswith(mark)]] = True
        self.known: dict[str, bytes] = {}

    def _pack(self, ids: list[int]) -> bytes:
        return np.array(ids, self.dtype).tobytes()

    def _learn(self, words: list[str]) -> None:
        """Encode words not met before. Words of letters only are one run each, so many of them can
        be encoded as one text and told apart by the mark."""
        # A sign after letters is a token of its own, so such a word is made of two shorter ones.
        ended = [w for w in words if w[-1] in ".," and all_letters(w[:-1])]
        stems = {w[:-1] for w in ended} | {w[-1] for w in ended}
        plain = [w for w in words if all_letters(w)]
        plain += [w for w in stems - self.known.keys() - set(plain) if all_letters(w)]
        chunks = [plain[i : i + JOINED_WORDS] for i in range(0, len(plain), JOINED_WORDS)]
        encoded = self.tokenizer.encode_batch_fast(list(map(" ".join, chunks)), False, False)
        size = self.dtype.itemsize
        for chunk, result in zip(chunks, encoded):
            ids = np.array(result.ids, self.dtype)
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) == len(chunk):  # else a word has other characters once normalised
                packed, stops = ids.tobytes(), (ends * size).tolist()
                cuts = map(slice, [0, *stops], stops)
                self.known.update(zip(chunk, map(packed.__getitem__, cuts)))
        later = [w for w in {*words, *stems}.difference(ended) if w not in self.known]
        encoded = self.tokenizer.encode_batch_fast(later, False, False)
        self.known.update((w, self._pack(e.ids)) for w, e in zip(later, encoded))
        self.known.update((w, self.known[w[:-1]] + self.known[w[-1]]) for w in ended)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, each with the end id last, and how many each has."""
        complex_ = pc.match_substring_regex(texts, _COMPLEX).to_numpy(zero_copy_only=False)
        simple = pc.if_else(pa.array(complex_), "", texts)
        split = pc.utf8_split_whitespace(pc.utf8_lower(simple))
        words, counts = split.flatten(), np.diff(split.offsets.to_numpy())
        if complex_.any():  # these are split at ASCII white space, letters as they are
            own = [_ASCII_SPACE.split(t) for t in texts.filter(pa.array(complex_)).to_pylist()]
            lists = np.split(np.arange(len(words)), np.cumsum(counts)[:-1])
            extra = pa.array([w for ws in own for w in ws], pa.large_string())
            ends = len(words) + np.cumsum([len(ws) for ws in own])
            for row, begin, end in zip(np.flatnonzero(complex_), [len(words), *ends], ends):
                lists[row] = np.arange(begin, end)
            counts = np.array(list(map(len, lists)))
            words = pa.concat_arrays([words, extra]).take(pa.array(np.concatenate(lists)))
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.known) > KNOWN_WORDS:
            self.known.clear()
        self._learn([w for w in distinct if w and w not in self.known])
        self.known[""] = b""
        packed = [*map(self.known.__getitem__, distinct), self._pack([self.end_id])]
        sizes = np.fromiter(map(len, packed), np.int32, len(packed)) // self.dtype.itemsize
        pool = np.frombuffer(b"".join(packed), self.dtype)
        stops = np.cumsum(counts)
        codes = np.insert(coded.indices.to_numpy(), stops, len(distinct))
        lengths = sizes[codes]
        ends = np.cumsum(lengths)
        # Where each id is in the pool: its word's place there, counted on from the word's first id.
        shift = (np.cumsum(sizes) - sizes)[codes] - (ends - lengths)
        places = np.repeat(shift.astype(np.int32), lengths)
        places += np.arange(len(places), dtype=np.int32)
        return pool.take(places), np.diff(ends[stops + np.arange(len(stops))], prepend=0)


_ready: dict[tuple[int, int, bool], WordTokenizer] = {}


def _tokenizer(content: str, end_id: int, specials: bool = True) -> WordTokenizer:
    key = hash(content), end_id, specials
    if key not in _ready:
        _ready.clear()
        _ready[key] = WordTokenizer(content, end_id, specials)
    return _ready[key]


# --- files ---------------------------------------------------------------------------------------


def _filesystem(folder: str) -> tuple[pa.fs.FileSystem, str]:
    folder = re.sub("^s3[an]:", "s3:", folder)
    if not urlparse(folder).scheme:
        return pa.fs.LocalFileSystem(), folder
    return pa.fs.FileSystem.from_uri(folder)


class _Writer:
    def __init__(self, folder: str, name: str, dtype: np.dtype, sequence: int):
        filesystem, root = _filesystem(folder)
        filesystem.create_dir(root, recursive=True)
        self.sequence, self.dtype = sequence, dtype
        self.schema = pa.schema(
            [
                ("ids", pa.list_(pa.from_numpy_dtype(dtype), sequence)),
                ("mask", pa.list_(pa.bool_(), sequence)),
            ]
        )
        self.documents = pa.schema(
            [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())]
        )
        self.sinks = [
            filesystem.open_output_stream(f"{root}/{name}.{kind}.arrow")
            for kind in ("sequences", "documents")
        ]
        self.files = [
            pa.ipc.new_file(sink, schema)
            for sink, schema in zip(self.sinks, (self.schema, self.documents))
        ]
        self.rest, self.tokens, self.rows = np.zeros(0, dtype), 0, 0

    def add(self, doc_ids: pa.Array, ids: np.ndarray, sizes: np.ndarray) -> None:
        starts = self.tokens + np.cumsum(sizes) - sizes
        self.tokens += int(sizes.sum())
        self.rows += len(sizes)
        columns = [doc_ids, pa.array(starts), pa.array(sizes)]
        self.files[1].write_batch(pa.RecordBatch.from_arrays(columns, schema=self.documents))
        ids = np.concatenate([self.rest, ids])
        step = self.sequence * BATCH_ROWS
        whole = len(ids) // step * step
        for begin in range(0, whole, step):
            self._write(ids[begin : begin + step], step)
        self.rest = ids[whole:].copy()

    def _write(self, ids: np.ndarray, real: int) -> None:
        mask = pa.array(np.arange(len(ids)) < real)
        columns = [
            pa.FixedSizeListArray.from_arrays(values, self.sequence)
            for values in (pa.array(ids), mask)
        ]
        self.files[0].write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))

    def close(self) -> None:
        ids = self.rest
        if len(ids):
            room = -(-len(ids) // self.sequence) * self.sequence
            self._write(np.pad(ids, (0, room - len(ids))), len(ids))
        for file in (*self.files, *self.sinks):
            file.close()


class TokenFile:
    """One file pair, opened for random access."""

    def __init__(self, folder: str, name: str):
        filesystem, root = _filesystem(folder)
        paths = [f"{root}/{name}.{kind}.arrow" for kind in ("sequences", "documents")]
        if isinstance(filesystem, pa.fs.LocalFileSystem):
            sources = list(map(pa.memory_map, paths))
        else:
            sources = list(map(filesystem.open_input_file, paths))
        self.sequences, self.documents = map(pa.ipc.open_file, sources)
        self.length = self.sequences.schema.field("ids").type.list_size
        self.rows = BATCH_ROWS

    def sequence(self, i: int) -> tuple[np.ndarray, pa.Array]:
        """Ids and mask of sequence ``i``; the ids are a view, not a copy."""
        batch = self.sequences.get_batch(i // self.rows)
        row = slice(i % self.rows * self.length, (i % self.rows + 1) * self.length)
        ids = batch.column("ids").flatten().to_numpy()
        return ids[row], batch.column("mask").flatten()[row]

    def span(self, begin: int, end: int) -> np.ndarray:
        """Ids from position ``begin`` up to ``end`` of the file."""
        step = self.length * self.rows
        parts = []
        for k in range(begin // step, -(-end // step)):
            batch = self.sequences.get_batch(k)
            real = batch.column("mask").flatten()
            ids = batch.column("ids").flatten().to_numpy()
            low, high = max(0, begin - k * step), min(step, end - k * step)
            if high > len(ids) or not real[high - 1].as_py():
                raise ValueError(f"position {k * step + high} is past the last token")
            parts.append(ids[low:high])
        return parts[0] if len(parts) == 1 else np.concatenate(parts or [np.zeros(0, np.uint16)])


# --- jobs ----------------------------------------------------------------------------------------


def write_token_files(
    docs: DataFrame,
    tokenizer_file: str,
    work: Workspace,
    id_column: str = "doc_id",
    text: str = "text",
    end_id: int = 1,
    sequence: int = SEQUENCE,
) -> DataFrame:
    """Encode every whole text, append ``end_id``, and write the ids in ascending id order.

    Returns the manifest: one row per file pair with its place in the order, its documents and its
    tokens.

    Defined cases: a null or empty text has the end id only; rows with a null id come first; rows
    that share an id are ordered by a hash of their text, and equal rows are all written. Nothing is
    written for an empty table. Other columns are ignored. The strings of special tokens in a text
    become these tokens, as the tokenizers library has it.
    """
    with open(tokenizer_file, encoding="utf-8") as file:
        content = docs.sparkSession.sparkContext.broadcast(file.read())  # its size is fixed
    folder = work.path("token-files")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _tokenizer(content.value, end_id)
        part, writer = TaskContext.get().partitionId(), None
        for batch in batches:
            texts = batch.column(1).cast(pa.large_string()).fill_null("")
            start = 0
            while start < len(texts):
                stop = _chunk_end(texts, start)
                writer = writer or _Writer(folder, name := _name(part), coder.dtype, sequence)
                ids = batch.column(0).slice(start, stop - start)
                writer.add(ids, *coder.encode(texts.slice(start, stop - start)))
                start = stop
        if writer:
            writer.close()
            row = [[part], [folder], [name], [writer.rows], [writer.tokens]]
            columns = ["part", "folder", "file", "documents", "tokens"]
            types = [pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, row, types)), columns)

    ranged = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))
    order = ("doc_id", F.xxhash64("text"))
    ranged = ranged.repartitionByRange(*order).sortWithinPartitions(*order)
    return work.keep(ranged.mapInArrow(run, MANIFEST), "manifest")


def _name(part: int) -> str:
    return f"part-{part:06d}-{uuid.uuid4().hex}"


def _chunk_end(texts: pa.Array, start: int) -> int:
    """Where the rows from ``start`` reach CHUNK_BYTES; one row at least."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)
    offsets = offsets[texts.offset + start : texts.offset + len(texts) + 1]
    return start + max(1, int(np.searchsorted(offsets - offsets[0], CHUNK_BYTES, "right")) - 1)


def read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What ``read_token_files`` does inside a task, for rows of folder, file and offset."""
    for batch in batches:
        for file in batch.to_pylist():
            token_file = TokenFile(file["folder"], file["file"])
            for k in range(token_file.documents.num_record_batches):
                found = token_file.documents.get_batch(k)
                starts, sizes = (found.column(c).to_numpy() for c in ("start", "n_tokens"))
                ends = np.append(starts, starts[-1] + sizes[-1])
                ids = token_file.span(int(ends[0]), int(ends[-1])).astype(np.int32)
                columns = {
                    "doc_id": found.column("doc_id"),
                    "start": pa.array(starts + file["offset"]),
                    "n_tokens": found.column("n_tokens"),
                    "ids": pa.ListArray.from_arrays(pa.array(ends - ends[0], pa.int32()), ids),
                }
                yield pa.RecordBatch.from_pydict(columns)


def files_in_order(manifest: DataFrame) -> DataFrame:
    """Folder, file and offset (tokens in all files before it) of the files, a task for each."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.withColumn("offset", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
    files = files.repartitionByRange(max(1, manifest.count()), "part")
    return files.select("folder", "file", "offset")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """doc_id, start (position in the whole corpus), n_tokens and ids of every document."""
    schema = "doc_id long, start long, n_tokens long, ids array<int>"
    return files_in_order(manifest).mapInArrow(read_batches, schema)
