"""Token counts of documents in flat, unindexed token files.

A flat file is nothing but ids, one document after another, each ended by the end-of-document id. The
file is cut into blocks of bounded size, and a task finds the separators of a block in one vectorised
comparison. Documents cross block boundaries, so blocks are stitched by a prefix scan: how many
separators came before, and where the last of them was.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.common import Workspace
from tidemill.llm.token_files import _chunk_end, _filesystem, _tokenizer

BLOCK_BYTES = 4 << 20
TASK_BYTES = 16 << 20


def write_flat_files(
    docs: DataFrame,
    tokenizer_file: str,
    separator: int,
    work: Workspace,
    id_column: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Encode whole texts into flat files, one for each task, in the order of the rows.

    Returns which documents went where: path, bytes (of the file), place (in the file), doc_id. The
    files themselves know nothing of that. A null or empty text is a separator alone. A repeated task
    writes under a new name, and only the files of tasks that succeeded are returned.
    """
    with open(tokenizer_file, encoding="utf-8") as file:
        content = docs.sparkSession.sparkContext.broadcast(file.read())  # its size is fixed
    folder = work.path("flat-files")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _tokenizer(content.value, separator, specials=False)  # no text may hold a separator
        filesystem, root = _filesystem(folder)
        name, sink, size, ids = f"{uuid.uuid4().hex}.tokens", None, 0, []
        for batch in batches:
            texts = batch.column(1).cast(pa.large_string()).fill_null("")
            ids.append(batch.column(0))
            start = 0
            while start < len(texts):
                if sink is None:
                    filesystem.create_dir(root, recursive=True)
                    sink = filesystem.open_output_stream(f"{root}/{name}")
                stop = _chunk_end(texts, start)
                tokens, _ = coder.encode(texts.slice(start, stop - start))
                sink.write(tokens.tobytes())
                size += tokens.nbytes
                start = stop
        if sink is not None:
            sink.close()
            place = 0
            for column in ids:
                n = len(column)
                columns = {
                    "path": pa.array([f"{folder}/{name}"] * n),
                    "bytes": pa.array(np.full(n, size)),
                    "place": pa.array(np.arange(place, place + n)),
                    "doc_id": column,
                }
                place += n
                yield pa.RecordBatch.from_pydict(columns)

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = "path string, bytes long, place long, doc_id long"
    return work.keep(rows.mapInArrow(run, schema), "flat-documents")


def find_separators(files: DataFrame, separator: int, dtype: str, work: Workspace) -> DataFrame:
    """For each block of the files (path, bytes): its tokens and where in the file its separators
    are."""
    width = np.dtype(dtype).itemsize
    total = files.agg(F.sum("bytes")).first()[0] or 0
    begins = F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(BLOCK_BYTES).cast("long"))
    blocks = files.where("bytes > 0").select("path", "bytes", F.explode(begins).alias("begin"))
    blocks = blocks.repartition(max(1, total // TASK_BYTES), "path", "begin")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                if row["bytes"] % width:
                    raise ValueError(f"{row['path']} ends within a token")
                folder, _, name = row["path"].rpartition("/")
                filesystem, root = _filesystem(folder)
                with filesystem.open_input_file(f"{root}/{name}") as file:
                    size = min(BLOCK_BYTES, row["bytes"] - row["begin"])
                    ids = np.frombuffer(file.read_at(size, row["begin"]), dtype)
                found = np.flatnonzero(ids == separator) + row["begin"] // width
                columns = {
                    "path": [row["path"]],
                    "block": [row["begin"] // BLOCK_BYTES],
                    "tokens": [len(ids)],
                    "found": [found],
                }
                yield pa.RecordBatch.from_pydict(columns)

    schema = "path string, block long, tokens long, found array<long>"
    return work.keep(blocks.mapInArrow(run, schema), "separators")


def count_tokens(files: DataFrame, separator: int, dtype: str, work: Workspace) -> DataFrame:
    """Every document in flat token files: path, place (in the file), start, n_tokens, closed.

    ``files`` has path and bytes. The separator itself is not counted. Defined cases: tokens after
    the last separator are a document that is not closed; an empty file has no documents, and two
    separators in a row have an empty one between them; a file whose size is not a whole number of
    tokens is an error; an empty table of files gives an empty result; a path named twice counts
    twice as long as its rows differ in nothing, so name each once; other columns are ignored.
    """
    blocks = find_separators(files.select("path", "bytes").distinct(), separator, dtype, work)
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    last = F.array_max("found").alias("last")
    scan = blocks.select("path", "block", F.size("found").alias("n"), last).select(
        "path",
        "block",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("places"),
        F.coalesce(F.max("last").over(before) + 1, F.lit(0)).alias("open_since"),
    )
    each = blocks.join(scan, ["path", "block"]).select(
        "path", "places", "open_since", "found", F.posexplode("found").alias("i", "end")
    )
    start = F.coalesce(F.get("found", F.col("i") - 1) + 1, F.col("open_since"))
    closed = each.select(
        "path",
        (F.col("places") + F.col("i")).alias("place"),
        start.alias("start"),
        (F.col("end") - start).alias("n_tokens"),
        F.lit(True).alias("closed"),
    )
    whole = blocks.groupBy("path").agg(
        F.sum("tokens").alias("tokens"),
        F.sum(F.size("found")).alias("place"),
        F.coalesce(F.max(F.array_max("found")) + 1, F.lit(0)).alias("start"),
    )
    rest = whole.where("tokens > start").select(
        "path",
        "place",
        "start",
        (F.col("tokens") - F.col("start")).alias("n_tokens"),
        F.lit(False).alias("closed"),
    )
    return closed.unionByName(rest)
