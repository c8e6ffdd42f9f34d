"""Language identification by a byte convolutional network, written in numpy.

Filters of several widths slide over the bytes of a fixed-length window; each filter's largest
response goes through a rectifier into a softmax over the languages. A byte is one of 256 symbols, so
a filter is a table of weights per offset and byte value, and a convolution is a sum of table rows.
For prediction the tables of two neighbouring offsets are merged into one over byte pairs.

Every window of a text counts, weighted by its bytes; nothing of a text is skipped.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructType

from tidemill.llm.common import Workspace, text_bytes

UNDETERMINED = "und"
WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
# The sample the network is trained on: at most so many documents of a language, so many windows of
# each. Which ones is decided by hashes. Prediction has no such bound.
DOCS_PER_LANGUAGE = 400
WINDOWS_PER_DOC = 2
EPOCHS = 8
# Bytes in one step of prediction.
STEP_BYTES = 1 << 20


class ByteCnn:
    def __init__(self, languages: list[str], seed: int = 1):
        random = np.random.default_rng(seed)
        self.languages = languages
        self.filters = {
            w: random.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS
        }
        n = FILTERS * len(WIDTHS)
        self.dense = random.normal(0, 0.1, (n, len(languages))).astype(np.float32)
        self.bias = np.zeros(len(languages), np.float32)

    # --- training --------------------------------------------------------------------------------

    def _pooled(self, windows: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        pooled, places = [], []
        for w, tables in self.filters.items():
            last = windows.shape[1] - w + 1
            response = sum(tables[j][windows[:, j : j + last]] for j in range(w))
            places.append(response.argmax(axis=1))
            pooled.append(np.take_along_axis(response, places[-1][:, None], axis=1)[:, 0])
        return np.concatenate(pooled, axis=1), places

    def fit(self, windows: np.ndarray, labels: np.ndarray, epochs: int = EPOCHS) -> None:
        """Adam on the mean cross-entropy; languages weigh alike however many windows they have."""
        random = np.random.default_rng(2)
        counts = np.bincount(labels, minlength=len(self.languages))
        weight = (len(labels) / (len(self.languages) * np.maximum(counts, 1)))[labels]
        params = [*self.filters.values(), self.dense, self.bias]
        first = [np.zeros_like(p) for p in params]
        second = [np.zeros_like(p) for p in params]
        step = 0
        for _ in range(epochs):
            order = random.permutation(len(labels))
            for begin in range(0, len(order), 64):
                rows = order[begin : begin + 64]
                x, y = windows[rows], labels[rows]
                pooled, places = self._pooled(x)
                active = np.maximum(pooled, 0)
                error = softmax(active @ self.dense + self.bias)
                error[np.arange(len(rows)), y] -= 1
                error *= (weight[rows] / len(rows))[:, None]
                back = (error @ self.dense.T) * (pooled > 0)
                gradients = []
                for k, (w, tables) in enumerate(self.filters.items()):
                    gradient = np.zeros_like(tables)
                    part = back[:, k * FILTERS : (k + 1) * FILTERS]
                    line, column = np.indices(part.shape)
                    for j in range(w):  # only the pooled place of a filter has a gradient
                        np.add.at(gradient[j], (x[line, places[k] + j], column), part)
                    gradients.append(gradient)
                gradients += [active.T @ error, error.sum(axis=0)]
                step += 1
                for p, g, m, v in zip(params, gradients, first, second):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= 0.01 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)

    # --- prediction ------------------------------------------------------------------------------

    def pair_tables(self) -> dict[int, list[np.ndarray]]:
        """For each width its offsets in twos, as tables over byte pairs; an odd one stays alone."""
        out = {}
        for w, tables in self.filters.items():
            pairs = [
                (tables[j][:, None] + tables[j + 1][None]).reshape(65536, FILTERS)
                for j in range(0, w - 1, 2)
            ]
            out[w] = pairs + ([tables[w - 1]] if w % 2 else [])
        return out

    def predict(self, windows: np.ndarray, tables: dict[int, list[np.ndarray]]) -> np.ndarray:
        """Probabilities of the languages for each window."""
        pairs = windows[:, :-1].astype(np.int32) << 8 | windows[:, 1:]
        pooled = []
        for w, parts in tables.items():
            last = windows.shape[1] - w + 1
            response = None
            for k, part in enumerate(parts):
                index = pairs if len(part) == 65536 else windows
                rows = part.take(index[:, 2 * k : 2 * k + last], axis=0)
                response = rows if response is None else np.add(response, rows, out=response)
            pooled.append(response.max(axis=1))
        return softmax(np.maximum(np.concatenate(pooled, axis=1), 0) @ self.dense + self.bias)


def softmax(scores: np.ndarray) -> np.ndarray:
    scores = np.exp(scores - scores.max(axis=1, keepdims=True))
    return scores / scores.sum(axis=1, keepdims=True)


def cut_windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts as fixed-length windows, the last of each padded with zero bytes; with the row each
    window belongs to and the number of its real bytes."""
    sizes = np.diff(offsets)
    counts = -(-sizes // WINDOW)
    begins = np.cumsum(counts) - counts
    flat = np.zeros(int(counts.sum()) * WINDOW, np.uint8)
    flat[np.arange(len(data)) + np.repeat(begins * WINDOW - offsets[:-1], sizes)] = data
    rows = np.repeat(np.arange(len(sizes)), counts)
    place = np.arange(len(rows)) - begins[rows]
    return flat.reshape(-1, WINDOW), rows, np.minimum(sizes[rows] - place * WINDOW, WINDOW)


def train(
    labelled: DataFrame, work: Workspace, text: str = "text", lang: str = "lang"
) -> ByteCnn | None:
    """A network for the languages of ``labelled``; None where no text has a language.

    Rows with a null text or language do not count. The network is fitted on a bounded sample, see
    ``DOCS_PER_LANGUAGE`` and ``WINDOWS_PER_DOC``, so its size does not grow with the table.
    """
    rows = labelled.where(
        F.col(text).isNotNull() & F.col(lang).isNotNull() & has_letter(F.col(text))
    ).select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    # A share of each language by hash first, so that what is ranked does not grow with the table.
    # Copies have one hash, so it is a share of the different texts.
    key, place = F.xxhash64("text"), F.pmod(F.xxhash64(F.lit(3), "text"), F.lit(1 << 30))
    different = rows.select("lang", key.alias("key")).distinct()
    counts = different.groupBy("lang").agg(F.count(F.lit(1)).alias("docs"))
    share = F.lit(4 * DOCS_PER_LANGUAGE * (1 << 30)) / F.col("docs")
    room = F.greatest(F.length("text") - WINDOW, F.lit(0)) + 1
    windows = [
        F.substring("text", (F.pmod(F.xxhash64("text", F.lit(k)), room) + 1).cast("int"), F.lit(WINDOW))
        for k in range(WINDOWS_PER_DOC)
    ]
    some = rows.join(work.keep(counts, "languages"), "lang").where(place < share)
    some = some.select("lang", key.alias("key"), F.array(*windows).alias("parts")).distinct()
    first = Window.partitionBy("lang").orderBy("key", "parts")
    sample = some.withColumn("n", F.row_number().over(first)).where(
        F.col("n") <= DOCS_PER_LANGUAGE
    )
    found = sample.select("lang", "key", F.explode("parts").alias("part")).distinct()
    found = sorted((r.lang, r.key, r.part) for r in found.collect())
    if not found:
        return None
    languages = sorted({f[0] for f in found})
    raw = [f[2].encode()[:WINDOW].ljust(WINDOW, b"\0") for f in found]
    network = ByteCnn(languages)
    network.fit(
        np.frombuffer(b"".join(raw), np.uint8).reshape(-1, WINDOW),
        np.array([languages.index(f[0]) for f in found]),
    )
    return network


def has_letter(text: Column) -> Column:
    return text.rlike(r"\p{L}")


_ready: dict[bytes, tuple[ByteCnn, dict]] = {}


def _network(packed: bytes) -> tuple[ByteCnn, dict]:
    if packed not in _ready:
        network = pickle.loads(packed)
        _ready.clear()
        _ready[packed] = network, network.pair_tables()
    return _ready[packed]


def _judge(texts: pa.Array, network: ByteCnn, tables: dict) -> np.ndarray:
    """Mean probabilities of the languages over all bytes of each text."""
    data, offsets = text_bytes(texts)
    total = np.zeros((len(texts), len(network.languages)))
    start = 0
    while start < len(texts):
        stop = int(np.searchsorted(offsets, offsets[start] + STEP_BYTES, "right")) - 1
        stop = max(stop, start + 1)
        part = data[offsets[start] : offsets[stop]]
        windows, rows, sizes = cut_windows(part, offsets[start : stop + 1] - offsets[start])
        for begin in range(0, len(windows), 256):
            step = slice(begin, begin + 256)
            chances = network.predict(windows[step], tables) * sizes[step, None]
            np.add.at(total, start + rows[step], chances)
        start = stop
    return total / np.maximum(np.diff(offsets), 1)[:, None]


def identify(
    docs: DataFrame, network: ByteCnn | None, text: str = "text"
) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the mean probability of that language.

    ``und`` with score 0 for a null text, one without any letter, and everything where there was
    nothing to learn from. Texts of any length are judged whole. Columns of the two names are
    replaced; other columns, nulls and repeated rows stay as they are.
    """
    kept = [docs.schema[c] for c in docs.columns if c not in ("lang_pred", "score")]
    schema = StructType([*kept]).add("lang_pred", StringType()).add("score", DoubleType())
    names = [f.name for f in kept]
    packed = docs.sparkSession.sparkContext.broadcast(pickle.dumps(network))
    rows = docs.select(*names, has_letter(F.col(text)).alias("_has_letter"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(batch.schema.names.index(n)) for n in names]
            known = batch.column(batch.num_columns - 1).fill_null(False)
            known = known.to_numpy(zero_copy_only=False)
            lang, score = np.full(len(known), UNDETERMINED, object), np.zeros(len(known))
            network, tables = _network(packed.value) if packed.value != NOTHING else (None, None)
            if network is not None and known.any():
                texts = columns[names.index(text)].filter(pa.array(known))
                chances = _judge(texts, network, tables)
                lang[known] = np.array(network.languages, object)[chances.argmax(axis=1)]
                score[known] = np.clip(chances.max(axis=1), 0, 1)
            columns += [pa.array(lang, pa.string()), pa.array(score)]
            yield pa.RecordBatch.from_arrays(columns, [*names, "lang_pred", "score"])

    return rows.mapInArrow(run, schema)


NOTHING = pickle.dumps(None)
