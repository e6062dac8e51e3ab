"""Quality classifier by compression.

Zstandard dictionaries are built from labelled text, one from good and one from bad documents. A text is cut into chunks,
each chunk is compressed with both, and the difference of the compressed sizes, divided by the plain size, says which kind
of text it resembles. The same is done with the text's shape (a run of letters becomes one ``a`` or ``A``, digits ``0``, all else stays), where layout
counts and words do not. Logistic regression on a part of the labels that the dictionaries have not seen turns
the differences into a probability.

The labels' sample is bounded (``SAMPLE`` documents for each label, ``PIECES`` chunks of each): more labels do not make the
model larger. Scoring reads every document as a whole.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlens.llm.common import id_text, map_batches, rows_of

#: Bytes of a chunk. Short enough that a dictionary matters throughout a long text.
CHUNK = 2048
#: Labelled documents of each label that are used, and chunks of each: at most 2 * 1,500 * 4 * 2 kB = 24 MB.
SAMPLE, PIECES = 1_500, 4
DICTIONARY_BYTES, LEVEL = 112 * 1024, 3
#: Short texts say little: sizes are shrunk towards typical ones as if this many bytes of typical text were added.
PRIOR_BYTES = 150
#: Scores from here on predict a good document.
THRESHOLD = 0.3


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt: CRC-32 of the id as text is divisible by 5. A null id counts as the empty text."""
    return F.crc32(id_text(doc_id).cast("binary")) % 5 == 0


def chunks(text: bytes) -> list[bytes]:
    """The whole text in pieces of CHUNK bytes; a short rest joins the piece before it."""
    cuts = list(range(0, len(text), CHUNK))
    if len(cuts) > 1 and len(text) - cuts[-1] < CHUNK // 2:
        cuts.pop()
    return [text[a:b] for a, b in zip(cuts, [*cuts[1:], len(text)])]


_SHAPE = bytes(
    ord("A") if 65 <= b <= 90 else ord("a") if 97 <= b <= 122 or b >= 128 else ord("0") if 48 <= b <= 57 else b for b in range(256)
)


def shape(text: bytes) -> bytes:
    marks = np.frombuffer(text.translate(_SHAPE), np.uint8)
    if not len(marks):
        return b""
    run_on = np.concatenate([[False], (marks[1:] == marks[:-1]) & np.isin(marks[1:], (ord("a"), ord("A"), ord("0")))])
    return marks[~run_on].tobytes()


@dataclass
class Model:
    """Dictionaries (good, bad, good shapes, bad shapes) and the calibration; ``base`` is the score where nothing was learnt."""

    dictionaries: tuple[bytes, ...] = ()
    weights: tuple[float, ...] = ()
    typical: tuple[float, ...] = (0.0, 0.0, 0.0, 0.0)
    base: float = 0.5

    def compressors(self) -> list[zstandard.ZstdCompressor]:
        out = []
        for data in self.dictionaries:
            kind = zstandard.DICT_TYPE_AUTO if data[:4] == b"\x37\xa4\x30\xec" else zstandard.DICT_TYPE_RAWCONTENT
            d = zstandard.ZstdCompressionDict(data, dict_type=kind)
            d.precompute_compress(level=LEVEL)
            out.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_dict_id=False))
        return out

    @property
    def trained(self) -> bool:
        return len(self.dictionaries) == 4 and all(self.dictionaries)


def _sizes(parts: list[bytes], good: zstandard.ZstdCompressor, bad: zstandard.ZstdCompressor, frame: int) -> tuple[int, int]:
    """Difference of the two compressed sizes, and the smaller one without the frames' own bytes."""
    g, b = sum(len(good.compress(p)) for p in parts), sum(len(bad.compress(p)) for p in parts)
    return b - g, min(g, b) - frame * len(parts)


def features(texts: list[bytes], model: Model) -> np.ndarray:
    """For text and shape: (difference of the compressed sizes, size with the better dictionary), both per byte."""
    out = np.tile(np.array(model.typical), (len(texts), 1))
    if not model.trained:
        return out
    good, bad, good_shape, bad_shape = model.compressors()
    frame, prior = len(good.compress(b"")), PRIOR_BYTES
    for i, text in enumerate(texts):
        if not text:
            continue
        outline = shape(text)
        plain, form = _sizes(chunks(text), good, bad, frame), _sizes(chunks(outline), good_shape, bad_shape, frame)
        n = np.array([len(text), len(text), len(outline), len(outline)], float)
        weight = prior * n / len(text)  # the shape is shorter than the text, and so is its share of the prior
        out[i] = (np.array([*plain, *form]) + weight * model.typical) / (n + weight)
    return out


def probability(x: np.ndarray, model: Model) -> np.ndarray:
    if not model.trained:
        return np.full(len(x), model.base)
    z = model.weights[0] + x @ np.array(model.weights[1:])
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> tuple[float, ...]:
    """Newton's method on standardised features; the ridge keeps separable labels finite."""
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-9)
    a = np.hstack([np.ones((len(x), 1)), (x - mean) / scale])
    w, pull = np.zeros(a.shape[1]), np.diag([1e-6] + [ridge] * x.shape[1])
    for _ in range(rounds):
        p = 1.0 / (1.0 + np.exp(-np.clip(a @ w, -30, 30)))
        w = w - np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + pull, a.T @ (p - y) + pull @ w)
    slopes = w[1:] / scale
    return (float(w[0] - slopes @ mean), *map(float, slopes))


def _dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary, or the samples themselves where they are too few to train on."""
    joined = b"".join(samples)
    if len(joined) > 8 * DICTIONARY_BYTES:
        try:
            return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=256, d=8).as_bytes()
        except zstandard.ZstdError:
            pass  # too little variety to train on
    return joined[-DICTIONARY_BYTES:]


def labelled_sample(docs: DataFrame, labels: DataFrame, target: str = "quality", sample: int = SAMPLE) -> list[tuple[str, int, list[bytes]]]:
    """(id, label, chunks) of at most ``sample`` documents for each label, in hash order of their ids, held-out rows left out.

    The ids are drawn from the labels first, so only a bounded list of ids meets the documents and no text is shuffled. Of
    several labels for one id the smallest counts. At most PIECES chunks of a text, spread over it, come to the driver.
    """
    usable = labels.filter(F.col(target).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    one = usable.groupBy("doc_id").agg(F.min(target).cast("int").alias("__label"))
    order = [F.md5(id_text(F.col("doc_id")).cast("binary")), F.col("doc_id")]
    drawn = [one.filter(F.col("__label") == y).orderBy(*order).limit(sample) for y in (0, 1)]
    few = F.broadcast(drawn[0].unionByName(drawn[1]))  # 2 * sample rows at most
    found = docs.select("doc_id", "text").join(few, "doc_id").select("doc_id", "text", "__label")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        parts = []
        for text in rows_of(batch.column(1)):
            all_parts = chunks(text)
            step = max(1, len(all_parts) // PIECES)
            parts.append(all_parts[::step][:PIECES])
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(parts, pa.list_(pa.binary()))], ["doc_id", "label", "parts"]
        )

    kinds = [docs.schema["doc_id"], T.StructField("label", T.IntegerType()), T.StructField("parts", T.ArrayType(T.BinaryType()))]
    rows = map_batches(found, run, T.StructType(kinds)).collect()
    unique = {str(r.doc_id): (str(r.doc_id), r.label, [bytes(p) for p in r.parts]) for r in sorted(rows, key=lambda r: (str(r.doc_id), [bytes(p) for p in r.parts]))}
    return [unique[k] for k in sorted(unique, key=lambda k: hashlib.md5(k.encode()).hexdigest())]


def train(docs: DataFrame, labels: DataFrame, target: str = "quality", sample: int = SAMPLE) -> Model:
    """Half of the sample of each label makes its dictionary, the other half the calibration.

    Without labels every score is 0.5; with one label only, every score is that label's smoothed share.
    """
    rows = labelled_sample(docs, labels, target, sample)
    by = {y: [parts for _, label, parts in rows if label == y and parts] for y in (0, 1)}
    n = len(by[0]) + len(by[1])
    if not by[0] or not by[1]:
        return Model(base=(len(by[1]) + 1) / (n + 2))
    # Labels with one text only use it for both.
    seen = {y: by[y][: max(1, len(by[y]) // 2)] for y in by}
    rest = {y: by[y][len(seen[y]) :] or by[y] for y in by}
    pieces = [[p for parts in seen[y] for p in parts] for y in (1, 0)]
    model = Model(tuple(map(_dictionary, [*pieces, *[[shape(p) for p in part] for part in pieces]])))
    texts = [b"".join(parts) for y in (1, 0) for parts in rest[y]]
    truth = np.array([y for y in (1, 0) for _ in rest[y]], float)
    raw = features(texts, model)
    # A text too short to tell counts as a typical good one.
    model.typical = tuple(float(v) for v in np.median(raw[truth == 1], axis=0))
    model.weights = fit_logistic(features(texts, model), truth)
    return model


def scored(docs: DataFrame, model: Model, keep: list[str], names: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """Columns ``keep`` of docs with the score of the whole text and whether it is predicted to be good."""

    read = [F.col(f"`{c}`") for c in keep]
    if "text" not in keep:
        read.append(F.col("text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        p = probability(features(rows_of(batch.column(batch.schema.get_field_index("text"))), model), model)
        cols = [*batch.columns[: len(keep)], pa.array(p), pa.array((p >= THRESHOLD).astype(np.int32))]
        return pa.RecordBatch.from_arrays(cols, [*keep, *names])

    kinds = [T.StructField(c, docs.schema[c].dataType) for c in keep]
    kinds += [T.StructField(names[0], T.DoubleType()), T.StructField(names[1], T.IntegerType())]
    return map_batches(docs.select(*read), run, T.StructType(kinds))


def classify(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, score, predicted for every row.

    Null and empty texts get the score of a text without any difference. Equal texts get equal scores. Labels that are null
    or name no document are ignored; other columns are never read. An empty table gives an empty result.
    """
    out = scored(docs, train(docs, labels, **options), ["doc_id"])
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that are predicted to be good, with their own columns, whatever these are called, and nothing else.

    Null and empty texts are judged like a text without any difference. Texts are read whole; repeated rows are each judged.
    An empty table gives an empty result. Only texts go to Python and only verdicts come back; the rows stay where they are.
    """
    model = train(docs, labels, **options)

    def good(texts: pa.Array) -> pa.Array:
        out, start = [], 0
        while start < len(texts):
            rows = len(texts) - start
            while rows > 1 and texts.slice(start, rows).nbytes > 8 << 20:
                rows = (rows + 1) // 2
            out.append(probability(features(rows_of(texts.slice(start, rows)), model), model) >= THRESHOLD)
            start += rows
        return pa.array(np.concatenate(out) if out else np.zeros(0, bool))

    return docs.filter(F.arrow_udf(good, "boolean")(F.col("text")))
