"""Quality classifier: logistic regression on hashed word n-grams, trained by
follow-the-regularised-leader updates, scored as sparse dot products.

Words are runs of letters and digits, and runs of other signs, in their case;
features are single words and pairs of neighbours, hashed to ``2**bits``
weights, and n-grams of which only is kept that the last word is the first one
again (one feature per n, whatever the word).  Every occurrence counts
1/sqrt(number of features), so the length of a text does not decide.  The model
is one array of a fixed size.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripscope.llm.common import drawn, held_out, mapped, of_one_task, slices, table

BITS = 18
#: About so many labelled documents are learnt from, picked by a hash of the id.
MAX_TRAINED = 12_000
#: n-grams "the first word again", by the distance of the two words.
REPEATS = (1, 2, 3, 4)
_WORDS = re.compile(r"[^\W_]+|[^\w\s]+")


class _WordHash(dict):
    """Word -> hash, for the words seen lately."""

    def __missing__(self, word: str) -> int:
        if len(self) >= 400_000:
            self.clear()
        value = self[word] = zlib.crc32(word.encode("utf-8", "surrogatepass"))
        return value


_HASHES = of_one_task(_WordHash())


def features(text: str | None, bits: int = BITS) -> np.ndarray:
    """Feature numbers of a text, one per occurrence."""
    words = _WORDS.findall(text or "")
    if not words:
        return np.zeros(0, np.int64)
    h = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    pairs = (h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:] * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(64 - bits)
    again = [np.full(np.count_nonzero(h[k:] == h[:-k]), k, np.uint64) for k in REPEATS]
    return np.concatenate([h & np.uint64((1 << bits) - 1), pairs, *again]).astype(np.int64)


@dataclass
class QualityModel:
    bits: int = BITS
    bias: float = 0.0
    weights: np.ndarray = field(default_factory=lambda: np.zeros(1 << BITS, np.float32))

    def score(self, text: str | None) -> float:
        f = features(text, self.bits)
        margin = self.bias + (float(self.weights[f].sum()) / len(f) ** 0.5 if len(f) else 0.0)
        return float(1.0 / (1.0 + np.exp(-np.clip(margin, -30, 30))))


def train(
    rows: list[tuple[np.ndarray, np.ndarray, int]], *, bits: int = BITS, epochs: int = 4,
    alpha: float = 0.3, beta: float = 0.2, l1: float = 0.02, l2: float = 0.02,
) -> QualityModel:
    """Follow the regularised leader, per coordinate: z holds the gradients
    less what the steps so far explain, n the squared gradients; the weight in
    use is the closed-form minimum, 0 while |z| is within l1.  ``rows``:
    (distinct features, their values, label), taken in the order given."""
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)
    zb = nb = 0.0

    def solved(z, n):
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))

    bias = 0.0
    for _ in range(epochs):
        for f, x, y in rows:
            zf, nf = z[f], n[f]
            w = solved(zf, nf)
            bias = -zb / ((beta + nb**0.5) / alpha + l2)
            p = 1.0 / (1.0 + np.exp(-np.clip(bias + w @ x, -30, 30)))
            g = (p - y) * x
            grown = nf + g * g
            z[f] = zf + g - (np.sqrt(grown) - np.sqrt(nf)) / alpha * w
            n[f] = grown
            gb = p - y
            zb += gb - ((nb + gb * gb) ** 0.5 - nb**0.5) / alpha * bias
            nb += gb * gb
    return QualityModel(bits, float(-zb / ((beta + nb**0.5) / alpha + l2)), solved(z, n).astype(np.float32))


def fit_quality(
    docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "quality",
    bits: int = BITS, max_trained: int = MAX_TRAINED,
) -> QualityModel:
    """Learn from documents with a label whose key is not held out; about
    ``max_trained`` of them, picked by a hash of the key.  The driver gets
    their sparse features, bounded by that number, never texts.  NULL keys and
    labels teach nothing; without any rows the model scores 0.5."""
    known = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label")).where(
        F.col("key").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("key"))
    )
    order = F.xxhash64(F.lit(8), "key")
    total = known.count()
    if total > max_trained:
        known = known.where(drawn(F.col("key"), 8, max_trained, total))
    # At most about max_trained short rows: a bounded broadcast.
    picked = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).join(F.broadcast(known), "key")

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                at, values = [], []
                for t in part.column("text").to_pylist():
                    f = features(t, bits)
                    f, n = np.unique(f, return_counts=True)
                    at.append(f.astype("<i4").tobytes())
                    values.append((n / max(n.sum(), 1) ** 0.5).astype("<f4").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column("order"), part.column("label"), pa.array(at, pa.binary()), pa.array(values, pa.binary())],
                    ["order", "label", "at", "values"],
                )

    got = (
        picked.select(order.alias("order"), "label", "text")
        .transform(mapped, sparse, "order long, label int, at binary, values binary").toArrow()
        .sort_by([("order", "ascending"), ("label", "ascending"), ("at", "ascending")])
    )
    rows = [
        (np.frombuffer(a, "<i4"), np.frombuffer(v, "<f4").astype(np.float64), y)
        for a, v, y in zip(got["at"].to_pylist(), got["values"].to_pylist(), got["label"].to_pylist(), strict=True)
    ]
    return train(rows, bits=bits)


def score_quality(docs: DataFrame, model: QualityModel, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score) per row, over whole texts; NULL and empty texts get the
    score of no features.  No shuffle; extra columns are ignored."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                scores = [model.score(t) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(scores, pa.float64())], ["key", "score"])

    kind = rows.schema["key"].dataType.simpleString()
    return rows.transform(mapped, score, f"key {kind}, score double").withColumnRenamed("key", key)


def keep_quality(docs: DataFrame, model: QualityModel, *, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose score is at least ``threshold``, all columns
    as they are."""
    at = docs.columns.index(text)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, at):
                yield part.filter(pa.array([model.score(t) >= threshold for t in part.column(at).to_pylist()], pa.bool_()))

    return docs.transform(mapped, keep, docs.schema)


def op8_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = fit_quality(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))
    return score_quality(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
