"""Language identification by a byte convolutional network.

Bytes are embedded, filters of several widths run over them, each filter's
largest response in a window feeds a softmax over the languages.  Trained in
numpy on windows of labelled texts.  For scoring, embedding and filters are
multiplied out into tables by byte pair, so a response is a sum of table rows;
every window of a text is scored and the windows' logits are averaged.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripscope.llm.common import drawn, held_out, mapped, slices, table

WINDOW = 192  # bytes; responses may look WIDTHS[-1] - 1 bytes further
WIDTHS = (2, 3, 4)
REACH = WIDTHS[-1] - 1
FILTERS = 16
EMBEDDING = 8
#: About so many documents (shared by the languages) and windows of each are learnt from.
MAX_DOCUMENTS = 4_000
MAX_WINDOWS = 5
MAX_LANGUAGES = 1_000
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str | None) -> bool:
    """A letter of any script (word characters also hold numbers like ½)."""
    return bool(text) and any(m.group().isalpha() for m in _LETTER.finditer(text))


def windows(text: bytes) -> np.ndarray:
    """(number, WINDOW + REACH) bytes, zeros behind the end; one at least."""
    n = max(1, -(-len(text) // WINDOW))
    padded = np.zeros(n * WINDOW + REACH, np.uint8)
    padded[: len(text)] = np.frombuffer(text, np.uint8)
    return np.lib.stride_tricks.as_strided(padded, (n, WINDOW + REACH), (WINDOW, 1))


@dataclass
class LanguageModel:
    languages: list[str]
    embedding: np.ndarray  # 256 x EMBEDDING
    filters: list[np.ndarray]  # per width: width x EMBEDDING x FILTERS
    offsets: list[np.ndarray]  # per width: FILTERS
    out: np.ndarray  # len(WIDTHS) * FILTERS x languages
    bias: np.ndarray

    @property
    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First two bytes of all widths, by pair; bytes three and four of
        width 4, by pair; byte three of width 3."""
        if not hasattr(self, "_tables"):
            one = [[self.embedding @ f[k] for k in range(len(f))] for f in self.filters]
            pair = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(65536, -1)
            first = np.concatenate([pair(t[0], t[1]) + o for t, o in zip(one, self.offsets, strict=True)], axis=1)
            self._tables = tuple(
                np.ascontiguousarray(t, np.float32) for t in (first, pair(one[2][2], one[2][3]), one[1][2])
            )
        return self._tables

    def logits(self, texts: list[bytes]) -> np.ndarray:
        """Mean logits over the windows of each text."""
        first, later, third = self.tables
        counts = np.array([max(1, -(-len(t) // WINDOW)) for t in texts])
        data = np.zeros(int(counts.sum()) * WINDOW + REACH, np.int32)
        starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
        for t, s in zip(texts, starts, strict=True):
            data[s * WINDOW : s * WINDOW + len(t)] = np.frombuffer(t, np.uint8)
        total, step, f = int(counts.sum()), 256, FILTERS
        pooled = np.empty((total, 3 * f), np.float32)
        # A response must not look into the next text: where a window ends a
        # text, the bytes behind it count as zeros.
        last = np.zeros(total, bool)
        last[np.cumsum(counts) - 1] = True
        for a in range(0, total, step):
            b = min(total, a + step)
            w = np.lib.stride_tricks.as_strided(
                data[a * WINDOW :], (b - a, WINDOW + REACH), (WINDOW * 4, 4)
            ).copy()
            w[last[a:b], WINDOW:] = 0
            pairs = (w[:, :-1] << 8) | w[:, 1:]
            got = first[pairs[:, :WINDOW]]
            got[:, :, f : 2 * f] += third[w[:, 2 : WINDOW + 2]]
            got[:, :, 2 * f :] += later[pairs[:, 2 : WINDOW + 2]]
            pooled[a:b] = got.max(axis=1)
        logits = np.maximum(pooled, 0) @ self.out.astype(np.float32) + self.bias.astype(np.float32)
        return np.add.reduceat(logits, starts, axis=0) / counts[:, None]

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """(language, probability) per text; ``und`` and 0 without a letter."""
        out = [(UNKNOWN, 0.0)] * len(texts)
        asked = [i for i, t in enumerate(texts) if has_letter(t)]
        if asked and self.languages:
            z = self.logits([texts[i].encode("utf-8", "replace") for i in asked])
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            for i, row in zip(asked, p, strict=True):
                k = int(row.argmax())
                out[i] = (self.languages[k], float(row[k]))
        return out


def first_weights(rng: np.random.Generator, languages: int) -> dict[str, np.ndarray]:
    p = {"e": rng.normal(0, 0.5, (256, EMBEDDING))}
    for w in WIDTHS:
        p[f"f{w}"] = rng.normal(0, (w * EMBEDDING) ** -0.5, (w * EMBEDDING, FILTERS))
        p[f"o{w}"] = np.zeros(FILTERS)
    p["out"] = rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, languages))
    p["bias"] = np.zeros(languages)
    return p


def gradients(p: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean cross entropy of windows ``x`` with languages ``y`` under the weights
    ``p``, and its derivative by each of them."""
    e = p["e"][x]
    g = {k: np.zeros_like(t) for k, t in p.items()}
    pooled, at, columns = [], [], []
    for w in WIDTHS:
        c = np.concatenate([e[:, k : k + WINDOW] for k in range(w)], axis=2)
        r = c @ p[f"f{w}"] + p[f"o{w}"]
        i = r.argmax(axis=1)
        columns.append(c)
        at.append(i)
        pooled.append(np.take_along_axis(r, i[:, None, :], axis=1)[:, 0])
    pooled = np.concatenate(pooled, axis=1)
    hidden = np.maximum(pooled, 0)
    z = hidden @ p["out"] + p["bias"]
    q = np.exp(z - z.max(axis=1, keepdims=True))
    q /= q.sum(axis=1, keepdims=True)
    loss = float(-np.log(q[np.arange(len(x)), y]).mean())
    q[np.arange(len(x)), y] -= 1
    q /= len(x)
    g["out"], g["bias"] = hidden.T @ q, q.sum(axis=0)
    back = (q @ p["out"].T) * (pooled > 0)
    one = np.arange(len(x))[:, None]
    for j, w in enumerate(WIDTHS):
        d, i = back[:, j * FILTERS : (j + 1) * FILTERS], at[j]
        c = columns[j][one, i]  # rows x FILTERS x w*EMBEDDING: only the largest responses learn
        g[f"f{w}"] = np.einsum("bfc,bf->cf", c, d)
        g[f"o{w}"] = d.sum(axis=0)
        de = (d[:, :, None] * p[f"f{w}"].T[None]).reshape(len(x), FILTERS, w, EMBEDDING)
        for k in range(w):
            np.add.at(g["e"], x[one, i + k], de[:, :, k])
    return loss, g


def train(data: np.ndarray, labels: np.ndarray, languages: list[str], *, epochs: int = 4, batch: int = 64,
          rate: float = 0.01, seed: int = 9) -> LanguageModel:
    """Mini-batch Adam on cross entropy.  ``data``: windows, ``labels``: the
    number of the language of each."""
    rng = np.random.default_rng(seed)
    p = first_weights(rng, len(languages))
    p = {k: v.astype(np.float32) for k, v in p.items()}
    m, v, step = {k: np.zeros_like(x) for k, x in p.items()}, {k: np.zeros_like(x) for k, x in p.items()}, 0
    for epoch in range(epochs):
        order = rng.permutation(len(data))
        for a in range(0, len(order), batch):
            rows = order[a : a + batch]
            x, y = data[rows].astype(np.int64), labels[rows]
            _, g = gradients(p, x, y)
            step += 1
            lr = rate * (1 - 0.9 * epoch / max(epochs - 1, 1)) * (1 - 0.999**step) ** 0.5 / (1 - 0.9**step)
            for k in p:
                m[k] += 0.1 * (g[k] - m[k])
                v[k] += 0.001 * (g[k] ** 2 - v[k])
                p[k] -= lr * m[k] / (np.sqrt(v[k]) + 1e-8)
    return LanguageModel(
        languages, p["e"], [p[f"f{w}"].reshape(w, EMBEDDING, FILTERS) for w in WIDTHS], [p[f"o{w}"] for w in WIDTHS],
        p["out"], p["bias"],
    )


def fit_language(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", lang: str = "lang",
    max_documents: int = MAX_DOCUMENTS, max_windows: int = MAX_WINDOWS,
) -> LanguageModel:
    """Learn from documents with a language whose key is not held out: about
    ``max_documents`` of them, the same number from each language as far as it
    has them, picked by a hash of the key; of each up to ``max_windows`` windows
    spread over its whole text.  The driver gets those windows only.  NULL keys,
    texts and languages teach nothing; with no rows every text is ``und``."""
    known = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang")).where(
        F.col("key").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("key"))
    )
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()}
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not counts:
        return LanguageModel([], np.zeros((256, EMBEDDING)), [], [], np.zeros(0), np.zeros(0))
    languages = sorted(counts)
    totals = docs.sparkSession.createDataFrame([(k, counts[k]) for k in languages], "lang string, total long")
    order = F.xxhash64(F.lit(9), "key")
    each = max(1, max_documents // len(languages))
    picked = known.join(F.broadcast(totals), "lang").where(drawn(F.col("key"), 9, each, F.col("total")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                row, out = [], []
                for i, t in enumerate(part.column("text").to_pylist()):
                    if not has_letter(t):
                        continue
                    w = windows(t.encode("utf-8", "replace"))
                    for k in np.unique(np.linspace(0, len(w) - 1, min(len(w), max_windows)).astype(int)):
                        row.append(i)
                        out.append(w[k].tobytes())
                rows = pa.array(row, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("order").take(rows), part.column("lang").take(rows), pa.array(out, pa.binary())],
                    ["order", "lang", "bytes"],
                )

    got = (
        picked.select(order.alias("order"), "lang", "text")
        .transform(mapped, cut, "order long, lang string, bytes binary").toArrow()
        .sort_by([("order", "ascending"), ("bytes", "ascending")])
    )
    number = {k: i for i, k in enumerate(languages)}
    data = np.frombuffer(b"".join(got["bytes"].to_pylist()), np.uint8).reshape(-1, WINDOW + REACH)
    return train(data, np.array([number[k] for k in got["lang"].to_pylist()], np.int64), languages)


def identify_language(docs: DataFrame, model: LanguageModel, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, lang_pred, score) per row, over every window of the whole text.
    NULL text or text without a letter: ``und``, 0.  No shuffle."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def identify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = model.predict(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), pa.array([k for k, _ in found], pa.string()),
                     pa.array([s for _, s in found], pa.float64())],
                    ["key", "lang_pred", "score"],
                )

    kind = rows.schema["key"].dataType.simpleString()
    return rows.transform(mapped, identify, f"key {kind}, lang_pred string, score double").withColumnRenamed("key", key)


def op9_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    found = identify_language(docs, fit_language(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
