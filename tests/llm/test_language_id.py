"""Language identification: held-out accuracy; tables against convolution."""

from __future__ import annotations

import numpy as np

from tests.conftest import SF_MID
from tripscope.llm.language_id import (
    EMBEDDING, FILTERS, REACH, WIDTHS, WINDOW, LanguageModel, first_weights, fit_language, gradients, has_letter,
    identify_language, op9_language, windows,
)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "lang")
    rows = op9_language(spark, SF_MID).join(docs, "doc_id").collect()
    out = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == r.lang for r in out) >= 0.95 * len(out)
    assert all(0 <= r.score <= 1 for r in rows)


def random_model(seed=1):
    r = np.random.default_rng(seed)
    return LanguageModel(
        ["a", "b", "c"], r.normal(size=(256, EMBEDDING)), [r.normal(size=(w, EMBEDDING, FILTERS)) for w in WIDTHS],
        [r.normal(size=FILTERS) for _ in WIDTHS], r.normal(size=(len(WIDTHS) * FILTERS, 3)), r.normal(size=3),
    )


def test_tables_equal_the_convolution():
    m = random_model()
    texts = [b"abc", b"x" * WINDOW, bytes(range(1, 256)) * 3, b"y" * (WINDOW + 1)]
    got = m.logits(texts)
    for t, z in zip(texts, got, strict=True):
        each = []
        for w in windows(t):
            pooled = []
            for f, o in zip(m.filters, m.offsets, strict=True):
                e = m.embedding[w.astype(int)]
                pooled.append(np.max([sum(e[i + k] @ f[k] for k in range(len(f))) + o for i in range(WINDOW)], axis=0))
            each.append(np.maximum(np.concatenate(pooled), 0) @ m.out + m.bias)
        assert np.allclose(np.mean(each, axis=0), z, atol=1e-3)


def test_gradients_equal_finite_differences():
    rng = np.random.default_rng(4)
    p = first_weights(rng, 3)  # double precision
    p = {k: v + 0.01 * rng.normal(size=v.shape) for k, v in p.items()}
    x, y = rng.integers(97, 105, (5, WINDOW + REACH)), np.array([0, 1, 2, 1, 0])
    _, g = gradients(p, x, y)
    for k in p:
        flat = np.flatnonzero(g[k])
        for i in rng.choice(flat, min(12, len(flat)), replace=False):
            at, h = np.unravel_index(i, p[k].shape), 1e-6
            old = p[k][at]
            losses = []
            for side in (h, -h):
                p[k][at] = old + side
                losses.append(gradients(p, x, y)[0])
            p[k][at] = old
            assert np.isclose((losses[0] - losses[1]) / (2 * h), g[k][at], rtol=1e-3, atol=1e-7), (k, at)


def test_letters():
    assert has_letter("½é") and has_letter("中") and not has_letter("½ 12_ ²") and not has_letter("") and not has_letter(None)


def test_odd_rows(odd, none):
    by = {r.doc_id: r for r in identify_language(odd, random_model()).collect()}
    assert all((by[k].lang_pred, by[k].score) == ("und", 0.0) for k in (3, 4, 8))
    assert by[6].lang_pred in ("a", "b", "c") and by[5].score <= 1
    model = fit_language(odd)
    assert set(model.languages) <= {"en", "fr", "de"}
    empty = fit_language(none)
    assert identify_language(odd, empty).where("lang_pred <> 'und'").count() == 0
    assert identify_language(none, model).count() == 0
