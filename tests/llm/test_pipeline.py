"""The pipeline, stage by stage, on the smallest tables."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline as P
from tests.conftest import SF_SMALL
from tests.llm.test_line_dedup import brute as lines_of
from tests.llm.test_packing import check
from tests.llm.test_setsketch import WORD
from tests.llm.test_setsketch import brute as groups_of
from tripscope.llm import quality
from tripscope.llm.common import written
from tripscope.llm.packing import LIMIT, pack


def test_every_stage_takes_effect(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, before = docs.columns, docs.count()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}

    good = written(P.quality_stage(spark, docs, SF_SMALL), "t")
    model = quality.fit_quality(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    want = {r.doc_id for r in docs.collect() if model.score(r.text) >= 0.5}
    assert {r.doc_id for r in good.collect()} == want and good.columns == columns and len(want) < before
    assert sum(labels.get(k) == 1 for k in want) >= 0.95 * sum(v == 1 for v in labels.values())

    cut = written(P.line_stage(spark, good, SF_SMALL), "t")
    plain = lines_of([(r.doc_id, r.text) for r in good.collect()])
    got = {r.doc_id: r.text for r in cut.collect()}
    assert got == {k: t for k, (_, t, _) in plain.items() if t.split()} and cut.columns == columns
    assert all(r.n_chars == len(r.text) for r in cut.collect())

    single = written(P.near_stage(spark, cut, SF_SMALL), "t")
    kept = {int(k) for k, _, _, keep in groups_of([(r.doc_id, r.text) for r in cut.collect()], P.NEAR_THRESHOLD) if keep}
    assert {r.doc_id for r in single.collect()} == kept and single.columns == columns

    mixed = written(P.mixing_stage(spark, single, SF_SMALL), "t")
    counts = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert set(counts) <= kept and set(counts.values()) <= {1, 2, 3} and mixed.columns == columns

    packed = P.packing_stage(spark, mixed, SF_SMALL)
    assert packed.where("start = 0").count() == mixed.count()


def test_stages_and_odd_rows(spark, odd, none):
    assert [name for name, _ in P.STAGES] == ["quality classifier", "line dedup", "near dedup", "mixing", "packing"]
    for stage in (P.quality_stage, P.line_stage, P.near_stage, P.mixing_stage):
        out = stage(spark, odd, SF_SMALL)
        assert out.columns == odd.columns and out.count() > 0
        assert {r[odd.columns[-1]] for r in out.collect()} == {"clash"}
    assert P.packing_stage(spark, odd, SF_SMALL).where("start = 0").count() == odd.count()
    for _, stage in P.STAGES:
        assert stage(spark, none, SF_SMALL).count() == 0


def test_mixing_takes_so_many_of_repeated_rows(spark):
    rows = [(1, "w " * 10, "a")] * 400 + [(i, "w " * 10, "b") for i in range(2, 202)] + [(i, "w " * 10, "c") for i in range(300, 400)]
    docs = written(spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(5), "t")
    out = P.mixing_stage(spark, docs, SF_SMALL)
    words = {r.source: 10 * r["count"] for r in out.groupBy("source").count().collect()}
    for s, target in plain_targets({"a": 4000, "b": 2000, "c": 1000}).items():
        assert abs(words[s] - target) <= 10, s


def plain_targets(sizes):
    """Words each source should give: all words by weight 5, 2, 1, 5, ..., none
    over three times its own."""
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(sizes))}
    full: set = set()
    while True:
        left = sum(sizes.values()) - sum(3 * sizes[s] for s in full)
        out = {s: left * w / sum(v for t, v in weights.items() if t not in full) for s, w in weights.items() if s not in full}
        over = {s for s in out if out[s] > 3 * sizes[s]}
        if not over:
            return out | {s: 3 * sizes[s] for s in full}
        full |= over


def test_run_mixes_to_the_targets_and_keeps_every_token(spark, monkeypatch):
    kept = {}

    def spy(df, name):
        kept[name] = written(df, name)
        return kept[name]

    monkeypatch.setattr(P, "written", spy)
    monkeypatch.setattr(P.packing, "pack", lambda docs: pack(docs, keep_ids=True))
    out = P.run(spark, SF_SMALL).collect()
    single = {r.doc_id: (r.source, r.text) for r in kept["pipeline-near-dedup"].collect()}
    mixed = [(r.doc_id, r.source, r.text) for r in kept["pipeline-mixing"].collect()]
    assert all(single[k] == (s, t) for k, s, t in mixed)
    uses, size = Counter(k for k, _, _ in mixed), {k: len(WORD.findall(t)) for k, (_, t) in single.items()}
    sizes = Counter()
    for k, (s, _) in single.items():
        sizes[s] += size[k]
    for s, target in plain_targets(sizes).items():
        own = [k for k in single if single[k][0] == s]
        taken = sum(uses[k] * size[k] for k in own)
        assert abs(taken - target) <= 0.05 * target + max(size[k] for k in own), s
        # a use of all documents comes before the next use of any
        assert max(uses[k] for k in own) - min(uses[k] for k in own) <= 1, s
    check([(k, t) for k, _, t in mixed], LIMIT, out)
