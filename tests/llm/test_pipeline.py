"""The five stages in turn against plain Python on their own input."""

import pytest

import corpus_pipeline as C
from dossier.llm import packing, rules
from dossier.llm.base import stage

from .test_decontaminate import spec as overlaps
from .test_linededup import spec as deduped
from .test_packing import check_layout
from .test_simhash import brute
from .test_simhash import spec as fingerprint


@pytest.fixture(scope="module")
def stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = [docs]
    for name, step in C.STAGES:
        docs = stage(step(spark, docs, sf), name)
        out.append(docs)
    return [(df.columns, df.collect()) for df in out]


def test_columns(stages):
    assert [n for n, _ in C.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "decontamination", "best_fit_packing"]
    assert all(columns == stages[0][0] for columns, _ in stages[:5])


def test_quality(spark, sf, stages):
    kept = {r.doc_id for r in rules.op5_quality_rules(spark, sf).where("kept").collect()}
    assert {r.doc_id for r in stages[1][1]} == kept


def test_lines(stages):
    rows = sorted(stages[1][1], key=lambda r: r.doc_id)
    want = deduped([(r.doc_id, r.text) for r in rows], 50)
    got = sorted(stages[2][1], key=lambda r: r.doc_id)
    assert [r.text for r in got] == want
    assert all(r.n_chars == len(r.text) for r in got)
    assert [(r.doc_id, r.lang, r.source) for r in got] == [(r.doc_id, r.lang, r.source) for r in rows]


def test_near_duplicates(stages):
    def signed(f):
        return f - (1 << 64) if f >> 63 else f
    rows = stages[2][1]
    fps = {r.doc_id: signed(fingerprint(r.text)) for r in rows}
    root = brute([*fps.values()], 2)
    least = {}
    for d, f in fps.items():
        least[root[f]] = min(d, least.get(root[f], d))
    assert sorted(r.doc_id for r in stages[3][1]) == sorted(least.values())


def test_contaminated_documents_go(spark, sf, stages):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    kept = {r.doc_id for r in stages[4][1]}
    gone = [(r.doc_id, r.text) for r in stages[3][1] if r.doc_id not in kept]
    short = [(r.doc_id, r.text) for r in stages[3][1] if r.doc_id in kept and len(r.text) < 800][:25]
    found = {d for d, _ in overlaps(gone + short, items)}
    assert found == {d for d, _ in gone}


def test_packed(stages):
    rows = stages[5][1]
    assert {r.doc_id for r in rows} == {r.doc_id for r in stages[4][1]}
    check_layout(rows, packing.CAPACITY)
