"""Each stage of the pipeline against brute force on its own input."""

import zlib

import numpy as np

import corpus_pipeline
from rhapsode.llm import toxicity
from rhapsode.llm.common import load, materialize
from rhapsode.llm.queries import SQL

from .helpers import SF, sql
from .test_mixing import targets_by_rounds
from .test_simhash import brute_components, brute_fingerprint
from .test_tokenio import whole


def size(text):
    return len((text or "").encode().split())


def test_stages(spark):
    docs = load(spark, SF, "documents")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = [r.asDict() for r in docs.collect()]
        out = materialize(stage(spark, docs, SF), name)
        kept[name] = (before, [r.asDict() for r in out.collect()])
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == columns
        docs = out

    before, after = kept["toxicity"]  # the scores themselves are held to brute force in test_toxicity
    scores = toxicity.toxicity_scores(load(spark, SF, "documents"), load(spark, SF, "labels")).collect()
    rejected = {r["doc_id"] for r in scores if r["score"] >= 0.5}
    assert [r["doc_id"] for r in before if r["doc_id"] not in rejected] == sorted(r["doc_id"] for r in after)
    toxic, clean = ({r["doc_id"] for r in load(spark, SF, "labels").where(f"toxic = {y}").collect()} for y in (1, 0))
    assert len(rejected & toxic) >= 0.5 * len(toxic) > 0 and len(rejected & clean) <= 0.02 * len(clean)

    before, after = kept["near_duplicates"]
    comp = brute_components([(r["doc_id"], brute_fingerprint(r["text"])) for r in before])
    assert sorted(r["doc_id"] for r in after) == sorted(set(comp))

    before, after = kept["leaks"]
    found = set(sql(SQL["op9_decontamination"], documents=docs_frame(spark, before), benchmark=load(spark, SF, "benchmark").toPandas())["doc_id"])
    assert {r["doc_id"] for r in after} == {r["doc_id"] for r in before} - found

    before, after = kept["source_mix"]
    sizes = {}
    for r in before:
        sizes.setdefault(r["source"], []).append(size(r["text"]))
    for source, target in targets_by_rounds({s: sum(v) for s, v in sizes.items()}).items():
        taken = sum(size(r["text"]) for r in after if r["source"] == source)
        assert abs(taken - target) <= max(sizes[source]) / 2 + 1e-6

    before, after = kept["token_output"]
    rows = sorted(((r["doc_id"], r["text"] or "") for r in before), key=lambda r: r[0])
    want, at = [], 0
    for (d, _), ids in zip(rows, whole([t for _, t in rows]), strict=True):
        want.append((d, at, len(ids) + 1, zlib.crc32(np.array([*ids, 2], dtype="<u4").tobytes())))
        at += len(ids) + 1
    assert sorted(map(tuple, (r.values() for r in after)), key=lambda r: r[1]) == want


def docs_frame(spark, rows):
    import pandas as pd

    return pd.DataFrame(rows)


def test_run_is_the_stages_in_order(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and out.count() > 0
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "leaks", "source_mix", "token_output"]
