"""The stages on a small corpus, and the registration of the queries."""

from __future__ import annotations

import random

import corpus_pipeline
import __spark_entry__ as entry


def test_stages(spark):
    r = random.Random(1)
    text = lambda: " ".join("".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(120))
    clean = [text() for _ in range(12)]
    near = clean[0].split(" ")
    near[5] = "changed"
    rows = [(i, t) for i, t in enumerate(clean)] + [(50, clean[1]), (51, " ".join(near[:60] + ["x", "y"] + near[60:])), (52, "too short"), (53, "a b c " * 60), (54, None)]
    docs = spark.createDataFrame([(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        kept.append(sorted({x["doc_id"] for x in docs.collect()}))
    assert kept[0] == [*range(12), 50, 51] and kept[1] == [*range(12), 51] and kept[2] == list(range(12))
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, "").collect()
    assert {x["doc_id"] for x in packed} == set(kept[3])


def test_every_corpus_query_is_registered():
    names = entry.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{n}" for n in range(1, 14)} and "pipeline" in names
