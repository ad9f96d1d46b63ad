"""The stages one after the other, against what their operators say."""

from collections import Counter

import corpus_pipeline
from skyweave.llm import contamination, outliers, private_data
from skyweave.llm.queries import QUERIES
from skyweave.llm.shared import documents, saved

from .test_similar import slow_kept


def test_stages(spark, data):
    docs, columns = documents(spark, data), documents(spark, data).columns
    bench = spark.read.parquet(f"{data}/benchmark.parquet")
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        after = saved(stage(spark, docs, data))
        if name != "pieces":
            assert after.columns == columns
        ids = lambda df: Counter(r.doc_id for r in df.select("doc_id").collect())
        if name == "quality":
            assert ids(after) == ids(outliers.quality_verdicts(docs).where("kept"))
        if name == "near_duplicates":
            assert set(ids(after)) == slow_kept([(r.doc_id, r.text) for r in docs.collect()]) and max(ids(after).values()) == 1
        if name == "decontaminate":
            assert set(ids(docs)) - set(ids(after)) == set(ids(contamination.matches(docs, bench)))
        if name == "private_data":
            assert ids(after) == ids(docs)
            spans = private_data.private_spans(after, private_data.Trees([]))
            assert spans.where("n_email + n_ip + n_card + n_phone > 0").count() == 0
        if name == "pieces":
            texts = {r.doc_id: r.text for r in docs.collect()}
            rows = after.collect()
            assert len(rows) == len(texts) and all(r.text == texts[r.doc_id] and r.n_pieces == len(r.ids) for r in rows)
        kept.append(after.count())
        docs = after
    assert kept == sorted(kept, reverse=True) and kept[-1] > 0
    assert corpus_pipeline.run(spark, data).count() == kept[-1]


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
