"""The pipeline: each stage against its operator by brute force, and odd inputs."""

import gc

import corpus_pipeline
import pyarrow as pa
from pyspark.sql import functions as F

from strata.llm import decontamination, jaccard_join, pii, quality_classifier, sentencepiece_fst
from strata.llm.common import load, materialise
from strata.llm.components import components

from .test_jaccard import brute


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality", "near_duplicates", "decontamination", "personal_data", "pieces"]


def test_pipeline_matches_its_operators(spark, sf_small):
    docs = load(spark, sf_small, "documents")
    at, columns = docs, docs.columns
    results = []
    for name, stage in corpus_pipeline.STAGES:
        at = materialise(spark, stage(spark, at, sf_small), f"test-{name}")
        results.append(at)
    model = quality_classifier.train(docs, load(spark, sf_small, "labels"))
    good = {r["doc_id"] for r in quality_classifier.score(docs, model).collect() if r["predicted"]}
    assert {r["doc_id"] for r in results[0].collect()} == good and all(r.columns == columns for r in results[:4])
    groups = brute([(r["doc_id"], r["text"]) for r in results[0].collect()], 5, 80)
    assert {r["doc_id"] for r in results[1].collect()} == {c for _, c in groups.values()}
    leaks = {r["doc_id"] for r in decontamination.leaks(results[1], load(spark, sf_small, "benchmark")).collect()}
    assert {r["doc_id"] for r in results[2].collect()} == {r["doc_id"] for r in results[1].collect()} - leaks
    before = {r["doc_id"]: r["text"] for r in results[2].collect()}
    after = {r["doc_id"]: r["text"] for r in results[3].collect()}
    crf = pii.train(results[2])
    for d, text in before.items():
        base = pii.base_spans(text)
        assert after[d] == pii.redact(text, base + pii.method_spans(text, base, crf))
    codec = sentencepiece_fst.Codec(sentencepiece_fst.Vocabulary.read())
    rows = results[4].collect()
    assert len(rows) == len(after) and all(r["pieces"] == codec.encode(after[r["doc_id"]]) for r in rows)
    assert corpus_pipeline.run(spark, sf_small).count() == len(rows)


def test_pipeline_on_odd_and_no_documents(spark, odd_docs, no_docs, sf_small):
    for docs in (odd_docs, no_docs):
        at = docs
        for name, stage in corpus_pipeline.STAGES:
            at = materialise(spark, stage(spark, at, sf_small), f"odd-{name}")
        assert at.columns == [*docs.columns, "n_pieces", "pieces", "round_trip"]


def test_stages_keep_columns_named_like_their_own(spark, sf_small):
    names = ["key", "_key", "digest", "_digest", "_leaked", "encoded", "n_pieces", "pieces", "round_trip"]
    docs = load(spark, sf_small, "documents").limit(40)
    docs = docs.select("*", *[F.concat(F.lit(f"{n}-"), "doc_id").alias(n) for n in names])
    at = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        at = materialise(spark, stage(spark, at, sf_small), f"named-{name}")
        assert at.columns == docs.columns
        assert all(r[n] == f"{n}-{r['doc_id']}" for r in at.collect() for n in names)
    last = corpus_pipeline.STAGES[-1][1](spark, at, sf_small)
    assert last.columns == [*docs.columns[:-3], "n_pieces", "pieces", "round_trip"]  # these are replaced
    assert last.filter("size(pieces) <> n_pieces").count() == 0 and last.count() == at.count()


def test_a_worker_keeps_no_machine_after_the_pieces(spark):
    docs = spark.range(16, numPartitions=8).selectExpr("id doc_id", "concat('some words of text ', id) text")
    stages = (sentencepiece_fst.pieces_stage(spark, docs, ""),
              sentencepiece_fst.encode(docs, sentencepiece_fst.Vocabulary.read()))
    for encoded in stages:
        assert encoded.agg(F.sum("n_pieces")).first()[0] > 0

        def machines(batches):
            kinds = [type(x).__name__ for x in gc.get_objects()]
            for batch in batches:
                yield pa.RecordBatch.from_arrays([pa.array([kinds.count("Machine")] * batch.num_rows, pa.int64())], ["n"])

        later = spark.range(64, numPartitions=64).mapInArrow(machines, "n long")  # more tasks than there are workers
        assert later.agg(F.sum("n")).first()[0] == 0


def test_no_stage_of_the_join_holds_two_python_workers_a_task(spark, monkeypatch):
    plans = []

    def seen(edges):
        plans.append(edges._jdf.queryExecution().toString())
        return components(edges)

    monkeypatch.setattr(jaccard_join, "components", seen)
    texts = [(i, f"one two three four five six seven eight nine ten eleven {i % 3}") for i in range(9)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in jaccard_join.join(docs, 5, 70, count_links=False).collect()}
    assert found == {d: c for d, (_, c) in brute(texts, 5, 70).items()}
    # the contraction runs Python over these edges, so what makes them must not
    assert len(plans) == 2 and not any("MapInArrow" in p for p in plans)
