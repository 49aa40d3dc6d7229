import sentencepiece

import corpus_pipeline
from dockflow.llm import decontaminate as DC
from dockflow.llm import quality_rules as QR
from dockflow.llm import sentencepiece_scan as SP

from ..conftest import SF_SMALL
from .common import edge_docs, empty_docs
from .test_decontaminate import distance
from .test_ngram_join import brute


def test_run_equals_the_stages_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rules = QR.fit(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    good = QR.keep_good(docs, rules).select("doc_id", "text").collect()
    heads = {i: t for (i, t) in ((r["doc_id"], r["text"]) for r in good)}
    keep = {i for i, _, c in brute(sorted(heads.items())) if i == c}
    items = [r["text"].lower().split() for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    leaked = {i for i in keep if any(w := heads[i].lower().split()) and any(
        len(set(p) & set(w)) >= 0.8 * len(set(p)) and distance(p, w) <= int(DC.MAX_RATE * len(p)) for p in items)}
    lib = sentencepiece.SentencePieceProcessor(model_file=SP.MODEL_PATH)
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SF_SMALL).collect()}
    assert set(got) == keep - leaked and leaked
    for i, r in got.items():
        assert r["ids"] == lib.encode(heads[i]) and r["n_tokens"] == len(r["ids"]) and r["round_trip"]


def test_stages_take_awkward_rows(spark):
    for docs in (edge_docs(spark), empty_docs(spark)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF_SMALL)
            assert out.columns == docs.columns
            out.count()
        name, last = corpus_pipeline.STAGES[-1]
        assert last(spark, docs, SF_SMALL).count() == docs.count()


def test_encoding_and_decoding_do_not_share_a_stage(spark):
    """A core that encodes and decodes in one stage holds two Python workers, with the tables of both."""
    out = corpus_pipeline.token_stage(spark, edge_docs(spark), SF_SMALL)
    assert out._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert all(r["round_trip"] for r in out.collect())
