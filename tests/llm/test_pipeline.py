import corpus_pipeline
from standings.llm.common import table
from standings.llm.langid import identify
from standings.llm.quality import judge_quality
from standings.llm.simhash import near_duplicates
from test_packing import library
from test_secrets import base_spans

from standings.llm.queries import tokenizer_path

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stage_by_stage(spark):
    docs = table(spark, SF_DIR, "documents")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "language_id", "near_dedup", "secret_scans", "packing"]
    after = {}
    for name, function in corpus_pipeline.STAGES[:-1]:
        after[name] = spark.createDataFrame(function(spark, docs, SF_DIR).collect(), docs.schema)
        assert after[name].columns == COLUMNS
        ids = {r.doc_id for r in docs.collect()}
        kept = {r.doc_id for r in after[name].collect()}
        if name == "quality_rules":
            verdicts = judge_quality(docs, table(spark, SF_DIR, "labels")).select("_row.doc_id", "kept").collect()
            assert kept == {r.doc_id for r in verdicts if r.kept}
        elif name == "language_id":
            assert kept == {r[0].doc_id for r in identify(docs, docs).where("accepted").select("_row").collect()}
        elif name == "near_dedup":
            assert kept == {r.component_id for r in near_duplicates(docs).collect()}
        else:
            assert kept == ids
            before = {r.doc_id: r.text for r in docs.collect()}
            for r in after[name].collect():
                assert r.n_chars == len(r.text) and not base_spans(r.text)
                assert r.text == before[r.doc_id] or "[SECRET]" in r.text
        docs = after[name]
    pieces = corpus_pipeline.run(spark, SF_DIR).collect()
    ids = library(tokenizer_path("word_bpe_49k.json"))
    own = {}
    for p in sorted(pieces, key=lambda p: p.start):
        own[p.doc_id] = own.get(p.doc_id, b"") + bytes(p.ids)
    import numpy as np

    assert {i: np.frombuffer(b, "<u4").tolist() for i, b in own.items()} == {
        r.doc_id: ids(r.text) + [1] for r in docs.collect()
    }
