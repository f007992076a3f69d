import public_tokenizers

import corpus_pipeline
from lakeshard.llm import bpe, exact_dedup, jaccard_join, mixing, toxicity
from lakeshard.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def test_every_operator_has_one_query():
    names = sorted(QUERIES, key=lambda n: int(n[2:].split("_")[0]))
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


def test_stages_feed_each_other(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    want = docs
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "exact_dedup", "near_dedup", "mixing", "bpe"]
    sizes = [docs.count()]
    for name, plain in (("toxicity", lambda d: toxicity.reject(d, labels)), ("exact_dedup", exact_dedup.deduplicate),
                        ("near_dedup", jaccard_join.keep_first), ("mixing", mixing.mix)):
        got = stages[name](spark, want, SF)
        assert got.columns == docs.columns
        plain_rows = plain(want).orderBy("doc_id", "text").collect()
        assert got.orderBy("doc_id", "text").collect() == plain_rows
        want = spark.createDataFrame(plain_rows, docs.schema)
        sizes.append(want.count())
    assert sizes[0] > sizes[1] > sizes[2] >= sizes[3] > 0
    result = corpus_pipeline.run(spark, SF)
    expected = bpe.digests(want, public_tokenizers.path("word_bpe_49k.json"))
    assert result.orderBy(*result.columns).collect() == expected.orderBy(*result.columns).collect()


def test_no_clean_document_is_lost(spark):
    """What a stage removes is toxic by its label where there is one."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    left = corpus_pipeline.toxicity_stage(spark, docs, SF)
    gone = docs.join(left, "doc_id", "left_anti").join(labels, "doc_id")
    assert gone.where("toxic = 0").count() <= 2
