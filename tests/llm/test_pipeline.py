import corpus_pipeline
from tidemark.llm import decontaminate, language_id, minhash, toxicity

FOLDER = "/root/testdata/sf0.01"


def test_stages_work_on_what_the_one_before_kept(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    extra = [(10_001, None, "en", "s", 0), (10_002, "12 34 !!", "en", "s", 8)]
    now = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    labels, bench = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("labels", "benchmark"))
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    expected = {
        "language_id": lambda d: {r.doc_id for r in language_id.identify(d, language_id.fit(d)).collect() if r.lang_pred != "und"},
        "toxicity": lambda d: {r.doc_id for r in toxicity.score(d, toxicity.fit(d, labels)).collect() if r.score < toxicity.THRESHOLD},
        "minhash_near_dedup": lambda d: {r.doc_id for r in minhash.group(d, 5).collect() if r.kept},
        "benchmark_decontamination": lambda d: ids(d) - {r.doc_id for r in decontaminate.contaminated(d, bench).collect()},
        "byte_bpe": ids,
    }
    assert [n for n, _ in corpus_pipeline.STAGES] == list(expected)
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, now, FOLDER)
        assert name == "byte_bpe" or out.columns == docs.columns
        out.write.parquet(str(tmp_path / str(k)))
        out = spark.read.parquet(str(tmp_path / str(k)))
        assert ids(out) == expected[name](now) and out.count() == len(ids(out))
        now = out
    assert ids(now) & {10_001, 10_002} == set()
    assert ids(corpus_pipeline.run(spark, FOLDER)) <= ids(docs)
