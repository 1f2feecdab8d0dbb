import duckdb

import corpus_pipeline
from retentio.llm import decontamination, jaccard_join, perplexity
from retentio.llm.common import stored

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    out = []
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), "test-stage")
        out.append(docs.collect())
    quality, unique, clean, mixed, sharded = out
    for kept in out[:4]:
        assert set(kept[0].asDict()) == set(corpus_pipeline.COLUMNS) and all(rows[r.doc_id] == r for r in kept)
    for r in quality:
        n, _, _, _, repeated = perplexity.base_rules(r.text)
        assert n >= 50 and 2 * repeated <= n
    ids = lambda part: [r.doc_id for r in part]
    sets = {r.doc_id: set(jaccard_join.shingles(r.text).tolist()) for r in quality}
    similar = lambda a, b: 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    assert not any(similar(a, b) for a in ids(unique) for b in ids(unique) if a < b)
    gone = set(ids(quality)) - set(ids(unique))
    assert all(any(similar(a, b) for b in sets if b != a) for a in gone)
    items = duckdb.sql(f"SELECT text FROM '{SF}/benchmark.parquet'").fetchall()
    windows = decontamination.WindowSet([(str(k), decontamination.words_of(t)) for k, (t,) in enumerate(items)])
    assert ids(clean) == [r.doc_id for r in unique if not windows.scan(decontamination.words_of(r.text))[0].any()] or \
        set(ids(clean)) == {r.doc_id for r in unique if not windows.scan(decontamination.words_of(r.text))[0].any()}
    assert sorted(ids(mixed)) == sorted(ids(sharded)) and set(ids(mixed)) <= set(ids(clean))
    assert max(ids(mixed).count(i) for i in set(ids(mixed))) <= 3
    assert {r.shard for r in sharded} <= set(range(corpus_pipeline.N_SHARDS))


def test_empty_and_null_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(None,) * 5, (1, None, "en", None, 0), (1, "", None, "a", 0)], docs.schema)
    for start in (odd, docs.limit(0)):
        docs = start
        for _, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, SF), "test-empty")
        assert docs.count() == 0
