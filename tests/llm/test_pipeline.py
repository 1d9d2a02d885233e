"""The pipeline against its stages' brute-force forms, stage by stage."""

from tests.llm import brute

TABLE_DIR = "/root/testdata/sf0.001"


def test_stages(spark, docs, benchmark, items, tmp_path):
    import corpus_pipeline as cp
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert cp.ORACLE_SQL is None and [n for n, _ in cp.STAGES] == [
        "quality rules", "near dedup", "decontamination", "mixing", "sharding"]
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for k, (name, stage) in enumerate(cp.STAGES):
        had = [(r["doc_id"], r["text"]) for r in now.select("doc_id", "text").collect()]
        out = stage(spark, now, str(tmp_path))
        out.write.parquet(f"{tmp_path}/stage{k}")
        out = spark.read.parquet(f"{tmp_path}/stage{k}")
        ids = sorted((r[0] for r in out.select("doc_id").collect()), key=repr)
        if k < 4:
            assert out.columns == docs.columns
        if name == "near dedup":
            want = {i for i, _, _, kept in brute.near_duplicates(had) if kept}
            assert set(ids) == want
        if name == "decontamination":
            bad = {i for i, _ in brute.decontaminate(had, items)}
            assert ids == sorted((i for i, _ in had if i not in bad), key=repr)
        if name == "mixing":
            assert set(ids) <= {i for i, _ in had} and max(ids.count(i) for i in ids if i is not None) <= 3
        if name == "sharding":
            assert len(ids) == len(had)
        now = out


def test_run_on_tables(spark):
    import __spark_entry__ as entry
    out = entry.queries()["pipeline"](spark, TABLE_DIR)
    assert {"doc_id", "text", "lang", "source", "n_chars", "shard", "slot"} <= set(out.columns) and out.count() > 0
