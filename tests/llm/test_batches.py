from gleaner.llm import token_output
from gleaner.llm.common import small_batches
from gleaner.session import stage_path

ROWS, BYTES = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"


def test_the_training_order_is_written_in_small_batches(spark, monkeypatch):
    seen, stage = [], token_output.stage

    def watched(*args):
        seen.append((int(spark.conf.get(ROWS)), int(spark.conf.get(BYTES).rstrip("b"))))
        return stage(*args)

    monkeypatch.setattr(token_output, "stage", watched)
    before = spark.conf.get(ROWS), spark.conf.get(BYTES)
    docs = spark.createDataFrame([(i, f"some words {i} " * i) for i in range(40)], "doc_id bigint, text string")
    path = stage_path(spark, "order")
    n = token_output.write_training_order(docs, path, length=64, per_shard=4)
    with small_batches(spark, size=200):
        records = token_output.read_training_order(spark, path, length=64, per_shard=4).collect()
    assert sorted(r.slot for r in records) == list(range(n)) and n > 8
    assert seen == [(1000, token_output.BATCH_BYTES)] and (spark.conf.get(ROWS), spark.conf.get(BYTES)) == before
