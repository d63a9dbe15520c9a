from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline


def test_stages_hand_python_small_batches_of_texts(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("ab c "), 1000).alias("text")).coalesce(1)
    kept = "spark.sql.execution.arrow.maxBytesPerBatch"
    old = spark.conf.get(kept)
    for stage in (corpus_pipeline.quality, corpus_pipeline.near_dedup, corpus_pipeline.packing):
        spark.conf.unset(kept)
        try:
            stage(spark, docs, "")
            sizes = docs.mapInArrow(
                lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"]) for b in batches), "n long"
            )
            assert sizes.agg(F.max("n")).first()[0] < 6 << 20
        finally:
            spark.conf.set(kept, old)
