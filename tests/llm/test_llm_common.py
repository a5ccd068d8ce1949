import pyarrow as pa
from pyspark.sql import functions as F

from skytally.llm.common import arrow_map


def test_wide_rows_go_to_python_in_batches_bounded_in_bytes(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"rows": [batch.num_rows], "size": [batch.nbytes]})

    texts = spark.range(4000, numPartitions=1).select(F.repeat(F.lit("word "), 800).alias("text"))
    texts = texts.unionByName(spark.range(1).select(F.repeat(F.lit("word "), 2_000_000).alias("text")))
    found = arrow_map(texts.coalesce(1), sizes, "rows long, size long").collect()
    assert sum(r.rows for r in found) == 4001
    size = sorted(r.size for r in found)
    assert len(size) > 3 and size[-2] < 5_000_000  # a text that is longer stays whole
