import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tillroll.llm.common import map_batches, stored

LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def sizes(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["rows", "bytes"])


def test_large_rows_come_in_small_batches(spark):
    before = spark.conf.get(LIMIT)
    rows = spark.range(0, 60, 1, 1).select(F.repeat(F.lit("x"), 1 << 20).alias("text"))
    found = stored(map_batches(rows, sizes, "rows long, bytes long"), "sizes").collect()
    assert sum(r.rows for r in found) == 60
    assert max(r.bytes for r in found) < 12 << 20
    assert spark.conf.get(LIMIT) == before


def test_settings_come_back_if_the_write_fails(spark):
    before = spark.conf.get(LIMIT)
    with pytest.raises(Exception, match="no such luck"):
        stored(spark.range(3).select(F.raise_error(F.lit("no such luck")).alias("x")), "broken")
    assert spark.conf.get(LIMIT) == before
