from pyspark.sql import functions as F

from quarry.session import fresh_dir
from quarry.sources.tables import read_table
from quarry.sources.versioned import VersionedTable
from quarry.streaming.events import append_stream, stream_source

from conftest import SF_SMALL


def test_stream_append_is_idempotent_per_checkpoint(spark):
    root = fresh_dir(spark, "stream_test")
    schema = read_table(spark, SF_SMALL, "events").schema
    table = VersionedTable(spark, root, "raw_events")
    ckpt = f"{root}/_ckpt"
    append_stream(stream_source(spark, f"{SF_SMALL}/events.parquet", schema), table, ckpt).awaitTermination()
    table.refresh()
    first = table.read().count()
    assert first == read_table(spark, SF_SMALL, "events").count()
    # same checkpoint, no new files: nothing is appended again
    append_stream(stream_source(spark, f"{SF_SMALL}/events.parquet", schema), table, ckpt).awaitTermination()
    table.refresh()
    assert table.read().count() == first
    assert table.read().where(F.col("_layer") == "raw").count() == first
