import datetime

from holdfast.streaming import runlog


def test_stream_equals_table(spark, tmp_path):
    at = lambda h, m: datetime.datetime(2024, 1, 1, h, m)
    log = spark.createDataFrame([(at(0, 5), "error"), (at(0, 50), "error"), (at(1, 1), "done"), (at(9, 0), "done")], "ts timestamp, event_type string")
    log.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(log.schema).parquet(f"{tmp_path}/in")
    query = runlog.windowed_counters(stream).writeStream.format("memory").queryName("counters").outputMode("complete").option("checkpointLocation", f"{tmp_path}/c").start()
    query.processAllAvailable()
    query.stop()
    assert sorted(map(tuple, spark.table("counters").collect())) == sorted(map(tuple, runlog.windowed_counters(log).collect()))
