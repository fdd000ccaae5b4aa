"""A stream gives what the table gives."""

from pyspark.sql import functions as F

from orogen.operators import ml
from orogen.plans.inputs import features
from orogen.streaming import scoring


def test_scores(spark, data, tmp_path):
    df = features(spark, data)
    model = ml.fit(df, ml.Training("label", ["f0", "f1"], "vec_id", trees=2, depth=2))
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = scoring.table_stream(spark, str(tmp_path / "in"), df.schema, files_per_batch=1)
    scoring.write_table(scoring.scored(stream, model, ["f0", "f1"]).drop("top_classes"), str(tmp_path / "out"), str(tmp_path / "cp"), once=True).awaitTermination()
    got = {r[0]: r[1] for r in spark.read.parquet(str(tmp_path / "out")).select("vec_id", "pred_label").collect()}
    assert got == {r[0]: r[1] for r in ml.predict(model, df, ["f0", "f1"]).select("vec_id", "pred_label").collect()}


def test_counts(spark, data, tmp_path):
    events = spark.read.parquet(f"{data}/events.parquet").select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    events.repartition(2).write.parquet(str(tmp_path / "in"))
    stream = scoring.table_stream(spark, str(tmp_path / "in"), events.schema)
    query = scoring.counts_by_time(stream, "ts", "event_type", "1 day", "365 days").writeStream.format("memory").queryName("per_day").outputMode("complete").start()
    query.processAllAvailable()
    query.stop()
    want = events.groupBy(F.date_trunc("day", "ts").alias("start"), "event_type").count()
    assert sorted(map(tuple, spark.table("per_day").collect())) == sorted(map(tuple, want.collect()))
