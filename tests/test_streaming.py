from meterline.plans.landing import uniform
from meterline.sinks.months import append_month
from meterline.streaming.arrivals import arriving_trips, load_arrivals


def test_each_file_is_loaded_once(spark, raw, tmp_path):
    landed, out, checkpoint = (str(tmp_path / name) for name in ("landed", "out", "checkpoint"))

    def run():
        load_arrivals(arriving_trips(spark, landed, files_per_batch=1), out, checkpoint, 2024).awaitTermination()
        return spark.read.parquet(out).count()

    append_month(uniform(raw({}, {}, {"VendorID": None})), landed, ("2024", "03"))
    assert run() == 2
    assert run() == 2
    later = raw({"fare_amount": 3.0}).withColumnRenamed("airport_fee", "Airport_fee").drop("cbd_congestion_fee")
    append_month(uniform(later), landed, ("2024", "04"))
    assert run() == 3
