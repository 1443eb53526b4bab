from pyspark.sql import functions as F

from support import SF_SMALL
from docloom.sources import fixtures as fx
from docloom.sources.landing import read_landed, write_landed
from docloom.streaming import ingested, start_ingest


def test_incremental_ingest_exactly_once(spark, scratch):
    land, out, ck = f"{scratch}/landing", f"{scratch}/raw", f"{scratch}/ckpt"
    docs = fx.day_docs(spark, SF_SMALL)
    first = docs.where(F.col("date") < "19970101")
    write_landed(first, land, ["date"], bucket=("month", F.substring("date", 1, 6)))
    assert read_landed(spark, land, "scoreboard", ["date"], "month").count() == first.count()

    def run():
        start_ingest(spark, land, "scoreboard", ["date"], out, checkpoint=ck).awaitTermination()
        return ingested(spark, out, "scoreboard")

    assert run().count() == first.count()
    assert run().count() == first.count()            # nothing new -> nothing added
    one = docs.where(F.col("date") >= "19970101").limit(1)
    write_landed(one, land, ["date"])
    t = run()
    assert t.count() == first.count() + 1
    assert t.where(F.col("doc").isNull()).count() == 0
    assert t.select("request_date").distinct().count() == t.count()


def test_malformed_landed_line_keeps_row(spark, scratch):
    land = f"{scratch}/landing"
    spark.createDataFrame([('{"ctx":{"date":"1"},"body":{"a":1}}', "x"), ("garbage", "x")],
                          "value string, resource string") \
        .write.partitionBy("resource").text(land)
    got = read_landed(spark, land, "x", ["date"]).collect()
    assert sorted(((r.date or ""), r.doc is None) for r in got) == [("", True), ("1", False)]
