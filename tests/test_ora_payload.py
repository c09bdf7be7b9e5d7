"""Open-response events without a payload are dropped however the empty object is spelled."""

from mooclens.operators.logs import ora_events


def test_empty_payloads(spark, tables):
    log = tables.tracking_log
    one = log.where("event_type = 'openassessmentblock.peer_assess'").limit(1)
    from pyspark.sql import functions as F
    texts = ['{"POST": {}, "GET": {}}', '{"POST":{},"GET":{}}', ' { "GET" : { }, "POST":{} } ', '{"POST": {}, "POST": {}}', '{"POST": {"a": 1}, "GET": {}}', '{"POST": {}}', "{}"]
    rows = one.crossJoin(spark.createDataFrame([(t,) for t in texts], "text string")).withColumn("event", F.col("text")).drop("text")
    assert sorted(r.event for r in ora_events(rows).collect()) == sorted(texts[3:])
