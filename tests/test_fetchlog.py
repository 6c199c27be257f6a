import json

from pyspark.sql import functions as F

from webloom.functions import fetchlog


def message(**params):
    return json.dumps({"message": {"params": params}})


CASES = [
    (message(response={"headersText": "HTTP/1.1 301 Moved\r\nX: y", "status": 200}), 301, None),
    (message(response={"headers": {"status": "404"}}), 404, 404),
    (message(redirectResponse={"headersText": "HTTP/1.1 302 Found"}), 302, None),
    (message(redirectResponse={"headers": {"status": "307"}}), 307, None),
    (message(response={"status": 200}), 200, None),
    (message(response={"headersText": "", "headers": {"status": "500\nrest"}}), 500, 500),
    (message(request={}), 200, None),
    (message(response={"headersText": "HTTP/1.1 abc"}), None, None),
]


def test_status(spark):
    df = spark.createDataFrame([(m,) for m, _, _ in CASES], "m string")
    got = df.select("m", fetchlog.status(F.col("m")), fetchlog.header_status(F.col("m"))).collect()
    assert [tuple(r) for r in got] == CASES


def test_response_entry(spark):
    log = spark.createDataFrame([("u", i, str(i)) for i in range(6)], "url string, log_idx int, message string")
    assert [r.message for r in fetchlog.response_entries(log).collect()] == ["3"]
