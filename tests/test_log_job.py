"""The log job: one pass, replays, state over batches."""

import json

from pyspark.sql import functions as F

from rtdw.operators import logs
from rtdw.sources import bindings as B
from rtdw.streaming.log_job import LogJob

SF = "/root/testdata/sf0.001"


def test_fan_out_is_one_pass_and_equals_the_split(spark):
    log = B.log_records(spark, SF)
    tagged = logs.route_tag(log)
    assert tagged._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    got = sorted(map(tuple, tagged.select("topic", "value").collect()))
    want = []
    body = {"common", "page", "start", "err", "displays", "actions", "ts", "display", "action"}
    for topic, df in logs.split(log).items():
        want += [(topic, r[0]) for r in df.select(F.to_json(F.struct(*[c for c in df.columns if c in body]))).collect()]
    assert got == sorted(want)


def test_lines_over_batches(spark, tmp_path):
    day = 86_400_000
    line = lambda mid, new, ts, **more: json.dumps({"common": {"mid": mid, "is_new": new}, "ts": ts, **more})
    page = {"page_id": "home"}
    batches = [
        [line("a", "1", 5 * day, page=page), "{broken", line("a", "1", 6 * day, page=page, displays=[{"pos_id": "1"}, {"pos_id": "2"}])],
        [line("a", "1", 7 * day, start={"entry": "icon"}, err={"error_code": "9"}), line("b", "0", 7 * day, page=page, actions=[]), "null"],
        [line("b", "1", 8 * day, page=page), line(None, "1", 8 * day, page=page), "[1]"],
    ]
    job = LogJob(spark, str(tmp_path), buckets=2)
    make = lambda rows: spark.createDataFrame(list(enumerate(rows)), "seq int, value string")
    for n, rows in enumerate(batches):
        for _ in range(2):
            job.write(make(rows), n)
    out = spark.read.json(f"{tmp_path}/out", schema="value string").collect()
    new = lambda t: sorted((r["batch"], json.loads(r["value"])["common"].get("is_new")) for r in out if r["topic"] == t)
    assert new("page") == [(0, "0"), (0, "1"), (1, "0"), (2, "0"), (2, "1")]
    assert new("display") == [(0, "0"), (0, "0")] and new("start") == [(1, "0")] and new("err") == [(1, "0")]
    assert sorted(r["value"] for r in out if r["topic"] == "dirty") == ["[1]", "null", "{broken"]
    starts = [json.loads(r["value"]) for r in out if r["topic"] == "start"]
    assert "err" not in starts[0] and "err" in json.loads([r["value"] for r in out if r["topic"] == "err"][0])
    assert [r["value"] for r in out if r["topic"] == "page" and r["batch"] == 1 and '"actions":[]' in r["value"]]
