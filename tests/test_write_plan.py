"""The plans that writes run, read from Spark's event log (a session of its
own, since a log is chosen when a session starts): no sort, no merge into one
task, no Python."""

import glob
import json
import os
import subprocess
import sys

from conftest import ROOT, SF001

JOB = """
import sys
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
         .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", sys.argv[1]).config("spark.eventLog.compress", "false")
         .config("spark.eventLog.rolling.enabled", "false").config("spark.checkpoint.dir", sys.argv[1] + "-shared").getOrCreate())
import __spark_entry__ as entry
for name in sys.argv[3:]:
    entry.QUERIES[name](spark, sys.argv[2])
spark.stop()
"""


def nodes(plan):
    """The nodes above the first exchange, aggregate or cached input: what the write adds."""
    name = plan["nodeName"]
    yield name
    if not any(x in name for x in ("Exchange", "Aggregate", "InMemoryTableScan", "QueryStage")):
        for child in plan["children"]:
            yield from nodes(child)


def test_dated_writes_neither_sort_nor_merge(tmp_path):
    logs = tmp_path / "log"
    logs.mkdir()
    names = ["stage_roundtrip", "snapshot_overwrite", "publish_fact", "publish_users"]
    subprocess.run([sys.executable, "-c", JOB, str(logs), SF001, *names], check=True, cwd=ROOT, env=os.environ | {"PYTHONPATH": ROOT}, timeout=600,
                   capture_output=True)
    plans = {}
    for path in glob.glob(f"{logs}/*"):
        for line in open(path):
            event = json.loads(line)
            if "sparkPlanInfo" in event:
                plans[event["executionId"]] = (list(nodes(event["sparkPlanInfo"])), event.get("physicalPlanDescription", ""))
    writes = [(n, text) for n, text in plans.values() if any("InsertIntoHadoopFs" in x for x in n)]
    assert len(writes) >= 6
    for n, text in writes:
        assert not [x for x in n if x in ("Sort", "Coalesce")], text
