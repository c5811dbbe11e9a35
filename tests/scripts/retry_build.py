"""Build the same index twice in one process: once cleanly, once with the
first attempt of one ingest task failing (a task that reads shuffle output,
so its retry re-fetches it).  Prints both manifests as JSON; they must be
equal.  The failing attempt leaves a marker file, so the test knows the
failure really happened.

Run in its own process: task retries need a ``local[N,F]`` master."""

import json
import sys

sys.path.insert(0, sys.argv[1])

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from shardsmith.operators.documents import documents_from_table  # noqa: E402
from shardsmith.plans.build import IndexSpec, build_index, read_manifest  # noqa: E402
from shardsmith.session import get_spark, shared_dir  # noqa: E402

spark = get_spark("local[4,3]", app="retry-test", **{"spark.sql.shuffle.partitions": "4"})
spark.sparkContext.setLogLevel("OFF")


MARKER = sys.argv[3]


@F.udf("string")
def flaky(s):
    ctx = TaskContext.get()
    if ctx.attemptNumber() == 0 and ctx.partitionId() == 0:
        open(MARKER, "w").close()
        raise RuntimeError("injected task failure")
    return s


def manifest(dest):
    rows = read_manifest(spark, dest, "ev").orderBy("shard").collect()
    return [(r.shard, r.docs, r.bytes, r.min_id, r.max_id, r.checksum) for r in rows]


ev = spark.read.parquet(sys.argv[2] + "/events.parquet").repartition(4, "event_id")
spec = IndexSpec("ev", 8, target_file_bytes=20_000)  # several write tasks per shard
clean = shared_dir(spark, "tests", "retry", unique=True)
build_index(spark, documents_from_table(ev, "event_id", routing_col="user_id"), clean, spec)

docs = documents_from_table(ev, "event_id", routing_col="user_id").withColumn("_source", flaky("_source"))
faulty = shared_dir(spark, "tests", "retry", unique=True)
build_index(spark, docs, faulty, spec)
print(json.dumps({"clean": manifest(clean), "faulty": manifest(faulty)}))
