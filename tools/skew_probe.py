"""Measure what the freshest-wins dedupe shuffles when one key holds a third
of all rows. Spark's event log goes to a fresh scratch folder and the
per-stage shuffle metrics are read back from it.

    python tools/skew_probe.py [rows]
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def stage_metrics(log_dir: str) -> list[dict]:
    import zstandard
    out = []
    for f in glob.glob(f"{log_dir}/*/events_*") + glob.glob(f"{log_dir}/*/*.inprogress"):
        raw = open(f, "rb").read()
        text = (zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read().decode()
                if f.endswith(".zstd") else raw.decode())
        for line in io.StringIO(text):
            e = json.loads(line)
            if e.get("Event") == "SparkListenerStageCompleted":
                info = e["Stage Info"]
                acc = {a["Name"]: a.get("Value") for a in info.get("Accumulables", [])}
                out.append({"stage": info["Stage ID"], "tasks": info["Number of Tasks"],
                            "shuffle_records_written":
                                acc.get("internal.metrics.shuffle.write.recordsWritten"),
                            "shuffle_records_read":
                                acc.get("internal.metrics.shuffle.read.recordsRead")})
    return sorted(out, key=lambda r: r["stage"])


def main(n: int) -> None:
    from pyspark.sql import functions as F
    from signalmart.operators.dedupe import latest_per_key
    from signalmart.session import get_spark
    log_dir = tempfile.mkdtemp(prefix="signalmart-evlog-")
    spark = get_spark("local[8]", shuffle_partitions=16,
                      extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir})
    src = spark.range(n, numPartitions=16).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("extracted"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"))
    kept = latest_per_key(src, ["k"], ["extracted"]).count()
    spark.stop()
    print(json.dumps({"input_rows": n, "hot_key_rows": (n + 2) // 3, "rows_kept": kept,
                      "stages": stage_metrics(log_dir)}, indent=1))


if __name__ == "__main__":
    main(int(sys.argv[1]) if len(sys.argv) > 1 else 3_000_000)
