"""spark-submit entry point for the daily run.

    spark-submit --py-files signalmart.zip jobs/daily_run.py build \\
        --flights s3://.../raw/flights --weather s3://.../raw/weather \\
        --events s3://.../seeds/events.csv --holidays s3://.../seeds/holidays.csv \\
        --out s3://.../warehouse
    spark-submit --py-files signalmart.zip jobs/daily_run.py update --flights s3://.../raw/flights ... --out s3://.../warehouse
    spark-submit --py-files signalmart.zip jobs/daily_run.py check --out s3://.../warehouse
    spark-submit --py-files signalmart.zip jobs/daily_run.py alert --out s3://.../warehouse

The master, executors and spark.checkpoint.dir come from spark-submit; the
session helper does not override them.
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from signalmart.__main__ import main  # noqa: E402

if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
