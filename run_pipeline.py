"""Launcher for spark-submit (ship the package with --py-files):

spark-submit --py-files sensorlake.zip run_pipeline.py --events <parquet> --warehouse <shared dir>
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sensorlake.plans.pipeline import main  # noqa: E402

if __name__ == "__main__":
    main()
