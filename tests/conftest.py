import os
import sys
import tempfile
from datetime import datetime, timedelta

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SCHEMA = ("event_id string, machine_id string, sensor_type string, value double, unit string, "
          "timestamp timestamp_ntz, ingested_at timestamp_ntz")
T0 = datetime(2024, 1, 1, 0, 0, 0)


@pytest.fixture(scope="session")
def spark():
    from sensorlake.session import local_session
    s = local_session("*", 8, app="sensorlake-tests",
                      extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="sl-wh-")})
    yield s
    s.stop()


@pytest.fixture()
def readings(spark):
    """Build a Bronze-shaped DataFrame from tuples
    (event_id, machine, sensor, value, minutes_offset[, ingest_offset_minutes])."""
    units = {"temperature": "celsius", "pressure": "bar", "vibration": "mm/s"}

    def make(rows):
        out = []
        for r in rows:
            eid, m, s, v, mins = r[:5]
            ing = r[5] if len(r) > 5 else mins + 5
            out.append((eid, m, s, v, units.get(s), T0 + timedelta(minutes=mins),
                        T0 + timedelta(minutes=ing)))
        return spark.createDataFrame(out, SCHEMA)
    return make
