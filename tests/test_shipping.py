"""Kernels must run on executors that have no copy of this package."""

import os
import pathlib
import subprocess
import sys

ROOT = str(pathlib.Path(__file__).resolve().parents[1])
SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
from shelfline.session import build_session
from shelfline.operators import forecast, timeseries
spark = build_session("elsewhere", 2, 2)
daily = spark.sql("SELECT 's' AS product_id, date_add(DATE '2023-01-01', CAST(id AS INT)) AS date, 100 + 10 * sin(id * 0.9) AS quantity FROM range(120)")
print(forecast.quantile_forecast(daily, 5).count(), timeseries.adf_test(daily).count(), forecast.arima_benchmark(daily).count())
"""


def test_kernels_travel_with_the_job(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240)
    assert done.stdout.split()[-3:] == ["5", "1", "1"], done.stderr[-2000:]
