"""Operators run on executors that can't import this package: their functions travel by value."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

from tests.llm import helpers as h

REPOSITORY = Path(__file__).resolve().parents[2]
SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
spark = (
    SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4")
    .config("spark.ui.enabled", "false").config("spark.driver.memory", "4g").getOrCreate()
)
spark.sparkContext.setLogLevel("OFF")
import __spark_entry__ as entry
queries = entry.queries()
for number in sys.argv[3:]:
    name = next(q for q in queries if q.startswith(f"op{number}_"))
    try:
        queries[name](spark, sys.argv[2]).write.format("noop").mode("overwrite").save()
        print("DONE", number)
    except Exception as error:
        print("FAILED", name, *[line for line in str(error).splitlines() if "Error" in line][-1:])
"""


@pytest.mark.parametrize("numbers", [["1", "4", "5", "7", "8"], ["10", "11", "12", "13"], ["6"]])
def test_functions_travel_by_value(tmp_path, numbers):
    # Workers start in the folder of the driver's process, so it must be another one than the repository.
    public = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    command = [sys.executable, "-c", SCRIPT, str(REPOSITORY), h.SMALL, *numbers]
    said = subprocess.run(command, cwd=tmp_path, env=public, capture_output=True, text=True, timeout=600)
    lines = [line for line in said.stdout.splitlines() if line.startswith(("DONE", "FAILED"))]
    assert lines == [f"DONE {n}" for n in numbers], said.stderr[-500:]
