import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture
def other_splits(spark):
    """Call it, and files read from then on are a partition each: what a change of the cores does to the splits."""
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    yield lambda: spark.conf.set(name, "1024")
    spark.conf.set(name, before)
