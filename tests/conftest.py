import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}{os.pathsep}{ROOT}/tests{os.pathsep}{os.environ.get('PYTHONPATH', '')}"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    made = tmp_path_factory.mktemp("spark")
    conf = {
        "spark.master": "local[4]",
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": "4g",
        "spark.local.dir": str(made / "local"),
        "spark.sql.warehouse.dir": str(made / "warehouse"),
        "spark.checkpoint.dir": f"file://{made / 'shared'}",
    }
    session = SparkSession.builder.config(map=conf).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
