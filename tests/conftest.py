import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def town(spark):
    from small_inputs import town_catalog

    return town_catalog(spark)


@pytest.fixture()
def write(tmp_path):
    """Write named transfer texts into a fresh folder and return its path."""

    def _write(**texts):
        folder = tmp_path / f"in{len(list(tmp_path.iterdir()))}"
        folder.mkdir()
        for name, text in texts.items():
            (folder / f"{name}.xml").write_text(text, encoding="utf-8")
        return str(folder)

    return _write
