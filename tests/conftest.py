import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from latewatch.session import build_session

    session = build_session(
        "tests",
        "local[8]",
        8,
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def stored(spark, tmp_path_factory):
    """Ingested incidents over the small event table: (folder, row accounts)."""
    from latewatch.plans.jobs import ingest
    from latewatch.sources.incidents import incident_records
    from latewatch.sources.readers import read_records

    folder = str(tmp_path_factory.mktemp("stored"))
    incident_records(spark, SMALL).write.csv(
        f"{folder}/raw.csv", header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
    accounts = ingest(read_records(spark, f"{folder}/missing.csv", f"{folder}/raw.csv"), folder, ["year"], 50)
    return folder, accounts


@pytest.fixture(scope="session")
def incidents(spark, stored):
    return spark.read.parquet(f"{stored[0]}/incidents.parquet")
