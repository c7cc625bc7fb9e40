import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

FIXTURES = os.path.join(ROOT, "tests", "fixtures")
SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from augur.session import build_session

    ckpt = str(tmp_path_factory.mktemp("ckpt"))
    s = build_session(
        "augur-tests",
        "local[*]",
        8,
        {"spark.checkpoint.dir": ckpt, "spark.sql.autoBroadcastJoinThreshold": "10485760"},
    )
    yield s
    s.stop()


@pytest.fixture(scope="session")
def raw_paths():
    return {
        "raw_forecasts_export": os.path.join(FIXTURES, "survey_forecasts.csv"),
        "raw_forecaster_demographics": os.path.join(FIXTURES, "survey_forecasters.csv"),
        "raw_question_tags": os.path.join(FIXTURES, "survey_tags.csv"),
    }


@pytest.fixture(scope="session")
def raw(spark, raw_paths):
    from augur.sources.csv import load_raw

    return load_raw(spark, raw_paths)


@pytest.fixture(scope="session")
def model(spark, raw):
    from augur.plans.model import build_tables

    return {k: v.cache() for k, v in build_tables(raw).items()}
