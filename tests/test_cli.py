"""The command line drives build -> gold -> append -> export end to end."""

import os

from augur.__main__ import main
from conftest import FIXTURES


def test_cli_end_to_end(spark, tmp_path):
    model, gold = str(tmp_path / "model"), str(tmp_path / "gold")
    f = os.path.join(FIXTURES, "survey_forecasts.csv")
    built = main(["build", "--forecasts", f, "--demographics", os.path.join(FIXTURES, "survey_forecasters.csv"),
                  "--tags", os.path.join(FIXTURES, "survey_tags.csv"), "--out", model])
    assert built["fct_forecasts"] == 18
    assert main(["gold", "--model", model, "--out", gold])["question_summary"] == 3
    assert main(["append", "--forecasts", f, "--model", model]) == {"appended": 0, "replaced": 0, "forecasters": 0, "waiting": 1}
    main(["export", "--gold", gold, "--table", "question_summary", "--out", str(tmp_path / "qs.json")])
    assert spark.read.json(str(tmp_path / "qs.json")).count() == 3
