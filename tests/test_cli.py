"""The command line over landed page files."""

import json
import os

from eventstar.__main__ import main
from eventstar.session import scratch_path
from eventstar.sources.fixture import fixture_pages
from tests.conftest import SF_SMALL


def test_cli_run_query_counts(spark, capsys):
    root = scratch_path(spark, "cli")
    landing, wh = os.path.join(root, "landing"), os.path.join(root, "wh")
    fixture_pages(spark, SF_SMALL).select("value").coalesce(2).write.text(landing)
    common = ["--warehouse", wh, "--shuffle-partitions", "4"]
    main(["run", "--landing", landing, "--end-time", "2024-02-01T00:00:00",
          "--lookback-days", "40", *common])
    run = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert run["ingestion"]["events_loaded"] == run["transformations"]["raw_events"] > 0
    main(["query", "--report", "q1", *common])
    q1 = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert sum(r["event_count"] for r in q1) == run["transformations"]["fact_events"]
    main(["counts", *common])
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1]) == run["transformations"]
