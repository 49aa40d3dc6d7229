"""End-to-end phases through the command line (features -> train -> predict -> report)."""

import json

from dockflow.cli import main
from dockflow.session import scratch_path
from dockflow.sources.tables import readings

from .conftest import SF_CHECK


def test_phases_end_to_end(spark, capsys):
    base = scratch_path(spark, "t-cli")
    readings(spark, SF_CHECK).drop("reading_id").write.parquet(f"{base}/readings")
    steps = [
        ["features", "--readings", f"{base}/readings", "--out", f"{base}/f"],
        ["tune", "--features", f"{base}/f/features", "--model", "ridge", "--trials", "1", "--out", f"{base}/t"],
        ["tune", "--features", f"{base}/f/features", "--model", "ridge", "--trials", "2", "--out", f"{base}/t"],
        ["train", "--features", f"{base}/f/features", "--models", "baseline,ridge", "--params", f"{base}/t/best", "--out", f"{base}/m"],
        ["predict", "--features", f"{base}/f/features", "--model", f"{base}/m/best_model", "--out", f"{base}/p"],
        ["report", "--predictions", f"{base}/p", "--results", f"{base}/m/results",
         "--importance", f"{base}/m/importance", "--out", f"{base}/k"],
    ]
    outs = []
    for s in steps:
        assert main(["--master", "local[4]", *s]) == 0
        outs.append(json.loads(capsys.readouterr().out.strip().splitlines()[-1]))
    assert outs[0]["lookup_sizes"]["level2"] > 0
    from dockflow.ml.models import read_trials
    assert sorted(r.trial for r in read_trials(spark, f"{base}/t/trials").collect()) == [0, 1]     # the second call ran trial 1 only
    assert outs[3]["best"] in ("Baseline (moyenne)", "ridge")
    assert outs[5]["rows"] >= 3 + 12 + 4 - 1
    sections = {r.section for r in spark.read.parquet(f"{base}/k").collect()}
    assert {"benchmark", "fill_rate", "error_histogram"} <= sections


def test_release_tables(spark):
    from dockflow.session import materialize, path_exists, release_tables, _WRITTEN
    df = materialize(spark.range(10), "t-release")
    path = _WRITTEN[-1]
    assert df.count() == 10 and path_exists(spark, path)
    assert release_tables(spark) >= 1
    assert not path_exists(spark, path)
