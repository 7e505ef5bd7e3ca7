import json

import pytest

from tidemark.config import JobConfig
from tidemark.ml import grid
from tidemark.plans import train
from tidemark.sources import samples
from tidemark.sources.tables import Dataset, write_table
from tests.conftest import SAMPLES


def test_registry_file(spark, tmp_path):
    tables = {n: {"path": f"/data/{n}", "row_id": "seq"} for n in ("sessions", "subscriptions", "variety")}
    path = tmp_path / "tables.json"
    path.write_text(json.dumps(tables, indent=1))
    with pytest.raises(ValueError, match="demographics"):
        train.read_registry(spark, str(path))
    tables["demographics"] = {"path": "/data/d", "format": "parquet"}
    path.write_text(json.dumps(tables, indent=1))
    registry = train.read_registry(spark, str(path))
    assert registry["sessions"] == Dataset("/data/sessions", row_id="seq")
    assert registry["demographics"].format == "parquet"


def test_search_choices(spark):
    assert sum(len(s.param_maps()) for s in train.searches("full")) == 348
    assert [len(s.param_maps()) for s in train.searches("quick")] == [1, 1, 1]


def test_job_from_files(spark, tmp_path, capsys):
    folder = f"{SAMPLES}/sf0.01"
    frames = {
        "demographics": samples.demographics(spark, folder),
        "sessions": samples.play_sessions(spark, folder),
        "variety": samples.variety(spark, folder).selectExpr("*", "cast(NULL AS double) AS lpi"),
        "subscriptions": samples.subscriptions(spark, folder),
    }
    registry = {
        name: Dataset(write_table(df, str(tmp_path / name), "parquet"), format="parquet", row_id="rid" if "rid" in df.columns else None)
        for name, df in frames.items()
    }
    chosen = [grid.random_forest({"numTrees": [3]}, max_depth=3)]
    outcome = train.run(spark, registry, JobConfig(churn_threshold=730), chosen, "accuracy")
    assert outcome.best_name == "random_forest"
    row = outcome.scores.first()
    # 122 users, a fifth of each label.
    assert 23 <= row.tp + row.fp + row.fn + row.tn <= 26
    assert "best model by accuracy: random_forest" in capsys.readouterr().out
