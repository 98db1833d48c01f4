import os
import subprocess
import sys

import pytest

from loanlens import SourceLayout, load_all, run_explain, run_full, run_score
from loanlens.__main__ import config, main, parser
from loanlens.config import Config, TrainingProfile
from loanlens.sources.tables import VIEW_CONFIG, loan_sources


def test_all_jobs_from_files_to_scores(spark, sf, tmp_path):
    """The tables written out as the files of a lender, then read, trained and scored."""
    src = loan_sources(spark, sf)
    dates = VIEW_CONFIG.early_snapshots + VIEW_CONFIG.late_snapshots
    for date in dates:
        one = src.credit.filter(f"SNAPSHOT_DATE = '{date}'").drop("SNAPSHOT_DATE")
        one.write.option("header", True).csv(str(tmp_path / "credit" / f"{date}.csv"))
    sheets = {}
    for name, df in src.demographics.items():
        sheets[name] = str(tmp_path / f"{name}.csv")
        df.drop("_ingest_order").write.option("header", True).csv(sheets[name])
    nps = str(tmp_path / "nps.csv")
    src.nps.select("LOAN_ID", "nps_score", "phone_locked").write.option("header", True).csv(nps)
    cfg = Config(
        snapshot_files=tuple((f"{d}.csv", d) for d in dates),
        early_snapshots=VIEW_CONFIG.early_snapshots,
        cv_folds=2,
        candidates=("logistic", "forest"),
        profile=TrainingProfile(forest_trees=4, max_bins=16),
    )
    sources = load_all(spark, SourceLayout(str(tmp_path / "credit"), sheets, nps), cfg)
    out = str(tmp_path / "out")
    result = run_full(sources, out, cfg)
    n = result.scores.count()
    assert n > 0 and result.metrics.first().n_test > 0
    assert sum(r["count"] for r in result.bands.collect()) == n
    assert result.report.count() == 5 and result.attribution.count() == len(result.training.features)
    assert result.dropped.first().n_dropped == 0
    for name in ("roc_curve", "pr_curve", "ks_curve", "calibration", "pd_histogram", "importances"):
        assert spark.read.parquet(f"{out}/{name}").count() > 0, name
    written = spark.read.option("header", True).csv(f"{out}/portfolio_scores")
    assert written.columns == ["LOAN_ID", "pd", "score", "risk_band"] and written.count() == n
    again = run_score(spark, sources, f"{out}/model", f"{out}/again", cfg)
    assert again.exceptAll(result.scores).count() == 0
    assert run_explain(spark, sources, f"{out}/model", cfg).count() == n


def test_command_line(spark, sf, tmp_path):
    src = loan_sources(spark, sf)
    date = VIEW_CONFIG.early_snapshots[0]
    one = src.credit.filter(f"SNAPSHOT_DATE = '{date}'").drop("SNAPSHOT_DATE")
    one.write.option("header", True).csv(str(tmp_path / "credit" / "a.csv"))
    shared = ["--credit", str(tmp_path / "credit"), "--out", str(tmp_path / "out")]
    shared += ["--snapshot", f"a.csv={date}", "--early", date, "--target", "par30"]
    args = parser().parse_args(["train", *shared])
    cfg = config(args).with_(
        cv_folds=2, candidates=("logistic",), profile=TrainingProfile(logistic_iterations=20)
    )
    assert (cfg.target_definition, cfg.snapshot_files) == ("par30", (("a.csv", date),))
    main(["train", *shared], cfg)
    with pytest.raises(SystemExit):
        main(["score", *shared], cfg)
    main(["explain", *shared, "--model", str(tmp_path / "out" / "model")], cfg)
    assert spark.read.parquet(str(tmp_path / "out" / "explanations")).count() > 0


def test_workers_need_no_copy_of_the_package(tmp_path):
    """From another folder, without the repository on the workers' path."""
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        "import sys; sys.path.insert(0, sys.argv[1])\n"
        "from loanlens.session import local_session\n"
        "from loanlens.operators.trees import Level, _EDGE, attribution_udf\n"
        "import numpy as np\n"
        "from pyspark.sql import functions as F\n"
        "spark = local_session(1, 'elsewhere')\n"
        "inf = float('inf')\n"
        "pair = Level([0, 0], [0, 0], [-inf, 0.0], [0.0, inf], [0.5, 0.5], [-inf] * 2, [inf] * 2, [1.0] * 2, [0.0, 2.0])\n"
        "tree = [np.rec.fromarrays([np.array(c) for c in pair], dtype=_EDGE).tobytes()]\n"
        "x = F.array(F.lit(0.5))\n"
        "print('GOT', spark.range(1).select(attribution_udf([tree])(x)).first()[0])\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run(
        [sys.executable, "-c", code, repo], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300
    )
    assert "GOT [1.0]" in run.stdout, run.stderr[-2000:]
