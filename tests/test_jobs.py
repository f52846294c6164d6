"""End to end: training, forecasting, the model store, the command line, the stream and the catalog."""

import json
import sys
from types import ModuleType

import duckdb
import pytest

from weftline import cli
from weftline.operators.boosting import Coding, Trees
from weftline.operators.factors import FilterConfig
from weftline.plans import catalog, panel
from weftline.plans.jobs import ForecastConfig, TrainConfig, run_forecast, run_train
from weftline.sources import files, model_store, plots
from weftline.streaming.factor_stream import stream_states

SMALL = "/root/testdata/sf0.001"


def test_train_then_forecast(spark, tmp_path):
    rows = panel.weekly(spark, SMALL).where("sku_id IN ('Brand#11', 'Brand#12', 'Brand#1', 'Brand#2')")
    rows.write.parquet(str(tmp_path / "weekly"))
    paths = {"data_path": str(tmp_path / "weekly"), "model_dir": str(tmp_path / "m"), "factor_dir": str(tmp_path / "f"), "use_factors": True}
    meta = run_train(spark, TrainConfig(**paths, use_search=False, params={"rounds": 2}, val_weeks=30, test_weeks=4))
    assert meta["n_train"] > 0 and "seasonal_factor" in meta["feature_cols"] and not any(c.startswith("qty_growth") for c in meta["feature_cols"])
    assert json.loads((tmp_path / "f" / "seasonal.json").read_text())["states"]
    out = run_forecast(spark, ForecastConfig(**paths, output_path=str(tmp_path / "out"), horizons=(1, 2)))
    assert out.columns == ["sku_id", "branch_id", "week", "horizon", "forecast_units", "scenario"]
    counts = {(r.scenario, r.horizon): r["count"] for r in out.groupBy("scenario", "horizon").count().collect()}
    assert set(counts) == {(s, h) for s in "AB" for h in (1, 2)} and len(set(counts.values())) == 1
    assert out.where("forecast_units < 0").isEmpty()


def test_model_store(spark, tmp_path):
    base = f"file://{tmp_path}/store"
    with pytest.raises(FileNotFoundError):
        model_store.latest(base)
    for i in range(10):
        model = Trees(Coding(["a"], [], [[0.5]], {}), float(i), 1)
        model_store.save_model(model, {"n": i}, base, f"v{i:02d}")
    assert model_store.rotate(base, 8) == ["v00", "v01"]
    assert model_store.load_latest(base).base == 9.0 and model_store.load_metadata(base)["n"] == 9
    assert files.folders(base) == [f"v{i:02d}" for i in range(2, 10)]


def test_command_line(capsys):
    assert cli.main([]) == 1
    args = cli.parser().parse_args(["forecast", "--horizons", "1", "3", "--scenarios", "A", "--no-use-growth"])
    assert args.horizons == [1, 3] and args.scenarios == ["A"] and not args.use_growth


def test_stream_of_observations(spark, tmp_path):
    schema = "key string, units double, pred_base double"
    for i in range(2):
        spark.createDataFrame([("a", 120.0, 100.0), ("b", 1.0, 0.0)], schema).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    q = stream_states(source).writeStream.outputMode("update").format("memory").queryName("states").option("checkpointLocation", str(tmp_path / "ck")).start()
    q.processAllAvailable()
    q.stop()
    got = {(r.key, r.updates): r.x for r in spark.table("states").collect()}
    cfg = FilterConfig()
    gain = cfg.initial_p / (cfg.initial_p + cfg.measurement_noise)
    assert got["a", 1] == pytest.approx(1 + gain * 0.2) and got["a", 2] > got["a", 1] and got["b", 0] == 1.0


@pytest.mark.parametrize("name", ["promo_depth", "weekly_lag_features", "stockout_impute", "daily_to_weekly", "promo_depth_curve", "kalman_fold", "rollout_blend_model", "validated_panel", "feature_projection", "profile_z_scores", "holiday_file", "forecast_sink", "factor_store", "model_versions"])
def test_queries_match_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("lineitem", "part", "supplier", "nation", "region", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    got, expected = catalog.queries()[name](spark, SMALL).toPandas(), con.sql(catalog.oracle_sql()[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(expected.columns)
    tidy = lambda x: x[columns].astype({c: float for c in columns if x[c].dtype.kind in "fiu"}).sort_values(columns).reset_index(drop=True).fillna(-1e9)
    assert tidy(got).equals(tidy(expected))


def test_filters_and_columns_reach_the_scan(spark):
    plan = panel.weekly(spark, SMALL).select("week", "units")._jdf.queryExecution().executedPlan().toString()
    assert "l_tax" not in plan and "l_linenumber" not in plan


class _Figure:
    """What the sinks use of a figure; savefig writes the calls."""

    def __init__(self, **_):
        self.calls = []

    def add_subplot(self):
        return self

    def barh(self, names, values):
        self.calls.append(list(zip(names, values, strict=True)))

    def plot(self, x, y, marker):
        self.calls.append(list(zip(x, y, strict=True)))

    def set_xlabel(self, name):
        pass

    set_ylabel = set_xlabel

    def savefig(self, out, format, dpi):  # noqa: A002
        out.write(json.dumps(self.calls).encode())


def test_figures_are_written_in_order(spark, tmp_path, monkeypatch):
    figure = ModuleType("matplotlib.figure")
    figure.Figure = _Figure
    monkeypatch.setitem(sys.modules, "matplotlib", ModuleType("matplotlib"))
    monkeypatch.setitem(sys.modules, "matplotlib.figure", figure)
    read = lambda p: json.loads(files.read_text(p))
    summary = spark.createDataFrame([("a", 2.0, 1.0), ("b", 1.0, 1.0), ("c", 2.0, 0.0)], "feature string, mean_abs_shap double, mean_shap double")
    assert read(plots.shap_png(summary, f"{tmp_path}/s.png")) == [[["b", 1.0], ["c", 2.0], ["a", 2.0]]]
    row = spark.createDataFrame([("a", 0.5), ("b", -2.0)], "feature string, shap double")
    assert read(plots.row_shap_png(row, f"{tmp_path}/r.png")) == [[["a", 0.5], ["b", -2.0]]]
    table = spark.createDataFrame([(2.0, 5.0), (1.0, 4.0)], "grid double, prediction double")
    assert read(plots.pdp_png(table, "a", f"{tmp_path}/p.png")) == [[[1.0, 4.0], [2.0, 5.0]]]
    assert plots.pdp_png(table.limit(0), "a", f"{tmp_path}/e.png")


def test_figures_name_what_is_missing(spark, tmp_path, monkeypatch):
    monkeypatch.setitem(sys.modules, "matplotlib.figure", None)
    with pytest.raises(RuntimeError, match="matplotlib"):
        plots.pdp_png(spark.createDataFrame([(1.0, 1.0)], "grid double, prediction double"), "a", f"{tmp_path}/p.png")
