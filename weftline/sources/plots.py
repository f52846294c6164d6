"""PNG figures of explanation tables, where matplotlib is installed. The tables have a row a feature or grid value."""

from __future__ import annotations

import io

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.sources import files


def _axes(width: float, height: float):
    try:
        from matplotlib.figure import Figure
    except ImportError as e:
        raise RuntimeError("PNG figures need matplotlib; the tables behind them do not") from e
    figure = Figure(figsize=(width, height), layout="tight")
    return figure, figure.add_subplot()


def _save(figure, path: str) -> str:
    held = io.BytesIO()
    figure.savefig(held, format="png", dpi=150)
    files.write_bytes(path, held.getvalue())
    return path


def shap_png(summary: DataFrame, path: str) -> str:
    """Bars of mean_abs_shap by feature, the greatest on top."""
    rows = summary.orderBy("mean_abs_shap", F.desc("feature")).collect()
    figure, axes = _axes(8, 1 + 0.3 * len(rows))
    axes.barh([r.feature for r in rows], [r.mean_abs_shap for r in rows])
    axes.set_xlabel("mean |SHAP|")
    return _save(figure, path)


def row_shap_png(values: DataFrame, path: str) -> str:
    """Bars of one row's (feature, shap), with their signs."""
    rows = values.orderBy(F.abs("shap"), F.desc("feature")).collect()
    figure, axes = _axes(8, 1 + 0.3 * len(rows))
    axes.barh([r.feature for r in rows], [r.shap for r in rows])
    axes.set_xlabel("SHAP")
    return _save(figure, path)


def pdp_png(table: DataFrame, feature: str, path: str) -> str:
    """The line of (grid, prediction)."""
    rows = table.orderBy("grid").collect()
    figure, axes = _axes(6, 4)
    axes.plot([r.grid for r in rows], [r.prediction for r in rows], marker="o")
    axes.set_xlabel(feature)
    axes.set_ylabel("mean prediction")
    return _save(figure, path)
