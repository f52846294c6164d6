"""Versioned model artifacts with metadata, a pointer to the latest, and rotation, wherever Spark can write."""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel

from weftline.operators.boosting import Trees
from weftline.sources import files

POINTER = "LATEST"
KEEP = 8


def save_model(model: PipelineModel | Trees, metadata: dict, base: str, version: str) -> str:
    target = f"{base}/{version}"
    if isinstance(model, Trees):
        files.write_text(f"{target}/trees.json", model.to_json())
    else:
        model.write().overwrite().save(f"{target}/model")
    files.write_text(f"{target}/metadata.json", json.dumps({"version": version, **metadata}, indent=2, default=str))
    # The pointer moves last: whoever follows it finds a whole version.
    files.write_text(f"{base}/{POINTER}", version)
    return target


def latest(base: str) -> str:
    if not files.exists(f"{base}/{POINTER}"):
        raise FileNotFoundError(f"No latest model in {base}")
    return f"{base}/{files.read_text(f'{base}/{POINTER}').strip()}"


def load_latest(base: str) -> PipelineModel | Trees:
    at = latest(base)
    return Trees.from_json(files.read_text(f"{at}/trees.json")) if files.exists(f"{at}/trees.json") else PipelineModel.load(f"{at}/model")


def load_metadata(base: str) -> dict:
    return json.loads(files.read_text(f"{latest(base)}/metadata.json"))


def rotate(base: str, keep: int = KEEP) -> list[str]:
    """Removes all but the ``keep`` last versions by name; returns what went."""
    versions = [v for v in files.folders(base) if v.startswith("v")]
    gone = versions[: max(0, len(versions) - keep)]
    for v in gone:
        files.remove(f"{base}/{v}")
    return gone
