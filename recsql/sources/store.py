"""Model persistence as parquet tables plus a JSON parameter file.

Nothing is pickled or imported dynamically: a saved model is a folder of
tables, safe to load from untrusted storage."""

from __future__ import annotations

import dataclasses
import json

from pyspark.sql import DataFrame, SparkSession


def save_model(model, path: str) -> None:
    """Write every DataFrame field as ``<path>/<field>`` parquet; scalars and
    parameters go to ``<path>/_params.json`` (via Spark, so any Hadoop path works)."""
    spark = SparkSession.getActiveSession()
    meta = {"kind": type(model).__name__, "scalars": {}}
    for f in dataclasses.fields(model):
        v = getattr(model, f.name)
        if isinstance(v, DataFrame):
            v.write.mode("overwrite").parquet(f"{path}/{f.name}")
        elif dataclasses.is_dataclass(v):
            save_model(v, f"{path}/{f.name}")
            meta["scalars"][f.name] = {"__model__": f.name}
        else:
            meta["scalars"][f.name] = v
    spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").text(f"{path}/_params")


def load_model(spark: SparkSession, path: str, cls):
    """Rebuild a model dataclass of type ``cls`` saved by ``save_model``."""
    meta = json.loads(spark.read.text(f"{path}/_params").first()[0])
    kwargs = {}
    hints = {f.name: f for f in dataclasses.fields(cls)}
    for name, f in hints.items():
        if name in meta["scalars"]:
            v = meta["scalars"][name]
            if isinstance(v, dict) and "__model__" in v:
                sub = _field_class(cls, name)
                kwargs[name] = load_model(spark, f"{path}/{name}", sub)
            else:
                kwargs[name] = v
        else:
            kwargs[name] = spark.read.parquet(f"{path}/{name}")
    return cls(**kwargs)


def _field_class(cls, name):
    import typing
    return typing.get_type_hints(cls)[name]
