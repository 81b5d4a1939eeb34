"""Versioned models in a shared folder.

Every change is one row in an append-only Parquet log, and a model is saved to
a path of its own. Replacing a version writes a new path and then a new row,
so a reader never meets a half-written model and no other version is touched.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from cohortry.models.native import register_score

LOG_SCHEMA = (
    "seq bigint, event string, name string, version string, path string, "
    "signature array<struct<feature: string, type: string>>, "
    "metrics map<string, double>, comment string"
)


class VersionError(ValueError):
    """A version that is missing, or there although it must not be."""


class SignatureError(ValueError):
    """Rows to be scored lack a feature or have it in another type."""


def signature_of(df: DataFrame, features: Sequence[str]) -> list[tuple[str, str]]:
    """Names and types of the features, taken from the real rows' schema."""
    return [(f, df.schema[f].dataType.simpleString()) for f in features]


class ModelRegistry:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._log = f"{self.root}/log"

    # -- log ---------------------------------------------------------------

    def _events(self) -> DataFrame:
        reader = self.spark.read.schema(LOG_SCHEMA).option("recursiveFileLookup", "true")
        try:
            return reader.parquet(self._log)
        except AnalysisException as error:
            # Only a log that is not there yet is an empty one.
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], LOG_SCHEMA)

    def _append(self, event: str, name: str, version: str, path: str | None = None,
                signature: list | None = None, metrics: dict | None = None,
                comment: str | None = None) -> None:
        seq = (self._events().agg(F.max("seq")).first()[0] or 0) + 1
        while True:
            row = (seq, event, name, version, path, signature, metrics, comment)
            frame = self.spark.createDataFrame([row], LOG_SCHEMA).coalesce(1)
            # One new folder per event, never rewritten. Whoever comes second
            # to a number finds its folder and takes the next one.
            try:
                frame.write.mode("error").parquet(f"{self._log}/event-{seq:012d}")
                return
            except AnalysisException as error:
                if error.getCondition() != "PATH_ALREADY_EXISTS":
                    raise
                seq += 1

    def versions(self, name: str | None = None) -> DataFrame:
        """Current versions, one row each, with the default one flagged."""
        events = self._events()
        if name is not None:
            events = events.filter(F.col("name") == name)
        newest = Window.partitionBy("name", "version").orderBy(F.desc("seq"))
        current = (
            events.filter(F.col("event").isin("register", "drop"))
            .withColumn("_place", F.row_number().over(newest))
            .filter((F.col("_place") == 1) & (F.col("event") == "register"))
            .drop("_place", "event")
        )
        default = (
            events.filter(F.col("event") == "default")
            .groupBy("name")
            .agg(F.max_by("version", "seq").alias("_default"))
        )
        joined = current.join(default, "name", "left")
        return joined.withColumn(
            "is_default", F.coalesce(F.col("_default") == F.col("version"), F.lit(False))
        ).drop("_default")

    def _entry(self, name: str, version: str | None):
        listed = self.versions(name)
        wanted = F.col("is_default") if version is None else F.col("version") == version
        entry = listed.filter(wanted).first()
        if entry is None:
            raise VersionError(f"{name} has no {'default version' if version is None else version}")
        return entry

    # -- changes -----------------------------------------------------------

    def register(
        self,
        name: str,
        version: str,
        model: PipelineModel,
        signature: list[tuple[str, str]],
        metrics: dict[str, float] | None = None,
        comment: str | None = None,
        replace: bool = False,
    ) -> None:
        """Save a model as a version. The first version becomes the default.

        An existing version is an error unless ``replace`` is given, and then
        only that version changes. A model known to predict a single class is
        refused.
        """
        if not version:
            raise VersionError("a version name is required")
        rate = (metrics or {}).get("predicted_positive_rate")
        if rate in (0.0, 1.0):
            raise ValueError("the model predicts a single class and is not registered")
        known = [r["version"] for r in self.versions(name).select("version").collect()]
        if version in known and not replace:
            raise VersionError(f"{name} {version} exists; pass replace=True to replace it")
        path = f"{self.root}/models/{name}/{version}/{uuid.uuid4().hex}"
        model.write().save(path)
        numbers = {k: float(v) for k, v in (metrics or {}).items()}
        self._append("register", name, version, path, signature, numbers, comment)
        if not known:
            self.set_default(name, version)

    def register_saved(self, name: str, version: str, path: str, signature: list[tuple[str, str]],
                       **details) -> None:
        """Register a model that was saved somewhere else."""
        self.register(name, version, PipelineModel.load(path), signature, **details)

    def drop_version(self, name: str, version: str) -> None:
        """Drop a version; the default one only if it is the last one left."""
        if self._entry(name, version)["is_default"] and self.versions(name).count() > 1:
            raise VersionError(f"{name} {version} is the default; set another default first")
        self._append("drop", name, version)

    def set_default(self, name: str, version: str) -> None:
        self._entry(name, version)
        self._append("default", name, version)

    # -- use ---------------------------------------------------------------

    def load(self, name: str, version: str | None = None) -> PipelineModel:
        return PipelineModel.load(self._entry(name, version)["path"])

    def register_function(self, function: str, name: str, version: str | None = None, replace: bool = True) -> None:
        """Make a version, or the default one, a native SQL function of its features.

        ``SELECT function(feature, ...)`` then gives the score. The function keeps the
        version it was made from; register it again to follow a new default.
        """
        entry = self._entry(name, version)
        signature = [(f["feature"], f["type"]) for f in entry["signature"]]
        register_score(self.spark, function, entry["path"], signature, replace)

    def score(self, df: DataFrame, name: str, version: str | None = None) -> DataFrame:
        """Add ``score`` and ``prediction`` to all rows, checked by signature."""
        from cohortry.models.training import with_probability

        entry = self._entry(name, version)
        for feature, dtype in entry["signature"]:
            if feature not in df.columns:
                raise SignatureError(f"feature {feature!r} is missing")
            found = df.schema[feature].dataType
            if found.simpleString() != dtype:
                raise SignatureError(f"feature {feature!r} is {found.simpleString()}, not {dtype}")
        model = PipelineModel.load(entry["path"])
        scored = with_probability(model.transform(df))
        return scored.select(
            *df.columns, "score", F.col("prediction").cast(T.LongType()).alias("prediction")
        )
