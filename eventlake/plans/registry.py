"""Saved models and the pointer to the latest one."""

from __future__ import annotations

import json
import math
import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from eventlake.functions.stamps import model_path, run_id
from eventlake.schemas import MODEL_POINTER, struct
from eventlake.sources.paths import children, create_once, exists, remove
from eventlake.sources.tables import local_rows


#: Names of the pointer's files that are made one at a time.
NUMBERED = "number-"


@dataclass(frozen=True)
class Publication:
    """Whether a model was published, where it lies if so, and the row that is current now."""

    published: bool
    model_path: str | None
    current: Row


@dataclass(frozen=True)
class ModelRegistry:
    """Models below one directory, with a JSON dataset ``LATEST`` of a row for each publication, the newest current."""

    spark: SparkSession
    base: str

    @property
    def pointer_path(self) -> str:
        return f"{self.base.rstrip('/')}/LATEST"

    def publish(self, model: PipelineModel, name: str, rmse: float, at: datetime | None = None) -> str:
        """Save a model [SNK4], then point to it [SNK5, ML9]; returns its path.

        The pointer row is added only after the save, so it never names half a
        model, and earlier rows stay, so there is one to read at every moment.
        """
        at = at or datetime.now(timezone.utc)
        stamp = f"{at:%Y-%m-%d %H:%M:%S}"
        outcome = struct(moment="string", model_name="string", rmse="double")
        pointer = local_rows(self.spark, [(stamp, name, float(rmse))], outcome)
        pointer = pointer.withColumn("timestamp", run_id(F.col("moment").cast("timestamp_ntz")))
        pointer = pointer.withColumn("model_path", model_path(self.base, F.col("model_name"), F.col("timestamp")))
        row = pointer.select(*MODEL_POINTER.names).first()
        model.write().overwrite().save(row.model_path)
        (
            local_rows(self.spark, [tuple(row)], MODEL_POINTER)
            .coalesce(1)  # one row [PHY3]
            .write.mode("append")
            .json(self.pointer_path)
        )
        return row.model_path

    def publish_if_better(self, model: PipelineModel, name: str, rmse: float, at: datetime | None = None) -> Publication:
        """Save and point to a model only if its RMSE is below the current one's; ties and NaN are not better [SNK5, ML9].

        Safe with several publishers that all use this method: each row is a
        numbered file that only one of them can create. Whoever comes second is
        compared again, with the model that was published meanwhile, and told if
        that is as good. The model is saved first, under a path of its own, and
        taken away again if it loses.
        """
        stamp = f"{at or datetime.now(timezone.utc):%Y%m%d_%H%M%S}"
        path = f"{self.base.rstrip('/')}/{name}_{stamp}_{uuid.uuid4().hex[:8]}"
        while True:
            # the number is read before the row: a row that comes in between makes the number taken
            number = 1 + max((int(n[len(NUMBERED) : -5]) for n in children(self.spark, self.pointer_path) if n.startswith(NUMBERED)), default=0)
            current = self.latest().first() if exists(self.spark, self.pointer_path) else None
            if math.isnan(rmse) or (current is not None and not math.isnan(current.rmse) and rmse >= current.rmse):
                remove(self.spark, path)
                return Publication(False, None, current)
            if not exists(self.spark, path):
                model.write().save(path)
            row = dict(zip(MODEL_POINTER.names, (path, max(stamp, current.timestamp) if current else stamp, name, float(rmse)), strict=True))
            if create_once(self.spark, f"{self.pointer_path}/{NUMBERED}{number:08}.json", json.dumps(row) + "\n"):
                return Publication(True, path, self.latest().first())

    def latest(self) -> DataFrame:
        """The pointer row: the newest by its timestamp, of equal ones the last written."""
        rows = self.spark.read.schema(MODEL_POINTER).json(self.pointer_path)
        newest = F.max_by(F.struct(*MODEL_POINTER.names), F.struct("timestamp", "_metadata.file_modification_time"))
        return rows.agg(newest.alias("row")).where("row IS NOT NULL").select("row.*")

    def resolve(self, path: str | None = None) -> str:
        """A stated model path, or the one the pointer names."""
        if path is not None:
            return path
        row = self.latest().first() if exists(self.spark, self.pointer_path) else None
        if row is None:
            raise ValueError(f"{self.pointer_path} names no model; publish one first")
        return row.model_path

    def load(self, path: str | None = None) -> PipelineModel:
        """A stated model, or the latest [SRC8]."""
        return PipelineModel.load(self.resolve(path))
