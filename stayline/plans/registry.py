"""Run store as append-only tables, model registry as a commit log per name."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from urllib.parse import quote

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from stayline.functions.times import utc_now
from stayline.plans.training import CLASSIFIERS, FittedModel, SearchResult
from stayline.sources.commits import CommitLog
from stayline.sources.readers import path_exists

# The metric champions are chosen by, and the alias in model uris.
SELECTION_METRIC = "cv_score"
ALIAS = "champion"
PRIMARY = "primary"

_TABLES = {
    "runs": "run_id string, model string, preprocessor string, artifact string, started_at timestamp_ntz",
    "run_params": "run_id string, param string, value string",
    "run_metrics": "run_id string, metric string, value double",
    "versions": "version int, run_id string, promoted_at timestamp_ntz, registry string",
}


@dataclass(frozen=True)
class RunStore:
    """Tables ``runs``, ``run_params``, ``run_metrics`` and ``versions`` below one folder.

    Rows are only ever appended. Runs, parameters and metrics of one training are
    a handful of rows. A registry is a commit log of its versions, so two trainings
    that register at once get one version each; its champion is the newest.
    """

    spark: SparkSession
    root: str

    def table(self, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        if path_exists(self.spark, path):
            reader = self.spark.read.schema(_TABLES[name])
            return reader.json(path) if name == "versions" else reader.parquet(path)
        return self.spark.createDataFrame([], _TABLES[name])

    def _append(self, name: str, rows: Sequence[tuple]) -> None:
        if rows:
            frame = self.spark.createDataFrame(list(rows), _TABLES[name])
            frame.coalesce(1).write.mode("append").parquet(f"{self.root}/{name}")

    def log_run(
        self,
        model: str,
        params: Mapping,
        metrics: Mapping,
        saved: tuple[str, str] | None = None,
        at: datetime | None = None,
    ) -> str:
        """Append one run. Only numeric metrics are kept; other values are left out.

        ``saved`` holds the paths of the preprocessor and the model.
        """
        run_id = uuid.uuid4().hex
        self._append("run_params", [(run_id, k, json.dumps(v)) for k, v in params.items()])
        numbers = [
            (run_id, k, float(v))
            for k, v in metrics.items()
            if isinstance(v, (int, float)) and not isinstance(v, bool)
        ]
        self._append("run_metrics", numbers)
        self._append("runs", [(run_id, model, *(saved or (None, None)), at or utc_now())])
        return run_id

    def metric(self, run_id: str, metric: str = SELECTION_METRIC) -> float | None:
        """Score of a run; NULL, NaN or a missing run all mean "no score"."""
        row = (
            self.table("run_metrics")
            .where((F.col("run_id") == run_id) & (F.col("metric") == metric) & ~F.isnan("value"))
            .agg(F.max("value").alias("value"))
            .first()
        )
        return row["value"]

    def _versions(self, registry: str) -> CommitLog:
        return CommitLog(self.spark, f"{self.root}/versions/registry={quote(registry, safe='')}")

    def champion(self, registry: str) -> tuple[int, str] | None:
        """(version, run id) the alias points at."""
        log = self._versions(registry)
        return self.version(registry, log.newest())

    def register_champion(
        self, registry: str, run_id: str, metric: str = SELECTION_METRIC
    ) -> tuple[int, bool]:
        """Promote a run if it beats the incumbent: (version in force, promoted).

        Without an incumbent any run is promoted, scored or not. A tie keeps the
        incumbent, so does a challenger without a score; an incumbent whose
        score is gone yields to any scored challenger. Who loses a version to
        another run challenges that run.
        """
        promoted = False

        def challenge(version: int, incumbent: dict | None) -> dict | None:
            nonlocal promoted
            promoted = True
            if incumbent is not None:
                challenger, defended = self.metric(run_id, metric), self.metric(incumbent["run_id"], metric)
                promoted = challenger is not None and (defended is None or challenger > defended)
            if not promoted:
                return None
            return {"version": version + 1, "run_id": run_id, "promoted_at": utc_now().isoformat()}

        version, _ = self._versions(registry).append(challenge)
        return version, promoted

    def register_models(
        self, runs: Mapping[str, str], metric: str = SELECTION_METRIC
    ) -> dict[str, tuple[int, bool]]:
        """Let every trained model defend its own registry, then contest the primary.

        ``runs`` maps model to run id in training order. Only classifiers compete
        for the primary; of equal scores the earlier one wins, and nothing
        happens when none has a score.
        """
        results = {name: self.register_champion(name, run_id, metric) for name, run_id in runs.items()}
        ranked = [(self.metric(runs[n], metric), n) for n in runs if n in CLASSIFIERS]
        scored = [(value, name) for value, name in ranked if value is not None]
        if scored:
            best = max(scored, key=lambda pair: pair[0])[1]
            results[PRIMARY] = self.register_champion(PRIMARY, runs[best], metric)
        return results

    def version(self, registry: str, number: int) -> tuple[int, str] | None:
        """(version, run id) of one version of a registry."""
        entry = self._versions(registry).read(number)
        return (entry["version"], entry["run_id"]) if entry else None

    def resolve(self, model: str) -> tuple[str, tuple[int, str] | None]:
        """(registry, (version, run id)) of a name, ``models:/name@champion`` or ``models:/name/3``.

        A name alone means its champion; None stands for what is not registered.
        """
        named = model.removeprefix("models:/")
        registry, _, alias = named.partition("@")
        if alias:
            if alias != ALIAS:
                raise ValueError(f"'{model}' asks for the alias '{alias}'; only '{ALIAS}' is kept")
            return registry, self.champion(registry)
        registry, _, number = named.partition("/")
        if not number:
            return registry, self.champion(registry)
        if not number.isdigit():
            raise ValueError(f"'{model}' ends in no version number")
        return registry, self.version(registry, int(number))

    def load_champion(self, registry: str, loaded: dict[str, object] | None = None) -> FittedModel | None:
        """The fitted model behind the alias, or None if nothing was registered or saved."""
        return self.load(self.resolve(registry)[1], registry, loaded)

    def load(
        self, version: tuple[int, str] | None, name: str, loaded: dict[str, object] | None = None
    ) -> FittedModel | None:
        """The fitted model of a version, under ``name``; None if it was not registered or saved.

        ``loaded`` collects preprocessors and models by path, so that champions of
        one training share a preprocessor, and the primary its model.
        """
        if version is None:
            return None
        row = self.table("runs").where(F.col("run_id") == version[1]).first()
        if row is None or row["artifact"] is None:
            return None
        shared = {} if loaded is None else loaded
        for path in (row["preprocessor"], row["artifact"]):
            if path not in shared:
                shared[path] = PipelineModel.load(path)
        return FittedModel(name, shared[row["preprocessor"]], shared[row["artifact"]].stages[0])

    def lineage(self) -> DataFrame:
        """(model, model_uri, model_version) of every registry's champion."""
        newest = self.table("versions").groupBy("registry").agg(F.max("version").alias("model_version"))
        return newest.select(
            F.col("registry").alias("model"),
            F.concat(F.lit("models:/"), "registry", F.lit(f"@{ALIAS}")).alias("model_uri"),
            "model_version",
        )


def log_search(
    store: RunStore, result: SearchResult, held_out: Mapping[str, float], settings: Mapping | None = None
) -> str:
    """Save the refitted model of a search and log its run, with the search settings if given."""
    saved = result.fitted.save(f"{store.root}/artifacts") if result.fitted is not None else None
    measured = {**held_out, SELECTION_METRIC: result.best_score}
    return store.log_run(result.name, {**(settings or {}), **result.best_params}, measured, saved)
