"""Batch scoring with several models at once."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from stayline import schema
from stayline.operators import compare, scoring
from stayline.operators.clusters import assign_nearest
from stayline.operators.features import transformed
from stayline.operators.quality import validate_batch
from stayline.plans.registry import ALIAS, PRIMARY, RunStore
from stayline.plans.training import CLASSIFIERS, CLUSTERING, FittedModel
from stayline.sources import writers

#: Models scored beside the primary.
OPTIONAL = (*CLASSIFIERS, CLUSTERING)


@dataclass(frozen=True)
class LoadedModels:
    """Models by name, the primary's version and uri, and why other models are absent."""

    models: dict[str, FittedModel]
    primary_uri: str
    primary_version: int
    absent: dict[str, str] = field(default_factory=dict)


def load_models(store: RunStore, optional: Sequence[str] = OPTIONAL, primary: str = PRIMARY) -> LoadedModels:
    """Models by name; each may be a name, ``models:/name@champion`` or ``models:/name/3``.

    The primary must load. Any other model that is not registered, or whose
    artifact cannot be read, is left out with the reason; it costs its column,
    not the batch.
    """
    shared: dict = {}
    registry, version = store.resolve(primary)
    fitted = store.load(version, PRIMARY, shared)
    if fitted is None:
        raise ValueError(f"cannot score: '{primary}' is not in the registry")
    uri = primary if primary.startswith("models:/") else f"models:/{registry}@{ALIAS}"
    models, absent = {PRIMARY: fitted}, {}
    for wanted in optional:
        name, version = store.resolve(wanted)
        try:
            found = store.load(version, name, shared)
        except Exception as error:  # whatever the file system or MLlib raises for a broken artifact
            absent[name] = f"{type(error).__name__}: {str(error).splitlines()[0] if str(error) else ''}"
            continue
        if found is None:
            absent[name] = "not registered"
        else:
            models[name] = found
    return LoadedModels(models, uri, version_number(store, primary), absent)


def version_number(store: RunStore, model: str) -> int:
    return store.resolve(model)[1][0]


def generate_predictions(
    models: Mapping[str, FittedModel],
    batch: DataFrame,
    primary: str = PRIMARY,
    segmentation: str | None = CLUSTERING,
    id_column: str = schema.ID_COLUMN,
    threshold: float = schema.DECISION_THRESHOLD,
    low: float = schema.RISK_LOW,
    high: float = schema.RISK_HIGH,
) -> DataFrame:
    """One row per customer: a score per classifier, a segment, the primary's decision.

    Models that share a preprocessor share its features, so those are computed
    once, and a model that appears under two names is scored once. The primary's
    score appears only as ``churn_probability``. Everything is a projection: the
    batch is read once and not shuffled.
    """
    if primary not in models:
        raise ValueError(f"nothing to decide by: '{primary}' is missing among {sorted(models)}")
    for name, fitted in models.items():
        if name != segmentation and (fitted.clusters or fitted.model.numClasses != 2):
            raise ValueError(f"'{name}' has no probability of two classes; name it as the segmentation instead")

    out = batch
    produced: list[str] = []
    for uid in dict.fromkeys(m.preprocessor.uid for m in models.values()):
        sharing = {n: m for n, m in models.items() if m.preprocessor.uid == uid}
        out = transformed(next(iter(sharing.values())).preprocessor, out)
        scored: dict[str, str] = {}
        for name, fitted in sharing.items():
            kept = out.columns
            if name != segmentation and fitted.model.uid in scored:
                column = f"{schema.PROBABILITY_PREFIX}{name}"
                out = out.withColumn(column, F.col(scored[fitted.model.uid]))
                produced.append(column)
            elif name == segmentation:
                centers = [(i, c.tolist()) for i, c in enumerate(fitted.model.clusterCenters())]
                out = assign_nearest(out.withColumn("_v", vector_to_array("features")), "_v", centers).drop("_v")
                produced += ["segment", "segment_distance"]
            else:
                column = f"{schema.PROBABILITY_PREFIX}{name}"
                out = fitted.model.transform(out).select(
                    *kept, vector_to_array("probability")[1].alias(column)
                )
                produced.append(column)
                scored[fitted.model.uid] = column
        out = out.drop("features")
    own = f"{schema.PROBABILITY_PREFIX}{primary}"
    others = [c for name in models for c in _outputs(name, segmentation) if c != own and c in produced]
    narrow = out.select(id_column, *others, F.col(own).alias("churn_probability"))
    return scoring.add_decision(narrow, "churn_probability", threshold, low, high)


def _outputs(name: str, segmentation: str | None) -> list[str]:
    if name == segmentation:
        return ["segment", "segment_distance"]
    return [f"{schema.PROBABILITY_PREFIX}{name}"]


@dataclass(frozen=True)
class BatchResult:
    """What a batch left: tables, where they are, and which optional models it did without."""

    predictions: DataFrame
    comparison: DataFrame
    summary: DataFrame
    predictions_path: str
    comparison_path: str
    absent: dict[str, str]


def run_batch(
    store: RunStore,
    batch: DataFrame,
    output: str,
    at: datetime,
    source: DataFrame | None = None,
    threshold: float = schema.DECISION_THRESHOLD,
    low: float = schema.RISK_LOW,
    high: float = schema.RISK_HIGH,
    optional: Sequence[str] = OPTIONAL,
    primary: str = PRIMARY,
    id_column: str = schema.ID_COLUMN,
    features: Sequence[str] = schema.FEATURES,
    with_csv: bool = False,
) -> BatchResult:
    """Score a batch and compare the models, as a job of its own with its own settings.

    ``batch`` is any extract of customers, read for instance by
    :func:`stayline.sources.readers.read_batch`; ``source`` adds its columns to
    the predictions. Threshold and risk bounds hold for decisions and comparison
    alike. Predictions and comparison are appended below ``output``, their paths
    and the models left out are part of the summary and of the logged run.
    ``with_csv`` also exports both as delimited files.
    """
    spark, batch_id = batch.sparkSession, scoring.batch_id(at)
    loaded = load_models(store, optional, primary)
    segmentation = CLUSTERING if CLUSTERING in loaded.models else None
    decided = generate_predictions(
        loaded.models, validate_batch(batch, id_column, features), PRIMARY, segmentation, id_column, threshold, low, high
    )
    stamped = scoring.add_metadata(decided, loaded.primary_uri, batch_id, at, loaded.primary_version)
    scored = scoring.enrich(stamped, source, id_column)
    table = writers.append_batch(scored, f"{output}/predictions", batch_id)
    predictions = writers.read_history(spark, table, scored.schema).where(F.col("batch_id") == batch_id)
    compared = compare.model_comparison(predictions, store.lineage(), threshold, low, high)
    report = writers.with_comparison_lineage(compared, batch_id, at)
    reports = writers.append_batch(report, f"{output}/comparison", batch_id)
    comparison = writers.read_history(spark, reports, report.schema).where(F.col("batch_id") == batch_id)
    if with_csv:
        writers.export_csv(predictions, f"{output}/export/predictions-{batch_id}.csv")
        writers.export_csv(comparison, f"{output}/export/comparison-{batch_id}.csv")
    notes = [("output_path", table), ("comparison_path", reports), *[("absent_model", n) for n in loaded.absent]]
    none = F.lit(None).cast("double").alias("value")
    summary = compare.batch_summary(predictions).unionByName(
        spark.createDataFrame(notes, "metric string, key string").select("metric", "key", none)
    )
    # A handful of rows: totals, risk groups, models and segments.
    measured = {".".join(filter(None, (r["metric"], r["key"]))): r["value"] for r in summary.collect() if r["value"] is not None}
    settings = {
        "threshold": threshold, "risk_low": low, "risk_high": high, "output_path": table, "comparison_path": reports,
        **{f"absent.{n}": reason for n, reason in loaded.absent.items()},
    }
    store.log_run(f"batch-{batch_id}", settings, measured)
    return BatchResult(predictions, comparison, summary, table, reports, loaded.absent)
