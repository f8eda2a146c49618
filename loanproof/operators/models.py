"""Logistic fits by Newton steps over one aggregate, tree models, and scoring as column expressions."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loanproof.functions.columns import clipped_logit
from loanproof.operators.boosting import Boosted, fit_boosted
from loanproof.operators.forest import Forest, fit_forest
from loanproof.operators.metrics import binary_metrics, calibration_figures, cv_summary, score_cells, tolerance_select
from loanproof.operators.population import fold_block
from loanproof.operators.prep import Preparation, as_vector, train_only_preparation
from loanproof.schema import ApplicationSchema
from loanproof.session import materialize, ship_package, small_table

C_GRID = (0.01, 0.1, 1.0, 10.0)
CLASS_WEIGHTS = (None, "balanced")
# Fits that run at the same time; each is a chain of small jobs over one cached table.
CONCURRENT_FITS = 4
MLLIB_MAX_DEPTH = 30
# Deep MLlib trees: each row keeps its node in every tree, cut by a checkpoint every few passes, so that the
# trees do not travel with the tasks; the larger room for statistics serves more nodes a pass.
TREE_RUN = {"cacheNodeIds": True, "checkpointInterval": 10, "maxMemoryInMB": 1024}
# A round of boosting grows one shallow tree, which is cheaper to send than a node number per row is to
# keep; the running predictions are cut by a checkpoint every few rounds.
BOOST_RUN = {"cacheNodeIds": False, "checkpointInterval": 20}


@dataclass(frozen=True)
class LogisticModel:
    columns: tuple[str, ...]
    coefficients: tuple[float, ...]
    intercept: float

    def probability(self, source: dict[str, Column] | None = None) -> Column:
        """The score as an expression over the feature columns."""
        line = F.lit(self.intercept)
        for name, b in zip(self.columns, self.coefficients):
            x = source[name] if source else F.col(name)
            line = line + F.lit(b) * x
        return 1.0 / (1.0 + F.exp(-line))


def class_sizes(df: DataFrame, target: str) -> tuple[int, int]:
    row = df.agg(F.count_if(F.col(target) == 0).alias("n"), F.count_if(F.col(target) == 1).alias("p")).first()
    return row["n"], row["p"]


def class_weights(df: DataFrame, target: str) -> DataFrame:
    """Balanced weights n / (2 * rows of the class), one row per class."""
    sizes = df.filter(F.col(target).isNotNull()).groupBy(target).agg(F.count("*").alias("rows"))
    total = F.sum("rows").over(Window.partitionBy())
    return sizes.withColumn("weight", total / (2.0 * F.col("rows")))


def fit_rows(df: DataFrame, columns: Sequence[str], target: str, group: Column | None = None) -> DataFrame:
    """(grp, y, x): the group, the outcome and the features with a last one for the intercept."""
    x = F.array(*[F.col(c).cast("double") for c in columns], F.lit(1.0))
    return df.select((F.lit(0) if group is None else group).cast("int").alias("grp"), F.col(target).cast("double").alias("y"), x.alias("x"))


@dataclass(frozen=True)
class FitPoint:
    """One fit over the rows of a group: C, weights of both classes, and whether the intercept is penalized."""

    group: int
    c_value: float
    weights: tuple[float, float] = (1.0, 1.0)
    penalized: bool = True


def _newton_sums(points: Sequence[FitPoint], betas: np.ndarray) -> Callable:
    """Per task and point the loss, the gradient and the upper half of the Hessian, as (point, slot, value)."""
    width = betas.shape[1]
    upper = np.triu_indices(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(points), 1 + width + len(upper[0])))
        for batch in batches:
            groups, y = batch.column("grp").to_numpy(), batch.column("y").to_numpy()
            rows = batch.column("x").flatten().to_numpy().reshape(-1, width)
            for k, point in enumerate(points):
                mine = groups == point.group
                x, label = rows[mine], y[mine]
                if not len(x):
                    continue
                line = x @ betas[k]
                p = 1.0 / (1.0 + np.exp(-np.clip(line, -700, 700)))
                w = np.where(label == 1, point.weights[1], point.weights[0])
                sums[k, 0] += (w * (np.logaddexp(0.0, line) - label * line)).sum()
                sums[k, 1 : 1 + width] += x.T @ (w * (p - label))
                sums[k, 1 + width :] += ((x * (w * p * (1 - p))[:, None]).T @ x)[upper]
        many = sums.shape[1]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(len(points)), many)), pa.array(np.tile(np.arange(many), len(points))), pa.array(sums.ravel())],
            names=["point", "slot", "value"],
        )

    return run


def newton_fits(rows: DataFrame, points: Sequence[FitPoint], width: int, steps: int = 100, tol: float = 1e-9) -> np.ndarray:
    """Coefficients of all points, from one aggregate over the rows per Newton step.

    Minimizes b.b / 2 + C * sum of weighted losses for each point. Every step sums loss, gradient and
    Hessian of all open points in one pass: points x width^2 numbers a task, whatever the rows. A step
    that does not lower the loss is halved.
    """
    ship_package(rows.sparkSession)
    betas = np.zeros((len(points), width))
    moves = np.zeros_like(betas)
    losses = np.full(len(points), np.inf)
    ridge = np.ones((len(points), width))
    for k, point in enumerate(points):
        ridge[k, -1] = float(point.penalized)
    upper = np.triu_indices(width)
    live = list(range(len(points)))
    for _ in range(steps):
        if not live:
            break
        sums = np.zeros((len(live), 1 + width + len(upper[0])))
        parts = rows.mapInArrow(_newton_sums([points[k] for k in live], betas[live]), "point long, slot long, value double")
        for r in parts.groupBy("point", "slot").agg(F.sum("value").alias("value")).toArrow().to_pylist():
            sums[r["point"], r["slot"]] = r["value"]
        still = []
        for row, k in zip(sums, live):
            c = points[k].c_value
            loss = (ridge[k] * betas[k] ** 2).sum() / 2 + c * row[0]
            if loss > losses[k] * (1 + 1e-12) + 1e-12:
                moves[k] /= 2
                betas[k] -= moves[k]
            else:
                losses[k] = loss
                half = np.zeros((width, width))
                half[upper] = row[1 + width :]
                curve = c * (half + np.triu(half, 1).T) + np.diag(ridge[k])
                moves[k] = -np.linalg.lstsq(curve, ridge[k] * betas[k] + c * row[1 : 1 + width], rcond=None)[0]
                betas[k] += moves[k]
            if np.abs(moves[k]).max() > tol:
                still.append(k)
        live = still
    return betas


def score_points(rows: DataFrame, points: Sequence[FitPoint], betas: np.ndarray) -> DataFrame:
    """(point, y, score): every row scored by all points of its group."""
    ship_package(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups, y = batch.column("grp").to_numpy(), batch.column("y").to_numpy()
            x = batch.column("x").flatten().to_numpy().reshape(-1, betas.shape[1])
            for k, point in enumerate(points):
                mine = groups == point.group
                score = 1.0 / (1.0 + np.exp(-np.clip(x[mine] @ betas[k], -700, 700)))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(score), k, dtype=np.int32)), pa.array(y[mine].astype(np.int32)), pa.array(score)], names=["point", "y", "score"])

    return rows.mapInArrow(run, "point int, y int, score double")


def point_weights(sizes: tuple[int, int], class_weight: str | None) -> tuple[float, float]:
    negatives, positives = sizes
    if not negatives or not positives:
        raise ValueError("a fit needs rows of both classes")
    n = negatives + positives
    return (n / (2.0 * negatives), n / (2.0 * positives)) if class_weight == "balanced" else (1.0, 1.0)


def _model(columns: Sequence[str], beta: np.ndarray) -> LogisticModel:
    return LogisticModel(tuple(columns), tuple(float(b) for b in beta[:-1]), float(beta[-1]))


def logistic_l2(df: DataFrame, columns: Sequence[str], target: str, c_value: float = 1.0, class_weight: str | None = None) -> LogisticModel:
    """L2 logistic regression with a penalized intercept."""
    rows = materialize(fit_rows(df, columns, target))
    point = FitPoint(0, c_value, point_weights(class_sizes(rows, "y"), class_weight))
    return _model(columns, newton_fits(rows, [point], len(columns) + 1)[0])


def run_together(spark: SparkSession, jobs: Sequence[Callable], abreast: int = CONCURRENT_FITS) -> list:
    """Run independent Spark jobs from a few threads, results in order."""
    bound = inheritable_thread_target(spark)
    with ThreadPool(min(abreast, len(jobs))) as pool:
        return pool.map(lambda job: bound(job)(), jobs)


@dataclass(frozen=True)
class ScoringPipeline:
    """Preparation and model together: scoring is one projection over the raw columns."""

    preparation: Preparation
    model: LogisticModel

    def score(self, df: DataFrame, name: str = "score") -> DataFrame:
        return df.withColumn(name, self.model.probability(self.preparation.columns()))


def fit_pipeline(
    train: DataFrame,
    schema: ApplicationSchema,
    c_value: float,
    class_weight: str | None,
    numeric: Sequence[str] | None = None,
    categorical: Sequence[str] | None = None,
    preparation: Preparation | None = None,
) -> ScoringPipeline:
    """Preprocessing and logistic model, both learned from ``train`` alone."""
    prep = preparation or train_only_preparation(
        train,
        schema.numeric if numeric is None else numeric,
        schema.categorical if categorical is None else categorical,
    )
    wide = prep.transform(train, [schema.row_id, schema.target])
    return ScoringPipeline(prep, logistic_l2(wide, prep.names, schema.target, c_value, class_weight))


def temporal_grid_search(
    development: DataFrame,
    schema: ApplicationSchema,
    c_grid: Sequence[float] = C_GRID,
    weights: Sequence[str | None] = CLASS_WEIGHTS,
    folds: int = 3,
) -> DataFrame:
    """Fold metrics of each grid point: one row per (C, class weight, fold).

    The preprocessing of a fold is learned once. The training rows of all folds are stacked, and all
    points of all folds are fitted together (see ``newton_fits``). Validation rows get one score column
    per grid point, and the metrics of all grid points and folds come from one grouped pass.
    """
    keep = [schema.row_id, schema.date, schema.target, *schema.features]
    blocked = fold_block(materialize(development.select(*keep)), schema, folds)
    spark = development.sparkSession
    grid = [(w, c) for w in weights for c in c_grid]

    def prepared(fold: int):
        train = blocked.filter(F.col("block") < fold)
        valid = blocked.filter(F.col("block") == fold)
        sizes = class_sizes(train, schema.target)
        if 0 in class_sizes(valid, schema.target) + sizes:
            raise ValueError(f"fold {fold} lacks one of the classes")
        prep = train_only_preparation(train, schema.numeric, schema.categorical)
        return prep, sizes, prep.transform(train, [schema.target]), prep.transform(valid, [schema.target])

    made = run_together(spark, [lambda f=f: prepared(f) for f in range(1, folds + 1)])
    width = 1 + max(len(prep.names) for prep, *_ in made)

    def stack(side: int) -> DataFrame:
        """The rows of all folds. Folds may know different levels: all are as wide as the widest, the rest is zero."""
        out = None
        for fold, parts in enumerate(made, 1):
            names = parts[0].names
            short = [F.lit(0.0).alias(f"_none{i}") for i in range(width - 1 - len(names))]
            rows = fit_rows(parts[side].select("*", *short), [*names, *[f"_none{i}" for i in range(len(short))]], schema.target, F.lit(fold))
            out = rows if out is None else out.unionByName(rows)
        return materialize(out)

    points, labels = [], []
    for fold, (_, sizes, *_) in enumerate(made, 1):
        points += [FitPoint(fold, float(c), point_weights(sizes, w)) for w, c in grid]
        labels += [(float(c), w or "None", fold, sum(sizes), sizes[1]) for w, c in grid]
    betas = newton_fits(stack(2), points, width)
    scored = score_points(stack(3), points, betas)
    names = {"point": "int", "C": "double", "class_weight": "string", "fold": "int", "train_rows": "bigint", "train_positives": "bigint"}
    table = small_table(spark, names, [(k, *label) for k, label in enumerate(labels)])
    keys = list(names)[1:]
    found = binary_metrics(scored, "score", "y", None, ["point"]).join(F.broadcast(table), "point")
    return found.select(
        *keys,
        F.col("rows").alias("validation_rows"),
        F.col("positives").alias("validation_positives"),
        "pr_auc",
        "roc_auc",
        "brier_score",
    )


def tune(development: DataFrame, schema: ApplicationSchema) -> tuple[DataFrame, float, str | None]:
    """The grid table with fold detail and ``selected``, and the selected point."""
    table = tolerance_select(cv_summary(temporal_grid_search(development, schema), ["C", "class_weight"]))
    table = materialize(table)
    best = table.filter("selected").first()
    return table, best["C"], None if best["class_weight"] == "None" else best["class_weight"]


def calibration_lines(df: DataFrame, score: str, target: str, groups: Sequence[str] = (), steps: int = 50) -> dict[tuple, tuple]:
    """Intercept and slope of the outcome on the score's logit, per group; (None, None) for one class.

    Newton steps from zero over the score cells, one aggregate of five sums a step for all groups.
    The caller names groups of which there are few: samples or segments.
    """
    keys = list(groups)
    cells = materialize(score_cells(df, score, target, keys).withColumn("logit", clipped_logit("score")))
    sizes = cells.groupBy(*keys).agg(F.sum("pos").alias("p"), F.sum("neg").alias("n")).collect()
    lines = {tuple(r[k] for k in keys): (None, None) for r in sizes}
    open_lines = {tuple(r[k] for k in keys): (0.0, 0.0) for r in sizes if r["p"] and r["n"]}
    names = {**{k: cells.schema[k].dataType.simpleString() for k in keys}, "b0": "double", "b1": "double"}
    for _ in range(steps):
        if not open_lines:
            break
        now = small_table(cells.sparkSession, names, [(*k, *b) for k, b in open_lines.items()])
        joined = cells.join(F.broadcast(now), keys) if keys else cells.crossJoin(F.broadcast(now))
        p = 1.0 / (1.0 + F.exp(-(F.col("b0") + F.col("b1") * F.col("logit"))))
        total, x = F.col("pos") + F.col("neg"), F.col("logit")
        off, curve = F.col("pos") - total * p, total * p * (1.0 - p)
        sums = joined.groupBy(*keys).agg(
            F.sum(off).alias("g0"), F.sum(off * x).alias("g1"), F.sum(curve).alias("h0"), F.sum(curve * x).alias("h1"), F.sum(curve * x * x).alias("h2")
        )
        for r in sums.collect():
            key = tuple(r[k] for k in keys)
            det = r["h0"] * r["h2"] - r["h1"] ** 2
            if det <= 1e-12 * r["h0"] * r["h2"]:  # one score alone, or classes that a score parts: no line
                del open_lines[key]
                continue
            move = ((r["h2"] * r["g0"] - r["h1"] * r["g1"]) / det, (r["h0"] * r["g1"] - r["h1"] * r["g0"]) / det)
            lines[key] = open_lines[key] = tuple(b + m for b, m in zip(open_lines[key], move))
            if max(map(abs, move)) < 1e-10:
                del open_lines[key]
    return lines


def calibration_fit(df: DataFrame, score: str, target: str) -> tuple[float | None, float | None]:
    """Intercept and slope of the outcome on the score's logit; missing for one class."""
    return calibration_lines(df, score, target).get((), (None, None))


def calibration_summary(samples: dict[str, DataFrame], score: str, target: str) -> DataFrame:
    """Calibration figures of each named sample, with the recalibration line."""
    stacked = None
    for name, df in samples.items():
        rows = df.select(F.lit(name).alias("sample"), score, target)
        stacked = rows if stacked is None else stacked.unionByName(rows)
    lines = calibration_lines(stacked, score, target, ["sample"])
    table = small_table(
        stacked.sparkSession,
        {"sample": "string", "calibration_intercept": "double", "calibration_slope": "double"},
        [(*k, *line) for k, line in lines.items()],
    )
    return calibration_figures(stacked, score, target, ["sample"]).join(F.broadcast(table), "sample", "left")


@dataclass(frozen=True)
class VectorModel:
    """A fitted MLlib classifier over a feature vector."""

    model: object
    columns: tuple[str, ...]

    def score(self, df: DataFrame, name: str = "score") -> DataFrame:
        scored = self.model.transform(as_vector(df, self.columns, "_features"))
        made = [c for c in scored.columns if c not in df.columns]
        return scored.withColumn(name, vector_to_array("probability")[1]).drop(*made)


def _fit_vector_model(estimator, train: DataFrame, columns: Sequence[str], target: str) -> VectorModel:
    rows = as_vector(train, columns, "_features").select(F.col(target).cast("double").alias("label"), "_features")
    estimator = estimator.setFeaturesCol("_features").setLabelCol("label")
    return VectorModel(estimator.fit(rows), tuple(columns))


def forest_model(
    train: DataFrame, columns: Sequence[str], target: str, trees: int = 500, depth: int | None = None, seed: int = 7
) -> Forest:
    """Random forest of Gini trees on Poisson bags; no depth limit means 30, MLlib's own limit.

    MLlib would hold all trees as objects in the driver; ``operators/forest.py`` keeps them as rows.
    """
    return fit_forest(train, columns, target, trees, MLLIB_MAX_DEPTH if depth is None else depth, seed)


def boosted_model(
    train: DataFrame,
    columns: Sequence[str],
    target: str,
    rounds: int = 250,
    step: float = 0.04,
    depth: int = 3,
    seed: int = 7,
) -> VectorModel:
    estimator = GBTClassifier(**BOOST_RUN, maxIter=rounds, stepSize=step, maxDepth=depth, seed=seed)
    return _fit_vector_model(estimator, train, columns, target)


def boosted_trees(
    train: DataFrame,
    columns: Sequence[str],
    target: str,
    rounds: int = 250,
    step: float = 0.04,
    depth: int = 3,
    seed: int = 7,
) -> Boosted:
    """The trees of ``boosted_model`` without its jobs per round, for studies of many fits.

    ``train`` must be written: the draws that place the bins hang on its partitions, as MLlib's do.
    """
    return fit_boosted(train, columns, target, rounds, step, depth, seed)


@dataclass(frozen=True)
class LinearVectorModel:
    """A logistic model behind the same ``score`` call as the tree models."""

    model: LogisticModel

    def score(self, df: DataFrame, name: str = "score") -> DataFrame:
        return df.withColumn(name, self.model.probability())


def unpenalized_intercept_logistics(train: DataFrame, columns: Sequence[str], target: str, c_values: Sequence[float]) -> list[LinearVectorModel]:
    """L2 logistic regressions with a free intercept, one per C, fitted together."""
    rows = materialize(fit_rows(train, columns, target))
    point_weights(class_sizes(rows, "y"), None)
    betas = newton_fits(rows, [FitPoint(0, float(c), penalized=False) for c in c_values], len(columns) + 1)
    return [LinearVectorModel(_model(columns, b)) for b in betas]
