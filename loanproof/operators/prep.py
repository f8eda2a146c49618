"""Filling, encoding and scaling of features, with statistics from a named set of rows.

``fit_preparation`` reads only the rows it is given; what it learns is a few numbers per
feature, kept on the driver and written into the plan as literals. ``Preparation.transform``
is then a projection: no join, no shuffle, and test rows cannot influence the statistics.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanproof.functions.columns import finite
from loanproof.operators.ordering import exact_quantiles, quantile_map
from loanproof.session import collect_bounded

# One-hot levels a categorical field may have; beyond it the field needs target encoding.
MAX_LEVELS = 1_000


@dataclass(frozen=True)
class Preparation:
    """Learned fill values, levels, target rates and scales, and the columns they make."""

    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    medians: dict[str, float]
    modes: dict[str, str]
    levels: dict[str, tuple[str, ...]]
    flagged: tuple[str, ...] = ()
    rates: dict[str, dict[str, float]] = field(default_factory=dict)
    base_rate: float | None = None
    scales: dict[str, tuple[float, float]] = field(default_factory=dict)

    def raw_columns(self) -> dict[str, Column]:
        """The made columns before scaling, by name."""
        out: dict[str, Column] = {}
        for c in self.numeric:
            out[c] = F.coalesce(finite(c), F.lit(self.medians[c]), F.lit(0.0))
        for c in self.flagged:
            out[f"{c}_missing"] = finite(c).isNull().cast("double")
        for c in self.categorical:
            filled = F.coalesce(F.col(c).cast("string"), F.lit(self.modes[c]))
            if c in self.rates:
                pairs = [F.lit(x) for level, rate in self.rates[c].items() for x in (level, float(rate))]
                rate = F.try_element_at(F.create_map(*pairs), filled) if pairs else F.lit(None)
                out[f"{c}_target_rate"] = F.coalesce(rate, F.lit(self.base_rate))
            for level in self.levels[c]:
                name = level_column(c, level)
                while name in out:
                    name += "_"
                out[name] = (filled == level).cast("double")
        return out

    def columns(self) -> dict[str, Column]:
        made = self.raw_columns()
        for name, (mean, std) in self.scales.items():
            made[name] = (made[name] - F.lit(mean)) / F.lit(std)
        return made

    @property
    def names(self) -> list[str]:
        return list(self.raw_columns())

    def transform(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        """The kept columns and the made columns."""
        return df.select(*keep, *[c.alias(n) for n, c in self.columns().items()])


def level_column(column: str, level: str) -> str:
    """Column name of a level, free of characters that need quoting."""
    return f"{column}_" + re.sub(r"\W+", "_", str(level))


@dataclass(frozen=True)
class Levels:
    """Rows and target sum per level of each categorical field, of one set of rows."""

    cells: dict[str, dict[str | None, tuple[int, float]]]

    def of(self, column: str) -> list[str]:
        return sorted(level for level in self.cells[column] if level is not None)

    def mode(self, column: str) -> str | None:
        """The most frequent level; the smallest one on ties."""
        return min(self.of(column), key=lambda level: -self.cells[column][level][0], default=None)

    def rates(self, column: str) -> dict[str, float]:
        """Mean target per level, rows without a level counted at the mode."""
        blank = self.cells[column].get(None, (0, 0.0))
        out = {}
        for level in self.of(column):
            n, total = self.cells[column][level]
            if level == self.mode(column):
                n, total = n + blank[0], total + blank[1]
            out[level] = total / n
        return out


def level_cells(df: DataFrame, categorical: Sequence[str], target: str | None = None) -> DataFrame:
    """Rows (and target sums) per level of several fields, in one pass."""
    y = F.lit(None).cast("double") if target is None else F.col(target).cast("double")
    pairs = F.array(
        *[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("level")) for c in categorical]
    )
    long = df.select(y.alias("y"), F.explode(pairs).alias("x"))
    return long.groupBy("x.field", "x.level").agg(F.count("*").alias("n"), F.sum("y").alias("total"))


def read_levels(df: DataFrame, categorical: Sequence[str], target: str | None = None) -> Levels:
    cells: dict[str, dict] = {c: {} for c in categorical}
    if categorical:
        limit = (MAX_LEVELS + 1) * len(categorical)
        for r in collect_bounded(level_cells(df, categorical, target), limit, "levels"):
            cells[r["field"]][r["level"]] = (r["n"], r["total"] or 0.0)
    for c, found in cells.items():
        if len(found) > MAX_LEVELS + 1:
            raise ValueError(f"{c} has more than {MAX_LEVELS} levels")
    return Levels(cells)


def impute_stats(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """Median per numeric field and most frequent level per categorical field."""
    medians = exact_quantiles(df, numeric, [0.5]).select("field", F.col("value").alias("median"))
    first = F.min(F.struct((-F.col("n")).alias("k"), F.col("level").alias("level")))
    levels = level_cells(df, categorical).filter(F.col("level").isNotNull())
    modes = levels.groupBy("field").agg(first.alias("m")).select("field", F.col("m.level").alias("mode"))
    return medians.withColumn("mode", F.lit(None).cast("string")).unionByName(
        modes.withColumn("median", F.lit(None).cast("double"))
    )


def scale_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean and population deviation per field; a zero deviation counts as 1."""
    std = lambda c: F.coalesce(F.nullif(F.stddev_pop(c), F.lit(0.0)), F.lit(1.0))
    wide = df.agg(*[F.struct(F.avg(c).alias("mean"), std(c).alias("std")).alias(c) for c in columns])
    return wide.unpivot([], list(columns), "field", "x").select("field", "x.*")


def scale_values(df: DataFrame, made: dict[str, Column]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation of each column in one pass; a zero deviation counts as 1."""
    aggs = []
    for i, c in enumerate(made.values()):
        aggs += [F.avg(c).alias(f"m{i}"), F.stddev_pop(c).alias(f"s{i}")]
    row = df.agg(*aggs).first()
    return {n: (row[f"m{i}"] or 0.0, row[f"s{i}"] or 1.0) for i, n in enumerate(made)}


def fit_preparation(
    fit_df: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    indicators: bool = True,
    scale_numeric_only: bool = True,
    target: str | None = None,
    drop_first: bool = False,
    levels_df: DataFrame | None = None,
) -> Preparation:
    """Learn from ``fit_df`` only.

    ``indicators`` adds a flag for each column with missing cells in ``fit_df``. With
    ``target`` each categorical also gets the mean target of its level. ``levels_df`` may
    name the rows whose levels get a column, when they are more than the fitted ones.
    """
    seen = read_levels(fit_df, categorical, target)
    levels = seen if levels_df is None else read_levels(levels_df, categorical)
    first = 1 if drop_first else 0
    medians, flagged = {}, []
    if numeric:
        clean = fit_df.select(*[finite(c).alias(c) for c in numeric])
        medians = {c: q[0.5] for c, q in quantile_map(clean, numeric, [0.5]).items()}
        if indicators:
            gaps = clean.agg(*[F.max(F.col(c).isNull()).alias(c) for c in numeric]).first()
            flagged = [c for c in numeric if gaps[c]]
    rates, base = {}, None
    if target is not None:
        base = fit_df.agg(F.avg(target)).first()[0]
        rates = {c: seen.rates(c) for c in categorical}
    learned = Preparation(
        numeric=tuple(numeric),
        categorical=tuple(categorical),
        medians=medians,
        modes={c: seen.mode(c) for c in categorical},
        levels={c: tuple(levels.of(c)[first:]) for c in categorical},
        flagged=tuple(flagged),
        rates=rates,
        base_rate=base,
    )
    made = learned.raw_columns()
    scaled = [*numeric, *[f"{c}_missing" for c in flagged]] if scale_numeric_only else list(made)
    scales = scale_values(fit_df, {n: made[n] for n in scaled}) if scaled else {}
    return Preparation(**{**learned.__dict__, "scales": scales})


def train_only_preparation(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> Preparation:
    """Median fill with missing flags, both scaled; mode fill with one column per level."""
    return fit_preparation(train, numeric, categorical)


def whole_sample_preparation(df: DataFrame, numeric, categorical, target: str) -> Preparation:
    """The faulty kind: statistics and target rates from all rows, test rows included."""
    return fit_preparation(
        df, numeric, categorical, indicators=False, scale_numeric_only=False, target=target, drop_first=True
    )


def train_only_encoding(train: DataFrame, everything: DataFrame, numeric, categorical, target: str) -> Preparation:
    """As the faulty kind, but every statistic from train; level columns over all rows."""
    return fit_preparation(
        train, numeric, categorical, indicators=False, scale_numeric_only=False, target=target,
        drop_first=True, levels_df=everything,
    )


def level_rates(df: DataFrame, column: str, target: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.avg(target).alias("target_rate"))


def target_encode(
    df: DataFrame, column: str, target: str, train: DataFrame | None = None, name: str | None = None
) -> DataFrame:
    """Adds the mean target of each row's level.

    With ``train`` the means come from those rows, and a level they lack gets their overall
    mean. The level table is joined without a hint: it is broadcast when its size allows,
    and otherwise joined by key, where a hot level is split by the adaptive skew join.
    """
    name = name or f"{column}_target_rate"
    fit = df if train is None else train
    rates = level_rates(fit, column, target).withColumnRenamed("target_rate", name)
    out = df.join(rates, column, "left")
    if train is not None:
        mean = train.agg(F.avg(target)).first()[0]
        out = out.withColumn(name, F.coalesce(name, F.lit(mean)))
    return out


def one_hot(df: DataFrame, column: str, levels: Sequence[str], drop_first: bool = False) -> DataFrame:
    """One 0/1 column per level; a level outside the list gives zeros."""
    used = list(levels)[1:] if drop_first else list(levels)
    hit = {level_column(column, v): F.coalesce((F.col(column) == v).cast("int"), F.lit(0)) for v in used}
    return df.withColumns(hit)


def as_vector(df: DataFrame, columns: Sequence[str], name: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=name).transform(df)


def _bin_counts(cuts: dict[str, np.ndarray]):
    """Rows and sum of y per (feature, number of cuts below the value), added up per task; missing values have no bin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros((2, len(edges) + 2)) for edges in cuts.values()]
        for batch in batches:
            y = batch.column(0).to_numpy(zero_copy_only=False)
            for k, edges in enumerate(cuts.values()):
                values = batch.column(k + 1)
                place = np.searchsorted(edges, values.to_numpy(zero_copy_only=False), side="left")
                if values.null_count:
                    place[values.is_null().to_numpy(zero_copy_only=False)] = len(edges) + 1
                sums[k] += [np.bincount(place, w, len(edges) + 2) for w in (None, y)]
        rows = [
            (c, place if place <= len(edges) else None, int(n), pos)
            for (c, edges), (ns, ps) in zip(cuts.items(), sums)
            for place, (n, pos) in enumerate(zip(ns.tolist(), ps.tolist()))
            if n
        ]
        kinds = {"feature": pa.string(), "bin": pa.int32(), "n": pa.int64(), "pos": pa.float64()}
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds.values())], names=list(kinds))

    return run


def mutual_information(df: DataFrame, columns: Sequence[str], target: str, bins: int = 10) -> DataFrame:
    """Mutual information (nats) of each binned feature with a 0/1 target.

    Features are cut at exact quantiles. Rows become counts per (feature, bin) before the
    shuffle: columns x bins rows per task, whatever the size of the table.
    """
    probs = [i / bins for i in range(1, bins)]
    edges = quantile_map(df, columns, probs)
    cuts = {c: np.array(sorted({edges[c][p] for p in probs if edges[c][p] is not None}), dtype=np.float64) for c in columns}
    y = F.col(target)
    kind = "bigint" if isinstance(df.schema[target].dataType, T.IntegralType) else "double"
    cells = (
        df.filter(y.isNotNull())
        .select(y.cast("double").alias("y"), *[F.col(f"`{c}`").cast("double").alias(f"v{k}") for k, c in enumerate(columns)])
        .mapInArrow(_bin_counts(cuts), "feature string, bin int, n long, pos double")
        .groupBy("feature", "bin")
        .agg(F.sum("n").alias("n"), F.sum("pos").cast(kind).alias("pos"))
    )
    whole = Window.partitionBy("feature")
    n, p = F.sum("n").over(whole), F.sum("pos").over(whole)
    sized = cells.withColumns({"all_n": n, "all_p": p})

    def term(count: Column, total: Column) -> Column:
        part = count / F.col("all_n")
        return F.when(count > 0, part * F.ln(count * F.col("all_n") / (F.col("n") * total))).otherwise(0.0)

    gain = term(F.col("pos"), F.col("all_p")) + term(F.col("n") - F.col("pos"), F.col("all_n") - F.col("all_p"))
    return sized.groupBy("feature").agg(F.sum(gain).alias("mutual_information"))
