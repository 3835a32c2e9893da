"""Model preparation (F1-F4, F6): feature matrix, k-best selection, splits, scaling."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import MODULUS, row_hash
from ..functions.selection import global_quantiles
from ..operators.explore import anova_f_scores
from ..operators.features import apply_label_encoders, fit_label_encoders, fit_one_hot, one_hot
from ..operators.profile import numeric_columns, string_columns
from ..operators.sampling import MAX_GROUPS, first_n


@dataclass
class Matrix:
    df: DataFrame                 # keys..., label (double), feature columns, "features" vector
    features: list
    label_classes: list | None
    medians: dict = field(default_factory=dict)


def prepare_matrix(df: DataFrame, label: str, keys: list[str] | None = None,
                   exclude: tuple = (), assemble: bool = True) -> Matrix:
    """numeric columns (one-hot text columns when there is none), nulls filled
    with each column's median, the label coded alphabetically when it is text,
    assembled into a ``features`` vector."""
    keys = list(keys or [])
    skip = set(exclude) | {label} | set(keys)
    num = [c for c in numeric_columns(df) if c not in skip]
    work = df
    if not num:
        txt = [c for c in string_columns(df) if c not in skip]
        levels = fit_one_hot(df, txt)
        work = one_hot(df.select(*keys, label, *txt), txt, levels)
        num = [c for c in work.columns if c not in skip and c not in txt]
    nulls = work.agg(*[F.count_if(F.col(c).isNull() | F.isnan(F.col(c).cast("double"))).alias(c)
                       for c in num]).first() if num else {}
    need = [c for c in num if nulls[c]]
    med = {c: v[0] for c, v in global_quantiles(work, need, [0.5]).items()} if need else {}
    cols = []
    for c in num:
        x = F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
        cols.append((F.coalesce(x, F.lit(med[c])) if c in med and med[c] is not None else x).alias(c))
    classes = None
    y = F.col(label)
    if isinstance(df.schema[label].dataType, T.StringType):
        enc = fit_label_encoders(work, [label])
        classes = enc.classes.get(label)      # null beyond the bound: the code table stays distributed
        work = apply_label_encoders(work, enc)
        y = F.col(label)
    out = work.select(*keys, y.cast("double").alias("label"), *cols)
    if assemble:
        out = VectorAssembler(inputCols=num, outputCol="features", handleInvalid="keep").transform(out)
    return Matrix(out, num, classes, med)


def select_k_best(df: DataFrame, label: str, features: list[str], k: int = 20) -> list[str]:
    """the ``k`` features with the highest ANOVA F, in their original order;
    all features when there are at most ``k``."""
    if len(features) <= k:
        return list(features)
    scores = anova_f_scores(df, label, features, k=k, with_p=False).where("selected").collect()
    chosen = {r["feature"] for r in scores}
    return [c for c in features if c in chosen]


def stratified_split(df: DataFrame, label: str, keys: list[str], test_size: float = 0.2,
                     seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """exact stratified split. The test set has ceil(test_size * N) rows shared
    among classes in proportion (largest remainder, ties by class order), the
    rows of each class drawn by a seeded hash of ``keys``. Returns (train, test)."""
    counts = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
              .limit(MAX_GROUPS + 1).collect()}
    if len(counts) > MAX_GROUPS:
        raise ValueError(f"more than {MAX_GROUPS} classes to stratify")
    total = sum(counts.values())
    n_test = int(math.ceil(test_size * total))
    classes = sorted(counts, key=lambda c: (c is None, c))
    exact = {c: n_test * counts[c] / total for c in classes}
    quota = {c: int(math.floor(v)) for c, v in exact.items()}
    left = n_test - sum(quota.values())
    for c in sorted(classes, key=lambda c: (-(exact[c] - quota[c]), classes.index(c)))[:left]:
        quota[c] += 1
    flagged = first_n(df, [row_hash(keys, seed)], {(c,): q for c, q in quota.items()}, keys,
                      by=[label], flag="_test")
    return (flagged.where(~F.col("_test")).drop("_test"), flagged.where(F.col("_test")).drop("_test"))


def random_split(df: DataFrame, keys: list[str], test_size: float = 0.2,
                 seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """exact unstratified split. The test set is the first ceil(test_size * N)
    rows in the order of a seeded hash of ``keys`` (ties by the keys), so its size
    is exact and it does not depend on partitioning. Returns (train, test)."""
    total = df.count()
    n_test = int(math.ceil(test_size * total))
    flagged = first_n(df, [row_hash(keys, seed)], n_test, keys, flag="_test", spread=MODULUS)
    return (flagged.where(~F.col("_test")).drop("_test"), flagged.where(F.col("_test")).drop("_test"))


@dataclass
class ScaleParams:
    mean: dict
    std: dict


def fit_standard_scale(df: DataFrame, cols: list[str]) -> ScaleParams:
    """F6 fit: mean and population std per column (sklearn ``StandardScaler``;
    Spark's scaler uses the sample std)."""
    row = df.agg(*[a for i, c in enumerate(cols) for a in (
        F.avg(F.col(c).cast("double")).alias(f"m{i}"), F.stddev_pop(F.col(c).cast("double")).alias(f"s{i}"))]).first()
    return ScaleParams({c: row[f"m{i}"] for i, c in enumerate(cols)},
                       {c: row[f"s{i}"] for i, c in enumerate(cols)})


def apply_standard_scale(df: DataFrame, params: ScaleParams) -> DataFrame:
    """F6 apply: (x - mean) / std; a zero std leaves the centred value (scale 1)."""
    out = []
    for c in df.columns:
        if c in params.mean:
            s = params.std[c]
            s = 1.0 if not s else s
            out.append(((F.col(c).cast("double") - F.lit(params.mean[c])) / F.lit(s)).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)
