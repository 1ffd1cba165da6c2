"""Model comparison, scoring and explanation with MLlib."""

from __future__ import annotations

import contextlib
import functools
import random
from collections.abc import Sequence

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import (
    DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladle.config import DEFAULTS
from ladle.operators import trees
from ladle.plans.scale import global_rank, join_on, materialize, with_stats


#: The original grows its forest's trees without a limit; this is how deep they may go here (MLlib allows 30).
FOREST_DEPTH = 10


def build_preprocessor(numeric: Sequence[str], categorical: Sequence[str]) -> list:
    """F1: z-scored numerics, one-hot categoricals (unseen -> all zeros).

    StringIndexer(keep) sends unseen values to an extra last index, which
    OneHotEncoder(dropLast) drops: n real categories, unseen = zero vector.
    StandardScaler divides by the sample deviation (the original uses the
    population one; the ratio sqrt(n/(n-1)) does not change tree or linear
    fits)."""
    stages = []
    oh = []
    for c in categorical:
        stages.append(StringIndexer(inputCol=c, outputCol=f"{c}__idx", handleInvalid="keep"))
        oh.append(c)
    if oh:
        stages.append(OneHotEncoder(inputCols=[f"{c}__idx" for c in oh], outputCols=[f"{c}__oh" for c in oh],
                                    dropLast=True, handleInvalid="keep"))
    stages.append(VectorAssembler(inputCols=list(numeric), outputCol="_num", handleInvalid="keep"))
    stages.append(StandardScaler(inputCol="_num", outputCol="_num_z", withMean=True, withStd=True))
    stages.append(VectorAssembler(inputCols=["_num_z"] + [f"{c}__oh" for c in oh], outputCol="features"))
    return stages


def label_scale(df: DataFrame, label: str) -> tuple[int, float]:
    """Rows and population deviation of the label, as ``estimators`` takes them."""
    r = df.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop(F.col(label).cast("double")).alias("s")).first()
    return r["n"], r["s"] or 1.0


def estimators(task: str, n_rows: int | None = None, label_std: float = 1.0, label: str = "label") -> dict:
    """The compared regressors with the original's settings (ridge alpha
    1.0 -> regParam alpha / n times the label's deviation, by which MLlib divides
    an L2 penalty; lasso alpha 0.1 -> regParam alpha)."""
    depth = 12 if task == "eta" else 10
    n = max(1, n_rows or 1)
    kw = dict(featuresCol="features", labelCol=label)
    return {
        "LinearRegression": LinearRegression(regParam=0.0, **kw),
        "Ridge": LinearRegression(regParam=label_std / n, elasticNetParam=0.0, standardization=False, **kw),
        "Lasso": LinearRegression(regParam=0.1, elasticNetParam=1.0, standardization=False, **kw),
        "DecisionTree": DecisionTreeRegressor(maxDepth=depth, seed=DEFAULTS.random_seed, **kw),
        "RandomForest": RandomForestRegressor(numTrees=100, maxDepth=FOREST_DEPTH, maxMemoryInMB=512, seed=DEFAULTS.random_seed, **kw),
        "GradientBoosting": GBTRegressor(maxIter=100, maxDepth=3, seed=DEFAULTS.random_seed, **kw),
    }


def with_folds(df: DataFrame, key: str, k: int | None = None, seed: int | None = None) -> DataFrame:
    """Stable fold id from a hash of the row key (re-runs and lost executors
    give the same folds)."""
    k = k or DEFAULTS.cv_folds
    seed = DEFAULTS.random_seed if seed is None else seed
    return df.withColumn("fold", F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(k)).cast("int"))


def oof_predictions(df: DataFrame, key: str, label: str, numeric, categorical, model_name: str, estimator,
                    k: int | None = None, parallelism: int = 5) -> DataFrame:
    """one out-of-fold prediction per row; preprocessing refitted per fold.
    The k fits are independent and are submitted concurrently (as
    ``CrossValidator(parallelism)`` does), so small fits share the cluster."""
    from concurrent.futures import ThreadPoolExecutor

    k = k or DEFAULTS.cv_folds
    data = with_folds(df.withColumn("label", F.col(label).cast("double")), key, k)

    def fit(f: int):
        pipe = Pipeline(stages=build_preprocessor(numeric, categorical) + [estimator.copy()])
        return pipe.fit(data.where(F.col("fold") != f))

    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, k))) as pool:
        models = list(pool.map(fit, range(k)))
    outs = [m.transform(data.where(F.col("fold") == f)).select(key, F.col("label").alias("actual"), F.col("prediction"))
            for f, m in enumerate(models)]
    res = outs[0]
    for o in outs[1:]:
        res = res.unionByName(o)
    return res.withColumn("model", F.lit(model_name))


def oof_board(df: DataFrame, key: str, label: str, numeric, categorical, models: dict, k: int | None = None,
              heavy: Sequence[str] = ("RandomForest",)) -> DataFrame:
    """F2 for several estimators (name -> estimator): their out-of-fold predictions, stored.

    The preprocessor is fitted once per fold and all models of the fold share its cached rows. Folds
    run at once; a fitted model's predictions are written before its fold goes on, so no model stays
    with the driver, and of the ``heavy`` ones only one at a time is fitted. Forests over many
    rows are grown by ``trees``."""
    import threading
    from concurrent.futures import ThreadPoolExecutor

    k = k or DEFAULTS.cv_folds
    data = with_folds(df.withColumn("label", F.col(label).cast("double")), key, k)
    alone = threading.Lock()

    def predictions(name: str, train: DataFrame, held: DataFrame) -> DataFrame:
        with alone if name in heavy else contextlib.nullcontext():
            model = trees.fit(models[name], train)
            if model:
                out = trees.predictions(model, held, key)
            else:
                out = models[name].copy().fit(train).transform(held).select(key, F.col("label").alias("actual"), F.col("prediction"))
            return materialize(out.withColumn("model", F.lit(name)))

    def fold(f: int) -> list[DataFrame]:
        train = data.where(F.col("fold") != f)
        prep = Pipeline(stages=build_preprocessor(numeric, categorical)).fit(train)
        train = prep.transform(train).select("features", "label").cache()
        held = prep.transform(data.where(F.col("fold") == f)).select(key, "features", "label").cache()
        names = list(models)
        out = [predictions(name, train, held) for name in names[f % len(names):] + names[:f % len(names)]]
        train.unpersist()
        held.unpersist()
        return out

    with ThreadPoolExecutor(max_workers=k) as pool:
        parts = [part for fold_parts in pool.map(fold, range(k)) for part in fold_parts]
    return functools.reduce(DataFrame.unionByName, parts)


def regression_metrics(df: DataFrame, actual: str = "actual", prediction: str = "prediction",
                       keys: Sequence[str] = (), prefix: str = "") -> DataFrame:
    """MAE, RMSE, R^2 rounded (half-even) to 4 decimals, one aggregate
    (R^2 needs the mean: attached as a per-key statistic)."""
    keys = list(keys)
    err = F.col(actual) - F.col(prediction)
    if keys:
        means = df.groupBy(*keys).agg(F.avg(actual).alias("_mean"))
        x = join_on(df, means, keys)
        mean = F.col("_mean")
    else:
        x = with_stats(df, df.agg(F.avg(actual).alias("m")), "_ms")
        mean = F.col("_ms.m")
    g = x.groupBy(*keys).agg(
        F.avg(F.abs(err)).alias("_mae"), F.sqrt(F.avg(err * err)).alias("_rmse"),
        F.sum(err * err).alias("_sse"), F.sum((F.col(actual) - mean) ** 2).alias("_sst"),
        F.count(F.lit(1)).alias("n"))
    return g.select(*keys, F.bround("_mae", 4).alias(f"{prefix}mae"), F.bround("_rmse", 4).alias(f"{prefix}rmse"),
                    F.bround(1 - F.try_divide(F.col("_sse"), F.col("_sst")), 4).alias(f"{prefix}r2"), "n")


def leaderboard(oof: DataFrame) -> DataFrame:
    """one row per model over the union of out-of-fold predictions, by MAE."""
    return regression_metrics(oof, keys=["model"]).orderBy("mae", "model")


def select_best(board: DataFrame, metric: str = "mae") -> DataFrame:
    """min MAE / min RMSE / max R^2 (unknown metric -> MAE); empty -> no row."""
    metric = metric if metric in ("mae", "rmse", "r2") else "mae"
    order = F.desc(metric) if metric == "r2" else F.asc(metric)
    return board.orderBy(order, "model").limit(1)


def fit_best(name: str, df: DataFrame, label: str, numeric, categorical, path: str | None = None,
             estimator=None, task: str = "eta") -> PipelineModel:
    """refit the winner (with its tuned parameters when given) on all rows;
    save it when a path is given (load with ``PipelineModel.load``)."""
    data = df.withColumn("label", F.col(label).cast("double"))
    est = estimator or estimators(task, *label_scale(data, "label"))[name]
    model = Pipeline(stages=build_preprocessor(numeric, categorical) + [est]).fit(data)
    if path:
        model.write().overwrite().save(path)
    return model


def load_model(spark, path: str) -> PipelineModel | None:
    """The saved model, or None where there is none; a damaged one is an error."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return None
    return PipelineModel.load(path)


# ---- FIXED VALUES: search ranges, as far as MLlib has the parameter -----------
SPACES = {
    "RandomForest": {"numTrees": ("int", 50, 500), "maxDepth": ("int", 3, 30), "minInstancesPerNode": ("int", 1, 20),
                     "featureSubsetStrategy": ("choice", ["sqrt", "log2", "all"])},
    "GradientBoosting": {"maxIter": ("int", 50, 500), "maxDepth": ("int", 3, 12), "stepSize": ("logfloat", 1e-3, 0.3),
                         "subsamplingRate": ("float", 0.6, 1.0), "minInstancesPerNode": ("int", 1, 20),
                         "featureSubsetStrategy": ("choice", ["sqrt", "log2", "all"])},
    "DecisionTree": {"maxDepth": ("int", 3, 20), "minInstancesPerNode": ("int", 1, 20)},
    "Ridge": {"regParam": ("logfloat", 1e-4, 1.0)},
    "Lasso": {"regParam": ("logfloat", 1e-4, 1.0)},
}
TRIALS = 50
# ------------------------------------------------------------------------------


def sample_params(space: dict, n_trials: int, seed: int | None = None) -> list[dict]:
    """Seeded random draws from int / float / log-float / categorical ranges."""
    import math
    rng = random.Random(DEFAULTS.random_seed if seed is None else seed)
    out = []
    for _ in range(n_trials):
        p = {}
        for k, spec in space.items():
            kind = spec[0]
            if kind == "int":
                p[k] = rng.randint(spec[1], spec[2])
            elif kind == "float":
                p[k] = rng.uniform(spec[1], spec[2])
            elif kind == "logfloat":
                p[k] = math.exp(rng.uniform(math.log(spec[1]), math.log(spec[2])))
            else:
                p[k] = rng.choice(spec[1])
        out.append(p)
    return out


def _moment_rows(train: DataFrame, dims: int) -> DataFrame:
    """A few weighted rows (features, label, weight) with the count, means and covariances of ``train``.

    A least-squares fit, penalised or not, reads nothing else of its rows, so it is the same on these 2 (dims + 1)
    rows: the means, each way along every axis of the covariance. One pass; a task sends one sum of squares."""
    def sums(batches):
        import pyarrow as pa
        n, mean, m2 = 0, np.zeros(dims + 1), np.zeros((dims + 1, dims + 1))
        for batch in batches:
            if not batch.num_rows:
                continue
            x = pc.list_flatten(batch.column(0)).to_numpy(zero_copy_only=False).reshape(-1, dims)
            x = np.column_stack([x, batch.column(1).to_numpy(zero_copy_only=False)])
            n, mean, m2 = _joined((n, mean, m2), (len(x), x.mean(axis=0), (x - x.mean(axis=0)).T @ (x - x.mean(axis=0))))
        yield pa.record_batch([pa.array([n]), pa.array([mean.tolist()]), pa.array([m2.ravel().tolist()])], names=["n", "mean", "m2"])

    import pyarrow.compute as pc
    parts = train.select(vector_to_array("features").alias("x"), "label").mapInArrow(sums, "n long, mean array<double>, m2 array<double>")
    total = (0, np.zeros(dims + 1), np.zeros((dims + 1, dims + 1)))
    for r in parts.where("n > 0").toLocalIterator():  # (dims + 2)^2 numbers a task
        total = _joined(total, (r["n"], np.array(r["mean"]), np.array(r["m2"]).reshape(dims + 1, dims + 1)))
    n, mean, m2 = total
    if not np.isfinite(m2).all():  # a fit on such rows is what it is on all of them
        return train.withColumn("weight", F.lit(1.0))
    values, axes = np.linalg.eigh(m2 / n)
    axes = axes * np.sqrt(np.maximum(values, 0.0) * (dims + 1))
    axes[np.diag(m2) == 0] = 0.0  # a constant stays one
    rows = [mean + sign * axis for axis in axes.T for sign in (1.0, -1.0)]
    return train.sparkSession.createDataFrame(
        [(Vectors.dense(r[:-1]), float(r[-1]), n / len(rows)) for r in rows], ["features", "label", "weight"]).coalesce(1).cache()


def _joined(a, b):
    """(count, means, sums of squares about them) of two sets of rows together."""
    n = a[0] + b[0]
    d = b[1] - a[1]
    return n, a[1] + d * (b[0] / n), a[2] + b[2] + np.outer(d, d) * (a[0] * b[0] / n)


def _linear_errors(held: DataFrame, models: list) -> list[tuple[float, float, int]]:
    """(sum of absolute errors, of squared errors, rows) of each linear model, all in one pass over ``held``."""
    coefs = np.array([m.coefficients.toArray() for m in models])
    intercepts = np.array([m.intercept for m in models])

    def sums(batches):
        import pyarrow as pa
        a, s, n = np.zeros(len(coefs)), np.zeros(len(coefs)), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            x = pc.list_flatten(batch.column(0)).to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            err = x @ coefs.T + intercepts - batch.column(1).to_numpy(zero_copy_only=False)[:, None]
            a, s, n = a + np.abs(err).sum(axis=0), s + (err * err).sum(axis=0), n + batch.num_rows
        yield pa.record_batch([pa.array(np.arange(len(coefs))), pa.array(a), pa.array(s), pa.array(np.full(len(coefs), n))],
                              names=["i", "a", "s", "n"])

    import pyarrow.compute as pc
    parts = held.select(vector_to_array("features").alias("x"), "label").mapInArrow(sums, "i long, a double, s double, n long")
    got = {r["i"]: r for r in parts.groupBy("i").agg(F.sum("a").alias("a"), F.sum("s").alias("s"), F.sum("n").alias("n")).collect()}
    return [(got[i]["a"], got[i]["s"], got[i]["n"]) if i in got else (0.0, 0.0, 0) for i in range(len(coefs))]


def tune(df: DataFrame, label: str, numeric, categorical, model_name: str, n_trials: int = TRIALS,
         task: str = "eta", k: int | None = None, parallelism: int = 4) -> DataFrame:
    """seeded random search minimising the MAE over held-out folds. One row:
    model, params (map), and the best trial's mae and rmse on the held-out rows.

    Folds are cut by a hash of the row. The preprocessor is fitted once per fold,
    on its training rows, and all trials of the fold share it. Linear trials are fitted
    on rows with the fold's moments and their errors summed in one pass over the held-out
    rows; over many rows the
    trees of all trials grow together (``trees``); others run ``parallelism`` at a time. Each comes back as one row of error sums."""
    from concurrent.futures import ThreadPoolExecutor

    k = k or DEFAULTS.cv_folds
    data = df.withColumns({"label": F.col(label).cast("double"), "_row": F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])})
    est = estimators(task, *label_scale(data, "label"))[model_name]
    draws = sample_params(SPACES[model_name], n_trials)
    data = with_folds(data, "_row", k)
    totals = [[0.0, 0.0, 0] for _ in draws]
    err = F.col("prediction") - F.col("label")
    sums = [F.sum(F.abs(err)).alias("a"), F.sum(err * err).alias("s"), F.count(F.lit(1)).alias("n")]
    for f in range(k):
        train = data.where(F.col("fold") != f)
        prep = Pipeline(stages=build_preprocessor(numeric, categorical)).fit(train)
        train = prep.transform(train).select("features", "label").cache()
        held = prep.transform(data.where(F.col("fold") == f)).select("features", "label").cache()

        linear = isinstance(est, LinearRegression)
        if linear:
            few = _moment_rows(train, len(train.first()["features"]))

        def trial(draw: dict):
            at = {getattr(est, name): value for name, value in draw.items()}
            if linear:  # noqa: B023
                return est.fit(few, at | {est.weightCol: "weight"})  # noqa: B023
            r = est.fit(train, at).transform(held).agg(*sums).first()  # noqa: B023
            return r["a"] or 0.0, r["s"] or 0.0, r["n"]

        if isinstance(est, DecisionTreeRegressor) and trees.many(train):
            found = trees.errors(trees.fit_trial_trees(train, draws), held)
        else:
            with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
                found = list(pool.map(trial, draws))
        if linear:
            few.unpersist()
            found = _linear_errors(held, found)
        for total, sums_of in zip(totals, found):
            for i, x in enumerate(sums_of):
                total[i] += x
        train.unpersist()
        held.unpersist()
    best = min(range(len(draws)), key=lambda i: totals[i][0])
    a, sq, n = totals[best]
    return df.sparkSession.createDataFrame(
        [(model_name, {name: str(v) for name, v in draws[best].items()}, a / n, (sq / n) ** 0.5)],
        "model string, params map<string,string>, mae double, rmse double")


def residuals(oof: DataFrame, board: DataFrame, top_n: int = 3) -> DataFrame:
    """F16: prediction - actual for the ``top_n`` best models by MAE."""
    best = board.orderBy("mae", "model").limit(top_n).select("model")
    return oof.join(F.broadcast(best), "model").withColumn("residual", F.col("prediction") - F.col("actual"))


def feature_ablation(board_with: DataFrame, board_without: DataFrame) -> DataFrame:
    """MAE with and without a feature and the gain per model."""
    a = board_with.select("model", F.col("mae").alias("mae_with"))
    b = board_without.select("model", F.col("mae").alias("mae_without"))
    return a.join(b, "model").withColumn("mae_gain", F.col("mae_without") - F.col("mae_with"))


def record_experiments(board: DataFrame, task: str, run_ts: Column | None = None, metric: str = "mae") -> DataFrame:
    """leaderboard rows for the experiments table with ``is_winner``.
    ``train_time_s`` is the board's (seconds its fits took), null where it has none."""
    took = F.col("train_time_s").cast("double") if "train_time_s" in board.columns else F.lit(None).cast("double")
    ts = run_ts if run_ts is not None else F.current_timestamp()
    win = select_best(board, metric).select(F.col("model").alias("_w"))
    return board.join(F.broadcast(win), F.col("model") == F.col("_w"), "left").select(
        F.xxhash64(F.lit(task), "model", ts.cast("string")).alias("experiment_id"), F.lit(task).alias("task"),
        F.col("model").alias("model_name"), "mae", "rmse", "r2", took.alias("train_time_s"),
        F.lit(None).cast("string").alias("run_id"), F.col("_w").isNotNull().alias("is_winner"), ts.alias("created_at"))


def score_eta(features: DataFrame, model: PipelineModel, threshold: float | None = None) -> DataFrame:
    """predicted minutes rounded to 1 decimal and the at-risk flag."""
    th = float(threshold or DEFAULTS.eta_risk_minutes)
    p = model.transform(features)
    return p.withColumn("predicted_minutes", F.bround("prediction", 1)).withColumn(
        "is_at_risk", F.col("prediction") > th)


def linear_contributions(model: PipelineModel, df: DataFrame, key: str, rows: DataFrame | None = None) -> DataFrame:
    """F20 (per row): coef_j * (x_j - mean_j) on the model's feature vector
    (for a linear last stage); the coefficients are a bounded driver list.
    Means are over ``df``; ``rows`` (default all of ``df``) get contributions."""
    from pyspark.ml.functions import vector_to_array
    lin = model.stages[-1]
    coefs = [float(c) for c in lin.coefficients]
    p = model.transform(df).select(key, vector_to_array("features").alias("_x"))
    if rows is None:
        p = materialize(p)  # the means and the contributions read it
    means = p.select(*[F.col("_x")[i].alias(f"m{i}") for i in range(len(coefs))]).agg(
        *[F.avg(f"m{i}").alias(f"m{i}") for i in range(len(coefs))])
    if rows is not None:
        p = model.transform(rows).select(key, vector_to_array("features").alias("_x"))
    x = with_stats(p, means, "_mu")
    contrib = F.array(*[F.lit(c) * (F.col("_x")[i] - F.col("_mu")[f"m{i}"]) for i, c in enumerate(coefs)])
    return x.select(key, F.posexplode(contrib).alias("feature_index", "contribution"))


def permutation_importance(model: PipelineModel, df: DataFrame, label: str, cols: Sequence[str],
                           key: str, seed: int | None = None) -> DataFrame:
    """F20 (global): MAE increase when one column is shuffled across rows.

    The shuffle pairs each row with the row of the same rank in a seeded
    random order: both ranks come from ``global_rank`` (bucketed), and the
    pairing is an equi-join on the rank, so no row is moved to one task."""
    seed = DEFAULTS.random_seed if seed is None else seed
    df = materialize(df)  # every column reads the features, and the rows' own ranks
    base = regression_metrics(score_eta(df, model).select(F.col(label).alias("actual"), "prediction"))
    base_mae = base.select("mae")
    rows = []
    # orders from a hash of the key: the same after a lost task
    src = materialize(global_rank(df.withColumn("_r", F.xxhash64(F.col(key), F.lit(seed))), [], "_r", key, descending=False, rank_col="_a", split_ties=False))
    for i, c in enumerate(cols):
        donor = global_rank(df.withColumn("_r2", F.xxhash64(F.col(key), F.lit(seed + i + 1))), [], "_r2", key, descending=False,
                            rank_col="_a", split_ties=False).select("_a", F.col(c).alias("_donor"))
        shuffled = src.join(donor, "_a").withColumn(c, F.col("_donor")).drop("_donor", "_a", "_r")
        m = regression_metrics(model.transform(shuffled).select(F.col(label).alias("actual"), "prediction"))
        rows.append(m.select(F.lit(c).alias("feature"), F.col("mae").alias("mae_shuffled")))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    out = with_stats(out, base_mae, "_b")
    return out.withColumn("mae_base", F.col("_b.mae")).drop("_b").withColumn(
        "importance", F.col("mae_shuffled") - F.col("mae_base"))


def example_predictions(scored: DataFrame, key: str, prediction: str = "prediction") -> DataFrame:
    """the fastest, the median-rank (n // 2, zero-based) and the slowest
    prediction; ranks from the bucketed running count."""
    r = global_rank(scored, [], prediction, key, descending=False, rank_col="_rk")
    x = with_stats(r, scored.agg(F.count(F.lit(1)).alias("n")), "_n")
    n = F.col("_n.n")
    lab = (F.when(F.col("_rk") == 1, "fast").when(F.col("_rk") == n, "slow")
           .when(F.col("_rk") == F.floor(n / 2) + 1, "normal"))
    return x.withColumn("example", lab).where(F.col("example").isNotNull()).drop("_rk", "_n")


def log_predictions(scored: DataFrame, model_name: str, input_cols: Sequence[str], version: str | None = None,
                    attributions: DataFrame | None = None, key: str | None = None) -> DataFrame:
    """prediction log rows with the SHA-256 of the input JSON (sorted keys)."""
    inp = F.to_json(F.struct(*[F.col(c) for c in sorted(input_cols)]))
    out = scored.select(
        *([key] if key else []), F.lit(model_name).alias("model_name"), F.lit(version).cast("string").alias("model_version"),
        F.sha2(inp, 256).alias("input_hash"), inp.alias("input_data"), F.col("prediction").alias("output_value"),
        F.current_timestamp().alias("created_at"))
    if attributions is not None and key:
        amap = attributions.groupBy(key).agg(F.map_from_entries(F.collect_list(
            F.struct(F.col("feature_index").cast("string"), F.col("contribution")))).alias("shap_values"))
        out = out.join(amap, key, "left")
    return out


def explain(predictions: DataFrame, ids: DataFrame, key: str = "prediction_id") -> DataFrame:
    """F23 (bulk): the logged predictions of the requested ids."""
    return predictions.join(ids.select(key).distinct(), key, "left_semi")


def tune_all(df: DataFrame, label: str, numeric, categorical, models: Sequence[str], n_trials: int = TRIALS,
             task: str = "eta") -> DataFrame:
    """F14 for each model; a model without a search space keeps its default
    parameters (empty map) with null metrics. A search that fails is an error."""
    spark = df.sparkSession
    schema = "model string, params map<string,string>, mae double, rmse double, tuned boolean"
    rows = []
    for name in models:
        if name not in SPACES:  # nothing to search: keeps its defaults
            rows.append((name, {}, None, None, False))
            continue
        r = tune(df, label, numeric, categorical, name, n_trials=n_trials, task=task).first()
        rows.append((name, dict(r["params"]), r["mae"], r["rmse"], True))
    return spark.createDataFrame(rows, schema)
