"""The four end-to-end jobs."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import (
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.ml.tuning import CrossValidatorModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linfit.functions.features import (
    array_to_features,
    assemble,
    feature_element,
    fill_numeric,
    slice_features,
    tokenize,
)
from linfit.operators.encoding import Scaling, label_map, label_map_difference
from linfit.operators.fold_moments import split_moments
from linfit.operators.instances import spread
from linfit.operators.linear import LinearModel, ridge_native, solve_positive_definite
from linfit.operators.metrics import multiclass_accuracy
from linfit.operators.multinomial import (
    MultinomialSearch,
    cross_validate_multinomial,
    multinomial_predict,
)
from linfit.operators.resample import BUCKETS, holdout, key_bucket, with_fold
from linfit.plans.tuning import (
    CVResult,
    cross_entropy_evaluator,
    cross_validate_logistic,
    cross_validate_native,
    param_grid,
    score_best,
)
from linfit.sources.files import write_csv, write_probabilities
from linfit.sources.schemas import (
    CLICK_CATEGORIES,
    CLICK_LABEL,
    CLICK_WEIGHT,
    LEAF_FEATURES,
    SONG_FIELDS,
    SONG_TIMBRE_AVERAGE,
    SONG_TIMBRE_COVARIANCE,
    click_numeric_features,
    feature_group,
)


@dataclass
class CollisionResult:
    search: CVResult
    holdout_score: DataFrame


def collision_job(
    data: DataFrame,
    group: str = "high",
    test_fraction: float = 0.3,
    k: int = 3,
    degrees: Sequence[int] = (1, 2, 3),
    lambdas: Sequence[float] = (0.001, 0.01, 0.1, 0.5),
    method: str = "gradient",
    max_iter: int = 100,
    learning_rate: float = 0.01,
    score_type: str = "accuracy",
    keys: Sequence[str] = (),
    hash_fn: str = "xxhash64",
) -> CollisionResult:
    """Search (degree, lambda) on the training rows, then score the winner on the others.

    Rows without a key of their own are split by the columns that are read anyway. The rate
    applies to a gradient summed over rows, so it has to shrink as the table grows.
    """
    keys = list(keys) or ["label", *feature_group(group)]
    slim = data.select("*", assemble(feature_group(group)).alias("features"))
    train, test = holdout(slim, keys, test_fraction, hash_fn)
    train = with_fold(train, keys, k, hash_fn=hash_fn).select("label", "features", "fold")
    search = cross_validate_logistic(
        spread(train),
        k=k,
        grid=param_grid(degrees, lambdas),
        method=method,
        max_iter=max_iter,
        learning_rate=learning_rate,
        score_type=score_type,
    )
    return CollisionResult(search, score_best(test.select("label", "features"), search))


@dataclass
class SongYearResult:
    means: list[float]
    own: LinearModel
    native: LinearModel
    scores: DataFrame


def song_instances(lines: DataFrame, fields: int = SONG_FIELDS, *keys: str) -> DataFrame:
    """``(keys.., values)``: the numbers of each line; a line of another length raises."""
    return lines.select(*keys, array_to_features(tokenize("value", ",", fields)).alias("values"))


def song_features(centred: DataFrame, fields: int = SONG_FIELDS) -> DataFrame:
    """``label`` from position 0, ``features`` from the rest, and the two timbre groups."""
    out = centred.select(
        feature_element("values", 0).alias("label"),
        slice_features("values", range(1, fields)).alias("features"),
    )
    if fields == SONG_FIELDS:
        out = out.withColumns(
            {
                "timbre_avg": slice_features("features", SONG_TIMBRE_AVERAGE),
                "timbre_cov": slice_features("features", SONG_TIMBRE_COVARIANCE),
            }
        )
    return out


def song_year_job(
    lines: DataFrame,
    test_fraction: float = 0.3,
    l2: float = 0.1,
    fields: int = SONG_FIELDS,
    hash_fn: str = "xxhash64",
) -> SongYearResult:
    """Ridge regression of a line's first number on the others, own solver beside the library's.

    All fields are centred on the training means, which replaces an intercept. One pass over the
    lines sums the products of both sides of the split; means, the own fit and every error follow
    from these sums. The library's fit reads the training lines once more, and nothing is kept.
    """
    if l2 < 0:
        raise ValueError("l2 must not be negative")
    held = key_bucket(["value"], hash_fn) < int(test_fraction * BUCKETS)
    values = song_instances(spread(lines.withColumn("fold", held.cast("int"))), fields, "fold")
    moments = split_moments(values, "values", "fold", fields)
    rows, mean, around = moments.outside(1)
    # The first number is the label, the last entry of a linear fit.
    around, held_out = (np.roll(m, -1, (0, 1)) for m in (around, moments.products_around(1, mean)))
    theta = solve_positive_definite(around[:-1, :-1] + l2 * np.eye(fields - 1), around[:-1, -1])
    own = LinearModel([float(t) for t in theta])
    scaling = Scaling([float(m) for m in mean], [0.0] * fields)
    train = values.where("fold = 0").select(scaling.apply("values", True, False).alias("values"))
    native = ridge_native(song_features(train, fields), reg_param=l2)

    def error(model: LinearModel, products: np.ndarray, n: float) -> float | None:
        w = np.append(-np.array(model.theta), 1.0)
        return float(np.sqrt(max(w @ products @ w, 0.0) / n)) if n else None

    tested = moments.rows[1]
    found = error(own, held_out, tested), error(native, held_out, tested), error(native, around, rows)
    scores = lines.sparkSession.createDataFrame(
        [found], "own_rmse double, native_rmse double, native_train_rmse double"
    )
    return SongYearResult(scaling.mean, own, native, scores)


@dataclass
class ClickResult:
    model: PipelineModel
    validation: DataFrame
    accuracy: DataFrame
    predictions: DataFrame


def click_stages(handle_invalid: str = "keep", max_iter: int = 100) -> list:
    """Index and one-hot the categories, assemble, scale, fit with the click price as weight.

    All categories share one indexing pass.
    """
    indexed = [f"{c}_index" for c in CLICK_CATEGORIES]
    encoded = [f"{c}_vec" for c in CLICK_CATEGORIES]
    return [
        StringIndexer(
            inputCols=CLICK_CATEGORIES, outputCols=indexed, handleInvalid=handle_invalid
        ),
        OneHotEncoder(inputCols=indexed, outputCols=encoded),
        VectorAssembler(inputCols=click_numeric_features() + encoded, outputCol="features"),
        StandardScaler(inputCol="features", outputCol="scaled"),
        LogisticRegression(
            labelCol=CLICK_LABEL,
            featuresCol="scaled",
            weightCol=CLICK_WEIGHT,
            maxIter=max_iter,
            fitIntercept=True,
        ),
    ]


def click_job(
    labelled: DataFrame,
    unlabelled: DataFrame,
    out: str,
    keys: Sequence[str] = (),
    test_fraction: float = 0.3,
    max_iter: int = 100,
    output_keys: Sequence[str] = (),
) -> ClickResult:
    """Fit on the training split, validate on the rest, write predictions for new rows.

    Numeric nulls become 0.0; null or unseen categories get a slot of their own.
    """
    labelled, unlabelled = fill_numeric(labelled), fill_numeric(unlabelled)
    train, validation = holdout(labelled, list(keys) or labelled.columns, test_fraction)
    train = spread(train).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = Pipeline(stages=click_stages(max_iter=max_iter)).fit(train)
    finally:
        train.unpersist()
    scored = model.transform(validation)
    predictions = model.transform(unlabelled)
    write_csv(predictions, out, ["prediction"], output_keys)
    accuracy = multiclass_accuracy(scored, CLICK_LABEL)
    return ClickResult(model, scored, accuracy, predictions)


@dataclass
class LeafResult:
    search: MultinomialSearch | CrossValidatorModel
    probabilities: DataFrame
    fitted_labels: DataFrame
    label_difference: DataFrame


def leaf_stages(
    vocabulary: Sequence[str], columns: Sequence[str] = tuple(LEAF_FEATURES), max_iter: int = 400
) -> list:
    return [
        StringIndexerModel.from_labels(list(vocabulary), inputCol="species", outputCol="label"),
        VectorAssembler(inputCols=list(columns), outputCol="raw_features"),
        StandardScaler(
            inputCol="raw_features", outputCol="features", withMean=True, withStd=True
        ),
        LogisticRegression(fitIntercept=True, maxIter=max_iter),
    ]


def leaf_job(
    spark: SparkSession,
    train: DataFrame,
    test: DataFrame,
    vocabulary: Sequence[str],
    out: str,
    columns: Sequence[str] = tuple(LEAF_FEATURES),
    k: int = 10,
    reg_params: Sequence[float] = (0.000003, 0.00003, 0.0003, 0.003, 0.03, 0.3),
    max_iter: int = 400,
    tol: float = 1e-6,
    solver: str = "own",
    parallelism: int = 4,
) -> LeafResult:
    """Choose the regularisation by cross-entropy, write class probabilities of unlabelled rows.

    Probabilities come in the vocabulary's order. The fold is a hash of the row's id. ``own`` fits
    all folds and penalties in the same passes; ``library`` fits them one after another.
    """
    if solver not in ("own", "library"):
        raise ValueError(f"unknown solver {solver!r}: use 'own' or 'library'")
    stages = leaf_stages(vocabulary, columns, max_iter)
    folded = spread(with_fold(train, ["id"], k))
    if solver == "own":
        rows = stages[0].transform(folded).select("label", "fold", assemble(columns).alias("features"))
        search = cross_validate_multinomial(
            rows, k, reg_params, len(vocabulary), max_iter=max_iter, tol=tol
        )
        asked = test.select("id", assemble(columns).alias("features"))
        probabilities = multinomial_predict(asked, search.model, keys=["id"])
        labels = stages[0].labels
    else:
        search = cross_validate_native(
            folded,
            stages,
            [(stages[-1].regParam, reg_params)],
            cross_entropy_evaluator(),
            k,
            fold="fold",
            parallelism=parallelism,
        )
        probabilities = search.bestModel.transform(test).select("id", "probability")
        labels = search.bestModel.stages[0].labels
    write_probabilities(probabilities, out)
    fitted = label_map(spark, labels)
    return LeafResult(
        search,
        probabilities,
        fitted,
        label_map_difference(fitted, label_map(spark, vocabulary)),
    )
