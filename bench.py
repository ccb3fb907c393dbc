"""Headline timings as one JSON line.

    BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from linfit.catalog.base import KEYS, embeddings, lines  # noqa: E402
from linfit.functions.features import with_bias  # noqa: E402
from linfit.operators.instances import pack_blocks, spread  # noqa: E402
from linfit.operators.linear import ridge_fit  # noqa: E402
from linfit.operators.logistic import (  # noqa: E402
    Fit,
    fit_many,
    fused_gradient_loss,
    graded_terms,
    logistic_fit,
    logistic_hessian,
    logistic_native,
    logistic_predict,
)
from linfit.operators.metrics import area_under_roc, confusion_matrix  # noqa: E402
from linfit.operators.moments import gram  # noqa: E402
from linfit.operators.resample import with_fold  # noqa: E402
from linfit.plans.tuning import cross_validate_logistic, param_grid  # noqa: E402


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("linfit-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}

    def measure(name: str, run, divide: int = 1) -> None:
        start = time.perf_counter()
        run()
        times[name] = round((time.perf_counter() - start) / divide, 3)

    table = lines(spark, folder)
    # Seven features, as in the collision job's high-level group.
    x = [F.col("x0"), F.col("x1"), F.col("price")]
    seven = F.array(*x, x[0] * x[1], x[0] * x[2], x[1] * x[2], x[0] * x[1] * x[2])
    # Operators that read once scan the file; fits that read often deal it out to all cores.
    wide = table.select(*KEYS, "label", seven.alias("features"))
    dealt = spread(wide)
    rows = wide.count()
    with pack_blocks(dealt) as warm:  # starts the Python workers
        fit_many(warm, [Fit(graded_terms(warm.width, 1))], max_iter=1)

    theta = [0.01 * i for i in range(7)]
    vectors = spread(embeddings(spark, folder))
    measure("gradient_pass_columns", lambda: fused_gradient_loss(wide, theta, 0.1).collect())
    measure("hessian_columns", lambda: logistic_hessian(wide, theta).collect())
    measure("gram_narrow", lambda: gram(wide, width=7).collect())
    measure("gram_wide", lambda: gram(vectors).collect())
    measure(
        "ridge_fit",
        lambda: ridge_fit(wide.withColumn("y", F.col("features")[2]), label="y", l2=1.0, width=7),
    )
    with pack_blocks(dealt) as blocks:
        fit = [Fit(graded_terms(7, 1), 0.1)]
        measure(
            "gradient_pass_blocks",
            lambda: fit_many(blocks, fit, max_iter=10, learning_rate=1.0 / rows, tol=0.0),
            10,
        )
        measure("newton_pass_blocks", lambda: fit_many(blocks, fit, "newton", 5, tol=0.0), 5)
    measure(
        "logistic_gd_20",
        lambda: logistic_fit(dealt, max_iter=20, learning_rate=1.0 / rows, tol=0.0),
    )
    measure("logistic_newton", lambda: logistic_fit(dealt, method="newton", max_iter=8))
    measure("logistic_native", lambda: logistic_native(dealt, maxIter=20))
    model = logistic_fit(dealt, method="newton", max_iter=4)
    measure("predict_confusion", lambda: confusion_matrix(logistic_predict(wide, model)).collect())
    scored = logistic_predict(wide, model).select("label", F.col("prediction_prob").alias("score"))
    measure("area_under_roc", lambda: area_under_roc(scored))
    biased = wide.select(with_bias("features").alias("features"))
    measure("gram_biased_arrow", lambda: gram(biased).collect())
    folded = with_fold(dealt, KEYS, 3)
    measure(
        "cv_3x4x3_10_iterations",
        lambda: cross_validate_logistic(
            folded,
            k=3,
            grid=param_grid((1, 2, 3), (0.001, 0.01, 0.1, 0.5)),
            max_iter=10,
            learning_rate=0.1 / rows,
            tol=0.0,
        ),
    )
    total = round(sum(times.values()), 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": total,
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
