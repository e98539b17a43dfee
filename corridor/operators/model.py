"""Four-weight linear travel-time model: predict, training features, fit, weights I/O.

``multiplier = max(1, w0 + w1*clamp(c,0,1) + w2*max(0,rain) + w3*|temp-20|)``
and ``travel time = length / (limit/3.6) * multiplier``. Prediction is a
pure column expression (no UDF), so scoring every segment is one
projection inside whole-stage codegen.

Training is full-batch gradient descent on the mean squared error of the
multiplier. Loss and gradient depend on the data only through
N, XᵀX, Xᵀy and yᵀy (4 features), so the data is read by **one** Spark
aggregate (15 numbers, combined map-side on every task); the epochs then
iterate on those numbers on the driver. That is the same sequence of
weights as iterating over every row each epoch, up to float rounding, and
its cost does not grow with the number of epochs.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corridor.functions.numeric import clamp, rnd

# Default weights, feature defaults and training defaults.
DEFAULT_WEIGHTS = {"w0": 1.0, "w1": 3.0, "w2": 0.05, "w3": 0.01}
DEFAULT_LENGTH_M = 1000.0
DEFAULT_LIMIT_KMH = 50.0
DEFAULT_TEMP_C = 20.0
KMH_PER_MS = 3.6
MIN_W0 = 0.5
EPOCHS, LEARNING_RATE = 500, 0.01

def free_flow_time(length: Column, limit: Column) -> Column:
    """Seconds at the speed limit; a 0/NULL limit means 50 km/h."""
    lim = F.coalesce(F.when(limit != 0, limit), F.lit(DEFAULT_LIMIT_KMH))
    return length / (lim / F.lit(KMH_PER_MS))


def features(congestion: Column, rain: Column, temp: Column) -> tuple[Column, Column, Column]:
    """x1..x3; a NULL input counts as its default (score 0, rain 0, 20 degrees)."""
    return (clamp(F.coalesce(congestion, F.lit(0.0)), 0.0, 1.0), F.greatest(F.lit(0.0), rain),
            F.abs(F.coalesce(temp, F.lit(DEFAULT_TEMP_C)) - F.lit(DEFAULT_TEMP_C)))


def multiplier(congestion: Column, rain: Column, temp: Column, w: dict | None = None) -> Column:
    w = {**DEFAULT_WEIGHTS, **(w or {})}
    x1, x2, x3 = features(congestion, rain, temp)
    m = F.lit(float(w["w0"])) + F.lit(float(w["w1"])) * x1 + F.lit(float(w["w2"])) * x2 \
        + F.lit(float(w["w3"])) * x3
    return F.greatest(F.lit(1.0), m)


def predict(length: Column, limit: Column, congestion: Column, rain: Column, temp: Column,
            w: dict | None = None) -> Column:
    """Predicted travel time in seconds, rounded to 2 decimals."""
    return rnd(free_flow_time(length, limit) * multiplier(congestion, rain, temp, w), 2)


def predict_response(length: Column, limit: Column, congestion: Column, rain: Column, temp: Column,
                     w: dict | None = None) -> dict[str, Column]:
    """Prediction, rounded free-flow time, and the multiplier against the rounded free flow."""
    pred = predict(length, limit, congestion, rain, temp, w)
    ff = rnd(length / (limit / F.lit(KMH_PER_MS)), 2)
    mult = F.when(ff > 0, rnd(pred / ff, 2)).otherwise(F.lit(1.0))
    return {"predicted_time_seconds": pred, "free_flow_time_seconds": ff, "congestion_multiplier": mult}


def training_rows(df: DataFrame, keep=()) -> DataFrame:
    """Features x1..x3 and the target multiplier y = actual / free flow.

    NULL inputs take the defaults (length 1000, limit 50, score 0, rain 0,
    temp 20). Rows without an actual time (NULL or 0) or with a non-positive
    free-flow time are skipped.
    """
    def col(name, default):
        return F.coalesce(F.col(name), F.lit(default)) if name in df.columns else F.lit(default)
    length, limit = col("length", DEFAULT_LENGTH_M), col("speed_limit", DEFAULT_LIMIT_KMH)
    ff = F.try_divide(length, limit / F.lit(KMH_PER_MS))
    actual = F.col("actual_time")
    x1, x2, x3 = features(col("congestion_score", 0.0), col("rain_intensity", 0.0), col("temperature", DEFAULT_TEMP_C))
    return (df.filter(actual.isNotNull() & (actual != 0) & ff.isNotNull() & (ff > 0))
            .select(*keep, x1.alias("x1"), x2.alias("x2"), x3.alias("x3"), (actual / ff).alias("y")))


def gram(rows: DataFrame) -> DataFrame:
    """One row: n and the 14 sums of XᵀX (bias included), Xᵀy and yᵀy."""
    xs = ["x1", "x2", "x3"]
    sums = [F.count(F.lit(1)).alias("n")]
    sums += [F.sum(x).alias(f"s_{x}") for x in xs]
    sums += [F.sum(F.col(a) * F.col(b)).alias(f"s_{a}{b}") for i, a in enumerate(xs) for b in xs[i:]]
    sums += [F.sum("y").alias("s_y")] + [F.sum(F.col(x) * F.col("y")).alias(f"s_{x}y") for x in xs]
    sums += [F.sum(F.col("y") * F.col("y")).alias("s_yy")]
    return rows.agg(*sums)


def add_grams(grams: DataFrame) -> DataFrame:
    """Sums of several splits of the training rows, added up to one row."""
    return grams.agg(*[F.sum(c).alias(c) for c in grams.columns])


def fit_from_gram(g: dict, weights: dict | None = None, epochs: int = EPOCHS,
                  lr: float = LEARNING_RATE) -> dict:
    """Projected gradient descent on 4 weights using the sufficient statistics.

    Warm-starts from ``weights``; after each step w0 >= 0.5 and w1..w3 >= 0.
    The reported loss is the one computed before the final step.
    """
    w = dict(DEFAULT_WEIGHTS if weights is None else weights)
    n = int(g["n"] or 0)
    if n == 0:
        return {"status": "skipped", "reason": "no usable rows", "weights": w}
    s = {k: float(v or 0.0) for k, v in g.items()}
    G = [[n, s["s_x1"], s["s_x2"], s["s_x3"]],
         [s["s_x1"], s["s_x1x1"], s["s_x1x2"], s["s_x1x3"]],
         [s["s_x2"], s["s_x1x2"], s["s_x2x2"], s["s_x2x3"]],
         [s["s_x3"], s["s_x1x3"], s["s_x2x3"], s["s_x3x3"]]]
    b = [s["s_y"], s["s_x1y"], s["s_x2y"], s["s_x3y"]]
    v = [w["w0"], w["w1"], w["w2"], w["w3"]]
    loss = 0.0
    history = []
    for epoch in range(epochs):
        gv = [sum(G[i][j] * v[j] for j in range(4)) for i in range(4)]
        loss = sum(v[i] * gv[i] for i in range(4)) - 2 * sum(v[i] * b[i] for i in range(4)) + s["s_yy"]
        loss = max(0.0, loss)       # a sum of squares; rounding can leave it just below 0
        grad = [(2.0 / n) * (gv[i] - b[i]) for i in range(4)]
        v = [v[i] - lr * grad[i] for i in range(4)]
        v = [max(MIN_W0, v[0]), max(0.0, v[1]), max(0.0, v[2]), max(0.0, v[3])]
        if epoch % 100 == 0 or epoch == epochs - 1:
            # Progress as the per-row loop reports it: MSE before the step,
            # weights after it.
            history.append({"epoch": epoch, "mse": loss / n, "weights": list(v)})
    w = {"w0": v[0], "w1": v[1], "w2": v[2], "w3": v[3]}
    return {"status": "success", "samples": n, "final_loss": loss / n, "weights": w, "history": history}


def fit(df: DataFrame, weights: dict | None = None, epochs: int = EPOCHS, lr: float = LEARNING_RATE) -> dict:
    """Train on a DataFrame of raw rows (length, speed_limit, ..., actual_time).

    An empty input is skipped with reason "empty input"; rows that all lack a
    usable target are skipped with "no usable rows" (emptiness is checked
    only on that path).
    """
    g = gram(training_rows(df)).first().asDict()
    res = fit_from_gram(g, weights, epochs, lr)
    if res["status"] == "skipped" and df.isEmpty():
        res["reason"] = "empty input"
    return res


WEIGHTS_SCHEMA = T.StructType([T.StructField(k, T.DoubleType()) for k in DEFAULT_WEIGHTS])


def weights_frame(spark: SparkSession, w: dict) -> DataFrame:
    return spark.createDataFrame([tuple(float(w[k]) for k in DEFAULT_WEIGHTS)], WEIGHTS_SCHEMA)


def save_weights(spark: SparkSession, w: dict, path: str) -> None:
    """One small JSON file (one row) under ``path``."""
    weights_frame(spark, w).coalesce(1).write.mode("overwrite").json(path)


def load_weights(spark: SparkSession, path: str, current: dict | None = None) -> dict:
    """Weights from ``path``; a missing key keeps the current value, a missing
    or malformed file keeps all of them. Any other failure (a store that cannot be
    reached, a refused read) is the caller's to see."""
    base = dict(current or DEFAULT_WEIGHTS)
    try:
        row = spark.read.schema(WEIGHTS_SCHEMA).json(path).first()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return base
    if row is None:
        return base
    return {k: (row[k] if row[k] is not None else base[k]) for k in base}


def weights_json(w: dict) -> str:
    return json.dumps({k: w[k] for k in DEFAULT_WEIGHTS}, indent=4)
