"""Queries over `training`: features, Gram sums, predictions, custom predictions, fit."""

from __future__ import annotations

from pyspark.sql import functions as F

from corridor.functions.numeric import rnd
from corridor.operators import model, validate
from corridor.plans.catalog import register, rnd_sql
from corridor.plans.views import duck_with, view

_W = model.DEFAULT_WEIGHTS


def _lit(v: float) -> str:
    return f"{v!r}e0"


_X1 = "greatest(0e0, least(1e0, COALESCE(congestion_score, 0e0)))"
_X2 = "greatest(0e0, COALESCE(rain_intensity, 0e0))"
_X3 = "abs(COALESCE(temperature, 2e1) - 2e1)"
_FF = "(COALESCE(length, 1e3) / (COALESCE(speed_limit, 5e1) / 36e-1))"

TR_SQL = duck_with("training").rstrip() + f""",
tr AS (SELECT l_orderkey, l_linenumber, {_X1} AS x1, {_X2} AS x2, {_X3} AS x3, actual_time / {_FF} AS y
  FROM training WHERE actual_time IS NOT NULL AND actual_time <> 0 AND {_FF} > 0)
"""


@register("training_features", TR_SQL + "SELECT * FROM tr")
def q_training_features(spark, sf):
    return model.training_rows(view(spark, sf, "training"), keep=["l_orderkey", "l_linenumber"])


_SUMS = ["x1", "x2", "x3"]
_GRAM_COLS = (["s_x1", "s_x2", "s_x3"] + [f"s_{a}{b}" for i, a in enumerate(_SUMS) for b in _SUMS[i:]]
              + ["s_y", "s_x1y", "s_x2y", "s_x3y", "s_yy"])


def _gram_expr(name: str) -> str:
    body = name[2:]
    if body in ("x1", "x2", "x3", "y"):
        return body
    if body == "yy":
        return "y * y"
    if body.endswith("y"):
        return f"{body[:-1]} * y"
    return f"{body[:2]} * {body[2:]}"


@register("training_gram", TR_SQL + "SELECT COUNT(*) AS n, " + ", ".join(
    f"{rnd_sql(f'SUM({_gram_expr(c)})', 4)} AS {c}" for c in _GRAM_COLS) + " FROM tr")
def q_training_gram(spark, sf):
    """The sufficient statistics of the fit (rounded to 1e-4 for comparison)."""
    g = model.gram(model.training_rows(view(spark, sf, "training")))
    return g.select("n", *[rnd(F.col(c), 4).alias(c) for c in _GRAM_COLS])


def _mult_sql() -> str:
    return (f"greatest(1e0, {_lit(_W['w0'])} + {_lit(_W['w1'])} * greatest(0e0, least(1e0, congestion_score)) "
            f"+ {_lit(_W['w2'])} * greatest(0e0, rain_intensity) + {_lit(_W['w3'])} * abs(temperature - 2e1))")


_PRED = rnd_sql(f"(length / (COALESCE(NULLIF(speed_limit, 0e0), 5e1) / 36e-1)) * {_mult_sql()}", 2)


@register("predict_travel_time", duck_with("training") +
          f"SELECT l_orderkey, l_linenumber, {_PRED} AS predicted_time FROM training")
def q_predict_travel_time(spark, sf):
    t = view(spark, sf, "training")
    return t.select("l_orderkey", "l_linenumber",
                    model.predict(F.col("length"), F.col("speed_limit"), F.col("congestion_score"),
                                  F.col("rain_intensity"), F.col("temperature")).alias("predicted_time"))


_FFR = rnd_sql("length / (speed_limit / 36e-1)", 2)


@register("predict_custom", duck_with("training").rstrip() + f""",
req AS (SELECT l_orderkey, l_linenumber, length, speed_limit, congestion_score,
    COALESCE(rain_intensity, 0e0) AS rain_intensity, COALESCE(temperature, 2e1) AS temperature FROM training
  WHERE length > 0 AND speed_limit > 0 AND congestion_score BETWEEN 0 AND 1 AND COALESCE(rain_intensity, 0e0) >= 0),
p AS (SELECT l_orderkey, l_linenumber, {_PRED} AS predicted_time_seconds, {_FFR} AS free_flow_time_seconds FROM req)
SELECT l_orderkey, l_linenumber, predicted_time_seconds, free_flow_time_seconds,
  CASE WHEN free_flow_time_seconds > 0 THEN {rnd_sql('predicted_time_seconds / free_flow_time_seconds', 2)}
       ELSE 1e0 END AS congestion_multiplier FROM p""")
def q_predict_custom(spark, sf):
    """Custom-feature predictions for every well-formed request row."""
    valid, _ = validate.validate_prediction_request(view(spark, sf, "training"),
                                                    keep=("l_orderkey", "l_linenumber"))
    r = model.predict_response(F.col("length"), F.col("speed_limit"), F.col("congestion_score"),
                               F.col("rain_intensity"), F.col("temperature"))
    return valid.select("l_orderkey", "l_linenumber", *[v.alias(k) for k, v in r.items()])


_REASON = """concat_ws(';', CASE WHEN length IS NULL OR length <= 0 THEN 'length_invalid' END,
  CASE WHEN speed_limit IS NULL OR speed_limit <= 0 THEN 'speed_limit_invalid' END,
  CASE WHEN congestion_score IS NULL OR congestion_score < 0 OR congestion_score > 1 THEN 'congestion_score_invalid' END,
  CASE WHEN rain_intensity < 0 THEN 'rain_intensity_invalid' END)"""


@register("predict_requests", duck_with("requests").rstrip() + f""",
req AS (SELECT l_orderkey, l_linenumber, length, speed_limit, congestion_score,
    COALESCE(rain_intensity, 0e0) AS rain_intensity, COALESCE(temperature, 2e1) AS temperature FROM requests WHERE {_REASON} = '')
SELECT l_orderkey, l_linenumber, {_PRED} AS predicted_time_seconds FROM req""")
def q_predict_requests(spark, sf):
    """Predictions of the well-formed among requests of which many are not."""
    valid, _ = validate.validate_prediction_request(view(spark, sf, "requests"), keep=("l_orderkey", "l_linenumber"))
    r = model.predict_response(F.col("length"), F.col("speed_limit"), F.col("congestion_score"),
                               F.col("rain_intensity"), F.col("temperature"))
    return valid.select("l_orderkey", "l_linenumber", r["predicted_time_seconds"].alias("predicted_time_seconds"))


@register("predict_request_rejects", duck_with("requests") +
          f"SELECT l_orderkey, l_linenumber, {_REASON} AS reason FROM requests WHERE {_REASON} <> ''")
def q_predict_request_rejects(spark, sf):
    """Requests that are refused, with every reason."""
    _, rejected = validate.validate_prediction_request(view(spark, sf, "requests"), keep=("l_orderkey", "l_linenumber"))
    return rejected.select("l_orderkey", "l_linenumber", "reason")


def _fit_sql() -> str:
    w, lr = _W, model.LEARNING_RATE
    g = ("g AS (SELECT COUNT(*) AS n, SUM(x1) AS s1, SUM(x2) AS s2, SUM(x3) AS s3, SUM(x1 * x1) AS s11, "
         "SUM(x1 * x2) AS s12, SUM(x1 * x3) AS s13, SUM(x2 * x2) AS s22, SUM(x2 * x3) AS s23, "
         "SUM(x3 * x3) AS s33, SUM(y) AS sy, SUM(x1 * y) AS s1y, SUM(x2 * y) AS s2y, SUM(x3 * y) AS s3y, "
         "SUM(y * y) AS syy FROM tr)")
    step = {i: f"w{i} - {_lit(lr)} * ((2e0 / n) * (g{i} - {b}))"
            for i, b in enumerate(("sy", "s1y", "s2y", "s3y"))}
    gd = f"""gd(k, w0, w1, w2, w3, loss) AS (
  SELECT 0, {_lit(w['w0'])}, {_lit(w['w1'])}, {_lit(w['w2'])}, {_lit(w['w3'])}, 0e0
  UNION ALL
  SELECT k + 1, greatest({_lit(model.MIN_W0)}, {step[0]}), greatest(0e0, {step[1]}),
    greatest(0e0, {step[2]}), greatest(0e0, {step[3]}),
    w0 * g0 + w1 * g1 + w2 * g2 + w3 * g3 - 2e0 * (w0 * sy + w1 * s1y + w2 * s2y + w3 * s3y) + syy
  FROM (SELECT gd.*, g.*,
      n * w0 + s1 * w1 + s2 * w2 + s3 * w3 AS g0, s1 * w0 + s11 * w1 + s12 * w2 + s13 * w3 AS g1,
      s2 * w0 + s12 * w1 + s22 * w2 + s23 * w3 AS g2, s3 * w0 + s13 * w1 + s23 * w2 + s33 * w3 AS g3
    FROM gd, g WHERE k < {model.EPOCHS}) t)
"""
    return (TR_SQL.replace("WITH ", "WITH RECURSIVE ", 1).rstrip() + ",\n" + g + ",\n" + gd +
            f"SELECT 'success' AS status, n AS samples, {rnd_sql('loss / n', 8)} AS final_loss, "
            + ", ".join(f"{rnd_sql(f'w{i}', 6)} AS w{i}" for i in range(4)) +
            f" FROM gd, g WHERE k = {model.EPOCHS}")


@register("model_fit", _fit_sql())
def q_model_fit(spark, sf):
    """Fitted weights: one Spark aggregate, then 500 epochs on 4 numbers.

    Weights are reported to 1e-6 and the loss to 1e-8; the oracle runs the
    same projected gradient descent over DuckDB's Gram sums.
    """
    res = model.fit(view(spark, sf, "training"))
    w = res["weights"]
    row = spark.createDataFrame(
        [(res["status"], int(res.get("samples", 0)), float(res.get("final_loss") or 0.0),
          float(w["w0"]), float(w["w1"]), float(w["w2"]), float(w["w3"]))],
        "status string, samples long, final_loss double, w0 double, w1 double, w2 double, w3 double")
    return row.select("status", "samples", rnd(F.col("final_loss"), 8).alias("final_loss"),
                      *[rnd(F.col(f"w{i}"), 6).alias(f"w{i}") for i in range(4)])
