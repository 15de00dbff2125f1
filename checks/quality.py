"""Queries on evaluation, drift, scaling, metric sinks and panels."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import sales as Q
from checks.registry import register, with_ctes
from pricetide.functions.text import categorise
from pricetide.operators import drift
from pricetide.operators import evaluation as E
from pricetide.operators import kpis
from pricetide.operators import sales_features as S
from pricetide.session import shared_folder
from pricetide.sources import sinks
from pricetide.sources.warehouse import Warehouse

PREDICTIONS = Q.STATS + f""",
predictions as (select {Q.CATEGORY} as category, unit_price as actual, unnest(['mean', 'middle']) as model,
  unnest([product_avg_price_global, (product_price_min + product_price_max) / 2]) as predicted
  from clean join stats using (stock_code)),
errors as (select *, abs(actual - predicted) as e, abs(actual - predicted) / greatest(actual, 0.01::double) as r
  from predictions),
metrics as (select model, avg(e) as mae, sqrt(avg(e * e)) as rmse, avg(r) * 100 as mape,
  1 - avg(e * e) / var_pop(actual) as r2, quantile_cont(e, 0.5) as median_abs_error,
  avg(cast(r <= 0.05 as int)) * 100 as within_5pct, avg(cast(r <= 0.1 as int)) * 100 as within_10pct,
  avg(cast(r <= 0.2 as int)) * 100 as within_20pct from errors group by model)
"""
METRICS = ["mae", "rmse", "mape", "r2", "median_abs_error", "within_5pct", "within_10pct", "within_20pct"]


def predictions_of(spark, folder):
    """Two simple price models over every sale: the product's mean and the middle of its range."""
    c = Q.clean_of(spark, folder)
    df = c.join(S.product_stats(c), "stock_code")
    both = F.array(F.struct(F.lit("mean").alias("model"), F.col("product_avg_price_global").alias("predicted")),
                   F.struct(F.lit("middle").alias("model"),
                            ((F.col("product_price_min") + F.col("product_price_max")) / F.lit(2.0)).alias("predicted")))
    return df.select(categorise("description").alias("category"), F.col("unit_price").alias("actual"),
                     F.inline(both))


@register("regression_metrics", with_ctes(PREDICTIONS, "select model, " + ", ".join(
    f"round({m}, 6) as {m}" for m in METRICS) + " from metrics"))
def regression_metrics(spark, folder):
    return E.regression_metrics(predictions_of(spark, folder)).withColumns({m: F.round(m, 6) for m in METRICS})


@register("compare_models", with_ctes(PREDICTIONS, "select model, " + ", ".join(
    f"cast(printf('%.{n}f', {m}) as double) as {m}" for m, n in zip(METRICS, (4, 4, 2, 4, 4, 1, 1, 1)))
    + " from metrics"))
def compare_models(spark, folder):
    return E.compare_models(E.regression_metrics(predictions_of(spark, folder)))


@register("metric_gate", with_ctes(PREDICTIONS, """select model, mae < 0.5 as mae_ok, mape < 5 as mape_ok, r2 > 0.9 as r2_ok,
within_10pct > 85 as within_10_ok, mae <= 8 as no_retrain from metrics"""))
def metric_gate(spark, folder):
    return E.metric_gate(E.regression_metrics(predictions_of(spark, folder)))


@register("category_mae", with_ctes(PREDICTIONS, """select category, round(mae, 6) as mae from (select category,
avg(e) as mae from errors where model = 'mean' group by category order by mae desc, category limit 5)"""))
def category_mae(spark, folder):
    return E.category_mae(predictions_of(spark, folder).filter(F.col("model") == "mean")).withColumn(
        "mae", F.round("mae", 6))


@register("residual_table", with_ctes(PREDICTIONS, "select model, category, actual, predicted, actual - predicted as residual from predictions"))
def residual_table(spark, folder):
    return E.residual_table(predictions_of(spark, folder))


@register("residual_histogram", with_ctes(PREDICTIONS, """res as (select actual - predicted as v from predictions
where model = 'mean'), ends as (select min(v) as lo, max(v) as hi from res)""", """select
cast(least(floor((v - lo) * 50 / (hi - lo)), 49) as int) as bin, round(any_value(lo + (hi - lo)
* least(floor((v - lo) * 50 / (hi - lo)), 49) / 50), 6) as bin_start, count(*) as row_count from res, ends group by 1"""))
def residual_histogram(spark, folder):
    df = predictions_of(spark, folder).filter(F.col("model") == "mean")
    return E.residual_histogram(df).withColumn("bin_start", F.round("bin_start", 6))


SCALED = ["unit_price", "quantity", "revenue"]


@register("minmax_scale", with_ctes(Q.CLEAN, "ends as (select " + ", ".join(
    f"min({c}) as lo_{c}, max({c}) as hi_{c}" for c in SCALED)
    + " from clean where invoice_date < timestamp '2000-01-01')", "select stock_code, invoice_no, " + ", ".join(
        f"round(({c} - lo_{c}) / (hi_{c} - lo_{c}), 9) as {c}" for c in SCALED) + " from clean, ends"))
def minmax_scale(spark, folder):
    c = Q.clean_of(spark, folder)
    fitted = E.fit_minmax(c.filter(F.col("invoice_date") < "2000-01-01"), SCALED)
    return E.apply_scale(c, fitted, SCALED).select("stock_code", "invoice_no", *[F.round(x, 9).alias(x) for x in SCALED])


@register("standard_scale", with_ctes(Q.CLEAN, "ends as (select " + ", ".join(
    f"avg({c}) as m_{c}, stddev_pop({c}) as s_{c}" for c in SCALED)
    + " from clean where invoice_date < timestamp '2000-01-01')", "select stock_code, invoice_no, " + ", ".join(
        f"round(({c} - m_{c}) / s_{c}, 7) as {c}" for c in SCALED) + " from clean, ends"))
def standard_scale(spark, folder):
    c = Q.clean_of(spark, folder)
    fitted = E.fit_standard(c.filter(F.col("invoice_date") < "2000-01-01"), SCALED)
    return E.apply_scale(c, fitted, SCALED).select("stock_code", "invoice_no", *[F.round(x, 7).alias(x) for x in SCALED])


def psi_sql(feature: str) -> str:
    return f"""select '{feature}' as feature, sum((a - e) * ln(a / e)) as psi from (
  select coalesce(en, 0) / (select count(*) from older)::double + 1e-6 as e,
    coalesce(an, 0) / (select count(*) from newer)::double + 1e-6 as a from range(10) b(bucket)
  left join (select least(floor(greatest(least(({feature} - lo) / (hi - lo), 1), 0) * 10), 9) as bucket, count(*) as en
    from older, (select min({feature}) as lo, max({feature}) as hi from older) group by 1) using (bucket)
  left join (select least(floor(greatest(least(({feature} - lo) / (hi - lo), 1), 0) * 10), 9) as bucket, count(*) as an
    from newer, (select min({feature}) as lo, max({feature}) as hi from older) group by 1) using (bucket))"""


HALVES = Q.CLEAN + """,
older as (select * from clean where invoice_date < timestamp '1999-01-01'),
newer as (select * from clean where invoice_date >= timestamp '1999-01-01')
"""


def halves_of(spark, folder):
    c = Q.clean_of(spark, folder)
    old = F.col("invoice_date") < "1999-01-01"
    return c.filter(old), c.filter(~old)


@register("psi", with_ctes(HALVES, f"select feature, round(psi, 6) as psi, psi > 0.2 as alert from ({psi_sql('unit_price')})"))
def psi(spark, folder):
    return drift.psi(*halves_of(spark, folder), "unit_price").withColumn("psi", F.round("psi", 6))


@register("psi_all", with_ctes(HALVES, "select feature, round(psi, 6) as psi, psi > 0.2 as alert from ("
                               + " union all ".join(psi_sql(f) for f in SCALED) + ")"))
def psi_all(spark, folder):
    return drift.psi_all(*halves_of(spark, folder), [*SCALED, "not_there"]).withColumn("psi", F.round("psi", 6))


@register("psi_all_rows", with_ctes(HALVES, "select feature, round(psi, 6) as psi, psi > 0.2 as alert from ("
                                    + " union all ".join(psi_sql(f) for f in SCALED) + ")"))
def psi_all_rows(spark, folder):
    """PSI of all features, unit_price among them, without leaving out rows."""
    return drift.psi_all(*halves_of(spark, folder), [*SCALED, "not_there"]).withColumn("psi", F.round("psi", 6))


@register("metrics_sink", with_ctes(PREDICTIONS, """named as (select model, unnest(['mae', 'rmse', 'mape', 'r2',
'median_abs_error', 'within_5pct', 'within_10pct', 'within_20pct']) as name, unnest([mae, rmse, mape, r2,
median_abs_error, within_5pct, within_10pct, within_20pct]) as value from metrics)""", """select name, round(value, 6) as value,
'None' as unit, 0::bigint as batch from named where model = 'mean'"""))
def metrics_sink(spark, folder):
    """Metric datums written in numbered batches and read back."""
    row = E.regression_metrics(predictions_of(spark, folder)).filter(F.col("model") == "mean")
    rows = sinks.metric_rows(row, F.lit("2024-01-01 00:00:00").cast("timestamp"))
    path = shared_folder(spark, "metrics")
    sinks.write_stage(sinks.batch_metrics(rows), path)
    return spark.read.parquet(path).select("name", F.round("value", 6).alias("value"), "unit", "batch")


def panel_rows(spark, folder):
    e = Warehouse(spark, folder).events()
    return e.select("ts", F.col("value").alias("final_price"), (F.col("value") * 0.75).alias("cost"),
                    (F.col("event_type") == "signup").alias("is_flash_sale"), (F.col("event_type") == "view").alias("cached"),
                    (F.col("value") + F.get_json_object("props", "$.k").cast("double") / 10).alias("actual_price"))


@register("kpi_panels", """select time_bucket(interval 10 minute, ts, timestamp '1970-01-01') as window_start,
cast(sum(cast(round(value * 10000) as bigint)) as double) / 10000 as revenue,
round(avg(case when value <> 0 then (value - value * 0.75::double) / value * 100 end), 6) as mean_margin_pct,
count(*) as decisions, count(*) filter (event_type = 'signup') as flash_sales,
count(*) filter (event_type = 'view') / count(*)::double * 100 as cache_hit_pct from events group by 1""")
def kpi_panels(spark, folder):
    return kpis.decision_panels(panel_rows(spark, folder), "10 minutes").withColumn(
        "mean_margin_pct", F.round("mean_margin_pct", 6))


@register("kpi_hourly_error", """select window_end, round(avg(abs(value + k / 10 - value)), 6) as mae from (
select value, cast(json_extract_string(props, '$.k') as double) as k,
time_bucket(interval 10 minute, ts, timestamp '1970-01-01') + to_minutes(cast(i * 10 as int)) as window_end
from events, range(1, 7) r(i)) group by window_end""")
def kpi_hourly_error(spark, folder):
    return kpis.hourly_error(panel_rows(spark, folder)).withColumn("mae", F.round("mae", 6))


