"""Roles, leak guards, null audits and invariants of the model table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegrid.catalog.gap_queries import SITES
from tidegrid.catalog.history_queries import HISTORY
from tidegrid.catalog.registry import HOURS, TRIPS, query, rounded
from tidegrid.operators.contracts import (
    audit_summary,
    collect_features,
    conserved,
    invariants,
    leaks,
    null_audit,
    null_counts,
    null_disagrees,
    out_of_unit,
    roles_table,
)
from tidegrid.operators.grid import check_grid
from tidegrid.plans import clocked, model_table, sites, study
from tidegrid.plans.entity_hours import entity_hours


HISTORY_NULLS = """
nulls AS (
  SELECT 'n_events' AS column_name, count(*) FILTER (n_events IS NULL) AS nulls FROM hist
  UNION ALL SELECT 'sum_value', count(*) FILTER (sum_value IS NULL) FROM hist
  UNION ALL SELECT 'mean_value', count(*) FILTER (mean_value IS NULL) FROM hist
  UNION ALL SELECT 'n_lag_1h', count(*) FILTER (n_lag_1h IS NULL) FROM hist
  UNION ALL SELECT 'n_lag_24h', count(*) FILTER (n_lag_24h IS NULL) FROM hist
  UNION ALL SELECT 'n_lag_168h', count(*) FILTER (n_lag_168h IS NULL) FROM hist
  UNION ALL SELECT 'n_same_hour_7d', count(*) FILTER (n_same_hour_7d IS NULL) FROM hist
  UNION ALL SELECT 'value_lag_168h', count(*) FILTER (value_lag_168h IS NULL) FROM hist
  UNION ALL SELECT 'value_same_hour_7d', count(*) FILTER (value_same_hour_7d IS NULL) FROM hist)"""


def _history_roles(spark, table, planted=()):
    """Roles of the columns the history table holds; ``planted`` columns join the features."""
    present = set(table.columns)
    features = {g: [c for c in cs if c in present] for g, cs in model_table.FEATURES.items()}
    roles = {r: [c for c in cs if c in present] for r, cs in model_table.ROLES.items()}
    if planted:
        features["planted"] = list(planted)
    return roles_table(spark, roles, features)


@query(
    "role_coverage",
    f"""WITH {HISTORY}, {HISTORY_NULLS}
    SELECT 'feature' AS role, CAST(6 AS BIGINT) AS columns, CAST(sum(nulls) AS BIGINT) AS nulls FROM nulls WHERE column_name LIKE '%lag%' OR column_name LIKE '%same%'
    UNION ALL SELECT 'target', CAST(2 AS BIGINT), CAST(sum(nulls) AS BIGINT) FROM nulls WHERE column_name IN ('n_events', 'mean_value')
    UNION ALL SELECT 'leak_if_unlagged', CAST(1 AS BIGINT), CAST(sum(nulls) AS BIGINT) FROM nulls WHERE column_name = 'sum_value'""",
)
def role_coverage(spark, sf_dir):
    """Columns and nulls per role, over the measured columns of the history table."""
    table = model_table.history_table(spark, sf_dir)
    kinds = ["past_counts", "past_values"]
    roles = _history_roles(spark, table).where(
        F.col("feature_group").isin(*kinds) | F.col("role").isin("target", "leak_if_unlagged")
    )
    return (
        null_counts(table)
        .join(roles, on="column_name")
        .groupBy("role")
        .agg(F.count("*").alias("columns"), F.sum("nulls").alias("nulls"))
    )


@query(
    "leaks",
    f"WITH {HISTORY}, {HISTORY_NULLS} SELECT column_name, nulls FROM nulls WHERE column_name = 'sum_value'",
)
def leaking(spark, sf_dir):
    """The guard finds the same-hour outcome planted among the features, with its nulls."""
    table = model_table.history_table(spark, sf_dir)
    found = leaks(_history_roles(spark, table, planted=["sum_value", "n_lag_1h"]))
    return null_counts(table).join(found, on="column_name").select("column_name", "nulls")


@query(
    "collected_features",
    f"""WITH {HISTORY}, {HISTORY_NULLS} SELECT column_name, CASE WHEN column_name LIKE 'value%' THEN 1 ELSE 2 END AS group_position, nulls
    FROM nulls WHERE column_name LIKE '%lag%' OR column_name LIKE '%same%'""",
)
def features(spark, sf_dir):
    """Features of two groups in their given order, with the nulls each has to resolve."""
    table = model_table.history_table(spark, sf_dir)
    wanted = collect_features(_history_roles(spark, table), ["past_values", "past_counts"])
    return null_counts(table).join(wanted, on="column_name").select(
        "column_name", "group_position", "nulls"
    )


@query(
    "null_counts",
    f"""WITH {SITES} SELECT * FROM (
      SELECT 'temp' AS column_name, count(*) FILTER (temp IS NULL) AS nulls, count(*) AS row_count FROM sites
      UNION ALL SELECT 'rain', count(*) FILTER (rain IS NULL), count(*) FROM sites
      UNION ALL SELECT 'rain_source', 0, count(*) FROM sites
      UNION ALL SELECT 'is_wet', 0, count(*) FROM sites
      UNION ALL SELECT 'is_freezing', count(*) FILTER (is_freezing IS NULL), count(*) FROM sites)""",
)
def counted_nulls(spark, sf_dir):
    site = sites.resolved(spark, sf_dir)
    return null_counts(site.select("temp", "rain", "rain_source", "is_wet", "is_freezing"))


@query(
    "null_audit",
    f"""WITH {HISTORY} SELECT column_name, nulls, row_count, family FROM (
      SELECT 'mean_value' AS column_name, count(*) FILTER (mean_value IS NULL) AS nulls, count(*) AS row_count, 'no event in the hour' AS family FROM hist
      UNION ALL SELECT 'holiday_name', count(*) FILTER (date NOT IN (DATE '2024-01-01', DATE '2024-01-02', DATE '2024-01-15')), count(*), 'no holiday' FROM hist
      UNION ALL SELECT 'n_lag_1h', count(*) FILTER (n_lag_1h IS NULL), count(*), 'before the first lag' FROM hist
      UNION ALL SELECT 'n_lag_24h', count(*) FILTER (n_lag_24h IS NULL), count(*), 'before the first lag' FROM hist
      UNION ALL SELECT 'n_lag_168h', count(*) FILTER (n_lag_168h IS NULL), count(*), 'before the first lag' FROM hist
      UNION ALL SELECT 'value_lag_168h', count(*) FILTER (value_lag_168h IS NULL), count(*), 'before the first lag' FROM hist
      UNION ALL SELECT 'n_same_hour_7d', count(*) FILTER (n_same_hour_7d IS NULL), count(*), 'before the first lag' FROM hist
      UNION ALL SELECT 'value_same_hour_7d', count(*) FILTER (value_same_hour_7d IS NULL), count(*), 'before the first lag' FROM hist) WHERE nulls > 0""",
)
def audited(spark, sf_dir):
    table = model_table.history_table(spark, sf_dir)
    return null_audit(table, model_table.NULL_FAMILIES, {})


@query("null_families")
def families(spark, sf_dir):
    """The whole model table by null family; an unexplained family would show as a row."""
    table = model_table.model_table(spark, sf_dir)
    return audit_summary(null_audit(table, model_table.NULL_FAMILIES, {}))


@query(
    "invariants",
    """SELECT check_name, CAST(0 AS BIGINT) AS violations FROM (VALUES ('mean_delay_denominator'), ('longhaul_in_unit'), ('late_in_unit'),
      ('slippage_identity'), ('hour_in_range')) t(check_name)""",
)
def invariant_rows(spark, sf_dir):
    series = clocked.scheduled_realised(spark, sf_dir)
    return invariants(
        series,
        {
            "mean_delay_denominator": null_disagrees("mean_delay", "n_delay_observed"),
            "longhaul_in_unit": out_of_unit("share_longhaul"),
            "late_in_unit": out_of_unit("share_late"),
            "slippage_identity": F.col("arrival_slippage")
            != F.col("actual_arrivals") - F.col("sched_arrivals"),
            "hour_in_range": ~F.col("hour").between(0, 23),
        },
    )


@query(
    "grid_checks",
    f"""WITH {HOURS} SELECT 'grid_rows' AS check_name, CAST(abs(count(*) - 3600) AS BIGINT) AS violations FROM hours
    UNION ALL SELECT 'duplicate_keys', CAST(0 AS BIGINT)
    UNION ALL SELECT 'mean_denominator', count(*) FILTER ((mean_value IS NULL) <> (n_events = 0)) FROM hours
    UNION ALL SELECT 'product_identity', count(*) FILTER (abs(n_events * mean_value - sum_value) > 0.01) FROM hours""",
)
def grid_checks(spark, sf_dir):
    product = F.abs(F.col("n_events") * F.col("mean_value") - F.col("sum_value"))
    return check_grid(
        entity_hours(spark, sf_dir),
        study.KEY,
        study.CELLS,
        {
            "mean_denominator": null_disagrees("mean_value", "n_events"),
            "product_identity": product > 0.01,
        },
    )


@query(
    "conserved_totals",
    f"""WITH {TRIPS} SELECT 'rows' AS total, count(*) * 1.0::DOUBLE AS before, count(*) * 1.0::DOUBLE AS after, true AS holds FROM trips
    UNION ALL SELECT 'value', round(sum(fare), 2), round(sum(fare), 2), true FROM trips""",
)
def conserved_totals(spark, sf_dir):
    return rounded(
        conserved(
            study.trips(spark, sf_dir),
            entity_hours(spark, sf_dir),
            {
                "rows": (F.count("*"), F.sum("n_events")),
                "value": (F.sum("fare"), F.sum("sum_value")),
            },
            1.0,
        ),
        2,
    )
