"""Report shaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from fareloom.operators import demand as D
from fareloom.operators import report as R
from fareloom.operators.features import hash_split
from fareloom.operators.training import compare
from fareloom.registry import sql as S
from fareloom.registry import tables as T
from fareloom.registry.entries import Entry


def _hourly(spark, folder):
    return D.hourly_demand(T.clean(spark, folder))


def _zone_report(operator):
    return lambda spark, folder: operator(
        D.zone_revenue(T.clean(spark, folder)), T.zones(spark, folder)
    )


def plain_metrics(spark, folder):
    """The comparison of predictors with known values on the held-out trips."""
    _, test = hash_split(T.clean(spark, folder), T.split_bucket())
    return compare(T.plain_predictions(test))


def _rounded(metrics):
    return metrics.withColumns({name: F.round(name, 6) for name in ("rmse", "r2")})


_NAMES = "['Sunday', 'Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday']"

ENTRIES = {
    "bucket_order": Entry(
        lambda spark, folder: T.in_order(
            R.order_distance_buckets(D.tipping_by_distance(T.clean(spark, folder)))
        ),
        S.query(
            S.ordered("tipping", "list_position(['short', 'medium', 'long'], distance_bucket)"),
            S.CLEAN,
            S.TIPPING,
        ),
    ),
    "day_names": Entry(
        lambda spark, folder: R.add_day_name(_hourly(spark, folder)),
        S.query(f"SELECT *, {_NAMES}[day_of_week] AS day_name FROM hourly", S.CLEAN, S.HOURLY),
    ),
    "hourly_matrix": Entry(
        lambda spark, folder: T.in_order(R.hourly_matrix(_hourly(spark, folder))),
        S.query(
            "SELECT day_name, any_value(i) AS position, "
            + ", ".join(
                f'CAST(sum(trip_count) FILTER (pickup_hour = {hour}) AS BIGINT) AS "{hour}"'
                for hour in range(24)
            )
            + f""" FROM (SELECT i, {_NAMES}[i] AS day_name FROM range(1, 8) AS r(i))
            LEFT JOIN hourly ON day_of_week = i GROUP BY day_name""",
            S.CLEAN,
            S.HOURLY,
        ),
    ),
    "top_zones": Entry(
        _zone_report(R.top_zones),
        S.query(
            """SELECT revenue.*, LocationID, Zone, Borough, Zone || ', ' || Borough AS zone_label
            FROM revenue LEFT JOIN zones ON PULocationID = LocationID
            ORDER BY total_revenue DESC, PULocationID LIMIT 15""",
            S.CLEAN,
            S.REVENUE,
            S.ZONES,
        ),
    ),
    "zones_named": Entry(
        lambda spark, folder: T.in_order(_zone_report(R.zones_named)(spark, folder)),
        S.query(
            """SELECT revenue.*, Zone, Borough,
            row_number() OVER (ORDER BY total_revenue DESC, PULocationID) AS position
            FROM revenue LEFT JOIN zones ON PULocationID = LocationID""",
            S.CLEAN,
            S.REVENUE,
            S.ZONES,
        ),
    ),
    "zone_labels": Entry(
        lambda spark, folder: T.in_order(R.zone_labels(T.zones(spark, folder))),
        S.query(S.ordered("labels", "label", "LocationID"), S.ZONES),
    ),
    "rmse_r2": Entry(
        lambda spark, folder: _rounded(plain_metrics(spark, folder)),
        S.query(
            """SELECT position, model, round(rmse, 6) AS rmse, round(r2, 6) AS r2
            FROM metrics""",
            S.CLEAN,
            S.METRICS,
        ),
    ),
    "best_model": Entry(
        lambda spark, folder: _rounded(R.best_model(plain_metrics(spark, folder))),
        S.query(
            """SELECT model, round(rmse, 6) AS rmse, round(r2, 6) AS r2
            FROM metrics ORDER BY metrics.rmse, position LIMIT 1""",
            S.CLEAN,
            S.METRICS,
        ),
    ),
    "improvement": Entry(
        lambda spark, folder: R.improvement(plain_metrics(spark, folder)),
        S.query(
            """SELECT arg_min(model, rmse) AS model,
            round((max(rmse) FILTER (model = 'lr') - min(rmse))
              / max(rmse) FILTER (model = 'lr') * 100, 1) AS improvement_pct FROM metrics""",
            S.CLEAN,
            S.METRICS,
        ),
    ),
}
