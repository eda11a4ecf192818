"""Decision rules: zone status, surge and partner rebalancing.

Three surge rules exist side by side because they are used for different things:
``recommended_surge`` on observed hours, ``PredictionRules`` on forecasts, and
``static_surge`` as the fixed table in force today.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .measures import col

# Demand-to-supply cut-offs, most severe first.
STATUS_CUTS = ((3.0, "CRITICAL"), (2.0, "STRESSED"), (1.0, "MODERATE"))
STATUS_DEFAULT = "HEALTHY"
SEVERITY = ("HEALTHY", "MODERATE", "STRESSED", "CRITICAL")  # ascending

# Customer segments by number of orders, largest first.
SEGMENT_CUTS = ((15, "Power User"), (8, "Regular"), (3, "Occasional"))
SEGMENT_DEFAULT = "New"

# Static surge table. Hours are half-open: 12-14 and 19-22.
STATIC_LUNCH = (12, 13, 1.3)
STATIC_DINNER = (19, 21, 1.5)
STATIC_RAIN_ADD = 0.3
STATIC_EVENT_ADD = 0.5


def ladder(value: Column, cuts, default: str, *, inclusive: bool) -> Column:
    """Label of the first cut that ``value`` passes; null takes the default."""
    out = None
    for cut, label in cuts:
        hit = value >= cut if inclusive else value > cut
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(default)


def ratio(orders: str | Column, partners: str | Column) -> Column:
    """Orders per active partner, unrounded; null without active partners."""
    return col(orders) / F.nullif(col(partners), F.lit(0))


def zone_status(r: str | Column, no_supply: str = STATUS_DEFAULT) -> Column:
    """Zone health.  ``no_supply`` is the label of zones without active partners."""
    r = col(r)
    return F.when(r.isNull(), no_supply).otherwise(
        ladder(r, STATUS_CUTS, STATUS_DEFAULT, inclusive=False)
    )


def segment(orders: str | Column) -> Column:
    return ladder(col(orders), SEGMENT_CUTS, SEGMENT_DEFAULT, inclusive=True)


def recommended_surge(r: str | Column) -> Column:
    r = col(r)
    return (
        F.when(r > 2.5, F.round(F.least(r * 0.3 + 1.0, F.lit(3.0)), 2))
        .when(r > 1.5, F.round(r * 0.2 + 1.0, 2))
        .otherwise(1.0)
    )


def rebalance_count(r: str | Column, orders: str | Column, partners: str | Column) -> Column:
    """Partners to bring in (positive) or send out (negative).

    0.3 and 0.2 partners each are written in tenths: products with the doubles 0.3 and
    0.2 can fall on the wrong side of a half.
    """
    r, orders, partners = col(r), col(orders), col(partners)
    bring = F.round(orders / 2 - partners * 3 / 10).cast("int")
    send = F.round(partners * 2 / 10).cast("int")
    return F.when(r > 2.5, bring).when(r < 0.5, -send).otherwise(0)


def static_surge(hour: str | Column, rain: str | Column, event: str | Column) -> Column:
    hour = col(hour)
    base = (
        F.when(hour.between(*STATIC_LUNCH[:2]), STATIC_LUNCH[2])
        .when(hour.between(*STATIC_DINNER[:2]), STATIC_DINNER[2])
        .otherwise(1.0)
    )
    rain_add = F.when(col(rain) == 1, STATIC_RAIN_ADD).otherwise(0.0)
    event_add = F.when(col(event) == 1, STATIC_EVENT_ADD).otherwise(0.0)
    return F.round(base + rain_add + event_add, 1)


def static_period(hour: str | Column) -> Column:
    hour = col(hour)
    return (
        F.when(hour.between(*STATIC_LUNCH[:2]), "lunch")
        .when(hour.between(*STATIC_DINNER[:2]), "dinner")
        .otherwise("other")
    )


def with_prediction_rules(df: DataFrame, predicted: str, partners: str) -> DataFrame:
    """Add the columns derived from a forecast.  All rounding is half-even.

    The rules work on the ratio rounded to two digits; missing partners count as 0.
    """
    active = F.coalesce(F.col(partners), F.lit(0)).cast("bigint")
    ds = F.col("ds_ratio")
    needed = F.bround(F.col(predicted) / 2 - F.col("active_partners") * F.lit(0.3)).cast("bigint")
    return (
        df.withColumn("active_partners", active)
        .withColumns(
            {
                "predicted_orders": F.bround(F.col(predicted)).cast("bigint"),
                "ds_ratio": F.bround(
                    F.col(predicted) / F.greatest(F.col("active_partners"), F.lit(1)), 2
                ),
            }
        )
        .withColumns(
            {
                "status": ladder(ds, STATUS_CUTS, STATUS_DEFAULT, inclusive=False),
                "recommended_surge": F.when(
                    ds > 1.5, F.bround(F.least(ds * 0.3 + 1.0, F.lit(3.0)), 2)
                ).otherwise(1.0),
                "partners_needed": F.when(
                    ds > 2, F.greatest(needed, F.lit(0).cast("bigint"))
                ).otherwise(F.lit(0).cast("bigint")),
            }
        )
    )
