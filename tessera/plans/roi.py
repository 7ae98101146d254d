"""Return on investment: totals, sensitivity scenarios, 12-month projection, advice."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import fmt_currency, roi_grade, roi_status, round_half_up

# FIXED VALUES
SCENARIOS = [("conservative", 0.7), ("realistic", 1.0), ("optimistic", 1.3)]
MONTHLY_COST_SHARE = 0.3          # running cost per month = 30 % of the period cost, per month
PROJECTION_MONTHS = 12
ROI_ADVICE = [
    (100, ["Excellent ROI - recommend scaling the initiative",
           "Consider expanding to additional use cases",
           "Allocate more resources for faster deployment"]),
    (50, ["Positive ROI - continue with current plan",
          "Focus on optimizing high-impact areas",
          "Monitor performance closely"]),
    (None, ["Review cost structure and benefit assumptions",
            "Consider alternative approaches or technologies",
            "Reassess timeline and milestones"]),
]


def roi_totals(costs: DataFrame, benefits: DataFrame) -> DataFrame:
    """One row: total_costs = Σ cost, total_benefits = Σ units × unit_value."""
    c = costs.agg(F.sum("cost").alias("total_costs"))
    b = benefits.agg(F.sum(F.col("units") * F.col("unit_value")).alias("total_benefits"))
    return c.crossJoin(b)


def roi_benefits(benefits: DataFrame) -> DataFrame:
    """Financial benefit of each category and its value-driver text."""
    value = F.col("units") * F.col("unit_value")
    return benefits.select("category", round_half_up(value, 2).alias("benefit"),
                           F.concat(F.lit("Category "), F.col("category"), F.lit(": "), fmt_currency(value, 0)).alias("driver"))


def _periods(period_days: int):
    return F.lit(period_days / 30.0)


def roi_summary(costs: DataFrame, benefits: DataFrame, period_days: int = 90) -> DataFrame:
    t = roi_totals(costs, benefits)
    C, B = F.col("total_costs"), F.col("total_benefits")
    roi = F.try_divide(B - C, C) * 100
    payback = F.when(B > 0, C / (B / _periods(period_days)))
    return t.select(
        round_half_up(C, 2).alias("total_costs"), round_half_up(B, 2).alias("total_benefits"),
        round_half_up(roi, 2).alias("roi_percentage"), round_half_up(B - C, 2).alias("net_benefit"),
        round_half_up(payback, 1).alias("payback_period_months"),
        round_half_up(F.try_divide(B, C), 2).alias("benefit_cost_ratio"),
        roi_status(roi).alias("roi_status"), roi_grade(roi).alias("investment_grade"))


def roi_sensitivity(costs: DataFrame, benefits: DataFrame) -> DataFrame:
    t = roi_totals(costs, benefits)
    sc = F.explode(F.array(*[F.struct(F.lit(n).alias("scenario"), F.lit(m).alias("multiplier"))
                             for n, m in SCENARIOS])).alias("s")
    x = t.select("total_costs", "total_benefits", sc)
    b = F.col("total_benefits") * F.col("s.multiplier")
    C = F.col("total_costs")
    return x.select(F.col("s.scenario").alias("scenario"), round_half_up(b, 2).alias("total_benefits"),
                    round_half_up(F.try_divide(b - C, C) * 100, 2).alias("roi_percentage"),
                    round_half_up(b - C, 2).alias("net_benefit"))


def roi_projection(costs: DataFrame, benefits: DataFrame, period_days: int = 90,
                   months: int = PROJECTION_MONTHS) -> DataFrame:
    """Month m: cumulative benefits m·mb, cumulative costs C + m·mc, cumulative ROI, break-even.

    The running sums are linear, so a closed form replaces a window.
    """
    t = roi_totals(costs, benefits)
    mb = F.col("total_benefits") / _periods(period_days)
    mc = F.col("total_costs") * MONTHLY_COST_SHARE / _periods(period_days)
    x = t.select("total_costs", mb.alias("_mb"), mc.alias("_mc"),
                 F.explode(F.sequence(F.lit(1), F.lit(months))).alias("month"))
    cb = F.col("month") * F.col("_mb")
    cc = F.col("total_costs") + F.col("month") * F.col("_mc")
    return x.select("month", round_half_up(cb, 2).alias("cumulative_benefits"),
                    round_half_up(cc, 2).alias("cumulative_costs"),
                    round_half_up(F.try_divide(cb - cc, cc) * 100, 2).alias("cumulative_roi"),
                    (cb >= cc).alias("break_even"))


def roi_recommendations(summary: DataFrame) -> DataFrame:
    """Advice lines for the ROI band (strict >)."""
    roi = F.col("roi_percentage")
    expr = None
    for floor, lines in ROI_ADVICE:
        arr = F.array(*[F.lit(x) for x in lines])
        if floor is None:
            expr = expr.otherwise(arr)
        else:
            expr = F.when(roi > floor, arr) if expr is None else expr.when(roi > floor, arr)
    return summary.select(F.explode(expr).alias("recommendation"))
