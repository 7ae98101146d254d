"""Pure ``Column -> Column`` helpers. Everything here is JVM-side and codegen'd.

Fixed values that must equal the reference's for equal results are grouped
under ``FIXED VALUES`` comments and written out in their natural order.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# FIXED VALUES (reference semantics)
# ---------------------------------------------------------------------------
# Age bands: right-closed bins (0,25] (25,35] (35,50] (50,65] (65,100].
AGE_EDGES = [0, 25, 35, 50, 65, 100]
AGE_LABELS = ["18-25", "26-35", "36-50", "51-65", "65+"]
# Day parts: right-closed bins (0,6] (6,12] (12,18] (18,24]; hour 0 falls outside.
DAYPART_EDGES = [0, 6, 12, 18, 24]
DAYPART_LABELS = ["Night", "Morning", "Afternoon", "Evening"]
# RFM segment ladder, checked top-down with >=.
SEGMENTS = ["Champions", "Loyal Customers", "Potential Loyalists", "At Risk", "Lost Customers"]
SEGMENT_FLOORS = [4.5, 3.5, 2.5, 1.5]
# Engagement = .3 duration + .2 pages + .2 (1 - bounce) + .2 open + .1 social.
ENGAGEMENT_WEIGHTS = {"duration": 0.3, "pages": 0.2, "non_bounce": 0.2, "open": 0.2, "social": 0.1}
# Satisfaction = max(0, engagement - 0.5 * tickets).
SATISFACTION_TICKET_WEIGHT = 0.5
# Interest diversity = categories visited / 8.
CATEGORY_COUNT = 8
# Churn risk = .4 cart + .3 bounce + .2 (1 - open) + .1 tickets / 5.
CHURN_WEIGHTS = {"cart": 0.4, "bounce": 0.3, "no_open": 0.2, "tickets": 0.1}
TICKET_SCALE = 5
# Churn label: 0.4 [risk > .6] + 0.3 [recency > 90] + 0.3 [rfm < 2] > 0.5.
CHURN_LABEL_RISK, CHURN_LABEL_RECENCY, CHURN_LABEL_RFM = 0.6, 90, 2.0
# ROI grade ladder (strict >) and status.
ROI_GRADES = [(200, "excellent"), (100, "good"), (50, "acceptable")]
ROI_GRADE_ELSE = "poor"
# ---------------------------------------------------------------------------


def round_half_up(c: Column | str, digits: int) -> Column:
    """Round to ``digits`` decimals as ``floor(x * 10^d + 0.5) / 10^d``.

    Written so any engine evaluating the same IEEE expression gets the same
    double (Spark's ``round`` goes through a decimal string, DuckDB's through
    a binary product; the two disagree on values such as 5.005).

    ``floor`` gives a 64-bit integer, so values of 2^53 units or more, which
    have no such decimals in a double, pass as they are; so do NaN, the
    infinities and NULL.
    """
    c = (F.col(c) if isinstance(c, str) else c).cast("double")
    units = c * F.lit(float(10 ** digits))
    return F.when(F.abs(units) < F.lit(float(1 << 53)),
                  F.floor(units + F.lit(0.5)) / F.lit(float(10 ** digits))).otherwise(c)


def sql_round(expr: str, digits: int) -> str:
    """SQL text of :func:`round_half_up` for the oracle side."""
    return f"(floor(({expr}) * 1e{digits} + 0.5) / 1e{digits})"


def band(c: Column | str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed banding ``(e_i, e_{i+1}] -> label_i``; outside or NULL -> NULL."""
    c = F.col(c) if isinstance(c, str) else c
    out = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (c > F.lit(lo)) & (c <= F.lit(hi))
        out = F.when(cond, F.lit(lab)) if out is None else out.when(cond, F.lit(lab))
    return out


def age_group(c: Column | str) -> Column:
    return band(c, AGE_EDGES, AGE_LABELS)


def day_part(hour: Column | str, include_lowest: bool = False) -> Column:
    """Part of the day of an hour; hour 0 has none unless ``include_lowest`` puts it in the first."""
    part = band(hour, DAYPART_EDGES, DAYPART_LABELS)
    h = F.col(hour) if isinstance(hour, str) else hour
    return F.when(h == DAYPART_EDGES[0], F.lit(DAYPART_LABELS[0])).otherwise(part) if include_lowest else part


def rfm_mean(r: Column | str, f: Column | str, m: Column | str) -> Column:
    r, f, m = (F.col(x) if isinstance(x, str) else x for x in (r, f, m))
    return (r + f + m) / F.lit(3.0)


def rfm_segment(score: Column | str) -> Column:
    """Segment ladder; a NULL score falls through to the last segment."""
    s = F.col(score) if isinstance(score, str) else score
    out = F.when(s >= F.lit(SEGMENT_FLOORS[0]), F.lit(SEGMENTS[0]))
    for floor, name in zip(SEGMENT_FLOORS[1:], SEGMENTS[1:-1]):
        out = out.when(s >= F.lit(floor), F.lit(name))
    return out.otherwise(F.lit(SEGMENTS[-1]))


def engagement_score(duration, pages, bounce, open_rate, social) -> Column:
    w = ENGAGEMENT_WEIGHTS
    return (F.col(duration) * w["duration"] + F.col(pages) * w["pages"]
            + (F.lit(1.0) - F.col(bounce)) * w["non_bounce"]
            + F.col(open_rate) * w["open"] + F.col(social) * w["social"])


def satisfaction_score(engagement: Column, tickets) -> Column:
    """``max(0, engagement - .5 tickets)``; NULL stays NULL (``greatest`` would give 0)."""
    raw = engagement - F.col(tickets) * SATISFACTION_TICKET_WEIGHT
    return F.when(raw.isNull(), F.lit(None).cast("double")).otherwise(F.greatest(F.lit(0.0), raw))


def interest_diversity(categories) -> Column:
    return F.col(categories) / F.lit(float(CATEGORY_COUNT))


def churn_risk_score(cart, bounce, open_rate, tickets) -> Column:
    w = CHURN_WEIGHTS
    return (F.col(cart) * w["cart"] + F.col(bounce) * w["bounce"]
            + (F.lit(1.0) - F.col(open_rate)) * w["no_open"]
            + (F.col(tickets) / F.lit(float(TICKET_SCALE))) * w["tickets"])


def churn_label(risk, recency, rfm_score) -> Column:
    """Weighted vote 0.4/0.3/0.3 against 0.5, i.e. at least two of three; NULL -> false."""
    flags = [F.coalesce(F.col(risk) > CHURN_LABEL_RISK, F.lit(False)),
             F.coalesce(F.col(recency) > CHURN_LABEL_RECENCY, F.lit(False)),
             F.coalesce(F.col(rfm_score) < CHURN_LABEL_RFM, F.lit(False))]
    votes = sum(f.cast("int") for f in flags)
    return (votes >= 2).cast("int")


def rule_label(x0: Column, x1: Column, x2: Column) -> Column:
    """Synthetic target rule ``(x0 > .5 & x1 < -.2) | x2 > 1``."""
    return (((x0 > 0.5) & (x1 < -0.2)) | (x2 > 1.0)).cast("int")


def confidence(proba: Column) -> Column:
    """Confidence = the largest class probability."""
    return F.array_max(proba)


def title_case(c: Column | str) -> Column:
    """Python ``str.title``: every run of letters is capitalised on its own.

    ``initcap`` only capitalises after whitespace (``O'neil``); here the string
    is split into letter / non-letter runs and each run is initcapped.
    """
    c = F.col(c) if isinstance(c, str) else c
    runs = F.regexp_extract_all(c, F.lit(r"(\p{L}+|[^\p{L}]+)"), 1)
    return F.when(c.isNull(), F.lit(None).cast("string")).otherwise(
        F.array_join(F.transform(runs, lambda x: F.initcap(x)), ""))


def title_from_snake(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.initcap(F.regexp_replace(c, "_", " "))


def roi_grade(pct: Column | str) -> Column:
    p = F.col(pct) if isinstance(pct, str) else pct
    out = F.when(p > ROI_GRADES[0][0], F.lit(ROI_GRADES[0][1]))
    for thr, name in ROI_GRADES[1:]:
        out = out.when(p > thr, F.lit(name))
    return out.otherwise(F.lit(ROI_GRADE_ELSE))


def roi_status(pct: Column | str) -> Column:
    p = F.col(pct) if isinstance(pct, str) else pct
    return F.when(p > 0, F.lit("positive")).otherwise(F.lit("negative"))


def alert_id(n: Column) -> Column:
    return F.format_string("ALERT_%03d", n)


def fmt_currency(c: Column, digits: int = 2) -> Column:
    """``€1,234.56``."""
    return F.concat(F.lit("€"), F.format_number(c, digits))


def fmt_percent(ratio: Column, digits: int = 1) -> Column:
    """``0.712 -> 71.2%``."""
    return F.concat(F.format_number(ratio * 100.0, digits), F.lit("%"))


def try_ratio(num: Column, den: Column) -> Column:
    """Division that yields NULL on a zero or NULL denominator (ANSI-safe)."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def safe_ratio0(num: Column, den: Column) -> Column:
    """Division that yields 0 on an empty denominator (metric convention)."""
    return F.coalesce(try_ratio(num, den), F.lit(0.0))


def epoch_micros(df, col: str) -> Column:
    """Microseconds since 1970-01-01 for a timestamp column, independent of the
    session time zone for ``timestamp_ntz`` (no cast through local time, so
    gaps across a daylight-saving change stay exact)."""
    if dict(df.dtypes)[col] == "timestamp_ntz":
        return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', `{col}`)")
    return F.unix_micros(F.col(col))
