"""Programme indicators over the gold table, in one global aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import DISTANCE_OK
from ..functions.numeric import round_half_up


def program_kpis(gold: DataFrame) -> DataFrame:
    """Employees, total cost, payroll, cost share of payroll (%), bonus and
    well-being counts and shares (%), distances resolved, activities counted.

    Money is summed as decimal(20,2), so the totals do not depend on the order
    in which partial sums are merged.
    """
    agg = gold.agg(
        F.count(F.lit(1)).alias("employees"),
        F.sum(F.col("total_cost").cast("decimal(20,2)")).alias("total_cost"),
        F.sum(F.col("gross_salary").cast("decimal(20,2)")).alias("payroll"),
        F.count_if("is_eligible_premium").alias("bonus_count"),
        F.count_if("is_eligible_wellbeing").alias("wellbeing_count"),
        F.count_if(F.col("distance_check_status") == DISTANCE_OK).alias("distances_resolved"),
        F.sum("activities_count_12m").alias("activities"),
    )
    def share(part: str, whole: str):
        """``part`` as a percentage of ``whole``, rounded to cents; NULL over nothing."""
        return round_half_up(F.try_divide(F.col(part).cast("double") * F.lit(100.0), F.col(whole).cast("double")))

    return agg.select(
        "employees",
        F.col("total_cost").cast("double").alias("total_cost"),
        F.col("payroll").cast("double").alias("payroll"),
        share("total_cost", "payroll").alias("cost_pct_payroll"),
        "bonus_count",
        share("bonus_count", "employees").alias("bonus_pct"),
        "wellbeing_count",
        share("wellbeing_count", "employees").alias("wellbeing_pct"),
        "distances_resolved",
        "activities",
    )
