"""areabook: monthly management reporting on Spark.

From ledger lines, a loan book and area-sales-manager KPI facts it computes
cumulative per-area profit-and-loss lines, allocates head-office amounts to
areas by drivers, rolls lines up, derives ratios and ranks managers.
"""

from areabook.plans.summary_a import summary_a
from areabook.plans.summary_b import summary_b
from areabook.plans.kpi_a import kpi_a
from areabook.plans.kpi_b import kpi_b

__all__ = ["summary_a", "summary_b", "kpi_a", "kpi_b"]
