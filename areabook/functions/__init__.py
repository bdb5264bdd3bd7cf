from areabook.functions.columns import (  # noqa: F401
    area_of, is_head, month_key_of, month_end_exclusive, digits_prefix, scale_millions,
    to_stage, stage_double, round_half_up, as_months, report_months_from, avg_of, ratio, exact_total, yyyymm_year_text,
)
