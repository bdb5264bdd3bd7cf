"""Schemas of the report's input and output tables (inferred from use; the
source system ships no DDL). Readers enforce them; no inference at scale."""

from pyspark.sql import types as T

LEDGER = T.StructType([
    T.StructField("transaction_date", T.TimestampNTZType(), True),
    T.StructField("account_code", T.LongType(), True),
    T.StructField("analysis_code", T.StringType(), True),
    T.StructField("amount", T.DecimalType(18, 2), True),
])

LOAN_BOOK = T.StructType([
    T.StructField("kpi_month", T.IntegerType(), True),
    T.StructField("area_code", T.StringType(), True),
    T.StructField("max_bucket", T.IntegerType(), True),
    T.StructField("outstanding_principal", T.DecimalType(18, 2), True),
    T.StructField("write_off_month", T.IntegerType(), True),
    T.StructField("write_off_balance_principal", T.DecimalType(18, 2), True),
    T.StructField("psdn", T.IntegerType(), True),
])

KPI_FACTS = T.StructType([
    T.StructField("month_report", T.IntegerType(), True),
    T.StructField("area_code", T.StringType(), True),
    T.StructField("employee_id", T.StringType(), True),
    T.StructField("kpi_code", T.StringType(), True),
    T.StructField("criteria_code", T.StringType(), True),
    T.StructField("value", T.DecimalType(18, 2), True),
])

BALANCE_TXN = T.StructType([
    T.StructField("month_key", T.IntegerType(), True),
    T.StructField("area_code", T.StringType(), True),
    T.StructField("fin_id_lv3", T.IntegerType(), True),
    T.StructField("dvml_head", T.StringType(), True),
    T.StructField("amount", T.DecimalType(18, 2), True),
])

DIM_CRITERIA = T.StructType([
    T.StructField("criteria_code", T.StringType(), False),
    T.StructField("criteria_type_name", T.StringType(), False),
])

DIM_CRITERIA_XLSX = T.StructType([T.StructField("criteria_code", T.StringType(), False)])

SUMMARY = T.StructType([
    T.StructField("fin_id", T.IntegerType(), False),
    T.StructField("area_code", T.StringType(), True),
    T.StructField("value", T.DoubleType(), True),
    T.StructField("month_key", T.IntegerType(), False),
])

KPI_B_OUT = T.StructType([
    T.StructField("month_key", T.IntegerType(), False),
    T.StructField("area_code", T.StringType(), True),
    T.StructField("employee_id", T.StringType(), True),
    T.StructField("criteria_code", T.StringType(), True),
    T.StructField("value", T.DoubleType(), True),
    T.StructField("rank_kpi", T.LongType(), True),
])

KPI_A_OUT = T.StructType(KPI_B_OUT.fields + [
    T.StructField("criteria_type_name", T.StringType(), True),
    T.StructField("type_score", T.LongType(), True),
    T.StructField("overall_score", T.LongType(), True),
    T.StructField("type_rank", T.LongType(), True),
    T.StructField("overall_rank", T.LongType(), True),
])

#: The published tables (see sources/mart.py).
PUBLISHED = {"fact_monthly_summary_a": SUMMARY, "fact_monthly_summary_b": SUMMARY,
             "fact_monthly_report_kpi_asm_a": KPI_A_OUT, "fact_monthly_report_kpi_asm_b": KPI_B_OUT}

COMMIT_ENTRY = T.StructType([
    T.StructField("table", T.StringType(), False),
    T.StructField("month_key", T.IntegerType(), False),
    T.StructField("version", T.StringType(), False),
    T.StructField("n_rows", T.LongType(), False),
    T.StructField("seq", T.LongType(), False),
])

COMMITS = T.StructType([
    T.StructField("entries", T.ArrayType(COMMIT_ENTRY, False), False),
    T.StructField("committed_at", T.TimestampType(), False),
])

RUN_LOG = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("procedure_name", T.StringType(), False),
    T.StructField("start_time", T.TimestampType(), True),
    T.StructField("end_time", T.TimestampType(), True),
    T.StructField("is_successful", T.BooleanType(), True),     # NULL: the run has only been started
    T.StructField("error_log", T.StringType(), True),
    T.StructField("rec_created_dt", T.TimestampType(), False),
    # ratios of variant B without a value for a zero denominator (NULL: not counted by the job)
    T.StructField("zero_denominators", T.LongType(), True),
    # rows that repeat a key of a table the job joins by it (dimension codes, head areas of a line): they multiply result rows
    T.StructField("duplicate_keys", T.LongType(), True),
])
