"""Fixed values of the credit-risk domain.

Everything below is data that results must match exactly; no logic lives here.
"""

# --- fixed values: code dictionaries -----------------------------------------------------------
SEX_LABELS = {1: "male", 2: "female"}
EDUCATION_LABELS = {1: "graduate_school", 2: "university", 3: "high_school", 4: "others"}
MARRIAGE_LABELS = {1: "married", 2: "single", 3: "others"}
UNKNOWN = "unknown"

# --- fixed values: age bands (exclusive upper bound, label) and the accepted age range ---------
AGE_BANDS = [(30, "<30"), (40, "30-39"), (50, "40-49"), (60, "50-59")]
OPEN_AGE_BAND = "60+"
AGE_RANGE = (18, 100)

# --- fixed values: calendar --------------------------------------------------------------------
MONTH_NAMES = {
    1: "Jan", 2: "Feb", 3: "Mar", 4: "Apr", 5: "May", 6: "Jun",
    7: "Jul", 8: "Aug", 9: "Sep", 10: "Oct", 11: "Nov", 12: "Dec",
}
BILLING_MONTHS = (4, 9)

# --- fixed values: wide history, calendar month -> (status, bill, payment) columns -------------
HISTORY = {
    9: ("pay_0", "bill_amt1", "pay_amt1"),
    8: ("pay_2", "bill_amt2", "pay_amt2"),
    7: ("pay_3", "bill_amt3", "pay_amt3"),
    6: ("pay_4", "bill_amt4", "pay_amt4"),
    5: ("pay_5", "bill_amt5", "pay_amt5"),
    4: ("pay_6", "bill_amt6", "pay_amt6"),
}
STATUS_COLUMNS = [cols[0] for cols in HISTORY.values()]
BILL_COLUMNS = [cols[1] for cols in HISTORY.values()]
PAYMENT_COLUMNS = [cols[2] for cols in HISTORY.values()]
CAPPED_COLUMNS = ["limit_bal", *BILL_COLUMNS, *PAYMENT_COLUMNS]

# --- fixed values: label column and its accepted spellings --------------------------------------
TARGET = "default_payment_next_month"
TARGET_SPELLINGS = (
    "default_payment_next_month",
    "default_payment_next_month_",
    "default.payment.next.month",
    "y",
)

# --- fixed values: macro series code -> indicator column ----------------------------------------
SERIES_COLUMNS = {
    "EXTAUS": "exchange_rate_twd_usd",
    "RBTWBIS": "real_broad_eer",
    "NBTWBIS": "nominal_broad_eer",
    "TRESEGTWM194N": "total_reserves",
}
INDICATORS = list(SERIES_COLUMNS.values())
SCALED_INDICATORS = ["exchange_rate_twd_usd", "real_broad_eer", "total_reserves"]
MISSING_MARKER = "."

# --- fixed values: message topics ---------------------------------------------------------------
CREDIT_TOPIC = "credit-card-raw"
MACRO_TOPIC = "fred-macro-raw"

# --- fixed values: rendering scale of the composition chart --------------------------------------
COMPOSITION_FLOOR = 0.18
COMPOSITION_SPAN = 0.82

# --- fixed values: demographic dimension -> label column ------------------------------------------
DIMENSIONS = {
    "sex": "sex_label",
    "education": "education_label",
    "marriage": "marriage_label",
    "age_band": "age_band",
}
KPI_TABLES = [
    "kpi_overall",
    "kpi_default_by_demographic",
    "kpi_monthly_default_vs_macro",
    "kpi_corr_default_macro",
]
