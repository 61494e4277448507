"""The data model: column lists, default texts and limits.

Everything in this module is a fixed value: results depend on these names and
numbers being exactly as they are.
"""

from __future__ import annotations

# ---- fixed values: the case message, all text ------------------------------
MESSAGE_COLUMNS = [
    "ddl_case_id",
    "state_code",
    "dist_code",
    "court_no",
    "judge_position",
    "type_name",
    "purpose_name",
    "disp_name",
    "date_of_filing",
    "date_of_decision",
    "date_first_list",
    "date_last_list",
    "date_next_list",
    "female_petitioner",
    "female_defendant",
]
MESSAGE_DDL = ", ".join(f"{c} string" for c in MESSAGE_COLUMNS)

CODE_COLUMNS = [
    "state_code", "dist_code", "court_no", "type_name", "purpose_name", "disp_name",
]
DATE_COLUMNS = [
    "date_of_filing", "date_of_decision", "date_first_list", "date_last_list", "date_next_list",
]
GENDER_COLUMNS = ["female_petitioner", "female_defendant"]

# ---- fixed values: key tables ----------------------------------------------
# name -> (file, code columns, text column, text used where no key matches)
KEY_TABLES = {
    "type": ("type_name_key.csv", ["type_name"], "type_name_s", "Unknown"),
    "disposition": ("disp_name_key.csv", ["disp_name"], "disp_name_s", "Pending"),
    "purpose": ("purpose_name_key.csv", ["purpose_name"], "purpose_name_s", "Not Listed"),
    "state": ("cases_state_key.csv", ["state_code"], "state_name", "Unknown"),
    "district": (
        "cases_district_key.csv", ["state_code", "dist_code"], "district_name", "Unknown",
    ),
    "court": (
        "cases_court_key.csv", ["state_code", "dist_code", "court_no"], "court_name", "Unknown",
    ),
}

# ---- fixed values: the cleaned fact table ----------------------------------
CLEANED_COLUMNS = [
    "ddl_case_id",
    "state_name",
    "district_name",
    "court_name",
    "court_no",
    "judge_position",
    "case_type",
    "purpose",
    "disposal_type",
    "date_of_filing",
    "date_of_decision",
    "date_first_list",
    "date_last_list",
    "date_next_list",
    "is_resolved",
    "case_age_days",
    "delay_category",
    "filing_year",
    "hearing_span_days",
    "petitioner_gender",
    "defendant_gender",
]
# working name -> name in the cleaned table
RENAMED = {
    "type_name_s": "case_type",
    "purpose_name_s": "purpose",
    "disp_name_s": "disposal_type",
    "female_petitioner": "petitioner_gender",
    "female_defendant": "defendant_gender",
}

# ---- fixed values: delay categories, upper age bound (days, exclusive) ------
DELAY_BOUNDS = [("Fast", 365), ("Medium", 1095), ("Slow", 2555)]
DELAY_REST = "Stuck"
DELAY_CATEGORIES = ["Fast", "Medium", "Slow", "Stuck"]

# ---- fixed values: publishing, streaming, JDBC ------------------------------
FILING_YEARS = range(2010, 2019)
KAFKA_PRODUCER = {
    "kafka.acks": "1",
    "kafka.compression.type": "gzip",
    "kafka.batch.size": "65536",
    "kafka.linger.ms": "10",
    "kafka.retries": "2",
    "kafka.max.block.ms": "60000",
}
MESSAGES_PER_BATCH = 100_000
JDBC_FETCH_SIZE = 10_000
JDBC_BATCH_SIZE = 10_000
JDBC_READ_PARTITIONS = 8
JDBC_WRITERS = 4
EXPORT_CHUNK = 100_000
OLDEST_PENDING = 50

# ---- fixed values: learning -------------------------------------------------
FEATURES = [
    "filing_year",
    "filing_month",
    "filing_day_of_week",
    "hearing_span_days",
    "delay_cat_encoded",
    "gender_encoded",
    "judge_encoded",
    "case_type_encoded",
]
DELAY_CODES = {"Fast": 0, "Medium": 1, "Slow": 2, "Stuck": 3}
GENDER_CODES = {"female": 1, "male": 0, "unknown": -1}
ENCODED_LABELS = {"judge_position": "judge_encoded", "case_type": "case_type_encoded"}
MISSING_LABEL = "unknown"
UNSEEN_CODE = -1
TRAINING_COLUMNS = [
    "ddl_case_id",
    "case_age_days",
    "filing_year",
    "hearing_span_days",
    "delay_category",
    "judge_position",
    "case_type",
    "petitioner_gender",
    "date_of_filing",
    "is_resolved",
]
TRAIN_UNTIL, VALIDATE_UNTIL = 2015, 2017
ROWS_PER_YEAR = 100_000
SEED = 42
SMOTE_NEIGHBOURS = 5
LOGISTIC_STEPS = 1000
FOREST_TREES, FOREST_DEPTH = 50, 10
BOOSTING_ROUNDS, BOOSTING_RATE = 100, 0.05
BOOSTING_DEPTH = 6
BOOSTING_LEAVES = 31
DISPOSE_FROM = 0.5
LINEUP_COLUMNS = [
    "ddl_case_id",
    "state_name",
    "district_name",
    "case_type",
    "date_of_filing",
    "date_next_list",
    "case_age_days",
    "delay_category",
    "petitioner_gender",
    "disposal_type",
    "resolution_probability",
    "predicted_outcome",
    "predicted_days_remaining",
    "prediction_date",
]
