"""Fixed schemas, seed rows and domain constants shared by readers and writers."""

from __future__ import annotations

from pyspark.sql import types as T

# Week index i stands for the sheet column ">i-(i+1)"; 52 is "52 plus".
WEEKS = 52
WEEK_COLUMNS = [f">{i}-{i + 1}" for i in range(WEEKS)]
OPEN_WEEK_COLUMN = "52 plus"

# Fixed values: (column, label, first week index, last week index, lower, upper, breach, long).
BANDS = [
    ("band_0_5_wks", "0-5 weeks", 0, 4, 0, 5, 0, 0),
    ("band_6_10_wks", "6-10 weeks", 5, 9, 6, 10, 0, 0),
    ("band_11_15_wks", "11-15 weeks", 10, 14, 11, 15, 0, 0),
    ("band_16_18_wks", "16-18 weeks", 15, 17, 16, 18, 0, 0),
    ("band_19_23_wks", "19-23 weeks", 18, 22, 19, 23, 1, 0),
    ("band_24_28_wks", "24-28 weeks", 23, 27, 24, 28, 1, 0),
    ("band_29_33_wks", "29-33 weeks", 28, 32, 29, 33, 1, 0),
    ("band_34_38_wks", "34-38 weeks", 33, 37, 34, 38, 1, 0),
    ("band_39_43_wks", "39-43 weeks", 38, 42, 39, 43, 1, 0),
    ("band_44_48_wks", "44-48 weeks", 43, 47, 44, 48, 1, 0),
    ("band_49_52_wks", "49-52 weeks", 48, 51, 49, 52, 1, 0),
    ("band_52_plus", "52+ weeks", 52, 52, 52, None, 1, 1),
]
BAND_COLUMNS = [b[0] for b in BANDS]
BAND_LABELS = {b[0]: b[1] for b in BANDS}
BREACH_COLUMNS = [b[0] for b in BANDS if b[6] == 1]
LONG_COLUMN = "band_52_plus"
BREACH_WEEK = 18  # first week index counted as over 18 weeks
LONG_WEEK = 52

# The region seed.
REGIONS = [
    ("Y56", "North East and Yorkshire", "NHSE-NEY"),
    ("Y58", "North West", "NHSE-NW"),
    ("Y59", "Midlands", "NHSE-MID"),
    ("Y60", "East of England", "NHSE-EOE"),
    ("Y61", "London", "NHSE-LON"),
    ("Y62", "South East", "NHSE-SE"),
    ("Y63", "South West", "NHSE-SW"),
]

# The treatment function seed (code, name, specialty group).
TREATMENT_FUNCTIONS = [
    ("100", "General Surgery", "Surgical"),
    ("101", "Urology", "Surgical"),
    ("110", "Trauma and Orthopaedic", "Surgical"),
    ("120", "Ear Nose and Throat (ENT)", "Surgical"),
    ("130", "Ophthalmology", "Surgical"),
    ("140", "Oral Surgery", "Surgical"),
    ("150", "Neurosurgery", "Surgical"),
    ("160", "Plastic Surgery", "Surgical"),
    ("170", "Cardiothoracic Surgery", "Surgical"),
    ("300", "General Medicine", "Medical"),
    ("301", "Gastroenterology", "Medical"),
    ("320", "Cardiology", "Medical"),
    ("330", "Dermatology", "Medical"),
    ("340", "Respiratory Medicine", "Medical"),
    ("400", "Neurology", "Medical"),
    ("410", "Rheumatology", "Medical"),
    ("420", "Endocrinology", "Medical"),
    ("501", "Obstetrics", "Medical"),
    ("502", "Gynaecology", "Surgical"),
    ("711", "Clinical Psychology", "Mental Health"),
    ("800", "Clinical Oncology", "Medical"),
]
DEFAULT_REGION_KEY = 1

# Expected dimension sizes of the published data set.
EXPECTED_COUNTS = {
    "dim_date": 132,
    "dim_trust": 189,
    "dim_region": 7,
    "dim_treatment_function": 25,
    "dim_wait_band": 12,
}

# Calendar bounds and named periods.
CALENDAR_START, CALENDAR_END = "2015-01-01", "2025-12-01"
COVID_START, COVID_END = "2020-03-01", "2022-03-01"
INDEX_MONTH = "2020-01-01"
BASELINE_FY = "2019/20"
BASELINE_START, BASELINE_END = "2019-04-01", "2020-03-01"
NOTEBOOK_BASELINE_END = "2020-02-01"
COVID_PEAK_START, COVID_PEAK_END = "2020-04-01", "2020-06-01"

# Sheet headers and the names used after renaming.
RENAMES = {
    "Region Code": "region_code",
    "Provider Code": "provider_org_code",
    "Provider Name": "provider_org_name",
    "Treatment Function Code": "treatment_function_code",
    "Treatment Function": "treatment_function_name",
    "Number of new RTT clock starts during the month": "new_rtt_periods",
    "Total number of incomplete pathways": "total_waiting",
    "Average (median) waiting time (in weeks)": "median_wait_weeks",
    "92nd percentile waiting time (in weeks)": "percentile_92_wait_weeks",
}
COMPLETED_TOTAL_HINT = "total number of completed"
CODE_PATTERN = "^[A-Z0-9]{3,6}$"

# File kinds; the first keyword found in a name wins, so NonAdmitted precedes Admitted.
FILE_KINDS = [
    ("Incomplete-Provider", "incomplete"),
    ("NonAdmitted-Provider", "completed_non_admitted"),
    ("Admitted-Provider", "completed_admitted"),
    ("New-Periods-Provider", "new_periods"),
]
SHEET_EXTENSIONS = [".xlsx", ".xls"]

# Sheet layout, 0-based.
PERIOD_ROW, PERIOD_COLUMN = 4, 2
HEADER_ROW = 13

ADMITTED, NON_ADMITTED = "Admitted", "Non-Admitted"
BASE_COLUMNS = [
    "region_code",
    "provider_org_code",
    "provider_org_name",
    "treatment_function_code",
    "treatment_function_name",
]
CELL_KEY = ["period_date", "provider_org_code", "treatment_function_code"]


def _fields(names: list[str], kind: T.DataType) -> list[T.StructField]:
    return [T.StructField(n, kind) for n in names]


def _processed(measures: list[T.StructField]) -> T.StructType:
    tail = _fields(["period_date", "source_file"], T.StringType())
    return T.StructType(_fields(BASE_COLUMNS, T.StringType()) + measures + tail)


_WAITS = _fields(["median_wait_weeks", "percentile_92_wait_weeks"], T.DoubleType())

# Processed CSV layouts; writer and reader use the same constant.
INCOMPLETE_CSV = _processed(_fields([*BAND_COLUMNS, "total_waiting"], T.LongType()) + _WAITS)
COMPLETED_CSV = _processed(
    _fields(["total_completed"], T.LongType()) + _WAITS + _fields(["pathway_type"], T.StringType())
)
NEW_PERIODS_CSV = _processed(_fields(["new_rtt_periods"], T.LongType()))


def as_text(schema: T.StructType) -> T.StructType:
    """The same columns, every one read as a string."""
    return T.StructType(_fields(schema.fieldNames(), T.StringType()))


def ddl(schema: T.StructType) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
