"""Fixed values of the register form and its workbook, in their natural order. Results depend on their spelling."""

# Readings of a strip, in form order.
FIELDS = [
    "record_no", "day", "month", "time_hh", "time_mm", "am_pm", "voucher_na", "voucher_color", "voucher_id",
    "patient_name", "village", "village_code", "first_time_odh", "first_voucher_use", "sex", "hh_owns_phone",
    "hh_owns_toilet", "last_care", "group_appt", "age_yrs", "hoh_education", "tests", "result_pn", "malaria",
    "sev_malaria", "weight_kg", "diagnosis", "art_dose", "treatment_line1", "treatment_line2", "treatment_line3",
    "tab_no", "full_cost", "balance", "cost_after_discount",
]
NAME, PLACE, NUMBER = "patient_name", "village", "record_no"
TREATMENTS = ["treatment_line1", "treatment_line2", "treatment_line3"]
TABLET = "tab_no"
SCALARS = [f for f in FIELDS if f not in (*TREATMENTS, TABLET)]
CHECKBOXES = ["sex", "first_time_odh", "hh_owns_phone", "hh_owns_toilet"]
CLIP = ["patient_name", "sex", "first_time_odh", "hh_owns_phone", "hh_owns_toilet", "result_pn", "diagnosis", "full_cost"]
CONTENT = ["treatment_line1", "treatment_line2", "treatment_line3", "tab_no", "full_cost", "balance", "cost_after_discount", "diagnosis"]
IDENTITY = ["sex", "age_yrs", "village"]
REPAIRABLE = [*CLIP, "record_no", "village", "village_code", "age_yrs", "day", "month", "time_hh", "time_mm", "am_pm"]
CONFIDENCES = ["high", "medium", "low", "illegible"]
LEAST_EMPTY, ALIKE, RECONCILER = 5, 0.75, "1"

# Valid values: whole numbers in a range, plain decimals, or one of a list.
RANGES = {"day": (1, 31), "month": (1, 12), "time_hh": (0, 12), "time_mm": (0, 59)}
DECIMALS = ["age_yrs", "weight_kg", "full_cost", "balance", "cost_after_discount"]
CHOICES = {"sex": ["M", "F"], "result_pn": ["P", "N"], "am_pm": ["AM", "PM"]}

# Columns of an exported row.
EXPORTED = [
    "record_id", "page_stem", "seq", "record_no", "patient_name", "sex", "age_yrs", "village", "village_code", "day",
    "month", "time", "first_time_odh", "first_voucher_use", "last_care", "group_appt", "hh_owns_phone",
    "hh_owns_toilet", "hoh_education", "tests", "result_pn", "malaria", "sev_malaria", "weight_kg", "diagnosis",
    "art_dose", "voucher_na", "voucher_color", "voucher_id", "treatments", "tab_nos", "full_cost", "balance",
    "cost_after_discount", "low_confidence_fields", "review", "review_reasons", "repaired_fields", "source_strips",
    "merged", "model", "reconciler_version",
]

# Columns of the workbook, those audited, and sheets that hold no records.
COLUMNS = [
    "Record No.", "Region", "Source PDF", "Page", "Center", "Date", "Time in", "Patient name", "Village",
    "1st time at ODH", "Last care code", "Travel time code", "1st voucher use", "Age (yrs)", "Sex", "Tests",
    "Malaria result", "Sev. malaria", "Diagnosis", "Treatment", "Tab no.", "Cost (UGX)", "Overall confidence",
    "Notes / uncertainties", "Optimization used",
]
AUDITED = ["Patient name", "Village", "Age (yrs)", "Sex", "Diagnosis", "Malaria result", "Cost (UGX)"]
RESERVED = ["Legend", "Progress"]

# Markers in order of precedence, with the cell colour of each; every colour but the verified one is a flag.
MARKERS = [("[verified]", "FF00B050"), ("[illegible]", "FFFF0000"), ("[??]", "FFFFC000"), ("[faded]", "FF4472C4"), ("[?]", "FFFFFF00")]
VERIFIED = "FF00B050"
FLAGS = ["FFFFFF00", "FFFFC000", "FFFF0000", "FF4472C4"]
LEGEND = [
    ("Green", "[verified]", "FF00B050"), ("Yellow", "[?]", "FFFFFF00"), ("Blue", "[faded]", "FF4472C4"),
    ("Orange", "[??]", "FFFFC000"), ("Red", "[illegible]", "FFFF0000"),
]
CLEAR = "00000000"
SOURCES = 312

# Prices in USD for a million tokens in and out, and the planning figures of a dry run in tokens a strip.
PRICES = {"gemini-3.5-flash-lite": (0.25, 1.50), "gemini-3.7-flash": (0.75, 3.75)}
PLANNED = (5400, 1000)

# Page geometry: canonical size, strips a page, sub-rows a strip, header share, snapping tolerance, padding, gap, line share.
WIDTH, HEIGHT, STRIPS, SUBROWS, HEADER, SNAP, PAD, GAP, LINE = 2000, 1400, 5, 3, 0.177, 0.03, 25, 6, 0.27

# Errors worth another attempt: status codes, and a pattern and words of a message.
RETRY_CODES = [429, 500, 501, 502, 503, 504]
RETRY_PATTERN = r"\b(429|50[0-4])\b"
RETRY_WORDS = ["RESOURCE_EXHAUSTED", "UNAVAILABLE", "DEADLINE_EXCEEDED"]
