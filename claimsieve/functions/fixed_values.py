"""They decide results, so they must stay as they are."""

# Text forms -----------------------------------------------------------------
DATE_SHAPE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
MONEY = (14, 2)
LOAD_NULL_TOKENS = ("NULL", "null", "")

# Code tables: (accepted codes in upper case, label), then the label for everything else
GENDER = ((("M", "MALE"), "Male"), (("F", "FEMALE"), "Female"))
GENDER_OTHER = "NA"
CLAIM_STATUS = ((("Y",), "Rejected"), (("N",), "Not Rejected"))
CLAIM_STATUS_OTHER = "Unknown"
GROUP_TYPE = ((("GOVT", "GOVT."), "Government"), (("PRIVATE",), "Private"))
GROUP_TYPE_OTHER = "NA"

# Use-case thresholds --------------------------------------------------------
YOUNG_SUBSCRIBER_AGE = 30
MINOR_AGE = 18
CANCER_TEXT = "CANCER"
MONTHS_PER_YEAR = 12
CASHLESS_CHARGES = 50_000
KNEE_SURGERY_AGE = 40
KNEE_TEXT = "KNEE"

# Answers where the columns a use case needs are missing
NOT_AVAILABLE = "NOT AVAILABLE"
NO_CASHLESS_COLUMNS = "cashless insurance flag and total charges are not present in the uploaded dataset"
NO_PROCEDURE_COLUMNS = (
    "procedure or surgery information and past-year surgery tracking are not present in the uploaded dataset"
)
