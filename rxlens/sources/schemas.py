"""Raw extract layouts.

Fixed values: the extract column headers and the clean names they map to.
They must match the extracts exactly (headers contain spaces, commas, ``?``
and, in ``Max. naive_end``, a dot; ``withColumnsRenamed`` takes them as is).
"""

from __future__ import annotations

# Dispensations extract header -> clean name.
DISPENSATIONS_RENAME = {
    "Month, Day, Year of Patient Birthdate": "disp_dob",
    "Month, Day, Year of Written At": "written_date",
    "Month, Day, Year of Filled At": "filled_date",
    "Month, Day, Year of Dispensations Created At": "disp_created_date",
    "Prescriber First Name": "prescriber_first_name",
    "Prescriber Last Name": "prescriber_last_name",
    "Orig Patient First Name": "patient_first_name",
    "Orig Patient Last Name": "patient_last_name",
    "Prescriber DEA": "prescriber_dea",
    "Generic Name": "generic_name",
    "Prescription Number": "rx_number",
    "AHFS Description": "ahfs",
    "Daily MME": "mme",
    "Days Supply": "days_supply",
    "Animal Name": "animal_name",
}

# Searches extract header -> clean name.
SEARCHES_RENAME = {
    "Month, Day, Year of Search Creation Date": "created_date",
    "Month, Day, Year of Searched DOB": "search_dob",
    "Searched First Name": "first_name",
    "Searched Last Name": "last_name",
    "Partial First Name?": "partial_first",
    "Partial Last Name?": "partial_last",
    "True ID": "true_id",
}

# User (ID) extract header -> clean name.
USERS_RENAME = {
    "Associated DEA Number(s)": "dea_number(s)",
    "User ID": "true_id",
    "User Full Name": "user_full_name",
    "State Professional License": "license_number",
    "Specialty Level 1": "specialty_1",
    "Specialty Level 2": "specialty_2",
    "Specialty Level 3": "specialty_3",
}

# Active prescriptions extract header -> clean name.
ACTIVE_RX_RENAME = {
    "Month, Day, Year of Patient Birthdate": "dob",
    "Month, Day, Year of Filled At": "filled_date",
    "Month, Day, Year of Dispensations Created At": "create_date",
    "Month, Day, Year of Written At": "written_date",
    "Orig Patient First Name": "patient_first_name",
    "Orig Patient Last Name": "patient_last_name",
    "Prescriber DEA": "dea",
    "AHFS Description": "ahfs",
    "Month, Day, Year of rx_end": "rx_end",
    "Animal Name": "animal_name",
}

# Opioid-naive extract header -> clean name.
NAIVE_RX_RENAME = {
    "Orig Patient First Name": "patient_first_name",
    "Orig Patient Last Name": "patient_last_name",
    "Max. naive_end": "naive_end",
    "Month, Day, Year of Patient Birthdate": "dob",
    "Month, Day, Year of Filled At": "naive_filled_date",
    "Animal Name": "animal_name",
}

# Clean column types; dates are listed with the text format they arrive in.
# Clean names that no operator reads: their headers may be missing.
UNUSED = frozenset(["generic_name"])
DISPENSATIONS_TYPES = {"days_supply": "int", "mme": "double"}
DISPENSATIONS_LONG_DATES = ("disp_dob", "written_date", "filled_date", "disp_created_date")
SEARCHES_TYPES = {"true_id": "bigint", "partial_first": "boolean", "partial_last": "boolean"}
SEARCHES_LONG_DATES = ("created_date", "search_dob")
USERS_TYPES = {"true_id": "bigint"}
ACTIVE_RX_LONG_DATES = ("dob", "filled_date", "create_date", "written_date", "rx_end")
NAIVE_RX_LONG_DATES = ("dob", "naive_filled_date")
NAIVE_RX_SHORT_DATES = ("naive_end",)

# Clean extract layouts (what the readers and the extract builders return).
DISPENSATIONS_COLUMNS = (
    "animal_name", "prescriber_dea", "rx_number", "ahfs", "patient_first_name", "patient_last_name",
    "prescriber_first_name", "prescriber_last_name", "written_date", "filled_date", "disp_created_date",
    "disp_dob", "days_supply", "mme",
)
SEARCHES_COLUMNS = ("true_id", "created_date", "search_dob", "first_name", "last_name",
                    "partial_first", "partial_last")
USERS_COLUMNS = ("true_id", "user_full_name", "dea_number(s)", "license_number",
                 "specialty_1", "specialty_2", "specialty_3")
ACTIVE_RX_COLUMNS = ("animal_name", "dea", "ahfs", "dob", "patient_first_name", "patient_last_name",
                     "create_date", "written_date", "filled_date", "rx_end")
NAIVE_RX_COLUMNS = ("animal_name", "dob", "patient_first_name", "patient_last_name",
                    "naive_filled_date", "naive_end")
