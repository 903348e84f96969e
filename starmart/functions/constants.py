"""Fixed values.

These must equal the values the original ETL uses, or the star tables come out
different. They are stated here plainly, in the order the original gives them.
"""

# Fixed value: SAS numeric dates count days from this day.
SAS_EPOCH = "1960-01-01"

# Fixed value: the year the age of a traveller is computed at.
REFERENCE_YEAR = 2016

# Labels of the visa class code (i94visa).
VISA_LABELS = {1: "Business", 2: "Pleasure", 3: "Student"}

# Labels of the travel mode code (i94mode).
MODE_LABELS = {1: "Air", 2: "Sea", 3: "Land", 9: "Not reported"}

# Fixed value: text given to codes outside the label tables.
UNKNOWN_LABEL = "N/A"

# Genders kept in the fact table.
KEPT_GENDERS = ["F", "M"]

# Fixed value: only rows of this travel mode code reach the fact table (Air).
AIR_MODE = 1

# State texts of port codes that lie outside the United States.
NON_US_STATES = [
    "CANADA", "Canada", "NETHERLANDS", "NETH ANTILLES", "THAILAND", "ETHIOPIA", "PRC", "BERMUDA",
    "COLOMBIA", "ARGENTINA", "MEXICO", "BRAZIL", "URUGUAY", "IRELAND", "GABON", "BAHAMAS", "MX",
    "CAYMAN ISLAND", "SEOUL KOREA", "JAPAN", "ROMANIA", "INDONESIA", "SOUTH AFRICA", "ENGLAND",
    "KENYA", "TURK & CAIMAN", "PANAMA", "NEW GUINEA", "ECUADOR", "ITALY", "EL SALVADOR",
]

# Airport types dropped from the airport dimension.
EXCLUDED_AIRPORT_TYPES = ["closed", "heliport", "seaplane_base", "balloonport"]

# Temperature rows are kept for this country and strictly after this day.
TEMPERATURE_COUNTRY = "United States"
TEMPERATURE_AFTER = "1950-01-01"

# Fixed value: an airport's region text must have this length (``US-CA``).
REGION_CODE_LENGTH = 5

# Fixed value: airports are kept when their upper-cased country contains this text.
AIRPORT_COUNTRY_TEXT = "US"

# Section search texts of the label file, and the header of the
# code table each section is written to.
LABEL_SECTIONS = {
    "I94CIT & I94RES": ("i94_country", ["code", "country_name"]),
    "I94PORT": ("i94_port", ["code", "port", "state_code"]),
    "I94MODE": ("i94_model", ["code", "model"]),
    "I94ADDR": ("i94_state_addrl", ["code", "state"]),
    "I94BIR": ("i94_visa", ["code", "VISA_Type"]),
}
