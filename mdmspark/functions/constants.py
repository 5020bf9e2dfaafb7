"""Fixed values.

Every value below must stay exactly as written: published tables and keys
depend on them (card-network vocabularies, key formula parameters, the money
clean-up pattern and the accepted date layouts).
"""

# --- fixed values -----------------------------------------------------------

# Transaction channel as written by the source system -> method code.
TRANSACTION_METHODS = {
    "Chip Transaction": "CHIP",
    "Swipe Transaction": "SWIPE",
    "Online Transaction": "ONLINE",
}
UNKNOWN = "UNKNOWN"

# Location type of a merchant.
ONLINE = "ONLINE"
PHYSICAL = "PHYSICAL"
ONLINE_CHANNEL = "Online Transaction"
PHYSICAL_CHANNELS = ("Chip Transaction", "Swipe Transaction")
ONLINE_CITY = "ONLINE"

# Gender text (upper-cased, trimmed) -> code.
GENDER_MALE = "MALE"
GENDER_FEMALE = "FEMALE"

# Chip flag spellings (upper-cased, trimmed).
CHIP_TRUE = ("YES", "Y", "TRUE", "1")
CHIP_FALSE = ("NO", "N", "FALSE", "0")

# Money: every character outside this class is dropped before the cast.
MONEY_STRIP_PATTERN = r"[^0-9.\-]"
MONEY_PRECISION = 18
MONEY_SCALE = 2
COORDINATE_PRECISION = 10
COORDINATE_SCALE = 6
CURRENCY_CODE = "USD"

# Surrogate key: parts joined with this separator, xxhash64, pmod by 2^63 - 1.
KEY_SEPARATOR = "||"
KEY_MODULUS = 9223372036854775807

# Merchant category codes: four digits, left-padded with '0'.
MCC_WIDTH = 4
MCC_PAD = "0"
DESCRIPTION_MAX_CHARS = 1000

# Flexible dates: whole-string shapes and the formats tried for each.
MONTH_YEAR4 = r"^\d{2}/\d{4}$"  # 09/2025 -> 2025-09-01
MONTH_YEAR2 = r"^\d{2}/\d{2}$"  # 09/25 -> 2025-09-01
YEAR_MONTH = r"^\d{4}-\d{2}$"  # 2025-09 -> 2025-09-01
ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"  # yyyy-MM-dd
SLASH_DATE = r"^\d{2}/\d{2}/\d{4}$"  # MM/dd/yyyy, then dd/MM/yyyy

# Snapshot date argument: YYYYMMDD.
SNAPSHOT_DATE_PATTERN = r"^\d{8}$"
