"""Fixed values of the schedule feed: names, codes and formats that results depend on."""

# --- fixed values: raw schedule columns, in file order ---------------------
PRELOG_COLUMNS = [
    "CHANNEL_ID",
    "CHANNEL_BELT",
    "TX_DATE",
    "START_TIME",
    "SLOT_DURATION",
    "SLOT_NAME",
    "MAIN_TITLE",
    "EPISODE_TITLE",
    "GENRE",
    "SUB_GENRE",
    "REPEAT",
    "LIVE_FLAG",
    "SUBTITLE_LANGUAGE",
    "PROGRAMME_ID",
    "COUNTRY_DESC",
    "LANGUAGE_DESC",
    "PRODUCTION_TYPE_DESC",
    "LOADING_FACTOR",
    "SPONSORED_FLAG",
    "LIVE_PROGRAMME_ID",
    "REFERENCE_ID",
    "MASTER_REFERENCE_KEY",
    "PRODUCTION_SUB_TYPE",
    "PSB_SURVEY",
    "ALTERNATE_LANGUAGE",
]

# --- fixed values: drop-file naming ----------------------------------------
FILE_PREFIX = "F"
FOLDER_DATE_PATTERN = "yyyy-MM-dd"
FILE_DATE_PATTERN = "yyMMdd"  # how the names are built
FILE_DATE_PATTERN_DAY_FIRST = "ddMMyy"  # the other reading of the same six digits
FILE_DATE_START = 2
FILE_DATE_LENGTH = 6
FILE_VERSION_START = 8
FILE_EXTENSION_LENGTH = 4

# --- fixed values: load key and date formats -------------------------------
LOAD_KEY = ["import_date", "file_name"]
TX_DATE_PATTERN = "yyyyMMdd"
DISPLAY_DATE_PATTERN = "dd/MM/yyyy"
NULL_SENTINEL = "NULL"

# --- fixed values: report datasets and the columns each one normalises -----
MAIN_DATASET = "Main Report"
MAIN_DATE_COLUMNS = ("Broadcast Date", "Start Date", "End Date")
MAIN_INT_COLUMNS = ("Program ID", "Content ID")
SECONDARY_DATE_COLUMNS = ("import_date", "TX_DATE")
SECONDARY_INT_COLUMNS = ("START_TIME", "SLOT_DURATION", "LOADING_FACTOR")
SECONDARY_LENIENT_COLUMNS = ("PROGRAMME_ID",)

TITLE_DATASET = "Exclusive Titles"
TITLE_COLUMN = "Main Title"
EXCLUSIVE_TITLES = [
    "What on Earth S2",
    "Let Me Tell You A Story",
    "Streets Made For Talking : Telok Ayer",
    "Oh Butterfly!",
    "Measuring Meritocracy",
    "Space Farmers",
    "MasterChef Singapore Season 4",
    "The Great Migration: New Eden",
    "Pesuvom Sr 2",
    "Lights. Camera. Action On Caldecott",
    "The Roots Of Our Garden",
    "Untold Legends",
    "Premium Rush: Inside Air Cargo Singapore - Part 1",
    "Premium Rush: Inside Air Cargo Singapore - Part 2",
    "ROOTS: A Greening Journey",
]

# --- fixed values: run log --------------------------------------------------
STATUS_CODES = [-1, 1, 2, 3]
STATUS_WHEN_ABSENT = -1
INSERT_RETURN_STATUS = 1
