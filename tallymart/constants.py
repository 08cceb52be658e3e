"""The word lists, code sets and inventories results depend on.

Everything here is data, not logic.  Larger inventories (the survey catalogue,
the projection list) are expanded from these specs by rule, and lookups with
hundreds of rows (places) are always caller-supplied frames.
"""

# --- cell tokens ------------------------------------------------------------

# Cells that mean "no number here" in exported CSV tables.
CSV_NULL_TOKENS = ("", "**", "n/a", "N/A", "..", "-")

# The same for workbook grids.
GRID_NULL_TOKENS = ("", "**", "n/a", "N/A", "..", "...", "-", "x", "[x]")

# Hyphen, non-breaking hyphen, figure dash, en dash, em dash, horizontal bar, minus sign.
DASHES = "\u2010\u2011\u2012\u2013\u2014\u2015\u2212"

# Characters treated as surrounding whitespace.
WHITESPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"

# Body markers of a response that carries no table.
EMPTY_BODY_MARKERS = ("No data available", "This data series is now archived")
EMPTY_BODY_PREFIX_BYTES = 2000

# Month names accepted besides their three-letter forms.
MONTH_NAMES = (
    "january", "february", "march", "april", "may", "june",
    "july", "august", "september", "october", "november", "december",
)
EXTRA_MONTH_SPELLINGS = ("sept",)

# --- breakdowns and validity ------------------------------------------------

# What the first column of a table lists.
TIME_SERIES = "Historical Time Periods"
PLACE_BREAKDOWNS = (
    "Provinces", "Centres", "Survey Zones",
    "Census Subdivision", "Neighbourhoods", "Census Tracts",
)
PARENT_BREAKDOWNS = ("Provinces", "Centres")
SUB_METRO_BREAKDOWNS = ("Survey Zones", "Census Subdivision", "Neighbourhoods", "Census Tracts")
METRO_SCOPED_BREAKDOWNS = ("Survey Zones", "Neighbourhoods", "Census Tracts")
NATIONAL_GEO_FILTERS = ("All", "10k", "50k", "Metro")
DEFAULT_GEO_FILTER = "Default"

# Ids the publisher no longer serves anywhere.
DEAD_TABLE_IDS = ("1.16.3.4", "1.16.3.5")

# Level codes of places.
LEVEL_COUNTRY, LEVEL_PROVINCE, LEVEL_METRO, LEVEL_DISTRICT, LEVEL_TRACT = 1, 2, 3, 4, 7

# --- metric inventory -------------------------------------------------------

# Fixed values: (survey, series, metric name, market, unit); the position is the metric id.
METRICS = (
    ("Rms", "Vacancy Rate", "Vacancy Rate", "Primary", "%"),
    ("Rms", "Availability Rate", "Availability Rate", "Primary", "%"),
    ("Rms", "Average Rent", "Average Rent", "Primary", "$"),
    ("Rms", "Average Rent Change", "Average Rent Change", "Primary", "%"),
    ("Rms", "Median Rent", "Median Rent", "Primary", "$"),
    ("Rms", "Rental Universe", "Rental Universe", "Primary", "units"),
    ("Rms", "Summary Statistics", "Summary Statistics", "Primary", "mixed"),
    ("Srms", "Condo Vacancy Rate", "Condo Vacancy Rate", "Secondary", "%"),
    ("Srms", "Condo Average Rent", "Condo Average Rent", "Secondary", "$"),
    ("Srms", "Condo Universe", "Condo Universe", "Secondary", "units"),
    ("Srms", "Rental Condo Universe", "Rental Condo Universe", "Secondary", "units"),
    ("Srms", "Percentage Condo used as Rental", "Percent Condo Used as Rental", "Secondary", "%"),
    ("Srms", "Other Secondary Rental Universe", "Other Secondary Rental Universe", "Secondary", "units"),
    ("Srms", "Other Secondary Rental Average Rent", "Other Secondary Rental Average Rent", "Secondary", "$"),
)

# Dimension -> (suffix of the projection's name, name of its category column).
DIMENSION_COLUMNS = {
    "Bedroom Type": ("bedroom", "bedroom_type"),
    "Year of Construction": ("year_of_construction", "year_of_construction"),
    "Structure Size": ("structure_size", "structure_size"),
    "Rent Ranges": ("rent_range", "rent_range"),
    "Rent Quartiles": ("rent_quartile", "rent_quartile"),
    "Dwelling Type": ("dwelling_type", "dwelling_type"),
}

# Metric -> (value column, dimensions that get a projection).
_COMMON = ("Bedroom Type", "Year of Construction", "Structure Size")
PROJECTED_METRICS = {
    "Vacancy Rate": ("vacancy_pct", _COMMON + ("Rent Ranges", "Rent Quartiles")),
    "Availability Rate": ("availability_pct", _COMMON),
    "Average Rent": ("avg_rent_dollars", _COMMON),
    "Average Rent Change": ("rent_change_pct", ("Bedroom Type",)),
    "Median Rent": ("median_rent_dollars", _COMMON),
    "Rental Universe": ("n_units", _COMMON),
    "Condo Vacancy Rate": ("vacancy_pct", ("Structure Size",)),
    "Condo Average Rent": ("avg_rent_dollars", ("Bedroom Type",)),
    "Condo Universe": ("n_units", ("Structure Size",)),
    "Rental Condo Universe": ("n_units", ("Structure Size",)),
    "Percent Condo Used as Rental": ("pct_rental", ("Structure Size",)),
    "Other Secondary Rental Universe": ("n_units", ("Dwelling Type",)),
    "Other Secondary Rental Average Rent": ("avg_rent_dollars", ("Dwelling Type",)),
}

# Display order of rent bands.
RENT_BAND_ORDER = (
    "Less Than $750", "$750 - $999", "$1,000 - $1,249", "$1,250 - $1,499",
    "$1,500 +", "Non-Market/Unknown", "Total",
)

# --- workbook recipes -------------------------------------------------------

# Section of a published page -> survey label.
SECTION_LABELS = {
    "household-characteristics": "Household Characteristics",
    "housing-market-data": "Housing Market Data",
    "mortgage-and-debt": "Mortgage and Debt",
    "rental-market": "Rental Market",
}

# One sheet, places down, periods across, a single metric.
SINGLE_SHEET_SLUGS = (
    "mortgage-delinquency-rate-canada-provinces-cmas",
    "household-growth-summary-canada-provinces-territories-cmas",
    "number-households-canada-provinces-select-metropolitan-areas",
    "number-owner-households-owner-canada-provinces-cmas",
    "number-renter-households-renter-canada-provinces-cmas",
    "number-urban-households-core-housing-need",
    "ownership-rates-canada-provinces-territories-metropolitan-areas",
    "real-median-after-tax-household-income-1990-2011",
    "real-median-after-tax-household-income-owner-households-1990-2011",
    "real-median-after-tax-household-income-renter-households-1990-2011",
    "real-median-total-household-income-before-taxes-1990-2011",
    "real-median-total-household-income-before-taxes-owners-1990-2011",
)
# One sheet per census year, places down, categories across.
SHEET_PER_PERIOD_SLUGS = {"number-households-core-housing-need": "Geography1"}
# One sheet per category, places down, years across with code columns.
SHEET_PER_CATEGORY_SLUGS = {
    "real-average-total-household-income-before-taxes": "Geography",
    "real-average-household-income-after-taxes-tenure": "Geography",
    "incidence-urban-households-core-housing-need": "Geography",
    "real-median-household-income-after-tax-tenure": None,
    "real-median-total-household-income-before-taxes": None,
}
CODE_COLUMN_LABEL = "Data quality"
SKIPPED_SHEETS = ("Notes",)
