"""Rules for the postings preset. Everything here is data, not logic.

FIXED VALUES: the patterns, labels, factors and thresholds below decide which
postings are kept and how they are labelled, so they must not be reworded.
"""

from __future__ import annotations

INDUSTRY_CODE = "5415"
WINDOW_DAYS = 365

TITLE_INCLUDE = [
    "data analyst",
    "data scien",
    "business intelligence",
    "bi analyst",
    "data engineer",
    "analytics engineer",
    "business analyst",
    "reporting analyst",
]
# "qa " keeps its trailing blank.
TITLE_EXCLUDE = [
    "security",
    "qa ",
    "quality assurance",
    "support",
    "trade",
    "exploitation",
    "acceptance testing",
    "network",
]
TITLE_BROAD = ["analyst", "analytics", "data scien", "business intelligence", "data engineer"]

OCCUPATIONS_KEPT = [
    "Data Scientists",
    "Database Architects",
    "Management Analysts",
    "Business Intelligence Analysts",
]
OCCUPATION_DISPLAY = {
    "Other": "Other matched analytics roles",
    "Business Intelligence Analysts": "Business intelligence analysts",
    "Management Analysts": "Management analysts",
    "Database Architects": "Database architects / data engineers",
    "Data Scientists": "Data scientists / data analysts",
}

# First matching rule wins.
ROLE_RULES = [
    ("data scien", "Data Scientist"),
    ("data engineer|analytics engineer", "Data Engineer"),
    ("business intelligence|bi analyst", "Business Intelligence"),
    ("data analyst|reporting analyst", "Data Analyst"),
    ("business analyst", "Business Analyst"),
]

ARRANGEMENT_SYNONYMS = {"onsite": "On-site", "on-site": "On-site"}
ARRANGEMENT_UNKNOWN = "Unknown"
ARRANGEMENT_ORDER = ["Remote", "Hybrid", "On-site", "Unknown"]
FLEXIBLE_ARRANGEMENTS = ["Remote", "Hybrid"]

YEARS_MIN, YEARS_MAX = 1, 20
ENTRY_YEARS = 2
YEARS_EDGES = [0, 2, 4, 7, 10, 100]
YEARS_LABELS = ["1-2 years", "3-4 years", "5-7 years", "8-10 years", "More than 10"]

EDUCATION_LEVELS = [
    "High school diploma or equivalent",
    "Postsecondary nondegree award",
    "Associate's degree",
    "Bachelor's degree",
    "Master's degree",
    "Doctoral or professional degree",
]
EDUCATION_MISSING = "Not specified"
EMPLOYER_MISSING = "Unknown employer"

PERIOD_FACTORS = {"hourly": 2080.0, "daily": 260.0, "weekly": 52.0, "monthly": 12.0, "annual": 1.0}
PAY_FLOOR = 20000.0

CAPITAL_PATTERN = r"(?i)district of columbia|washington,?\s*d\.?\s?c\b"
CAPITAL_LABEL = "District of Columbia"
CODE_IN_TEXT = r",\s*([A-Z]{2})[,;]"
STATE_UNRESOLVED = "Unspecified"
STATES = {
    "AL": "Alabama",
    "AK": "Alaska",
    "AZ": "Arizona",
    "AR": "Arkansas",
    "CA": "California",
    "CO": "Colorado",
    "CT": "Connecticut",
    "DE": "Delaware",
    "DC": "District of Columbia",
    "FL": "Florida",
    "GA": "Georgia",
    "HI": "Hawaii",
    "ID": "Idaho",
    "IL": "Illinois",
    "IN": "Indiana",
    "IA": "Iowa",
    "KS": "Kansas",
    "KY": "Kentucky",
    "LA": "Louisiana",
    "ME": "Maine",
    "MD": "Maryland",
    "MA": "Massachusetts",
    "MI": "Michigan",
    "MN": "Minnesota",
    "MS": "Mississippi",
    "MO": "Missouri",
    "MT": "Montana",
    "NE": "Nebraska",
    "NV": "Nevada",
    "NH": "New Hampshire",
    "NJ": "New Jersey",
    "NM": "New Mexico",
    "NY": "New York",
    "NC": "North Carolina",
    "ND": "North Dakota",
    "OH": "Ohio",
    "OK": "Oklahoma",
    "OR": "Oregon",
    "PA": "Pennsylvania",
    "RI": "Rhode Island",
    "SC": "South Carolina",
    "SD": "South Dakota",
    "TN": "Tennessee",
    "TX": "Texas",
    "UT": "Utah",
    "VT": "Vermont",
    "VA": "Virginia",
    "WA": "Washington",
    "WV": "West Virginia",
    "WI": "Wisconsin",
    "WY": "Wyoming",
}
CITY_RULES = [
    ("San,? Francisco", "California"),
    ("Sunnyvale", "California"),
    ("Santa,? Monica", "California"),
    ("San Mateo", "California"),
    ("Austin", "Texas"),
    ("Chicago", "Illinois"),
]

COMPANY_SUFFIX = r"(llc|inc|corp|corporation|ltd)$"
URL_LIKE = r"(?i)\.(?:com|net|org)|oraclecloud|myworkday"
NATIONAL = r"(?i)remote|united states|\bUSA?\b"

# Share of postings (%) at or above which a skill is expected at a level.
TARGET_TIERS = [(20.0, 4), (10.0, 3)]
TARGET_BASE = 2

SKILL_THRESHOLD = 0.05
TOP_STATES = 6
OTHER_STATE = "Other state"
TEST_SHARE = 0.25
FOLDS = 5
SEED = 688
FOREST_TREES = 500
FOREST_DEPTH = 30
FOREST_LEAF = 3
LOGISTIC_ITERATIONS = 2000

PANEL_COLUMNS = [
    "ID",
    "TITLE_CLEAN",
    "COMPANY_NAME",
    "COMPANY_IS_STAFFING",
    "occupation_group",
    "role_family",
    "posted_date",
    "state",
    "LOCATION",
    "REMOTE_TYPE_NAME",
    "MAX_EDULEVELS_NAME",
    "MIN_EDULEVELS_NAME",
    "min_years_experience",
    "max_years_experience",
    "salary_from_annual",
    "salary_to_annual",
    "salary_midpoint",
    "ORIGINAL_PAY_PERIOD",
    "SKILLS_NAME",
    "SPECIALIZED_SKILLS_NAME",
    "NAICS_2022_4",
    "NAICS_2022_6_NAME",
]
COVERAGE_FIELDS = [
    "STATE_NAME",
    "STATE",
    "COUNTY_NAME",
    "MSA_NAME",
    "SALARY_FROM",
    "MIN_YEARS_EXPERIENCE",
]
LIST_FIELDS = [
    "SKILLS_NAME",
    "SPECIALIZED_SKILLS_NAME",
    "COMMON_SKILLS_NAME",
    "SOFTWARE_SKILLS_NAME",
]
