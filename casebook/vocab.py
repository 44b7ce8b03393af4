"""Fixed vocabulary: the words, codes and header names results depend on."""

from __future__ import annotations

# --- Fixed values: identity --------------------------------------------------
ID_SALT = "VOS_SALT_v1"

# --- Fixed values: landing layout --------------------------------------------
SOURCE_ROOTS = ("estuary", "confluence", "Historical", "Daily")
INTAKE_ROOT = "estuary"
BACKFILL_ROOT = "Historical"
BRONZE_ZONE = "reef"
QUARANTINE_ZONE = "quarantine"
DERIVED_SUFFIXES = (".parquet", ".json")
UNKNOWN_SOURCE = "unknown"
GENERIC_DATASET = "generic"

# --- Fixed values: places ----------------------------------------------------
STATE_NAMES = {
    "AL": "Alabama", "AK": "Alaska", "AZ": "Arizona", "AR": "Arkansas",
    "CA": "California", "CO": "Colorado", "CT": "Connecticut", "DE": "Delaware",
    "FL": "Florida", "GA": "Georgia", "HI": "Hawaii", "ID": "Idaho",
    "IL": "Illinois", "IN": "Indiana", "IA": "Iowa", "KS": "Kansas",
    "KY": "Kentucky", "LA": "Louisiana", "ME": "Maine", "MD": "Maryland",
    "MA": "Massachusetts", "MI": "Michigan", "MN": "Minnesota",
    "MS": "Mississippi", "MO": "Missouri", "MT": "Montana", "NE": "Nebraska",
    "NV": "Nevada", "NH": "New Hampshire", "NJ": "New Jersey",
    "NM": "New Mexico", "NY": "New York", "NC": "North Carolina",
    "ND": "North Dakota", "OH": "Ohio", "OK": "Oklahoma", "OR": "Oregon",
    "PA": "Pennsylvania", "RI": "Rhode Island", "SC": "South Carolina",
    "SD": "South Dakota", "TN": "Tennessee", "TX": "Texas", "UT": "Utah",
    "VT": "Vermont", "VA": "Virginia", "WA": "Washington",
    "WV": "West Virginia", "WI": "Wisconsin", "WY": "Wyoming",
    "DC": "District of Columbia", "PR": "Puerto Rico", "VI": "Virgin Islands",
    "GU": "Guam", "AS": "American Samoa", "MP": "Northern Mariana Islands",
    "UM": "US Minor Outlying Islands",
}
NON_STATES = ("DC", "PR", "VI", "GU", "AS", "MP", "UM")
UNSEEDED_STATES = ("UM",)
REJECTED_STATES = ("US", "ON", "XX")

# Ordered rewrites (pattern, replacement) applied to an upper-cased city.
CITY_PREFIX_RULES = (
    (r"\s*\d{5}(-\d{4})?\s*$", ""),
    (
        r"^\d+\s+[A-Z]\.?\s+[A-Z]+\s+(STREET|ST|AVENUE|AVE|ROAD|RD|DRIVE|DR|BLVD"
        r"|BOULEVARD|WAY|LANE|LN|COURT|CT|CIRCLE|CIR|PLACE|PL)\s*",
        "",
    ),
    (
        r"^(STE|SUITE|UNIT|APT|BLDG|BUILDING|FLOOR|FL|RM|ROOM|PO BOX|P\.?O\.?\s*BOX)"
        r"\b\s*\d*\s*",
        "",
    ),
    (r"^\d+\s+", ""),
)
CITY_NICKNAMES = {"NYC": "NEW YORK"}
CITY_WORD_RULES = (
    (r" TOWNSHIP$", ""),
    (r"^MT\.?\s+", "MOUNT "),
    (r"^FT\.?\s+", "FORT "),
    (r"\bST\.?\b", "SAINT"),
    (r"\bSTE\.?\b", "SAINTE"),
    (r"\bBCH\b", "BEACH"),
    (r"\bHTS\b", "HEIGHTS"),
    (r"\bSPGS\b", "SPRINGS"),
    (r"\bVLY\b", "VALLEY"),
    (r"\bCTR\b", "CENTER"),
    (r"\bPK\b", "PARK"),
    (r"\bPT\b", "PORT"),
)

# Gazetteer place names: "<name> <kind>".
PLACE_KINDS = (
    "city", "town", "village", "CDP", "borough", "municipality", "urban county",
    "comunidad", "zona urbana", "metropolitan government", "unified government",
    "consolidated government", "unified.*government",
)
PLACE_PREFIXES = (("St. ", "Saint "), ("Ste. ", "Sainte "))
DEFAULT_PLACE_KIND = "Place"
GOVERNMENT_KINDS = ("metropolitan", "unified", "consolidated")

# --- Fixed values: companies -------------------------------------------------
# Words dropped from an incoming company name before its alias is looked up.
COMPANY_NOISE = (
    r"inc\.?", r"corp\.?", "llc", r"co\.?", r"ltd\.?", "store", "supercenter",
    "fulfillment", "services", "motors", "coffee",
)
# Words dropped from a listed company's name to make its alias.
LEGAL_FORMS = (
    r"inc\.?", r"corp\.?", "llc", r"co\.?", r"ltd\.?", "corporation",
    "incorporated", "company",
)
# Share-class texts cut out of a listed security's name, in this order.
SHARE_SUFFIXES = (
    " Common Stock", " Class A", " Class B", " Class C", " Ordinary Shares",
    " American Depositary Shares", " Depositary Shares", " Units", " Rights",
    " Warrants", " Preferred Stock", " Series A", " Series B", " Series C",
)
# Share types looked for in a security's name, first hit wins.
SHARE_TYPES = (
    "Common Stock", "Class A", "Class B", "Class C", "Ordinary Shares",
    "American Depositary Shares", "Depositary Shares", "Units", "Rights",
    "Warrants", "Preferred Stock",
)
DEFAULT_SHARE_TYPE = "Common Stock"

# Words that stay upper-case in display names.
ACRONYMS = (
    "OSHA", "MSHA", "FDA", "NHTSA", "FAA", "EPA", "DOT", "CPSC", "NIOSH",
    "USA", "US", "NYC", "LA", "DC", "UK",
    "LLC", "LP", "LLP", "PC", "PLLC", "NA", "NV", "II", "III", "IV",
)

# --- Fixed values: characters a trim removes (spaces, line ends, BOM) --------
TRIM_CHARS = (
    "\t\n\x0b\x0c\r \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"
)

# --- Fixed values: report sizes ----------------------------------------------
RECENT_PER_SOURCE = 5
TOP_COMPANIES = 10
RECENT_IN_STATE = 20
QUARANTINE_GROUPS = 100
SITEMAP_URLS = 25_000
DIRECTORY_PAGE = 30
NATION_DIRECTORY_PAGE = 60
COMPANY_RECENTS_PAGE = 10
COMPANY_RECENTS_WITH_SITES = 5
SIBLINGS_PAGE = 10

# Deductions of the safety score, per event.
SCORE_START = 100.0
SCORE_PER_FATALITY = 5.0
SCORE_PER_HOSPITALISATION = 2.0
SCORE_PER_VIOLATION = 0.5

# --- Fixed values: header maps -----------------------------------------------
# (source, dataset) -> canonical key -> file headers, the first present wins.
HEADER_MAPS: dict[tuple[str, str], dict[str, tuple[str, ...]]] = {
    ("OSHA", "severe-incident"): {
        "semantic_id": ("ID",),
        "event_date": ("EventDate",),
        "company_name": ("Employer",),
        "street": ("Address1", "Address2"),
        "city": ("City",),
        "state": ("State",),
        "zip": ("Zip",),
        "location_lat": ("Latitude",),
        "location_lon": ("Longitude",),
        "naics_code": ("Primary NAICS",),
        "description": ("Final Narrative",),
        "violation_type": ("NatureTitle", "EventTitle"),
        "violation_code": ("Nature", "Event", "Part of Body", "Source", "Secondary Source"),
        "violation_part": ("Part of Body Title",),
        "violation_source": ("SourceTitle", "Secondary Source Title"),
        "injuries_hospitalized": ("Hospitalized",),
        "injuries_amputation": ("Amputation",),
        "injuries_eye_loss": ("Loss of Eye",),
        "inspection_id": ("Inspection",),
    },
    ("OSHA", "odi-96-01"): {
        "data_reliability": ("SURVEYSTATUS",),
        "company_name": ("ESTAB_NAME", "ESTAB_NAME2"),
        "street": ("STREET",),
        "city": ("CITY",),
        "state": ("STATE",),
        "zip": ("ZIP",),
        "event_date": ("Year",),
        "sic_code": ("SIC",),
        "phone": ("PHONE",),
        "avg_annual_employees": ("Q1",),
        "total_hours_worked": ("Q2",),
        "status_normal": ("Q3A",),
        "status_strike": ("Q3B",),
        "status_shutdown": ("Q3C",),
        "status_seasonal": ("Q3D",),
        "status_disaster": ("Q3E",),
        "status_short_schedule": ("Q3F",),
        "status_long_schedule": ("Q3G",),
        "status_other": ("Q3H",),
        "total_injury_deaths": ("C1",),
        "injuries_days_away_restricted": ("C2",),
        "injuries_days_away": ("C3",),
        "total_days_away": ("C4",),
        "total_days_restricted": ("C5",),
        "injuries_no_lost_days": ("C6",),
        "illness_skin": ("C7A",),
        "illness_dust_lung": ("C7B",),
        "illness_respiratory_toxic": ("C7C",),
        "illness_poisoning": ("C7D",),
        "illness_physical_agents": ("C7E",),
        "illness_repeated_trauma": ("C7F",),
        "illness_other": ("C7G",),
        "total_illness_deaths": ("C8",),
        "illnesses_days_away_restricted": ("C9",),
        "illnesses_days_away": ("C10",),
        "illnesses_days_away_total": ("C11",),
        "illnesses_restricted_total": ("C12",),
        "illnesses_no_lost_days": ("C13",),
    },
    ("OSHA", "odi-02-11"): {
        "data_reliability": ("SURVEYSTATUS",),
        "company_name": ("ESTAB_NAME", "ESTAB_NAME2"),
        "street": ("STREET",),
        "city": ("CITY",),
        "state": ("STATE",),
        "zip": ("ZIP",),
        "event_date": ("Year",),
        "sic_code": ("SIC",),
        "naics_code": ("NAICS",),
        "phone": ("PHONE",),
        "avg_annual_employees": ("EMP_Q1",),
        "total_hours_worked": ("HOURS_Q2",),
        "status_normal": ("UNUSUAL_Q3",),
        "status_strike": ("STRIKE_Q3",),
        "status_shutdown": ("SHUT_Q3",),
        "status_seasonal": ("SEASONAL_Q3",),
        "status_disaster": ("DISASTER_Q3",),
        "status_short_schedule": ("SHORT_Q3",),
        "status_long_schedule": ("LONG_Q3",),
        "status_other": ("OREASON_Q3",),
        "status_other_desc": ("OREASON_DESC",),
        "injury_illness_occurred": ("INJILL_Q4",),
        "total_deaths": ("DEATHS_G",),
        "cases_days_away": ("CAWAY_H",),
        "cases_job_transfer": ("CTRANSFER_I",),
        "cases_other": ("COTHER_J",),
        "days_away": ("DAWAY_L",),
        "days_job_transfer": ("DTRANSFER_K",),
        "injuries_total": ("INJ_M1",),
        "illness_skin": ("SKIN_M2",),
        "illness_respiratory": ("RESP_M3",),
        "illness_poisoning": ("POIS_M4",),
        "illness_hearing_loss": ("HEARING_M",),
        "illness_other": ("OTHER_M5",),
    },
    ("OSHA", "ita"): {
        "semantic_id": ("id",),
        "company_name": ("company_name", "establishment_name"),
        "ein": ("ein",),
        "street": ("street_address",),
        "city": ("city",),
        "state": ("state",),
        "zip": ("zip_code",),
        "naics_code": ("naics_code",),
        "industry_desc": ("industry_description",),
        "avg_annual_employees": ("annual_average_employees",),
        "total_hours_worked": ("total_hours_worked",),
        "no_injuries_illnesses": ("no_injuries_illnesses",),
        "total_deaths": ("total_deaths",),
        "cases_days_away": ("total_dafw_cases",),
        "cases_job_transfer": ("total_djtr_cases",),
        "cases_other": ("total_other_cases",),
        "days_away": ("total_dafw_days",),
        "days_job_transfer": ("total_djtr_days",),
        "injuries_total": ("total_injuries",),
        "illness_poisoning": ("total_poisonings",),
        "illness_respiratory": ("total_respiratory_conditions",),
        "illness_skin": ("total_skin_disorders",),
        "illness_hearing_loss": ("total_hearing_loss",),
        "illness_other": ("total_other_illnesses",),
        "establishment_id": ("establishment_id",),
        "establishment_type": ("establishment_type",),
        "size": ("size",),
        "event_date": ("year_filing_for", "created_timestamp"),
        "change_reason": ("change_reason",),
    },
}

# Canonical keys that have a column of their own (or never go into the overflow).
NOT_IN_DETAILS = (
    "event_id", "source", "source_url", "ingested_at", "event_date", "raw_data",
    "state", "city", "city_slug", "company_slug", "site_id", "event_title",
    "event_description",
)
# A survey row is recognised by either of these being mapped.
SURVEY_KEYS = ("avg_annual_employees", "total_hours_worked")

# --- Fixed values: narrative requests ----------------------------------------
NARRATIVE_SYSTEM_TEXT = """You are a workplace safety data analyst. Convert OSHA violation data into structured, neutral, factual descriptions.

CRITICAL RULES:
- Use ONLY information provided in the violation data
- Do NOT invent, infer, or assume details
- Write in neutral, professional, journalistic tone
- No sarcasm, humor, or editorial commentary
- Return ONLY valid JSON, no markdown or code blocks

OUTPUT FORMAT:
Return JSON with these fields:
- title: Brief descriptive title (max 80 chars)
- explanation: What happened (2-4 sentences, neutral)
- riskAssessment: Safety risk assessment (2-3 sentences)
- compliance: OSHA compliance context (1-2 sentences, optional)
- keyPoints: Array of 3-5 key points
- industryContext: Industry context from NAICS (1 sentence, optional)"""

NARRATIVE_REQUEST_HEAD = """Convert the following OSHA violation data into a structured description. Use ONLY the information provided. Do not invent or infer details.

VIOLATION DATA:
"""

NARRATIVE_REQUEST_TAIL = """

Return a JSON object with the following structure:
{
  "title": "Brief descriptive title (max 80 chars)",
  "explanation": "What happened (2-4 sentences, neutral)",
  "riskAssessment": "Safety risk assessment (2-3 sentences)",
  "compliance": "OSHA compliance context (1-2 sentences, optional)",
  "keyPoints": ["Point 1", "Point 2", "Point 3"],
  "industryContext": "Industry context from NAICS (1 sentence, optional)"
}"""
