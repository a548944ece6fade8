"""Fixed values that must stay as they are for identical results.

FIXED VALUES (do not edit): header spellings, labels, thresholds and
separators exactly as pages print them or patterns match them.
"""

# FIXED VALUES: result-table header label -> canonical column (exact match after
# whitespace cleaning).
HEADER_ALIASES = {
    "LP": "lp",
    "L.P.": "lp",
    "Lp": "lp",
    "Nazwisko Imię": "player",
    "Nazwisko i Imię": "player",
    "Nazwisko i imię": "player",
    "Kl": "klass",
    "Kl.": "klass",
    "Okręg": "district",
    "Okreg": "district",
    "Krąg": "m_skeet",
    "Krag": "m_skeet",
    "Oś": "m_lane",
    "Os": "m_lane",
    "MOP": "m_trap",
    "Śrut": "sub_shot",
    "Srut": "sub_shot",
    "Dzik": "m_boar",
    "Rogacz": "m_buck",
    "Kula": "sub_rifle",
    "Razem": "score",
}

# FIXED VALUES: a result table is kept only if it has all of these.
REQUIRED_RESULT_COLUMNS = ("player", "district", "score")

# FIXED VALUES: repeated header rows inside a result table (compared lower-cased).
REPEATED_HEADER_PLAYER = ("nazwisko imię", "nazwisko i imię")

# FIXED VALUES: schedule-table headers and the engine column each one feeds.
SCHEDULE_HEADERS = {
    "Lp": "schedule_lp",
    "Nazwa zawodów": "event_name",
    "ZO PZŁ": "organizer",
    "Strzelnica": "venue",
    "Data zawodów": "date_text",
    "Wyniki": "results_url",
}

# FIXED VALUES: a schedule link starting with this (lower-cased) means "no results".
NO_RESULTS_PREFIX = "brak"

# Numeric result columns coerced with the tolerant number rule, in table order.
NUMERIC_RESULT_COLUMNS = (
    "lp", "m_skeet", "m_lane", "m_trap", "sub_shot", "m_boar", "m_buck", "sub_rifle", "score",
)
MEASURE_COLUMNS = ("m_skeet", "m_lane", "m_trap", "m_boar", "m_buck")

# FIXED VALUES: award ladders, lower bounds inclusive, highest first; category
# "K" uses the first ladder, every other category the second.
AWARD_LABEL_DIAMOND = "złoty Wawrzyn Strzelecki z diamentem"
AWARD_LABEL_GOLD = "złoty Wawrzyn Strzelecki"
AWARD_LABEL_SILVER = "srebrny Wawrzyn Strzelecki"
AWARD_LABEL_BRONZE = "brązowy Wawrzyn Strzelecki"
AWARD_LADDERS = {
    "K": ((1411, AWARD_LABEL_DIAMOND), (1351, AWARD_LABEL_GOLD),
          (1306, AWARD_LABEL_SILVER), (1260, AWARD_LABEL_BRONZE)),
    "*": ((1455, AWARD_LABEL_DIAMOND), (1410, AWARD_LABEL_GOLD),
          (1365, AWARD_LABEL_SILVER), (1320, AWARD_LABEL_BRONZE)),
}
# Table 1 of a result page is the women's category.
CATEGORY_FIRST_TABLE = "K"
CATEGORY_OTHER_TABLES = "M"

# FIXED VALUES: disciplines of the weakness profile: (code, label, max score),
# in declared order (the order breaks ties between equally weak disciplines).
DISCIPLINES = (
    ("m_skeet", "Krag", 100.0),
    ("m_lane", "Os mysliwska", 100.0),
    ("m_trap", "MOP", 100.0),
    ("m_boar", "Dzik", 100.0),
    ("m_buck", "Rogacz", 100.0),
)

# FIXED VALUES: separator of joined event names.
NAME_SEPARATOR = " | "

# FIXED VALUES: trend wording of the weakness report.
TREND_TOO_FEW = "za malo startow na trend"
TREND_PREFIX = "trend "
TREND_FLAT = "trend bez zmian"
TREND_UNIT = " pkt"

# Qualification flags: places that qualify for the final / championship badge.
FINAL_PLACES = 6
CHAMPIONSHIP_PLACES = 3
