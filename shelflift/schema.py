"""Column names and types of the eight source tables, and the code lists used by the rules.

Everything in this module is a fixed value of the source data.
"""

from __future__ import annotations

SOURCE_TABLES: dict[str, str] = {
    "transaction_data": (
        "household_key int, basket_id bigint, day int, product_id bigint, quantity int, "
        "sales_value decimal(10,2), store_id int, retail_disc decimal(10,2), trans_time int, "
        "week_no int, coupon_disc decimal(10,2), coupon_match_disc decimal(10,2)"
    ),
    "product": (
        "product_id bigint, manufacturer int, department string, brand string, "
        "commodity_desc string, sub_commodity_desc string, curr_size_of_product string"
    ),
    "hh_demographic": (
        "age_desc string, marital_status_code string, income_desc string, homeowner_desc string, "
        "hh_comp_desc string, household_size_desc string, kid_category_desc string, household_key int"
    ),
    "campaign_table": "description string, household_key int, campaign int",
    "campaign_desc": "description string, campaign int, start_day int, end_day int",
    "coupon": "coupon_upc bigint, product_id bigint, campaign int",
    "coupon_redempt": "household_key int, day int, coupon_upc bigint, campaign int",
    "causal_data": "product_id bigint, store_id int, week_no int, display string, mailer string",
}

# Departments that are not merchandise, and the commodity label of products without a category.
EXCLUDED_DEPARTMENTS = ["", "KIOSK-GAS", "MISC SALES TRAN", "MISC. TRANS.", "COUP/STR & MFG"]
NO_COMMODITY = "NO COMMODITY DESCRIPTION"

# Placement code of a product that is not on display / not in the mailer.
NOT_PLACED = "0"

# Promotion types.
BOTH = "display + mailer"
DISPLAY_ONLY = "display only"
MAILER_ONLY = "mailer only"

# Levels of the uplift summary and of the cannibalisation summary.
LEVEL_TYPE = "1. promo type"
LEVEL_DISPLAY = "2. display location (display-only weeks)"
LEVEL_MAILER = "3. mailer placement (mailer-only weeks)"
CANNIBAL_OVERALL = "1. overall"
CANNIBAL_TYPE = "2. promo type"
CANNIBAL_DEPARTMENT = "3. department"
ALL_PROMOTIONS = "all promotions"
MIXED = "mixed"

# Readable names of the placement codes.
DISPLAY_NAMES = {
    "1": "Store front",
    "2": "Store rear",
    "3": "Front end cap",
    "4": "Mid-aisle end cap",
    "5": "Rear end cap",
    "6": "Side-aisle end cap",
    "7": "In-aisle",
    "9": "Secondary location",
    "A": "In-shelf",
}
MAILER_NAMES = {
    "A": "Interior page feature",
    "C": "Interior page line item",
    "D": "Front page feature",
    "F": "Back page feature",
    "H": "Wrap front feature",
    "J": "Wrap interior coupon",
    "L": "Wrap back feature",
}
FREE_ITEM_MAILERS = ["X", "Z", "P"]

# Customer segments, and the quintile scores from which they count as high and as fair.
HIGH_SCORE = 4
FAIR_SCORE = 3
CHAMPIONS = "Champions"
LOYAL = "Loyal"
PROMISING = "Promising"
NEEDS_ATTENTION = "Needs attention"
AT_RISK = "At risk"
LOST = "Lost"

# The twelve income bands of the demographics table and the four reporting bands.
INCOME_BANDS = {
    "Under 15K": "Under $35K",
    "15-24K": "Under $35K",
    "25-34K": "Under $35K",
    "35-49K": "$35-74K",
    "50-74K": "$35-74K",
    "75-99K": "$75-124K",
    "100-124K": "$75-124K",
    "125-149K": "$125K+",
    "150-174K": "$125K+",
    "175-199K": "$125K+",
    "200-249K": "$125K+",
    "250K+": "$125K+",
}
TOP_INCOME_BAND = "$125K+"
NOT_KNOWN = "Not known"
