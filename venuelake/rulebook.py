"""Fixed values that decide results: word lists, thresholds and rates.

Venue data (rosters, owners, caps, price lists, vendor maps, keyword rules, house tabs) are input tables
and don't appear here; of rule rows that a venue may replace (processor and deposit lines) the defaults do.
"""

# Reason text -> bucket, first hit wins.
COMP_REASONS = [
    ("birthday", "programmatic_birthday"),
    ("promoter", "programmatic_promoter"),
    ("wycliffe", "programmatic_standing"),
    ("owner comp", "owner_discretion"),
    ("spillage", "recovery"),
    ("food quality", "recovery"),
    ("customer didn't like", "recovery"),
    ("employee discount", "employee"),
    ("manager comp", "discretionary_manager"),
    ("open $", "uncategorized_open_dollar"),
    ("open %", "uncategorized_open_pct"),
]
DISCRETIONARY = ["discretionary_manager", "recovery", "uncategorized_open_dollar", "uncategorized_open_pct"]
UNCATEGORIZED = ["uncategorized_open_dollar", "uncategorized_open_pct"]
EXCLUDED = ["employee"]
INTENT_BUCKETS = [
    "owner_discretion", "programmatic_birthday", "programmatic_promoter", "programmatic_marketing", "programmatic_standing",
]
PREMIUM_WORDS = [
    "1942", "clase azul", "ace of spades", "cristal", "louis xiii", "louis roederer", "moet ice", "chandon reserve",
]
CHAMPAGNE_WORDS = ["moet", "wycliff", "bellaire", "prosecco", "veuve", "cristal", "dom p", "ace ", " ace", "champagne"]
PACKAGE_WORDS = ["birthday dinner package", "birthday package", "bday package", "birthday dinner"]
BIRTHDAY_WORDS = ["birthday", "bday"]
PARTY_TAB = r"(?i)^bday[\s\-\.]*(?:f(?:ri)?|s(?:at)?|w(?:ed)?|u(?:un)?|sun)[\s\-\.]+([a-z]+)"
PACKAGE_MIN_SPEND = 200.0
# Weekday (Monday = 0) -> (item word, how it is rung).
BIRTHDAY_PROGRAM = [
    (2, "bellaire", "comped"),
    (4, "moet", "cost_basis"),
    (5, "moet", "cost_basis"),
    (6, "bellaire", "retail_or_cost_basis"),
]

# Expense groups by words in the category name.
COGS_WORDS = ["cost of goods", "cogs"]
LABOR_WORDS = ["3. labor", "labor cost", "payroll"]
MARKETING_WORDS = ["marketing", "promotions", "entertainment", "event"]
OPEX_WORDS = ["operating expenses", "opex"]

GRAT_RETAIN = 0.35
LABOR_RATE_PER_HOUR = 18.0

# Default rule rows for settlement lines of the card processor, first hit wins: (words that the upper-case text holds, a regex it also matches or
# None, category, vendor). A venue with another processor passes its own rows.
PROCESSOR_LINES = [
    (["TOAST", "DES:DEP"], None, "1. Revenue/Sales Revenue", "Toast Deposit"),
    (["TOAST", "DES:EOM"], None, "1. Revenue/Sales Revenue", "Toast EOM Adjustment"),
    (["TOAST", "INC", "DES:"], r"TOAST,?\s*INC\.?\s+DES:\d{8}", "1. Revenue/Sales Revenue", "Toast Settlement"),
    (["TOAST", "DES:REF"], None, "5. Operating Expenses (OPEX)/POS & Technology Fees", "Toast Refund"),
    (["TOAST", "INC", "DES:TOAST"], r"TOAST,?\s*INC\s+DES:TOAST", "5. Operating Expenses (OPEX)/POS & Technology Fees", "Toast Platform Fee"),
]
# Default rule rows for deposits, first hit wins: (text, whether the description must begin with it, sign of the amount or 0 for any, kind).
DEPOSIT_LINES = [
    ("NET SETLMT", False, 1, "card_settlement"),
    ("TOAST DES:DEP", False, 1, "processor_deposit"),
    ("TOAST DES:EOM", False, 0, "processor_month_end"),
    ("Counter Credit", False, 1, "counter_credit"),
    ("Toast, Inc DES:Toast", False, -1, "platform_fee"),
    ("Online Banking transfer from CHK", True, 1, "transfer_in"),
]

# Sales categories of the payout report.
LIQUOR_SALES = r"liquor|beer|wine|bottle|cocktail|spirits|na beverage|n/a beverage"
FOOD_SALES = r"food|kitchen|appetizer|entree|dessert|brunch"
SHISHA_SALES = r"hookah|shisha"

# Grades: metric, good limit, watch limit, direction.
COMP_GRADES = [("recovery", 2.0), ("discretionary_manager", 1.5)]
PRIME_GRADES = [(55.0, "Excellent"), (60.0, "Good"), (65.0, "Elevated")]
SYNTHETIC_USER = r"^[a-f0-9]{8}-[a-f0-9]{4}-[a-f0-9]{4}-[a-f0-9]{4}-[a-f0-9]{12}"
