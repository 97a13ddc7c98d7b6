"""Codes, signs and labels that decide results.

These must equal the values used by the source systems; they are data, given as
plain text.
"""

# Document type of an invoice, by billing type or "billing type|order reason".
INVOICE_TYPE = {
    "ZIV": 4, "ZWIF": 4, "ZWMF": 4, "ZF2": 4, "ZF3": 4, "ZFBG": 4,
    "ZL2": 5, "ZG2": 6, "ZG4": 6, "ZRE": 7,
    "ZL3|Z04": 12, "ZL3|Z09": 17, "ZL3": 14,
    "ZG3|Z04": 13, "ZG3|Z09": 16, "ZG3": 15,
}

# Sign of an invoice, by billing type.
INVOICE_SIGN = {
    "ZS1": -1, "ZS2": 1, "ZS3": 1, "ZS4": -1, "ZIV": 1, "ZF2": 1, "ZF3": 1,
    "ZWIF": 1, "ZWMF": 1, "ZFBG": 1, "ZL2": 1, "ZG2": -1, "ZG4": -1,
    "ZRE": -1, "ZL3": 1, "ZG3": -1,
}

# Document type of an order, by document category or "order type|reason".
ORDER_TYPE = {
    "B": 4, "C": 4, "L": 5, "K": 6, "H": 7,
    "ZCRE|Z04": 13, "ZCRE|Z09": 16, "ZCRE": 15,
    "ZDRE|Z04": 12, "ZDRE|Z09": 17, "ZDRE": 14,
}

# Sign of an order, by document category.
ORDER_SIGN = {"C": 1, "L": 1, "B": 1, "K": -1, "H": -1}

# Positions that stand for services, as "order type|item category".
SERVICE_POSITIONS = [
    "YFOC|ZKL", "ZCN|ZG2T", "ZDN|ZL2T", "ZFOC|ZKL", "ZOR|ZTAX", "ZORB|ZOR1",
    "ZSBU|ZTAX", "ZSUR|ZTAX", "ZOR|ZTAP",
]

# Cancelling billing types.
CANCELLING_TYPES = ["ZS1", "ZS2", "ZS3", "ZS4"]

# Order types without value, never valid as orders.
EXCLUDED_ORDER_TYPES = ["ZKL", "ZFOC", "YFOC", "ZWBF", "ZWPC", "ZWPR"]

# Order type that is valid although the type table does not list it.
EXTRA_ORDER_TYPE = "Z23"

# Document categories that make an order type count.
ORDER_CATEGORIES = ["C", "K", "L", "H"]

# Consignment, return and old-perimeter order types.
CONSIGNMENT_TYPES = ["ZKA", "ZKB"]
RETURN_ORDER_TYPES = ["ZREB", "ZREG"]
OLD_PERIMETER_TYPES = ["ZKA", "ZKB", "ZKE", "ZKR"]
B_GRADE_TYPE = "ZBGR"

# Credit states that block an order; billing state that blocks it.
CREDIT_BLOCKS = ["C", "B"]
BILLING_BLOCK = "C"

# Companies left out of every fact.
EXCLUDED_COMPANIES = ["62T0", "6230"]

# Networks left out of the portfolio report.
EXCLUDED_NETWORKS = [1, 2]

# Source systems and the division kept for the ERP.
ERP = "sap"
LEGACY = "cas"
FINISHED_GOODS = "FG"
SERVICE_DIVISION = "SE"

# Price condition codes by measure.
VAT_CODES = ["MWST"]
NSV_CODES = ["ZNSV", "ZIV1", "ZIV2"]
DISCOUNT_CODES = ["ZCDS"]
RAEE_CODES = ["ZWEE"]
GSV_CODES = ["ZTTV", "ZIV1", "ZIV2"]
LIST_CODES = ["ZNET"]
FORCED_CODES = ["PB00"]
FEE_CODES = ["ZFEE"]
BONUS_CODES = ["RENT", "PPNT"]
TOTAL_CODES = ["ZGSV"]
FREIGHT_CODES = ["ZFR2", "ZFR5"]

# Partner roles, by the name of the customer they fill.
PARTNER_ROLES = {
    "ship": "SP", "sold": "BP", "purchase": "ZC", "main": "ZD", "super": "ZE",
    "sale_zone": "YB", "sale_man": "YD", "sale_director": "YA", "rsm": "YC",
}

# Partner key and whether a blank item value also falls back to the header.
PARTNER_TARGETS = {
    "dest_id": ("ship", False),
    "inv_id": ("sold", True),
    "purchase_group_code": ("purchase", True),
    "main_group_code": ("main", True),
    "super_group_code": ("super", True),
    "sale_zone_code": ("sale_zone", False),
    "salesman_code": ("sale_man", True),
    "sale_director_code": ("sale_director", False),
    "rsm_code": ("rsm", False),
}

# Names of partners by the column of their code.
PARTNER_NAMES = {
    "purchase_group_code": "purchase_group_descr", "main_group_code": "main_group_descr",
    "super_group_code": "super_group_descr", "sale_zone_code": "sale_zone_descr",
    "salesman_code": "salesman_name", "sale_director_code": "sale_director", "rsm_code": "rsm",
}

HEADER_ITEM = "000000"

# Account names of the budget, forecast and freight exports.
BUDGET_ACCOUNTS = {
    "2000_ASO_CALC": "gross_sales", "1095_LFG": "qty_sold",
    "2090_LFG": "net_sales", "A_NSV_MEDIO": "nsv",
}
FORECAST_ACCOUNTS = {
    "2090_CALC": "gross_sales", "Dest_1095": "qty_sold",
    "Dest_2000": "net_sales", "NSV": "nsv",
}
FREIGHT_ACCOUNTS = {
    "A_CDC_1": "customs_cost_1", "A_CDC_2": "customs_cost_2",
    "A_TRC_TOT": "transportation_cost", "A_CDC_3": "customs_cost_3",
    "A_HANIC": "handling_ic", "A_NAHNW": "handling_network",
}

MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun",
          "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]

# Product segments: label and the product type codes they hold. The flag adds
# products whose id starts with "1-@-" or "2-@-". No codes means every product.
PRODUCT_SEGMENTS = [
    ("ONLY FG (1)", ["1"], True),
    ("PROGRAMS ACC. (2)", ["2"], False),
    ("ACCESSORIES (3)", ["3"], False),
    ("FG (1) + PROGR.ACC. (2)", ["1", "2"], True),
    ("FG (1) + ACCESSORIES (3)", ["1", "3"], True),
    ("PROGR.ACC. (2) + ACCESSORIES (3)", ["2", "3"], False),
    ("SERVICE WASHPASS", ["W"], False),
    ("ALL", [], False),
]
FINISHED_GOOD_PREFIXES = ["1-@-", "2-@-"]
UNKNOWN_SEGMENTS = ["ONLY FG (1)", "FG (1) + PROGR.ACC. (2)",
                    "FG (1) + ACCESSORIES (3)", "ALL"]
SECTOR_SEGMENTS = ["ONLY FG (1)", "ALL"]

# Budget divisions without products of their own: code and name.
BUDGET_DIVISIONS = {
    "CAC": "Commercial AC", "COO": "Cooking", "DW": "Dishwasher",
    "FRE": "Freezer", "HAC": "Air Conditioning", "IT": "IT",
    "MP": "Mobile Phone", "OTH": "Others", "REF": "Refrigerator", "TV": "TV",
    "WH": "Water Heater", "WM": "Washing Machine",
}

# Return reasons.
GOOD_RETURN_MOTIVES = [60, 70, 80, 90, 100]
BAD_RETURN_MOTIVES = [20, 30, 40, 50]

# Product tree columns of an overview file.
TREE_COLUMNS = ["MKT Tree", "R&D Tree", "EPREL Tree", "Environmental Tree"]

# Names given to three classification characteristics.
CHARACTERISTICS = {
    "ZPROD_COMCODEEXT": "commodity_code_extension",
    "ZPREF_ORIG": "material_preferential_origin",
    "ZPROD_INWCODE": "inward_processing_code",
}

# Release states that end a product.
ENDED_STATES = ["OBSOLETE", "REJECT", "CANCEL"]

# Texts and dates that stand for "none".
NOT_DEFINED = "Not Defined"
NOT_DEFINED_KEY = "NOT DEFINED"
TO_BE_DEFINED = "TO BE DEFINED"
NO_DATE = "1900-01-01"
OLDEST_DATE = "1970-01-01"
FIRST_INTERVAL = "2000-01-01"
SERIAL_DAY_ZERO = "1899-12-30"
DEFAULT_LINE = "999"
DEFAULT_CURRENCY = "EUR"

# Fixed names of the error table's key and file columns.
ERROR_KEY = "pkey_value"
ERROR_FILE = "s3_input_file_name"

# Fixed values of the market hierarchy: the company whose networks go by product line, code
# widths, code prefixes, and the columns that describe a market.
LINE_COMPANY = "80"
LINE_ORGANIZATION = "66J0"
MARKET_CODES = {"sales_organization": None, "sales_office": None, "company": 2, "network": 2}
MARKET_PREFIXES = {
    "market_budget": "M_", "responsible_code1": "R_", "responsible_code": "C_", "responsible_code3": "S_",
}
MARKET_TEXTS = [
    "responsible_code", "responsible_descr", "responsible_code1", "responsible_descr1",
    "responsible_code3", "responsible_descr3", "market_budget", "market_budget_descr",
]

# Names of the responsibles of a market in the report.
MARKET_NAMES = {
    "responsible_code1": "region_code", "responsible_code": "cluster_code", "responsible_code3": "subcluster_code",
    "responsible_descr1": "region", "responsible_descr": "cluster", "responsible_descr3": "subcluster",
}
