"""Fixed values.

Everything in this module is a constant that has to be exactly this for the
results to be right: words of the source data, labels that appear in results,
cut points and the snapshot time. There is no logic here.
"""

from datetime import date, datetime

# --- snapshot and calendar -------------------------------------------------
SNAPSHOT_TIME = datetime(2018, 11, 1, 0, 0, 0)
CALENDAR_FIRST = date(2016, 1, 1)
CALENDAR_LAST = date(2018, 12, 31)
UNKNOWN_KEY = -1

# --- geography -------------------------------------------------------------
EARTH_RADIUS_KM = 6371.0
REGION_STATES = {
    "Norte": ["AC", "AP", "AM", "PA", "RO", "RR", "TO"],
    "Nordeste": ["AL", "BA", "CE", "MA", "PB", "PE", "PI", "RN", "SE"],
    "Centro-Oeste": ["DF", "GO", "MT", "MS"],
    "Sudeste": ["ES", "MG", "RJ", "SP"],
    "Sul": ["PR", "RS", "SC"],
}
REGIONS = ["Norte", "Nordeste", "Centro-Oeste", "Sudeste", "Sul", "Unknown"]

# --- products --------------------------------------------------------------
SIZE_CUTS_CM3 = [5000, 20000]
SIZE_BANDS = ["Small", "Medium", "Large"]
SIZE_BANDS_ACCEPTED = ["Small", "Medium", "Large", "Unknown"]

# --- order status ----------------------------------------------------------
STATUS_LABELS = {
    "created": "Created",
    "approved": "Payment approved",
    "processing": "Being prepared",
    "invoiced": "Invoiced",
    "shipped": "Shipped",
    "delivered": "Delivered",
    "canceled": "Cancelled",
    "unavailable": "Unavailable",
}
STATUS_STEPS = {
    "created": 1,
    "approved": 2,
    "invoiced": 3,
    "processing": 4,
    "shipped": 5,
    "delivered": 6,
    "canceled": 7,
    "unavailable": 8,
}
STATUS_LAST_STEP = 9

# --- payment type ----------------------------------------------------------
PAYMENT_LABELS = {
    "credit_card": "Credit card",
    "boleto": "Boleto (bank slip)",
    "voucher": "Voucher",
    "debit_card": "Debit card",
    "not_defined": "Not defined",
}

# --- reviews ---------------------------------------------------------------
REVIEW_SCORES = [1, 2, 3, 4, 5]
POSITIVE_FROM = 4
NEGATIVE_TO = 2

# --- result buckets: cut points, long labels, short (dashboard) labels -----
DELIVERY_DAY_CUTS = [7, 14, 21]
DELIVERY_DAY_LABELS = ["1. น้อยกว่า 7 วัน", "2. 7-13 วัน", "3. 14-20 วัน", "4. 21 วันขึ้นไป"]
DELIVERY_DAY_SHORT = ["1. <7 วัน", "2. 7-13 วัน", "3. 14-20 วัน", "4. 21+ วัน"]

PRICE_CUTS = [50, 100, 200, 400]
PRICE_LABELS = [
    "1. ต่ำกว่า R$50",
    "2. R$50-99",
    "3. R$100-199",
    "4. R$200-399",
    "5. R$400 ขึ้นไป",
]

WEIGHT_CUTS = [500, 2000, 5000, 10000]
WEIGHT_LABELS = [
    "1. น้อยกว่า 500 กรัม",
    "2. 500 กรัม - 2 กก.",
    "3. 2-5 กก.",
    "4. 5-10 กก.",
    "5. มากกว่า 10 กก.",
]
WEIGHT_SHORT = ["1. <500 กรัม", "2. 500ก.-2กก.", "3. 2-5 กก.", "4. 5-10 กก.", "5. >10 กก."]

FREIGHT_PCT_CUTS = [10, 20, 30]
FREIGHT_PCT_LABELS = ["1. ต่ำกว่า 10%", "2. 10-19%", "3. 20-29%", "4. 30% ขึ้นไป"]
FREIGHT_PCT_SHORT = ["1. <10%", "2. 10-19%", "3. 20-29%", "4. 30%+"]

PHOTO_CUTS = [0, 2, 4, 6]
PHOTO_LABELS = ["0 รูป", "1-2 รูป", "3-4 รูป", "5-6 รูป", "7 รูปขึ้นไป"]
PHOTO_SHORT = ["0 รูป", "1-2 รูป", "3-4 รูป", "5-6 รูป", "7+ รูป"]

INSTALMENT_CUTS = [1, 3, 6, 12]
INSTALMENT_LABELS = ["1", "2-3", "4-6", "7-12", "13+"]

# Not given anywhere: chosen here, and parameters of the two questions.
LATENESS_CUTS = [1, 4, 8]
LATENESS_LABELS = ["1. on time", "2. 1-3 days late", "3. 4-7 days late", "4. 8+ days late"]
DISTANCE_CUTS_KM = [100, 500, 1000, 2000]
DISTANCE_LABELS = [
    "1. under 100 km",
    "2. 100-499 km",
    "3. 500-999 km",
    "4. 1000-1999 km",
    "5. 2000 km and more",
]
SELLER_TOP_PERCENTS = [1, 5, 10, 20]
MIN_LABELLED_SHARE = 0.06
