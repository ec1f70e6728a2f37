"""Fixed values of the listing rules.

Everything in this module is a constant of the data contract: results are only
right when these equal the published rules, so they are stated as plain text.
"""

# Texts a CSV reader of the original feeds treats as missing (fixed values).
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# Every character that counts as white space when a text is stripped.
WHITESPACE = (
    "\t\n\u000b\u000c\r\u001c\u001d\u001e\u001f \u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

THAI_DIGITS = "๐๑๒๓๔๕๖๗๘๙"

# Place names searched in titles; the first of the list that occurs wins.
LOCATION_KEYWORDS = [
    "สุขุมวิท", "Sukhumvit", "สีลม", "Silom", "สาทร", "Sathorn",
    "ลาดพร้าว", "Lat Phrao", "พระราม9", "Rama 9", "อ่อนนุช", "On Nut",
    "บางนา", "Bang Na", "รังสิต", "Rangsit", "ธนบุรี", "Thonburi",
    "พญาไท", "Phaya Thai", "อารีย์", "Ari", "ทองหล่อ", "Thong Lo",
    "เอกมัย", "Ekkamai", "ราชเทวี", "Ratchathewi", "ห้วยขวาง", "Huai Khwang",
    "บางกะปิ", "Bang Kapi", "มีนบุรี", "Min Buri", "หนองจอก", "Nong Chok",
    "ตลิ่งชัน", "Taling Chan", "บางแค", "Bang Khae", "จตุจักร", "Chatuchak",
]

# Spelling (stripped, lower case) -> canonical place.
LOCATION_ALIASES = {
    "sukhumvit": "สุขุมวิท", "สุขุมวิทร์": "สุขุมวิท",
    "silom": "สีลม", "sathorn": "สาทร", "lat phrao": "ลาดพร้าว",
    "rama 9": "พระราม9", "on nut": "อ่อนนุช", "bang na": "บางนา",
    "rangsit": "รังสิต", "thonburi": "ธนบุรี", "phaya thai": "พญาไท",
    "ari": "อารีย์", "thong lo": "ทองหล่อ", "ekkamai": "เอกมัย",
    "ratchathewi": "ราชเทวี", "huai khwang": "ห้วยขวาง",
    "bang kapi": "บางกะปิ", "min buri": "มีนบุรี", "nong chok": "หนองจอก",
    "taling chan": "ตลิ่งชัน", "bang khae": "บางแค", "chatuchak": "จตุจักร",
}

# Zone -> canonical places.
ZONES = {
    "CBD": ["สุขุมวิท", "สีลม", "สาทร", "ทองหล่อ", "เอกมัย"],
    "Inner City": ["ลาดพร้าว", "พระราม9", "อ่อนนุช", "พญาไท", "อารีย์",
                   "ราชเทวี", "ห้วยขวาง", "จตุจักร"],
    "Suburban": ["บางนา", "บางกะปิ", "ธนบุรี", "ตลิ่งชัน", "บางแค"],
    "Outer": ["รังสิต", "มีนบุรี", "หนองจอก"],
}
UNKNOWN_ZONE = "Unknown"

# Spelling (stripped, lower case) -> canonical property type.
TYPE_ALIASES = {
    "condo": "คอนโด", "condominium": "คอนโด",
    "house": "บ้านเดี่ยว", "single house": "บ้านเดี่ยว", "detached house": "บ้านเดี่ยว",
    "townhome": "ทาวน์โฮม", "townhouse": "ทาวน์โฮม",
    "land": "ที่ดิน", "land plot": "ที่ดิน",
}
LAND = "ที่ดิน"

# Tokens of a supported property type, with the bedrooms assumed when unknown.
# The order matters: "townhouse" contains "house".
TYPE_TOKENS = [
    (["คอนโด", "condo", "condominium"], 1.0),
    (["บ้าน", "house", "detached"], 3.0),
    (["ทาวน์", "town"], 2.0),
    (["ที่ดิน", "land"], 0.0),
]

BEDROOM_CODES = {"studio": 0.0, "3+1": 4.0}

# Spam and sentinels.
SENTINEL_PRICES = ["ราคาต่อรอง", "สอบถาม"]
AGENT_WORDS = ["รับฝากขาย", "รับฝากเช่า", "นายหน้า"]
URGENT_MARK = "ด่วน!!!"
PHONE_PATTERN = r"(?U)0\d{1,2}[-\s]?\d{3}[-\s]?\d{4}"
MARKUP_PATTERN = r"&amp;|<br>|\\n\\t"
EMOJI = "🏠🔥⭐\u0e00"

# Units and money.
MILLION_WORD, MILLION = "ล้าน", 1_000_000.0
LAKH_WORD, LAKH = "แสน", 100_000.0
BAHT_WORD = "บาท"
USD_SOURCE, USD_RATE, USD_LOOKS_THB = "HipFlat", 35.0, 500_000.0
PRICE_CAP = 500_000_000.0
SPLIT_UNIT, SPLIT_UNIT_THB, WAH_UNIT, SQM_UNIT = "sqm_split", "sqm_split_thb", "sqw", "sqm"
SQM_PER_RAI, SQM_PER_NGAN, SQM_PER_WAH = 1600.0, 400.0, 4.0
RAI_CAP, NGAN_CAP = 10.0, 3.0
AREA_CAP, AREA_PLACEHOLDER = 20_000.0, 999_999.0
SWAP_PRICE_BELOW, SWAP_AREA_ABOVE = 1000.0, 100_000.0
MAX_BEDROOMS = 15.0
TEST_PRICES = [0.0, 1.0]
UNKNOWN_AGE_DAYS = 180

# Two-digit years above this pivot belong to the last century.
CENTURY_PIVOT = 2068

# Rule-based estimate.
TYPE_BASE_PRICE = {"คอนโด": 120000.0, "บ้านเดี่ยว": 80000.0, "ทาวน์โฮม": 70000.0, "ที่ดิน": 50000.0}
DEFAULT_BASE_PRICE = 80000.0
ZONE_FACTOR = {"CBD": 1.5, "Inner City": 1.2, "Suburban": 0.9, "Outer": 0.7}
DEFAULT_ZONE_FACTOR = 1.0
TRANSIT_FACTOR = 1.1
ESTIMATE_DEFAULTS = {
    "area_sqm": 50.0, "bedrooms": 1.0, "bathrooms": 1.0, "floor": 1.0,
    "zone": "CBD", "property_type": "คอนโด", "has_bts": 0,
}
ESTIMATE_LABEL = "Estimated (model not loaded)"

# Shown when no model has been trained yet.
DEFAULT_IMPORTANCES = [
    ("area_sqm", 0.45), ("zone_CBD", 0.20), ("property_type_คอนโด", 0.15),
    ("bedrooms", 0.08), ("has_bts", 0.05), ("bathrooms", 0.04), ("floor", 0.03),
]

# Display texts.
NO_TITLE, MISSING_MARK, SQM_WORD = "ไม่มีหัวข้อ", "-", "ตร.ม."
NOT_FOUND = "N/A"
HTML_SOURCE = "DDProperty"
