"""Fixed values that results depend on: enumerations, limits, catalogues, formats."""

# The fourteen primary categories.
CATEGORIES = (
    "Politics & Diplomacy", "Defence & Security", "Conflict & Humanitarian", "Economy & Business",
    "Energy", "Technology & AI", "Health & Medicine", "Science & Space", "Climate & Environment",
    "Disasters & Weather", "Law & Governance", "Society & Culture", "Sports", "General",
)

# Article labels.
LABELS = ("Breaking", "Trending", "Developing", "Live", "Analysis", "Exclusive", "Fact Check")

# How an article entered the system.
SOURCE_TYPES = ("RSS", "GDELT", "News API", "Web Feed", "Manual")
FEED_SOURCE_TYPE = "RSS"
API_SOURCE_TYPE = "GDELT"

# Sentiments.
SENTIMENTS = ("Positive", "Negative", "Neutral", "Mixed", "Unknown")

DEFAULT_CATEGORY = "General"
DEFAULT_SENTIMENT = "Unknown"
DEFAULT_LANGUAGE = "en"
UNKNOWN_LANGUAGE = "und"
DEFAULT_CARD_TEMPLATE = "standard"

# Limits.
MAX_RESULT_LIMIT = 200
MAX_API_RECORDS = 250
MAX_FEED_RECORDS = 200
DEFAULT_MAX_RECORDS = 25
MIN_API_MINUTES = 15
MAX_RETRY_COUNT = 5
TOP_TEN = 10
MAX_FAVORITE_COUNTRIES = 2
MAX_URL_LENGTH = 2083
MAX_STORED_URL_LENGTH = 2048
TITLE_LENGTH = 500
DESCRIPTION_LENGTH = 2000
AUTHOR_LENGTH = 200
SOURCE_NAME_LENGTH = 200

# Message envelope.
MESSAGE_SCHEMA_VERSION = "1.0"
ARTICLE_MESSAGE_TYPE = "article_processing"
TRIGGER_MESSAGE_TYPE = "ingestion_trigger"
RAW_RECORD_TYPE = "raw_news_payload"
REJECTED_RECORD_TYPE = "rejected_news_payload"

# Lake layers and their prefixes.
LAYER_PREFIXES = {
    "raw": "raw/news",
    "processed": "processed/news",
    "rejected": "rejected/news",
    "curated": "curated/news",
    "social-cards": "social-cards",
}
ARTICLE_LAYERS = ("processed", "curated")
RESERVED_PARTITIONS = ("provider", "category", "year", "month", "day", "hour")

# Patterns.
REQUEST_TIMESPAN_PATTERN = r"^[1-9]\d*(min|h|hours|d|days|w|weeks|m|months)$"
SOURCE_ID_PATTERN = r"^[a-z0-9]+(?:-[a-z0-9]+)*$"
FEED_LANGUAGE_PATTERN = r"^[a-z]{2,3}(-[A-Z]{2})?$"
HASH_PATTERN = r"^[0-9A-Fa-f]{64}$"
UUID_PATTERN = r"^[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}$"

# The region catalogue (code suffix, name), states then union territories, in
# display order. The region code is "IN-" plus the suffix, which is also the short code.
REGION_STATES = (
    ("AP", "Andhra Pradesh"), ("AR", "Arunachal Pradesh"), ("AS", "Assam"), ("BR", "Bihar"),
    ("CT", "Chhattisgarh"), ("GA", "Goa"), ("GJ", "Gujarat"), ("HR", "Haryana"),
    ("HP", "Himachal Pradesh"), ("JH", "Jharkhand"), ("KA", "Karnataka"), ("KL", "Kerala"),
    ("MP", "Madhya Pradesh"), ("MH", "Maharashtra"), ("MN", "Manipur"), ("ML", "Meghalaya"),
    ("MZ", "Mizoram"), ("NL", "Nagaland"), ("OR", "Odisha"), ("PB", "Punjab"), ("RJ", "Rajasthan"),
    ("SK", "Sikkim"), ("TN", "Tamil Nadu"), ("TG", "Telangana"), ("TR", "Tripura"),
    ("UP", "Uttar Pradesh"), ("UT", "Uttarakhand"), ("WB", "West Bengal"),
)
REGION_TERRITORIES = (
    ("AN", "Andaman and Nicobar Islands"), ("CH", "Chandigarh"),
    ("DH", "Dadra and Nagar Haveli and Daman and Diu"), ("DL", "Delhi"),
    ("JK", "Jammu and Kashmir"), ("LA", "Ladakh"), ("LD", "Lakshadweep"), ("PY", "Puducherry"),
)
REGION_TYPES = ("state", "union_territory")

# The registered feeds.
FEED_REGISTRY = (
    {"source_id": "nasa-recently-published", "name": "NASA Recently Published",
     "feed_url": "https://www.nasa.gov/feed/", "homepage_url": "https://www.nasa.gov/",
     "default_category": "Science & Space"},
    {"source_id": "nasa-news-releases", "name": "NASA News Releases",
     "feed_url": "https://www.nasa.gov/news-release/feed/",
     "homepage_url": "https://www.nasa.gov/news-release/", "default_category": "Science & Space"},
    {"source_id": "nasa-technology", "name": "NASA Technology",
     "feed_url": "https://www.nasa.gov/technology/feed/",
     "homepage_url": "https://www.nasa.gov/technology/", "default_category": "Technology & AI"},
    {"source_id": "nasa-jpl-news", "name": "NASA Jet Propulsion Laboratory News",
     "feed_url": "https://www.jpl.nasa.gov/feeds/news/",
     "homepage_url": "https://www.jpl.nasa.gov/news/", "default_category": "Science & Space"},
)
FEED_DEFAULTS = {
    "source_country_code": "US", "language_code": "en", "expected_format": "rss",
    "is_official_source": True, "enabled": True, "max_articles_per_fetch": 50,
}

# Formal ISO 3166 names that differ from the common English name.
FORMAL_COUNTRY_NAMES = {
    "BN": ("Brunei Darussalam",), "BO": ("Bolivia, Plurinational State of", "Bolivia"),
    "CD": ("Congo, The Democratic Republic of the",), "CG": ("Congo",), "CV": ("Cabo Verde",),
    "CZ": ("Czechia", "Czech Republic"), "FK": ("Falkland Islands (Malvinas)",),
    "FM": ("Micronesia, Federated States of",), "GB": ("United Kingdom",
    "United Kingdom of Great Britain and Northern Ireland"), "HK": ("Hong Kong",),
    "IR": ("Iran, Islamic Republic of", "Iran"), "KP": ("Korea, Democratic People's Republic of",
    "North Korea"), "KR": ("Korea, Republic of", "South Korea"),
    "LA": ("Lao People's Democratic Republic", "Laos"), "MD": ("Moldova, Republic of", "Moldova"),
    "MO": ("Macao",), "MM": ("Myanmar",), "PS": ("Palestine, State of",),
    "RU": ("Russian Federation",), "SY": ("Syrian Arab Republic", "Syria"),
    "SZ": ("Eswatini",), "TW": ("Taiwan, Province of China", "Taiwan"),
    "TZ": ("Tanzania, United Republic of", "Tanzania"), "TR": ("Türkiye", "Turkey"),
    "US": ("United States", "United States of America"), "VA": ("Holy See (Vatican City State)",),
    "VE": ("Venezuela, Bolivarian Republic of", "Venezuela"), "VN": ("Viet Nam", "Vietnam"),
}
