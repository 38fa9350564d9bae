"""They must equal the published rules for results to agree. Nothing here is derived."""

# --- fixed values: booking software, in priority order ---
BOOKING_SIGNATURES = {
    "vagaro": ["vagaro.com"],
    "mindbody": ["mindbodyonline.com", "mindbody.io"],
    "boulevard": ["joinblvd.com", "blvd.com", "boulevard.com"],
    "square": ["square.site", "squareup.com/appointments"],
    "acuity": ["acuityscheduling.com"],
    "calendly": ["calendly.com"],
    "glossgenius": ["glossgenius.com"],
    "zenoti": ["zenoti.com"],
    "booksy": ["booksy.com"],
    "fresha": ["fresha.com"],
    "jane": ["janeapp.com"],
    "mangomint": ["mangomint.com"],
    "aesthetic_record": ["aestheticrecord.com"],
    "pabau": ["pabau.com"],
    "setmore": ["setmore.com"],
}

# --- fixed values: words that call a visitor to book ---
BOOKING_HREF_WORDS = ["book", "schedul", "appointment"]
BOOKING_TEXT_WORDS = ["book", "schedule"]

# --- fixed values: site builders, in priority order ---
PLATFORM_MARKERS = {
    "wix": ["wix.com", "wixpress", "wix-code", "_wix"],
    "squarespace": ["squarespace.com", "squarespace-headers"],
    "wordpress": ["wp-content", "wp-includes", "wp-json"],
    "shopify": ["shopify.com"],
}

# --- fixed values: words that make a link worth a crawl ---
PRICE_LINK_WORDS = [
    "price", "pricing", "service", "treatment", "menu", "membership", "package",
    "special", "offer", "promo", "book", "appointment",
]
CONTACT_HREF_WORDS = ["contact", "reach-us", "get-in-touch"]

# --- fixed values: limits ---
MAX_PAGES = 12
HOMEPAGE_SCORE = 10_000
MAX_BODY_BYTES = 5 * 1024 * 1024
FRESH_DAYS = 7
SPARSE_TEXT_CHARS = 200
MAX_ROW_CHARS = 500

# --- fixed values: scoring ---
WEIGHTS = {
    "no_website": 3,
    "no_booking": 2,
    "not_mobile": 2,
    "no_ssl": 1,
    "dormant_social": 1,
    "no_social": 1,
}
REVIEWS_BONUS = 2
REVIEWS_THRESHOLD = 100
GOOD_LEAD_THRESHOLD = 4

# --- fixed values: search phrases, in query order ---
SEARCH_PHRASES = ["med spa", "day spa", "medical spa"]

# --- fixed values: name endings dropped from an opening line, in order ---
NAME_SUFFIXES = [" inc", " corp", " llc", " med spa", " medical spa", " spa"]

# --- fixed values: opening lines; {n} name, {r} review count, {p} platform phrase ---
HOOK_TEMPLATES = {
    "reviews_vs_web": "noticed {n} has {r}+ five-star reviews but no online booking on the site — you're probably losing after-hours bookings to whoever picks up the phone first.",
    "no_website/facebook": "noticed {n} has a strong social presence but relies on Facebook for details — a dedicated website would help you rank much higher in local Google searches.",
    "no_website/linktree": "noticed {n} uses Linktree as your main hub — a dedicated website would give you more space to showcase services and rank on Google.",
    "no_website": "noticed {n} doesn't have an active website online yet — we could help set up a simple landing page to get you discovered by local clients.",
    "no_booking": "looked at the website for {n} and noticed there's no online booking widget {p} — letting clients book 24/7 online usually saves tons of front-desk time.",
    "not_mobile": "checked out the site for {n} on my phone and noticed it isn't fully mobile-optimized — fixing the mobile layout would make booking much smoother for clients.",
    "no_ssl": "noticed that the site for {n} shows a 'Not Secure' warning because it's missing SSL — adding a security certificate would build instant trust with clients.",
    "dormant_social": "noticed the social links on the {n} site haven't been updated recently — sharing recent before/afters or promos is a great way to keep clients engaged.",
    "no_social": "looked for social links on the {n} site and didn't spot any — setting up a basic Instagram or Facebook page is a great way to showcase your results to new clients.",
    "default": "noticed {n} has some great reviews online, but your web presence could be optimized to capture more local clients.",
}

# --- fixed values: export columns, in order ---
EXPORT_COLUMNS = [
    "name", "metro", "deficiency_score", "primary_deficiency",
    "phone", "email", "email_status", "website_url",
    "booking_platform", "social_status", "hook_text", "google_maps_url",
]

# --- fixed values: columns whose change is a price change ---
MATERIAL_COLUMNS = [
    "offering_type", "display_name", "qualifier", "service_catalog_id", "price_type",
    "amount_min_minor", "amount_max_minor", "currency", "price_unit", "package_quantity",
    "original_amount_minor", "valid_from", "valid_through", "price_display",
]

# --- fixed values: patterns ---
EMAIL = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
SITEMAP_LOC = r"(?is)<loc>\s*(.*?)\s*</loc>"
CITY_STATE = r"^[^,]+,\s*[A-Z]{2}$"
MONEY_TOKEN = r"(\$|USD|US\$|CAD|C\$|€|£)\s?"
MONEY_PARITY = r"(\d{1,3}(?:,\d{3})*(?:\.\d{1,2})?)"
MONEY_WHOLE = r"((?:\d{1,3}(?:,\d{3})+|\d+)(?:\.\d{1,2})?)"
DOLLARS = r"\$\s*[\d,]+(?:\.\d{1,2})?"
OFFERING_NAME = r"(?i)^([A-Za-z][A-Za-z0-9&/'\- ]{1,100}?)(?:\s*(?:[-–—|:]|\$|from\b|starting\b))"
PRICE_RANGE = r"\$\s*([\d,]+(?:\.\d{1,2})?)\s*(?:-|–|to)\s*\$\s*([\d,]+(?:\.\d{1,2})?)"
FROM_PRICE = r"\b(from|starting at)\b"
QUANTITY = r"\b(\d+)\s*(?:sessions|treatments)\b"
WAS_NOW = r"(?i)\bwas\s+(\$\s*[\d,]+(?:\.\d{1,2})?).{0,40}?\bnow\s+(\$\s*[\d,]+(?:\.\d{1,2})?)"
NOW_PRICE = r"(?i)now\s+\$\s*[\d,]+(?:\.\d{1,2})?"
PRICE_TEXT = r"(?i)(?:from\s+|starting at\s+|now\s+)?\$\s*[\d,]+(?:\.\d{1,2})?(?:\s*(?:-|–|to)\s*\$\s*[\d,]+(?:\.\d{1,2})?)?"
UNTIL_DATE = r"(?i)\b(?:through|until|valid)\s+([A-Z][a-z]+\s+\d{1,2},?\s+\d{4}|\d{4}-\d{2}-\d{2})"

# --- fixed values: HTML vocabulary ---
VOID_TAGS = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "keygen", "link", "menuitem", "meta", "param",
    "source", "track", "wbr", "basefont", "bgsound", "command", "frame", "image", "isindex", "nextid", "spacer",
}
HIDDEN_TAGS = {"script", "style", "noscript", "nav", "footer"}
OPAQUE_TAGS = {"script", "style", "template", "rt", "rp"}
ROW_TAGS = {"li", "tr", "article", "section", "div", "p"}
OFFER_TYPE = "Offer"

# --- fixed values: public suffixes assumed when the caller passes no list of their own ---
DEFAULT_SUFFIXES = [
    "com", "net", "org", "io", "co", "us", "site", "app", "biz", "info", "edu", "gov", "me", "ee", "ca",
    "uk", "co.uk", "org.uk", "de", "fr", "es", "eu", "au", "com.au", "net.au", "nz", "co.nz", "test",
]
