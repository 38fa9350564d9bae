"""SQL fragments that restate the rules for another engine, used to check results on the same rows."""

from __future__ import annotations

from leadlake import constants as C

BOOKING_HOSTS = ", ".join(
    f"'{h}'" for h in sorted({s.split("/")[0] for ss in C.BOOKING_SIGNATURES.values() for s in ss}))


def quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def contains_any(text: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"CONTAINS({text}, {quoted(w)})" for w in words) + ")"


def count_words(text: str, words: list[str]) -> str:
    return "(" + " + ".join(f"CAST(CONTAINS({text}, {quoted(w)}) AS INT)" for w in words) + ")"


def extract(text: str, pattern: str, group: int) -> str:
    return f"NULLIF(REGEXP_EXTRACT({text}, {quoted(pattern)}, {group}), '')"


def normalized(text: str) -> str:
    spelled = f"REPLACE(LOWER(COALESCE({text}, '')), '&', ' and ')"
    return rf"TRIM(REGEXP_REPLACE(REGEXP_REPLACE({spelled}, '[^\p{{L}}\p{{N}}_\s]', ' ', 'g'), '\s+', ' ', 'g'))"


def collapsed(text: str) -> str:
    return rf"TRIM(REGEXP_REPLACE({text}, '\s+', ' ', 'g'))"


def host(url: str) -> str:
    return rf"LOWER(REGEXP_EXTRACT({url}, '^[^:/?#]+://([^/?#]*)', 1))"


def registrable(url: str) -> str:
    return rf"REGEXP_EXTRACT({host(url)}, '([^.]+\.[^.]+)$', 1)"


def canonical(url: str) -> str:
    query = rf"REGEXP_EXTRACT({url}, '^[^?#]*\?([^#]*)', 1)"
    pairs = (rf"LIST_TRANSFORM(LIST_FILTER(STRING_SPLIT({query}, '&'), LAMBDA p: p <> '' AND NOT "
             r"REGEXP_MATCHES(p, '(?i)^(utm_|fbclid|gclid)')), LAMBDA p: CASE WHEN CONTAINS(p, '=') THEN p ELSE p || '=' END)")
    joined = f"ARRAY_TO_STRING({pairs}, '&')"
    path = rf"REGEXP_EXTRACT({url}, '^[^:/?#]+://[^/?#]*([^?#]*)', 1)"
    return (rf"(LOWER(REGEXP_EXTRACT({url}, '^([^:/?#]+)://', 1)) || '://' || {host(url)} || "
            f"CASE WHEN {path} = '' THEN '/' ELSE {path} END || CASE WHEN {joined} = '' THEN '' ELSE '?' || {joined} END)")


def resolved(base: str, href: str) -> str:
    return (rf"CASE WHEN STARTS_WITH({href}, '/') THEN REGEXP_EXTRACT({base}, '^([^:/?#]+://[^/?#]+)', 1) || {href} "
            f"ELSE {href} END")


def anchors(pages: str, columns: str) -> str:
    """Anchor rows of pages whose anchors have one plain attribute and plain text."""
    pattern = "'<a href=\"([^\"]*)\">([^<]*)</a>'"
    return f"""(SELECT {columns}, i AS ord, h[i + 1] AS href, REPLACE(t[i + 1], '&amp;', '&') AS text FROM (
        SELECT {columns}, h, t, UNNEST(RANGE(LEN(h))) AS i FROM (
            SELECT {columns}, REGEXP_EXTRACT_ALL(html, {pattern}, 1) AS h, REGEXP_EXTRACT_ALL(html, {pattern}, 2) AS t
            FROM {pages}) p) q)"""


def signature(text: str) -> str:
    cases = " ".join(f"WHEN {contains_any(text, ss)} THEN '{p}'" for p, ss in C.BOOKING_SIGNATURES.items())
    return f"CASE {cases} END"


def platform(html: str, url: str) -> str:
    cases = " ".join(f"WHEN {contains_any(f'LOWER({html})', ms)} THEN '{p}'" for p, ms in C.PLATFORM_MARKERS.items())
    return (f"CASE WHEN CONTAINS(LOWER({url}), 'linktr.ee') THEN 'linktree' WHEN CONTAINS(LOWER({url}), 'facebook.com') "
            f"THEN 'facebook' {cases} ELSE 'custom' END")


def mobile(html: str) -> str:
    content = f"LOWER(REGEXP_EXTRACT({html}, '<meta name=\"viewport\" content=\"([^\"]*)\"', 1))"
    return f"CAST({contains_any(content, ['width=device-width', 'initial-scale'])} AS INT)"


def page_facts(pages: str) -> str:
    """One row per page with its signals."""
    a = anchors(pages, "page_id, html")
    href, text = "LOWER(href)", "LOWER(text)"
    book = (f"({contains_any(href, C.BOOKING_HREF_WORDS)} OR {contains_any(text, C.BOOKING_TEXT_WORDS)} "
            f"OR {signature(href)} IS NOT NULL)")
    mailto = f"STARTS_WITH({href}, 'mailto:') AND REGEXP_MATCHES(TRIM(SPLIT_PART(SUBSTRING(href, 8), '?', 1)), '^{C.EMAIL}')"
    return rf"""(SELECT p.page_id, {platform('p.html', 'p.final_url')} AS page_platform, {mobile('p.html')} AS page_mobile,
        CASE WHEN {signature('LOWER(p.html)')} IS NOT NULL THEN {signature('LOWER(p.html)')}
             WHEN link.href IS NOT NULL THEN COALESCE({signature('LOWER(link.href)')}, 'other')
             WHEN REGEXP_MATCHES(p.html, '(?i)<button[^>]*>[^<]*(book|schedule)') OR REGEXP_MATCHES(p.html, '(?i)<input[^>]*value="[^"]*(book|schedule)')
             THEN 'other' END AS page_booking_platform,
        s.page_instagram, s.page_facebook, s.contact_href,
        COALESCE(s.mailto, {extract('p.html', C.EMAIL, 0)}) AS page_email
    FROM {pages} p
    LEFT JOIN (SELECT page_id, MIN_BY(href, ord) AS href FROM {a} b WHERE {book} GROUP BY page_id) link ON link.page_id = p.page_id
    LEFT JOIN (SELECT page_id, MIN_BY(href, ord) FILTER (ord = ig) AS page_instagram,
                      MIN_BY(href, ord) FILTER (CONTAINS({href}, 'facebook.co') AND NOT CONTAINS({href}, 'sharer') AND ord IS DISTINCT FROM ig) AS page_facebook,
                      MAX_BY(href, ord) FILTER ({contains_any(href, C.CONTACT_HREF_WORDS)}) AS contact_href,
                      MAX_BY(TRIM(SPLIT_PART(SUBSTRING(href, 8), '?', 1)), ord) FILTER ({mailto}) AS mailto
               FROM (SELECT *, MIN(ord) FILTER (CONTAINS({href}, 'instagram.com')) OVER (PARTITION BY page_id) AS ig FROM {a} b) c
               GROUP BY page_id) s ON s.page_id = p.page_id)"""


def scored(rows: str) -> str:
    leak = "(no_website OR not_mobile OR no_booking)"
    w = C.WEIGHTS
    return f"""(SELECT *, {w['no_website']} * CAST(no_website AS INT) + {w['no_booking']} * CAST(no_booking AS INT)
            + {w['not_mobile']} * CAST(not_mobile AS INT) + {w['no_ssl']} * CAST(no_ssl AS INT)
            + {w['dormant_social']} * CAST(dormant AS INT) + {w['no_social']} * CAST(no_social AS INT)
            + {C.REVIEWS_BONUS} * CAST(busy AND {leak} AS INT) AS deficiency_score,
        CASE WHEN busy AND {leak} THEN 'reviews_vs_web' WHEN no_website THEN 'no_website' WHEN no_booking THEN 'no_booking'
             WHEN not_mobile THEN 'not_mobile' WHEN no_ssl THEN 'no_ssl' WHEN dormant THEN 'dormant_social'
             WHEN no_social THEN 'no_social' END AS primary_deficiency
    FROM (SELECT *, COALESCE(site_platform IN ('none', 'linktree', 'facebook'), false) OR (COALESCE(site_platform, '') = '' AND (
                 COALESCE(website_url, '') = '' OR CONTAINS(LOWER(website_url), 'linktr.ee') OR CONTAINS(LOWER(website_url), 'facebook.com'))) AS no_website,
             COALESCE(has_online_booking = 0, false) AS no_booking, COALESCE(is_mobile_friendly = 0, false) AS not_mobile,
             COALESCE(has_ssl = 0, false) AS no_ssl, COALESCE(social_status = 'dormant', false) AS dormant,
             COALESCE(social_status = 'none', false) AS no_social, COALESCE(review_count, 0) >= {C.REVIEWS_THRESHOLD} AS busy
          FROM {rows} r) f)"""


def short_name(name: str) -> str:
    text = f"LOWER({name})"
    for suffix in C.NAME_SUFFIXES:
        text = f"TRIM(REGEXP_REPLACE({text}, '{suffix}$', ''))"
    return f"COALESCE(NULLIF({text}, ''), LOWER({name}))"


def hook(short: str) -> str:
    def fill(template: str) -> str:
        text = quoted(template).replace("{n}", f"' || {short} || '").replace("{r}", "' || CAST(COALESCE(review_count, 0) AS STRING) || '")
        return text.replace("{p}", "' || CASE WHEN COALESCE(site_platform, '') IN ('', 'unknown') THEN 'on the site' "
                                   "ELSE 'on ' || site_platform END || '")

    cases = " ".join(f"WHEN hook_key = '{k}' THEN {fill(t)}" for k, t in C.HOOK_TEMPLATES.items() if k != "default")
    return f"CASE {cases} ELSE {fill(C.HOOK_TEMPLATES['default'])} END"


HOOK_KEY = ("CASE WHEN primary_deficiency = 'no_website' AND site_platform IN ('facebook', 'linktree') "
            "THEN 'no_website/' || site_platform ELSE primary_deficiency END")


def hooked(rows: str) -> str:
    return f"(SELECT *, {hook('short')} AS line FROM (SELECT *, {HOOK_KEY} AS hook_key, {short_name('name')} AS short FROM {rows} h1) h2)"


def lookup_domain(url: str) -> str:
    return f"COALESCE(NULLIF(REGEXP_EXTRACT({url}, '^[^:/?#]+://([^/?#]*)', 1), ''), SPLIT_PART({url}, '/', 1), '')"


def price_fields(rows: str, text: str, parity: bool = False) -> str:
    """The price grammar over rows with one text column."""
    money = "(?i)" + C.MONEY_TOKEN + (C.MONEY_PARITY if parity else C.MONEY_WHOLE)

    def amount(value: str) -> str:
        return f"TRY_CAST(REPLACE({value}, ',', '') AS DECIMAL(18, 6))"

    def token(value: str) -> str:
        return f"CASE WHEN UPPER(REGEXP_EXTRACT({value}, {quoted(money)}, 1)) IN ('$', 'USD', 'US$') THEN 'USD' END"

    dated = f"(REGEXP_EXTRACT_ALL(clean, {quoted(C.UNTIL_DATE)}, 1))[-1]"
    parsed = " , ".join(f"TRY_STRPTIME({dated}, '{f}')" for f in ("%B %d, %Y", "%B %d %Y", "%Y-%m-%d"))
    return rf"""(SELECT *,
        CASE WHEN {contains_any('lower_text', ['offer', 'special', 'expires', 'valid through'])} THEN 'offer'
             WHEN CONTAINS(lower_text, 'membership') THEN 'membership' WHEN CONTAINS(lower_text, 'package') THEN 'package'
             ELSE 'service' END AS offering_type,
        CASE WHEN first_amount IS NULL THEN 'none' WHEN is_range THEN 'range'
             WHEN REGEXP_MATCHES(lower_text, {quoted(C.FROM_PRICE)}) THEN 'from' ELSE 'fixed' END AS price_type,
        CASE WHEN now_text IS NOT NULL THEN {amount(extract('now_text', money, 2))} ELSE listed END AS amount_min,
        CASE WHEN first_amount IS NOT NULL AND is_range THEN {amount(extract('clean', C.PRICE_RANGE, 2))} END AS amount_max,
        CASE WHEN now_text IS NOT NULL THEN {token('now_text')} ELSE {token('clean')} END AS currency,
        CASE WHEN REGEXP_MATCHES(lower_text, '/(?:mo|month)\b|per month') THEN 'month' WHEN REGEXP_MATCHES(lower_text, 'per session|/session') THEN 'session'
             WHEN REGEXP_MATCHES(lower_text, 'per unit|/unit') THEN 'unit' WHEN CONTAINS(lower_text, 'package') THEN 'package'
             WHEN listed <> 0 THEN 'total' END AS price_unit,
        TRY_CAST({extract('lower_text', C.QUANTITY, 1)} AS INT) AS package_quantity,
        {amount(extract('was_text', money, 2))} AS original_amount,
        CAST(COALESCE({parsed}) AS DATE) AS valid_through,
        CASE WHEN now_text IS NOT NULL THEN {extract('clean', C.NOW_PRICE, 0)} ELSE {extract('clean', C.PRICE_TEXT, 0)} END AS price_display,
        SUBSTRING(clean, 1, {C.MAX_ROW_CHARS}) AS evidence_text
    FROM (SELECT *, CASE WHEN first_amount IS NOT NULL AND is_range THEN {amount(extract('clean', C.PRICE_RANGE, 1))} ELSE first_amount END AS listed
          FROM (SELECT *, LOWER(clean) AS lower_text, {amount(extract('clean', money, 2))} AS first_amount,
                       REGEXP_MATCHES(clean, {quoted(C.PRICE_RANGE)}) AS is_range, {extract('clean', C.WAS_NOW, 1)} AS was_text,
                       {extract('clean', C.WAS_NOW, 2)} AS now_text,
                       NULLIF(TRIM(REGEXP_EXTRACT(clean, {quoted(C.OFFERING_NAME)}, 1), ' -'), '') AS display_name
                FROM (SELECT *, {collapsed(text)} AS clean FROM {rows} g0) g1) g2
          WHERE display_name IS NOT NULL AND CONTAINS(clean, '$')) g3)"""


def minor(amount: str) -> str:
    """Hundredths as a whole number; the inputs have at most two decimals."""
    return f"CAST({amount} * 100 AS BIGINT)"
