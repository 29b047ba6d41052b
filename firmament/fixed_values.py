"""Word lists, patterns, formats and constants that decide results.

They are plain data.  Functions that use them take them as default arguments,
so a job may pass its own lists.
"""

# --- Statuses ---------------------------------------------------------------

AGGREGATOR_ACTIVE = "Работает"
AGGREGATOR_CLOSED = "Компания больше не работает"
AGGREGATOR_MAYBE = "Компания, возможно, не работает"
AGGREGATOR_STATUSES = [AGGREGATOR_ACTIVE, AGGREGATOR_CLOSED, AGGREGATOR_MAYBE]

OFFICIAL_STATUSES = [
    "ACTIVE",
    "LIQUIDATED",
    "LIQUIDATING",
    "BANKRUPT",
    "REORGANIZING",
    "UNKNOWN",
]

# Status codes the JSON registry provider is known to send.
PROVIDER_STATUSES = ["ACTIVE", "LIQUIDATING", "LIQUIDATED", "BANKRUPT", "REORGANIZING"]

STATUS_LABELS = {
    "ACTIVE": "✓ Действующее",
    "LIQUIDATED": "✗ Ликвидировано",
    "LIQUIDATING": "⚠ Ликвидация",
    "REORGANIZING": "⚠ Реорганизация",
    "BANKRUPT": "✗ Банкрот",
    "UNKNOWN": "? Не определён",
    "NO_INN": "— Нет ИНН",
    "PENDING": "⏳ Ожидает проверки",
}

HEAD_LIQUIDATOR = "ЛИКВИДАТОР"
HEADS_BANKRUPT = ["КОНКУРСНЫЙ УПРАВЛЯЮЩИЙ", "АРБИТРАЖНЫЙ УПРАВЛЯЮЩИЙ"]

# --- Identifiers ------------------------------------------------------------

INN_LENGTHS = [10, 12]
OGRN_LENGTHS = [13, 15]
KPP_LENGTH = 9
MIN_PHONE_DIGITS = 7

# --- White space that is stripped from texts ----------------------------------

WHITE_SPACE = (
    "\t\n\u000b\u000c\r\u001c\u001d\u001e\u001f \u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# --- Names ------------------------------------------------------------------

NAME_DASHES = "-–—"
NAME_DROPPED = "«»„\"“”'().,!?;:"

# --- Dates a report cell may carry ------------------------------------------

DATE_FORMATS = [
    "yyyy-M-d",
    "d.M.yyyy",
    "yyyy-M-d'T'H:m:s",
    "yyyy-M-d H:m:s",
]

# --- Contact extraction -----------------------------------------------------

PHONE_ANNOTATION_PATTERN = r"\s*\([^)]*[а-яёА-ЯЁa-zA-Z][^)]*\)\s*$"

EMAIL_PATTERN = r"[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}"

PHONE_PREFIXES = [r"\+\s*7", "8"]
PHONE_BODY_PATTERN = (
    r"\s*[\-–—.(]*\d{3}[\s\-–—.)]*\d{3}[\s\-–—]*\d{2}[\s\-–—]*\d{2}"
)

CONTACT_LINK_PATTERN = (
    r"контакт|связ[аь]|обратн|реквизит|contact|about"
    r"|о\s*компании|о\s*нас|наши\s*контакт"
)

FALLBACK_PATHS = [
    "/contacts",
    "/kontakty",
    "/contact",
    "/about",
    "/about-us",
    "/o-kompanii",
    "/o-nas",
]

SKIPPED_HREF_PREFIXES = ["mailto:", "tel:", "javascript:", "#"]

JUNK_LOCAL_PARTS = [
    "noreply",
    "no-reply",
    "no.reply",
    "mailer-daemon",
    "postmaster",
    "hostmaster",
    "root",
    "nobody",
    "test",
    "example",
    "email",
    "your",
    "name",
    "user",
]

JUNK_DOMAINS = [
    "example.com",
    "example.org",
    "test.com",
    "domain.com",
    "email.com",
    "site.com",
    "yoursite.com",
    "company.com",
    "sentry.io",
    "wixpress.com",
    "w3.org",
    "schema.org",
    "googleapis.com",
    "gravatar.com",
    "cloudflare.com",
    "google.com",
    "facebook.com",
    "twitter.com",
    "instagram.com",
    "vk.com",
    "ok.ru",
    "youtube.com",
    "t.me",
    "telegram.org",
    "timeweb.ru",
    "timeweb.com",
    "reg.ru",
    "nic.ru",
    "beget.com",
    "beget.tech",
    "jino.ru",
    "spaceweb.ru",
    "mchost.ru",
    "hostinger.com",
    "godaddy.com",
    "namecheap.com",
    "wix.com",
    "tilda.cc",
    "tildacdn.com",
    "taplink.cc",
    "taplink.at",
    "ucoz.ru",
    "ucoz.com",
    "narod.ru",
    "orgs.biz",
    "vsite.biz",
    "wordpress.com",
    "blogspot.com",
    "livejournal.com",
]

PARKING_DOMAINS = [
    "timeweb.ru",
    "timeweb.com",
    "reg.ru",
    "nic.ru",
    "beget.com",
    "beget.tech",
    "jino.ru",
    "spaceweb.ru",
    "mchost.ru",
    "hostinger.com",
    "parking.reg.ru",
    "rf.ru",
]

FILE_EXTENSIONS = [
    ".png",
    ".jpg",
    ".jpeg",
    ".gif",
    ".svg",
    ".webp",
    ".ico",
    ".css",
    ".js",
    ".map",
    ".woff",
    ".woff2",
    ".ttf",
    ".eot",
    ".pdf",
    ".doc",
    ".docx",
    ".xls",
    ".xlsx",
    ".zip",
    ".rar",
    ".mp3",
    ".mp4",
    ".avi",
    ".mov",
]

TEXT_CONTENT_TYPES = ["text/html", "text/plain"]

# Named character references decoded in page text ("amp" must come last).
NAMED_ENTITIES = {
    "nbsp": " ",
    "commat": "@",
    "plus": "+",
    "lpar": "(",
    "rpar": ")",
    "period": ".",
    "ndash": "–",
    "mdash": "—",
    "laquo": "«",
    "raquo": "»",
    "quot": '"',
    "apos": "'",
    "lt": "<",
    "gt": ">",
    "amp": "&",
}

# --- Requisites in free text ------------------------------------------------

TEXT_INN_PATTERN = r"\bинн\s*(?:/\s*кпп)?\s*[:\s,\.-]*(\d{10,12})\b"
TEXT_OGRN_PATTERN = r"\bогрн(?:ип)?\b\s*[:\s,\.-]*(\d{13,15})\b"
TEXT_KPP_PATTERN = r"\bкпп\b\s*[:\s,\.-]*(\d{9})\b"
TEXT_INN_KPP_PATTERN = r"\b\d{10}/(\d{9})\b"
TEXT_LEGAL_NAME_PATTERN = (
    r"\b(?:ООО|ИП|АО|ЗАО|ОАО|АНО|ЧОП|ЧОО)\s+([А-Яа-яЁё\w\s«\"'„“”\-\.]{3,80})"
)

# --- Crawl and enrichment settings ------------------------------------------

MAX_ATTEMPTS = 5
PAGE_TTL_DAYS = 14
RESPONSE_TTL_DAYS = 30
RECHECK_DAYS = 30
CACHED_AFTER_SECONDS = 60
