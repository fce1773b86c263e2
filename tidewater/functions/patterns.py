"""Fixed values used by the document and page jobs.

Everything here is a constant of the jobs' definition: change a value and
the jobs' results change with it.  Patterns keep to the regex subset that
Java (Spark) and RE2 (the DuckDB oracle) read the same way: no look-around,
no back-references.
"""

# --- tokenisation -----------------------------------------------------------
# A token is a maximal run of letters or digits, lower-cased.
TOKEN_SPLIT = r"[^\p{L}\p{N}]+"
# For the quality classifier, runs of other signs are tokens too: junk shows there.
WORD_OR_SIGNS = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]+"

# --- personal data and secrets (replaced in this order) ---------------------
SECRET = r'(token|api_key|apikey|password|secret)\s*[=:]\s*"[^"]*"'
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
CARD = r"\b[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}\b"
PHONE = r"\+[0-9]{1,3} \([0-9]{3}\) [0-9]{3}-[0-9]{4}"
IPV4 = r"\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b"

REDACTIONS = [
    ("secret", SECRET, "<SECRET>"),
    ("email", EMAIL, "<EMAIL>"),
    ("card", CARD, "<CARD>"),
    ("phone", PHONE, "<PHONE>"),
    ("ip", IPV4, "<IP>"),
]

# --- licence lines ----------------------------------------------------------
LICENSE_LINE = r"(?i)(licensed under|license|licence|copyright|all rights reserved)"

# --- quality rules ----------------------------------------------------------
MIN_WORDS = 50
MAX_WORDS = 100_000
MIN_MEAN_WORD_LEN = 3.0
MAX_MEAN_WORD_LEN = 10.0
MAX_SYMBOL_RATIO = 0.1  # '#', '%', '*', '&' characters per word
SYMBOLS = r"[#%*&]"
MAX_DUP_LINE_FRACTION = 0.3
MIN_STOP_WORDS = 2
# A handful of the most common function words per language.
STOP_WORDS = {
    "en": ["the", "and", "of", "to", "a", "in", "is", "that", "it", "with", "for", "as", "was", "on", "be"],
    "fr": ["le", "la", "les", "de", "des", "et", "un", "une", "du", "en", "que", "qui", "dans", "est", "pour"],
    "de": ["der", "die", "das", "und", "in", "zu", "den", "von", "mit", "ist", "nicht", "sich", "auf", "für", "ein"],
    "es": ["el", "la", "de", "que", "y", "en", "los", "se", "del", "las", "un", "por", "con", "una", "es"],
}

# --- sampling ---------------------------------------------------------------
# Share of each language kept by the language-mix sample.
LANGUAGE_RATES = {"en": 0.25, "fr": 0.5, "de": 0.5, "es": 1.0}
SAMPLE_SEED = 42

# --- near-duplicates and decontamination ------------------------------------
SHINGLE_WORDS = 5
MINHASH_BANDS = 34
MINHASH_ROWS = 4
NEAR_DUP_JACCARD = 0.7
SKETCH_SHARE = 0.5  # five standard deviations of 136 values below the threshold
DECONTAMINATION_NGRAM = 13
MERSENNE_31 = 2147483647

# --- pages ------------------------------------------------------------------
TITLE = r"(?is)<title[^>]*>(.*?)</title>"
LINK = r"""(?i)<a\s+([^>]*\s)?href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
# Comments and raw-text elements in one pattern, so that the one that begins
# first decides: a script in a comment is no script, a comment in a script no
# comment.  Raw-text elements end at their own closing tag, or with the page.
RAW_TAGS = ["script", "style"]
UNREAD = "(?is)" + "|".join([r"<!--.*?-->", *(rf"<{tag}\b[^>]*>.*?(</{tag}\s*>|\z)" for tag in RAW_TAGS)])
# Elements dropped with all they hold, however deep they nest.
BLOCK_TAGS = ["nav", "aside", "footer", "header"]
AD_BLOCK = r"(?is)<div class=\"ad\"[^>]*>.*?</div>"
TAG = r"<[^>]+>"
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")]
URL_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)"
URL_PARTS = r"^([A-Za-z][A-Za-z0-9+.-]*://)?([^/?#]*)([^?#]*)(\?([^#]*))?"  # scheme, host, path, ?query, query
# Of a query with "&" put before each parameter.
TRACKING_PARAM = r"&(utm_[a-z]+|ref|fbclid|gclid)=[^&]*"
