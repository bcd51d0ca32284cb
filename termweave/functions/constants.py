"""Fixed values.

Everything in this module must stay equal to the values the original pipeline
uses, because outputs (scores, reject reasons, statuses) depend on them.  They are
listed plainly and in their natural order.  Keyword lists are defaults only: every
operator that uses them also accepts a caller-supplied list or table.
"""

# --- fixed values: sentence mining -----------------------------------------

MIN_WORDS = 8
MAX_WORDS = 150

# Clinical keywords per language; +3 per keyword contained in a sentence.
CLINICAL_KEYWORDS = {
    "en": [
        "treatment", "diagnosis", "symptoms", "patient", "case",
        "management", "therapy", "clinical", "study", "results",
        "risk", "complications", "procedure", "presented with",
        "condition", "disorder", "disease", "medication", "pathology",
    ],
    "vi": [
        "điều trị", "chẩn đoán", "triệu chứng", "bệnh nhân", "ca bệnh",
        "phác đồ", "liệu pháp", "lâm sàng", "nghiên cứu", "kết quả",
        "biến chứng", "thủ thuật", "bệnh lý", "rối loạn", "thuốc",
    ],
}

# Text-cleaning patterns (Python regex syntax as in the original; the Spark and SQL forms
# add only dialect flags and the explicit whitespace class).
BRACKET_PATTERN = r"\[.*?\]"        # square-bracket groups, not across a newline
PAREN_PATTERN = r"\([^)]*\)"         # parenthesised groups, across newlines
SENTENCE_END_CHARS = ".!?"            # a sentence ends at one of these before whitespace
DECIMAL_PATTERN = r"\d+\.\d+"         # first decimal number on a report line
BLEU_FALLBACK_PATTERN = r"BLEU\s*=\s*(\d+\.\d+)"

# Phrases removed (case-insensitively, anywhere, as substrings) by clean_text.
BOILERPLATE_PHRASES = [
    "jump to content", "from wikipedia", "navigation", "search", "encyclopedia",
    "free encyclopedia", "edit source", "history", "retrieved",
]

# A sentence containing any of these scores -100.
NOISE_WORDS = ["cookie", "browser", "javascript"]

# A sentence starting with any of these scores -100.
BOILERPLATE_PREFIXES = [
    "jump to", "from wikipedia", "copyright", "all rights", "log in", "sign up",
    "menu", "search", "retrieved", "skip to",
]

SCORE_REJECT = -100
SCORE_CONTAINS_TERM = 10
SCORE_STARTS_WITH_TERM = 5
SCORE_PER_KEYWORD = 3
SCORE_WORDS_IN_RANGE = 5
SCORE_WORDS_OUT_OF_RANGE = -5
SCORE_END_PUNCT = 5
SCORE_NO_END_PUNCT = -10
MIN_SHORT_SENTENCE_CHARS = 20
MIN_PAGE_TEXT_CHARS = 50

# Elements removed with their content before page text is taken.
DROPPED_HTML_ELEMENTS = [
    "script", "style", "nav", "footer", "header", "form", "noscript", "aside",
    "figure", "table", "button",
]

# Search query suffixes per language, in the order they are tried.
SEARCH_QUERY_SUFFIXES = {
    "en": [" medical", " disease", ""],
    "vi": [" medical", " y", " bệnh", ""],
}
LINKS_PER_QUERY = 2

# Resume sentinels and the minimum length of an existing value that is kept.
PENDING = "PENDING"
UNOBSERVED = "UNOBSERVED"
MIN_KEPT_VALUE_CHARS = 10  # kept when strictly longer
ENRICHMENT_COLUMNS = [
    "English example", "Vietnamese example", "English source URL", "Vietnamese source URL",
]

# --- fixed values: prompting -----------------------------------------------

REASON_MISSING_EN_TERM = "Missing English term"
REASON_MISSING_VI_TERM = "Missing Vietnamese term"
REASON_MISSING_EN_SENTENCE = "Missing English Sentence"
REASON_MISSING_VI_SENTENCE = "Missing Vietnamese Sentence"
REASON_TERM_NOT_IN_SENTENCE = "English Sentence does not contain English term '{term}'"
STATUS_SUCCESS = "success"
STATUS_FAILED_VALIDATION = "failed_validation: "
STATUS_FAILED_API = "failed_api: "
API_ERROR_PREFIX = "LLM API error: "
MAX_ATTEMPTS = 3
RETRY_INSTRUCTION = "\n\nEnsure the Vietnamese translation contains the term: {term}."

# Default prompt template (our own wording; pass a different one as a parameter).
DEFAULT_PROMPT_TEMPLATE = (
    "Translate the English sentence of the input to Vietnamese for a medical reader. "
    "The English term must be rendered with the given Vietnamese term, used as in the "
    "example Vietnamese sentences.\n"
    "Input: <index> <English term> <Vietnamese term> <English sentence> <Vietnamese examples>\n"
    "Answer with one line: <index> | <English sentence> | <Vietnamese sentence>"
)

# --- fixed values: corpus preparation --------------------------------------

MAX_SEQUENCE_LENGTH = 512
TRAIN_SEED = 42
PAD_ID = 0
UNK_ID = 1
FIRST_TOKEN_ID = 2
TRANSLATE_BATCH_SIZE = 8
QUESTION_BATCH_SIZE = 5

# --- fixed values: evidence and answers ------------------------------------

EVIDENCE_SEPARATOR = " | "
NO_EVIDENCE = "No relevant evidence found"
NO_ENGLISH_EVIDENCE = "No relevant English evidence found"
ASCII_SHARE_MIN = 0.8  # kept when strictly greater
SNIPPETS_PER_QUERY = 3
FIRST_PROVIDER_SNIPPETS = 5
CHOICE_TYPES = ["multi_choice", "open_ended_multi_choice"]
OPEN_TYPE = "open_ended"
UNSUPPORTED_REASONING = "Unsupported question type"
OPEN_DEFAULT_CHOICE = "A"

# --- fixed values: whitespace ----------------------------------------------

# Characters Python's str.isspace()/str.strip()/re "\s" treat as whitespace.
WHITESPACE_CODEPOINTS = (
    [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x85, 0xA0, 0x1680]
    + list(range(0x2000, 0x200B))
    + [0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)
WHITESPACE_CHARS = "".join(chr(c) for c in WHITESPACE_CODEPOINTS)
