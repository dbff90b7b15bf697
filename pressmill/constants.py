"""Fixed values of the data model: labels, phrases, patterns, thresholds.

Everything in this module is a value that results depend on.
"""

# --- Fixed values: article classes -------------------------------------------
RELIABLE_TYPES = ("reliable",)
FAKE_TYPES = (
    "fake", "unreliable", "conspiracy", "rumor",
    "junksci", "clickbait", "hate", "satire",
)
AMBIGUOUS_TYPES = ("unknown", "political", "bias")

# --- Fixed values: statement (claim) labels ----------------------------------
CLAIM_FAKE = ("false", "pants-fire", "barely-true")
CLAIM_RELIABLE = ("true", "mostly-true")
CLAIM_BORDERLINE = ("half-true",)

# Columns of the header-less statement file, in file order.
CLAIM_COLUMNS = (
    "id", "label", "statement", "subject", "speaker", "job_title",
    "state_info", "party_affiliation", "barely_true_counts", "false_counts",
    "half_true_counts", "mostly_true_counts", "pants_on_fire_counts", "context",
)

# --- Fixed values: boilerplate phrases ---------------------------------------
RAW_BOILERPLATE = (
    "click thumbnail", "click picture", "click pictur",
    "photo gallery", "photo galleri", "view gallery", "view galleri",
    "follow us on facebook", "follow us facebook", "follow us twitter",
    "follow us instagram", "reader think story fact",
    "reader think stori fact", "add two cent", "water cooler open thread",
    "subscrib", "share this video", "watch the video",
)
STEMMED_BOILERPLATE = (
    "reader think stori fact", "add two cent", "water cooler open thread",
    "follow us facebook", "follow us twitter", "follow us instagram",
    "click thumbnail", "photo galleri", "view galleri",
)

# --- Fixed values: quality bounds (all comparisons are strict) ---------------
MIN_TOKENS = 30
MAX_TOKENS = 1200
MIN_DISTINCT_RATIO = 0.28
MAX_TOP_WORD_RATIO = 0.20

# --- Fixed values: profile settings ------------------------------------------
TOP_WORDS = 100
RANK_FREQUENCY_WORDS = 10_000
OUTLIER_ROWS = 30
SAMPLE_ROWS = 1_000
PREVIEW_CHARS = 250
HISTOGRAM_BINS = 60
LENGTH_QUANTILES = (0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99, 1.0)
IMBALANCE_RATIO = 1.2
DUPLICATE_RATE = 0.01
NULL_CLASS = "nan"
TEXT_CANDIDATES = ("content", "cleaned_text", "processed_text", "text", "article")
OPTIONAL_COLUMNS = ("title", "domain", "url", "cleaned_text", "processed_text")
METADATA_COLUMNS = ("domain", "title", "authors")

# --- Fixed values: splitting and sampling ------------------------------------
SEED = 42
VOCABULARY_SAMPLE_ROWS = 500_000

# --- Fixed values: model settings --------------------------------------------
NB_ALPHA = 0.1
SVM_ALPHA = 1e-4
SVM_EPOCHS = 3
C_GRID = (0.01, 0.1, 1.0, 10.0)
LOGISTIC_MAX_ITER = 1000

# --- Fixed values: patterns (Java regex) -------------------------------------
# Whitespace as Python's str.split() sees it: Unicode white space, which Java's \s
# covers under the flag (?U), and the four information separators, which it does not.
SPACE = r"[\s\x1c-\x1f]"
NOT_SPACE = r"[^\s\x1c-\x1f]"
SPACES_PATTERN = f"(?U){SPACE}+"
EDGE_SPACES_PATTERN = f"(?U)^{SPACE}+|{SPACE}+$"
NON_LETTERS = "[^a-z]+"
# A class in front, here and below, only skips places where no match can start.
URL_PATTERN = rf"(?=[hwHW])(?iU)(?:https?://{NOT_SPACE}+|www\.{NOT_SPACE}+)"
MARKUP_URL_PATTERN = rf"(?U)http{NOT_SPACE}+|www\.{NOT_SPACE}+"
MARKUP_TAG_PATTERN = r"<[^\n]*?>"

# A word character is a letter, a number or an underscore of any script, which
# is wider than Java's \w; hence explicit look-around.
_NOT_AFTER_WORD = r"(?<![\p{L}\p{N}_])"
_NOT_BEFORE_WORD = r"(?![\p{L}\p{N}_])"
_DIGIT = r"\p{Nd}"
_FROM_DIGIT = rf"(?={_DIGIT}){_NOT_AFTER_WORD}"
# Month names and their short forms.
MONTH_NAMES = (
    "january", "february", "march", "april", "may", "june", "july", "august", "september",
    "october", "november", "december",
    "jan", "feb", "mar", "apr", "jun", "jul", "aug", "sept", "sep", "oct", "nov", "dec",
)
_MONTH = "|".join(MONTH_NAMES)
DATE_PATTERNS = (
    rf"{_FROM_DIGIT}{_DIGIT}{{4}}-{_DIGIT}{{1,2}}-{_DIGIT}{{1,2}}{_NOT_BEFORE_WORD}",
    rf"{_FROM_DIGIT}{_DIGIT}{{1,2}}/{_DIGIT}{{1,2}}/{_DIGIT}{{2,4}}{_NOT_BEFORE_WORD}",
    rf"{_FROM_DIGIT}{_DIGIT}{{1,2}}-{_DIGIT}{{1,2}}-{_DIGIT}{{2,4}}{_NOT_BEFORE_WORD}",
    # Three classes for the letters that a month starts with.
    rf"(?U)(?=[jfmasondJFMASOND\x{{17f}}][aceopuACEOPU][bcglnprtvyBCGLNPRTVY]){_NOT_AFTER_WORD}(?i:{_MONTH}){SPACE}+{_DIGIT}{{1,2}}"
    rf"(?:,{SPACE}*{_DIGIT}{{4}})?{_NOT_BEFORE_WORD}",
)
NUMBER_PATTERN = rf"{_FROM_DIGIT}{_DIGIT}+(?:[.,]{_DIGIT}+)?{_NOT_BEFORE_WORD}"

# Vectoriser token patterns: any script with two or more word characters, or
# plain letters only (after accents are stripped).
WORD_TOKENS = r"[\p{L}\p{N}_]{2,}"
LETTER_TOKENS = rf"{_NOT_AFTER_WORD}[a-zA-Z]{{2,}}{_NOT_BEFORE_WORD}"
PLAIN_TOKENS = r"[a-z]{2,}"

# --- Fixed values: English stop words ----------------------------------------
# The usual English list. Tokens are runs of a-z, so the entries with an
# apostrophe can never match and are left out.
STOP_WORDS = tuple(
    """
    i me my myself we our ours ourselves you your yours yourself yourselves he
    him his himself she her hers herself it its itself they them their theirs
    themselves what which who whom this that these those am is are was were be
    been being have has had having do does did doing a an the and but if or
    because as until while of at by for with about against between into through
    during before after above below to from up down in out on off over under
    again further then once here there when where why how all any both each few
    more most other some such no nor not only own same so than too very s t can
    will just don should now d ll m o re ve y ain aren couldn didn doesn hadn
    hasn haven isn ma mightn mustn needn shan shouldn wasn weren won wouldn
    """.split()
)
