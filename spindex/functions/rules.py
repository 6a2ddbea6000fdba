"""Fixed values of the analyzer: character sets, rule patterns, stopwords.

Everything in this module is data that must equal the indexed collection's
original tokenizer for the terms to come out the same. The patterns are
written twice only where the two regex engines need different syntax:
``java`` runs inside Spark (java.util.regex), ``re2`` is the plain form
(no possessive marks, no bounds) used by the DuckDB oracle.

Character classes are spelled out because java.util.regex's ``\\s \\w \\d``
are ASCII-only while the original tokenizer's are Unicode.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# Character classes (bodies, without the brackets)
# ---------------------------------------------------------------------------
BLANK = r"\t-\r\x{1c}-\x{20}\x{85}\p{Z}"     # Unicode whitespace
WORDCH = r"\p{L}\p{N}_"                       # Unicode word character
DIGIT = r"\p{Nd}"                             # Unicode decimal digit

# Characters skipped at a token start, in their original order:
#   blank [ ] + $ | = % * { } / 0 - " # > ( ) ; : ! ? . , TAB U+00A0 U+0085 U+00E2 U+0000
IGNORE_CHARS = ' []+$|=%*{}/0-"#>();:!?.,\t\xa0\x85\xe2\x00'
IGNORE_CLASS = r'[ \[\]+$|=%*{}/0\-"#>();:!?.,\t\x{a0}\x{85}\x{e2}\x{0}]'

# Line breaks: universal newlines, no token crosses a line.
LINE_SPLIT = r"\r\n|\r|\n"

# Marks that ``analyzer.marked`` puts into a line before it is scanned, so that
# the costly rules are tried only where they match (Unicode noncharacters; one
# that stands in a text already becomes U+FDEF, which no rule knows either).
M_CSS = "﷐"      # before each character at which the CSS rule matches
M_BRACE = "﷑"    # the '{' at which such a match turns to its block
M_OPEN = "﷒"     # a '<' that no '>' follows
M_MAIL = "﷓"     # before each character at which the e-mail rule matches
M_DOT = "﷔"      # the '.' before such a match's tail
M_ANY = "﷕"      # a '{' that a block follows, while marks are made
MARKS = M_CSS + M_BRACE + M_OPEN + M_MAIL + M_DOT + M_ANY
NO_MARK = "﷯"

# ---------------------------------------------------------------------------
# Token rules
# ---------------------------------------------------------------------------
_B = BLANK
_W = WORDCH
CSS_RE2 = rf"(?:[^{_B}]*,[{_B}]+)*[^{_B}]+[{_B}]*\{{[^}}]+\}}"
ENTITY = rf"&[{_W}]+"
TAG = r"<[^>]+>"
URL = rf"(?:https?://|www[^\n])[^{_B}</]+"
NUMBER = rf"[1-9][{DIGIT},.\-]*"
EMAIL = rf"[^{_B}]+@[^{_B}]+\.[^<{_B},?!.]+"
MAIL_TAIL = rf"[^<{_B},?!.{M_OPEN}]"
WORD_RE2 = rf"[A-z](?:[{_W}'\-]+|\.[{_W}]|<[^>]+>)*"

# The same rules for java.util.regex over a marked line, without backtracking:
# every part is possessive, and marks may stand before any character.
_M = f"[{M_CSS}{M_MAIL}]*+"
IGNORE_JAVA = rf"(?:{_M}[{IGNORE_CLASS[1:-1]}{M_BRACE}{M_DOT}])++"
CSS_JAVA = rf"{M_CSS}[^{M_BRACE}]*+{M_BRACE}[^}}]++\}}"
ENTITY_JAVA = rf"{_M}&(?:{_M}[{_W}])++"
TAG_JAVA = rf"{_M}<(?!{_M}>)[^>]++>"
URL_JAVA = (_M + _M.join("http") + rf"(?:{_M}s)?" + _M + _M.join("://"), _M + _M.join("www") + rf"{_M}[^\n{M_CSS}{M_MAIL}]")
URL_JAVA = rf"(?:{URL_JAVA[0]}|{URL_JAVA[1]})(?:{_M}[^{_B}</{M_OPEN}{M_CSS}{M_MAIL}])++"
NUMBER_JAVA = rf"{_M}[1-9](?:{_M}[{DIGIT},.\-{M_DOT}])*+"
EMAIL_JAVA = rf"{M_MAIL}[^{M_DOT}]*+{M_DOT}{MAIL_TAIL}++"
WORD_JAVA = rf"[A-z](?:(?:{_M}[{_W}'\-])++|{_M}[.{M_DOT}]{_M}[{_W}]|{_M}<(?!{_M}>)[^>]++>)*+"

# And over a line without marks (the CSS and the e-mail rule match nowhere in it).
IGNORE_PLAIN = IGNORE_CLASS + "++"
TAG_PLAIN = r"<[^>]++>"
URL_PLAIN = rf"(?:https?://|www[^\n])[^{_B}</{M_OPEN}]++"
NUMBER_PLAIN = rf"[1-9][{DIGIT},.\-]*+"
WORD_PLAIN = rf"[A-z](?:[{_W}'\-]++|\.[{_W}]|<[^>]++>)*+"

# Normalizer patterns (removed from the lower-cased / raw lexeme)
URL_STRIP = r"https://|http://|www\."
URL_STRIP_COMPACT = r"https://|http://|www|\."
NUMBER_STRIP = r"[,\-]|\..*"
WORD_STRIP = r"[.\-']|<[^>]+>"
WORD_STRIP_CHARS = ".-'"
EMAIL_STRIP_COMPACT = r"@.*|<[^>]+>"

# The 179-word English stopword list, in its original order.
STOPWORDS = (
    'i', 'me', 'my', 'myself', 'we', 'our', 'ours', 'ourselves', 'you', "you're", "you've", "you'll", "you'd",
    'your', 'yours', 'yourself', 'yourselves', 'he', 'him', 'his', 'himself', 'she', "she's", 'her', 'hers',
    'herself', 'it', "it's", 'its', 'itself', 'they', 'them', 'their', 'theirs', 'themselves', 'what', 'which',
    'who', 'whom', 'this', 'that', "that'll", 'these', 'those', 'am', 'is', 'are', 'was', 'were', 'be', 'been',
    'being', 'have', 'has', 'had', 'having', 'do', 'does', 'did', 'doing', 'a', 'an', 'the', 'and', 'but', 'if',
    'or', 'because', 'as', 'until', 'while', 'of', 'at', 'by', 'for', 'with', 'about', 'against', 'between',
    'into', 'through', 'during', 'before', 'after', 'above', 'below', 'to', 'from', 'up', 'down', 'in', 'out',
    'on', 'off', 'over', 'under', 'again', 'further', 'then', 'once', 'here', 'there', 'when', 'where', 'why',
    'how', 'all', 'any', 'both', 'each', 'few', 'more', 'most', 'other', 'some', 'such', 'no', 'nor', 'not',
    'only', 'own', 'same', 'so', 'than', 'too', 'very', 's', 't', 'can', 'will', 'just', 'don', "don't",
    'should', "should've", 'now', 'd', 'll', 'm', 'o', 're', 've', 'y', 'ain', 'aren', "aren't", 'couldn',
    "couldn't", 'didn', "didn't", 'doesn', "doesn't", 'hadn', "hadn't", 'hasn', "hasn't", 'haven', "haven't",
    'isn', "isn't", 'ma', 'mightn', "mightn't", 'mustn', "mustn't", 'needn', "needn't", 'shan', "shan't",
    'shouldn', "shouldn't", 'wasn', "wasn't", 'weren', "weren't", 'won', "won't", 'wouldn', "wouldn't",
)

# Fixed values of the index layout: fixed-width text export widths.
WIDTH_TERM = 5
WIDTH_NUM_DOCS = 4
WIDTH_START = 8
WIDTH_DOC_ID = 4
WIDTH_WEIGHT = 8
WIDTH_FILE_NAME = 6

# Fixed value: results per query.
TOP_K = 10


# ---------------------------------------------------------------------------
# Rule tables
# ---------------------------------------------------------------------------
@dataclass(frozen=True)
class Rule:
    """One token rule. ``emit`` False means the lexeme is consumed and dropped.

    ``java`` is its pattern over a marked line, ``plain`` over one without
    marks (None: it matches nowhere there), ``re2`` the plain form of the
    oracle. ``norm`` names the normalizer applied to an emitted lexeme.
    """

    kind: str
    java: str
    plain: str | None
    re2: str
    emit: bool
    norm: str | None = None


_TAG = Rule("tag", TAG_JAVA, TAG_PLAIN, TAG, emit=False)
_ENTITY = Rule("entity", ENTITY_JAVA, ENTITY, ENTITY, emit=False)
_NUMBER = Rule("number", NUMBER_JAVA, NUMBER_PLAIN, NUMBER, emit=True, norm="number")
_WORD = Rule("word", WORD_JAVA, WORD_PLAIN, WORD_RE2, emit=True, norm="word")

# The full analyzer: rules tried in this order at each position, first match wins.
FULL_RULES = (
    Rule("css", CSS_JAVA, None, CSS_RE2, emit=False),
    _ENTITY,
    _TAG,
    Rule("url", URL_JAVA, URL_PLAIN, URL, emit=True, norm="url"),
    _NUMBER,
    Rule("email", EMAIL_JAVA, None, EMAIL, emit=True, norm="keep"),
    _WORD,
)

# The earlier, compact analyzer: no CSS rule, other order, other normalizers.
# Its original order is tag, url, email, number, entity, word; entity and word
# start with disjoint characters ('&' against [A-z]), so listing entity last
# changes no match and keeps the emitted rules contiguous.
COMPACT_RULES = (
    _TAG,
    Rule("url", URL_JAVA, URL_PLAIN, URL, emit=True, norm="url_compact"),
    Rule("email", EMAIL_JAVA, None, EMAIL, emit=True, norm="email_compact"),
    _NUMBER,
    _WORD,
    _ENTITY,
)

RULE_SETS = {"full": FULL_RULES, "compact": COMPACT_RULES}
