"""Hyper-parameters and the fixed lexical tables of the pre-processing chain."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# ---------------------------------------------------------------------------
# Fixed values. They must equal the method's published settings for results
# to agree; they are stated here plainly, in their natural order.
# ---------------------------------------------------------------------------

# English stop-words (the NLTK English list, 179 entries, in its own order).
# Entries with an apostrophe never match: punctuation is deleted first.
STOP_WORDS = (
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you",
    "you're", "you've", "you'll", "you'd", "your", "yours", "yourself",
    "yourselves", "he", "him", "his", "himself", "she", "she's", "her", "hers",
    "herself", "it", "it's", "its", "itself", "they", "them", "their", "theirs",
    "themselves", "what", "which", "who", "whom", "this", "that", "that'll",
    "these", "those", "am", "is", "are", "was", "were", "be", "been", "being",
    "have", "has", "had", "having", "do", "does", "did", "doing", "a", "an",
    "the", "and", "but", "if", "or", "because", "as", "until", "while", "of",
    "at", "by", "for", "with", "about", "against", "between", "into", "through",
    "during", "before", "after", "above", "below", "to", "from", "up", "down",
    "in", "out", "on", "off", "over", "under", "again", "further", "then",
    "once", "here", "there", "when", "where", "why", "how", "all", "any",
    "both", "each", "few", "more", "most", "other", "some", "such", "no", "nor",
    "not", "only", "own", "same", "so", "than", "too", "very", "s", "t", "can",
    "will", "just", "don", "don't", "should", "should've", "now", "d", "ll",
    "m", "o", "re", "ve", "y", "ain", "aren", "aren't", "couldn", "couldn't",
    "didn", "didn't", "doesn", "doesn't", "hadn", "hadn't", "hasn", "hasn't",
    "haven", "haven't", "isn", "isn't", "ma", "mightn", "mightn't", "mustn",
    "mustn't", "needn", "needn't", "shan", "shan't", "shouldn", "shouldn't",
    "wasn", "wasn't", "weren", "weren't", "won", "won't", "wouldn", "wouldn't",
)

# ASCII punctuation deleted by the punctuation switch (Python's string.punctuation).
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# Tokenizer delimiters: space , . : ; " ' / - % ( ) [ ] { } ? ! @ # $ ^ & * + = | \ ~ `
# newline, tab, CR, FF, VT, backspace, bell, the control characters 0x00-0x07, and
# the digits 8 and 9 (the configured list spells them as '\8' and '\9', which are
# not escapes). '<', '>' and '_' are not delimiters.
DELIMITER_CLASS = r"[\x00-\x0d ,.:;\"'/\-%()\[\]{}?!@#$^&*+=|\\~`89]+"

# Runs of Unicode whitespace, as Python's str.split() without arguments sees them.
WHITESPACE_CLASS = (
    r"[\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}"
    r"\x{202f}\x{205f}\x{3000}]+"
)

# The same characters, one by one.
WHITESPACE_CHARS = "".join(
    map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)

# Delimiters that are neither whitespace, punctuation nor digits.
CONTROL_DELIMITERS = r"[\x00-\x08]"

# Runs of decimal digits, optionally with a decimal part; replaced by NUM_TOKEN.
DIGITS_PATTERN = r"\p{Nd}+(\.\p{Nd}+)?"
NUM_TOKEN = "<NUM>"

# Out-of-vocabulary bucket of the background model (upper case: no token can equal it).
UNK = "<UNK>"

# Default settings.
DEFAULT_MU = 800.0
DEFAULT_TOP_K = 20
DEFAULT_LAMBDA = 0.2
DEFAULT_UNK_PCT = 0.5  # a percentage: 0.5 %
CUTOFFS = (5, 10, 50)


def checked_mu(mu: float) -> float:
    """mu as a float. Smoothing needs mu > 0: without it a term that a document lacks has no probability."""
    mu = float(mu)
    if not mu > 0:
        raise ValueError(f"mu must be positive, not {mu}")
    return mu


@dataclass(frozen=True)
class TextOptions:
    """The five switches of the pre-processing chain."""

    lowercase: bool = True
    punctuation: bool = True
    digits: bool = True
    stemming: bool = False
    stopwords: bool = True
    stop_words: tuple = STOP_WORDS
    # With ``stemming``: a DataFrame (word, stem), one row per word; None is the English rules.
    stems: object = field(default=None, compare=False)


@dataclass(frozen=True)
class Params:
    """Hyper-parameters of one re-ranking run."""

    mu: float = DEFAULT_MU
    top_k: int = DEFAULT_TOP_K
    lam: float = DEFAULT_LAMBDA
    unk_pct: float = DEFAULT_UNK_PCT
    text: TextOptions = field(default_factory=TextOptions)
    # Task 0: a query token that occurs in no candidate is skipped ('drop') or raises ('error').
    oov: str = "drop"
    # Expansion words outside the candidates share <UNK>: the lowest-ranked one's
    # weight counts ('last', by assignment), or all of them ('sum').
    unk: str = "last"
    # A query of which no word has a vector: ranked by its own terms, or, strictly,
    # without any term of positive mass, so that every score is 1 (D8).
    strict_vectors: bool = False
    # Upper bound on the measured bytes of a side that may be broadcast.
    broadcast_bytes: int = 64 << 20

    def __post_init__(self):
        checked_mu(self.mu)

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)
