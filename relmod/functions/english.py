"""English stems (SCL-4): the published Porter2 suffix algorithm as tables of rules.

Every step looks for the longest of its suffixes at a word's end and, where the
suffix stands in a region of the word or the letters before it fit, replaces
it. The steps are written once, as expressions that Spark SQL and other SQL
engines read alike (``Dialect`` names what differs), one column after another.
They are meant for distinct words, whose stems are then joined.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values of the published algorithm -------------------------------

VOWELS = "aeiouy"
DOUBLES = ["bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt"]
LI_ENDINGS = "cdeghkmnrt"
#: Words whose first region starts after these beginnings.
R1_PREFIXES = ["gener", "commun", "arsen"]
#: Whole words with stems of their own.
SPECIAL = {
    "skis": "ski",
    "skies": "sky",
    "dying": "die",
    "lying": "lie",
    "tying": "tie",
    "idly": "idl",
    "gently": "gentl",
    "ugly": "ugli",
    "early": "earli",
    "only": "onli",
    "singly": "singl",
    "sky": "sky",
    "news": "news",
    "howe": "howe",
    "atlas": "atlas",
    "cosmos": "cosmos",
    "bias": "bias",
    "andes": "andes",
}
#: Words that stay as they are after step 1a.
INVARIANT = ["inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed"]

#: (suffix, replacement, condition beyond the region), steps 2 and 3 in R1, step 4 in R2.
STEP_2 = [
    ("tional", "tion", None),
    ("enci", "ence", None),
    ("anci", "ance", None),
    ("abli", "able", None),
    ("entli", "ent", None),
    ("izer", "ize", None),
    ("ization", "ize", None),
    ("ational", "ate", None),
    ("ation", "ate", None),
    ("ator", "ate", None),
    ("alism", "al", None),
    ("aliti", "al", None),
    ("alli", "al", None),
    ("fulness", "ful", None),
    ("ousli", "ous", None),
    ("ousness", "ous", None),
    ("iveness", "ive", None),
    ("iviti", "ive", None),
    ("biliti", "ble", None),
    ("bli", "ble", None),
    ("ogi", "og", "after l"),
    ("fulli", "ful", None),
    ("lessli", "less", None),
    ("li", "", "after li-ending"),
]
STEP_3 = [
    ("tional", "tion", None),
    ("ational", "ate", None),
    ("alize", "al", None),
    ("icate", "ic", None),
    ("iciti", "ic", None),
    ("ical", "ic", None),
    ("ful", "", None),
    ("ness", "", None),
    ("ative", "", "in R2"),
]
STEP_4 = [
    *[(s, "", None) for s in ["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent"]],
    *[(s, "", None) for s in ["ism", "ate", "iti", "ous", "ive", "ize"]],
    ("ion", "", "after s or t"),
]

# ---------------------------------------------------------------------------

_V, _C = f"[{VOWELS}]", f"[^{VOWELS}]"
#: From a word's (or region's) start to the first non-vowel after a vowel.
_REGION = f"^{_C}*{_V}+{_C}"
#: A short syllable at the end; capital Y is a consonant.
_SHORT = f"(^{_V}{_C}|{_C}{_V}[^{VOWELS}wxY])$"


@dataclass(frozen=True)
class Dialect:
    """What SQL engines write differently."""

    matches: str  # function of a text and a pattern
    group: str  # the first group in a replacement
    flags: str  # what makes a replacement replace all
    ends: str  # that a word ends in a suffix


#: Spark compiles the plain comparison to far less code; methods that grow too long are only interpreted.
SPARK = Dialect("regexp_like", "$1", "", "endswith({word}, '{suffix}')")
DUCKDB = Dialect("regexp_matches", "\\1", ", 'g'", "right({word}, {n}) = '{suffix}'")


def _cut(n: int, word: str = "w") -> str:
    return f"left({word}, length({word}) - {n})"


def _case(branches: list[tuple[str, str]], otherwise: str) -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN {x}" for c, x in branches) + f" ELSE {otherwise} END"


def _by_length(rules: list[tuple]) -> list[tuple]:
    return sorted(rules, key=lambda r: -len(r[0]))


def _suffix_step(rules: list[tuple], region: str, ends: Callable[..., str]) -> str:
    """The longest suffix decides; it is replaced if it stands in the region and its condition holds."""
    conditions = {
        "after l": lambda n: f"{ends('l', _cut(n))}",
        "after li-ending": lambda n: f"right({_cut(n)}, 1) IN ({', '.join(repr(c) for c in LI_ENDINGS)})",
        "after s or t": lambda n: f"right({_cut(n)}, 1) IN ('s', 't')",
        "in R2": lambda n: f"length(w) - {n} >= r2",
    }
    branches = []
    for suffix, replacement, condition in _by_length(rules):
        n = len(suffix)
        holds = f"length(w) - {n} >= {region}" + (f" AND {conditions[condition](n)}" if condition else "")
        branches.append((ends(suffix), _case([(holds, f"{_cut(n)} || '{replacement}'")], "w")))
    return _case(branches, "w")


def steps(d: Dialect) -> list[tuple[str, str]]:
    """(column, expression) one after another, from ``word`` to ``stem``; ``w`` is the word as far as it has come."""

    def ends(suffix: str, word: str = "w") -> str:
        return d.ends.format(word=word, suffix=suffix, n=len(suffix))

    def matches(text: str, pattern: str) -> str:
        return f"{d.matches}({text}, '{pattern}')"

    def region(text: str) -> str:
        return f"length(regexp_extract({text}, '{_REGION}', 0))"

    marked = f"regexp_replace({_case([(ends('y', 'left(w, 1)'), 'concat(chr(89), substr(w, 2))')], 'w')}, '({_V})y', '{d.group}Y'{d.flags})"
    r1 = _case(
        [(f"left(w, {len(p)}) = '{p}'", str(len(p))) for p in R1_PREFIXES] + [(f"{region('w')} > 0", region("w"))], "length(w)"
    )
    rest = "substr(w, r1 + 1)"
    step_1a = _case(
        [
            (ends("sses"), _cut(2)),
            (f"{ends('ied')} OR {ends('ies')}", _case([("length(w) > 4", _cut(2))], _cut(1))),
            (f"{ends('us')} OR {ends('ss')}", "w"),
            (f"{ends('s')} AND {matches(_cut(2), _V)}", _cut(1)),
        ],
        "w",
    )
    # step 1b: what is left after a suffix that goes, else null
    shorter = _case(
        [
            (f"{ends('eedly')} OR {ends('eed')}", "NULL"),
            *[(ends(s), _case([(matches(_cut(len(s)), _V), _cut(len(s)))], "NULL")) for s in ["ingly", "edly", "ing", "ed"]],
        ],
        "NULL",
    )
    doubled = f"right(gone, 2) IN ({', '.join(repr(x) for x in DOUBLES)})"
    step_1b = _case(
        [
            ("gone IS NOT NULL AND right(gone, 2) IN ('at', 'bl', 'iz')", "gone || 'e'"),
            (f"gone IS NOT NULL AND {doubled}", _cut(1, "gone")),
            (f"gone IS NOT NULL AND length(gone) <= r1 AND {matches('gone', _SHORT)}", "gone || 'e'"),
            ("gone IS NOT NULL", "gone"),
            (ends("eedly"), _case([("length(w) - 5 >= r1", _cut(3))], "w")),
            (ends("eed"), _case([("length(w) - 3 >= r1", _cut(1))], "w")),
        ],
        "w",
    )
    step_1c = _case([(f"length(w) > 2 AND {matches('w', f'{_C}[yY]$')}", f"{_cut(1)} || 'i'")], "w")
    step_5 = _case(
        [
            (f"{ends('e')} AND (length(w) - 1 >= r2 OR (length(w) - 1 >= r1 AND NOT {matches(_cut(1), _SHORT)}))", _cut(1)),
            (f"{ends('ll')} AND length(w) - 1 >= r2", _cut(1)),
        ],
        "w",
    )
    lowered = "lower(word)"
    special = _case([(f"{lowered} = '{w}'", f"'{s}'") for w, s in SPECIAL.items()] + [(f"length({lowered}) <= 2", lowered)], "NULL")
    kept = f"w IN ({', '.join(repr(x) for x in INVARIANT)})"
    return [
        ("fixed", special),
        ("w", lowered),
        ("w", _case([("left(w, 1) = chr(39)", "substr(w, 2)")], "w")),
        ("w", marked),
        ("r1", r1),
        ("r2", _case([(f"{region(rest)} > 0", f"r1 + {region(rest)}")], "length(w)")),
        ("w", _case([(f"right(w, {n}) = {s}", _cut(n)) for n, s in ((3, "chr(39) || 's' || chr(39)"), (2, "chr(39) || 's'"), (1, "chr(39)"))], "w")),
        ("w", step_1a),
        ("fixed", _case([("fixed IS NOT NULL", "fixed"), (kept, "w")], "NULL")),
        ("gone", shorter),
        ("w", step_1b),
        ("w", step_1c),
        ("w", _suffix_step(STEP_2, "r1", ends)),
        ("w", _suffix_step(STEP_3, "r1", ends)),
        ("w", _suffix_step(STEP_4, "r2", ends)),
        ("w", step_5),
        ("stem", "coalesce(fixed, replace(w, 'Y', 'y'))"),
    ]


def english_stems(words: DataFrame) -> DataFrame:
    """``words`` with the stems of its column ``word``. A null word has a null stem, an empty one an empty stem."""
    out = words
    for column, expression in steps(SPARK):
        out = out.withColumn(column, F.expr(expression))
    return out.select(*words.columns, "stem")


def english_stems_sql(words: str) -> str:
    """SQL of ``english_stems`` over a table expression with a column ``word``."""
    inner, known = words, ["word"]
    for column, expression in steps(DUCKDB):
        kept = [c for c in known if c != column]
        inner = f"(SELECT {', '.join(kept)}, {expression} AS {column} FROM {inner})"
        known = [*kept, column]
    return f"SELECT word, stem FROM {inner}"
