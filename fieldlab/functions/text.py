"""Text cleaning, extraction and categorising as column functions."""

from __future__ import annotations

from functools import reduce
from string import digits, punctuation

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldlab.functions.numbers import as_column

# Spellings that anglers and crews wrote, and the species or answer they mean.
SPECIES_SPELLINGS = {
    "troutor": "trout",
    "northern pikeminow": "northern pikeminnow",
    "pikeminow": "northern pikeminnow",
    "pileminnow": "northern pikeminnow",
    "pike": "northern pikeminnow",
    "notrouthern pikeminnow": "northern pikeminnow",
    "typically fish salmon": "salmon",
    "smb": "smallmouth bass",
    "bass": "smallmouth bass",
    "any": "anything",
    "any kind": "anything",
    "anythingthing": "anything",
    "but whatever is in": "anything",
    "not an angler": "non-angler",
    "not anglers": "non-angler",
    "non-anglers": "non-angler",
    "ps": "pumpkinseed",
    "suckers": "sucker",
    "rb": "rainbow trout",
    "rt": "rainbow trout",
    "ct": "cutthroat trout",
}

# Reasons for choosing a site, first match wins.
SITE_REASONS = [
    ("SMB|small ?mouth ?bass| bass", "SMB / bass"),
    ("fish|fishing|caught|rod", "Fishing"),
    ("close|nearby|near|live|local|camping|close ?by|campground", "Proximity"),
    ("recreation|swim|BBQ|quiet|vacation|camping", "Recreation / Relaxation"),
]

# Nest outcome and fry codes and the sentences they stand for.
NEST_DESTROYED = {
    "Y": "Nest destroyed.",
    "N": "Nest not destroyed.",
    "P": "Nest partially destroyed.",
    "N (prev Y)": "Nest not destroyed.",
}
FRY_CAPTURED = {
    "N": "No fry captured.",
    "Y": "Fry captured.",
    "Y (1)": "Fry captured.",
    "Y (2)": "Two fry captured.",
    "Y (3)": "Three fry captured.",
    "N (attempted)": "Tried to catch fry, unsuccessful.",
}


# English function words left out of term counts. Contractions are not listed:
# punctuation is removed before words are compared.
STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself "
    "she her hers herself it its itself they them their theirs themselves what which who whom "
    "this that these those am is are was were be been being have has had having do does did doing "
    "would should could ought a an the and but if or because as until while of at by for with "
    "about against between into through during before after above below to from up down in out on "
    "off over under again further then once here there when where why how all any both each few "
    "more most other some such no nor not only own same so than too very"
).split()


_SPACES = "\t\r\n\f\v"


def strip(c: Column | str) -> Column:
    """Text without white space (line breaks included) at either end."""
    return F.btrim(as_column(c), F.lit(" " + _SPACES))


def tidy(c: Column | str) -> Column:
    """Stripped lower-case text."""
    return strip(F.lower(as_column(c)))


def replace_in_order(c: Column | str, rules: list[tuple[str, str]]) -> Column:
    """Apply regex replacements one after the other; later rules see earlier results."""
    return reduce(lambda text, rule: F.regexp_replace(text, *rule), rules, as_column(c))


def spelled(c: Column | str, spellings: dict[str, str]) -> Column:
    """Replace a whole value by its listed spelling; other values stay."""
    text = as_column(c)
    pairs = [F.lit(x) for pair in spellings.items() for x in pair]
    return F.coalesce(F.element_at(F.create_map(*pairs), text), text)


def commas(c: Column | str) -> Column:
    """Semicolons and the words "and", "or" as commas."""
    return F.regexp_replace(as_column(c), r"(?i);|\band\b|\bor\b", ",")


def after_dash(c: Column | str) -> Column:
    """What follows the first dash, null when there is none."""
    found = F.regexp_extract(as_column(c), r"(?<=-).*", 0)
    return F.when(F.instr(as_column(c), "-") > 0, found)


def sum_numbers(c: Column | str) -> Column:
    """Sum of all whole numbers written in a text; 0 without digits, null for null."""
    digits = F.regexp_extract_all(as_column(c), F.lit(r"(\d+)"), F.lit(1))
    return F.aggregate(digits, F.lit(0.0), lambda total, x: total + x.cast("double"))


def digit_count(c: Column | str) -> Column:
    return F.length(F.regexp_replace(as_column(c), "[^0-9]", ""))


def categorise(c: Column | str, rules: list[tuple[str, str]], otherwise: str = "Other") -> Column:
    """Label of the first case-insensitive pattern found in the text."""
    text = as_column(c)
    chain = reduce(
        lambda w, rule: w.when(text.rlike(f"(?i){rule[0]}"), rule[1]),
        rules[1:],
        F.when(text.rlike(f"(?i){rules[0][0]}"), rules[0][1]),
    )
    return chain.otherwise(otherwise)


def expand_code(c: Column | str, sentences: dict[str, str]) -> Column:
    """Sentence for a code; empty text for unknown or missing codes."""
    pairs = [F.lit(x) for pair in sentences.items() for x in pair]
    return F.coalesce(F.element_at(F.create_map(*pairs), as_column(c)), F.lit(""))


def nest_activity(destroyed: Column | str, fry: Column | str) -> Column:
    """Nest outcome and fry sentences joined by one space."""
    return F.trim(
        F.concat_ws(" ", expand_code(destroyed, NEST_DESTROYED), expand_code(fry, FRY_CAPTURED))
    )


def labelled(parts: dict[str, Column | str]) -> Column:
    """``Label: value`` pairs in one string; missing values print as nothing."""
    pieces = [
        F.concat(F.lit(f"{label}: "), F.coalesce(as_column(c).cast("string"), F.lit("")))
        for label, c in parts.items()
    ]
    return F.concat_ws(" ", *pieces)


def repaired(c: Column | str, wrong: str, right: str) -> Column:
    text = as_column(c)
    return F.when(text == wrong, F.lit(right)).otherwise(text)


def fragments(c: Column | str, separator: str = r"\.") -> Column:
    """Array of trimmed, non-blank fragments between separators."""
    parts = F.transform(F.split(as_column(c), separator), lambda p: strip(p))
    return F.filter(parts, lambda p: p != "")


def tidy_activity(c: Column | str) -> Column:
    """Doubled full stops become one, leading stops go, outer blanks are trimmed."""
    rules = [(r"\.( ?\.)+", "."), (r"^[. ]+", "")]
    return strip(replace_in_order(c, rules))


def or_label(c: Column | str, label: str = "NA") -> Column:
    return F.coalesce(as_column(c), F.lit(label))


def words(c: Column | str) -> Column:
    """Lower-case words after dropping ASCII punctuation and digits; blanks may remain."""
    bare = F.translate(F.lower(as_column(c)), _SPACES + punctuation + digits, " " * len(_SPACES))
    return F.split(bare, " ")
