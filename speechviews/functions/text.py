"""Text clean-up and tokenising as column expressions.

A token is what lies between single spaces. Punctuation, tabs and newlines are deleted inside
a token, so a newline joins its neighbours instead of splitting them. All of this is done on
the whole text at once: one regular expression over a text costs a quarter of one per token,
and no higher-order function stands between the scan and ``explode``.
"""

from pyspark.sql import Column, functions as F

# The characters deleted from a token, and the control characters (other than
# those) that trimming removes at both ends of a token.
DELETED = r"[,.!?:;)(\t\n]+"
CONTROL = r"[\x00-\x08\x0b-\x1f]"
CONTROL_AT_TOKEN_EDGE = r"(?<![^\x20])[\x00-\x1f]+|[\x00-\x1f]+(?![^\x20])"
LETTERS = r"\p{L}+"
OUTSIDE_BMP = r"[\x{10000}-\x{10FFFF}]"


def clean_text(text: Column) -> Column:
    """Lower-cased text without punctuation, tokens still separated by single spaces."""
    kept = F.regexp_replace(text, DELETED, "")
    trimmed = F.regexp_replace(kept, CONTROL_AT_TOKEN_EDGE, "")
    # Hardly any text needs the trimming, and the optimiser evaluates one branch only.
    return F.lower(F.when(text.rlike(CONTROL), trimmed).otherwise(kept))


def is_word(token: Column) -> Column:
    """More than two UTF-16 units; two characters reach that only outside the basic plane."""
    n = F.length(token)
    return (n > 2) | ((n == 2) & token.rlike(OUTSIDE_BMP))


def words(text: Column) -> Column:
    """Array of the words that survive clean-up, in order, with repetitions."""
    return F.filter(F.split(clean_text(text), " "), is_word)


def normalise(text: Column) -> Column:
    """The surviving words joined by one space; '' when none survives."""
    return F.array_join(words(text), " ")


def letter_words(text: Column) -> Column:
    """Lower-cased runs of letters, the tokens the sentiment model sees."""
    return F.regexp_extract_all(F.lower(text), F.lit(LETTERS), F.lit(0))


def drop_listed(tokens: Column, stop_words) -> Column:
    """Tokens not in a (short, driver-side) list; letter case is ignored, repetitions stay."""
    lowered = [w.lower() for w in stop_words]
    return F.filter(tokens, lambda t: ~F.lower(t).isin(lowered))


def comma_list(items: Column) -> Column:
    return F.array_join(items, ",")


def display_list(comma_separated: Column) -> Column:
    """``a,b`` as it is shown: ``a, b``."""
    return F.array_join(F.split(comma_separated, ","), ", ")
