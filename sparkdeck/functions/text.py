"""Text cleaning as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Accented letters and their plain letters.
ACCENTED = "ÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝàáâãäåçèéêëìíîïñòóôõöùúûüýÿ"
PLAIN = "AAAAAACEEEEIIIINOOOOOUUUUYaaaaaaceeeeiiiinooooouuuuyy"
# The accented letters the social cleaner folds.
SOCIAL_ACCENTED = "ÀÁÂÃÄÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜàáâãäçèéêëìíîïñòóôõöùúûü"
SOCIAL_PLAIN = "AAAAACEEEEIIIINOOOOOUUUUaaaaaceeeeiiiinooooouuuu"
# Signs folded to letters by the social cleaner; digits become blanks there anyway.
SIGNS, SIGN_LETTERS = "ªº§³²¹", "AOS   "
# Characters the social cleaner turns into blanks.
SOCIAL_BLANKS = "!.?,;:/+%()[]&`*$«»'_\t|\"0123456789"
# Characters the product cleaner deletes, and those it turns into blanks.
PRODUCT_DELETED = ".;,!/§?*-&~#(|`_\\^@)][=}{\n\"+<>"
PRODUCT_BLANKS = ":'"
# Fixed value: what the product cleaner takes for tags.
PRODUCT_TAGS = r"(?s)<[^>]*>(\s*<[^>]*>)*"
# Loose dashes the social cleaner turns into blanks, one after the other.
SOCIAL_DASHES = (" -", "- ", "--", " - ")


def strip_accents(col: Column) -> Column:
    return F.translate(col, ACCENTED, PLAIN)


def strip_punctuation(col: Column) -> Column:
    """Remove ASCII punctuation."""
    return F.regexp_replace(col, r"\p{Punct}", "")


def tokens(col: Column, separator: str = r"\s+") -> Column:
    """Split and drop empty tokens."""
    return F.filter(F.split(col, separator), lambda t: t != "")


def clean_product(col: Column) -> Column:
    """Product text: no tags, lower case, no listed punctuation, no accents."""
    text = F.lower(F.regexp_replace(col, PRODUCT_TAGS, ""))
    text = F.translate(text, PRODUCT_BLANKS + PRODUCT_DELETED, " " * len(PRODUCT_BLANKS))
    return strip_accents(text)


def clean_social(col: Column) -> Column:
    """Short messages to tokens: accents folded, punctuation and digits blanked, loose dashes dropped."""
    text = F.translate(col, SIGNS, SIGN_LETTERS)
    text = F.translate(F.translate(text, SOCIAL_ACCENTED, SOCIAL_PLAIN), SOCIAL_BLANKS, " " * len(SOCIAL_BLANKS))
    for dash in SOCIAL_DASHES:
        text = F.replace(text, F.lit(dash), F.lit(" "))
    return tokens(F.lower(text))


def drop_stop_words(words: Column, stop_words: list[str]) -> Column:
    """Keep tokens that are not in a short fixed list; repeated tokens stay repeated."""
    return F.filter(words, lambda t: ~t.isin(stop_words)) if stop_words else words


def clean_catalogue(col: Column, stop_words: list[str], min_len: int = 3) -> Column:
    """Catalogue lines to tokens: only a-z and underscore, short tokens and stop words dropped."""
    words = F.regexp_extract_all(F.lower(col), F.lit(f"[a-z_]{{{max(min_len, 1)},}}"), F.lit(0))
    return drop_stop_words(words, stop_words)


def count_of(words: Column, term: str) -> Column:
    """How often a term stands in a token array, without exploding it."""
    return F.size(F.filter(words, lambda t: t == term))
