"""Text cleaning as built-in expressions.

Only `html_to_text` names its argument more than once; give it a plain column. No other
function does, so a chain of them evaluates every step once.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from opine.functions.stopwords import ENGLISH

# The patterns of the cleaning rules. Dropped blocks go before tags,
# because a script may hold text that looks like a tag.
DROPPED_BLOCKS = r"(?is)<(?:script\b.*?</script\s*>|style\b.*?</style\s*>|!--.*?-->)"
TAG = r"<[A-Za-z/!?][^>]*>"
NON_LETTER = "[^a-zA-Z]"
SENTENCE_END = r"([.!?]+)[ \t\r\n]+"
BLANKS = " \t\r\n"
NAMED_ENTITY = "^([A-Za-z][A-Za-z0-9]*);"
DECIMAL_ENTITY = "^#([0-9]{1,7});"
HEX_ENTITY = "^#[xX]([0-9a-fA-F]{1,6});"

SENTENCE_MARK = "\u0001"
ABBREVIATION_MARK = "\u0002"


def _character(code_point: Column) -> Column:
    valid = code_point.between(1, 0xD7FF) | code_point.between(0xE000, 0x10FFFF)
    as_text = F.decode(F.unhex(F.lpad(F.hex(code_point), 8, "0")), "UTF-32")
    return F.when(valid, as_text).otherwise(F.lit("�"))


def _decode_piece(piece: Column, names: Column) -> Column:
    """Decode the piece of text that followed an ampersand."""
    name = F.regexp_extract(piece, NAMED_ENTITY, 1)
    decimal = F.regexp_extract(piece, DECIMAL_ENTITY, 1)
    hexadecimal = F.regexp_extract(piece, HEX_ENTITY, 1)
    rest = F.substring(piece, F.instr(piece, ";") + F.lit(1), F.length(piece))
    kept = F.concat(F.lit("&"), piece)
    return (
        F.when(piece.rlike(NAMED_ENTITY), F.coalesce(F.concat(F.try_element_at(names, name), rest), kept))
        .when(piece.rlike(DECIMAL_ENTITY), F.concat(_character(decimal.cast("int")), rest))
        .when(piece.rlike(HEX_ENTITY), F.concat(_character(F.conv(hexadecimal, 16, 10).cast("int")), rest))
        .otherwise(kept)
    )


def decode_entities(text: Column) -> Column:
    """Named (the 252 HTML 4 names) and numeric character references, decoded once."""
    pairs = "\u0001".join(f"{name}\u0002{chr(code)}" for name, code in sorted(name2codepoint.items()))
    names = F.str_to_map(F.lit(pairs), F.lit("\u0001"), F.lit("\u0002"))
    pieces = F.transform(
        F.split(text, "&"), lambda piece, i: F.when(i == 0, piece).otherwise(_decode_piece(piece, names))
    )
    return F.array_join(pieces, "")


def html_to_text(html: Column, sep: str = "") -> Column:
    """Drop scripts, styles, comments and tags, then decode entities.

    Text nodes are joined by `sep`: nothing by default, a space to keep words apart.
    Text without "<" skips the patterns, which cost more than all other steps together.
    """
    without_tags = F.regexp_replace(F.regexp_replace(html, DROPPED_BLOCKS, sep), TAG, sep)
    return decode_entities(F.when(F.contains(html, F.lit("<")), without_tags).otherwise(html))


def letters_only(text: Column) -> Column:
    """Every character outside a-z and A-Z becomes one space."""
    return F.regexp_replace(text, NON_LETTER, " ")


def word_list(text: Column) -> Column:
    """The runs of letters, in lower case. Text without letters gives an empty list.

    The same words as letters only, then lower case, then a split at blanks, but with one
    pass of the pattern. Words are lowered after the cut: some other letters lower to a-z.
    """
    return F.transform(F.array_remove(F.split(text, NON_LETTER + "+"), ""), F.lower)


def without_stopwords(words: Column, stopwords: Sequence[str] = ENGLISH) -> Column:
    """Drop stop words; order and repeats stay."""
    return F.filter(words, lambda word: ~word.isin(*stopwords)) if stopwords else words


def review_words(
    raw: Column, remove_stopwords: bool = False, stopwords: Sequence[str] = ENGLISH, sep: str = ""
) -> Column:
    """HTML to text to word list, with stop words kept unless asked otherwise."""
    words = word_list(html_to_text(raw, sep))
    return without_stopwords(words, stopwords) if remove_stopwords else words


def clean_review(raw: Column, stopwords: Sequence[str] = ENGLISH, sep: str = "") -> Column:
    """The whole cleaning chain as one string, words joined by one space."""
    return F.array_join(review_words(raw, True, stopwords, sep), " ")


def sentences(raw: Column, abbreviations: Sequence[str] = ()) -> Column:
    """Cut raw text after a run of . ! ? that blanks follow; empty sentences are dropped.

    The rule is plain: it also cuts after "Mr." unless `abbreviations` names "Mr".
    """
    if abbreviations:
        names = "|".join(re.escape(a) for a in sorted(abbreviations))
        raw = F.replace(raw, F.lit(ABBREVIATION_MARK), F.lit(" "))
        raw = F.regexp_replace(raw, rf"(?<![A-Za-z])({names})\.(?=[ \t\r\n])", "$1" + ABBREVIATION_MARK)
    raw = F.replace(raw, F.lit(SENTENCE_MARK), F.lit(" "))
    marked = F.regexp_replace(raw, SENTENCE_END, "$1" + SENTENCE_MARK)
    if abbreviations:
        marked = F.replace(marked, F.lit(ABBREVIATION_MARK), F.lit("."))
    trimmed = F.transform(F.split(marked, SENTENCE_MARK), lambda s: F.trim(s, F.lit(BLANKS)))
    return F.array_remove(trimmed, "")


# A word as abbreviations are counted, with what may stand around it.
WORD_TYPE = r"^[\"'(\[]*((?:[A-Za-z]+\.)*[A-Za-z]+)(\.?)[\"')\],;:!?]*$"
LAST_TYPE = r"^[\"'(\[]*((?:[A-Za-z]+\.)*[A-Za-z]+)\.$"


def word_types(text: Column) -> Column:
    """The words between blanks as (type, with_period): letters with periods inside, in lower case, and whether a period
    follows. What holds other characters has no type."""
    tokens = F.filter(F.split(text, "[ \t\r\n]+"), lambda t: t.rlike(WORD_TYPE))
    return F.transform(
        tokens,
        lambda t: F.struct(
            F.lower(F.regexp_extract(t, WORD_TYPE, 1)).alias("type"),
            (F.regexp_extract(t, WORD_TYPE, 2) == ".").alias("with_period"),
        ),
    )


def sentences_known(raw: Column, known: Column) -> Column:
    """As `sentences`, with the abbreviations as an array column of types in lower case: no cut after a known type and
    one period. The text is cut at every end first, and ends after known types are closed again."""
    raw = F.replace(raw, F.lit(SENTENCE_MARK), F.lit(" "))
    pieces = F.split(F.regexp_replace(raw, r"([.!?]+)(?=[ \t\r\n])", "$1" + SENTENCE_MARK), SENTENCE_MARK)

    def closed(piece: Column) -> Column:
        last = F.element_at(F.split(piece, "[ \t\r\n]+"), -1)
        is_known = F.array_contains(known, F.lower(F.regexp_extract(last, LAST_TYPE, 1)))
        return F.when(is_known, piece).otherwise(F.concat(piece, F.lit(SENTENCE_MARK)))

    parts = F.split(F.array_join(F.transform(pieces, closed), ""), SENTENCE_MARK)
    return F.array_remove(F.transform(parts, lambda s: F.trim(s, F.lit(BLANKS))), "")
