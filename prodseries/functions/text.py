"""Text repair, accent folding and the parsers for sheet tokens."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from prodseries.schemas import MISSING_TOKENS, MOJIBAKE_REPAIRS, MONTH_ABBREVIATIONS

# Unicode white space plus the four ASCII separators (FS, GS, RS, US).
_WHITESPACE = r"(?U)[\s\x1c-\x1f]+"

# Optional sign; digits with single underscores between them; optional fraction and
# exponent; or an infinity. This is a fixed grammar: Spark's own cast is both wider
# (type suffixes) and narrower (underscores).
_NUMBER = (
    r"^[+-]?(\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?$"
    r"|^[+-]?inf(inity)?$"
)

_NON_ASCII = r"[^\x00-\x7F]"

# The forms of a series description and of a period token.
_SERIES = r"^(.+?) - (.+?) - (.+?) \(([^)]+)\)$"
_PERIOD = r"^([A-Za-z]{3})([0-9]{2})$"


def clean_text(c: Column) -> Column:
    """Collapse runs of white space to one blank, then trim."""
    return F.trim(F.regexp_replace(c, _WHITESPACE, " "))


def fix_mojibake(c: Column) -> Column:
    """Repair the known damaged words, then drop any replacement character left over."""
    for damaged, repaired in MOJIBAKE_REPAIRS.items():
        c = F.replace(c, F.lit(damaged), F.lit(repaired))
    return F.replace(c, F.lit("�"), F.lit(""))


def normalize_text(c: Column) -> Column:
    return clean_text(fix_mojibake(c))


@lru_cache(maxsize=1)
def _ascii_folding() -> tuple[str, str, dict[str, str]]:
    """Compatibility decomposition restricted to ASCII, generated from the Unicode tables.

    Returns the characters that fold to exactly one ASCII character, their images, and the
    characters that fold to several.
    """
    single, image, several = [], [], {}
    for code in range(0x80, sys.maxunicode + 1):
        char = chr(code)
        if not unicodedata.decomposition(char):
            continue
        folded = "".join(x for x in unicodedata.normalize("NFKD", char) if x < "\x80")
        if len(folded) == 1:
            single.append(char)
            image.append(folded)
        elif folded:
            several[char] = folded
    return "".join(single), "".join(image), several


def _character_class(chars: list[str]) -> str:
    """A regex class over sorted characters, neighbours merged into ranges."""
    ranges: list[list[int]] = []
    for code in sorted(map(ord, chars)):
        if ranges and ranges[-1][1] == code - 1:
            ranges[-1][1] = code
        else:
            ranges.append([code, code])
    return "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in ranges) + "]"


def strip_accents(c: Column) -> Column:
    """Fold to ASCII: decompose compatibility characters and drop whatever is not ASCII.

    ASCII texts pass through untouched. Characters that expand (ligatures, fractions, squared
    units, ...) are few in any text: the distinct ones are looked up and replaced in turn.
    """
    single, image, several = _ascii_folding()
    # One literal instead of a thousand: pairs and their halves split at control characters.
    pairs = "\x02".join(f"{char}\x01{folded}" for char, folded in several.items())
    expansions = F.str_to_map(F.lit(pairs), F.lit("\x02"), F.lit("\x01"))
    foreign = F.regexp_replace(c, r"[\x00-\x7F]+", "")
    expanding = _character_class(list(several))
    found = F.array_distinct(F.regexp_extract_all(foreign, F.lit(expanding), F.lit(0)))
    expanded = F.when(
        foreign.rlike(expanding),
        F.aggregate(found, c, lambda text, ch: F.replace(text, ch, F.element_at(expansions, ch))),
    ).otherwise(c)
    folded = F.regexp_replace(F.translate(expanded, single, image), _NON_ASCII, "")
    return F.when(c.rlike(_NON_ASCII), folded).otherwise(c)


def month_number(abbreviation: Column) -> Column:
    """Spanish three-letter month -> 1..12, NULL when unknown."""
    lookup = F.create_map(
        *[F.lit(x) for i, name in enumerate(MONTH_ABBREVIATIONS, start=1) for x in (name, i)]
    )
    return F.element_at(lookup, abbreviation)


def parse_period(token: Column) -> Column:
    """``Abr24`` -> 2024-04-01; anything else -> NULL."""
    clean = normalize_text(token)
    month = month_number(F.lower(F.regexp_extract(clean, _PERIOD, 1)))
    year = F.lit(2000) + F.regexp_extract(clean, _PERIOD, 2).try_cast("int")
    return F.when(month.isNotNull(), F.make_date(year, month, F.lit(1)))


def parse_series_metadata(description: Column) -> Column:
    """``<title> - <mineral> - <departamento> (<unidad>)`` -> struct of the three parts.

    The text is matched as written first and without accents second; the three fields are
    NULL when neither matches.
    """
    text = normalize_text(description)
    plain = strip_accents(text)
    source = F.when(text.rlike(_SERIES), text).when(plain.rlike(_SERIES), plain)
    parts = [normalize_text(F.regexp_extract(source, _SERIES, i)) for i in (2, 3, 4)]
    return F.named_struct(
        F.lit("mineral"), parts[0], F.lit("departamento"), parts[1], F.lit("unidad"), F.lower(parts[2])
    )


def parse_numeric(raw: Column) -> Column:
    """Cell text -> struct(value, is_missing, is_invalid_numeric).

    A comma is always a thousands mark. A signed ``nan`` is a number without a value:
    NULL, with both flags false.
    """
    token = F.lower(strip_accents(normalize_text(raw)))
    missing = token.isNull() | token.isin(MISSING_TOKENS)
    digits = F.trim(F.replace(token, F.lit(","), F.lit("")))
    signed_nan = digits.rlike(r"^[+-]?nan$")
    number = digits.rlike(_NUMBER)
    value = F.when(
        ~missing & number, F.replace(digits, F.lit("_"), F.lit("")).try_cast("double")
    )
    return F.named_struct(
        F.lit("value"), value,
        F.lit("is_missing"), missing,
        F.lit("is_invalid_numeric"), ~missing & ~number & ~signed_nan,
    )


def optional_text(c: Column) -> Column:
    """Trimmed text, NULL when blank."""
    return F.nullif(F.trim(c), F.lit(""))


def text_to_bool(c: Column) -> Column:
    """True for ``true`` in any case, false for everything else including NULL."""
    return F.coalesce(F.lower(F.trim(c.cast("string"))) == "true", F.lit(False))
