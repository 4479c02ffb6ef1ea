"""Text clean-up: blanks, decimal commas, comparable place names, keys."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def _accent_table() -> tuple[str, str]:
    """Every precomposed capital whose canonical decomposition is letter + marks."""
    composed, plain = [], []
    for code in [*range(0x00C0, 0x0250), *range(0x1E00, 0x1F00)]:
        letter = chr(code)
        base, *marks = unicodedata.normalize("NFD", letter)
        if marks and letter == letter.upper():
            composed.append(letter)
            plain.append(base)
    return "".join(composed), "".join(plain)


_COMPOSED, _PLAIN = _accent_table()


# Bytes 0x80 to 0x9F that Windows-1252 defines; the others of the range have no character.
_WINDOWS_1252 = {
    chr(byte): bytes([byte]).decode("cp1252") for byte in range(0x80, 0xA0)
    if byte not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)}


def windows_1252(text: Column) -> Column:
    """Text that was decoded as Latin-1, as Windows-1252 means it."""
    return F.translate(text, "".join(_WINDOWS_1252), "".join(_WINDOWS_1252.values()))


def blank_to_null(text: Column) -> Column:
    """Trimmed text, or NULL when nothing is left."""
    return F.nullif(F.trim(text), F.lit(""))


def parse_double(text: Column) -> Column:
    """Lenient number: blank or non-numeric text becomes NULL, also under ANSI.

    Blanks are common in reports and are sorted out before the cast, whose
    failure path is slow.
    """
    return blank_to_null(text).try_cast("double")


def decimal_comma(text: Column) -> Column:
    """``"12,5"`` -> 12.5; blank or non-numeric marks such as ``Ip`` -> NULL."""
    return F.replace(blank_to_null(text), F.lit(","), F.lit(".")).try_cast("double")


def plain_name(name: Column) -> Column:
    """Comparable form of a place name: trimmed, upper case, no diacritics.

    Precomposed letters go through a translate table; combining marks of
    decomposed input are dropped. ASCII names have neither and skip both.
    """
    upper = F.upper(F.trim(name))
    plain = F.regexp_replace(F.translate(upper, _COMPOSED, _PLAIN), r"\p{M}+", "")
    return F.when(F.octet_length(upper) == F.char_length(upper), upper).otherwise(plain)


def surrogate_key(*parts: Column) -> Column:
    """Deterministic key: the parts joined by ``|``; NULL when any part is NULL."""
    complete = parts[0].isNotNull()
    for part in parts[1:]:
        complete = complete & part.isNotNull()
    return F.when(complete, F.concat_ws("|", *[part.cast("string") for part in parts]))
