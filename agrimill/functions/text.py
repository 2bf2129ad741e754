"""Text clean-up as Column expressions."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable
from functools import lru_cache

from pyspark.sql import Column, functions as F

# Letters that no decomposition takes apart, and what they become in a name.
LIGATURES = {"œ": "oe", "æ": "ae", "Œ": "OE", "Æ": "AE", "ß": "ss"}
COMBINING = "[\u0300-\u036f]"


@lru_cache(maxsize=1)
def plain_letters() -> dict[str, str]:
    """What stands for a character in a name: its compatibility form without marks, where that is ASCII.

    Forms of several letters count for Latin letters only (``Ǆ``, ``ﬁ``).
    """
    out = dict(LIGATURES)
    for code in range(0x80, 0x10000):
        char = chr(code)
        form = "".join(c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c))
        if form.isascii() and (len(form) == 1 or len(form) > 1 and char.isalpha() and (code < 0x250 or 0xFB00 <= code <= 0xFB06)):
            out[char] = form
    return out


def join_skip_null(*cols: Column | str) -> Column:
    """Concatenation where NULL counts as the empty string."""
    return F.concat_ws("", *cols)


def join_strict(*cols: Column | str) -> Column:
    """Concatenation that is NULL as soon as one part is NULL."""
    return F.concat(*cols)


def blank_to_null(col: Column) -> Column:
    return F.nullif(F.trim(col), F.lit(""))


def default_if_blank(col: Column, default: object) -> Column:
    """Value, or the default when it is NULL or only spaces."""
    return F.when(F.coalesce(F.trim(col), F.lit("")) == "", F.lit(default)).otherwise(col)


def strip_spaces_tabs(col: Column) -> Column:
    return F.regexp_replace(col, r"^[ \t]+|[ \t]+\z", "")


def slug(col: Column) -> Column:
    """``[^a-zA-Z0-9]`` to ``_``, one trailing odd character dropped, lowered last."""
    return F.lower(F.regexp_replace(F.regexp_replace(col, "[^a-zA-Z0-9]", "_"), "[^a-zA-Z0-9]$", ""))


def slug_with_id(ident: Column, name: Column) -> Column:
    """``<id>_<slugged name>``: only the name is lowered, the end is trimmed once."""
    body = F.concat(ident, F.lit("_"), F.regexp_replace(F.lower(name), "[^a-zA-Z0-9]", "_"))
    return F.regexp_replace(body, "[^a-zA-Z0-9]$", "")


def snake(col: Column) -> Column:
    """Column-name rule applied to a value: plain letters, snake case, ``_`` between words.

    Same names as ``snake_name``. A letter that has no plain form counts as a gap between words.
    """
    plain = plain_letters()
    single = {c: p for c, p in plain.items() if len(p) == 1}
    longer = {c: p for c, p in plain.items() if len(p) > 1}
    out = F.translate(F.regexp_replace(col, COMBINING, ""), "".join(single), "".join(single.values()))
    out = F.when(out.rlike(f"[{''.join(longer)}]"), replace_all(out, longer.items())).otherwise(out)
    out = F.regexp_replace(out, "([A-Z0-9]+)([A-Z][a-z])", "$1_$2")
    out = F.lower(F.regexp_replace(out, "([a-z0-9])([A-Z])", "$1_$2"))
    out = F.regexp_replace(out, "[^a-z0-9]+", "_")
    out = F.regexp_replace(out, "^_|_$", "")
    return F.regexp_replace(out, "^([0-9])", "_$1")


def snake_name(name: str) -> str:
    """The same rule for one header cell (header lines reach the driver as names, not as rows)."""
    plain = re.sub(COMBINING, "", name).translate(str.maketrans(plain_letters()))
    plain = re.sub("([A-Z0-9]+)([A-Z][a-z])", r"\1_\2", plain)
    plain = re.sub("([a-z0-9])([A-Z])", r"\1_\2", plain).lower()
    plain = re.sub("(^_|_$)", "", re.sub("[^a-z0-9]+", "_", plain))
    return re.sub("^([0-9])", r"_\1", plain)


def header_names(cells: Iterable[str | None]) -> list[str]:
    """Names for a header line; blank cells become ``padding<position>``."""
    return [snake_name(c) if (c or "").strip() else f"padding{i}" for i, c in enumerate(cells)]


def elide_articles(col: Column) -> Column:
    """``D ALLIER`` and ``L ISLE`` to ``D'ALLIER`` and ``L'ISLE``, at any word start."""
    return F.regexp_replace(col, r"(^|\s)([DL]) ", "$1$2'")


def flatten_sentence(col: Column) -> Column:
    """Line feed to space, double quote to single quote, semicolon to full stop."""
    return F.translate(col, '\n";', " '.")


def drop_chars(col: Column, chars: str) -> Column:
    return F.translate(col, chars, "")


def capitalize(col: Column) -> Column:
    """First letter upper, all the rest lower."""
    return F.concat(F.upper(F.substring(col, 1, 1)), F.lower(F.substr(col, F.lit(2))))


def contains_any(col: Column, words: Iterable[str]) -> Column:
    test = F.lit(False)
    for word in words:
        test = test | F.contains(col, F.lit(word))
    return test


def replace_all(col: Column, pairs: Iterable[tuple[str, str]]) -> Column:
    """Literal replacements, in the order given."""
    for old, new in pairs:
        col = F.replace(col, F.lit(old), F.lit(new))
    return col


def address_parts(*parts: Column) -> Column:
    """Parts joined by one space, skipping NULL, blank, ``nan`` and ``-``; NULL if none is left."""
    kept = F.filter(F.array(*parts), lambda p: p.isNotNull() & ~p.isin("nan", "", "-"))
    return F.nullif(F.array_join(kept, " "), F.lit(""))


def capture_quantity_unit(col: Column, phrasings: Iterable[str]) -> tuple[Column, Column]:
    """(quantity, unit) after the first phrasing that is followed by ``<digits> <word>``."""
    found = []
    for phrase in phrasings:
        pattern = re.escape(phrase).replace("\\ ", " ") + r"(\d+) (\S+)"
        found.append((F.nullif(F.regexp_extract(col, pattern, 1), F.lit("")),
                      F.nullif(F.regexp_extract(col, pattern, 2), F.lit(""))))
    quantity = F.coalesce(*[q for q, _ in found])
    unit = F.coalesce(*[u for _, u in found])
    return F.translate(quantity, ",", "."), F.translate(unit, ".,", "")
