"""Expressions that pick pieces out of HTML text.

The patterns are possessive where they repeat, so that long pages need neither
backtracking nor deep recursion.
"""

from __future__ import annotations

import json
from functools import lru_cache
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# The named entities most seen, and their characters. All others are in the standard library's
# table of the HTML standard.
ENTITIES = {
    "amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " ",
    "aacute": "á", "eacute": "é", "iacute": "í", "oacute": "ó", "uacute": "ú", "ntilde": "ñ", "uuml": "ü",
    "Aacute": "Á", "Eacute": "É", "Iacute": "Í", "Oacute": "Ó", "Uacute": "Ú", "Ntilde": "Ñ", "Uuml": "Ü",
    "iquest": "¿", "iexcl": "¡", "ordm": "º", "ordf": "ª", "deg": "°", "laquo": "«", "raquo": "»",
}

# Whitespace of any script.
SPACE = r"[\s\x1C-\x1F]"


@lru_cache(maxsize=1)
def _other_entities() -> str:
    """SQL for a map of the remaining named entities."""
    others = {name[:-1]: char for name, char in html5.items() if name.endswith(";") and name[:-1] not in ENTITIES}
    text = json.dumps(others).replace("'", r"\u0027")
    return f"from_json(r'{text}', 'map<string,string>')"


def decode(text: str) -> str:
    """SQL for a text with its entities replaced by their characters; unknown ones stay as they are.

    The text is cut at its ampersands and every piece looks at its own name or number.
    Arrays of one value bind a name to something that is used more than once.
    """
    names, chars = ",".join(ENTITIES), ",".join(ENTITIES.values()).replace("'", r"\'")
    known = f"map_from_arrays(split('{names}', ','), split('{chars}', ','))"
    code = """CASE WHEN name RLIKE '^#0*+[0-9]{1,7}$' THEN try_cast(ltrim('0', substring(name, 2)) AS int)
                   WHEN name RLIKE '^#[xX]0*+[0-9A-Fa-f]{1,6}$' THEN int(conv(ltrim('0', substring(name, 3)), 16, 10)) END"""
    numbered = f"""transform(array({code}), code ->
                     CASE WHEN code BETWEEN 1 AND 55295 OR code BETWEEN 57344 AND 1114111
                          THEN decode(unhex(lpad(hex(code), 8, '0')), 'UTF-32') END)[0]"""
    piece = f"""transform(array(CASE WHEN contains(piece, ';') THEN substring_index(piece, ';', 1) END), name ->
                  coalesce(coalesce(try_element_at({known}, name), {numbered}, try_element_at({_other_entities()}, name)) || substring(piece, length(name) + 2),
                           '&' || piece))[0]"""
    return f"""transform(array({text}), whole ->
                 CASE WHEN contains(whole, '&')
                      THEN substring_index(whole, '&', 1)
                           || array_join(transform(slice(split(whole, '&'), 2, length(whole)), piece -> {piece}), '')
                      ELSE whole END)[0]"""


def strip_hidden(html: Column) -> Column:
    """Drop comments, scripts and styles, whose content may look like markup."""
    html = F.regexp_replace(html, r"(?s)<!--.*?-->", "")
    return F.regexp_replace(html, r"(?is)<(script|style)\b[^>]*+>.*?</\1\s*>", "")


def text_nodes(inner: Column) -> Column:
    """Texts that stand directly in an element, not decoded: what child elements hold is left out."""
    childless = F.regexp_replace(inner, r"(?i)<(\w++)\b[^>]*+>[^<]*+</\1\s*>", "<x>")
    pieces = F.when(F.contains(inner, F.lit("<")), F.split(childless, r"<[^>]*+>")).otherwise(F.array(inner))
    return F.filter(pieces, lambda t: t != "")


def collapse(text: str) -> str:
    """SQL for a text with every run of whitespace as one space."""
    return f"regexp_replace({text}, r'(?U){SPACE}+', ' ')"


def strip(text: str) -> str:
    """SQL for a text without whitespace at either end."""
    return f"regexp_replace({text}, r'(?U)^{SPACE}+|{SPACE}+\\z', '')"
