"""Text helpers: truncation, prefixes, encoded bodies, visible text of a page, host names."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# The named entities of HTML 4 with their characters, from the standard library; a fixed space reads as a space.
ENTITIES = {name: chr(code) for name, code in name2codepoint.items()} | {"nbsp": " ", "apos": "'"}
ENTITY = "&(?:[A-Za-z][A-Za-z0-9]*|#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6});"

# White space, Unicode blanks included, as a character class and as characters.
WHITE = r"[\s\x0B\x1C-\x1F\x85\p{Z}]"
WHITE_CHARACTERS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# One scan from left to right, as a parser reads: at each place the first kind of mark-up that begins there is dropped as a whole. A ``>``
# inside a quoted attribute ends no tag; scripts, styles and comments reach to their own end, or to that of the page.
_ATTRIBUTES = r"""(?:[^"'>]++|"[^"]*+"|'[^']*+')*+"""
MARKUP = "(?is)" + "|".join(
    [
        r"<!--.*?(?:-->|\z)",
        rf"<(script|style)(?=[\s/>]){_ATTRIBUTES}(?<!/)>.*?(?:</\1\s*>|\z)",
        rf"</?[a-z]{_ATTRIBUTES}>",
        r"<[!?/a-z][^>]*+>",
        r"<[!?/a-z].*\z",
    ]
)


def shortened(text: Column, limit: int) -> Column:
    """The first ``limit`` characters and ``...`` where the text is longer."""
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit("..."))).otherwise(text)


def stripped(text: Column) -> Column:
    """Without white space at both ends, line breaks included."""
    return F.btrim(text, F.lit(WHITE_CHARACTERS))


def without_prefix(name: Column, prefix: str) -> Column:
    """``people/c1`` to ``c1``; names without the prefix are kept."""
    cut = F.substr(name, F.lit(len(prefix) + 1))
    return F.when(F.startswith(name, F.lit(prefix)), cut).otherwise(name)


def with_prefix(name: Column, prefix: str) -> Column:
    """``c1`` to ``people/c1``; names that have the prefix are kept."""
    return F.when(F.startswith(name, F.lit(prefix)), name).otherwise(F.concat(F.lit(prefix), name))


def id_from_url(url: Column) -> Column:
    """The id in ``…/d/<id>…``, else the input."""
    found = F.regexp_extract(url, r"/d/([A-Za-z0-9_-]+)", 1)
    return F.when(found != "", found).otherwise(url)


def decode_base64url(data: Column) -> Column:
    """URL-safe base64, with or without padding, to text; undecodable input is null."""
    standard = F.translate(data, "-_", "+/")
    return F.try_to_binary(standard, F.lit("base64")).cast("string")


def encode_base64url(text: Column) -> Column:
    """Text to unpadded URL-safe base64."""
    return F.rtrim(F.translate(F.base64(F.encode(text, "UTF-8")), "+/", "-_"), F.lit("="))


def _character(entity: Column) -> Column:
    """What one entity stands for; itself if that is no character."""
    body = F.substring(entity, 2, 1 << 16)
    body = F.left(body, F.length(body) - 1)
    hexadecimal = F.lower(F.substring(body, 2, 1)) == "x"
    number = F.when(hexadecimal, F.conv(F.substring(body, 3, 8), 16, 10)).otherwise(F.substring(body, 2, 8)).try_cast("bigint")
    usable = (number > 0) & (number < 0x110000) & ~number.between(0xD800, 0xDFFF)
    numbered = F.when(usable, F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32"))
    named = F.try_element_at(F.create_map(*[F.lit(x) for pair in ENTITIES.items() for x in pair]), body)
    return F.coalesce(F.when(F.startswith(body, F.lit("#")), numbered).otherwise(named), entity)


def without_entities(text: Column) -> Column:
    """Named and numeric entities decoded, each once; unknown ones stay."""

    def decoded(t: Column) -> Column:
        found = F.transform(F.regexp_extract_all(t, F.lit(ENTITY), F.lit(0)), _character)
        pieces = F.zip_with(F.split(t, ENTITY, -1), found, lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
        return F.when(F.contains(t, F.lit("&")), F.array_join(pieces, "")).otherwise(t)

    # In a list of one, so that what makes the text is computed once.
    return F.element_at(F.transform(F.array(text), decoded), 1)


def visible_text(html: Column) -> Column:
    """Text of a page: no scripts, styles, comments or tags; entities decoded; blanks collapsed."""
    text = without_entities(F.regexp_replace(html, MARKUP, ""))
    return F.trim(F.regexp_replace(text, f"{WHITE}+", " "))


def host(url: Column) -> Column:
    """Lower-case host name of a URL, null when there is none."""
    return F.lower(F.try_parse_url(url, F.lit("HOST")))
