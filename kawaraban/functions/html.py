"""Expressions on single HTML tokens and on HTML text."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column, functions as F

# One match per token: comment, script or style with its content, tag, text, stray '<'.
# A quoted attribute value may hold '<' and '>'; a quote that never closes is no quote.
# Possessive repeats keep it linear.
TOKEN = (
    r"(?is)<!--.*?-->"
    r"|<script\b.*?</script\s*>"
    r"|<style\b.*?</style\s*>"
    r"""|<[a-z/!?](?:[^<>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+>"""
    r"|[^<]+"
    r"|<"
)
VOID_TAGS = ("br", "img", "meta", "hr", "input", "link")


def tokens(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(TOKEN), F.lit(0))


def tag_name(token: Column) -> Column:
    """Lower-case tag name; '' where the token is no tag, NULL where it is plain text."""
    name = F.lower(F.regexp_extract(token, r"^</?([A-Za-z][A-Za-z0-9]*)", 1))
    return F.when(token.startswith("<") & (token != "<"), name)


def kind(token: Column, name: Column) -> Column:
    """comment, raw (script or style with content), tag or text, given ``tag_name``."""
    return (
        F.when(name.isNull(), "text")
        .when(name == "", "comment")
        .when(name.isin("script", "style") & ~token.startswith("</") & token.contains("</"), "raw")
        .otherwise("tag")
    )


def attribute(token: Column, name: str) -> Column:
    """Attribute value as written, NULL where the tag lacks it.

    The pattern goes from attribute to attribute, so what stands inside another
    one's quoted value is never taken for an attribute.
    """
    value = r"""(?:"[^"]*+"|'[^']*+'|[^\s>]*+)"""
    other = rf"""[\s/]++(?!{name}\s*+=)[^\s=/>]++(?:\s*+=\s*+{value})?+"""
    pattern = rf"""(?is)^<[a-z][^\s/>]*+(?:{other})*+[\s/]++{name}\s*+=\s*+("[^"]*"|'[^']*'|[^\s"'>]+)"""
    found = F.regexp_extract(token, pattern, 1)
    return F.btrim(F.nullif(found, F.lit("")), F.lit("\"'"))


def self_closed(token: Column) -> Column:
    return token.endswith("/>") & token.rlike(r"""(^<[A-Za-z0-9]+|["'\s])/>$""")


def with_void_tags_closed(token: Column) -> Column:
    """``<br>`` to ``<br/>``, and likewise for the other void tags."""
    return F.regexp_replace(token, rf"(?is)^<({'|'.join(VOID_TAGS)})\b([^>]*?)\s*/?>$", "<$1$2/>")


def reserialised(text: str) -> Column:
    """Text column as it stands in serialised markup: only ``& < >`` are escaped."""
    out = decode_entities(text)
    for char, ref in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        out = F.replace(out, F.lit(char), F.lit(ref))
    return F.when(F.col(text).rlike("[&<>]"), out).otherwise(F.col(text))


def decode_entities(text: str) -> Column:
    """Text column with named and numeric character references replaced, each exactly once.

    The text is cut at '&', so what one reference decodes to is never read as
    the start of another; what stands before the first '&' holds none.
    References nobody knows stay as they are.
    """
    return F.expr(_DECODED.format(text=f"`{text}`"))


def decoded(text: Column) -> Column:
    """``decode_entities`` of any expression, such as a part of an array's element."""
    reference = "^(#[0-9]+|#[xX][0-9A-Fa-f]+|[A-Za-z][A-Za-z0-9]*);"

    def point(ref: Column) -> Column:
        hexadecimal = F.ltrim(F.substring(ref, 3, 1 << 20), F.lit("0"))
        from_hex = F.when(F.length(hexadecimal).between(1, 6), hexadecimal)
        from_decimal = F.hex(F.substring(ref, 2, 1 << 20).try_cast("bigint"))
        digits = F.when(F.lower(F.left(ref, F.lit(2))) == "#x", from_hex).otherwise(from_decimal)
        value = F.conv(digits, 16, 10).try_cast("bigint")
        valid = value.between(1, 0x10FFFF) & ~value.between(0xD800, 0xDFFF)
        return F.when(valid, F.decode(F.unhex(F.lpad(digits, 8, "0")), "UTF-32"))

    def piece(x: Column) -> Column:
        names = F.str_to_map(F.lit(_names().replace("\\'", "'")), F.lit("\x02"), F.lit("\x01"))
        char = F.when(x["ref"] == "", None).when(x["ref"].startswith("#"), point(x["ref"])).otherwise(F.try_element_at(names, x["ref"]))
        rest = F.concat(char, F.substr(x["part"], F.length(x["ref"]) + 2))
        return F.coalesce(rest, F.when(x["head"], x["part"]).otherwise(F.concat(F.lit("&"), x["part"])))

    parts = F.transform(
        F.split(text, "&"),
        lambda part, i: F.struct(
            part.alias("part"), (i == 0).alias("head"), F.when(i == 0, "").otherwise(F.regexp_extract(part, reference, 1)).alias("ref")
        ),
    )
    return F.when(F.contains(text, F.lit("&")), F.array_join(F.transform(parts, piece), "")).otherwise(text)


def _names() -> str:
    """Named references as constant text for str_to_map, the common ones first.

    Maps are scanned in order.
    """
    points = name2codepoint | {"apos": ord("'")}
    common = ["amp", "quot", "apos", "lt", "gt", "nbsp"]
    names = common + sorted(set(points) - set(common))
    return "\x02".join(f"{n}\x01{chr(points[n])}" for n in names).replace("'", "\\'")


# Code point of a numeric reference as hexadecimal digits, without leading zeros;
# NULL where it is larger than any code point.
_HEX = "ltrim('0', substring(x.ref, 3))"
_DIGITS = (
    f"CASE WHEN lower(left(x.ref, 2)) = '#x' THEN CASE WHEN length({_HEX}) BETWEEN 1 AND 6 THEN {_HEX} END"
    " ELSE hex(try_cast(substring(x.ref, 2) AS bigint)) END"
)
_POINT = f"try_cast(conv({_DIGITS}, 16, 10) AS bigint)"
# SQL text, since it is short to send; written once per column.
_DECODED = f"""
CASE WHEN contains({{text}}, '&') THEN
  array_join(transform(
    transform(split({{text}}, '&'), (part, i) -> named_struct('part', part, 'head', i = 0, 'ref',
      CASE WHEN i = 0 THEN '' ELSE regexp_extract(
        part, '^(#[0-9]+|#[xX][0-9A-Fa-f]+|[A-Za-z][A-Za-z0-9]*);', 1) END)),
    x -> coalesce(
      CASE WHEN x.ref = '' THEN NULL
           WHEN NOT startswith(x.ref, '#') THEN
             try_element_at(str_to_map('{_names()}', '\x02', '\x01'), x.ref)
           WHEN {_POINT} BETWEEN 1 AND 1114111 AND {_POINT} NOT BETWEEN 55296 AND 57343 THEN
             decode(unhex(lpad({_DIGITS}, 8, '0')), 'UTF-32')
      END || substring(x.part, length(x.ref) + 2),
      CASE WHEN x.head THEN x.part ELSE '&' || x.part END)), '')
ELSE {{text}} END"""
