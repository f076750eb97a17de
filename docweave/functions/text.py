"""Column expressions for document text, all of built-in functions; a few on strings for steps that read a part whole."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as trimming means it, a regex character class's inside.
SPACE = r"\s\x0B\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}"


def trimmed(s: Column) -> Column:
    """Without white space, of any kind, at both ends."""
    return F.regexp_replace(s, rf"\A[{SPACE}]+|(?<![{SPACE}])[{SPACE}]+\z", "")


def escape_cell(s: Column) -> Column:
    """Text of a Markdown table cell: | escaped, newlines as spaces."""
    return F.replace(F.replace(s, F.lit("|"), F.lit("\\|")), F.lit("\n"), F.lit(" "))


def xml_escape(s: Column) -> Column:
    """& < > as entities."""
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        s = F.replace(s, F.lit(raw), F.lit(entity))
    return s


#: The entities that XML itself defines.
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&"))


def xml_unescape(s: Column) -> Column:
    """Entities and numeric references as their characters; a reference to no character stays."""
    plain = s
    for entity, raw in ENTITIES:
        plain = F.replace(plain, F.lit(entity), F.lit(raw))
    named = F.create_map(*(F.lit(x) for pair in ENTITIES for x in pair))
    # Each reference by itself, so that what one gives is never read as another.
    pieces = F.regexp_extract_all(s, F.lit(r"(?s)(&(?:[a-z]+|#[0-9]{1,7}|#x[0-9A-Fa-f]{1,6});|[^&]+|&)"), 1)

    def piece(x: Column) -> Column:
        number = F.regexp_extract(x, "^&#x?([0-9A-Fa-f]+);$", 1)
        code = F.when(number != "", F.when(x.startswith("&#x"), F.conv(number, 16, 10)).otherwise(number).cast("long"))
        valid = (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
        return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")).otherwise(F.coalesce(named[x], x))

    return F.when(s.contains("&#"), F.array_join(F.transform(pieces, piece), "")).otherwise(plain)


_REFERENCE = re.compile(r"&(?:[a-z]+|#[0-9]{1,7}|#x[0-9A-Fa-f]{1,6});")
_BLANK = " \t\n\x0b\f\r\u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000\ufeff"


def stripped(s: str) -> str:
    """trimmed() of a string."""
    return s.strip(_BLANK)


def unescaped(s: str) -> str:
    """xml_unescape() of a string."""
    if "&" not in s:
        return s
    if "&#" not in s:
        for entity, raw in ENTITIES:
            s = s.replace(entity, raw)
        return s
    named = dict(ENTITIES)

    def of(m: re.Match) -> str:
        x = m[0]
        if x[1] != "#":
            return named.get(x, x)
        code = int(x[3:-1], 16) if x[2] == "x" else int(x[2:-1])
        return chr(code) if 0 < code < 0x110000 and not 0xD800 <= code <= 0xDFFF else x

    return _REFERENCE.sub(of, s)


#: What a media type holds, in this order, and the extension it gets.
EXTENSIONS = (("png", "png"), ("jpeg", "jpg"), ("jpg", "jpg"), ("gif", "gif"), ("bmp", "bmp"), ("svg", "svg"), ("webp", "webp"), ("emf", "emf"), ("wmf", "wmf"))


def extension(mime: Column) -> Column:
    """File extension of an image by its media type; bin if none fits."""
    m, out = F.lower(mime), None
    for part, ext in EXTENSIONS:
        out = F.when(m.contains(part), ext) if out is None else out.when(m.contains(part), ext)
    return out.otherwise("bin")


def size_label(n: Column) -> Column:
    """Bytes below 1024, else KB with one digit."""
    return F.when(n < 1024, F.concat(n.cast("string"), F.lit("B"))).otherwise(F.concat(F.format_string("%.1f", F.round(n / 1024, 1)), F.lit("KB")))


def heading_level(style: Column) -> Column:
    """1 to 6 from an outline style's name, else null."""
    level = F.regexp_extract(style, r"(?i)(?:개요|Outline)\s*([1-7])", 1)
    number = F.when(level != "", level.cast("int"))
    return F.when(number > 6, 6).otherwise(number)


def replace_last(s: Column, key: Column, value: Column) -> Column:
    """The last occurrence of a literal key replaced; unchanged without one. No regex."""
    p = _last(s, key)
    return F.when(p > 0, F.concat(F.substring(s, F.lit(1), p - 1), value, F.substring(s, p + F.char_length(key), F.char_length(s)))).otherwise(s)


def _last(s: Column, key: Column) -> Column:
    """1-based place of the key's last occurrence, 0 if there is none."""
    back = F.position(F.reverse(key), F.reverse(s))
    return F.when(back > 0, F.char_length(s) - back - F.char_length(key) + 2).otherwise(0)


def replace_keys(s: Column, pairs: list[tuple[str, str]], all_occurrences: bool = False) -> tuple[Column, list[Column]]:
    """Ordered pairs applied to a text node, each to its last occurrence, later ones to
    what earlier ones left, or to all occurrences; and for each pair whether it hit. Values are XML-escaped. Empty keys are refused."""
    if not all(key for key, _ in pairs):
        raise ValueError("a key must not be empty")
    if not pairs:
        return s, []
    done = replace_each(s, F.array(*(F.struct(xml_escape(F.lit(k)).alias("k"), xml_escape(F.lit(v)).alias("v")) for k, v in pairs)), all_occurrences)
    return done["text"], [done["hits"][i] for i in range(len(pairs))]


def replace_each(s: Column, steps: Column, all_occurrences: bool = False) -> Column:
    """struct(text, hits) of a text node after steps, an array of struct(k, v) that may differ by row: each k, as it is, replaced
    by v at its last occurrence, or at all, in what earlier ones left; hits tells which were there."""
    start = F.struct(s.alias("text"), F.array().cast("array<boolean>").alias("hits"))
    put = F.replace if all_occurrences else replace_last
    return F.aggregate(steps, start, lambda acc, kv: F.struct(
        put(acc["text"], kv["k"], kv["v"]).alias("text"), F.array_append(acc["hits"], F.position(kv["k"], acc["text"]) > 0).alias("hits")))


#: The suffix of a changed document's default path, by what was done.
SUFFIXES = {
    "replace_text": "modified", "fill_template": "filled", "append_paragraph": "appended", "delete_paragraph": "deleted", "append_row": "row-added", "delete_row": "row-deleted", "set_field": "field-set",
    "set_paragraph": "para-set", "set_cell": "cell-set", "append_column": "col-added", "delete_column": "col-deleted", "insert_image": "img-added", "text_style": "styled", "paragraph_style": "para-styled",
    "insert_table": "table-added", "merge_horizontal": "merged", "merge_vertical": "vmerged", "delete_image": "img-removed", "replace_image": "img",
}


def output_path(path: Column, suffix: str) -> Column:
    """base_suffix.ext."""
    return F.regexp_replace(path, r"(\.[^./]*)$", f"_{suffix}$1")


#: Code points that count as wide.
WIDE = r"[\x{3000}-\x{303F}\x{3040}-\x{30FF}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{AC00}-\x{D7A3}\x{FF00}-\x{FFEF}]"


def text_width(s: Column, size: Column) -> Column:
    """Estimated width: wide characters count `size`, others 0.55 of it."""
    wide = F.regexp_count(s, F.lit(WIDE))
    return (wide + (F.char_length(s) - wide) * 0.55) * size
