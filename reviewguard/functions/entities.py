"""HTML character references decoded in column expressions.

A text is cut at ``&``. Each part then begins with a number (``#65;``, ``#x41``), a name (``eacute;``) or
neither. Names come from the standard library's table of the HTML standard; those that may lack
their semicolon also match as a prefix, the longest first. Numbers follow the standard's rules
for code points that aren't characters.
"""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Names that are read without a semicolon, also in front of other letters.
BARE = {n: v for n, v in html5.items() if not n.endswith(";")}
LONGEST_BARE = max(map(len, BARE))

#: Fixed patterns of the standard: a number, a name.
NUMBER = r"^#(?:[0-9]+|[xX][0-9a-fA-F]+);?"
DECIMAL = r"^#([0-9]+)"
HEXADECIMAL = r"^#[xX]([0-9a-fA-F]+)"
NAME = r"^[^\t\n\f <&#;]{1,32};?"
REPLACEMENT = "�"
LAST = 0x10FFFF


def replaced_numbers() -> dict[int, str]:
    """Code points that stand for others: zero, and the C1 range as Windows-1252 where that has a character."""
    out = {0: REPLACEMENT, 13: "\r"}
    for n in range(0x80, 0xA0):
        try:
            out[n] = bytes([n]).decode("cp1252")
        except UnicodeDecodeError:
            out[n] = chr(n)
    return out


def is_dropped(n: Column) -> Column:
    """Code points that decode to nothing: controls but for blanks, and non-characters."""
    return (n.between(1, 8) | (n == 11) | n.between(14, 31) | n.between(127, 159) | n.between(0xFDD0, 0xFDEF)
            | (F.pmod(n, F.lit(0x10000)) >= 0xFFFE))


def _table(names: dict[str, str]) -> Column:
    """Two maps deep, first letter then name: a lookup goes through the names of one letter only."""
    deep: dict[str, dict[str, str]] = {}
    for n, v in names.items():
        deep.setdefault(n[0], {})[n] = v
    return F.from_json(F.lit(json.dumps(deep)), "map<string,map<string,string>>")


def _look_up(table: Column, name: Column) -> Column:
    return F.try_element_at(F.try_element_at(table, F.substring(name, 1, 1)), name)


def _character(n: Column) -> Column:
    swap = replaced_numbers()
    swaps = F.from_json(F.lit(json.dumps({str(k): v for k, v in swap.items()})), "map<string,string>")
    plain = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
    own = F.try_element_at(swaps, n.cast("string"))
    return (F.when((n <= 159) & own.isNotNull(), own)
            .when((n > LAST) | n.between(0xD800, 0xDFFF), REPLACEMENT)
            .when(is_dropped(n), "").otherwise(plain))


def _part(p: Column, names: Column, bare: Column) -> Column:
    """The text that stands for ``&`` and a part."""
    digits = F.ltrim(F.coalesce(F.nullif(F.regexp_extract(p, DECIMAL, 1), F.lit("")), F.regexp_extract(p, HEXADECIMAL, 1)), F.lit("0"))
    base = F.when(p.rlike(DECIMAL), 10).otherwise(16)
    small = F.when(base == 10, F.conv(F.left(digits, F.lit(8)), 10, 10)).otherwise(F.conv(F.left(digits, F.lit(8)), 16, 10)).cast("long")
    n = F.when(F.length(digits) > 7, LAST + 1).when(digits == "", 0).otherwise(small).cast("int")
    number = F.concat(_character(n), F.substr(p, F.length(F.regexp_extract(p, NUMBER, 0)) + 1))
    name = F.regexp_extract(p, NAME, 0)
    whole = F.concat(_look_up(names, name), F.substr(p, F.length(name) + 1))
    starts = [F.when(F.length(name) > k, F.concat(_look_up(bare, F.left(name, F.lit(k))), F.substr(p, F.lit(k + 1)))) for k in range(LONGEST_BARE, 1, -1)]
    return F.when(p.rlike(NUMBER), number).otherwise(F.coalesce(whole, *starts, F.concat(F.lit("&"), p)))


def decode_entities(c: Column) -> Column:
    """``c`` with every named and numeric character reference decoded once (``&amp;lt;`` gives ``&lt;``); null stays."""
    names, bare = _table(html5), _table(BARE)
    parts = F.split(c, "&", -1)
    rest = F.transform(F.slice(parts, F.lit(2), F.size(parts)), lambda p: _part(p, names, bare))
    return F.when(F.contains(c, F.lit("&")), F.concat(F.get(parts, F.lit(0)), F.array_join(rest, ""))).otherwise(c)
