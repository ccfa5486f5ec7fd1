"""Text clean-up, metrics and content hashes as column expressions.

Entity decoding and Unicode normal forms, which Spark has no function for, run in
Arrow UDFs, and so do metrics, which arrays count many times faster than regular
expressions; everything else stays in the JVM.
"""

from __future__ import annotations

import functools
import re
import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import arrow_udf
from pyspark.sql.pandas.types import from_arrow_type
from pyspark.sql.types import StringType

SPACE = r"[\s   -     　﻿]"
SPACES = "\t\n\x0b\f\r \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"
TOKEN = r"[\p{L}\p{N}]+"
ENTITIES = {"quot": '"', "lt": "<", "gt": ">", "amp": "&", "apos": "'", "nbsp": " ", "hellip": "…", "lsquo": "‘", "rsquo": "’", "ldquo": "“", "rdquo": "”"}
BOILERPLATE = "menu|close|sign in|log in|terms of use|privacy policy|advertisement|skip to content|share this article|manage cookies|cookie preferences|accept all cookies".split("|")
_ENTITY = re.compile(r"&(?:#[xX]([0-9a-fA-F]+)|#([0-9]+)|([a-zA-Z]+));")


def _entity(m: re.Match) -> str:
    hexadecimal, decimal, name = m.groups()
    if name:
        return ENTITIES.get(name.lower(), m[0])
    code = int(hexadecimal, 16) if hexadecimal else int(decimal)
    if code > 0x10FFFF or 0xD800 <= code <= 0xDFFF:
        return m[0]
    return chr(code)


def decode_entities(text: str) -> str:
    """Numeric references and eleven named ones, in one pass; others stay."""
    return _ENTITY.sub(_entity, text) if "&" in text else text


def _texts(column: pa.Array, change) -> pa.Array:
    """Changed texts, a few at a time as Python strings."""
    few = [column.slice(k, 256) for k in range(0, len(column), 256)] or [column]
    return pa.concat_arrays([pa.array([None if t is None else change(t) for t in some.to_pylist()], pa.string()) for some in few])


@arrow_udf(StringType())
def _decoded(column: pa.Array) -> pa.Array:
    import unicodedata

    return _texts(column, lambda t: unicodedata.normalize("NFC", decode_entities(t)))


@arrow_udf(StringType())
def _compatible(column: pa.Array) -> pa.Array:
    import unicodedata

    return _texts(column, lambda t: unicodedata.normalize("NFKC", decode_entities(t)))


@functools.cache
def unsettled(form: str) -> str:
    """A pattern that finds a character in every text that decoding and this normal form may change.

    It finds whatever isn't known to stay as it is in any text: characters without a normal
    form other than themselves, of combining class 0, that join no character before them. Of those
    the ranges of fewer than 64 above Cyrillic, but for general punctuation, and all above
    U+1FFFF are left out to keep the pattern short. ASCII is settled by the first test; ampersands are looked for elsewhere.
    """
    import unicodedata

    joins = {*range(0x1161, 0x1176), *range(0x11A8, 0x11C3)}
    for k in range(sys.maxunicode + 1):
        parts = unicodedata.decomposition(chr(k)).split()
        if len(parts) > 1 and parts[0][0] != "<":
            joins.add(int(parts[1], 16))
    ranges: list[list[int]] = []
    for k in range(0x80, 0x20000):
        c = chr(k)
        if k in joins or 0xD800 <= k <= 0xDFFF or unicodedata.combining(c) or unicodedata.normalize(form, c) != c:
            continue
        if ranges and ranges[-1][1] == k - 1:
            ranges[-1][1] = k
        else:
            ranges.append([k, k])
    kept = sorted(((a, b) for a, b in ranges if b - a >= 64 or a < 0x530 or 0x2010 <= a <= 0x203F), key=lambda r: r[0] - r[1])
    return r"[[^\x00-\x7f]&&[^" + "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in kept) + "]]"


def _ascii(c: Column) -> Column:
    return F.octet_length(c) == F.length(c)


def _changeable(c: Column, form: str) -> Column:
    return F.contains(c, F.lit("&")) | (~_ascii(c) & c.rlike(unsettled(form)))


def decoded(c: Column) -> Column:
    """Entities decoded, then normal form C. Only texts that these may change go to Python."""
    return F.coalesce(_decoded(F.when(_changeable(c, "NFC"), c)), c)


def compatible(c: Column) -> Column:
    """Entities decoded, then normal form KC. Only texts that these may change go to Python."""
    return F.coalesce(_compatible(F.when(_changeable(c, "NFKC"), c)), c)


def barrier(value: Column) -> Column:
    """The value, in a projection that the optimizer neither copies into filters nor merges with others."""
    return F.when(F.spark_partition_id() >= 0, value)


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, also where it holds a Python function."""
    return F.get(F.transform(F.array(value), use), 0)


def _runs(kinds: str, first: str = "[^!-~]") -> str:
    """A pattern of runs of these characters, a single blank left out as it is to become one.

    ``first`` holds all of them and is soon tested: most characters aren't among them.
    """
    one = f"[{first}&&[{kinds}]]"
    return f"[{first}&&[^ ]&&[{kinds}]]{one}*| {one}+"


def trim(c: Column) -> Column:
    """Without white space, Unicode's included, at both ends."""
    return F.btrim(c, F.lit(SPACES))


def collapse(c: Column) -> Column:
    return F.regexp_replace(c, _runs(SPACE[1:-1]), " ")


def count_of(c: Column, kinds: str) -> Column:
    """How many characters of these kinds a text has, without a list of them."""
    return F.length(F.regexp_replace(c, f"[^{kinds}]+", ""))


def normalized(c: Column, decode: bool = True) -> Column:
    """White-space normal form; null stands for an empty text."""
    c = F.coalesce(c, F.lit(""))
    c = decoded(c) if decode else c
    ascii_only = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"  # a class that Java looks up in a table
    c = F.when(_ascii(c), F.regexp_replace(c, ascii_only, "")).otherwise(F.regexp_replace(c, r"[[^\t\n\r -~]&&[\x00-\x08\x0b\x0c\x0e-\x1f\x7f​-‏⁠﻿]]", ""))
    c = F.replace(F.replace(c, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    # patterns match only where they change something: a single blank or line end is none
    for pattern, to in (
        (r"[\t\x{a0}][\t\x{a0} ]*| [\t\x{a0} ]+", " "),
        (r" +\n *|\n +", "\n"),
        (r"\n{3,}", "\n\n"),
    ):
        c = F.regexp_replace(c, pattern, to)
    return trim(c)


def _comparable(line: Column) -> Column:
    return trim(F.rtrim(F.lower(line), F.lit(".!:")))


def without_boilerplate(c: Column) -> Column:
    """A normalised text without isolated interface labels and adjacent repeats of a line.

    A line goes when the last line before it that is no label compares equal; a blank
    line in between saves it.
    """
    lines = F.transform(F.split(c, "\n"), lambda x: F.struct(x.alias("line"), _comparable(x).alias("form")))
    lines = F.filter(lines, lambda x: ~x["form"].isin(*BOILERPLATE))
    kept = let(lines, lambda a: F.filter(a, lambda x, i: (i == 0) | (x["form"] == "") | (x["form"] != F.get(a, i - 1)["form"])))
    return trim(F.regexp_replace(F.array_join(F.transform(kept, lambda x: x["line"]), "\n"), r"\n{3,}", "\n\n"))


def cleaned(c: Column, decode: bool = True) -> Column:
    return without_boilerplate(normalized(c, decode))


def content_form(c: Column, decode: bool = True) -> Column:
    """What is left of a text when case, quotes, dashes, tags and punctuation don't count."""
    c = F.coalesce(c, F.lit(""))
    c = F.lower(normalized(compatible(c) if decode else c, decode=False))
    c = F.regexp_replace(c, r"<[^>]+>", " ")
    # quotes and dashes of all kinds are punctuation
    return trim(F.regexp_replace(c, _runs(r"\p{P}\p{S}" + SPACE[1:-1], "[^a-z0-9]"), " "))


def content_hash(c: Column, decode: bool = True) -> Column:
    """SHA-256 of the content form, in hexadecimal."""
    return F.sha2(content_form(c, decode), 256)


METRICS = pa.struct([("character_count", pa.int32()), ("word_count", pa.int32()), ("sentence_count", pa.int32()), ("letter_ratio", pa.float64()), ("repeated_line_ratio", pa.float64()), ("token_diversity", pa.float64())])
_NO_TEXT = (None, None, None, 0.0, None, 0.0)
_LETTER, _BLANK, _END, _CLOSE = 1, 2, 4, 8


@functools.cache
def _kinds() -> np.ndarray:
    """For every character whether it is a letter or number, white space but no line end, a sentence's end, or what closes one."""
    import unicodedata

    kinds = np.fromiter((_LETTER if unicodedata.category(chr(k))[0] in "LN" else 0 for k in range(sys.maxunicode + 1)), np.uint8, sys.maxunicode + 1)
    for chars, bit in ((SPACES.replace("\n", ""), _BLANK), (".!?。！？", _END), ("\t\n\x0b\f\r \u00a0\"'”’)", _CLOSE)):
        kinds[[ord(c) for c in chars]] |= bit
    return kinds


def _points(t: str) -> np.ndarray:
    return np.frombuffer(t.encode("utf-32-le"), "<u4")


def _string(points: np.ndarray) -> str:
    return points.astype("<u4").tobytes().decode("utf-32-le")


def _repeated(low: str, points: np.ndarray, kinds: np.ndarray) -> float:
    blank = kinds & _BLANK != 0
    twice = blank[1:] & blank[:-1]
    if twice.any() or (blank & (points != 32)).any():
        low = _string(np.where(blank, 32, points)[np.append(True, ~twice)])
    lines = [x for x in (x.strip(" ") for x in low.split("\n")) if len(x) >= 20]
    if len(lines) < 3:
        return 0.0
    total = sum(map(len, lines))
    return (total - sum(map(len, set(lines)))) / total


def measured(t: str) -> tuple:
    """The six metrics of a text."""
    if not t:
        return (0, 0, 0, 0.0, 0.0, 0.0)
    kinds = _kinds()[_points(t)]
    letter, end, close = (kinds & bit != 0 for bit in (_LETTER, _END, _CLOSE))
    letters, words = int(letter.sum()), int(letter[0]) + int((letter[1:] & ~letter[:-1]).sum())
    sentences = int((end[:-1] & close[1:]).sum()) + int(end[-1])
    points = _points(low := t.lower())
    kinds = _kinds()[points]
    distinct = len(set(_string(np.where(kinds & _LETTER, points, 32)).split(" ")) - {""})
    return len(t), words, sentences, letters / len(t), _repeated(low, points, kinds), distinct / words if words else 0.0


@arrow_udf(from_arrow_type(METRICS))
def metrics(column: pa.Array) -> pa.Array:
    """Struct of the six text metrics."""
    rows = (_NO_TEXT if t is None else measured(t) for k in range(0, len(column), 64) for t in column.slice(k, 64).to_pylist())
    return pa.array([dict(zip([f.name for f in METRICS], row)) for row in rows], METRICS)


def repeated_line_ratio(c: Column) -> Column:
    """Share of characters in lines (of 20 or more) that came before; 0 under three such lines."""
    return metrics(c)["repeated_line_ratio"]


def inline(c: Column) -> Column:
    """One line of text without carriage returns."""
    return trim(collapse(F.regexp_replace(F.coalesce(c, F.lit("")), "\r", "")))


def keyword_form(c: Column) -> Column:
    """Lower case, ampersands spelt out, runs of anything but letters and digits a space."""
    c = F.regexp_replace(F.lower(c), rf"r{SPACE}*&{SPACE}*d", "research and development")
    c = F.regexp_replace(F.replace(c, F.lit("&"), F.lit(" and ")), r"[^\p{L}\p{N}]+", " ")
    return F.trim(c)
