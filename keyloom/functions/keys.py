"""Keys and key ranges as column expressions.

A range is [start, end) over unsigned byte order. One convention holds everywhere: a start of X'' is the lowest
key and a NULL end is unbounded; other spellings are turned into it where data come in."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The prefix of keys of the second key format, and the end of the range of all such keys.
V2_PREFIX, V2_END = bytes.fromhex("72000000"), bytes.fromhex("72000001")
# How other programs write "no upper bound".
OPEN_ENDS = (b"", bytes.fromhex("ffffffffff"))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def encode_v2(key: Column | str) -> Column:
    return F.concat(F.lit(V2_PREFIX), _col(key))


def is_v2(key: Column | str) -> Column:
    return F.startswith(_col(key), F.lit(V2_PREFIX))


def decode_v2(key: Column | str, on_bad: str = "error") -> Column:
    """The key without its prefix. A key without the prefix raises an error, or gives NULL if on_bad is "null"."""
    key = _col(key)
    bad = F.lit(None).cast("binary") if on_bad == "null" else F.raise_error(F.concat(F.lit("key without the V2 prefix: "), F.hex(key))).cast("binary")
    return F.when(key.isNull() | is_v2(key), F.substring(key, len(V2_PREFIX) + 1, 2**31 - 1)).otherwise(bad)


def encode_v2_range(start: Column | str, end: Column | str) -> tuple[Column, Column]:
    """Both ends in the second format; no upper bound becomes the end of all its keys."""
    return encode_v2(start), F.coalesce(encode_v2(end), F.lit(V2_END))


def decode_v2_range(start: Column | str, end: Column | str) -> tuple[Column, Column]:
    start, end = _col(start), _col(end)
    return decode_v2(start), F.when(end != F.lit(V2_END), decode_v2(end))


def convert_range(start: Column | str, end: Column | str, source: str, target: str) -> tuple[Column, Column]:
    """A range of one key format ("v1", "v1ttl", "v2") in another."""
    if {source, target} - {"v1", "v1ttl", "v2"}:
        raise ValueError(f"unknown key format: {source} or {target}")
    if (source == "v2") == (target == "v2"):
        return _col(start), _col(end)
    return encode_v2_range(start, end) if target == "v2" else decode_v2_range(start, end)


def normal_end(end: Column | str, spellings: tuple[bytes, ...] = OPEN_ENDS) -> Column:
    """NULL for each spelling of an unbounded end."""
    end = _col(end)
    for s in spellings:
        end = F.when(end != F.lit(s), end)
    return end


def in_span(key: Column | str, start: Column | str, end: Column | str) -> Column:
    """start <= key < end."""
    key, end = _col(key), _col(end)
    return (key >= _col(start)) & (end.isNull() | (key < end))


def strictly_inside(key: Column | str, start: Column | str, end: Column | str) -> Column:
    """In the range and not its start: where a range can be split."""
    return in_span(key, start, end) & (_col(key) > _col(start))


def overlaps(start: Column | str, end: Column | str, start2: Column | str, end2: Column | str) -> Column:
    """Whether two non-empty ranges share a key."""
    start, end, start2, end2 = map(_col, (start, end, start2, end2))
    return (end2.isNull() | (start < end2)) & (end.isNull() | (start2 < end))


def compare_ends(a: Column | str, b: Column | str) -> Column:
    """-1, 0 or 1; no upper bound is above every key."""
    a, b = _col(a), _col(b)
    return F.when(a.eqNullSafe(b), 0).when(a.isNull(), 1).when(b.isNull(), -1).when(a < b, -1).otherwise(1)


def compare_starts(a: Column | str, b: Column | str) -> Column:
    """-1, 0 or 1; a missing start is below every key."""
    a, b = F.coalesce(_col(a), F.lit(b"")), F.coalesce(_col(b), F.lit(b""))
    return F.when(a == b, 0).when(a < b, -1).otherwise(1)


def encode_memcomparable(key: Column | str) -> Column:
    """Bytes in groups of eight, padded with zeros, each followed by 255 less the padding's length: the order
    of whole byte strings is that of their encodings, and no encoding is a prefix of another."""
    key = _col(key)
    group = lambda i: F.substring(key, i * 8 + 1, F.lit(8))
    def one(i: Column) -> Column:
        g = group(i)
        n = F.length(g)
        return F.concat(F.hex(g), F.repeat(F.lit("00"), 8 - n), F.lpad(F.hex(247 + n), 2, "0"))
    return F.unhex(F.array_join(F.transform(F.sequence(F.lit(0), F.floor(F.length(key) / 8).cast("int")), one), ""))


def decode_memcomparable(code: Column | str) -> Column:
    code = _col(code)
    def one(i: Column) -> Column:
        pad = 255 - F.conv(F.hex(F.substring(code, i * 9 + 9, F.lit(1))), 16, 10).cast("int")
        return F.hex(F.substring(code, i * 9 + 1, 8 - pad))
    return F.unhex(F.array_join(F.transform(F.sequence(F.lit(0), (F.length(code) / 9).cast("int") - 1), one), ""))


def redact(key: Column | str, hidden: bool) -> Column:
    """Keys as hexadecimal text, or a question mark for each if they are to be hidden."""
    return F.when(_col(key).isNotNull(), F.lit("?")) if hidden else F.hex(_col(key))


def latin1(key: Column | str) -> Column:
    """Bytes as text, a character a byte (ISO-8859-1), for regular expressions over arbitrary bytes."""
    return F.decode(_col(key), "ISO-8859-1")


def approximate_size(*parts: Column | str) -> Column:
    """Bytes of key, value and old value; missing parts count 0."""
    total = F.lit(0)
    for p in parts:
        total = total + F.coalesce(F.length(_col(p)), F.lit(0))
    return total


def quote_identifier(name: Column | str) -> Column:
    return F.concat(F.lit("`"), F.replace(_col(name), F.lit("`"), F.lit("``")), F.lit("`"))


# Driver-side parsing of keys that people write.

# What one-letter escapes stand for.
_ESCAPES = {"a": 7, "b": 8, "f": 12, "n": 10, "r": 13, "t": 9, "v": 11, "\\": 92, "'": 39, '"': 34}


def unescape(text: str) -> bytes:
    """Bytes of a text with escapes: the letters above, \\x and one or two hex digits, \\ and three octal digits."""
    out, i = bytearray(), 0
    while i < len(text):
        if text[i] != "\\":
            out += text[i].encode()
            i += 1
            continue
        rest = text[i + 1 :]
        if not rest:
            raise ValueError("the text ends inside an escape")
        if rest[0] in _ESCAPES:
            out.append(_ESCAPES[rest[0]])
            i += 2
        elif rest[0] == "x":
            digits = rest[1:3] if all(c in "0123456789abcdefABCDEF" for c in rest[1:3]) else rest[1:2]
            out.append(int(digits, 16))
            i += 2 + len(digits)
        else:
            out.append(int(rest[:3], 8))
            i += 4
    return bytes(out)


def parse_key(form: str, text: str) -> bytes:
    """A key written raw, escaped or in hex."""
    readers = {"raw": str.encode, "escaped": unescape, "hex": bytes.fromhex}
    if form not in readers:
        raise ValueError(f"unknown key form {form!r}")
    return readers[form](text)


def parse_span(form: str, start: str, end: str) -> tuple[bytes, bytes]:
    """A range in the second key format from two written keys; an empty end is unbounded."""
    low, high = parse_key(form, start), parse_key(form, end)
    if high and low >= high:
        raise ValueError("a range must start before it ends")
    return V2_PREFIX + low, V2_PREFIX + high if high else V2_END
