"""The 32-bit polynomial string hash (h = 31*h + c over UTF-16 code units) used for keys and salts."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

MASK = 0xFFFFFFFF
PIECE = 1 << 18  # code units hashed at a time, which bounds the memory of a batch


def java_string_hash(column):
    """Hash of a short string such as an account id, as a JVM-side expression.

    The fold works on code points; one above the basic plane counts as its two surrogates.
    """
    text = F.col(column) if isinstance(column, str) else column

    def push(h, unit):
        return (h * F.lit(31).cast("long") + unit).bitwiseAND(F.lit(MASK))

    def step(h, char):
        point = F.ascii(char).cast("long")
        above = point - 0x10000
        high = F.shiftright(above, 10) + 0xD800
        low = above.bitwiseAND(F.lit(0x3FF)) + 0xDC00
        return F.when(point < 0x10000, push(h, point)).otherwise(push(push(h, high), low))

    def signed(h):
        return F.when(h > 0x7FFFFFFF, h - (MASK + 1)).otherwise(h).cast("int")

    return F.aggregate(F.split(text, ""), F.lit(0).cast("long"), step, signed)


def hash_of(text):
    """The same hash of one Python string, for literals in lookups."""
    h = 0
    for unit in np.frombuffer(text.encode("utf-16-le"), dtype="<u2").tolist():
        h = (31 * h + unit) & MASK
    return h - (MASK + 1) if h > 0x7FFFFFFF else h


def _powers(n):
    powers = np.full(n, 31, dtype=np.uint32)
    powers[:1] = 1
    return np.multiply.accumulate(powers, dtype=np.uint32)


def _hash_piece(units, state, powers):
    """Continue the hash `state` over one run of code units."""
    n = len(units)
    tail = np.sum(units.astype(np.uint32) * powers[:n][::-1], dtype=np.uint32)
    return (state * int(powers[n]) + int(tail)) & MASK


def _hash_group(units, lengths, powers):
    """Hashes of several strings laid end to end.

    Prefix sums wrap modulo 2^32, so the difference of two of them is the hash of one string.
    """
    ends = np.cumsum(lengths)
    exponent = np.repeat(ends, lengths) - 1 - np.arange(len(units))
    sums = np.cumsum(units.astype(np.uint32) * powers[exponent], dtype=np.uint32)
    prefix = np.concatenate([np.zeros(1, np.uint32), sums])
    return prefix[ends] - prefix[ends - lengths]


def _hash_batch(texts: pa.Array) -> pa.Array:
    """Hashes of a batch, decoded and hashed in groups of about PIECE bytes whatever the length of its texts."""
    column = texts.cast(pa.large_string()).fill_null("").cast(pa.large_binary())
    n, powers = len(column), _powers(PIECE + 1)
    hashes = np.zeros(n, dtype=np.uint32)
    offsets = np.frombuffer(column.buffers()[1], "<i8")[column.offset:column.offset + n + 1] if n else np.zeros(1, "<i8")
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    first = 0
    while first < n:
        upto = max(first + 1, int(np.searchsorted(offsets, offsets[first] + PIECE, "right")) - 1)
        part = data[offsets[first]:offsets[upto]]
        units = np.frombuffer(part.tobytes().decode().encode("utf-16-le"), dtype="<u2")
        if len(part) > PIECE:  # one long text
            state = 0
            for start in range(0, len(units), PIECE):
                state = _hash_piece(units[start:start + PIECE], state, powers)
            hashes[first] = state
        else:
            # a character is one unit, two where its UTF-8 has four bytes
            each = ((part & 0xC0) != 0x80).astype(np.int64) + (part >= 0xF0)
            before = np.concatenate([[0], np.cumsum(each)])
            hashes[first:upto] = _hash_group(units, np.diff(before[offsets[first:upto + 1] - offsets[first]]), powers)
        first = upto
    return pa.array(hashes.view(np.int32), type=pa.int32(), mask=np.asarray(texts.is_null()))


def java_string_hash_text(column):
    """Hash of whole lines or texts: Arrow batches, one vectorised pass per batch."""
    return F.arrow_udf(_hash_batch, "int")(column)
