"""Token sequences as bytes: four a token, little-endian, turned over for a whole Arrow batch at once.

Arrays are built, stored and cut one element at a time, bytes are copied: a stage that only moves tokens keeps them
packed.  Each function defines what runs in the workers inside itself, so that it travels with the plan.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.idstrings import SURROGATES_SIZE, SURROGATES_START

WIDTH = 4
# Text that is turned over in one go inside a batch.
CODED_BYTES = 4 << 20
CODED_IDS = 1 << 20
IDS = T.ArrayType(T.IntegerType(), False)
DIGEST = T.StructType([T.StructField("n_tokens", T.IntegerType()), T.StructField("digest", T.StringType())])


def packed_ids(seq: Column) -> Column:
    """An id string as packed ids; null stays null."""

    @F.arrow_udf(T.BinaryType())
    def packed(seqs: pa.Array) -> pa.Array:
        seqs = seqs.cast(pa.large_string())
        at = np.frombuffer(seqs.buffers()[1], np.int64)[seqs.offset : seqs.offset + len(seqs) + 1]
        data = memoryview(seqs.buffers()[2] or b"")
        # A null or empty row takes no bytes, so rows lie one after another.
        counts, parts, row = [np.zeros(1, np.int64)], [], 0
        while row < len(seqs):
            end = max(row + 1, int(np.searchsorted(at, at[row] + CODED_BYTES, "right")) - 1)
            part = data[at[row] : at[end]]
            before = np.zeros(len(part) + 1, np.int64)
            np.cumsum((np.frombuffer(part, np.uint8) & 0xC0) != 0x80, out=before[1:])
            counts.append(counts[-1][-1] + before[at[row + 1 : end + 1] - at[row]])
            codes = np.frombuffer(str(part, "utf-8").encode("utf-32-le"), "<i4")
            parts.append((codes - SURROGATES_SIZE * (codes >= SURROGATES_START)).astype("<i4"))
            row = end
        ids = np.concatenate(parts) if parts else np.zeros(0, "<i4")
        valid = pa.array(~np.asarray(seqs.is_null())).buffers()[1] if seqs.null_count else None
        ends = np.concatenate(counts) * WIDTH
        return pa.Array.from_buffers(pa.binary(), len(seqs), [valid, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(ids)])

    return packed(seq)


def unpacked_ids(packed: Column) -> Column:
    """Packed ids as ``ARRAY<INT>``; null stays null."""

    @F.arrow_udf(IDS)
    def unpacked(rows: pa.Array) -> pa.Array:
        rows = rows.cast(pa.large_binary())
        at = np.frombuffer(rows.buffers()[1], np.int64)[rows.offset : rows.offset + len(rows) + 1]
        data = memoryview(rows.buffers()[2] or b"")[at[0] : at[-1]]
        ends = pa.array(((at - at[0]) // WIDTH).astype(np.int32))
        mask = rows.is_null() if rows.null_count else None
        return pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(data, "<i4")), mask=mask)

    return unpacked(packed)


def array_ids(seq: Column) -> Column:
    """Id string to ``ARRAY<INT>``: what ``ids_of`` gives, for columns of whole texts."""
    return unpacked_ids(packed_ids(seq))


def packed_size(packed: Column) -> Column:
    return F.shiftright(F.octet_length(packed), 2)


def packed_slice(packed: Column, start: Column, length: Column) -> Column:
    """``length`` ids from the place ``start``, which counts from 0."""
    return F.substring(packed, (start * WIDTH + 1).cast("int"), (length * WIDTH).cast("int"))


def id_digest(ids: Column) -> Column:
    """Number of ids, and the MD5 of their codes: four hexadecimal digits and a bar each (see ``queries.codes``)."""

    @F.arrow_udf(DIGEST)
    def digests(rows: pa.Array) -> pa.Array:
        digits = np.frombuffer(b"0123456789abcdef", np.uint8)
        known = np.full((1 << 16, 5), ord("|"), np.uint8)
        for place in range(4):
            known[:, place] = digits[(np.arange(1 << 16) >> (12 - 4 * place)) & 15]
        known = known.view("V5")[:, 0]

        def code(t: int | None) -> str:
            return "" if t is None else f"{t & (1 << 64) - 1:04x}"[:4] + "|"

        def codes_of(ids: pa.Array) -> bytes:
            values = ids.to_numpy(zero_copy_only=False)
            if ids.null_count or len(ids) and not (0 <= values.min() and values.max() < len(known)):
                return "".join(map(code, ids.to_pylist())).encode()
            return known[values].tobytes()

        at, valid = rows.offsets.to_pylist(), rows.is_valid().to_pylist()
        found, row = [], 0
        while row < len(rows):
            # Rows are coded together, unless one of them needs more than the table.
            end = row + 1
            while end < len(rows) and at[end + 1] - at[row] <= CODED_IDS:
                end += 1
            coded = codes_of(rows.values[at[row] : at[end]])
            if len(coded) == 5 * (at[end] - at[row]):
                texts = [coded[5 * (a - at[row]) : 5 * (b - at[row])] for a, b in zip(at[row:end], at[row + 1 : end + 1])]
            else:
                texts = [codes_of(rows.values[a:b]) for a, b in zip(at[row:end], at[row + 1 : end + 1])]
            found += [hashlib.md5(text).hexdigest() for text in texts]
            row = end
        sizes = [b - a for a, b in zip(at, at[1:])]
        fields = [pa.array(sizes, pa.int32()), pa.array(found, pa.string())]
        mask = pa.array([not v for v in valid]) if rows.null_count else None
        return pa.StructArray.from_arrays(fields, fields=[pa.field("n_tokens", pa.int32()), pa.field("digest", pa.string())], mask=mask)

    return digests(ids)
