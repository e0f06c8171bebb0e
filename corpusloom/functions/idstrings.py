"""Token sequences as strings: one character per token id.

Ids below the surrogate block are their own code point; larger ids skip that block.  A byte sequence is then the
ISO-8859-1 reading of the UTF-8 bytes, a pair is a two-character string, and a merge is a plain ``replace``, which
Catalyst compiles into the surrounding stage.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# First surrogate code point, and the size of the surrogate block.
SURROGATES_START = 0xD800
SURROGATES_SIZE = 0x800

# Private-use characters of the last plane: above every token id, so they can never be part of a sequence.
GAP = "\U0010fffd"
MISSING = "\U0010fffc"


def id_char(token_id: int) -> str:
    """The character that stands for ``token_id``."""
    return chr(token_id if token_id < SURROGATES_START else token_id + SURROGATES_SIZE)


def char_id(char: str) -> int:
    """Inverse of :func:`id_char`."""
    code = ord(char)
    return code if code < SURROGATES_START else code - SURROGATES_SIZE


def byte_string(text: Column) -> Column:
    """The UTF-8 bytes of ``text`` as an id string."""
    return F.decode(text.cast("binary"), "ISO-8859-1")


def code_of(char: Column) -> Column:
    """Token id of a one-character column."""
    code = F.ascii(char)
    return F.when(code < SURROGATES_START, code).otherwise(code - SURROGATES_SIZE)


def ids_of(seq: Column, max_id: int | None = None) -> Column:
    """Id string to ``ARRAY<INT>``.  A known ``max_id`` below the surrogate block saves the shift per element.

    ``array_remove`` drops the one empty string that an empty sequence splits into; a CASE would evaluate ``seq`` twice.
    """
    narrow = max_id is not None and max_id < SURROGATES_START
    return F.transform(F.array_remove(F.split(seq, ""), ""), F.ascii if narrow else code_of)


def string_array(values: Iterable[str], gap: str = GAP) -> Column:
    """A constant array of strings, sent as one literal and folded by the optimizer into an array literal."""
    return F.split(F.lit(gap.join(values)), gap)


def fold_pairs(seq: Column, triples: Column) -> Column:
    """Apply merges given as an array of three-character strings ``left right merged``, in array order."""
    return F.aggregate(
        triples, seq, lambda acc, m: F.replace(acc, F.substring(m, 1, 2), F.substring(m, 3, 1))
    )


def triple(left: int, right: int, token_id: int) -> str:
    return id_char(left) + id_char(right) + id_char(token_id)
