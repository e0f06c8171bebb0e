"""Readable forms of token bytes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def readable(token_bytes: Column) -> Column:
    """UTF-8 text of ``token_bytes``; invalid bytes become U+FFFD."""
    return F.make_valid_utf8(token_bytes.cast("string"))


def render_token(token_bytes: Column) -> Column:
    r"""Readable text with every character of a Unicode category C* written as ``\uXXXX``."""
    text = readable(token_bytes)

    def visible(char: Column) -> Column:
        code = F.lower(F.hex(F.ascii(char)))
        padded = F.when(F.length(code) < 4, F.lpad(code, 4, "0")).otherwise(code)
        return F.when(F.regexp_like(char, F.lit(r"\p{C}")), F.concat(F.lit("\\u"), padded)).otherwise(char)

    return F.array_join(F.transform(F.split(text, ""), visible), "")
