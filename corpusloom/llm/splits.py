"""The rows that classifiers must not learn from."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FOLDS = 4
HELD_OUT = 2


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the id as text has remainder 2 by 4; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT
