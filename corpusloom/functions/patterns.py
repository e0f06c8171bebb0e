"""Split patterns and the pre-tokenizing expression."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Two split patterns, in the form this data format uses.
GPT2PAT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?\p{P}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
GPT4PAT = r"""'(?i:[sdmt]|ll|ve|re)|[^\r\n\p{L}\p{N}]?+\p{L}+|\p{N}{1,3}| ?[^\s\p{L}\p{N}]++[\r\n]*|\s*[\r\n]|\s+(?!\S)|\s+"""


# What is not a group: escapes, quoted stretches and character classes.  A group captures unless ``(?`` opens it, or if
# it has a name.
_NO_GROUP = re.compile(r"\\Q.*?(?:\\E|\Z)|\\.|\[\^?\]?(?:\\.|[^\]\\])*\]", re.DOTALL)
_GROUP = re.compile(r"\((?!\?)|\(\?<(?![=!])")


def check_pattern(pattern: str) -> str:
    """Reject patterns with capture groups: only whole matches are split points here."""
    groups = len(_GROUP.findall(_NO_GROUP.sub("", pattern)))
    if groups:
        raise ValueError(f"a split pattern must not have capture groups, this one has {groups}: {pattern}")
    return pattern


def pretokenize(text: Column, pattern: str = GPT4PAT) -> Column:
    """All matches of ``pattern`` in ``text``, in order.  ``(?U)`` gives the Unicode reading of the classes."""
    return F.regexp_extract_all(text, F.lit("(?U)" + check_pattern(pattern)), F.lit(0))


def followed(text: Column, pattern: str, mark: str) -> Column:
    """``text`` with ``mark``, a control character, behind each match of ``pattern``."""
    return F.regexp_replace(text, F.lit("(?U)" + check_pattern(pattern)), F.lit("$0" + mark))
