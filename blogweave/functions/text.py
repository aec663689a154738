"""Text column functions of the bag-of-words corpus.

All native: ``translate`` for character maps, ``regexp_extract_all`` for
tokens, ``lower`` for case.  Tokens use Unicode letter/number classes so
Java and RE2 split identically.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the corpus format.
SPACE_CHARS = "«»“”’*…/_.\\"          # each becomes a space before tokenising
TOKEN = r"[\p{L}\p{N}_]+"
MIN_TOKEN_LENGTH = 3                   # tokens of length > 2 are kept
BAG_ESCAPED = " :|\t"                  # each becomes '_' inside a bag item
MODALITIES = ["words", "author", "users", "tags", "hubs"]


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def space_out(text) -> Column:
    return F.translate(_col(text), SPACE_CHARS, " " * len(SPACE_CHARS))


def tokens(text) -> Column:
    return F.regexp_extract_all(_col(text), F.lit(TOKEN), F.lit(0))


def long_tokens(text) -> Column:
    """The tokens of ``space_out(text)`` of ``MIN_TOKEN_LENGTH`` and more: of the
    characters that become spaces only ``_`` could be part of one."""
    return F.regexp_extract_all(_col(text), F.lit(rf"[\p{{L}}\p{{N}}]{{{MIN_TOKEN_LENGTH},}}+"), F.lit(0))


def normalise_token(tok) -> Column:
    """Lower case and ``ё`` → ``е``."""
    return F.replace(F.lower(_col(tok)), F.lit("ё"), F.lit("е"))


def bag_item(term, n) -> Column:
    """Escaped term, with ``:n`` unless the count is 1."""
    term = _col(term)
    some = reduce(or_, [F.contains(term, F.lit(c)) for c in BAG_ESCAPED])
    escaped = F.when(some, F.translate(term, BAG_ESCAPED, "_" * len(BAG_ESCAPED))).otherwise(term)
    return F.concat(escaped, F.when(_col(n) == 1, F.lit("")).otherwise(F.concat(F.lit(":"), _col(n).cast("string"))))
