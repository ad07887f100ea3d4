"""Hot search words in a tab-separated search log.

Log lines are ``time, user, word, rank, click, url`` separated by tabs.
The word is the third field; a line with too few fields counts under the
word ``"null"``, as the original job did. Splitting follows Java's
``String.split``: trailing empty fields are dropped first, so
``"a\\tb\\t"`` has two fields while ``"a\\tb\\t\\td"`` has an empty word.

One plan: split -> partial count per map task -> one shuffle -> final
count -> top-k (``TakeOrderedAndProject``: each task keeps k rows, no
global sort).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MISSING_WORD = "null"   # fixed value: word of lines without a word field
DEFAULT_TOP_K = 10      # fixed value: the job printed the ten hottest words


def log_fields(line: F.Column) -> F.Column:
    """Tab-separated fields with trailing empty fields removed."""
    return F.split(F.regexp_replace(line, "\t+\\z", ""), "\t", -1)


def _word(line: F.Column, field: int) -> F.Column:
    fields = log_fields(line)
    return F.when(F.size(fields) > field, F.element_at(fields, field + 1)).otherwise(F.lit(MISSING_WORD))


def word_counts(lines: DataFrame, field: int = 2, column: str = "value") -> DataFrame:
    """``(word, searchCount)`` for every word of the log."""
    return (lines.select(_word(F.col(column), field).alias("word"))
                 .groupBy("word").agg(F.count(F.lit(1)).alias("searchCount")))


def hot_words(lines: DataFrame, k: int = DEFAULT_TOP_K, field: int = 2,
              column: str = "value") -> DataFrame:
    """The ``k`` most searched words, ties broken by the word: ``(word, searchCount)``."""
    return (word_counts(lines, field, column)
            .orderBy(F.desc("searchCount"), F.asc("word")).limit(k))


def hot_words_malformed(lines: DataFrame, field: int = 2, column: str = "value") -> DataFrame:
    """Lines without a word field (the lines the job printed): ``line``."""
    return (lines.filter(F.size(log_fields(F.col(column))) <= field)
                 .select(F.col(column).alias("line")))
