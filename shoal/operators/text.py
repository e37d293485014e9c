"""Word count (D9) and most used words.

The mapper/combiner/reducer pair becomes ``explode(split)`` → ``groupBy``:
Spark's partial aggregate is the combiner, so a word that makes up a third of
all tokens is summed inside each map task before the shuffle. Whole texts are
tokenised; nothing is truncated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the default delimiter set of a Java StringTokenizer
# (blank, tab, newline, carriage return, form feed).
TOKEN_DELIMITERS = "[ \\t\\n\\r\\f]+"


def tokens(df: DataFrame, text_col: str = "text") -> DataFrame:
    """One row per whitespace-separated token; case and punctuation kept."""
    return (df.select(F.explode(F.split(F.col(text_col), TOKEN_DELIMITERS)).alias("word"))
            .where(F.col("word") != ""))


def word_count(df: DataFrame, text_col: str = "text", sorted_parts: bool = True) -> DataFrame:
    """``(word, count)`` with a 64-bit count.

    With ``sorted_parts`` each output partition is ordered by word, like the
    output of one reducer (a local sort, no extra shuffle)."""
    counts = tokens(df, text_col).groupBy("word").agg(F.count(F.lit(1)).alias("count"))
    return counts.sortWithinPartitions("word") if sorted_parts else counts


def top_words(df: DataFrame, k: int = 25, text_col: str = "text") -> DataFrame:
    """The ``k`` most used words, ties broken by the word (distributed top-k)."""
    return word_count(df, text_col, sorted_parts=False).orderBy(F.col("count").desc(), F.col("word")).limit(k)
