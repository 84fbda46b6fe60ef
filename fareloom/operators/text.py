"""Word counts."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.operators.aggregates import top_k

# Fixed value: what separates words.
NON_WORD = r"\W+"


def words(df: DataFrame, column: str = "value", pattern: str = NON_WORD) -> DataFrame:
    """One row per word of ``column``, without empty ones."""
    return df.select(F.explode(F.split(column, pattern)).alias("word")).filter("word <> ''")


def word_totals(df: DataFrame, column: str = "value", pattern: str = NON_WORD) -> DataFrame:
    """Occurrences of each word; unsorted. Frequent words are combined before the shuffle."""
    return words(df, column, pattern).groupBy("word").count()


def word_count(df: DataFrame, column: str = "value", pattern: str = NON_WORD) -> DataFrame:
    """Occurrences of each word, most frequent first."""
    return word_totals(df, column, pattern).orderBy(F.desc("count"), "word")


def top_words(df: DataFrame, k: int = 20, column: str = "value") -> DataFrame:
    """The ``k`` most frequent words."""
    return top_k(word_totals(df, column), k, "count", "word")
