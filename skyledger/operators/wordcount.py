"""Word count over text: words are runs between blanks, tabs and line breaks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the word delimiters of the classic word count
# (space, tab, newline, carriage return, form feed).
WORD_SPLIT_PATTERN = r"[ \t\n\r\f]+"


def words(df: DataFrame, text_col: str = "text") -> DataFrame:
    """One row per word occurrence, column ``word``."""
    tokens = F.explode(F.split(F.col(text_col), WORD_SPLIT_PATTERN)).alias("word")
    return df.select(tokens).filter(F.col("word") != "")


def word_count(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``(word, n)``; partial counts combine map-side, so frequent words stay cheap."""
    return words(df, text_col).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def word_count_lines(counts: DataFrame) -> DataFrame:
    """Counts as text lines ``word<TAB>n`` ordered by word, the classic output format.

    The order is a distributed sort (range partitioning, then a sort within
    each partition), so part files read in name order give the global order.
    """
    return counts.orderBy("word").select(
        F.concat_ws("\t", F.col("word"), F.col("n").cast("string")).alias("line")
    )


def write_word_counts(counts: DataFrame, path: str) -> None:
    """Write ``word_count_lines`` as text files under ``path``."""
    word_count_lines(counts).write.mode("overwrite").text(path)
