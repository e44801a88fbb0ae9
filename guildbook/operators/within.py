"""Texts that hold words, as a join by equality: a word's first characters are looked up among the short pieces of the texts, and the
whole word is checked afterwards. So no word meets every text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

c = F.col
#: Characters by which words and texts meet; shorter words meet by all they have.
PIECE = 3


def pieces(text: Column) -> Column:
    """All pieces of a text of one to PIECE characters, each once."""
    n = F.length(text)
    cut = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.array(*[F.substring(text, i, F.lit(k)) for k in range(1, PIECE + 1)]))
    return F.filter(F.array_distinct(F.flatten(cut)), lambda x: x != "")


def held_in(words: DataFrame, word: str, texts: DataFrame, text: str) -> DataFrame:
    """Rows of both tables where the text holds the word, as it is; null and empty ones never meet."""
    left = words.filter(F.length(word) > 0).withColumn("_piece", F.left(c(word), F.lit(PIECE)))
    right = texts.filter(F.length(text) > 0).withColumn("_piece", F.explode(pieces(c(text))))
    return left.join(right, "_piece").filter(c(text).contains(c(word))).drop("_piece")
