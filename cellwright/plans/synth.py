"""Synthetic tables, chats and manifests, and train/eval splits."""

from __future__ import annotations

from math import gcd

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.draws import draw_int, uniform
from ..functions.numbers import round_exact
from ..operators.positions import take_lowest
from .chat import TABLE_MARK

# ---- fixed values of the generator ----
QUESTION = "what is the class?"
ID_DIGITS = 5
PAIRS = (1, 4)
ANSWERS = (0, 9)


def random_tables(tables: DataFrame, rows: int, columns: int, seed: int) -> DataFrame:
    """table_id, row_id, c0..: uniform values with two decimals for every given table_id."""
    grid = tables.select("table_id", F.explode(F.sequence(F.lit(0), F.lit(rows - 1))).alias("row_id"))
    return grid.select(
        "table_id", "row_id",
        *[round_exact(uniform(seed, "table_id", "row_id", F.lit(c)), 2).alias(f"c{c}") for c in range(columns)],
    )


def id_space(n: int) -> tuple[int, int]:
    """(lowest id, number of ids): five digits, or more when n needs them; the
    largest number of that length is never used."""
    digits = ID_DIGITS
    while 9 * 10 ** (digits - 1) - 1 < n:
        digits += 1
    return 10 ** (digits - 1), 9 * 10 ** (digits - 1) - 1


def id_step(size: int, seed: int) -> int:
    """A step without common factor with ``size``, so that multiples of it do not repeat."""
    step = int(size * 0.6180339887) + seed
    while gcd(step, size) != 1:
        step += 1
    return step


def unique_ids(df: DataFrame, number: str, n: int, seed: int, out: str = "id") -> DataFrame:
    """Scattered ids without repeats from the dense number 0..n-1 of each row."""
    low, size = id_space(n)
    wide = F.col(number).cast("decimal(38,0)")
    return df.withColumn(out, (F.lit(low) + F.pmod(wide * F.lit(id_step(size, seed)) + seed, F.lit(size))).cast("bigint"))


def random_chats(samples: DataFrame, seed: int, mark: bool = False) -> DataFrame:
    """``conversations`` for every id: one to four questions with a digit as answer."""
    pairs = draw_int(uniform(seed, "id", F.lit("pairs")), *PAIRS)

    def turn(who: str, what: Column) -> Column:
        return F.struct(F.lit(who).alias("from"), what.alias("value"))

    def pair(k):
        question = F.lit(QUESTION)
        if mark:
            question = F.when(k == 0, F.lit(TABLE_MARK + "\n" + QUESTION)).otherwise(question)
        digit = draw_int(uniform(seed, F.col("id"), k, F.lit("digit")), *ANSWERS)
        return F.array(turn("human", question), turn("gpt", digit.cast("string")))

    turns = F.flatten(F.transform(F.sequence(F.lit(0).cast("bigint"), pairs - 1), pair))
    return samples.withColumn("conversations", turns)


def split_exact(df: DataFrame, fraction: float, seed: int, key: str) -> DataFrame:
    """``part``: exactly int(n * fraction) rows are train, the rest eval."""
    drawn = df.withColumn("_u", uniform(seed, key, F.lit("split")))
    # a hair above, so that n * fraction does not fall just short of a whole number
    how_many = F.floor(F.col("n") * F.lit(fraction) + F.lit(1e-9))
    marked = take_lowest(drawn, "_u", [key], how_many, out="_train")
    return marked.withColumn("part", F.when(F.col("_train"), F.lit("train")).otherwise(F.lit("eval"))).drop("_train", "_u")


def split_hash(df: DataFrame, fraction: float, seed: int, key: str) -> DataFrame:
    """``part`` by hash threshold: no count and no shuffle, sizes only about right."""
    train = uniform(seed, key, F.lit("split")) < fraction
    return df.withColumn("part", F.when(train, F.lit("train")).otherwise(F.lit("eval")))


def manifest(samples: DataFrame, seed: int) -> DataFrame:
    """id, table, conversations, with the table mark before the first question."""
    named = samples.withColumn("table", F.concat(F.col("id").cast("string"), F.lit(".csv")))
    return random_chats(named, seed, mark=True).select("id", "table", "conversations")
