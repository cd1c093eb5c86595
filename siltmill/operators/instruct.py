"""Instruction data from question and answer collections."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A fixed value: the language numbers of contest solutions.
CONTEST_LANGUAGES = {0: "uknown", 1: "Python 2", 2: "CPP", 3: "Python 3", 4: "Java"}


def math_file(name: Column) -> tuple[Column, Column, Column]:
    """difficulty, field, topic of .../train-difficulty/field__topic.txt."""
    stem = F.split_part(F.element_at(F.split(name, "/", -1), -1), F.lit("."), F.lit(1))
    return F.split_part(F.element_at(F.split(name, "/", -1), -2), F.lit("-"), F.lit(2)), F.split_part(stem, F.lit("__"), F.lit(1)), F.split_part(stem, F.lit("__"), F.lit(2))


def exercise_prompt(question: Column, starter: Column, tests: Column, solutions: Column) -> Column:
    """A programming exercise with its first solution: call-based if the tests name a function. tests and solutions
    are JSON; malformed ones count as absent."""
    named = F.length(F.coalesce(F.get_json_object(tests, "$.fn_name"), F.lit(""))) > 0
    use = F.when(named, "\nUse Call-Based format").otherwise("\nUse Standard Input format")
    first = F.coalesce(F.try_element_at(F.from_json(solutions, "array<string>"), F.lit(1)), F.lit(""))
    return F.concat(F.lit("\nQUESTION:\n"), question, F.coalesce(starter, F.lit("")), use, F.lit("\nANSWER:\n"), first)


def first_per_language(solutions: Column, languages: Column, names: Mapping[int, str] = CONTEST_LANGUAGES) -> Column:
    """The first solution of each language, in order: array of struct(language, solution)."""
    name = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    pairs = F.transform(F.arrays_zip(solutions.alias("s"), languages.alias("l")), lambda p: F.struct(F.try_element_at(name, p["l"]).alias("language"), p["s"].alias("solution")))
    return F.aggregate(pairs, F.array().cast("array<struct<language:string,solution:string>>"), lambda a, p: F.when(F.exists(a, lambda x: x["language"].eqNullSafe(p["language"])), a).otherwise(F.concat(a, F.array(p))))


def contest_text(description: Column, firsts: Column) -> Column:
    shown = F.transform(firsts, lambda p: F.concat(F.lit("Solution ("), F.coalesce(p["language"], F.lit("")), F.lit("):"), p["solution"], F.lit("\n")))
    return F.regexp_replace(F.concat(description, F.lit("\n"), F.array_join(shown, "")), r"^\s+|\s+$", "")


def answered(turns: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role", text: str = "text", asks: str = "user", answers: str = "assistant") -> DataFrame:
    """key, order, content: each question that an answer follows directly, and the answer, a line each.

    The window holds a conversation's turns, which are few; order is unique within a key.
    """
    w = Window.partitionBy(key).orderBy(order)
    paired = turns.withColumns({"__next": F.lead(text).over(w), "__next_role": F.lead(role).over(w)})
    return paired.filter((F.col(role) == asks) & (F.col("__next_role") == answers)).select(key, order, F.concat_ws("\n", text, "__next").alias("content"))


def task_texts(rows: DataFrame) -> DataFrame:
    """task_name, task_description, language_name, code -> content per task, its solutions by language and code."""
    shown = F.concat(F.lit("Language: "), "language_name", F.lit("\n"), "code")
    one = rows.groupBy("task_name", "task_description").agg(F.sort_array(F.collect_list(F.struct("language_name", "code", shown.alias("shown")))).alias("s"))
    return one.select("task_name", F.concat("task_name", F.lit("\n"), "task_description", F.lit("\n\n"), F.array_join(F.transform("s", lambda x: x["shown"]), "\n\n")).alias("content"))


def token_stats(df: DataFrame, text: str, *by: str) -> DataFrame:
    """n, n_tokens (split at white space), millions and mean of each group."""
    n = F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(r"\S+")).cast("long")
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.sum(n).alias("n_tokens"), (F.sum(n) / 1e6).alias("millions"), F.avg(n).alias("mean"))


def histogram(df: DataFrame, value: str, low: float, high: float, bins: int) -> DataFrame:
    """bin (0 below, bins + 1 from high on), n, density over the range."""
    width = (high - low) / bins
    all_rows = df.filter(F.col(value).isNotNull()).select(F.width_bucket(F.col(value).cast("double"), F.lit(low), F.lit(high), F.lit(bins)).alias("bin"))
    inside = F.col("bin").between(1, bins)
    counts = all_rows.groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum(F.when(inside, F.col("n"))).alias("__all"))
    return counts.join(F.broadcast(total), F.lit(True)).select("bin", "n", F.when(inside, F.col("n") / F.col("__all") / width).alias("density"))
