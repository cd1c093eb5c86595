"""Statistics of file contents and the filters on them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltmill.functions.text import once, split_lines

LEAST_ALPHANUM, MOST_HEX, MOST_LINES, MOST_AVERAGE, MOST_LENGTH = 0.25, 0.25, 100_000, 100, 1000
# Languages of documents, and words that an English text has.
DOCUMENT_LANGUAGES = ("Markdown", "reStructuredText", "RMarkdown", "RDoc", "AsciiDoc")
ENGLISH = r"\s+(the|be|to|of|and|that|have|with)\s+"


def content_stats(text: Column) -> Column:
    """struct of alphanum_fraction, alpha_fraction, hex_fraction, num_lines, avg_line_length, max_line_length.

    All are 0 for an empty text and null for a null one.
    """
    n = F.length(text)
    zero = lambda c, kind: F.when(n == 0, F.lit(0).cast(kind)).when(n > 0, c.cast(kind))
    share = lambda left: zero((n - left).cast("double") / n, "double")
    without = lambda value, kind: F.regexp_replace(value, rf"\p{{{kind}}}+", "")
    # Letters are taken out of the whole text, digits only out of the rest.
    rest = once(without(text, "L"), lambda other: F.struct(F.length(without(other, "N")).alias("symbols"), F.length(other).alias("others")))
    sizes = once(F.transform(split_lines(text), F.length), lambda of: F.struct(F.size(of).alias("n"), F.aggregate(of, F.lit(0).cast("long"), lambda x, y: x + y).alias("sum"), F.array_max(of).alias("max")))
    told = lambda rest, sizes: F.struct(
        share(rest["symbols"]).alias("alphanum_fraction"),
        share(rest["others"]).alias("alpha_fraction"),
        share(F.length(F.replace(text, F.lit("\\x"), F.lit("")))).alias("hex_fraction"),
        zero(sizes["n"], "long").alias("num_lines"),
        zero(F.try_divide(sizes["sum"].cast("double"), sizes["n"]), "double").alias("avg_line_length"),
        zero(sizes["max"], "long").alias("max_line_length"),
    )
    return once(F.struct(rest.alias("rest"), sizes.alias("sizes")), lambda x: told(x["rest"], x["sizes"]))


def is_valid(text: Column, language: Column, path: Column | None = None, languages: tuple[str, ...] | None = None, dependency_files: tuple[str, ...] | None = None) -> Column:
    """Whether a file is worth keeping: mostly letters and digits, few hex escapes, no overlong lines unless it is a
    document, and English words if it is Markdown. With both lists given, the language or the file name must be in one."""
    document = F.coalesce(language.isin(*DOCUMENT_LANGUAGES), F.lit(False))
    listed = F.lit(True)
    if languages is not None and dependency_files is not None and path is not None:
        listed = F.coalesce(language.isin(*languages), F.lit(False)) | F.element_at(F.split(path, "/", -1), -1).isin(*dependency_files)
    english = ~F.coalesce(language == "Markdown", F.lit(False)) | text.rlike(ENGLISH)

    def passes(s: Column) -> Column:
        short = (s["avg_line_length"] < MOST_AVERAGE) & (s["max_line_length"] < MOST_LENGTH)
        return (s["hex_fraction"] < MOST_HEX) & (s["num_lines"] < MOST_LINES) & (document | short) & (s["alphanum_fraction"] > LEAST_ALPHANUM)

    return once(content_stats(text), passes) & listed & english


def valid_files(files: Column, text: str = "base_content", language: str = "base_language") -> Column:
    """The valid ones of an array of file structs; null if none is."""
    kept = F.filter(files, lambda f: F.coalesce(is_valid(f[text], f[language]), F.lit(False)))
    return F.when(F.size(kept) > 0, kept)


def markdown_share(types: Column) -> Column:
    return F.try_divide(F.size(F.filter(types, lambda t: t == "markdown")).cast("double"), F.size(types))
