"""Text expressions. All are columns of built-in functions; none of them runs Python per row."""

from __future__ import annotations

from collections.abc import Callable
from keyword import kwlist

from pyspark.sql import Column
from pyspark.sql import functions as F

TRUNCATED = "[TRUNCATED]"

# Patterns of texts that mail clients add to replies.
MAIL_REPLIES = (
    r"(?s)^(.*)From:.+Reply to this email directly.+view it on GitHub(.*)\n?(.*)",
    r"(?s)^(.*)On.+notifications@github.com.+wrote:.+Reply to this email directly.+view it on GitHub(.*)\n?(.*)",
    r"(?s)^(.*)Signed-off-by: .+<.+>(.*?)\n?(.*)",
)
MAIL_DATE = r"\d+/\d+/\d+ \d{2}:\d{2} [AP]M.+wrote"
# Phrases of notebook templates.
CODE_PHRASES = (
    "This Python 3 environment comes",
    "here's several helpful packages to load",
    "defined by the kaggle/python docker image",
    "defined by the kaggle/python Docker image",
    "Copyright (C)",
)
MARKDOWN_PHRASES = (
    "IntroductionGreetings from the Kaggle bot!",
    "Kaggle bot",
    "Kaggle kerneler bot",
    "automatically-generated",
    "clicking run or pressing Shift+Enter",
    "https://www.kaggle.com/learn/python",
    "Thank You",
)
SHELL_STARTS = ("%", "!", "cd ", "pip ", "apt ", "wget ")
CSV_PATHS = (r"\.\./input/((?:[^/]+/)+[^/]+\.csv)", r"kaggle/input/((?:[^/]+/)+[^/]+\.csv)", r"/kaggle/input/((?:[^/]+/)+[^/]+\.csv)")
# End of fixed values.

LONGEST_LINE = 600
LONGEST_OUTPUT = 600


def let(value: Column, body) -> Column:  # noqa: ANN001
    """body(value) with the value computed once, however often body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def utf8_text(raw: Column) -> Column:
    """Bytes as text; malformed sequences become the replacement character instead of an error."""
    return F.make_valid_utf8(raw.cast("string"))


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


_SEPARATOR = "[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"


def once(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), with value computed once however often it occurs there."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def split_lines(text: Column) -> Column:
    """Lines by any line separator; a separator at the end begins no line, and an empty text has none."""
    parts = F.split(F.replace(text, F.lit("\r\n"), F.lit("\n")), _SEPARATOR, -1)
    return once(parts, lambda p: F.when(F.get(p, F.size(p) - 1) == "", F.slice(p, F.lit(1), F.size(p) - 1)).otherwise(p))


def base_path(path: Column) -> Column:
    return F.regexp_extract(path, "^(.*/)", 1)


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/", -1), -1)


def suffix(path: Column) -> Column:
    """The last extension of a file name without its dot; a leading dot begins a name."""
    return F.regexp_extract(base_name(path), r"^.+\.([^.]+)$", 1)


def repo_of_url(url: Column, host: str = "github.com") -> Column:
    return F.regexp_extract(url, rf"https://{host.replace('.', chr(92) + '.')}/([^/]+/[^/]+)", 1)


def pull_guid(url: Column) -> Column:
    """owner/repo/pull/number of an API address that ends in owner/repo/pulls/number."""
    parts = F.split(url, "/", -1)
    return F.concat_ws("/", F.try_element_at(parts, F.lit(-4)), F.try_element_at(parts, F.lit(-3)), F.lit("pull"), F.try_element_at(parts, F.lit(-1)))


def bucket(key: Column, digits: int = 3) -> Column:
    """The first hex digits of the key's SHA-256: 16^digits buckets."""
    return F.substring(F.upper(F.sha2(key.cast("string").cast("binary"), 256)), 1, digits)


def truncate_lines(text: Column, most: int = 80, tail: int = 20) -> Column:
    """A text of more than `most` lines as its first most - tail lines, a marker, and its last `tail`."""
    lines = lines_of(text)
    short = F.concat(F.slice(lines, 1, most - tail), F.array(F.lit(TRUNCATED)), F.slice(lines, -tail, tail))
    return F.when(F.size(lines) > most, F.array_join(short, "\n")).otherwise(text)


def drop_markup_comments(text: Column) -> Column:
    """Without <!-- comments -->; an unclosed one loses its mark only."""
    return F.array_join(F.transform(F.split(text, "<!--", -1), lambda x: F.element_at(F.split(x, "-->", -1), -1)), "")


def strip_mail(text: Column, strict: bool = False) -> Column:
    """A reply without what mail clients add: by whole patterns, else line by line; page breaks go as well.

    Line by line, what stands before a quoting line and after the last line of a footer or quotation stays. Where no
    end is found, all lines follow those before the start, which repeats them; strict leaves them once.
    """

    def by_lines(whole: Column) -> Column:
        lines = F.transform(lines_of(whole), lambda x, i: F.struct(x.alias("line"), F.regexp_replace(x, r"^\s+|\s+$", "").alias("bare"), i.alias("i")))
        return let(lines, lambda ls: let(bounds(ls), lambda b: joined(ls, b)))

    def bounds(lines: Column) -> Column:
        starts = F.filter(lines, lambda x: x["bare"].contains("notifications@github.com") | x["bare"].rlike(MAIL_DATE))
        ends = F.filter(lines, lambda x: x["bare"].contains("Reply to this email directly") | x["bare"].startswith(">"))
        end_of = lambda x: F.when(x["bare"].contains("Reply to this email directly") & x["bare"].endswith(":") & ~x["bare"].startswith(">"), x["i"] + 1).otherwise(x["i"])
        start = F.coalesce(F.array_max(F.transform(starts, lambda x: x["i"])), F.lit(0))
        end = F.get(F.transform(F.slice(ends, F.greatest(F.size(ends), F.lit(1)), F.lit(1)), end_of), F.lit(0))
        return F.struct(start.alias("start"), F.coalesce(end, start - 1 if strict else F.lit(-1)).alias("end"))

    def joined(lines: Column, b: Column) -> Column:
        kept = F.concat(F.filter(lines, lambda x: x["i"] < b["start"]), F.filter(lines, lambda x: x["i"] > b["end"]))
        return F.array_join(F.transform(kept, lambda x: x["line"]), "\n")

    def stripped(whole: Column) -> Column:
        out = by_lines(whole)
        for pattern in reversed(MAIL_REPLIES):
            out = F.when(whole.rlike(pattern), F.concat(F.regexp_extract(whole, pattern, 1), F.regexp_extract(whole, pattern, 3))).otherwise(out)
        return F.regexp_replace(F.regexp_replace(out, "_{20,}", ""), r"^\s+|\s+$", "")

    return let(F.regexp_replace(F.coalesce(text, F.lit("")), r"^\s+|\s+$", ""), stripped)


def anonymised(text: Column, names: Column) -> Column:
    """text with every name, in first-seen order, as username_0, username_1, …; names inside words are replaced too."""
    numbered = F.transform(F.array_distinct(F.array_compact(names)), lambda x, i: F.struct(x.alias("old"), F.concat(F.lit("username_"), i.cast("string")).alias("new")))
    return F.aggregate(numbered, text, lambda t, n: F.when(n["old"] == "", t).otherwise(F.replace(t, n["old"], n["new"])))


def shifted_hunk(header: Column, skipped: Column) -> Column:
    """`@@ -a,b +c,d @@ rest` with both starts lowered; null if a start would fall below 0 or the header is none."""
    part = lambda k: F.regexp_extract(header, r"@@ -(\d+)(,\d+)? \+(\d+)(,\d+)? @@(?s)(.*)", k)
    old, new = part(1).cast("long") - skipped, part(3).cast("long") - skipped
    text = F.concat(F.lit("@@ -"), old.cast("string"), part(2), F.lit(" +"), new.cast("string"), part(4), F.lit(" @@"), part(5))
    return F.when(header.rlike(r"@@ -\d+(,\d+)? \+\d+(,\d+)? @@"), F.when((old >= 0) & (new >= 0), text))


def _any_phrase(text: Column, phrases: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for p in phrases:
        found = found | text.contains(p)
    return found


def clean_markdown(text: Column) -> Column:
    """Without tags, with single line breaks; empty if a template's phrase is in it."""
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, "<.*?>", ""), "\r\n", "\n"), "\n+", "\n")
    return F.when(_any_phrase(bare, MARKDOWN_PHRASES), F.lit("")).otherwise(bare)


def clean_code(text: Column) -> Column:
    """Without blank lines, magics, shell lines, overlong lines and lines of templates."""

    def stays(line: Column) -> Column:
        bare = F.regexp_replace(line, r"^\s+|\s+$", "")
        shell = F.lit(False)
        for start in SHELL_STARTS:
            shell = shell | bare.startswith(start)
        return (bare != "") & ~shell & (F.length(bare) <= LONGEST_LINE) & ~_any_phrase(bare, CODE_PHRASES)

    return F.array_join(F.filter(lines_of(text), stays), "\n")


def is_progress(text: Column) -> Column:
    return text.contains(", ?B/s]") | text.contains("." * 16)


def cap_output(text: Column, most: int = LONGEST_OUTPUT) -> Column:
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most), F.lit("..."))).otherwise(text)


def csv_path(path: Column) -> Column:
    """The data set path inside a notebook's file name, by the first pattern that fits; else null."""
    return F.coalesce(*[F.nullif(F.regexp_extract(path, p, 1), F.lit("")) for p in CSV_PATHS])


def strip_prefix(text: Column, prefix: str) -> Column:
    return F.when(text.startswith(prefix), F.regexp_replace(F.substring(text, len(prefix) + 1, 1 << 30), r"^\s+|\s+$", "")).otherwise(text)


def split_before(text: Column, marks: tuple[str, ...]) -> Column:
    """Pieces of a text that begin at any of the marks."""
    safe = "|".join("\\Q" + m + "\\E" for m in marks)
    return F.filter(F.split(text, f"(?=(?:{safe}))", -1), lambda x: x != "")


def is_identifier(line: Column) -> Column:
    """Whether a line is one expression without spaces that begins like a name: of word characters, dots, parentheses
    and plus signs, and no keyword of Python."""
    bare = F.regexp_replace(line, r"^\s+|\s+$", "")
    return bare.rlike(r"^\w[\w.()+]*$") & ~bare.isin(*kwlist)
