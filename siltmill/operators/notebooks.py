"""Notebooks as scripts: cells, their outputs, segments, formatting and filters."""

from __future__ import annotations

import ast
import hashlib
import warnings
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltmill.functions.text import cap_output, clean_code, clean_markdown, csv_path, is_progress, let, strip_prefix
from siltmill.functions.values import by_value
from siltmill.operators.dedup import uniform

EMPTY = "<empty>"
MOST_ROWS = MOST_COLUMNS = 5
MOST_CONTENT, LEAST_SCRIPT, LEAST_CELLS = 5_000_000, 100, 4
#: A text in a notebook is a string or a list of strings; either way it is read as the JSON that it is.
CELLS = "array<struct<cell_type: string, source: string, outputs: array<struct<text: string, data: map<string, string>>>>>"


def joined(text: Column) -> Column:
    """A string, or a JSON list of strings as one string."""
    return F.when(text.startswith("["), F.coalesce(F.array_join(F.from_json(text, "array<string>"), ""), text)).otherwise(text)


class _Table(HTMLParser):
    def __init__(self) -> None:
        super().__init__()
        self.rows: list[list[tuple[str, str]]] = []
        self.cell: list[str] | None = None
        self.tables = 0

    def handle_starttag(self, tag, attrs) -> None:  # noqa: ANN001
        self.tables += tag == "table"
        if self.tables != 1:
            return
        if tag == "tr":
            self.rows.append([])
        elif tag in ("th", "td"):
            self.end_cell()
            if self.rows:
                self.cell = []
                self.rows[-1].append((tag, ""))

    def end_cell(self) -> None:
        if self.cell is not None:
            kind, _ = self.rows[-1].pop()
            self.rows[-1].append((kind, "".join(self.cell).strip().replace("\n", " ").replace("|", "&#124;")))
            self.cell = None

    def handle_endtag(self, tag) -> None:  # noqa: ANN001
        if tag in ("th", "td", "tr", "table"):
            self.end_cell()
        self.tables += 2 * (tag == "table")  # whatever follows the first table is not it

    def handle_data(self, data) -> None:  # noqa: ANN001
        if self.cell is not None and self.tables == 1:
            self.cell.append(data)


def markdown_of(html: str | None) -> str | None:
    """The first table as Markdown: at most five columns and, of more than five rows, five drawn ones, whose digests
    with the table's text are the smallest; empty without a table or rows."""
    if html is None:
        return None
    table = _Table()
    table.feed(html)
    table.end_cell()
    if not table.rows:
        return ""
    heads = [text for kind, text in table.rows[0] if kind == "th"][:MOST_COLUMNS]
    rows = [[text for kind, text in row if kind == "td"][:MOST_COLUMNS] for row in table.rows[1:]]
    if len(rows) > MOST_ROWS:
        drawn = sorted(range(len(rows)), key=lambda i: hashlib.sha256(f"{i}|{html}".encode("utf-8", "surrogatepass")).digest())
        rows = [rows[i] for i in drawn[:MOST_ROWS]]
    rows = [r for r in rows if r]
    line = lambda cells: "| " + " | ".join(cells) + " |"
    return "\n".join(([line(heads), line(["---"] * len(heads))] if heads else []) + [line(r) for r in rows])


def table_markdown(html: Column) -> Column:
    def convert(texts: pd.Series) -> pd.Series:
        return texts.map(markdown_of, na_action="ignore")

    return F.pandas_udf(convert, "string")(html)


def is_table(kind: Column, text: Column) -> Column:
    return (kind == "text/html") & (text.contains("dataframe") | text.contains("<table"))


def output_text(outputs: Column, tables: Column) -> Column:
    """The text of a cell's outputs: tables as Markdown (tables: the converted HTML of each output, null if it is no
    table), else Markdown or LaTeX, else plain text without progress bars; pictures and scripts have none. EMPTY if
    there is nothing, and at most as long as an output may be."""
    trim = lambda t: F.regexp_replace(t, r"^\n+|\n+$", "")
    plain = lambda t: F.when(is_progress(t), F.lit("")).otherwise(F.concat(trim(t), F.lit("\n")))

    def one(o: Column, i: Column) -> Column:
        data = o["data"]
        rich = F.coalesce(F.try_element_at(data, F.lit("text/markdown")), F.try_element_at(data, F.lit("text/latex")))
        bare = F.concat(*[F.coalesce(plain(joined(F.try_element_at(data, F.lit(k)))), F.lit("")) for k in ("text/plain", "text/html")])
        spoken = F.when(data.isNotNull(), F.coalesce(tables[i], joined(rich), F.replace(bare, F.lit('"""'), F.lit(""))))
        return F.coalesce(spoken, F.concat(trim(joined(o["text"])), F.lit("\n")), F.lit(""))

    text = trim(F.array_join(F.transform(outputs, one), ""))
    return F.when(F.coalesce(F.length(text), F.lit(0)) == 0, EMPTY).otherwise(cap_output(text))


def cells_of(notebooks: DataFrame, content: str = "content", drop_share: float = 0.0, key: str = "file_id") -> DataFrame:
    """notebooks with cells: array of struct(cell_type, input, output), null where the content is no list of cells.

    Empty cells go. drop_share of the outputs are left out, by a digest of the key and the cell's place.
    """
    parsed = notebooks.withColumn("__cells", F.from_json(content, CELLS))
    html = lambda o: joined(F.try_element_at(o["data"], F.lit("text/html")))
    def convert(column: pd.Series) -> pd.Series:
        return column.map(lambda cells: None if cells is None else [[markdown_of(x) for x in (outputs if outputs is not None else [])] for outputs in cells])

    htmls = F.transform("__cells", lambda c: F.coalesce(F.transform(c["outputs"], lambda o: F.when(is_table(F.lit("text/html"), html(o)), html(o))), F.array().cast("array<string>")))
    # marked as not deterministic so that the optimizer leaves the call in a projection of its own, outside lambdas
    to_tables = F.pandas_udf(convert, "array<array<string>>").asNondeterministic()
    rendered = parsed.withColumn("__html", htmls).withColumn("__tables", to_tables("__html"))
    whole = F.filter(
        F.transform("__cells", lambda c, i: F.struct(c["cell_type"].alias("cell_type"), joined(c["source"]).alias("input"), F.coalesce(output_text(c["outputs"], F.col("__tables")[i]), F.lit(EMPTY)).alias("output"), i.alias("i"))),
        lambda c: F.length(c["input"]) > 0,
    )
    keep = lambda c: F.when(uniform(F.lit("output"), F.col(key), c["i"]) < drop_share, EMPTY).otherwise(c["output"])
    out = F.transform(whole, lambda c: F.struct(c["cell_type"].alias("cell_type"), c["input"].alias("input"), (keep(c) if drop_share else c["output"]).alias("output")))
    return rendered.withColumn("cells", out).drop("__cells", "__html", "__tables")


def segments(cells: Column) -> Column:
    """Runs of cells of one type without output between them, each as one cell with the output of its last."""

    def begins(c: Column, i: Column) -> Column:
        before, own = F.get(c, i - 1), F.get(c, i)
        return (i == 0) | (before["output"] != EMPTY) | (before["cell_type"] != own["cell_type"])

    def run(c: Column, starts: Column, at: Column, k: Column) -> Column:
        part = F.slice(c, at + 1, F.coalesce(F.get(starts, k + 1), F.size(c)) - at)
        return let(part, lambda p: F.struct(F.get(p, F.lit(0))["cell_type"].alias("cell_type"), F.array_join(F.transform(p, lambda x: x["input"]), "\n").alias("input"), F.element_at(p, -1)["output"].alias("output")))

    def runs(c: Column) -> Column:
        places = F.transform(c, lambda _, i: i)
        return let(F.filter(places, lambda i: F.coalesce(begins(c, i), F.lit(True))), lambda starts: F.transform(starts, lambda at, k: run(c, starts, at, k)))

    return let(cells, runs)


def formatted(cell: Column, with_results: bool = False) -> Column:
    """A segment's part of the script: code cleaned, Markdown as comments, results as a quoted example if wanted."""
    prose = clean_markdown(cell["input"])
    comments = F.array_join(F.transform(F.split(prose, "\n", -1), lambda x: F.concat(F.lit("# "), F.trim(x))), "\n")
    code = cell["cell_type"] == "code"
    body = F.when(code, clean_code(cell["input"])).when(cell["cell_type"] == "markdown", F.when(prose != "", comments).otherwise(F.lit(""))).otherwise(F.lit(""))
    shown = cell["output"] != EMPTY
    lines = F.split(cell["output"], "\n", -1)
    cut = F.when(F.size(lines) >= 5, F.concat(F.slice(lines, 1, 5), F.array(F.lit("...")))).otherwise(lines)
    result = F.when(shown, F.concat(F.lit('"""Example Output:\n'), F.array_join(cut, "\n"), F.lit('\n"""'))) if with_results else F.lit(None).cast("string")
    tail = F.when(body.contains("def "), F.lit("\n")).otherwise(F.lit(""))
    alone = F.when(code, F.concat(body, F.lit("\n"), tail)).otherwise(F.concat(F.lit("\n"), body, F.lit("\n"), tail))
    return F.when(body == "", F.lit("")).when(result.isNotNull(), F.concat(body, F.lit("\n"), result, F.lit("\n\n"))).when(shown & ~code, F.lit("")).otherwise(alone)


def script(cells: Column, with_results: bool = False) -> Column:
    """A notebook's script; empty for fewer than four cells or none of code. Markdown at the end goes."""
    s = segments(cells)
    kept = F.when(F.try_element_at(s, F.lit(-1))["cell_type"] == "markdown", F.slice(s, F.lit(1), F.greatest(F.size(s) - 1, F.lit(0)))).otherwise(s)
    text = F.array_join(F.transform(kept, lambda c: formatted(c, with_results)), "")
    return F.when((F.size(cells) >= LEAST_CELLS) & F.exists(s, lambda c: c["cell_type"] == "code"), text).otherwise(F.lit(""))


def _compiles(code: str | None) -> bool:
    try:
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            compile(code or "", "<script>", "exec", dont_inherit=True)
    except Exception:
        return False
    return True


def compiles(code: Column) -> Column:
    """Whether a text is a Python program."""
    return by_value(_compiles, pa.bool_(), "boolean")(code)


def _read_csv(code: str | None) -> list[str]:
    bare = "\n".join(x for x in (code or "").splitlines() if not x.startswith("%"))
    try:
        tree = ast.parse(bare)
    except Exception:
        return []
    calls = (n for n in ast.walk(tree) if isinstance(n, ast.Call) and getattr(n.func, "attr", None) == "read_csv" and n.args)
    return [n.args[0].value.strip() for n in calls if isinstance(n.args[0], ast.Constant) and isinstance(n.args[0].value, str)]


def read_csv_paths(code: Column) -> Column:
    """Literal first arguments of a program's read_csv calls; lines of magics are left out before it is parsed."""
    return by_value(_read_csv, pa.list_(pa.string()), "array<string>")(code)


def dataset_paths(files: Column) -> Column:
    """Distinct data set paths among file names."""
    return F.array_distinct(F.array_compact(F.transform(files, csv_path)))


def scripts(notebooks: DataFrame, templates: tuple[str, ...] = (), with_results: bool = False) -> dict[str, DataFrame]:
    """The table after each step: original, parsed (not too long, a script of some length), compiled."""
    parsed = cells_of(notebooks.filter(F.length("content") <= MOST_CONTENT)).withColumn("script", script(F.col("cells"), with_results)).drop("cells")
    long = parsed.filter(F.length("script") > LEAST_SCRIPT)

    def compiled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[batch["script"].map(_compiles)]

    good = long.mapInPandas(compiled, long.schema)
    for t in templates:
        good = good.withColumn("script", strip_prefix(F.col("script"), t))
    return {"original": notebooks, "parsed": long, "compiled": good}
