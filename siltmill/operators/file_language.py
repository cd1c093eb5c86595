"""The language of a source file: by its name, its first line, its suffix, and by its tokens where a suffix is that of
several languages.

The cascade is a column expression over tables of rules. What it leaves open is decided among the suffix's languages by
a naive Bayes classifier of hashed tokens that is fitted, in one pass, on all files that the cascade decides.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hashed tokens; and languages that a fit may have.
BUCKETS = 1 << 14
MOST_LANGUAGES = 1000
_TOKEN = re.compile(rb"[^\W\d]+|[^\w\s]")


@dataclass(frozen=True)
class Rules:
    """Languages by whole name, by the interpreter that a first line names, and by suffix (lower case, with its dot)."""

    names: Mapping[str, str]
    interpreters: Mapping[str, str]
    suffixes: Mapping[str, tuple[str, ...]]


# Common names, interpreters and suffixes of source files.
SOURCE_RULES = Rules(
    names={"CMakeLists.txt": "CMake", "Dockerfile": "Dockerfile", "Gemfile": "Ruby", "Jenkinsfile": "Groovy", "Makefile": "Makefile", "Rakefile": "Ruby", "SConstruct": "Python", "go.mod": "Go Module", "meson.build": "Meson"},
    interpreters={"awk": "Awk", "bash": "Shell", "lua": "Lua", "node": "JavaScript", "perl": "Perl", "php": "PHP", "python": "Python", "Rscript": "R", "ruby": "Ruby", "sh": "Shell", "zsh": "Shell"},
    suffixes={
        ".c": ("C",), ".cc": ("C++",), ".clj": ("Clojure",), ".cpp": ("C++",), ".cs": ("C#",), ".css": ("CSS",), ".d": ("D", "Makefile"), ".f90": ("Fortran",), ".fs": ("F#", "GLSL"), ".go": ("Go",), ".h": ("C", "C++", "Objective-C"),
        ".hs": ("Haskell",), ".html": ("HTML",), ".ipynb": ("Jupyter Notebook",), ".java": ("Java",), ".jl": ("Julia",), ".js": ("JavaScript",), ".json": ("JSON",), ".kt": ("Kotlin",), ".lua": ("Lua",), ".m": ("MATLAB", "Mathematica", "Objective-C"),
        ".md": ("Markdown",), ".ml": ("OCaml", "Standard ML"), ".php": ("PHP",), ".pl": ("Perl", "Prolog"), ".pm": ("Perl",), ".pro": ("IDL", "Prolog", "QMake"), ".py": ("Python",), ".r": ("R", "Rebol"), ".rb": ("Ruby",), ".rs": ("Rust", "XML"),
        ".scala": ("Scala",), ".sh": ("Shell",), ".sql": ("SQL",), ".swift": ("Swift",), ".tex": ("TeX",), ".ts": ("TypeScript", "XML"), ".v": ("Coq", "Verilog"), ".xml": ("XML",), ".yaml": ("YAML",), ".yml": ("YAML",),
    },
)
# End of fixed values.

#: The interpreter of a first line, past its path, `env` with its options, and the number of a version.
INTERPRETER = r"^#!\s*(?:[^\s]*/)?(?:env\s+(?:-[^\s]+\s+)*(?:[^\s]*/)?)?([A-Za-z]+)"


def _lookup(table: Mapping[str, tuple[str, ...]], key: Column) -> Column:
    if not table:
        return F.lit(None).cast("array<string>")
    return F.try_element_at(F.create_map(*[c for k, v in sorted(table.items()) for c in (F.lit(k), F.array(*map(F.lit, v)))]), key)


def cascade(name: Column, text: Column, rules: Rules = SOURCE_RULES) -> Column:
    """struct<how string, candidates array<string>>: the first of name, first_line and suffix that a rule knows. A name's path
    does not count; of two dotted suffixes the longer one is tried first. Both null where no rule fits."""
    base = F.regexp_extract(F.coalesce(name, F.lit("")), r"([^/]*)$", 1)
    one = lambda table: {k: (v,) for k, v in table.items()}
    first = F.regexp_extract(F.substring_index(F.coalesce(text, F.lit("")), "\n", 1), INTERPRETER, 1)
    suffix = lambda dots: F.lower(F.regexp_extract(base, r".((?:\.[^.]*)" + f"{{{dots}}})$", 1))
    found = {"name": _lookup(one(rules.names), base), "first_line": _lookup(one(rules.interpreters), first), "suffix": F.coalesce(_lookup(rules.suffixes, suffix(2)), _lookup(rules.suffixes, suffix(1)))}
    return F.coalesce(*[F.when(c.isNotNull(), F.struct(F.lit(how).alias("how"), c.alias("candidates"))) for how, c in found.items()])


def bucket_counts(text: str | None) -> np.ndarray:
    """How often each bucket's tokens occur: words without digits, and single signs."""
    found = _TOKEN.findall((text or "").encode("utf-8", "replace"))
    return np.bincount(np.fromiter((zlib.crc32(t) % BUCKETS for t in found), np.int64, len(found)), minlength=BUCKETS)


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows language, bucket, n of a task; bucket -1 counts files."""
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        for language, text in zip(batch["language"], batch["text"]):
            total = totals.setdefault(language, np.zeros(BUCKETS + 1, np.int64))
            total[1:] += bucket_counts(text)
            total[0] += 1
    for language, total in totals.items():
        at = np.flatnonzero(total)
        yield pd.DataFrame({"language": language, "bucket": at - 1, "n": total[at]})


@dataclass
class TokenModel:
    """Logarithms of a language's share of the files and of each bucket's share of its tokens, smoothed by one."""

    languages: dict[str, int]
    shares: np.ndarray
    buckets: np.ndarray

    def best(self, text: str, candidates: list[str]) -> str:
        """The likeliest of the candidates that the model knows, the first one in order if it knows none."""
        known = sorted(c for c in candidates if c in self.languages)
        if not known:
            return sorted(candidates)[0]
        rows = [self.languages[c] for c in known]
        return known[int(np.argmax(self.shares[rows] + self.buckets[rows] @ bucket_counts(text)))]


def fit(files: DataFrame) -> TokenModel:
    """Of all rows language, text with both. What reaches the driver is bounded by MOST_LANGUAGES and BUCKETS."""
    rows = files.filter("language IS NOT NULL AND text IS NOT NULL")
    names = [r[0] for r in rows.select("language").distinct().limit(MOST_LANGUAGES + 1).collect()]
    if len(names) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    places = {x: i for i, x in enumerate(sorted(names))}
    counts = np.zeros((len(names), BUCKETS + 1))
    sums = rows.select("language", "text").mapInPandas(_counted, "language string, bucket long, n long").groupBy("language", "bucket").agg(F.sum("n").alias("n")).toArrow()
    counts[[places[x] for x in sums["language"].to_pylist()], sums["bucket"].to_numpy() + 1] = sums["n"].to_numpy()
    tokens = counts[:, 1:] + 1
    shares = np.log(counts[:, 0] + 1e-300) - np.log(counts[:, 0].sum() + 1e-300)
    return TokenModel(places, shares, np.log(tokens) - np.log(tokens.sum(axis=1, keepdims=True)))


def identify(files: DataFrame, name_col: str = "name", text_col: str = "content", rules: Rules = SOURCE_RULES) -> DataFrame:
    """files with language and how (name, first_line, suffix, tokens; both null where no rule knows the file).

    Tokens decide among the languages of an ambiguous suffix; a null or empty text has none, and the language of most
    files wins. Without a file that the cascade decides, the first of the languages in order does. Rows may repeat; an
    empty table stays empty; columns named language or how are replaced.
    """
    seen = files.withColumn("__c", cascade(F.col(name_col), F.col(text_col), rules))
    only = F.when(F.size("__c.candidates") == 1, F.get("__c.candidates", F.lit(0)))
    model = files.sparkSession.sparkContext.broadcast(fit(seen.select(only.alias("language"), F.col(text_col).alias("text"))))

    def choose(texts: pd.Series, candidates: pd.Series) -> pd.Series:
        return pd.Series([None if c is None else model.value.best(t or "", list(c)) for t, c in zip(texts, candidates)], dtype=object)

    open_ = F.size("__c.candidates") > 1
    by_tokens = F.pandas_udf(choose, "string")(F.when(open_, F.col(text_col)), F.when(open_, F.col("__c.candidates")))
    decided = seen.withColumn("__t", by_tokens)
    return decided.withColumns({"language": F.coalesce(only, F.col("__t")), "how": F.when(open_, F.lit("tokens")).otherwise(F.col("__c.how"))}).drop("__c", "__t")
