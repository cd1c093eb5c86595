"""Vendored and generated files: path patterns met by equality on prefixes, parts and suffixes, and the shape of lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rules up to which their table is broadcast; beyond, it is joined.
MOST_BROADCAST = 100_000

# Label, kind, pattern. A `folder` stands anywhere in the path, a `root` begins it, a `name` is the file's,
# a `suffix` ends the name and begins with a dot.
FILE_RULES: Sequence[tuple[str, str, str]] = (
    *(("vendored", "folder", x) for x in ("bower_components", "deps", "external", "externals", "extern", "node_modules", "site-packages", "third-party", "third_party", "thirdparty", "vendor", "vendors", "Pods", "Carthage")),
    *(("vendored", "root", x) for x in ("dist/", "cache/", ".yarn/releases/", "debian/", "gradle/wrapper/")),
    *(("vendored", "name", x) for x in ("configure", "config.guess", "config.sub", "gradlew", "gradlew.bat", "install-sh", "jquery.js", "ltmain.sh", "mvnw")),
    *(("vendored", "suffix", x) for x in (".min.js", ".min.css", ".bundle.js")),
    *(("generated", "name", x) for x in ("Cargo.lock", "Gopkg.lock", "Pipfile.lock", "composer.lock", "glide.lock", "go.sum", "npm-shrinkwrap.json", "package-lock.json", "poetry.lock", "yarn.lock")),
    *(("generated", "suffix", x) for x in (".designer.cs", ".g.dart", ".js.map", ".css.map", ".nib", ".pb.go", ".pb.h", ".pb.cc", ".pbxproj", ".xcworkspacedata", "_pb2.py", "_pb2_grpc.py")),
    *(("generated", "folder", x) for x in ("__generated__", "zz_generated")),
)
#: What one of the first lines of a generated file says, in any case.
GENERATED_LINE = r"(?i)(do not edit|@generated|auto-?generated|generated by|this file was generated|automatically generated)"
# End of fixed values.
HEAD_LINES = 5
#: Source files of a longer mean line than this are minified.
LONG_LINES = 110


def path_keys(path: Column) -> Column:
    """kind:pattern of everything by which a rule could meet the path: its folders, what it begins with, its name and every
    suffix of the name from a dot or an underscore on. As many keys as the path has parts and the name dots."""
    parts = F.filter(F.split(F.coalesce(path, F.lit("")), "/"), lambda x: x != "")
    name = F.coalesce(F.element_at(F.when(F.size(parts) > 0, parts), -1), F.lit(""))
    folders = F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0)))
    roots = F.transform(folders, lambda _, i: F.concat(F.array_join(F.slice(folders, F.lit(1), i + 1), "/"), F.lit("/")))
    places = F.filter(F.sequence(F.lit(1), F.length(name) + 1), lambda i: F.substr(name, i, F.lit(1)).isin(".", "_"))
    tagged = lambda kind, xs: F.transform(xs, lambda x: F.concat(F.lit(f"{kind}:"), x))
    return F.array_distinct(F.concat(tagged("folder", folders), tagged("root", roots), tagged("name", F.array(name)), tagged("suffix", F.transform(places, lambda i: F.substr(name, i)))))


def labelled_paths(files: DataFrame, rules: Sequence[tuple[str, str, str]] | DataFrame = FILE_RULES, path_col: str = "path") -> DataFrame:
    """path, labels (sorted, distinct) of each path that a rule meets, once. Rules are (label, kind, pattern), as a table if
    they are many. Paths compare by their bytes; a null or empty path meets nothing."""
    spark = files.sparkSession
    table = rules if isinstance(rules, DataFrame) else spark.createDataFrame(list(rules), "label string, kind string, pattern string")
    keyed = table.select(F.concat_ws(":", "kind", "pattern").alias("__key"), "label").distinct()
    if not isinstance(rules, DataFrame) and len(rules) <= MOST_BROADCAST:
        keyed = F.broadcast(keyed)
    met = files.select(F.col(path_col).alias("path")).distinct().select("path", F.explode(path_keys(F.col("path"))).alias("__key")).join(keyed, "__key")
    return met.groupBy("path").agg(F.sort_array(F.collect_set("label")).alias("labels"))


def line_shape(text: Column) -> Column:
    """struct<n_lines long, longest long, mean_line double, says_generated boolean> of a whole text; lines end at line feeds, an
    empty or null text has none."""
    lines = F.when(F.coalesce(F.length(text), F.lit(0)) > 0, F.split(text, "\n", -1)).otherwise(F.array().cast("array<string>"))
    sizes = F.transform(lines, F.length)
    n = F.size(lines)
    mean = F.when(n > 0, (F.length(text) - (n - 1)) / n).otherwise(F.lit(0.0))
    head = F.exists(F.slice(lines, F.lit(1), F.lit(HEAD_LINES)), lambda x: x.rlike(GENERATED_LINE))
    return F.struct(n.cast("long").alias("n_lines"), F.coalesce(F.array_max(sizes), F.lit(0)).cast("long").alias("longest"), mean.alias("mean_line"), F.coalesce(head, F.lit(False)).alias("says_generated"))


def labelled_files(files: DataFrame, rules: Sequence[tuple[str, str, str]] | DataFrame = FILE_RULES, path_col: str = "path", text_col: str = "content", minified: Sequence[str] = (".js", ".css")) -> DataFrame:
    """files with is_vendor and is_generated: by a rule on the path, by what the first lines say, or by lines of over
    LONG_LINES characters on average in files of a minified suffix. Null paths and texts are neither; rows may repeat."""
    labels = labelled_paths(files, rules, path_col).select(F.col("path").alias("__path"), "labels")
    shape = line_shape(F.col(text_col))
    dense = F.coalesce(F.lower(path_col).rlike("(" + "|".join(x.replace(".", r"\.") for x in minified) + ")$"), F.lit(False)) if minified else F.lit(False)
    has = lambda label: F.coalesce(F.array_contains("labels", label), F.lit(False))
    joined = files.join(labels, F.col(path_col) == F.col("__path"), "left")
    generated = has("generated") | shape["says_generated"] | (dense & (shape["mean_line"] > LONG_LINES))
    return joined.withColumns({"is_vendor": has("vendored"), "is_generated": generated}).drop("__path", "labels")
