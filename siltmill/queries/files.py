"""What is found out about single files: licenses, language, vendored and generated ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltmill.operators import charsets, file_language, passages, path_labels
from siltmill.sources.readers import table

QUERIES, ORACLE = {}, {}


def query(sql: str | None):  # noqa: ANN201
    def add(f):  # noqa: ANN001, ANN202
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _values(rows) -> str:  # noqa: ANN001
    return ", ".join("(" + ", ".join("'" + x.replace("'", "''") + "'" for x in r) + ")" for r in rows)


_TEXTS = (*(("notice", *r) for r in passages.NOTICES), *(("text", *r) for r in passages.LICENSE_TEXTS))


def _prints(source: str, key: str, text: str) -> str:
    """SELECT of key and fingerprints in DuckDB's SQL."""
    return rf"""SELECT DISTINCT {key}, unnest(CASE WHEN len(g) = 0 THEN [] ELSE list_transform(range(1, greatest(len(g) - {passages.WINDOW - 1}, 1) + 1), lambda i: list_min(g[i:i + {passages.WINDOW - 1}])) END) AS print
  FROM (SELECT {key}, CASE WHEN len(w) = 0 THEN [] ELSE list_transform(range(1, greatest(len(w) - {passages.WIDTH - 1}, 1) + 1), lambda i: left(md5(array_to_string(w[i:i + {passages.WIDTH - 1}], ' ')), 16)) END AS g
  FROM (SELECT {key}, regexp_extract_all(translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{passages.WORDS}') AS w FROM {source}))"""


_HELD = f"""
WITH t(part, license, text) AS (VALUES {_values(_TEXTS)}), r AS (SELECT part, license, text, part || ':' || license AS ref FROM t),
a AS ({_prints("documents", "doc_id", "text")}), b AS ({_prints("r", "ref", "text")}),
n AS (SELECT ref, count(*) AS n FROM b GROUP BY ref),
h AS (SELECT doc_id, ref, count(*) AS shared, n FROM a JOIN b USING (print) JOIN n USING (ref) GROUP BY doc_id, ref, n HAVING count(*) >= {passages.LEAST} * n)"""


@query(f"{_HELD} SELECT doc_id, ref, shared, n AS \"of\" FROM h")
def license_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licenses' notices and texts that documents hold, whole or edited."""
    references = spark.createDataFrame([(f"{part}:{name}", text) for part, name, text in _TEXTS], "ref string, body string")
    return passages.held_passages(table(spark, sf_dir, "documents"), references, "doc_id", "text", "ref", "body")


@query(f"""{_HELD},
l AS (SELECT doc_id, array_to_string(list_sort(list(DISTINCT license)), ',') AS licenses FROM h JOIN r USING (ref) WHERE doc_id % 3 <> 1 GROUP BY doc_id)
SELECT doc_id AS blob_id, coalesce(licenses, '') AS licenses FROM documents LEFT JOIN l USING (doc_id)""")
def license_file_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files, two in three of which bear the name of a license file, with the licenses found in these."""
    name = F.when(F.col("doc_id") % 3 == 0, "LICENSE").when(F.col("doc_id") % 3 == 1, "main.py").otherwise("README.md")
    files = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("blob_id"), F.array(name).alias("filenames"), F.col("text").alias("content"))
    references = spark.createDataFrame([r[1:] for r in _TEXTS], "license string, text string")
    return passages.file_licenses(files, references).withColumn("licenses", F.array_join("licenses", ","))


_LANGUAGES = ("de", "en", "es", "fr")
#: Documents as files: a third are named by their language's suffix, some begin with an interpreter, the rest are open.
_TEXT_RULES = file_language.Rules({"NEWS": "en"}, {x: x for x in _LANGUAGES}, {**{f".{x}": (x,) for x in _LANGUAGES}, ".txt": _LANGUAGES, ".neue.txt": ("de",)})


def _named(docs: DataFrame) -> DataFrame:
    kind = F.col("doc_id") % 6
    suffix = F.when(kind < 2, F.concat(F.lit("."), "lang")).when(kind == 2, F.lit(".TXT")).when(kind == 3, F.lit(".neue.txt")).otherwise(F.lit(""))
    name = F.when((kind == 4) & (F.col("doc_id") % 4 == 0), F.concat("source", F.lit("/NEWS"))).otherwise(F.concat("source", F.lit("/f"), "doc_id", suffix))
    text = F.when(kind == 5, F.concat(F.lit("#!/usr/bin/env -S "), "lang", F.lit("3\n"), "text")).otherwise(F.col("text"))
    return docs.select("doc_id", "lang", name.alias("name"), text.alias("content"))


@query("""
SELECT doc_id, CASE WHEN k = 5 THEN 'first_line' WHEN k = 4 THEN CASE WHEN doc_id % 4 = 0 THEN 'name' END ELSE 'suffix' END AS how,
  CASE WHEN k IN (0, 1, 5) THEN lang WHEN k = 2 THEN 'de,en,es,fr' WHEN k = 3 THEN 'de' WHEN doc_id % 4 = 0 THEN 'en' END AS candidates
FROM (SELECT *, doc_id % 6 AS k FROM documents)""")
def file_language_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What name, first line and suffix say."""
    found = _named(table(spark, sf_dir, "documents")).select("doc_id", file_language.cascade(F.col("name"), F.col("content"), _TEXT_RULES).alias("c"))
    return found.select("doc_id", "c.how", F.array_join("c.candidates", ",").alias("candidates"))


@query(None)
def file_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files; what the cascade leaves open is decided by tokens, which it teaches itself."""
    return file_language.identify(_named(table(spark, sf_dir, "documents")), rules=_TEXT_RULES).select("doc_id", "name", "how", "language")


#: The rules of source trees, and some that paths of web pages meet.
_RULES = (*path_labels.FILE_RULES, ("vendored", "folder", "de"), ("vendored", "name", "825"), ("generated", "suffix", ".html"), ("vendored", "root", "m.ththth.example.net/en/"))


@query(rf"""
WITH v(label, kind, pattern) AS (VALUES {_values(_RULES)}),
p AS (SELECT page_id, coalesce(html, '') AS html, regexp_extract(url, '://([^?#]*)', 1) AS path, string_split(coalesce(html, ''), chr(10)) AS lines FROM pages),
s AS (SELECT *, list_filter(string_split(path, '/'), lambda x: x <> '') AS parts FROM p),
f AS (SELECT *, coalesce(parts[-1], '') AS name, parts[1:len(parts) - 1] AS folders FROM s),
l AS (SELECT DISTINCT page_id, label FROM f JOIN v ON kind = 'folder' AND list_contains(folders, pattern) OR kind = 'name' AND name = pattern OR kind = 'suffix' AND ends_with(name, pattern)
        OR kind = 'root' AND starts_with(array_to_string(folders, '/') || '/', pattern))
SELECT page_id, path, page_id IN (SELECT page_id FROM l WHERE label = 'vendored') AS is_vendor,
  page_id IN (SELECT page_id FROM l WHERE label = 'generated') OR len(list_filter(lines[1:{path_labels.HEAD_LINES}], lambda x: regexp_matches(x, '{path_labels.GENERATED_LINE}'))) > 0
    OR (ends_with(lower(path), '/') AND (length(html) - (len(lines) - 1)) / len(lines) > {path_labels.LONG_LINES}) AS is_generated
FROM f""")
def vendored_and_generated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages by their paths and the shape of their lines."""
    files = table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("url", "://([^?#]*)", 1).alias("path"), F.col("html").alias("content"))
    return path_labels.labelled_files(files, _RULES, minified=("/",)).select("page_id", "path", "is_vendor", "is_generated")


_CODECS = (charsets.UTF_8, *charsets.ENCODINGS)


@query(f"""
SELECT doc_id, text AS content, CASE WHEN strlen(text) = length(text) THEN '{charsets.UTF_8}' ELSE [{", ".join(f"'{x}'" for x in _CODECS)}][doc_id % {len(_CODECS)} + 1] END AS src_encoding FROM documents""")
def charset_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as bytes in five encodings by turns, decoded without being told which; ASCII is UTF-8."""
    docs = table(spark, sf_dir, "documents")
    same = (F.col("doc_id") % len(_CODECS) == 0) | (F.length("text") == F.octet_length("text"))  # ASCII is the same in all
    raw = F.when(same, F.col("text").cast("binary"))
    for i, codec in enumerate(charsets.ENCODINGS, 1):
        raw = raw.when(F.col("doc_id") % len(_CODECS) == i, charsets.encoded(F.col("text"), codec))
    return charsets.with_texts(docs.select("doc_id", raw.alias("raw")), "raw").select("doc_id", "content", "src_encoding")
