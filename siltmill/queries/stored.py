"""Tables written by each sink to the shared folder and read back by the readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltmill.operators import compiled, joins, notebooks, tree
from siltmill.sources import readers, sinks
from siltmill.sources.readers import table
from siltmill.storage import new_path

QUERIES, ORACLE = {}, {}


def query(sql: str | None):  # noqa: ANN201
    def add(f):  # noqa: ANN001, ANN202
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


@query("SELECT conv_id, turn, text FROM conversations")
def json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "json")
    sinks.gzip_json(table(spark, sf_dir, "conversations"), path, ["role"])
    return readers.json_records(spark, path, "conv_id long, turn long, text string")


@query("SELECT conv_id, turn, role, ' \"' || text || '\" ' AS text FROM conversations")
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "csv")
    quoted = F.concat(F.lit(' "'), F.col("text"), F.lit('" '))
    sinks.csv(table(spark, sf_dir, "conversations").withColumn("text", quoted), path)
    return readers.csv_table(spark, path, "conv_id long, turn long, role string, text string")


@query("SELECT doc_id, lang, n_chars, length(text) AS text_chars FROM documents")
def parquet_by_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "parquet")
    sinks.parquet(table(spark, sf_dir, "documents"), path, files=4, by=["lang"])
    return spark.read.parquet(path).select("doc_id", "lang", "n_chars", F.length("text").cast("long").alias("text_chars"))


@query("SELECT event_id, event_type, ts FROM events")
def orc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "orc")
    table(spark, sf_dir, "events").select("event_id", "event_type", "ts").write.orc(path)
    return readers.orc_with_timestamps(spark, path).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("""
SELECT sum(n_chars)::BIGINT AS n_chars, count(*) AS n_docs, (SELECT sum(strlen(text)) // 500000 + 1 FROM documents)::BIGINT AS n_files FROM documents""")
def sharded_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "sharded")
    sinks.sharded(table(spark, sf_dir, "documents"), path, "text", shard_bytes=500_000)
    stems = readers.with_stem(spark.read.parquet(path), ["doc_id", "n_chars"])
    return stems.agg(F.sum("n_chars").alias("n_chars"), F.count("doc_id").alias("n_docs"), F.count_distinct("stem").alias("n_files"))


@query("""
WITH d AS (SELECT doc_id, octet_length(encode(text)) AS size, coalesce(sum(octet_length(encode(text))) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT AS start FROM documents),
t AS (SELECT sum(size)::HUGEINT AS total, (sum(size) // 300000 + 1)::HUGEINT AS n FROM d),
k AS (SELECT doc_id, size, least(start * n // total, n - 1) AS k, n FROM d, t)
SELECT format('train-{:05d}-of-{:05d}', k::BIGINT, n::BIGINT) AS shard, 1 AS n_files, count(*) AS n_docs, sum(size)::BIGINT AS bytes, min(doc_id) AS first_doc, max(doc_id) AS last_doc FROM k GROUP BY k, n""")
def contiguous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards of consecutive documents and equal bytes, read back by name; a shard out of order loses its first and last."""
    path = new_path(spark, "contiguous")
    sinks.contiguous(table(spark, sf_dir, "documents"), path, "octet_length(text)", shard_bytes=300_000, order=["doc_id"])
    kept = spark.read.parquet(path).select("shard", "doc_id", F.octet_length("text").alias("size"), F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    return kept.groupBy("shard").agg(
        F.count_distinct("file").alias("n_files"), F.count(F.lit(1)).alias("n_docs"), F.sum("size").alias("bytes"), F.min_by("doc_id", "row").alias("first_doc"), F.max_by("doc_id", "row").alias("last_doc")
    )


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F'")
def unfinished_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "done")
    orders = table(spark, sf_dir, "orders")
    sinks.parquet(orders.filter("o_orderstatus = 'F'").select("o_orderkey"), path)
    return sinks.unfinished(orders.select("o_orderkey"), spark.read.parquet(path), ["o_orderkey"])


@query("""
SELECT 'b' || doc_id AS blob_id, n_chars * 2000 AS length, 'f' || doc_id AS filename, NULL::VARCHAR AS content FROM documents WHERE n_chars * 2000 < 10485760""")
def small_file_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "records")
    k = F.col("doc_id").cast("string")
    records = table(spark, sf_dir, "documents").select(F.concat(F.lit("b"), k).alias("blob_id"), (F.col("n_chars") * 2000).alias("length"), F.array(F.concat(F.lit("f"), k)).alias("filenames"), F.lit(True).alias("is_vendor"))
    sinks.gzip_json(records, path)
    return readers.file_records(spark, path).select("blob_id", "length", F.get("filenames", F.lit(0)).alias("filename"), "content")


@query("SELECT c_name FROM customer")
def blob_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One compressed file for each part of the customers, fetched by the records that name the files."""
    path = new_path(spark, "blobs")
    table(spark, sf_dir, "customer").select("c_name").repartition(5).write.option("compression", "gzip").text(path)
    listed = spark.read.format("binaryFile").load(path).select(F.regexp_extract("path", r"([^/]+)\.gz$", 1).alias("blob_id"), F.lit(None).cast("string").alias("content"))
    whole = readers.blobs(spark, path, listed)
    return whole.select(F.explode(F.split("content", "\n")).alias("c_name")).filter("c_name <> ''")


@query("""
SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN text END AS content FROM documents WHERE doc_id % 3 <> 2""")
def fetched_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each third document is a blob that a record names, each third a record without a blob, the rest neither."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = new_path(spark, "store")
    wanted = F.concat(F.lit("b"), F.col("doc_id").cast("string"))
    held = docs.filter("doc_id % 3 <> 1").select(wanted.alias("blob_id"), F.encode("text", "utf-8").alias("raw"))
    sinks.blobs(held, path, "blob_id", "raw")
    records = docs.filter("doc_id % 3 <> 2").select("doc_id", wanted.alias("blob_id"), F.lit(None).cast("string").alias("content"))
    return readers.fetched_blobs(records, readers.stored(path)).select("doc_id", "content")


@query("SELECT '# ' || n_name AS input, 'code' AS cell_type FROM nation UNION ALL SELECT 'x = ' || n_nationkey, 'code' FROM nation")
def notebook_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A notebook a file, with a cell of one string and a cell of a list of strings."""
    path = new_path(spark, "notebooks")
    cell = lambda source: F.struct(F.lit("code").alias("cell_type"), source.alias("source"))
    name = cell(F.concat(F.lit("# "), F.col("n_name")))
    number = F.struct(F.lit("code").alias("cell_type"), F.array(F.lit("x = "), F.col("n_nationkey").cast("string")).alias("source"))
    content = F.concat(F.lit('{"cells": ['), F.to_json(name), F.lit(","), F.to_json(number), F.lit("]}"))
    table(spark, sf_dir, "nation").select(content.alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    cells = notebooks.cells_of(readers.notebooks(spark, path, only="*.txt"))
    return cells.select(F.explode("cells").alias("c")).select("c.input", "c.cell_type")


@query("""
WITH n AS (SELECT n_name, row_number() OVER (ORDER BY n_name) - 1 AS i, count(*) OVER () AS total FROM nation)
SELECT (i // 2)::INT AS n, string_agg(n_name, chr(10) ORDER BY i) AS content FROM n WHERE i // 2 < total // 2 GROUP BY i // 2""")
def alternate_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "lines")
    table(spark, sf_dir, "nation").select("n_name").orderBy("n_name").coalesce(1).write.text(path)
    return readers.alternate_lines(spark, path).select("n", "content")


@query("SELECT text || chr(10) || role AS content FROM conversations")
def query_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "responses")
    sinks.gzip_json(table(spark, sf_dir, "conversations").select(F.col("text").alias("query"), F.col("role").alias("response")), path)
    return readers.query_responses(spark, path)


@query("""
WITH RECURSIVE e AS (
  SELECT 'root' AS parent, r_name AS name, 'r' || r_regionkey AS child, 'dir' AS type FROM region WHERE r_regionkey % 5 <> 3
  UNION ALL SELECT 'r' || n_regionkey, n_name, 'n' || n_nationkey, CASE n_nationkey % 6 WHEN 4 THEN 'rev' WHEN 5 THEN NULL ELSE 'dir' END FROM nation
  UNION ALL SELECT 'n' || c_nationkey, c_name, 'c' || c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'rev' ELSE 'file' END FROM customer),
w AS (SELECT '/' || name AS path, child, type, 0 AS level FROM e WHERE parent = 'root' UNION ALL SELECT path || '/' || e.name, e.child, e.type, level + 1 FROM w JOIN e ON w.child = e.parent WHERE w.type = 'dir')
SELECT path, level, 'b' || child AS blob_id FROM w WHERE type = 'file'""")
def listed_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw folder entries in ORC, with submodules and entries of no type, walked to the files and their contents."""
    t = lambda name, *columns: table(spark, sf_dir, name).selectExpr(*columns)
    raw = (
        t("region", "'root' AS directory_id", "CAST(r_name AS BINARY) AS name", "IF(r_regionkey % 5 = 3, 'rev', 'dir') AS type", "concat('r', r_regionkey) AS target")
        .unionByName(t("nation", "concat('r', n_regionkey) AS directory_id", "CAST(n_name AS BINARY) AS name", "CASE n_nationkey % 6 WHEN 4 THEN 'rev' WHEN 5 THEN NULL ELSE 'dir' END AS type", "concat('n', n_nationkey) AS target"))
        .unionByName(t("customer", "concat('n', c_nationkey) AS directory_id", "CAST(c_name AS BINARY) AS name", "IF(c_custkey % 3 = 0, 'rev', 'file') AS type", "concat('c', c_custkey) AS target"))
    )
    path = new_path(spark, "entries")
    raw.write.orc(path)
    content = t("customer", "concat('c', c_custkey) AS content_id", "concat('bc', c_custkey) AS blob_id", "c_custkey AS length")
    files = tree.walk(spark.range(1).select(F.lit("root").alias("node")), tree.folder_entries(spark.read.orc(path)))
    return tree.with_content(files, content).select("path", "level", "blob_id")


@query("""
WITH f AS (SELECT l_orderkey, CASE l_returnflag WHEN 'A' THEN 'Python' WHEN 'N' THEN 'JSON' ELSE 'C' END AS language, CASE l_linenumber % 3 WHEN 0 THEN 'd/x.json' WHEN 1 THEN 'd/y.py' ELSE 'd.e/z' END AS path, l_linenumber FROM lineitem)
SELECT l_orderkey, count(*) AS n_files, sum(l_linenumber)::BIGINT AS lines FROM f WHERE NOT (language = 'JSON' AND path = 'd/x.json') AND NOT (language = 'C' AND path = 'd.e/z') GROUP BY l_orderkey""")
def unlisted_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    language = F.expr("CASE l_returnflag WHEN 'A' THEN 'Python' WHEN 'N' THEN 'JSON' ELSE 'C' END")
    path = F.expr("CASE l_linenumber % 3 WHEN 0 THEN 'd/x.json' WHEN 1 THEN 'd/y.py' ELSE 'd.e/z' END")
    orders = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct(language.alias("base_language"), path.alias("base_path"), "l_linenumber")).alias("files"))
    kept = joins.without_listed(orders, "files", [("JSON", "json"), ("C", "")])
    return kept.select("l_orderkey", F.size("files").cast("long").alias("n_files"), F.aggregate("files", F.lit(0).cast("long"), lambda a, x: a + x["l_linenumber"]).alias("lines"))


@query("""
WITH d AS (SELECT n_regionkey, '[' || string_agg('{"n_nationkey":' || n_nationkey || ',"n_name":"' || n_name || '","n_regionkey":' || n_regionkey || '}', ',' ORDER BY n_nationkey) || ']' AS nations, min(n_nationkey) AS n_nationkey FROM nation WHERE n_nationkey % 5 <> 2 GROUP BY n_regionkey),
c AS (SELECT s_nationkey, min(s_suppkey) AS s_suppkey, count(*) AS n FROM supplier GROUP BY s_nationkey)
SELECT r_regionkey, d.n_nationkey, s_suppkey, nations, n AS n_suppliers FROM region LEFT JOIN d ON d.n_regionkey = r_regionkey LEFT JOIN c ON s_nationkey = d.n_nationkey""")
def lookup_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda name: table(spark, sf_dir, name)
    hops = [(t("nation").filter("n_nationkey % 5 <> 2").select("n_nationkey", "n_name", "n_regionkey"), "r_regionkey", "n_regionkey", {"n_nationkey": "n_nationkey"}), (t("supplier").select("s_suppkey", "s_nationkey"), "n_nationkey", "s_nationkey", {"s_suppkey": "s_suppkey"})]
    found = joins.first_match_chain(t("region").select("r_regionkey"), hops, records=["nations", "suppliers"])
    n = F.size(F.from_json("suppliers", "array<struct<s_suppkey:bigint,s_nationkey:int>>"))
    return found.select("r_regionkey", "n_nationkey", "s_suppkey", "nations", F.when(F.col("suppliers").isNotNull(), n.cast("long")).alias("n_suppliers"))


@query("""
WITH c AS (SELECT conv_id, turn, CASE WHEN role = 'user' THEN 'code' ELSE 'markdown' END AS kind,
    CASE WHEN role = 'user' THEN 'name_' || turn || ' = "' || left(replace(text, '"', ''), 40) || '"' || CASE WHEN conv_id % 9 = 4 THEN ' +' ELSE '' END ELSE left(replace(text, chr(10), ' '), 60) END AS source
  FROM (SELECT conv_id, turn, role, replace(text, chr(10), ' ') AS text FROM conversations)),
n AS (SELECT conv_id, count(*) AS n, count(*) FILTER (kind = 'code') AS n_code, max(turn) FILTER (kind = 'code') AS last FROM c GROUP BY conv_id),
s AS (SELECT c.conv_id, turn, kind, source, sum(CASE WHEN lag IS DISTINCT FROM kind THEN 1 ELSE 0 END) OVER (PARTITION BY c.conv_id ORDER BY turn) AS seg
  FROM (SELECT *, lag(kind) OVER (PARTITION BY conv_id ORDER BY turn) AS lag FROM c) c JOIN n USING (conv_id) WHERE n >= 4 AND n_code > 0 AND turn <= last),
p AS (SELECT conv_id, seg, CASE WHEN any_value(kind) = 'code' THEN string_agg(source, chr(10) ORDER BY turn) || chr(10) ELSE chr(10) || string_agg('# ' || trim(source), chr(10) ORDER BY turn) || chr(10) END AS part FROM s GROUP BY conv_id, seg),
t AS (SELECT conv_id, string_agg(part, '' ORDER BY seg) AS script FROM p GROUP BY conv_id)
SELECT conv_id, script FROM t WHERE length(script) > 100 AND conv_id % 9 <> 4""")
def notebook_script_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    plain = F.replace("text", F.lit("\n"), F.lit(" "))
    code = F.concat(F.lit("name_"), F.col("turn").cast("string"), F.lit(' = "'), F.substring(F.replace(plain, F.lit('"'), F.lit("")), 1, 40), F.lit('"'), F.when(F.col("conv_id") % 9 == 4, " +").otherwise(""))
    user = F.col("role") == "user"
    cell = F.struct(F.when(user, "code").otherwise("markdown").alias("cell_type"), F.when(user, code).otherwise(F.substring(plain, 1, 60)).alias("source"))
    books = table(spark, sf_dir, "conversations").groupBy(F.col("conv_id").cast("string").alias("file_id")).agg(F.sort_array(F.collect_list(F.struct("turn", cell.alias("cell")))).alias("c"))
    steps = notebooks.scripts(books.select("file_id", F.to_json(F.transform("c", lambda x: x["cell"])).alias("content")))
    return steps["compiled"].select(F.col("file_id").cast("long").alias("conv_id"), "script")


@query("""
SELECT root, '/d/' || r_name AS path, 1 AS level FROM (SELECT 'n' || n_nationkey AS root, n_regionkey, row_number() OVER (PARTITION BY n_regionkey ORDER BY 'n' || n_nationkey) AS i FROM nation) JOIN region ON r_regionkey = n_regionkey WHERE i <= 2""")
def capped_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders that many roots share, followed from two of them each."""
    t = lambda name, *columns: table(spark, sf_dir, name).selectExpr(*columns)
    entries = t("nation", "concat('n', n_nationkey) AS parent", "'d' AS name", "concat('r', n_regionkey) AS child", "false AS is_file").unionByName(t("region", "concat('r', r_regionkey) AS parent", "r_name AS name", "concat('f', r_regionkey) AS child", "true AS is_file"))
    return tree.walk(t("nation", "concat('n', n_nationkey) AS node"), entries, most_per_node=2).select("root", "path", "level")


@query("""
SELECT n_name AS source, CASE n_nationkey % 3 WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE -1 END AS perf_status, CASE n_nationkey % 3 WHEN 0 THEN 0 WHEN 1 THEN 0 ELSE -1 END AS size_status, CASE n_nationkey % 3 WHEN 0 THEN 'code of ' || n_name END AS perf_out FROM nation""")
def compiled_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that compile, that fail at one level, and of a language without a compiler; the commands stand in for one."""
    extension = F.expr("CASE n_nationkey % 3 WHEN 0 THEN 'good' WHEN 1 THEN 'half' ELSE 'unknown' END")
    files = table(spark, sf_dir, "nation").select(F.col("n_name").alias("source"), extension.alias("extension"), F.concat(F.lit("code of "), F.col("n_name")).alias("code"))
    done = compiled.compile_files(files, {"good": ("cp {src} {out}", "cp {src} {out}"), "half": ("false", "true")})
    return done.select("source", "perf_status", "size_status", "perf_out")


@query("""
WITH c AS (SELECT conv_id, string_agg('v' || turn || ' = ' || turn || chr(10), '' ORDER BY turn) AS script, count(*) AS n FROM conversations GROUP BY conv_id),
o AS (SELECT conv_id, string_agg('v' || turn || ' = ' || turn || chr(10) || repeat(chr(34), 3) || 'Example Output:' || chr(10) || CASE WHEN turn = 2 THEN 'a' || chr(10) || 'b' || chr(10) || 'c' || chr(10) || 'd' || chr(10) || 'e' || chr(10) || '...' ELSE 'out ' || turn END || chr(10) || repeat(chr(34), 3) || chr(10) || chr(10), '' ORDER BY turn) AS told FROM conversations GROUP BY conv_id)
SELECT conv_id, CASE WHEN n >= 4 THEN script ELSE '' END AS script, CASE WHEN n >= 4 THEN told ELSE '' END AS told FROM c JOIN o USING (conv_id)""")
def scripts_with_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code cells that each have an output, one of more lines than are shown."""
    turn = F.col("turn").cast("string")
    shown = F.when(F.col("turn") == 2, "a\nb\nc\nd\ne\nf").otherwise(F.concat(F.lit("out "), turn))
    cell = F.struct(F.lit("code").alias("cell_type"), F.concat(F.lit("v"), turn, F.lit(" = "), turn).alias("input"), shown.alias("output"))
    books = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", cell.alias("cell")))).alias("c")).select("conv_id", F.transform("c", lambda x: x["cell"]).alias("cells"))
    return books.select("conv_id", notebooks.script(F.col("cells")).alias("script"), notebooks.script(F.col("cells"), True).alias("told"))
