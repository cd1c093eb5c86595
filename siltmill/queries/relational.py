"""Deduplication, joins, aggregates, windows, samples and sets over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltmill.functions.text import base_name, bucket, repo_of_url
from siltmill.operators import dedup, instruct, joins
from siltmill.sources.readers import archive_grid, missing, table
from siltmill.streaming import event_counts

QUERIES, ORACLE = {}, {}


def query(sql: str | None):  # noqa: ANN201
    def add(f):  # noqa: ANN001, ANN202
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


@query("""
SELECT doc_id, sha256(text) AS digest, quality, n_chars FROM (
  SELECT d.doc_id, d.text, d.n_chars, l.quality,
         row_number() OVER (PARTITION BY sha256(d.text) ORDER BY l.quality DESC NULLS LAST, d.n_chars DESC, d.doc_id) AS n
  FROM documents d LEFT JOIN labels l USING (doc_id)) WHERE n = 1""")
def exact_dedup_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("digest"), "n_chars")
    labelled = docs.join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    one = dedup.first_by(labelled, ["digest"], [F.col("quality").desc_nulls_last(), F.col("n_chars").desc(), F.col("doc_id")])
    return one.select("doc_id", "digest", "quality", "n_chars")


@query("""
SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders) WHERE n = 1""")
def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return dedup.first_by(orders, ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()])


@query("""
SELECT l_partkey, l_orderkey, l_linenumber, l_returnflag, l_quantity FROM (
  SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_returnflag NULLS LAST, l_quantity DESC, l_extendedprice DESC, l_shipdate, l_orderkey, l_linenumber, l_suppkey) AS n
  FROM lineitem) WHERE n = 1""")
def multi_key_priority_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [F.col("l_returnflag").asc_nulls_last(), F.col("l_quantity").desc(), F.col("l_extendedprice").desc(), *map(F.col, ("l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey"))]
    one = dedup.first_by(table(spark, sf_dir, "lineitem"), ["l_partkey"], order)
    return one.select("l_partkey", "l_orderkey", "l_linenumber", "l_returnflag", "l_quantity")


@query("""
SELECT l_orderkey, o_orderdate, l_returnflag, l_linenumber, l_partkey FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY o_orderdate DESC, l_returnflag DESC, l_linenumber, l_partkey, l_suppkey) AS n
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey) WHERE n = 1""")
def revision_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    items, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    joined = items.join(orders, items["l_orderkey"] == orders["o_orderkey"])
    one = dedup.first_by(joined, ["l_orderkey"], [F.col("o_orderdate").desc(), F.col("l_returnflag").desc(), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")])
    return one.select("l_orderkey", "o_orderdate", "l_returnflag", "l_linenumber", "l_partkey")


@query("SELECT event_id, user_id, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events) WHERE n <= 10")
def cap_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.first_by(table(spark, sf_dir, "events").select("event_id", "user_id", "ts"), ["user_id"], [F.col("ts"), F.col("event_id")], 10)


@query("SELECT DISTINCT user_id, event_type FROM events")
def distinct_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("user_id", "event_type").dropDuplicates()


@query("""
WITH v AS (SELECT user_id, count(*) AS n_views FROM events WHERE event_type = 'view' GROUP BY 1), c AS (SELECT user_id, count(*) AS n_errors FROM events WHERE event_type = 'error' AND value > 60 GROUP BY 1)
SELECT user_id, coalesce(n_views, 0) AS n_views, coalesce(n_errors, 0) AS n_errors FROM (SELECT DISTINCT user_id FROM events) LEFT JOIN v USING (user_id) LEFT JOIN c USING (user_id)""")
def typed_counts_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    # one pass: counts of both types beside the distinct users, where three tables were joined
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.count_if(kind == "view").alias("n_views"), F.count_if((kind == "error") & (F.col("value") > 60)).alias("n_errors"))


@query("""
SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM (
  SELECT * FROM events WHERE event_type = 'click' UNION ALL SELECT * FROM events WHERE event_type = 'purchase')) WHERE n = 1""")
def union_all_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "ts")
    both = events.filter("event_type = 'click'").union(events.filter("event_type = 'purchase'"))
    return dedup.first_by(both, ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()]).drop("ts")


@query("""
SELECT c_custkey, n_name AS nation, r_name AS region, c_mktsegment AS segment FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def struct_pack_unpack(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", F.struct(F.col("c_mktsegment").alias("segment")).alias("metadata"))
    nations, regions = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    placed = customers.join(nations, customers["c_nationkey"] == nations["n_nationkey"]).join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
    packed = placed.select("c_custkey", F.struct(F.struct(F.col("n_name").alias("nation"), F.col("r_name").alias("region")).alias("place"), "metadata").alias("repo"))
    return packed.selectExpr("c_custkey", "repo.place.*", "repo.metadata.segment AS segment")


@query("""
SELECT c_custkey, n_name, o_orderkey FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN orders ON c_custkey = o_custkey AND o_orderpriority = '1-URGENT'""")
def three_way_left_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers, nations = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    urgent = table(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'").select("o_custkey", "o_orderkey")
    named = customers.join(nations, customers["c_nationkey"] == nations["n_nationkey"])
    return named.join(urgent, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", "n_name", "o_orderkey")


@query("""
SELECT o_orderkey, o_orderpriority, c_mktsegment FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey
WHERE (o_orderpriority = '1-URGENT' AND c_mktsegment = 'BUILDING') OR (c_mktsegment IS NULL AND o_orderpriority IN ('2-HIGH', '3-MEDIUM'))""")
def branch_predicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer").filter("c_acctbal > 0")
    segment, priority = F.col("c_mktsegment"), F.col("o_orderpriority")
    joined = orders.join(customers, orders["o_custkey"] == customers["c_custkey"], "left")
    return joined.filter(((priority == "1-URGENT") & (segment == "BUILDING")) | (segment.isNull() & priority.isin("2-HIGH", "3-MEDIUM"))).select("o_orderkey", "o_orderpriority", "c_mktsegment")


@query("SELECT page_id, regexp_extract(url, 'https://([^/]+/[^/]+)', 1) AS full_name FROM pages WHERE url LIKE 'https://%'")
def like_prefix_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").filter("url LIKE 'https://%'").select("page_id", F.regexp_extract("url", "https://([^/]+/[^/]+)", 1).alias("full_name"))


@query("""
SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND toxic = 1) AND source NOT IN ('src3', 'src7')""")
def optout_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("repo_name"))
    repos = table(spark, sf_dir, "labels").filter("toxic = 1").join(docs, "doc_id").select("repo_name")
    users = spark.range(1).select(F.explode(F.array(F.lit("src3"), F.lit("src7"))).alias("user"))
    return joins.opted_out(docs, repos, users).select("doc_id", "source")


@query("""
SELECT event_id, event_type FROM events e WHERE NOT EXISTS (SELECT 1 FROM (VALUES ('click', 1), ('click', 2), ('view', 3), ('error', 69)) b(t, k) WHERE b.t = e.event_type AND b.k = (props->>'$.k')::INT)""")
def blacklist_composite_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "event_type", F.get_json_object("props", "$.k").cast("int").alias("k"))
    listed = spark.sql("SELECT * FROM VALUES ('click', 1), ('click', 2), ('view', 3), ('error', 69) AS b(event_type, k)")
    return events.join(listed, ["event_type", "k"], "left_anti").select("event_id", "event_type")


@query("""
SELECT p_partkey, p_brand, license_type FROM part JOIN (SELECT DISTINCT p_brand, CASE WHEN CAST(regexp_extract(p_brand, '(\\d+)', 1) AS INT) % 3 = 0 THEN 'non_permissive' WHEN CAST(regexp_extract(p_brand, '(\\d+)', 1) AS INT) % 3 = 1 THEN 'permissive' ELSE 'no_license' END AS license_type
  FROM part WHERE CAST(regexp_extract(p_brand, '(\\d+)', 1) AS INT) < 20) USING (p_brand) WHERE license_type <> 'non_permissive'""")
def license_lookup_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    n = F.regexp_extract("p_brand", r"(\d+)", 1).cast("int")
    kind = F.when(n % 3 == 0, "non_permissive").when(n % 3 == 1, "permissive").otherwise("no_license")
    licenses = parts.filter(n < 20).select(F.col("p_brand").alias("repo_name"), kind.alias("license_type")).distinct()
    return joins.licensed(parts, licenses, "p_brand").select("p_partkey", "p_brand", "license_type")


@query("""
WITH c AS (SELECT c_nationkey AS k, count(*) AS n_customers FROM customer WHERE c_nationkey <> 3 GROUP BY 1), s AS (SELECT s_nationkey AS k, count(*) AS n_suppliers FROM supplier WHERE s_nationkey <> 5 GROUP BY 1)
SELECT k AS nationkey, n_customers, n_suppliers FROM c FULL JOIN s USING (k)""")
def full_outer_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").filter("c_nationkey <> 3").groupBy(F.col("c_nationkey").alias("nationkey")).agg(F.count(F.lit(1)).alias("n_customers"))
    suppliers = table(spark, sf_dir, "supplier").filter("s_nationkey <> 5").groupBy(F.col("s_nationkey").alias("nationkey")).agg(F.count(F.lit(1)).alias("n_suppliers"))
    return joins.full_outer_once(customers, suppliers, "nationkey")


@query("""
SELECT p_partkey, f.l_orderkey, o_custkey, c_nationkey, n_name FROM part LEFT JOIN (SELECT l_partkey, min(l_orderkey) AS l_orderkey FROM lineitem GROUP BY 1) f ON p_partkey = l_partkey
LEFT JOIN orders ON o_orderkey = f.l_orderkey LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey""")
def first_match_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda name: table(spark, sf_dir, name)
    hops = [
        (t("lineitem"), "p_partkey", "l_partkey", {"l_orderkey": "l_orderkey"}),
        (t("orders"), "l_orderkey", "o_orderkey", {"o_custkey": "o_custkey"}),
        (t("customer"), "o_custkey", "c_custkey", {"c_nationkey": "c_nationkey"}),
        (t("nation"), "c_nationkey", "n_nationkey", {"n_name": "n_name"}),
    ]
    return joins.first_match_chain(t("part").select("p_partkey"), hops)


@query("""
SELECT host, array_to_string(list_sort(list_distinct(list(name))), ',') AS names, left(host, 2) AS prefix FROM (
  SELECT regexp_extract(url, '://([^/?#]*)', 1) AS host, string_split(regexp_extract(url, '://[^?#]*'), '/')[-1] AS name FROM pages) GROUP BY host""")
def collect_set_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select(F.regexp_extract("url", "://([^/?#]*)", 1).alias("host"), base_name(F.regexp_extract("url", "://[^?#]*", 0)).alias("name"))
    return pages.groupBy("host").agg(F.array_join(F.sort_array(F.collect_set("name")), ",").alias("names")).withColumn("prefix", F.substring("host", 1, 2))


@query("""
SELECT source, array_to_string(list_sort(list_distinct(flatten(list(tags)))), ',') AS tags FROM (SELECT source, list_filter(['MIT License', 'Apache License', 'GNU General', 'CC BY'], lambda x: contains(text, x)) AS tags FROM documents) GROUP BY source""")
def flatten_distinct_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.array(*map(F.lit, ("MIT License", "Apache License", "GNU General", "CC BY")))
    tagged = table(spark, sf_dir, "documents").select("source", F.filter(names, lambda x: F.contains(F.col("text"), x)).alias("tags")).filter(F.size("tags") >= 0)
    return tagged.groupBy("source").agg(F.array_join(F.sort_array(F.array_distinct(F.flatten(F.collect_set("tags")))), ",").alias("tags"))


@query("SELECT doc_id, source, count(*) OVER (PARTITION BY source) AS in_source FROM documents")
def group_count_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.with_group_size(table(spark, sf_dir, "documents").select("doc_id", "source"), "source", "in_source")


@query("""
WITH p AS (SELECT page_id, regexp_extract(url, '://([^/?#]*)', 1) AS host, regexp_extract(url, '://[^/?#]*([^?#]*)', 1) AS path FROM pages),
f AS (SELECT *, CASE page_id % 7 WHEN 0 THEN ['MIT'] WHEN 1 THEN ['GPL-3.0', 'MIT'] ELSE [] END AS licenses FROM p),
b AS (SELECT host, regexp_extract(path, '^(.*/)', 1) AS base, flatten(list(licenses)) AS found FROM f WHERE len(licenses) > 0 GROUP BY ALL)
SELECT page_id, f.host, path, array_to_string(list_sort(list_distinct(coalesce(flatten(list(found)), []))), ',') AS detected FROM f LEFT JOIN b ON f.host = b.host AND starts_with(path, base) AND base <> '' GROUP BY page_id, f.host, path""")
def prefix_license_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = F.expr("CASE page_id % 7 WHEN 0 THEN array('MIT') WHEN 1 THEN array('GPL-3.0', 'MIT') ELSE array() END")
    files = table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("url", "://([^/?#]*)", 1).alias("host"), F.regexp_extract("url", "://[^/?#]*([^?#]*)", 1).alias("path"), found.alias("licenses"))
    return joins.propagate(files, ["host"], identity=["page_id"]).select("page_id", "host", "path", F.array_join("detected", ",").alias("detected"))


@query("""
SELECT doc_id, upper(left(sha256(doc_id::VARCHAR), 3)) AS bucket FROM documents""")
def sha_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", bucket(F.col("doc_id")).alias("bucket"))


@query("""
SELECT doc_id, source FROM (SELECT doc_id, source, count(*) OVER (PARTITION BY source) AS n, ('0x' || left(sha256('doc|' || doc_id), 8))::BIGINT / 4294967296.0::DOUBLE AS u FROM documents)
WHERE u < CASE WHEN n <= 1000 THEN 0.8007::DOUBLE - 0.0007::DOUBLE * n ELSE 100.0::DOUBLE / n END""")
def size_based_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = dedup.with_group_size(table(spark, sf_dir, "documents").select("doc_id", "source"), "source", "n")
    return docs.filter(dedup.uniform(F.lit("doc"), F.col("doc_id")) < dedup.repo_rate(F.col("n"))).drop("n")


@query("SELECT p_partkey, p_name FROM (SELECT *, row_number() OVER (ORDER BY p_partkey) - 1 AS r, count(*) OVER () AS n FROM part) WHERE r >= (n // 7) * 6")
def slice_i_of_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.slice_of(table(spark, sf_dir, "part").select("p_partkey", "p_name"), ["p_partkey"], 6, 7)


@query("SELECT p_partkey, ((row_number() OVER (ORDER BY p_partkey) - 1) % 5)::BIGINT AS part FROM part")
def round_robin_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = dedup.round_robin(table(spark, sf_dir, "part").select("p_partkey"), ["p_partkey"], 5)
    return dealt.withColumn("part", F.col("part").cast("long"))


@query("SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 25")
def head_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", "p_retailprice").orderBy(F.desc("p_retailprice"), "p_partkey").limit(25)


@query("""
SELECT step, n_docs FROM (SELECT count(*) AS a, count(*) FILTER (n_chars > 100) AS b, count(*) FILTER (n_chars > 100 AND lang = 'en') AS c, count(*) FILTER (n_chars > 100 AND lang = 'en' AND coalesce(toxic, 0) = 0) AS d FROM documents LEFT JOIN labels USING (doc_id))
UNPIVOT (n_docs FOR step IN (a AS 'initial', b AS 'long', c AS 'english', d AS 'clean'))""")
def funnel_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang").join(table(spark, sf_dir, "labels").select("doc_id", "toxic"), "doc_id", "left")
    long = F.col("n_chars") > 100
    english = long & (F.col("lang") == "en")
    steps = {"initial": F.lit(True), "long": long, "english": english, "clean": english & (F.coalesce("toxic", F.lit(0)) == 0)}
    return docs.agg(*[F.count_if(c).alias(n) for n, c in steps.items()]).unpivot([], list(steps), "step", "n_docs")


@query("""
WITH b AS (SELECT CASE WHEN n_chars < 0 THEN 0 WHEN n_chars >= 8000 THEN 100 ELSE floor(n_chars / (8000.0::DOUBLE / 99))::BIGINT + 1 END AS bin, count(*) AS n FROM documents GROUP BY 1)
SELECT bin, n, round(CASE WHEN bin BETWEEN 1 AND 99 THEN n / (SELECT sum(n) FROM b WHERE bin BETWEEN 1 AND 99) / (8000.0::DOUBLE / 99) END, 12) AS density FROM b""")
def length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return instruct.histogram(table(spark, sf_dir, "documents").select("n_chars"), "n_chars", 0.0, 8000.0, 99).withColumn("density", F.round("density", 12))


@query("""
SELECT source, lang, count(*) AS n, sum(len(regexp_extract_all(text, '\\S+')))::BIGINT AS n_tokens, sum(len(regexp_extract_all(text, '\\S+'))) / 1e6 AS millions, round(avg(len(regexp_extract_all(text, '\\S+'))), 6) AS mean FROM documents GROUP BY ALL""")
def token_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return instruct.token_stats(table(spark, sf_dir, "documents"), "text", "source", "lang").withColumn("mean", F.round("mean", 6))


@query("SELECT lang, count(*) AS n FROM documents GROUP BY lang")
def language_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").groupBy("lang").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT source, lang, doc_id FROM (SELECT source, lang, doc_id, row_number() OVER (PARTITION BY source, lang ORDER BY doc_id) AS n FROM documents) WHERE n = 1""")
def first_per_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").groupBy("source", "lang").agg(F.min("doc_id").alias("doc_id"))


@query("""
SELECT g.day::VARCHAR AS day, h.hour::INT AS hour, g.day || '-' || h.hour || '.json.gz' AS name, count(event_id) AS n_events
FROM (SELECT unnest(generate_series(DATE '2024-01-01', DATE '2024-01-31', INTERVAL 1 DAY))::DATE AS day) g CROSS JOIN (SELECT unnest(range(24)) AS hour) h
LEFT JOIN events ON ts >= g.day + to_hours(h.hour) AND ts < g.day + to_hours(h.hour + 1) GROUP BY ALL""")
def day_hour_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = archive_grid(spark, "2024-01-01", "2024-01-31")
    events = table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("day"), F.hour("ts").alias("hour")).agg(F.count("event_id").alias("n"))
    return grid.join(events, ["day", "hour"], "left").select(F.col("day").cast("string"), "hour", "name", F.coalesce("n", F.lit(0)).cast("long").alias("n_events"))


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE NOT (o_orderkey % 3 = 0 AND o_totalprice > 100000)")
def manifest_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return missing(wanted, wanted.filter("o_orderkey % 3 = 0 AND o_totalprice > 100000"), ["o_orderkey", "o_totalprice"])


@query("""
SELECT l_partkey, list_sort(list_intersect(a, b))::VARCHAR AS both_flags, len(list_filter(a, lambda x: NOT list_contains(b, x)))::BIGINT AS n_only_early FROM (
  SELECT l_partkey, coalesce(list(DISTINCT l_returnflag) FILTER (l_linenumber <= 3), []) AS a, coalesce(list(DISTINCT l_returnflag) FILTER (l_linenumber > 3), []) AS b FROM lineitem GROUP BY 1)""")
def array_set_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    early = F.col("l_linenumber") <= 3
    sets = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.collect_set(F.when(early, F.col("l_returnflag"))).alias("a"), F.collect_set(F.when(~early, F.col("l_returnflag"))).alias("b"))
    shown = F.concat(F.lit("["), F.array_join(F.sort_array(F.array_intersect("a", "b")), ", "), F.lit("]"))
    return sets.select("l_partkey", shown.alias("both_flags"), F.size(F.array_except("a", "b")).cast("long").alias("n_only_early"))


@query("""
SELECT event_type, date_trunc('day', ts) AS start, count(*) AS n_events, sum(value::DECIMAL(18, 4))::DOUBLE AS value FROM events GROUP BY ALL""")
def windowed_event_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_counts.windowed(table(spark, sf_dir, "events"))


@query(ORACLE["windowed_event_counts"])
def streamed_event_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    stream = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return event_counts.drained(event_counts.windowed(stream, late="100 days"))


@query("""
SELECT page_id, regexp_extract(replace(url, 'http://', 'https://'), 'https://([^/]+/[^/?#]+)', 1) <> '' AS has_repo FROM pages""")
def url_owner_repo(spark: SparkSession, sf_dir: str) -> DataFrame:
    plain = F.regexp_replace(F.replace(F.col("url"), F.lit("http://"), F.lit("https://")), "^https://[^/]+", "https://github.com")
    return table(spark, sf_dir, "pages").select("page_id", (repo_of_url(F.concat(plain, F.lit("/x"))) != "").alias("has_repo"))
