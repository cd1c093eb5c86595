"""Histories, trees, notebooks, prompts and renders over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltmill.operators import compiled, dedup, diffs, histories, instruct, joins, notebooks, tree
from siltmill.plans import license_typing, pull_render, repo_merge
from siltmill.sources.readers import table

QUERIES, ORACLE = {}, {}


def query(sql: str | None):  # noqa: ANN201
    def add(f):  # noqa: ANN001, ANN202
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations")


def _ordered(turns: DataFrame) -> DataFrame:
    """conv_id, turns: array of struct(turn, role, text) in order."""
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))


@query("""
WITH RECURSIVE e AS (
  SELECT 'root' AS parent, r_name AS name, 'r' || r_regionkey AS child, false AS is_file FROM region
  UNION ALL SELECT 'r' || n_regionkey, n_name, 'n' || n_nationkey, false FROM nation
  UNION ALL SELECT 'n' || c_nationkey, c_name, 'c' || c_custkey, false FROM customer
  UNION ALL SELECT 'c' || o_custkey, 'order' || o_orderkey, 'o' || o_orderkey, true FROM orders),
w AS (SELECT 'root' AS root, '/' || name AS path, child, is_file, 0 AS level FROM e WHERE parent = 'root'
  UNION ALL SELECT root, path || '/' || e.name, e.child, e.is_file, level + 1 FROM w JOIN e ON w.child = e.parent WHERE NOT w.is_file)
SELECT root, path, child, level FROM w WHERE is_file""")
def bfs_tree_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda name, *columns: table(spark, sf_dir, name).selectExpr(*columns)
    edges = (
        t("region", "'root' AS parent", "r_name AS name", "concat('r', r_regionkey) AS child", "false AS is_file")
        .unionByName(t("nation", "concat('r', n_regionkey) AS parent", "n_name AS name", "concat('n', n_nationkey) AS child", "false AS is_file"))
        .unionByName(t("customer", "concat('n', c_nationkey) AS parent", "c_name AS name", "concat('c', c_custkey) AS child", "false AS is_file"))
        .unionByName(t("orders", "concat('c', o_custkey) AS parent", "concat('order', o_orderkey) AS name", "concat('o', o_orderkey) AS child", "true AS is_file"))
    )
    return tree.walk(spark.range(1).select(F.lit("root").alias("node")), edges)


@query("""
SELECT 'c' || (doc_id % 300) AS content_id, 'b' || (doc_id % 300) AS blob_id, (doc_id % 300)::BIGINT AS length, array_to_string(list_sort(list_distinct(list(source))), ',') AS filenames, 'b' || left((doc_id % 300)::VARCHAR, 1) AS blob_prefix FROM documents GROUP BY doc_id % 300""")
def unique_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = (F.col("doc_id") % 300).cast("string")
    paths = table(spark, sf_dir, "documents").select(F.concat(F.lit("c"), k).alias("content_id"), F.concat(F.lit("b"), k).alias("blob_id"), (F.col("doc_id") % 300).alias("length"), F.concat(F.lit("/dir/"), "source").alias("path"))
    return tree.unique_files(paths).withColumn("filenames", F.array_join("filenames", ","))


@query("SELECT conv_id, string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS history, count(*) AS n_turns FROM conversations GROUP BY conv_id")
def ordered_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = F.transform("turns", lambda t: F.concat(t["role"], F.lit(": "), t["text"]))
    return _ordered(_turns(spark, sf_dir)).select("conv_id", F.array_join(shown, "\n").alias("history"), F.size("turns").cast("long").alias("n_turns"))


@query("""
WITH f AS (SELECT conv_id, arg_min(role, turn) AS role, arg_min(text, turn) AS text FROM conversations GROUP BY 1)
SELECT conv_id, turn, role, text FROM conversations UNION ALL SELECT conv_id, -1, 'system', text FROM f WHERE role <> 'system'""")
def synthetic_open_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = F.col("turns")[0]
    opening = F.array(F.struct(F.lit(-1).cast("long").alias("turn"), F.lit("system").alias("role"), first["text"].alias("text")))
    whole = F.when(first["role"] == "system", F.col("turns")).otherwise(F.concat(opening, F.col("turns")))
    return _ordered(_turns(spark, sf_dir)).select("conv_id", F.explode(whole).alias("t")).select("conv_id", "t.*")


@query("""
WITH r AS (SELECT *, (turn // 2) AS review FROM conversations), l AS (SELECT conv_id, review, arg_max(role, turn) AS state FROM r GROUP BY 1, 2)
SELECT c.conv_id, n_turns, n_roles, n_user, has_system, n_last_assistant FROM (
  SELECT conv_id, count(*) AS n_turns, count(DISTINCT role) AS n_roles, count(*) FILTER (role = 'user') AS n_user, bool_or(role = 'system') AS has_system FROM conversations GROUP BY 1) c
JOIN (SELECT conv_id, count(*) FILTER (state = 'assistant') AS n_last_assistant FROM l GROUP BY 1) s ON c.conv_id = s.conv_id""")
def history_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = lambda c: F.size(c).cast("long")
    t = F.col("turns")
    # turns are in order, so of each review the last state is the one that no later turn of it follows
    last = F.filter(t, lambda x: ~F.exists(t, lambda y: (F.floor(y["turn"] / 2) == F.floor(x["turn"] / 2)) & (y["turn"] > x["turn"])))
    return _ordered(_turns(spark, sf_dir)).select(
        "conv_id",
        size(t).alias("n_turns"),
        size(F.array_distinct(F.transform(t, lambda x: x["role"]))).alias("n_roles"),
        size(F.filter(t, lambda x: x["role"] == "user")).alias("n_user"),
        F.exists(t, lambda x: x["role"] == "system").alias("has_system"),
        size(F.filter(last, lambda x: x["role"] == "assistant")).alias("n_last_assistant"),
    )


@query("""
WITH f AS (SELECT conv_id, arg_min(role, turn) AS opener FROM conversations GROUP BY 1)
SELECT conv_id, turn, role FROM conversations JOIN f USING (conv_id) WHERE opener <> 'system' AND role <> 'assistant'""")
def veto_and_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = F.when(F.col("turns")[0]["role"] != "system", F.filter("turns", lambda x: x["role"] != "assistant"))
    return _ordered(_turns(spark, sf_dir)).select("conv_id", F.explode(kept).alias("t")).select("conv_id", "t.turn", "t.role")


@query("""
SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN 'page' ELSE 'account' END AS shape, CASE WHEN event_type = 'purchase' THEN value END AS price, CASE WHEN event_type = 'error' THEN (props->>'$.k')::BIGINT END AS code FROM events WHERE event_type <> 'signup'""")
def event_flatten_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    events = table(spark, sf_dir, "events").filter(kind != "signup")
    return events.select(
        "event_id",
        F.when(kind.isin("click", "view"), "page").otherwise("account").alias("shape"),
        F.when(kind == "purchase", F.col("value")).alias("price"),
        F.when(kind == "error", F.get_json_object("props", "$.k").cast("long")).alias("code"),
    )


@query("""
SELECT user_id, arg_min(event_type, (ts, event_id)) AS first_type, arg_min(event_type, (ts, event_id)) IN ('click', 'view') AS starts_by_looking FROM events GROUP BY user_id""")
def initial_state_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = table(spark, sf_dir, "events").groupBy("user_id").agg(F.min_by("event_type", F.struct("ts", "event_id")).alias("first_type"))
    return first.withColumn("starts_by_looking", F.col("first_type").isin("click", "view"))


@query("""
SELECT conv_id, string_agg('Language: ' || role || chr(10) || text, chr(10) || chr(10) ORDER BY role, text) AS content FROM conversations GROUP BY conv_id""")
def group_concat_by_problem(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("conv_id").cast("string")
    rows = _turns(spark, sf_dir).select(key.alias("task_name"), F.lit("about").alias("task_description"), F.col("role").alias("language_name"), F.col("text").alias("code"))
    texts = instruct.task_texts(rows)
    return texts.select(F.col("task_name").cast("long").alias("conv_id"), F.regexp_replace("content", "^[^\n]*\nabout\n\n", "").alias("content"))


@query("""
SELECT conv_id, turn, text || chr(10) || next AS content FROM (SELECT *, lead(text) OVER w AS next, lead(role) OVER w AS next_role FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) WHERE role = 'user' AND next_role = 'assistant'""")
def qa_pairing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return instruct.answered(_turns(spark, sf_dir))


@query("""
SELECT conv_id, turn, chr(10) || 'QUESTION:' || chr(10) || text || CASE WHEN turn % 2 = 0 THEN '' ELSE 'def f():' END || chr(10) || CASE WHEN turn % 3 = 0 THEN 'Use Call-Based format' ELSE 'Use Standard Input format' END || chr(10) || 'ANSWER:' || chr(10) || 'first ' || conv_id AS content FROM conversations""")
def prompt_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    starter = F.when(F.col("turn") % 2 == 0, "").otherwise("def f():")
    tests = F.when(F.col("turn") % 3 == 0, '{"fn_name": "f"}').when(F.col("turn") % 3 == 1, '{"inputs": []}').otherwise("{broken")
    solutions = F.to_json(F.array(F.concat(F.lit("first "), F.col("conv_id").cast("string")), F.lit("second")))
    return _turns(spark, sf_dir).select("conv_id", "turn", instruct.exercise_prompt(F.col("text"), starter, tests, solutions).alias("content"))


@query("""
WITH r AS (SELECT conv_id, role, turn, text, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS n FROM conversations)
SELECT conv_id, 'Task' || chr(10) || string_agg('Solution (' || CASE role WHEN 'user' THEN 'Python 2' WHEN 'assistant' THEN 'CPP' ELSE 'Python 3' END || '):' || 'code ' || turn || chr(10), '' ORDER BY turn) AS raw FROM r WHERE n = 1 GROUP BY conv_id""")
def contest_solutions(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.expr("CASE role WHEN 'user' THEN 1 WHEN 'assistant' THEN 2 ELSE 3 END")
    rows = _turns(spark, sf_dir).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", number.alias("n")))).alias("t"))
    solutions = F.transform("t", lambda x: F.concat(F.lit("code "), x["turn"].cast("string")))
    firsts = instruct.first_per_language(solutions, F.transform("t", lambda x: x["n"]))
    return rows.select("conv_id", F.concat(instruct.contest_text(F.lit("Task"), firsts), F.lit("\n")).alias("raw"))


@query("""
WITH c AS (SELECT conv_id, turn, role, CASE WHEN turn % 3 = 2 THEN 'out' ELSE '<empty>' END AS output, text FROM conversations WHERE length(text) > 0),
b AS (SELECT *, CASE WHEN lag(output) OVER w <> '<empty>' OR lag(role) OVER w <> role OR lag(role) OVER w IS NULL THEN 1 ELSE 0 END AS begins FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
s AS (SELECT *, sum(begins) OVER (PARTITION BY conv_id ORDER BY turn) AS segment FROM b)
SELECT conv_id, segment::BIGINT AS segment, any_value(role) AS cell_type, string_agg(text, chr(10) ORDER BY turn) AS input, arg_max(output, turn) AS output FROM s GROUP BY conv_id, segment""")
def notebook_segmentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    output = F.when(F.col("turn") % 3 == 2, "out").otherwise(notebooks.EMPTY)
    cells = _turns(spark, sf_dir).filter(F.length("text") > 0).select("conv_id", "turn", F.struct(F.col("role").alias("cell_type"), F.col("text").alias("input"), output.alias("output")).alias("cell"))
    books = cells.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "cell"))).alias("c")).select("conv_id", F.transform("c", lambda x: x["cell"]).alias("cells"))
    return books.select("conv_id", F.posexplode(notebooks.segments(F.col("cells"))).alias("i", "s")).select("conv_id", (F.col("i") + 1).cast("long").alias("segment"), "s.*")


@query("""
WITH t AS (SELECT conv_id, count(*) AS n, count(*) FILTER (role = 'user') AS n_code FROM conversations GROUP BY 1) SELECT conv_id, n >= 4 AND n_code > 0 AS has_script FROM t""")
def notebook_scripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("role") == "user", "code").otherwise("markdown")
    cell = F.struct(kind.alias("cell_type"), F.concat(F.lit("x = "), F.col("turn").cast("string")).alias("source"))
    books = _turns(spark, sf_dir).groupBy(F.col("conv_id").alias("file_id")).agg(F.to_json(F.transform(F.sort_array(F.collect_list(F.struct("turn", cell.alias("cell")))), lambda x: x["cell"])).alias("content"))
    made = notebooks.cells_of(books).withColumn("script", notebooks.script(F.col("cells")))
    return made.select(F.col("file_id").alias("conv_id"), (F.length("script") > 0).alias("has_script"))


@query("""
SELECT n_regionkey, '| name | region |' || chr(10) || '| --- | --- |' || string_agg(chr(10) || '| ' || n_name || ' | ' || n_regionkey || ' |', '' ORDER BY n_name || '<') AS markdown FROM nation GROUP BY n_regionkey""")
def html_table_to_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = F.concat(F.lit("<tr><td>"), F.col("n_name"), F.lit("</td><td>"), F.col("n_regionkey").cast("string"), F.lit("</td></tr>"))
    regions = table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.array_join(F.sort_array(F.collect_list(row)), "").alias("rows"))
    html = F.concat(F.lit("<table><tr><th>name</th><th>region</th></tr>"), F.col("rows"), F.lit("</table>"))
    return regions.select("n_regionkey", notebooks.table_markdown(html).alias("markdown"))


def _beside_previous(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, before, text: each document and the one before it in its source."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    pairs = dedup.with_previous(docs, "source", "doc_id", "before_id").select("doc_id", "before_id")
    texts = docs.select("doc_id", "text")
    return pairs.join(texts, "doc_id").join(texts.select(F.col("doc_id").alias("before_id"), F.col("text").alias("before")), "before_id").filter("before IS NOT NULL")


@query(None)
def line_diff_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _beside_previous(spark, sf_dir)
    return docs.select("doc_id", diffs.change_range(F.col("before"), F.col("text")).alias("r")).select("doc_id", "r.*")


@query(None)
def diff_hunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _beside_previous(spark, sf_dir)
    return docs.select("doc_id", diffs.hunks(F.col("before"), F.col("text"), F.lit(0)).alias("hunks"))


@query("""
SELECT s_nationkey, count(*) AS n, count(*) FILTER (a = 0) AS n_perf, count(*) FILTER (b = 0) AS n_size, count(*) FILTER (a = 0 AND b = 0) AS n_both, count(*) FILTER (a = 0 AND b = 0) / count(*)::DOUBLE AS both_share
FROM (SELECT s_nationkey, s_suppkey % 2 AS a, s_suppkey % 3 AS b FROM supplier) GROUP BY s_nationkey""")
def compile_status_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = table(spark, sf_dir, "supplier").select("s_nationkey", (F.col("s_suppkey") % 2).cast("int").alias("perf_status"), (F.col("s_suppkey") % 3).cast("int").alias("size_status"))
    return compiled.summary(results, "s_nationkey")


def _pulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as raw events of pull requests: openings, reviews, comments and a merge."""
    turns = _turns(spark, sf_dir)
    n = F.col("conv_id").cast("string")
    at = F.date_format(F.timestamp_seconds(F.lit(1_700_000_000) + F.col("conv_id") * 1000 + F.col("turn")), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    number = F.concat(F.lit("https://api.host/repos/o"), (F.col("conv_id") % 7).cast("string"), F.lit("/r/pulls/"), n)
    kind = F.expr("CASE WHEN turn = 0 THEN 'PullRequestEvent' WHEN turn % 3 = 1 THEN 'PullRequestReviewEvent' WHEN turn % 3 = 2 THEN 'IssueCommentEvent' ELSE 'PullRequestReviewCommentEvent' END")
    head, base = F.concat(F.lit("h"), n, F.lit("_"), (F.col("turn") / 4).cast("int").cast("string")), F.concat(F.lit("b"), n)
    raw = turns.select("*", kind.alias("k")).select(
        F.col("k").alias("type"),
        at.alias("created_at"),
        F.struct(F.col("role").alias("login")).alias("actor"),
        F.struct(
            F.when(F.col("turn") == 0, "opened").otherwise("created").alias("action"),
            F.when(
                F.col("k") != "IssueCommentEvent",
                F.struct(number.alias("url"), (F.col("turn") > 0).alias("merged"), F.lit("A title of some length").alias("title"), F.col("text").alias("body"), F.struct(head.alias("sha")).alias("head"), F.struct(base.alias("sha")).alias("base")),
            ).alias("pull_request"),
            F.struct(F.col("turn").alias("id"), F.col("text").alias("body"), F.lit("src/a.py").alias("path"), F.lit("@@ -20,2 +20,2 @@\n-a\n+b").alias("diff_hunk")).alias("comment"),
            F.struct(F.col("turn").alias("id"), F.col("text").alias("body"), F.lit("approved").alias("state")).alias("review"),
            F.when(F.col("k") == "IssueCommentEvent", F.struct(F.col("conv_id").alias("id"), F.struct(number.alias("url")).alias("pull_request"))).alias("issue"),
        ).alias("payload"),
    )
    return raw.select(F.from_json(F.to_json(F.struct(*raw.columns)), histories.RAW).alias("e")).select("e.*")


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("conv_id").cast("string")
    base = F.concat_ws("\n", F.array_repeat(F.concat(F.lit("line of "), n), 30))
    head = F.concat(base, F.lit("\nnew line"))
    commits = _turns(spark, sf_dir).select("conv_id", (F.col("turn") / 4).cast("int").alias("c")).distinct()
    return commits.select(
        F.concat(F.lit("o"), (F.col("conv_id") % 7).cast("string"), F.lit("/r/pull/"), n).alias("pull_guid"),
        F.concat(F.lit("h"), n, F.lit("_"), F.col("c").cast("string")).alias("head_commit_id"),
        F.concat(F.lit("b"), n).alias("base_commit_id"),
        F.array(F.struct(F.lit("src/a.py").alias("base_path"), base.alias("base_content"), F.lit("Python").alias("base_language"), F.concat(head, F.col("c").cast("string")).alias("head_content"))).alias("files"),
    )


@query("""
WITH t AS (SELECT *, CASE WHEN turn = 0 THEN 'p' WHEN turn % 3 = 1 THEN 'r' WHEN turn % 3 = 2 THEN 'i' ELSE 'c' END AS k FROM conversations)
SELECT 'o' || (conv_id % 7) || '/r/pull/' || conv_id AS pull_guid, count(*) FILTER (k = 'p') + CASE WHEN count(*) FILTER (k = 'p') = 0 THEN 1 ELSE 0 END AS n_pre, count(*) FILTER (k IN ('r', 'c')) AS n_cre, count(*) FILTER (k = 'i') AS n_ie, count(*) FILTER (k = 'r') AS review_n_approved,
  CASE WHEN max(turn) FILTER (k <> 'i') > 0 THEN 1 ELSE 0 END AS is_merged FROM t GROUP BY conv_id HAVING count(*) FILTER (k <> 'i') > 0""")
def pull_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = histories.with_stats(histories.pull_histories(histories.routed(histories.flat_events(_pulls(spark, sf_dir)))[1]))
    return stats.select("pull_guid", "n_pre", "n_cre", "n_ie", "review_n_approved", "is_merged")


@query("""
WITH t AS (SELECT conv_id, turn, role, text, CASE WHEN turn = 0 THEN 'P' WHEN turn % 3 = 1 THEN 'R' WHEN turn % 3 = 2 THEN 'I' ELSE 'C' END AS k FROM conversations),
u AS (SELECT conv_id, role, row_number() OVER (PARTITION BY conv_id ORDER BY min(turn)) - 1 AS number FROM t GROUP BY conv_id, role),
n AS (SELECT conv_id, list(role ORDER BY number) AS names FROM u GROUP BY conv_id),
e AS (SELECT t.*, 'username_' || number AS who, regexp_replace(replace(replace(replace(text, names[1], 'username_0'), coalesce(names[2], chr(1)), 'username_1'), coalesce(names[3], chr(1)), 'username_2'), '^\\s+|\\s+$', '', 'g') AS said
  FROM t JOIN u USING (conv_id, role) JOIN n USING (conv_id)),
x AS (SELECT *, CASE WHEN length(said) >= 20 THEN who || ': ' || left(said, 1000) END AS whole, CASE WHEN said = '' THEN who ELSE who || ': ' || left(said, 1000) END AS brief,
  '<pr_diff><pr_file>src/a.py<pr_diff_hunk>@@ -14,3 +14,4 @@' || repeat(chr(10) || ' line of ' || conv_id, 3) || chr(10) || '+new line' AS diff FROM e),
p AS (SELECT conv_id, turn, k, whole, CASE k
  WHEN 'P' THEN '<pr>Title: A title of some length' || chr(10) || whole || '<pr_status>opened<pr_base><pr_file>src/a.py<pr_base_code>' || repeat('line of ' || conv_id || chr(10), 15) || 'line of ' || conv_id || diff || '0'
  WHEN 'R' THEN CASE WHEN turn = 4 THEN diff || '1' ELSE '' END || '<pr_review>' || brief || '<pr_event_id>' || turn || '<pr_review_state>approved'
  WHEN 'C' THEN coalesce('<pr_review_comment><pr_event_id>' || turn || '<pr_file>src/a.py<pr_diff_hunk>@@ -6,2 +6,2 @@' || chr(10) || '-a' || chr(10) || '+b<pr_comment>' || whole, '')
  ELSE coalesce('<pr_comment>' || whole || '<pr_event_id>' || turn || '<pr_status>created', '') END AS part FROM x)
SELECT 'o' || (conv_id % 7) || '/r/pull/' || conv_id AS pull_guid, length(string_agg(part, '' ORDER BY turn)) AS length, string_agg(part, '' ORDER BY turn) AS render FROM p GROUP BY conv_id
HAVING count(*) FILTER (k IN ('R', 'C')) > 0 AND bool_or(k = 'P' AND whole IS NOT NULL) AND length(string_agg(part, '' ORDER BY turn)) BETWEEN 200 AND 1000000""")
def pull_renders(spark: SparkSession, sf_dir: str) -> DataFrame:
    pulls = histories.pull_histories(histories.routed(histories.flat_events(_pulls(spark, sf_dir)))[1])
    return pull_render.render(pulls, _pairs(spark, sf_dir), pull_render.Params(randomness=False)).select("pull_guid", "length", "render")


@query("""
SELECT user_id AS github_id, 'u' || (user_id % 50) AS full_name, nullif(count(*) FILTER (event_type = 'view'), 0) AS star_events_count, nullif(count(*) FILTER (event_type = 'error' AND value > 80), 0) AS fork_events_count FROM events GROUP BY user_id""")
def repo_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("event_type") == "view", "WatchEvent").when((F.col("event_type") == "error") & (F.col("value") > 80), "ForkEvent").otherwise("PushEvent")
    name = F.concat(F.lit("u"), (F.col("user_id") % 50).cast("string"))
    raw = table(spark, sf_dir, "events").select(kind.alias("type"), F.struct(F.col("user_id").alias("id"), name.alias("name")).alias("repo"))
    return repo_merge.activity(raw)


@query("""
WITH f AS (SELECT regexp_extract(url, '://([^/?#]*)', 1) AS directory_id, regexp_extract(url, '://[^/?#]*([^?#]*)', 1) || '/' || page_id AS path, 'b' || (page_id % 90) AS blob_id,
    CASE (page_id % 90) % 5 WHEN 0 THEN ['MIT'] WHEN 1 THEN ['GPL-3.0'] ELSE [] END AS licenses FROM pages),
r AS (SELECT DISTINCT directory_id, CASE length(directory_id) % 3 WHEN 0 THEN 'MIT' WHEN 1 THEN 'NOASSERTION' END AS repo, length(directory_id) % 4 AS stars FROM f),
b AS (SELECT directory_id, regexp_extract(path, '^(.*/)', 1) AS base, flatten(list(licenses)) AS found FROM f WHERE len(licenses) > 0 GROUP BY ALL),
o AS (SELECT directory_id, path, blob_id FROM (SELECT f.*, row_number() OVER (PARTITION BY blob_id ORDER BY repo IN ('MIT') DESC NULLS LAST, stars DESC NULLS LAST, f.directory_id, path) AS n FROM f JOIN r ON f.directory_id = r.directory_id) WHERE n = 1),
d AS (SELECT o.directory_id, path, blob_id, list_sort(list_distinct(coalesce(flatten(list(found)), []))) AS found FROM o LEFT JOIN b ON o.directory_id = b.directory_id AND starts_with(path, base) GROUP BY ALL)
SELECT blob_id, d.directory_id, path, array_to_string(found, ',') AS detected, CASE WHEN repo = 'MIT' THEN 'permissive' WHEN len(found) = 0 THEN CASE WHEN repo IS NULL THEN 'no_license' ELSE 'non_permissive' END
  WHEN found = ['MIT'] THEN 'permissive' ELSE 'non_permissive' END AS license_type FROM d JOIN r ON d.directory_id = r.directory_id""")
def typed_license_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    host, path = F.regexp_extract("url", "://([^/?#]*)", 1), F.regexp_extract("url", "://[^/?#]*([^?#]*)", 1)
    blob = F.concat(F.lit("b"), (F.col("page_id") % 90).cast("string"))
    pages = table(spark, sf_dir, "pages").select(host.alias("directory_id"), F.concat(path, F.lit("/"), F.col("page_id").cast("string")).alias("path"), blob.alias("content_id"), blob.alias("blob_id"), (F.col("page_id") % 90).alias("k"))
    found = F.expr("CASE k % 5 WHEN 0 THEN array('MIT') WHEN 1 THEN array('GPL-3.0') ELSE array() END")
    contents = pages.select("blob_id", found.alias("licenses")).distinct()
    n = F.length("directory_id")
    repos = pages.select("directory_id").distinct().select("directory_id", F.when(n % 3 == 0, "MIT").when(n % 3 == 1, "NOASSERTION").alias("gha_license_id"), (n % 4).alias("star_events_count"), F.lit(0).alias("fork_events_count"), F.lit(0).alias("revision_date"), F.lit(0).alias("visit_date"))
    typed = license_typing.typed_files(pages.drop("k"), contents, repos, ("MIT",))
    return typed.select("blob_id", "directory_id", "path", F.array_join("detected_licenses", ",").alias("detected"), "license_type")


@query("""
WITH b AS (SELECT l_orderkey AS k, 'p' || (l_partkey % 9) AS path, arg_max(l_suppkey, (l_linenumber, l_partkey, l_suppkey)) AS v FROM lineitem WHERE l_linenumber <= 4 GROUP BY ALL),
h AS (SELECT l_orderkey AS k, 'p' || (l_partkey % 9) AS path, arg_max(l_suppkey, (l_linenumber, l_partkey, l_suppkey)) AS v FROM lineitem WHERE l_linenumber > 2 GROUP BY ALL)
SELECT k AS l_orderkey, string_agg(path || ':' || b.v || '>' || h.v, ' ' ORDER BY path) AS files, count(*) AS num_diff_files FROM b JOIN h USING (k, path) GROUP BY k""")
def commit_file_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    file = F.struct("l_linenumber", "l_partkey", "l_suppkey", F.concat(F.lit("p"), (F.col("l_partkey") % 9).cast("string")).alias("path"))
    side = lambda keep: F.sort_array(F.collect_list(F.when(keep, file)))
    commits = items.groupBy("l_orderkey").agg(side(F.col("l_linenumber") <= 4).alias("base_files"), side(F.col("l_linenumber") > 2).alias("head_files"))
    shown = F.transform("head_base_files", lambda f: F.concat(f["base"]["path"], F.lit(":"), f["base"]["l_suppkey"].cast("string"), F.lit(">"), f["head"]["l_suppkey"].cast("string")))
    return joins.paired_files(commits, ["l_orderkey"]).select("l_orderkey", F.array_join(shown, " ").alias("files"), "num_diff_files")


@query("""
WITH s AS (SELECT 'u' || user_id AS u, list(DISTINCT CASE event_type WHEN 'view' THEN 'all' WHEN 'click' THEN 'Commits' WHEN 'error' THEN 'GitHub issue' ELSE event_type || '/r' END) AS scopes FROM events WHERE value > 95 GROUP BY 1)
SELECT 'user_repos' AS kind, u AS name FROM s WHERE list_contains(scopes, 'all') UNION SELECT 'user_commits', u FROM s WHERE list_has_any(scopes, ['all', 'Commits']) UNION SELECT 'user_issues', u FROM s WHERE list_has_any(scopes, ['all', 'GitHub issue'])
UNION SELECT 'repo', x FROM (SELECT unnest(scopes) AS x FROM s) WHERE x NOT IN ('all', 'Commits', 'GitHub issue')""")
def opt_out_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    scope = F.expr("CASE event_type WHEN 'view' THEN 'all' WHEN 'click' THEN 'Commits' WHEN 'error' THEN 'GitHub issue' ELSE concat(event_type, '/r') END")
    listed = table(spark, sf_dir, "events").filter("value > 95").groupBy(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("user")).agg(F.collect_set(scope).alias("scopes"))
    return joins.opt_out_lists(listed)


@query("""
SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN true WHEN turn % 3 = 1 THEN false ELSE true END AS compiles FROM conversations""")
def syntax_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.when(F.col("turn") % 3 == 0, "x = 1").when(F.col("turn") % 3 == 1, "x = = 1").otherwise("def f():\n    return 2")
    return _turns(spark, sf_dir).select("conv_id", "turn", notebooks.compiles(code).alias("compiles"))


@query("""
SELECT 'documents' AS dataset, doc_id AS id, n_chars FROM documents UNION ALL SELECT 'conversations', conv_id * 1000 + turn, length(text) FROM conversations""")
def concatenated_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.lit("documents").alias("dataset"), F.col("doc_id").alias("id"), "n_chars")
    turns = _turns(spark, sf_dir).select(F.lit("conversations").alias("dataset"), (F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.length("text").cast("long").alias("n_chars"))
    return docs.unionByName(turns)
