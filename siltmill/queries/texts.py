"""Text functions, content statistics and filters over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltmill.functions import bots, content, licenses, text
from siltmill.operators import instruct, notebooks
from siltmill.plans import pull_render
from siltmill.sources.readers import table

QUERIES, ORACLE = {}, {}


def query(sql: str | None):  # noqa: ANN201
    def add(f):  # noqa: ANN001, ANN202
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


_RULES = ", ".join(f"CASE WHEN regexp_matches(text, '{pattern}') THEN '{name}' END" for name, pattern in licenses.LICENSE_LINES)


@query(f"""
WITH d AS (SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'MIT' WHEN 1 THEN 'GPL-3.0' WHEN 2 THEN 'NOASSERTION' END AS repo, list_filter([{_RULES}], lambda x: x IS NOT NULL) AS found FROM documents)
SELECT doc_id, array_to_string(found, ',') AS detected, CASE
  WHEN repo IN ('MIT', 'Apache-2.0') THEN 'permissive'
  WHEN repo IS NOT NULL AND repo <> 'NOASSERTION' THEN 'non_permissive'
  WHEN len(found) = 0 THEN CASE WHEN repo IS NULL THEN 'no_license' ELSE 'non_permissive' END
  WHEN len(list_filter(found, lambda x: x NOT IN ('MIT', 'Apache-2.0'))) > 0 THEN 'non_permissive' ELSE 'permissive' END AS license_type FROM d""")
def license_type_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    repo = F.expr("CASE doc_id % 5 WHEN 0 THEN 'MIT' WHEN 1 THEN 'GPL-3.0' WHEN 2 THEN 'NOASSERTION' END")
    docs = table(spark, sf_dir, "documents").select("doc_id", repo.alias("repo"), licenses.detected_licenses(F.col("text")).alias("found"))
    return docs.select("doc_id", F.array_join("found", ",").alias("detected"), licenses.license_type(F.col("repo"), F.col("found"), ("MIT", "Apache-2.0")).alias("license_type"))


_NAMES = "['LICENSE', 'license.txt', 'COPYING3', 'MIT-LICENSE.md', 'main.py', 'gpl-3.0.txt', 'my_unlicense', 'readme.md', 'permit.c', 'al2.0', 'BSDL', 'aboutness']"


@query(rf"""
SELECT page_id, name, regexp_matches(name, '{licenses.LICENSE_FILE}') AS is_license FROM (SELECT page_id, {_NAMES}[page_id % 12 + 1] AS name FROM pages)""")
def license_file_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.expr(f"array({_NAMES[1:-1]})")
    named = table(spark, sf_dir, "pages").select("page_id", F.element_at(names, (F.col("page_id") % 12 + 1).cast("int")).alias("name"))
    return named.select("page_id", "name", licenses.is_license_file(F.col("name")).alias("is_license"))


_ENDS = " OR ".join(f"ends_with(n, '{x}')" for x in bots.BOT_ENDS)
_PARTS = " OR ".join(f"contains(n, '{x}')" for x in bots.BOT_PARTS)


@query(f"""
WITH u AS (SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN NULL WHEN 1 THEN 'dependabot' WHEN 2 THEN 'SparkQA' WHEN 3 THEN c_name WHEN 4 THEN 'k8s-' || c_name ELSE lower(c_name) || '-ci' END AS n FROM customer)
SELECT c_custkey, n AS name, n IS NULL OR n IN {bots.BOT_NAMES} OR {_PARTS} OR {_ENDS} AS is_bot FROM u""")
def bot_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.expr("CASE c_custkey % 6 WHEN 0 THEN NULL WHEN 1 THEN 'dependabot' WHEN 2 THEN 'SparkQA' WHEN 3 THEN c_name WHEN 4 THEN concat('k8s-', c_name) ELSE concat(lower(c_name), '-ci') END")
    return table(spark, sf_dir, "customer").select("c_custkey", name.alias("name")).withColumn("is_bot", bots.is_bot_name(F.col("name")))


_STATS = r"""
s AS (SELECT doc_id, lang, text, length(text) AS n, list_transform(l, lambda x: length(x)) AS lengths FROM (
  SELECT *, CASE WHEN p[-1] = '' THEN p[:-2] ELSE p END AS l FROM (SELECT *, string_split(text, chr(10)) AS p FROM documents))),
c AS (SELECT doc_id, lang, text, coalesce(length(regexp_replace(text, '[^\p{L}\p{N}]', '', 'g'))::DOUBLE / nullif(n, 0), 0) AS alphanum_fraction, coalesce(length(regexp_replace(text, '[^\p{L}]', '', 'g'))::DOUBLE / nullif(n, 0), 0) AS alpha_fraction,
  coalesce((n - length(replace(text, '\x', '')))::DOUBLE / nullif(n, 0), 0) AS hex_fraction, len(lengths)::BIGINT AS num_lines, coalesce(list_sum(lengths)::DOUBLE / nullif(len(lengths), 0), 0) AS avg_line_length, coalesce(list_max(lengths), 0)::BIGINT AS max_line_length FROM s)"""
_SIX = "alphanum_fraction, alpha_fraction, hex_fraction, num_lines, avg_line_length, max_line_length"


@query(f"WITH {_STATS} SELECT doc_id, {', '.join(f'round({c}, 9) AS {c}' if 'fraction' in c or 'avg' in c else c for c in _SIX.split(', '))} FROM c")
def content_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = table(spark, sf_dir, "documents").select("doc_id", content.content_stats(F.col("text")).alias("s")).select("doc_id", "s.*")
    return stats.withColumns({c: F.round(c, 9) for c in ("alphanum_fraction", "alpha_fraction", "hex_fraction", "avg_line_length")})


@query(f"""
WITH {_STATS}, k AS (SELECT *, CASE WHEN lang = 'de' THEN 'Markdown' WHEN lang = 'fr' THEN 'RDoc' ELSE 'C' END AS language FROM c)
SELECT doc_id, language FROM k WHERE alphanum_fraction > 0.25 AND hex_fraction < 0.25 AND num_lines < 100000 AND (language IN ('Markdown', 'RDoc') OR (avg_line_length < 100 AND max_line_length < 1000))
  AND (language <> 'Markdown' OR regexp_matches(text, '\\s+(the|be|to|of|and|that|have|with)\\s+'))""")
def content_validity_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    language = F.when(F.col("lang") == "de", "Markdown").when(F.col("lang") == "fr", "RDoc").otherwise("C")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", language.alias("language"))
    return docs.filter(content.is_valid(F.col("text"), F.col("language"))).select("doc_id", "language")


@query("SELECT page_id, array_to_string(list_transform(string_split(html, '<!--'), lambda x: string_split(x, '-->')[-1]), '') AS html FROM pages")
def html_comment_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", text.drop_markup_comments(F.col("html")).alias("html"))


@query("""
SELECT doc_id, CASE WHEN len(l) > 12 THEN array_to_string(l[:7], chr(10)) || chr(10) || '[TRUNCATED]' || chr(10) || array_to_string(l[-5:], chr(10)) ELSE text END AS text FROM (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents)""")
def truncate_long_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.truncate_lines(F.col("text"), 12, 5).alias("text"))


@query(r"""
WITH t AS (SELECT conv_id, turn, text, turn % 3 AS k FROM conversations)
SELECT conv_id, turn, regexp_replace(regexp_replace(CASE k WHEN 0 THEN text WHEN 1 THEN '' ELSE text || chr(10) || chr(10) END, '_{20,}', '', 'g'), '^\s+|\s+$', '', 'g') AS text FROM t""")
def email_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    # turns as replies: plain, quoted after a footer, and signed
    reply = F.when(F.col("turn") % 3 == 0, F.col("text")).when(
        F.col("turn") % 3 == 1, F.concat(F.lit("From: a\n"), F.replace(F.col("text"), F.lit("\n"), F.lit(" ")), F.lit("\nReply to this email directly, view it on GitHub"))
    ).otherwise(F.concat(F.col("text"), F.lit("\n\nSigned-off-by: a b <a@b.c>")))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", text.strip_mail(reply).alias("text"))


@query("""
SELECT doc_id, replace(replace(replace(text, 'the', 'username_0'), 'of', 'username_1'), 'name', 'username_2') AS text FROM documents""")
def anonymise_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.array(*map(F.lit, ("the", "of", "the", "name", "of")))
    return table(spark, sf_dir, "documents").select("doc_id", text.anonymised(F.col("text"), names).alias("text"))


@query("SELECT event_id, (props->>'$.k')::BIGINT AS k, (props->>'$.missing') AS missing FROM events")
def json_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = F.from_json("props", "k bigint, missing string")
    return table(spark, sf_dir, "events").select("event_id", parsed.alias("p")).select("event_id", "p.k", "p.missing")


@query(r"""
SELECT doc_id, CASE WHEN contains(t, 'Kaggle bot') OR contains(t, 'Thank You') THEN '' ELSE t END AS text FROM (
  SELECT doc_id, regexp_replace(regexp_replace(CASE doc_id % 4 WHEN 0 THEN '<b>' || text || '</b>' || chr(10) || chr(10) || 'x' WHEN 1 THEN 'Thank You ' || text ELSE text END, '<.*?>', '', 'g'), '\n+', chr(10), 'g') AS t FROM documents)""")
def markdown_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = F.expr("CASE doc_id % 4 WHEN 0 THEN concat('<b>', text, '</b>\\n\\nx') WHEN 1 THEN concat('Thank You ', text) ELSE text END")
    return table(spark, sf_dir, "documents").select("doc_id", text.clean_markdown(marked).alias("text"))


@query(r"""
SELECT doc_id, array_to_string(list_filter(string_split(code, chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g') <> '' AND NOT regexp_matches(regexp_replace(x, '^\s+', ''), '^(%|!|cd |pip |apt |wget )') AND length(regexp_replace(x, '^\s+|\s+$', '', 'g')) <= 600 AND NOT contains(x, 'Copyright (C)')), chr(10)) AS code FROM (
  SELECT doc_id, '%matplotlib inline' || chr(10) || ' !ls' || chr(10) || '# Copyright (C) x' || chr(10) || chr(10) || text AS code FROM documents)""")
def code_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.concat(F.lit("%matplotlib inline\n !ls\n# Copyright (C) x\n\n"), F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", text.clean_code(code).alias("code"))


@query("""
SELECT page_id, regexp_extract(path, '^(.*/)', 1) AS base_path, string_split(path, '/')[-1] AS name, regexp_extract(string_split(path, '/')[-1], '^.+\\.([^.]+)$', 1) AS suffix, left(md5(path), 2) AS prefix
FROM (SELECT page_id, regexp_extract(url, '://[^/?#]*([^?#]*)', 1) AS path FROM pages)""")
def path_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.col("path")
    pages = table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("url", "://[^/?#]*([^?#]*)", 1).alias("path"))
    return pages.select("page_id", text.base_path(path).alias("base_path"), text.base_name(path).alias("name"), text.suffix(path).alias("suffix"), F.substring(F.md5(path.cast("binary")), 1, 2).alias("prefix"))


@query("""
SELECT page_id, p[-4] || '/' || p[-3] || '/pull/' || p[-1] AS guid FROM (SELECT page_id, string_split('https://api.host/repos/owner' || page_id || '/repo/pulls/' || page_id, '/') AS p FROM pages)""")
def pull_guids(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("page_id").cast("string")
    return table(spark, sf_dir, "pages").select("page_id", text.pull_guid(F.concat(F.lit("https://api.host/repos/owner"), key, F.lit("/repo/pulls/"), key)).alias("guid"))


@query("""
SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'a/b' || page_id || '.csv' WHEN 1 THEN 'set/f.csv' END AS dataset FROM pages""")
def csv_path_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.expr("CASE page_id % 3 WHEN 0 THEN concat('../input/a/b', page_id, '.csv') WHEN 1 THEN '/kaggle/input/set/f.csv' ELSE '../input/alone.csv' END")
    return table(spark, sf_dir, "pages").select("page_id", text.csv_path(path).alias("dataset"))


@query("""
SELECT conv_id, turn, CASE WHEN length(text) > 120 THEN left(text, 120) || '...' ELSE text END AS shown, contains(text, repeat('.', 16)) AS is_progress FROM conversations""")
def output_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", text.cap_output(F.col("text"), 120).alias("shown"), text.is_progress(F.col("text")).alias("is_progress"))


@query("""
SELECT event_id, '@@ -' || (event_id + 5 - user_id % 5) || ',3 +' || (event_id + 9 - user_id % 5) || ' @@ def f' AS header FROM events""")
def hunk_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    header = F.concat(F.lit("@@ -"), (F.col("event_id") + 5).cast("string"), F.lit(",3 +"), (F.col("event_id") + 9).cast("string"), F.lit(" @@ def f"))
    return table(spark, sf_dir, "events").select("event_id", text.shifted_hunk(header, F.col("user_id") % 5).alias("header"))


@query("""
SELECT doc_id, x.name, (x.len)::BIGINT AS n_chars FROM (SELECT doc_id, unnest([{'name': 'raw', 'len': length(text)}, {'name': 'stripped', 'len': length(CASE WHEN starts_with(text, 'The ') THEN regexp_replace(substr(text, 5), '^\\s+|\\s+$', '', 'g') ELSE text END)}]) AS x FROM documents)""")
def strip_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = F.array(F.struct(F.lit("raw").alias("name"), F.col("text")), F.struct(F.lit("stripped").alias("name"), text.strip_prefix(F.col("text"), "The ").alias("text")))
    return table(spark, sf_dir, "documents").select("doc_id", F.explode(both).alias("x")).select("doc_id", "x.name", F.length("x.text").cast("long").alias("n_chars"))


@query("SELECT c_custkey, c_name || chr(65533) || 'é' AS name FROM customer")
def decoded_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.concat(F.col("c_name").cast("binary"), F.unhex(F.lit("FF")), F.lit("é").cast("binary"))
    return table(spark, sf_dir, "customer").select("c_custkey", text.utf8_text(raw).alias("name"))


@query(r"""
WITH t AS (SELECT conv_id, turn, regexp_replace(text, '^\s+|\s+$', '', 'g') AS text, string_split(regexp_replace(text, '^\s+|\s+$', '', 'g'), chr(10))[1] AS head FROM conversations)
SELECT conv_id, turn, CASE turn % 4 WHEN 0 THEN text WHEN 1 THEN head || chr(10) || text || chr(10) || 'On 1/2/2020 10:11 AM a@b.c wrote' WHEN 2 THEN text ELSE 'first' || chr(10) || 'first' || chr(10) || 'x notifications@github.com y' || chr(10) || text END AS text
FROM (SELECT * REPLACE (CASE WHEN turn % 4 = 1 THEN head ELSE text END AS text) FROM t)""")
def mail_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies without a whole pattern: quoted above, quoted below, behind a footer, and with the service's address."""
    own, head = F.col("text"), F.get(F.split("text", "\n"), F.lit(0))
    reply = (
        F.when(F.col("turn") % 4 == 0, F.concat(F.lit("> quoted\n> more\n"), own))
        .when(F.col("turn") % 4 == 1, F.concat(head, F.lit("\nOn 1/2/2020 10:11 AM a@b.c wrote")))
        .when(F.col("turn") % 4 == 2, F.concat(F.lit("footer\nReply to this email directly:\nits last line\n"), own, F.lit("\n"), F.repeat(F.lit("_"), 30)))
        .otherwise(F.concat(F.lit("first\nx notifications@github.com y\n"), own))
    )
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", text.strip_mail(reply).alias("text"))


@query("""
WITH t AS (SELECT conv_id, turn, left(replace(text, chr(10), ' '), 8 + (conv_id % 40)::INT) || CASE turn % 5 WHEN 1 THEN ' Release' WHEN 2 THEN ' dependency' ELSE '' END AS title FROM conversations)
SELECT conv_id, turn, CASE WHEN length(title) >= 10 AND NOT regexp_matches(lower(title), 'depend|release') THEN 'Title: ' || title || chr(10) END AS title FROM t""")
def rendered_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    end = F.expr("CASE turn % 5 WHEN 1 THEN ' Release' WHEN 2 THEN ' dependency' ELSE '' END")
    title = F.concat(F.substring(F.replace("text", F.lit("\n"), F.lit(" ")), F.lit(1), (8 + F.col("conv_id") % 40).cast("int")), end)
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", pull_render.rendered_title(title).alias("title"))


@query(r"""
WITH t AS (SELECT conv_id, turn, role, regexp_replace(text, '^\s+|\s+$', '', 'g') AS text FROM conversations),
c AS (SELECT *, CASE turn % 4 WHEN 0 THEN text WHEN 1 THEN left(text, 15) WHEN 2 THEN text || ' see CodeCov' ELSE text || '<!-- note --> end' END AS said, CASE turn % 4 WHEN 3 THEN text || ' end' WHEN 1 THEN left(text, 15) ELSE text END AS shown FROM t)
SELECT conv_id, turn, CASE WHEN turn % 4 = 2 THEN role || ': [OMITTED]CodeCov' WHEN length(shown) >= 20 THEN role || ': ' || left(shown, 1000) END AS said FROM c""")
def rendered_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = F.regexp_replace("text", r"^\s+|\s+$", "")
    said = F.when(F.col("turn") % 4 == 0, own).when(F.col("turn") % 4 == 1, F.substring(own, 1, 15)).when(F.col("turn") % 4 == 2, F.concat(own, F.lit(" see CodeCov"))).otherwise(F.concat(own, F.lit("<!-- note --> end")))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", pull_render.rendered_text(F.col("role"), said).alias("said"))


@query("""
SELECT page_id, CASE page_id % 2 WHEN 0 THEN 'easy' ELSE 'hard' END AS difficulty, 'field' || page_id % 9 AS field, 'topic_' || page_id AS topic FROM pages""")
def math_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("page_id")
    name = F.concat(F.lit("file:/data/train-"), F.when(k % 2 == 0, "easy").otherwise("hard"), F.lit("/field"), (k % 9).cast("string"), F.lit("__topic_"), k.cast("string"), F.lit(".txt"))
    difficulty, field, topic = instruct.math_file(name)
    return table(spark, sf_dir, "pages").select("page_id", difficulty.alias("difficulty"), field.alias("field"), topic.alias("topic"))


@query("""
WITH p AS (SELECT doc_id, string_split(text, 'the ') AS p FROM documents),
s AS (SELECT doc_id, list_filter(list_transform(p, lambda x, i: CASE WHEN i = 1 THEN x ELSE 'the ' || x END), lambda x: x <> '') AS s FROM p)
SELECT doc_id, len(s) AS n_pieces, coalesce(list_max(list_transform(s, lambda x: length(x))), 0) AS longest, array_to_string(s, '|') AS pieces FROM s""")
def marked_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = text.split_before(F.col("text"), ("the ", "no such mark"))
    longest = F.coalesce(F.array_max(F.transform("s", F.length)), F.lit(0)).cast("long")
    return table(spark, sf_dir, "documents").select("doc_id", s.alias("s")).select("doc_id", F.size("s").cast("long").alias("n_pieces"), longest.alias("longest"), F.array_join("s", "|").alias("pieces"))


@query(r"""
WITH w AS (SELECT conv_id, turn, unnest(list_concat(string_split(text, ' '), ['for', 'x.y(1)', ' None ', 'a b', 'f()+1', '-x'])) AS word FROM conversations)
SELECT conv_id, turn, count(*) AS n_words, count(*) FILTER (regexp_full_match(regexp_replace(word, '^\s+|\s+$', '', 'g'), '\w[\w.()+]*') AND trim(word) NOT IN ('for', 'None', 'in', 'is', 'as', 'or', 'not', 'and', 'if', 'with', 'from', 'try', 'del', 'pass')) AS n_names FROM w GROUP BY ALL""")
def identifier_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    more = F.array(*map(F.lit, ("for", "x.y(1)", " None ", "a b", "f()+1", "-x")))
    words = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.explode(F.concat(F.split("text", " ", -1), more)).alias("word"))
    return words.groupBy("conv_id", "turn").agg(F.count(F.lit(1)).alias("n_words"), F.count_if(text.is_identifier(F.col("word"))).alias("n_names"))


@query("SELECT conv_id, count(*) FILTER (role = 'user') / count(*)::DOUBLE AS share FROM conversations GROUP BY conv_id")
def markdown_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    types = F.collect_list(F.when(F.col("role") == "user", "markdown").otherwise("code"))
    return table(spark, sf_dir, "conversations").groupBy("conv_id").agg(types.alias("t")).select("conv_id", content.markdown_share(F.col("t")).alias("share"))


@query("""
SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '../input/a/' || doc_id || '.csv|x.csv' WHEN 1 THEN '' WHEN 2 THEN 'd' || doc_id || '.csv' ELSE '' END AS paths, CASE doc_id % 4 WHEN 0 THEN 'a/' || doc_id || '.csv' ELSE '' END AS sets FROM documents""")
def read_csv_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Programs that read two files, one by a variable, one after a magic, and none that can be parsed."""
    k = F.col("doc_id").cast("string")
    quoted = F.concat(F.lit("note = "), F.to_json(F.struct(F.col("text").alias("t"))), F.lit("\n"))
    code = (
        F.when(F.col("doc_id") % 4 == 0, F.concat(quoted, F.lit("import pandas as pd\na = pd.read_csv(' ../input/a/"), k, F.lit(".csv')\nif a:\n    b = pd.read_csv('x.csv', sep=';')\n")))
        .when(F.col("doc_id") % 4 == 1, F.concat(quoted, F.lit("pd.read_csv(path)\nread_csv('plain.csv')\n")))
        .when(F.col("doc_id") % 4 == 2, F.concat(F.lit("%matplotlib inline\n"), quoted, F.lit("x = pd.read_csv('d"), k, F.lit(".csv')")))
        .otherwise(F.concat(F.lit("pd.read_csv('x.csv'\n"), F.col("text")))
    )
    found = table(spark, sf_dir, "documents").select("doc_id", notebooks.read_csv_paths(code).alias("p"))
    return found.select("doc_id", F.array_join("p", "|").alias("paths"), F.array_join(notebooks.dataset_paths(F.col("p")), "|").alias("sets"))


@query("""
WITH c AS (SELECT conv_id, turn, replace(text, chr(10), ' ') AS text, turn % 5 AS k FROM conversations)
SELECT conv_id, turn, CASE k WHEN 0 THEN '<empty>' WHEN 1 THEN CASE WHEN length(text) > 600 THEN left(text, 600) || '...' ELSE text END WHEN 2 THEN '| h |' || chr(10) || '| --- |' || chr(10) || '| v' || conv_id || '&#124; |' WHEN 3 THEN '**md**' ELSE '<empty>' END AS output FROM c""")
def notebook_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outputs of cells: none, a stream of lines, a table beside its plain text, Markdown beside plain text, a progress bar."""
    k = F.col("turn") % 5
    plain = F.replace("text", F.lit("\n"), F.lit(" "))
    data = lambda **kinds: F.create_map(*[x for name, value in kinds.items() for x in (F.lit(name.replace("_", "/")), value)])
    html = F.concat(F.lit("<div><table><tr><th>h</th></tr><tr><td>v"), F.col("conv_id").cast("string"), F.lit("|</td></tr></table></div>"))
    kinds = F.when(k == 2, data(text_html=html, text_plain=F.lit("no"))).when(k == 3, data(text_markdown=F.lit("**md**"), text_plain=F.lit("no"))).when(k == 4, data(text_plain=F.lit("50%................"), image_png=F.lit("x")))
    output = F.struct(F.when(k == 1, F.concat(plain, F.lit("\n"))).alias("text"), kinds.alias("data"))
    cell = F.struct(F.lit("code").alias("cell_type"), F.lit("x").alias("source"), F.when(k > 0, F.array(output)).alias("outputs"))
    books = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.to_json(F.array(cell)).alias("content"), F.concat_ws("/", "conv_id", "turn").alias("file_id"))
    return notebooks.cells_of(books).select("conv_id", "turn", F.get("cells", F.lit(0))["output"].alias("output"))
