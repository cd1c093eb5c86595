"""One query per operator with its production parameters, and the SQL that expresses it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltmill.llm import html_blocks, jaccard_forest, language_id, line_ratio, maxent_lm, periodic_runs, piece_sampling, rule_ledger, shard_table, source_divergence, source_mix, url_automaton, vector_hash
from siltmill.llm.tables import WORD, new_path, table, written


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_forest.near_duplicates(table(spark, sf_dir, "documents")).withColumnRenamed("component_id", "class_id")


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_blocks.extract(table(spark, sf_dir, "pages"), keep=("url",)).select("page_id", "url", "text", "n_chars")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = rule_ledger.verdicts(rule_ledger.ledger(table(spark, sf_dir, "documents")))
    base = F.col("kept_base")
    kept = {"base_failed": ~base, "kept": base & F.col("kept_v1"), "kept_v2": base & F.col("kept_v2")}
    return book.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", *[c.alias(name) for name, c in kept.items()], "fail_bits")


def rule_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of the strictest policy rejects, alone and with others."""
    return rule_ledger.ablations(rule_ledger.ledger(table(spark, sf_dir, "documents")), rule_ledger.POLICIES[-1])


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_automaton.filter_urls(table(spark, sf_dir, "pages"))


def op5_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_hash.near_duplicates(table(spark, sf_dir, "embeddings")).select("vec_id", "n_links", "component_id", "copies", "kept")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_table.place(table(spark, sf_dir, "documents").select("doc_id"), "doc_id")


def sharded_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents written to their shards and read back, as the folders name them."""
    path = new_path(spark, "shards")
    shard_table.write_shards(table(spark, sf_dir, "documents"), path, "doc_id")
    back = spark.read.parquet(path)
    return back.select("doc_id", "slot", "shard", F.length("text").cast("long").alias("n_chars"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sizes = written(docs.select("doc_id", "source", source_mix.text_size(F.col("text")).alias("size")), "sizes")  # read twice
    mixed = source_mix.mix(sizes, size_col="size")
    return mixed.select("doc_id", "size", "source_size", "target", "copies", "taken")


def op9_piece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = piece_sampling.sample_encodings(table(spark, sf_dir, "documents"))
    size = F.coalesce(F.size("pieces"), F.lit(0)).cast("long")
    return drawn.select("doc_id", "sample", F.greatest(size, F.lit(0)).alias("n_pieces"), F.xxhash64("pieces").alias("pieces_digest"), "log_prob", "perturbed", "log_inclusion", "decodes")


def piece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's first drawn segmentation, decoded."""
    first = piece_sampling.sample_encodings(table(spark, sf_dir, "documents")).filter("sample = 1")
    return piece_sampling.decode(first).select("doc_id", "text")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_ratio.drop_boilerplate(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))


def with_tails(docs: DataFrame) -> DataFrame:
    """doc_id, text of documents; every tenth by the CRC-32 of its id repeats a period from some word to its end. Ids
    that are null have no digest and keep their text."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORD), F.lit(0))
    chosen = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("w"), F.floor(h / 10).alias("g"))
    n = F.size("w").cast("long")
    placed = chosen.select("*", F.when(n > 0, F.col("g") % n).alias("a")).select("*", (1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8))).alias("p"))
    place = lambda x, i: F.when(i < F.col("a"), x).otherwise(F.get("w", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")))
    return placed.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(F.transform("w", place), " ")).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find_runs(with_tails(table(spark, sf_dir, "documents").select("doc_id", "text")))
    longer = lambda a, b: F.when(a.isNull() | (b["length"] * a["period"] > a["length"] * b["period"]), b).otherwise(a)
    best = F.aggregate("runs", F.lit(None).cast(periodic_runs.RUN), longer)  # the runs are in the order that ties take
    rows = F.array_join(F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))), "")
    digests = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("b"), F.sha2(rows.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
    return digests.select("doc_id", "n_runs", "b.*", F.expr("1000 * b.length div b.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.audit(table(spark, sf_dir, "documents"))


def op13_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent_lm.score_texts(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_jaccard_join,
        op2_html_text,
        op3_quality_rules,
        op4_url_filter,
        op5_vector_dedup,
        op6_sharding,
        op7_language_id,
        op8_source_mix,
        op9_piece_sampling,
        op10_line_dedup,
        op11_periodic_runs,
        op12_source_divergence,
        op13_lm_scoring,
        rule_ablations,
        sharded_documents,
        piece_round_trip,
    )
}

_WORD = r"[^\x20\x09-\x0D]+"
_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
#: The smallest row that each row reaches by the links l(a, b).
_REACH = """r(id, root) AS (SELECT id, id FROM rows UNION SELECT b, root FROM r JOIN l ON a = id WHERE root < b),
m AS (SELECT id, min(root) AS root FROM r GROUP BY id), c AS (SELECT a AS id, count(*) AS links, count(*) FILTER (equal) AS copies FROM l GROUP BY a)"""

_LEDGER = rf"""
WITH w AS (SELECT doc_id, text, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS words,
             list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS lines FROM documents),
windows AS (SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS gram
            FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
often AS (SELECT doc_id, gram FROM windows GROUP BY ALL HAVING count(*) > 1),
places AS (SELECT DISTINCT doc_id, i + d AS place FROM windows JOIN often USING (doc_id, gram), (SELECT unnest([0, 1, 2]) AS d)),
repeats AS (SELECT doc_id, count(*) AS n FROM places GROUP BY doc_id),
m AS (SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
        CAST(length(coalesce(text, '')) - length(regexp_replace(coalesce(text, ''), '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words, len(lines) AS n_lines
      FROM w LEFT JOIN repeats ON w.doc_id = repeats.doc_id),
f AS (SELECT *, n_words < 50 AS f0, 100 * n_repeat_words > 50 * n_words AS f1, 10 * n_symbols > 5 * n_words AS f2,
        word_chars < 2 * n_words AS f3, word_chars > 20 * n_words AS f4, 100 * n_dup_lines > 50 * n_lines AS f5 FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  CAST(f0::INT + 2 * f1::INT + 4 * f2::INT + 8 * f3::INT + 16 * f4::INT + 32 * f5::INT AS BIGINT) AS fail_bits,
  f0 OR f1 AS base_failed, NOT (f0 OR f1 OR f2 OR f3 OR f4) AS kept, NOT (f0 OR f1 OR f2 OR f3 OR f4 OR f5) AS kept_v2 FROM f"""
_NAMES = [r.name for r in rule_ledger.RULES]
#: Each rule of the last policy, which has them all, by its bit.
_ABLATIONS = f"""
WITH b AS (SELECT fail_bits FROM ({_LEDGER})), r AS (SELECT unnest({_NAMES}) AS rule, unnest({[1 << r.bit for r in rule_ledger.RULES]}) AS bit)
SELECT rule, count(*) FILTER (fail_bits & bit <> 0) AS n_failed, count(*) FILTER (fail_bits = bit) AS n_failed_alone, count(*) FILTER (fail_bits & ~bit = 0) AS n_kept_without FROM b, r GROUP BY rule"""
_PLACED = f"""
WITH RECURSIVE m AS (SELECT {shard_table.SLOTS} AS m, {len(shard_table.SHARDS)} AS n),
s AS (SELECT i, 'shard-' || lpad(i::VARCHAR, 2, '0') AS shard FROM (SELECT unnest(range(n)) AS i FROM m)),
p AS (SELECT i, list_transform(range(m), lambda j: (('0x' || left(md5('offset:' || shard), 15))::BIGINT % m + j * (('0x' || left(md5('skip:' || shard), 15))::BIGINT % (m - 1) + 1)) % m) AS slots FROM s, m),
t(turn, owner, claimed) AS (
  SELECT 0, [], []::BIGINT[]
  UNION ALL
  SELECT turn + 1, [(turn % n)::BIGINT], list_append(claimed, list_filter(slots, lambda x: NOT list_contains(claimed, x))[1])
  FROM t, m, p WHERE turn < m AND p.i = turn % n),
owners AS (SELECT claimed[turn] AS slot, (turn - 1) % n AS i FROM t, m WHERE turn > 0)
SELECT doc_id, CAST(o.slot AS INTEGER) AS slot, shard{{more}}
FROM (SELECT doc_id, text, ('0x' || left(md5(coalesce(doc_id::VARCHAR, '')), 15))::BIGINT % m AS k FROM documents, m) d JOIN owners o ON o.slot = d.k JOIN s USING (i)"""

ORACLE = {
    "op1_jaccard_join": rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
        ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS gram FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b, shared = x.n AND shared = y.n AS equal FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 5 * shared >= 4 * (x.n + y.n - shared)),
rows AS (SELECT doc_id AS id FROM documents), {_REACH}
SELECT m.id AS doc_id, root AS class_id, 1 + coalesce(copies, 0) AS copies, coalesce(links, 0) AS n_links, m.id = root AS kept FROM m LEFT JOIN c ON c.id = m.id""",
    "op5_vector_dedup": f"""
WITH RECURSIVE e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
u AS (SELECT * FROM e WHERE len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
l AS (SELECT x.vec_id AS a, y.vec_id AS b, x.v = y.v AS equal FROM u x JOIN u y ON x.vec_id <> y.vec_id AND len(x.v) = len(y.v) WHERE list_cosine_similarity(x.v, y.v) >= 0.95),
rows AS (SELECT vec_id AS id FROM embeddings), {_REACH}
SELECT m.id AS vec_id, root AS component_id, 1 + coalesce(copies, 0) AS copies, coalesce(links, 0) AS n_links, m.id = root AS kept FROM m LEFT JOIN c ON c.id = m.id""",
    # for pages that mark an article of paragraphs, titles, bold words and line breaks, as those of the test tables do
    "op2_html_text": r"""
WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '<article[^>]*>(.*)</article>', 1, 's') AS h FROM pages),
b AS (SELECT page_id, url, string_split(regexp_replace(regexp_replace(regexp_replace(h, '</?(p|h1)>', chr(1), 'g'), '<br>', ' ', 'g'), '</?b>', '', 'g'), chr(1)) AS blocks FROM a),
t AS (SELECT page_id, url, array_to_string(list_filter(list_transform(blocks, lambda x: trim(regexp_replace(regexp_replace(replace(x, '&quot;', '"'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))), lambda x: x <> ''), ' ') AS text FROM b)
SELECT page_id, url, text, length(text) AS n_chars FROM t""",
    "piece_round_trip": "SELECT doc_id, text FROM documents",
    "op3_quality_rules": _LEDGER,
    "rule_ablations": _ABLATIONS,
    "op4_url_filter": r"""
WITH u AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path FROM pages),
r(name, h, p, v) AS (VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
                            ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
b AS (SELECT page_id, host, path, arg_max(name, length(name)) AS name, arg_max(v, length(name)) AS v
      FROM u LEFT JOIN r ON ends_with('.' || host, '.' || h) AND starts_with(path, p) GROUP BY ALL)
SELECT page_id, host, path, name AS rule, coalesce(v, CASE WHEN regexp_matches('.' || host, 'spam|casino|-pills|\.ads-|\.ads\.|porn|poker|viagra') THEN 'block' ELSE 'allow' END) AS verdict FROM b""",
    "op6_sharding": _PLACED.format(more=""),
    "sharded_documents": _PLACED.format(more=", length(text)::BIGINT AS n_chars"),
    "op8_source_mix": rf"""
WITH d AS (SELECT doc_id, source, coalesce(source IS NOT NULL, false) AS named, len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::BIGINT AS size, md5(coalesce(doc_id::VARCHAR, 'size ' || len(regexp_extract_all(coalesce(text, ''), '{_WORD}')))) AS mark FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [1, 2, 3][1 + ((row_number() OVER (ORDER BY source IS NULL, source COLLATE "C") - 1) % 3)::INT] AS weight FROM s),
o AS (SELECT *, sum(3 * source_size) OVER b AS full_before, sum(weight) OVER b AS weight_before, sum(source_size) OVER () AS words, sum(weight) OVER () AS weights
      FROM w WINDOW b AS (ORDER BY source_size / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT *, 3.0::DOUBLE * source_size * (weights - coalesce(weight_before, 0))::DOUBLE <= weight * (words - coalesce(full_before, 0))::DOUBLE AS capped FROM o),
t AS (SELECT source, source_size, CASE WHEN capped THEN (3 * source_size)::DOUBLE
        ELSE (words - coalesce(sum(CASE WHEN capped THEN 3 * source_size END) OVER (), 0))::DOUBLE / (sum(CASE WHEN NOT capped THEN weight END) OVER ())::DOUBLE * weight END AS target FROM c),
k AS (SELECT d.*, CASE WHEN size < 16 THEN size ELSE length(bin(size)) * 8 + (size >> (length(bin(size)) - 4)::INT) - 8 END AS class FROM d),
n AS (SELECT k.doc_id, size, source_size, target, row_number() OVER (PARTITION BY k.source ORDER BY class DESC, left(mark, 2), size DESC, mark, doc_id) AS place,
        coalesce(target / nullif(source_size::DOUBLE, 0), 0) AS each,
        ('0x' || left(md5('mix:' || coalesce('=' || k.source, '')), 8))::BIGINT::DOUBLE / 4294967296 AS shift
      FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source),
e AS (SELECT *, CAST(floor(place * each + shift) - floor((place - 1) * each + shift) AS BIGINT) AS copies FROM n)
SELECT doc_id, size, source_size, target, copies, copies * size AS taken FROM e""",
    "op10_line_dedup": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, text, string_split(text, chr(10)) AS lines FROM documents),
l AS (SELECT source, unnest(list_distinct(list_transform(lines, lambda x: trim(x, {_SPACE})))) AS line FROM d WHERE source IS NOT NULL),
p AS (SELECT source, count(*) AS pages FROM d GROUP BY source),
b AS (SELECT source, list(line) AS keys FROM (SELECT source, line, count(*) AS n FROM l WHERE line <> '' GROUP BY ALL) JOIN p USING (source)
      WHERE n >= {line_ratio.LEAST_PAGES} AND n > CAST({line_ratio.RATIO} AS DOUBLE) * pages GROUP BY source),
c AS (SELECT d.*, CASE WHEN keys IS NULL THEN lines ELSE list_filter(lines, lambda x: trim(x, {_SPACE}) = '' OR NOT list_contains(keys, trim(x, {_SPACE}))) END AS rest FROM d LEFT JOIN b USING (source))
SELECT doc_id, source, array_to_string(rest, chr(10)) AS text, coalesce(len(lines), 0)::BIGINT AS n_lines, (coalesce(len(lines), 0) - coalesce(len(rest), 0))::BIGINT AS n_dropped FROM c""",
    # the CRC-32 bit by bit; equal words that lie p apart, their stretches, and each stretch's smallest period
    "op11_periodic_runs": rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
h AS (SELECT *, len(w)::BIGINT AS n, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''),
        lambda c: [ord(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))), lambda x, e: CASE WHEN e >= 0 THEN xor(x, e) ELSE xor(x >> 1, 3988292384 * (x & 1)) END)) AS h FROM d),
a AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN (h // 10) % n END AS a FROM h),
o AS (SELECT r, doc_id, n, CASE WHEN a IS NULL THEN w ELSE list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) END]) END AS w FROM a),
x AS (SELECT r, n, unnest(w) AS word, unnest(range(n)) AS i FROM o),
e AS (SELECT a.r, b.i - a.i AS p, a.i FROM x a JOIN x b ON a.r = b.r AND a.word = b.word AND b.i > a.i AND b.i - a.i <= a.n // 4),
s AS (SELECT r, p, min(i) AS start, count(*) + p AS length FROM (SELECT r, p, i, i - row_number() OVER (PARTITION BY r, p ORDER BY i) AS island FROM e) GROUP BY r, p, island),
u AS (SELECT r, start, length, min(p) AS period FROM s WHERE length >= greatest(6, 4 * p) GROUP BY r, start, length),
c AS (SELECT r, count(*) AS n_runs, list({{'start': start, 'length': length, 'period': period}} ORDER BY length * 1.0::DOUBLE / period DESC, start, period)[1] AS b,
        string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS runs FROM u GROUP BY r),
g AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM u),
k AS (SELECT x.r, string_agg(word, ' ' ORDER BY x.i) AS text FROM x LEFT JOIN g ON g.r = x.r AND g.i = x.i WHERE g.i IS NULL GROUP BY x.r)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, b.start AS start, b.length AS length, b.period AS period, 1000 * b.length // b.period AS exponent_milli,
  sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(text, '')) AS collapsed_sha256
FROM o LEFT JOIN c ON c.r = o.r LEFT JOIN k ON k.r = o.r""",
    "op12_source_divergence": f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
t AS (SELECT r, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS n FROM t GROUP BY ALL HAVING count(DISTINCT r) >= {source_divergence.LEAST_DOCUMENTS}),
c AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN k USING (lang, term) GROUP BY ALL),
g AS (SELECT lang, source, coalesce(total, 0) AS total FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL) USING (lang, source)),
v AS (SELECT lang, count(*) AS v, sum(n) AS total FROM k GROUP BY lang),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000 * (coalesce(c.n, 0) + 2)::HUGEINT) // (g.total + 2 * v)::HUGEINT AS p, 1 + (1000000000 * (k.n + 2)::HUGEINT) // (v.total + 2 * v)::HUGEINT AS q
      FROM g JOIN v USING (lang) JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
f AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
      UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM p WHERE n > 0 AND p > q),
o AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item COLLATE "C") AS rank FROM r)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank FROM o WHERE part = 'pair' OR rank <= {source_divergence.TOP_TERMS}""",
}
