"""Line dedup by site-relative frequency.

Per host, the pages that hold a line are divided by the host's pages; a line on more than a given part of them is the
site's boilerplate and goes from every page of that host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltmill.llm import jaccard_forest
from siltmill.llm.tables import written

#: A line on more than this part of a host's pages is boilerplate.
RATIO = 0.1
#: And only if it is on that many pages at least, so that hosts of a few pages keep their texts.
LEAST_PAGES = 3
#: Digests (of 16 bytes) in all hosts' lists up to which they are broadcast; beyond, they are joined by host, and each
#: list goes to DEALT tasks, so that a host with a third of all pages is no single task's.
DEALT = 64
MOST_BROADCAST = 100_000
_SPACE = " \t\n\x0b\f\r"


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _bare(line: Column) -> Column:
    """A line without the ASCII white space around it: a carriage return before the line feed is none of the line."""
    return F.trim(line, F.lit(_SPACE))


def _key(line: Column) -> Column:
    return F.unhex(F.md5(_bare(line).cast("binary")))


def _keys(text: Column) -> Column:
    return F.array_distinct(F.transform(F.filter(_lines(text), lambda x: _bare(x) != ""), _key))


def _often(lines: DataFrame, pages: DataFrame, ratio: float, least_pages: int) -> DataFrame:
    """host, keys of lines (host, key: a row per page) and pages (host, pages)."""
    counts = lines.groupBy("host", "key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_pages)
    return counts.join(pages, "host").filter(F.col("n") > F.lit(ratio) * F.col("pages")).groupBy("host").agg(F.collect_list("key").alias("keys"))


def _with_lists(rows: DataFrame, host: str, text: str, found: DataFrame, how: str) -> DataFrame:
    """rows with their host's list in __keys; found: __host, __keys. While the digests are few, no text is shuffled."""
    if (found.agg(F.sum(F.size("__keys"))).first()[0] or 0) <= MOST_BROADCAST:
        return rows.join(F.broadcast(found), F.col(host) == F.col("__host"), how).drop("__host")
    lists = found.withColumn("__to", F.explode(F.sequence(F.lit(0), F.lit(DEALT - 1))))
    dealt = rows.withColumn("__deal", F.pmod(F.xxhash64(text), F.lit(DEALT)).cast("int"))
    return dealt.join(lists, (F.col(host) == F.col("__host")) & (F.col("__deal") == F.col("__to")), how).drop("__host", "__deal", "__to")


def boilerplate(docs: DataFrame, text_col: str = "text", host_col: str = "source", ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> DataFrame:
    """host, keys: the digests of each host's boilerplate lines; hosts without any have no row.

    A page counts once for a line, and lines meet by digest, summed before they are shuffled. A host's list stays
    short: its lines' pages add up to its pages' lines, so it has fewer than (lines a page) / ratio entries.
    """
    host, text = F.col(host_col), F.col(text_col)
    pages = docs.filter(host.isNotNull()).groupBy(host.alias("host")).agg(F.count(F.lit(1)).alias("pages"))
    lines = docs.filter(host.isNotNull() & text.isNotNull()).select(host.alias("host"), F.explode(_keys(text)).alias("key"))
    return _often(lines, pages, ratio, least_pages)


def boilerplate_once(docs: DataFrame, text_col: str = "text", host_col: str = "source", ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> DataFrame:
    """boilerplate() that tells repeated documents from repeated lines: a host's copies of a document are one page, and
    so are its near copies (the components of jaccard_forest.near_duplicates), as far as they hold a line that is
    frequent among the host's distinct texts. Null texts are no pages.

    A line must exceed the ratio twice, among distinct texts and among what is left when near copies count once; only
    texts that hold a line of the first kind are compared.
    """
    host, text = F.col(host_col), F.col(text_col)
    rows = docs.filter(host.isNotNull() & text.isNotNull()).select(host.alias("host"), text.alias("text"), _keys(text).alias("keys"))
    mark = F.md5(F.col("text").cast("binary")).alias("mark")
    texts = written(rows.select("host", mark, "keys").distinct(), "texts")
    pages = texts.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    often = written(_often(texts.select("host", F.explode("keys").alias("key")), pages, ratio, least_pages).withColumnsRenamed({"host": "__host", "keys": "__keys"}), "often")
    if often.isEmpty():
        return often.withColumnsRenamed({"__host": "host", "__keys": "keys"})
    held = _with_lists(texts, "host", "mark", often, "inner").select("host", "mark", F.array_intersect("keys", "__keys").alias("keys")).filter(F.size("keys") > 0)
    suspects = written(_with_lists(rows, "host", "text", often, "inner").filter(F.arrays_overlap("keys", "__keys")).groupBy(mark).agg(F.first("text").alias("text")), "suspects")
    alike = jaccard_forest.near_duplicates(suspects, "mark", "text").select("mark", F.col("component_id").alias("alike"))
    groups = written(held.join(alike, "mark").select("host", "alike", "mark", "keys"), "alike")
    less = groups.groupBy("host").agg((F.count(F.lit(1)) - F.count_distinct("alike")).alias("less"))
    left = pages.join(less, "host", "left").select("host", (F.col("pages") - F.coalesce("less", F.lit(0))).alias("pages"))
    return _often(groups.select("host", "alike", F.explode("keys").alias("key")).distinct(), left, ratio, least_pages)


def drop_boilerplate(docs: DataFrame, text_col: str = "text", host_col: str = "source", ratio: float = RATIO, least_pages: int = LEAST_PAGES, once: bool = False) -> DataFrame:
    """docs with the text freed of its host's boilerplate lines, n_lines before and n_dropped; those two replace
    columns of their names.

    Lines are compared without the ASCII white space around them; lines without anything else are never dropped. A null
    text stays null with 0 lines, an empty text is one empty line, a null host has no boilerplate. An empty table gives
    an empty table. Repeated rows count as pages and stay repeated; with `once`, copies and near copies of a document count as one page, see boilerplate_once().
    """
    lists = (boilerplate_once if once else boilerplate)(docs, text_col, host_col, ratio, least_pages)
    found = written(lists.withColumnsRenamed({"host": "__host", "keys": "__keys"}), "boilerplate")
    joined = _with_lists(docs.drop("n_lines", "n_dropped"), host_col, text_col, found, "left").withColumn("__lines", _lines(F.col(text_col)))
    stays = F.filter("__lines", lambda x: (_bare(x) == "") | ~F.array_contains(F.col("__keys"), _key(x)))
    left = joined.withColumn("__left", F.when(F.col("__keys").isNull(), F.col("__lines")).otherwise(stays))
    count = lambda c: F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0)).cast("long")
    out = left.withColumns({"n_lines": count("__lines"), "n_dropped": count("__lines") - count("__left"), text_col: F.array_join("__left", "\n")})
    return out.drop("__keys", "__lines", "__left")
