"""How far the sources of a language differ in their terms, by inclusion-exclusion over supports.

The divergence of two sources is a sum over all kept terms of a language, most of which neither source holds. With
p0 and q0 the smoothed shares of a term that a source does not hold, a sum over all terms of f(p, q) is

    V * f(p0, q0)                                            a constant, as if neither held any term
    + sum over terms of the one: f(p, q0) - f(p0, q0)        from the histogram of the source's counts
    + sum over terms of the other: f(p0, q) - f(p0, q0)      likewise
    + sum over terms of both: f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0)    from a join of the postings

so the postings are joined only where both sources hold the term. All arithmetic is on integers.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltmill.llm.tables import written

#: A language keeps the terms of this many of its documents.
LEAST_DOCUMENTS = 10
#: A share of 1; shares are whole numbers of its parts.
WHOLE = 1_000_000_000
#: Terms of a source that are reported, those that it holds more than its language does.
TOP_TERMS = 10
#: Different terms that a task counts before it passes them on.
HELD = 200_000
#: By byte: letters as lower case, bytes of other characters as they are, the rest a space.
_BYTES = bytes(i + 32 if 65 <= i <= 90 else i if 97 <= i <= 122 or i >= 128 else 32 for i in range(256))


def terms(text: bytes) -> list[bytes]:
    """A text's terms in order: runs of letters and of characters beyond ASCII, only A-Z lower-cased."""
    return text.translate(_BYTES).split()


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows lang, source, term, n, docs summed over many texts; the empty term counts a group's documents."""
    n: dict[tuple[str, str], Counter] = {}
    docs: dict[tuple[str, str], Counter] = {}
    held = 0

    def passed_on() -> Iterator[pd.DataFrame]:
        for (lang, source), found in docs.items():
            yield pd.DataFrame({"lang": lang, "source": source, "term": list(found), "n": [n[lang, source][t] for t in found], "docs": list(found.values())})
        n.clear()
        docs.clear()

    for batch in batches:
        for lang, source, text in zip(batch["lang"], batch["source"], batch["text"]):
            key = (lang, source)
            if key not in docs:
                n[key], docs[key] = Counter(), Counter()
            words = terms(text)
            held -= len(docs[key])
            n[key].update(words)
            docs[key].update(set(words))
            docs[key][b""] += 1
            held += len(docs[key])
            if held > HELD:
                yield from passed_on()
                held = 0
    yield from passed_on()


def share(count: Column, total: Column, kept: Column) -> Column:
    """A term's smoothed share of a group, exact however large the counts are."""
    whole = F.lit(WHOLE).cast("decimal(10,0)") * (count + 2).cast("decimal(19,0)")
    return F.expr("1") + F.call_function("div", whole, (total + 2 * kept).cast("decimal(19,0)"))


def gap(p: Column, q: Column) -> Column:
    """One term's part of the divergence; at most WHOLE^2 before the division."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def posting_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents with the term); null texts and labels are empty ones. The empty
    term stands for the group itself: its docs are the group's documents."""
    label = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = docs.select(label(lang_col).alias("lang"), label(source_col).alias("source"), label(text_col).cast("binary").alias("text"))
    found = rows.mapInPandas(_counted, "lang string, source string, term binary, n long, docs long")
    return found.groupBy("lang", "source", F.col("term").cast("string").alias("term")).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least_documents: int = LEAST_DOCUMENTS, top_terms: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank: part `pair` holds a source's divergence from each other source of its language,
    part `term` the terms that it holds most above its language.

    Null texts, languages and sources count as empty ones; texts may be of any length and rows may repeat, each is a
    document. A group without kept terms is compared all the same; a language without kept terms gives pairs of value 0;
    a language of one source has no pairs; an empty table gives no rows. Ties rank by the item's UTF-8 bytes. Other
    columns, whatever their names, are ignored. What grows with the input are the postings, one row a term and group;
    a hot source or language is only many of them, summed before they are shuffled.
    """
    counts = written(posting_counts(docs, text_col, lang_col, source_col), "posting-counts")
    found = counts.filter(F.col("term") != "")
    often = found.groupBy("lang", "term").agg(F.sum("docs").alias("df"), F.sum("n").alias("lang_n")).filter(F.col("df") >= least_documents)
    kept = written(found.join(often, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n"), "kept-postings")

    groups = counts.filter(F.col("term") == "").select("lang", "source")
    sizes = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = kept.groupBy("lang", "term").agg(F.first("lang_n").alias("lang_n")).groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("lang_n").alias("lang_total"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    plain = groups.join(sizes, ["lang", "source"], "left").join(langs, "lang", "left").select("lang", "source", zero("total"), zero("terms"), zero("lang_total"))
    none = F.when(F.col("terms") > 0, share(F.lit(0).cast("long"), F.col("total"), F.col("terms"))).otherwise(F.lit(0).cast("long"))
    groups = written(plain.withColumn("p0", none), "divergence-groups", narrow=True)

    pair = _pairs(kept, groups).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    ranked = pair.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))))
    return ranked.unionByName(_raised(kept, groups, top_terms))


def _pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item (another source of the lang), value."""
    p, p0, q, q0 = (F.col(c) for c in ("p", "p0", "q", "q0"))
    side = groups.filter(F.col("terms") > 0)
    other = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"))
    with_p = side.select("lang", "source", "total", "terms", "p0")

    # a source's terms against sources without them: one row per count
    counts = kept.groupBy("lang", "source", "n").agg(F.count(F.lit(1)).alias("many")).join(with_p, ["lang", "source"])
    counts = counts.select("lang", "source", "p0", "many", share(F.col("n"), F.col("total"), F.col("terms")).alias("p"))
    alone = counts.join(other, "lang").filter(F.col("source") != F.col("item"))
    one_sided = alone.groupBy("lang", "source", "item").agg(F.sum(F.col("many") * (gap(p, q0) - gap(p0, q0))).alias("v"))
    both_ways = one_sided.unionByName(one_sided.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "v"))

    # both hold the term: each pair once, then both ways
    postings = kept.join(with_p, ["lang", "source"]).select("lang", "term", "source", "p0", share(F.col("n"), F.col("total"), F.col("terms")).alias("p"))
    second = postings.select("lang", "term", F.col("source").alias("item"), F.col("p0").alias("q0"), F.col("p").alias("q"))
    met = postings.join(second, ["lang", "term"]).filter(F.col("source") < F.col("item"))
    overlap = met.groupBy("lang", "source", "item").agg(F.sum(gap(p, q) - gap(p, q0) - gap(p0, q) + gap(p0, q0)).alias("v"))
    overlaps = overlap.select("lang", F.explode(F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item")))).alias("e"), "v").select("lang", "e.*", "v")

    each = groups.select("lang", "source", "terms", "p0").join(other, "lang").filter(F.col("source") != F.col("item"))
    floor = each.select("lang", "source", "item", F.when(F.col("terms") > 0, F.col("terms") * gap(p0, q0)).otherwise(F.lit(0).cast("long")).alias("v"))
    return floor.unionByName(both_ways).unionByName(overlaps).groupBy("lang", "source", "item").agg(F.sum("v").alias("value"))


def _raised(kept: DataFrame, groups: DataFrame, top_terms: int) -> DataFrame:
    """The terms that a source holds most above its language; only the first of each task's rows are shuffled."""
    p, q = F.col("p"), F.col("q")
    rows = kept.join(groups.select("lang", "source", "total", "terms", "lang_total"), ["lang", "source"])
    rows = rows.select("lang", "source", F.col("term").alias("item"), share(F.col("n"), F.col("total"), F.col("terms")).alias("p"), share(F.col("lang_n"), F.col("lang_total"), F.col("terms")).alias("q")).filter(p > q)
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item")))
    return rows.select("lang", "source", F.lit("term").alias("part"), "item", gap(p, q).alias("value")).withColumn("rank", rank).filter(F.col("rank") <= top_terms)
