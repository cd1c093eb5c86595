"""Pull requests as training texts: events, base files and commit diffs in the order in which they happened.

The work is joins, windows and ordered aggregation by pull request; Python only matches the lines of two texts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltmill.functions.text import drop_markup_comments, let, shifted_hunk, strip_mail, truncate_lines
from siltmill.operators import histories as h
from siltmill.operators.dedup import repo_rate, uniform, with_group_size
from siltmill.operators.diffs import change_range, hunks
from siltmill.storage import written

# The marks of a rendered pull request, and the rules that thin out generated files.
PR, STATUS, REPO, MERGED = "<pr>", "<pr_status>", "<repo_name>", "<pr_is_merged>"
BASE, FILE, CODE = "<pr_base>", "<pr_file>", "<pr_base_code>"
DIFF, HUNK = "<pr_diff>", "<pr_diff_hunk>"
COMMENT, EVENT_ID = "<pr_comment>", "<pr_event_id>"
REVIEW, REVIEW_STATE, REVIEW_COMMENT = "<pr_review>", "<pr_review_state>", "<pr_review_comment>"
REPLY_REVIEW, REPLY_COMMENT, HUNK_LINE = "<pr_in_reply_to_review_id>", "<pr_in_reply_to_comment_id>", "<pr_diff_hunk_comment_line>"
MARKS = (PR, STATUS, REPO, MERGED, BASE, FILE, CODE, DIFF, HUNK, COMMENT, EVENT_ID, REVIEW, REVIEW_STATE, REVIEW_COMMENT, REPLY_REVIEW, REPLY_COMMENT, HUNK_LINE)
OMITTED, DIFFS_OMITTED = "[OMITTED]", "[DIFFS OMITTED]"
THINNED = {"YAML": ("pack", "lock", "yarn", "output", "swagger", "openapi"), "JSON": ("pack", "lock", "output")}
TITLE_WORDS = ("depend", "release")
# End of fixed values.


@dataclass(frozen=True)
class Params:
    least_title: int = 10
    most_title: int = 500
    least_text: int = 20
    most_text: int = 1000
    most_hunk: int = 10_000
    full_base_share: float = 0.2
    base_context: int = 32
    hunk_context: int = 3
    thin_share: float = 0.5
    thin_keep: float = 0.1
    least_length: int = 200
    most_length: int = 1_000_000
    #: Off: contexts are half of what they may be, no base file is taken whole, and nothing is sampled.
    randomness: bool = True


def rendered_title(text: Column, p: Params = Params()) -> Column:
    """The title line; null for one too short or of a word that marks automatic requests."""
    cut = truncate_lines(F.coalesce(text, F.lit("")))
    automatic = F.lower(F.coalesce(text, F.lit(""))).rlike("|".join(TITLE_WORDS))
    return F.when((F.length(cut) >= p.least_title) & ~automatic, F.concat(F.lit("Title: "), F.substring(cut, 1, p.most_title), F.lit("\n")))


def rendered_text(user: Column, text: Column, p: Params = Params(), any_length: bool = False) -> Column:
    """`user: text` without mail additions and markup comments; null for a text too short."""

    def shown(mail: Column, cut: Column) -> Column:
        full = F.when(F.length(cut) == 0, user).otherwise(F.concat(user, F.lit(": "), F.substring(cut, 1, p.most_text)))
        fits = F.lit(True) if any_length else F.length(cut) >= p.least_text
        return F.when(mail.contains("Qwiet"), None).when(F.lower(mail).contains("codecov"), F.concat(user, F.lit(f": {OMITTED}CodeCov"))).when(fits, full)

    return let(strip_mail(F.coalesce(text, user)), lambda mail: let(truncate_lines(drop_markup_comments(mail)), lambda cut: shown(mail, cut)))


def _tagged(mark: str, value: Column) -> Column:
    return F.concat(F.lit(mark), value.cast("string"))


def _optional(mark: str, value: Column) -> Column:
    return F.coalesce(_tagged(mark, value), F.lit(""))


def event_text(e: Column, said: Column, opened: Column, skipped: Column, p: Params = Params()) -> Column:
    """One event's text, null if its title or text is rejected. said: struct of the event's rendered text (full) and of
    that whatever its length (any); opened: whether the opening is rendered before the event."""
    user = F.coalesce(e["actor_login"], F.lit(""))
    told = e["action"].isin("opened", "edited", "reopened")
    body = F.when(told, F.concat(rendered_title(e["title"], p), said["full"])).otherwise(user)
    pull = F.concat(
        F.lit(PR),
        body,
        _optional(STATUS, F.lower(e["action"])),
        F.when(opened, F.lit("")).otherwise(_optional(REPO, e["base_repo_name"])),
        F.when(e["action"] == "closed", _optional(MERGED, F.initcap(e["pull_merged"].cast("string")))).otherwise(F.lit("")),
    )
    spoken = F.when(F.coalesce(F.length(e["text"]), F.lit(0)) > 0, said["any"]).otherwise(user)
    review = F.concat(F.lit(REVIEW), spoken, _optional(EVENT_ID, e["review_comment_id"]), _optional(REVIEW_STATE, e["review_state"]))
    lines = F.split(e["comment_diff_hunk"], "\n", -1)
    moved = F.when(lines[0].contains("@@"), F.concat_ws("\n", F.coalesce(shifted_hunk(lines[0], skipped), lines[0]), F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 1, F.lit(0))))).otherwise(e["comment_diff_hunk"])
    hunk = F.concat(F.lit(HUNK), F.when(F.length(moved) > p.most_hunk, F.lit(OMITTED)).otherwise(F.coalesce(moved, F.lit(""))))
    remark = F.concat(
        F.lit(REVIEW_COMMENT),
        _optional(EVENT_ID, e["review_comment_id"]),
        _optional(REPLY_REVIEW, e["comment_pull_request_review_id"]),
        _optional(REPLY_COMMENT, e["comment_in_reply_to_id"]),
        _optional(FILE, e["comment_path"]),
        _optional(HUNK_LINE, e["comment_original_position"]),
        hunk,
        F.lit(COMMENT),
        said["full"],
    )
    talk = F.concat(F.lit(COMMENT), said["full"], _optional(EVENT_ID, e["comment_id"]), _optional(STATUS, F.lower(e["action"])))
    kind = e["type"]
    return F.when(kind == h.PULL, pull).when(kind == h.REVIEW, review).when(kind == h.REVIEW_COMMENT, remark).when(kind == "IssueCommentEvent", talk)


def eligible(pulls: DataFrame, pairs: DataFrame, p: Params = Params()) -> DataFrame:
    """Approved or merged requests on one base whose first commits have a diff; sampled by their repository's number
    of requests. pulls: pull_guid, events; pairs: pull_guid, head_commit_id, base_commit_id, files."""
    counted = with_group_size(pulls.withColumn("__repo", F.split_part("pull_guid", F.lit("/pull/"), F.lit(1))), "__repo", "__in_repo")
    good = counted.filter(((h.approvals(F.col("events")) > 0) | h.is_merged(F.col("events"))) & (h.rebases(F.col("events")) == 0))
    if p.randomness:
        good = good.filter(uniform(F.lit("pull"), F.col("pull_guid")) < repo_rate(F.col("__in_repo")))
    first = h.first_commits(F.col("events"))
    good = good.withColumns({"__head": first["head"], "__base": first["base"]})
    commits = pairs.select("pull_guid", F.col("head_commit_id").alias("__head"), F.col("base_commit_id").alias("__base"))
    return good.join(commits, ["pull_guid", "__head", "__base"], "left_semi").drop("__head", "__base", "__repo", "__in_repo")


def base_files(pairs: DataFrame, p: Params = Params()) -> DataFrame:
    """pull_guid, path, language, start, snippet: each base file's changed stretch over all commits, with context.

    Generated YAML and JSON files, and those that make up most of a request, are thinned out.
    """
    files = pairs.select("pull_guid", "head_commit_id", F.explode("files").alias("f")).select("pull_guid", "head_commit_id", "f.*").filter("base_content IS NOT NULL AND head_content IS NOT NULL")
    ranged = files.withColumn("r", change_range(F.col("base_content"), F.col("head_content")))
    one = ranged.groupBy("pull_guid", F.col("base_path").alias("path")).agg(F.min("r.old_start").alias("lo"), F.max("r.old_end").alias("hi"), F.min_by(F.struct("base_content", "base_language"), "head_commit_id").alias("b"))
    lines = F.split(F.regexp_replace("b.base_content", "\r?\n$", ""), "\r?\n", -1)
    draw = lambda what: uniform(F.lit(what), F.col("pull_guid"), F.col("path"))
    before, after = (F.floor(draw(w) * p.base_context) if p.randomness else F.lit(p.base_context // 2) for w in ("before", "after"))
    whole = draw("whole") < p.full_base_share if p.randomness else F.lit(False)
    placed = one.withColumn("lines", lines).withColumns(
        {
            "start": F.when(whole, 0).otherwise(F.greatest(F.lit(0), F.least(F.col("lo"), F.size("lines")) - before)).cast("int"),
            "stop": F.when(whole, F.size("lines")).otherwise(F.least(F.size("lines"), F.col("hi") + after)).cast("int"),
        }
    )
    name = F.coalesce("b.base_language", F.element_at(F.split("path", "/", -1), -1))
    cut = placed.select("pull_guid", "path", name.alias("language"), "start", F.array_join(F.slice("lines", F.col("start") + 1, F.greatest(F.col("stop") - F.col("start"), F.lit(0))), "\n").alias("snippet"))
    if not p.randomness:
        return cut
    total = F.sum(F.length("snippet")).over(Window.partitionBy("pull_guid"))
    thin = F.lit(False)
    for language, keys in THINNED.items():
        generated = F.col("path").rlike("|".join(keys)) | (F.length("snippet") / F.greatest(total, F.lit(1)) > p.thin_share)
        thin = thin | ((F.col("language") == language) & generated)
    return cut.filter(~thin | (draw("thin") <= p.thin_keep))


def render(pulls: DataFrame, pairs: DataFrame, p: Params = Params()) -> DataFrame:
    """pull_guid, length, render, languages: the texts of all eligible requests.

    A request goes if its opening is rejected, no base file is left, or the text is too short or too long.
    """
    chosen = written(h.with_placeholders(eligible(pulls, pairs, p)), "pulls")  # both tables are read more than once
    mine = pairs.join(chosen.select("pull_guid"), "pull_guid", "left_semi")
    base = written(base_files(mine, p), "bases")
    bases = base.groupBy("pull_guid").agg(F.sort_array(F.collect_list(F.struct("path", "snippet", "language", "start"))).alias("b")).filter(F.aggregate("b", F.lit(0), lambda a, x: a + F.length(x["snippet"])) <= p.most_length)
    bases = bases.select(
        "pull_guid",
        F.concat(F.lit(BASE), F.array_join(F.transform("b", lambda x: F.concat(F.lit(FILE), x["path"], F.lit(CODE), x["snippet"])), "")).alias("base_text"),
        F.transform("b", lambda x: F.struct(x["language"].alias("language"), x["path"].alias("path"), F.length(x["snippet"]).alias("n_chars"))).alias("languages"),
        F.map_from_arrays(F.transform("b", lambda x: x["path"]), F.transform("b", lambda x: x["start"])).alias("starts"),
    )
    files = mine.select("pull_guid", "head_commit_id", F.posexplode_outer("files").alias("i", "f")).withColumn("path", F.col("f.base_path"))
    files = files.join(base.select("pull_guid", "path", "start"), ["pull_guid", "path"], "left")
    part = F.when(F.col("start").isNotNull(), F.concat(F.lit(FILE), F.col("path"), hunks(F.col("f.base_content"), F.col("f.head_content"), F.col("start"), p.hunk_context, HUNK)))
    diffs = files.withColumn("part", part).groupBy("pull_guid", "head_commit_id").agg(F.sort_array(F.collect_list(F.struct("i", "part"))).alias("parts"), F.count("f").alias("n"))
    diffs = diffs.select("pull_guid", F.col("head_commit_id").alias("head"), F.concat(F.lit(DIFF), F.when(F.col("n") == 0, F.lit(DIFFS_OMITTED)).otherwise(F.array_join(F.transform("parts", lambda x: F.coalesce(x["part"], F.lit(""))), ""))).alias("diff_text"))

    events = chosen.join(bases, "pull_guid").select("pull_guid", "base_text", "languages", "starts", F.posexplode("events").alias("i", "e"))
    order = Window.partitionBy("pull_guid").orderBy("i")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    opens = (F.col("e.type") == h.PULL) & F.col("e.action").isin("opened", "reopened")
    coded = F.col("e.type").isin(h.PULL, h.REVIEW, h.REVIEW_COMMENT)
    events = events.withColumn("opened", F.coalesce(F.max(opens).over(earlier), F.lit(False)))
    events = events.withColumn("opening", opens & ~F.col("opened"))
    live = coded & (F.col("opened") | F.col("opening"))
    events = events.withColumn("head", F.when(live, F.col("e.head_commit_id")))
    events = events.withColumn("fresh", live & ~F.col("head").eqNullSafe(F.last("head", ignorenulls=True).over(earlier)) & F.col("head").isNotNull())
    skipped = F.coalesce(F.try_element_at("starts", F.coalesce("e.comment_path", F.lit(""))), F.lit(0))
    user = F.coalesce("e.actor_login", F.lit(""))
    said = F.struct(rendered_text(user, F.col("e.text"), p).alias("full"), rendered_text(user, F.col("e.text"), p, any_length=True).alias("any"))
    events = events.withColumn("said", said)
    text = event_text(F.col("e"), F.col("said"), F.col("opened"), skipped, p)
    silent = F.col("e.type").isin(h.REVIEW, h.REVIEW_COMMENT) & ~F.col("opened")
    told = events.join(diffs, ["pull_guid", "head"], "left").withColumn("text", F.when(silent, F.lit("")).otherwise(text))
    diff = F.when(F.col("fresh"), F.coalesce("diff_text", F.lit(""))).otherwise(F.lit(""))
    own = F.coalesce("text", F.lit(""))
    whole = F.when(F.col("opening"), F.concat(own, F.col("base_text"), diff)).otherwise(F.concat(diff, own))
    rejected = F.col("text").isNull() & (F.col("e.type") == h.PULL) & (F.col("e.action") == "opened")
    out = told.groupBy("pull_guid").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("i", whole.alias("t")))), lambda x: x["t"]), "").alias("render"), F.max(rejected).alias("rejected"), F.first("languages").alias("languages")
    )
    sized = out.filter(~F.col("rejected")).withColumn("length", F.length("render").cast("long"))
    return sized.filter(F.col("length").between(p.least_length, p.most_length)).select("pull_guid", "length", "render", "languages")
