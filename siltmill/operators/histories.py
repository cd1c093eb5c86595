"""Issue and pull-request histories from event streams, their statistics and filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltmill.functions.bots import is_bot
from siltmill.functions.text import anonymised, let, pull_guid
from siltmill.storage import written

ISSUE_TYPES = ("IssuesEvent", "IssueCommentEvent")
REVIEW, REVIEW_COMMENT, PULL = "PullRequestReviewEvent", "PullRequestReviewCommentEvent", "PullRequestEvent"
STATES = ("approved", "dismissed", "commented", "changes_requested")

# A fixed format: the parts of a raw event that are read.
_USER, _REPO = "struct<login: string>", "struct<full_name: string>"
_PULL = f"struct<url: string, merged: boolean, created_at: string, title: string, body: string, user: {_USER}, head: struct<sha: string, repo: {_REPO}>, base: struct<sha: string, repo: {_REPO}>>"
_COMMENT = "struct<id: bigint, body: string, author_association: string, original_commit_id: string, pull_request_review_id: bigint, in_reply_to_id: bigint, path: string, original_position: bigint, diff_hunk: string, user: struct<type: string>>"
_REVIEW = "struct<id: bigint, body: string, state: string, author_association: string, commit_id: string, user: struct<type: string>>"
_ISSUE = f"struct<id: bigint, number: bigint, title: string, body: string, created_at: string, user: {_USER}, pull_request: struct<url: string>>"
RAW = f"type string, public boolean, created_at string, actor {_USER}, repo struct<name: string>, org {_USER}, payload struct<action: string, pull_request: {_PULL}, comment: {_COMMENT}, review: {_REVIEW}, issue: {_ISSUE}>"


def flat_events(raw: DataFrame) -> DataFrame:
    """Raw events of four shapes as one wide row each; other types go. Columns of another shape are null, and so is
    a merged flag that an event does not have.

    Issues and their comments are grouped by their pull request if they belong to one, else by the issue; a comment's
    text stands in for the issue's, whose own is kept as issue_body.
    """
    p = lambda path: F.col(f"payload.{path}")
    kind = F.col("type")
    issue, pull = kind.isin(*ISSUE_TYPES), kind.isin(PULL, REVIEW, REVIEW_COMMENT)
    only = lambda when, c: F.when(when, c)
    guid = F.when(issue, F.when(p("issue.pull_request.url").isNotNull(), pull_guid(p("issue.pull_request.url")))).otherwise(pull_guid(p("pull_request.url")))
    text = F.when(issue, F.when(p("comment.id").isNotNull(), p("comment.body")).otherwise(p("issue.body"))).when(kind == REVIEW, p("review.body")).when(kind == REVIEW_COMMENT, p("comment.body")).otherwise(p("pull_request.body"))
    user_type = F.when(kind == REVIEW, p("review.user.type")).when(kind == REVIEW_COMMENT, p("comment.user.type"))
    return raw.filter((issue & p("issue.id").isNotNull()) | (pull & p("pull_request.url").isNotNull())).select(
        F.coalesce(guid, p("issue.id").cast("string")).alias("group_id"),
        "type",
        p("action").alias("action"),
        F.col("actor.login").alias("actor_login"),
        is_bot(kind, user_type, F.col("actor.login")).alias("actor_is_bot"),
        "created_at",
        F.col("repo.name").alias("repo_name"),
        F.col("org.login").alias("org_login"),
        guid.alias("pull_guid"),
        "public",
        F.when(issue, p("issue.title")).when(kind == PULL, p("pull_request.title")).alias("title"),
        text.alias("text"),
        only(issue, p("issue.body")).alias("issue_body"),
        only(issue, p("issue.id")).alias("issue_id"),
        only(issue, p("issue.number")).alias("issue_number"),
        only(issue, p("comment.id")).alias("comment_id"),
        only(issue, p("issue.created_at")).alias("issue_created_at"),
        only(issue, p("issue.user.login")).alias("issue_user_login"),
        F.when(kind == REVIEW, p("review.author_association")).when(kind == REVIEW_COMMENT, p("comment.author_association")).alias("author_association"),
        F.when(kind == REVIEW, p("review.id")).when(kind == REVIEW_COMMENT, p("comment.id")).alias("review_comment_id"),
        F.when(kind == REVIEW, p("review.commit_id")).when(kind == REVIEW_COMMENT, p("comment.original_commit_id")).alias("review_comment_commit_id"),
        only(kind == REVIEW, p("review.state")).alias("review_state"),
        *[only(kind == REVIEW_COMMENT, p(f"comment.{c}")).alias(f"comment_{c}") for c in ("pull_request_review_id", "in_reply_to_id", "path", "original_position", "diff_hunk")],
        only(pull, p("pull_request.merged")).alias("pull_merged"),
        only(pull, p("pull_request.head.sha")).alias("head_commit_id"),
        only(pull, p("pull_request.base.sha")).alias("base_commit_id"),
        only(pull, p("pull_request.base.repo.full_name")).alias("base_repo_name"),
        only(pull, p("pull_request.head.repo.full_name")).alias("head_repo_name"),
        only(pull, p("pull_request.created_at")).alias("pull_created_at"),
        only(pull, p("pull_request.user.login")).alias("pull_user_login"),
        only(pull, p("pull_request.title")).alias("pull_title"),
        only(pull, p("pull_request.body")).alias("pull_body"),
    )


def _read(v: Column, path: str, kind: T.DataType) -> Column:
    """What a variant holds at a path, as a column of the given type; structs field by field."""
    if isinstance(kind, T.StructType):
        return F.struct(*[_read(v, f"{path}.{f.name}", f.dataType).alias(f.name) for f in kind.fields])
    return F.try_variant_get(v, path, kind.simpleString())


def variant_events(lines: DataFrame, text: str = "value") -> DataFrame:
    """lines with `event`, the JSON of each as a variant, and the columns of RAW read from it.

    Nothing of an event is lost for want of a schema: whatever flat_events does not read stays in `event`, shapes that
    nobody knew included, and each field is only looked up where something uses it. A field that is missing, null or of
    another type is null. Lines that are no JSON, and null ones, have a null event and null columns.
    """
    kept = lines.withColumn("event", F.try_parse_json(text))
    return kept.select("*", *[_read(F.col("event"), f"$.{f.name}", f.dataType).alias(f.name) for f in T.StructType.fromDDL(RAW).fields])


def listed_events(events: Column) -> Column:
    """A JSON list as an array of variants: empty for a null, for what is no list, and for no JSON."""
    return F.coalesce(F.try_variant_get(F.try_parse_json(events), "$", "array<variant>"), F.array().cast("array<variant>"))


def routed(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Events of issues and events of pull requests: issue types belong to a pull request if their group is one."""
    mine = F.col("type").isin(*ISSUE_TYPES) & ~F.col("group_id").contains("/pull/")
    return events.filter(mine), events.filter(~mine)


def _gathered(events: DataFrame, key: str, *order: Column) -> DataFrame:
    """One row per key with its events as an array of structs in the given order."""
    rest = [F.col(c) for c in events.columns if c != key]
    return events.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(*[o.alias(f"__{i}") for i, o in enumerate(order)], F.struct(*rest).alias("event")))).alias("e")).select(key, F.transform("e", lambda x: x["event"]).alias("events"))


def issue_histories(events: DataFrame) -> DataFrame:
    """One row per issue: repo, org, ids and its events in time order, as struct(type, action, at, author, title, text,
    comment_id). A history that does not begin with its opening gets one from what its first event says of the issue.
    Deleted comments carry no text, and only openings, reopenings and edits a title and description."""
    e = _gathered(events, "issue_id", F.col("created_at"), F.col("type"), F.coalesce("comment_id", F.lit(0)))
    first = F.get("events", F.lit(0))
    full = lambda x: x["action"].isin("opened", "edited", "reopened")

    def entry(x: Column) -> Column:
        comment = x["type"] == "IssueCommentEvent"
        return F.struct(
            F.when(comment, "comment").otherwise("issue").alias("type"),
            x["action"].alias("action"),
            x["created_at"].alias("at"),
            x["actor_login"].alias("author"),
            F.when(~comment & full(x), x["title"]).alias("title"),
            F.when(comment, F.when(x["action"] != "deleted", x["text"])).when(full(x), x["text"]).alias("text"),
            F.when(comment, x["comment_id"]).alias("comment_id"),
        )

    opening = F.struct(F.lit("issue").alias("type"), F.lit("opened").alias("action"), first["issue_created_at"].alias("at"), first["issue_user_login"].alias("author"), first["title"].alias("title"), first["issue_body"].alias("text"), F.lit(None).cast("long").alias("comment_id"))
    begun = (first["type"] == "IssuesEvent") & (first["action"] == "opened")
    entries = F.transform("events", entry)
    return e.select(
        first["repo_name"].alias("repo"),
        first["org_login"].alias("org"),
        "issue_id",
        first["issue_number"].alias("issue_number"),
        first["pull_guid"].alias("pull_guid"),
        F.when(begun, entries).otherwise(F.concat(F.array(opening), entries)).alias("events"),
    )


def issue_text(short: int | None = None) -> Column:
    """A history as readable text."""
    body = lambda x: F.coalesce(x if short is None else F.concat(F.substring(x, 1, short), F.lit("...")), F.lit(""))
    head = lambda word, x: F.concat(F.lit(word), F.upper(x["action"]), F.lit(" ["), x["at"], F.lit("] BY "), F.coalesce(x["author"], F.lit("")), F.lit("\n"))
    comment = lambda x: F.concat(head("COMMENT ", x), F.when(x["text"].isNotNull(), F.concat(body(x["text"]), F.lit("\n"))).otherwise(F.lit("")))
    issue = lambda x: F.concat(head("ISSUE ", x), F.when(x["action"].isin("opened", "edited", "reopened"), F.concat(F.lit("TITLE: "), F.coalesce(x["title"], F.lit("")), F.lit("\nDESCRIPTION: "), body(x["text"]), F.lit("\n"))).otherwise(F.lit("")))
    top = F.concat(F.lit("REPO: "), "repo", F.lit("\n"), F.coalesce(F.concat(F.lit("ORG: "), "org", F.lit("\n")), F.lit("")), F.lit("ISSUE NUMBER: "), F.col("issue_number").cast("string"), F.lit("\n\n"))
    return F.concat(top, F.array_join(F.transform("events", lambda x: F.when(x["type"] == "comment", comment(x)).otherwise(issue(x))), "\n"))


_HELPERS = ("issue_id", "issue_number", "issue_body", "issue_created_at", "issue_user_login", "pull_created_at", "pull_user_login", "pull_title", "pull_body")


def pull_histories(events: DataFrame) -> DataFrame:
    """One row per pull request: pull_guid and its events in time order, pull-request events before issue events of
    the same time. Groups of issue events only go. Without an opening, one is made from the first pull-request event;
    the first opening of the pull request as an issue goes."""
    return told_pulls(_gathered(events, "group_id", *pull_order(events)))


def pull_order(events: DataFrame) -> tuple[Column, Column, Column]:
    """What the events of a pull request are ordered by."""
    return F.col("created_at"), F.col("type").isin(*ISSUE_TYPES), F.xxhash64(*events.columns)


def told_pulls(e: DataFrame) -> DataFrame:
    """Histories of pull requests from group_id and all its events, ordered by pull_order."""
    pulls = F.filter("events", lambda x: ~x["type"].isin(*ISSUE_TYPES))
    issues = F.filter("events", lambda x: x["type"].isin(*ISSUE_TYPES))
    split = e.select(F.col("group_id").alias("pull_guid"), pulls.alias("pulls"), issues.alias("issues")).filter(F.size("pulls") > 0)
    opens = lambda kind: lambda x: (x["type"] == kind) & (x["action"] == "opened")
    place = F.array_position(F.transform("issues", lambda x: F.coalesce(opens("IssuesEvent")(x), F.lit(False))), True)
    rest = F.filter("issues", lambda x, i: (place == 0) | (i != place - 1))
    names = [f.name for f in e.schema["events"].dataType.elementType.fields]
    first = F.get("pulls", F.lit(0))
    made = {"type": F.lit(PULL), "action": F.lit("opened"), "created_at": first["pull_created_at"], "actor_login": first["pull_user_login"], "title": first["pull_title"], "text": first["pull_body"]}
    opening = F.struct(*[made.get(n, first[n]).alias(n) for n in names])
    begun = F.exists("pulls", lambda x: F.coalesce(opens(PULL)(x), F.lit(False)))
    whole = F.concat(F.when(begun, F.col("pulls")).otherwise(F.concat(F.array(opening), F.col("pulls"))), rest)
    ranked = F.array_sort(F.transform(whole, lambda x, i: F.struct(x["created_at"].alias("at"), i.alias("i"), x.alias("event"))))
    kept = [n for n in names if n not in _HELPERS]
    return split.select("pull_guid", F.transform(ranked, lambda x: F.struct(*[x["event"][n].alias(n) for n in kept])).alias("events"))


def with_stats(histories: DataFrame) -> DataFrame:
    """Histories with the statistics of their events, each a column."""
    e = F.col("events")
    mine = lambda keep: F.filter(e, keep)
    issue = lambda x: x["type"].isin(*ISSUE_TYPES)
    pull, review = (lambda x: x["type"] == PULL), (lambda x: ~issue(x) & (x["type"] != PULL))
    bot = lambda x: F.coalesce(x["actor_is_bot"], F.lit(False))
    n = lambda keep: F.size(mine(keep)).cast("long")
    distinct = lambda keep, value: F.size(F.array_distinct(F.transform(mine(keep), value))).cast("long")
    merged = F.exists(e, lambda x: ~issue(x) & F.coalesce(x["pull_merged"], F.lit(False)))
    out = histories.withColumns(
        {
            "is_bot_opened": F.exists(e, lambda x: pull(x) & bot(x) & (x["action"] == "opened")).cast("int"),
            "is_closed": F.exists(e, lambda x: ~issue(x) & F.coalesce(x["action"] == "closed", F.lit(False))).cast("int"),
            "is_merged": merged.cast("int"),
            "n_non_bot_users": distinct(lambda x: ~bot(x), lambda x: x["actor_login"]),
            "n_bot_users": distinct(bot, lambda x: x["actor_login"]),
            "n_pre": n(pull),
            "n_pre_bot": n(lambda x: pull(x) & bot(x)),
            "n_cre": n(review),
            "n_cre_bot": n(lambda x: review(x) & bot(x)),
            "n_ie": n(issue),
            "n_ie_bot": n(lambda x: issue(x) & bot(x)),
            "n_commit_pairs": distinct(lambda x: ~issue(x), lambda x: F.struct(x["base_commit_id"], x["head_commit_id"])),
            "n_rebases": F.greatest(distinct(lambda x: ~issue(x), lambda x: x["base_commit_id"]) - 1 - merged.cast("long"), F.lit(0).cast("long")),
            "pr_desc_len": F.coalesce(F.length(F.try_element_at(mine(pull), F.lit(1))["text"]), F.lit(0)).cast("long"),
            "pr_title_len": F.coalesce(F.length(F.try_element_at(mine(pull), F.lit(1))["title"]), F.lit(0)).cast("long"),
        }
    )
    reviews = F.transform(mine(lambda x: x["type"] == REVIEW), lambda x: F.struct(x["review_comment_id"].alias("id"), x["review_state"].alias("state")))
    by_id = F.array_sort(F.transform(reviews, lambda r, i: F.struct(r["id"].alias("id"), i.alias("i"), r["state"].alias("state"))))
    last = let(by_id, lambda rs: F.filter(rs, lambda r, i: (i == F.size(rs) - 1) | ~F.get(rs, i + 1)["id"].eqNullSafe(r["id"])))
    out = out.withColumn("__last", last)
    count = lambda keep: F.size(F.filter("__last", keep)).cast("long")
    in_state = lambda state: lambda r: r["state"] == state
    known = lambda r: F.coalesce(r["state"].isin(*STATES), F.lit(False))
    return out.withColumns({**{f"review_n_{s}": count(in_state(s)) for s in STATES}, "review_n_other": count(lambda r: ~known(r))}).drop("__last")


def discussed(stats: DataFrame) -> DataFrame:
    """Pull requests that a person opened and described and a person reviewed or discussed."""
    return stats.filter((F.col("is_bot_opened") == 0) & (F.col("pr_desc_len") > 0) & ((F.col("n_cre") > F.col("n_cre_bot")) | (F.col("n_ie") > F.col("n_ie_bot"))))


def without_users(histories: DataFrame, users: DataFrame) -> DataFrame:
    """Histories without those opened by, from or to a listed user (column user); other events of listed users go,
    and histories of nothing else.

    The names a history has meet the list in one join; no list is held in a task.
    """
    histories = written(histories, "histories")  # read twice
    owner = lambda c: F.split_part(F.coalesce(c, F.lit("")), F.lit("/"), F.lit(1))
    names = F.array_distinct(F.array_compact(F.flatten(F.transform("events", lambda x: F.array(x["actor_login"], owner(x["head_repo_name"]), owner(x["base_repo_name"]))))))
    listed = histories.select("pull_guid", F.explode(names).alias("user")).join(users.select("user").distinct(), "user", "left_semi").groupBy("pull_guid").agg(F.collect_set("user").alias("__listed"))
    marked = histories.join(listed, "pull_guid", "left").withColumn("__listed", F.coalesce("__listed", F.array().cast("array<string>")))
    out = lambda c: F.coalesce(F.array_contains("__listed", c), F.lit(False))
    opened = lambda x: F.coalesce(x["action"] == "opened", F.lit(False))
    veto = F.exists("events", lambda x: opened(x) & (((x["type"] == PULL) & (out(x["actor_login"]) | out(owner(x["head_repo_name"])) | out(owner(x["base_repo_name"])))) | ((x["type"] == "IssuesEvent") & out(x["actor_login"]))))
    kept = marked.filter(~veto).withColumn("events", F.filter("events", lambda x: ~out(x["actor_login"])))
    return kept.filter(F.size("events") > 0).drop("__listed")


def with_placeholders(histories: DataFrame) -> DataFrame:
    """User names as username_0, username_1, … in first-seen order, in the events' texts too."""
    names = F.array_distinct(F.array_compact(F.transform("events", lambda x: x["actor_login"])))
    marked = histories.withColumn("__names", names)
    fields = [f.name for f in histories.schema["events"].dataType.elementType.fields]

    def masked(x: Column) -> Column:
        at = F.array_position("__names", x["actor_login"])
        own = {"actor_login": F.when(x["actor_login"].isNotNull(), F.concat(F.lit("username_"), (at - 1).cast("string"))), "text": anonymised(x["text"], F.col("__names"))}
        return F.struct(*[own.get(f, x[f]).alias(f) for f in fields])

    return marked.withColumn("events", F.transform("events", masked)).drop("__names")


def approvals(events: Column) -> Column:
    return F.size(F.filter(events, lambda x: (x["type"] == REVIEW) & (x["review_state"] == "approved")))


def is_merged(events: Column) -> Column:
    return F.exists(events, lambda x: F.coalesce(x["pull_merged"], F.lit(False)))


def rebases(events: Column) -> Column:
    """Distinct base commits beyond the first, one less for a merge."""
    bases = F.size(F.array_distinct(F.array_compact(F.transform(events, lambda x: x["base_commit_id"]))))
    return F.greatest(bases - 1 - is_merged(events).cast("int"), F.lit(0))


def first_commits(events: Column) -> Column:
    """struct(head, base) of the earliest event that has both."""
    full = F.filter(events, lambda x: x["head_commit_id"].isNotNull() & x["base_commit_id"].isNotNull())
    return F.array_min(F.transform(full, lambda x: F.struct(F.try_to_timestamp(x["created_at"]).alias("at"), x["head_commit_id"].alias("head"), x["base_commit_id"].alias("base"))))
