"""Which users are bots."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names of bots, and parts and ends of such names.
BOT_NAMES = ("Apache-HBase", "AutorestCI", "CLAassistant", "cmsbuild", "codecov-io", "codecov-commenter", "coveralls", "danger-public", "dnfclas", "msftclas", "PyDocTeur", "SparkQA", "karma-pr-reporter", "claassistantio", "probot-stale")
BOT_PARTS = ("[bot]", "botmanager", "bors-", "jenkins", "k8s-", "-test-", "travis")
BOT_ENDS = ("-automaton", "-automation", "-benchmark", "-build", "-deployer", "-cloud", "bot", "-ci", "-linter", "-teamcity", "-test", "-testing", "-Service-Account")
# End of fixed values.
REVIEWS = ("PullRequestReviewEvent", "PullRequestReviewCommentEvent")


def is_bot_name(name: Column) -> Column:
    """True for a null name too; case matters."""
    found = name.isin(*BOT_NAMES)
    for part in BOT_PARTS:
        found = found | name.contains(part)
    for end in BOT_ENDS:
        found = found | name.endswith(end)
    return name.isNull() | found


def is_bot(event_type: Column, user_type: Column, name: Column) -> Column:
    """By the user's type where a review event tells it, else by name."""
    told = event_type.isin(*REVIEWS) & user_type.isNotNull()
    return F.when(told, F.lower(user_type) != "user").otherwise(is_bot_name(name))
