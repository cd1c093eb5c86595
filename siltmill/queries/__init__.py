"""The registered queries: name -> (spark, folder) -> DataFrame, and the SQL of those that SQL expresses."""

from siltmill.queries import arrivals, corpus, events, files, relational, stored, texts

QUERIES = {**relational.QUERIES, **texts.QUERIES, **corpus.QUERIES, **events.QUERIES, **stored.QUERIES, **files.QUERIES, **arrivals.QUERIES}
ORACLE = {**relational.ORACLE, **texts.ORACLE, **corpus.ORACLE, **events.ORACLE, **stored.ORACLE, **files.ORACLE, **arrivals.ORACLE}
