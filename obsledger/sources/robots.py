"""robots.txt as a policy table (G3-G6, G8): rules by a UDTF, decisions by a join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf


@udtf(returnType="agents array<string>, rule_no int, allow boolean, pattern string, delay double")
class robots_rules:  # noqa: N801
    """Every rule of a file with the agents of its group. A BOM and comments do not count; a group's
    agents end at its first rule. A group without rules yields one row with a null pattern."""

    def eval(self, body: str):
        agents, rules, open_, n = [], 0, False, 0

        def line_of(x):
            return x.split("#", 1)[0].strip().partition(":")

        for key, _, value in map(line_of, (body or "").lstrip("﻿").splitlines()):
            key, value = key.strip().lower(), value.strip()
            if key == "user-agent":
                if not open_:
                    if agents and not rules:
                        yield agents, n, None, None, None
                    agents, rules, open_ = [], 0, True
                agents = [*agents, value.lower()]
            elif agents and key in ("allow", "disallow", "crawl-delay"):
                open_ = False
                if key == "crawl-delay":
                    try:
                        yield agents, n, None, None, float(value)
                    except ValueError:
                        continue
                elif value:
                    yield agents, n, key == "allow", value, None
                else:
                    yield agents, n, None, None, None
                rules, n = rules + 1, n + 1
        if agents and not rules:
            yield agents, n, None, None, None


def response_state(status: Column, content_type: Column, body: Column) -> Column:
    """May the file's rules be relied on? ``pass`` (none exist), ``busy``, ``unknown`` (never open), or ``rules``."""
    text = F.coalesce(body, F.lit(""))
    line = r"(?im)^\s*(user-agent|allow|disallow|crawl-delay|sitemap|host|clean-param)\s*:"
    return (
        F.when(status.isin(404, 410), "pass").when(status.isin(429, 503), "busy").when(status.isNull() | (status != 200), "unknown")
        .when(F.lower(F.coalesce(content_type, F.lit(""))).contains("html") | F.lower(F.ltrim(text)).startswith("<"), "unknown")
        .when(F.trim(text) == "", "pass").when(~text.rlike(line), "unknown").otherwise("rules")
    )


def _regex(pattern: Column) -> Column:
    """A rule's path as a Java pattern: ``*`` is anything, a final ``$`` the end."""
    quoted = F.regexp_replace(pattern, r"([\\\[\](){}.+?^|])", r"\\$1")
    return F.concat(F.lit("^"), F.regexp_replace(F.replace(quoted, F.lit("*"), F.lit(".*")), r"\$(?!$)", r"\\\$"))


def decide(urls: DataFrame, rules: DataFrame, agent: str) -> DataFrame:
    """(host, path) -> allowed, rule, delay. The groups that name the agent, else those of ``*``; the
    longest matching rule decides, a tie allows; no match allows. ``rules``: host and the UDTF's columns."""
    named = rules.withColumn("own", F.exists("agents", lambda a: F.lit(agent.lower()).contains(a) & (a != "*") & (a != "")))
    has = named.groupBy("host").agg(F.max("own").alias("any_own"))
    used = named.join(has, "host").where(F.when(F.col("any_own"), F.col("own")).otherwise(F.array_contains("agents", "*")))
    delay = used.groupBy("host").agg(F.max("delay").alias("delay"))
    u = urls.select("host", "path").distinct()
    hit = u.join(used.where(F.col("pattern").isNotNull()), "host").where(F.regexp_like("path", _regex(F.col("pattern"))))
    best = hit.groupBy("host", "path").agg(F.max(F.struct(F.length("pattern").alias("n"), F.col("allow"), F.col("pattern"))).alias("b"))
    return u.join(best, ["host", "path"], "left").join(delay, "host", "left").select("host", "path", F.coalesce("b.allow", F.lit(True)).alias("allowed"), F.col("b.pattern").alias("rule"), "delay")
