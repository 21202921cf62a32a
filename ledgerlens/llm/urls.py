"""URL filters: rules indexed by their rarest literal token.

A rule is a regular expression over ``host + rest`` of an address, plus the tokens (runs of ASCII letters and digits) that
any address it fits must contain whole. The index files each rule under that token of its own which the fewest
addresses contain; an address fetches the rules filed under its tokens, and only those run. Rules without a token
are run on every address.

Addresses are judged once each, however many pages repeat them. Joins are plain: Spark sends the index to all executors only while
its known size is small, and splits a frequent token's addresses otherwise.

Defined results: a null address, or one without ``://``, has an empty host and path and fits no rule; the longest rule
wins, the first of equally long ones; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.text import only

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ADDRESS = r"://([^/?#]*)([^?#]*)"


@dataclass(frozen=True)
class Rule:
    """``tier`` 1 goes before 0; within a tier the longest name wins."""

    name: str
    verdict: str
    regex: str
    tokens: tuple[str, ...]
    tier: int = 0


def _tokens(text: str) -> tuple[str, ...]:
    return tuple(sorted(set(re.findall(r"[A-Za-z0-9]+", text))))


def site(verdict: str, name: str) -> Rule:
    """``name`` is a host, a slash and the start of a path; it fits the host and all below it."""
    host, slash, path = name.partition("/")
    # A path that stops inside a token may go on in the address, so that token is not literal.
    whole = path if re.search(r"[^A-Za-z0-9]$", path) else re.sub(r"[A-Za-z0-9]+$", "", path)
    return Rule(name, verdict, rf"^(?:[^/?#]*\.)?{re.escape(host)}{slash}{re.escape(path)}", _tokens(f"{host}/{whole}"), 1)


def pattern(verdict: str, name: str) -> Rule:
    """``name`` with ``*`` for anything, anywhere in the address; tokens beside a star may be cut and are not literal."""
    parts = name.split("*")
    literal = []
    for part in parts:
        part = re.sub(r"^[A-Za-z0-9]+", "", part)
        literal.append(re.sub(r"[A-Za-z0-9]+$", "", part))
    return Rule(name, verdict, ".*".join(map(re.escape, parts)), _tokens("*".join(literal)))


#: Fixed rules of sites.
SITES = (
    site("allow", "com/"), site("block", "example.com/en/"), site("allow", "www.example.com/en/"),
    site("block", "net/es/"), site("block", "net/fr/"),
)
#: Addresses no site rule speaks of: pages that hold no prose of their own.
PATTERNS = (
    pattern("block", "/login/"), pattern("block", "/cart/"), pattern("block", "/search?"), pattern("block", "/tag/*/page/"),
    pattern("block", "?page=*&ref="), pattern("block", "/wp-admin/"), pattern("block", ".casino."), pattern("block", ".adult."),
)
RULES = SITES + PATTERNS


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), _ADDRESS, 1), UPPER, LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _ADDRESS, 2)


def _address(url: Column) -> Column:
    """Host in lower case and all that follows it; empty without ``://``."""
    return F.concat(host(url), F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)://[^/?#]*(.*)", 1))


def rule_table(spark: SparkSession, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    schema = T.StructType([
        T.StructField("place", T.IntegerType()), T.StructField("name", T.StringType()), T.StructField("verdict", T.StringType()),
        T.StructField("regex", T.StringType()), T.StructField("tokens", T.ArrayType(T.StringType())), T.StructField("tier", T.IntegerType()),
    ])
    return spark.createDataFrame([(i, r.name, r.verdict, r.regex, list(r.tokens), r.tier) for i, r in enumerate(rules)], schema)


def index(rules: DataFrame, tokens: DataFrame) -> DataFrame:
    """Each rule with the token it is filed under; a rule with a token no address has fits nothing and is left out.

    ``tokens`` has one row per address and different token of it.
    """
    named = rules.select("place", F.explode("tokens").alias("token"))
    wanted = tokens.join(named.select("token").distinct(), "token", "left_semi")
    often = wanted.groupBy("token").agg(F.count("*").alias("n"))
    rarest = named.join(often, "token", "left").groupBy("place").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")).alias("least"))
    return rules.join(rarest.where("least.n > 0").select("place", "least.token"), "place")


def fits(addresses: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``address`` and the rules that fit it, from a table of different addresses."""
    table = rule_table(addresses.sparkSession, rules)
    every = F.array_distinct(F.array_remove(F.split("address", "[^A-Za-z0-9]+"), ""))
    tokens = addresses.select("address", F.explode(every).alias("token"))
    fetched = tokens.join(index(table, tokens), "token").where(F.rlike("address", F.col("regex")))
    out = fetched.select("address", "place", "name", "verdict", "tier")
    for i, rule in enumerate(rules):
        if not rule.tokens:
            told = [F.lit(x).alias(n) for n, x in (("place", i), ("name", rule.name), ("verdict", rule.verdict), ("tier", rule.tier))]
            out = out.unionByName(addresses.where(F.col("address").rlike(rule.regex)).select("address", *told))
    return out


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """One row per page: host, path, the site rule that decides, the pattern that does where no site rule fits, the verdict."""
    rows = only(pages, page_id, url)
    rows = rows.select(page_id, host(F.col(url)).alias("host"), path(F.col(url)).alias("path"), _address(F.col(url)).alias("address"))
    fitting = fits(rows.select("address").distinct(), rules)
    best = fitting.groupBy("address").agg(
        F.max(F.struct("tier", F.length("name").alias("n"), (-F.col("place")).alias("first"), "name", "verdict")).alias("best"))
    out = rows.join(best, "address", "left")
    return out.select(
        page_id, "host", "path", F.when(F.col("best.tier") == 1, F.col("best.name")).alias("rule"),
        F.when(F.col("best.tier") == 0, F.col("best.name")).alias("pattern"), F.coalesce("best.verdict", F.lit("allow")).alias("verdict"),
    )
