"""URL filter by hashed expressions, in DataFrame functions only.

Each URL is expanded into host suffixes times path prefixes; the expressions are
joined to the rules on the first bytes of their digests, the full digests
confirm a match, and the longest rule gives the verdict.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.llm.common import ascii_lower, read

#: Bytes of the digest that are joined on.
PREFIX_HEX = 8
#: Copies of each rule: a rule that a third of all URLs match (a top-level
#: domain) is dealt over so many join keys.
SALTS = 16
#: Verdict where no rule fits.
DEFAULT = "allow"

#: The rules of the contract: host, path, verdict (fixed values).
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def split_url(url: str = "url"):
    """(host, path) columns: host after the first ``://`` up to ``/ ? #``, then the path up to ``? #``."""
    at = F.instr(F.col(url), "://")
    rest = F.when(at > 0, F.substr(F.col(url), at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return ascii_lower(F.regexp_extract(rest, r"(?s)^[^/?#]*", 0)), F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def digest(host, path):
    return F.sha2(F.concat(host, F.lit("\n"), path).cast("binary"), 256)


def judge_urls(pages: DataFrame, rules: DataFrame, carry: list[str], url: str = "url") -> DataFrame:
    """``carry`` with ``host``, ``path``, ``rule`` (host and path, else null) and ``verdict``.

    ``rules``: columns host, path, verdict. A rule fits its host and that host's
    subdomains where the URL's path starts with its path. The longest rule wins,
    the longer host among equally long ones, ``block`` among equals. A null URL,
    or one without ``://``, has an empty host and path, fits no rule and gets
    ``DEFAULT``. Every row gives one row, repeated rows too; empty tables give
    empty results or defaults. Rules with nulls never fit. Only ``carry`` and
    ``url`` are read, so other columns may have any name.

    Expansions are bounded by the rules: no more labels than the deepest rule
    host has, and the path lengths that rules have.
    """
    known = rules.select(ascii_lower(F.col("host")).alias("r_host"), F.col("path").alias("r_path"), F.col("verdict").alias("r_verdict")).filter("r_host is not null and r_path is not null and r_verdict is not null")
    depth, cuts = known.agg(F.max(F.size(F.split("r_host", r"\."))), F.array_sort(F.collect_set(F.length("r_path")))).first()
    host, path = split_url(url)
    inner = [F.col(c).alias(f"c{i}") for i, c in enumerate(carry)]
    base = pages.select(*inner, host.alias("host"), path.alias("path")).withColumn("row", F.monotonically_increasing_id())
    labels = F.split("host", r"\.")
    hosts = F.transform(F.sequence(F.lit(1), F.least(F.lit(depth or 0), F.size(labels))), lambda k: F.concat_ws(".", F.slice(labels, -k, k)))
    hosts = F.when((F.col("host") != "") & F.lit(bool(depth)), hosts)
    paths = F.transform(F.filter(F.lit(cuts or [0]), lambda n: n <= F.length("path")), lambda n: F.substring(F.col("path"), F.lit(1), n))
    # a row always gives at least one line (explode_outer), so no row is lost
    lines = base.withColumn("e_host", F.explode_outer(hosts)).withColumn("e_path", F.explode_outer(paths))
    lines = lines.withColumn("full", digest(F.col("e_host"), F.col("e_path")))
    lines = lines.select("*", F.substring("full", 1, PREFIX_HEX).alias("short"), F.pmod(F.col("row"), F.lit(SALTS)).cast("int").alias("salt"))
    table = known.withColumn("r_full", digest(F.col("r_host"), F.col("r_path"))).withColumn("r_short", F.substring("r_full", 1, PREFIX_HEX))
    table = table.withColumn("r_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    near = (F.col("short") == F.col("r_short")) & (F.col("salt") == F.col("r_salt")) & (F.col("full") == F.col("r_full"))
    best = F.max(
        F.when(
            F.col("r_full").isNotNull(),
            F.struct(
                (F.length("r_host") + F.length("r_path")).alias("long"),
                F.length("r_host").alias("host_long"),
                F.col("r_verdict").alias("verdict"),
                F.concat("r_host", "r_path").alias("rule"),
            ),
        )
    )
    out = lines.join(table, near, "left").groupBy("row", *[f"c{i}" for i in range(len(carry))], "host", "path").agg(best.alias("best"))
    return out.select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(carry)], "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(DEFAULT)).alias("verdict")
    )


def rules_table(spark) -> DataFrame:
    return spark.createDataFrame(RULES, "host string, path string, verdict string")


def op5_urls(spark, sf_dir):
    """Contract query: verdict of every page's URL."""
    return judge_urls(read(spark, sf_dir, "pages"), rules_table(spark), ["page_id"])


ORACLE_SQL = r"""
WITH cut AS (
  SELECT page_id, row_number() OVER () AS rid, CASE WHEN url IS NULL OR instr(url, '://') = 0 THEN '' ELSE substr(url, instr(url, '://') + 3) END AS rest FROM pages),
u AS (SELECT page_id, rid, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
r(rhost, rpath, rverdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
m AS (SELECT u.*, rhost || rpath AS rule, rverdict, row_number() OVER (PARTITION BY rid ORDER BY length(rhost || rpath) DESC NULLS LAST) AS k
      FROM u LEFT JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(rverdict, 'allow') AS verdict FROM m WHERE k = 1
"""
