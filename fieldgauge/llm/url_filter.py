"""URL rules by a sort-merge range join, in DataFrame functions alone.

Keys are a host with its labels reversed, a separator, and a path, so that a rule is the interval of
keys that start with its own. A url stands once for itself and each parent domain that has rules at
all. In a sorted sweep over rules and urls each rule carries the stack of rules that are active where
it starts, outermost first; a url takes the stack of the last rule that started and pops what has
ended. Intervals that start with one another are nested, so no other rule can be active.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldgauge.llm.staging import cut_lineage, small_side, without

# At least so many groups are swept, and more as rows grow.
LEAST_SALTS = 64
ROWS_PER_SALT = 250_000
A_TO_Z = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
OUTPUT = ("host", "path", "rule", "verdict")


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?``, ``#`` or the end; else empty."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(found, F.lit("")), *A_TO_Z)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def reversed_host(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, r"\.")), ".")


def parents(host: Column) -> Column:
    """The host itself and every parent domain."""
    labels = F.split(host, r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )


def nested_rules(rules: DataFrame) -> DataFrame:
    """Distinct rules by key, each with the stack of rules that contain it, itself last.

    Ancestors are found by joining each rule's prefixes, at the lengths that occur for its host, with
    the rules of that host. Of rules with one host and path a blocking one wins.
    """
    clean = rules.select(
        F.translate(F.coalesce("host", F.lit("")), *A_TO_Z).alias("r_host"),
        F.coalesce("path", F.lit("")).alias("r_path"), F.col("verdict").alias("r_verdict"),
    ).filter("r_host != ''")
    distinct = cut_lineage(
        clean.groupBy("r_host", "r_path").agg(F.max("r_verdict").alias("r_verdict"))
        .withColumn("r_key", F.concat(reversed_host(F.col("r_host")), F.lit("\u0000"), F.col("r_path")))
    )
    lengths = distinct.groupBy("r_host").agg(F.collect_set(F.length("r_path")).alias("lengths"))
    prefixes = distinct.join(lengths, "r_host").select(
        "r_host", F.col("r_key").alias("key"), F.col("r_path").alias("of_path"),
        F.explode(F.filter("lengths", lambda n: n <= F.length("r_path"))).alias("n"),
    ).withColumn("r_path", F.expr("left(of_path, n)"))
    stacked = prefixes.join(distinct, ["r_host", "r_path"]).groupBy("key").agg(
        F.sort_array(F.collect_list(F.struct(F.length("r_path").alias("n"), "r_key", "r_host", "r_path", "r_verdict")))
        .alias("stack")
    )
    return cut_lineage(stacked)


def salts_for(rows: int, rules: int) -> int:
    """Groups of about ``ROWS_PER_SALT`` rows, but no more than let rules, which each group repeats, outnumber rows."""
    return max(LEAST_SALTS, min(-(-rows // ROWS_PER_SALT), rows // max(rules, 1)))


def judge_urls(
    urls: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow", salts: int | None = None
) -> DataFrame:
    """Every row of ``urls`` with ``host``, ``path``, the longest fitting ``rule`` and its ``verdict``.

    ``rules`` has the columns host, path and verdict. A rule fits its host and all subdomains if the
    url's path starts with the rule's. Rows are dealt by a salted hash, so a host that holds a third
    of all rows is spread; rules are repeated once per salt, and salts grow with the rows
    (``salts_for``) unless given. Rows are numbered once, in a staged table: a lost executor cannot
    number them anew between their two uses.

    * A NULL url, or one without ``://``, has an empty host and path, and no rule: the default counts.
    * Repeated rows stay. Rules with an empty host are ignored; no rules, or no urls, is no error.
    * Of fitting rules of equal length the longer host wins.
    * Input columns named like an added one are replaced.
    """
    kept = without(urls, *OUTPUT)
    numbered = cut_lineage(kept.select(
        F.struct(*[F.col(f"`{c}`") for c in kept.columns]).alias("row"),
        host_of(F.col(f"`{url}`")).alias("host"), path_of(F.col(f"`{url}`")).alias("path"),
        F.monotonically_increasing_id().alias("id"),
    ))
    stacks = nested_rules(rules)
    salts = salts_for(numbered.count(), stacks.count()) if salts is None else salts
    packed = numbered.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int"))

    hosts = cut_lineage(stacks.select(F.explode("stack.r_host").alias("with_rules")).distinct())
    # Each url once without a key, so that none is lost, and once for each domain that has rules.
    keyed = packed.select("*", F.explode(parents(F.col("host"))).alias("of_host"))
    looked_up = keyed.join(small_side(hosts), keyed.of_host == hosts.with_rules, "left_semi")
    no_key, no_stack = F.lit(None).cast("string"), F.lit(None).cast(stacks.schema["stack"].dataType)
    events = looked_up.select(
        "salt", F.concat(reversed_host(F.col("of_host")), F.lit("\u0000"), F.col("path")).alias("key"),
        F.lit(1).alias("kind"), "id", no_stack.alias("stack"),
        F.lit(None).cast(packed.schema["row"].dataType).alias("row"), no_key.alias("host"), no_key.alias("path"),
    )
    plain = packed.select(
        "salt", no_key.alias("key"), F.lit(1).alias("kind"), "id", no_stack.alias("stack"), "row", "host", "path"
    )
    starts = stacks.select(
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), "key", F.lit(0).alias("kind"),
        F.lit(None).cast("long").alias("id"), "stack",
        F.lit(None).cast(packed.schema["row"].dataType).alias("row"), no_key.alias("host"), no_key.alias("path"),
    )
    sweep = Window.partitionBy("salt").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    swept = (
        starts.unionByName(events).unionByName(plain)
        .withColumn("last_stack", F.last("stack", ignorenulls=True).over(sweep))
        .filter("kind = 1")
        .withColumn("active", F.filter("last_stack", lambda r: F.col("key").startswith(r["r_key"])))
        .withColumn("top", F.when(F.col("key").isNotNull(), F.try_element_at("active", F.lit(-1))))
    )
    rule = F.concat("top.r_host", "top.r_path")
    length = F.length(rule)
    best = swept.withColumn(
        "hit", F.when(F.col("top").isNotNull(), F.struct(
            length.alias("n"), F.length("top.r_host").alias("h"), rule.alias("rule"), F.col("top.r_verdict").alias("v"))),
    ).groupBy("salt", "id").agg(
        F.max("hit").alias("hit"), F.first("row", ignorenulls=True).alias("row"),
        F.first("host", ignorenulls=True).alias("host"), F.first("path", ignorenulls=True).alias("path"),
    )
    return best.select(
        "row.*", "host", "path", F.col("hit.rule").alias("rule"), F.coalesce("hit.v", F.lit(default)).alias("verdict")
    )
