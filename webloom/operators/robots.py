"""robots.txt rules and the test of URLs against them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from webloom import schemas
from webloom.functions import urls
from webloom.functions.html import visible_text
from webloom.functions.text import percent_decode
from webloom.operators.joins import at_most, hot_key_join, row_bound

ROBOTS_PATH = "robots.txt"
_LINE_END = "\r\n|[\n\r\x0b\f\x1c-\x1e\x85\u2028\u2029]"
_TRIM = r"^\s+|\s+$"


def robots_files(files: DataFrame) -> DataFrame:
    """The robots file of each authority, the one with the lowest status if there are several."""
    return (
        files.where((F.col("path") == ROBOTS_PATH) & F.col("status").isNotNull())
        .groupBy("authority")
        .agg(F.min(F.struct("status", "body")).alias("_f"))
        .select("authority", "_f.*")
    )


def robots_content(files: DataFrame, ok: list[int]) -> DataFrame:
    """``authority``, ``robots_content``: text of the files that were fetched, free of markup."""
    return (
        robots_files(files)
        .where(F.col("status").isin(ok))
        .select("authority", visible_text(F.col("body")).alias("robots_content"))
    )


def robots_rules(files: DataFrame, ok: list[int]) -> DataFrame:
    """Rules that bind every agent: ``authority, line_no, allow, path``.

    A group is a run of user-agent lines and the rules below it, up to a blank
    line or the next run. The first group that names "*" counts.
    """
    lines = (
        robots_files(files)
        .where(F.col("status").isin(ok))
        .select("authority", F.posexplode(F.split("body", _LINE_END, -1)).alias("line_no", "line"))
        .withColumn("text", F.regexp_replace(F.substring_index("line", "#", 1), _TRIM, ""))
        .withColumn(
            "field",
            F.when(
                F.contains(F.col("text"), F.lit(":")),
                F.lower(F.regexp_replace(F.substring_index("text", ":", 1), _TRIM, "")),
            ),
        )
        .withColumn(
            "value",
            percent_decode(
                F.regexp_replace(F.regexp_replace("text", "^[^:]*:", ""), _TRIM, "")
            ),
        )
        .withColumn(
            "kind",
            F.when(F.col("line") == "", "blank")
            .when(F.col("field") == "user-agent", "agent")
            .when(F.col("field").isin("allow", "disallow"), "rule")
            .when(F.col("field").isin("crawl-delay", "request-rate"), "setting"),
        )
        .where(F.col("kind").isNotNull())
    )
    # One exchange, by authority: all windows and the final filter share it. A
    # partition of a window is one file, hence no larger than one input value.
    in_order = Window.partitionBy("authority").orderBy("line_no")
    group = Window.partitionBy("authority", "group")
    agent, kind = F.col("kind") == "agent", F.col("kind")
    names = lambda who: F.max(agent & (F.col("value") == who)).over(group)
    starts = (kind == "blank") | (agent & ~F.lag(kind).over(in_order).eqNullSafe("agent"))
    grouped = (
        lines.withColumn("starts", starts)
        .withColumn("group", F.sum(F.col("starts").cast("int")).over(in_order))
        .withColumn("ruled", F.max(kind.isin("rule", "setting")).over(group))
        .withColumn("any", names("*"))
        .withColumn("blank_name", names(""))
        # An agent line without a name matches "*" too and comes before the default group.
        .withColumn(
            "rank",
            F.when(
                F.col("ruled") & (F.col("any") | F.col("blank_name")),
                F.struct(F.col("any").alias("late"), F.col("group").alias("group")),
            ),
        )
        .withColumn("first", F.min("rank").over(Window.partitionBy("authority")))
    )
    return grouped.where((F.col("rank") == F.col("first")) & (kind == "rule")).select(
        "authority",
        "line_no",
        ((F.col("field") == "allow") | (F.col("value") == "")).alias("allow"),
        F.col("value").alias("path"),
    )


def robots_policy(files: DataFrame, ok: list[int]) -> DataFrame:
    """One row per authority: its rules in file order, and what holds where none matches.

    A refused robots file (401, 403) closes the site, as does one that could not
    be had for a fault of the server; other client errors leave it open. The body that a
    redirect led to counts like a file; without one the site is open.
    """
    ok = [*ok, *schemas.REDIRECTS]
    rules = (
        robots_rules(files, ok)
        .groupBy("authority")
        .agg(F.array_sort(F.collect_list(F.struct("line_no", "allow", "path"))).alias("rules"))
    )
    status = F.col("status")
    # The status alone: file texts need not be shuffled a second time for it.
    statuses = (
        files.where((F.col("path") == ROBOTS_PATH) & status.isNotNull())
        .groupBy("authority")
        .agg(F.min("status").alias("status"))
    )
    otherwise = status.isin(ok) | (status.between(400, 499) & ~status.isin(401, 403))
    return statuses.select("authority", otherwise.alias("otherwise")).join(
        rules, "authority", "left"
    )


def with_robots(
    df: DataFrame, policy: DataFrame, url: str = "url", rows_per_task: int | None = None
) -> DataFrame:
    """``allowed`` for every URL; a site without a robots file allows all.

    A site's rules travel as one array, so a URL meets one row however many rules
    there are, and the URLs of a huge site spread over many tasks.
    """
    extra = {} if rows_per_task is None else {"rows_per_task": rows_per_task}
    keyed = at_most(df.withColumn("authority", urls.authority(F.col(url))), row_bound(df))
    joined = hot_key_join(keyed, policy, "authority", url, **extra)
    rest = F.regexp_replace(
        percent_decode(F.col(url)), rf"^(?:{urls.SCHEME}:)?(?://[^/?#]*)?", ""
    )
    target = F.when(rest == "", "/").otherwise(rest)
    match = F.try_element_at(
        F.filter("rules", lambda r: F.startswith(F.col("_target"), r["path"])), F.lit(1)
    )
    return (
        joined.withColumn("_target", target)
        .withColumn("allowed", F.coalesce(match["allow"], F.col("otherwise"), F.lit(True)))
        .drop("authority", "rules", "otherwise", "_target")
    )
