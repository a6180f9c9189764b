"""URL filters by a temporal list join; DataFrame operations only.

Lists change: an entry is added on a date, for a time or without end, and taken off on a date. ``intervals`` turns
the dated entries of a key into validity intervals; ``judge`` joins every capture, as of its own date, with the entries
in force then, on the keys under which a URL can be listed: the whole URL, its host and path's first segment,
its host, and each domain the host belongs to.

Dates are days, so a key has at most one state a day however many entries it has, and captures are first reduced
to distinct (key, day) pairs: a host that a third of all captures share is looked up once a day.

Defined results: a URL without a host has only its whole text as key; a null URL or date matches nothing, and the
capture stays; of entries for one key, list and day, taking off beats adding, and the longest term counts; an addition
lasts until its own term is over or its key and list are taken off, whichever comes first, and a later addition shortens
none before it; repeated captures each get their row. A null pattern or day in an entry is ignored. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

_HOST = r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)"
#: Stands for no end while intervals are put together.
_OPEN = "9999-12-31"
_FIRST_SEGMENT = r"^[a-z][a-z0-9+.-]*://[^/?#]*(/[^/?#]*)"


def host(url: Column) -> Column:
    """Host in lower case, '' if there is none."""
    return F.coalesce(F.regexp_extract(F.lower(url), _HOST, 1), F.lit(""))


def url_keys(url: Column) -> Column:
    """All (kind, value) under which a URL can be listed."""
    name = host(url)
    labels = F.split(name, r"\.")
    depth = F.size(labels)
    domains = F.when(
        depth >= 2,
        F.transform(
            F.sequence(F.lit(2), F.greatest(depth, F.lit(2))),
            lambda n: F.struct(F.lit("domain").alias("kind"), F.array_join(F.slice(labels, -n, n), ".").alias("value")),
        ),
    ).otherwise(F.array())
    hosts = F.when(
        name != "",
        F.array(
            F.struct(F.lit("host").alias("kind"), name.alias("value")),
            F.struct(F.lit("prefix").alias("kind"), F.concat(name, F.regexp_extract(url, _FIRST_SEGMENT, 1)).alias("value")),
        ),
    ).otherwise(F.array())
    return F.concat(F.array(F.struct(F.lit("url").alias("kind"), url.alias("value"))), hosts, domains)


def intervals(entries: DataFrame) -> DataFrame:
    """``kind, value, list, valid_from, valid_to``: when each key is on a list; ``valid_to`` is exclusive, null is open.

    ``entries`` has ``kind, value, list, day, action`` ('add' or 'remove') and ``days``, the term of an addition or null.
    """
    daily = (
        entries.filter("value IS NOT NULL AND day IS NOT NULL AND action IN ('add', 'remove')")
        .groupBy("kind", "value", "list", "day")
        .agg(
            F.max(F.col("action") == "remove").alias("off"),
            F.max(F.when(F.col("action") == "add", F.coalesce("days", F.lit(2_000_000)))).alias("term"),
        )
    )
    key = ["kind", "value", "list"]
    # a key's rows are one a day, however many entries it has
    by_key = W.partitionBy(*key).orderBy("day")
    taken_off = F.min(F.when(F.col("off"), F.col("day"))).over(by_key.rowsBetween(1, W.unboundedFollowing))
    ends = F.when(F.col("term") < 2_000_000, F.date_add("day", F.col("term").cast("int")))
    each = (
        daily.withColumn("taken_off", taken_off).filter("NOT off")
        .select(*key, F.col("day").alias("valid_from"), F.coalesce(F.least(ends, F.col("taken_off")), F.lit(_OPEN).cast("date")).alias("valid_to"))
        .filter("valid_to > valid_from")
    )
    # additions that overlap or touch become one interval, so that a day meets one at most
    earlier = W.partitionBy(*key).orderBy("valid_from")
    covered = F.max("valid_to").over(earlier.rowsBetween(W.unboundedPreceding, -1))
    begins = F.when(covered >= F.col("valid_from"), 0).otherwise(1)
    return (
        each.withColumn("begins", begins).withColumn("part", F.sum("begins").over(earlier))
        .groupBy(*key, "part").agg(F.min("valid_from").alias("valid_from"), F.max("valid_to").alias("valid_to"))
        .select(*key, "valid_from", F.nullif("valid_to", F.lit(_OPEN).cast("date")).alias("valid_to"))
    )


def judge(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """``page_id, url, day, n_lists, lists, blocked`` for every capture ``page_id, url, day``.

    ``lists`` are the names of the lists it is on at its date, sorted; lists named ``allow...`` overrule the others.
    """
    keyed = captures.select("page_id", "url", "day", F.explode(F.array_distinct(url_keys(F.col("url")))).alias("k")).select(
        "page_id", "url", "day", "k.kind", "k.value"
    )
    keyed = keyed.filter("value IS NOT NULL AND day IS NOT NULL")
    asked = keyed.select("kind", "value", "day").distinct().alias("a")
    valid = intervals(entries).alias("v")
    in_force = (F.col("v.valid_from") <= F.col("a.day")) & (F.col("v.valid_to").isNull() | (F.col("a.day") < F.col("v.valid_to")))
    state = (
        asked.join(valid, (F.col("a.kind") == F.col("v.kind")) & (F.col("a.value") == F.col("v.value")) & in_force)
        .groupBy("a.kind", "a.value", "a.day")
        .agg(F.collect_set("v.list").alias("own"))
    )
    # the captures meet their keys' states by (key, day); what a URL is on depends on nothing but URL and day
    found = (
        keyed.select("url", "day", "kind", "value").distinct().join(state, ["kind", "value", "day"])
        .groupBy("url", "day")
        .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("own")))).alias("names"))
    )
    names = F.coalesce("names", F.array().cast("array<string>"))
    allowed = F.exists(names, lambda n: n.startswith("allow"))
    return (
        captures.select("page_id", "url", "day").join(found, ["url", "day"], "left")
        .select(
            "page_id", "url", "day", F.size(names).cast("bigint").alias("n_lists"), F.array_join(names, ",").alias("lists"),
            ((F.size(names) > 0) & ~allowed).alias("blocked"),
        )
    )
