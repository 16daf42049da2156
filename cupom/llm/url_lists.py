"""URL filter by dated lists: change log -> validity intervals -> as-of join with captures.

``entries`` is a change log (list_name, pattern, action, effective_date): from the effective date on,
``add`` puts a host pattern on a list and ``remove`` takes it off. A pattern matches a host that
equals it or ends in "." + pattern. A capture is judged by the entries active on its fetch date:

* ``active_lists``: names of lists with an active match, sorted, comma-joined ("" if none);
* ``verdict``: ``block`` if the longest active pattern of an ordinary list is longer than that of
  any allow list, else ``allow`` if an allow list matches, else ``pass``.

Only DataFrame functions are used. Verdicts depend on (host, day) alone, so captures are first
reduced to distinct pairs (partial aggregation on the map side): a host with a third of all captures
becomes one row per day before the first shuffle; the verdicts then go back by an equi-join, which
AQE may split where one pair is hot.

Patterns are brought into the form of hosts (lower case, no blanks around them, no dot after them).

Defined results: entries with a null list, a null or empty pattern, a null date or an unknown action are ignored; of several
actions for one list, pattern and day, ``remove`` wins; repeated entries change nothing. A capture
with a null or hostless URL, or no fetch date, gets no active list and ``pass``. All captures stay,
repeated ones too, with all their columns; a column already named like a result column is replaced.
Empty lists give ``pass`` everywhere; empty captures give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Optional scheme, user info up to the last @, then the host (a bracketed address too) up to a port, path, query or fragment.
HOST = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#]*@)?(\[[^\]]*\]|[^/:?#@]+)"


def as_host(text: Column) -> Column:
    """A host's one form: lower case, without blanks around it or dots after it; null when nothing is left."""
    return F.nullif(F.rtrim(F.lower(F.trim(text)), F.lit(".")), F.lit(""))


def host_of(url: Column) -> Column:
    """Host of a URL; null when there is none."""
    return as_host(F.regexp_extract(F.trim(url), HOST, 1))


def suffixes(host: Column) -> Column:
    """The host and its parent domains, longest first."""
    labels = F.split(host, r"\.")
    return F.transform(labels, lambda _, i: F.array_join(F.slice(labels, i + 1, F.size(labels)), "."))


def validity_intervals(entries: DataFrame) -> DataFrame:
    """(list_name, pattern, valid_from, valid_to) with ``valid_to`` exclusive and null while open."""
    action = F.lower(F.col("action"))
    days = (
        entries.withColumn("pattern", as_host(F.col("pattern")))
        .where(F.col("list_name").isNotNull() & F.col("pattern").isNotNull() & F.col("effective_date").isNotNull() & action.isin("add", "remove"))
        .groupBy("list_name", "pattern", F.col("effective_date").cast("date").alias("valid_from"))
        .agg(F.min(action == "add").alias("on"))  # one row per day at most: a key is bounded by the calendar
    )
    w = Window.partitionBy("list_name", "pattern").orderBy("valid_from")
    changes = days.withColumn("was", F.lag("on").over(w)).where(F.col("was").isNull() | (F.col("was") != F.col("on")))
    return changes.withColumn("valid_to", F.lead("valid_from").over(w)).where("on").select("list_name", "pattern", "valid_from", "valid_to")


def judge(captures: DataFrame, entries: DataFrame, url: str = "url", fetched: str = "fetch_date", allow: tuple[str, ...] = ("allow",)) -> DataFrame:
    """``captures`` with ``host``, ``active_lists`` and ``verdict`` as of each capture's fetch date."""
    kept = [c for c in captures.columns if c.lower() not in ("host", "active_lists", "verdict")]
    rows = captures.select(*kept, host_of(F.col(url)).alias("_ul_host"), F.col(fetched).cast("date").alias("_ul_day"))
    probes = (
        rows.where(F.col("_ul_host").isNotNull() & F.col("_ul_day").isNotNull())
        .groupBy("_ul_host", "_ul_day")
        .agg(F.lit(1).alias("_ul_one"))
        .select("_ul_host", "_ul_day", F.explode(suffixes(F.col("_ul_host"))).alias("pattern"))
    )
    spans = validity_intervals(entries)
    active = (F.col("valid_from") <= F.col("_ul_day")) & (F.col("valid_to").isNull() | (F.col("_ul_day") < F.col("valid_to")))
    allows = F.col("list_name").isin(*allow)
    longest = lambda which: F.coalesce(F.max(F.when(which, F.length("pattern"))), F.lit(0))
    verdicts = (
        probes.join(spans, "pattern")
        .where(active)
        .groupBy("_ul_host", "_ul_day")
        .agg(F.array_join(F.array_sort(F.collect_set("list_name")), ",").alias("active_lists"), longest(~allows).alias("_ul_block"), longest(allows).alias("_ul_allow"))
    )
    block, permit = F.col("_ul_block") > F.col("_ul_allow"), F.col("_ul_allow") > 0
    return rows.join(verdicts, ["_ul_host", "_ul_day"], "left").select(
        *kept,
        F.col("_ul_host").alias("host"),
        F.coalesce("active_lists", F.lit("")).alias("active_lists"),
        F.when(block, "block").when(permit, "allow").otherwise("pass").alias("verdict"),
    )
