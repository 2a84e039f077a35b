"""URL filters: a sorted sweep over canonical keys keeps a stack of active nested rules.

A canonical key is the host with its labels reversed, a zero character and the path
(``org.example<0>/es/x``). Hosts hold no slash, so a rule's key is the beginning of exactly
those keys that the rule binds: an interval of the sort order, and two intervals are nested or
apart. A rule also binds subdomains, so a url stands once under each ancestor of its host that
has any rule.

Keys and rules are sorted together by range. The sweep of a range keeps a stack of the rules
whose interval is open. A rule that opened in an earlier range is the beginning of the range's
first key, so an equi-join of that key's beginnings with the rules finds those, for urls that
matched no rule of their own range; any rule of their own range is longer.

Null urls, and urls without ``://``, have an empty host and path and match nothing. Repeated
rules with both verdicts block. Repeated rows are each judged. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geotracks.llm.common import lower_ascii
from geotracks.session import materialize

#: The production rules: verdict, host, path.
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def parse(url) -> tuple:
    """Columns of a url's host and path."""
    place = F.instr(url, "://")
    rest = F.when(place > 0, F.substring(url, place + 3, F.length(url)))
    host = lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def reversed_host(host):
    return F.array_join(F.reverse(F.split(host, r"\.")), ".")


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """(id, host, path, rule, verdict) of every row of ``pages``.

    ``rules``: (verdict, host, path). The longest rule that fits wins; without one the rule is
    null and the verdict is ``default``.
    """
    named = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"))
    host, path = parse(F.col("_url"))
    urls = materialize(named.select(F.monotonically_increasing_id().alias("uid"), "_id", host.alias("host"), path.alias("path")))
    known = rules.where("host is not null and path is not null").select(
        reversed_host(lower_ascii(F.col("host"))).alias("at"), F.concat(lower_ascii(F.col("host")), "path").alias("rule"), "path", "verdict"
    )
    known = materialize(known.groupBy(F.concat_ws("\0", "at", "path").alias("key"), "at", "rule").agg(F.max("verdict").alias("verdict")))

    labels = F.split("host", r"\.")
    ancestors = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.reverse(F.slice(labels, F.size(labels) - i + 1, i)), "."),
    )
    under = urls.where("host <> ''").select("uid", "path", F.explode(ancestors).alias("at"))
    keys = under.join(known.select("at").distinct(), "at", "left_semi")
    events = keys.select(
        F.concat_ws("\0", "at", "path").alias("key"), F.lit(1).alias("kind"), "uid", F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict")
    ).unionByName(known.select("key", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("uid"), "rule", "verdict"))
    swept = materialize(
        events.repartitionByRange("key", "kind", "uid").sortWithinPartitions("key", "kind", "uid")
        .withColumn("range", F.spark_partition_id())
        .mapInArrow(_sweep, "uid long, key string, range int, rule string, verdict string")
    )
    begins = swept.groupBy("range").agg(F.min("key").alias("first"))
    # only prefixes as long as a rule's key can be one: they are few, however long the url is
    lengths = [n for (n,) in known.select(F.length("key")).distinct().collect()]
    heads = begins.select("range", F.explode(F.array(*(F.substring("first", 1, n) for n in lengths)).cast("array<string>")).alias("head")).distinct()
    carried = heads.join(known.select(F.col("key").alias("head"), F.col("rule").alias("late"), F.col("verdict").alias("late_verdict")), "head")
    late = swept.where("rule is null").select("uid", "key", "range").join(carried, "range").where(F.expr("startswith(key, head)"))
    found = swept.where("rule is not null").select("uid", "rule", "verdict").unionByName(
        late.select("uid", F.col("late").alias("rule"), F.col("late_verdict").alias("verdict"))
    )
    best = found.groupBy("uid").agg(F.max(F.struct(F.length("rule").alias("n"), "rule", "verdict")).alias("best"))
    return urls.join(best, "uid", "left").select(
        F.col("_id").alias(id_col), "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict")
    )


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    active: list[tuple[str, str, str]] = []
    for batch in batches:
        out = []
        for key, kind, uid, rule, verdict, place in zip(*(c.to_pylist() for c in batch.columns)):
            while active and not key.startswith(active[-1][0]):
                active.pop()
            if kind == 0:
                active.append((key, rule, verdict))
            else:
                top = active[-1] if active else (None, None, None)
                out.append((uid, key, place, top[1], top[2]))
        kinds = (pa.int64(), pa.string(), pa.int32(), pa.string(), pa.string())
        columns = list(zip(*out)) if out else [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["uid", "key", "range", "rule", "verdict"])
