"""Secret scan by corpus-wide ownership, in DataFrame functions only.

Patterns find candidates in whole texts. A value's hash is counted over the whole table by distinct
owners and distinct repositories. A value that ``copied_owners`` owners or more hold is a copied
example; one that a single owner holds, and that looks live (letters and figures mixed, of some
variety, no placeholder), is a credential of that owner. Each such candidate gives a further span
of its value alone, of the kind ``copied`` or ``live``. The spans of the patterns stay as they are.

Texts are split by a pattern, so lengths of the pieces and of the matches give the places, in code
points; a running sum over a text's matches adds them up. Only places, lengths and hashes leave the
scan: no text and no value is stored or shuffled. Owners and repositories of a value are made
distinct before they are counted, with partial sums on the map side, so a value that a third of all
documents holds meets in no task.

Null and empty texts have no spans, and a null owner or repository is one of its own. Rows that
repeat an id or a text are scanned each on its own, but repeat no owner. Spans that start together
come in the order of ``KINDS``. Very long texts are scanned whole. An empty table gives no rows.
Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geotracks.session import materialize

#: The patterns, the group that is the value, and the least length of the value.
PATTERNS = {
    "assign": (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    "access": (r"AKIA[A-Z0-9]+", 0, 16),
    "hex": (r"(?<![0-9a-f])[0-9a-f]{32,}", 0, 32),
}
#: Further candidates of this method, kind ``form``, told by their published forms.
FORMS = r"gh[opsu]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"
#: The kinds of spans, in order.
KINDS = ("assign", "access", "hex", "live", "copied")
#: Texts that no live credential holds.
PLACEHOLDER = r"(?i)example|sample|dummy|changeme|placeholder|password|your|xxxx"


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repository_col: str = "doc_id", copied_owners: int = 5,
) -> DataFrame:
    """(id, n_assign, n_access, n_hex, base_sha256, spans) of every row of ``docs``."""
    found = candidates(docs, id_col, text_col, owner_col, repository_col)
    return report(found, ownership(found, copied_owners)).withColumnRenamed("_id", id_col)


def candidates(docs: DataFrame, id_col: str, text_col: str, owner_col: str, repository_col: str) -> DataFrame:
    """A row for every candidate: its text's row, place, kind, hash and whether it looks live.

    Rows without one have a single row with a null kind.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("_id"),
        F.struct(F.col(owner_col)).alias("_owner"), F.struct(F.col(repository_col)).alias("_repository"), text.alias("_text"),
    )
    patterns = {kind: (pattern, group) for kind, (pattern, group, _) in PATTERNS.items()} | {"form": (FORMS, 0)}
    # most texts hold none of the plain marks, and a search for a mark is cheap
    marks = {"access": F.contains("_text", F.lit("AKIA")), "form": F.col("_text").rlike("gh[opsu]_|xox[abprs]-|eyJ")}
    rows = rows.select("*", *(F.when(marks.get(k, F.lit(True)), F.split("_text", p, -1)).alias(f"_{k}") for k, (p, _) in patterns.items()))
    rows = rows.select(
        "_row", "_id", "_owner", "_repository",
        F.concat(*(F.when(F.size(f"_{k}") > 1, _hits(k, p, g)).otherwise(F.array().cast(_HITS)) for k, (p, g) in patterns.items())).alias("_hits"),
    )
    held = materialize(rows).select("_row", "_id", "_owner", "_repository", F.explode_outer("_hits").alias("_hit"))
    held = held.select("_row", "_id", "_owner", "_repository", "_hit.*")
    walked = Window.partitionBy("_row", "kind").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    some = held.where("kind is not null").withColumn("end", F.sum(F.col("gap") + F.col("size")).over(walked))
    long_enough = F.lit(True)
    for kind, (_, _, least) in PATTERNS.items():
        long_enough = long_enough & ((F.col("kind") != kind) | (F.col("length") >= least))
    some = some.select(
        "_row", "_id", "_owner", "_repository", "kind", (F.col("end") - F.col("size")).alias("start"), "end", "length", "hash", "looks_live", long_enough.alias("_valid")
    )
    none = held.where("kind is null").select("_row", "_id", "_owner", "_repository")
    return materialize(some.unionByName(none, allowMissingColumns=True))


_HITS = "array<struct<kind:string,place:int,gap:bigint,size:bigint,length:bigint,hash:binary,looks_live:boolean>>"


def _hits(kind: str, pattern: str, group: int) -> Column:
    """For each match: the text before it since the last one, and its size, as lengths; its value's hash."""
    matches = F.regexp_extract_all("_text", F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all("_text", F.lit(pattern), F.lit(group)) if group else matches
    zipped = F.arrays_zip(F.slice(f"_{kind}", F.lit(1), F.size(f"_{kind}") - 1).alias("gap"), matches.alias("match"), values.alias("value"))
    return F.transform(
        zipped,
        lambda hit, place: F.struct(
            F.lit(kind).alias("kind"), place.alias("place"), F.length(hit["gap"]).cast("long").alias("gap"), F.length(hit["match"]).cast("long").alias("size"),
            F.length(hit["value"]).cast("long").alias("length"), F.unhex(F.sha2(hit["value"].cast("binary"), 256)).alias("hash"),
            looks_live(hit["value"]).alias("looks_live"),
        ),
    ).cast(_HITS)


def looks_live(value: Column) -> Column:
    """Twelve characters or more, a letter and a figure, six different characters, no placeholder."""
    varied = F.size(F.array_distinct(F.split(value, ""))) >= 6
    return (F.length(value) >= 12) & value.rlike("[A-Za-z]") & value.rlike("[0-9]") & varied & ~value.rlike(PLACEHOLDER)


def ownership(found: DataFrame, copied_owners: int) -> DataFrame:
    """(hash, owners, repositories, widely): how many distinct ones hold each value."""
    pairs = found.where("_valid").select("hash", "_owner", "_repository").distinct()
    # a repository of several owners counts once for each
    of_owner = pairs.groupBy("hash", "_owner").agg(F.count("*").alias("_n"))
    counted = of_owner.groupBy("hash").agg(F.count("*").alias("owners"), F.sum("_n").alias("repositories"))
    return counted.withColumn("widely", (F.col("owners") >= copied_owners) & (F.col("repositories") >= copied_owners))


def report(found: DataFrame, owned: DataFrame) -> DataFrame:
    """Counts and spans of every row: the patterns' own, and those that ownership adds."""
    some = found.where("kind is not null")
    judged = some.join(materialize(owned.where("owners = 1 or widely")), "hash", "left")
    added = F.when(F.col("_valid") & F.col("widely"), "copied").when(F.col("_valid") & (F.col("owners") == 1) & F.col("looks_live"), "live")
    base = F.col("_valid") & (F.col("kind") != "form")
    order = F.create_map(*(F.lit(x) for n, k in enumerate(KINDS) for x in (k, n)))
    span = lambda kind, start: F.struct(
        start.alias("start"), order[kind].alias("order"), F.col("end"), F.concat_ws(":", kind, start.cast("string"), F.col("end").cast("string")).alias("text")
    )
    own = F.when(base, span(F.col("kind"), F.col("start")))
    more = F.when(added.isNotNull(), span(added, F.col("end") - F.col("length")))
    counts = [F.count_if(base & (F.col("kind") == k)).alias(f"n_{k}") for k in PATTERNS]
    texts = lambda spans: F.array_join(F.array_sort(spans)["text"], ",")
    grouped = judged.select("_row", "_id", "kind", "_valid", own.alias("_own"), more.alias("_more"))
    of_rows = grouped.groupBy("_row").agg(
        F.first("_id").alias("_id"), *counts, F.collect_list("_own").alias("_base"), F.collect_set("_more").alias("_added")
    )
    reported = of_rows.select("_id", *(f"n_{k}" for k in PATTERNS), _sha(texts(F.col("_base"))).alias("base_sha256"), texts(F.concat("_base", "_added")).alias("spans"))
    zero = F.lit(0).cast("long")
    clean = found.where("kind is null").select("_id", *(zero.alias(f"n_{k}") for k in PATTERNS), _sha(F.lit("")).alias("base_sha256"), F.lit("").alias("spans"))
    return reported.unionByName(clean)


def _sha(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)
