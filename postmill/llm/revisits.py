"""Not-modified revisits in web archives: an as-of join by canonical URL.

A revisit record says that a page had not changed. It is resolved to the latest earlier full
response of its URL, if the validators agree, with the headers that a not-modified answer
may update. Everything here is columns: no Python runs on the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postmill.llm.staging import staged

# The headers that a not-modified answer carries for an update.
PERMITTED = (
    "cache-control",
    "content-location",
    "date",
    "etag",
    "expires",
    "last-modified",
    "vary",
)
RECORDS_PER_RANGE = 1 << 20


def canonical_url(url: Column) -> Column:
    """Scheme and host in lower case, ``http`` as ``https``, without a default port, leading
    ``www.``, fragment, tracking parameters (``utm_*``, ``ref``) and a trailing slash. A URL
    without ``://`` stays as it is, without blanks around."""
    plain = F.trim(url)
    head = r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)"
    host = F.lower(F.regexp_extract(plain, head, 1))
    host = F.regexp_replace(host, "^http:", "https:")
    host = F.regexp_replace(host, "^(https://)www[.]", "$1")
    host = F.regexp_replace(host, ":(80|443)$", "")
    rest = F.regexp_replace(plain, head, "")
    rest = F.regexp_replace(rest, "(?s)#.*$", "")
    rest = F.regexp_replace(rest, r"([?&])(utm_[^=&]*|ref)=[^&]*", "$1")
    rest = F.regexp_replace(rest, r"([?&])&+", "$1")
    rest = F.regexp_replace(rest, r"[?&]+$", "")
    rest = F.regexp_replace(rest, "/$", "")
    return F.when(plain.rlike("(?s)" + head), F.concat(host, rest)).otherwise(plain)


def _lowered(headers: Column) -> Column:
    """Header names in lower case; of names that then are equal, the last value."""
    low = F.transform(
        F.map_entries(headers), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value"))
    )
    count = F.size(low)
    last = F.filter(
        low,
        lambda e, i: F.size(F.filter(F.slice(low, i + 2, F.greatest(count, F.lit(1))), lambda x: x["key"] == e["key"])) == 0,
    )
    return F.map_from_entries(last)


def _equal_tags(a: Column, b: Column) -> Column:
    """Weak comparison of entity tags: a leading ``W/`` does not count."""
    return F.regexp_replace(a, "^W/", "") == F.regexp_replace(b, "^W/", "")


def resolve_revisits(
    records: DataFrame,
    permitted: tuple[str, ...] = PERMITTED,
    records_per_range: int = RECORDS_PER_RANGE,
) -> DataFrame:
    """(record_id, url_key, response_id, outcome, headers, digest) for each revisit record.

    ``records`` has ``record_id bigint, url string, warc_date timestamp, record_type string
    (response or revisit), status int, etag string, last_modified string, digest string,
    headers map<string, string>``; other columns are not read. A full response is one of
    status 200. The candidate is the latest of a strictly smaller date, of equal dates the
    one of the greatest id. ``outcome`` is

    - ``resolved``: a validator that both have agrees (entity tags by weak comparison, else
      the date of modification, else the digest);
    - ``changed``: that validator differs; ``unchecked``: they share none. In both cases
      ``response_id`` names the candidate, and headers and digest are the revisit's own;
    - ``missing``: there is no earlier full response.

    If resolved, ``headers`` are the response's, with the ``permitted`` ones of the revisit,
    names in lower case, and ``digest`` is the response's. Null headers count as none. A
    record without URL or date is never matched: such a revisit is ``missing``. Repeated
    rows of a revisit give repeated results, of a response they change nothing. An empty
    table gives an empty result.

    One URL may hold most records: records are dealt by ranges of (URL, date, id), so that
    such a URL spans many ranges. The last response of each range is carried to the URL's
    later ranges through a table with a row per URL and range.
    """
    spark = records.sparkSession
    response = (F.col("record_type") == "response") & (F.col("status") == 200)
    full = F.struct("record_id", "etag", "last_modified", "digest", "headers")
    narrow = records.select(
        "record_id",
        canonical_url(F.col("url")).alias("url_key"),
        F.col("warc_date").alias("at"),
        # At equal dates, revisits come first, so that they see earlier responses only.
        F.coalesce(response, F.lit(False)).alias("is_response"),
        "record_type",
        F.when(response, full).alias("full"),
        F.struct("etag", "last_modified", "digest", "headers").alias("own"),
    ).where("is_response or record_type = 'revisit'")
    order = ["at", "is_response", "record_id"]
    usable = narrow.where("url_key is not null and at is not null")
    ranges = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")), -(-usable.count() // records_per_range)
    )
    dealt = usable.repartitionByRange(ranges, "url_key", *order)
    dealt = staged(dealt.withColumn("part", F.spark_partition_id()), "ranges")

    # What the earlier ranges of a URL leave to the later ones; most URLs have one range.
    last = dealt.groupBy("url_key", "part").agg(
        F.max_by("full", F.when(F.col("is_response"), F.struct("at", "record_id"))).alias("last")
    )
    wide = last.groupBy("url_key").agg(F.count("*").alias("n")).where("n > 1").select("url_key")
    by_part = Window.partitionBy("url_key").orderBy("part")
    carried = last.join(wide, "url_key", "left_semi").select(
        "url_key",
        "part",
        F.last("last", True).over(by_part.rowsBetween(Window.unboundedPreceding, -1)).alias("carried"),
    )
    inside = Window.partitionBy("url_key", "part").orderBy(*order)
    here = F.last("full", True).over(inside.rowsBetween(Window.unboundedPreceding, -1))
    found = (
        dealt.withColumn("here", here)
        .where("record_type = 'revisit'")
        .join(carried, ["url_key", "part"], "left")
        .withColumn("full", F.coalesce("here", "carried"))
        .select("record_id", "url_key", "full", "own")
    )
    lost = narrow.where("record_type = 'revisit' and (url_key is null or at is null)")
    found = found.unionByName(lost.select("record_id", "url_key", "full", "own"))

    def both(name: str) -> Column:
        return F.col(f"full.{name}").isNotNull() & F.col(f"own.{name}").isNotNull()

    agrees = (
        F.when(both("etag"), _equal_tags(F.col("full.etag"), F.col("own.etag")))
        .when(both("last_modified"), F.col("full.last_modified") == F.col("own.last_modified"))
        .when(both("digest"), F.col("full.digest") == F.col("own.digest"))
    )
    outcome = (
        F.when(F.col("full").isNull(), "missing")
        .when(agrees.isNull(), "unchecked")
        .when(agrees, "resolved")
        .otherwise("changed")
    )
    none = F.create_map().cast("map<string,string>")
    new = _lowered(F.coalesce("own.headers", none))
    old = _lowered(F.coalesce("full.headers", none))
    update = F.map_filter(new, lambda k, _: k.isin(list(permitted)))
    merged = F.map_concat(F.map_filter(old, lambda k, _: ~F.array_contains(F.map_keys(update), k)), update)
    resolved = F.col("outcome") == "resolved"
    return found.withColumn("outcome", outcome).select(
        "record_id",
        "url_key",
        F.col("full.record_id").alias("response_id"),
        "outcome",
        F.when(resolved, merged).otherwise(new).alias("headers"),
        F.when(resolved, F.col("full.digest")).otherwise(F.col("own.digest")).alias("digest"),
    )
