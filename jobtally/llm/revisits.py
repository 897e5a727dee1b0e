"""WARC not-modified revisits: as-of join to the latest earlier full response.

A revisit record says that a server answered "not modified". It is resolved by
the latest earlier response with status 200 of the same canonical URL, if the
validators agree: the entity tags where both records have one (weak
comparison), else the last-modified dates where both have one. Headers that a
not-modified answer may update replace those of the response.

The as-of join is a window over (canonical URL, time slice), so a URL with very
many captures is dealt over the slices; the last response of each slice, one
row per URL and slice, is carried into the later slices. Only ids and dates
take part; headers and payload are joined to the one matched response. A
response is repeated once for each of up to ``SALTS`` salts that its revisits
have, so the revisits of a very frequent response do not meet in one task.

Records have record_id, url, date (timestamp), kind (``response`` or
``revisit``), status, headers (map, names in lower case) and any other columns,
which the matched response lends to the result as ``response_<name>`` (with
further underscores where that name is taken).

Defined cases: records without url or date match nothing (``no_response``);
earlier means a smaller date, on equal dates a smaller record_id; a response
without a record_id is not used; neither validator on both sides is
``unverified``, a difference is ``changed``; only ``resolved`` rows have merged
headers; responses are told apart by record_id, date and URL, and of rows equal
in these that with the least SHA-256 of its header lines and other columns, as
JSON, counts; repeated revisit rows are each resolved; null headers are an
empty map; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobtally.llm.common import written

# Headers a 304 answer carries for the stored response, query parameters that name no resource.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")
TRACKING = "utm_[a-z]+|sid|sessionid|phpsessid|jsessionid"

SLICE_SECONDS = 86_400
SALTS = 256
_URL = r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?([^/?#]*)([^?#]*)(?:\?([^#]*))?"


def canonical_url(url: Column) -> Column:
    """Host in lower case without ``www.`` and default port, path without a last slash, query
    parameters sorted and without tracking ones; no scheme, no fragment."""
    bare = F.btrim(url)
    host = F.regexp_replace(F.lower(F.regexp_extract(bare, _URL, 1)), r"^www\.|:(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, _URL, 2), "/+$", "")
    words = F.split(F.regexp_extract(bare, _URL, 3), "&")
    words = F.filter(words, lambda w: (w != "") & ~F.lower(w).rlike(f"^({TRACKING})(=|$)"))
    query = F.array_join(F.array_sort(words), "&")
    return F.concat(host, F.when(path == "", "/").otherwise(path), F.when(query == "", "").otherwise(F.concat(F.lit("?"), query)))


def _tag(headers: Column) -> Column:
    return F.regexp_replace(headers["etag"], "^W/", "")


def latest_earlier(records: DataFrame, slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """Each revisit of ``records`` (canonical_url, date, record_id, kind, status, ...) with
    response_id and response_date of the latest earlier full response of its URL."""
    kind_full = (F.col("kind") == "response") & (F.col("status") == 200)
    usable = (kind_full & F.col("record_id").isNotNull()) | (F.col("kind") == "revisit")
    time_slice = F.floor(F.unix_micros(F.col("date")) / (slice_seconds * 1_000_000)).cast("long")
    events = records.where(F.col("canonical_url").isNotNull() & F.col("date").isNotNull() & usable)
    events = events.select("canonical_url", time_slice.alias("slice"), "date", "record_id", kind_full.alias("full"))
    place = F.struct("date", "record_id")
    # responses of one place in time come after the revisits there: earlier is strict
    order = ("date", "record_id", "full")
    here = Window.partitionBy("canonical_url", "slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    found = events.withColumn("here", F.last(F.when(F.col("full"), place), ignorenulls=True).over(here)).where(~F.col("full"))
    # one row per URL and slice: its last response, null where it has revisits only
    slices = events.groupBy("canonical_url", "slice").agg(F.max(F.when(F.col("full"), place)).alias("last"))
    before = Window.partitionBy("canonical_url").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = slices.select("canonical_url", "slice", F.last("last", ignorenulls=True).over(before).alias("carried"))
    found = found.join(carried, ["canonical_url", "slice"], "left").withColumn("match", F.coalesce("here", "carried"))
    return found.select(
        "record_id", "date", "canonical_url", F.col("match.record_id").alias("response_id"), F.col("match.date").alias("response_date")
    ).distinct()


def _lent_names(others: list[str]) -> list[str]:
    taken = {"response_id"}
    names = []
    for c in others:
        name = f"response_{c}"
        while name in taken:
            name += "_"
        taken.add(name)
        names.append(name)
    return names


def resolve(records: DataFrame, slice_seconds: int = SLICE_SECONDS, salts: int = SALTS) -> DataFrame:
    """One row per revisit: record_id, url, canonical_url, date, outcome, response_id, merged_headers,
    and the other columns of the matched response as ``response_<name>``."""
    known = ("record_id", "url", "date", "kind", "status", "headers")
    others = [c for c in records.columns if c not in known]
    empty = F.create_map().cast("map<string,string>")
    base = records.select(
        "record_id", "url", "date", "kind", "status", canonical_url(F.col("url")).alias("canonical_url"),
        F.coalesce("headers", empty).alias("headers"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)],
    )
    lent = [f"c{i}" for i in range(len(others))]
    salt = F.pmod(F.xxhash64("record_id", "date"), F.lit(salts))
    matches = written(latest_earlier(base, slice_seconds).where(F.col("response_id").isNotNull()).withColumn("salt", salt), "revisits")
    response = ["response_id", "response_date", "response_url"]
    matches = matches.withColumn("response_url", F.col("canonical_url"))
    turn = F.unhex(F.sha2(F.to_json(F.struct(header_lines(F.col("headers")).alias("headers"), *lent)), 256))
    # column by column, so that those nobody asks for are not shuffled
    stored = base.where((F.col("kind") == "response") & (F.col("status") == 200)).withColumn("turn", turn).groupBy(
        F.col("record_id").alias("response_id"), F.col("date").alias("response_date"), F.col("canonical_url").alias("response_url")
    ).agg(*[F.min_by(c, "turn").alias(name) for c, name in (("headers", "theirs"), *zip(lent, lent))])
    # a response once for each salt of its revisits
    stored = stored.join(matches.select(*response, "salt").distinct(), response)
    own = matches.select(F.col("record_id").alias("of"), F.col("date").alias("at"), F.col("canonical_url").alias("key"), *response, "salt")
    revisits = base.where(F.col("kind") == "revisit").select("record_id", "url", "canonical_url", "date", F.col("headers").alias("mine"))
    revisits = revisits.join(
        own, F.col("record_id").eqNullSafe(F.col("of")) & (F.col("date") == F.col("at")) & (F.col("canonical_url") == F.col("key")), "left")
    both = revisits.join(stored, [*response, "salt"], "left")
    mine, theirs = F.col("mine"), F.col("theirs")
    tags = _tag(mine) == _tag(theirs)
    dates = mine["last-modified"] == theirs["last-modified"]
    agree = F.coalesce(tags, dates)  # null where one side lacks the validator
    outcome = (
        F.when(F.col("response_id").isNull(), "no_response").when(agree.isNull(), "unverified")
        .when(agree, "resolved").otherwise("changed")
    )
    update = F.map_filter(mine, lambda k, v: k.isin(*PERMITTED))
    kept = F.map_filter(theirs, lambda k, v: ~F.map_contains_key(update, k))
    resolved = F.col("outcome") == "resolved"
    return both.withColumn("outcome", outcome).select(
        "record_id", "url", "canonical_url", "date", "outcome", "response_id",
        F.when(resolved, F.map_concat(kept, update)).alias("merged_headers"),
        *[F.when(resolved, F.col(c)).alias(name) for c, name in zip(lent, _lent_names(others))],
    )


def header_lines(headers: Column) -> Column:
    """``name: value`` lines by name."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(headers)), lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "\n")


def captures(pages: DataFrame) -> DataFrame:
    """WARC records made from all pages: each page as a response, and a not-modified revisit of its address.

    The response of a page is taken at a minute given by its id. The revisit
    asks for another spelling of the same address between an hour before and
    five hours after, with the entity tag of the page, or, for a fifth of the
    addresses, one that has since changed.
    """
    url = F.coalesce(F.col("url"), F.lit(""))
    turn = F.conv(F.substring(F.md5(url.cast("binary")), 1, 6), 16, 10).cast("long")
    minute = F.col("page_id") * 60 + 1_700_000_000
    tag = F.concat(F.lit('"'), F.substring(F.md5(F.coalesce(F.col("html"), F.lit("")).cast("binary")), 1, 16), F.lit('"'))
    response = F.struct(
        (F.col("page_id") * 2).alias("record_id"), F.col("url"), minute.alias("second"), F.lit("response").alias("kind"),
        F.lit(200).alias("status"),
        F.create_map(
            F.lit("etag"), tag, F.lit("content-type"), F.lit("text/html"), F.lit("date"), minute.cast("string"),
            F.lit("cache-control"), F.lit("max-age=60"), F.lit("content-length"), F.octet_length(F.coalesce("html", F.lit(""))).cast("string"),
        ).alias("headers"),
        F.col("html").alias("payload"), F.sha2(F.col("html").cast("binary"), 256).alias("digest"),
    )
    later = minute + (turn % 7 - 1) * 3600
    revisit = F.struct(
        (F.col("page_id") * 2 + 1).alias("record_id"),
        F.concat(F.regexp_replace(F.col("url"), "^http:", "https:"), F.lit("#again")).alias("url"),
        later.alias("second"), F.lit("revisit").alias("kind"), F.lit(304).alias("status"),
        F.create_map(
            F.lit("etag"), F.when(turn % 5 == 0, F.lit('"stale"')).otherwise(F.concat(F.lit("W/"), tag)),
            F.lit("date"), later.cast("string"), F.lit("cache-control"), F.lit("max-age=600"),
            F.lit("content-length"), F.lit("0"), F.lit("set-cookie"), F.lit("a=b"),
        ).alias("headers"),
        F.lit(None).cast("string").alias("payload"), F.lit(None).cast("string").alias("digest"),
    )
    rows = pages.select(F.explode(F.array(response, revisit)).alias("r")).select("r.*")
    return rows.withColumn("date", F.timestamp_seconds("second")).drop("second")


ORACLE = r"""
WITH p AS (
  SELECT page_id, url, html, ('0x' || substr(md5(coalesce(url, '')), 1, 6))::BIGINT AS turn, page_id * 60 + 1700000000 AS second,
         '"' || substr(md5(coalesce(html, '')), 1, 16) || '"' AS tag
  FROM pages),
r AS (
  SELECT page_id * 2 AS record_id, url, second, TRUE AS is_full, tag, html FROM p
  UNION ALL
  SELECT page_id * 2 + 1, regexp_replace(url, '^http:', 'https:') || '#again', second + (turn % 7 - 1) * 3600, FALSE,
         CASE WHEN turn % 5 = 0 THEN '"stale"' ELSE tag END, NULL
  FROM p),
u AS (
  SELECT *, regexp_extract(trim(url), '^(?:[A-Za-z][A-Za-z0-9+.-]*://)?([^/?#]*)([^?#]*)(?:\?([^#]*))?', ['h', 'p', 'q']) AS x FROM r),
c AS (
  SELECT record_id, url, second, is_full, tag, html,
         regexp_replace(lower(x.h), '^www\.|:(80|443)$', '', 'g') AS host, regexp_replace(x.p, '/+$', '') AS path,
         array_to_string(list_sort(list_filter(string_split(x.q, '&'), lambda w: w <> '' AND NOT regexp_matches(lower(w), '^(utm_[a-z]+|sid|sessionid|phpsessid|jsessionid)(=|$)'))), '&') AS query
  FROM u),
k AS (
  SELECT *, CASE WHEN url IS NOT NULL THEN host || CASE WHEN path = '' THEN '/' ELSE path END
                 || CASE WHEN query = '' THEN '' ELSE '?' || query END END AS canonical_url
  FROM c),
m AS (
  SELECT *, CASE WHEN canonical_url IS NOT NULL THEN last_value(CASE WHEN is_full THEN record_id END IGNORE NULLS) OVER (
              PARTITION BY canonical_url ORDER BY second, record_id, is_full ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) END AS response_id
  FROM k),
j AS (
  SELECT m.record_id, m.url, m.canonical_url, m.second, m.response_id, m.tag, f.tag AS stored, f.html,
         CASE WHEN f.record_id IS NULL THEN 'no_response' WHEN f.tag = m.tag THEN 'resolved' ELSE 'changed' END AS outcome
  FROM m LEFT JOIN m f ON f.record_id = m.response_id AND f.is_full WHERE NOT m.is_full)
SELECT record_id, url, canonical_url, second, outcome, response_id,
       CASE WHEN outcome = 'resolved' THEN 'cache-control: max-age=600' || chr(10)
         || 'content-length: ' || strlen(coalesce(html, '')) || chr(10) || 'content-type: text/html' || chr(10)
         || 'date: ' || second || chr(10) || 'etag: W/' || tag END AS merged_headers,
       CASE WHEN outcome = 'resolved' THEN sha256(html) END AS payload_sha256
FROM j
"""
