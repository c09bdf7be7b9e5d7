"""Not-modified revisits of a web archive (operator 5).

A revisit record (a 304 answer) has no body of its own: it stands for the latest
earlier full response of the same canonical URL. The as-of join runs on URL and
time bucket, so a URL that holds a third of all captures is spread over its
buckets: within a bucket a window carries the last response forward, and from
earlier buckets only the last response of each comes in.

A response answers for a revisit if their validators agree: entity tags when both have
one (weak ones compare by their text), else the last-modified date when both have one;
with none in common the match is ``unchecked``. The revisit's headers then
replace the stored ones, but for those that a 304 may not change.

Native DataFrame code throughout. Edge cases: a null URL or time matches nothing
(``no_original``); a response at the very time of a revisit is not earlier;
of responses at one time the greatest id wins; null headers are none; of
a header that one record names twice (``Date`` and ``date``) the last value counts; very long values are kept whole; repeated revisits
are resolved each on its own; an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET = 3600

# fixed values: headers of a 304 that never replace stored ones (framing and connection)
NOT_MERGED = ("connection", "content-encoding", "content-length", "content-range", "keep-alive", "proxy-authenticate", "proxy-authorization",
              "te", "trailer", "transfer-encoding", "upgrade", "warning")
# fixed values: query parameters that do not name a resource
TRACKING = "utm_[^=&]*|ref|fbclid|gclid"


def canonical_url(url: Column) -> Column:
    """Host (lower case, without ``www.``, ``m.`` or a default port) and path, with
    tracking parameters dropped, the others sorted, and no scheme, fragment or closing slash."""
    bare = F.regexp_replace(F.trim(url), "^[A-Za-z][A-Za-z0-9+.-]*://|#.*$", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(bare, "^[^/?]*", 0)), ":(80|443)$", ""), "^(www|m)\\.", "")
    path = F.regexp_replace(F.regexp_extract(bare, "^[^/?]*([^?]*)", 1), "/+$", "")
    query = F.regexp_extract(bare, "\\?(.*)$", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(f"^({TRACKING})(=|$)")))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.concat_ws("&", kept))).otherwise(""))


def _tag(etag: Column) -> Column:
    return F.regexp_replace(etag, "^W/", "")


def resolve_revisits(records: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """``records``: record_id, url, ts (seconds), kind (``response`` or
    ``revisit``), etag, last_modified, headers (map), payload_digest, length.

    Per revisit: record_id, url_key, ts, state (``resolved``, ``unchecked``,
    ``mismatch`` or ``no_original``), and for the first two original_id,
    original_ts, payload_digest, length and the merged headers.
    """
    facts = F.struct("record_id", "etag", "last_modified", "headers", "payload_digest", "length")
    full = F.col("kind") == "response"
    rec = records.select(canonical_url(F.col("url")).alias("url_key"), "ts", "kind", "record_id", "etag", "last_modified",
                         F.when(full, F.lit(0)).otherwise(1).alias("rank"), F.col("headers"), facts.alias("facts"))
    # nothing is earlier than a null time and nothing shares a null URL
    loose = rec.filter("kind = 'revisit' and (url_key is null or ts is null)")
    rec = rec.filter("url_key is not null and ts is not null").withColumn("slot", F.floor(F.col("ts") / bucket))
    stamped = F.struct("ts", F.col("record_id").alias("id"), "facts")
    here = Window.partitionBy("url_key", "slot").orderBy("ts").rangeBetween(Window.unboundedPreceding, -1)
    seen = rec.select("*", F.max_by(F.when(full, stamped), F.when(full, F.struct("ts", "record_id"))).over(here).alias("near"))
    lasts = rec.filter(full).groupBy("url_key", "slot").agg(F.max_by(stamped, F.struct("ts", "record_id")).alias("last"))
    # slots of revisits too, so that each finds the last response before its slot
    slots = rec.groupBy("url_key", "slot").agg(F.count(F.lit(1)).alias("_")).drop("_").join(lasts, ["url_key", "slot"], "left")
    before = Window.partitionBy("url_key").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    carried = slots.select("url_key", "slot", F.last("last", ignorenulls=True).over(before).alias("far"))
    joined = seen.filter("kind = 'revisit'").join(carried, ["url_key", "slot"], "left").select("*", F.coalesce("near", "far").alias("o"))
    joined = joined.drop("slot", "near", "far").unionByName(loose.withColumn("o", F.lit(None).cast(joined.schema["o"].dataType)))
    o = lambda name: F.col(f"o.facts.{name}")
    by_tag = F.col("etag").isNotNull() & o("etag").isNotNull()
    by_date = F.col("last_modified").isNotNull() & o("last_modified").isNotNull()
    state = F.when(F.col("o").isNull(), "no_original").when(by_tag, F.when(_tag(F.col("etag")) == _tag(o("etag")), "resolved").otherwise("mismatch"))
    state = state.when(by_date, F.when(F.col("last_modified") == o("last_modified"), "resolved").otherwise("mismatch")).otherwise("unchecked")
    names = lambda m: F.coalesce(m, F.create_map().cast("map<string,string>"))

    def low(m):
        """Headers by lower-case name; of several spellings of a name the last one counts."""
        each = F.transform(F.map_entries(names(m)), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
        back = F.reverse(F.transform(each, lambda e: e["key"]))
        return F.map_from_entries(F.filter(each, lambda e, i: F.array_position(back, e["key"]) == F.size(back) - i))

    fresh = F.map_filter(low(F.col("headers")), lambda k, v: ~k.isin(*NOT_MERGED))
    stored = low(o("headers"))
    merged = F.map_concat(F.map_filter(stored, lambda k, v: ~F.map_contains_key(fresh, k)), fresh)
    matched = F.col("state").isin("resolved", "unchecked")
    joined = joined.select("*", state.alias("state"), merged.alias("merged"))
    keep = lambda c, name: F.when(matched, c).alias(name)
    return joined.select("record_id", "url_key", "ts", "state", keep(o("record_id"), "original_id"), keep(F.col("o.ts"), "original_ts"),
                         keep(o("payload_digest"), "payload_digest"), keep(o("length"), "length"), keep(F.col("merged"), "headers"))


def capture_log(pages: DataFrame) -> DataFrame:
    """A capture log of the ``pages`` table: each page is fetched in full at
    second ``97 * page_id`` and asked for again 1,000 * (page_id % 7 + 1)
    seconds later (one in eleven: 50,000 earlier, from another's copy), when the server answers 304: mostly with the
    page's tag, one time in ten with another, one time in five with no tag but the date, and sometimes with neither."""
    i = F.col("page_id")
    tag = F.concat(F.lit('"'), F.md5(F.coalesce("html", F.lit(""))), F.lit('"'))
    date = F.concat(F.lit("day "), i.cast("string"))
    header = lambda *kv: F.create_map(*[F.lit(x) if isinstance(x, str) else x for x in kv])
    first = pages.select(
        (2 * i).alias("record_id"), "url", (97 * i).alias("ts"), F.lit("response").alias("kind"), tag.alias("etag"), date.alias("last_modified"),
        header("Content-Type", "text/html", "Content-Length", F.length(F.coalesce("html", F.lit(""))).cast("string"), "Date", (97 * i).cast("string"),
               "Cache-Control", "max-age=60").alias("headers"), F.md5("html").alias("payload_digest"), F.length("html").cast("long").alias("length"))
    ts = 97 * i + F.when(i % 11 == 4, -50000).otherwise(1000 * (i % 7 + 1))
    again = pages.select(
        (2 * i + 1).alias("record_id"), "url", ts.alias("ts"), F.lit("revisit").alias("kind"),
        F.when(i % 10 == 3, F.lit('"other"')).when(i % 5 == 1, None).otherwise(F.concat(F.lit("W/"), tag)).alias("etag"),
        F.when(i % 15 != 1, date).alias("last_modified"),
        header("Content-Length", "0", "Date", ts.cast("string"), "ETag", F.concat(F.lit("v"), i.cast("string"))).alias("headers"),
        F.lit(None).cast("string").alias("payload_digest"), F.lit(None).cast("long").alias("length"))
    return first.unionByName(again)


def revisit_digest(pages: DataFrame) -> DataFrame:
    """Resolved revisits of the capture log, headers as sorted ``name=value`` lines."""
    out = resolve_revisits(capture_log(pages))
    text = F.concat_ws(";", F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))))
    return out.select("record_id", "url_key", "ts", "state", "original_id", "original_ts", "payload_digest", "length",
                      F.when(F.col("headers").isNotNull(), text).alias("headers"))


ORACLE = r"""
with parts as (
  select page_id i, url, html, regexp_replace(regexp_replace(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*://', ''), '#.*$', '') bare from pages),
split as (
  select *, regexp_replace(regexp_replace(lower(regexp_extract(bare, '^[^/?]*')), ':(80|443)$', ''), '^(www|m)\.', '') host,
    regexp_replace(regexp_extract(bare, '^[^/?]*([^?]*)', 1), '/+$', '') path, regexp_extract(bare, '\?(.*)$', 1) query from parts),
args as (
  select *, list_sort(list_filter(string_split(query, '&'), lambda p: p <> '' and not regexp_matches(p, '^(utm_[^=&]*|ref|fbclid|gclid)(=|$)'))) kept from split),
keyed as (
  select i, html, host || path || case when len(kept) > 0 then '?' || array_to_string(kept, '&') else '' end url_key,
    '"' || md5(coalesce(html, '')) || '"' tag from args),
fulls as (select 2 * i record_id, i, url_key, 97 * i ts, tag, md5(html) digest, length(html) n, length(coalesce(html, '')) len from keyed),
again as (
  select 2 * i + 1 record_id, i, url_key, 97 * i + case when i % 11 = 4 then -50000 else 1000 * (i % 7 + 1) end ts,
    case when i % 10 = 3 then '"other"' when i % 5 = 1 then null else tag end tag from keyed),
found as (
  select a.*, f.record_id orig, f.i fi, f.ts fts, f.tag ftag, f.digest, f.n, f.len from again a
  left join lateral (select * from fulls f where f.url_key = a.url_key and f.ts < a.ts order by f.ts desc, f.record_id desc limit 1) f on true),
judged as (
  select *, case when orig is null then 'no_original' when tag is not null then case when tag = ftag then 'resolved' else 'mismatch' end
    when i % 15 = 1 then 'unchecked' when i = fi then 'resolved' else 'mismatch' end state from found)
select record_id, url_key, ts, state, case when state in ('resolved', 'unchecked') then orig end original_id,
  case when state in ('resolved', 'unchecked') then fts end original_ts, case when state in ('resolved', 'unchecked') then digest end payload_digest,
  case when state in ('resolved', 'unchecked') then n end length, case when state in ('resolved', 'unchecked') then 'cache-control=max-age=60;content-length=' || len || ';content-type=text/html;date=' || ts || ';etag=v' || i end headers
from judged
"""
