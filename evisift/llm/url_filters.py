"""URL filters [native]: a temporal as-of join of captures with dated list entries.

List entries (key, kind block or allow, day, action add or remove) become validity intervals: for each key and kind,
an entry holds from its day until the next entry's, and counts while its action is add.  A capture's keys are its
host, each parent domain, and the host with each leading path segment; it is joined on the key with the intervals
that hold at its fetch time.  The most specific active key decides, allow before block at equal length.

What is judged is each distinct URL and time; every capture then takes its own verdict, so captures of one page at
several times, or rows that share an id, are never mixed.  Both joins are equi-joins with a shuffle on both sides, so
adaptive execution splits a host or a URL that holds a third of all captures; the list is never assumed small.  Keys
longer than any of the list are not made: how many labels and segments it has at most is one row, worked out with the
query.

Cases: a null or malformed URL has no host and no match; entries with a null key, day or action are left out; of
several entries of one key, kind and day the removal wins; repeated captures and repeated or null ids are rows each by
itself; empty tables give no rows, an empty list no matches; very long URLs give as many keys as the list is deep.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def intervals(entries: DataFrame) -> DataFrame:
    """key, kind, since, until (exclusive, null: open): when each key is listed."""
    w = Window.partitionBy("key", "kind").orderBy("day")
    one = entries.where("key is not null and kind is not null and day is not null and action in ('add', 'remove')").groupBy("key", "kind", "day").agg(F.max("action").alias("action"))
    return one.withColumn("until", F.lead("day").over(w)).where("action = 'add'").select("key", "kind", F.col("day").alias("since"), "until")


def with_host(df: DataFrame, url: str = "url") -> DataFrame:
    """df with host (lower case, no port or user) and path (leading slash, no query or fragment)."""
    host = F.lower(F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))
    path = F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)", 1)
    return df.withColumn("host", F.nullif(F.coalesce(host, F.lit("")), F.lit(""))).withColumn("path", F.coalesce(path, F.lit("")))


def keys(labels: str, segments: str) -> str:
    """SQL for the keys of host and path of at most so many labels and path segments."""
    most = lambda parts, n: f"least(size({parts}), {n})"
    own, steps = "split(host, '[.]')", "filter(split(path, '/'), s -> s != '')"
    parents = f"transform(sequence(1, greatest(1, {most(own, labels)})), i -> array_join(slice({own}, -i, i), '.'))"
    paths = f"if({most(steps, segments)} = 0, cast(array() as array<string>), transform(sequence(1, greatest(1, {most(steps, segments)})), i -> concat(host, '/', array_join(slice({steps}, 1, i), '/'))))"
    return f"if(host is null, cast(array() as array<string>), array_distinct(concat({parents}, {paths})))"


def filter_urls(captures: DataFrame, entries: DataFrame, page_id: str = "page_id", url: str = "url", fetched: str = "fetched") -> DataFrame:
    """page_id, host, fetched, n_block, n_allow, specificity (key length, null: no match), blocked of each capture."""
    base = captures.select(F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("url"), F.col(fetched).alias("fetched"))
    listed = intervals(entries)
    deepest = listed.agg(
        F.coalesce(F.max(F.size(F.split(F.substring_index("key", "/", 1), "[.]"))), F.lit(0)).alias("labels"),
        F.coalesce(F.max(F.size(F.split("key", "/")) - 1), F.lit(0)).alias("segments"),
    )
    judged = with_host(base.where("url is not null and fetched is not null").select("url", "fetched").distinct())
    judged = judged.withColumn("labels", deepest.select("labels").scalar()).withColumn("segments", deepest.select("segments").scalar())
    asked = judged.select("url", "fetched", F.explode(F.expr(keys("labels", "segments"))).alias("key"))
    # Merge joins at every size: captures and list both grow.
    hit = asked.join(listed.hint("merge"), "key").where("since <= fetched and (until is null or fetched < until)")
    per = hit.groupBy("url", "fetched").agg(
        F.expr("count_if(kind = 'block')").alias("n_block"),
        F.expr("count_if(kind = 'allow')").alias("n_allow"),
        F.expr("max(length(key) * 2 + if(kind = 'allow', 1, 0))").alias("best"),
    )
    out = with_host(base).join(per.hint("merge"), ["url", "fetched"], "left")
    return out.select("page_id", "host", "fetched", F.expr("coalesce(n_block, 0L)").alias("n_block"), F.expr("coalesce(n_allow, 0L)").alias("n_allow"), F.expr("cast(floor(best / 2) as int)").alias("specificity"), F.expr("coalesce(best % 2 = 0, false)").alias("blocked"))


def _draw(x: str, salt: str, modulo: int) -> str:
    return f"cast(conv(substring(md5(concat({x}, '{salt}')), 1, 6), 16, 10) as int) % {modulo}"


def drawn_list(pages: DataFrame) -> DataFrame:
    """Dated entries for the pages' own hosts, drawn by md5: the tables hold no list, so the query stands one in.

    A third of the hosts are added as blocked on a day of 2024 and, in half of the cases, removed up to 90 days later;
    a quarter of the top-level domains are blocked from a day on; for a tenth of the hosts one path is allowed.
    """
    hosts = with_host(pages.select("url")).select("host", F.expr("concat(host, '/', element_at(filter(split(path, '/'), s -> s != ''), 1))").alias("spot")).where("host is not null").distinct()
    day = lambda n: F.expr(f"date_add(date'2024-01-01', {n})")
    one = hosts.select("host").distinct()
    added = one.where(f"{_draw('host', 'b', 3)} = 0").select(F.col("host").alias("key"), F.lit("block").alias("kind"), day(_draw("host", "d", 366)).alias("day"), F.lit("add").alias("action"))
    gone = one.where(f"{_draw('host', 'b', 3)} = 0 and {_draw('host', 'r', 2)} = 0").select(F.col("host").alias("key"), F.lit("block").alias("kind"), day(f"{_draw('host', 'd', 366)} + 1 + {_draw('host', 'e', 90)}").alias("day"), F.lit("remove").alias("action"))
    above = one.select(F.expr("array_join(slice(split(host, '[.]'), -2, 2), '.')").alias("key")).where("key like '%.%'").distinct().where(f"{_draw('key', 't', 4)} = 0")
    above = above.select("key", F.lit("block").alias("kind"), day(_draw("key", "d", 366)).alias("day"), F.lit("add").alias("action"))
    spots = hosts.where(f"spot is not null and {_draw('spot', 'a', 10)} = 0").select(F.col("spot").alias("key"), F.lit("allow").alias("kind"), day(_draw("spot", "d", 366)).alias("day"), F.lit("add").alias("action")).distinct()
    return added.unionByName(gone).unionByName(above).unionByName(spots)


def op6_url_filters(pages: DataFrame) -> DataFrame:
    """filter_urls over all pages; fetch days stand in as 2024-01-01 plus page_id modulo 366, as pages has none."""
    captures = pages.select("page_id", "url", F.expr("date_add(date'2024-01-01', cast(pmod(page_id, 366) as int))").alias("fetched"))
    return filter_urls(captures, drawn_list(pages))


_HOST = r"nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)', 1)), '')"
_PATH = r"regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1)"


def _duck(x: str, salt: str, modulo: int) -> str:
    return f"(('0x' || substr(md5({x} || '{salt}'), 1, 6))::INTEGER % {modulo})"


ORACLE_SQL = f"""
WITH base AS (SELECT page_id, url, {_HOST} AS host, coalesce({_PATH}, '') AS path, DATE '2024-01-01' + CAST(page_id % 366 AS INTEGER) AS fetched FROM pages),
parts AS (SELECT *, string_split(host, '.') AS labels, list_filter(string_split(path, '/'), lambda s: s <> '') AS steps FROM base),
hosts AS (SELECT DISTINCT host, CASE WHEN len(steps) > 0 THEN host || '/' || steps[1] END AS spot FROM parts WHERE host IS NOT NULL),
one AS (SELECT DISTINCT host FROM hosts),
tops AS (SELECT DISTINCT array_to_string(labels[-2:], '.') AS key FROM parts WHERE host IS NOT NULL AND len(labels) > 1),
entries AS (
  SELECT host AS key, 'block' AS kind, DATE '2024-01-01' + {_duck("host", "d", 366)} AS day, 'add' AS action FROM one WHERE {_duck("host", "b", 3)} = 0
  UNION ALL SELECT host, 'block', DATE '2024-01-01' + ({_duck("host", "d", 366)} + 1 + {_duck("host", "e", 90)}), 'remove' FROM one WHERE {_duck("host", "b", 3)} = 0 AND {_duck("host", "r", 2)} = 0
  UNION ALL SELECT key, 'block', DATE '2024-01-01' + {_duck("key", "d", 366)}, 'add' FROM tops WHERE {_duck("key", "t", 4)} = 0
  UNION ALL SELECT DISTINCT spot, 'allow', DATE '2024-01-01' + {_duck("spot", "d", 366)}, 'add' FROM hosts WHERE spot IS NOT NULL AND {_duck("spot", "a", 10)} = 0),
one_a_day AS (SELECT key, kind, day, max(action) AS action FROM entries GROUP BY ALL),
spans AS (SELECT *, lead(day) OVER (PARTITION BY key, kind ORDER BY day) AS until FROM one_a_day),
asked AS (SELECT DISTINCT url, fetched, unnest(list_concat(list_transform(range(1, len(labels) + 1), lambda i: array_to_string(labels[i:], '.')), list_transform(range(1, len(steps) + 1), lambda i: host || '/' || array_to_string(steps[:i], '/')))) AS key FROM parts WHERE host IS NOT NULL),
hit AS (SELECT url, fetched, count(*) FILTER (kind = 'block') AS n_block, count(*) FILTER (kind = 'allow') AS n_allow, max(length(key) * 2 + (kind = 'allow')::INTEGER) AS best
  FROM asked JOIN spans USING (key) WHERE action = 'add' AND day <= fetched AND (until IS NULL OR fetched < until) GROUP BY url, fetched)
SELECT page_id, host, base.fetched AS fetched, coalesce(n_block, 0) AS n_block, coalesce(n_allow, 0) AS n_allow, CAST(best // 2 AS INTEGER) AS specificity, coalesce(best % 2 = 0, false) AS blocked
FROM base LEFT JOIN hit USING (url, fetched)"""
