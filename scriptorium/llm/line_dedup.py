"""Line dedup by site-relative frequency.

A line is boilerplate on a host when the share of the host's pages that hold
it exceeds a ratio. Counting shuffles one row per (host, line) and task;
the text itself is never shuffled unless the boilerplate table outgrows the
broadcast bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.llm.common import stored, table

#: Share of a host's pages above which a line is boilerplate.
RATIO = 0.1
#: Pages of a host that must hold a line, whatever the host's size: what one or two pages say is their own.
HOLDING = 3
#: Boilerplate lines up to which their table is broadcast (about 60 bytes each).
BROADCAST_LINES = 100_000
#: Ways a host is split when that table has to be joined by shuffle.
SALTS = 64


def _filled(line: Column) -> Column:
    return F.length(F.trim(line)) > 0


def boilerplate(df: DataFrame, text: str, host: str, ratio: float = RATIO, min_pages: int = 1, once: bool = False) -> DataFrame:
    """(host, line_key, n_pages, host_pages) of the boilerplate lines.

    A host has at most (lines of its mean page / ratio) of them. Lines are
    known by their MD5; blank lines and pages without host or text don't count
    as lines, but a page without text does count as a page of its host. A line that fewer than
    HOLDING pages hold is none, on a host of any size; hosts of fewer than ``min_pages`` pages, if asked, are left alone.

    With ``once``, copies are no evidence: equal texts are one page of the host, and of the pages that hold a line
    those with the same least hash among their other lines count once, so that near
    copies, which share nearly all their lines, count about as one page does.
    """
    pages = df.select(F.col(host).alias("host"), F.col(text).alias("t")).where(F.col("host").isNotNull())
    keys = F.array_distinct(F.transform(F.filter(F.split("t", "\n"), _filled), lambda x: F.md5(F.trim(x))))
    if once:
        totals = pages.select("host", F.xxhash64("t").alias("x")).distinct().groupBy("host").agg(F.count(F.lit(1)).alias("host_pages"))
        least = pages.select("host", F.array_sort(keys).alias("k")).select("host", F.explode("k").alias("line_key"), F.get("k", F.lit(0)).alias("a"), F.get("k", F.lit(1)).alias("b"))
        lines = least.select("host", "line_key", F.xxhash64(F.when(F.col("line_key") == F.col("a"), F.col("b")).otherwise(F.col("a"))).alias("among")).distinct()
    else:
        totals = pages.groupBy("host").agg(F.count(F.lit(1)).alias("host_pages"))
        lines = pages.select("host", F.explode(keys).alias("line_key"))
    counts = lines.groupBy("host", "line_key").agg(F.count(F.lit(1)).alias("n_pages")).where(F.col("n_pages") >= HOLDING)
    return counts.join(totals.where(F.col("host_pages") >= min_pages), "host").where(F.col("n_pages") > ratio * F.col("host_pages"))


def _free(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores as no column of df has."""
    taken = {c.lower() for c in df.columns}
    return [next(n + "_" * k for k in range(len(taken) + 1) if n + "_" * k not in taken) for n in names]


def drop_boilerplate(
    df: DataFrame, text: str, host: Column, ratio: float = RATIO, min_pages: int = 1, once: bool = False
) -> DataFrame:
    """df with the boilerplate lines of each host (see there) taken out of column ``text``,
    and the columns n_lines and n_dropped added.

    Lines end at \\n and are compared without surrounding spaces. Null text
    stays null (0 lines); a text of boilerplate only becomes empty; rows with a
    null host are left as they are; repeated rows count as pages of their own.
    Blank lines stay. df may have columns of any names but n_lines and n_dropped, which are refused.
    """
    if {"n_lines", "n_dropped"} & {c.lower() for c in df.columns}:
        raise ValueError("df already has a column n_lines or n_dropped")
    of, salt, drop, kept = _free(df, "host", "salt", "drop", "kept")
    work = df.withColumn(of, host)
    found = stored(boilerplate(work, text, of, ratio, min_pages, once))
    per_host = found.groupBy(F.col("host").alias(of)).agg(F.collect_list("line_key").alias(drop))
    if found.count() <= BROADCAST_LINES:
        joined = work.join(F.broadcast(per_host), of, "left")
    else:
        salted = per_host.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = work.withColumn(salt, F.pmod(F.xxhash64(text), F.lit(SALTS)).cast("int")).join(salted, [of, salt], "left")
    every = F.split(F.col(text), "\n")
    left = F.when(F.col(drop).isNull(), every).otherwise(F.filter(every, lambda x: ~(_filled(x) & F.array_contains(F.col(drop), F.md5(F.trim(x))))))
    joined = joined.withColumn(kept, left)
    return (
        joined.withColumn("n_lines", F.coalesce(F.array_size(every), F.lit(0)).cast("long"))
        .withColumn("n_dropped", F.col("n_lines") - F.coalesce(F.array_size(kept), F.lit(0)))
        .withColumn(text, F.array_join(kept, "\n"))
        .select(*df.columns, "n_lines", "n_dropped")
    )


#: Elements that end a line of a page's text.
_BLOCK = "p|div|br|h1|h2|h3|h4|h5|h6|li|ul|ol|nav|article|section|header|footer|table|tr|td|th|title|body|head|html|blockquote|pre|main|aside"


def page_text(html: Column) -> Column:
    """Visible lines of a page: scripts, styles and comments go, block elements end lines."""
    x = F.regexp_replace(html, r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->", "")
    x = F.regexp_replace(x, r"[\r\n\t ]+", " ")
    x = F.regexp_replace(x, rf"(?i)</?({_BLOCK})\b[^>]*>", "\n")
    x = F.regexp_replace(x, r"<[^>]*>", "")
    return F.trim(F.regexp_replace(x, r" *\n[ \n]*", "\n"))


def url_host(url: Column) -> Column:
    """Lower-case host of a URL; null where there is none."""
    x = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1)
    return F.when(F.length(x) > 0, x)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7: the text of every page without its host's boilerplate lines.

    Pages are parsed once and kept in the shared folder, as they are read twice.
    """
    pages = stored(
        table(spark, sf_dir, "pages").select("page_id", url_host(F.col("url")).alias("host"), page_text(F.col("html")).alias("text"))
    )
    return drop_boilerplate(pages, "text", F.col("host"))


ORACLE = rf"""
WITH x AS (
  SELECT page_id,
    nullif(regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1), '') AS host,
    regexp_replace(html, '(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->', '', 'g') AS h
  FROM pages
), y AS (
  SELECT page_id, host, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(h,
    '[\r\n\t ]+', ' ', 'g'), '(?i)</?({_BLOCK})\b[^>]*>', chr(10), 'g'), '<[^>]*>', '', 'g'), ' *\n[ \n]*', chr(10), 'g'), ' ') AS t
  FROM x
), l AS (
  SELECT page_id, host, i, string_split(t, chr(10))[i] AS line
  FROM (SELECT page_id, host, t, unnest(generate_series(1, len(string_split(t, chr(10))))) AS i FROM y)
), c AS (SELECT host, trim(line, ' ') AS line, count(DISTINCT page_id) AS n FROM l WHERE trim(line, ' ') <> '' GROUP BY ALL),
t AS (SELECT host, count(*) AS total FROM y GROUP BY host),
b AS (SELECT host, line FROM c JOIN t USING (host) WHERE n >= {HOLDING} AND n > {RATIO}::DOUBLE * total),
m AS (SELECT l.*, b.line IS NOT NULL AS gone FROM l LEFT JOIN b ON l.host = b.host AND trim(l.line, ' ') = b.line)
SELECT page_id, host, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '') AS text,
  count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped
FROM m GROUP BY page_id, host
"""
