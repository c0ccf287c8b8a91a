"""Removal of boilerplate lines, by the share of a site's pages that have a line.

Everything is a DataFrame expression. A line counts once a page; its pages are counted by
(host, hash of the line), with partial counts before the shuffle, and divided by the pages of
the host. A host with an average of m distinct lines a page has at most m / ratio lines above
a ratio, so its list of boilerplate is short whatever the number of its pages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import table, written

#: A line on more than so many percent of a host's pages, and on so many pages at least, is boilerplate.
PERCENT, LEAST = 1, 5
#: Lines of boilerplate, of all hosts together, that are broadcast; beyond them the join is shuffled.
BROADCAST_LINES = 2_000_000


def boilerplate(pages: DataFrame, host: str, text: str, percent: int = PERCENT, least: int = LEAST) -> DataFrame:
    """(host, lines): the hashes of each host's boilerplate lines; hosts without any are absent."""
    pages = pages.select(F.col(f"`{host}`").alias("host"), F.col(f"`{text}`").alias("text"))
    totals = pages.groupBy("host").agg(F.count("*").alias("pages"))
    own = F.expr("array_distinct(transform(filter(split(text, '\\n'), l -> trim(l) != ''), l -> xxhash64(trim(l))))")
    lines = pages.select("host", F.explode(own).alias("line")).groupBy("host", "line").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    many = lines.alias("l").join(totals.alias("t"), F.col("l.host").eqNullSafe(F.col("t.host"))).where(F.col("n") * 100 > F.col("pages") * percent)
    return many.groupBy(F.col("l.host").alias("host")).agg(F.collect_set("line").alias("lines"))


def drop_lines(pages: DataFrame, host: str = "source", text: str = "text", percent: int = PERCENT, least: int = LEAST) -> DataFrame:
    """`pages` without boilerplate lines in `text`, with n_lines and n_dropped (long) added.

    Lines are what stands between newlines, without the blanks around; blank ones are never
    boilerplate and stay. A null host is a host of its own; a null text stays null, with null
    counts, and its page counts in the total. A page of boilerplate alone keeps an empty text. Repeated rows
    are pages of their own. Columns named n_lines and n_dropped are replaced, however they are cased; no
    other name clashes, since a row travels as one struct.
    """
    rows = pages.drop("n_lines", "n_dropped")
    known = written(boilerplate(pages, host, text, percent, least))
    if (known.agg(F.sum(F.size("lines"))).first()[0] or 0) <= BROADCAST_LINES:
        known = F.broadcast(known)
    apart = rows.select(F.struct(*(F.col(f"`{c}`") for c in rows.columns)).alias("row"), F.col(f"`{host}`").alias("of"), F.split(F.col(f"`{text}`"), "\n").alias("every"))
    joined = apart.join(known, F.col("of").eqNullSafe(F.col("host")), "left")
    kept = joined.withColumn("kept", F.expr("CASE WHEN lines IS NULL THEN every ELSE filter(every, l -> trim(l) = '' OR NOT array_contains(lines, xxhash64(trim(l)))) END"))
    count = lambda c: F.expr(f"CASE WHEN every IS NOT NULL THEN CAST(size(filter({c}, l -> trim(l) != '')) AS BIGINT) END")
    own = (F.array_join("kept", "\n").alias(c) if c.lower() == text.lower() else F.col(f"row.`{c}`") for c in rows.columns)
    return kept.select(*own, count("every").alias("n_lines"), (count("every") - count("kept")).alias("n_dropped"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, source, n_lines, n_dropped and the text that stays."""
    return drop_lines(table(spark, sf_dir, "documents")).select("doc_id", "source", "n_lines", "n_dropped", "text")


OP2_SQL = f"""
WITH pages AS (SELECT doc_id, source, string_split(text, chr(10)) AS lines FROM documents),
totals AS (SELECT source, count(*) AS pages FROM documents GROUP BY source),
own AS (SELECT source, unnest(list_distinct(list_filter(list_transform(lines, lambda l: trim(l)), lambda l: l <> ''))) AS line FROM pages),
many AS (
  SELECT source, line FROM own JOIN totals USING (source) GROUP BY source, line, pages
  HAVING count(*) >= {LEAST} AND count(*) * 100 > pages * {PERCENT}
),
lists AS (SELECT source, list(line) AS boilerplate FROM many GROUP BY source),
kept AS (
  SELECT doc_id, source, lines, list_filter(lines, lambda l: trim(l) = '' OR NOT list_contains(coalesce(boilerplate, []), trim(l))) AS kept
  FROM pages LEFT JOIN lists USING (source)
)
SELECT doc_id, source, len(list_filter(lines, lambda l: trim(l) <> '')) AS n_lines, len(lines) - len(kept) AS n_dropped, array_to_string(kept, chr(10)) AS text
FROM kept
"""
