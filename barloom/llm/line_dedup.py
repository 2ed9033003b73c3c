"""Boilerplate lines: those on too large a share of a host's pages are taken out of the texts of that host.

Everything here is a DataFrame expression. Lines are counted under their digest, so long lines cost no more than short
ones, and hot lines are counted before they are shuffled. A host can have (lines per page / ratio) boilerplate lines at
most, so these are gathered per host and written; where that table is small it is broadcast by its size, otherwise
pages meet it by host and a salt, so a hot host is dealt to many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import written

#: Parts into which every host is dealt.
SALTS = 16


def _digest(line: Column) -> Column:
    """Digest of a line's content, null for a blank line."""
    content = F.trim(line, F.lit(" \t\x0b\f\r"))
    return F.when(content != "", F.unhex(F.md5(content)))


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def boilerplate(pages: DataFrame, host: str, text: str = "text", ratio: float = 0.1, least_pages: int = 5) -> DataFrame:
    """Rows (host, lines): digests of the lines that stand on over ``ratio`` of the host's pages, ``least_pages`` at least.

    A page counts once for a line however often it repeats it. Rows without a host are one host (null).
    """
    at = F.col(f"`{host}`").alias("host")
    # an outer explode: the plain one adds a filter that computes all digests a second time
    per_page = pages.select(at, F.explode_outer(F.array_distinct(F.transform(_lines(F.col(f"`{text}`")), _digest))).alias("line"))
    seen = per_page.filter("line IS NOT NULL").groupBy("host", "line").agg(F.count("*").alias("n"))
    pages_of = pages.groupBy(at).agg(F.count("*").alias("pages")).withColumnRenamed("host", "of_host")
    often = seen.filter(F.col("n") >= least_pages).join(pages_of, F.col("host").eqNullSafe(F.col("of_host")))
    return often.filter(F.col("n") > ratio * F.col("pages")).groupBy("host").agg(F.collect_list("line").alias("lines"))


def drop_boilerplate(pages: DataFrame, host: str, text: str = "text", ratio: float = 0.1, least_pages: int = 5,
                     removed: str | None = None, length: str | None = None) -> DataFrame:
    """``pages`` with boilerplate lines gone from ``text``; the lines left are joined as they were.

    Every row stays, repeated rows too; a page all of whose lines go has an empty text, and a null text stays null.
    ``removed`` names a column for the number of lines taken out, ``length`` one of ``pages`` that holds the characters
    of the text and is brought up to date. Blank lines are never counted or removed.
    """
    # written first, so that its size decides: where it is small it goes to the pages and no text is moved
    found = written(boilerplate(pages, host, text, ratio, least_pages), "boilerplate").select(
        F.col("host").alias("__llm_host"), F.col("lines").alias("__llm_lines"),
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("__llm_of"),
    )
    own, body = [F.col(f"`{c}`") for c in pages.columns], F.col(f"`{text}`")
    salted = pages.withColumn("__llm_salt", F.pmod(F.xxhash64(*own), F.lit(SALTS)).cast("int"))
    met = salted.join(
        found, F.col(f"`{host}`").eqNullSafe(F.col("__llm_host")) & (F.col("__llm_salt") == F.col("__llm_of")), "left"
    ).select(*own, "__llm_lines", _lines(body).alias("__llm_all"))
    left = F.when(
        F.col("__llm_lines").isNull(), F.col("__llm_all")
    ).otherwise(
        F.filter("__llm_all", lambda x: ~F.coalesce(F.array_contains(F.col("__llm_lines"), _digest(x)), F.lit(False)))
    )
    done = met.withColumn("__llm_left", left)
    joined = F.array_join("__llm_left", "\n")
    changed = {text: joined} | ({length: F.length(joined).cast(pages.schema[length].dataType)} if length else {})
    out = [changed.get(c, F.col(f"`{c}`")).alias(c) for c in pages.columns]
    if removed:
        out.append(F.coalesce(F.size("__llm_all") - F.size("__llm_left"), F.lit(0)).cast("bigint").alias(removed))
    return done.select(*out)
