"""Readings of system counters from the text of /proc files and accelerator tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _numbers(line: Column) -> Column:
    return F.transform(F.filter(F.split(F.trim(line), r"\s+"), lambda x: x.rlike(r"^-?\d+$")), lambda x: x.cast("bigint"))


def cpu_totals(stat: DataFrame, text: str = "value") -> DataFrame:
    """(cpu, total, idle) of each cpu line of /proc/stat; idle includes waiting for input and output."""
    lines = stat.select(F.explode(F.split(text, "\n")).alias("line")).where(F.col("line").rlike(r"^cpu\d*\s"))
    n = _numbers(F.regexp_replace("line", r"^cpu\d*", ""))
    rows = lines.select(F.regexp_extract("line", r"^(cpu\d*)", 1).alias("cpu"), n.alias("n")).where(F.size("n") >= 4)
    return rows.select("cpu", F.aggregate("n", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("total"), (F.element_at("n", 4) + F.coalesce(F.try_element_at("n", F.lit(5)), F.lit(0))).alias("idle"))


def memory_kib(meminfo: DataFrame, text: str = "value") -> DataFrame:
    """(key, kib) of /proc/meminfo."""
    lines = meminfo.select(F.explode(F.split(text, "\n")).alias("line"))
    return lines.select(F.regexp_extract("line", r"^(\w[\w()]*):", 1).alias("key"), F.regexp_extract("line", r":\s*(\d+)", 1).try_cast("bigint").alias("kib")).where("key <> '' and kib is not null")


def load_average(c: Column) -> Column:
    a = F.split(F.trim(c), r"\s+")
    at = lambda i: F.try_element_at(a, F.lit(i)).try_cast("double")
    return F.struct(at(1).alias("one"), at(2).alias("five"), at(3).alias("fifteen"))


def process_stat(c: Column) -> Column:
    """struct(pid, name, state, utime, stime) of /proc/<pid>/stat; the name may hold blanks and brackets."""
    rest = F.split(F.trim(F.regexp_extract(c, r"^\d+ \(.*\) (.*)$", 1)), " ")
    return F.struct(
        F.regexp_extract(c, r"^(\d+) ", 1).try_cast("int").alias("pid"), F.regexp_extract(c, r"^\d+ \((.*)\) ", 1).alias("name"), F.try_element_at(rest, F.lit(1)).alias("state"),
        F.try_element_at(rest, F.lit(12)).try_cast("bigint").alias("utime"), F.try_element_at(rest, F.lit(13)).try_cast("bigint").alias("stime"),
    )


def accelerator_rows(table: DataFrame, text: str = "value") -> DataFrame:
    """(index, name, utilisation, memory_used, memory_total) of a CSV table; [N/A] becomes null, short lines are left out."""
    lines = table.select(F.explode(F.split(text, "\n")).alias("line")).where("trim(line) <> ''")
    c = F.transform(F.split("line", ","), lambda x: F.trim(x))
    rows = lines.select(c.alias("c")).where(F.size("c") >= 5)
    number = lambda i: F.regexp_extract(F.element_at("c", i), r"^(\d+(?:\.\d+)?)", 1).try_cast("double")
    return rows.select(number(1).cast("int").alias("index"), F.element_at("c", 2).alias("name"), number(3).alias("utilisation"), number(4).alias("memory_used"), number(5).alias("memory_total"))
