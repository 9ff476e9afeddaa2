"""Instrument files: names, what is missing, and what to rename."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.recode import recode
from ..functions.text import extract_first, paste, replace_all, replace_first
from ..operators.joins import anti_join
from ..operators.reshape import union_by_name
from ..operators.rows import groups_of_size

OTHER_SIDE = {"left": "right", "right": "left"}


def side_in(name: str) -> Column:
    return F.when(F.col(name).rlike("LEFT|left|Left"), "left").when(
        F.col(name).rlike("RIGHT|right|Right"), "right")


def visit_in(name: str) -> Column:
    """By the end of the name; the first test that holds decides."""
    return (
        F.when(F.col(name).rlike("T12$"), "m12")
        .when(F.col(name).rlike("T4$"), "m4")
        .when(F.col(name).rlike("t$|T$"), "m0")
    )


def name_of(path: str, extension: str = "txt") -> Column:
    """Base name of a path, null if the name has further dots."""
    return replace_all(extract_first(path, rf"/[^/.]+\.{extension}"), rf"/|\.{extension}")


def canonical_name(prefix: str, by: str = "id", side: str = "side", timepoint: str = "timepoint") -> Column:
    base = [F.lit(prefix), F.col(by), F.upper(side)]
    visit = F.upper(replace_first(timepoint, "m", "t"))
    return F.when(F.col(timepoint) == "m0", paste(*base, sep="_")).when(
        F.col(timepoint) != "m0", paste(*base, visit, sep="_"))


def path_metadata(files: DataFrame, prefix: str, path: str = "file", extension: str = "txt") -> DataFrame:
    """Name, id, side, timepoint and canonical name from each file's path."""
    df = files.withColumn("name", name_of(path, extension))
    df = df.withColumns({
        "id": extract_first("name", r"\d+(?=_)").try_cast("bigint"),
        "side": side_in("name"),
        "timepoint": visit_in("name"),
    })
    return df.withColumn("correct_name", canonical_name(prefix))


def missing_files(expected: DataFrame, found: DataFrame) -> DataFrame:
    """Visits without a file (side ``both``), and the other side of lone files."""
    none = anti_join(expected, found, ["id", "timepoint"], null_safe=True)
    none = none.select("id", "timepoint", F.lit("both").alias("side"))
    lone = groups_of_size(found, ["id", "timepoint"], 1, order="side")
    lone = lone.select("id", "timepoint", recode("side", OTHER_SIDE).alias("side"))
    return union_by_name(none, lone)


def rename_plan(files: DataFrame, path: str = "file", extension: str = "txt") -> DataFrame:
    """(current, correct) paths of the files that are not canonically named."""
    wrong = files.filter(F.col("name") != F.col("correct_name"))
    target = F.concat(F.col("dir"), F.lit("/"), F.col("correct_name"), F.lit(f".{extension}"))
    return wrong.select(F.col(path).alias("current_path"), target.alias("correct_path"))
