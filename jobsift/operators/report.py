"""Aggregates behind the four reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobsift import lexicons
from jobsift.functions.arrays import one_row_per_item
from jobsift.functions.keywords import words_contained
from jobsift.functions.text import text_of
from jobsift.operators import metrics


def top_by_first_seen(
    counted: DataFrame, k: int, names: Sequence[str], count_col: str = "n", first_col: str = "first"
) -> DataFrame:
    """The k largest counts; equal counts in order of first appearance."""
    return counted.orderBy(F.desc(count_col), first_col).limit(k).select(*names, count_col)


def skill_counts(
    df: DataFrame,
    text_col: str = "descricao_texto",
    skills: Sequence[str] = lexicons.REPORT_SKILLS,
    key: str = "doc_id",
) -> DataFrame:
    """(skill, n, first): documents that mention each skill.

    The map side reduces to at most one row per skill and task.
    """
    present = words_contained(F.lower(text_of(text_col)), skills)
    mentions = one_row_per_item(df, present, "skill", key)
    rank = F.array_position(F.array(*[F.lit(s) for s in skills]), F.col("skill"))
    counted = mentions.groupBy("skill").agg(
        F.count(F.lit(1)).alias("n"), F.min(key).alias("first_doc")
    )
    return counted.select("skill", "n", F.struct("first_doc", rank.alias("rank")).alias("first"))


def top_skills(
    df: DataFrame,
    text_col: str = "descricao_texto",
    k: int = lexicons.TOP_SKILLS,
    skills: Sequence[str] = lexicons.REPORT_SKILLS,
) -> DataFrame:
    return top_by_first_seen(skill_counts(df, text_col, skills), k, ["skill"])


def first_seniority(values: Column) -> Column:
    """First seniority term in lower case; ``Sem`` when there is none."""
    first = F.trim(F.get(F.split(values, ","), F.lit(0)))
    return F.when(F.trim(values) == "", lexicons.NO_SENIORITY).otherwise(F.lower(first))


def seniority_distribution(
    df: DataFrame, k: int = lexicons.TOP_SENIORITY, col: str = "senioridade_re", key: str = "doc_id"
) -> DataFrame:
    """(seniority, n), top k; an empty table when the column is missing."""
    if col not in df.columns:
        return df.sparkSession.createDataFrame([], "seniority string, n long")
    is_list = isinstance(df.schema[col].dataType, T.ArrayType)
    values = F.concat_ws(",", F.slice(col, 1, 1)) if is_list else text_of(col)
    counted = (
        df.select(key, first_seniority(values).alias("seniority"))
        .groupBy("seniority")
        .agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("first"))
    )
    return top_by_first_seen(counted, k, ["seniority"])


def skill_pair_counts(
    df: DataFrame,
    text_col: str = "descricao_texto",
    skills: Sequence[str] = lexicons.REPORT_SKILLS,
    key: str = "doc_id",
) -> DataFrame:
    """(a, b, n, first): documents that mention both skills, a before b.

    Documents are counted per combination of skills first, so the pairs of a
    combination are listed once however many documents share it.
    """
    present = F.sort_array(words_contained(F.lower(text_of(text_col)), skills))
    # no filter on the size: it would be moved below and look for the skills twice
    combinations = (
        df.select(key, present.alias("skills"))
        .groupBy("skills")
        .agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("first_doc"))
    )
    followers = F.transform(
        F.col("skills"),
        lambda a, i: F.transform(
            F.slice(F.col("skills"), i + 2, F.size("skills")),
            lambda b: F.struct(a.alias("a"), b.alias("b")),
        ),
    )
    pairs = one_row_per_item(combinations, F.flatten(followers), "p", "n", "first_doc").select(
        "n", "first_doc", "p.*"
    )
    return (
        pairs.groupBy("a", "b")
        .agg(F.sum("n").alias("n"), F.min("first_doc").alias("first_doc"))
        .select("a", "b", "n", F.struct("first_doc", "a", "b").alias("first"))
    )


def top_skill_pairs(
    df: DataFrame,
    text_col: str = "descricao_texto",
    k: int = lexicons.TOP_PAIRS,
    skills: Sequence[str] = lexicons.REPORT_SKILLS,
) -> DataFrame:
    """(pair, n) with the pair written ``a+b``."""
    top = top_by_first_seen(skill_pair_counts(df, text_col, skills), k, ["a", "b"])
    return top.select(F.concat_ws("+", "a", "b").alias("pair"), "n")


def confusion_report(matrix: DataFrame, labels: DataFrame) -> DataFrame:
    """Stored confusion matrix as a labelled grid in label order."""
    names = [r["label"] for r in labels.orderBy("label_idx").collect()]
    return metrics.confusion_grid(matrix, names)
