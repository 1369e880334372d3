"""Weak area labels from weighted keywords and title evidence."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsift import lexicons
from jobsift.functions.arrays import let
from jobsift.functions.keywords import weights_contained
from jobsift.functions.text import text_of
from jobsift.sources.tables import require_columns

Keywords = Mapping[str, Mapping[int, list[str]]]


def area_points(text: Column, keywords: Keywords = lexicons.AREA_KEYWORDS) -> Column:
    """array<int>: per area the weights of its keywords that the text contains (presence, not count)."""
    return weights_contained(F.lower(text), list(keywords.values()))


def title_boost(lowered: Column, title: Column, pattern: str, boost: int) -> Column:
    """``boost`` when the pattern is in the title or at the start of the text."""
    opening = F.substring(lowered, 1, lexicons.TITLE_WINDOW_CHARS)
    found = title.rlike(f"(?iU){pattern}") | opening.rlike(f"(?iU){pattern}")
    return F.when(found, boost).otherwise(0)


def area_scores(
    text: Column,
    title: Column,
    keywords: Keywords = lexicons.AREA_KEYWORDS,
    titles: Mapping[str, str] = lexicons.TITLE_PATTERNS,
    boost: int = lexicons.TITLE_BOOST,
    points: Column | None = None,
) -> Column:
    """array<struct<score, rank, label>>, one entry per area.

    ``points`` are the area points of the text where they are known already.
    """
    lowered, lowered_title = F.lower(text), F.lower(title)

    def scores(found: Column) -> Column:
        entries = []
        for rank, label in enumerate(keywords):
            score = F.get(found, F.lit(rank))
            if boost and label in titles:
                score = score + title_boost(lowered, lowered_title, titles[label], boost)
            entries.append(
                F.struct(
                    score.alias("score"), F.lit(-rank).alias("rank"), F.lit(label).alias("label")
                )
            )
        return F.array(*entries)

    return let(area_points(text, keywords) if points is None else points, scores)


def best_area(scores: Column) -> Column:
    """Highest score, earlier area on ties; too little evidence is ``Outro``."""
    return let(
        F.array_max(scores),
        lambda top: F.when(top["score"] < lexicons.MIN_AREA_SCORE, lexicons.OTHER_AREA).otherwise(
            top["label"]
        ),
    )


def label_text_column(df: DataFrame, text_col: str, text_source: str = "auto") -> str:
    """Cleaned text when it exists (or is asked for), else the raw text."""
    require_columns(df, "text_clean", text_col, any_of=True)
    if text_source == "raw":
        require_columns(df, text_col)
        return text_col
    if text_source == "clean":
        require_columns(df, "text_clean")
        return "text_clean"
    return "text_clean" if "text_clean" in df.columns else text_col


def label_areas(
    df: DataFrame,
    text_col: str = "descricao_texto",
    title_col: str = "titulo",
    text_source: str = "auto",
) -> DataFrame:
    """Append ``label_area`` to every row."""
    text = text_of(label_text_column(df, text_col, text_source))
    title = text_of(title_col) if title_col in df.columns else F.lit("")
    return df.withColumn("label_area", best_area(area_scores(text, title)))
