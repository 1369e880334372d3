"""Regular-expression features of a posting: projections only, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsift import lexicons
from jobsift.functions.keywords import words_contained
from jobsift.functions.text import find_all, find_all_if, joined, text_of
from jobsift.sources.tables import require_columns

TEXT_COL = "descricao_texto"


def seniority(text: Column) -> Column:
    return find_all(text, lexicons.SENIORITY_PATTERN)


def regime(text: Column) -> Column:
    return find_all(text, lexicons.REGIME_PATTERN)


def salary(text: Column) -> Column:
    return find_all(text, lexicons.SALARY_PATTERN)


def workload(text: Column) -> Column:
    # every match ends in "week" or "semana"
    lowered = F.lower(text)
    hint = F.contains(lowered, F.lit("wee")) | F.contains(lowered, F.lit("emana"))
    return find_all_if(text, hint, lexicons.WORKLOAD_PATTERN)


def urls(text: Column) -> Column:
    lowered = F.lower(text)
    hint = F.contains(lowered, F.lit("http")) | F.contains(lowered, F.lit("www."))
    return find_all_if(text, hint, lexicons.URL_PATTERN)


def emails(text: Column) -> Column:
    return find_all_if(text, F.contains(text, F.lit("@")), lexicons.EMAIL_PATTERN)


def skills(text: Column, words: list[str] | None = None) -> Column:
    return words_contained(F.lower(text), words or lexicons.POSTING_SKILLS)


def feature_arrays(text: Column) -> dict[str, Column]:
    """The seven features as arrays, keyed by output column."""
    kept = lexicons.MAX_LINKS_KEPT
    return {
        "senioridade_re": seniority(text),
        "regime_re": regime(text),
        "salario_re": salary(text),
        "carga_horaria_re": workload(text),
        "urls_re": F.slice(urls(text), 1, kept),
        "emails_re": F.slice(emails(text), 1, kept),
        "skills_re": skills(text),
    }


def extract_features(
    df: DataFrame, text_col: str = TEXT_COL, as_arrays: bool = False
) -> DataFrame:
    """Append the seven feature columns, joined with ``", "`` by default."""
    require_columns(df, text_col)
    features = feature_arrays(text_of(text_col))
    if not as_arrays:
        features = {name: joined(column) for name, column in features.items()}
    return df.withColumns(features)
