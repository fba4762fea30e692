"""Document collections as the frames that scoring and the dashboard read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Of each column, the field it comes from and its type ("" leaves it as it is).
Fields = dict[str, tuple[str, str]]

HISTORY: Fields = {"user_id": ("user_id", ""), "historical_episode_id": ("episode_id", "")}
SCORES: Fields = {"user_id": ("user_id", ""), "episode_id": ("episode_id", ""), "als_score": ("als_score", "double")}
NEIGHBOURS: Fields = {"episode_id": ("new_episode_id", ""), "similar_episode_id": ("historical_episode_id", ""), "similarity": ("similarity", "double")}


def projected(df: DataFrame, fields: Fields) -> DataFrame:
    """Exactly these columns. A field that no document has is null, and so is a value that its type can't hold."""
    out = []
    for name, (source, kind) in fields.items():
        x = F.col(source) if source.split(".")[0] in df.columns else F.lit(None).cast(kind or "string")
        out.append((x.try_cast(kind) if kind else x).alias(name))
    return df.select(*out)


def found(df: DataFrame, *names: str) -> DataFrame:
    """These fields of every document, null where the collection lacks one, and nothing else."""
    return projected(df, {x: (x, "") for x in names})


def history(df: DataFrame) -> DataFrame:
    """What each user has heard, each pair once; without null ids."""
    return projected(df, HISTORY).dropna().dropDuplicates()


def scores(df: DataFrame) -> DataFrame:
    """Collaborative scores; documents without an id or a number are left out, repeated ones stay."""
    return projected(df, SCORES).dropna()


def neighbours(df: DataFrame) -> DataFrame:
    """Episodes and similar ones; documents without an id or a number are left out, repeated ones stay."""
    return projected(df, NEIGHBOURS).dropna()
