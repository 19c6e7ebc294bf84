"""Genre lookup, genre junction, language table, new-key append."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.dedupe import distinct_by_key
from strata.operators.merge import null_safe_join


def exploded_genres(records: DataFrame, id_col: str = "Id",
                    genres: str = "genres") -> DataFrame:
    """X2 + P8: one row per (record, genre): ``Id, genre_id, genre_name``.

    NULL or empty arrays give no row.
    """
    g = records.select(F.col(id_col), F.explode(genres).alias("g"))
    return g.select(
        F.col(id_col),
        F.col("g.id").alias("genre_id"),
        F.col("g.name").alias("genre_name"),
    )


def genre_lookup(records: DataFrame, genres: str = "genres") -> DataFrame:
    """G1: ``(genre_id, genre_name)``, one row per id (name = max, deterministic).

    Distinct ``(id, name)`` pairs first: a hash aggregate, partial before the
    shuffle, so a genre shared by most records costs one shuffled row per map
    task. Only that small distinct set reaches the per-id ``max`` (a sort
    aggregate, as ``max`` of a string has no fixed-width buffer).
    """
    g = records.select(F.explode(genres).alias("g")).select(
        F.col("g.id").alias("genre_id"), F.col("g.name").alias("genre_name"))
    return distinct_by_key(g.dropDuplicates(), "genre_id", ["genre_name"])


def genre_junction(records: DataFrame, id_col: str = "Id",
                   genres: str = "genres") -> DataFrame:
    """Distinct ``(Id, genre_id)`` pairs."""
    return exploded_genres(records, id_col, genres).select(id_col, "genre_id").distinct()


def append_new_keys(new: DataFrame, existing: DataFrame | None,
                    key: str | Sequence[str]) -> DataFrame:
    """Rows of ``new`` whose key is not yet in ``existing`` (left anti join).

    NULL equals NULL here: a NULL key that the table already holds is not new,
    so appending twice adds nothing.
    """
    if existing is None:
        return new
    keys = [key] if isinstance(key, str) else list(key)
    return null_safe_join(new, existing, keys, "left_anti")


def languages(records: DataFrame, column: str = "OriginalLanguage",
              distinct: bool = False) -> DataFrame:
    """The language column as a bag (faithful) or as a set."""
    out = records.select(column)
    return out.distinct() if distinct else out
