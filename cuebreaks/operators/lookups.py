"""Joins: label overrides, title metadata, and lookups into the same relation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cuebreaks.functions.measures import one_more_multiplier, spec_multiplier
from cuebreaks.functions.text import normalize_asset_id
from cuebreaks.operators.skew import HOT_ROWS, HotKeys, find_hot, join_on
from cuebreaks.operators.versions import distinct_rows

METADATA_MATCHES = ("exact", "normalized")
TITLE_KEY = "_title_key"


def label_override(
    df: DataFrame,
    corrections: DataFrame,
    on: Sequence[tuple[str, str]],
    values: Sequence[tuple[str, str]],
    hot: HotKeys | None = None,
) -> DataFrame:
    """Replace columns by the correction's value where it has one.

    ``on`` pairs columns that must match case-insensitively, ``values`` pairs each column
    with its correcting column. Several corrections for one row give several rows.
    """
    keyed = df.withColumns({f"_key_{a}": F.lower(a) for a, _ in on})
    lookup = corrections.select(
        *[F.lower(b).alias(f"_key_{b}") for _, b in on],
        *[F.col(b).alias(f"_new_{b}") for _, b in values],
    ).dropna(subset=[f"_key_{b}" for _, b in on])
    joined = join_on(keyed, lookup, [(f"_key_{a}", f"_key_{b}") for a, b in on], hot=hot)
    corrected = {a: F.coalesce(F.col(f"_new_{b}"), F.col(a)) for a, b in values}
    return joined.withColumns(corrected).select(*df.columns)


def title_lookup(metadata: DataFrame, content_id: str, columns: Sequence[str], match: str):
    """Distinct metadata columns by ``_title_key``, the id as the ``match`` mode compares it."""
    if match not in METADATA_MATCHES:
        raise ValueError(f"metadata match is one of {METADATA_MATCHES}, not {match!r}")
    key = F.lower(content_id) if match == "exact" else normalize_asset_id(content_id)
    keyed = metadata.select(key.alias(TITLE_KEY), *columns)
    return keyed.filter(F.col(TITLE_KEY).isNotNull()).distinct()


def metadata_join(
    df: DataFrame,
    metadata: DataFrame,
    asset_id: str,
    content_id: str,
    columns: Sequence[str],
    match: str = "exact",
    hot: HotKeys | int | None = None,
) -> DataFrame:
    """Attach title metadata to rows with a normalized ``asset_id``.

    ``exact`` only lower-cases the metadata id; ``normalized`` also strips its format
    suffixes, which finds more titles and may find several per asset. Without ``hot``
    adaptive execution splits a hot asset, unless the result is grouped by the asset as it is; ``distinct_rows``
    removes duplicates of it without that.
    """
    titles = title_lookup(metadata, content_id, columns, match)
    return join_on(df, titles, [(asset_id, TITLE_KEY)], hot=find_hot(df, [asset_id], hot))


def _hot_pairs(df: DataFrame, key: str, second: str, hot: HotKeys | int | None) -> HotKeys | None:
    """Hot pairs, counted only if the key alone is hot: pairs are nearly unique, keys are few."""
    if isinstance(hot, int) and find_hot(df, [key], hot) is None:
        return None
    return find_hot(df, [key, second], hot)


def next_position_lookup(
    df: DataFrame,
    key: str,
    position: str,
    value: str,
    out: str,
    lookup_key: Column | None = None,
    hot: HotKeys | int | None = HOT_ROWS,
) -> DataFrame:
    """Attach ``value`` of the row at ``position + 1`` of the same key, NULL if there is none.

    ``lookup_key`` is the key as the looked-up side computes it, where it differs.
    """
    following = df.select(
        (F.col(key) if lookup_key is None else lookup_key).alias("_key"),
        (F.col(position) - 1).alias("_before"),
        F.col(value).alias(out),
    )
    following = following.dropna(subset=["_key", "_before"]).distinct()
    hot = _hot_pairs(df, key, position, hot)
    return join_on(df, following, [(key, "_key"), (position, "_before")], hot=hot)


def terminal_quotients(df: DataFrame, key: str, position: str, length: str, spec: str):
    """Multipliers by (key, position), ready to be looked up by the cue count."""
    return distinct_rows(
        df.select(
            key,
            position,
            spec_multiplier(spec, length).alias("Mutiplier"),
            one_more_multiplier(length).alias("Multiplier_just_one_more"),
        ).dropna(subset=[key, position])
    )


def terminal_position_lookup(
    df: DataFrame,
    key: str,
    position: str,
    length: str,
    spec: str,
    hot: HotKeys | int | None = HOT_ROWS,
) -> DataFrame:
    """Attach the multipliers of the key's terminal row: the one whose position is the cue count.

    The looked-up side is reduced to distinct quotients first, so copies of the terminal
    row do not multiply the result.
    """
    quotients = terminal_quotients(df, key, position, length, spec)
    hot = _hot_pairs(df, key, length, hot)
    return join_on(df, quotients, [(key, key), (length, position)], hot=hot)


def group_max(df: DataFrame, key: str, value: Column | str, out: str) -> DataFrame:
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max(value).alias(out))


def group_max_join_back(
    df: DataFrame, key: str, value: str, out: str, hot: HotKeys | int | None = HOT_ROWS
) -> DataFrame:
    """Attach the key's largest ``value``; NULL for a NULL key.

    One shuffle with a window; with hot keys the maximum is pre-aggregated instead and
    joined back in pieces.
    """
    hot = find_hot(df, [key], hot)
    if hot is not None:
        return join_on(df, group_max(df, key, value, out), [(key, key)], hot=hot)
    largest = F.max(value).over(Window.partitionBy(key))
    return df.withColumn(out, F.when(F.col(key).isNotNull(), largest))


def series_semi_join(
    df: DataFrame,
    members: DataFrame,
    key: str,
    member_key: str,
    hot: HotKeys | int | None = HOT_ROWS,
) -> DataFrame:
    """Rows whose key occurs in ``members``."""
    keys = members.select(member_key).distinct()
    return join_on(df, keys, [(key, member_key)], how="left_semi", hot=find_hot(df, [key], hot))
