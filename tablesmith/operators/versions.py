"""Latest version per key over append-only raw tables.

A raw table holds every ingested *version* of a record, with three control
columns: ``ingestion_timestamp``, ``bronze_row_id`` and ``ingestion_status``.
The current state of a record is its newest successfully loaded version:

1. keep only rows whose status is ``LOADED`` — *before* ranking, so a newer
   failed version never hides an older good one (rows with NULL status are
   dropped as well);
2. rank the versions of each key by ``ingestion_timestamp`` descending,
   then ``bronze_row_id`` descending, NULLs first (a version with an
   unknown timestamp wins, as in a descending sort that puts NULLs first);
3. keep rank 1; versions that tie on both are ordered by a hash of the row,
   so the choice does not depend on how the rows were partitioned.

Plan shape: ``row_number() ... = 1`` lets Catalyst insert a partial
``WindowGroupLimit`` *before* the shuffle, so each map task forwards at
most one row per key. A key holding a third of all versions therefore
shuffles one row per map task, not a third of the table. That limit sorts
its input in every map task, which spills when the rows are wide; so wide
tables are ranked by keys, order and row hash alone, and the rows then meet the
identities of the winners (``narrow_first``, :func:`superseded_versions`): they
are shuffled once and not sorted before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Control column names and the status of a good version.
TS_COL = "ingestion_timestamp"
ROW_ID_COL = "bronze_row_id"
STATUS_COL = "ingestion_status"
LOADED = "LOADED"

_RANK = "__version_rank"
_HASH, _TIE, _VERSION, _LATEST = "__row_hash", "__tie_hash", "__version", "__latest"


def version_order(ts_col: str = TS_COL, row_id_col: str = ROW_ID_COL) -> list[Column]:
    """Newest first; NULL timestamps/ids rank as newest."""
    return [F.col(ts_col).desc_nulls_first(), F.col(row_id_col).desc_nulls_first()]


def loaded_versions(df: DataFrame, status_col: str = STATUS_COL, status: str = LOADED) -> DataFrame:
    """Only successfully loaded versions (pushed to the Parquet scan)."""
    return df.filter(F.col(status_col) == F.lit(status))


def _row_hash(df: DataFrame) -> Column:
    """Of all columns but maps, which have no hash."""
    return F.xxhash64(*[F.col(c) for c, kind in df.dtypes if "map<" not in kind])


def _ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column], tie_columns: Sequence[str] = ()) -> DataFrame:
    first = [F.xxhash64(*tie_columns)] if tie_columns else []
    w = Window.partitionBy(*[F.col(k) for k in keys]).orderBy(*order, *first, _row_hash(df))
    return df.withColumn(_RANK, F.row_number().over(w))


def _with_identity(df: DataFrame, keys: Sequence[str], ts_col: str, row_id_col: str, tie_columns: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """``df`` with its key, version and hash in one struct (NULLs in a struct
    are equal), and the identities of the newest versions, found without the
    other columns."""
    ident = list(dict.fromkeys([*keys, ts_col, row_id_col]))
    hashed = df.withColumn(_HASH, _row_hash(df))
    version = F.struct(*ident, _HASH)
    first = [F.xxhash64(*tie_columns).alias(_TIE)] if tie_columns else []
    narrow = hashed.select(*ident, _HASH, *first)
    w = Window.partitionBy(*[F.col(k) for k in keys]).orderBy(*version_order(ts_col, row_id_col), *([F.col(_TIE)] if first else []), F.col(_HASH))
    latest = narrow.withColumn(_RANK, F.row_number().over(w)).filter(F.col(_RANK) == 1).select(version.alias(_LATEST))
    return hashed.select(version.alias(_VERSION), *[F.col(c) for c in df.columns if c not in ident]), latest


def _number_copies(df: DataFrame) -> DataFrame:
    """Numbers the rows of the same version: copies of each other."""
    return df.withColumn(_RANK, F.row_number().over(Window.partitionBy(_VERSION).orderBy(_VERSION)))


def _plain(df: DataFrame, columns: Sequence[str], ident: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(_VERSION).getField(c).alias(c) if c in ident else F.col(c) for c in columns])


def latest_by_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column] | None = None,
    status_col: str | None = STATUS_COL,
    status: str = LOADED,
    tie_columns: Sequence[str] = (),
    narrow_first: bool = False,
) -> DataFrame:
    """One row per key: its newest loaded version, all input columns kept.

    ``status_col=None`` skips the status filter (input already filtered).
    NULL keys form one group, like any other key value.

    Ties are decided by a hash of ``tie_columns`` first. A read of only the key,
    the order and these columns then finds the same values of them as a read of
    the whole rows, so both can be used side by side.

    ``narrow_first`` (in the default order) is for wide rows of many keys: the
    same rows, found by a narrow scan and one join on the versions' identity.
    """
    if status_col is not None:
        df = loaded_versions(df, status_col, status)
    if narrow_first:
        if order is not None:
            raise ValueError("narrow_first ranks in the default order")
        rows, latest = _with_identity(df, keys, TS_COL, ROW_ID_COL, tie_columns)
        found = _number_copies(rows.join(latest, F.col(_VERSION) == F.col(_LATEST)))
        return _plain(found.where(F.col(_RANK) == 1), df.columns, [*keys, TS_COL, ROW_ID_COL])
    order = list(order) if order is not None else version_order()
    return _ranked(df, keys, order, tie_columns).filter(F.col(_RANK) == 1).drop(_RANK)


def superseded_versions(
    df: DataFrame,
    keys: Sequence[str],
    status_col: str | None = STATUS_COL,
    status: str = LOADED,
    ts_col: str = TS_COL,
    row_id_col: str = ROW_ID_COL,
) -> DataFrame:
    """Loaded versions the dedup discards: the complement of
    :func:`latest_by_key` within the loaded versions.

    Written as a join on the identity of a version (key, timestamp, row id and
    row hash; NULL-safe), not as a rank over each key's versions: a key holding a
    third of all versions is then spread over many tasks by the join's hash
    partitioning instead of being sorted in one window task. Copies of a
    winner are numbered among themselves, where the join has brought them; all
    but one stay.
    """
    if status_col is not None:
        df = loaded_versions(df, status_col, status)
    rows, latest = _with_identity(df, keys, ts_col, row_id_col)
    joined = _number_copies(rows.join(latest, F.col(_VERSION) == F.col(_LATEST), "left"))
    return _plain(joined.where(F.col(_LATEST).isNull() | (F.col(_RANK) > 1)), df.columns, [*keys, ts_col, row_id_col])
