"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Both take part in the hash, so stored keys depend on them.
NULL_PART = "_dbt_utils_surrogate_key_null_"
SEPARATOR = "-"


def surrogate_key(*parts: str | Column) -> Column:
    """md5 over the parts as text; a NULL part is hashed as a fixed marker."""
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    texts = [F.coalesce(c.cast("string"), F.lit(NULL_PART)) for c in columns]
    return F.md5(F.concat_ws(SEPARATOR, *texts))


# Key -> the columns it is made of, as far as these came clean into staging.
KEY_PARTS = {
    "sk_event_id": ("event_id",),
    "sk_mrr_id": ("subscription_id", "mrr_month"),
    "sk_payment_id": ("payment_id",),
    "sk_plan_id": ("plan_id",),
    "sk_subscription_id": ("subscription_id",),
    "sk_user_id": ("user_id",),
}


# Types whose text is the same in every session.
PLAIN_TYPES = ("string", "int", "bigint")
# The column of a stored file that lists the keys it leaves out; older files have none.
LEFT_OUT = "_keys_left_out"


def _known_keys(rows: DataFrame) -> dict[str, Column]:
    types = dict(rows.dtypes)
    return {
        key: surrogate_key(*parts)
        for key, parts in KEY_PARTS.items()
        if types.get(key) == "string" and all(types.get(part) in PLAIN_TYPES for part in parts)
    }


def without_known_keys(rows: DataFrame) -> DataFrame:
    """The rows for a shuffle: a key that its row's columns give again is NULL, any other goes along marked.

    Hashes do not compress, and would be most of what is shuffled. ``with_known_keys`` undoes it exactly.
    """
    return rows.withColumns({
        key: F.when(~F.col(key).eqNullSafe(known), F.coalesce(F.concat(F.lit("="), F.col(key)), F.lit("")))
        for key, known in _known_keys(rows).items()
    })


def with_known_keys(rows: DataFrame, like: DataFrame) -> DataFrame:
    """The rows as they were before ``without_known_keys``; ``like`` are these, for the columns' comments."""
    restored = {key: _restored(key, known) for key, known in _known_keys(like).items()}
    return rows.select([
        restored[f.name].alias(f.name, metadata=f.metadata) if f.name in restored else F.col(f.name) for f in like.schema.fields
    ])


def _restored(key: str, known: Column) -> Column:
    return F.when(F.col(key).isNull(), known).when(F.col(key) != "", F.expr(f"substring({key}, 2)"))


def as_stored(rows: DataFrame) -> DataFrame:
    """The rows as they lie in files: without known keys, and with the names of these keys."""
    noted = [F.col(f.name).alias(f.name, metadata=f.metadata) for f in rows.schema.fields]
    return without_known_keys(rows).select(*noted, F.lit(",".join(_known_keys(rows))).alias(LEFT_OUT))


def from_stored(stored: DataFrame) -> DataFrame:
    """The rows that ``as_stored`` was given; a file without that column, or without that name in it, holds the key itself."""
    restored = {
        key: F.when(F.find_in_set(F.lit(key), LEFT_OUT) > 0, _restored(key, known)).otherwise(F.col(key))
        for key, known in _known_keys(stored).items()
    }
    return stored.select([
        restored.get(f.name, F.col(f.name)).alias(f.name, metadata=f.metadata) for f in stored.schema.fields if f.name != LEFT_OUT
    ])
