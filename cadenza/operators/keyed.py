"""Keyed loads: what a batch does to a table, and a Parquet table that takes batches.

The first half are DataFrame functions. :class:`MonthTable` applies them to Parquet
in folders by month and bucket of the key, as loads that are seen whole or not at all.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.constants import WEATHER_FIELDS
from cadenza.operators.shaping import conform
from cadenza.operators.versions import Version, VersionedTable
from cadenza.session import new_path

c = F.col


class DuplicateKeys(ValueError):
    """A load would store the same key twice."""


def require_unique(df: DataFrame, keys: list[str]) -> None:
    """Raise on a repeated key or a null in one, like a primary key does."""
    unknown = reduce(Column.__or__, [c(k).isNull() for k in keys])
    wrong = df.groupBy(*keys).count().filter((c("count") > 1) | unknown)
    if sample := wrong.limit(1).collect():
        raise DuplicateKeys(f"repeated or null key {sample[0].asDict()} on {keys}")


def _ts(loaded_at: dt.datetime) -> Column:
    return F.lit(loaded_at.isoformat(sep=" ")).cast("timestamp_ntz")


def stamp(batch: DataFrame, loaded_at: dt.datetime) -> DataFrame:
    """Set both audit timestamps."""
    return batch.withColumns({"inserted_at": _ts(loaded_at), "updated_at": _ts(loaded_at)})


def new_rows(existing: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Batch rows whose key the table does not have."""
    return batch.join(existing.select(*keys), keys, "left_anti")


def insert_new(
    existing: DataFrame, batch: DataFrame, keys: list[str], loaded_at: dt.datetime
) -> DataFrame:
    """The table with unseen keys added; stored rows stay as they are."""
    added = stamp(new_rows(existing, batch, keys), loaded_at)
    return existing.unionByName(conform(added, existing.schema))


def any_weather() -> Column:
    return F.coalesce(*[c(f).cast("string") for f in WEATHER_FIELDS]).isNotNull()


def weather_for_missing(existing: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Batch rows with any weather whose stored row has no temperature."""
    missing = existing.filter(c("weather_temp_c").isNull()).select(*keys)
    return batch.filter(any_weather()).join(missing, keys, "left_semi")


def backfill_weather(
    existing: DataFrame, batch: DataFrame, keys: list[str], loaded_at: dt.datetime
) -> DataFrame:
    """The table where rows without temperature take each known weather field.

    A batch with a repeated key is refused: each of its rows would make one of the stored row.
    """
    require_unique(batch, keys)
    return _filled(existing, batch, keys, loaded_at)


def _filled(existing: DataFrame, batch: DataFrame, keys: list[str], loaded_at: dt.datetime) -> DataFrame:
    incoming = batch.filter(any_weather()).select(
        *keys,
        *[c(f).alias(f"_new_{f}") for f in WEATHER_FIELDS],
        F.lit(True).alias("_filled"),
    )
    joined = existing.join(incoming, keys, "left")
    fill = c("weather_temp_c").isNull() & c("_filled")
    changed = {
        f: F.when(fill, F.coalesce(f"_new_{f}", f)).otherwise(c(f)) for f in WEATHER_FIELDS
    }
    changed["updated_at"] = F.when(fill, _ts(loaded_at)).otherwise(c("updated_at"))
    return joined.select(
        *[changed[n].alias(n) if n in changed else c(n) for n in existing.columns]
    )


def replace_by_key(
    existing: DataFrame, batch: DataFrame, keys: list[str], loaded_at: dt.datetime
) -> DataFrame:
    """The table where batch rows replace stored rows of the same key."""
    kept = existing.join(batch.select(*keys), keys, "left_anti")
    return kept.unionByName(conform(stamp(batch, loaded_at), existing.schema))


def delete_by_key(existing: DataFrame, ids: DataFrame, keys: list[str]) -> DataFrame:
    return existing.join(ids.select(*keys), keys, "left_anti")


class MonthTable(VersionedTable):
    """A Parquet table under ``path``, in folders by load, month of a date column and bucket of the key.

    A load writes a folder of its own and then makes a version that names it (``operators.versions``); nothing
    stored is changed, so a load that is cut short leaves the table as it was and can be run again. Inserts add a
    folder to the months of the batch; changes store the months they touch anew.

    ``stays`` says that a key keeps its date, because the date is part of the key or never changes at the source.
    Then a batch is held against the months it has rows in; else against all months. In either case only against the
    buckets of its keys and their key columns, and row groups whose Bloom filter (on the last key, if a text) lacks
    the keys of a small batch are skipped. The batch's keys are made distinct and joined to the table, so that Spark may broadcast
    them if they are small; the table's rows are not sorted or grouped for a load.
    """

    PARTITION, BUCKET = "part_month", "part_bucket"
    #: Keys of a batch up to which their values are looked for in the files' Bloom filters.
    FEW_KEYS = 200

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        keys: list[str],
        date: str,
        buckets: int = 2,
        stays: bool = False,
        keep: int = 10,
    ):
        super().__init__(spark, path, {self.PARTITION: T.StringType(), self.BUCKET: T.IntegerType()}, keep)
        self.schema, self.keys, self.date, self.buckets, self.stays = schema, keys, date, buckets, stays

    # -- reading --------------------------------------------------------------------

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of the newest version, or of an older one that is still kept."""
        return self._read(at=None if version is None else self.log.at(version)).select(*self.schema.names)

    def _read(self, months: list[str] | None = None, at: Version | None = None) -> DataFrame:
        """Stored rows of the months, all if not given, with the columns of their folders."""
        held = (at or self.version()).parts
        chosen = held if months is None else {m: held[m] for m in months if m in held}
        return self._rows(self.schema, chosen)

    def _placed(self, df: DataFrame) -> DataFrame:
        """The rows in the table's columns, with month and bucket."""
        month = F.coalesce(F.date_format(self.date, "yyyy-MM"), F.lit("none"))
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        return conform(df, self.schema).withColumns({self.PARTITION: month, self.BUCKET: bucket})

    def beside(self, batch: DataFrame) -> DataFrame:
        """Stored rows that may have a key of the batch."""
        placed = self._placed(batch)
        # at most one row per calendar month and bucket, so safe to collect
        cells = placed.select(self.PARTITION, self.BUCKET).distinct().collect()
        months = sorted({r[0] for r in cells}) if self.stays else None
        stored = self._read(months).filter(c(self.BUCKET).isin({r[1] for r in cells}))
        last = self.keys[-1]
        few = placed.select(last).distinct().limit(self.FEW_KEYS + 1).collect()
        if len(few) <= self.FEW_KEYS and all(r[0] is not None for r in few):
            stored = stored.filter(reduce(Column.__or__, [c(last) == r[0] for r in few], F.lit(False)))
        return stored

    def known_keys(self, batch: DataFrame, where: Column | None = None) -> DataFrame:
        """Keys of the batch that the table has, with their months; of rows for which ``where`` holds."""
        stored = self.beside(batch)
        stored = stored if where is None else stored.filter(where)
        return stored.select(*self.keys, self.PARTITION).join(batch.select(*self.keys).distinct(), self.keys, "left_semi")

    # -- loads ----------------------------------------------------------------------

    def last_batch(self, stream: str) -> tuple[int, int]:
        """Number of the last batch of a stream that is in, -1 if none is, and its records put aside."""
        batch, aside = self.version().batches.get(stream, (-1, 0))
        return batch, aside

    def note_batch(self, stream: str, batch: int, aside: int) -> None:
        """Remember, in the version that the current load makes, that a batch is in."""
        with self.load():
            self._open = replace(self._open, batches=self._open.batches | {stream: [batch, aside]})

    def store(self, rows: DataFrame) -> None:
        """Store complete rows, audit columns included, in a new table."""
        with self.load():
            if self._open.number:
                raise ValueError(f"{self.path} is already a table")
            self._store(rows)

    def replace(self, batch: DataFrame, loaded_at: dt.datetime) -> None:
        """Drop what is stored and store the batch."""
        require_unique(batch, self.keys)
        with self.load():
            self._drop(list(self._open.parts))
            self._store(stamp(batch, loaded_at))

    def append(self, batch: DataFrame, loaded_at: dt.datetime) -> None:
        """Store the batch besides what is there; a repeated key is an error."""
        with self.load():
            known = self.known_keys(batch).select(*self.keys)
            require_unique(batch.select(*self.keys).unionByName(known), self.keys)
            self._store(stamp(batch, loaded_at))

    def insert_new(self, batch: DataFrame, loaded_at: dt.datetime) -> None:
        """Store rows of unseen keys. Nothing stored is rewritten."""
        require_unique(batch, self.keys)
        with self.load():
            if self._open.parts:  # else there is no key to hold the batch against
                batch = new_rows(self.known_keys(batch), batch, self.keys)
            self._store(stamp(batch, loaded_at))

    def backfill_weather(self, batch: DataFrame, loaded_at: dt.datetime) -> None:
        """Fill weather where it is missing, in the months that have such rows."""
        require_unique(batch, self.keys)
        with self.load():
            months = self._months(self.known_keys(batch.filter(any_weather()), c("weather_temp_c").isNull()))
            self._rewrite(months, lambda rows: _filled(rows, batch, self.keys, loaded_at))

    def replace_by_key(self, batch: DataFrame, loaded_at: dt.datetime) -> None:
        """Store the batch, over rows of the same key. A row may change its month."""
        require_unique(batch, self.keys)
        with self.load():
            incoming = conform(stamp(batch, loaded_at), self.schema)
            months = self._months(self.known_keys(batch))
            if not months:
                return self._store(incoming)
            self._rewrite(months, lambda rows: delete_by_key(rows, batch, self.keys).unionByName(incoming))

    def delete(self, ids: DataFrame) -> None:
        with self.load():
            known = self.known_keys(ids)
            self._rewrite(self._months(known), lambda rows: delete_by_key(rows, ids, self.keys))

    def compact(self, loads: int = 8) -> None:
        """Store months that more than so many loads hold in one folder each."""
        with self.load():
            many = [m for m, held in self._open.parts.items() if len(held) > loads]
            self._rewrite(many, lambda rows: rows)

    def changed(self, since: int, keys: list[str]) -> DataFrame:
        """Distinct ``keys`` of which a row was added, removed or changed after version ``since``, which must be kept.

        Only folders that one of the two versions has are read. Rows that were merely stored anew cancel out: per key their
        hashes are summed, those that went as negative, so what is shuffled is one row a key and task.
        """
        old, new = self.log.at(since).parts if since else {}, self.version().parts

        def only(a: dict[str, list[str]], b: dict[str, list[str]], sign: int) -> DataFrame:
            rows = self._rows(self.schema, {p: [x for x in held if x not in b.get(p, [])] for p, held in a.items()})
            columns = [x for x in self.schema.names if x not in ("inserted_at", "updated_at")]
            hashed = F.xxhash64(*columns).cast("decimal(38, 0)")
            return rows.select(*keys, F.lit(sign).alias("_n"), (hashed * sign).alias("_hash"))

        moved = only(new, old, 1).unionByName(only(old, new, -1)).groupBy(*keys)
        sums = moved.agg(F.sum("_n").alias("_n"), F.sum("_hash").alias("_hash"))
        return sums.filter((c("_n") != 0) | (c("_hash") != 0)).select(*keys)

    # -- helpers --------------------------------------------------------------------

    def stage(self, batch: DataFrame) -> DataFrame:
        """Write a batch that several loads use, so that it is computed once."""
        path = new_path(self.spark, "batch")
        batch.write.parquet(path)
        return self.spark.read.schema(batch.schema).parquet(path)

    def _months(self, rows: DataFrame) -> list[str]:
        """Months of rows: at most one value per calendar month, so safe to collect."""
        return sorted(r[0] for r in rows.select(self.PARTITION).distinct().collect())

    def _store(self, rows: DataFrame) -> None:
        last, options = self.keys[-1], {"parquet.bloom.filter.adaptive.enabled": "true"}
        if isinstance(self.schema[last].dataType, T.StringType):  # almost all values differ: no dictionary
            options |= {f"parquet.enable.dictionary#{last}": "false", f"parquet.bloom.filter.enabled#{last}": "true"}
        self._add(self._placed(rows), self.keys, options)

    def _rewrite(self, months: list[str], changed: Callable[[DataFrame], DataFrame]) -> None:
        """Store what ``changed`` makes of the rows of the months in their place."""
        if not months:
            return
        rows = changed(self._read(months).select(*self.schema.names))
        self._drop(months)
        self._store(rows)
