"""Named ERP relations as DataFrames, from JDBC or from parquet."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from netdays.session import written

Relations = Callable[[str], DataFrame]


def parquet_relations(spark: SparkSession, directory: str) -> Relations:
    """Relation ``name`` is read from ``directory/name``."""
    return lambda name: spark.read.parquet(f"{directory}/{name}")


def frame_relations(frames: Mapping[str, DataFrame]) -> Relations:
    """Relations that are DataFrames already."""
    return lambda name: frames[name]


@dataclass(frozen=True)
class JdbcSplit:
    """How one relation is read in parallel: ranges of a date or number column."""

    column: str
    lower: dt.date | int
    upper: dt.date | int
    partitions: int


@dataclass(frozen=True)
class JdbcConnection:
    url: str
    driver: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    fetch_size: int = 10_000
    tables: Mapping[str, str] = field(default_factory=dict)
    splits: Mapping[str, JdbcSplit] = field(default_factory=dict)

    def options(self, name: str) -> dict[str, str]:
        """Reader options of a relation; ``tables`` maps it to its remote name."""
        out = {
            "url": self.url,
            "driver": self.driver,
            "dbtable": self.tables.get(name, name),
            "fetchsize": str(self.fetch_size),
            "pushDownPredicate": "true",
        }
        if self.user is not None:
            out["user"] = self.user
        if self.password is not None:
            out["password"] = self.password
        split = self.splits.get(name)
        if split is not None:
            out |= {
                "partitionColumn": split.column,
                "lowerBound": str(split.lower),
                "upperBound": str(split.upper),
                "numPartitions": str(split.partitions),
            }
        return out


def jdbc_relations(spark: SparkSession, connection: JdbcConnection) -> Relations:
    """Relations read over JDBC. Column pruning and plain filters reach the database."""
    return lambda name: spark.read.format("jdbc").options(**connection.options(name)).load()


def staged_relations(relations: Relations, names: Sequence[str]) -> Relations:
    """Relations of which the named ones are copied to the scratch folder on first use.

    For a database: a relation that several look-ups need is then fetched once,
    and the optimizer learns the size of small ones and broadcasts those.
    """
    copies: dict[str, DataFrame] = {}

    def read(name: str) -> DataFrame:
        if name not in names:
            return relations(name)
        if name not in copies:
            copies[name] = written(relations(name), name)
        return copies[name]

    return read


def prefixed(relation: DataFrame, alias: str, columns: Sequence[str]) -> DataFrame:
    """Only these columns, as ``alias_column``, so that joined names stay apart."""
    return relation.select(*[relation[c].alias(f"{alias}_{c}") for c in columns])
