"""Publishing snapshots: a new bucketed table per version, behind a view that is switched last."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.evolve import create_database, create_table

VERSION = "snapshot.version"
SOURCE = "snapshot.source"
TABLE = "snapshot.table"
WRITTEN = "snapshot.written"


def buckets_for(scan: DataFrame) -> int:
    """Buckets for a table about the size of ``scan``, a plain file scan: one per split, up to the
    shuffle partitions, so that small tables are not cut into crumbs and large ones meet shuffled
    loads without being shuffled themselves."""
    limit = int(scan.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(limit, scan.rdd.getNumPartitions()))


class ConcurrentPublish(RuntimeError):
    """Another run switched the table while this one was writing its version."""


class Warehouse:
    """Tables of one database.

    ``<name>`` is a view on ``<name>__v<n>_<run>``, a parquet table bucketed by the merge key, so a
    merge shuffles the load but not the target. Readers see the old version until the view is
    switched, in one catalog operation; old versions stay until :meth:`vacuum`, so that a reader may
    outlive a publish. A run that finds the view switched by another one fails and leaves at most a
    version that the next vacuum takes away.
    """

    def __init__(
        self,
        spark: SparkSession,
        database: str,
        location: str | None = None,
        buckets: int | None = None,
    ) -> None:
        self.spark = spark
        self.database = database
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        create_database(spark, database, location)

    def qualified(self, name: str) -> str:
        return f"`{self.database}`.`{name}`"

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(self.qualified(name))

    def _property(self, name: str, key: str) -> str | None:
        if not self.exists(name):
            return None
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.qualified(name)}").collect()
        return {r.key: r.value for r in rows}.get(key)

    def version(self, name: str) -> int:
        return int(self._property(name, VERSION) or 0)

    def source(self, name: str) -> str | None:
        """What the current version was made from, as told to :meth:`publish`."""
        return self._property(name, SOURCE)

    def read(self, name: str) -> DataFrame | None:
        return self.spark.table(self.qualified(name)) if self.exists(name) else None

    def publish(
        self,
        df: DataFrame,
        name: str,
        keys: list[str],
        source: str = "",
        placed: bool = False,
        partition_by: list[str] | None = None,
    ) -> DataFrame:
        """Write the next version, bucketed by ``keys`` and in folders by ``partition_by``, and
        switch the view to it.

        ``placed`` says that ``df`` comes from a merge with the current version and so already
        sits in its buckets; otherwise rows are first brought together by key.
        """
        current = self.version(name)
        table = f"{name}__v{current + 1}_{uuid.uuid4().hex[:12]}"
        rows = df if placed else df.repartition(self.buckets, *keys)
        writer = rows.write.format("parquet").bucketBy(self.buckets, *keys).sortBy(*keys)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.saveAsTable(self.qualified(table))
        self.spark.sql(
            f"ALTER TABLE {self.qualified(table)} SET TBLPROPERTIES ('{WRITTEN}'='{time.time()}')"
        )
        if self.version(name) != current:
            raise ConcurrentPublish(f"{name} is no longer at version {current}")
        told = source.replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self.qualified(name)}"
            f" TBLPROPERTIES ('{VERSION}'='{current + 1}', '{TABLE}'='{table}', '{SOURCE}'='{told}')"
            f" AS SELECT * FROM {self.qualified(table)}"
        )
        return self.read(name)

    def vacuum(self, older_than: float = 7 * 86_400) -> list[str]:
        """Drop versions that no view shows and that were written more than so many seconds ago."""
        names = [r.name for r in self.spark.catalog.listTables(self.database) if not r.isTemporary]
        shown = {self._property(n, TABLE) for n in names if "__v" not in n}
        dropped = []
        for n in names:
            if "__v" not in n or n in shown:
                continue
            written = float(self._property(n, WRITTEN) or 0)
            if time.time() - written >= older_than:
                self.spark.sql(f"DROP TABLE IF EXISTS {self.qualified(n)}")
                dropped.append(n)
        return dropped

    def append(self, df: DataFrame, name: str, columns: str) -> None:
        """Add rows to a plain log table."""
        create_table(self.spark, self.qualified(name), columns)
        df.write.insertInto(self.qualified(name))
        # The rows of a micro-batch belong to a session of their own, whose writes this one does not see.
        self.spark.catalog.refreshTable(self.qualified(name))

    def log(self, name: str, columns: str) -> DataFrame:
        create_table(self.spark, self.qualified(name), columns)
        return self.spark.table(self.qualified(name))
