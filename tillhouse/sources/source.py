"""The till database as a source: JDBC in production, Parquet or given frames elsewhere."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.functions.dates import within
from tillhouse.schemas import TABLES
from tillhouse.session import stored_bytes


class FrameSource:
    """Source tables that are already DataFrames."""

    def __init__(self, frames: dict[str, DataFrame]):
        self.frames = frames

    def size_bytes(self) -> int:
        """Bytes to size shuffles after; 0 where they are not known."""
        return 0

    def table(self, name: str) -> DataFrame:
        return self.frames[name].select(*TABLES[name].fieldNames())

    def orders(self, start: date, end: date) -> DataFrame:
        return orders_between(self.table("orders"), start, end)

    def items(self, start: date, end: date) -> DataFrame:
        return items_between(self.table("order_items"), self.table("orders"), start, end)


class ParquetSource(FrameSource):
    """One Parquet folder per source table."""

    def __init__(self, spark: SparkSession, root: str):
        super().__init__({name: spark.read.parquet(f"{root}/{name}") for name in TABLES})
        self.spark, self.root = spark, root

    def size_bytes(self) -> int:
        return stored_bytes(self.spark, self.root)


def jdbc_options(
    url: str, query: str, column: str | None = None, start: str = "", end: str = "", readers: int = 1
) -> dict[str, str]:
    """Reader options; with a column the scan is split into that many ranges of it."""
    # times stay as the database shows them, whatever zone the JVM is in
    options = {"url": url, "dbtable": f"({query}) AS scan", "fetchsize": "10000", "preferTimestampNTZ": "true"}
    if column and readers > 1:
        options.update(
            partitionColumn=column, lowerBound=start, upperBound=end, numPartitions=str(readers)
        )
    return options


def orders_query(start: date, end: date) -> str:
    columns = ", ".join(TABLES["orders"].fieldNames())
    return (
        f"SELECT {columns} FROM orders WHERE created_at >= '{start.isoformat()}' "
        f"AND created_at < '{(end + timedelta(days=1)).isoformat()}'"
    )


def counts_query(start: date, end: date, unit: str = "minute") -> str:
    """Orders per unit of time: a few hundred rows a day, counted in the database."""
    return (
        f"SELECT date_trunc('{unit}', created_at) AS at, COUNT(*) AS n FROM orders "
        f"WHERE created_at >= '{start.isoformat()}' AND created_at < '{(end + timedelta(days=1)).isoformat()}' GROUP BY 1"
    )


def slice_bounds(counts: list[tuple[datetime, int]], slices: int) -> list[datetime]:
    """Times at which slices begin that hold about the same number of rows, the first one left out.

    Rows of one unit of time stay together, so a slice is larger than its share by less than the fullest unit.
    """
    total = sum(n for _, n in counts)
    bounds: list[datetime] = []
    before = 0
    for at, n in sorted(counts):
        # a slice begins here if all that came before fills the slices so far
        if before and before * slices >= total * (len(bounds) + 1) and len(bounds) < slices - 1:
            bounds.append(at)
        before += n
    return bounds


def slice_predicates(column: str, start: date, end: date, bounds: list[datetime]) -> list[str]:
    """Half-open ranges of the column, together all of the days."""
    edges = [f"{start} 00:00:00", *(f"{at:%Y-%m-%d %H:%M:%S}" for at in bounds), f"{end + timedelta(days=1)} 00:00:00"]
    return [f"{column} >= '{low}' AND {column} < '{high}'" for low, high in zip(edges, edges[1:], strict=False)]


def items_query(start: date, end: date) -> str:
    columns = ", ".join(f"i.{name}" for name in TABLES["order_items"].fieldNames())
    return (
        f"SELECT {columns}, o.created_at FROM order_items i JOIN orders o ON o.order_id = i.order_id "
        f"WHERE o.created_at >= '{start.isoformat()}' "
        f"AND o.created_at < '{(end + timedelta(days=1)).isoformat()}'"
    )


class JdbcSource:
    """Day scans run as one query in the database, read in parallel slices of created_at.

    Most orders fall into a few hours, so slices are cut where the counted orders are, not at equal times.
    """

    def __init__(self, spark: SparkSession, url: str, properties: dict[str, str] | None = None, readers: int = 8):
        self.spark = spark
        self.url = url
        self.properties = properties or {}
        self.readers = readers

    def size_bytes(self) -> int:
        return 0

    def _read(self, options: dict[str, str]) -> DataFrame:
        return self.spark.read.format("jdbc").options(**{**options, **self.properties}).load()

    def table(self, name: str) -> DataFrame:
        columns = ", ".join(TABLES[name].fieldNames())
        return self._read(jdbc_options(self.url, f"SELECT {columns} FROM {name}"))

    @cache
    def _bounds(self, start: date, end: date) -> list[datetime]:
        """One look at the orders of the days serves the scans of orders and of items."""
        counts = self._read(jdbc_options(self.url, counts_query(start, end))).collect()
        return slice_bounds([(row["at"], row["n"]) for row in counts], self.readers)

    def _days(self, query: str, start: date, end: date) -> DataFrame:
        predicates = slice_predicates("created_at", start, end, self._bounds(start, end))
        options = jdbc_options(self.url, query)
        properties = {k: v for k, v in {**options, **self.properties}.items() if k not in ("url", "dbtable")}
        return self.spark.read.jdbc(self.url, options["dbtable"], predicates=predicates, properties=properties)

    def orders(self, start: date, end: date) -> DataFrame:
        return self._days(orders_query(start, end), start, end)

    def items(self, start: date, end: date) -> DataFrame:
        return self._days(items_query(start, end), start, end)


def orders_between(orders: DataFrame, start: date, end: date) -> DataFrame:
    return orders.filter(within(F.col("created_at"), start, end))


def items_between(items: DataFrame, orders: DataFrame, start: date, end: date) -> DataFrame:
    """Items of the orders created in the range, with the order's creation time."""
    parents = orders_between(orders, start, end).select("order_id", "created_at")
    return items.join(parents, "order_id").select(*items.columns, "created_at")


def as_text(df: DataFrame) -> DataFrame:
    """Money, flags and times as text; whole numbers and text stay as they are."""
    keep = {"integer", "long", "string"}
    return df.select(
        *[
            F.col(field.name) if field.dataType.typeName() in keep else F.col(field.name).cast("string").alias(field.name)
            for field in df.schema
        ]
    )
