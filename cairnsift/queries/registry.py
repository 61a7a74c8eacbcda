"""The query registry, the table readers and the shared input shapes.

An input shape is SQL text both engines read alike; what differs by dialect comes from
``Dialect``. The operators themselves are DataFrame code; the counterpart SQL is written
independently of them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from cairnsift.session import configure, stored

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")


@dataclass(frozen=True)
class Dialect:
    spark: bool
    root: str = ""

    def table(self, name: str) -> str:
        return f"parquet.`{self.root}/{name}.parquet`" if self.spark else name

    def us(self, ts: str) -> str:
        """Microseconds of a zone-free timestamp since 1970."""
        if self.spark:
            return f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {ts})"
        return f"epoch_us({ts})"

    def div(self, a: str, b: str) -> str:
        return f"(({a}) div ({b}))" if self.spark else f"(({a}) // ({b}))"

    def text(self, value: str) -> str:
        return f"cast({value} as {'string' if self.spark else 'varchar'})"

    def kprop(self) -> str:
        """The integer under ``k`` in an event's JSON properties."""
        if self.spark:
            return "cast(get_json_object(props, '$.k') as bigint)"
        return "cast(props->>'$.k' as bigint)"


SHAPES: dict[str, Callable[[Dialect], str]] = {}
DEPENDS: dict[str, tuple[str, ...]] = {}


def shape(name: str, *needs: str):
    def add(fn):
        SHAPES[name] = fn
        DEPENDS[name] = needs
        return fn
    return add


class Tables:
    """Driver tables and shapes for one query run."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = configure(spark)
        self.root = root.rstrip("/")
        self.dialect = Dialect(True, self.root)
        self._kept: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(f"{self.root}/{name}.parquet")
        return self.spark.sql(with_shapes(self.dialect, (name,), f"SELECT * FROM {name}"))

    def stored(self, name: str) -> DataFrame:
        """A shape written once as the table it stands for, for queries that read it several times or run many
        patterns over its paths."""
        if name not in self._kept:
            self._kept[name] = stored(self[name])
        return self._kept[name]


def _closure(names: tuple[str, ...]) -> list[str]:
    order: list[str] = []

    def visit(n: str) -> None:
        for need in DEPENDS[n]:
            visit(need)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    return order


def with_shapes(dialect: Dialect, names: tuple[str, ...], body: str) -> str:
    parts = [f"{n} AS ({SHAPES[n](dialect)})" for n in _closure(names)]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, *shapes: str, sql: str | None = None, ctes: str = "", recursive: bool = False):
    """Register a query; ``sql`` is the counterpart body over the named shapes."""
    text = None
    if sql is not None:
        duck = Dialect(False)
        parts = [f"{n} AS ({SHAPES[n](duck)})" for n in _closure(shapes)]
        if ctes:
            parts.append(ctes)
        head = ("WITH " + ("RECURSIVE " if recursive else "") + ",\n".join(parts) + "\n") if parts else ""
        text = head + sql

    def add(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(name, fn, text)
        return fn
    return add
