"""Registry of the checked queries: a DataFrame builder and, where SQL can say it, its SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from hearthspark.session import tune
from hearthspark.sources.survey import Survey, households_sql, persons_sql


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Survey], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.build(Survey(tune(spark), str(sf_dir)))


QUERIES: dict[str, Query] = {}


def query(sql: str | None = None) -> Callable[[Callable[[Survey], DataFrame]], Callable[[Survey], DataFrame]]:
    """Register the decorated builder under its own name."""

    def register(build: Callable[[Survey], DataFrame]) -> Callable[[Survey], DataFrame]:
        if build.__name__ in QUERIES:
            raise ValueError(f"query {build.__name__} is registered twice")
        QUERIES[build.__name__] = Query(build.__name__, build, sql)
        return build

    return register


def with_tables(body: str, **extra: str) -> str:
    """``body`` over the survey tables: personas, hogares, train, test, scored, and extra ones."""
    tables = {
        "personas": persons_sql(order=True),
        "hogares": households_sql(),
        "train": "select * from hogares where part = 'train'",
        "test": "select * from hogares where part = 'test'",
        "scored": "select id, Pobre as label, 1 - Fex_c/500 as score from hogares",
        **extra,
    }
    return "with " + ",\n".join(f"{name} as ({text})" for name, text in tables.items()) + "\n" + body
