"""Person and household tables derived from the order tables.

A line item stands for a person, an order for a household. Each column is one
SQL expression that Spark and DuckDB both accept, so the Spark views and the
check queries share a single definition.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ID = "id"
LABEL = "Pobre"
LEAKY = ("Npobres", "Indigente", "Nindigentes")
SPARSE = ("P5100", "P5130", "P5140")

PERSON_COLUMNS = {
    "id": "l_orderkey",
    "P6020": "case when l_linestatus='F' then 2 else 1 end",
    "P6040": "cast(l_quantity*2 as int)-1",
    "P6050": "l_linenumber",
    "P6090": "case l_returnflag when 'R' then 1 when 'N' then 2 end",
    "P6100": "case when l_returnflag='R' then cast(l_suppkey%3+1 as int) end",
    "P6210": "cast(nullif(l_partkey%10,0) as int)",
    "P6240": "cast(nullif(l_suppkey%7,0) as int)",
    "P6430": "case when l_suppkey%7=1 then cast(l_partkey%9+1 as int) end",
    **{
        f"P6585s{j}": f"case when l_suppkey%7=1 then case (l_partkey+{j})%6 when 0 then 1 when 5 then 9 else 2 end end"
        for j in (1, 2, 3, 4)
    },
    "P6590": "case when l_suppkey%7=1 then case l_partkey%8 when 0 then 1 when 7 then 9 else 2 end end",
    "P6800": "case when l_suppkey%7=1 then cast(l_partkey%80+1 as int) end",
    "P6920": "cast(nullif(l_partkey%4,0) as int)",
    "P7150": "case l_partkey%5 when 0 then null when 1 then 1 else 2 end",
    "P7495": "case (l_partkey+l_suppkey)%6 when 0 then null when 1 then 1 else 2 end",
    "P7510s3": "case (l_partkey+l_suppkey)%9 when 0 then null when 1 then 1 else 2 end",
    "Estrato1": "cast(l_suppkey%6+1 as int)",
}

# Full order of the persons of one household. Rows equal in all of these are
# equal in every person column, so the order is total for every purpose.
PERSON_ORDER = (
    "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity",
    "l_shipdate", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
)

_POOR = "(o_totalprice<100000 and o_orderkey%11<>0) or (o_totalprice>=100000 and o_orderkey%29=0)"

HOUSEHOLD_COLUMNS = {
    "id": "o_orderkey",
    "Clase": "n_regionkey%2+1",
    "Dominio": "n_name",
    "Depto": "n_nationkey",
    "P5000": "cast(o_custkey%6 as int)",
    "P5010": "cast(o_orderkey%4+1 as int)",
    "P5090": "cast(substr(o_orderpriority,1,1) as int)",
    "P5100": "case when substr(o_orderpriority,1,1)='2' then o_totalprice end",
    "P5130": "case when substr(o_orderpriority,1,1) in ('1','2') then o_totalprice/2 end",
    "P5140": "case when substr(o_orderpriority,1,1)='3' then o_totalprice/4 end",
    "Nper": "cast(o_custkey%8+1 as int)",
    "Npersug": "cast(o_custkey%8+1 as int)",
    "Li": "100.0e0+n_nationkey",
    "Lp": "200.0e0+2*n_nationkey",
    "Fex_c": "o_totalprice/1000",
    "Fex_dpto": "c_acctbal/100",
    "Pobre": f"case when {_POOR} then 1 else 0 end",
    "Npobres": f"case when {_POOR} then cast(o_custkey%8+1 as int) else 0 end",
    "Indigente": "case when o_totalprice<30000 then 1 else 0 end",
    "Nindigentes": "case when o_totalprice<30000 then cast(o_custkey%8+1 as int) else 0 end",
    "part": "case when o_orderdate>=timestamp '2000-01-01 00:00:00' then 'test' else 'train' end",
}



def _columns(columns: dict[str, str]) -> list[str]:
    return [f"{text} as {name}" for name, text in columns.items()]


def persons_sql(order: bool = False) -> str:
    extra = list(PERSON_ORDER) if order else []
    return "select " + ", ".join(_columns(PERSON_COLUMNS) + extra) + " from lineitem"


def households_sql() -> str:
    return (
        "select " + ", ".join(_columns(HOUSEHOLD_COLUMNS))
        + " from orders join customer on o_custkey=c_custkey join nation on c_nationkey=n_nationkey"
    )


@dataclass(frozen=True)
class Survey:
    """The survey tables found under one data folder."""

    spark: SparkSession
    folder: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def persons(self) -> DataFrame:
        return self.table("lineitem").selectExpr(*_columns(PERSON_COLUMNS))

    @cached_property
    def ordered_persons(self) -> DataFrame:
        """Persons plus the columns of ``PERSON_ORDER``."""
        return self.table("lineitem").selectExpr(*_columns(PERSON_COLUMNS), *PERSON_ORDER)

    @cached_property
    def households(self) -> DataFrame:
        joined = (
            self.table("orders")
            .join(self.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
            .join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        )
        return joined.selectExpr(*_columns(HOUSEHOLD_COLUMNS))

    @property
    def train(self) -> DataFrame:
        return self.households.filter("part = 'train'").drop("part")

    @property
    def test(self) -> DataFrame:
        """Test households as a survey delivers them: no label, no leaky columns."""
        return self.households.filter("part = 'test'").drop("part", LABEL, *LEAKY)

    @property
    def scored(self) -> DataFrame:
        """(id, label, score) for the metric operators."""
        return self.households.selectExpr("id", f"{LABEL} as label", "1 - Fex_c/500 as score")
