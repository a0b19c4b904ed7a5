"""Schemas of the survey files, stated so that no read has to infer them."""

from __future__ import annotations

from pyspark.sql import types as T

_PERSON_ANSWERS = (
    "P6020", "P6040", "P6050", "P6090", "P6100", "P6210", "P6240", "P6430", "P6585s1", "P6585s2", "P6585s3",
    "P6585s4", "P6590", "P6800", "P6920", "P7150", "P7495", "P7510s3", "Estrato1",
)

PERSONS = T.StructType(
    [T.StructField("id", T.StringType())] + [T.StructField(name, T.IntegerType()) for name in _PERSON_ANSWERS]
)


def _fields(kind: T.DataType, *names: str) -> list[T.StructField]:
    return [T.StructField(name, kind) for name in names]


HOUSEHOLDS_TEST = T.StructType(
    _fields(T.StringType(), "id")
    + _fields(T.IntegerType(), "Clase")
    + _fields(T.StringType(), "Dominio")
    + _fields(T.IntegerType(), "Depto", "P5000", "P5010", "P5090")
    + _fields(T.DoubleType(), "P5100", "P5130", "P5140")
    + _fields(T.IntegerType(), "Nper", "Npersug")
    + _fields(T.DoubleType(), "Li", "Lp", "Fex_c", "Fex_dpto")
)
HOUSEHOLDS_TRAIN = T.StructType(
    HOUSEHOLDS_TEST.fields + _fields(T.IntegerType(), "Pobre", "Npobres", "Indigente", "Nindigentes")
)
PREDICTIONS = T.StructType(_fields(T.StringType(), "id") + _fields(T.IntegerType(), "pobre"))
