"""Header contracts, conforming raw rows to a target schema, and type migration."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rawlane.specs import DatasetSpec


def expected_header(dataset: Column, specs: Sequence[DatasetSpec]) -> Column:
    """The header array a dataset's files must carry; NULL where the dataset has no template."""
    expected = F.lit(None).cast("array<string>")
    for spec in specs:
        if spec.header is not None:
            expected = F.when(dataset == spec.name, F.array(*[F.lit(c) for c in spec.header])).otherwise(expected)
    return expected


def header_contract(manifest: DataFrame, specs: Sequence[DatasetSpec]) -> DataFrame:
    """Compare each file's header with its contract: exact names, exact order, no trimming, before any rename.

    One row per file. A pure reorder fails with both ``missing`` and ``extra`` empty.
    """
    expected, found = expected_header(F.col("dataset"), specs), F.col("header")
    # EqualTo on arrays is element by element, so order and case both count.
    checked = manifest.select("*", expected.alias("expected")).withColumns(
        {
            "ok": F.col("expected").isNull() | F.coalesce(F.col("expected") == found, F.lit(False)),
            "missing": F.array_except("expected", found),
            "extra": F.array_except(found, F.col("expected")),
        }
    )
    listed = lambda c: F.concat(F.lit("["), F.array_join(c, ", "), F.lit("]"))
    message = F.concat(
        F.lit("Cabeçalho fora do contrato. Esperado: "),
        listed(F.col("expected")),
        F.lit("; encontrado: "),
        listed(found),
        F.lit("; faltando: "),
        listed(F.col("missing")),
        F.lit("; extras: "),
        listed(F.col("extra")),
    )
    return checked.withColumn("message", F.when(~F.col("ok"), message))


def first_positions(header: Sequence[str], rename: Mapping[str, str]) -> dict[str, int]:
    """0-based position of each column after renaming; the first of several equal names wins."""
    positions: dict[str, int] = {}
    for index, name in enumerate(header):
        positions.setdefault(rename.get(name, name), index)
    return positions


def conform(df: DataFrame, spec: DatasetSpec, keep: Sequence[str] = ()) -> DataFrame:
    """Rename, keep the first of duplicate names, add absent target columns as NULL, drop extras, fix the order.

    All of it is one positional ``select`` over text columns; ``keep`` names technical columns carried along.
    """
    positional = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    at = first_positions(df.columns, spec.rename)
    carried = [positional[f"c{df.columns.index(name)}"].alias(name) for name in keep]
    target = [
        (positional[f"c{at[f.name]}"] if f.name in at else F.lit(None)).cast("string").alias(f.name) for f in spec.target
    ]
    return positional.select(*carried, *target)


def conform_cells(cells: Column, header: Column, spec: DatasetSpec) -> list[Column]:
    """The same for rows whose column order is only known per row: look each target up in the row's header."""
    if spec.rename:
        renames = F.create_map(*[F.lit(x) for pair in spec.rename.items() for x in pair])
        header = F.transform(header, lambda name: F.coalesce(F.try_element_at(renames, name), name))
    columns = []
    for field in spec.target:
        position = F.array_position(header, F.lit(field.name)).cast("int")
        columns.append(F.when(position > 0, F.try_element_at(cells, position)).alias(field.name))
    return columns


def migrate_types(df: DataFrame, types: Mapping[str, T.DataType | str]) -> DataFrame:
    """Change column types in place, keeping values; column order is unchanged."""
    unknown = [name for name in types if name not in df.columns]
    if unknown:
        raise ValueError(f"no such columns: {unknown}")
    return df.withColumns({name: F.col(name).cast(kind) for name, kind in types.items()})
