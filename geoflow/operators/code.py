"""User code on a layer: SQL over the whole table, Python over the whole table or per feature."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.layer import GEOM

ROW_ID = "__row_id__"


def run_sql(df: DataFrame, code: str, row_id: str, keep_geometry: bool = False, geom: str = GEOM) -> DataFrame:
    """SELECT over the table ``items`` (also called ``gdf``), with ``__row_id__`` as the feature id.

    With ``keep_geometry`` the geometry is joined back to a result that carries ``__row_id__``.
    """
    spark = df.sparkSession
    view = f"items_{uuid.uuid4().hex}"
    df.withColumn(ROW_ID, F.col(row_id)).createTempView(view)
    # both names are bound inside the statement, so views of the session that are called so stay as they are
    named = f"with items as (table {view}), gdf as (table {view})"
    try:
        result = spark.sql(f"{named} select * from (\n{code.strip().rstrip(';')}\n)")
    finally:
        spark.catalog.dropTempView(view)
    if keep_geometry:
        if ROW_ID not in result.columns:
            raise ValueError(f"the query must select {ROW_ID} to keep the geometry")
        shapes = df.select(F.col(row_id).alias("_shape_id"), F.col(geom))
        result = result.join(shapes, F.col(ROW_ID) == F.col("_shape_id"), "left").drop("_shape_id")
    return result


def run_table(df: DataFrame, code: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Run Python once on the whole table, as a DataFrame transformation."""
    return df.transform(code)


def run_item(df: DataFrame, code: Callable[[dict], dict], schema: T.StructType | str) -> DataFrame:
    """Run Python on every feature; ``code`` gets the row as a dict and returns the new fields.

    A feature whose code raises keeps its columns, gets null results and the error in
    ``reject_reason`` (see ``split_rejected``).
    """
    result_schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    names = [f.name for f in result_schema.fields]
    out = T.StructType(
        list(df.schema.fields) + list(result_schema.fields) + [T.StructField("reject_reason", T.StringType())]
    )

    fields = [*to_arrow_schema(result_schema), pa.field("reject_reason", pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made: list[dict] = []
            for item in batch.to_pylist():
                try:
                    got = code(item)
                    row = {n: got.get(n) for n in names} | {"reject_reason": None}
                    # a value that doesn't fit its type rejects the row as well
                    pa.RecordBatch.from_pylist([row], pa.schema(fields))
                    made.append(row)
                except Exception as error:  # noqa: BLE001 - any failure of user code rejects the row
                    made.append(dict.fromkeys(names) | {"reject_reason": f"{type(error).__name__}: {error}"})
            added = pa.RecordBatch.from_pylist(made, pa.schema(fields))
            yield pa.RecordBatch.from_arrays([*batch.columns, *added.columns], [*batch.schema.names, *added.schema.names])

    return df.mapInArrow(run, out)


