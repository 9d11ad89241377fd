"""One pass over texts: a function of a run of rows gives further columns, without a shuffle."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from corpusloom.llm import tables
from corpusloom.llm.bytewords import text_slices


def with_columns(
    docs: DataFrame,
    compute: Callable[[pa.RecordBatch], list],
    outputs: T.StructType,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep: Sequence[str] = (),
) -> DataFrame:
    """The id, the ``keep`` columns (the text may be one) and ``outputs``, which ``compute`` gives for each run of rows.

    ``compute`` sees the columns ``id``, ``text`` and ``carried``. An output replaces a kept column of its name.
    """
    own = {id_column, *outputs.names}
    names = [name for name in keep if name not in own and name != text_column]
    with_text = text_column in keep and text_column not in own
    base = docs.select(
        tables.exactly(docs, id_column).cast("long").alias("id"), tables.exactly(docs, text_column).alias("text"), tables.carried(docs, names)
    )
    fields = [base.schema["id"], base.schema["carried"]] + [base.schema["text"]] * with_text
    renamed = [T.StructField(f"o{i}", field.dataType) for i, field in enumerate(outputs)]
    schema = T.StructType(fields + renamed)
    arrow = to_arrow_schema(schema)
    passed = [field.name for field in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in text_slices(batch, "text"):
                made = [value if isinstance(value, pa.Array) else pa.array(value, field.type) for value, field in zip(compute(rows), list(arrow)[len(passed) :], strict=True)]
                yield pa.RecordBatch.from_arrays([rows.column(name).cast(arrow.field(name).type) for name in passed] + made, schema=arrow)

    mapped = base.mapInArrow(run, schema)
    kept = dict(zip(names, tables.released(names), strict=True)) | ({text_column: F.col("text").alias(text_column)} if with_text else {})
    return mapped.select(
        F.col("id").alias(id_column), *[kept[name] for name in keep if name in kept], *[F.col(f"o{i}").alias(name) for i, name in enumerate(outputs.names)]
    )
