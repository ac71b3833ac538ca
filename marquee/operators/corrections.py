"""Manual corrections overlay: (signature, field, true_value, seq) rows set
fields of the events they name; the highest ``seq`` per (signature, field)
wins and the value is cast to the field's type."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def apply_corrections(events: DataFrame, corrections: DataFrame, key: str = "signature",
                      fields: dict[str, str] | None = None) -> DataFrame:
    """``fields`` maps field name -> Spark type of the target column.

    One aggregation of the (small) corrections table, pivoted on the listed
    field names (explicit values: no extra job to discover them), then one
    left join to the events.  A correction that does not parse as the
    field's type is ignored (``try_cast``), like a failed assignment.  Lists
    are written as Python or JSON literals (``['A', 'B']``).
    """
    from marquee.functions.text import py_list_text_to_array

    def typed(value, kind):
        return py_list_text_to_array(value, kind[6:-1]) if kind.startswith("array<") else value.try_cast(kind)

    fields = fields or {}
    last = (corrections.filter(F.col("field").isin(list(fields)))
            .groupBy("event_signature", "field")
            .agg(F.max_by("true_value", F.struct("seq", "true_value")).alias("v")))
    wide = last.groupBy("event_signature").pivot("field", list(fields)).agg(F.first("v"))
    for f in fields:
        wide = wide.withColumnRenamed(f, f"_fix_{f}")
    out = events.join(wide, events[key] == wide["event_signature"], "left").drop("event_signature")
    for f, typ in fields.items():
        out = out.withColumn(f, F.coalesce(typed(F.col(f"_fix_{f}"), typ), F.col(f))).drop(f"_fix_{f}")
    return out
