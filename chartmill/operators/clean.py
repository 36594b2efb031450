"""Frame-level typing and cleaning.  Every function takes a frame and returns a lazy frame."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from chartmill.functions import columns as C


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def drop_if_present(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.drop(*names)


def trim_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Strip spaces (only spaces) at both ends; belongs before any grouping."""
    return df.withColumns({name: F.trim(name) for name in names})


def unify_key_case(df: DataFrame, key: str = "MRN") -> DataFrame:
    """One spelling of a key column, whatever case the source used."""
    return df.withColumnsRenamed({name: key for name in df.columns if name.lower() == key.lower()})


def null_out_tokens(df: DataFrame, tokens: Iterable[str]) -> DataFrame:
    texts = [name for name, kind in df.dtypes if kind == "string"]
    return df.withColumns({name: C.null_tokens(F.col(name), tokens) for name in texts})


def split_mixed_value(df: DataFrame, name: str) -> DataFrame:
    """Replace a mixed measure by ``<name>_NUM`` and ``<name>_TXT``."""
    number, words = C.split_mixed(F.col(name))
    return df.withColumns({f"{name}_NUM": number, f"{name}_TXT": words}).drop(name)


def coerce_to_schema(df: DataFrame, schema: StructType, formats: Iterable[str] = ()) -> DataFrame:
    """Cast each text column present to its declared type; a bad value becomes null."""
    present = dict(df.dtypes)
    casts = {
        field.name: C.coerce(F.col(field.name), field.dataType, formats)
        for field in schema.fields
        if present.get(field.name) == "string"
    }
    return df.withColumns(casts) if casts else df


def rejected_values(raw: DataFrame, schema: StructType, formats: Iterable[str] = ()) -> DataFrame:
    """Per typed column: texts present, and texts that did not parse (one pass over the raw rows)."""
    present = dict(raw.dtypes)
    names = [f for f in schema.fields if present.get(f.name) == "string" and f.dataType.typeName() != "string"]
    entries = []
    for field in names:
        text = F.col(field.name)
        lost = text.isNotNull() & C.coerce(text, field.dataType, formats).isNull()
        entries.append((field.name, F.count(text), F.count_if(lost)))
    one = raw.agg(*[F.struct(n.alias("n_text"), bad.alias("n_rejected")).alias(name) for name, n, bad in entries])
    rows = F.explode(F.array(*[
        F.struct(F.lit(name).alias("column"), F.col(f"`{name}`.n_text"), F.col(f"`{name}`.n_rejected"))
        for name, _, _ in entries
    ]))
    return one.select(rows.alias("r")).select("r.*")


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """The declared columns in the declared order; absent ones are null, required ones must be set.

    A null in a required column fails the job that reads it.
    """
    present = set(df.columns)
    selected = []
    for field in schema.fields:
        if field.name in present:
            value = F.col(f"`{field.name}`").cast(field.dataType)
        else:
            value = F.lit(None).cast(field.dataType)
        if not field.nullable:
            message = F.lit(f"required column {field.name} is null")
            value = F.coalesce(value, F.raise_error(message).cast(field.dataType))
        selected.append(value.alias(field.name))
    return df.select(*selected)


def stamp(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn(name, F.current_timestamp().cast("timestamp_ntz"))


def stamp_provenance(df: DataFrame, file_name: str | None = None) -> DataFrame:
    """File of origin (unless the reader already set it) and time of loading."""
    if file_name is not None:
        df = df.withColumn("_source_file", F.lit(file_name))
    return stamp(df, "_ingested_at")


def drop_rows(df: DataFrame, keys: Sequence[tuple], columns: Sequence[str]) -> DataFrame:
    """Remove rows named by a compound key; a null in the key matches nothing."""
    if not keys:
        return df
    kinds = dict(df.dtypes)
    ddl = ", ".join(f"`{name}` {kinds[name]}" for name in columns)
    listed = df.sparkSession.createDataFrame(list(keys), ddl)
    return df.join(listed, list(columns), "left_anti")


def constant_columns(df: DataFrame) -> list[str]:
    """Columns holding a single value (nulls counted): one pass, constant state, one row to the driver."""
    row = df.agg(*[C.differs(f"`{name}`").alias(name) for name in df.columns]).first()
    return [name for name in df.columns if not row[name]]


def drop_constant_columns(df: DataFrame) -> DataFrame:
    return df.drop(*constant_columns(df))


def drop_truncated_rows(df: DataFrame, code: str, label: str, dependents: Sequence[str]) -> DataFrame:
    """Remove rows cut off in mid-record.

    Such a row has every dependent column null and a label that is a proper beginning of the label
    its code usually carries.
    """
    empty = F.lit(True)
    for name in dependents:
        empty = empty & F.col(name).isNull()
    suspect = empty & F.col(code).isNotNull() & F.col(label).isNotNull()
    counts = df.groupBy(code, label).agg(F.count(F.lit(1)).alias("_n"))
    usual = counts.where(F.col(label).isNotNull()).groupBy(code).agg(
        F.max(F.struct("_n", F.col(label).alias("_usual"))).alias("_top")
    ).select(code, F.col("_top._usual").alias("_usual"))
    cut = F.col("_usual").startswith(F.col(label)) & (F.length("_usual") > F.length(label))
    checked = df.where(suspect).join(usual, code, "left").where(~F.coalesce(cut, F.lit(False)))
    return df.where(~suspect).unionByName(checked.select(*df.columns))
