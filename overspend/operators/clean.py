"""Topic record to bronze row to silver row."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from overspend import fixed_values as fv, schemas
from overspend.functions.fields import blank_to_null, parse_date, parse_duration, parse_year, valid_amount, whole_number
from overspend.operators.lookup import join_region


def parse_records(records: DataFrame, schema: T.StructType = schemas.CONTRACT,
                  time_name: str = "kafka_timestamp") -> DataFrame:
    """Unpack JSON messages next to their offset, partition and message time.

    A message that is not JSON gives null fields; a field of the wrong type is null and its siblings stay.
    Fields taken out of a struct column, and filters on them, would each parse the message again; unpacking an
    array that holds the struct parses it once.
    """
    message = F.from_json(F.col("value").cast("string"), schema)
    return records.select(F.inline(F.array(message)), "offset", "partition", F.col("timestamp").alias(time_name))


def is_valid_contract() -> Column:
    """The silver rule: id, text, date present and a value above zero."""
    return (
        F.col("id_contrato").isNotNull() & F.col("objeto_contrato").isNotNull()
        & valid_amount(F.col("valor_contrato")) & F.col("fecha_firma").isNotNull()
    )


def prepare_contracts(bronze: DataFrame, redundant: Sequence[str] = fv.REDUNDANT_COLUMNS,
                      strict: bool = False) -> DataFrame:
    """Drop redundant columns, turn blank text into null and parse the date; keeps every row.

    ``strict`` leaves blank text as it is.
    """
    dated = bronze.drop(*redundant).withColumn("fecha_firma", parse_date(F.col("fecha_firma")))
    if strict:
        return dated
    texts = [f.name for f in dated.schema.fields if isinstance(f.dataType, T.StringType)]
    return dated.withColumns({name: blank_to_null(F.col(name)) for name in texts})


def to_silver(bronze: DataFrame, strict: bool = False) -> DataFrame:
    """Bronze rows to the valid contracts among them."""
    return prepare_contracts(bronze, strict=strict).where(is_valid_contract())


def normalize_source(raw: DataFrame, row_id: str, strict: bool = False) -> DataFrame:
    """Rows of the open-data feed to contract messages of 21 fields, with defaults."""
    def text(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(""))

    def number_or(name: str, parse: Callable[[Column], Column], default: int | None = None) -> Column:
        """Numbers are truncated; only texts go through the text rule."""
        return whole_number(F.col(name), default) if isinstance(raw.schema[name].dataType, T.NumericType) else parse(F.col(name))

    amount = F.col("valor_del_contrato").try_cast("double")
    named = raw.withColumn("departamento", text("departamento"))
    with_region = join_region(named, strict=strict)
    reference = F.col("referencia_del_contrato")
    number = F.col(row_id).cast("string")
    return with_region.select(
        F.coalesce(reference, F.concat(F.lit("CT-"), number)).alias("id_contrato"),
        text("descripcion_del_procedimiento").alias("objeto_contrato"),
        text("nombre_entidad").alias("entidad"),
        "departamento",
        text("municipio").alias("municipio"),
        "region",
        text("codigo_de_categoria_principal").alias("codigo_unspsc"),
        text("descripcion_del_proceso").alias("descripcion_categoria"),
        F.coalesce(F.nanvl(amount, F.lit(0.0)), F.lit(0.0)).alias("valor_contrato"),
        number_or("duraci_n_del_contrato", parse_duration).alias("duracion_dias"),
        text("fecha_de_inicio_del_contrato").alias("fecha_firma"),
        text("tipo_de_contrato").alias("tipo_contrato"),
        text("estado_contrato").alias("estado_contrato"),
        text("modalidad_de_contratacion").alias("modalidad"),
        number_or("anno_bpin", parse_year, fv.DEFAULT_YEAR).alias("anno"),
        F.concat(F.lit("SYS-"), number).alias("id_interno_sistema"),
        F.lit(None).cast("string").alias("campo_vacio"),
        F.lit("VALOR_FIJO").alias("constante_1"),
        F.lit(100).alias("constante_2"),
        F.coalesce(reference, F.lit("")).alias("duplicate_id"),
        F.current_timestamp().cast("string").alias("timestamp_carga"),
    )


def newer_than(df: DataFrame, moment: str, since: Column, inclusive: bool = False,
               folder: tuple[str, Callable[[Column], Column]] | None = None) -> DataFrame:
    """Rows after the last processed time.

    With ``since`` a literal, as ``high_watermark`` gives it, the filter reaches the scan. ``folder`` names a partition column and how
    it follows from the time (it must not fall as time rises); folders before that of ``since`` are then not listed for reading at all.
    """
    newer = df.where(F.col(moment) >= since if inclusive else F.col(moment) > since)
    return newer if folder is None else newer.where(F.col(folder[0]) >= folder[1](since))


def high_watermark(target: DataFrame, moment: str, default: Column) -> Column:
    """Latest time in the target table as a literal of its type, or ``default`` while the table is empty or has no time."""
    latest = target.agg(F.max(moment)).first()[0]
    return default if latest is None else F.lit(latest).cast(target.schema[moment].dataType)


def model_rows(df: DataFrame, features: str, label: str, extra: Sequence[str] = ()) -> DataFrame:
    """Rows fit for training: features and label present, label above zero."""
    return df.select(F.col(features).alias("features"), F.col(label).alias("label"), *extra).where(
        F.col("features").isNotNull() & valid_amount(F.col("label")))
