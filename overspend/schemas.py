"""Row types of messages, contracts, trips and small dictionaries."""

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_S, _I, _D = T.StringType(), T.IntegerType(), T.DoubleType()

# The contract message and its field types.
CONTRACT = _struct(
    id_contrato=_S, objeto_contrato=_S, entidad=_S, departamento=_S, municipio=_S, region=_S,
    codigo_unspsc=_S, descripcion_categoria=_S, valor_contrato=_D, duracion_dias=_I, fecha_firma=_S,
    tipo_contrato=_S, estado_contrato=_S, modalidad=_S, anno=_I, id_interno_sistema=_S,
    campo_vacio=_S, constante_1=_S, constante_2=_I, duplicate_id=_S, timestamp_carga=_S,
)

# The topic record around a message.
TOPIC_RECORD = _struct(
    value=T.BinaryType(), partition=_I, offset=T.LongType(), timestamp=T.TimestampType(),
)

# The trip message and its field types.
TRIP_MESSAGE = _struct(
    vendor_id=_I, pickup_datetime=_S, passenger_count=_I, trip_distance=_D, pickup_longitude=_D,
    pickup_latitude=_D, dropoff_longitude=_D, dropoff_latitude=_D, payment_type=_I,
    fare_amount=_D, tip_amount=_D,
)

EVENT = _struct(
    event_id=T.LongType(), ts=T.TimestampNTZType(), user_id=T.LongType(),
    event_type=_S, value=_D, props=_S,
)

REGION = _struct(departamento=_S, region=_S)
PAYMENT = _struct(payment_id=T.LongType(), nombre_pago=_S)
