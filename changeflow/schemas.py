"""Fixed, explicit schemas of the envelope, the event and the layer tables.

Schemas are never inferred: the raw payload is kept as text and parsed
with the explicit event schema below; the mixed struct/array field
``log_params`` is left out on purpose.
"""

from pyspark.sql import types as T

# Common queue envelope, whatever queue is behind it. The offset is text:
# a Kinesis sequence number has 56 digits and does not fit a BIGINT.
ENVELOPE_COLUMNS = ("clave", "valor", "origen", "particion", "desplazamiento", "ts_cola")

BRONZE = T.StructType([
    T.StructField("clave", T.StringType()),
    T.StructField("valor", T.StringType()),
    T.StructField("origen", T.StringType()),
    T.StructField("particion", T.StringType()),
    T.StructField("desplazamiento", T.StringType()),
    T.StructField("ts_cola", T.TimestampType()),
    T.StructField("ingerido_en", T.TimestampType()),
])

# The envelope as a queue delivers it (bronze without the ingest stamp).
ENVELOPE = T.StructType([f for f in BRONZE.fields if f.name != "ingerido_en"])

# Fields the late-data analysis reads from the raw payload.
TAGGED_EVENT = T.StructType([
    T.StructField("meta", T.StructType([
        T.StructField("id", T.StringType()),
        T.StructField("dt", T.StringType()),
    ])),
    T.StructField("comment", T.StringType()),
])

SILVER = T.StructType([
    T.StructField("meta_id", T.StringType()),
    T.StructField("ts_evento", T.TimestampType()),
    T.StructField("tipo", T.StringType()),
    T.StructField("wiki", T.StringType()),
    T.StructField("servidor", T.StringType()),
    T.StructField("espacio", T.IntegerType()),
    T.StructField("titulo", T.StringType()),
    T.StructField("usuario", T.StringType()),
    T.StructField("es_bot", T.BooleanType()),
    T.StructField("ts_mediawiki", T.TimestampType()),
    T.StructField("ts_cola", T.TimestampType()),
    T.StructField("retraso_s", T.DoubleType()),
    T.StructField("ingerido_en", T.TimestampType()),
])
SILVER_COLUMNS = tuple(f.name for f in SILVER.fields)

P1 = T.StructType([
    T.StructField("ventana_inicio", T.TimestampType()),
    T.StructField("ventana_fin", T.TimestampType()),
    T.StructField("servidor", T.StringType()),
    T.StructField("espacio", T.IntegerType()),
    T.StructField("eventos", T.LongType()),
])

P2 = T.StructType([
    T.StructField("ventana_inicio", T.TimestampType()),
    T.StructField("ventana_fin", T.TimestampType()),
    T.StructField("es_bot", T.BooleanType()),
    T.StructField("eventos", T.LongType()),
])

# P1 and P2 folded into one table (one streaming aggregate).
COUNTS = T.StructType([
    T.StructField("ventana_inicio", T.TimestampType()),
    T.StructField("ventana_fin", T.TimestampType()),
    T.StructField("servidor", T.StringType()),
    T.StructField("espacio", T.IntegerType()),
    T.StructField("es_bot", T.BooleanType()),
    T.StructField("eventos", T.LongType()),
])

P3 = T.StructType([
    T.StructField("ventana_inicio", T.TimestampType()),
    T.StructField("ventana_fin", T.TimestampType()),
    T.StructField("wiki", T.StringType()),
    T.StructField("titulo", T.StringType()),
    T.StructField("editores", T.LongType()),
    T.StructField("ediciones", T.LongType()),
])

# P3 as panes of mergeable editor sketches, and latency states per minute.
PANES = T.StructType([
    T.StructField("ventana_inicio", T.TimestampType()),
    T.StructField("ventana_fin", T.TimestampType()),
    T.StructField("ts_panel", T.TimestampType()),
    T.StructField("wiki", T.StringType()),
    T.StructField("titulo", T.StringType()),
    T.StructField("editores_hll", T.BinaryType()),
    T.StructField("ediciones", T.LongType()),
])

LATENCY = T.StructType([
    T.StructField("ventana_inicio", T.TimestampType()),
    T.StructField("ventana_fin", T.TimestampType()),
    T.StructField("ultimo", T.TimestampType()),
    T.StructField("filas", T.LongType()),
    T.StructField("minimo", T.DoubleType()),
    T.StructField("maximo", T.DoubleType()),
    T.StructField("estado", T.BinaryType()),
])

# Capture file record: arrival time in epoch seconds and the event as text.
CAPTURE = T.StructType([
    T.StructField("recibido", T.DoubleType()),
    T.StructField("evento", T.StringType()),
    T.StructField("error_parseo", T.StringType()),
])

# Layer tables: name -> (schema, date partition source column).
LAYERS = {
    "bronze": (BRONZE, "ts_cola"),
    "silver": (SILVER, "ts_evento"),
    "gold_activity": (P1, "ventana_inicio"),
    "gold_bots": (P2, "ventana_inicio"),
    "gold_concurrent": (P3, "ventana_inicio"),
    "gold_counts": (COUNTS, "ventana_inicio"),
    "gold_panes": (PANES, "ventana_inicio"),
    "silver_latency": (LATENCY, "ventana_inicio"),
}
