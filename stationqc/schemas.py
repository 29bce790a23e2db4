"""Explicit schemas (no inference on any read)."""

from pyspark.sql import types as T

STATION_PAYLOAD = T.StructType([
    T.StructField("status", T.StringType()),
    T.StructField("body", T.ArrayType(T.StructType([
        T.StructField("_id", T.StringType()),
        T.StructField("place", T.StructType([
            T.StructField("location", T.ArrayType(T.DoubleType())),
            T.StructField("altitude", T.DoubleType()),
            T.StructField("city", T.StringType()),
            T.StructField("country", T.StringType()),
            T.StructField("timezone", T.StringType()),
            T.StructField("street", T.StringType()),
        ])),
        T.StructField("module_types", T.MapType(T.StringType(), T.StringType())),
    ]))),
])

MEASURE_PAYLOAD = T.StructType([T.StructField("body", T.MapType(T.StringType(), T.ArrayType(T.DoubleType())))])

# A measurement document as it lands: the station may stand beside the body; the text of one that does not fit is kept.
MEASURE_DOCUMENT = T.StructType([T.StructField("station_id", T.StringType()), *MEASURE_PAYLOAD.fields,
                                 T.StructField("_corrupt", T.StringType())])
# The same with entries as raw text, for documents in which some entry does not fit.
MEASURE_LENIENT = T.StructType([T.StructField("station_id", T.StringType()),
                                T.StructField("body", T.MapType(T.StringType(), T.StringType())),
                                T.StructField("_corrupt", T.StringType())])

# Column order of the station list file.
STATION_LIST_COLUMNS = ["station_id", "module1_id", "module1_type", "latitude", "longitude", "altitude",
                        "city", "country", "street", "timezone"]

STATION_LIST = T.StructType([
    T.StructField("station_id", T.StringType()), T.StructField("module1_id", T.StringType()),
    T.StructField("module1_type", T.StringType()), T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()), T.StructField("altitude", T.DoubleType()),
    T.StructField("city", T.StringType()), T.StructField("country", T.StringType()),
    T.StructField("street", T.StringType()), T.StructField("timezone", T.StringType()),
])

# Column order of an observation file (time first).
OBS_FILE_COLUMNS = ["ts", "temperature", "longitude", "latitude", "altitude", "station_ID"]

OBS_FILE = T.StructType([
    T.StructField("ts", T.StringType()), T.StructField("temperature", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()), T.StructField("latitude", T.DoubleType()),
    T.StructField("altitude", T.StringType()), T.StructField("station_ID", T.StringType()),
])
