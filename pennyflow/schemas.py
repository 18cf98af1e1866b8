"""Declared schemas. Nothing is inferred at read time."""

from pyspark.sql import types as T

_S, _L = T.StringType(), T.LongType()


def _struct(required: str, kinds: dict, optional: tuple[str, ...] = ()) -> T.StructType:
    names = required.split()
    return T.StructType([T.StructField(n, kinds.get(n, _S), n in optional) for n in names])


_TIMES = {"time_transaction_occurred": _L, "created_at": _L, "updated_at": _L}

EVENTS = _struct(
    "user_id event_type time_transaction_occurred source_of_event created_at updated_at context",
    _TIMES,
    optional=("context",),
)
BEHAVIOUR = _struct(
    "user_id account_id transaction_type amount unit currency "
    "time_transaction_occurred created_at updated_at",
    {**_TIMES, "amount": _L},
)
FLAGS = _struct("user_id account_id rule_label reason accuracy created_at updated_at", _TIMES)

# One queued message: a JSON list of these, base64 encoded.
MESSAGE = T.StructType(
    [
        T.StructField("user_id", _S),
        T.StructField("event_type", _S),
        T.StructField("time_transaction_occurred", _L),
        T.StructField("context", _S),
    ]
)

# A notification as the service posts it.
NOTIFICATION = T.StructType(
    [
        T.StructField("eventType", _S),
        T.StructField("userId", _S),
        T.StructField("timestamp", _L),
        T.StructField("context", T.MapType(_S, _S)),
        T.StructField("hash", _S),
    ]
)

OFFER_CONTEXT = T.StructType(
    [
        T.StructField("boostId", _S),
        T.StructField("boostType", _S),
        T.StructField("boostCategory", _S),
        T.StructField("boostAmount", _S),
        T.StructField("boostUnit", _S),
        T.StructField("boostStartTime", _L),
        T.StructField("boostEndTime", _L),
        T.StructField("statusConditions", T.MapType(_S, T.ArrayType(_S))),
    ]
)

PAYMENT_CONTEXT = T.StructType([T.StructField("accountId", _S), T.StructField("savedAmount", _S)])

# --- daily app export ------------------------------------------------------------------
# The export's field names in the order in which they enter the context object.
EXPORT_FIELDS = (
    "client_event_time",
    "ip_address",
    "library",
    "dma",
    "user_creation_time",
    "$insert_id",
    "$schema",
    "client_upload_time",
    "app",
    "user_id",
    "city",
    "event_type",
    "device_carrier",
    "location_lat",
    "event_time",
    "platform",
    "is_attribution_event",
    "os_version",
    "paying",
    "amplitude_id",
    "device_type",
    "sample_rate",
    "device_manufacturer",
    "start_version",
    "uuid",
    "version_name",
    "location_lng",
    "server_upload_time",
    "event_id",
    "device_id",
    "device_family",
    "os_name",
    "adid",
    "amplitude_event_type",
    "device_brand",
    "country",
    "device_model",
    "language",
    "region",
    "session_id",
    "idfa",
)
EXPORT_PROPERTY_MAPS = ("event_properties", "data", "groups", "group_properties", "user_properties")
BAD_RECORD = "_bad_record"
EXPORT_LINE = T.StructType(
    [T.StructField(n, T.VariantType()) for n in EXPORT_FIELDS]
    + [T.StructField(n, T.MapType(_S, T.VariantType())) for n in EXPORT_PROPERTY_MAPS]
    + [T.StructField(BAD_RECORD, _S)]
)
