"""Explicit Bronze schemas, so that no scan pays for an inference pass."""

from __future__ import annotations

from pyspark.sql import types as T

from meseta import catalog

_TEXT, _LONG, _DOUBLE = T.StringType(), T.LongType(), T.DoubleType()


def record(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def _all_text(names) -> T.StructType:
    return record(**dict.fromkeys(names, _TEXT))


ENVELOPE_METADATA = record(
    source=_TEXT, dataset=_TEXT, ingestion_mode=_TEXT, ingestion_timestamp=_TEXT,
    requested_start_date=_TEXT, requested_end_date=_TEXT,
)


def envelope(data: T.DataType, **extra_metadata: T.DataType) -> T.StructType:
    """``{"metadata": {...}, "data": payload}`` around one payload type."""
    extra = [T.StructField(name, kind) for name, kind in extra_metadata.items()]
    return record(metadata=T.StructType([*ENVELOPE_METADATA.fields, *extra]), data=data)


STATIONS = envelope(T.ArrayType(_all_text(catalog.STATION_FIELDS)))
DAILY_CLIMATOLOGY = envelope(
    T.ArrayType(_all_text(("indicativo", "fecha", *catalog.DAILY_FIELD_ORDER)))
)
CURRENT_OBSERVATIONS = envelope(T.ArrayType(record(
    idema=_TEXT, fint=_TEXT, lat=_DOUBLE, lon=_DOUBLE,
    **{name: _TEXT if name == "ubi" else _DOUBLE for name in catalog.CURRENT_MEASURES},
)))


def parallel_series(container: str, variables, id_field: str) -> T.StructType:
    """One location per envelope, one array per variable below ``data.<container>``."""
    arrays = {
        name: T.ArrayType(_LONG if name in catalog.INTEGER_VARIABLES else _DOUBLE)
        for name in variables
    }
    payload = record(
        elevation=_DOUBLE, latitude=_DOUBLE, longitude=_DOUBLE,
        **{container: record(time=T.ArrayType(_TEXT), **arrays)},
    )
    return envelope(payload, **{id_field: _TEXT, "station_name": _TEXT, "province": _TEXT})


_CLASSIFIER = T.ArrayType(record(id=_LONG, name=_TEXT))
INDICATOR = envelope(record(indicator=record(
    id=_LONG, name=_TEXT, short_name=_TEXT, magnitud=_CLASSIFIER, tiempo=_CLASSIFIER,
    values_updated_at=_TEXT,
    values=T.ArrayType(record(
        datetime=_TEXT, datetime_utc=_TEXT, tz_time=_TEXT,
        geo_id=_LONG, geo_name=_TEXT, value=_DOUBLE,
    )),
)))

PROVINCES_CSV = _all_text(("COD_PROV", "PROVINCIA", "COD_CA", "COMUNIDAD_AUTONOMA", "CAPITAL"))
MUNICIPALITIES_CSV = _all_text((
    "COD_INE", "ID_REL", "COD_GEO", "COD_PROV", "PROVINCIA", "NOMBRE_ACTUAL",
    "POBLACION_MUNI", "SUPERFICIE", "PERIMETRO", "COD_INE_CAPITAL", "CAPITAL",
    "POBLACION_CAPITAL", "HOJA_MTN25", "LONGITUD_ETRS89_REGCAN95",
    "LATITUD_ETRS89_REGCAN95", "ORIGENCOOR", "ALTITUD", "ORIGENALTITUD",
))
