"""A small landing zone written the way the sources deliver it: indented JSON, one object per file."""

import json
import math
from pathlib import Path

from meseta import catalog

PROVINCES = [
    ("28", "Madrid", "13", "Comunidad de Madrid", "Madrid"),
    ("46", "València/Valencia", "10", "Comunitat Valenciana", "València"),
    ("01", "Araba/Álava", "16", "País Vasco/Euskadi", "Vitoria-Gasteiz"),
]
STATIONS = [("S28", "MADRID"), ("S46", "VALENCIA"), ("S01", "ARABA/ALAVA")]
QUARTERS = [f"2026-08-18T{h:02d}:{m:02d}" for h in (12, 13) for m in (0, 15, 30, 45)]
HOURS = ["2026-08-18T12:00", "2026-08-18T13:00"]


def put(root, source, dataset, name, content, encoding="utf-8"):
    folder = Path(root) / source / dataset / "year=2026" / "month=08" / "day=18"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(content, encoding=encoding)


def put_json(root, source, dataset, name, data, stamp="2026-08-18T16:00:00+00:00", **metadata):
    envelope = {"metadata": {"source": source, "dataset": dataset, "ingestion_mode": "incremental",
                             "ingestion_timestamp": stamp, "requested_start_date": None,
                             "requested_end_date": None, **metadata}, "data": data}
    put(root, source, dataset, f"{source}_{dataset}_{name}.json", json.dumps(envelope, ensure_ascii=False, indent=2))


def indicator(indicator_id, dataset, classes, values):
    point = lambda at, geo_id, geo_name, value: {
        "datetime": at, "datetime_utc": at, "tz_time": at, "geo_id": geo_id, "geo_name": geo_name, "value": value}
    return {"indicator": {
        "id": indicator_id, "name": dataset, "short_name": dataset,
        "magnitud": [{"id": classes[0], "name": "m"}], "tiempo": [{"id": classes[1], "name": "t"}],
        "values_updated_at": "2026-08-18T15:00:00Z", "values": [point(*v) for v in values]}}


def variables(names, size):
    return {
        name: [10 * (i + 1) if name in catalog.INTEGER_VARIABLES else 1.5 * (i + 1) for i in range(size)]
        for name in names}


def write(root):
    stations = [
        {"indicativo": sid, "nombre": sid, "provincia": province, "altitud": "667", "latitud": "402443N",
         "longitud": "0034049W", "indsinop": "08222"} for sid, province in STATIONS]
    put_json(root, "aemet", "stations", "a", stations)
    put_json(root, "aemet", "stations", "b", [])
    daily = dict.fromkeys(catalog.DAILY_FIELD_ORDER, "1,5") | {
        "indicativo": "S28", "fecha": "2026-08-17", "provincia": "MADRID", "prec": "Ip"}
    put_json(root, "aemet", "daily_climatological_values", "a", [daily, daily])
    current = [
        {**dict.fromkeys(catalog.CURRENT_MEASURES, 1.0), "ubi": sid, "idema": sid, "fint": "2026-08-18T12:00:00",
         "lat": 40.4, "lon": -3.7, "ta": 30.0, "hr": None, "prec": 0.0} for sid, _ in STATIONS[:2]]
    put_json(root, "aemet", "current_observations", "a", current)
    put_json(root, "aemet", "current_observations", "b", [{**current[0], "ta": 31.0}], "2026-08-18T17:00:00+00:00")

    place = {"elevation": 600.0, "latitude": 40.4, "longitude": -3.7}
    quarter_variables = catalog.SURFACE_VARIABLES + catalog.HUB_HEIGHT_VARIABLES
    for sid, province in STATIONS:
        meta = {"station_name": sid, "province": province, "latitude": 40.4}
        for dataset, names in (("weather_hourly", catalog.SURFACE_VARIABLES),
                               ("weather_historical_forecast", catalog.HUB_HEIGHT_VARIABLES)):
            put_json(root, "open_meteo", dataset, sid, {
                **place, "hourly": {"time": HOURS, **variables(names, len(HOURS))}}, station_id=sid, **meta)
        put_json(root, "open_meteo", "weather_15min", sid, {
            **place, "minutely_15": {"time": QUARTERS, **variables(quarter_variables, len(QUARTERS))}},
            location_id=sid, **meta)

    for key, dataset in catalog.HOURLY_ENERGY_DATASETS.items():
        values = [] if dataset.startswith("demanda") else [
            (f"2026-08-18T{h}:00:00Z", 28, "Madrid", float(key) * (-1 if key == 10035 else 1)) for h in (11, 12)]
        put_json(root, "esios", dataset, "a", indicator(key, dataset, catalog.ENERGY_BY_HOUR, values))
    for key, dataset in catalog.FIVE_MINUTE_POWER_DATASETS.items():
        geo = (8741, "Península") if key == catalog.DEMAND_INDICATOR else (3, "España")
        values = [(f"2026-08-18T11:{m:02d}:00Z", *geo, 120.0) for m in (0, 5, 10)]
        put_json(root, "esios", dataset, "a", indicator(key, dataset, catalog.POWER_BY_FIVE_MINUTES, values))
    for key, dataset in catalog.MONTHLY_CAPACITY_DATASETS.items():
        values = [("2026-06-30T22:00:00Z", 8, "Madrid", 100.0), ("2026-06-30T22:00:00Z", 10, "País Vasco", 50.0)]
        put_json(root, "esios", dataset, "a", indicator(key, dataset, catalog.CAPACITY_BY_MONTH, values))

    rows = "\n".join(";".join(row) for row in PROVINCES)
    put(root, "cnig", "provinces", "cnig_provinces_20260818T140500123456Z_ab.csv",
        "COD_PROV;PROVINCIA;COD_CA;COMUNIDAD_AUTONOMA;CAPITAL\n" + rows + "\n", "windows-1252")
    header = ("COD_INE;ID_REL;COD_GEO;COD_PROV;PROVINCIA;NOMBRE_ACTUAL;POBLACION_MUNI;SUPERFICIE;PERIMETRO;"
              "COD_INE_CAPITAL;CAPITAL;POBLACION_CAPITAL;HOJA_MTN25;LONGITUD_ETRS89_REGCAN95;"
              "LATITUD_ETRS89_REGCAN95;ORIGENCOOR;ALTITUD;ORIGENALTITUD")
    row = ('01001000000;1010014;01010;01;Araba/Álava;Alegría-Dulantzi;2961;"1994,5872";35069;01001000101;'
           'Alegría-Dulantzi;2842;0113-3;"-2,512507724";"42,84045247";Detección automática;568;MDT')
    put(root, "cnig", "municipalities", "cnig_municipalities_20260818T140500123456Z_ab.csv",
        f"{header}\n{row}\n", "windows-1252")
    return root


def mean_direction(degrees):
    x = sum(math.sin(math.radians(d)) for d in degrees)
    y = sum(math.cos(math.radians(d)) for d in degrees)
    return math.degrees(math.atan2(x, y)) % 360
