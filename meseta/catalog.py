"""Source columns, indicator catalogues and the table registry."""

from __future__ import annotations

from dataclasses import dataclass

# AEMET source fields -----------------------------------------

STATION_FIELDS = ("indicativo", "nombre", "provincia", "altitud", "latitud", "longitud", "indsinop")

DAILY_FIELD_ORDER = (
    "altitud", "dir", "horaHrMax", "horaHrMin", "horaPIntMax", "horaPresMax", "horaPresMin",
    "horaracha", "horatmax", "horatmin", "hrMax", "hrMedia", "hrMin", "nombre", "pintMax",
    "prec", "presMax", "presMin", "provincia", "racha", "sol", "tmax", "tmed", "tmin",
    "velmedia",
)
# those of them that are numbers
DAILY_NUMBER_FIELDS = (
    "altitud", "dir", "hrMax", "hrMedia", "hrMin", "pintMax", "prec", "presMax",
    "presMin", "racha", "sol", "tmax", "tmed", "tmin", "velmedia",
)

CURRENT_MEASURES = (
    "alt", "dmax", "dmaxu", "dv", "dvu", "geo700", "geo850", "geo925", "hr", "inso",
    "nieve", "pacutp", "pliqt", "prec", "pres", "pres_nmar", "psoltp", "rviento",
    "stddv", "stddvu", "stdvv", "stdvvu", "ta", "tamax", "tamin", "tpr", "ts",
    "tss20cm", "tss5cm", "ubi", "vis", "vmax", "vmaxu", "vv", "vvu",
)

# Open-Meteo variables -----------------------------------------

SURFACE_VARIABLES = (
    "temperature_2m", "relative_humidity_2m", "dew_point_2m", "precipitation",
    "pressure_msl", "surface_pressure", "cloud_cover", "shortwave_radiation",
    "direct_radiation", "diffuse_radiation", "direct_normal_irradiance",
    "sunshine_duration", "wind_speed_10m", "wind_direction_10m", "wind_gusts_10m",
)
HUB_HEIGHT_VARIABLES = (
    "wind_speed_80m", "wind_direction_80m", "wind_speed_120m", "wind_direction_120m",
)
# Published as whole numbers although a reader would expect doubles.
INTEGER_VARIABLES = frozenset({
    "relative_humidity_2m", "cloud_cover", "wind_direction_10m",
    "wind_direction_80m", "wind_direction_120m",
})

# ESIOS datasets by family, with indicator id -------------------

HOURLY_ENERGY_DATASETS = {
    1159: "generacion_medida_eolica_terrestre",
    1161: "generacion_medida_solar_fotovoltaica",
    1162: "generacion_medida_solar_termica",
    10035: "generacion_medida_hidraulica",
    1153: "generacion_medida_nuclear",
    1156: "generacion_medida_ciclo_combinado",
    1158: "generacion_medida_gas_natural_turbina_vapor",
    1164: "generacion_medida_gas_natural_cogeneracion",
    10036: "generacion_medida_carbon",
    10041: "generacion_medida_otras_renovables",
    10043: "generacion_medida_total",
    10195: "generacion_medida_total_tipo_produccion",
    1193: "demanda_en_consumo",
    10267: "demanda_medida_discriminacion_horaria_total",
}
FIVE_MINUTE_POWER_DATASETS = {
    1293: "demanda_real",
    10004: "demanda_real_suma_generacion",
    2038: "generacion_treal_eolica_nacional",
    2039: "generacion_treal_nuclear_nacional",
    2040: "generacion_treal_carbon_nacional",
    2041: "generacion_treal_ciclo_combinado_nacional",
    2042: "generacion_treal_hidraulica_nacional",
    2044: "generacion_treal_solar_fotovoltaica_nacional",
    2045: "generacion_treal_solar_termica_nacional",
    2046: "generacion_treal_termica_renovable_nacional",
    2051: "generacion_treal_cogeneracion_residuos_nacional",
    2065: "generacion_treal_consumo_bombeo_nacional",
}
MONTHLY_CAPACITY_DATASETS = {
    1475: "potencia_instalada_hidraulica",
    1485: "potencia_instalada_eolica",
    1486: "potencia_instalada_solar_fotovoltaica",
    1487: "potencia_instalada_solar_termica",
    10302: "potencia_instalada_total_renovable",
    1477: "potencia_instalada_nuclear",
    1478: "potencia_instalada_carbon",
    1483: "potencia_instalada_ciclo_combinado",
    1488: "potencia_instalada_otras_renovables",
}

# Fixed values: (magnitude id, time id) of each family ------------------------

ENERGY_BY_HOUR = (13, 4)
POWER_BY_FIVE_MINUTES = (20, 219)
CAPACITY_BY_MONTH = (20, 2)

# Indicator id -> Gold metric -----------------------------------

HOURLY_METRICS = {
    1159: "wind_generation_mwh",
    1161: "solar_photovoltaic_generation_mwh",
    1162: "solar_thermal_generation_mwh",
    10035: "hydraulic_generation_mwh",
    1153: "nuclear_generation_mwh",
    1156: "combined_cycle_generation_mwh",
    1158: "gas_natural_steam_turbine_generation_mwh",
    1164: "gas_natural_cogeneration_mwh",
    10036: "coal_generation_mwh",
    10041: "other_renewables_generation_mwh",
    10043: "total_generation_mwh",
}
CAPACITY_METRICS = {
    1475: "hydraulic_installed_capacity_mw",
    1485: "wind_installed_capacity_mw",
    1486: "solar_photovoltaic_installed_capacity_mw",
    1487: "solar_thermal_installed_capacity_mw",
    10302: "renewable_total_installed_capacity_mw",
    1477: "nuclear_installed_capacity_mw",
    1478: "coal_installed_capacity_mw",
    1483: "combined_cycle_installed_capacity_mw",
    1488: "other_renewables_installed_capacity_mw",
}
# metric stem of the national series; power adds _power_mw, demand only _mw
NATIONAL_SERIES = {
    1293: "real_demand",
    2038: "wind_generation",
    2039: "nuclear_generation",
    2040: "coal_generation",
    2041: "combined_cycle_generation",
    2042: "hydraulic_generation",
    2044: "solar_photovoltaic_generation",
    2045: "solar_thermal_generation",
    2046: "renewable_thermal_generation",
    2051: "cogeneration_waste_generation",
    2065: "pumping_consumption",
}
DEMAND_INDICATOR = 1293
EXCLUDED_FROM_GOLD = frozenset({10195, 1193, 10267, 10004})

# ESIOS ids of the two national scopes ---------------------------

SPAIN_GEO_ID = 3
PENINSULA_GEO_ID = 8741

# Radiation report -----------------------------------------------

# type -> (unit, first hour, last hour, step in hours, granularity label)
RADIATION_TYPES = {
    "GL": ("10*kJ/m2", 5.0, 20.0, 1.0, "1h"),
    "DF": ("10*kJ/m2", 5.0, 20.0, 1.0, "1h"),
    "DT": ("10*kJ/m2", 5.0, 20.0, 1.0, "1h"),
    "UVB": ("J/m2", 4.5, 20.0, 0.5, "30min"),
    "UVER": ("J/m2", 4.5, 20.0, 0.5, "30min"),
    "IR": ("10*kJ/m2", 1.0, 24.0, 1.0, "1h"),
}


@dataclass(frozen=True)
class TableSpec:
    """What the load needs to know about one stored table."""

    name: str
    keys: tuple[str, ...]
    partition: tuple[str, str] | None = None  # ("days" | "months" | "value", column)
    place_column: str | None = None  # source column resolved against the province master
    buckets: int = 0  # parts by the hash of the key, for tables whose loads touch all partitions

    @property
    def partition_column(self) -> str | None:
        """Physical partition column on formats without partition transforms."""
        if self.partition is None:
            return None
        kind, column = self.partition
        return column if kind == "value" else {"days": "part_day", "months": "part_month"}[kind]


_SERIES_KEY = ("station_id", "observation_timestamp")
_INDICATOR_KEY = ("indicator_id", "esios_geo_id", "observation_timestamp")
BY_DAY = ("days", "observation_timestamp")
BY_MONTH = ("months", "observation_timestamp")

SILVER_TABLES = {
    spec.name: spec
    for spec in (
        TableSpec("silver_aemet_stations", ("station_id",), None, "provincia"),
        TableSpec("silver_aemet_daily_climatology", ("station_id", "observation_date"),
                  ("months", "observation_date"), "provincia"),
        TableSpec("silver_aemet_current_observations", _SERIES_KEY, BY_DAY),
        TableSpec("silver_open_meteo_hourly", _SERIES_KEY, BY_DAY, "province"),
        TableSpec("silver_open_meteo_historical_forecast", _SERIES_KEY, BY_DAY, "province"),
        TableSpec("silver_open_meteo_15min", _SERIES_KEY, BY_DAY, "province"),
        TableSpec("silver_cnig_provinces", ("province_code",)),
        TableSpec("silver_cnig_autonomous_communities", ("autonomous_community_code",)),
        TableSpec("silver_cnig_municipalities", ("municipality_ine_code",)),
        TableSpec("silver_esios_energy_hourly", _INDICATOR_KEY, BY_DAY, "esios_geo_name"),
        TableSpec("silver_esios_power_5min", _INDICATOR_KEY, BY_DAY),
        TableSpec("silver_esios_installed_capacity_monthly", _INDICATOR_KEY, BY_MONTH),
    )
}

GOLD_TABLES = {
    spec.name: spec
    for spec in (
        TableSpec("gold_fact_province_hourly", ("province_code", "gold_timestamp"),
                  ("days", "gold_timestamp")),
        TableSpec("gold_fact_installed_capacity_monthly",
                  ("autonomous_community_code", "year_month"), ("value", "year_month")),
        TableSpec("gold_fact_country_15min", ("geography_key", "gold_timestamp"),
                  ("days", "gold_timestamp")),
        TableSpec("gold_fact_country_5min", ("geography_key", "gold_timestamp"),
                  ("days", "gold_timestamp")),
        TableSpec("gold_dim_time", ("time_key",)),
        TableSpec("gold_dim_geography", ("geography_key",)),
    )
}

# Load modes: which Silver tables each one refreshes.
LOAD_MODES = {
    "all": frozenset(SILVER_TABLES),
    "geography-fix": frozenset({
        "silver_aemet_stations", "silver_aemet_daily_climatology", "silver_open_meteo_hourly",
        "silver_open_meteo_historical_forecast", "silver_open_meteo_15min",
    }),
    "esios-geography-fix": frozenset({"silver_esios_energy_hourly"}),
}

# Geography level each fact may hold.
FACT_LEVELS = {
    "gold_fact_province_hourly": ("PROVINCE",),
    "gold_fact_installed_capacity_monthly": ("AUTONOMOUS_COMMUNITY",),
    "gold_fact_country_15min": ("COUNTRY", "PENINSULA"),
    "gold_fact_country_5min": ("COUNTRY", "PENINSULA"),
}
GEOGRAPHY_LEVELS = ("PROVINCE", "AUTONOMOUS_COMMUNITY", "COUNTRY", "PENINSULA")
TIME_GRAINS = ("FIVE_MINUTES", "FIFTEEN_MINUTES", "HOUR", "MONTH")
