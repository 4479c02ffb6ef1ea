"""Reading the Bronze landing zone with explicit schemas."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meseta import catalog, schemas
from meseta.functions import instant_with, windows_1252
from meseta.operators.clean import flatten_envelope
from meseta.sources.landing import RECORD_SEPARATOR

ESIOS_DATASETS = frozenset({
    *catalog.HOURLY_ENERGY_DATASETS.values(),
    *catalog.FIVE_MINUTE_POWER_DATASETS.values(),
    *catalog.MONTHLY_CAPACITY_DATASETS.values(),
})


class Bronze:
    """A landing root laid out as ``<root>/<source>/<dataset>/year=/month=/day=``.

    ``landed`` restricts every scan to the half-open range of landing dates. The folders
    of those days are looked up by month, so an incremental load lists and reads its own
    days only, however long the history is.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        landed: tuple[dt.date, dt.date] | None = None,
        multiline: bool = True,
    ):
        if not root.strip():
            raise ValueError("The Bronze root cannot be blank.")
        self.spark = spark
        self.root = root.strip().rstrip("/")
        self.landed = landed
        self.multiline = multiline

    def everything(self) -> Bronze:
        """The same landing root without a range of landing dates."""
        return Bronze(self.spark, self.root, None, self.multiline)

    def path(self, source: str, dataset: str) -> str:
        source, dataset = source.strip(), dataset.strip()
        if not source or not dataset:
            raise ValueError("Source and dataset cannot be blank.")
        return f"{self.root}/{source}/{dataset}"

    def _day_folders(self, path: str) -> list[str]:
        """Folders of the landed days of a dataset that exist; one listing a month."""
        start, end = self.landed
        wanted = {start + dt.timedelta(days=i) for i in range((end - start).days)}
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        found = []
        for year, month in sorted({(day.year, day.month) for day in wanted}):
            folder = jvm.org.apache.hadoop.fs.Path(f"{path}/year={year:04d}/month={month:02d}")
            files = folder.getFileSystem(conf)
            if not files.exists(folder):
                continue
            for status in files.listStatus(folder):
                name = status.getPath().getName()
                if name.startswith("day=") and dt.date(year, month, int(name[4:])) in wanted:
                    found.append(f"{path}/year={year:04d}/month={month:02d}/{name}")
        return sorted(found)

    def _located(self, reader: DataFrameReader, paths: list[str]) -> tuple[DataFrameReader, list[str]]:
        """The reader and the folders it has to scan.

        The days of one dataset come with their date columns; several datasets have no
        common base for them and are scanned as one list of folders.
        """
        if self.landed is None:
            return reader, paths
        folders = [folder for path in paths for folder in self._day_folders(path)]
        if len(paths) > 1:
            return reader.option("recursiveFileLookup", True), folders
        return reader.option("basePath", paths[0]), folders

    # generic scans -----------------------------------------------------------

    def json(self, schema: T.StructType, source: str, *datasets: str) -> DataFrame:
        """One scan over one or several datasets of a source."""
        paths = [self.path(source, dataset) for dataset in datasets]
        reader = (
            self.spark.read.schema(schema)
            .option("multiLine", self.multiline)
            .option("recursiveFileLookup", self.landed is None)
        )
        reader, folders = self._located(reader, paths)
        return reader.json(folders)

    def csv(self, schema: T.StructType, source: str, dataset: str, sep: str = ";") -> DataFrame:
        """Delimited snapshot with a header.

        The published files are Windows-1252, which Spark 4 reads only with a legacy
        switch. Latin-1 is accepted and differs in 27 characters, which are put right
        in every text column.
        """
        reader = self.spark.read.schema(schema).options(header=True, sep=sep, encoding="iso-8859-1")
        reader, folders = self._located(reader, [self.path(source, dataset)])
        texts = [field.name for field in schema if isinstance(field.dataType, T.StringType)]
        return reader.csv(folders).withColumns({name: windows_1252(F.col(name)) for name in texts})

    def text(self, source: str, dataset: str, packed: bool = False) -> DataFrame:
        """One row per landed document: a whole file, or a record of a packed file."""
        form = {"lineSep": RECORD_SEPARATOR} if packed else {"wholetext": True}
        reader, folders = self._located(self.spark.read.options(**form), [self.path(source, dataset)])
        return reader.text(folders)

    # AEMET -------------------------------------------------------------------

    def _records(self, schema: T.StructType, dataset: str) -> DataFrame:
        """Records without the all-NULL row an empty delivery would leave."""
        return flatten_envelope(self.json(schema, "aemet", dataset), keep_empty=False)

    def stations(self) -> DataFrame:
        return self._records(schemas.STATIONS, "stations")

    def daily_climatology(self) -> DataFrame:
        return self._records(schemas.DAILY_CLIMATOLOGY, "daily_climatological_values")

    def current_observations(self) -> DataFrame:
        return self._records(schemas.CURRENT_OBSERVATIONS, "current_observations")

    def radiation(self) -> DataFrame:
        return self.text("aemet", "radiation")

    # Open-Meteo --------------------------------------------------------------

    def weather_hourly(self) -> DataFrame:
        schema = schemas.parallel_series("hourly", catalog.SURFACE_VARIABLES, "station_id")
        return self.json(schema, "open_meteo", "weather_hourly")

    def weather_historical_forecast(self) -> DataFrame:
        schema = schemas.parallel_series("hourly", catalog.HUB_HEIGHT_VARIABLES, "station_id")
        return self.json(schema, "open_meteo", "weather_historical_forecast")

    def weather_15min(self) -> DataFrame:
        variables = catalog.SURFACE_VARIABLES + catalog.HUB_HEIGHT_VARIABLES
        schema = schemas.parallel_series("minutely_15", variables, "location_id")
        return self.json(schema, "open_meteo", "weather_15min")

    # ESIOS -------------------------------------------------------------------

    def indicators(self, datasets: Iterable[str]) -> DataFrame:
        """Indicator envelopes of the named datasets plus a ``dataset`` column.

        All datasets share one schema, so one scan covers them; the dataset name
        is the path segment below the source.
        """
        names = sorted(set(datasets))
        unknown = [name for name in names if name not in ESIOS_DATASETS]
        if unknown:
            raise ValueError(f"Unknown ESIOS datasets: {unknown}")
        scan = self.json(schemas.INDICATOR, "esios", *names)
        segment = F.regexp_extract(F.col("_metadata.file_path"), r"/esios/([^/]+)/", 1)
        return scan.select("metadata", "data", segment.alias("dataset"))

    # CNIG --------------------------------------------------------------------

    def provinces(self) -> DataFrame:
        return with_file_time(self.csv(schemas.PROVINCES_CSV, "cnig", "provinces"))

    def municipalities(self) -> DataFrame:
        return with_file_time(self.csv(schemas.MUNICIPALITIES_CSV, "cnig", "municipalities"))


def file_time(file_name) -> "F.Column":
    """Landing instant encoded in a file name as ``_YYYYMMDDTHHMMSSffffffZ_``."""
    stamp = F.regexp_extract(file_name, r"_(\d{8}T\d{12}Z)_", 1)
    return instant_with(stamp, "yyyyMMdd'T'HHmmssSSSSSS'Z'")


def with_file_time(df: DataFrame) -> DataFrame:
    return df.withColumn("ingestion_timestamp", file_time(F.col("_metadata.file_name")))
