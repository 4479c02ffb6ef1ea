import pytest
from pyspark.sql import functions as F

from meseta import config
from meseta.operators import geo, joins

MASTER = [
    ("01", "Araba/Álava", "16", "País Vasco/Euskadi"), ("03", "Alacant/Alicante", "10", "Comunitat Valenciana"),
    ("04", "Almería", "01", "Andalucía"), ("05", "Ávila", "07", "Castilla y León"),
    ("07", "Illes Balears", "04", "Illes Balears"), ("10", "Cáceres", "11", "Extremadura"),
    ("11", "Cádiz", "01", "Andalucía"), ("12", "Castelló/Castellón", "10", "Comunitat Valenciana"),
    ("14", "Córdoba", "01", "Andalucía"), ("20", "Gipuzkoa", "16", "País Vasco/Euskadi"),
    ("23", "Jaén", "01", "Andalucía"), ("24", "León", "07", "Castilla y León"),
    ("28", "Madrid", "13", "Comunidad de Madrid"), ("29", "Málaga", "01", "Andalucía"),
    ("38", "Santa Cruz de Tenerife", "05", "Canarias"), ("46", "València/Valencia", "10", "Comunitat Valenciana"),
    ("48", "Bizkaia", "16", "País Vasco/Euskadi")]


@pytest.fixture(scope="module")
def master(spark):
    return spark.createDataFrame(MASTER, ", ".join(f"{c} string" for c in geo.PROVINCE_COLUMNS))


EXPECTED = {
    "CORDOBA": "14", "ALMERIA": "04", "ARABA/ALAVA": "01", "AVILA": "05", "CACERES": "10", "CADIZ": "11",
    "JAEN": "23", "LEON": "24", "MALAGA": "29", "MADRID": "28", "ALICANTE": "03", "BALEARES": "07",
    "CASTELLON": "12", "STA. CRUZ DE TENERIFE": "38", "VALENCIA": "46", "ALAVA": "01", "GUIPUZCOA": "20",
    " vizcaya ": "48", "PROVINCIA_INEXISTENTE": None, None: None}


def test_province_resolution(spark, master):
    sources = spark.createDataFrame([(name,) for name in EXPECTED], "province string")
    found = geo.resolve_place(sources, master, "province", config.load("province_aliases"))
    assert {r["province"]: r["province_code"] for r in found.collect()} == EXPECTED
    assert found.columns == ["province", *geo.PROVINCE_COLUMNS]
    with pytest.raises(ValueError, match="weather: 2 rows"):
        geo.require_matched(found, "weather")
    geo.require_matched(found, "weather", scope=F.col("province").isin("MADRID", "LEON"))


def test_master_is_unique_and_complete(spark, master):
    assert geo.prepare_master(master.unionByName(master)).count() == len(MASTER)
    with pytest.raises(ValueError):
        geo.prepare_master(master.drop("province_name"))


def test_alias_settings_are_clean(spark):
    frame = geo.alias_frame(spark, config.load("province_aliases"))
    assert frame.filter("alias_key IS NULL OR canonical_key IS NULL").count() == 0
    assert frame.groupBy("alias_key").count().filter("count > 1").count() == 0
    repeated = geo.alias_frame(spark, {"Álava": "Araba", " ALAVA": "Araba"})
    assert repeated.groupBy("alias_key").count().filter("count > 1").count() == 1
    with pytest.raises(ValueError):
        geo.alias_frame(spark, {"Álava": 1})


def test_station_place(spark, master):
    stations = master.selectExpr("concat('S', province_code) AS station_id", *geo.PROVINCE_COLUMNS)
    rows = spark.createDataFrame([("S28", 1.0), ("S99", 2.0)], "station_id string, ta double")
    placed = geo.attach_station_place(rows, stations)
    assert {(r["station_id"], r["province_name"]) for r in placed.collect()} == {("S28", "Madrid"), ("S99", None)}


def test_merge_on_grain_keeps_every_key(spark):
    a = spark.createDataFrame([(1, 1.0), (2, 2.0)], "k int, a double")
    b = spark.createDataFrame([(2, 20.0), (3, None)], "k int, b double")
    c = spark.createDataFrame([(4, "x")], "k int, c string")
    merged = joins.merge_on_grain({"a": a, "b": b, "c": c}, ["k"])
    assert sorted(tuple(r) for r in merged.collect()) == [
        (1, 1.0, None, None), (2, 2.0, 20.0, None), (3, None, None, None), (4, None, None, "x")]
    full = a.join(b, "k", "full").join(c, "k", "full").select(merged.columns)
    assert merged.exceptAll(full).count() == full.exceptAll(merged).count() == 0


def test_merge_on_grain_refuses_to_multiply(spark):
    a = spark.createDataFrame([(1, 1.0), (1, 2.0)], "k int, a double")
    b = spark.createDataFrame([(1, 20.0)], "k int, b double")
    with pytest.raises(Exception, match="repeats a key"):
        joins.merge_on_grain({"a": a, "b": b}, ["k"]).collect()
    with pytest.raises(ValueError, match="occurs in both"):
        joins.merge_on_grain({"a": a, "b": a}, ["k"])


@pytest.mark.parametrize("pairs", [[("A", "x"), (" a", "y")], [("", "x")], [("A", " ")]])
def test_repeated_and_blank_settings_are_refused(pairs):
    from meseta import config

    with pytest.raises(ValueError):
        config.unique_entries(pairs)
    assert config.load("province_aliases") and config.load("community_aliases") and config.load("time_alignment")
