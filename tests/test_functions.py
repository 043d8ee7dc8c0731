"""Column functions on literal rows with expectations worked out by hand."""

import datetime as dt

import duckdb
import pytest
from oracle import connect
from pyspark.sql import functions as F

from geoframe.functions import times as T
from geoframe.functions import values as V
from geoframe.registry import ORACLE, QUERIES


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("name", "layout", "want"),
    [
        ("MRMS_PrecipFlag_00.00_20160122-194600.grib2.gz", "radar", dt.datetime(2016, 1, 22, 19, 46)),
        ("PrecipRate_20160122-194600.grib2", "radar", dt.datetime(2016, 1, 22, 19, 46)),
        ("NPR.GEO.GHE.v1.S201906242000.nc.gz", "rain_rate", dt.datetime(2019, 6, 24, 20)),
        ("X-GLB-5_v1r0_blend_s202501020304059_e202501020313059.nc", "blended_rain", dt.datetime(2025, 1, 2, 3, 4)),
        ("SILAM-dust-glob01_v5_7_2_2024111400_001.nc4", "dust", dt.datetime(2024, 11, 14)),
        ("gk2a_ami_le1b_ir087_fd020ge_202501010000.nc", "full_disk", dt.datetime(2025, 1, 1)),
        ("no time here", "radar", None),
    ],
)
def test_time_from_name(spark, name, layout, want):
    assert one(spark, T.time_from_name(F.lit(name), layout)) == want


def test_day_of_year(spark):
    name = "OR_ABI-L1b-RadF-M6C01_G19_s20243662359205_e20250010009513_c20250010009543.nc"
    assert one(spark, T.time_from_day_of_year(F.lit(name))) == dt.datetime(2024, 12, 31, 23, 59, 20)
    assert one(spark, T.time_from_day_of_year(F.lit("x"))) is None


@pytest.mark.parametrize(("seconds", "want"), [(0, dt.datetime(2000, 1, 1, 12)), (86400, dt.datetime(2000, 1, 2, 12))])
def test_epoch(spark, seconds, want):
    assert one(spark, T.decode_time(F.lit(seconds), "s", "2000-01-01 12:00:00")) == want
    assert one(spark, T.encode_time(F.lit(str(want)).cast("timestamp_ntz"), "s", "2000-01-01 12:00:00")) == seconds


def test_mid_time(spark):
    start, end = (F.lit(x).cast("timestamp_ntz") for x in ("2025-01-01 00:00:00", "2025-01-01 00:00:09.5"))
    assert one(spark, T.mid_time(start, end)) == dt.datetime(2025, 1, 1, 0, 0, 4, 750000)


def test_field_name(spark):
    url = "https://x/p/T/wvl1/532/lvt1/150/lv1/118/r/2025-01-01T00:00/s/PT003H00M.grib2"
    assert one(spark, V.field_name_of_url(F.lit(url))) == "T_wavelength-532_level-118_step-003.grib2"


def test_metadata_numbers(spark):
    text = F.lit('<g name="Gain">0.01</g><t name="Accumulation time" unit="h">24</t>')
    assert one(spark, V.tagged_number(text, 'Gain">')) == 0.01
    assert one(spark, V.tagged_number(text, 'unit="h">')) == 24
    assert one(spark, V.tagged_number(text, 'Offset">')) is None


@pytest.mark.parametrize(("name", "want"), [("IASI_xxx_1C_M01_2025", "Metop-B"), ("IASI_xxx_1C_M09_2025", None)])
def test_platform(spark, name, want):
    assert one(spark, V.platform_name(F.lit(name))) == want


@pytest.mark.parametrize(
    ("name", "want"),
    [("VOLUNTEER OBSERVING SHIPS", {"ships", "obs"}), ("PROFILING FLOATS AND GLIDERS (GENERIC)", {"gliders"}), ("ship", set())],
)
def test_platform_classes(spark, name, want):
    assert set(one(spark, V.platform_classes(F.lit(name)))) == want


@pytest.mark.parametrize(("value", "want"), [(-1.0, None), (65535.0, None), (float("nan"), None), (2.5, 2.5)])
def test_sentinels(spark, value, want):
    assert one(spark, V.fill_to_null(F.lit(value), -1.0, 65535.0)) == want


@pytest.mark.parametrize(("value", "want"), [(273.15, 273.25), (101325.0, float("inf"))])
def test_half(spark, value, want):
    assert one(spark, V.to_half(F.lit(value))) == want


def test_half_query_equals_its_sql_on_odd_values(spark, tmp_path):
    inf, nan = float("inf"), float("nan")
    values = [None, nan, inf, 0.0, -0.0, 65519.99, 65520.0, 2048.5, 2049.5, 32784.0, 32816.0, 1023.75, 1e-9, 2.0**-24, 1.5 * 2.0**-24, 2.5 * 2.0**-24, 6.1e-5, *(2.0**k for k in range(-26, 17)), *(2.0**k * (1 - 2.0**-53) for k in range(-26, 17)), *(2.0**k * (1 + 2.0**-52) for k in range(-26, 17))]
    flags = [None, nan, inf, -inf, 127.0, 127.9, 128.0, -128.9, -129.0, -0.9]
    rows = [(k, 1, 1, v, flags[k % len(flags)]) for k, v in enumerate(values)]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_extendedprice double, l_quantity double").write.parquet(f"{tmp_path}/parts")
    con = duckdb.connect()
    con.execute(f"COPY (SELECT * FROM '{tmp_path}/parts/*.parquet') TO '{tmp_path}/lineitem.parquet'")
    want = connect(tmp_path).execute(ORACLE["FN21_narrow_to_half"]).fetchall()
    got = [tuple(r) for r in QUERIES["FN21_narrow_to_half"](spark, str(tmp_path)).collect()]
    # as text, so that negative zero and NaN count
    assert sorted(map(str, got)) == sorted(map(str, want))


@pytest.mark.parametrize(("value", "want"), [(273.15, 273.0), (101325.0, 101376.0), (0.1, 0.0999755859375), (0.0, 0.0)])
def test_bit_rounding(spark, value, want):
    assert one(spark, V.bit_rounded(F.lit(value))) == want


def test_axis(spark):
    assert one(spark, V.regular_axis(-10, 10, 5, falling=True)) == [10.0, 5.0, 0.0, -5.0, -10.0]
