"""Explicit schemas of the inputs (no inference job, stable types under
schema drift: a column missing from one snapshot reads as null)."""

from __future__ import annotations

from pyspark.sql import types as T

S, D, L, B, I = T.StringType(), T.DoubleType(), T.LongType(), T.BooleanType(), T.IntegerType()


def _f(name: str, dt: T.DataType) -> T.StructField:
    return T.StructField(name, dt, True)


# Attributes of one listing in a snapshot.
LISTING_SCHEMA = T.StructType(
    [
        _f("propertyCode", S),
        _f("thumbnail", S),
        _f("externalReference", S),
        _f("numPhotos", L),
        _f("floor", S),
        _f("price", D),
        _f("propertyType", S),
        _f("operation", S),
        _f("size", D),
        _f("exterior", B),
        _f("rooms", L),
        _f("bathrooms", L),
        _f("address", S),
        _f("province", S),
        _f("municipality", S),
        _f("district", S),
        _f("country", S),
        _f("neighborhood", S),
        _f("latitude", D),
        _f("longitude", D),
        _f("showAddress", B),
        _f("url", S),
        _f("distance", S),
        _f("hasVideo", B),
        _f("status", S),
        _f("newDevelopment", B),
        _f("hasLift", B),
        _f("priceByArea", D),
        _f("detailedType", T.StructType([_f("subTypology", S), _f("typology", S)])),
        _f(
            "parkingSpace",
            T.StructType([_f("hasParkingSpace", B), _f("isParkingSpaceIncludedInPrice", B), _f("parkingSpacePrice", D)]),
        ),
        _f("suggestedTexts", T.StructType([_f("subtitle", S), _f("title", S)])),
        _f("hasPlan", B),
        _f("has3DTour", B),
        _f("has360", B),
        _f("hasStaging", B),
        _f("topNewDevelopment", B),
        _f("newDevelopmentFinished", B),
    ]
)

# Yearly family-income CSV (header names as in the files;
# the CSV reader applies the schema by position).
INCOME_CSV_SCHEMA = T.StructType(
    [
        _f("Any", I),
        _f("Codi_Districte", I),
        _f("Nom_Districte", S),
        _f("Codi_Barri", I),
        _f("Nom_Barri", S),
        _f("Població", I),
        _f("Índex RFD Barcelona = 100", D),
    ]
)

# Nested income documents: one per neighbourhood, yearly values in an array.
INCOME_DOC_SCHEMA = T.StructType(
    [
        _f("neigh_name", S),
        _f("info", T.ArrayType(T.StructType([_f("year", I), _f("RFD", D)]))),
    ]
)

# Household occupancy CSV (UTF-8 with BOM).
OCCUPANCY_CSV_SCHEMA = T.StructType(
    [
        _f("Any", I),
        _f("Codi_Districte", I),
        _f("Nom_Districte", S),
        _f("Codi_Barri", I),
        _f("Nom_Barri", S),
        _f("Poblacio", I),
        _f("Domicilis", I),
        _f("Ocupacio_mitjana_(persones_ per_domicili)", D),
    ]
)

# Pair lookup CSV (district, neighbourhood) -> ids.
PAIR_LOOKUP_SCHEMA = T.StructType(
    [
        _f("district", S),
        _f("neighborhood", S),
        _f("district_n_reconciled", S),
        _f("district_n", S),
        _f("district_id", S),
        _f("neighborhood_n_reconciled", S),
        _f("neighborhood_n", S),
        _f("neighborhood_id", S),
    ]
)

# Name lookups (JSON lines), income side and listing side.
INCOME_NAME_LOOKUP_SCHEMA = T.StructType(
    [_f("_id", S), _f("neighborhood", S), _f("neighborhood_name", S), _f("neighborhood_reconciled", S)]
)
RENT_NAME_LOOKUP_SCHEMA = T.StructType([_f("_id", S), _f("ne", S), _f("ne_n", S), _f("ne_re", S)])

# District lookups with an array of neighbourhood ids.
INCOME_DISTRICT_LOOKUP_SCHEMA = T.StructType(
    [
        _f("_id", S),
        _f("district", S),
        _f("district_name", S),
        _f("district_reconciled", S),
        _f("neighborhood_id", T.ArrayType(S)),
    ]
)
RENT_DISTRICT_LOOKUP_SCHEMA = T.StructType(
    [_f("_id", S), _f("di", S), _f("di_n", S), _f("di_re", S), _f("ne_id", T.ArrayType(S))]
)

# Older document model: listing with a year -> income object.
LISTING_RFD_MAP_SCHEMA = T.StructType(
    [_f("district", S), _f("neighborhood", S), _f("rfd", T.MapType(S, D))]
)

# KPI result files.
KPI1_SCHEMA = T.StructType([_f("date", S), _f("listings_count", L)])
KPI2_SCHEMA = T.StructType([_f("neighborhood", S), _f("mean_price", D), _f("rfd", D)])
KPI3_SCHEMA = T.StructType([_f("neighborhood", S), _f("inhabitants_family", D), _f("rfd", D)])


# The driver's synthetic tables (types as stored; the
# timestamps carry no zone, so they are timestamp_ntz).
DRIVER_TABLES: dict[str, T.StructType] = {
    "region": T.StructType([_f("r_regionkey", I), _f("r_name", S)]),
    "nation": T.StructType([_f("n_nationkey", I), _f("n_name", S), _f("n_regionkey", I)]),
    "customer": T.StructType(
        [_f("c_custkey", L), _f("c_name", S), _f("c_nationkey", I), _f("c_acctbal", D), _f("c_mktsegment", S)]
    ),
    "supplier": T.StructType([_f("s_suppkey", L), _f("s_name", S), _f("s_nationkey", I), _f("s_acctbal", D)]),
    "orders": T.StructType(
        [
            _f("o_orderkey", L),
            _f("o_custkey", L),
            _f("o_orderstatus", S),
            _f("o_totalprice", D),
            _f("o_orderdate", T.TimestampNTZType()),
            _f("o_orderpriority", S),
        ]
    ),
    "lineitem": T.StructType(
        [
            _f("l_orderkey", L),
            _f("l_partkey", L),
            _f("l_suppkey", L),
            _f("l_linenumber", I),
            _f("l_quantity", D),
            _f("l_extendedprice", D),
            _f("l_discount", D),
            _f("l_tax", D),
            _f("l_returnflag", S),
            _f("l_linestatus", S),
            _f("l_shipdate", T.TimestampNTZType()),
        ]
    ),
    "events": T.StructType(
        [
            _f("event_id", L),
            _f("ts", T.TimestampNTZType()),
            _f("user_id", L),
            _f("event_type", S),
            _f("value", D),
            _f("props", S),
        ]
    ),
}
