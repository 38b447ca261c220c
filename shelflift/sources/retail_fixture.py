"""The eight source tables derived from the TPC-H-like test tables.

Used by the registered queries and the tests. Only integer arithmetic (one floor over doubles for money)
so that another engine can derive identical rows. See FIXTURES.md for the definition.
"""

from __future__ import annotations

from collections.abc import Mapping
from threading import RLock

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelflift.schema import SOURCE_TABLES
from shelflift.sources.tables import scratch_path

# Fixed values of the fixture.
INCOMES = ["Under 15K", "15-24K", "25-34K", "35-49K", "50-74K", "75-99K", "100-124K", "125-149K",
           "150-174K", "175-199K", "200-249K", "250K+"]
AGES = ["19-24", "25-34", "35-44", "45-54", "55-64", "65+"]
HOMEOWNERS = ["Homeowner", "Renter", "Unknown", "Probable Owner", "Probable Renter"]
KIDS = ["None/Unknown", "1", "2", "3+"]
COMPOSITIONS = ["2 Adults No Kids", "2 Adults Kids", "Single Female", "Single Male", "1 Adult Kids", "Unknown"]
MARITAL = ["A", "B", "U"]
SIZES = ["1", "2", "3", "4", "5+"]


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _day(ts: str) -> Column:
    return F.expr(f"cast((cast(datediff({ts}, date'1995-01-01') as bigint) * 711) div 2405 + 1 as int)")


def _week(day: Column) -> Column:
    return (F.floor((day - 1) / 7) + 1).cast("int")


def _product(partkey: str, orderkey: str) -> Column:
    """Ten parts make one product; every 25th product is rarely sold, its other lines go to its neighbour."""
    return F.expr(
        f"CASE WHEN ({partkey} div 10) % 25 = 24 AND {orderkey} % 61 <> 0 "
        f"THEN {partkey} div 10 - 1 ELSE {partkey} div 10 END"
    )


def _dollars(cents: Column) -> Column:
    return (cents.cast("decimal(12,0)") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(10,2)")


def _conform(df: DataFrame, table: str) -> DataFrame:
    return df.selectExpr(*[
        f"cast({name} as {kind}) as {name}"
        for name, kind in (c.strip().rsplit(" ", 1) for c in SOURCE_TABLES[table].split(", "))
    ])


# Departments whose promotions take their sales from similar products: in an event week of a sub-category and store, every second product is on
# display and sells twice as much, the others a tenth.
TAKING = ["PROMO", "ECONOMY"]
EVENT = "(sub * 7 + store_id * 11 + week_no * 3) % 5 = 0"


def _taking(part: DataFrame) -> DataFrame:
    """(n, sub) of the products of those departments."""
    return part.filter("p_partkey % 10 = 0 AND (p_partkey div 10) % 40 < 35").filter(F.col("p_type").isin(TAKING)).selectExpr(
        "p_partkey div 10 as n", "p_size % 12 as sub")


def transaction_data(lineitem: DataFrame, orders: DataFrame, part: DataFrame) -> DataFrame:
    day = _day("o_orderdate")
    lines = lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey).withColumns({
        "n": _product("l_partkey", "l_orderkey"), "store_id": F.expr("l_orderkey % 5"), "week_no": _week(day),
        "cents": F.expr("cast(floor(l_extendedprice * (1 - l_discount) / 10 + 0.5) as bigint)"),
    }).join(_taking(part), "n", "left")
    event = F.expr(f"sub IS NOT NULL AND {EVENT}")
    cents = F.when(event & (F.col("n") % 2 == 0), F.col("cents") * 2).when(event, F.expr("cents div 10")).otherwise(F.col("cents"))
    rows = lines.withColumn("cents", cents).select(
        F.col("o_custkey").alias("household_key"),
        F.col("l_orderkey").alias("basket_id"),
        day.alias("day"),
        F.col("n").alias("product_id"),
        F.expr("CASE WHEN l_orderkey % 97 = 0 THEN 0 ELSE cast(l_quantity as int) END").alias("quantity"),
        _dollars(F.expr("CASE WHEN l_orderkey % 89 = 0 THEN 0 ELSE cents END")).alias("sales_value"),
        "store_id",
        _dollars(F.expr(
            "CASE WHEN (l_orderkey + l_linenumber) % 1009 = 0 THEN 399 "
            "ELSE -floor(l_extendedprice * l_discount / 10 + 0.5) END")).alias("retail_disc"),
        F.expr("CASE WHEN l_orderkey % 499 = 0 THEN 2475 "
               "ELSE (l_orderkey % 24) * 100 + l_linenumber * 7 END").alias("trans_time"),
        "week_no",
        _dollars(F.expr("CASE WHEN l_orderkey % 11 = 0 THEN -100 ELSE 0 END")).alias("coupon_disc"),
        _dollars(F.expr("CASE WHEN l_orderkey % 33 = 0 THEN -50 ELSE 0 END")).alias("coupon_match_disc"),
    )
    return _conform(rows, "transaction_data")


def product(part: DataFrame) -> DataFrame:
    rows = part.filter("p_partkey % 10 = 0").selectExpr(
        "p_partkey div 10 as product_id",
        "p_size as manufacturer",
        "CASE WHEN (p_partkey div 10) % 40 = 36 THEN 'KIOSK-GAS' WHEN (p_partkey div 10) % 40 = 37 THEN '' "
        "WHEN (p_partkey div 10) % 40 = 38 THEN 'MISC SALES TRAN' "
        "WHEN (p_partkey div 10) % 40 = 39 THEN 'COUP/STR & MFG' ELSE p_type END as department",
        "CASE WHEN (p_partkey div 10) % 3 = 0 THEN 'Private' ELSE 'National' END as brand",
        "CASE WHEN (p_partkey div 10) % 40 = 35 THEN 'NO COMMODITY DESCRIPTION' ELSE p_brand END as commodity_desc",
        "concat('SUB ', p_size % 12) as sub_commodity_desc",
        "concat(p_size, ' OZ') as curr_size_of_product",
    )
    return _conform(rows, "product")


def causal_data(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """Every shipped line places its product for some weeks from the ship week on; most codes are '0'.

    Products of the departments with events are placed in their event weeks instead.
    """
    taking = _taking(part)
    events = (
        taking.filter("n % 2 = 0").withColumn("store_id", F.explode(F.sequence(F.lit(0), F.lit(3))))
        .withColumn("week_no", F.explode(F.sequence(F.lit(9), F.lit(101)))).filter(EVENT)
        .select(F.col("n").alias("product_id"), "store_id", "week_no", F.lit("3").alias("display"), F.lit("0").alias("mailer"))
    )
    line = lineitem.filter("l_orderkey % 5 < 4").select(
        _product("l_partkey", "l_orderkey").alias("product_id"),
        F.expr("l_orderkey % 5").alias("store_id"),
        _week(_day("least(l_shipdate, timestamp_ntz'2001-08-01 00:00:00')")).alias("first_week"),
        F.expr("(l_partkey * 31 + l_orderkey * 17 + l_linenumber * 7) % 23").alias("h"),
    )
    always = F.col("product_id") % 13 == 0
    weeks = F.when(always, 8).otherwise(F.col("h") % 3 + 1)
    rows = line.select(
        "product_id",
        "store_id",
        F.explode(F.sequence(F.col("first_week"), (F.col("first_week") + weeks - 1).cast("int"))).alias("week_no"),
        F.when(always, "3").otherwise(F.expr(
            "CASE WHEN h = 0 THEN '1' WHEN h = 1 THEN '3' WHEN h = 2 THEN '7' WHEN h = 3 THEN 'A' "
            "WHEN h = 8 AND product_id % 7 = 0 THEN '10' ELSE '0' END"
        )).alias("display"),
        F.expr(
            "CASE WHEN h IN (3, 4) THEN 'A' WHEN h = 5 THEN 'D' WHEN h = 6 THEN 'H' "
            "WHEN h = 7 AND product_id % 5 = 0 THEN 'X' WHEN h = 9 AND product_id % 11 = 0 THEN 'Łx' ELSE '0' END"
        ).alias("mailer"),
    ).filter("week_no BETWEEN 9 AND 101").join(taking.select(F.col("n").alias("product_id")), "product_id", "left_anti")
    return _conform(rows.unionByName(events), "causal_data")


def campaign_desc(nation: DataFrame) -> DataFrame:
    rows = nation.selectExpr("cast(n_nationkey as int) + 1 as c").selectExpr(
        "CASE c % 3 WHEN 0 THEN 'TypeA' WHEN 1 THEN 'TypeB' ELSE 'TypeC' END as description",
        "c as campaign",
        "224 + (c - 1) * 19 as start_day",
        "CASE WHEN c = 25 THEN 719 ELSE 224 + (c - 1) * 19 + 32 + (c % 3) * 7 END as end_day",
    )
    return _conform(rows, "campaign_desc")


def campaign_table(orders: DataFrame) -> DataFrame:
    """Two thirds of the customers are targeted, each by the campaigns that some of their orders point to."""
    rows = orders.filter("o_custkey % 3 <> 0 AND o_orderkey % 3 = 0").selectExpr(
        "o_custkey as household_key", "(o_orderkey div 3) % 25 + 1 as campaign"
    ).distinct().withColumn(
        "description", F.expr("CASE campaign % 3 WHEN 0 THEN 'TypeA' WHEN 1 THEN 'TypeB' ELSE 'TypeC' END")
    )
    return _conform(rows, "campaign_table")


def coupon(part: DataFrame) -> DataFrame:
    """One coupon per part; every 20th row appears twice."""
    rows = part.selectExpr(
        "(p_partkey % 25 + 1) * 10000 + p_size % 4 + 1 as coupon_upc",
        "p_partkey div 10 as product_id",
        "p_partkey % 25 + 1 as campaign",
        "explode(CASE WHEN p_partkey % 20 = 0 THEN array(1, 2) ELSE array(1) END) as copy",
    )
    return _conform(rows, "coupon")


def coupon_redempt(targets: DataFrame, campaigns: DataFrame) -> DataFrame:
    rows = targets.filter("(household_key + campaign) % 4 = 0").join(
        campaigns.select("campaign", "start_day", "end_day"), "campaign"
    ).selectExpr(
        "household_key",
        "CASE WHEN household_key % 97 = 5 THEN end_day + 3 ELSE start_day + household_key % 20 END as day",
        "CASE WHEN household_key % 89 = 7 THEN campaign * 10000 + 99 "
        "ELSE campaign * 10000 + 1 + household_key % 4 END as coupon_upc",
        "campaign",
    )
    return _conform(rows, "coupon_redempt")


def hh_demographic(customer: DataFrame) -> DataFrame:
    q = F.expr("c_custkey div 3")
    rows = customer.filter("c_custkey % 3 = 1").select(
        _pick(AGES, q % 6).alias("age_desc"),
        _pick(MARITAL, q % 3).alias("marital_status_code"),
        _pick(INCOMES, q % 12).alias("income_desc"),
        _pick(HOMEOWNERS, q % 5).alias("homeowner_desc"),
        _pick(COMPOSITIONS, F.expr("(c_custkey div 6) % 6")).alias("hh_comp_desc"),
        _pick(SIZES, q % 5).alias("household_size_desc"),
        _pick(KIDS, q % 4).alias("kid_category_desc"),
        F.col("c_custkey").alias("household_key"),
    )
    return _conform(rows, "hh_demographic")


# Folder of each derived table, by application, data folder and table.
_LOADED: dict[tuple[str, str, str], str] = {}
_LOADING: dict[tuple[str, str, str], RLock] = {}


class RetailTables(Mapping):
    """The eight source tables of one data folder.

    A table is derived when it is first asked for and loaded into the scratch folder, so that queries read
    typed, prunable files as they would after loading the original CSVs.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        def read(name: str) -> DataFrame:
            return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")

        def read_lines(*columns: str) -> DataFrame:
            # A small test file holds a single row group, which one task would read and derive everything from. Larger ones are read in enough splits.
            lines, tasks = read("lineitem").select(*columns), spark.sparkContext.defaultParallelism
            return lines if lines.rdd.getNumPartitions() >= tasks else lines.repartition(tasks)

        self._build = {
            "transaction_data": lambda: transaction_data(read_lines(
                "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
            ), read("orders"), read("part")),
            "product": lambda: product(read("part")),
            "hh_demographic": lambda: hh_demographic(read("customer")),
            "campaign_table": lambda: campaign_table(read("orders")),
            "campaign_desc": lambda: campaign_desc(read("nation")),
            "coupon": lambda: coupon(read("part")),
            "coupon_redempt": lambda: coupon_redempt(self["campaign_table"], self["campaign_desc"]),
            "causal_data": lambda: causal_data(
                read_lines("l_orderkey", "l_partkey", "l_linenumber", "l_shipdate"), read("part")),
        }
        self._spark, self._sf_dir = spark, sf_dir

    def __getitem__(self, name: str) -> DataFrame:
        key = (self._spark.sparkContext.applicationId, self._sf_dir, name)
        # Threads that build layers at the same time load a table once.
        with _LOADING.setdefault(key, RLock()):
            if key not in _LOADED:
                path = scratch_path(self._spark, f"raw-{name}")
                self._build[name]().write.parquet(path)
                _LOADED[key] = path
        return self._spark.read.parquet(_LOADED[key])

    def __iter__(self):
        return iter(self._build)

    def __len__(self) -> int:
        return len(self._build)


def retail_tables(spark: SparkSession, sf_dir: str) -> Mapping[str, DataFrame]:
    return RetailTables(spark, sf_dir)
