"""Observations from star-schema tables: lineitem x part x supplier x nation x region.

A brand stands for the mineral, a region for the departamento, and the summed quantity of a
ship month for the month's production. Official totals leave out every 40th order, so they
disagree with the regional detail by a few percent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prodseries.functions.measures import month_index, month_start
from prodseries.schemas import LONG_COLUMNS, MONTH_ABBREVIATIONS

# Period tokens carry two year digits and assume the century 2000.
MONTH_SHIFT = 276
FIRST_YEAR = 2018
UNITS_BY_REMAINDER = ["tm.f", "kg.f", "grs.f"]

# Column groups of the generated sheet, in order; the total closes each brand's block.
REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def last_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest observed month, from the ship dates alone."""
    latest = table(spark, sf_dir, "lineitem").agg(F.max("l_shipdate").alias("latest"))
    return latest.select(F.add_months(month_start(F.col("latest")), MONTH_SHIFT).alias("period_date"))


def monthly_quantities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detail and official quantity per month, brand and supplying nation, with its region.

    One pass over lineitem. It is summed by nation before regions are looked up, so only the
    two joins that need the fact rows see them. No side is hinted: part and supplier grow
    with the data, so whether they are broadcast or shuffled is left to their size.
    """
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate"
    )
    brands = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    official = F.col("l_orderkey") % 40 != 0
    by_nation = (
        items.join(brands, F.col("l_partkey") == F.col("p_partkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy(
            F.add_months(month_start(F.col("l_shipdate")), MONTH_SHIFT).alias("period_date"),
            F.col("p_brand").alias("mineral"),
            "s_nationkey",
        )
        .agg(
            F.sum("l_quantity").alias("detail_value"),
            F.sum(F.when(official, F.col("l_quantity"))).alias("official_value"),
        )
    )
    return (
        by_nation.join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("period_date", "mineral", F.col("r_name").alias("departamento"), "detail_value", "official_value")
    )


def _detail_and_total(monthly: DataFrame) -> DataFrame:
    """Emit each monthly row as detail and as a share of its total, then add the shares up."""
    return (
        monthly.select(
            "period_date",
            "mineral",
            F.inline(
                F.array(
                    F.struct(F.col("departamento"), F.col("detail_value").alias("value")),
                    F.struct(F.lit("Total").alias("departamento"), F.col("official_value").alias("value")),
                )
            ),
        )
        .filter(F.col("value").isNotNull())
        .groupBy("period_date", "mineral", "departamento")
        .agg(F.sum("value").alias("value"))
    )


def brand_number(mineral: Column) -> Column:
    return F.regexp_extract(mineral, r"(\d+)", 1).cast("int")


def unit_of(mineral: Column) -> Column:
    return F.element_at(F.array(*[F.lit(u) for u in UNITS_BY_REMAINDER]), brand_number(mineral) % 3 + 1)


def period_token(date: Column) -> Column:
    names = F.array(*[F.lit(m.capitalize()) for m in MONTH_ABBREVIATIONS])
    return F.concat(F.element_at(names, F.month(date)), F.date_format(date, "yy"))


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The long observation table: one row per month and series, totals included."""
    mineral, departamento, date = F.col("mineral"), F.col("departamento"), F.col("period_date")
    unit = unit_of(mineral)
    computed = {
        "source_dataset": F.lit("lineitem"),
        "period_raw": period_token(date),
        "year": F.year(date),
        "month": F.month(date),
        "series_code": F.concat_ws("_", F.replace(mineral, F.lit("#"), F.lit("")), departamento),
        "series_description": F.concat(
            F.lit("Produccion mensual - "), mineral, F.lit(" - "), departamento, F.lit(" ("), unit, F.lit(")")
        ),
        "unidad": unit,
        "is_missing": F.lit(False),
        "is_invalid_numeric": F.lit(False),
        "value_raw": F.col("value").cast("bigint").cast("string"),
    }
    rows = _detail_and_total(monthly_quantities(spark, sf_dir))
    return rows.select(*[computed[c].alias(c) if c in computed else c for c in LONG_COLUMNS])


def fault_residue(date: Column, brand_no: Column) -> Column:
    """Spreads the seeded faults over months and brands the same way on every engine."""
    return (month_index(date) * 31 + brand_no * 17) % 50


def faulty_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations with one seeded fault per quality rule."""
    obs = observations(spark, sf_dir)
    brand = brand_number(F.col("mineral"))
    residue = fault_residue(F.col("period_date"), brand)
    month = F.date_format("period_date", "yyyy-MM")
    region = F.col("departamento")
    seeded = {
        "mineral": F.when((brand == 7) & (region == "EUROPE"), F.lit(None)).otherwise(F.col("mineral")),
        "unidad": F.when((brand == 11) & (region == "ASIA") & (F.col("month") == 1), "onzas").otherwise(
            F.col("unidad")
        ),
        "value": F.when(residue.isin(0, 3), F.lit(None))
        .when((brand == 5) & (month == "2020-05"), -F.col("value"))
        .otherwise(F.col("value")),
        "month": F.when((brand == 6) & (month == "2021-06"), 13).otherwise(F.col("month")),
        "is_missing": residue == 0,
        "is_invalid_numeric": residue == 3,
        "period_date": F.when((brand == 8) & (month == "2019-08"), F.lit(None)).otherwise(
            F.col("period_date")
        ),
        # March 2020 appears twice.
        "_copy": F.explode(F.when(month == "2020-03", F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))),
    }
    return obs.withColumns(seeded).select(*LONG_COLUMNS)


def _cell_text(value: Column, residue: Column) -> Column:
    """A cell's text with parsing faults seeded on fixed residues."""
    digits = value.cast("bigint").cast("string")
    return (
        F.when(residue == 0, "n.d.")
        .when(residue == 1, "")
        .when(residue == 2, "—")
        .when(residue == 3, "abc")
        .when(residue == 4, "12f")
        .when(residue == 5, F.format_number(value.cast("bigint"), 0))
        .when(residue == 6, F.concat(F.lit("1_"), F.lpad(digits, 9, "0")))
        .when(residue == 7, "inf")
        .when(residue == 8, F.lit(None).cast("string"))
        .when(residue == 9, F.concat(F.lit(" "), digits, F.lit(".25 ")))
        .when(residue == 10, F.concat(F.lit(", "), digits))
        .when(residue == 11, F.concat(digits, F.lit(" ,")))
        .otherwise(digits)
    )


def raw_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The observations laid out as a wide sheet, with damaged headers, cells and tokens.

    The sheet has a fixed number of columns (brands x regions and totals, plus one repeated
    code), so a row is bounded however large lineitem is.
    """
    rows = _detail_and_total(monthly_quantities(spark, sf_dir)).withColumn(
        "brand_no", brand_number(F.col("mineral"))
    )
    areas = F.array(*[F.lit(x) for x in [*REGIONS, "Total"]])
    width = len(REGIONS) + 1
    rows = rows.withColumn(
        "col_ord", ((F.col("brand_no") - 1) * width + F.array_position(areas, F.col("departamento"))).cast("int")
    )

    # Column 3 (the first brand's ASIA) returns as a last column with other values.
    brands = table(spark, sf_dir, "part").select(brand_number(F.col("p_brand")).alias("n"))
    last_column = (brands.agg(F.max("n")).scalar() * width + 1).cast("int")
    rows = rows.select(
        "period_date",
        "brand_no",
        F.inline(
            F.when(
                F.col("col_ord") == 3,
                F.array(
                    F.struct(F.col("col_ord"), F.col("value")),
                    F.struct(last_column.alias("col_ord"), (F.col("value") + 1000).alias("value")),
                ),
            ).otherwise(F.array(F.struct(F.col("col_ord"), F.col("value"))))
        ),
    )

    month = F.date_format("period_date", "yyyy-MM")
    ordinal = (month_index(F.col("period_date")) - FIRST_YEAR * 12 + 1).cast("bigint")

    def line(row_ord, token, extra):
        return F.struct(row_ord.alias("row_ord"), token.alias("token"), F.lit(extra).alias("extra"))

    own = line(ordinal, period_token(F.col("period_date")), 0.0)
    # Two months share one unknown token shape, one month is written a second time.
    lines = (
        F.when(month == "2020-03", F.array(own, line(F.lit(1000).cast("bigint"), F.lit("Mar20"), 1.0)))
        .when(month == "2023-09", F.array(own, line(F.lit(1001).cast("bigint"), F.lit("Set23"), 0.0)))
        .when(month == "2023-04", F.array(own, line(F.lit(1002).cast("bigint"), F.lit("2023-04"), 0.0)))
        .otherwise(F.array(own))
    )
    data = (
        rows.select("period_date", "brand_no", "col_ord", "value", F.inline(lines))
        .select(
            "row_ord",
            "token",
            "col_ord",
            _cell_text(
                F.col("value") + F.col("extra"), fault_residue(F.col("period_date"), F.col("brand_no"))
            ).alias("cell"),
            F.sequence(F.lit(1), last_column).alias("columns"),
        )
        .groupBy("row_ord", "token", "columns")
        .agg(F.map_from_entries(F.collect_list(F.struct("col_ord", "cell"))).alias("by_column"))
        .select(
            "row_ord",
            F.concat(
                F.array("token"),
                F.transform("columns", lambda k: F.element_at("by_column", k)),
            ).alias("cells"),
        )
    )
    return _sheet_header(spark, sf_dir, width, last_column).unionByName(data)


def _sheet_header(spark: SparkSession, sf_dir: str, width: int, last_column: Column) -> DataFrame:
    """Code row and description row, from the brands that exist."""
    brands = table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("mineral")).agg(F.lit(1).alias("_"))
    n = brand_number(F.col("mineral"))
    columns = brands.select(
        "mineral",
        n.alias("brand_no"),
        F.posexplode(F.array(*[F.lit(x) for x in [*REGIONS, "Total"]])).alias("area", "departamento"),
    ).withColumn("col_ord", ((F.col("brand_no") - 1) * width + F.col("area") + 1).cast("int"))
    code = F.concat_ws("_", F.replace(F.col("mineral"), F.lit("#"), F.lit("")), F.col("departamento"))
    described = F.concat(
        F.lit("Producción mensual - "), F.col("mineral"), F.lit(" - "), F.col("departamento"),
        F.lit(" ("), unit_of(F.col("mineral")), F.lit(")"),
    )
    brand, area = F.col("brand_no"), F.col("departamento")
    damaged = (
        F.when((brand == 7) & (area == "EUROPE"), "Sin descripcion")
        .when((brand == 11) & (area == "ASIA"), F.replace(described, unit_of(F.col("mineral")), F.lit("Onzas")))
        .when(area == "AMERICA", F.replace(described, F.lit("ó"), F.lit("�")))
        .when(area == "AFRICA", F.replace(described, F.lit("AFRICA"), F.lit("Hu�nuco")))
        .when(area == "MIDDLE EAST", F.replace(described, F.lit("MIDDLE EAST"), F.lit("MIDDLE \u00a0 EAST")))
        .otherwise(described)
    )
    repeated = F.lit("Produccion mensual - Brand#1 - ASIA repetida (kg.f)")
    titles = columns.select(
        F.inline(
            F.when(
                F.col("col_ord") == 3,
                F.array(
                    F.struct(F.col("col_ord"), code.alias("code"), damaged.alias("description")),
                    F.struct(last_column.alias("col_ord"), code.alias("code"), repeated.alias("description")),
                ),
            ).otherwise(F.array(F.struct(F.col("col_ord"), code.alias("code"), damaged.alias("description"))))
        )
    )
    header = titles.agg(F.array_sort(F.collect_list(F.struct("col_ord", "code", "description"))).alias("h"))
    return header.select(
        F.inline(
            F.array(
                F.struct(
                    F.lit(0).cast("bigint").alias("row_ord"),
                    F.concat(F.array(F.lit("")), F.col("h.code")).alias("cells"),
                ),
                F.struct(
                    F.lit(1).cast("bigint").alias("row_ord"),
                    F.concat(F.array(F.lit("")), F.col("h.description")).alias("cells"),
                ),
            )
        )
    )
