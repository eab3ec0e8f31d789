"""Minute bars from one CSV file per ticker, with table names and tags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import clean_name, file_stem
from tidemark.schema import TABLE, TS

BAR_SCHEMA = (
    f"`{TS}` timestamp_ntz, open double, high double, low double, close double, volume bigint"
)

# Companies of the tickers, and the index lists a ticker is tagged with.
COMPANIES = {
    "mmm": "3m", "axp": "american express", "aapl": "apple", "ba": "boeing", "cat": "caterpillar",
    "cvx": "chevron", "csco": "cisco", "ko": "coca-cola", "dis": "disney", "dwdp": "dowdupont inc",
    "xom": "exxon mobil", "ge": "general electric", "gs": "goldman sachs", "hd": "home depot",
    "ibm": "ibm", "intc": "intel", "jnj": "johnson and johnson", "jpm": "jpmorgan chase",
    "mcd": "mcdonald", "mrk": "merck", "msft": "microsoft", "nke": "nike", "pfe": "pfizer",
    "pg": "procter and gamble", "trv": "travelers companies inc", "utx": "united technologies",
    "unh": "unitedhealth", "vz": "verizon", "v": "visa", "wmt": "walmart",
}
NYSE = [
    "axp", "ba", "cat", "cvx", "dd", "dis", "ge", "gs", "hd", "ibm", "jnj", "jpm", "ko", "mcd", "mmm", "mrk",
    "nke", "pfe", "pg", "trv", "unh", "utx", "v", "vz", "wmt", "xom",
]
NASDAQ = [
    "aapl", "csco", "intc", "msft",
]
DOW = [
    "aapl", "axp", "ba", "cat", "csco", "cvx", "dd", "dis", "ge", "gs", "hd", "ibm", "intc", "jnj", "jpm", "ko",
    "mcd", "mmm", "mrk", "msft", "nke", "pfe", "pg", "trv", "unh", "utx", "v", "vz", "wmt", "xom",
]


def company_of(ticker: Column) -> Column:
    """Company of a ticker; the ticker itself if it is not listed."""
    known = F.create_map(*[F.lit(x) for pair in COMPANIES.items() for x in pair])
    return F.coalesce(F.try_element_at(known, ticker), ticker)


def table_name_of(ticker: Column) -> Column:
    return F.concat(F.lit("stocks."), clean_name(company_of(ticker)))


def name_map(df: DataFrame, ticker: str, mapping: DataFrame, company: str = "company") -> DataFrame:
    """Company by a mapping table ``(ticker, company)``; unknown tickers keep their own name."""
    from tidemark.session import checked_broadcast

    side = mapping.select(F.col("ticker").alias("_ticker"), F.col("company").alias("_company"))
    joined = df.join(checked_broadcast(side), F.col(ticker) == F.col("_ticker"), "left")
    return joined.withColumn(company, F.coalesce("_company", F.col(ticker))).drop("_ticker", "_company")


def read_minutes(
    spark: SparkSession,
    folder: str,
    schema: str = BAR_SCHEMA,
    header: bool = False,
    ticker: Column | None = None,
) -> DataFrame:
    """All CSV files of a folder (unzipped before), each row with ticker and ``$table``.

    The ticker is the file name unless another expression over ``_metadata`` is given.
    """
    rows = (
        spark.read.schema(schema).option("header", header).option("mode", "FAILFAST")
        .option("recursiveFileLookup", True).csv(folder)
    )
    ticker = file_stem(F.col("_metadata.file_name")) if ticker is None else ticker
    return rows.select("*", ticker.alias("ticker")).withColumn(TABLE, table_name_of(F.col("ticker")))


def ticker_tags(tables: DataFrame) -> DataFrame:
    """Tags per (``$table``, ticker): the ticker and the lists it belongs to."""
    ticker = F.col("ticker")
    listed = lambda names, *tags: F.when(
        ticker.isin(names), F.array(*[F.lit(t) for t in tags])
    ).otherwise(F.array().cast("array<string>"))
    tags = F.concat(
        F.array(ticker), listed(DOW, "dji", "usd"), listed(NYSE, "nyse"), listed(NASDAQ, "nasdaq")
    )
    return (
        tables.select(F.col(f"`{TABLE}`").alias("alias"), "ticker")
        .distinct()
        .select("alias", F.lit("table").alias("entry_type"), F.explode(tags).alias("tag"))
        .distinct()
    )
