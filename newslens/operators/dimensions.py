"""Seeding dimensions and giving rows their numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslens.operators.dedup import keep_first
from newslens.operators.numbering import number_new_rows
from newslens.operators.upsert import missing

def seed_dimension(target: DataFrame, seeds: DataFrame, keys: list[str], id_column: str) -> DataFrame:
    """Target plus the seeds whose natural key it lacks, numbered after its largest id. Running it again adds nothing. Of
    seeds with one key the first by all columns stays."""
    order = [F.col(c).asc_nulls_last() for c in seeds.columns if c not in keys]
    single = keep_first(seeds, keys, order) if order else seeds.dropDuplicates(keys)
    fresh = number_new_rows(missing(target, single, keys), keys, id_column, target)
    return target.unionByName(fresh, allowMissingColumns=True).select(*target.columns)


def resolve_aliases(companies: DataFrame, seeds: DataFrame) -> DataFrame:
    """Alias seeds (ticker, alias, alias_type) with the company_id of their ticker; unknown tickers fall out."""
    return seeds.join(companies.select("company_id", "ticker"), "ticker").select("company_id", "alias", "alias_type")


def company_seeds(spark) -> DataFrame:
    """Tracked companies of a new installation."""
    columns = "ticker string, company_name string, exchange string, sector string, industry string, country string"
    return spark.createDataFrame([(*row, "US") for row in COMPANIES], columns)


def alias_seeds(spark) -> DataFrame:
    return spark.createDataFrame(list(ALIASES), "ticker string, alias string, alias_type string")


# Tracked companies and the names they are matched by.
COMPANIES = (
    ("AAPL", "Apple Inc.", "NASDAQ", "Technology", "Consumer Electronics"),
    ("MSFT", "Microsoft Corporation", "NASDAQ", "Technology", "Software"),
    ("NVDA", "NVIDIA Corporation", "NASDAQ", "Technology", "Semiconductors"),
    ("TSLA", "Tesla, Inc.", "NASDAQ", "Consumer Cyclical", "Auto Manufacturers"),
    ("AMZN", "Amazon.com, Inc.", "NASDAQ", "Consumer Cyclical", "Internet Retail"),
    ("GOOGL", "Alphabet Inc.", "NASDAQ", "Technology", "Internet Content & Information"),
    ("META", "Meta Platforms, Inc.", "NASDAQ", "Technology", "Internet Content & Information"),
    ("AMD", "Advanced Micro Devices, Inc.", "NASDAQ", "Technology", "Semiconductors"),
    ("INTC", "Intel Corporation", "NASDAQ", "Technology", "Semiconductors"),
    ("NFLX", "Netflix, Inc.", "NASDAQ", "Communication Services", "Entertainment"),
    ("ORCL", "Oracle Corporation", "NYSE", "Technology", "Software"),
    ("IBM", "International Business Machines Corporation", "NYSE", "Technology", "Information Technology Services"),
)
ALIASES = (
    ("AAPL", "Apple", "short_name"),
    ("MSFT", "Microsoft", "short_name"),
    ("NVDA", "NVIDIA", "short_name"),
    ("TSLA", "Tesla", "short_name"),
    ("AMZN", "Amazon", "short_name"),
    ("GOOGL", "Google", "short_name"),
    ("GOOGL", "Alphabet", "short_name"),
    ("META", "Meta", "short_name"),
    ("META", "Facebook", "legacy_name"),
    ("AMD", "AMD", "ticker_name"),
    ("AMD", "Advanced Micro Devices", "short_name"),
    ("INTC", "Intel", "short_name"),
    ("NFLX", "Netflix", "short_name"),
    ("ORCL", "Oracle", "short_name"),
    ("IBM", "IBM", "ticker_name"),
    ("IBM", "International Business Machines", "short_name"),
)
