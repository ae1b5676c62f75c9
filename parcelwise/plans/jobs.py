"""The four jobs from raw files to star schema, each a chain of whole-table operators.

    python -m parcelwise.plans.jobs check --raw DIR --out DIR
    python -m parcelwise.plans.jobs stage --raw DIR --out DIR
    python -m parcelwise.plans.jobs clean --raw STAGED --out DIR
    python -m parcelwise.plans.jobs load  --raw CLEANED --out DIR
    python -m parcelwise.plans.jobs collect --raw MONTHLY --out DIR

With ``--jdbc URL`` the tables of stage, clean and load are read from and written to a database instead of
Parquet, as ``SCHEMA.table``: the folders then name schemas. ``collect`` puts monthly listing files into the
two files that stage reads.

Every job reads tables it does not write, so it can be run again with the same result.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelwise.operators.demography import merge_demography
from parcelwise.operators.imputation import idw_impute, impute_amenities, impute_building
from parcelwise.operators.quality import (
    DEMOGRAPHY_RULES,
    LISTING_RULES,
    POI_RULES,
    QualityError,
    RuleSet,
    enforce_verdicts,
    gate_report,
    missing_columns,
    month_gaps,
    quality_recheck,
    quality_report,
    validate_rows,
)
from parcelwise.operators.staging import stage_demography, stage_listings, stage_poi
from parcelwise.operators.star import (
    LISTING_KEY,
    dim_building,
    dim_demography,
    dim_infrastructure,
    dim_time,
    dim_unit,
    fact_offers,
    with_row_id,
)
from parcelwise.sources.files import (
    DEMOGRAPHY_GLOB,
    LISTING_FILES,
    POI_FILES,
    list_delimited,
    read_delimited,
    read_demography,
    read_listings,
    read_monthly_listings,
    read_poi,
    write_rejects,
    write_table,
)
from parcelwise.sources.jdbc import read_jdbc, write_jdbc
from parcelwise.sources.observed import MOST_FILES, RowCounts, files_report, watch_files
from parcelwise.sources.scratch import scratch_folder, written

Save = Callable[[DataFrame, str], None]
FILE, POSITION = "source_file", "_position"


def parquet_in(folder: str, partition_by: Mapping[str, tuple[str, ...]] | None = None) -> Save:
    """A sink that writes each named table as Parquet under ``folder``."""
    return lambda df, name: write_table(df, f"{folder}/{name}", (partition_by or {}).get(name, ()))


def jdbc_in(url: str, schema: str, properties: Mapping[str, str] | None = None, mode: str = "overwrite") -> Save:
    """A sink that fills each named table of a database schema."""
    return lambda df, name: write_jdbc(df, url, f"{schema}.{name}", mode, properties=properties)


def collect(spark: SparkSession, raw: str, out: str) -> None:
    """Monthly listing files to one file per kind of offer, as folders of text that ``stage`` reads."""
    rows = read_monthly_listings(spark, f"{raw}/*.csv").drop(FILE)
    for kind, name in LISTING_FILES.items():
        own = rows.filter(F.col("listing_type") == kind).drop("listing_type")
        own.write.mode("overwrite").option("header", True).option("escape", '"').csv(f"{out}/{name}")


def check(spark: SparkSession, raw: str, rejects: str) -> dict[str, tuple[int, int]]:
    """Validate the raw files, write what is rejected, and return (accepted, rejected) rows.

    Every file is looked at by its own header, and the rejects are written in any case. Then it fails, naming
    all files of all sources that are absent or empty, lack a required column or have no acceptable row.
    """
    sources: dict[str, tuple[list[str], list[str], RuleSet, str]] = {
        "listings": (list(LISTING_FILES.values()), list(LISTING_FILES.values()), LISTING_RULES, ","),
        "demography": ([DEMOGRAPHY_GLOB], [], DEMOGRAPHY_RULES, ","),
        "poi": (list(POI_FILES.values()), list(POI_FILES.values()), POI_RULES, ";"),
    }
    result, problems = {}, []
    for name, (globs, expected, rules, sep) in sources.items():
        found = list_delimited(spark, [f"{raw}/{g}" for g in globs], sep)
        present = {part for f in found for part in f.path.split("/")}  # a folder of text counts by its name
        problems += [f"{file}: no such file" for file in expected if file not in present]
        if not expected and not found:
            problems.append(f"{globs[0]}: no such file")
        absent = {f.name: missing_columns(f.columns, rules) if f.columns else [] for f in found}
        usable = [f for f in found if f.columns and not absent[f.name]]
        listed = spark.createDataFrame([(n, ", ".join(c)) for n, c in absent.items()], f"{FILE} string, absent string")
        if usable:
            rows = read_delimited(spark, [], sep, file_column=FILE, position_column=POSITION, files=usable)
            # Written once, so that counts, rejects and duplicates all see the same positions.
            placed = written(rows, f"{scratch_folder(spark)}/{name}")
            validated = validate_rows(placed, rules, [POSITION], [FILE])
            names = [f.name for f in usable]
            counts, few = RowCounts(), len(names) <= MOST_FILES
            watched = watch_files(counts, validated, name, names, FILE) if few else validated
            write_rejects(watched.drop(POSITION), f"{rejects}/{name}", sep, FILE)
            # The counts come out of that write; only very many files are counted by another query.
            report = files_report(counts, validated, name, names, FILE) if few else quality_report(validated, FILE)
        else:
            report = spark.createDataFrame([], f"{FILE} string, rows_ok long, rows_rejected long")
        try:
            result[name] = enforce_verdicts(gate_report(report, listed, FILE), FILE)
        except QualityError as error:
            problems.append(str(error))
    if problems:
        raise QualityError("; ".join(problems))
    return result


def stage(spark: SparkSession, raw: str, save: Save) -> dict[str, int]:
    """Raw files to typed tables ``listings``, ``demography`` and ``poi``; returns their rows, counted while they are written."""
    counts = RowCounts()
    put = lambda df, name: save(counts.watch(df, name), name)
    put(stage_listings(read_listings(spark, raw)), "listings")
    # Of files that overlap the one of the later years wins: the names end in the years they cover.
    people = read_demography(spark, raw).withColumn("_age", -F.regexp_extract(FILE, r"(\d+)\D*$", 1).try_cast("int"))
    put(stage_demography(people, ["_age", FILE]), "demography")
    put(stage_poi(read_poi(spark, raw)), "poi")
    return {name: counts.of(name)["rows"] for name in counts}


def clean_listings(listings: DataFrame, order=LISTING_KEY) -> DataFrame:
    """Fill distances, building traits and amenities, then check area and price again.

    Each step writes what it fills and the next one reads that, so that plans stay short
    and no step is computed twice.
    """
    folder = scratch_folder(listings.sparkSession)
    steps = {"distances": idw_impute, "buildings": impute_building, "amenities": impute_amenities}
    for name, fill in steps.items():
        listings = written(fill(listings, order=order), f"{folder}/{name}")
    return quality_recheck(listings)


def clean(spark: SparkSession, demography: DataFrame, listings: DataFrame, save: Save) -> DataFrame:
    """Staged to cleaned tables; returns the gaps between listing months."""
    save(merge_demography(demography), "demography")
    cleaned = clean_listings(listings)
    save(cleaned, "listings")
    return month_gaps(cleaned)


def load(spark: SparkSession, demography: DataFrame, listings: DataFrame, save: Save, keys=LISTING_KEY) -> None:
    """Cleaned tables to five dimensions and the fact table."""
    folder = scratch_folder(spark)
    numbered = written(with_row_id(listings, keys), f"{folder}/numbered")
    time = written(dim_time(numbered), f"{folder}/time")
    people = written(dim_demography(demography), f"{folder}/demography")
    save(time, "Dim_Czas")
    save(dim_unit(numbered), "Dim_Lokal")
    save(dim_building(numbered), "Dim_Budynek")
    save(dim_infrastructure(numbered), "Dim_Infrastruktura")
    save(people, "Dim_Demografia")
    save(fact_offers(numbered, time, people), "Fact_Oferta_Nieruchomosci")


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("job", choices=("collect", "check", "stage", "clean", "load"))
    parser.add_argument("--raw", required=True, help="input folder or database schema")
    parser.add_argument("--out", required=True, help="output folder or database schema")
    parser.add_argument("--jdbc", help="URL of a database for tables")
    parser.add_argument("--property", action="append", default=[], metavar="NAME=VALUE", help="connection property")
    args = parser.parse_args(argv)
    # Wide projections make methods that the JVM does not compile; leave those unfused.
    builder = SparkSession.builder.config("spark.sql.codegen.hugeMethodLimit", "8000")
    spark = builder.appName(f"parcelwise-{args.job}").getOrCreate()

    properties = dict(p.split("=", 1) for p in args.property)

    def table(name: str) -> DataFrame:
        if args.jdbc:
            return read_jdbc(spark, args.jdbc, f"{args.raw}.{name}", properties=properties)
        return spark.read.parquet(f"{args.raw}/{name}")

    def sink(partition_by: Mapping[str, tuple[str, ...]] | None = None) -> Save:
        return jdbc_in(args.jdbc, args.out, properties) if args.jdbc else parquet_in(args.out, partition_by)

    if args.job == "collect":
        collect(spark, args.raw, args.out)
    elif args.job == "check":
        for name, (accepted, rejected) in check(spark, args.raw, args.out).items():
            print(f"{name}: {accepted} rows accepted, {rejected} rejected")
    elif args.job == "stage":
        for name, rows in stage(spark, args.raw, sink()).items():
            print(f"{name}: {rows} rows staged")
    elif args.job == "clean":
        gaps = clean(spark, table("demography"), table("listings"), sink())
        gaps.show(truncate=False)
    else:
        by_kind = {"Dim_Lokal": ("listing_type",)}
        load(spark, table("demography"), table("listings"), sink(by_kind))


if __name__ == "__main__":
    main()
