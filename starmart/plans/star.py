"""The star: one fact table of arrivals and three dimensions.

Every builder takes DataFrames in the raw source schemas
(``starmart.sources.schemas``) and returns a lazy DataFrame; nothing runs
until the caller writes or counts. ``run_etl`` writes all four tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.functions import columns as C
from starmart.functions import constants as K
from starmart.functions import predicates as P
from starmart.operators.joins import (DEFAULT_BROADCAST_MAX_ROWS, DEFAULT_SALT_BUCKETS, fits_broadcast_all,
                                      lookup_join)
from starmart.operators.profile import table_stats
from starmart.plans.codes import code_tables
from starmart.session import file_system
from starmart.operators.duplicates import first_rows
from starmart.sources import readers as R
from starmart.sources import schemas as SC
from starmart.sources import versions
from starmart.sources.labels import read_texts
from starmart.sources.sinks import publish, rows_not_in, table_exists, write_parquet

FACT_COLUMNS = ["cicid", "citizenship_country", "residence_country", "arrival_date", "departure_date",
                "age", "gender", "city", "state", "visa_type", "detailed_visa_type"]


def build_country_codes(codes: DataFrame) -> DataFrame:
    """Country codes as read; ``INVALID`` entries stay valid join partners."""
    return codes.select("code", "country_name")


def build_port_codes(codes: DataFrame, non_us_states: Sequence[str] = K.NON_US_STATES) -> DataFrame:
    """Port codes with a state, outside the non-US list."""
    return codes.filter(F.col("state_code").isNotNull() & P.not_in("state_code", non_us_states))


def clean_immigration(immigration: DataFrame, marker: str | None = K.UNKNOWN_LABEL,
                      require_valid_stay: bool = False) -> DataFrame:
    """Casts, labels, the air/gender filters and the two dates (no lookups)."""
    im = immigration.withColumns({"arrdate": C.cast_int("arrdate"), "depdate": C.cast_int("depdate")})
    im = im.withColumns({
        "visa_type": C.decode("i94visa", K.VISA_LABELS, K.UNKNOWN_LABEL),
        "arrival_modes": C.decode("i94mode", K.MODE_LABELS, K.UNKNOWN_LABEL),
    })
    # mode = Air also implies arrival_modes = 'Air', the original's later filter.
    im = im.filter(F.col("i94mode") == K.AIR_MODE).filter(P.is_in("gender", K.KEPT_GENDERS))
    im = im.withColumns({
        "arrival_date": C.day_to_date("arrdate"),
        "departure_date": C.day_to_date_or_marker("depdate", marker),
    })
    if require_valid_stay:
        # Compared as dates: the marker text never takes part in a comparison.
        im = im.filter(C.day_to_date_or_marker("depdate", None) >= F.col("arrival_date"))
    return im


def build_fact(immigration: DataFrame, country_codes: DataFrame, port_codes: DataFrame,
               reference_year: int = K.REFERENCE_YEAR, marker: str | None = K.UNKNOWN_LABEL,
               require_valid_stay: bool = False,
               broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
               salt_buckets: int = DEFAULT_SALT_BUCKETS) -> DataFrame:
    """Arrivals by air of travellers with a known gender, decoded and looked up.

    The three lookups are inner joins, so unknown citizenship, residence or port
    codes drop the row. Code tables are broadcast after a size check; the
    fact side is never shuffled for them. A code table over the bound is
    joined by a salted shuffle (see ``lookup_join``); the fact is read once in
    any case.
    """
    im = clean_immigration(immigration, marker, require_valid_stay)
    # One size check per code table; the country table serves two roles.
    small_countries, small_ports = fits_broadcast_all([country_codes, port_codes], broadcast_max_rows)
    im = lookup_join(im, country_codes, "i94cit", {"country_name": "citizenship_country"},
                     broadcast=small_countries, salt_buckets=salt_buckets)
    im = lookup_join(im, country_codes, "i94res", {"country_name": "residence_country"},
                     broadcast=small_countries, salt_buckets=salt_buckets)
    im = lookup_join(im, port_codes, "i94port", {"port": "entry_port", "state_code": "entry_port_state"},
                     broadcast=small_ports, salt_buckets=salt_buckets)
    return im.select(
        "cicid", "citizenship_country", "residence_country", "arrival_date", "departure_date",
        C.age_at_year("biryear", reference_year).alias("age"), "gender",
        C.upper_trim("entry_port").alias("city"), C.upper_trim("entry_port_state").alias("state"),
        "visa_type", F.col("visatype").alias("detailed_visa_type"))


def explore_fact(immigration: DataFrame, marker: str | None = K.UNKNOWN_LABEL) -> DataFrame:
    """The exploration variant: stays must not end before they start, and no
    code lookups are made."""
    return clean_immigration(immigration, marker, require_valid_stay=True)


TEMPERATURE_KEYS = ["date", "city"]
MEASURES = {"average_temperature": "AverageTemperature", "average_temperature_uncertainty": "AverageTemperatureUncertainty"}


def clean_temperature(temperature: DataFrame, country: str = K.TEMPERATURE_COUNTRY, after: str = K.TEMPERATURE_AFTER,
                      strict_dates: bool = True) -> DataFrame:
    """The readings of one country after a day, with ``date`` and ``city`` (stripped and upper-cased)."""
    t = temperature.filter(F.col("Country") == country).withColumn("date", C.parse_date("dt", strict=strict_dates))
    return t.filter(P.date_after("date", after)).withColumn("city", C.strip_upper("City"))


def temperature_sums(readings: DataFrame, decimals: int | None = None, times: str | None = None) -> DataFrame:
    """Per (date, city) the sum and the number of readings of each measure, the state that means are merged in.

    With ``decimals`` sums are DECIMAL, so they do not depend on the order of the increments. ``times`` is a column
    that says how often a row counts.
    """
    aggs = []
    for name, c in MEASURES.items():
        m, n = F.col(c), F.col(times) if times else F.lit(1)
        if decimals is not None:
            m = F.when(~F.isnan(m), m).cast(f"decimal(28,{decimals})")
            total = F.sum(m * n.cast("decimal(9,0)") if times else m).cast(f"decimal(38,{decimals})")
        else:
            total = F.sum(m * n)
        aggs += [total.alias(f"{name}_sum"), F.sum(F.when(m.isNotNull(), n).otherwise(F.lit(0))).cast("long").alias(f"{name}_n")]
    return readings.groupBy(*TEMPERATURE_KEYS).agg(*aggs)


def temperature_means(sums: DataFrame, digits: int | None = None) -> DataFrame:
    """The means of ``temperature_sums``; NULL where nothing was read."""
    def mean(name: str):
        n = F.col(f"{name}_n")
        kind = sums.schema[f"{name}_sum"].dataType
        m = F.col(f"{name}_sum") / F.when(n > 0, n)
        m = m.cast(f"decimal(34,{kind.scale + 4})") if hasattr(kind, "scale") else m
        return (F.round(m, digits) if digits is not None else m).cast("double").alias(name)

    return sums.select(*TEMPERATURE_KEYS, *map(mean, MEASURES))


def build_dim_temperature(temperature: DataFrame, country: str = K.TEMPERATURE_COUNTRY,
                          after: str = K.TEMPERATURE_AFTER, as_timestamp: bool = False,
                          digits: int | None = None, decimals: int | None = None,
                          strict_dates: bool = True) -> DataFrame:
    """Monthly city temperatures of one country after a day, averaged per (date, city).

    A text that is no date fails the job, as in the original; with
    ``strict_dates=False`` its row is dropped by the date filter.

    City names are stripped and upper-cased first, so spellings that differ
    only in case or blanks fall into one row. ``decimals`` says how many decimals
    the readings have; they are then summed exactly (a NaN is a missing reading).
    """
    out = temperature_means(temperature_sums(clean_temperature(temperature, country, after, strict_dates), decimals), digits)
    return out.withColumn("date", F.col("date").cast("timestamp")) if as_timestamp else out


def counted_readings(readings: DataFrame) -> DataFrame:
    """``clean_temperature`` with each different reading once: how often it occurs (``times``) and its 128-bit ``id``."""
    columns = readings.columns
    texts = [F.coalesce(F.concat(F.lit("="), F.col(f"`{c}`").cast("string")), F.lit("")) for c in columns]
    lengths = [F.length(t).cast("string") for t in texts]  # so that no two rows have the same text
    ids = readings.withColumn("id", F.md5(F.concat_ws("|", *lengths, *texts)))
    return ids.groupBy(*columns, "id").agg(F.count(F.lit(1)).alias("times"))


def build_dim_airports(airports: DataFrame, excluded_types: Sequence[str] = K.EXCLUDED_AIRPORT_TYPES,
                       country_text: str = K.AIRPORT_COUNTRY_TEXT,
                       region_length: int = K.REGION_CODE_LENGTH) -> DataFrame:
    """Airports in the country, of kept types, with a city and a two-part region."""
    a = airports.filter(P.contains_upper("iso_country", country_text))
    a = a.filter(P.not_in_keep_null("type", excluded_types))
    a = a.filter(F.col("municipality").isNotNull()).withColumn("municipality", F.upper("municipality"))
    a = a.withColumn("len", C.text_length("iso_region")).filter(F.col("len") == region_length)
    return a.withColumn("state", C.split_after_first("iso_region", "-"))


def build_dim_demographics(demographics: DataFrame) -> DataFrame:
    """City demographics with clean city, state code and race; veterans dropped."""
    d = demographics.withColumns({
        "City": C.strip_upper("City"),
        "State Code": C.strip_upper("State Code"),
        "Race": C.strip_upper("Race"),
    })
    return d.select(
        F.col("City").alias("city"), F.col("State").alias("state"),
        F.col("`Median Age`").alias("median_age"), F.col("`Male Population`").alias("male_population"),
        F.col("`Female Population`").alias("female_population"),
        F.col("`Total Population`").alias("total_population"), F.col("`Foreign-born`").alias("foreign_born"),
        F.col("`Average Household Size`").alias("average_household_size"),
        F.col("`State Code`").alias("state_code"), F.col("Race").alias("race"), F.col("Count").alias("count"))


STAR_TABLES = ("dim_demographics", "dim_temperature", "dim_airports", "fact_immigration")
FACT_KEYS = ["city", "state"]
DIMENSION_KEYS = {"dim_airports": ["municipality", "state"], "dim_demographics": ["city", "state_code"]}


#: Tables that updates need and readers do not: the sums behind the means, and which readings are in them.
STATE_TABLES = ("temperature_sums", "temperature_readings")
FOLDERS = {**{name: name for name in STAR_TABLES}, **{name: f"_state/{name}" for name in STATE_TABLES}}
TABLE_KEYS = {"dim_demographics": ["city", "state_code", "race"], "dim_temperature": TEMPERATURE_KEYS,
              "dim_airports": ["ident"], "fact_immigration": ["cicid"]}


def build_star(sources: Mapping[str, DataFrame], temperature_options: Mapping[str, object] | None = None,
               **fact_options) -> dict[str, DataFrame]:
    """All four tables from the sources ``immigration, country_codes, port_codes,
    temperature, airports, demographics``."""
    return {
        "dim_demographics": build_dim_demographics(sources["demographics"]),
        "dim_temperature": build_dim_temperature(sources["temperature"], **(temperature_options or {})),
        "dim_airports": build_dim_airports(sources["airports"]),
        "fact_immigration": build_fact(sources["immigration"], build_country_codes(sources["country_codes"]),
                                       build_port_codes(sources["port_codes"]), **fact_options),
    }


def _state(sources: Mapping[str, DataFrame], options: Mapping[str, object]) -> dict[str, DataFrame]:
    given = {k: v for k, v in options.items() if k in ("country", "after", "strict_dates")}
    readings = counted_readings(clean_temperature(sources["temperature"], **given))
    return {"temperature_sums": temperature_sums(readings, options.get("decimals"), "times"),
            "temperature_readings": readings.select(*TEMPERATURE_KEYS, "id", "times")}


def run_etl(spark: SparkSession, sources: Mapping[str, DataFrame], out_dir: str, mode: str = "errorifexists",
            partition_fact_by: Sequence[str] | None = None, concurrent_writes: int = 4,
            temperature_options: Mapping[str, object] | None = None) -> DataFrame:
    """Build and write the star as ``out_dir``; return schema and row counts
    of the written tables (read back from storage).

    The tables are written to a staging folder next to ``out_dir``, which is
    renamed to ``out_dir`` when all of them are there. A failed run leaves no part
    of a star, and can simply be run again. ``mode`` is ``errorifexists`` or
    ``overwrite``; for increments there is ``update_star``. To overwrite, the new
    tables become a new version of the star (``sources/versions.py``): readers
    who come through ``read_star`` see the old star or the new one, and a failure
    leaves the old one. The tables are
    independent, so their writes are concurrent Spark jobs
    (``concurrent_writes`` at a time). A failed write raises.
    """
    if mode not in ("errorifexists", "overwrite"):
        raise ValueError(f"mode {mode!r}: a star is built new or overwritten; use update_star to add to it")
    out_dir = out_dir.rstrip("/")
    exists = table_exists(spark, out_dir)
    if mode == "errorifexists" and exists:
        raise FileExistsError(out_dir)
    options = dict(temperature_options or {})
    tables = {**build_star(sources, options), **_state(sources, options)}
    number = versions.current(spark, out_dir, FOLDERS)["version"] + 1 if exists else 1
    below = versions.new_folder(number)
    staging = f"{out_dir}/{below}" if exists else f"{out_dir}__staging-{uuid.uuid4().hex[:12]}"

    def write(item):
        name, df = item
        return write_parquet(df, f"{staging}/{name if exists else FOLDERS[name]}",
                             partition_by=partition_fact_by if name == "fact_immigration" else None)

    files, path = file_system(spark, out_dir)
    try:
        with ThreadPoolExecutor(max_workers=max(1, concurrent_writes)) as pool:
            list(pool.map(write, tables.items()))
        if exists:
            versions.commit(spark, out_dir, number, {name: [f"{below}/{name}"] for name in tables})
        else:
            if files.exists(path(out_dir)):
                files.delete(path(out_dir), True)  # an empty folder
            publish(spark, staging, out_dir)
    except BaseException:
        files.delete(path(staging), True)
        raise
    return table_stats(spark, read_star(spark, out_dir))


def _merged_temperature(spark: SparkSession, out_dir: str, stored: Mapping[str, Sequence[str]], readings: DataFrame,
                        options: Mapping[str, object]) -> tuple[DataFrame, DataFrame]:
    """The sums with the readings that are new, and which these are. A reading that the increment has more often than all
    increments before counts for the difference."""
    counted = counted_readings(readings)
    if not stored["temperature_readings"]:
        new = counted
    else:
        known = (versions.read(spark, out_dir, stored["temperature_readings"]).groupBy("id")
                 .agg(F.sum("times").alias("known")))
        new = (counted.join(known, "id", "left").withColumn("times", F.col("times") - F.coalesce("known", F.lit(0)))
               .filter(F.col("times") > 0).drop("known"))
    sums = temperature_sums(new, options.get("decimals"), "times")
    if stored["temperature_sums"]:
        both = versions.read(spark, out_dir, stored["temperature_sums"]).unionByName(sums)
        sums = both.groupBy(*TEMPERATURE_KEYS).agg(*(F.sum(f.name).cast(f.dataType).alias(f.name) for f in sums.schema.fields[2:]))
    return sums, new.select(*TEMPERATURE_KEYS, "id", "times")


def update_star(spark: SparkSession, sources: Mapping[str, DataFrame], out_dir: str,
                partition_fact_by: Sequence[str] | None = None,
                temperature_options: Mapping[str, object] | None = None) -> DataFrame:
    """Add an increment (a month of arrivals, new rows of the other sources) to the star at ``out_dir``.

    Arrivals, airports and demographics have a key (``TABLE_KEYS``); rows whose key is stored are
    skipped, and of a key repeated in the increment the first row counts. Temperatures are means: the new readings are
    added to the stored sums and counts, and the means follow from these. A reading that was delivered before (a row equal
    in all columns) counts once, or as often as the increment that has it most often. So an
    update that is run twice ends in the same star, whatever the increments overlap in. All tables change together when the
    new version is committed; an update that fails leaves the star as it was. A missing star is built.
    ``partition_fact_by`` must be the
    columns the fact is stored by; they follow from the arrival, so arrivals
    are compared within the partitions touched. ``temperature_options`` must stay the same over the updates of a star.
    """
    out_dir, options = out_dir.rstrip("/"), dict(temperature_options or {})
    stored = versions.current(spark, out_dir, FOLDERS)
    number, folders = stored["version"] + 1, dict(stored["tables"])
    if folders["dim_temperature"] and not folders["temperature_sums"]:
        raise ValueError(f"{out_dir} was built without the sums of its temperatures; build it again with run_etl")
    below = versions.new_folder(number)
    files, path = file_system(spark, out_dir)

    def write(name: str, df: DataFrame, **how) -> str:
        write_parquet(df, f"{out_dir}/{below}/{name}", **how)
        return f"{below}/{name}"

    try:
        tables = build_star(sources, options)
        for name in ("dim_demographics", "dim_airports", "fact_immigration"):
            parts = partition_fact_by if name == "fact_immigration" else None
            rows = first_rows(tables[name], TABLE_KEYS[name])
            if folders[name]:
                rows = rows_not_in(rows, versions.read(spark, out_dir, folders[name]), TABLE_KEYS[name], parts)
            added = write(name, rows, partition_by=parts)
            if not folders[name] or table_exists(spark, f"{out_dir}/{added}"):
                folders[name] = [*folders[name], added]
        given = {k: v for k, v in options.items() if k in ("country", "after", "strict_dates")}
        sums, new = _merged_temperature(spark, out_dir, folders, clean_temperature(sources["temperature"], **given), options)
        folders["temperature_readings"] = [*folders["temperature_readings"], write("temperature_readings", new)]
        folders["temperature_sums"] = [write("temperature_sums", sums)]
        means = temperature_means(versions.read(spark, out_dir, folders["temperature_sums"]), options.get("digits"))
        if options.get("as_timestamp"):
            means = means.withColumn("date", F.col("date").cast("timestamp"))
        folders["dim_temperature"] = [write("dim_temperature", means)]
        versions.commit(spark, out_dir, number, folders)
    except BaseException:
        files.delete(path(f"{out_dir}/{below}"), True)
        raise
    return table_stats(spark, read_star(spark, out_dir))


def sources_from_files(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, DataFrame]:
    """The sources of the star from raw files: ``labels`` (label text), ``immigration`` (parquet), ``temperature``
    and ``airports`` (CSV), ``demographics`` (CSV with semicolons). A label section that is missing fails the job."""
    codes = code_tables(read_texts(spark, paths["labels"]))
    return {
        "immigration": R.scan_parquet(spark, paths["immigration"]),
        "country_codes": codes["i94_country"],
        "port_codes": codes["i94_port"],
        "temperature": R.scan_csv(spark, paths["temperature"], SC.TEMPERATURE),
        "airports": R.scan_csv(spark, paths["airports"], SC.AIRPORTS),
        "demographics": R.scan_csv_delimited(spark, paths["demographics"], SC.DEMOGRAPHICS),
    }


def run_etl_from_files(spark: SparkSession, paths: Mapping[str, str], out_dir: str, **options) -> DataFrame:
    """``run_etl`` from raw files (see ``sources_from_files``)."""
    return run_etl(spark, sources_from_files(spark, paths), out_dir, **options)


def read_star(spark: SparkSession, out_dir: str) -> dict[str, DataFrame]:
    """The four tables of the newest version; all of them belong together."""
    out_dir = out_dir.rstrip("/")
    folders = versions.current(spark, out_dir, FOLDERS)["tables"]
    return {name: versions.read(spark, out_dir, folders[name] or [name]) for name in STAR_TABLES}
