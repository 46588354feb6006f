"""File sources.

Landed files are read with a declared schema (no inference job), conformed
to the declared column set, and narrowed by joins instead of driver-side id
lists.  Any Hadoop file system URI works as a path (S13).
"""

from __future__ import annotations

from multiprocessing.pool import ThreadPool

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchlake.operators.prefix import positions
from pitchlake.schemas import (COMPETITION_DROP, COMPETITION_GENDER, CSV_OPTIONS, EXCLUDED_COMPETITIONS,
                               LINEUP_SCHEMA, MATCH_DROP, SEASON_AFTER)


def require_columns(df: DataFrame, cols) -> DataFrame:
    """Plan-time check (S10): raise ``ValueError`` naming missing columns."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {missing}; the table has {df.columns}")
    return df


def conform(df: DataFrame, schema: T.StructType, cast_existing: bool = True) -> DataFrame:
    """Exactly the columns of ``schema`` in its order (S6): present ones cast
    to the declared type, missing ones as typed nulls, extras dropped."""
    present = set(df.columns)
    cols = []
    for f in schema.fields:
        if f.name in present:
            c = F.col(f.name)
            cols.append((c.cast(f.dataType) if cast_existing else c).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def read_table(spark: SparkSession, path, fmt: str = "parquet", schema: T.StructType | None = None,
               sep: str = ",", corrupt_col: str | None = None, ignore_corrupt_files: bool = False,
               ignore_missing_files: bool = False, infer_schema: bool = False) -> DataFrame:
    """Parquet / JSON / CSV reader (S1, S11, S12, S14).  CSV uses ``"`` as
    the escape character: files written by pandas double embedded quotes,
    and Spark's default backslash escape would split such fields.
    ``corrupt_col`` keeps malformed JSON/CSV rows in that column (S8)."""
    r = spark.read
    if schema is not None:
        s = schema
        if corrupt_col and corrupt_col not in schema.fieldNames():
            s = T.StructType(schema.fields + [T.StructField(corrupt_col, T.StringType())])
        r = r.schema(s)
    if ignore_corrupt_files:
        r = r.option("ignoreCorruptFiles", "true")
    if ignore_missing_files:
        r = r.option("ignoreMissingFiles", "true")
    if fmt == "csv":
        r = r.options(**CSV_OPTIONS).option("sep", sep)
        if schema is None and infer_schema:
            r = r.option("inferSchema", "true")
    if fmt in ("csv", "json") and corrupt_col:
        r = r.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt_col)
    return r.format(fmt).load(path)


def read_checked(spark: SparkSession, path, schema: T.StructType, fmt: str = "json",
                 sep: str = ",") -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows) of landed JSON lines or CSV with a header
    (S8).  Lines are parsed in the plan, not by the file source, so either
    side can be written, counted or joined alone, and nothing is cached.
    Rejects keep the whole line (``line``) and its file (``file``)."""
    full = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    if fmt == "json":
        row = F.from_json("value", full, options)
    elif fmt == "csv":
        lines = lines.filter(F.col("value") != sep.join(schema.fieldNames()))  # the header of each file
        row = F.from_csv("value", full.simpleString()[len("struct<"):-1].replace(":", " "),
                         {**options, "sep": sep, "escape": '"', "quote": '"'})
    else:
        raise ValueError("fmt must be 'json' or 'csv'")
    parsed = lines.filter(F.trim("value") != "").withColumn("row", row)
    good = parsed.filter(F.col("row._bad").isNull()).select("row.*").drop("_bad")
    bad = parsed.filter(F.col("row._bad").isNotNull()).select(F.col("value").alias("line"), "file")
    return good, bad


def read_quarantined(spark: SparkSession, path, schema: T.StructType, fmt: str = "parquet",
                     sep: str = ",") -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined files) of a folder in which whole files may be
    unreadable (S8): such files are skipped, not fatal, and listed as ``file,
    length, reason``.

    The list is the folder's listing without the files that gave a row; neither
    side reads a file's content for it (the listing has none, the row side asks
    for no column), and nothing runs before an action.  A sound file without
    rows is in the list too, as nothing could be read from it; a file of no bytes
    is not, as file scans leave those out.  Of a file whose damage lies behind
    readable rows, the rows before it are kept."""
    good = read_table(spark, path, fmt, schema=schema, sep=sep, ignore_corrupt_files=True)
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path) \
        .select(F.col("_metadata.file_path").alias("file"), "length")
    gave = good.select(F.col("_metadata.file_path").alias("file")).distinct()
    return good, listed.join(gave, "file", "left_anti").select("file", "length", F.lit("no row could be read").alias("reason"))


def units_of(spark: SparkSession, path: str) -> list[str]:
    """The landed units (a folder or a file each) right below a path, on any
    file system that Spark reads."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = where.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(where)
    return sorted(f.getPath().toString() for f in found if f.getPath().getName()[0] not in "._")


def fitted(df: DataFrame, schema: T.StructType) -> DataFrame:
    """:func:`conform` for columns of any type: a value that does not fit the
    declared one is null instead of an error, and numbers written as text count
    as numbers (``'3.0'`` is the integer 3)."""
    kind = {f.name: f.dataType for f in df.schema.fields}
    cols = []
    for f in schema.fields:
        c = F.lit(None) if f.name not in kind else F.col(f"`{f.name}`")
        if f.name in kind and kind[f.name] != f.dataType:
            if isinstance(kind[f.name], T.StringType) and isinstance(f.dataType, T.IntegralType):
                c = c.try_cast("decimal(38,9)")
            c = c.try_cast(f.dataType)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def read_drifting(spark: SparkSession, paths, schema: T.StructType, fmt: str = "parquet", sep: str = ",",
                  threads: int = 16) -> DataFrame:
    """One table from landed units whose columns differ in number, order and
    type (S6, U2): every unit's own columns are resolved by name against the
    declared schema, and the units are concatenated.

    ``paths`` are units (a match or a batch each, written by one job) or a folder of
    them.  Units are grouped by their columns as their own footer (Parquet) or
    header (CSV) names them, one small read a unit; each group is one scan, so the
    plan grows with the ways in which units differ, not with their number.  JSON
    names the columns in every record: one scan, each value read as text and
    turned into its declared type.  No type is guessed from data."""
    units = [u for p in ([paths] if isinstance(paths, str) else paths) for u in units_of(spark, p)] \
        if isinstance(paths, str) else list(paths)
    if not units:
        return spark.createDataFrame([], schema)
    if fmt == "json":
        text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
        return fitted(spark.read.schema(text).json(units), schema)

    def columns(unit: str) -> T.StructType:
        if fmt == "parquet":
            return spark.read.parquet(unit).schema
        return spark.read.options(**CSV_OPTIONS).option("sep", sep).csv(unit).schema  # the header; all text

    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    with ThreadPool(threads) as pool:
        for unit, found in zip(units, pool.map(columns, units)):
            groups.setdefault(found.json(), (found, []))[1].append(unit)
    out = None
    for found, own in groups.values():
        r = spark.read.schema(found)
        part = fitted(r.parquet(*own) if fmt == "parquet" else r.options(**CSV_OPTIONS).option("sep", sep).csv(own), schema)
        out = part if out is None else out.unionByName(part)
    return out


def filter_competitions(comps: DataFrame, gender: str = COMPETITION_GENDER,
                        season_after: str = SEASON_AFTER, exclude=EXCLUDED_COMPETITIONS,
                        drop=COMPETITION_DROP) -> DataFrame:
    """Gender, season name compared as text (so ``'2014/2015'``
    passes ``> '2014'`` and ``'2014'`` does not), excluded names, dropped
    columns."""
    df = require_columns(comps, ["competition_gender", "season_name", "competition_name"])
    if gender is not None:
        df = df.filter(F.col("competition_gender") == gender)
    if season_after is not None:
        df = df.filter(F.col("season_name") > F.lit(season_after))
    if exclude:
        df = df.filter(~F.col("competition_name").isin(*exclude))
    return df.drop(*[c for c in drop if c in df.columns])


def matches_for(matches: DataFrame, comps: DataFrame, drop=MATCH_DROP) -> DataFrame:
    """Matches of the chosen competition-seasons (S2): semi join, no id list
    in the plan.  Competitions are a small dimension; adaptive execution
    broadcasts them when they fit the threshold."""
    require_columns(matches, ["match_id", "competition_id", "season_id"])
    m = matches.join(comps.select("competition_id", "season_id"), ["competition_id", "season_id"], "left_semi")
    return m.drop(*[c for c in drop if c in m.columns])


def rows_of_matches(df: DataFrame, matches: DataFrame) -> DataFrame:
    """Rows (lineups, events, frames) of the given matches."""
    require_columns(df, ["match_id"])
    return df.join(matches.select("match_id"), "match_id", "left_semi")


def flatten_lineups(lineups: DataFrame) -> DataFrame:
    """``match_id, teams map<team, array<player>>`` -> one row per player with
    ``match_id`` and ``team`` stamped on (S4)."""
    return (lineups.select("match_id", F.explode("teams").alias("team", "players"))
                   .select("match_id", "team", F.inline("players")))


def read_lineups(spark: SparkSession, path, fmt: str = "json") -> DataFrame:
    return flatten_lineups(read_table(spark, path, fmt, schema=LINEUP_SCHEMA))


def attach_match(events: DataFrame, matches: DataFrame, cols=("competition", "season")) -> DataFrame:
    """Stamp the match's attributes on every event (J8): inner join on
    ``match_id``.  The matches side is a dimension; adaptive execution
    broadcasts it when small and keeps a shuffle join otherwise."""
    require_columns(events, ["match_id"])
    require_columns(matches, ["match_id", *cols])
    ev = events.drop(*[c for c in cols if c in events.columns])
    return ev.join(matches.select("match_id", *cols), "match_id", "inner")


def positional_index(df: DataFrame, order_col: str, out: str = "pos") -> DataFrame:
    """0-based position of each row in ``order_col`` order (W4), nulls first;
    rows of equal keys take consecutive positions in no set order.  The rows
    are written once in key order and positions come from the counts of the
    ranges (:func:`positions`): even tasks for any kind of key, one key of very
    many rows included.  Runs when called."""
    return positions(df, [order_col], out)


def match_batches(matches: DataFrame, batch_size: int = 500, order_col: str = "match_id") -> DataFrame:
    """Batch number of every match by position (S7): batch b holds positions
    [b*size, (b+1)*size)."""
    require_columns(matches, [order_col])
    return positional_index(matches, order_col).withColumn(
        "batch", (F.col("pos") / batch_size).cast("long"))


def match_batch(matches: DataFrame, start: int, end: int, order_col: str = "match_id") -> DataFrame:
    """Matches at positions [start, end) in ``order_col`` order (S7).  Uses
    the distributed position, so a late batch of a large table does not make
    every task keep ``end`` rows as an offset/limit top-k would."""
    pos = positional_index(require_columns(matches, [order_col]), order_col)
    return pos.filter((F.col("pos") >= start) & (F.col("pos") < end)).drop("pos")


def _typed(df: DataFrame, schema: T.StructType, matches: DataFrame | None, parse_frames: bool) -> DataFrame:
    from pitchlake.functions.frames import parse_frame

    df = conform(require_columns(df, ["match_id"]), schema)
    if parse_frames and "shot_freeze_frame" in df.columns:
        df = df.withColumn("frame", parse_frame("shot_freeze_frame")).drop("shot_freeze_frame")
    return df if matches is None else attach_match(df, matches)


def read_events(spark: SparkSession, path, schema: T.StructType, matches: DataFrame | None = None,
                fmt: str = "parquet", sep: str = ",", parse_frames: bool = False) -> DataFrame:
    """Events scan (S5): declared schema, conform (S6), optional inner join
    to chosen matches, stamping competition and season (J8).
    ``parse_frames`` turns the freeze-frame text into the typed ``frame``
    column once, at ingest, so later queries read the typed array."""
    return _typed(read_table(spark, path, fmt, schema=schema, sep=sep), schema, matches, parse_frames)


def read_events_checked(spark: SparkSession, path, schema: T.StructType, matches: DataFrame | None = None,
                        fmt: str = "json", sep: str = ",", parse_frames: bool = False) -> tuple[DataFrame, DataFrame]:
    """As :func:`read_events` for text files, with the lines that do not
    parse as a second frame for the caller to write or count (S8)."""
    good, bad = read_checked(spark, path, schema, fmt, sep)
    return _typed(good, schema, matches, parse_frames), bad


def ingest_quality(df: DataFrame, key: str = "match_id", shot_type: str = "Shot") -> DataFrame:
    """Row, null-key and distinct-key counts plus shots (A12, F15), one job."""
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.count_if(F.col(key).isNull()).cast("bigint").alias("null_keys"),
                  F.countDistinct(key).alias("distinct_keys"),
                  F.count_if(F.col("type") == shot_type).cast("bigint").alias("shots"),
                  F.lit(len(df.columns)).alias("columns"))


def group_counts(df: DataFrame, key: str) -> DataFrame:
    """Rows per key, largest first."""
    return df.groupBy(key).count().orderBy(F.desc("count"), F.col(key))
