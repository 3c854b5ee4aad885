"""CSV sources whose columns are bound by header name, whatever their order or number."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.sql.utils import AnalysisException

from shoplake.config import CONTRACTS, FULL_LOAD, INCREMENT, METADATA
from shoplake.functions.shape import lossy, quoted, typed
from shoplake.session import scratch_dir

# A line with more or fewer fields than its header is kept whole here while it is read.
MALFORMED = "_malformed_line"

def _listing(spark: SparkSession, path: str) -> DataFrame | None:
    """Names of the non-empty files under a path; None if it does not exist. No content is read."""
    try:
        found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return found.filter(F.col("length") > 0).select("path")


def any_files(spark: SparkSession, path: str) -> bool:
    found = _listing(spark, path)
    return found is not None and not found.isEmpty()


def header(spark: SparkSession, line: str) -> tuple[str, ...]:
    """Column names of a header line, as Spark names them."""
    return tuple(spark.read.option("header", "true").csv(spark.sparkContext.parallelize([line], 1)).columns)


def infer_schema(spark: SparkSession, path: str, sampling_ratio: float = 1.0) -> StructType:
    """Column types inferred from all rows, to be fixed as the schema of later reads. A smaller share is quicker and may miss values."""
    return spark.read.options(header="true", inferSchema="true", samplingRatio=str(sampling_ratio)).csv(path).schema


def _files(spark: SparkSession, source: str | Sequence[str]) -> DataFrameReader:
    return spark.read.option("recursiveFileLookup", "true") if isinstance(source, str) else spark.read


def header_lines(spark: SparkSession, source: str | Sequence[str]) -> DataFrame:
    """``file`` and its first line that is not blank, for every file of a folder or list; found by the tasks that read them."""
    lines = _files(spark, source).text(source if isinstance(source, str) else list(source))
    first = lines.filter((F.trim("value") != "") & (F.col("_metadata.file_block_start") == 0))
    numbered = first.select(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("_id"), "value")
    return numbered.groupBy("file").agg(F.min_by("value", "_id").alias("line"))


def _positions(spark: SparkSession, source: str | Sequence[str], width: int) -> DataFrame:
    """The lines of all files, headers apart, as text columns by position. A line with another number of fields is kept whole."""
    schema = StructType([StructField(f"_p{k}", StringType()) for k in range(width)] + [StructField(MALFORMED, StringType())])
    reader = _files(spark, source).options(header="true", columnNameOfCorruptRecord=MALFORMED).schema(schema)
    rows = reader.csv(source if isinstance(source, str) else list(source))
    # Tasks read a block from its start, so block and row put the rows of a file in order.
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return rows.select(
        "*",
        F.col("_metadata.file_path").alias("_source_file"),
        F.col("_metadata.file_modification_time").alias("_changed_at"),
        F.col("_metadata.file_block_start").alias("_source_block"),
        row.alias("_source_row"),
    )


def _by_name(rows: DataFrame, headers: Mapping[int, Sequence[str]], width: int) -> DataFrame:
    """Text columns by name, from columns by position and each row's header (``_header``, a fingerprint).

    A header narrower than the widest makes its lines look too short; they are parsed once more by its own width.
    """
    whole = F.col(MALFORMED)
    every = [F.col(f"_p{k}") for k in range(width)]
    found: dict[str, tuple[str, list[Column]]] = {}
    broken: list[Column] = []
    for number, names in headers.items():
        mine = F.col("_header") == number
        if len(names) == width:
            values, malformed = every, whole
        else:
            again = f"_again{len(broken)}"
            schema = ", ".join(f"{quoted(f'_q{k}')} string" for k in range(len(names)))
            parsed = F.from_csv(whole, f"{schema}, {MALFORMED} string", {"columnNameOfCorruptRecord": MALFORMED})
            rows = rows.withColumn(again, F.when(mine & whole.isNotNull(), parsed))
            one = whole.isNull()  # as many fields as the widest header has: too many for this one
            values = [F.when(one, every[k]).otherwise(F.col(again)[f"_q{k}"]) for k in range(len(names))]
            malformed = F.when(one, F.to_csv(F.struct(*every))).otherwise(F.col(again)[MALFORMED])
        broken.append(F.when(mine, malformed))
        for name, value in zip(names, values, strict=True):
            found.setdefault(name.lower(), (name, []))[1].append(F.when(mine, value))
    columns = [F.coalesce(*values).alias(name) for name, values in found.values()]
    return rows.select(*columns, F.coalesce(*broken).alias(MALFORMED), "_source_file", "_changed_at", "_source_block", "_source_row")


def _extra(names: Sequence[str], types: Mapping[str, str]) -> list[str]:
    """Columns outside the contract. Names differing only in case are the same column, as elsewhere in Spark."""
    taken, extra = {*types, *METADATA, MALFORMED}, []
    for name in names:
        if name.lower() not in taken:
            taken.add(name.lower())
            extra.append(name)
    return extra


def _rescued(texts: Mapping[str, str], types: Mapping[str, str]) -> str:
    """SQL text: what the types or the header have no place for, as JSON of column names and texts; NULL if nothing. ``texts`` names
    the text behind each typed column. The JSON is built for rows that need it only."""
    odd = {n: lossy(text, n, types[n]) for n, text in texts.items()}
    found = [f"'{n}', IF({test}, {quoted(texts[n])}, NULL)" for n, test in odd.items()]
    found.append(f"'{MALFORMED}', {quoted(MALFORMED)}")
    needed = " OR ".join([f"{quoted(MALFORMED)} IS NOT NULL", *(f"coalesce({test}, FALSE)" for test in odd.values())])
    return f"IF({needed}, to_json(named_struct({', '.join(found)}), map('ignoreNullFields', 'true')), NULL)"


def _shape(rows: DataFrame, types: Mapping[str, str], load_type: str) -> DataFrame:
    """Known columns in their types, unknown ones kept as text, then the load metadata."""
    have = {n.lower() for n in rows.columns}
    known = [f"{typed(n, 'string', t) if n in have else f'CAST(NULL AS {t})'} AS {quoted(n)}" for n, t in types.items()]
    extra = [quoted(n) for n in _extra(rows.columns, types)]
    # Texts go along to a second projection, so that each is turned into its type once.
    prefix = "_text"
    while any(c.lower().startswith(prefix) for c in rows.columns):
        prefix += "_"
    texts = {n: f"{prefix}{k}" for k, (n, t) in enumerate(types.items()) if n in have and t != "string"}
    place = ["_source_file", "_changed_at", "_source_block", "_source_row"]
    kept = [quoted(MALFORMED), *place, *(f"{quoted(n)} AS {text}" for n, text in texts.items())]
    load = ["current_timestamp() AS _ingestion_timestamp", "_source_file", f"'{load_type}' AS _load_type"]
    load += [*place[1:], f"{_rescued(texts, types)} AS _rescued"]
    return rows.selectExpr(*known, *extra, *kept).selectExpr(*(quoted(n) for n in types), *extra, *load)


def read(spark: SparkSession, source: str | Sequence[str], types: Mapping[str, str], load_type: str) -> tuple[DataFrame, list[str]]:
    """CSV files of a folder or list in one scan, whatever their headers, and the columns outside the contract.

    Tasks find each file's header; one row for each distinct one comes back. Where there are several, rows are told apart by their
    file's fingerprint. Jobs that find the headers run while the frame is built.
    """
    stored = scratch_dir(spark, "headers")
    header_lines(spark, source).withColumn("_header", F.xxhash64("line")).write.parquet(stored)
    lines = spark.read.schema("file string, line string, _header long").parquet(stored)
    kinds = lines.groupBy("_header").agg(F.min("file").alias("file"), F.min("line").alias("line")).orderBy("file").collect()
    with ThreadPoolExecutor(8) as pool:
        names = dict(zip([k["_header"] for k in kinds], pool.map(lambda k: header(spark, k["line"]), kinds), strict=True))
    if not names:
        nothing = spark.createDataFrame([], f"{MALFORMED} string, _source_file string, _changed_at timestamp, _source_block long, _source_row long")
        return _shape(nothing, types, load_type), []
    width = max(map(len, names.values()))
    rows = _positions(spark, source, width)
    if len(names) > 1:
        # One row for each file.
        rows = rows.join(lines.select(F.col("file").alias("_source_file"), "_header"), "_source_file")
    else:
        rows = rows.withColumn("_header", F.lit(next(iter(names))))
    rows = _by_name(rows, names, width)
    return _shape(rows, types, load_type), _extra(rows.columns, types)


def land(
    spark: SparkSession,
    source: str | Sequence[str],
    entity: str,
    load_type: str,
    write: Callable[[DataFrame], None],
    types: dict[str, str] | None = None,
) -> list[str]:
    """Read files by column name and pass them to ``write``, which must replace what an earlier attempt left.

    Returns the columns outside the contract.
    """
    rows, extra = read(spark, source, types or CONTRACTS[entity], load_type)
    write(rows)
    return extra
