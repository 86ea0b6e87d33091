"""Read a folder of files whose headers differ into one table of contract columns, all text."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterloom.contract import TableContract
from rosterloom.functions import header_code
from rosterloom.operators.profile import profile_columns
from rosterloom.operators.rows import FILE, FILE_ORDER, SHEET
from rosterloom.operators.shape import clean_all_text, header_matches
from rosterloom.operators.skew import SMALL_ROWS
from rosterloom.scratch import local_table, scratch_path, written
from rosterloom.sources.intask import header_scan, workbook_rows

#: Which file, and which version of it, a row comes from.
PATH, MODIFIED, SIZE = "_source_path", "_source_modified", "_source_size"
PROVENANCE = T.StructType(
    [
        T.StructField(PATH, T.StringType()),
        T.StructField(SHEET, T.StringType()),
        T.StructField(MODIFIED, T.LongType()),
        T.StructField(SIZE, T.LongType()),
    ]
)


#: The code of the header line of a row's file.
LAYOUT = "_source_layout"
#: Up to this many files are named one by one. Of more, only what their layouts share passes through the driver.
FEW_FILES = 1_000
#: At most this many files are named in a message.
NAMED_FILES = 20
TABLES_PER_TASK = 50


class SourceError(RuntimeError):
    """The files of a source cannot be found or read."""


@dataclass(frozen=True)
class Source:
    """Where a flow's files are and how to read them.

    ``paths`` may hold globs; ``**`` spans any number of folders, wherever it stands. Spark does not
    list names that begin with ``_`` or ``.``. ``sheet`` (a name, a
    position or ``*`` for all) and ``header_row`` apply to workbooks, ``sep`` and ``encoding``
    to delimited text.
    """

    paths: tuple[str, ...]
    format: str = "csv"
    sheet: str | int = 0
    header_row: int = 0
    sep: str = ";"
    encoding: str = "UTF-8"
    options: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if isinstance(self.paths, str):
            object.__setattr__(self, "paths", (self.paths,))
        if self.format not in ("csv", "parquet", "workbook"):
            raise SourceError(f"unknown source format {self.format!r}")


#: What the parts of a glob mean in a path; ``**/`` and ``**`` span folders.
_GLOB = {"**/": "(?:.*/)?", "**": ".*", "*": "[^/]*", "?": "[^/]", "{": "(?:", "}": ")", ",": "|"}


def _glob_pattern(glob: str) -> str:
    parts = re.split(r"(\*\*/|\*\*|[*?{},]|\[[^\]]*\])", glob)
    meant = [_GLOB.get(p) or (p.replace("[!", "[^") if p.startswith("[") else re.escape(p)) for p in parts]
    return "".join(meant)


def _listing(spark: SparkSession, pattern: str) -> DataFrame:
    reader = spark.read.format("binaryFile")
    # Only the listing: the content column is never selected, so no file is opened.
    listed = ["path", "modificationTime", "length"]
    if "**" not in pattern:
        return reader.load(pattern).select(*listed)
    folder = pattern[: pattern.index("**")].rpartition("/")[0] or ("/" if pattern[0] == "/" else ".")
    below = re.sub(r"^\w+:/*", "/", pattern)
    found = reader.option("recursiveFileLookup", "true").load(folder).select(*listed)
    return found.filter(F.col("path").rlike(f"{_glob_pattern(below)}$"))


def list_files(spark: SparkSession, source: Source) -> DataFrame:
    """(path, modified, size) of every file once; ``modified`` in microseconds.

    Editor lock files (``~$``) are left out. The listing is taken when this is called.
    """
    found = []
    for pattern in source.paths:
        try:
            found.append(_listing(spark, pattern))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    name = F.element_at(F.split("path", "/"), -1)
    files = None
    if found:
        listed = (
            reduce(DataFrame.unionByName, found)
            .filter(~name.startswith("~$"))
            .select(
                plain_path(F.col("path")).alias("path"),
                F.unix_micros("modificationTime").alias("modified"),
                F.col("length").alias("size"),
            )
        )
        rows = few_rows(listed)
        if rows is not None:
            files = local_table(spark, sorted(set(rows)), listed.schema) if rows else None
        else:
            files = written(listed.distinct(), scratch_path(spark, "listing"))
    if files is None:
        raise SourceError("no file found for: " + ", ".join(source.paths))
    return files


def few_rows(df: DataFrame) -> list | None:
    """The rows of a listing, or None if there are more than ``FEW_FILES``."""
    rows = df.limit(FEW_FILES + 1).collect()
    return rows if len(rows) <= FEW_FILES else None


def held(df: DataFrame, name: str) -> DataFrame:
    """``df`` as it is now: up to ``FEW_FILES`` rows with the plan itself, more of them in a written table."""
    rows = few_rows(df)
    if rows is None:
        return written(df, scratch_path(df.sparkSession, name))
    return local_table(df.sparkSession, rows, df.schema)


@dataclass(frozen=True)
class Layout:
    """A header line: its code, the headers, how many files or sheets have it, and one of those."""

    code: int
    headers: tuple[str, ...]
    tables: int
    path: str
    sheet: str


@dataclass(frozen=True)
class Scanned:
    """The tables found in files: (path, modified, size, sheet, layout) in Spark, and their layouts."""

    tables: DataFrame
    layouts: list[Layout]

    @property
    def count(self) -> int:
        return sum(layout.tables for layout in self.layouts)

    def only(self, layout: Layout) -> Scanned:
        return Scanned(self.tables.filter(F.col("layout") == layout.code), [layout])


def scan_headers(spark: SparkSession, files: DataFrame, source: Source) -> Scanned:
    """Header lines of all files, read in tasks. Only one row per distinct header line reaches the driver.

    Empty files and empty sheets beside others hold nothing and are left out; a file that holds
    something without a header line is an error, so that no row is lost unseen.
    """
    options = {
        "format": source.format,
        "sheet": source.sheet,
        "header_row": source.header_row,
        "sep": source.sep,
        "encoding": source.encoding,
    }
    headers = F.col("headers")
    found = held(
        files.repartition(spread_over(files), "path")
        .mapInArrow(
            header_scan(options),
            "path string, modified bigint, size bigint, sheet string, headers array<string>",
        )
        .withColumn("layout", F.when(F.size(headers) > 0, F.xxhash64(F.to_json(headers)))),
        "tables",
    )
    least = F.min(F.struct("path", "sheet"))
    groups = found.groupBy("layout", "headers").agg(F.count("*").alias("n"), least.alias("first")).collect()
    if any(g["layout"] is None for g in groups):
        empty = found.groupBy("path").agg(F.max("size").alias("size"), F.count("layout").alias("read"))
        lost = empty.filter("size > 0 and read = 0").orderBy("path").limit(NAMED_FILES).collect()
        if lost:
            raise SourceError("no header line in: " + ", ".join(r["path"] for r in lost))
    layouts = [
        Layout(g["layout"], tuple(g["headers"]), g["n"], g["first"]["path"], g["first"]["sheet"])
        for g in groups
        if g["layout"] is not None
    ]
    if not layouts:
        raise SourceError("no file has a header line: " + ", ".join(source.paths))
    if len({layout.code for layout in layouts}) < len(layouts):
        raise SourceError("two header lines have the same code")
    layouts.sort(key=lambda layout: (layout.path, layout.sheet))
    return Scanned(found.filter("layout is not null").drop("headers"), layouts)


def spread_over(files: DataFrame) -> int:
    """Partitions for work on whole files, each of which takes a while: some for every core."""
    return 4 * files.sparkSession.sparkContext.defaultParallelism


def plain_path(path: Column) -> Column:
    """One spelling for local paths, which Spark writes with one slash or with three."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def metadata_columns() -> list[Column]:
    """Provenance of the row at hand, from the built-in file readers.

    The path is URL-encoded there; a literal plus sign must survive decoding.
    """
    encoded = F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))
    return [
        plain_path(F.url_decode(encoded)).alias(PATH),
        F.lit("0").alias(SHEET),
        F.unix_micros("_metadata.file_modification_time").alias(MODIFIED),
        F.col("_metadata.file_size").alias(SIZE),
    ]


def _as_text(field_: T.StructField) -> Column:
    """Cells of typed columns as the text a spreadsheet would show: 123.0 becomes 123."""
    c = F.col(f"`{field_.name}`")
    if isinstance(field_.dataType, (T.FloatType, T.DoubleType)):
        whole = c.try_cast("bigint")
        return F.when(whole.cast("double") == c, whole.cast("string")).otherwise(c.cast("string"))
    return c.cast("string")


def _read_tables(spark: SparkSession, scanned: Scanned, source: Source) -> DataFrame:
    """The rows of all tables in columns c0, c1, ... as they stand in each, their provenance and layout."""
    names = [f"c{i}" for i in range(max(len(layout.headers) for layout in scanned.layouts))]
    if source.format == "workbook":
        return _read_workbooks(scanned, names, source)
    if source.format == "parquet":
        # A typed format: what has the same columns is read together.
        parts = [_read_parquet(spark, scanned.only(layout), source) for layout in scanned.layouts]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    reader = (
        spark.read.schema(T.StructType([T.StructField(n, T.StringType()) for n in names]))
        .options(header=True, sep=source.sep, encoding=source.encoding, escape='"')
        .options(**source.options)
    )
    few = scanned.count <= FEW_FILES
    if few:
        rows = reader.csv([r["path"] for r in scanned.tables.select("path").collect()])
    else:  # the same files by their patterns, so that their names need not pass through here
        rows = reduce(DataFrame.unionByName, [_by_pattern(reader, p) for p in source.paths])
    rows = rows.select(*[F.col(n) for n in names], *metadata_columns())
    if few and len(scanned.layouts) == 1:
        return rows.withColumn(LAYOUT, F.lit(scanned.layouts[0].code))
    where = scanned.tables.select(F.col("path").alias(PATH), F.col("layout").alias(LAYOUT))
    return rows.join(F.broadcast(where) if scanned.count <= SMALL_ROWS else where, PATH)


def _by_pattern(reader, pattern: str) -> DataFrame:
    if "**" not in pattern:
        return reader.csv(pattern)
    folder = pattern[: pattern.index("**")].rpartition("/")[0] or ("/" if pattern[0] == "/" else ".")
    return reader.option("recursiveFileLookup", "true").csv(folder)


def _read_parquet(spark: SparkSession, scanned: Scanned, source: Source) -> DataFrame:
    # Names of files, which Spark's reader takes one by one and keeps in its plan.
    paths = [r["path"] for r in scanned.tables.select("path").distinct().toLocalIterator()]
    rows = spark.read.options(**source.options).parquet(*paths)
    cells = [_as_text(f).alias(f"c{i}") for i, f in enumerate(rows.schema.fields)]
    return rows.select(*cells, *metadata_columns(), F.lit(scanned.layouts[0].code).alias(LAYOUT))


def _read_workbooks(scanned: Scanned, names: list[str], source: Source) -> DataFrame:
    """A workbook cannot be split; its sheets are read by tasks that get some of all sheets each."""
    cells = [T.StructField(n, T.StringType()) for n in names]
    schema = T.StructType([*cells, *PROVENANCE.fields, T.StructField(LAYOUT, T.LongType())])
    parts = min(scanned.count, max(spread_over(scanned.tables), scanned.count // TABLES_PER_TASK))
    listed = scanned.tables.select("path", "sheet", "modified", "size", "layout")
    reader = workbook_rows(schema.names, source.header_row)
    return listed.repartition(parts, "path", "sheet").mapInArrow(reader, schema)


def read_folder(
    spark: SparkSession,
    source: Source,
    contract: TableContract,
    keep: Mapping[str, str] | None = None,
    files: DataFrame | None = None,
) -> DataFrame:
    """Stack all files of a source by column name, with the provenance of every row.

    Headers are matched to the contract per file: all files are read by position at once, and each
    row finds its columns by the header line of its own file. ``keep`` maps an internal column name
    to a source header that is not in the contract but is needed later.
    """
    files = list_files(spark, source) if files is None else files
    return stack_tables(spark, scan_headers(spark, files, source), source, contract, keep)


def wanted_columns(
    headers: Sequence[str], contract: TableContract, keep: Mapping[str, str] | None = None
) -> list[tuple[int, str]]:
    """(position, name) of the contract columns, and of the kept ones, in a header line."""
    found = header_matches(list(headers), contract)
    codes = [header_code(h) for h in headers]
    for name, header in (keep or {}).items():
        if header and header_code(header) in codes:
            found.append((codes.index(header_code(header)), name))
    return found


def stack_tables(
    spark: SparkSession,
    scanned: Scanned,
    source: Source,
    contract: TableContract,
    keep: Mapping[str, str] | None = None,
) -> DataFrame:
    """The tables found by ``scan_headers``, each cell under the contract's name for its own header."""
    places: dict[str, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
    for layout in scanned.layouts:
        for position, name in wanted_columns(layout.headers, contract, keep):
            places[name][position].append(layout.code)
    every = len(scanned.layouts)

    def cell(name: str) -> Column:
        found = None
        for position, codes in places[name].items():
            own = F.col(f"c{position}")
            if len(codes) == every:
                return own
            holds = F.col(LAYOUT).isin(*codes)
            found = F.when(holds, own) if found is None else found.when(holds, own)
        return found

    rows = _read_tables(spark, scanned, source)
    return with_file_order(
        rows.select(*[cell(name).alias(name) for name in places], *PROVENANCE.names)
    )


def profile_source(spark: SparkSession, source: Source, contract: TableContract) -> DataFrame:
    """Profile every header line found in a source: see ``profile_columns``.

    ``tables`` counts the files or sheets that share the header line; ``example`` names one.
    """
    parts = []
    scanned = scan_headers(spark, list_files(spark, source), source)
    for layout in scanned.layouts:
        rows = _read_tables(spark, scanned.only(layout), source)
        cells = rows.select(*[F.col(f"c{i}") for i in range(len(layout.headers))])
        example = layout.path.rsplit("/", 1)[-1]
        parts.append(
            profile_columns(clean_all_text(cells).toDF(*_distinct_names(layout.headers)), contract)
            .withColumn("tables", F.lit(layout.tables).cast("int"))
            .withColumn("example", F.lit(f"{example}, sheet {layout.sheet}"))
        )
    return reduce(DataFrame.unionByName, parts)


def _distinct_names(headers: tuple[str, ...]) -> list[str]:
    """Headers as column names; blanks tell repeated ones apart and do not change their code."""
    seen: dict[str, int] = defaultdict(int)
    names = []
    for header in headers:
        names.append(header + " " * seen[header.lower()])
        seen[header.lower()] += 1
    return names


def with_file_order(rows: DataFrame) -> DataFrame:
    """Add file name and file order: modification time, then name, so the greatest is newest."""
    name = F.element_at(F.split(PATH, "/"), -1)
    order = F.concat_ws("|", F.lpad(F.col(MODIFIED).cast("string"), 20, "0"), name)
    return rows.withColumns({FILE: name, FILE_ORDER: order})
