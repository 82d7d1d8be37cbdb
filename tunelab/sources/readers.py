"""Readers: datasets, result folders, run tables, histories, checkpoints."""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyarrow import fs as pyarrow_fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunelab import schemas
from tunelab.operators.prep import only_split
from tunelab.schemas import nan_to_null, quoted

SPLIT_COLUMN = "split"
#: Tasks that share the folders of a listing, and rows of one batch of it.
LISTING_TASKS, LISTED = 64, 10_000


def _glob(spark: SparkSession, pattern: str, folders_only: bool = False) -> list[str]:
    """Paths that match a glob on the pattern's own file system, sorted."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path) or []
    return sorted(s.getPath().toString() for s in found if s.isDirectory() or not folders_only)


def exists(spark: SparkSession, path: str) -> bool:
    return bool(_glob(spark, path))


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema: str | None = None) -> DataFrame:
    """A Parquet, ORC, JSON or CSV (with header) table."""
    reader = spark.read.schema(schema) if schema else spark.read
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.format(fmt).load(path)


def load_dataset(
    spark: SparkSession,
    path: str,
    config: str | None = None,
    split: str | None = None,
    fmt: str = "parquet",
    schema: str | None = None,
) -> DataFrame:
    """A dataset by path; ``config`` is a sub-folder and ``split`` a value of the split column.

    With the split stored as a partition folder, only that folder is read.  A
    split that is asked for and not there is an error.
    """
    df = read_table(spark, f"{path.rstrip('/')}/{config}" if config else path, fmt, schema)
    if split and SPLIT_COLUMN not in df.columns:
        raise ValueError(f"split {split!r} is missing: {path} has no column {SPLIT_COLUMN!r}")
    return only_split(df, split) if split else df


def load_first(
    spark: SparkSession, paths: Sequence[str], config: str | None = None, split: str | None = None, fmt: str = "parquet"
) -> DataFrame:
    """The first of several sources that exists, with its ``config`` folder if it has one."""
    for path in paths:
        if config and exists(spark, f"{path.rstrip('/')}/{config}"):
            return load_dataset(spark, path, config, split, fmt)
        if exists(spark, path):
            return load_dataset(spark, path, None, split, fmt)
    raise FileNotFoundError(f"none of {list(paths)} exists")


def decoded(uri: Column) -> Column:
    """File metadata holds URIs; paths are handed to readers as plain text."""
    return F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))


def folder_of(depth: int = 1) -> Column:
    """Name of the folder that holds the row's file; ``depth`` 2 is its parent.

    Of ``key=value`` the value is taken.
    """
    part = F.try_element_at(F.split(F.col("_metadata.file_path"), "/"), F.lit(-1 - depth))
    return F.regexp_replace(decoded(part), "^[^=]+=", "")


def load_prefix(spark: SparkSession, prefix: str, fmt: str = "parquet", schema: str | None = None) -> DataFrame:
    """All dataset folders whose path starts with a prefix, as one table.

    ``folder`` names the folder of each row.  The folders are handed to one
    scan, sorted, and hold together all their columns; plain files that match
    are passed over.
    """
    pattern = prefix if prefix.endswith("*") else f"{prefix}*"
    found = _glob(spark, pattern, folders_only=True)
    if not found:
        raise ValueError(f"no folder matches {pattern}")
    reader = spark.read.schema(schema) if schema else spark.read.option("mergeSchema", True)
    return reader.format(fmt).load(found).withColumn("folder", folder_of())


def load_results(
    spark: SparkSession, path: str, from_disk: bool = False, multi_folder: bool = False, split: str = "test"
) -> DataFrame:
    """Results by folder prefix, from one folder, or a split of a dataset."""
    if multi_folder:
        return load_prefix(spark, path)
    return load_dataset(spark, path) if from_disk else load_dataset(spark, path, split=split)


def _filled(field: T.StructField) -> T.StructField:
    """The field with a default for files that lack the column, as ``ALTER TABLE ... ADD COLUMN ... DEFAULT`` gives it."""
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        value = "''" if isinstance(field.dataType, T.StringType) else "X''"
    elif isinstance(field.dataType, (T.NumericType, T.BooleanType)):
        value = f"CAST(0 AS {field.dataType.simpleString()})"
    else:
        raise ValueError(f"column {field.name!r} of type {field.dataType.simpleString()} cannot be required of a run")
    return T.StructField(field.name, field.dataType, True, {"EXISTS_DEFAULT": value, "CURRENT_DEFAULT": value})


def load_run_results(
    spark: SparkSession, parent: str, required: Sequence[str] = ("label", "generated_answer"), fmt: str = "parquet"
) -> DataFrame:
    """Results below ``parent/group/run`` with their ``run_group`` and ``run_name``.

    One scan reads all runs, with the columns of all of them.  A run whose files lack a required column is left out; one whose
    values are all null stays, since a model without a single answer is wrong everywhere.  The tasks tell them apart: a second
    scan gives absent columns a default, so that a column that is null in the first scan and not in the second is
    absent.  Only counts per run come out of it, and the runs are not looked at one by one on the driver.
    """
    found = _glob(spark, f"{parent.rstrip('/')}/*/*", folders_only=True)
    everything = spark.read.option("mergeSchema", True).format(fmt).load(found) if found else None
    if everything is None or not schemas.has_columns(everything, list(required)):
        raise ValueError(f"no result folder below {parent} has the columns {list(required)}")
    where = {"run_group": folder_of(2), "run_name": folder_of(1)}
    filled = T.StructType([_filled(everything.schema[c]) for c in required])
    results = everything.select(*map(quoted, required), "_metadata").withColumns(where)
    others = spark.read.schema(filled).format(fmt).load(found).select("*", "_metadata").withColumns(where)

    def counts(rows: DataFrame, prefix: str) -> DataFrame:
        return rows.groupBy(*where).agg(*[F.count(quoted(c)).alias(f"{prefix}{i}") for i, c in enumerate(required)])

    both = counts(results, "plain").join(counts(others, "filled"), [*where])
    lacks = F.array(*[F.col(f"plain{i}") < F.col(f"filled{i}") for i in range(len(required))])
    complete = both.where(~F.array_contains(lacks, True)).select(*where)
    return results.join(complete, [*where], "left_semi").select(*map(quoted, required), *where)


def load_raw_runs(spark: SparkSession, path: str) -> DataFrame:
    """Exported run objects, one JSON object per line."""
    return spark.read.schema(schemas.RAW_RUNS).json(path)


def load_parsed_runs(spark: SparkSession, path: str) -> DataFrame:
    """The parsed run table; a missing file is an error that says what to do."""
    if not exists(spark, path):
        raise FileNotFoundError(f"no run table at {path}; export and parse the runs first")
    df = nan_to_null(read_table(spark, path, "csv", schemas.PARSED_RUNS))
    return df.withColumn("lora_rank", F.col("lora_rank").cast("int"))


def csv_cells(line: Column) -> Column:
    """Cells of a CSV line as a CSV reader sees them: commas in quotes do not cut, doubled quotes are one; outer spaces go."""
    found = F.regexp_extract_all(F.concat(F.lit(","), F.rtrim(line, F.lit("\r"))), F.lit(r',\s*("(?:[^"]|"")*"|[^,]*)'), 1)

    def plain(cell: Column) -> Column:
        bare = F.btrim(cell)
        inner = F.replace(F.substr(bare, F.lit(2), F.greatest(F.char_length(bare) - 2, F.lit(0))), F.lit('""'), F.lit('"'))
        return F.when(bare.startswith('"') & bare.endswith('"') & (F.char_length(bare) > 1), inner).otherwise(bare)

    return F.transform(found, plain)


def _read_histories(spark: SparkSession, paths: str | list[str], columns: Sequence[str]) -> DataFrame:
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    raw = (
        spark.read.schema(schema)
        .option("header", True)
        .option("pathGlobFilter", "*.csv")
        .csv(paths)
    )
    types = {schemas.STEP_COLUMN: "long", **{c: "double" for c in schemas.LOSS_COLUMNS}}
    typed = {c: quoted(c).try_cast(t) for c, t in types.items() if c in columns}
    run = F.regexp_replace(decoded(F.col("_metadata.file_name")), "\\.csv$", "")
    return nan_to_null(raw.withColumn("name", run).withColumns(typed))


def load_histories(spark: SparkSession, folder: str, columns: Sequence[str] | None = None) -> DataFrame:
    """All ``{run}.csv`` histories of a folder in one table with the run's ``name``.

    With ``columns`` all files are known to hold these columns in this order.
    Otherwise files may differ: the header of each, the line with a ``_step``
    cell, is a row of a small table, which is joined to the cells of one scan,
    so that every column is picked by its name.  Only the distinct headers reach
    the driver.  A file that cannot be read is an error.
    """
    if columns:
        return _read_histories(spark, folder, columns)
    lines = spark.read.option("pathGlobFilter", "*.csv").text(folder)
    cells = csv_cells(F.col("value"))
    path = F.col("_metadata.file_path").alias("path")
    headers = lines.select(cells.alias("columns"), path).where(F.array_contains("columns", schemas.STEP_COLUMN))
    headers = headers.groupBy("path").agg(F.min("columns").alias("columns"))
    distinct = [row["columns"] for row in headers.select("columns").distinct().collect()]
    if not distinct:
        raise FileNotFoundError(f"no histories in {folder}")
    found = sorted({column for header in distinct for column in header})
    places = [f"c{i}" for i in range(max(map(len, distinct)))]
    raw = spark.read.schema(", ".join(f"{c} string" for c in places)).option("pathGlobFilter", "*.csv").csv(folder)
    rows = raw.select(path, F.array(*places).alias("cells"))
    rows = rows.where(~F.coalesce(F.array_contains("cells", schemas.STEP_COLUMN), F.lit(False)))
    run = F.regexp_replace(decoded(F.element_at(F.split("path", "/"), -1)), "\\.csv$", "")
    named = {c: F.get("cells", F.array_position("columns", F.lit(c)).cast("int") - 1) for c in found}
    types = {schemas.STEP_COLUMN: "long", **{c: "double" for c in schemas.LOSS_COLUMNS}}
    typed = {c: value.try_cast(types[c]) if c in types else value for c, value in named.items()}
    joined = rows.join(headers, "path")
    return nan_to_null(joined.select(*[value.alias(c) for c, value in typed.items()], run.alias("name")))


def load_task_eval(spark: SparkSession, path: str) -> DataFrame:
    return nan_to_null(read_table(spark, path, "csv", schemas.TASK_EVAL))


def load_wide_benchmark(spark: SparkSession, path: str) -> DataFrame:
    """Wide benchmark export; all but ``name`` stay text until they are unpivoted."""
    return spark.read.option("header", True).csv(path)


def wide_cells(lines: DataFrame, key: str = "name") -> DataFrame:
    """(name, metric, value) of every non-empty cell of wide exports, given as CSV lines (path, value).

    The header of an export is its line with a cell ``key``; cells are named by their place in it.  No column has to be
    known beforehand, none becomes a column of a plan, and exports with different columns go together.
    """
    cut = lines.where(F.btrim("value") != "").select("path", csv_cells(F.col("value")).alias("cells"))
    is_header = F.array_contains("cells", key)
    headers = cut.where(is_header).groupBy("path").agg(F.min("cells").alias("columns"))
    rows = cut.where(~is_header).join(headers, "path")
    named = F.transform("columns", lambda c, i: F.struct(c.alias("metric"), F.get("cells", i).alias("value")))
    held = F.filter(named, lambda x: (x.metric != key) & (x.value != ""))
    name = F.get("cells", F.array_position("columns", F.lit(key)).cast("int") - 1)
    return rows.select(name.alias("name"), F.explode(held).alias("cell")).select("name", "cell.metric", "cell.value")


def load_wide_cells(spark: SparkSession, path: str) -> DataFrame:
    """The non-empty cells of the wide exports in a file or folder."""
    lines = spark.read.option("pathGlobFilter", "*.csv").text(path)
    return wide_cells(lines.select("value", F.col("_metadata.file_path").alias("path")))


def _list_in_tasks(spark: SparkSession, base: str, tasks: int, folders: bool) -> DataFrame:
    """(model_folder, path) of what lies in the folders of ``base``: their folders, or all that is in them.

    Every task lists ``base`` and then those of its folders whose name falls to it, so no list of paths passes through the
    driver, however many there are.  A folder with nothing to list gives a null path.
    """
    uri = _glob(spark, base.rstrip("/"))[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if "://" in uri:
            system, root = pyarrow_fs.FileSystem.from_uri(uri)
        else:
            system, root = pyarrow_fs.LocalFileSystem(), uri.removeprefix("file:")
        shown = uri.removesuffix(root)
        shares = [share for batch in batches for share in batch.column(0).to_pylist()]
        names, paths = [], []
        for folder in system.get_file_info(pyarrow_fs.FileSelector(root)):
            if folder.type != pyarrow_fs.FileType.Directory or zlib.crc32(folder.base_name.encode()) % tasks not in shares:
                continue
            inside = system.get_file_info(pyarrow_fs.FileSelector(folder.path))
            found = [shown + x.path for x in inside if not folders or x.type == pyarrow_fs.FileType.Directory]
            names += [folder.base_name] * max(1, len(found))
            paths += found or [None]
            if len(names) >= LISTED:
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(paths, pa.string())], names=["model_folder", "path"])
                names, paths = [], []
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(paths, pa.string())], names=["model_folder", "path"])

    return spark.range(0, tasks, 1, tasks).mapInArrow(run, "model_folder string, path string")


def list_checkpoints(spark: SparkSession, grid_dir: str, tasks: int = LISTING_TASKS) -> DataFrame:
    """Sub-folders of all model folders: ``model_folder`` and ``path``.

    A model folder without any sub-folder is listed with a null path.  The
    folder must lie where the tasks can list it: on a shared disk, HDFS or an object store.
    """
    if not exists(spark, grid_dir):
        raise ValueError(f"grid folder {grid_dir} does not exist")
    return _list_in_tasks(spark, grid_dir, tasks, folders=True)


def list_files(spark: SparkSession, base_dir: str, tasks: int = LISTING_TASKS) -> DataFrame:
    """Files one level below the output folders, without reading them; none if the folder does not exist yet."""
    if not exists(spark, base_dir):
        return spark.createDataFrame([], "path string")
    return _list_in_tasks(spark, base_dir, tasks, folders=False).where("path is not null").select("path")


def load_adapters(spark: SparkSession, grid_dir: str) -> DataFrame:
    """Adapter configs of all checkpoints: ``path`` of the checkpoint, base model and rank."""
    pattern = f"{grid_dir.rstrip('/')}/*/*/adapter_config.json"
    if not exists(spark, pattern):
        return spark.createDataFrame([], f"path string, {schemas.ADAPTER_CONFIG}")
    configs = spark.read.schema(schemas.ADAPTER_CONFIG).json(pattern, multiLine=True)
    path = F.regexp_replace(decoded(F.col("_metadata.file_path")), "/adapter_config\\.json$", "")
    return configs.select(path.alias("path"), "base_model_name_or_path", "r")


def adapters_from_json(df: DataFrame, path: str = "path", config: str = "config") -> DataFrame:
    """Adapter configs that are held as JSON text."""
    parsed = F.from_json(quoted(config), schemas.ADAPTER_CONFIG)
    return df.select(quoted(path).alias("path"), parsed.alias("c")).select("path", "c.*")
