"""CSV sources: explicit-schema reads, header-drift repair, yearly extracts.

Schema inference costs a full extra pass over the file and types count columns
as text when a stray word appears, so every reader here takes a declared schema.
Yearly extracts whose headers drift (case, byte-order mark, extra or reordered
columns) are read in one scan as text, and every row finds its cells through the
header of its own file, repaired by *name*: a multi-file read under one schema would
bind columns by position and silently mix them up.
"""

from __future__ import annotations

import re
from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from policypanel.sources.tables import inline_table

# Byte-order-mark forms seen at the start of a header cell.
BOM_PREFIXES = ("\ufeff", "\u00ef\u00bb\u00bf")


#: A path's scheme and slashes, which Spark's listing and its metadata column write differently (file:/// and file:/).
_SLASHES = r"^([A-Za-z][A-Za-z0-9+.-]*):/+"


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str,
             header: bool = True, sep: str = ",", mode: str = "PERMISSIVE",
             corrupt_column: str | None = None) -> DataFrame:
    """Explicit-schema CSV scan. Under PERMISSIVE a cell that does not fit its
    type becomes null and the rest of the row is kept; with ``corrupt_column``
    the raw line of such rows is kept in that extra string column."""
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    reader = spark.read.schema(schema).option("header", header).option("sep", sep) \
        .option("mode", mode)
    if corrupt_column:
        schema = T.StructType(list(schema.fields) + [T.StructField(corrupt_column, T.StringType())])
        reader = reader.schema(schema).option("columnNameOfCorruptRecord", corrupt_column)
    return reader.csv(path)


def clean_header(name: str) -> str:
    for bom in BOM_PREFIXES:
        if name.startswith(bom):
            name = name[len(bom):]
    return name.strip()


def resolve_header(columns: Sequence[str], canonical: str) -> str | None:
    """The physical column to use for ``canonical``: exact name, then a
    BOM-stripped / case-insensitive match, then the one column that is the canonical
    name behind a prefix without ASCII letters, digits or underscores (a garbled
    byte-order mark), so that ``NOT_HOUR`` never stands for ``HOUR``."""
    if canonical in columns:
        return canonical
    want = canonical.upper()
    for c in columns:
        if clean_header(c).upper() == want:
            return c
    garbled = [c for c in columns if clean_header(c).upper().endswith(want)
               and not re.search(r"[A-Za-z0-9_]", clean_header(c)[:-len(want)])]
    return garbled[0] if len(garbled) == 1 else None


def normalise_header(df: DataFrame, canonical: Mapping[str, T.DataType | str] | Sequence[str],
                     missing: str = "null") -> DataFrame:
    """Select the canonical columns in canonical order, repaired by name and cast
    with ``try_cast`` (text that does not fit becomes null). A canonical column
    absent from the file becomes a typed null (``missing="null"``) or raises."""
    if not isinstance(canonical, Mapping):
        canonical = {c: None for c in canonical}
    cols = []
    for name, dtype in canonical.items():
        src = resolve_header(df.columns, name)
        if src is None:
            if missing != "null":
                raise ValueError(f"column {name!r} not found in {df.columns}")
            cols.append(F.lit(None).cast(dtype or "string").alias(name))
            continue
        c = F.col(f"`{src}`")
        cols.append((c.try_cast(dtype) if dtype is not None else c).alias(name))
    return df.select(*cols)


def split_header(line: str, sep: str = ",") -> list[str]:
    """The cells of a header line (quotes as CSV has them)."""
    import csv as text
    return next(text.reader([line], delimiter=sep), [])


def first_lines(spark: SparkSession, paths: Sequence[str]) -> dict[str, str]:
    """The first line of each file, read by the driver through Spark's own file systems: no Spark job, no full file."""
    from concurrent.futures import ThreadPoolExecutor

    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def first(path: str) -> str:
        at = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(path))
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(at)
        stream = at.getFileSystem(conf).open(at)
        try:
            if codec is not None:
                stream = codec.createInputStream(stream)
            line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
        finally:
            stream.close()
        return line or ""

    if not paths:
        return {}
    with ThreadPoolExecutor(max_workers=min(16, len(paths))) as pool:
        return dict(zip(paths, pool.map(first, paths)))


def header_positions(columns: Sequence[str], canonical: Collection[str], optional: Collection[str] = (),
                     where: str = "") -> list[int | None]:
    """Where each canonical column stands in a file with the header ``columns``; None if it is absent and ``optional``, else an error."""
    lost = [c for c in canonical if c not in optional and resolve_header(columns, c) is None]
    if lost:
        raise ValueError(f"{where} lacks {lost}; its columns are {list(columns)}")
    found = [resolve_header(columns, c) for c in canonical]
    return [None if f is None else list(columns).index(f) for f in found]


def read_yearly(spark: SparkSession, paths: Mapping[int, str] | Sequence[str],
                canonical: Mapping[str, T.DataType | str], sep: str = ",",
                optional: Collection[str] = ()) -> DataFrame:
    """One frame from yearly CSV extracts with drifting headers, in one scan however many files there are.

    Every file's header line gives a map from canonical column to position (repaired by name, see ``resolve_header``); files
    with the same header share a layout. One CSV scan then reads all files with cells by position, as text,
    and each row takes its cells through its own file's layout (``_metadata.file_path``, joined to the list of
    files, which the driver holds and so is broadcast) and casts them with ``try_cast``. A file without a canonical
    column raises, unless the column is ``optional`` (then null in its rows). Files without any line are skipped.
    """
    roots = [paths[y] for y in sorted(paths)] if isinstance(paths, Mapping) else list(paths)
    files = sorted(spark.read.text(roots).inputFiles()) if roots else []
    headers = {f: split_header(line, sep) for f, line in first_lines(spark, files).items() if line}
    layouts: dict[tuple, int] = {}
    for f, h in headers.items():
        layouts.setdefault(tuple(header_positions(h, canonical, optional, f)), len(layouts))
    of_file = [(f, layouts[tuple(header_positions(h, canonical, optional, f))]) for f, h in headers.items()]
    empty = T.StructType([T.StructField(n, T._parse_datatype_string(t) if isinstance(t, str) else t) for n, t in canonical.items()])
    if not of_file:
        return spark.createDataFrame([], empty)
    width = max(len(h) for h in headers.values())
    cells = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(width)])
    # a row longer or shorter than the widest header keeps its cells by position; the header is skipped, not matched
    raw = (spark.read.schema(cells).option("header", True).option("sep", sep).option("enforceSchema", True)
           .csv(roots).select("*", F.regexp_replace("_metadata.file_path", _SLASHES, "$1:/").alias("__file")))
    known = inline_table(spark, [(re.sub(_SLASHES, r"\1:/", f), k) for f, k in of_file], "__file string, __layout int")
    rows = raw.join(known, "__file")

    def column(k: int, name: str, dtype: T.DataType | str) -> Column:
        # layouts that keep the column in the same place share a branch
        by_place: dict[int, list[int]] = {}
        for positions, layout in layouts.items():
            if positions[k] is not None:
                by_place.setdefault(positions[k], []).append(layout)
        if not by_place:
            return F.lit(None).cast(dtype or "string").alias(name)
        cell = F
        for place, ids in by_place.items():
            cell = cell.when(F.col("__layout").isin(ids), F.col(f"_c{place}"))
        return (cell.try_cast(dtype) if dtype is not None else cell).alias(name)

    return rows.select(*[column(k, n, t) for k, (n, t) in enumerate(canonical.items())])


def split_rejects(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str, store: str,
                  header: bool = True, sep: str = ",") -> tuple[DataFrame, DataFrame]:
    """One read of a CSV source, split into good rows and a reject table.

    Good rows fit the schema in every cell. The reject table has one row per cell that does not fit its
    column's type, ``file, column, value, line`` with the raw line, and one with a null column
    and value per line that has too many or too few cells. The parsed rows are
    written once below ``store``, good and rejected apart, and both results read from there, so the source is not read again.
    ``read_csv`` keeps the rejected rows with null cells instead.
    """
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    names = [f.name for f in schema.fields]
    line = "__line"
    raw = read_csv(spark, path, schema, header, sep, corrupt_column=line).select("*", F.col("_metadata.file_path").alias("__file"))
    text = T.StructType([T.StructField(f"_{i}", T.StringType()) for i in range(len(names))] + [T.StructField("__rest", T.StringType())])
    # only the lines that do not fit are parsed again, as text, to name the cell
    cells = F.when(F.col(line).isNotNull(), F.from_csv(line, text.simpleString()[7:-1].replace(":", " "), {"sep": sep, "mode": "PERMISSIVE"}))
    misfits = F.array_compact(F.array(*[
        F.when(F.col("__cells")[f"_{i}"].isNotNull() & F.col(n).isNull(), F.struct(F.lit(n).alias("column"), F.col("__cells")[f"_{i}"].alias("value")))
        for i, n in enumerate(names)]))
    none = F.array(F.struct(F.lit(None).cast("string").alias("column"), F.lit(None).cast("string").alias("value")))
    tagged = raw.select("*", cells.alias("__cells")).select(
        *names, "__file", line, F.col(line).isNull().alias("__good"),
        F.when(F.col(line).isNull(), F.lit(None)).when(F.size(misfits) > 0, misfits).otherwise(none).alias("__misfits"))
    tagged.write.partitionBy("__good").parquet(store)
    stored = spark.read.schema(tagged.schema).parquet(store)
    good = stored.where("__good").select(*names)
    rejects = stored.where("NOT __good").select(
        F.col("__file").alias("file"), F.inline("__misfits"), F.col(line).alias("line"))
    return good, rejects.select("file", "column", "value", "line")
