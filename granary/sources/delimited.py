"""Delimited text files."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.functions import literal, named, quoted
from granary.operators.cleaning import rename_columns
from granary.spec import SourceSpec

QUOTE = '"'
# How every text begins that can be cast to a double.
_NUMBER = r"^[\x00-\x20]*[+-]?(?:[0-9.]|(?i:nan|inf))"


def has_multi_line_records(spark: SparkSession, path: str, quote: str = QUOTE) -> bool:
    """Whether any line leaves a quote open, so that a record may go on below it.

    For use before a file is read for the first time: it reads all of it, as plain text in
    splits. With doubled quotes as escapes, a line that
    closes all it opens has an even number of them.
    """
    lines = spark.read.text(path)
    quotes = F.length("value") - F.length(F.translate("value", quote, ""))
    return lines.filter(quotes % 2 == 1).limit(1).count() > 0


def read_delimited(
    spark: SparkSession,
    path: str,
    separator: str = ",",
    schema: T.StructType | None = None,
    header: bool = True,
    infer_schema: bool = False,
    multi_line: bool = False,
    options: Mapping[str, str] | None = None,
    corrupt_column: str | None = None,
    stream: bool = False,
) -> DataFrame:
    """Read a delimited file; all columns are text unless a schema is given or inferred.

    A given schema wins over inference. With ``corrupt_column`` lines of the
    wrong shape are kept whole in that column, which Spark fills only if it is
    part of the schema; without a schema it is made from the header. ``multi_line`` takes
    records that span lines; the file is then a single task, whatever its size. ``stream``
    reads a folder as a stream of files, with the columns of those that are there already.
    """
    settings = {
        "header": str(header).lower(),
        "sep": separator,
        "encoding": "utf-8",
        "quote": QUOTE,
        "escape": QUOTE,
        **(options or {}),
    }
    settings["multiLine"] = str(multi_line).lower()
    if schema is None and infer_schema:
        settings["inferSchema"] = "true"
    if corrupt_column:
        settings |= {
            "mode": "PERMISSIVE",
            "columnNameOfCorruptRecord": corrupt_column,
            # A reader that parses only some columns takes wrong line shapes for right.
            "columnPruning": "false",
        }
    if schema is None and (corrupt_column or stream):
        schema = spark.read.options(**settings).csv(path).schema
    if corrupt_column:
        if corrupt_column not in schema.names:
            schema = T.StructType([*schema.fields, T.StructField(corrupt_column, T.StringType())])
    reader = (spark.readStream if stream else spark.read).options(**settings)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def _lines_of_splits(spark: SparkSession, path: str, quote: str) -> DataFrame:
    """Lines (value, odd, blank, size, at, origin, heads) of files read in splits.

    ``odd`` tells whether a line has an odd number of quotes, ``at`` numbers the splits. ``origin`` is
    the split in which the record began that is open where this one begins, or -1; ``heads`` holds
    1 if the first record of the file begins in this split and 2 if the open one is that. All follow
    from sums per split, over a table of one row per split: lines are not shuffled.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"
    )
    odd = (F.length("value") - F.length(F.replace("value", F.lit(quote), F.lit("")))) % 2 == 1
    blank = F.trim(F.rtrim("value", F.lit("\r"))) == ""
    lines = lines.withColumns({"odd": odd, "blank": blank, "size": F.length("value") + 1})

    place = F.monotonically_increasing_id()
    splits = lines.select("file", "block", "odd", "blank", place.alias("place")).groupBy("file", "block").agg(
        F.count_if("odd").alias("odds"),
        F.min(F.when(F.col("odd"), F.col("place"))).alias("first_odd"),
        F.min(F.when(~F.col("blank"), F.col("place"))).alias("first_filled"),
    )
    splits = splits.withColumn("at", F.row_number().over(Window.orderBy("file", "block")))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("odds").over(earlier), F.lit(0)) % 2 == 1
    begins = F.col("first_filled").isNotNull() & (F.count("first_filled").over(earlier) == 0)
    splits = splits.withColumns({"inside": inside, "begins": begins})
    # The record open at the end began here, unless the one open at the beginning goes on.
    opens = (F.col("inside") != (F.col("odds") % 2 == 1)) & (~F.col("inside") | (F.col("odds") > 0))
    heads = F.col("begins") & (F.col("odds") == 1) & (F.col("first_odd") == F.col("first_filled"))
    opened = F.when(opens, F.struct("at", heads.alias("heads")))
    splits = splits.withColumn("opened", F.when(F.col("inside"), F.last(opened, True).over(earlier)))
    facts = splits.select(
        "file", "block", "at",
        F.coalesce("opened.at", F.lit(-1)).alias("origin"),
        (F.col("begins").cast("int") + F.coalesce("opened.heads", F.lit(False)).cast("int") * 2).alias("heads"),
    )
    found = lines.join(F.broadcast(facts), ["file", "block"], "left")
    known = F.coalesce("at", F.raise_error(F.lit("files were split in another way when they were read again")).cast("int"))
    return found.select("value", "odd", "blank", "size", known.alias("at"), "origin", "heads")


_RECORDS = "value string, head boolean, origin int, at int, size bigint"


def _records_of_lines(longest: int, cut: bool):
    """What a task makes of its lines: (value, head, origin, at, size).

    These are the records that lie within a split, with no ``origin``; or, with ``cut``, the pieces
    of those that splits cut, one from each split and named by the split in which they begin. ``head``
    marks the first record of a file. Lines of a piece or record of more than ``longest``
    characters are records of their own, so that no more than that is held; such a piece has no
    value, only a size.
    """

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        kind, names = pa.string(), ("value", "head", "origin", "at", "size")
        kinds = (pa.bool_(), pa.int32(), pa.int32(), pa.int64())
        at = origin = heads = None
        # The record that is open, whether it was so where the split began, its lines and characters.
        inside, carried, held, size, head = False, False, [], 0, False

        def rows(values, heads, *piece):
            cells = [pa.array(heads, kinds[0])]
            cells += [pa.array([cell] * len(values), t) for cell, t in zip(piece or (None, None, None), kinds[1:])]
            return pa.RecordBatch.from_arrays([values, *cells], names)

        def joined(offsets, values):
            lists = pa.ListArray if pa.types.is_string(values.type) else pa.LargeListArray
            lists = lists.from_arrays(pa.array(offsets, pa.int32() if lists is pa.ListArray else pa.int64()), values)
            return pc.binary_join(lists, "\n")

        def hold(values, sizes):
            nonlocal held, size
            held.append(values)
            size += int(sizes.sum())
            if size > longest:
                lines, held = pa.concat_arrays(held), []
                if not cut:
                    yield rows(lines, [head] * len(lines))

        def close(whole):
            nonlocal held, size, carried
            text = None
            if size <= longest:
                lines = pa.concat_arrays(held)
                text = joined([0, len(lines)], lines)
            if carried or not whole:
                if cut:
                    yield rows(pa.nulls(1, kind) if text is None else text, [head], origin if carried else at, at, size)
            elif text is not None and not cut:
                yield rows(text, [head])
            held, size, carried = [], 0, False

        def follow(values, odd, blank, sizes):
            nonlocal inside, head, heads
            after = (np.cumsum(odd) + inside) % 2 == 1
            kept = (after != odd) | ~blank
            going, inside = inside, bool(after[-1])
            if not kept.all():
                values, sizes, after = values.filter(pa.array(kept)), sizes[kept], after[kept]
            ends = np.flatnonzero(~after) + 1
            start = 0
            if going:
                start = int(ends[0]) if len(ends) else len(values)
                yield from hold(values.slice(0, start), sizes[:start])
                if len(ends):
                    yield from close(True)
                ends = ends[1:]
            if len(ends):
                if not cut:
                    offsets = np.concatenate(([start], ends))
                    numbers = np.zeros(len(ends), bool)
                    numbers[0] = heads & 1
                    long = np.add.reduceat(sizes[: ends[-1]], offsets[:-1]) > longest
                    if long.any():
                        counts = np.where(long, np.diff(offsets), 1)
                        own = np.concatenate([np.arange(a, b) if far else [a] for a, b, far in zip(offsets, ends, long)])
                        offsets, numbers = np.append(own, ends[-1]), np.repeat(numbers, counts)
                    yield rows(joined(offsets, values), numbers)
                heads &= 2
                start = int(ends[-1])
            if start < len(values):
                head, heads = bool(heads & 1), heads & 2
                yield from hold(values.slice(start), sizes[start:])

        for batch in batches:
            if not batch.num_rows:
                continue
            kind = batch.schema.field("value").type
            values, odd, blank, sizes, splits, origins, marks = (batch.column(k) for k in range(7))
            odd, blank = (flags.to_numpy(zero_copy_only=False) for flags in (odd, blank))
            sizes, splits = sizes.to_numpy().astype(np.int64), splits.to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(splits)) + 1), len(splits)]
            for a, b in zip(cuts, cuts[1:]):
                if splits[a] != at:
                    if inside:
                        yield from close(False)
                    at, origin, heads = int(splits[a]), origins[int(a)].as_py(), marks[int(a)].as_py()
                    inside = carried = origin >= 0
                    head = bool(heads & 2)
                yield from follow(values.slice(a, b - a), odd[a:b], blank[a:b], sizes[a:b])
        if inside:
            yield from close(False)

    return run


def _whole_records(lines: DataFrame, longest: int) -> DataFrame:
    """Records (value, head) of the lines; only pieces of records that splits cut are shuffled."""
    within = lines.mapInArrow(_records_of_lines(longest, cut=False), _RECORDS)
    pieces = lines.mapInArrow(_records_of_lines(longest, cut=True), _RECORDS)
    whole = F.sum("size").over(Window.partitionBy("origin")) <= longest
    pieces = pieces.withColumn("whole", whole).filter(F.col("value").isNotNull())
    ordered = F.array_sort(F.collect_list(F.struct("at", "value")))
    own = F.when(~F.col("whole"), F.col("at")).alias("own")
    joined = pieces.groupBy("origin", "head", "whole", own).agg(
        F.array_join(F.transform(ordered, lambda piece: piece["value"]), "\n").alias("value")
    )
    values = F.when(F.col("whole"), F.array("value")).otherwise(F.split("value", "\n"))
    return within.select("value", "head").unionByName(joined.select(F.explode(values).alias("value"), "head"))


def read_records(
    spark: SparkSession,
    path: str,
    separator: str = ",",
    schema: T.StructType | None = None,
    header: bool = True,
    options: Mapping[str, str] | None = None,
    corrupt_column: str | None = None,
    longest: int = 1 << 24,
) -> DataFrame:
    """Read a delimited file whose records may span lines, in as many tasks as it has splits.

    Lines are read as text, and those of a record are put together wherever splits cut it; Spark
    parses whole records. All columns are text unless a schema is given. Quotes must enclose whole
    fields and be doubled within, as the standard has it; a stray one opens a field. Lines end
    with a line feed; one within quotes stays, with a carriage return before it. A record of more
    than ``longest`` characters, such as the rest of a file behind a quote left open, is not put
    together: its lines are records of their own, and those of the wrong shape are corrupt.
    """
    settings = {"sep": separator, "quote": QUOTE, "escape": QUOTE, **(options or {})}
    if settings["escape"] != settings["quote"]:
        raise ValueError("only doubled quotes can be counted")
    if schema is None:
        first = spark.read.options(**settings).option("multiLine", True).option("header", header).csv(path)
        schema = T.StructType([T.StructField(name, T.StringType()) for name in first.columns])
    settings |= {"multiLine": "true", "header": "false", "mode": "PERMISSIVE"}
    if corrupt_column:
        settings["columnNameOfCorruptRecord"] = corrupt_column
        if corrupt_column not in schema.names:
            schema = T.StructType([*schema.fields, T.StructField(corrupt_column, T.StringType())])

    records = _whole_records(_lines_of_splits(spark, path, settings["quote"]), longest)
    if header:
        records = records.filter("NOT head")
    text = F.rtrim("value", F.lit("\r"))
    text = F.when(F.col("head"), F.ltrim(text, F.lit("\ufeff"))).otherwise(text)
    return records.select(F.from_csv(text, _ddl(schema), settings).alias("row")).select("row.*")


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"{quoted(field.name)} {field.dataType.simpleString()}" for field in schema.fields)


def read_source(
    spark: SparkSession,
    path: str,
    spec: SourceSpec | None = None,
    schema: T.StructType | None = None,
    header: bool = True,
    infer_schema: bool = False,
) -> DataFrame:
    """Read a file as its spec says and rename its columns; no spec means plain CSV."""
    spec = spec or SourceSpec("")
    if spec.split:
        if infer_schema:
            raise ValueError("records put together from splits take a schema or are text")
        frame = read_records(
            spark, path, spec.separator, schema, header, options=spec.options, corrupt_column=spec.corrupt_column
        )
        return rename_columns(frame, spec.renames)
    frame = read_delimited(
        spark,
        path,
        spec.separator,
        schema=schema,
        header=header,
        infer_schema=infer_schema,
        multi_line=spec.multi_line,
        options=spec.options,
        corrupt_column=spec.corrupt_column,
    )
    return rename_columns(frame, spec.renames)


def stream_source(
    spark: SparkSession, path: str, spec: SourceSpec, files_per_batch: int | None = None
) -> DataFrame:
    """:func:`read_source` as a stream of the files of a folder, old ones first."""
    if spec.split:
        raise ValueError("records put together from splits need all lines of a file, not a stream")
    limit = {"maxFilesPerTrigger": str(files_per_batch)} if files_per_batch else {}
    frame = read_delimited(
        spark,
        path,
        spec.separator,
        multi_line=spec.multi_line,
        options={**spec.options, **limit},
        corrupt_column=spec.corrupt_column,
        stream=True,
    )
    return rename_columns(frame, spec.renames)


def kind_measures(df: DataFrame) -> dict[str, str]:
    """Aggregates in SQL that tell which text columns hold numbers only.

    They can be observed while the rows are written, where inference would read the file again.
    """
    measures = {}
    for at, column in enumerate(df.schema.fields):
        if not isinstance(column.dataType, T.StringType):
            continue
        cell = quoted(column.name)
        whole = f"{cell} RLIKE '^[+-]?[0-9]+$'"
        tests = {
            "int": f"{whole} AND try_cast({cell} AS INT) IS NOT NULL",
            "bigint": f"{whole} AND try_cast({cell} AS BIGINT) IS NOT NULL",
            # A cast that fails costs far more than this test, which every number in text passes.
            "double": f"{cell} RLIKE {literal(_NUMBER)} AND try_cast({cell} AS DOUBLE) IS NOT NULL",
        }
        measures[f"filled_{at}"] = f"count({cell})"
        for kind, test in tests.items():
            measures[f"{kind}_{at}"] = f"count(CASE WHEN {test} THEN 1 END)"
    return measures


def with_kinds(df: DataFrame, seen: Mapping[str, int]) -> DataFrame:
    """The frame with columns of numbers as numbers, by what :func:`kind_measures` found.

    A column is the narrowest of int, bigint and double that takes all its cells; one without
    cells stays text, as do dates.
    """
    cells = []
    for at, column in enumerate(df.schema.fields):
        cell, filled = named(column.name), seen.get(f"filled_{at}", 0)
        kinds = [kind for kind in ("int", "bigint", "double") if filled and seen[f"{kind}_{at}"] == filled]
        cells.append(cell.cast(kinds[0]).alias(column.name) if kinds else cell)
    return df.select(*cells)
