"""Positional CSV feed reader.

The header row is discarded and columns bind by position.  Nothing is inferred: every
raw column is text.  Every line or record ends up either in ``records`` or in
``rejects``, with a reason:

* ``short_record``: fewer fields than the feed's arity (S2); longer records keep their
  first N fields (S4);
* ``unterminated_quote``: a quote that is never closed.  Read line by line it costs this
  line only; read with newlines in cells the reject holds all the text up to the end of
  the quote, and how many lines that is;
* ``swallowed_records``: a cell (newlines allowed) that holds what looks like whole
  records: an unclosed quote that met the next quote of the file;
* ``escaped_quote``: a backslash before a quote in a record read with newlines in cells;
  line by line such quotes are read as the reference rule has it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from feedworks.functions.staged import worked_out
from feedworks.schemas import CORRUPT_COLUMN, raw_schema
from feedworks.sources.splits import BORDERS, FOUND, HEADER, KEEPS, RECORD, TURNS, WITHIN, borders, read

INGEST_ORDER = "_ingest_order"
REASON = "reject_reason"
LINE = "_line"
# A line is read as one cell: a separator no text should hold, and no quote.  Where a line
# holds it all the same, the reader reports the whole line as a corrupt record.
ONE_CELL = {"sep": "\u0001", "quote": "", "escape": ""}
# The first stands for an escaped backslash while a line is taken apart.  Where the text has one of the two
# itself, the second and a digit stand for it, so that it comes back as it was.
_BACKSLASH, _MARK = "\ue000", "\ue001"


@dataclass
class Feed:
    """A scanned feed: positional text records and the records rejected at read time
    (``key``, ``record``, ``lines``, ``reject_reason``).  ``tagged`` holds both, with the
    reason, for counts in one pass; null for a feed that is not read from text."""
    records: DataFrame
    rejects: DataFrame
    tagged: DataFrame | None = None


def field_count(line: Column) -> Column:
    """Fields in one raw CSV record: commas outside quoted sections, plus one.  A quote that
    is never closed runs to the end."""
    bare = F.regexp_replace(line, r'"[^"]*(?:"|$)', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + F.lit(1)


def open_quote(line: Column) -> Column:
    """Whether a quote is left open: an odd number of them (doubled ones count twice)."""
    return (F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))) % 2 == 1


def doubled_quotes(line: Column) -> Column:
    """``\\"`` as a doubled quote and ``\\\\`` as one backslash (marked until the cells are cut)."""
    own = F.replace(F.replace(line, F.lit(_MARK), F.lit(_MARK + "1")), F.lit(_BACKSLASH), F.lit(_MARK + "0"))
    marked = F.replace(own, F.lit("\\\\"), F.lit(_BACKSLASH))
    return F.replace(marked, F.lit('\\"'), F.lit('""'))


def unmarked(cell: Column) -> Column:
    """A cell with its own characters again in place of the marks of :func:`doubled_quotes`."""
    plain = F.replace(cell, F.lit(_BACKSLASH), F.lit("\\"))
    return F.replace(F.replace(plain, F.lit(_MARK + "0"), F.lit(_BACKSLASH)), F.lit(_MARK + "1"), F.lit(_MARK))


def split_lines(lines: DataFrame, columns: list[str], line: str = LINE) -> Feed:
    """S1-S5 for text that comes line by line; other columns of ``lines`` stay with the records.

    Backslash-escaped and doubled quotes are both read.
    """
    others = [c for c in lines.columns if c != line and c not in columns]
    text = lines.select(*others, F.col(line).alias("record"), doubled_quotes(F.col(line)).alias("_text"))
    reason = F.when(open_quote(F.col("_text")), F.lit("unterminated_quote")) \
        .when(field_count(F.col("_text")) < F.lit(len(columns)), F.lit("short_record"))
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    options = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "true", "mode": "PERMISSIVE"}
    cells = F.from_csv(F.col("_text"), schema.simpleString()[7:-1].replace(":", " "), options)
    tagged = (worked_out(text, **{REASON: reason}).withColumn("_cells", cells)
              .select(*others, *[unmarked(F.col(f"_cells.{c}")).alias(c) for c in columns],
                      "record", F.lit(1).alias("lines"), REASON))
    return _feed_of(tagged, columns)


def read_lines(spark: SparkSession, path, ingest_order: bool = True) -> DataFrame:
    """The lines of CSV files without their headers, in ``_line``; large files are split."""
    raw = (spark.read.schema(f"{LINE} string, {CORRUPT_COLUMN} string").option("header", True)
           .options(**ONE_CELL).option("mode", "PERMISSIVE").option("enforceSchema", True)
           .option("columnNameOfCorruptRecord", CORRUPT_COLUMN).csv(path))
    return with_order(raw, ingest_order, F.col("_metadata.file_path"), F.col("_metadata.file_block_start")) \
        .withColumn(LINE, whole_line()).drop(CORRUPT_COLUMN)


def whole_line() -> Column:
    return F.coalesce(F.col(CORRUPT_COLUMN), F.col(LINE), F.lit(""))


def with_order(df: DataFrame, wanted: bool, file: Column, block: Column) -> DataFrame:
    if not wanted:
        return df
    return df.withColumn(INGEST_ORDER, F.struct(file.alias("file"), block.alias("block"),
                                                F.monotonically_increasing_id().alias("pos")))


# A whole cell, and what leaves a quote open: quotes open a cell at its begin alone, and behind its closing
# quote all is passed over up to the next separator, as the one-task reader does.
_QUOTED = r'"[^"]*+(?:""[^"]*+)*+'
_CELL = rf'(?:[ \t]*+{_QUOTED}"[^,]*+|(?![ \t]*+")[^,]*+)'
_OPENS = rf'^(?:{_CELL},)*+[ \t]*+{_QUOTED}\z'
_STAYS_OPEN = rf'^{_QUOTED[1:]}(?:\z|"[^,]*+(?:,{_CELL})*+,[ \t]*+{_QUOTED}\z)'
# A quote between two pieces of text: only such lines need the patterns, in others every quote counts.
_STRAY = r'[^",\s]\s*"\s*[^",\s]'


def _states(df: DataFrame, part: list[str], order: str) -> DataFrame:
    """``df`` with ``s0``: whether a quote is open before a row, if none is at the begin of its part.  ``f0``
    and ``f1`` tell whether one is at the end of a row, if none (one) is at its own begin.  Rows that
    end alike whatever their begin are fixed points; between them it only matters how often it changes."""
    upto = W.partitionBy(*part).orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)
    earlier = W.partitionBy(*part).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    turns = F.when((F.col("f0") == 1) & (F.col("f1") == 0), 1).otherwise(0)
    fixed = F.when(F.col("f0") == F.col("f1"), F.struct(F.col("f0").alias("to"), F.col("_turns").alias("at")))
    df = df.withColumn("_turns", F.sum(turns).over(upto)).withColumn("_fixed", F.last(fixed, True).over(earlier))
    before = F.col("_turns") - turns
    state = F.when(F.col("_fixed").isNull(), before).otherwise(before + F.col("_fixed.to") - F.col("_fixed.at")) % 2
    return df.withColumn("s0", state).drop("_turns", "_fixed")


def _splits(borders: DataFrame) -> DataFrame:
    """One row for each split: how it begins, and the pieces in it of the record that is open at its begin
    (``head``) and of the one that is open at its end (``tail``), each under the number of the split in which
    this record begins; 0 stands for the header of the file."""
    # All columns are used behind the exchange, so that it is the same one wherever the splits are asked for.
    rows = borders.repartition("file").select(F.inline(F.array(F.struct(*borders.columns))))
    rows = _states(rows, ["file"], "block").withColumns({
        "split": F.row_number().over(W.orderBy("file", "block")), "first": F.row_number().over(W.partitionBy("file").orderBy("block")) == 1,
        "open": F.col("s0") == 1})
    case = lambda c: F.when(F.col("open"), F.col(c.format(1))).otherwise(F.col(c.format(0)))
    closes, before = case("closes{}"), W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("own", F.when(closes | ~F.col("open"), F.when(F.col("first") & ~closes, 0).otherwise(F.col("split"))))
    piece = lambda record, pos, n, text: F.struct(record.alias("record"), "split", pos.alias("pos"), n.alias("n"), text.cast("string").alias("text"))
    return rows.select("file", "block", "split", F.when(F.col("open"), WITHIN).when(F.col("first"), HEADER).otherwise(RECORD).alias("begin"),
                       F.when(F.col("open"), piece(F.last("own", True).over(before), F.lit(0).cast("long"), F.col("head_n"), F.col("head"))).alias("head"),
                       F.when((case("f{}") == 1) & F.col("own").isNotNull(),
                              piece(F.col("own"), case("tail{}_pos"), case("tail{}_n"), case("tail{}"))).alias("tail"))


def _put_together(splits: DataFrame, lines: DataFrame, max_lines: int) -> DataFrame:
    """The records that cross the borders of splits, from their pieces."""
    pieces = splits.select("file", "block", "begin", F.explode(F.array("head", "tail")).alias("piece")).where("piece.record > 0") \
        .select("file", "block", "begin", "piece.*")
    # pieces that were too long to be kept for a case that might not hold: their splits are read again
    missing = pieces.where("text IS NULL").select("file", "block", "split", "begin").distinct()
    again = _read(lines.join(F.broadcast(missing), ["file", "block"]), max_lines, True).select("split", "pos", F.col("text").alias("_found"))
    pieces = pieces.join(again, ["split", "pos"], "left").withColumn("text", F.coalesce("text", "_found"))
    pieces = pieces.withColumn("total", F.sum("n").over(W.partitionBy("record")))
    text = F.when(F.col("total") > max_lines, F.substring_index("text", "\n", 1)).otherwise(F.col("text"))
    parts = F.sort_array(F.collect_list(F.struct("split", "pos", text.alias("text")))).alias("parts")
    return pieces.groupBy("record").agg(parts, F.max("total").alias("n")).select(
        F.col("parts")[0]["split"].alias("split"), F.col("parts")[0]["pos"].alias("pos"), "n",
        F.when(F.col("n") > max_lines, F.col("parts")[0]["text"]).otherwise(F.array_join("parts.text", "\n")).alias("text"))


def _read(lines: DataFrame, max_lines: int, pieces: bool = False) -> DataFrame:
    place = F.col("split").cast("long") * 16 + F.col("begin") * 4 + F.col("code")
    found = lines.select(F.col("value").cast("binary"), place.alias("place")).mapInArrow(read(max_lines, pieces), FOUND)
    return found.withColumn("text", F.col("text").cast("string"))


def read_records(spark: SparkSession, path, columns: list[str], ingest_order: bool = True, max_lines: int = 10_000,
                 room: int = 1 << 18) -> Feed:
    """S1 / S3 with newlines in cells, for files of any size: read line by line by many tasks.

    A line begins a record where no quote is open before it.  Each line tells whether it leaves
    one open, for both cases before it, mostly by the parity of its quotes.  The lines are
    read twice, each split from its begin to its end, and no line is sorted or sent to another
    task.  The first time a split gives one row: both cases at its end, and the lines
    next to its borders that may belong to a record of the next or the last split.  Sums over the splits
    of a file tell which case holds; so the second time each split gives the records that lie
    within it, and those that cross a border are put together from the rows of the splits.
    Records and rejects are those of the one-task reader; a record of over ``max_lines`` lines
    (a quote that is never closed) is a reject with its first line and its number of lines,
    so that no task holds the rest of a file.  Of lines next to a border up to ``room`` bytes are kept
    the first time; only splits with a longer piece of a record are read a third time.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    quoted, stray, odd = F.contains("value", F.lit('"')), F.col("value").rlike(_STRAY), open_quote(F.col("value"))
    bits = F.col("value").rlike(_OPENS).cast("int") + 2 * F.col("value").rlike(_STAYS_OPEN).cast("int")
    code = F.when(~quoted, KEEPS).when(stray, bits).when(odd, TURNS).otherwise(KEEPS)
    lines = lines.withColumn("code", code)
    place = (F.col("block") * 4 + F.col("code")).alias("place")
    splits = _splits(lines.select(F.col("value").cast("binary"), place, "file").mapInArrow(borders(max_lines, room), BORDERS))
    known = F.broadcast(splits.select("file", "block", "split", "begin"))  # one row for each split
    found = _read(lines.join(known, ["file", "block"], "left"), max_lines).unionByName(_put_together(splits, lines, max_lines)) \
        .where((F.col("n") > max_lines) | (F.col("text") != ""))
    if ingest_order:
        found = found.join(F.broadcast(splits.select("split", "file", "block")), "split") \
            .withColumn(INGEST_ORDER, F.struct("file", "block", "pos"))
    schema = raw_schema(columns)
    options = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}
    long = F.when(F.col("n") > max_lines, F.struct("text", F.col("n").cast("int").alias("n")))
    cells = F.from_csv(F.when(F.col("n") <= max_lines, F.col("text")), schema.simpleString()[7:-1].replace(":", " "), options)
    raw = found.select(*[INGEST_ORDER] * ingest_order, long.alias("_long"), F.inline(F.array(cells)))  # cut once; see ``worked_out``
    cut = F.col("_long").isNotNull()
    tagged = split_records(raw, columns).tagged.withColumns({
        "record": F.when(cut, F.col("_long.text")).otherwise(F.col("record")), "lines": F.when(cut, F.col("_long.n")).otherwise(F.col("lines")),
        REASON: F.when(cut, F.lit("unterminated_quote")).otherwise(F.col(REASON))}).drop("_long")
    return _feed_of(tagged, columns)


def read_feed(spark: SparkSession, path, columns: list[str], multi_line: bool | str = False,
              ingest_order: bool = True) -> Feed:
    """Scan one or many CSV files of a feed.

    By default a record is a line: large files are split over the cluster.
    ``multi_line=True`` accepts newlines inside quoted cells, but each file is read by one
    task; ``multi_line="split"`` gives the same of files that many tasks read
    (:func:`read_records`), for reading the text twice.
    Quotes are ``"``, doubled inside a quoted cell.

    ``ingest_order`` adds a sortable ``_ingest_order`` (file path, split start, row
    position) used to make keep-first loads deterministic.
    """
    if multi_line == "split":
        return read_records(spark, path, columns, ingest_order)
    if not multi_line:
        return split_lines(read_lines(spark, path, ingest_order), columns)
    reader = (spark.read.schema(raw_schema(columns))
              .option("header", True)
              .option("multiLine", True)
              .option("quote", '"').option("escape", '"')
              .option("ignoreLeadingWhiteSpace", True)
              .option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", CORRUPT_COLUMN))
    raw = with_order(reader.csv(path), ingest_order, F.col("_metadata.file_path"), F.col("_metadata.file_block_start"))
    return split_records(raw, columns)


def split_records(raw: DataFrame, columns: list[str]) -> Feed:
    """S2 / S4 for records that the CSV source has cut into cells, newlines allowed."""
    # Spark refuses a raw CSV scan whose pruned read schema is only the corrupt
    # column (as ``count()`` on the rejects would be).  Appending an empty piece of
    # the first data column keeps that column in every read schema; the value is
    # unchanged (``concat_ws`` skips a null piece).
    line = F.concat_ws("", F.col(CORRUPT_COLUMN), F.substring(F.col(columns[0]), 1, 0))
    corrupt = F.col(CORRUPT_COLUMN).isNotNull()
    cells = F.concat_ws("\u0001", *[F.col(c) for c in columns])
    record = F.when(corrupt, line).otherwise(F.concat_ws(",", *[F.coalesce(F.col(c), F.lit("")) for c in columns]))
    inner = r"\n\s*-?[0-9]+,(?:[^\n,]*,){" + str(max(len(columns) - 2, 1)) + "}"
    reason = F.when(corrupt & open_quote(line), F.lit("unterminated_quote")) \
        .when(cells.rlike(inner), F.lit("swallowed_records")) \
        .when(F.contains(cells, F.lit('\\"')) | (corrupt & F.contains(line, F.lit('\\"'))), F.lit("escaped_quote")) \
        .when(corrupt & (field_count(line) < F.lit(len(columns))), F.lit("short_record"))
    lines = F.length(record) - F.length(F.replace(record, F.lit("\n"), F.lit(""))) + 1
    others = [c for c in raw.columns if c not in columns and c != CORRUPT_COLUMN]
    tagged = worked_out(raw, **{REASON: reason}).select(*others, *columns, record.alias("record"), lines.alias("lines"), REASON)
    return _feed_of(tagged, columns)


def _feed_of(tagged: DataFrame, columns: list[str]) -> Feed:
    others = [c for c in tagged.columns if c not in (*columns, "record", "lines", REASON)]
    records = tagged.filter(F.col(REASON).isNull()).select(*columns, *others)
    # a record that could not be cut has no key cell: what stands before the first comma
    key = F.coalesce(F.col(columns[0]), F.regexp_extract("record", r"^\s*([^,]*)", 1))
    rejects = tagged.filter(F.col(REASON).isNotNull()).select(key.alias("key"), "record", "lines", REASON)
    return Feed(records, rejects, tagged)


def from_rows(df: DataFrame, columns: list[str]) -> Feed:
    """Treat an existing text DataFrame as a feed: columns are renamed by position (an
    ``_ingest_order`` column may follow the feed's columns); there are no read rejects.

    Used when records arrive from another source (a table, a stream)."""
    renamed = df.toDF(*columns)
    empty = renamed.limit(0).select(F.lit(None).cast("string").alias("key"), F.lit(None).cast("string").alias("record"),
                                    F.lit(None).cast("int").alias("lines"), F.lit(None).cast("string").alias(REASON))
    return Feed(renamed, empty)
