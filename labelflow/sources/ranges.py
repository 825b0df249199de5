"""Read CSV files with line breaks in fields, and JSON arrays, by many tasks.

Such a file has no place where a reader may start without knowing what came
before: a line break, comma or brace may stand inside quotes. Here tasks read
ranges of the file, cut at line breaks (CSV) or closing braces (JSON), and follow
the quotes from *both* possible states. The ranges' outcomes, a few numbers each,
are put together in file order, which tells the true state at the start of each
range; then the tasks cut the records. A record that reaches over a border is put
together from its parts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelflow.operators.positions import free_name, quoted, running_total
from labelflow.storage import materialise, text_batches

#: Characters of a range's stored parts.
PART_CHARS = 1 << 20


class CsvLines:
    """Lines of a CSV file with quotes doubled inside of quotes.

    A state is whether a quoted field is open. A quote that does not start a
    field is a character like others, and so is all that follows the end of a
    quoted field up to the next comma. Empty lines outside of quotes are none.
    """

    separator, behind, glue = "\n", "", "\n"
    #: The rest of a quoted field, up to the quote that ends it.
    CLOSE = re.compile(r'[^"]*+(?:""[^"]*+)*+"')

    def start(self, unit: str) -> tuple[str, int]:
        return unit.removeprefix("﻿"), 0

    def open_at_end(self, inside: bool, depth: int) -> bool:
        return inside

    def borders(self, unit: str, inside: bool, last: str) -> tuple[list, bool, int, str]:
        """Ends of records in the unit as (place, next place, depth); the state,
        the change of depth and the last character after it."""
        blank = not inside and unit in ("", "\r")
        at = 0
        while True:
            if inside:
                closed = self.CLOSE.match(unit, at)
                if closed is None:
                    return [], True, 0, ""
                inside, at = False, unit.find(",", closed.end())
                if at < 0:
                    break
                at += 1
            quote = unit.find('"', at)
            if quote < 0:
                break
            inside = quote == 0 or unit[quote - 1] == ","
            at = quote + 1
        return ([] if blank else [(len(unit), len(unit), 0)]), False, 0, ""


class JsonElements:
    """Text up to closing braces of a file that holds an array, or one object.

    A state is whether a string is open; the depth counts brackets and braces,
    from 0 inside of the array. Elements end at commas, or the bracket, there.
    """

    separator, behind, glue = "}", "}", ""
    TOKEN = re.compile(r'"(?:[^"\\]|\\.)*+"|[\[\]{},"]|[^\s"\[\]{},]++', re.DOTALL)
    CLOSE = re.compile(r'(?:[^"\\]|\\.)*+"', re.DOTALL)

    def start(self, unit: str) -> tuple[str, int]:
        """The file's first unit without the bracket, and the depth before it."""
        text = unit.removeprefix("﻿").lstrip()
        if text.startswith("["):
            return text[1:], 0
        # One value: no depth of its commas counts.
        return text, 1 if text else -1

    def open_at_end(self, inside: bool, depth: int) -> bool:
        return inside or depth >= 0

    def borders(self, unit: str, inside: bool, last: str) -> tuple[list, bool, int, str]:
        found, depth, at = [], 0, 0
        if inside:
            closed = self.CLOSE.match(unit)
            if closed is None:
                return [], True, 0, last
            at, last = closed.end(), '"'
        for token in self.TOKEN.finditer(unit, at):
            text = token.group()
            if text == '"':
                return found, True, depth, text
            if text == "," or text == "]":
                # An empty array has no element.
                if last not in ("", ","):
                    found.append((token.start(), token.end(), depth))
            depth += (text in ("[", "{")) - (text in ("]", "}"))
            last = text[-1]
        return found, False, depth, last


_PARTS = (
    "file string, block long, part long, units array<string>, "
    "inside0 boolean, depth0 long, before0 map<long,long>, "
    "inside1 boolean, depth1 long, before1 map<long,long>"
)


def _scan(form: CsvLines | JsonElements):
    """A function for mapInArrow over (value, file, block) as read: parts of
    ranges, each with the state, the depth and the ends of records before it, for
    both states at the start of its range. The last part of a range has no
    units: it tells how the range ends."""
    schema = pa.schema(
        [
            ("file", pa.string()), ("block", pa.int64()), ("part", pa.int64()),
            ("units", pa.list_(pa.string())),
            *[
                field
                for s in "01"
                for field in (
                    (f"inside{s}", pa.bool_()), (f"depth{s}", pa.int64()),
                    (f"before{s}", pa.map_(pa.int64(), pa.int64())),
                )
            ],
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, number, chars = None, 0, 0
        units: list[str] = []
        ways: list[list] = []  # for both states: inside, depth, ends, last character

        def row() -> pa.RecordBatch:
            nonlocal number
            ways_before = begun if units else [(w[0], w[1], dict(w[2])) for w in ways]
            out = {"file": place[0], "block": place[1], "part": number, "units": list(units)}
            for s, (inside, depth, ends) in enumerate(ways_before):
                out |= {f"inside{s}": inside, f"depth{s}": depth, f"before{s}": list(ends.items())}
            number += 1
            units.clear()
            return pa.RecordBatch.from_pylist([out], schema=schema)

        begun: list[tuple] = []
        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("value", "file", "block")]
            for unit, file, block in zip(*columns):
                if place != (file, block):
                    if place is not None:
                        if units:
                            yield row()
                        yield row()
                    place, number, chars = (file, block), 0, 0
                    depth = 0
                    if block == 0:
                        unit, depth = form.start(unit)
                    last = "" if block == 0 else form.behind
                    ways = [[False, depth, Counter(), last], [True, depth, Counter(), last]]
                if not units:
                    begun = [(w[0], w[1], dict(w[2])) for w in ways]
                for way in ways:
                    found, inside, change, last = form.borders(unit + form.behind, way[0], way[3])
                    for _, _, depth in found:
                        way[2][way[1] + depth] += 1
                    way[0], way[1], way[3] = inside, way[1] + change, last
                units.append(unit)
                chars += len(unit) + 1
                if chars >= PART_CHARS:
                    yield row()
                    chars = 0
        if place is not None:
            if units:
                yield row()
            yield row()

    return run


def _resolve(form: CsvLines | JsonElements):
    """A function for mapInArrow over the ends of ranges, sorted by file and range:
    the true state, depth and number of records before each, within its file. A
    last row of each file, without a range, has all records."""
    schema = pa.schema(
        [
            ("file", pa.string()), ("block", pa.int64()), ("inside", pa.bool_()),
            ("depth", pa.int64()), ("records", pa.int64()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, inside, depth, records = None, False, 0, 0

        def end() -> dict:
            total = records + form.open_at_end(inside, depth)
            return {"file": file, "block": None, "inside": None, "depth": None, "records": total}

        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["file"] != file:
                    if file is not None:
                        out.append(end())
                    file, inside, depth, records = row["file"], False, 0, 0
                out.append(
                    {"file": file, "block": row["block"], "inside": inside, "depth": depth, "records": records}
                )
                s = int(inside)
                records += dict(row[f"before{s}"]).get(-depth, 0)
                inside, depth = row[f"inside{s}"], depth + row[f"depth{s}"]
            yield pa.RecordBatch.from_pylist(out, schema=schema)
        if file is not None:
            yield pa.RecordBatch.from_pylist([end()], schema=schema)

    return run


_RECORDS = "base long, number long, piece struct<block:long,part:long>, whole boolean, text string"


def _cut(form: CsvLines | JsonElements):
    """A function for mapInArrow over parts with their true start: records, or
    pieces of the first and the last one of a part."""
    schema = pa.schema(
        [
            ("base", pa.int64()), ("number", pa.int64()),
            ("piece", pa.struct([("block", pa.int64()), ("part", pa.int64())])),
            ("whole", pa.bool_()), ("text", pa.string()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                (row,) = batch.slice(i, 1).to_pylist()
                found = [{"base": row["base"]} | r for r in records(row)]
                yield pa.RecordBatch.from_pylist(found, schema=schema)

    def records(row: dict) -> Iterator[dict]:
        inside, depth, number = row["inside"], row["depth"], row["number"]
        if depth < 0:
            return
        last = "" if row["first"] else form.behind
        # What came before the part belongs to its first record, unless the
        # parts are lines and the one before ended its record.
        whole = row["first"] or (form.glue == "\n" and not inside)
        held: list[str] = []
        piece = {"block": row["block"], "part": row["part"]}
        for unit in row["units"]:
            unit += form.behind
            at = 0
            found, inside_after, change, last = form.borders(unit, inside, last)
            for end, following, below in found:
                if depth + below == 0:
                    held.append(unit[at:end])
                    yield {"number": number, "piece": piece, "whole": whole, "text": form.glue.join(held)}
                    held, at, whole = [], following, True
                    number += 1
            if not form.glue or (not found and (inside or inside_after)):
                held.append(unit[at:])
            inside, depth = inside_after, depth + change
            if depth < 0:  # behind the array
                return
        if held:
            yield {"number": number, "piece": piece, "whole": False, "text": form.glue.join(held)}

    return run


def read_records(
    spark: SparkSession, path: str, form: CsvLines | JsonElements, skip: int = 0
) -> DataFrame:
    """(number, record): the records' texts, numbered from 0 in the order of files
    and records; the first ``skip`` of each file are left out.

    The parts of the ranges are stored once, because the ranges of two reads
    need not be the same. Ranges are summed up per file: a file's ranges, a few
    numbers each, pass through one task. A record is never cut; an unclosed quote
    takes all that follows in the file.
    """
    lines = spark.read.option("lineSep", form.separator).text(path)
    placed = lines.select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )
    parts = materialise(text_batches(placed).mapInArrow(_scan(form), _PARTS))
    ends = parts.where(F.size("units") == 0).drop("units", "part")
    starts = materialise(
        ends.repartition("file")
        .sortWithinPartitions("file", "block")
        .mapInArrow(
            _resolve(form), "file string, block long, inside boolean, depth long, records long"
        )
    )
    totals = starts.where("block IS NULL").select(
        "file", F.greatest(F.col("records") - skip, F.lit(0)).alias("n")
    )
    bases = materialise(running_total(totals, ["file"], "n", "base"))
    true = materialise(starts.where("block IS NOT NULL").join(bases.select("file", "base"), "file"))
    own = [
        F.when(F.col("inside"), F.col(f"{n}1")).otherwise(F.col(f"{n}0")) for n in ("inside", "depth", "before")
    ]
    inside, depth, before = own
    records = F.coalesce(F.try_element_at(before, -F.col("depth")), F.lit(0).cast("long"))
    known = (
        parts.where(F.size("units") > 0)
        .join(true, ["file", "block"])
        .select(
            "block", "part", "units", inside.alias("inside"), (F.col("depth") + depth).alias("depth"),
            ((F.col("block") == 0) & (F.col("part") == 0)).alias("first"),
            (F.col("records") + records).alias("number"), "base",
        )
    )
    cut = materialise(text_batches(known).mapInArrow(_cut(form), _RECORDS))
    # Of two files with the same base, one has no records but those skipped.
    pieces = cut.where(~F.col("whole") & (F.col("number") >= skip))
    joined = (
        pieces.groupBy("base", "number")
        .agg(F.array_sort(F.collect_list(F.struct("piece", "text"))).alias("x"))
        .select("base", "number", F.array_join("x.text", form.glue).alias("text"))
    )
    whole = cut.where(F.col("whole") & (F.col("number") >= skip))
    return whole.select("base", "number", "text").unionByName(joined).select(
        (F.col("base") + F.col("number") - skip).alias("number"), "text"
    )


def _fields(parsed: DataFrame, names: Sequence[str], number: bool) -> DataFrame:
    """Columns of the struct x by place, and the number as a last column."""
    fields = [F.col(f"x.c{i}").alias(n) for i, n in enumerate(names)]
    out = parsed.select(*fields)
    return parsed.select(*fields, F.col("number").alias(free_name(out, "_number"))) if number else out


def read_csv(
    spark: SparkSession, path: str, names: Sequence[str], number: bool = False
) -> DataFrame:
    """CSV files with a header, as strings in columns of the given ``names``."""
    lines = read_records(spark, path, CsvLines(), skip=1)
    text = F.regexp_replace("text", r"\r\z", "")
    options = {
        "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
    }
    schema = ", ".join(f"c{i} string" for i in range(len(names)))
    return _fields(lines.select("number", F.from_csv(text, schema, options).alias("x")), names, number)


def read_json_array(
    spark: SparkSession, path: str, schema: T.StructType, number: bool = False
) -> DataFrame:
    """Files that hold an array of objects (or one object): fields by ``schema``."""
    elements = read_records(spark, path, JsonElements())
    parsed = elements.select("number", F.from_json("text", schema).alias("x"))
    out = parsed.select(*[F.col("x")[f.name].alias(f.name) for f in schema], "number")
    names = [f.name for f in schema]
    last = free_name(parsed.sparkSession.createDataFrame([], schema), "_number")
    out = out.toDF(*names, last)
    return out if number else out.select(*quoted(names))
