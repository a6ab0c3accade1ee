"""Objects of very large JSON files, read in parallel though a file may be one line.

Spark's text reader cuts the files at closing braces, whatever store they are
in, and deals byte ranges to tasks. Whether a brace closes an object depends on
what comes before it: on whether it stands in a string, and how deep. So a
first pass works out, for each range, what it makes of either state that it
may begin in; the ranges' results, one row each, are put together in order;
and a second pass, which knows how each range begins, gives whole objects and
the parts of those that go over a border, which are joined by their number.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_STRING_END = re.compile(r'(?:[^"\\]|\\.)*"', re.S)
_STRING = re.compile(r'"(?:[^"\\]|\\.)*"', re.S)
_MARK = re.compile(r'"(?:[^"\\]|\\.)*("|$)|\{', re.S)

#: What a range makes of the two states, outside and inside a string, that it may begin in: state, change of depth and least depth after a close; and its bytes.
RANGE = "path string, block long, size long, bytes long, pieces long, state array<int>, depth array<int>, low array<int>"
#: An object or a part of one that began in the range ``owner``.
PART = "path string, owner long, number long, block long, content string, closed boolean, whole boolean"


class Scan:
    """Goes through pieces of text that closing braces end."""

    def __init__(self, inside: bool = False, depth: int = 0):
        self.inside, self.depth, self.low = inside, depth, depth

    def opened(self, piece: str) -> list[int]:
        """Places of the opening braces of a piece that stand in no string; what the piece ends in is then known."""
        at = 0
        if self.inside:
            end = _STRING_END.match(piece)
            if not end:
                return []
            self.inside, at = False, end.end()
        places = []
        for mark in _MARK.finditer(piece, at):
            if mark[0] == "{":
                places.append(mark.start())
            elif not mark[1]:
                self.inside = True
        return places

    def closed(self) -> None:
        self.depth -= 1
        self.low = min(self.low, self.depth)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.option("lineSep", "}").option("recursiveFileLookup", True).text(path)
    return rows.select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.col("_metadata.file_size").alias("size"))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[str]]]:
    """Pieces by range, in order, a batch's at a time."""
    for batch in batches:
        values, paths, blocks, sizes = (c.to_pylist() for c in batch.columns)
        first = 0
        for i in range(1, len(values) + 1):
            if i == len(values) or (paths[i], blocks[i]) != (paths[first], blocks[first]):
                yield (paths[first], blocks[first], sizes[first]), values[first:i]
                first = i


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    small = pa.list_(pa.int32())
    schema = pa.schema([("path", pa.string()), ("block", pa.int64()), ("size", pa.int64()), ("bytes", pa.int64()), ("pieces", pa.int64()), ("state", small), ("depth", small), ("low", small)])
    now, scans, totals = None, (), [0, 0]

    def row() -> pa.RecordBatch:
        found = {"bytes": totals[0], "pieces": totals[1], "state": [int(s.inside) for s in scans], "depth": [s.depth for s in scans], "low": [s.low for s in scans]}
        return pa.RecordBatch.from_pylist([dict(zip(("path", "block", "size"), now)) | found], schema)

    for key, values in _runs(batches):
        if key != now:
            if now is not None:
                yield row()
            now, scans, totals = key, (Scan(False), Scan(True)), [0, 0]
        for value in values:
            totals[0] += len(value.encode()) + 1
            totals[1] += 1
            for scan in scans:
                scan.depth += len(scan.opened(value))
                if not scan.inside:
                    scan.closed()
    if now is not None:
        yield row()


class Start(NamedTuple):
    """How a range begins: in a string or not, how deep, in the object that began in which range, with which piece of its file; and the file's last piece, and whether that has its brace."""

    inside: bool
    depth: int
    owner: int | None
    piece: int
    last: int
    closed: bool


def starts(ranges: list, level: int) -> dict[tuple[str, int], Start]:
    """Of the rows of all ranges how each begins."""
    out, files = {}, {}
    for r in sorted(ranges, key=lambda r: (r["path"], r["block"])):
        files.setdefault(r["path"], []).append(r)
    for path, rows in files.items():
        closed, last = sum(r["bytes"] for r in rows) <= rows[0]["size"], sum(r["pieces"] for r in rows) - 1
        inside, depth, piece, owner = False, 0, 0, None
        for r in rows:
            out[path, r["block"]] = Start(inside, depth, owner, piece, last, closed)
            low, depth = depth + r["low"][inside], depth + r["depth"][inside]
            owner = None if depth < level else owner if owner is not None and low >= level else r["block"]
            inside, piece = bool(r["state"][inside]), piece + r["pieces"]
    return out


class _Objects:
    """Goes through one range and gives its objects at a level, and parts of those that began before or end after it."""

    def __init__(self, key: tuple, start: Start, level: int):
        self.path, self.block, self.start, self.level = key[0], key[1], start, level
        self.scan, self.piece = Scan(start.inside, start.depth), start.piece
        self.owner, self.number, self.texts = start.owner, -1, []

    def of(self, value: str) -> Iterator[tuple]:
        """The rows that a piece ends."""
        scan, level = self.scan, self.level
        ends = self.piece < self.start.last or self.start.closed
        before, places = scan.depth, scan.opened(value)
        text = value + "}" if ends else value
        if before + len(places) >= level:
            if before < level:
                text = text[places[level - 1 - before] :]
                self.owner, self.number, self.texts = self.block, self.piece, []
            self.texts.append(text)
        scan.depth += len(places)
        if ends and not scan.inside:
            if scan.depth == level:
                yield self.row(True)
                self.texts = []
            scan.closed()
        self.piece += 1

    def rest(self) -> Iterator[tuple]:
        if self.texts and self.scan.depth >= self.level:
            yield self.row(False)

    def row(self, closed: bool) -> tuple:
        return self.path, self.owner, self.number, self.block, "".join(self.texts), closed, closed and self.number >= 0


def objects(spark: SparkSession, path: str, level: int = 1) -> DataFrame:
    """path, number and content of each object of the files at a path that stands ``level`` braces deep: 1 are those that stand in no other one.

    number counts the pieces before an object's first one, so it is in the
    order of the file. Braces and quotes in strings, nested objects, nulls
    and objects over the border of ranges are taken as they are; an object
    that the end of its file cuts off is left out, as is all that is no
    object. A closing brace too many makes what follows shallower. Files must
    be UTF-8; an object has to fit into memory, a file doesn't. A file without
    objects gives nothing.
    """
    pieces = _pieces(spark, path)
    known = spark.sparkContext.broadcast(starts(pieces.mapInArrow(_ranges, RANGE).collect(), level))

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("path", pa.string()), ("owner", pa.int64()), ("number", pa.int64()), ("block", pa.int64()), ("content", pa.string()), ("closed", pa.bool_()), ("whole", pa.bool_())])
        now, going, rows = None, None, []
        for key, values in _runs(batches):
            if key != now:
                rows += going.rest() if going else ()
                now, going = key, _Objects(key, known.value[key[0], key[1]], level)
            for value in values:
                rows += going.of(value)
            if len(rows) > 1_000:
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], schema)
                rows = []
        rows += going.rest() if going else ()
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], schema)

    found = pieces.mapInArrow(parts, PART)
    ordered = F.array_sort(F.collect_list(F.struct("block", "content")))
    joined = found.where("NOT whole").groupBy("path", "owner").agg(F.max("number").alias("number"), F.max("closed").alias("closed"), F.array_join(F.transform(ordered, lambda p: p["content"]), "").alias("content"))
    return found.where("whole").select("path", "number", "content").unionByName(joined.where("closed").select("path", "number", "content"))
