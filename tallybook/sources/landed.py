"""Feed pages as they were landed, read as a stream whose offset is the feed's resume token.

A landing is a folder ``pages-<first>-<next>`` of page envelopes, one JSON object per line, in files that may be packed as
their names tell: the pages from token ``first`` on, of which the last is followed by token ``next``. The stream walks from landing to landing by their tokens, so pages
that come before those ahead of them wait, and its checkpoint alone tells where to go on.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from tallybook.sources.feeds import landing

#: Bytes of a file that a task holds at once, beside a line that is longer.
BLOCK = 4 << 20

_LANDING = re.compile(r"pages-(\d+)-(\d+)")


class WalkError(RuntimeError):
    """The landings don't form one walk over the feed."""


@dataclass
class _File(InputPartition):
    path: str


def _place(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


class LandedPages(DataSource):
    """Spark data source ``landed_pages`` over the folder ``path``; ``start`` names the first token, 0 by default."""

    @classmethod
    def name(cls) -> str:
        return "landed_pages"

    def schema(self) -> str:
        return "value string"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Walk(self.options["path"], int(self.options.get("start", "0")))


class _Walk(DataSourceStreamReader):
    def __init__(self, path: str, start: int):
        self.path, self.start = path, start

    def _landings(self) -> dict[int, tuple[int, str]]:
        """The token and folder that follow each token; one entry per landing, on the driver."""
        files, root = _place(self.path)
        found: dict[int, tuple[int, str]] = {}
        for folder in files.get_file_info(fs.FileSelector(root, allow_not_found=True)):
            named = _LANDING.fullmatch(folder.base_name)
            if not named:
                continue
            first, following = int(named[1]), int(named[2])
            if following <= first:
                raise WalkError(f"{folder.base_name} does not lead on")
            if files.get_file_info(f"{folder.path}/_SUCCESS").type == fs.FileType.NotFound:
                continue  # still being written
            if first in found:
                raise WalkError(f"two landings begin at token {first}")
            found[first] = following, folder.path
        return found

    def initialOffset(self) -> dict:
        return {"token": str(self.start)}

    def latestOffset(self) -> dict:
        landings, token, walked = self._landings(), self.start, set()
        while token in landings:
            walked.add(token)
            token = landings[token][0]
        across = sorted(first for first in landings if self.start <= first < token and first not in walked)
        if across:
            raise WalkError(f"the landing from token {across[0]} lies across others")
        return {"token": str(token)}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        token, last = int(start["token"]), int(end["token"])
        landings, parts = self._landings(), []
        while token < last:
            if token not in landings:
                raise WalkError(f"the landing from token {token} is gone")
            token, folder = landings[token]
            inside = _place(self.path)[0].get_file_info(fs.FileSelector(folder, recursive=True))
            parts += [_File(x.path) for x in inside if x.is_file and x.size and x.base_name[0] not in "._"]
        return sorted(parts, key=lambda part: part.path)

    def read(self, partition: _File) -> Iterator[pa.RecordBatch]:
        with _place(self.path)[0].open_input_stream(partition.path) as stream:
            for lines in _lines(stream):
                yield pa.RecordBatch.from_arrays([pa.array(lines, pa.binary()).cast(pa.string())], names=["value"])


def _lines(stream) -> Iterator[list[bytes]]:
    """The lines of a stream with something in them, a block at a time."""
    begun: list[bytes] = []  # of a line that goes beyond its block
    while block := stream.read(BLOCK):
        head, *others = block.split(b"\n")
        begun.append(head)
        if others:
            whole = [b"".join(begun), *others[:-1]]
            begun = [others[-1]]
            if lines := [line for line in whole if line.strip()]:
                yield lines
    if (line := b"".join(begun)).strip():
        yield [line]


def land(envelopes: DataFrame, path: str, first: int, following: int, items: int = 1) -> None:
    """Write the pages of up to ``items`` rows from token ``first`` up to the one that ``following`` names.

    The files are packed; readers see them once whole.
    """
    landing(envelopes, items).mode("overwrite").json(f"{path}/pages-{first}-{following}")


def follow(spark: SparkSession, path: str, start: int = 0) -> DataFrame:
    """The landed pages from token ``start`` on as a stream of one JSON text each.

    A file is read by one task. The landings since ``start`` must stay, as each batch walks their names; a batch takes
    all that can be reached from where the last one ended.
    """
    spark.dataSource.register(LandedPages)
    return spark.readStream.format("landed_pages").option("start", str(start)).load(path)
