"""Saved payloads as a data source: folders of board answers and of checkpoint lines, with pushed filters.

    spark.dataSource.register(SavedBoards)
    spark.read.format("saved_boards").load(folder)      <folder>/<source>/<board>.json
    spark.dataSource.register(SavedLines)
    spark.read.format("saved_lines").load(folder)       <folder>/<name>.jsonl

Each file is a partition of its own, read where it is needed by whatever file system its path names. A filter on source,
board or name leaves partitions out before anything is read (spark.sql.python.filterPushdown.enabled must be on).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceReader, EqualNullSafe, EqualTo, Filter, In, InputPartition


def _folder(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _files(path: str, ending: str) -> list[tuple[str, ...]]:
    """The names below a folder that end so: folder and file names from there, in order."""
    from pyarrow import fs

    where, base = _folder(path)
    found = where.get_file_info(fs.FileSelector(base, recursive=True, allow_not_found=True))
    names = (f.path.removeprefix(base.rstrip("/")).strip("/") for f in found if f.type == fs.FileType.File and f.path.endswith(ending))
    return sorted(tuple(n.removesuffix(ending).split("/")) for n in names)


def _read(path: str, name: str) -> str:
    where, base = _folder(path)
    with where.open_input_stream(f"{base.rstrip('/')}/{name}") as stream:
        return stream.read().decode("utf-8", "replace")


@dataclass
class SavedFile(InputPartition):
    names: tuple[str, ...]


class _Reader(DataSourceReader):
    """Files whose names (the columns of `named`, in order) meet all pushed filters."""

    named: tuple[str, ...] = ()
    ending = ""

    def __init__(self, options):
        self.path, self.wanted = options["path"], []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            column = f.attribute[0] if isinstance(f, (EqualTo, EqualNullSafe, In)) and len(f.attribute) == 1 else None
            if column in self.named:
                some = f.value if isinstance(f, In) else (f.value,)
                self.wanted.append((self.named.index(column), {x for x in some if x is not None}))
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        found = [n for n in _files(self.path, self.ending) if len(n) == len(self.named)]
        return [SavedFile(n) for n in found if all(n[i] in some for i, some in self.wanted)]


class BoardReader(_Reader):
    named, ending = ("source", "board"), ".json"

    def read(self, partition: SavedFile) -> Iterator[tuple]:
        # (None: a folder without a file that is wanted has one empty partition)
        if partition is not None:
            yield (*partition.names, 200, _read(self.path, "/".join(partition.names) + self.ending))


class LineReader(_Reader):
    named, ending = ("name",), ".jsonl"

    def read(self, partition: SavedFile) -> Iterator[tuple]:
        if partition is not None:
            for n, line in enumerate(_read(self.path, partition.names[0] + self.ending).split("\n")):
                if line:
                    yield partition.names[0], n, line


class SavedBoards(DataSource):
    """source, board, status, body: the responses that ingest.answered() reads."""

    @classmethod
    def name(cls) -> str:
        return "saved_boards"

    def schema(self) -> str:
        return "source string, board string, status int, body string"

    def reader(self, schema) -> DataSourceReader:
        return BoardReader(self.options)


class SavedLines(DataSource):
    """name, line_no, line: the lines that ingest.checkpoint() reads."""

    @classmethod
    def name(cls) -> str:
        return "saved_lines"

    def schema(self) -> str:
        return "name string, line_no long, line string"

    def reader(self, schema) -> DataSourceReader:
        return LineReader(self.options)
