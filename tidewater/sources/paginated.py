"""A data source that reads numbered pages."""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType


def page_of_folder(root: str, number: int) -> list[dict]:
    """Fetch a page that lies as JSON lines below `root/page=<number>`; no folder means no page."""
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(root)
    files = system.get_file_info(fs.FileSelector(f"{path}/page={number}", allow_not_found=True))
    rows = []
    for f in files:
        if f.base_name.endswith(".json"):
            with system.open_input_stream(f.path) as source:
                rows += [json.loads(line) for line in source.read().decode().splitlines() if line]
    return rows


def page_numbers(root: str) -> list[int]:
    """The numbers of all pages below `root`, in order; an empty or missing page ends nothing."""
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(root)
    names = [f.base_name for f in system.get_file_info(fs.FileSelector(path, allow_not_found=True))]
    return sorted(int(n.removeprefix("page=")) for n in names if n.startswith("page=") and n.removeprefix("page=").isdigit())


class Pages(InputPartition):
    def __init__(self, numbers: list[int]):
        self.numbers = numbers


class PagedReader(DataSourceReader):
    def __init__(self, root: str, per_task: int, columns: list[str]):
        self.root, self.per_task, self.columns = root, per_task, columns

    def partitions(self) -> list[InputPartition]:
        numbers = page_numbers(self.root)
        return [Pages(numbers[i : i + self.per_task]) for i in range(0, len(numbers), self.per_task)]

    def read(self, partition: Pages) -> Iterator[tuple]:
        for number in partition.numbers:
            for row in page_of_folder(self.root, number):
                yield tuple(row.get(c) for c in self.columns)


class PagedSource(DataSource):
    """`spark.read.format("pages").schema(...).option("root", ...).load()`; tasks fetch a few pages each."""

    @classmethod
    def name(cls) -> str:
        return "pages"

    def reader(self, schema: StructType) -> DataSourceReader:
        return PagedReader(self.options["root"], int(self.options.get("pagespertask", "4")), schema.fieldNames())
