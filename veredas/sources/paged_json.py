"""A Python data source for JSON services that take their query in the URL and answer in pages."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThanOrEqual, InputPartition
from pyspark.sql.types import StructType


@dataclass
class Page(InputPartition):
    offset: int


class PagedJsonReader(DataSourceReader):
    """Projection, range predicates and order go into the URL ($select, $where, $order); each page is one partition."""

    def __init__(self, schema: StructType, options: dict[str, str]) -> None:
        self.schema, self.options, self.where = schema, options, []

    def pushFilters(self, filters: list[Filter]):  # noqa: N802
        """Comparisons of a plain column become conditions of the service; everything else stays with Spark."""
        for f in filters:
            if isinstance(f, (GreaterThanOrEqual, EqualTo)) and len(f.attribute) == 1 and isinstance(f.value, (str, int, float)):
                sign = ">=" if isinstance(f, GreaterThanOrEqual) else "="
                value = "'" + f.value.replace("'", "''") + "'" if isinstance(f.value, str) else str(f.value)
                self.where.append(f"{f.attribute[0]} {sign} {value}")
            yield f  # services round and compare text in their own ways: Spark checks again

    def partitions(self) -> list[Page]:
        size, total = int(self.options.get("pagesize", "1000")), int(self.options.get("rows", "1000"))
        return [Page(offset) for offset in range(0, max(total, 1), size)]

    def read(self, partition: Page) -> Iterator[tuple]:
        size, total = int(self.options.get("pagesize", "1000")), int(self.options.get("rows", "1000"))
        names = [f.name for f in self.schema.fields]
        query = {"$select": ",".join(names), "$limit": min(size, total - partition.offset), "$offset": partition.offset}
        if self.where:
            query["$where"] = " AND ".join(self.where)
        if "order" in self.options:
            query["$order"] = self.options["order"]
        url = f"{self.options['path']}?{urllib.parse.urlencode(query)}"
        for attempt in range(int(self.options.get("retries", "2")) + 1):
            try:
                with urllib.request.urlopen(url, timeout=float(self.options.get("timeout", "10"))) as answer:  # noqa: S310
                    rows = json.load(answer)
                break
            except (urllib.error.URLError, TimeoutError):
                if attempt == int(self.options.get("retries", "2")):
                    raise
                time.sleep(2**attempt)
        for row in rows:
            yield tuple(None if row.get(n) is None else row[n] if isinstance(row[n], str) else json.dumps(row[n]) for n in names)


class PagedJson(DataSource):
    """``spark.read.format("paged_json").schema("a string, ...").option("rows", n).load(url)``; all columns are text."""

    @classmethod
    def name(cls) -> str:
        return "paged_json"

    def reader(self, schema: StructType) -> DataSourceReader:
        return PagedJsonReader(schema, self.options)
