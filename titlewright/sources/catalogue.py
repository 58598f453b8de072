"""A catalogue that is read in pages, as a data source of Spark's: filters are pushed into the request, and paging stops by rule."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThanOrEqual, InputPartition

#: No catalogue serves more pages of one query than this.
MOST_PAGES = 500
_PARAMS = {("media_type", EqualTo): "media_type", ("origin_country", EqualTo): "with_origin_country", ("vote_count", GreaterThanOrEqual): "vote_count.gte"}


def pages_in(path: str) -> Callable[[dict, int], dict]:
    """A catalogue that is a folder of answers, page-1.json and so on; each has results and total_pages. What a server would
    leave out by the parameters, this leaves out."""
    from pyarrow import fs

    system, root = fs.FileSystem.from_uri(f"file://{path[5:]}" if path.startswith("file:/") and not path.startswith("file://") else path)

    def fetch(params: dict, page: int) -> dict:
        with system.open_input_stream(f"{root}/page-{page}.json") as f:
            got = json.loads(f.read())
        fits = lambda r: params.get("media_type") in (None, r["media_type"]) and params.get("with_origin_country") in (None, r["origin_country"]) and r["vote_count"] >= params.get("vote_count.gte", 0)
        return got | {"results": [r for r in got["results"] if fits(r)]}

    return fetch


class _Reader(DataSourceReader):
    """One partition: a page tells whether there is another, so a query's pages come one after the other."""

    def __init__(self, fetch: Callable[[dict, int], dict], target: int | None):
        self.fetch, self.target, self.params = fetch, target, {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        for f in filters:
            name = _PARAMS.get((f.attribute[0], type(f))) if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if name and name not in self.params:
                self.params[name] = f.value
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(0)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        page, seen = 1, set()
        while page <= MOST_PAGES and (self.target is None or len(seen) < self.target):
            got = self.fetch(self.params, page)
            for r in got["results"]:
                if r["id"] not in seen:
                    seen.add(r["id"])
                    yield r["id"], r["media_type"], r["origin_country"], r["vote_count"], page
            if page >= got["total_pages"]:
                break
            page += 1


class PagedCatalogue(DataSource):
    """spark.read.format("titlewright_pages").option("path", ...).option("target", ...): tmdb_id, media_type, origin_country,
    vote_count and page. Equality with media_type and origin_country and a least vote_count go into the request; a target ends
    the paging with the page that reaches it. Another catalogue overrides fetch."""

    @classmethod
    def name(cls) -> str:
        return "titlewright_pages"

    def schema(self) -> str:
        return "tmdb_id bigint, media_type string, origin_country string, vote_count bigint, page int"

    def fetch(self) -> Callable[[dict, int], dict]:
        return pages_in(self.options["path"])

    def reader(self, schema) -> _Reader:
        return _Reader(self.fetch(), int(self.options["target"]) if "target" in self.options else None)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PagedCatalogue)
