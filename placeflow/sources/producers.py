"""Record producers: a caller's jobs and records as a data source of Spark, for batches and for streams."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition


class Job(InputPartition):
    def __init__(self, name: str):
        super().__init__(name)


class _Reader(DataSourceReader):
    def __init__(self, jobs, records):
        self.jobs, self.records = jobs, records

    def partitions(self) -> list[Job]:
        return [Job(j) for j in self.jobs()]

    def read(self, partition: Job) -> Iterator[tuple]:
        yield from self.records(partition.value) if partition is not None else ()


class _Stream(DataSourceStreamReader):
    """The offset is how many jobs were read. A batch is the jobs that came since, a partition one of them."""

    def __init__(self, jobs, records):
        self.jobs, self.records = jobs, records

    def initialOffset(self) -> dict:
        return {"jobs": 0}

    def latestOffset(self) -> dict:
        return {"jobs": len(self.jobs())}

    def partitions(self, start: dict, end: dict) -> list[Job]:
        return [Job(j) for j in self.jobs()[start["jobs"] : end["jobs"]]]

    def read(self, partition: Job) -> Iterator[tuple]:
        yield from self.records(partition.value)

    def commit(self, end: dict) -> None:
        pass


def record_source(name: str, schema: str, jobs: Callable[[], list[str]], records: Callable[[str], Iterable[tuple]]) -> type[DataSource]:
    """A data source to be registered (spark.dataSource.register) and read by its name.

    jobs: the names of all jobs so far, new ones last, called on the driver; records: the rows of one job, called in a task and read
    as they come, so a job may be larger than memory. Reading a job twice must give the same rows; that is how lost tasks are repeated. A stream goes on
    after the jobs that its checkpoint holds.
    """

    class Records(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return schema

        def reader(self, schema) -> DataSourceReader:
            return _Reader(jobs, records)

        def streamReader(self, schema) -> DataSourceStreamReader:
            return _Stream(jobs, records)

    return Records
