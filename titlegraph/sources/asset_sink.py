"""Assets as a sink: df.write.format('asset').option('id', i).mode('overwrite').save(folder).

Records become files of one JSON object a line, and asset.json holds the envelope: what the asset is, and how many records
it has, in all and by action. Tasks write into a folder of their own; the commit puts the envelope beside the records of the
tasks that count and renames the folder, so that all of it becomes visible at once. A write that fails leaves nothing, and
an asset that it was to replace stays.
"""

from __future__ import annotations

import datetime
import json
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark import TaskContext
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import Row, StructType

from ..storage import arrow_file

ENVELOPE = "asset.json"


@dataclass
class Written(WriterCommitMessage):
    file: str | None
    records: int
    actions: dict[str, int]


def _plain(value: object) -> object:
    if isinstance(value, Row):
        return {k: _plain(v) for k, v in value.asDict().items()}
    if isinstance(value, (list, tuple)):
        return [_plain(v) for v in value]
    if isinstance(value, dict):
        return {k: _plain(v) for k, v in value.items()}
    return value.isoformat() if isinstance(value, (datetime.date, datetime.datetime)) else value


class _Writer(DataSourceWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.options, self.overwrite = options, overwrite
        self.uri = options["path"].rstrip("/")
        self.staging = f"{self.uri}.staging-{uuid.uuid4().hex}"
        # made here, and not by tasks, so that one that is still running when a write is given up cannot bring it back
        store, folder = arrow_file(self.staging)
        store.create_dir(folder, recursive=True)

    def write(self, iterator: Iterator[Row]) -> Written:
        store, folder = arrow_file(self.staging)
        name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.json"
        records, actions = 0, Counter()
        with store.open_output_stream(f"{folder}/{name}") as out:
            for row in iterator:
                record = _plain(row)
                out.write((json.dumps(record, ensure_ascii=False, separators=(",", ":")) + "\n").encode("utf-8"))
                records += 1
                actions[str(record.get("action"))] += 1
        return Written(name, records, dict(actions))

    def commit(self, messages: list[Written]) -> None:
        from pyarrow import fs

        store, folder = arrow_file(self.staging)
        _, target = arrow_file(self.uri)
        count = {m.file for m in messages if m is not None}
        for info in store.get_file_info(fs.FileSelector(folder)):
            if info.base_name not in count:  # of a task that was run again
                store.delete_file(info.path)
        actions = sum((Counter(m.actions) for m in messages if m is not None), Counter())
        given = lambda k, other=None: self.options.get(k.lower(), other)
        envelope = {
            "id": given("id"), "source": given("source"), "assetVersion": given("assetVersion", "1"), "compiledAt": given("compiledAt") or datetime.datetime.now(datetime.UTC).isoformat(timespec="milliseconds").replace("+00:00", "Z"),
            "license": given("license"), "attribution": given("attribution"), "recordCount": sum(actions.values()), "actionCounts": dict(actions), "records": sorted(count),
        }
        with store.open_output_stream(f"{folder}/{ENVELOPE}") as out:
            out.write(json.dumps(envelope, ensure_ascii=False, indent=1).encode("utf-8"))
        old = None
        if store.get_file_info(target).type != fs.FileType.NotFound:
            if not self.overwrite:
                store.delete_dir(folder)
                raise FileExistsError(f"{self.uri} exists; mode('overwrite') replaces it")
            old = f"{target}.old-{uuid.uuid4().hex}"
            store.move(target, old)
        store.move(folder, target)
        if old is not None:
            store.delete_dir(old)

    def abort(self, messages: list[Written | None]) -> None:
        from pyarrow import fs

        store, folder = arrow_file(self.staging)
        if store.get_file_info(folder).type != fs.FileType.NotFound:
            store.delete_dir(folder)


class AssetSink(DataSource):
    """Options: path, id, source, assetVersion, compiledAt (else the time of the commit), license, attribution."""

    @classmethod
    def name(cls) -> str:
        return "asset"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return _Writer(dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(AssetSink)
