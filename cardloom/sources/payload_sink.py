"""Parts as files: for each part a JSON payload with its envelope and a CSV table, written by a data source with a commit.

Spark makes every line (JSON and CSV text of envelopes and records) and sorts them to their parts; the writer's tasks only put
them into files, one record at a time, under names of their own, and the commit gives all files their final names.  A task that fails or runs
twice leaves no half-written part.  A part without records has a payload without voters and a table of a header alone.  A part is one
file and so is written by one task, as its readers expect; memory does not grow with it."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from cardloom.operators.store import record_order
from cardloom.schema import FULL, PAYLOAD, PUBLIC
from cardloom.sources.many_files import file_system

#: What the sink takes: the part's folder, and lines in order: first the envelope with the header, then records.
LINES = "path string, json string, csv string"


@dataclass
class Moved(WriterCommitMessage):
    """What a task has written: the manifest that names its files, which stays in the sink's folder until the commit.  The names themselves would
    reach the driver all at once."""

    root: str
    manifest: str | None = None

    @property
    def files(self) -> list[tuple[str, str]]:
        """(written name, final name) of the files of the task."""
        if self.manifest is None:
            return []
        with file_system(self.root)[0].open_input_stream(self.manifest) as f:
            return [tuple(names) for names in json.loads(f.read())]


class PartPayloads(DataSource):
    """Option: path, the folder below which parts have theirs."""

    @classmethod
    def name(cls) -> str:
        return "part_payloads"

    def schema(self) -> str:
        return LINES

    def writer(self, schema, overwrite: bool) -> PartWriter:
        return PartWriter(self.options["path"])


class PartWriter(DataSourceWriter):
    def __init__(self, root: str) -> None:
        self.root = root

    def write(self, iterator: Iterator) -> Moved:
        system, root = file_system(self.root)
        files, open_, part, first = [], [], None, True
        attempt = uuid.uuid4().hex
        manifest = f"{root}/.files-{attempt}"

        def close() -> None:
            if open_:
                open_[0].write(b"\n]}\n")
                for f in open_:
                    f.close()
                open_.clear()

        try:
            for row in iterator:
                if row.path != part:
                    close()
                    part, first = row.path, True
                    names = [(f"{root}/{part}/{kind}/.voters-{attempt}", f"{root}/{part}/{kind}/voters.{kind}") for kind in ("json", "csv")]
                    for name, _ in names:
                        system.create_dir(name.rsplit("/", 1)[0])
                        open_.append(system.open_output_stream(name))
                        files.append((name, dict(names)[name]))
                    envelope = row.json[:-1]  # its closing brace comes after the records
                    open_[0].write((envelope + (", " if len(envelope) > 1 else "") + '"voters": [').encode())
                else:
                    open_[0].write(("\n" if first else ",\n").encode() + row.json.encode())
                    first = False
                open_[1].write((row.csv + "\n").encode())
            close()
            if files:
                with system.open_output_stream(manifest) as f:
                    f.write(json.dumps(files).encode())
        except BaseException:
            for f in open_:
                f.close()
            _deleted(system, [*(written for written, _final in files), manifest])
            raise
        return Moved(self.root, manifest if files else None)

    def commit(self, messages: list) -> None:
        system, _ = file_system(self.root)
        for m in messages:
            for written, final in m.files if m else ():
                system.move(written, final)
        _deleted(system, [m.manifest for m in messages if m and m.manifest])

    def abort(self, messages: list) -> None:
        system, _ = file_system(self.root)
        for m in messages:
            if m and m.manifest and _is_file(system, m.manifest):
                _deleted(system, [*(written for written, _final in m.files), m.manifest])


def _is_file(system: fs.FileSystem, name: str) -> bool:
    return system.get_file_info(name).type == fs.FileType.File


def _deleted(system: fs.FileSystem, names: list[str]) -> None:
    """Delete those of the files that are there."""
    for name in names:
        if _is_file(system, name):
            system.delete_file(name)


def full_records(records: DataFrame) -> list:
    """Columns of records in export form: all fields in their order, missing ones null, confidences to four places."""
    have = set(records.columns)
    out = []
    for f in FULL.fields:
        c = F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType)
        if f.name == "confidence":
            c = F.bround(c, 4)
        elif f.name == "boundingBoxes" and f.name in have:
            c = F.transform(c, lambda t: F.struct(t["text"].alias("text"), F.bround(t["confidence"], 4).alias("confidence"), t["bbox"].alias("bbox")))
        out.append(c.cast(f.dataType).alias(f.name))
    return out


def part_lines(records: DataFrame, parts: DataFrame, key: str = "path") -> DataFrame:
    """LINES of parts (key, and what of the envelope they have) and their records (key and fields), sorted to them.  Records of no part
    that is given are left out."""
    envelope = [f for f in PAYLOAD.fields if f.name != "voters" and f.name in parts.columns]
    options = {"ignoreNullFields": "false"}
    heads = parts.dropDuplicates([key]).select(F.col(key).alias("path"), F.lit(0).alias("_kind"), F.to_json(F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in envelope]), options).alias("json") if envelope else F.lit("{}").alias("json"), F.lit(",".join(PUBLIC.fieldNames())).alias("csv"))
    full = records.select(F.col(key).alias("path"), *full_records(records))
    lines = full.join(heads.select("path"), "path", "left_semi").select("path", F.lit(1).alias("_kind"), F.to_json(F.struct(*FULL.fieldNames()), options).alias("json"), F.to_csv(F.struct(*PUBLIC.fieldNames()), {"escape": '"'}).alias("csv"), "serialNo", "page")
    whole = heads.unionByName(lines, allowMissingColumns=True)
    return whole.repartition("path").sortWithinPartitions("path", "_kind", *record_order(), "json").select("path", "json", "csv")


def write_parts(records: DataFrame, parts: DataFrame, folder: str, key: str = "path") -> None:
    """Write the files of all parts below a folder.  key: the folder of each part below it."""
    records.sparkSession.dataSource.register(PartPayloads)
    part_lines(records, parts, key).write.format("part_payloads").option("path", folder).mode("append").save()

