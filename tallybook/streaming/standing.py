"""Keyed state: what a key had before a batch, held by the state store."""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator, Sequence
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Groups that a stream's keys are dealt into for the state store, whose number a checkpoint keeps for life.
CELLS = 2048
#: Keys that a part of a cell is meant to hold at most.
PART_KEYS = 1024
# A row's own columns pass through Python as text, so that no type is changed on the way.
_TEXT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
#: Settings of a stream that asks for what its keys had before: state on disk, of which a batch touches its own keys.
ON_DISK = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def _part(name: str, parts: int) -> int:
    """The part of its cell that a key is held in; ``parts`` is a power of two."""
    return zlib.crc32(name.encode()) & (parts - 1)


class _Standing(StatefulProcessor):
    """Per key, the rows that came so far and their newest time, as microseconds.

    Keys are called up a cell at a time, as every call costs several trips between Python and the store. A cell holds
    its keys in parts, of which a batch reads and writes those of its own keys; the parts are doubled before one holds
    many more than ``PART_KEYS``. A batch's rows are given back chunk by chunk with what their key had before the
    batch; none is held, so a key may fill the batch.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._parts = handle.getValueState("parts", "parts int")
        self._held = handle.getMapState("standing", "part int", "held string")

    def _load(self, part: int) -> dict[str, list]:
        return json.loads(self._held.getValue((part,))[0]) if self._held.containsKey((part,)) else {}

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        parts = self._parts.get()[0] if self._parts.exists() else 1
        held: dict[int, dict[str, list]] = {}  # what the parts that the batch touches held before it
        now: dict[str, list] = {}  # of the batch's keys, rows and newest time with it
        for chunk in rows:
            codes, names = pd.factorize(chunk["keys"])
            before = []
            for name in names:
                part = _part(name, parts)
                if part not in held:
                    held[part] = self._load(part)
                before.append(held[part].get(name, (0, None)))
                now.setdefault(name, list(before[-1]))
            tops = [now[name] for name in names]
            for code, time in zip(codes, chunk["micros"]):
                top = tops[code]
                top[0] += 1
                if time and (top[1] is None or int(time) > top[1]):
                    top[1] = int(time)
            arrived = np.array([count for count, _ in before], dtype="int64")
            newest = np.array([None if time is None else str(time) for _, time in before], dtype=object)
            yield pd.DataFrame({"row": chunk["row"], "arrived": arrived[codes], "newest": newest[codes]})
        for name, told in now.items():
            held[_part(name, parts)][name] = told
        if any(len(part) > PART_KEYS for part in held.values()):
            every = {name: told for part in range(parts) for name, told in (held[part] if part in held else self._load(part)).items()}
            while len(every) * 2 > parts * PART_KEYS:
                parts *= 2
            held = {part: {} for part in range(parts)}
            for name, told in every.items():
                held[_part(name, parts)][name] = told
        self._parts.update((parts,))
        for part, keys in held.items():
            self._held.updateValue((part,), (json.dumps(keys),))

    def close(self) -> None:
        pass


def with_standing(stream: DataFrame, keys: Sequence[str], created: str) -> DataFrame:
    """The rows with ``_arrived_before`` and ``_newest_before``: how many rows of the key earlier batches had, and the
    newest ``created`` among them.

    The stream is to be run with the settings ``ON_DISK``. Rows whose keys are null share one key.
    """
    packed = stream.select(  # names of chunks can't begin with an underscore
        F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}).alias("keys"),
        F.to_json(F.struct(*stream.columns), {**_TEXT, "ignoreNullFields": "false"}).alias("row"),
        F.unix_micros(F.col(created).cast("timestamp")).cast("string").alias("micros"),
    )
    cells = packed.withColumn("cell", F.pmod(F.xxhash64("keys"), F.lit(CELLS)).cast("int"))
    out = cells.groupBy("cell").transformWithStateInPandas(
        statefulProcessor=_Standing(),
        outputStructType="row string, arrived long, newest string",
        outputMode="append",
        timeMode="none",
    )
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in stream.schema])
    return out.select(
        F.from_json("row", schema, _TEXT).alias("_row"),
        F.col("arrived").alias("_arrived_before"),
        F.timestamp_micros(F.col("newest").cast("long")).alias("_newest_before"),
    ).select("_row.*", "_arrived_before", "_newest_before")
