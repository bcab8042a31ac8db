"""F2 on a stream: the consultation number from one counter per patient.

State per patient is the number and the date of the last consultation, whatever
their count. Patients are dealt to ``BUCKETS`` by the hash of their key, and the
state of a bucket's patients is one value: a micro-batch reads and writes it once
a bucket instead of once a patient. A micro-batch numbers a patient's rows in the
order of the batch operator: contact date, then every other column, nulls last.

Late rows: a row dated before the last numbered consultation of its patient
cannot take its place any more, as the numbers after it are out. It comes out
without a number and with ``late`` true, as does a row without a date (its place
is known at no time); numbers that are out never change. Rows of one date that
come in different micro-batches are numbered in the order they come.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from consult import schema as S

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


#: Groups of patients that share a state value.
BUCKETS = 1024


class _Numbers(StatefulProcessor):
    def __init__(self, columns: list[str], key: str, key_type: str, date: str):
        self.columns, self.key, self.key_type, self.date = columns, key, key_type, date

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", f"patients array<struct<patient: {self.key_type}, number: bigint, micros: bigint>>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803 - the interface's names
        held = {p: (n, t) for p, n, t in self.last.get()[0]} if self.last.exists() else {}
        names = [*self.columns, "consultation_number", "late"]
        at, me = self.columns.index(self.date), self.columns.index(self.key)
        rest = [i for i in range(len(self.columns)) if i != at]
        own = [tuple(r)[1:] for r in rows]  # the columns, then the time
        own.sort(key=lambda q: (q[-1] is None, q[-1] or 0, [(q[i] is None, q[i] if q[i] is not None else 0) for i in rest]))
        changed = False
        for q in own:
            time = q[-1]
            number, date = held.get(q[me], (0, None))
            late = time is None or (date is not None and time < date)
            if not late:
                number += 1
                held[q[me]] = (number, time)
                changed = True
            yield Row(**dict(zip(names, (*q[:-1], None if late else number, late), strict=True)))
        if changed:
            self.last.update(([(p, n, t) for p, (n, t) in held.items()],))

    def close(self) -> None:
        pass


@contextmanager
def state_store(spark: SparkSession):
    """Keyed state needs the RocksDB store; the session's setting comes back afterwards."""
    was = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        if was is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, was)


def number_consultations(stream: DataFrame, key: str = S.PSEUDO_ID, date: str = S.CONTACT_DATE) -> DataFrame:
    """``stream`` with consultation_number (BIGINT) and late (BOOLEAN); start it within ``state_store``."""
    columns = stream.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stream.schema.fields)
    timed = stream.withColumn("__time", F.unix_micros(F.col(date).cast("timestamp")))
    bucketed = timed.select(F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int").alias("__bucket"), *columns, "__time")
    return bucketed.groupBy("__bucket").transformWithState(
        _Numbers(columns, key, stream.schema[key].dataType.simpleString(), date), f"{schema}, consultation_number bigint, late boolean", "Append", "None")
