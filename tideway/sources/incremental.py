"""Incremental scans: rows past a stored high watermark.

The bound is the stored watermark, else the initial value, else none. Comparison is strict
by default (rows that share the last value and come later are skipped); inclusive reads the
last value again, which a keyed merge makes harmless. Rows without a cursor value are read
only where there is no bound. The new watermark is observed on the pass that writes the rows
and stored after the write, so that a crash in between reads again but never skips.

A stored watermark has the type of its cursor. An instant (timestamp) is stored as microseconds
in UTC, so that no session's time zone changes it, and a cursor of another type than the stored
one is an error.
"""

import datetime as dt
import json
from dataclasses import dataclass
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..storage import Versions

_EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.UTC)


class WatermarkError(ValueError):
    """A stored watermark that does not fit the cursor."""


def as_state(value: Column, kind: T.DataType) -> Column:
    """A cursor value as the text that is stored: microseconds in UTC for an instant, hex digits for bytes, the text of the value for any other type."""
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value).cast("string")
    if isinstance(kind, T.BinaryType):
        return F.hex(value)
    return value.cast("string")


def from_state(text: str, kind: T.DataType) -> Column:
    """The inverse of as_state, as a literal."""
    if isinstance(kind, T.TimestampType):
        return F.timestamp_micros(F.lit(int(text)))
    if isinstance(kind, T.BinaryType):
        return F.unhex(F.lit(text))
    return F.lit(text).cast(kind)


def from_user(text: str, kind: T.DataType) -> Column:
    """A bound that a user has written, as a literal. An instant without an offset is in UTC."""
    if isinstance(kind, T.TimestampType):
        at = dt.datetime.fromisoformat(text.strip())
        at = at if at.tzinfo else at.replace(tzinfo=dt.UTC)
        return F.timestamp_micros(F.lit((at - _EPOCH) // dt.timedelta(microseconds=1)))
    return F.lit(text).cast(kind)


@dataclass(frozen=True)
class Watermark:
    """A stored watermark: the text of as_state, and the cursor's type."""

    value: str
    kind: str

    def column(self, kind: T.DataType) -> Column:
        if kind.simpleString() != self.kind:
            raise WatermarkError(f"the stored watermark is of type {self.kind}, the cursor of type {kind.simpleString()}")
        return from_state(self.value, kind)

    def __str__(self) -> str:
        """As a user would write it."""
        if self.kind != "timestamp":
            return self.value
        return (_EPOCH + dt.timedelta(microseconds=int(self.value))).isoformat(" ")


@dataclass(frozen=True)
class Incremental:
    cursor: str
    initial: str | None = None
    inclusive: bool = False
    ordered: bool = False

    def _bound(self, kind: T.DataType, resume: "str | Watermark | None") -> Column | None:
        if isinstance(resume, Watermark):
            return resume.column(kind)
        text = resume if resume is not None else self.initial
        return None if text is None else from_user(str(text), kind)

    def apply(self, df: DataFrame, resume: "str | Watermark | None" = None) -> DataFrame:
        """The new rows of df. The bound (a stored watermark, or a user's text) is a literal of the cursor's type, so that the filter reaches the scan."""
        bound = self._bound(df.schema[self.cursor].dataType, resume)
        cursor = F.col(f"`{self.cursor}`")
        if bound is not None:
            df = df.filter(cursor >= bound if self.inclusive else cursor > bound)
        return df.orderBy(cursor.asc_nulls_last()) if self.ordered else df

    def observe(self, df: DataFrame) -> tuple[DataFrame, Observation]:
        """df with an observation of rows and the greatest cursor value, as it is stored."""
        seen = Observation()
        greatest = as_state(F.max(f"`{self.cursor}`"), df.schema[self.cursor].dataType)
        return df.observe(seen, F.count(F.lit(1)).alias("rows"), greatest.alias("watermark")), seen


class StateTable:
    """Watermarks by name: a folder for each, with a numbered file for every stored one. The last stored one counts."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _versions(self, name: str) -> Versions:
        return Versions(self.spark, f"{self.path}/{quote(name, safe='')}")

    def read(self, name: str) -> Watermark | None:
        _, text = self._versions(name).last()
        if not text:
            return None
        state = json.loads(text)
        if state["type"] == "timestamp" and state.get("form") != "utc":
            raise WatermarkError(f"the watermark of {name} was stored as text without a zone: {state['value']}; store it again with its instant")
        return Watermark(state["value"], state["type"])

    def store(self, name: str, mark: Watermark | None) -> None:
        """Store a watermark; a run that saw no cursor value leaves the last one as it was. Writers at one time each get a number."""
        if mark is None:
            return
        versions = self._versions(name)
        while not versions.commit(versions.last()[0] + 1, json.dumps({"value": mark.value, "type": mark.kind, "form": "utc"})):
            pass
