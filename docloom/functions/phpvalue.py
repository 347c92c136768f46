"""Decoder for PHP ``serialize()`` values, used by an Arrow UDF."""

from __future__ import annotations

import json
import math
import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F, types as T

# Ship the decoder with the task: executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class _Reader:
    """Reads one value after another from UTF-8 bytes; string lengths are in bytes."""

    def __init__(self, data: bytes):
        self.data = data
        self.at = 0

    def until(self, mark: bytes) -> bytes:
        end = self.data.index(mark, self.at)
        found = self.data[self.at : end]
        self.at = end + len(mark)
        return found

    def expect(self, mark: bytes) -> None:
        if not self.data.startswith(mark, self.at):
            raise ValueError(f"expected {mark!r} at {self.at}")
        self.at += len(mark)

    def quoted(self) -> str:
        size = int(self.until(b":"))
        self.expect(b'"')
        if size < 0 or self.at + size > len(self.data):
            raise ValueError("string length out of range")
        raw = self.data[self.at : self.at + size]
        self.at += size
        self.expect(b'"')
        return raw.decode("utf-8")

    def entries(self) -> list[tuple[object, object]]:
        count = int(self.until(b":"))
        if count < 0:
            raise ValueError("negative count")
        self.expect(b"{")
        found = []
        for _ in range(count):
            key = self.value()
            if isinstance(key, bool) or not isinstance(key, (int, str)):
                raise ValueError("array keys are integers or strings")
            found.append((key, self.value()))
        self.expect(b"}")
        return found

    def value(self) -> object:
        kind = self.data[self.at : self.at + 1]
        self.at += 1
        if kind == b"N":
            self.expect(b";")
            return None
        self.expect(b":")
        if kind == b"b":
            flag = self.until(b";")
            if flag not in (b"0", b"1"):
                raise ValueError("bad boolean")
            return flag == b"1"
        if kind == b"i":
            return int(self.until(b";"))
        if kind == b"d":
            number = float(self.until(b";"))
            # JSON has no NAN or INF.
            return number if math.isfinite(number) else None
        if kind == b"s":
            text = self.quoted()
            self.expect(b";")
            return text
        if kind == b"a":
            items = self.entries()
            if [key for key, _ in items] == list(range(len(items))):
                return [item for _, item in items]
            return {str(key): item for key, item in items}
        if kind == b"O":
            self.quoted()
            self.expect(b":")
            # Private and protected names carry a NUL-delimited scope.
            return {str(key).rsplit("\0", 1)[-1]: item for key, item in self.entries()}
        raise ValueError(f"unknown type {kind!r}")


def decode(text: str | None) -> str | None:
    """JSON text of a serialized value; NULL when it cannot be decoded.

    Arrays keyed 0, 1, 2, ... become JSON arrays, all others objects.
    """
    if text is None:
        return None
    reader = _Reader(text.encode("utf-8"))
    try:
        value = reader.value()
        if reader.at != len(reader.data):
            return None
        return json.dumps(value, ensure_ascii=False)
    except (ValueError, RecursionError):
        return None


@F.arrow_udf(T.StringType())
def _php_to_json(values: pa.Array) -> pa.Array:
    return pa.array([decode(value) for value in values.to_pylist()], pa.string())


def php_to_json(col: Column | str) -> Column:
    """JSON text of a PHP-serialized string column (NULL if undecodable)."""
    return _php_to_json(col)
