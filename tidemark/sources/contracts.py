"""Record contracts: Avro schemas as Spark, Arrow and DDL types, validation, and
the framed messages of a schema registry."""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PLAIN = {
    "string": (T.StringType(), pa.string(), "String"),
    "int": (T.IntegerType(), pa.int32(), "Int32"),
    "long": (T.LongType(), pa.int64(), "Int64"),
    "float": (T.FloatType(), pa.float32(), "Float32"),
    "double": (T.DoubleType(), pa.float64(), "Float64"),
    "boolean": (T.BooleanType(), pa.bool_(), "Bool"),
    "bytes": (T.BinaryType(), pa.binary(), "String"),
}
_LOGICAL = {
    "date": (T.DateType(), None, "Date"),
    "timestamp-millis": (T.TimestampType(), None, "DateTime64(3)"),
    "timestamp-micros": (T.TimestampType(), None, "DateTime64(6)"),
}


def branches(kind) -> tuple[bool, object]:
    """(nullable, first branch that is not null)."""
    if isinstance(kind, list):
        rest = [k for k in kind if k != "null"]
        return len(rest) < len(kind), rest[0] if rest else "string"
    return False, kind


def _name(kind) -> str:
    return kind["type"] if isinstance(kind, dict) else kind


def spark_type(kind) -> T.DataType:
    _, kind = branches(kind)
    if isinstance(kind, dict):
        if kind.get("logicalType") in _LOGICAL:
            return _LOGICAL[kind["logicalType"]][0]
        if kind["type"] == "array":
            return T.ArrayType(spark_type(kind["items"]))
    return _PLAIN.get(_name(kind), _PLAIN["string"])[0]


def arrow_type(kind) -> pa.DataType:
    _, kind = branches(kind)
    if isinstance(kind, dict) and kind["type"] == "array":
        return pa.list_(arrow_type(kind["items"]))
    return _PLAIN.get(_name(kind), _PLAIN["string"])[1]


def ddl_type(kind) -> str:
    nullable, kind = branches(kind)
    if isinstance(kind, dict):
        if kind["type"] == "array":
            return f"Array({ddl_type(kind['items'])})"  # an array is empty, never null
        name = _LOGICAL[kind["logicalType"]][2] if kind.get("logicalType") in _LOGICAL else _PLAIN.get(kind["type"], _PLAIN["string"])[2]
    else:
        name = _PLAIN.get(kind, _PLAIN["string"])[2]
    return f"Nullable({name})" if nullable else name


def to_struct(schema: dict) -> T.StructType:
    return T.StructType([T.StructField(f["name"], spark_type(f["type"]), branches(f["type"])[0]) for f in schema["fields"]])


def to_arrow(schema: dict) -> pa.Schema:
    return pa.schema([pa.field(f["name"], arrow_type(f["type"]), nullable=branches(f["type"])[0]) for f in schema["fields"]])


def key_of(schema: dict) -> str | None:
    names = [f["name"] for f in schema["fields"]]
    return next((k for k in ("id", "job_id") if k in names), None)


def to_ddl(schema: dict, table: str) -> str:
    lines = ",\n".join(f"  {f['name']} {ddl_type(f['type'])}" for f in schema["fields"])
    return f"CREATE TABLE IF NOT EXISTS {table} (\n{lines}\n) ENGINE = ReplacingMergeTree ORDER BY {key_of(schema) or 'tuple()'}"


def check_record(schema: dict, record: dict) -> list[str]:
    """What is wrong with a record; empty if nothing."""
    wrong = []
    for f in schema["fields"]:
        nullable, kind = branches(f["type"])
        value = record.get(f["name"], f.get("default"))
        if value is None:
            if not nullable:
                wrong.append(f"{f['name']} is missing")
        elif not _fits(kind, value):
            wrong.append(f"{f['name']} is {value!r}")
    return wrong


def _fits(kind, value) -> bool:
    if isinstance(kind, list):
        return any((k == "null" and value is None) or (k != "null" and value is not None and _fits(k, value)) for k in kind)
    name = _name(kind)
    if name == "array":
        return isinstance(value, list) and all(_fits(kind["items"], v) for v in value)
    if name == "enum":
        return value in kind["symbols"]
    if name in ("int", "long"):
        bits = 31 if name == "int" else 63
        return isinstance(value, int) and not isinstance(value, bool) and -(2**bits) <= value < 2**bits
    kinds = {"string": str, "float": (int, float), "double": (int, float), "boolean": bool, "bytes": bytes}
    return isinstance(value, kinds.get(name, object)) and not (name in ("float", "double") and isinstance(value, bool))


def invalid_rows(df: DataFrame, schema: dict) -> DataFrame:
    """Rows that break the contract, with the fields at fault: nulls where none
    may be, also in arrays, enum values outside their symbols, numbers that the
    declared width does not hold, and text that is no number or boolean."""
    faults = []
    for f in schema["fields"]:
        nullable, kind = branches(f["type"])
        column = F.col(f["name"]) if f["name"] in df.columns else F.lit(None)
        if not nullable:
            faults.append(F.when(column.isNull(), F.lit(f["name"])))
        wrong = _out_of_range(kind, column)
        if wrong is not None:
            faults.append(F.when(column.isNotNull() & wrong, F.lit(f["name"])))
    listed = F.filter(F.array(*faults), lambda x: x.isNotNull()) if faults else F.array().cast("array<string>")
    return df.withColumn("faults", listed).filter(F.size("faults") > 0)


def _out_of_range(kind, column: Column) -> Column | None:
    """Whether a value that is there does not fit its declared type."""
    name = _name(kind)
    if name == "enum":
        return ~column.cast("string").isin(*kind["symbols"])
    if name == "array":
        item = branches(kind["items"])
        inner = F.exists(column, lambda x: x.isNull()) if not item[0] else F.lit(False)
        return F.coalesce(inner, F.lit(False))
    if name in ("int", "long", "float", "double", "boolean"):
        to = {"int": "int", "long": "bigint", "float": "double", "double": "double", "boolean": "boolean"}[name]
        return column.cast("string").try_cast(to).isNull()
    return None


# --- messages: a zero byte, the schema id (big-endian), Avro binary -----------


def frame(payload: Column, schema_id: int) -> Column:
    return F.concat(F.lit(b"\x00" + struct.pack(">I", schema_id)), payload)


def unframe(value: Column) -> Column:
    """struct(schema_id, payload); an error where the first byte is not zero."""
    bad = F.raise_error(F.lit("a message does not begin with the magic byte")).cast("int")
    number = F.conv(F.hex(F.substring(value, 2, 4)), 16, 10).cast("int")
    return F.struct(
        F.when(F.hex(F.substring(value, 1, 1)) == "00", number).otherwise(bad).alias("schema_id"),
        F.substr(value, F.lit(6)).alias("payload"),
    )


def _write_long(n: int) -> bytes:
    n, out = (n << 1) ^ (n >> 63), bytearray()
    while n & ~0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes(out + bytes([n]))


def _write(kind, value) -> bytes:
    if isinstance(kind, list):
        at = next(i for i, k in enumerate(kind) if (k == "null") == (value is None))
        return _write_long(at) + (b"" if value is None else _write(kind[at], value))
    name = _name(kind)
    if name == "array":
        items = b"".join(_write(kind["items"], v) for v in value)
        return (_write_long(len(value)) + items if value else b"") + b"\x00"
    if name == "enum":
        return _write_long(kind["symbols"].index(value))
    if name == "record":
        return b"".join(_write(f["type"], value.get(f["name"], f.get("default"))) for f in kind["fields"])
    if name in ("int", "long"):
        return _write_long(value)
    if name in ("string", "bytes"):
        data = value.encode() if name == "string" else value
        return _write_long(len(data)) + data
    if name == "boolean":
        return bytes([value])
    return struct.pack("<f" if name == "float" else "<d", value)


class _Cursor:
    def __init__(self, data: bytes):
        self.data, self.at = data, 0

    def take(self, n: int) -> bytes:
        self.at += n
        return self.data[self.at - n : self.at]

    def long(self) -> int:
        n = shift = 0
        while True:
            b = self.take(1)[0]
            n |= (b & 0x7F) << shift
            if b < 0x80:
                return (n >> 1) ^ -(n & 1)
            shift += 7

    def read(self, kind):
        if isinstance(kind, list):
            return self.read(kind[self.long()])
        name = _name(kind)
        if name == "null":
            return None
        if name == "array":
            out = []
            while n := self.long():
                if n < 0:  # a block that states its bytes
                    n = -n
                    self.long()
                out += [self.read(kind["items"]) for _ in range(n)]
            return out
        if name == "enum":
            return kind["symbols"][self.long()]
        if name == "record":
            return {f["name"]: self.read(f["type"]) for f in kind["fields"]}
        if name in ("int", "long"):
            return self.long()
        if name in ("string", "bytes"):
            data = self.take(self.long())
            return data.decode() if name == "string" else data
        if name == "boolean":
            return self.take(1) == b"\x01"
        return struct.unpack("<f" if name == "float" else "<d", self.take(4 if name == "float" else 8))[0]


def encode_record(schema: dict, record: dict) -> bytes:
    return _write(schema, record)


def decode_record(schema: dict, payload: bytes) -> dict:
    return _Cursor(payload).read(schema)


def decode_messages(df: DataFrame, schema: dict, column: str = "payload") -> DataFrame:
    """Records of a column of Avro binary, in the contract's Spark schema."""
    to, arrow = to_struct(schema), to_arrow(schema)
    loose = pa.schema([f.with_nullable(True) for f in arrow])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [decode_record(schema, x) for x in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_pylist(rows, schema=loose)

    return df.select(column).mapInArrow(run, to)


# --- contracts ---------------------------------------------------------------

_SLUG = re.compile(r"^[a-z][a-z0-9]*(?:[-_][a-z0-9]+)*$")
_NEEDS = {"producer": ["schema", "topic"], "streaming": ["topic", "sink", "resources"]}


@dataclass
class Contract:
    name: str
    kind: str
    body: dict = field(default_factory=dict)

    def __post_init__(self) -> None:
        if not _SLUG.match(self.name or ""):
            raise ValueError(f"{self.name!r} is not a name")
        if self.kind not in _NEEDS:
            raise ValueError(f"{self.name}: unknown kind {self.kind!r}")
        if lacking := [k for k in _NEEDS[self.kind] if not self.body.get(k)]:
            raise ValueError(f"{self.name}: without {', '.join(lacking)}")
        if self.kind == "streaming" and not (self.body["resources"].get("limits") or {}).get("memory"):
            raise ValueError(f"{self.name}: without a memory limit")

    def environment(self) -> dict[str, str]:
        """Settings in upper case; empty ones dropped."""
        return {k.upper(): str(v) for k, v in (self.body.get("settings") or {}).items() if v not in (None, "")}


def load_contracts(folder: str) -> list[Contract]:
    """Every YAML contract of a folder in order of name, but for default.yaml."""
    from pathlib import Path

    import yaml

    out = []
    for path in sorted(Path(folder).glob("*.yaml")):
        if path.name != "default.yaml":
            doc = yaml.safe_load(path.read_text(encoding="utf-8")) or {}
            out.append(Contract(doc.pop("name", path.stem), doc.pop("kind", "producer"), doc))
    return out


def topics(contracts: list[Contract]) -> list[str]:
    return sorted({str(c.body["topic"]) for c in contracts})


def load_schema(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def plan_topics(wanted: list[str], present: set[str]) -> list[tuple[str, int, int]]:
    """(name, partitions, replicas) of the topics to create, from
    ``name:partitions:replicas``; a malformed entry fails before any is made."""
    parsed = []
    for entry in wanted:
        if not re.fullmatch(r"[A-Za-z0-9._-]+:[1-9]\d*:[1-9]\d*", entry):
            raise ValueError(f"malformed topic {entry!r}")
        name, partitions, replicas = entry.split(":")
        parsed.append((name, int(partitions), int(replicas)))
    return [t for t in parsed if t[0] not in present]


def rendered(contract: Contract, schema: dict) -> dict:
    """What a contract gives a deployment: its table, its subject and its settings."""
    subject = f"{contract.body['topic']}-value"
    return {"name": contract.name, "subject": subject, "ddl": to_ddl(schema, contract.name.replace("-", "_")), "environment": contract.environment()}


def register(contracts: list[Contract], schemas: dict[str, dict], have: dict[str, str]) -> dict[str, str]:
    """Subjects whose schema must be registered: new or changed. Schemas are
    compared in one spelling, so order and blanks of their JSON do not matter."""
    spelled = lambda schema: json.dumps(schema, sort_keys=True, separators=(",", ":"))
    out = {}
    for c in contracts:
        if c.kind == "producer":
            subject = f"{c.body['topic']}-value"
            if have.get(subject) != spelled(schemas[c.body["schema"]]):
                out[subject] = spelled(schemas[c.body["schema"]])
    return out


def unpinned(documents: list[dict]) -> list[str]:
    """Images in deployment documents that are not pinned by tag or digest."""
    found: list[str] = []
    stack = list(documents)
    while stack:
        node = stack.pop()
        if isinstance(node, dict):
            image = node.get("image")
            if isinstance(image, str):
                name, _, tag = image.rpartition("/")[2].partition(":")
                if "@sha256:" not in image and tag in ("", "latest"):
                    found.append(image)
            stack += node.values()
        elif isinstance(node, list):
            stack += node
    return sorted(set(found))
