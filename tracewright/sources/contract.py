"""The declared contract of extracted records: schema, stream options, digests, and labels from a teacher's cache."""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DTYPES = {"str": T.StringType(), "int": T.LongType(), "float": T.DoubleType(), "bool": T.BooleanType(), "list": T.ArrayType(T.StringType())}


@dataclass(frozen=True)
class Field:
    name: str
    dtype: str = "str"
    required: bool = False
    choices: tuple[str, ...] = ()


@dataclass(frozen=True)
class Contract:
    name: str
    version: int
    entities: tuple[str, ...] = ()
    fields: tuple[Field, ...] = ()
    classifications: dict[str, tuple[str, ...]] = field(default_factory=dict)
    relations: tuple[str, ...] = ()

    def digest(self) -> str:
        """SHA-256 over the sorted JSON with the default separators; another digest is another lineage."""
        return hashlib.sha256(json.dumps(asdict(self), sort_keys=True, ensure_ascii=False).encode()).hexdigest()

    def problems(self) -> list[str]:
        """Everything that is wrong with the contract; empty if it may be used."""
        found = [] if self.name and self.version >= 1 else ["a contract needs a name and a version from 1"]
        names = [*self.entities, *(f.name for f in self.fields), *self.classifications, *self.relations]
        found += [f"used more than once: {n}" for n in sorted({n for n in names if names.count(n) > 1})]
        found += ["empty name"] * any(not n for n in names)
        for f in self.fields:
            if f.dtype not in DTYPES:
                found.append(f"unknown type of {f.name}: {f.dtype}")
            if len(set(f.choices)) < len(f.choices):
                found.append(f"repeated choices of {f.name}")
        for task, labels in self.classifications.items():
            if not labels or any(not x for x in labels) or len(set(labels)) < len(labels):
                found.append(f"labels of {task} must be distinct and not empty")
        return found

    def struct(self) -> T.StructType:
        """The columns that records of this contract have; declared, never inferred from data."""
        span = T.StructType([T.StructField("text", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("confidence", T.DoubleType())])
        pair = T.StructType([T.StructField("head", T.StringType()), T.StructField("tail", T.StringType())])
        return T.StructType(
            [T.StructField(e, T.ArrayType(span)) for e in self.entities]
            + [T.StructField(f.name, DTYPES[f.dtype], not f.required) for f in self.fields]
            + [T.StructField(c, T.MapType(T.StringType(), T.DoubleType())) for c in self.classifications]
            + [T.StructField(r, T.ArrayType(pair)) for r in self.relations]
        )


@dataclass(frozen=True)
class StreamConfig:
    path: str
    patterns: tuple[str, ...] = ("*.ndjson",)
    max_bytes: int = 8 << 20
    max_deliver: int = 5
    models: tuple[tuple[str, tuple[str, ...]], ...] = ()
    secrets: dict[str, str] = field(default_factory=dict)

    def problems(self) -> list[str]:
        found = [] if self.path else ["a stream needs a path"]
        if not self.patterns or any("*" in p[1:] or not p for p in self.patterns):
            found.append("patterns are *suffix or exact names")
        if self.max_bytes < 1024 or self.max_deliver < 1:
            found.append("max_bytes from 1024 and max_deliver from 1")
        found += [f"secret {k} must refer to env: or file:" for k, v in self.secrets.items() if not v.startswith(("env:", "file:"))]
        return found

    def allowed_models(self) -> list[str]:
        """Ids and aliases in the order they are declared, each once."""
        return list(dict.fromkeys(n for model, aliases in self.models for n in (model, *aliases)))

    def options(self) -> dict[str, str]:
        """Options of the spool source."""
        return {"path": self.path, "patterns": ",".join(self.patterns), "max_bytes": str(self.max_bytes)}


def cached_labels(documents: DataFrame, cache: DataFrame, contract_digest: str, text: str = "text") -> DataFrame:
    """Documents with ``request_sha256`` and the teacher's cached ``output``; null where a teacher must be asked.

    A request is known by the contract and the text, so the same text is asked once; copies share the answer."""
    request = documents.withColumn("request_sha256", F.sha2(F.concat_ws("\n", F.lit(contract_digest), F.col(text)), 256))
    answers = cache.groupBy("request_sha256").agg(F.min("output").alias("output"))
    return request.join(answers, "request_sha256", "left")


def unanswered(labelled: DataFrame, text: str = "text") -> DataFrame:
    """Each request still to be put to a teacher, once."""
    return labelled.where("output is null").groupBy("request_sha256").agg(F.min(text).alias(text))


ANSWERS = "request_sha256 string, output string, attempts int, error string"


def answered(requests: DataFrame, ask: Callable[[str], str], text: str = "text", attempts: int = 3, wait: float = 0.5, keys: tuple[str, ...] = ()) -> DataFrame:
    """(request_sha256, output, attempts, error) of each request put to a teacher: ``ask`` gives its answer as text.

    An answer must be one JSON object, with nothing around it and, if ``keys`` are given, no others.  What fails is asked
    again after ``wait`` seconds, twice as long each time; after ``attempts`` the last error stands and the output is null.
    Append the outputs to the cache, so nothing is asked twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(key, *_answer(ask, t, attempts, wait, keys)) for key, t in zip(*(c.to_pylist() for c in batch.columns))]
            columns = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int32(), pa.string()))], names=["request_sha256", "output", "attempts", "error"])

    return requests.select("request_sha256", text).mapInArrow(run, ANSWERS)


def _answer(ask: Callable[[str], str], text: str, attempts: int, wait: float, keys: tuple[str, ...]) -> tuple[str | None, int, str | None]:
    error = None
    for n in range(1, attempts + 1):
        try:
            value = json.loads(ask(text))
            if not isinstance(value, dict):
                raise ValueError("no object")
            if keys and (more := sorted(set(value) - set(keys))):
                raise ValueError(f"unknown keys: {','.join(more)}")
            return json.dumps(value, sort_keys=True, ensure_ascii=False), n, None
        except Exception as e:  # noqa: BLE001
            error = f"{type(e).__name__}: {e}"
            if n < attempts:
                time.sleep(wait * 2 ** (n - 1))
    return None, attempts, error
