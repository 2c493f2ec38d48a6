"""Token ids and token counts of a whole corpus with a public byte-level vocabulary."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tracewright.functions.shared import spread
from tracewright.llm.bpe import PIECE, Encoder

#: Where the public vocabularies lie; a parameter of every operator that needs one.
TOKENIZERS = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")
_ENCODERS: dict[int, Encoder] = {}


def encoder_source(df: DataFrame, tokenizers: str, name: str) -> Callable[[], Encoder]:
    """A function for workers that gives the encoder, built once a process. The driver reads the vocabulary file (its
    size is fixed by the public vocabulary, under 2 MB) and broadcasts its bytes."""
    with open(os.path.join(tokenizers, f"{name}.json"), "rb") as f:
        shared = df.sparkSession.sparkContext.broadcast(f.read())

    def get() -> Encoder:
        vocabulary = shared.value
        key = hash(vocabulary)
        if key not in _ENCODERS:
            _ENCODERS[key] = Encoder(vocabulary)
        return _ENCODERS[key]

    return get


def slices(sizes: np.ndarray, most: int = 2 * PIECE) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes each, so that a batch of long texts is not exploded at once."""
    ends = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")))
        yield at, to
        at = to


def _lengths(column: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def token_ids(documents: DataFrame, tokenizers: str = TOKENIZERS, name: str = "byte_bpe_50k") -> DataFrame:
    """(doc_id, ids) of every document, without special tokens; their spellings in a text are ordinary text.

    Null and empty texts give the empty list; repeated rows give a row each; extra columns are ignored; texts of any
    length are encoded whole, in pieces between which no word runs.
    """
    get = encoder_source(documents, tokenizers, name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = get()
        for batch in batches:
            for a, b in slices(_lengths(batch.column(1))):
                part = batch.slice(a, b - a)
                ids, counts = encoder.encode(part.column(1).to_pylist())
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], names=["doc_id", "ids"])

    return spread(documents.select(documents["doc_id"].cast("bigint"), documents["text"])).mapInArrow(run, "doc_id bigint, ids array<int>")


def token_counts(documents: DataFrame, keep: list[str], tokenizers: str = TOKENIZERS, name: str = "byte_bpe_50k") -> DataFrame:
    """The columns ``keep`` of each document with ``n_tokens`` (0 for null and empty texts) and ``n_text_chars``."""
    get = encoder_source(documents, tokenizers, name)
    chosen = spread(documents.select(*keep, "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = get()
        for batch in batches:
            texts = batch.column(len(keep))
            for a, b in slices(_lengths(texts)):
                part = batch.slice(a, b - a)
                own = part.column(len(keep)).to_pylist()
                chars = np.fromiter((len(t) if t else 0 for t in own), np.int64, len(own))
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], pa.array(encoder.count(own)), pa.array(chars)], names=[*keep, "n_tokens", "n_text_chars"])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema if f.name in keep)
    return chosen.mapInArrow(run, f"{kept}, n_tokens bigint, n_text_chars bigint")
